import math
import re
from collections import defaultdict

import pytest

from reelhouse.llm import mixing as M
from tests.llm.helpers import DOCS, awkward, documents, sentence


def brute_targets(sizes):
    """Targets by the rule: weights 1, 2, 3 by source order, capped at CAP times, excess reshared."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = [s for s in order if s not in full]
        if not left:
            return {s: 3.0 * sizes[s] for s in order}
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def brute_tilt(rows, target):
    """The tilt of one source by bisection."""
    mean = sum(rows) / len(rows)
    low, high = -1e4, 1e4
    for _ in range(400):
        mid = (low + high) / 2
        words = sum(x * math.exp(min(mid * x / mean, math.log(3))) for x in rows)
        low, high = (mid, high) if words < target else (low, mid)
    return low


def check(df, rows):
    out = df.collect()
    sizes, by = defaultdict(int), defaultdict(list)
    for i, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(sizes)
    for r in out:
        by[r.source].append(r)
        assert r.size * r.copies == r.taken <= 3 * r.size and r.copies >= 0
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
    assert len(out) == len(rows)
    return by, want


def test_targets_caps_and_words(spark):
    import random
    rng = random.Random(3)
    rows = [(k, sentence(rng, rng.randrange(1, 60)), f"s{k % 4}" if k % 7 else None) for k in range(400)]
    rows += [(1000, "a b c", "tiny"), (1001, None, "s1"), (1002, "", "void"), (1002, "", "void")]
    docs = documents(spark, rows, extra=True)
    by, want = check(M.mix(docs), rows)
    for s, target in want.items():
        assert abs(sum(r.taken for r in by[s]) - target) <= max(0.01 * target, 3)
    again = M.mix(docs)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted((tuple(r) for v in by.values() for r in v), key=repr)


def test_tilts_solve_the_dual(spark):
    import random
    rng = random.Random(5)
    rows = [(k, sentence(rng, rng.randrange(1, 200)), "ab"[k % 2]) for k in range(300)]
    sized = M.sizes(documents(spark, rows))
    counts = sized.groupBy("source", "size").count().withColumnRenamed("count", "n")
    total = {r[0]: r[1] for r in sized.groupBy("source").sum("size").collect()}
    aims = spark.createDataFrame([("a", total["a"], 0.4 * total["a"]), ("b", total["b"], 2.2 * total["b"])],
                                 "source string, source_size long, target double")
    for r in M.tilts(counts, aims).collect():
        words = [len(t.split()) for _, t, s in rows if s == r.source]
        assert r.tilt == pytest.approx(brute_tilt(words, r.target), abs=1e-5)


def test_awkward_and_empty(spark):
    check(M.mix(documents(spark, awkward())), awkward())
    assert M.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_partitions_do_not_change_the_mix(spark):
    """Sixty rows whose sizes tie, in 1, 3 and 7 partitions and in another order."""
    rows = [(k if k % 9 else None, sentence(__import__("random").Random(k % 7), 10 + k % 7), "abc"[k % 3]) for k in range(60)]
    seen = []
    for n in (1, 3, 7):
        docs = documents(spark, rows[n:] + rows[:n]).repartition(n)
        seen.append(sorted((tuple(r) for r in M.taken(docs).select("doc_id", "size", "taken").collect()), key=repr))
    assert seen[0] == seen[1] == seen[2] and sum(r[2] for r in seen[0])
