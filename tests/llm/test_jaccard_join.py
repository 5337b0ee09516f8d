import itertools
import random
import re

import numpy as np
import pytest

from reelhouse.llm import jaccard_join as J
from reelhouse.llm.common import Scratch
from reelhouse.llm.components import components
from tests.llm.helpers import DOCS, awkward, documents, same, sentence


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t, _ in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            group[find(a)] = find(b)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows)))


def families(seed, n_families=6, size=14, words=80):
    """Groups of copies with a few words changed: links, chains and near misses."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n_families):
        base = sentence(rng, words, 3000).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w), "s"))
    return rows


def test_equals_sql(spark):
    docs = documents(spark, awkward(), extra=True)
    same(J.similar_groups(docs), J.SQL, documents=docs.select("doc_id", "text"))


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (2, 60)])
def test_families_equal_brute_force(spark, k, percent):
    rows = families(k) + [(1000 + i, t, s) for i, t, s in awkward(k)]
    got = J.similar_groups(documents(spark, rows), k, percent).collect()
    assert sorted(map(tuple, got)) == brute(rows, k, percent)


def test_large_buckets_and_dense_ones_lose_nothing(spark, monkeypatch):
    """Common shingles, trees, parts of a large bucket and exact second traversals, forced on small data."""
    for name, value in (("FEW", 2), ("PER_CLASS", 0), ("BUCKET", 6), ("BLOCK", 3), ("COMMON_LEAST", 5), ("LEAF", 2), ("FANOUT", 2)):
        monkeypatch.setattr(J, name, value)
    rows = families(9, 4, 20)
    got = J.similar_groups(documents(spark, rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 85)


def test_null_ids_repeats_and_empty_table(spark):
    rows = [(None, "a b c d e", "s"), (3, "a b c d e", "s"), (3, "a b c d e", "s"), (None, None, "s")]
    got = sorted(map(tuple, J.similar_groups(documents(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 2, 3), (3, 2, 3), (3, 2, 3), (None, 0, None)], key=repr)
    assert J.similar_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = awkward() + [(1, awkward()[0][1], "a")]
    docs = documents(spark, rows, extra=True)
    kept = J.keep_first(docs, 4, 85)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    want = sorted({i for i, _, c in brute(awkward(), 4, 85) if i == c})
    assert ids == want


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 40, rng.integers(1, 200)).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.95], rng.integers(0, 1 << 40, 4).astype(np.uint64))))
        bits = [J.bitmap(a).tobytes(), J.bitmap(b).tobytes()]
        n = np.array([len(a), len(b)])
        if len(b) and J.linked(a, b, 80):
            assert J.possible_pairs(n, bits, np.array([0]), np.array([1]), 80)[0]
            assert list(J.tree_pairs(n, bits, np.array([0, 1]), 80))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 100 + k) for k in range(1, 20)] + [(7, 7), (200, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()))
    assert all(got[i] == 1 for i in range(1, 31)) and all(got[100 + k] == 100 for k in range(20)) and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0
