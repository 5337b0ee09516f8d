"""SimHash near-duplicates against brute force."""
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from reelhouse.llm import simhash_join
from reelhouse.llm.common import Scratch
from tests.conftest import SF001
from tests.llm.helpers import awkward, documents


def brute_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest class of each class, of the transitive closure of links."""
    fps = sorted(set(prints))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= simhash_join.DISTANCE:
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {f: find(f) for f in fps}


def check(df, rows):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)
    prints = [(i, brute_print(t)) for i, t in rows]
    comp = brute_components([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[comp[p]] = min(i, least.get(comp[p], i))
    assert got == sorted(((i, f"{p:016x}", least.get(comp[p])) for i, p in prints), key=str)


def test_awkward_rows_equal_brute_force(spark):
    rows = awkward()
    rows += [(None, rows[0][1], "a"), (None, "only null ids have this text", "a"), (1, rows[0][1], "b")]
    check(simhash_join.near_duplicates(documents(spark, rows, extra=True)), [r[:2] for r in rows])


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    check(simhash_join.near_duplicates(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark):
    assert simhash_join.near_duplicates(documents(spark, [])).count() == 0


def _links(spark, fps):
    classes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    found = simhash_join.links(classes, Scratch(spark)).collect()
    mask = (1 << 64) - 1
    return [(r.a & mask, r.b & mask) for r in found]


def test_links_join_what_brute_force_joins(spark, monkeypatch):
    """Sparse and dense balls of classes; the small bucket size needs several rounds."""
    rng = random.Random(4)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice((0, 1, 1, 2, 3, 4)))))
    centre = rng.getrandbits(64)
    fps = sorted(fps | {centre ^ k << 20 for k in range(1500)})
    want = brute_components(fps)
    for bucket in (4096, 512):
        monkeypatch.setattr(simhash_join, "BUCKET", bucket)
        found = _links(spark, fps)
        assert all(0 < (a ^ b).bit_count() for a, b in found)
        root = {f: f for f in fps}
        for _ in range(len(fps)):
            moved = False
            for a, b in found:
                low = min(root[a], root[b])
                moved |= root[a] != low or root[b] != low
                root[a] = root[b] = low
            if not moved:
                break
        assert root == want


def test_every_linked_pair_shares_a_bucket_within_its_budgets():
    rng = random.Random(5)
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 3)))
        x = np.array([differ], dtype=np.uint64)
        assert any(not differ & simhash_join.chain(i)[0][1] and simhash_join.near(x, simhash_join.chain(i)[0])[0]
                   for i in range(1, simhash_join.SEGMENTS + 1))


def test_paths_leave_fewer_bits_each_round():
    path, left = 0, []
    for _ in range(4):
        path = path * simhash_join.SEGMENTS + 1
        left.append(len(simhash_join.chain(path)[1]))
    assert left[0] < 40 and left[-1] <= 9


def test_no_join_of_all_pairs(spark):
    """A third of all rows in one class is one row of the joins."""
    rows = [(i, "the same words again and again here", "a") for i in range(300)] + [(1000 + i, f"t{i} u{i} v{i} x{i}", "a") for i in range(300)]
    got = simhash_join.near_duplicates(documents(spark, rows))
    assert got.where("doc_id < 1000").agg(F.max("component_id")).first()[0] == 0
    assert got.count() == 600
