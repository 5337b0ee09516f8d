"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has a bit set where more than half of its word shingles'
64-bit hashes have it.  Two fingerprints link at ``DISTANCE`` differing bits or
fewer; equal fingerprints are one class, so a group of copies costs one row.

*Pigeonring.*  The undecided bits form a ring of ``SEGMENTS`` consecutive
segments.  If two fingerprints differ in at most t bits, there is a segment from
which every chain of l consecutive segments has at most ``floor(l * t / m)``
differences.  With t = 2 and m = 5 the first two segments of that chain are equal
(the bucket key), three and four have one difference at most, the whole ring two:
a pair goes through these budgets before the full Hamming check counts.

*Buckets.*  Each class is in one bucket for each start of a chain.  Buckets of
one class are dropped, those of up to ``BUCKET`` classes are compared inside one
task.  A larger one is dealt anew by a ring over the bits its key leaves
undecided, which fixes two fifths of these; after four rounds at most 2**9
classes can share a key, so no bucket of any input is compared whole.

*Result.*  Buckets return the links that join their classes, small ones every
link; connected components give each class the smallest doc_id it reaches.

Edge cases: null, empty and blank texts have fingerprint zero and link like any
other; texts with fewer words than a shingle are one shingle; a null doc_id stays
null and is never a component's id unless all its documents have none; repeated
rows are members of one class; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Words, text_blocks
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENTS = 2 * DISTANCE + 1       # then a chain starts with DISTANCE equal segments
BUCKET = 4096                     # classes compared inside one task
SMALL = 64                        # classes of a bucket whose links are all returned

ROWS = "path int, key long, fp long"


def fingerprints(texts: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    words = Words([t.lower() for t in texts])          # bytes.lower() changes A-Z only
    n = np.where(words.counts > 0, np.maximum(words.counts - k + 1, 1), 0)
    out = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    offsets = np.concatenate(([0], np.cumsum(n[some])[:-1]))
    first = words.doc_first[some]
    begin = np.arange(int(n.sum())) + np.repeat(first - offsets, n[some])
    end = np.minimum(begin + k - 1, np.repeat(first + words.counts[some] - 1, n[some]))
    data, digest = words.data, xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[i:j], SEED) for i, j in zip(words.starts[begin].tolist(), words.ends[end].tolist())),
                         dtype=np.uint64, count=len(begin))
    for bit in range(64):
        ones = np.add.reduceat((hashes >> np.uint64(bit)).astype(np.uint8) & 1, offsets, dtype=np.int64)
        out[some] |= (2 * ones > n[some]).astype(np.uint64) << np.uint64(bit)
    return out


def _fingerprint_rows(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_blocks(batches, "id", "text"):
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fingerprints(texts, k).view(np.int64))],
                                         names=["id", "fp"])


@cache
def chain(path: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(masks of the chains of 1 .. SEGMENTS segments, bits the bucket leaves undecided) of a bucket's path.

    A path is the starts of its rounds, as digits 1 .. SEGMENTS, the last round last."""
    before, start = divmod(path - 1, SEGMENTS)
    free = chain(before)[1] if before else tuple(range(64))
    cuts = [len(free) * i // SEGMENTS for i in range(SEGMENTS + 1)]
    segments = [free[i:j] for i, j in zip(cuts, cuts[1:])]
    ring = segments[start:] + segments[:start]
    masks, mask = [], 0
    for segment in ring:
        mask |= sum(1 << b for b in segment)
        masks.append(mask)
    return tuple(masks), tuple(b for segment in ring[DISTANCE:] for b in segment)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (path, fp): one for each start of a chain of the next round, with its key."""
    for b in batches:
        path, fp = b.column("path").to_numpy(), b.column("fp").to_numpy()
        for old in np.unique(path).tolist():
            rows = fp[path == old]
            for start in range(SEGMENTS):
                new = old * SEGMENTS + start + 1
                fixed, p = 0, new
                while p:                                        # the bits all rounds have fixed
                    fixed |= chain(p)[0][DISTANCE - 1]
                    p = (p - 1) // SEGMENTS
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(rows), new, dtype=np.int32)), pa.array(rows & np.int64(_signed(fixed))),
                    pa.array(rows)], names=["path", "key", "fp"])


def near(x: np.ndarray, masks: tuple[int, ...]) -> np.ndarray:
    """Whether the differences ``x`` of pairs stay within the budget of every chain."""
    ok = np.ones(x.shape, dtype=bool)
    for length in range(DISTANCE + 1, SEGMENTS + 1):
        ok &= np.bitwise_count(x & np.uint64(masks[length - 1])) <= length * DISTANCE // SEGMENTS
    return ok


def _spanning(fp: np.ndarray, masks: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the classes of one bucket: each class and the first of its component."""
    label = np.arange(len(fp))
    for i in range(0, len(fp), 256):
        a, b = np.nonzero(near(fp[i:i + 256, None] ^ fp[None, i:], masks))
        a, b = a + i, b + i
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of whole buckets; the rows arrive sorted by (path, key)."""
    held: list[np.ndarray] = []

    def solved(rows: np.ndarray) -> pa.RecordBatch:
        path, fp = rows[0], rows[2].view(np.uint64)
        bucket = np.cumsum(np.concatenate(([0], (np.diff(path) != 0) | (np.diff(rows[1]) != 0))))
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        size = np.diff(np.append(begin, len(path)))
        out = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        for g in np.flatnonzero(size > SMALL).tolist():
            out.append(_spanning(fp[begin[g]:begin[g] + size[g]], chain(int(path[begin[g]]))[0]))
        few = np.flatnonzero(size[bucket] <= SMALL)
        for step in range(1, SMALL):                            # each class with the step-th one after it
            a = few[few + step < len(path)]
            few = a = a[bucket[a] == bucket[a + step]]
            if not len(a):
                break
            for p in np.unique(path[a]).tolist():
                own = a[path[a] == p]
                own = own[near(fp[own] ^ fp[own + step], chain(p)[0])]
                out.append((fp[own], fp[own + step]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(side).view(np.int64)) for side in zip(*out)], names=["a", "b"])

    for b in batches:
        held.append(np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("path", "key", "fp")]))
        if sum(h.shape[1] for h in held) >= 1 << 18:
            rows = np.concatenate(held, axis=1)
            whole = (rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1])
            if whole.any():                                     # the last bucket may go on
                yield solved(rows[:, whole])
            held = [rows[:, ~whole]]
    if held:
        yield solved(np.concatenate(held, axis=1))


def links(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that join all classes within ``DISTANCE``."""
    left = classes.select(F.lit(0).alias("path"), "fp")
    found = []
    while True:
        rows = scratch.store(left.mapInArrow(_deal, ROWS), "simhash-rows")
        sized = rows.groupBy("path", "key").agg(F.count("*").alias("size")).where("size > 1")
        rows = scratch.store(rows.join(sized, ["path", "key"]), "simhash-buckets")
        found.append(rows.where(F.col("size") <= BUCKET).select("path", "key", "fp").repartition("path", "key")
                     .sortWithinPartitions("path", "key").mapInArrow(_compare, "a long, b long"))
        left = rows.where(F.col("size") > BUCKET).select("path", "fp")
        if left.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return scratch.store(out, "simhash-links")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every document."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    prints = scratch.store(rows.mapInArrow(lambda batches: _fingerprint_rows(batches, k), "id long, fp long"), "simhash-prints")
    classes = scratch.store(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes")
    nodes = scratch.store(components(links(classes, scratch), scratch).distinct(), "simhash-nodes")
    joined = classes.join(nodes, F.col("fp") == F.col("node"))
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    of_class = classes.join(
        joined.join(least, "component").select("fp", "least"), "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("component_id"))
    of_class = scratch.store(of_class, "simhash-components")
    return prints.join(of_class, "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
