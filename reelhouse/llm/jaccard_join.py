"""N-gram Jaccard join with signature trees.

Documents are sets of word shingles; two link when
``100 * intersection >= percent * union``.  Equal sets form one class first, so
a group of copies costs one set.  Then

1. *Routing.*  Similar sets must share one of the first ``n - need + 1`` of
   their shingles under any common order (prefix filter).  The order puts
   shingles of frequent words, and shingles many documents share, last; these
   are found by one counting pass, whose lists hold only items above a fixed
   share of the corpus.  Shingles met in two classes or more become buckets.
2. *Leaders.*  Each bucket's most central class (largest share of widely shared
   shingles) meets the others: linear work that joins most of a large group.
3. *Trees.*  Buckets that still hold several components build a signature tree:
   leaves are classes of similar size, nodes hold the OR of their token bitmaps,
   their size range and bitmap slack.  A dual traversal drops a node pair when
   even the largest possible overlap is too small, when sizes are too far
   apart, or when all its classes are in one component already.  A first
   traversal sees bitmaps only and names the classes with a possible partner; a
   second one, with the shingles of those alone, tests pairs exactly and skips
   what is joined meanwhile, so it returns at most one link for each class.
   Larger buckets are cut by size and then into blocks whose pairs are separate
   tasks.
4. *Components* of all links give each document the smallest doc_id it reaches.

Shingles are 64-bit codes; every decision on a pair is made on whole sets.

Edge cases: null and blank texts have no shingles and link with nothing;
texts with fewer words than a shingle are one shingle of their own length;
a null doc_id counts as the largest; repeated rows are members of one class;
empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, Scratch, Words, drop_stored, mix, stored, text_blocks, window_hash
from .components import components

SHINGLE = 4
PERCENT = 85
SHARE = 17                 # frequent words have at least 2**-17 of all words
COMMON = 20                # common shingles have at least 2**-20 of all shingles
COMMON_LEAST = 64
LOCALLY = 3                # occurrences within one block that make an item worth counting
LAST_CLASS = 63            # order class of common shingles
ROOM = 4                   # bits of bitmap for each shingle
LEAF = 32
FANOUT = 8
FEW = 8                    # classes of a bucket compared without a tree
PER_CLASS = 4              # candidate pairs a bucket may return for each of its classes
BUCKET = 4096              # classes of one bucket that one task takes
BLOCK = 1024

COUNTS = "kind int, code long, n long"
SKETCH = "id long, n long, hot int, key binary, prefix binary, bits binary"
NODES = "node long, tokens binary"


def need(size: int, percent: int) -> int:
    """Smallest intersection of two sets with ``size`` members together that links them."""
    return -(-percent * size // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _shingles(words: Words, hashes: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(text index, positions of its shingles' first words) for texts of k words or more."""
    for d in np.flatnonzero(words.counts >= k).tolist():
        first = words.doc_first[d]
        yield d, slice(first, first + words.counts[d] - k + 1)


def _lower(texts: list[bytes]) -> list[bytes]:
    return [t.lower() for t in texts]          # bytes.lower() changes A-Z only


def _count(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for _, texts in text_blocks(batches, "id", "text"):
        words = Words(_lower(texts))
        hashes = words.hashes()
        rows = [(np.zeros(0, np.uint64), np.array([len(hashes)]), 0)]
        for kind, codes in ((1, hashes), (2, mix(window_hash(hashes, k)))):
            code, n = np.unique(codes, return_counts=True)
            rows.append((code[n >= LOCALLY], n[n >= LOCALLY], kind))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.full(len(n), kind, np.int32) for _, n, kind in rows])),
            pa.array([None] + np.concatenate([c for c, _, _ in rows]).view(np.int64).tolist(), pa.int64()),
            pa.array(np.concatenate([n for _, n, _ in rows]).astype(np.int64))], names=["kind", "code", "n"])


class Order:
    """A common order of shingles: expected copies by word frequency, then hash; common shingles last."""

    def __init__(self, total: int, words: list[tuple[int, int]], common: list[int]):
        code = np.array([w for w, _ in words], dtype=np.int64).view(np.uint64)
        by = np.argsort(code)
        self.words = code[by]
        share = np.array([n for _, n in words], dtype=float)[by] / max(total, 1)
        # whole numbers, so that a shingle's class does not depend on its place in a block
        self.log = np.round(1024 * np.log2(np.maximum(share, 2.0 ** -SHARE))).astype(np.int64)
        self.common = np.sort(np.array(common, dtype=np.int64).view(np.uint64))
        self.expect = round(1024 * (math.log2(max(total, 2)) + 6))

    def codes(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(code of the shingle starting at each word, whether it is common)."""
        shingle = mix(window_hash(hashes, k))
        if not len(shingle):
            return shingle, np.zeros(0, dtype=bool)
        log = np.full(len(hashes), -1024 * (SHARE + 1), dtype=np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            log = np.where(self.words[at] == hashes, self.log[at], log)
        total = np.cumsum(np.concatenate(([0], log)))
        level = (total[k:] - total[:-k] + self.expect) >> 10
        level = np.clip(level, 0, LAST_CLASS - 1).astype(np.uint64)
        common = np.zeros(len(shingle), dtype=bool)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, shingle), len(self.common) - 1)
            common = self.common[at] == shingle
        level[common] = LAST_CLASS
        return (level << np.uint64(57)) | (shingle >> np.uint64(7)), common


def _sets(texts: list[bytes], k: int, order: Order) -> Iterator[tuple[np.ndarray, int] | None]:
    """For each text its sorted distinct shingle codes and how many are common; None without words."""
    words = Words(_lower(texts))
    hashes = words.hashes()
    codes, _ = order.codes(hashes, k)
    for d, n in enumerate(words.counts.tolist()):
        first = int(words.doc_first[d])
        if n >= k:
            code = np.unique(codes[first:first + n - k + 1])
            yield code, int((code >> np.uint64(57) == LAST_CLASS).sum())
        elif n:
            one = mix(window_hash(hashes[first:first + n], n) + np.uint64(n))
            yield one >> np.uint64(7), 0
        else:
            yield None


def bitmap(code: np.ndarray) -> np.ndarray:
    """The set's token bitmap: ROOM bits a token or up to twice that, a power of two, 64 at least."""
    width = max(64, 1 << (ROOM * len(code) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(code & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def _key(code: np.ndarray) -> bytes:
    return hashlib.blake2b(code.tobytes(), digest_size=16).digest()


def _sketch(batches, k: int, percent: int, order: Order) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_blocks(batches, "id", "text"):
        rows: list[tuple] = []
        for i, got in zip(ids, _sets(texts, k, order)):
            if got is None:
                rows.append((i, 0, 0, None, None, None))
                continue
            code, hot = got
            rows.append((i, len(code), 1000 * hot // len(code), _key(code),
                         code[:prefix_length(len(code), percent)].tobytes(), bitmap(code).tobytes()))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
             *[pa.array(c, pa.binary()) for c in cols[3:]]], names=["id", "n", "hot", "key", "prefix", "bits"])


def _prefix_rows(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tokens = [np.frombuffer(p, dtype=np.int64) for p in b.column("prefix").to_pylist()]
        node = np.repeat(b.column("node").to_numpy(zero_copy_only=False), [len(t) for t in tokens])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64)), pa.array(node)],
            names=["token", "node"])


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64-bit words ORed down to ``width`` words."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _close(na, nb, differ, percent: int):
    """Whether sets of these sizes may link when at least ``differ`` tokens are in one alone."""
    size = na + nb
    return size - 2 * (-(-percent * size // (100 + percent))) >= differ


class Tree:
    """Signature tree over classes of one bitmap width.  Level 0 are the leaves."""

    def __init__(self, index: np.ndarray, n: np.ndarray, bits: np.ndarray, comp: np.ndarray):
        by = np.argsort(n, kind="stable")
        self.index, self.n, self.bits = index[by], n[by], bits[by]
        slack = self.n - np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)
        self.levels: list[dict] = []
        cut = np.arange(0, len(self.n), LEAF)
        comp = comp[by]
        one = np.minimum.reduceat(comp, cut) == np.maximum.reduceat(comp, cut)
        level = {"low": np.minimum.reduceat(self.n, cut), "high": np.maximum.reduceat(self.n, cut),
                 "bits": np.bitwise_or.reduceat(self.bits, cut, axis=0), "slack": np.maximum.reduceat(slack, cut),
                 "comp": np.where(one, comp[cut], -1)}
        self.levels.append(level)
        while len(level["low"]) > 1:
            cut = np.arange(0, len(level["low"]), FANOUT)
            one = np.minimum.reduceat(level["comp"], cut) == np.maximum.reduceat(level["comp"], cut)
            level = {"low": np.minimum.reduceat(level["low"], cut), "high": np.maximum.reduceat(level["high"], cut),
                     "bits": np.bitwise_or.reduceat(level["bits"], cut, axis=0),
                     "slack": np.maximum.reduceat(level["slack"], cut),
                     "comp": np.where(one, level["comp"][cut], -1)}
            self.levels.append(level)


def _possible(x: dict, y: dict, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Node pairs that may hold a link between components."""
    same = (x["comp"][i] == y["comp"][j]) & (x["comp"][i] >= 0)
    apart = (100 * x["high"][i] < percent * y["low"][j]) | (100 * y["high"][j] < percent * x["low"][i])
    keep = ~(same | apart)
    i, j = i[keep], j[keep]
    overlap = (np.bitwise_count(x["bits"][i] & y["bits"][j]).sum(axis=1).astype(np.int64)
               + np.minimum(x["slack"][i], y["slack"][j]))
    low = x["low"][i] + y["low"][j]
    keep[keep] = overlap >= -(-percent * low // (100 + percent))
    return keep


def dual(x: Tree, y: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of class pairs (positions in the bucket) that bitmaps and sizes leave possible."""
    top = max(len(x.levels), len(y.levels)) - 1
    i = j = np.zeros(1, dtype=np.int64)
    for level in range(top, -1, -1):
        a, b = x.levels[min(level, len(x.levels) - 1)], y.levels[min(level, len(y.levels) - 1)]
        keep = _possible(a, b, i, j, percent)
        if x is y:
            keep &= i <= j
        i, j = i[keep], j[keep]
        if level:
            ci = _children(i, level, x)
            i, j = ci[1], j[ci[0]]
            cj = _children(j, level, y)
            i, j = i[cj[0]], cj[1]
    for a, b in zip(i.tolist(), j.tolist()):
        u = np.arange(a * LEAF, min((a + 1) * LEAF, len(x.n)))
        v = np.arange(b * LEAF, min((b + 1) * LEAF, len(y.n)))
        differ = np.bitwise_count(x.bits[u][:, None, :] ^ y.bits[v][None, :, :]).sum(axis=2).astype(np.int64)
        ok = _close(x.n[u][:, None], y.n[v][None, :], differ, percent)
        if x is y and a == b:
            ok &= u[:, None] < v[None, :]
        p, q = np.nonzero(ok)
        if len(p):
            yield x.index[u[p]], y.index[v[q]]


def _children(nodes: np.ndarray, level: int, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(which node, child) for the nodes' children one level down; a tree already at its leaves stays."""
    if level >= len(tree.levels):
        return np.arange(len(nodes)), nodes
    child = nodes[:, None] * FANOUT + np.arange(FANOUT)[None, :]
    which = np.repeat(np.arange(len(nodes)), FANOUT)
    child = child.ravel()
    ok = child < len(tree.levels[level - 1]["low"])
    return which[ok], child[ok]


def tree_pairs(n: np.ndarray, bits: list[bytes], comp: np.ndarray, percent: int):
    """Pairs of different components that may link, by trees over each bitmap width
    and between neighbouring widths (sets that link differ in size by less than two)."""
    words = np.array([len(b) // 8 for b in bits])
    by_width = {int(w): np.flatnonzero(words == w) for w in np.unique(words)}
    rows = {w: np.stack([np.frombuffer(bits[i], dtype=np.uint64) for i in at.tolist()]) for w, at in by_width.items()}
    for w, at in by_width.items():
        tree = Tree(at, n[at], rows[w], comp[at])
        yield from dual(tree, tree, percent)
        if 2 * w in by_width:
            up = by_width[2 * w]
            yield from dual(tree, Tree(up, n[up], _fold(rows[2 * w], w), comp[up]), percent)


def _groups(batches) -> Iterator[pa.Table]:
    """Rows sorted by bucket, in tables that hold whole buckets."""
    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now])
        if not now.num_rows:
            continue
        token, part = (now.column(c).to_numpy() for c in ("token", "part"))
        last = np.flatnonzero((token != token[-1]) | (part != part[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield now.slice(0, cut)
        held = now.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _candidates(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Of each bucket, the pairs of different components that may link (kind 0: a, b); where
    these are many, instead the classes that have such a partner (kind 1: a, its component b)."""
    for rows in _groups(batches):
        token, part, node, comp, n = (rows.column(c).to_numpy() for c in ("token", "part", "node", "comp", "n"))
        bits = rows.column("bits").to_pylist()
        cut = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (part[1:] != part[:-1]))))
        size = np.diff(np.append(cut, len(token)))
        group = np.repeat(np.arange(len(cut)), size)
        few = size[group] <= FEW
        pairs = []
        for d in range(1, FEW):
            i = np.flatnonzero(few[:-d] & (group[d:] == group[:-d]) & (comp[d:] != comp[:-d])) if d < len(few) else []
            if len(i):
                pairs.append((i[possible_pairs(n, bits, i, i + d, percent)], d))
        a = np.concatenate([i for i, _ in pairs]) if pairs else np.zeros(0, np.int64)
        b = np.concatenate([i + d for i, d in pairs]) if pairs else np.zeros(0, np.int64)
        out = [(np.zeros(len(a), np.int32), token[a], part[a], node[a], node[b])]
        for g in np.flatnonzero(size > FEW).tolist():
            at = np.arange(cut[g], cut[g] + size[g])
            _, c = np.unique(comp[at], return_inverse=True)
            alive, found, many = np.zeros(len(at), dtype=bool), [], False
            for i, j in tree_pairs(n[at], bits[cut[g]:cut[g] + size[g]], c, percent):
                other = c[i] != c[j]
                alive[i[other]] = alive[j[other]] = True
                if not many:
                    found.append((at[i[other]], at[j[other]]))
                    many = sum(len(x) for x, _ in found) > PER_CLASS * len(at)
            if many:
                at = at[alive]
                out.append((np.ones(len(at), np.int32), token[at], part[at], node[at], comp[at]))
            else:
                out += [(np.zeros(len(i), np.int32), token[i], part[i], node[i], node[j]) for i, j in found]
        cols = [np.concatenate(c) for c in zip(*out)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "token", "part", "a", "b"])


def _span(group: pa.Table, percent: int) -> pa.Table:
    """Links that join components of a bucket, at most one for each class."""
    group = group.sort_by("node")
    node, tokens = group.column("node").to_numpy(), [np.frombuffer(t, np.uint64) for t in group.column("tokens").to_pylist()]
    n = np.array([len(t) for t in tokens], dtype=np.int64)
    _, comp = np.unique(group.column("comp").to_numpy(), return_inverse=True)
    root = np.arange(comp.max() + 1)

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    bits = [bitmap(t).tobytes() for t in tokens]
    for a, b in tree_pairs(n, bits, comp, percent):
        for i, j in zip(a.tolist(), b.tolist()):
            ci, cj = find(comp[i]), find(comp[j])
            if ci != cj and linked(tokens[i], tokens[j], percent):
                root[cj] = ci
                links.append((int(node[i]), int(node[j])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def possible_pairs(n: np.ndarray, bits: list[bytes], a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and bitmaps leave a link of the rows a[i] and b[i] possible."""
    keep = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
    words = np.array([len(x) // 8 for x in bits])
    wa, wb = words[a], words[b]
    for x, y in {p for p, k in zip(zip(wa.tolist(), wb.tolist()), keep.tolist()) if k}:
        for at in np.array_split(np.flatnonzero(keep & (wa == x) & (wb == y)), 1 + int(keep.sum()) * max(x, y) // (1 << 20)):
            if len(at):
                left = np.frombuffer(b"".join([bits[i] for i in a[at].tolist()]), np.uint64).reshape(-1, x)
                right = np.frombuffer(b"".join([bits[i] for i in b[at].tolist()]), np.uint64).reshape(-1, y)
                w = min(x, y)
                differ = np.bitwise_count(_fold(left, w) ^ _fold(right, w)).sum(axis=1).astype(np.int64)
                keep[at] = _close(n[a[at]], n[b[at]], differ, percent)
    return keep


def _prune_pairs(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps leave a link possible."""
    for batch in batches:
        n = np.concatenate([batch.column(c).to_numpy() for c in ("na", "nb")])
        bits = batch.column("bits_a").to_pylist() + batch.column("bits_b").to_pylist()
        rows = np.arange(batch.num_rows)
        keep = possible_pairs(n, bits, rows, rows + batch.num_rows, percent)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
            pa.array(keep, pa.bool_()))


def _verify(batches, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b"))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
            pa.array(keep, pa.bool_()))


class Join:
    """One run over a table with id and text."""

    def __init__(self, docs: DataFrame, k: int, percent: int):
        self.docs, self.k, self.percent = docs, k, percent
        self.scratch = Scratch(docs.sparkSession)
        self.order = self._order()

    def _order(self) -> Order:
        k = self.k
        counted = (self.docs.mapInArrow(lambda it: _count(it, k), COUNTS)
                   .groupBy("kind", "code").agg(F.sum("n").alias("n"))).persist()
        total = counted.where("kind = 0").agg(F.sum("n")).first()[0] or 0
        words = counted.where((F.col("kind") == 1) & (F.col("n") >= max(1, total >> SHARE))).select("code", "n")
        common = counted.where((F.col("kind") == 2) & (F.col("n") >= max(COMMON_LEAST, total >> COMMON))).select("code")
        order = Order(total, [tuple(r) for r in words.collect()], [r[0] for r in common.collect()])
        counted.unpersist()
        return order

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """The documents' (id, n, key), and one row for each distinct set."""
        k, percent, order = self.k, self.percent, self.order
        sketch, path = stored(self.docs.mapInArrow(lambda it: _sketch(it, k, percent, order), SKETCH), "jaccard-sketch")
        found = sketch.where("n > 0").groupBy("key").agg(
            F.min("id").alias("least"), F.first("n").alias("n"), F.first("hot").alias("hot"),
            F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
        # the smallest number leads a bucket: sets made of widely shared shingles come first
        node = F.shiftleft((1000 - F.col("hot")).cast("long"), 53) + F.monotonically_increasing_id()
        members = self.scratch.store(sketch.select("id", "n", "key"), "jaccard-members")
        classes = self.scratch.store(found.withColumn("node", node), "jaccard-classes")
        drop_stored(sketch.sparkSession, path)       # prefixes and bitmaps are with the classes now
        return members, classes

    def sets(self, classes: DataFrame, nodes: DataFrame) -> DataFrame:
        """(node, tokens) of some classes, from the text of a member."""
        k, order = self.k, self.order
        wanted = classes.select("node", "least", "key").join(nodes, "node", "left_semi")
        rows = self.docs.join(wanted, F.col("id") == F.col("least")).select("node", "key", "text")

        def codes(batches):
            for b in batches:
                texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
                out = [(n, got[0].tobytes()) for n, key, got in
                       zip(b.column("node").to_pylist(), b.column("key").to_pylist(), _sets(texts, k, order))
                       if got is not None and _key(got[0]) == key]
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()),
                                                  pa.array([t for _, t in out], pa.binary())], names=["node", "tokens"])

        return self.scratch.store(rows.mapInArrow(codes, NODES).dropDuplicates(["node"]), "jaccard-sets")

    def links(self, classes: DataFrame) -> DataFrame:
        """Links between classes that join everything the full set of links joins."""
        percent = self.percent
        rows = classes.select("node", "prefix").mapInArrow(_prefix_rows, "token long, node long")
        met = rows.groupBy("token").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
        met = met.where("leader < last").select("token", "leader")
        shared = self.scratch.store(rows.join(met, "token"), "jaccard-shared")

        side = classes.select("node", "n", "bits")
        pairs = shared.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        pairs = (pairs.join(side.toDF("a", "na", "bits_a"), "a").join(side.toDF("b", "nb", "bits_b"), "b")
                 .mapInArrow(lambda it: _prune_pairs(it, percent), "a long, b long"))
        pairs = self.scratch.store(pairs, "jaccard-pairs")
        sets = self.sets(classes, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        led = self.scratch.store(self._linked(pairs, sets), "jaccard-links")

        comp = components(led, self.scratch).withColumnRenamed("component", "comp")
        open_rows = shared.select("token", "node").join(comp, "node", "left").select(
            "token", "node", F.coalesce("comp", "node").alias("comp"))
        open_rows = self.scratch.store(open_rows, "jaccard-open")
        several = self._distinct(open_rows, ["token"], F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y")
        buckets = self._parts(open_rows.join(several.select("token", "size"), "token").join(side, "node"))
        found = (buckets.repartition("token", "part").sortWithinPartitions("token", "part")
                 .mapInArrow(lambda it: _candidates(it, percent), "kind int, token long, part long, a long, b long"))
        found = self.scratch.store(found, "jaccard-candidates")
        more = found.where("kind = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        dense = found.where("kind = 1").select("token", "part", F.col("a").alias("node"), F.col("b").alias("comp"))
        dense = dense.join(self._distinct(dense, ["token", "part"]).select("token", "part"), ["token", "part"])
        nodes = more.select(F.explode(F.array("a", "b")).alias("node")).unionByName(dense.select("node")).distinct()
        sets = self.sets(classes, nodes)
        spans = dense.join(sets, "node").groupBy("token", "part").applyInArrow(
            lambda t: _span(t, percent), "a long, b long")
        return self.scratch.store(led.unionByName(self._linked(more, sets)).unionByName(spans).distinct(), "jaccard-links")

    def _linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        percent = self.percent
        return (pairs.join(sets.toDF("a", "tokens_a"), "a").join(sets.toDF("b", "tokens_b"), "b")
                .select("a", "b", "tokens_a", "tokens_b")
                .mapInArrow(lambda it: _verify(it, percent), "a long, b long"))

    @staticmethod
    def _distinct(rows: DataFrame, bucket: list[str], *more) -> DataFrame:
        """One bucket of those with the same classes, told by count and two 64-bit sums; with its size."""
        sums = [F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
        each = rows.groupBy(*bucket).agg(F.count("*").alias("size"), *sums, *more)
        names = [c for c in each.columns if c not in ("size", "s1", "s2", *bucket)]
        one = each.groupBy("size", "s1", "s2").agg(
            F.min(F.struct(*bucket)).alias("one"), *[F.min(c).alias(c) for c in names])
        return one.select("size", *[F.col(f"one.{c}").alias(c) for c in bucket], *names)

    def _parts(self, rows: DataFrame) -> DataFrame:
        """Adds ``part``: 0 for a bucket one task takes.  A larger one is cut by size class
        (a class also visits the next, since linked sizes differ by less than one class),
        each class into blocks, and every pair of its blocks is a part."""
        ratio = math.log(100 / self.percent) if self.percent < 100 else 1e-9
        small = rows.where(F.col("size") <= BUCKET).withColumn("part", F.lit(0).cast("long"))
        large = rows.where(F.col("size") > BUCKET)
        cls = F.floor(F.log(F.col("n").cast("double")) / ratio + 1e-9)
        large = large.withColumn("cls", F.explode(F.array(cls, cls + 1)))
        blocks = F.ceil(F.col("size") / BLOCK)
        mine = F.pmod(F.xxhash64("node"), blocks)
        other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
        large = large.withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", other)
        part = 1 + (F.col("cls") * F.col("blocks") + F.least("mine", "other")) * F.col("blocks") + F.greatest("mine", "other")
        large = large.withColumn("part", part.cast("long"))
        return small.select("token", "part", "node", "comp", "n", "bits").unionByName(
            large.select("token", "part", "node", "comp", "n", "bits"))


def similar_groups(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    join = Join(docs.select(key.alias("id"), F.col(text_col).alias("text")), k, percent)
    members, classes = join.classes()
    comp = components(join.links(classes), join.scratch)
    root = classes.select("key", "node", "least").join(comp, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    first = root.groupBy("component").agg(F.min("least").alias("first"))
    first = root.join(first, "component").select(F.col("key").alias("k"), "first")
    out = members.join(first, F.col("key") == F.col("k"), "left")
    real = lambda c: F.when(c != LAST_ID, c)
    out = join.scratch.store(out.select(
        real(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        real(F.coalesce("first", "id")).alias("component_id")), "jaccard-groups")
    join.scratch.drop(keep=1)
    return out


def keep_first(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, *, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Of each group of linked documents the one with the smallest id, all columns as they are.
    Rows that repeat a kept document (id and text) stay once; documents without an id stay
    unless they are linked to one that has an id."""
    groups = similar_groups(docs, k, percent, id_col=id_col, text_col=text_col)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col("_kept")), "left_semi")
    return rows.dropDuplicates([id_col, text_col])


# DuckDB: distinct shingles, pairs by shared shingles, recursive reachability.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, array_to_string(ws[i:i + least(4, len(ws)) - 1], ' ') AS k
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS i FROM w WHERE len(ws) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION
  SELECT r.doc_id, link.b FROM reach r JOIN link ON r.other = link.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       coalesce(min(reach.other), w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.doc_id = w.doc_id
GROUP BY w.doc_id, n.n
"""
