"""Substring deduplication by super-k-mer partitioning.

A window is ``window`` consecutive words.  Its minimiser is the smallest hash of
its ``minimiser`` consecutive words; consecutive windows that share one form a
super-k-mer, which travels as one packed string to the bucket of that minimiser.
Equal windows have equal minimisers, so each bucket holds every copy of its
windows; it sorts them and finds the first start of each.  Only the runs of
*first* windows return to the documents (copies return nothing, so a group of
copies costs its representatives alone); all other windows are repeats.

Steps
  1. count minimisers; those with many super-k-mers are hot (a bounded list).  A task
     leaves out counts under ``1 / (4 HOT_SHARE)`` of its own, so a count misses less
     than that share of all and no hot one is overlooked.  Minimisers are counted by 32
     bits of their hash: one that shares them with a hot one is hot as well, which only
     changes how its windows travel;
  2. pack: a block of documents sends one compressed string list to each bucket,
     identical super-k-mers of the block once, with their earliest start.
     Windows of a hot minimiser travel singly, each to the bucket of its own
     content, so no bucket grows with a passage that many documents share;
  3. each bucket numbers its words, sorts window hashes and compares the words
     of equal hashes;
  4. runs join their documents, which drop the words no first window explains.

Edge cases: a null or blank text has no words; fewer words than a window means
no window; rows with a null doc_id are documents of their own, after all others, in
the order they are read; rows that repeat a doc_id are one document position by position, so exact repeats get equal results; an empty
table gives an empty result; other columns are ignored (``deduplicate_text``
keeps them).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, mix, sliding_min, stored, text_blocks, window_hash

WINDOW = 20
MINIMISER = 3
BUCKET_BYTES = 16 << 20       # packed text per bucket, before compression
HOT_SHARE = 1 << 17           # a hot minimiser has at least 1/HOT_SHARE of all super-k-mers
HOT_LEAST = 256
SEGMENT = 1 << 21             # super-k-mers a task counts together
NULL_IDS = 1 << 62            # rows without doc_id are numbered from here
RUN_BITS = 16

COUNTS = "cell long, n long"
CELL = np.uint64(0xFFFFFFFF)
TOTAL, SIZE = -1, -2          # cells of the number of super-k-mers and of the bytes of words
PACKED = "bucket long, packed binary, places binary"
RUNS = "id long, run long"
DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _super_kmers(words: Words, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, first word within the block, windows, minimiser) of each super-k-mer."""
    total = len(words.starts)
    if total < window:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, np.zeros(0, dtype=np.uint64)
    low = sliding_min(mix(window_hash(words.hashes(), m)), window - m + 1)
    per_doc = np.maximum(words.counts - window + 1, 0)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc) + words.doc_first[doc]
    key = low[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    return doc[first], at[first], np.diff(np.append(first, len(at))), key[first]


def _count(batches: Iterable[pa.RecordBatch], window: int, m: int) -> Iterator[pa.RecordBatch]:
    def counts(keys: list[np.ndarray], total: int, size: int) -> pa.RecordBatch:
        cell, n = np.unique(np.concatenate(keys), return_counts=True)
        many = n > total // (4 * HOT_SHARE)
        return pa.RecordBatch.from_arrays([
            pa.array(np.append(cell[many].astype(np.int64), [TOTAL, SIZE]), pa.int64()),
            pa.array(np.append(n[many], [total, size]), pa.int64())], names=["cell", "n"])

    keys, total, size = [], 0, 0
    for _, texts in text_blocks(batches, "id", "text"):
        words = Words(texts)
        *_, key = _super_kmers(words, window, m)
        keys.append((key & CELL).astype(np.uint32))
        total, size = total + len(key), size + len(words.data)
        if total >= SEGMENT:
            yield counts(keys, total, size)
            keys, total, size = [], 0, 0
    if keys:
        yield counts(keys, total, size)


def _pack(batches: Iterable[pa.RecordBatch], window: int, m: int, buckets: int,
          hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_blocks(batches, "id", "text"):
        words = Words(texts)
        doc, at, n, key = _super_kmers(words, window, m)
        single = np.isin(key & CELL, hot) if len(hot) else np.zeros(len(key), dtype=bool)
        if single.any():            # one window each, spread by its own content
            reps = n[single]
            step = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            one = np.repeat(at[single], reps) + step
            doc = np.concatenate((doc[~single], np.repeat(doc[single], reps)))
            at = np.concatenate((at[~single], one))
            n = np.concatenate((n[~single], np.ones(len(one), dtype=np.int64)))
            key = np.concatenate((key[~single], mix(window_hash(words.hashes(), window)[one])))
        if not len(at):
            continue
        id_of = np.array(ids, dtype=np.int64)[doc]
        start = at - words.doc_first[doc]
        order = np.lexsort((start, id_of))       # earliest first: the first of equal strings stays
        begin, end = words.starts[at], words.ends[at + n + window - 2]
        data, seen, keep, strings = words.data, set(), [], []
        for k, b, e in zip(order.tolist(), begin[order].tolist(), end[order].tolist()):
            s = data[b:e]
            if s not in seen:
                seen.add(s)
                keep.append(k)
                strings.append(s)
        keep = np.array(keep)
        bucket = (key[keep] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[by])) + 1
        pack = zstandard.ZstdCompressor(level=3)
        rows: tuple[list, list, list] = ([], [], [])
        for part in np.split(by, cut):
            k = keep[part]
            places = np.stack((id_of[k], start[k], n[k])).astype(np.int64)
            rows[0].append(int(bucket[part[0]]))
            rows[1].append(pack.compress(b"\n".join([strings[i] for i in part.tolist()])))
            rows[2].append(pack.compress(places.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())],
            names=["bucket", "packed", "places"])


def _first_windows(token: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Whether each window (starts ``at`` in ``token``, earliest first) is the first of its words."""
    hashes = window_hash(mix(token.astype(np.uint64) + np.uint64(1)), window)[at]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    equal = np.ones(len(a), dtype=bool)
    for k in range(window):
        equal &= token[a + k] == token[b + k]
    first = np.ones(len(at), dtype=bool)
    first[order[1:][same]] = False
    if not equal.all():             # different windows of one hash: compare those by their words
        bad = np.isin(hashes, hashes[order[1:][same][~equal]])
        seen: set[tuple] = set()
        for i in np.flatnonzero(bad).tolist():
            words = tuple(token[at[i]:at[i] + window].tolist())
            first[i] = words not in seen
            seen.add(words)
    return first


def _resolve(group: pa.Table, window: int) -> pa.Table:
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    unpack = zstandard.ZstdDecompressor()
    tokens, places = [], []
    for row in range(group.num_rows):
        words = unpack.decompress(group.column("packed")[row].as_py()).split()
        tokens.append(np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words)))
        places.append(np.frombuffer(unpack.decompress(group.column("places")[row].as_py()),
                                    dtype=np.int64).reshape(3, -1))
    token, (doc, start, n) = np.concatenate(tokens), np.concatenate(places, axis=1)
    base = np.cumsum(n + window - 1) - (n + window - 1)
    order = np.lexsort((start, doc))
    doc, start, n, base = doc[order], start[order], n[order], base[order]
    seg = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    first = _first_windows(token, base[seg] + step, window)
    top = (1 << RUN_BITS) - 1
    begin = first & ~(np.concatenate(([False], first[:-1])) & (step % top != 0))
    runs = np.flatnonzero(begin)
    length = np.add.reduceat(first.astype(np.int64), runs) if len(runs) else runs
    s = seg[runs]
    return pa.table({"id": pa.array(doc[s], pa.int64()),
                     "run": pa.array(((start[s] + step[runs]) << RUN_BITS) | length, pa.int64())})


def kept_words(words: list[bytes], runs: list[int] | None, window: int) -> list[bytes]:
    """The words that no repeated window covers; ``runs`` are the document's first windows."""
    windows = len(words) - window + 1
    if windows <= 0:
        return words
    code = np.array(runs or [], dtype=np.int64)
    begin, length = code >> RUN_BITS, code & ((1 << RUN_BITS) - 1)
    edge = np.zeros(windows + 1, dtype=np.int64)
    inside = begin < windows         # rows that repeat a doc_id may be shorter
    np.add.at(edge, begin[inside], 1)
    np.add.at(edge, np.minimum(begin + length, windows)[inside], -1)
    repeated = np.flatnonzero(np.cumsum(edge[:-1]) <= 0)
    if not len(repeated):
        return words
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + window, -1)
    keep = np.cumsum(cover[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def first_runs(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """(id, run): the runs of windows no earlier start repeats; ``docs`` has id and text."""
    spark = docs.sparkSession
    counted = docs.mapInArrow(lambda it: _count(it, window, minimiser), COUNTS).groupBy("cell").agg(F.sum("n").alias("n"))
    counted = counted.where((F.col("cell") < 0) | (F.col("n") >= HOT_LEAST - HOT_LEAST // 4)).persist()
    whole = {r["cell"]: r["n"] for r in counted.where("cell < 0").collect()}       # two rows
    total, size = whole.get(TOTAL, 0), whole.get(SIZE, 0)
    # what the tasks left out of a count is less than total // (4 * HOT_SHARE)
    least = max(HOT_LEAST, total // HOT_SHARE) - total // (4 * HOT_SHARE)
    hot = counted.where((F.col("cell") >= 0) & (F.col("n") >= least)).select("cell").collect()
    counted.unpersist()
    hot = np.sort(np.array([r[0] for r in hot], dtype=np.uint64))
    # a super-k-mer repeats window - 1 words for (window - minimiser + 2) / 2 windows on average
    grown = 1 + 2 * (window - 1) / (window - minimiser + 2)
    buckets = max(1, int(size * grown / BUCKET_BYTES))
    packed = docs.mapInArrow(lambda it: _pack(it, window, minimiser, buckets, hot), PACKED)
    return packed.groupBy("bucket").applyInArrow(lambda t: _resolve(t, window), RUNS)


def _with_runs(docs: DataFrame, id_col: str, text_col: str, window: int, minimiser: int) -> DataFrame:
    """(row, id, text, runs) with ``row`` the untouched input row."""
    whole, key = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long")
    text = F.col(f"`{text_col}`").alias("text")
    nameless = docs.where(key.isNull()).select(whole, (F.monotonically_increasing_id() + NULL_IDS).alias("id"), text)
    rows = docs.where(key.isNotNull()).select(whole, key.alias("id"), text)
    rows = rows.unionByName(stored(nameless, "rows-without-id")[0])
    runs = (first_runs(rows.select("id", "text"), window, minimiser)
            .groupBy("id").agg(F.collect_list("run").alias("runs")).withColumnRenamed("id", "of"))
    return rows.join(runs, rows["id"] == runs["of"], "left").drop("of")


def dedup_digest(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, *,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    marked = _with_runs(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                        "doc_id", "text", window, minimiser)

    def digest(batches):
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for text, runs in zip(b.column("text").cast(pa.binary()), b.column("runs")):
                words = (text.as_py() or b"").split()
                kept = kept_words(words, runs.as_py(), window)
                out[0].append(len(words))
                out[1].append(len(words) - len(kept))
                out[2].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return marked.select("row.doc_id", "text", "runs").mapInArrow(digest, DIGEST)


def deduplicate_text(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, *,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated words cut from ``text_col``.  Rows that lose
    nothing keep their text as it is; others hold the kept words, single-spaced."""
    marked = _with_runs(docs, id_col, text_col, window, minimiser)

    def cut(batches):
        for b in batches:
            out = []
            for text, runs in zip(b.column("text"), b.column("runs")):
                text = text.as_py()
                words = (text or "").encode().split()
                kept = kept_words(words, runs.as_py(), window)
                out.append(text if len(kept) == len(words) else b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.string())], names=["row", "kept"])

    schema = T.StructType([marked.schema["row"], T.StructField("kept", T.StringType())])
    done = marked.select("row", "text", "runs").mapInArrow(cut, schema)
    return done.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


# DuckDB: every window of every document, the first start of each, uncovered words.
SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)),
rep AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM rep)),
tok AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT t.doc_id, count(*) AS n, string_agg(t.word, ' ' ORDER BY t.p) AS s
  FROM tok t ANTI JOIN gone g ON t.doc_id = g.doc_id AND t.p = g.p GROUP BY t.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
