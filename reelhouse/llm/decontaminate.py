"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores, for each block of documents, the positions of every
training token that some test item uses (other tokens cannot match).  The index
is partitioned by document: each row holds one block's posting lists, so a
search needs no shuffle.  ``search`` takes the test windows to every block:
lists are intersected from the window's rarest term in that block, each list
shifted by the term's offset, until no start is left.  Starts that survive all
terms are exact phrase matches.  With ``slop``, proximity matches too: all terms of
the window in order in one document, with 1 to ``slop`` words more between the first
and the last than in the window; from each place of its first term the match that
ends first counts.

The test set is the stated query set: it goes to all rows in blocks of at most
``QUERY_BYTES`` of text, so what each task receives is bounded.  With more than one
block the documents are stored once with a number for each row, which brings the
findings of all blocks together.

Edge cases: null texts have no words; an item without words has no window; a
shorter item is one window; repeated windows count for each of their items;
a null item_id prints as an empty string, a null doc_id stays null; repeated
documents are judged row by row; empty tables give empty or clean results.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_rows, drop_stored, stored, text_blocks

WINDOW = 10
QUERY_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20

# lower-cases A-Z; every other ASCII character but digits and letters separates words
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                 for c in range(256))

INDEX = "rows array<long>, ids array<long>, counts array<int>, terms binary, ends binary, positions binary"
HITS = "row long, doc_id long, n_words long, hits array<int>, items array<string>"
MATCHES = "doc_id long, item_id long, kind string, first_word long, last_word long"
DIGEST = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class Queries:
    """One block of the test set: its vocabulary, distinct windows and their items."""

    def __init__(self, items: list[tuple], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        found: defaultdict = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text or b"")]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1 if ids else 0):
                found[tuple(ids[k:k + size])].add(item)
        self.windows = sorted(found)
        self.items = [sorted(found[w], key=lambda i: (i is None, i)) for w in self.windows]
        self.table = np.full((len(self.windows), window), len(self.vocabulary), dtype=np.int32)
        for row, w in zip(self.table, self.windows):
            row[:len(w)] = w


def query_blocks(items: DataFrame, window: int, item_col: str, text_col: str) -> Iterator[Queries]:
    """The test set in blocks of at most about QUERY_BYTES, each collected by itself."""
    items = items.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // QUERY_BYTES
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == k) if n > 1 else items
        yield Queries([(r["item"], (r["text"] or "").encode()) for r in part.collect()], window)


def _index_block(texts: list[bytes], vocabulary: dict[bytes, int], gap: int) -> tuple:
    """(words in each text, terms, end of each term's list, positions).  Texts
    lie ``gap`` positions apart, so no window reaches from one to the next."""
    counts, ids, starts, at = [], [], [], 0
    get = vocabulary.get
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        ids += [get(w, -1) for w in words]
        starts.append(at)
        at += len(words) + gap
    counts_a = np.array(counts, dtype=np.int64)
    term = np.array(ids, dtype=np.int32)
    shift = np.array(starts, dtype=np.int64) - (np.cumsum(counts_a) - counts_a)
    place = np.arange(len(term), dtype=np.int64) + np.repeat(shift, counts_a)
    known = np.flatnonzero(term >= 0)
    order = known[np.argsort(term[known], kind="stable")]
    terms, first = np.unique(term[order], return_index=True)
    return counts_a, terms, np.append(first[1:], len(order)).astype(np.int64), place[order].astype(np.int32)


class Block:
    """Posting lists of one block of documents."""

    def __init__(self, counts, terms, ends, positions, gap: int):
        self.counts, self.positions, self.gap = counts, positions, gap
        self.first = np.cumsum(counts + gap) - (counts + gap)      # position of each text's first word
        self.size = int((counts + gap).sum())
        self.span = {int(t): (int(b), int(e)) for t, b, e in
                     zip(terms, np.concatenate(([0], ends[:-1])) if len(ends) else [], ends)}

    def postings(self, term: int) -> np.ndarray:
        b, e = self.span.get(term, (0, 0))
        return self.positions[b:e]

    def frequencies(self, n_terms: int) -> np.ndarray:
        out = np.zeros(n_terms + 1, dtype=np.int64)
        for t, (b, e) in self.span.items():
            out[t] = e - b
        out[n_terms] = self.size + 1                               # padding of short windows
        return out

    def phrases(self, q: Queries) -> Iterator[tuple[int, np.ndarray]]:
        """(window, starts) of every exact match."""
        if not len(q.windows):
            return
        often = self.frequencies(len(q.vocabulary))[q.table]
        order = np.argsort(often, axis=1, kind="stable")           # rarest term first
        for k in np.flatnonzero(often.min(axis=1) > 0).tolist():
            window, starts = q.windows[k], None
            for offset in order[k].tolist():
                if offset >= len(window):
                    continue
                found = self.postings(window[offset]) - offset
                if starts is None:
                    starts = found
                else:
                    at = np.searchsorted(found, starts)
                    at[at == len(found)] = 0
                    starts = starts[found[at] == starts]
                if not len(starts):
                    break
            else:
                yield k, starts

    def near(self, q: Queries, slop: int) -> Iterator[tuple[int, int, int]]:
        """(window, first, last position) where its terms lie in order, with 1 to ``slop`` words
        more between the first and the last than in the window."""
        if not len(q.windows):
            return
        often = self.frequencies(len(q.vocabulary))[q.table]
        order = np.argsort(often, axis=1, kind="stable")
        for k in np.flatnonzero(often.min(axis=1) > 0).tolist():
            window = q.windows[k]
            width = len(window) - 1
            begin = self.postings(window[0])
            for o in order[k].tolist():                            # rarest first: every term within reach
                if 0 < o <= width and len(begin):
                    found = np.append(self.postings(window[o]), np.iinfo(np.int64).max)
                    begin = begin[found[np.searchsorted(found, begin + o)] <= begin + o + slop]
            end = begin
            for term in window[1:]:                                # then in order, each as early as it can be
                found = self.postings(term)
                at = np.searchsorted(found, end, side="right")
                ok = at < len(found)
                begin, end = begin[ok], found[at[ok]]
            ok = (end - begin > width) & (end - begin <= width + slop)
            begin, end = begin[ok], end[ok]
            ok = np.searchsorted(self.first, begin, side="right") == np.searchsorted(self.first, end, side="right")
            for b, e in zip(begin[ok].tolist(), end[ok].tolist()):
                yield k, b, e


def build_index(docs: DataFrame, queries: Queries, *, id_col: str = "doc_id",
                text_col: str = "text", row_col: str | None = None) -> tuple[DataFrame, str]:
    """The stored index of ``docs`` for the vocabulary of ``queries``, and its folder.  ``row_col``
    numbers the rows, where the findings of several indexes are to be brought together."""
    vocabulary, gap = queries.vocabulary, queries.window
    row = F.col(row_col) if row_col else F.lit(None).cast("long")
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), row.alias("row")).alias("key"),
                       F.col(text_col).alias("text"))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_blocks(batches, "key", "text", BLOCK_BYTES):
            counts, terms, ends, positions = _index_block(texts, vocabulary, gap)
            yield pa.RecordBatch.from_arrays(
                [pa.array([[k["row"] for k in keys]], pa.list_(pa.int64())), pa.array([[k["id"] for k in keys]], pa.list_(pa.int64())),
                 pa.array([counts.tolist()], pa.list_(pa.int32())),
                 pa.array([terms.tobytes()], pa.binary()), pa.array([ends.tobytes()], pa.binary()),
                 pa.array([positions.tobytes()], pa.binary())],
                names=["rows", "ids", "counts", "terms", "ends", "positions"])

    return stored(rows.mapInArrow(index, INDEX), "positional-index")


def _blocks(batches: Iterable[pa.RecordBatch], gap: int) -> Iterator[tuple[list, list, Block]]:
    for batch in batches:
        for row in range(batch.num_rows):
            rows, ids, counts, terms, ends, positions = (batch.column(k)[row].as_py() for k in range(6))
            yield rows, ids, Block(np.array(counts, dtype=np.int64), np.frombuffer(terms, dtype=np.int32),
                             np.frombuffer(ends, dtype=np.int64), np.frombuffer(positions, dtype=np.int32), gap)


def search(index: DataFrame, queries: Queries, slop: int = 0) -> DataFrame:
    """doc_id, item_id, kind ('exact' or 'near'), first_word, last_word: word
    numbers count from 0 in the document.  One row for each item of a window."""

    def run(batches):
        for _, ids, block in _blocks(batches, queries.window):
            rows = []
            found = [(k, int(s), int(s) + len(queries.windows[k]) - 1, "exact")
                     for k, starts in block.phrases(queries) for s in starts]
            if slop:
                found += [(k, b, e, "near") for k, b, e in block.near(queries, slop)]
            for k, b, e, kind in found:
                doc = int(np.searchsorted(block.first, b, side="right")) - 1
                rows += [(ids[doc], item, kind, b - int(block.first[doc]), e - int(block.first[doc]))
                         for item in queries.items[k]]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["doc_id", "item_id", "kind", "first_word", "last_word"])

    return index.mapInArrow(run, MATCHES)


def _hits_of(block: Block, queries: Queries) -> tuple[dict[int, set], dict[int, np.ndarray]]:
    """For each text with a match: its item ids as strings, and its hit words."""
    cover = np.zeros(block.size + 1, dtype=np.int32)
    items: defaultdict = defaultdict(set)
    for k, starts in block.phrases(queries):
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + len(queries.windows[k]), -1)
        names = ["" if i is None else str(i) for i in queries.items[k]]
        for doc in np.unique(np.searchsorted(block.first, starts, side="right") - 1).tolist():
            items[doc].update(names)
    hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0) if items else np.zeros(0, dtype=np.int64)
    hits = {doc: hit[(hit >= block.first[doc]) & (hit < block.first[doc] + block.counts[doc])] - block.first[doc]
            for doc in items}
    return items, hits


def _hits(index: DataFrame, queries: Queries) -> DataFrame:
    """One row per document: its hit word numbers and item ids."""

    def run(batches):
        for rows, ids, block in _blocks(batches, queries.window):
            items, hits = _hits_of(block, queries)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(block.counts, pa.int64()),
                 pa.array([hits[d].tolist() if d in hits else [] for d in range(len(ids))], pa.list_(pa.int32())),
                 pa.array([sorted(items[d]) if d in items else [] for d in range(len(ids))], pa.list_(pa.string()))],
                names=["row", "doc_id", "n_words", "hits", "items"])

    return index.mapInArrow(run, HITS)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    blocks, parts, row = query_blocks(items, window, "item_id", "text"), [], None
    queries, more = next(blocks), next(blocks, None)
    if more is not None:
        docs, _ = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                     F.monotonically_increasing_id().alias("row")), "numbered-documents")
        row = "row"
    while queries is not None:
        index, _ = build_index(docs, queries, row_col=row)
        parts.append(_hits(index, queries))
        queries, more = more, next(blocks, None)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if len(parts) > 1:
        found = found.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, *, text_col: str = "text") -> DataFrame:
    """The documents without any hit word, all columns as they are."""
    for queries in query_blocks(items, window, "item_id", "text"):
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                           F.col(text_col).alias("text"))

        def clean(batches, queries=queries):
            for b in batches:
                texts = [t or b"" for t in binary_rows(b, "text")]
                keep, size, begin = [], 0, 0
                for k, t in enumerate(texts):
                    size += len(t)
                    if size >= BLOCK_BYTES or k == len(texts) - 1:
                        block = Block(*_index_block(texts[begin:k + 1], queries.vocabulary, queries.window),
                                      queries.window)
                        items_of, _ = _hits_of(block, queries)
                        keep += [d not in items_of for d in range(k + 1 - begin)]
                        size, begin = 0, k + 1
                yield pa.RecordBatch.from_arrays([b.column("row")], names=["row"]).filter(pa.array(keep, pa.bool_()))

        schema = T.StructType([rows.schema["row"]])
        docs = rows.mapInArrow(clean, schema).select(*[F.col(f"row.`{c}`") for c in docs.columns])
    return docs


def drop_index(docs: DataFrame, path: str) -> None:
    drop_stored(docs.sparkSession, path)


SQL = r"""
WITH item AS (
  SELECT DISTINCT item_id, ws FROM (
    SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
q AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(ws[s:s + least(10, len(ws)) - 1], ' ') AS k
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s FROM item)),
d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
win AS (
  SELECT doc_id, s, size, array_to_string(ws[s:s + size - 1], ' ') AS k
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS s
        FROM d, (SELECT DISTINCT size FROM q) WHERE len(ws) >= size)),
hit AS (
  SELECT win.doc_id, win.s, win.size, q.item_id FROM win JOIN q USING (size, k)),
words AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
