"""Phrase collocations by three-way sorting of suffix pointers.

Texts are cut into pieces and words; a suffix is the words from one word on, to
the end of its piece or ``DEPTH`` words.  Everything is per language.

1. *Words* are counted (combined in each task), and so are all pairs of
   neighbours by the hash of their partition, (language, two leading words).  A
   partition with fewer than ``LEAST`` occurrences is abandoned before its suffixes
   move, and a pair of that kind ends every suffix it is in, as no candidate holds
   it.  Tasks know what is left by bitmaps of ``BITMAP_MOST`` bits at most; these may
   keep a rare pair but never lose a frequent one.
2. *Blocks.*  The suffixes of a few MB of text are sorted; equal ones are one row
   with their count, so a phrase of any frequency is one row a block.
3. *Routing.*  Suffixes go to slots of the hash of their two leading words.  A slot
   with more than ``SLOT_MOST`` rows sends them on by three, four, then five words,
   and receives their first two words alone, as rows of a block; a long slot is
   found by counting all rows of all blocks.
4. *Sorting.*  A slot sorts its pointers by multikey three-way quicksort: a
   partition is split by a pivot word into smaller, equal and larger; the equal
   part goes one word deeper, down to ``DEPTH``, and its size is the count of the
   phrase.  Partitions with fewer than ``LEAST`` occurrences are abandoned.
5. *Scores.*  Each cut of a candidate meets the counts of its two parts; the lowest
   score counts.  Products are decimals of 38 digits.

Edge cases: a null text is empty; a null language is ``und``; texts of separators
only have no words; repeated rows count each; an empty table gives an empty
result; a null doc_id and other columns are ignored; ties are broken by the
phrase, so the result does not depend on partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE, Scratch, binary_rows, mix

DEPTH = 5
LEAST = 100                       # occurrences of a candidate
TOP = 2000                        # rows reported for each language
BLOCK_BYTES = 8 << 20
SLOT_ROWS = 1 << 19               # rows a slot has on average
SLOT_MOST = 1 << 21               # rows of a slot that one task sorts
MOST_SLOTS = 1 << 24
BITMAP_MOST = 1 << 27
RANGE = 1 << 17                   # hash places one task adds up at a time
PAIRS_AT_ONCE = 1 << 23           # pairs whose counts a task adds up before it sends them
SALTS = 64

# a piece ends at each of these; a full stop stands for them all
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
TO_PIECES = bytes.maketrans(SEPARATORS + b"\t", b"." * len(SEPARATORS) + b" ")

PAIRS = "part int, data binary"
FREQUENT = "part int, bits binary, n long"
WORDS = "lang string, word string, n long, hash long"
BLOCKS = "lang string, level int, slot long, n long, rows binary"
SENT = "lang string, level int, slot long, rows binary"
PHRASES = "lang string, phrase string, size int, f long"
UNKNOWN = "und"


class Lexicon:
    """The words of a block by number; 0 ends a piece."""

    def __init__(self, texts: list[bytes]):
        known: dict[bytes, int] = {b".": 0}
        data = b" . ".join(texts).lower().translate(TO_PIECES).replace(b".", b" . ")
        self.ids = np.array([known.setdefault(w, len(known)) for w in data.split()], dtype=np.int32)
        self.words = list(known)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), dtype=np.uint64, count=len(self.words))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Blocks of texts of one language."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), binary_rows(b, "text")):
            held.setdefault(lang, []).append(text or b"")
            size[lang] = size.get(lang, 0) + len(text or b"")
            if size[lang] >= BLOCK_BYTES:
                yield lang, held.pop(lang)
                size[lang] = 0
            elif sum(size.values()) >= 4 * BLOCK_BYTES:      # many languages: the largest goes
                largest = max(size, key=size.get)
                yield largest, held.pop(largest)
                size[largest] = 0
    yield from held.items()


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _texts(batches):
        block = Lexicon(texts)
        n = np.bincount(block.ids, minlength=len(block.words))[1:]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(n), pa.string()), pa.array(block.words[1:], pa.binary()).cast(pa.string(), safe=False),
            pa.array(n), pa.array(block.hashes[1:].view(np.int64))], names=["lang", "word", "n", "hash"])


def _lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def suffixes(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct suffixes of two words or more in sorted order, their counts); rows are word numbers, 0 after the end.

    ``linked``: whether a word and the next one are a pair that candidates may hold."""
    at = np.flatnonzero(linked)
    if not len(at):
        return np.zeros((0, DEPTH), dtype=np.int32), np.zeros(0, dtype=np.int64)
    ids, linked = (np.concatenate((x, np.zeros(DEPTH, dtype=x.dtype))) for x in (ids, linked))
    rows = np.zeros((len(at), DEPTH), dtype=np.int32)
    rows[:, 0] = ids[at]
    goes_on = np.ones(len(at), dtype=bool)
    for k in range(1, DEPTH):
        goes_on &= linked[at + k - 1]
        rows[:, k] = np.where(goes_on, ids[at + k], 0)
    keys = [rows[:, k].astype(np.int64) for k in range(DEPTH)]
    if rows.max() < 1 << 21:                                    # several words fit one key
        keys = [keys[0] << 32 | keys[1], keys[2] << 42 | keys[3] << 21 | keys[4]]
    rows = rows[np.lexsort(keys[::-1])]
    begin = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1))))
    return rows[begin], np.diff(np.append(begin, len(rows)))


def slots(rows: np.ndarray, hashes: np.ndarray, lang: str, level: int, count: int) -> np.ndarray:
    """The slot of each suffix by its first ``level`` words."""
    with np.errstate(over="ignore"):
        h = np.full(len(rows), _lang_seed(lang) + np.uint64(level), dtype=np.uint64)
        for k in range(level):
            h = mix(h * BASE + hashes[rows[:, k]])
    return (h >> np.uint64(20)).astype(np.int64) % count


def _has(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


def _pair_places(block: Lexicon, lang: str, at: np.ndarray, places: int) -> np.ndarray:
    """Of the pairs that start ``at`` these words."""
    return slots(np.stack((block.ids[at], block.ids[at + 1]), axis=1), block.hashes, lang, 2, places)


def _count_pairs(batches: Iterable[pa.RecordBatch], words: np.ndarray, places: int) -> Iterator[pa.RecordBatch]:
    """How often each place of the hash space is met, a row for each range of places."""
    held: list[np.ndarray] = []

    def sent() -> pa.RecordBatch:
        place, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        part = place // RANGE
        begin = np.flatnonzero(np.diff(part, prepend=-1))
        data = []
        for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(part)]):
            gaps = np.diff(place[i:j], prepend=part[i] * RANGE)
            kinds = [np.min_scalar_type(int(x.max())) for x in (gaps, n[i:j])]
            head = np.array([j - i, kinds[0].itemsize, kinds[1].itemsize], dtype=np.int64).tobytes()
            data.append(zstandard.compress(head + gaps.astype(kinds[0]).tobytes() + n[i:j].astype(kinds[1]).tobytes(), 1))
        return pa.RecordBatch.from_arrays([pa.array(part[begin].astype(np.int32)), pa.array(data, pa.binary())], names=["part", "data"])

    for lang, texts in _texts(batches):
        block = Lexicon(texts)
        frequent = _has(words, (block.hashes % np.uint64(8 * len(words))).astype(np.int64))
        frequent[0] = False
        known = frequent[block.ids]
        held.append(_pair_places(block, lang, np.flatnonzero(known[:-1] & known[1:]), places))
        if sum(map(len, held)) >= PAIRS_AT_ONCE:
            yield sent()
    if sum(map(len, held)):
        yield sent()


def _frequent_pairs(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """A bitmap of each range and the occurrences of what it keeps; the rows arrive sorted by range."""
    part, total = None, np.zeros(RANGE, dtype=np.int64)

    def done() -> pa.RecordBatch:
        kept = total >= least
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bits": [np.packbits(kept, bitorder="little").tobytes()],
                                           "n": [int(total[kept].sum())]})

    for b in batches:
        for own, data in zip(b.column("part").to_pylist(), b.column("data").to_pylist()):
            if own != part:
                if part is not None:
                    yield done()
                part = own
                total[:] = 0
            data = zstandard.decompress(data)
            size, gap, deep = np.frombuffer(data, dtype=np.int64, count=3).tolist()
            place = np.cumsum(np.frombuffer(data, dtype=f"u{gap}", count=size, offset=24).astype(np.int64))
            total[place] += np.frombuffer(data, dtype=f"u{deep}", count=size, offset=24 + size * gap).astype(np.int64)
    if part is not None:
        yield done()


def _pack(rows: np.ndarray, n: np.ndarray, words: list[bytes]) -> bytes:
    """Suffixes with the words they use: sizes, the words, then rows and counts in the narrowest types."""
    used, codes = np.unique(rows, return_inverse=True)
    text = b" ".join(words[i] for i in used.tolist())
    kinds = [np.min_scalar_type(max(len(used), 1)), np.min_scalar_type(int(n.max(initial=1)))]
    head = np.array([len(rows), len(text), kinds[0].itemsize, kinds[1].itemsize], dtype=np.int64).tobytes()
    body = codes.reshape(rows.shape).T.astype(kinds[0]).tobytes() + n.astype(kinds[1]).tobytes()
    return zstandard.compress(head + text + body, 1)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(rows, counts, words); rows are numbers of the words."""
    data = zstandard.decompress(data)
    size, text, wide, deep = np.frombuffer(data, dtype=np.int64, count=4).tolist()
    at = 32 + text
    codes = np.frombuffer(data, dtype=f"u{wide}", count=size * DEPTH, offset=at).reshape(DEPTH, size).T
    n = np.frombuffer(data, dtype=f"u{deep}", count=size, offset=at + size * DEPTH * wide)
    return codes.astype(np.int32), n.astype(np.int64), data[32:at].split(b" ")


def _sort_blocks(batches: Iterable[pa.RecordBatch], bitmap: np.ndarray, count: int) -> Iterator[pa.RecordBatch]:
    """A row for each block with its distinct suffixes (level 0), and how many rows each slot gets at each level."""
    for lang, texts in _texts(batches):
        block = Lexicon(texts)
        at = np.flatnonzero((block.ids[:-1] > 0) & (block.ids[1:] > 0))
        linked = np.zeros(len(block.ids), dtype=bool)
        linked[at[_has(bitmap, _pair_places(block, lang, at, 8 * len(bitmap)))]] = True
        rows, n = suffixes(block.ids, linked)
        if not len(rows):
            continue
        words = [b"", *block.words[1:]]
        levels, slot, sums = [0], [0], [len(rows)]
        for level in range(2, DEPTH):
            s, c = np.unique(slots(rows[rows[:, level - 1] > 0], block.hashes, lang, level, count), return_counts=True)
            levels += [level] * len(s)
            slot += s.tolist()
            sums += c.tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(slot), pa.string()), pa.array(levels, pa.int32()), pa.array(slot, pa.int64()),
            pa.array(sums, pa.int64()), pa.array([_pack(rows, n, words), *[None] * (len(slot) - 1)], pa.binary())],
            names=["lang", "level", "slot", "n", "rows"])


def _route(batches: Iterable[pa.RecordBatch], long: dict[tuple[str, int], np.ndarray], count: int) -> Iterator[pa.RecordBatch]:
    """Each block's suffixes by slot."""
    none = np.zeros(0, dtype=np.int64)
    for b in batches:
        for lang, data in zip(b.column("lang").to_pylist(), b.column("rows").to_pylist()):
            rows, n, words = _unpack(data)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w or b".") for w in words), dtype=np.uint64, count=len(words))
            zero = words.index(b"") if b"" in words else -1     # the end sorts first, as number 0
            levels, numbers, parts = [], [], []
            for level in range(2, DEPTH + 1):
                rows, n = (x[rows[:, level - 1] != zero] for x in (rows, n)) if len(rows) else (rows, n)
                slot = slots(rows, hashes, lang, level, count)
                on = np.isin(slot, long.get((lang, level), none))
                for mine, cut in ((~on, DEPTH), (on, level)):
                    if not mine.any():
                        continue
                    own, own_n, own_slot = rows[mine], n[mine], slot[mine]
                    if cut < DEPTH:                             # first words alone: equal ones are neighbours
                        begin = np.flatnonzero(np.concatenate(([True], (own[1:, :cut] != own[:-1, :cut]).any(axis=1))))
                        own, own_slot, own_n = own[begin].copy(), own_slot[begin], np.add.reduceat(own_n, begin)
                        if zero < 0:
                            words, zero, hashes = [*words, b""], len(words), np.append(hashes, np.uint64(0))
                        own[:, cut:] = zero
                    order = np.argsort(own_slot, kind="stable")
                    begin = np.flatnonzero(np.diff(own_slot[order], prepend=-1))
                    for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(order)]):
                        levels.append(level)
                        numbers.append(int(own_slot[order[i]]))
                        parts.append(_pack(own[order[i:j]], own_n[order[i:j]], words))
                rows, n = rows[on], n[on]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(levels), pa.string()), pa.array(levels, pa.int32()), pa.array(numbers, pa.int64()),
                pa.array(parts, pa.binary())], names=["lang", "level", "slot", "rows"])


def quicksort(keys: np.ndarray, n: np.ndarray, first: int, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
    """(a pointer, depth, count) of each phrase of ``first`` words or more that occurs ``least`` times.

    ``keys`` has the words of each suffix as numbers, 0 after its end; ``n`` its occurrences."""
    columns = [np.ascontiguousarray(keys[:, depth]) for depth in range(DEPTH)]
    todo = [(np.arange(len(keys)), 0)]
    while todo:
        at, depth = todo.pop()
        if n[at].sum() < least:
            continue
        key = columns[depth][at]
        pivot = key[len(key) // 2]
        less, more = key < pivot, key > pivot
        equal = at[~(less | more)] if less.any() or more.any() else at
        for side in (less, more):
            if side.any():
                todo.append((at[side], depth))
        if pivot == 0:
            continue                                            # suffixes that end here
        size = int(n[equal].sum())
        if size < least:
            continue
        if depth + 1 >= first:
            yield int(equal[0]), depth + 1, size
        if depth + 1 < DEPTH:
            todo.append((equal, depth + 1))


def _sort_slot(key: tuple, rows: pa.Table, least: int) -> pa.Table:
    lang, level, _ = (k.as_py() for k in key)
    known: dict[bytes, int] = {b"": 0}
    keys, counts = [], []
    for data in rows.column("rows").to_pylist():
        codes, n, words = _unpack(data)
        number = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int32)
        keys.append(number[codes])
        counts.append(n)
    words, keys = list(known), np.concatenate(keys)
    found = list(quicksort(keys, np.concatenate(counts), max(level, 2), least))
    return pa.table({
        "lang": pa.array([lang] * len(found), pa.string()),
        "phrase": pa.array([b" ".join(words[i] for i in keys[at, :size].tolist()) for at, size, _ in found],
                           pa.binary()).cast(pa.string(), safe=False),
        "size": pa.array([size for _, size, _ in found], pa.int32()), "f": pa.array([f for _, _, f in found], pa.int64())})


def _power(x: float, least: int, most: int) -> int:
    return int(min(max(1 << max(int(x) - 1, 0).bit_length(), least), most))


def phrases(docs: DataFrame, scratch: Scratch, least: int = LEAST, slot_most: int = SLOT_MOST) -> tuple[DataFrame, DataFrame]:
    """((lang, word, n) of all words, (lang, phrase, size, f) of all candidates)."""
    counted = docs.mapInArrow(_count_words, WORDS).groupBy("lang", "word").agg(
        F.sum("n").alias("n"), F.any_value("hash").alias("hash"))
    words = scratch.store(counted, "collocation-words")
    total = words.agg(F.sum("n"), F.count("*")).first()
    bits = _power(16 * total[1], 1 << 10, BITMAP_MOST)
    # one long for 64 places: at most BITMAP_MOST / 64 rows
    place = F.pmod(F.col("hash"), F.lit(bits))              # bits divides 2**64, so the sign does not matter
    rows = words.where(F.col("n") >= least).select(
        F.shiftright(place, 6).alias("at"), F.expr(f"shiftleft(1L, CAST(pmod(hash, {bits}) & 63 AS INT))").alias("bit")).groupBy(
        "at").agg(F.bit_or("bit").alias("mask")).toArrow()
    bitmap = np.zeros(bits // 64, dtype=np.int64)
    bitmap[rows.column("at").to_numpy()] = rows.column("mask").to_numpy()
    bitmap = bitmap.view(np.uint8)

    places = _power(2 * (total[0] or 0), RANGE, BITMAP_MOST)
    counts = docs.mapInArrow(lambda b: _count_pairs(b, bitmap, places), PAIRS)
    kept = counts.repartition("part").sortWithinPartitions("part").mapInArrow(lambda b: _frequent_pairs(b, least), FREQUENT).toArrow()
    pairs, moved = np.zeros(places // 8, dtype=np.uint8), 0     # at most BITMAP_MOST / RANGE rows
    for part, bits, n in zip(*(kept.column(c).to_pylist() for c in ("part", "bits", "n"))):
        pairs[part * RANGE // 8:(part + 1) * RANGE // 8] = np.frombuffer(bits, dtype=np.uint8)
        moved += n

    count = _power(moved / SLOT_ROWS, 16, MOST_SLOTS)
    blocks = scratch.store(docs.mapInArrow(lambda b: _sort_blocks(b, pairs, count), BLOCKS), "collocation-blocks")
    sums = blocks.where("level > 0").groupBy("lang", "level", "slot").agg(F.sum("n").alias("n"))
    long: dict[tuple[str, int], list] = {}
    for r in sums.where(F.col("n") > max(slot_most, 4 * moved // MOST_SLOTS)).collect():
        long.setdefault((r.lang, r.level), []).append(r.slot)
    long = {k: np.array(v, dtype=np.int64) for k, v in long.items()}
    sent = blocks.where("level = 0").select("lang", "rows").mapInArrow(lambda b: _route(b, long, count), SENT)
    found = sent.groupBy("lang", "level", "slot").applyInArrow(lambda key, rows: _sort_slot(key, rows, least), PHRASES)
    return words.select("lang", "word", "n"), scratch.store(found, "collocation-phrases")


def _prefix(words: str, k: str) -> str:
    return f"concat_ws(' ', slice({words}, 1, {k}))"


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, slot_most: int = SLOT_MOST, *,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` collocations."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    words, found = phrases(rows, scratch, least, slot_most)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = found.where(F.col("size") < DEPTH).select("lang", F.col("phrase").alias("part"), "f").unionByName(
        words.where(F.col("n") >= least).select("lang", F.col("word").alias("part"), F.col("n").alias("f")))

    # a candidate goes if a longer one that holds it has as many occurrences
    split = found.select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    inner = split.where("size > 2").selectExpr(
        "lang", "a", """explode(flatten(transform(sequence(2, size - 1), k ->
            transform(sequence(1, size - k + 1), i -> concat_ws(' ', slice(words, i, k)))))) AS phrase""")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = split.join(longer, ["lang", "phrase"], "left").where(F.expr("longer IS NULL OR longer < a"))

    cuts = kept.selectExpr("lang", "phrase", "size", "a", "words", "explode(sequence(1, size - 1)) AS k").selectExpr(
        "lang", "phrase", "a", "k", "concat_ws(' ', slice(words, 1, k)) AS head", "concat_ws(' ', slice(words, k + 1, size - k)) AS rest")
    heads = parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    rests = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang").selectExpr(
        "lang", "phrase", "a", "k", "l", "r", "n", """(1000 * CAST(a AS DECIMAL(38, 0)) * CAST(n AS DECIMAL(38, 0)))
            div (CAST(l AS DECIMAL(38, 0)) * CAST(r AS DECIMAL(38, 0))) AS score""")
    least_cut = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    out = least_cut.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    # the first ones of each salted part hold the first ones of the language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = out.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(
        F.col("rank") <= top).drop("rank", "salt")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, unnest(w) AS word FROM lists),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, w[i : i + k - 1] AS p
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY lang, p HAVING count(*) >= 100),
cand AS (SELECT lang, p, f AS a FROM f WHERE len(p) >= 2),
inner_p AS (
  SELECT lang, a, p[i : i + k - 1] AS p
  FROM cand, (SELECT unnest(range(2, 5)) AS k), (SELECT unnest(range(1, 5)) AS i)
  WHERE k < len(p) AND i + k - 1 <= len(p)),
longer AS (SELECT lang, p, max(a) AS longer FROM inner_p GROUP BY lang, p),
kept AS (
  SELECT c.lang, c.p, c.a FROM cand c LEFT JOIN longer g ON c.lang = g.lang AND c.p = g.p
  WHERE g.longer IS NULL OR 100 * g.longer < 100 * c.a),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM kept c, (SELECT unnest(range(1, 5)) AS k) ks, f x, f y, totals t
  WHERE k < len(c.p) AND x.lang = c.lang AND x.p = c.p[1 : k] AND y.lang = c.lang AND y.p = c.p[k + 1 : len(c.p)]
    AND t.lang = c.lang),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM cuts),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
