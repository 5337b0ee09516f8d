"""Spelling variants by an index of variable-length grams.

Words are maximal letter runs with ``LENGTH`` letters or more that the corpus has
``OCCURRENCES`` times or more.  Two are near if one inserted, deleted or replaced
letter turns one into the other.

1. *Dictionary.*  Grams of ``SHORTEST`` to ``LONGEST`` letters (an end mark counts
   as one) are counted over the words.  Those above ``share`` of all places, or
   ``GRAM_LEAST`` where that is more, are frequent and pruned: an index gram is
   the shortest one at its place that is not frequent, or the longest allowed.
   At most ``LONGEST / share`` grams are frequent, which bounds the dictionary.
2. *Decomposition.*  A word has a gram at every place.  As the letters of a gram
   alone decide where it ends, an edit can affect only the grams that cover it.
3. *Merging.*  For each place an edit of a word can be at, the grams it does not
   affect are in any near word too, at the same distance from the start or from
   the end: the affected-gram bound is reached with equality.  The lists of these
   grams are therefore merged whole, as a join on all of them together; merging
   the rarest few of them first met 87 million pairs on 181,000 words.
4. *Verification.*  Pairs that meet are compared by edit distance.

A word's form is its near word with the largest count if that is ``FACTOR`` times
its own or more; its root is where forms lead.

Edge cases: null and empty texts have no words; a null doc_id seeds the marked
runs like an empty string; ties go to the smallest word in code-point order;
repeated rows count each; an empty table gives an empty result; other columns are
ignored.  Text that is not UTF-8 is read with replacement characters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, binary_rows

LENGTH, OCCURRENCES, FACTOR = 6, 5, 5
DROPPED = 199                     # of so many (document, run) pairs one loses a letter
SHORTEST, LONGEST = 2, 4
SHARE = 2.0 ** -8
GRAM_LEAST = 64
HELD = 200_000                    # distinct words a task holds before it sends their counts

RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LENGTH)   # shorter runs are no words
END = "$"                                               # in no run
LISTS = "merged long, letter boolean, word string, n long"


def words_of(doc_id, text: bytes) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text, after the marked runs lost their letter."""
    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    for run, n in Counter(RUN.findall(text.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % DROPPED == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        if len(run) >= LENGTH:
            yield run, n


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def sent() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                         names=["word", "n"])
        held.clear()
        return out

    for b in batches:
        for i, text in zip(b.column("id").to_pylist(), binary_rows(b, "text")):
            for word, n in words_of(i, text or b""):
                held[word] += n
            if len(held) >= HELD:
                yield sent()
    if held:
        yield sent()


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that occur often enough."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= OCCURRENCES)


def frequent_grams(words: DataFrame, share: float = SHARE, least: int = GRAM_LEAST) -> dict[str, int]:
    """The pruned grams with their counts: at most ``LONGEST / share``, as each place has one gram of a length."""
    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    marked = F.concat("word", F.lit(END))
    grams = [F.transform(F.sequence(F.lit(1), F.length(marked) - (q - 1)), lambda i, q=q: F.substring(marked, i, F.lit(q)))
             for q in range(SHORTEST, LONGEST + 1)]
    counted = words.select(F.explode(F.concat(*grams)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {r.gram: r.n for r in counted.where(F.col("n") > max(share * places, least)).collect()}


def decompose(word: str, frequent: dict[str, int]) -> list[str]:
    """The gram at each place of the word."""
    marked = word + END
    out = []
    for at in range(len(word)):
        q = SHORTEST
        while q < LONGEST and at + q < len(marked) and marked[at:at + q] in frequent:
            q += 1
        out.append(marked[at:at + q])
    return out


def merged_lists(word: str, frequent: dict[str, int]) -> Iterator[tuple[str, bool]]:
    """(the grams an edit does not affect, whether it takes a letter) for every edit: at each
    letter, replaced or taken out, and at each gap, where one is put in."""
    size = len(word)
    grams = [(at, at + len(gram), f"{at}{gram}", f"{size - at}{gram}") for at, gram in enumerate(decompose(word, frequent))]
    for k in range(size + 1):
        left = "".join(own for _, end, own, _ in grams if end <= k)
        right = [own for at, _, _, own in grams if at >= k]
        yield f"{size} {k} {left} {''.join(right)}", False
        if k < size:
            yield f"{size - 1} {k} {left} {''.join(right[1:])}", True


def _list_rows(batches: Iterable[pa.RecordBatch], frequent: dict[str, int]) -> Iterator[pa.RecordBatch]:
    kinds, names = [pa.int64(), pa.bool_(), pa.string(), pa.int64()], ["merged", "letter", "word", "n"]
    for b in batches:
        for start in range(0, b.num_rows, 1 << 12):
            rows = [(xxhash.xxh64_intdigest(key) - (1 << 63), letter, word, n)
                    for word, n in zip(b.column("word")[start:start + (1 << 12)].to_pylist(), b.column("n")[start:start + (1 << 12)].to_pylist())
                    for key, letter in merged_lists(word, frequent)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def near_pairs(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(word, n, other, other_n) once for each two near words."""
    lists = words.mapInArrow(lambda batches: _list_rows(batches, frequent), LISTS)
    one = lists.select("merged", F.col("letter").alias("a_letter"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    # two words that differ in a letter, or one with a letter more than the other
    met = one.join(lists.where("letter"), "merged").where(~F.col("a_letter") | (F.col("a") < F.col("word"))).where(
        F.levenshtein("a", "word", 1) == 1)
    return met.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("word").alias("other"),
                      F.col("n").alias("other_n")).distinct()


def _best(n: Column, word: Column) -> Column:
    return F.min(F.struct((-n).alias("minus"), word.alias("word")))


def variants(docs: DataFrame, share: float = SHARE, least: int = GRAM_LEAST, *, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    scratch = Scratch(docs.sparkSession)
    words = scratch.store(vocabulary(docs, id_col=id_col, text_col=text_col), "spelling-words")
    pairs = scratch.store(near_pairs(words, frequent_grams(words, share, least)), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.any_value("n").alias("own"),
                                    _best(F.col("other_n"), F.col("other")).alias("best"))
    is_form = -F.col("best.minus") >= FACTOR * F.col("own")
    best = scratch.store(best.select("word", "n_near", F.when(is_form, F.col("best.word")).alias("form"),
                                     F.when(is_form, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    # follow forms to the last: every round doubles the way covered, and a form has FACTOR times the
    # count of what leads to it, so there are few
    ends = best.where("form is not null").select("word", F.col("form").alias("end"))
    while True:
        ends = scratch.store(ends, "spelling-ends")
        onward = ends.select(F.col("word").alias("end"), F.col("end").alias("next"))
        if ends.join(onward, "end", "left_semi").isEmpty():
            break
        ends = ends.join(onward, "end", "left").select("word", F.coalesce("next", "end").alias("end"))
    return words.join(best, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
