"""Quality rules combined by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0).  Nobody labels documents:
expectation-maximisation over the votes estimates, for each rule, how often it
votes each way on good and on bad documents, and gives each document the
posterior probability of being good.  A document passes when that probability
is at least ``KEEP``, instead of having to pass every rule.

The votes of all documents are counted by pattern first (at most 3^rules rows,
whatever the corpus size); EM runs on these counts.  The prior rates act as
``PRIOR_SHARE`` of the corpus, so they weigh the same at every size.

Edge cases: null, empty or blank texts have no words, fail the base rule and
are not kept; an empty table gives an empty result; repeated rows are judged
alike; other columns do not matter (``keep_good`` returns them untouched).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

SYMBOLS = "#*$%&|<>"
LONE = frozenset(SYMBOLS + "-=_~+•·–—")       # words of one such character part items, not sentences
SPACES = " \t\n\v\f\r"
KEEP = 0.5
PRIOR_SHARE = 1.0
ROUNDS = 100

# name, value, good when between, bad when outside; elsewhere it abstains
RULES = [
    ("length", "n_words", (80, 1e18), (50, 1e18)),
    ("word_length", "word_chars / n_words", (3.0, 12.0), (2.0, 18.0)),
    ("symbols", "n_symbols / n_words", (0.0, 0.05), (0.0, 0.2)),
    ("letters", "n_letters / word_chars", (0.92, 1.0), (0.82, 1.0)),
    ("bullets", "n_lone / n_words", (0.0, 0.05), (0.0, 0.2)),
    ("repeated_lines", "n_dup_lines / n_lines", (0.0, 0.1), (0.0, 0.3)),
    ("repeated_words", "n_repeat_words / n_words", (0.0, 0.2), (0.0, 0.4)),
    ("upper_case", "n_upper / n_letters", (0.0, 0.15), (0.0, 0.4)),
    ("exclamation", "n_exclaims / n_words", (0.0, 0.03), (0.0, 0.15)),
    ("sentences", "n_stops / n_words", (0.02, 0.4), (0.005, 0.6)),
]
# rates of (bad, none, good) votes expected on bad and on good documents before any data
PRIOR = np.array([[[0.15, 0.07, 0.78], [0.004, 0.066, 0.93]]] * len(RULES))
PRIOR_GOOD = 0.85

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_letters", "n_exclaims", "n_stops", "n_lone"]

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_STOP = re.compile(r"[.!?…。](?=\s|$)")
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
_LETTER = re.compile(r"[^\W\d_]")


def _repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    total, covered = 0, 0            # words before ``covered`` are counted
    for k, w in enumerate(windows):
        if often[w] > 1:
            total += k + 3 - max(k, covered)
            covered = k + 3
    return total


def measure(text: str | None) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    text = text or ""
    words = _WORD.findall(text)
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line and line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    n_letters = len(_LETTER.findall(text)) if not text.isascii() else sum(map(str.isalpha, text))
    lower = text.lower()
    n_upper = sum(a != b for a, b in zip(text, lower)) if len(lower) == len(text) else len(_UPPER.findall(text))
    return (len(words), len(text) - sum(text.count(c) for c in SPACES), sum(text.count(c) for c in SYMBOLS),
            dup, _repeated_words(words), lines, n_upper, n_letters, text.count("!"), len(_STOP.findall(text)),
            sum(map(LONE.__contains__, words)))


def _measure_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = np.array([measure(t.as_py()) for t in b.column("text")], dtype=np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([b.column("row"), *[pa.array(c) for c in rows.T]], names=["row", *COUNTS])


def measured(docs: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """(row, COUNTS...): ``row`` is a struct of ``columns``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], *[T.StructField(c, T.LongType()) for c in COUNTS]])
    return rows.mapInArrow(_measure_batches, schema)


def votes() -> list[Column]:
    """One column of -1, 0, 1 for each rule; a rule whose value is undefined abstains."""
    out = []
    for name, value, good, bad in RULES:
        top, _, bottom = value.partition(" / ")
        x = F.col(top) / F.expr(f"nullif({bottom}, 0)") if bottom else F.col(top)
        out.append(F.when(x.between(*good), 1).when(~x.between(*bad), -1).otherwise(0).alias(f"vote_{name}"))
    return out


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, np.ndarray]:
    """EM over (votes, documents): the share of good documents and the vote
    rates[rule, class, vote + 1]."""
    if not patterns:
        return PRIOR_GOOD, PRIOR
    v = np.array([p for p, _ in patterns]) + 1
    n = np.array([c for _, c in patterns], dtype=float)
    weight = PRIOR_SHARE * n.sum()
    share, rates = PRIOR_GOOD, PRIOR
    onehot = np.eye(3)[v]                                        # pattern, rule, vote
    for _ in range(ROUNDS):
        good = posterior(v - 1, share, rates)
        both = np.stack((1 - good, good))                        # class, pattern
        got = np.einsum("cp,p,prv->rcv", both, n, onehot)
        mass = weight * np.array([1 - PRIOR_GOOD, PRIOR_GOOD])
        new = got + PRIOR * mass[None, :, None]
        new /= new.sum(axis=2, keepdims=True)
        share = float((good @ n + weight * PRIOR_GOOD) / (n.sum() + weight))
        done = np.abs(new - rates).max() < 1e-9
        rates = new
        if done:
            break
    return share, rates


def posterior(v: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """Probability of being good for each row of votes."""
    log = np.log(rates)
    rule = np.arange(v.shape[1])
    score = np.log(share / (1 - share)) + (log[rule, 1, v + 1] - log[rule, 0, v + 1]).sum(axis=1)
    return 1 / (1 + np.exp(-score))


def good_probability(model: tuple[float, np.ndarray]) -> Column:
    """The posterior as a column over the vote columns."""
    share, rates = model
    ratio = np.log(rates[:, 1, :]) - np.log(rates[:, 0, :])
    score = F.lit(float(np.log(share / (1 - share))))
    for (name, *_), by_vote in zip(RULES, ratio):
        vote = F.col(f"vote_{name}")
        score = score + F.when(vote == 1, float(by_vote[2])).when(vote == -1, float(by_vote[0])).otherwise(float(by_vote[1]))
    return 1 / (1 + F.exp(-score))


def learn(counted: DataFrame) -> tuple[float, np.ndarray]:
    """The model of a table with COUNTS columns; only the vote patterns reach the driver."""
    columns = votes()
    patterns = counted.select(*columns).groupBy(*[f"vote_{r[0]}" for r in RULES]).count().collect()
    return fit(sorted((tuple(r)[:-1], r[-1]) for r in patterns))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, kept, p_good and the votes of every document."""
    counted, _ = stored(measured(docs, [id_col], text_col), "quality-counts")
    judged = counted.select(F.col(f"row.`{id_col}`").alias("doc_id"), *COUNTS, *votes())
    p = good_probability(learn(counted))
    return judged.withColumn("p_good", p).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP))


def verdicts(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", *COUNTS[:5], "base_failed", "kept", "p_good")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, all columns as they are (measured once to learn, once to filter)."""
    model = learn(measured(docs, docs.columns[:1], text_col))
    rows = measured(docs, docs.columns, text_col).select("row", *COUNTS, *votes())
    kept = rows.where(~base_failed() & (good_probability(model) >= KEEP))
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])
