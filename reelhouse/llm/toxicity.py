"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the average of the vectors of its character n-grams (hashed to a
fixed table, word borders included), so a misspelling unseen in training shares
most vectors with the word it hides.  A bag is a run of ``BAG`` words, averaged
again and given to a linear softmax over (clean, toxic).  Vectors and softmax
are trained jointly in numpy.  A document's score is that of its most toxic
bag, calibrated on labelled documents kept out of training, so that one remark
in a long text is not averaged away.

Only the training sample is bounded (``WORDS_PER_CLASS``); every document is
scored whole.  With two classes the softmax needs only the difference of its
two weight vectors, so scoring reads one number for each n-gram.

Edge cases: null or wordless texts get the calibrated score of a bag without
any evidence (under the threshold); without both labels every score is 0;
labels that are null or of unknown documents teach nothing, and a document with
both labels is toxic; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, drop_stored, held_out, stored, text_blocks, window_hash

GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 16
BAG = 2
WORDS_PER_CLASS = 400_000
EPOCHS = 16
BAG_EPOCHS = 4             # with the document's label on every bag
SHARPNESS = 2.0            # of a document's softmax over its bags
BATCHES = 24
RATE = 0.5
DECAY = 1e-6
THRESHOLD = 0.7
BLOCK_BYTES = 1 << 20

RESULT = "doc_id long, held_out boolean, score double, predicted int"

# lower-cases A-Z; ASCII characters other than letters and digits separate words
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                 for c in range(256))


class Grams:
    """The hashed n-grams of a block of texts: bucket and word of each, words of each text."""

    def __init__(self, texts: list[bytes]):
        words = Words([t.translate(TO_WORDS) for t in texts])
        self.counts, self.total = words.counts, len(words.starts)
        buf = np.concatenate(([32], words.buf, [32])).astype(np.uint8)
        letter = buf != 32
        word = np.cumsum(~letter) - 1                      # of each byte of a word
        buckets, owners = [], []
        spread = (buf.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        for n in GRAMS:
            if len(buf) < n:
                continue
            ends = len(buf) - n
            ok = letter[1:ends + 2] & letter[n - 2:ends + n - 1] & (word[1:ends + 2] == word[n - 2:ends + n - 1])
            h = window_hash(spread, n)[ok] + np.uint64(n)
            buckets.append(((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int32))
            owners.append(word[1:ends + 2][ok].astype(np.int32))
        self.bucket = np.concatenate(buckets) if buckets else np.zeros(0, np.int32)
        self.word = np.concatenate(owners) if owners else np.zeros(0, np.int32)
        self.per_word = np.maximum(np.bincount(self.word, minlength=self.total), 1)

    def word_means(self, value: np.ndarray) -> np.ndarray:
        """The mean of a number of each bucket over the n-grams of each word."""
        return np.bincount(self.word, weights=value[self.bucket], minlength=self.total) / self.per_word


def bag_means(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean of each run of BAG words, its text); a text of fewer words is one bag."""
    size = np.minimum(counts, BAG)
    bags = np.where(counts > 0, counts - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), bags)
    first = (np.cumsum(counts) - counts)[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(bags) - bags, bags)
    total = np.concatenate(([0.0], np.cumsum(values)))
    return (total[first + size[doc]] - total[first]) / np.maximum(size[doc], 1), doc


class Model:
    """n-gram vectors, the softmax's difference vector, and the calibration of its logit."""

    def __init__(self):
        rng = np.random.default_rng(7)
        self.vectors = rng.normal(0, 0.1, (BUCKETS, DIM))
        self.softmax = rng.normal(0, 0.5, DIM)
        self.bias, self.scale, self.shift = 0.0, 0.0, -50.0
        self.gram_logit = np.zeros(BUCKETS, dtype=np.float32)

    def train(self, texts: list[bytes], labels: np.ndarray) -> None:
        """Adagrad.  First every bag carries its document's label; then a document answers
        through its most toxic bags (a softmax over its bags), so the clean bags of toxic
        documents stop counting and the worst bags of clean ones are pressed down."""
        order = np.array_split(np.random.default_rng(11).permutation(len(texts)), BATCHES)
        parts = [Grams([texts[i] for i in docs]) for docs in order]
        n_words = [max(1, sum(int(p.counts[labels[o] == c].sum()) for p, o in zip(parts, order))) for c in (0, 1)]
        n_docs = [max(1, int((labels == c).sum())) for c in (0, 1)]
        for epoch in range(EPOCHS):
            if epoch in (0, BAG_EPOCHS):
                sums = [np.full(BUCKETS, 1e-6), np.full(DIM, 1e-6), 1e-6]
            for part, docs in zip(parts, order):
                if not part.total:
                    continue
                bags = -(-part.counts // BAG)
                at = np.arange(part.total) - np.repeat(np.cumsum(part.counts) - part.counts, part.counts)
                bag = np.repeat(np.cumsum(bags) - bags, part.counts) + at // BAG
                n, doc = np.bincount(bag), np.repeat(np.arange(len(bags)), bags)
                logit = np.bincount(bag, weights=part.word_means(self.vectors @ self.softmax)) / n + self.bias
                label = labels[docs]
                if epoch < BAG_EPOCHS:
                    error = (1 / (1 + np.exp(-logit)) - label[doc]) * n / np.take(n_words, label[doc])
                else:
                    top = np.full(len(bags), -np.inf)
                    np.maximum.at(top, doc, logit)
                    pull = np.exp(SHARPNESS * (logit - top[doc]))
                    pull /= np.bincount(doc, weights=pull, minlength=len(bags))[doc]
                    whole = np.bincount(doc, weights=pull * logit, minlength=len(bags))
                    wrong = (1 / (1 + np.exp(-whole)) - label) / np.take(n_docs, label)
                    error = pull * wrong[doc]
                self._step(part, (error / n)[bag] / part.per_word, float(error.sum()), sums)
        self.gram_logit = (self.vectors @ self.softmax).astype(np.float32)

    def _step(self, part: Grams, share: np.ndarray, error: float, sums: list) -> None:
        """One Adagrad step; ``share`` is each word's error for one of its n-grams.  The loss
        moves an n-gram's vector along the softmax, and the softmax along the vectors."""
        coef = np.bincount(part.bucket, weights=share[part.word], minlength=BUCKETS)
        hit = np.flatnonzero(coef)
        c, softmax = coef[hit], self.softmax
        grad = c @ self.vectors[hit] + DECAY * softmax
        sums[0][hit] += c * c * (softmax @ softmax)
        self.vectors[hit] -= (RATE * c / np.sqrt(sums[0][hit]))[:, None] * softmax[None, :]
        sums[1] += grad ** 2
        self.softmax = softmax - 0.1 * RATE * grad / np.sqrt(sums[1])
        sums[2] += error ** 2
        self.bias -= 0.1 * RATE * error / np.sqrt(sums[2])

    def peaks(self, grams: Grams) -> np.ndarray:
        """The largest bag logit of each text; that of the bias alone without words."""
        means, doc = bag_means(grams.word_means(self.gram_logit), grams.counts)
        out = np.full(len(grams.counts), -np.inf)
        np.maximum.at(out, doc, means)
        return np.where(np.isfinite(out), out, 0.0) + self.bias

    def calibrate(self, peaks: np.ndarray, labels: np.ndarray) -> None:
        """Logistic regression of the label on the peak, classes weighing the same, by Newton steps."""
        mean, spread = peaks.mean(), peaks.std() or 1.0
        x = np.stack(((peaks - mean) / spread, np.ones(len(peaks))), axis=1)
        weight = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((labels == 0).sum(), 1)) * len(labels)
        theta = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ theta))
            grad = x.T @ (weight * (p - labels)) + 0.01 * theta
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
            theta -= np.linalg.solve(hess, grad)
        self.scale, self.shift = theta[0] / spread, theta[1] - theta[0] * mean / spread

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.peaks(Grams(texts)) + self.shift, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, words_per_class: int = WORDS_PER_CLASS) -> list[tuple[bytes, int]]:
    """(text, label) of labelled documents outside the held-out fold, in hashed order, up to
    ``words_per_class`` words of each class.  Counts by class set the rate of a draw first, so
    the driver only receives about what it keeps."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").alias("of")).agg(F.max("toxic").alias("toxic"))
    order = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30))
    # first (id, label, size), then texts: only the drawn rows' texts meet the labels
    size = (F.octet_length("text") / 5).cast("long") + 1
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", size.alias("size"), order.alias("o")).join(
        known, F.col("doc_id") == F.col("of"))
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.sum("size").alias("n")).collect()}
    if len(total) < 2:
        return []
    rate = F.create_map(*[F.lit(x) for c, n in total.items() for x in (c, min(1.0, 1.3 * words_per_class / n))])
    drawn = rows.where(F.col("o") < rate[F.col("toxic")] * float(1 << 30)).select(
        F.col("doc_id").alias("of"), "toxic", "o", "size")
    drawn, path = stored(drawn, "toxicity-draw")     # bounded, and of known size before it meets the texts
    got = docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("of")).select("toxic", "o", "text").collect()
    drop_stored(docs.sparkSession, path)
    out, used = [], {0: 0, 1: 0}
    for label, _, text in sorted(got):
        if used[label] < words_per_class:
            out.append((text.encode(), label))
            used[label] += len(text) // 5 + 1
    return out


def fit(rows: list[tuple[bytes, int]]) -> Model:
    """Three quarters of the sample train, the rest calibrate."""
    model = Model()
    labels = np.array([c for _, c in rows], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return model
    rank = np.concatenate([np.arange((labels == c).sum()) for c in (0, 1)])
    kept = np.zeros(len(rows), dtype=bool)
    kept[np.concatenate([np.flatnonzero(labels == c) for c in (0, 1)])] = rank % 4 == 3
    if len(set(labels[kept].tolist())) < 2:
        kept[:] = True
    texts = [t for t, _ in rows]
    use = np.flatnonzero(~kept) if not kept.all() else np.arange(len(rows))
    model.train([texts[i] for i in use], labels[use])
    hold = np.flatnonzero(kept)
    model.calibrate(np.concatenate([model.peaks(Grams([texts[i]])) for i in hold]), labels[hold])
    model.vectors = np.zeros((0, DIM))          # scoring needs the n-gram logits only
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    rows = rows.withColumn("id", F.struct("doc_id", "held_out"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches, "id", "text", BLOCK_BYTES):
            s = model.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i["doc_id"] for i in ids], pa.int64()), pa.array([i["held_out"] for i in ids], pa.bool_()),
                 pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return rows.select("id", "text").mapInArrow(run, RESULT)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(sample(docs, labels)))
