"""Cross-entropy difference of documents under two matched n-gram models.

A target model (of text one wants more of) and a background model (of the whole
corpus) have the same order, smoothing and vocabulary.  Each token's loss under
both is taken; a document's score is the mean difference, target minus
background, in bits a token: the lower, the more it reads like the target.

Both models are bigrams interpolated with add-one unigrams.  Every word and
every pair of both corpora counts, by a 64-bit hash, whatever its frequency.
Texts are stored in blocks of a few MB; a block sends its distinct words and
pairs with their counts to buckets of the hash space, and a bucket adds them up
and returns to each block the totals of what it sent.  The number of buckets
grows with the corpus, and a block sends an item once, so no item is hot and no
task, nor the driver, holds more than a bucket or a block.

Edge cases: a null or wordless text has 0 tokens and null scores; an empty
target or corpus leaves uniform unigrams; repeated rows are counted and scored
each; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, Scratch, Words, mix, text_blocks
from .decontaminate import TO_WORDS

PAIR_WEIGHT = 0.6          # of the bigram in the interpolation
BUCKET_BYTES = 12 << 20    # of text for each bucket
LEAST_BUCKETS = 64

BLOCKS = "block long, size long, data binary"
SENT = "bucket long, block long, codes binary, n binary"
TOTALS = "block long, bucket long, words long, t long, b long, t_counts binary, b_counts binary"
SCORES = "doc_id long, n_tokens long, target_bits double, background_bits double, score double"


def _hashes(texts: list[bytes]) -> Words:
    return Words([t.translate(TO_WORDS) for t in texts])


def _pack(ids: list, texts: list[bytes]) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.large_binary())], names=["id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> tuple[list, list[bytes]]:
    batch = pa.ipc.open_stream(data).read_all()
    return batch.column("id").to_pylist(), batch.column("text").to_pylist()


def _short(counts: np.ndarray) -> bytes:
    """Counts in the narrowest unsigned type that holds them all."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _long(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"u{len(data) // size}").astype(np.int64)


def _blocks(rows: DataFrame) -> DataFrame:
    def run(batches):
        part = TaskContext.get().partitionId() << 32
        for k, (ids, texts) in enumerate(text_blocks(batches, "doc_id", "text")):
            yield pa.RecordBatch.from_pydict({"block": [part | k], "size": [sum(map(len, texts))], "data": [_pack(ids, texts)]})

    return rows.mapInArrow(run, BLOCKS)


class Items:
    """The words and pairs of a block of texts by their codes: even for words, odd for pairs."""

    def __init__(self, texts: list[bytes]):
        words = _hashes(texts)
        self.counts, self.doc_first = words.counts, words.doc_first
        hashes = words.hashes()
        inside = np.ones(len(hashes) + 1, dtype=bool)
        inside[words.doc_first] = False
        self.at = np.flatnonzero(inside[:len(hashes)])             # second words of the pairs within a text
        with np.errstate(over="ignore"):
            pairs = mix(hashes[self.at - 1] * BASE + hashes[self.at])
        self.codes, place, self.n = np.unique(np.concatenate((hashes & ~np.uint64(1), pairs | np.uint64(1))),
                                              return_inverse=True, return_counts=True)
        self.word, self.pair = place[:len(hashes)], place[len(hashes):]

    def sent(self, block: int, buckets: int) -> pa.RecordBatch:
        """A row for each bucket, in the order of the codes."""
        bucket = ((self.codes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        cuts = list(zip(begin.tolist(), [*begin[1:].tolist(), len(bucket)]))
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[begin]), pa.array([block] * len(cuts), pa.int64()),
            pa.array([self.codes[i:j].tobytes() for i, j in cuts], pa.binary()),
            pa.array([_short(self.n[i:j]) for i, j in cuts], pa.binary())], names=["bucket", "block", "codes", "n"])

    def bits(self, counts: list[np.ndarray], total: list[int], size: int) -> np.ndarray:
        """[target, background] bits a token of each text, from both corpora's counts of the codes."""
        out = []
        for n, whole in zip(counts, total):
            uni = (n[self.word] + 1) / (whole + size)
            loss = -np.log2(uni)
            seen = np.minimum(n[self.pair] / np.maximum(n[self.word[self.at - 1]], 1), 1.0)
            loss[self.at] = -np.log2(PAIR_WEIGHT * seen + (1 - PAIR_WEIGHT) * uni[self.at])
            added = np.concatenate(([0.0], np.cumsum(loss)))
            out.append(added[self.doc_first[1:]] - added[self.doc_first[:-1]])
        return np.stack(out) / np.maximum(self.counts, 1)


def _sent(blocks: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("data")):
                yield Items(_unpack(data.as_py())[1]).sent(block, buckets)

    return blocks.select("block", "data").mapInArrow(run, SENT)


def _added(rows: pa.Table) -> pa.Table:
    """The totals of a bucket: a row for each block of the background, one without block for the whole bucket.
    Blocks of the target have no number, as nothing is returned to them."""
    blocks = rows.column("block").to_pylist()
    codes = [np.frombuffer(c, dtype=np.uint64) for c in rows.column("codes").to_pylist()]
    n = np.concatenate([_long(x, len(c)) for x, c in zip(rows.column("n").to_pylist(), codes)])
    ends = np.cumsum([len(c) for c in codes])
    target = np.repeat([b is None for b in blocks], [len(c) for c in codes])
    every, place = np.unique(np.concatenate(codes), return_inverse=True)
    added = []
    for side in (target, ~target):
        count = np.zeros(len(every), dtype=np.int64)
        np.add.at(count, place[side], n[side])
        added.append(count)
    word = every & np.uint64(1) == 0
    back = [(b, i, j) for b, i, j in zip(blocks, [0, *ends[:-1].tolist()], ends.tolist()) if b is not None]
    bucket = rows.column("bucket")[0].as_py()
    zeros = [0] * len(back)
    return pa.table({
        "block": pa.array([None, *[b for b, _, _ in back]], pa.int64()), "bucket": pa.array([bucket] * (len(back) + 1), pa.int64()),
        "words": pa.array([int(word.sum()), *zeros], pa.int64()),
        "t": pa.array([int(added[0][word].sum()), *zeros], pa.int64()), "b": pa.array([int(added[1][word].sum()), *zeros], pa.int64()),
        "t_counts": pa.array([None, *[_short(added[0][place[i:j]]) for _, i, j in back]], pa.binary()),
        "b_counts": pa.array([None, *[_short(added[1][place[i:j]]) for _, i, j in back]], pa.binary())})


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_bits, background_bits, score of every document; ``target`` has a
    column text, the background is ``docs`` itself."""
    scratch = Scratch(docs.sparkSession)
    blocks = scratch.store(_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "scoring-blocks")
    wanted = _blocks(target.select(F.lit(0).cast("long").alias("doc_id"), "text"))
    size = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    sent = _sent(blocks, buckets).unionByName(_sent(wanted, buckets).withColumn("block", F.lit(None).cast("long")))
    totals = scratch.store(sent.groupBy("bucket").applyInArrow(_added, TOTALS), "scoring-totals")
    words, t, b = totals.agg(F.sum("words"), F.sum("t"), F.sum("b")).first()
    whole, vocabulary = [t or 0, b or 0], (words or 0) + 1

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("bucket").to_numpy())
        out = []
        for data in block.column("data").to_pylist():
            ids, texts = _unpack(data)
            items = Items(texts)
            sizes = np.diff(np.searchsorted(
                (items.codes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24),
                np.append(found.column("bucket").to_numpy()[order], buckets).astype(np.uint64))).tolist()
            counts = []
            for c in ("t_counts", "b_counts"):
                parts = found.column(c).to_pylist()
                counts.append(np.concatenate([np.zeros(0, np.int64), *[_long(parts[k], n) for k, n in zip(order, sizes)]]))
            bits, none = items.bits(counts, whole, vocabulary), items.counts == 0
            out.append(pa.table([pa.array(ids, pa.int64()), pa.array(items.counts, pa.int64()), pa.array(bits[0], mask=none),
                                 pa.array(bits[1], mask=none), pa.array(bits[0] - bits[1], mask=none)],
                                names=["doc_id", "n_tokens", "target_bits", "background_bits", "score"]))
        return pa.concat_tables(out)

    back = totals.where("block is not null").select("block", "bucket", "t_counts", "b_counts")
    return blocks.select("block", "data").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, SCORES)
