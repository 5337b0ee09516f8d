import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from reelhouse.llm import toxicity as M
from tests.llm.helpers import DOCS, awkward, documents, sentence

LABELS = "doc_id long, quality int, toxic int"
BAD = ["grumbleworth", "snarkface", "wretchling"]


def corpus(spark, n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(n):
        w = sentence(rng, rng.randrange(10, 120), 300).split()
        toxic = k % 4 == 0
        for _ in range(2 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(BAD))
        rows.append((k, " ".join(w), "s"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_held_out_documents_and_misspellings(spark):
    rows, labels = corpus(spark)
    rows += [(900, sentence(random.Random(5), 200, 300) + " grumblewortth you", "s"), (901, None, "s"), (902, "", None),
             (903, "!!! ...", "s"), (None, "w1 w2 w3", None), (0, rows[0][1], "s")]
    docs = documents(spark, rows, extra=True)
    got = M.toxicity(docs, spark.createDataFrame(labels + [(5, 1, None), (77777, 1, 1), (None, 0, 1)], LABELS)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    hold = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(by[i].predicted == t for i, t in hold) >= 0.97 * len(hold) and all(by[i].held_out for i, _ in hold)
    assert by[900].predicted == 1 and not any(by[i].predicted for i in (901, 902, 903, None))


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus(spark, 60)
    hold = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    got = M.sample(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert sorted(t.decode() for t, _ in got) == sorted(t for i, t, _ in rows if i not in hold)


def test_grams_of_a_word_do_not_depend_on_its_place():
    one, two = M.Grams([b"alpha"]), M.Grams([b"x yy, Alpha! zz"])
    mine = sorted(two.bucket[two.word == 2].tolist())
    assert mine == sorted(one.bucket.tolist()) and len(mine) == sum(7 - n + 1 for n in M.GRAMS)


def test_bags():
    means, doc = M.bag_means(np.array([1.0, 2, 3, 4, 10]), np.array([4, 0, 1]))
    assert doc.tolist() == [0] * (4 - M.BAG + 1) + [2] and means[-1] == 10


def test_one_class_and_empty(spark):
    docs = documents(spark, awkward())
    out = M.toxicity(docs, spark.createDataFrame([(1, 1, 0)], LABELS)).collect()
    assert len(out) == len(awkward()) and not any(r.predicted for r in out)
    assert M.toxicity(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
    assert M.toxicity(docs.withColumn("text", F.lit(None).cast("string")), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == len(awkward())
