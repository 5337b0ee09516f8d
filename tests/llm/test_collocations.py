"""Phrase collocations against SQL."""
import random

import numpy as np
import pytest

from reelhouse.llm import collocations
from tests.llm.helpers import awkward, documents, same


def text(rng, n, words):
    return "".join(f"w{rng.randrange(words)}{rng.choice(['.', ' ', '  ', ', ', chr(9)] + [' '] * 20)} "[:-1] + " " for _ in range(n))


def corpus(seed=3):
    rng = random.Random(seed)
    rows = awkward() + [(100 + k, text(rng, 400, 7), None if k % 3 else "x") for k in range(40)]
    rows += [(300 + k, "Alpha beta GAMMA delta epsilon zeta! one-two\ntail " * (k % 7), "b") for k in range(60)]
    rows += [(None, "hot pair here " * 400, "a"), (1, "A. B? C;;", "a"), (1, "A. B? C;;", "a")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    df = documents(spark, corpus(), extra=True)
    # the language by source: none, one letter, several
    return df.withColumn("lang", df["source"])


def test_equals_sql(spark, docs):
    assert len(same(collocations.collocations(docs), collocations.SQL, documents=docs)) > 80


def test_long_slots_and_partitions_change_nothing(spark, docs):
    """Slots that pass their rows on, level after level, give the same counts."""
    for most in (0, 40):
        assert same(collocations.collocations(docs.repartition(5), slot_most=most), collocations.SQL, documents=docs)


def test_a_product_over_64_bits(spark):
    from pyspark.sql import functions as F
    found = spark.createDataFrame([("a", 3 * 10 ** 12, 4 * 10 ** 12, 5 * 10 ** 12)], "w string, a long, n long, l long")
    score = found.select(F.expr("""(1000 * CAST(a AS DECIMAL(38, 0)) * CAST(n AS DECIMAL(38, 0)))
        div (CAST(l AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(38, 0)))""")).first()[0]
    assert score == 1000 * 4 * 10 ** 12 // (5 * 10 ** 12)


def test_empty(spark, docs):
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_quicksort_counts():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 4, (500, collocations.DEPTH)).astype(np.int32)
    keys[np.cumsum(rng.random(keys.shape) < 0.1, axis=1) > 0] = 0
    keys[:, 0] = np.maximum(keys[:, 0], 1)
    n = rng.integers(1, 5, 500)
    found = {tuple(keys[at, :size]): f for at, size, f in collocations.quicksort(keys, n, 1, 20)}
    want = {}
    for row, count in zip(keys.tolist(), n.tolist()):
        for size in range(1, collocations.DEPTH + 1):
            if row[size - 1]:
                want[tuple(row[:size])] = want.get(tuple(row[:size]), 0) + count
    assert found == {k: v for k, v in want.items() if v >= 20}
