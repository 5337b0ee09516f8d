"""The stages against brute force, each on its own input; and the whole run."""
import random

import corpus_pipeline as P
from reelhouse.llm import decontaminate, quality_rules
from tests.llm import test_jaccard_join as J
from tests.llm import test_substring_dedup as D
from tests.llm.helpers import awkward, documents
from tests.llm.test_quality_rules import corpus


def make(spark, tmp_dir):
    good, bad = corpus(5)
    rng = random.Random(9)
    item = good[0][1].split("\n")[1]
    words = good[1][1].split(" ")
    words[20] = "other"
    rows = good + bad + [(300, good[1][1], "t"), (301, " ".join(words), "t")] + [(400 + (i or 0), t, s) for i, t, s in awkward()]
    passage = "\n".join(good[5][1].split("\n")[:2])
    rows += [(600 + k, "\n".join([good[20 + k][1], passage]), "u") for k in range(3)]
    rng.shuffle(rows)
    documents(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    return rows


def as_rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_each_stage_on_its_own_input(spark, tmp_dir):
    make(spark, tmp_dir)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "jaccard_join", "substring_dedup", "decontamination", "source_mixing"]

    one = P.quality(spark, docs, tmp_dir)
    good = {r.doc_id for r in quality_rules.verdicts(docs).collect() if r.kept}
    assert one.columns == columns and {r.doc_id for r in one.collect()} == good

    two = P.near_duplicates(spark, one, tmp_dir)
    first = {i for i, _, c in J.brute(as_rows(one), P.SHINGLE, P.PERCENT) if i == c}
    assert two.columns == columns and sorted(r.doc_id for r in two.collect()) == sorted(first) and len(first) < len(good)

    three = P.repeated_passages(spark, two, tmp_dir)
    cut = {r.doc_id: r for r in three.collect()}
    assert three.columns == columns and set(cut) == first
    removed = {i: n for i, _, n, _ in D.brute(as_rows(two), 20)}
    for i, text, _ in as_rows(two):
        assert len(cut[i].text.split()) == len(text.split()) - removed[i] and cut[i].n_chars == len(cut[i].text)
        assert removed[i] or cut[i].text == text
    assert sum(removed.values()) > 0

    four = P.benchmark_free(spark, three, tmp_dir)
    item = spark.read.parquet(f"{tmp_dir}/benchmark.parquet")
    dirty = {r.doc_id for r in decontaminate.contamination(three, item).collect() if r.contaminated}
    assert dirty and four.columns == columns and {r.doc_id for r in four.collect()} == first - dirty


def test_run(spark, tmp_dir):
    make(spark, tmp_dir)
    out = P.run(spark, tmp_dir)
    rows = out.collect()
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(out.columns) and rows
    assert all(r.taken <= 3 * r.size for r in rows)
    assert 0.97 <= sum(r.taken for r in rows) / sum(r.size for r in rows) <= 1.03
