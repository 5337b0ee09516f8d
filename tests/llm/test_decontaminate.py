import random

from reelhouse.llm import decontaminate as D
from tests.llm.helpers import DOCS, awkward, documents, same, sentence

ITEMS = "item_id long, text string"


def items(spark):
    rng = random.Random(1)
    passage = sentence(rng, 120, 5000).split()          # the base text of awkward(1)
    return spark.createDataFrame([
        (1, " ".join(passage[10:40]).upper() + "!"), (2, "One, two-three"), (3, None), (4, "..."), (10, " ".join(passage[35:60])),
        (2, "One, two-three"), (None, "one two"), (12, "nothing of this kind is found in any of the documents here")], ITEMS)


def test_equals_sql(spark):
    docs = documents(spark, awkward(), extra=True)
    test = items(spark).where("item_id is not null")
    rows = same(D.contamination(docs, test), D.SQL, documents=docs.select("doc_id", "text"), benchmark=test)
    assert sum(r[5] for r in rows) >= 4


def test_blocks_of_queries_give_the_same(spark, monkeypatch):
    docs = documents(spark, awkward() + awkward())
    whole = sorted(map(tuple, D.contamination(docs, items(spark)).collect()), key=repr)
    monkeypatch.setattr(D, "QUERY_BYTES", 120)
    assert sorted(map(tuple, D.contamination(docs, items(spark)).collect()), key=repr) == whole


def test_phrase_and_proximity_matches(spark):
    docs = documents(spark, [(1, "x alpha beta gamma delta y", "s"), (2, "alpha beta z gamma delta", "s"), (3, None, "s"),
                             (4, "delta gamma beta alpha", "s")])
    test = spark.createDataFrame([(5, "Alpha beta, gamma delta.")], ITEMS)
    queries = next(D.query_blocks(test, 10, "item_id", "text"))
    index, _ = D.build_index(docs, queries)
    exact = [tuple(r) for r in D.search(index, queries).collect()]
    assert exact == [(1, 5, "exact", 1, 4)]
    near = {tuple(r) for r in D.search(index, queries, slop=2).collect()} - set(exact)
    assert {(r[0], r[2]) for r in near} == {(2, "near")}


def brute_near(words, window, slop):
    found = set()
    for b, first in enumerate(words):
        if first != window[0]:
            continue
        e = b
        for term in window[1:]:
            e = next((p for p in range(e + 1, len(words)) if words[p] == term), None)
            if e is None:
                break
        if e is not None and len(window) - 1 < e - b <= len(window) - 1 + slop:
            found.add((b, e))
    return found


def test_proximity_equals_brute_force(spark):
    rng = random.Random(3)
    item = "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"
    texts = ["w0 w1 extra w2 w3 w4 w5 w6 w7 w8 w9", "w0 w1 w2 w3 w4 w5 w6 w7 extra w8 w9", item, item + " " + item,
             "w0 w1 w2 w3 w4", "w5 w6 w7 w8 w9", "w0 " + item, "", None, "w9 w8 w7 w6 w5 w4 w3 w2 w1 w0"]
    for _ in range(120):                       # the item with words put in, left out, exchanged
        words = item.split() * rng.randrange(1, 3)
        for _ in range(rng.randrange(5)):
            words.insert(rng.randrange(len(words)), rng.choice(["x", "w0", "w4", "w9"]))
        if rng.random() < 0.3:
            words.pop(rng.randrange(len(words)))
        texts.append(" ".join(words))
    docs = documents(spark, [(k, t, "s") for k, t in enumerate(texts)])
    test = spark.createDataFrame([(5, item), (6, "w4 w4 w9")], ITEMS)
    queries = next(D.query_blocks(test, 10, "item_id", "text"))
    index, _ = D.build_index(docs.repartition(3), queries)
    for slop in (1, 4):
        got = {(r.doc_id, r.item_id, r.first_word, r.last_word)
               for r in D.search(index, queries, slop).collect() if r.kind == "near"}
        want = {(k, i, b, e) for k, t in enumerate(texts) for i, w in ((5, item), (6, "w4 w4 w9"))
                for b, e in brute_near((t or "").split(), w.split(), slop)}
        assert got == want and {(0, 5, 0, 10), (1, 5, 0, 10)} <= got


def test_blocks_of_queries_do_not_rely_on_equal_splits(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    rows = awkward() + [(1000 + k, sentence(rng, 60, 3000), "s") for k in range(300)]
    documents(spark, rows).repartition(7).write.parquet(str(tmp_path / "d"))
    whole = sorted(map(tuple, D.contamination(spark.read.parquet(str(tmp_path / "d")), items(spark)).collect()), key=repr)
    monkeypatch.setattr(D, "QUERY_BYTES", 120)
    build, calls = D.build_index, []

    def split_anew(docs, queries, **options):
        calls.append(1)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(4096 * len(calls)))
        return build(docs, queries, **options)

    monkeypatch.setattr(D, "build_index", split_anew)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        got = sorted(map(tuple, D.contamination(spark.read.parquet(str(tmp_path / "d")), items(spark)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(calls) > 2 and got == whole


def test_clean_documents_stay_as_they_are(spark):
    docs = documents(spark, awkward(), extra=True)
    bad = {r.doc_id for r in D.contamination(docs, items(spark)).collect() if r.contaminated}
    kept = D.keep_clean(docs, items(spark))
    assert kept.columns == docs.columns
    want = sorted((tuple(r) for r in docs.collect() if r.doc_id not in bad), key=repr)
    assert sorted(map(tuple, kept.collect()), key=repr) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert D.contamination(none, items(spark)).count() == 0
    docs = documents(spark, awkward())
    out = D.contamination(docs, spark.createDataFrame([], ITEMS)).collect()
    assert len(out) == len(awkward()) and not any(r.contaminated for r in out)
