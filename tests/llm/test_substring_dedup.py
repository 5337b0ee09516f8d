import hashlib
import re

import pytest

from reelhouse.llm import substring_dedup as S
from tests.llm.helpers import DOCS, awkward, documents, same


def brute(rows, window):
    """doc -> (n_words, kept) by the definition; rows with a null id are documents of their own, after all others."""
    words = [((float("inf"), k) if i is None else (i, 0), re.findall(r"[^\x20\x09-\x0D]+", t or ""))
             for k, (i, t, _) in enumerate(rows)]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, (i, s)), (i, s))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (i, s):
                gone |= set(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((None if i[0] == float("inf") else i[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_equals_sql(spark):
    docs = documents(spark, awkward())
    rows = same(S.dedup_digest(docs), S.SQL, documents=docs)
    assert sum(r[2] for r in rows) > 0


@pytest.mark.parametrize("window,minimiser", [(20, 3), (6, 2), (4, 4)])
def test_equals_brute_force(spark, window, minimiser):
    rows = awkward(2) + [(None, awkward(2)[0][1], None)]
    got = S.dedup_digest(documents(spark, rows, extra=True), window, minimiser).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, window)


def test_hot_passage_travels_by_window(spark, monkeypatch):
    """A minimiser with most super-k-mers is cut into single windows; the result is the same."""
    monkeypatch.setattr(S, "HOT_LEAST", 5)
    rows = [(k, f"a{k} b{k} " + "the shared passage of many documents is here again " * 4 + f"c{k}", "s") for k in range(40)]
    got = S.dedup_digest(documents(spark, rows), 8, 2).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 8)


def test_null_ids_are_documents_of_their_own(spark):
    base, other = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(1, base, "s"), (None, other, "s"), (None, base, "s")]
    got = S.dedup_digest(documents(spark, rows)).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 30]
    rows += [(None, [base, other, base + " " + other, f"x{k} " + other][k % 4], None) for k in range(60)] + awkward(3)
    got = S.dedup_digest(documents(spark, rows, extra=True)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 20)
    kept = S.deduplicate_text(documents(spark, rows)).where("doc_id is null").select("text").collect()
    assert sum(len((r[0] or "").split()) for r in kept) == sum(r.n_words - r.n_removed for r in got if r.doc_id is None)


def test_minimiser_of_few_in_every_block_is_hot(spark, monkeypatch):
    """Nothing a block holds less of than others is left out of the counts."""
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(S, "SEGMENT", 100)
    passage = " ".join(f"p{k}" for k in range(20))
    batches = [pa.record_batch({"id": [k], "text": [" ".join(f"w{k}_{i}" for i in range(400)) + " " + passage]})
               for k in range(50)]
    monkeypatch.setattr(S, "text_blocks", lambda it, *_: ((b.column("id").to_pylist(), [b.column("text")[0].as_py().encode()])
                                                         for b in it))
    parts = list(S._count(iter(batches), 20, 3))
    assert len(parts) > 10
    key, n = (np.array([x for p in parts for x in p.column(c).to_pylist()[:-2]]) for c in ("cell", "n"))
    assert max(n[key == k].sum() for k in np.unique(key)) >= 50


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "x y z " * 10, "s"), (1, "x y z " * 10, "s")]
    got = S.dedup_digest(documents(spark, rows)).collect()
    assert len(got) == 2 and got[0] == got[1]
    assert S.dedup_digest(spark.createDataFrame([], DOCS)).count() == 0


def test_text_keeps_columns_and_untouched_rows(spark):
    docs = documents(spark, awkward(), extra=True)
    out = S.deduplicate_text(docs)
    assert out.columns == docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in out.collect()}
    assert after[1] == before[1] and after[2] == "" and after[4] is None and after[12] == before[12]
    assert after.keys() == before.keys()


def test_equal_hashes_are_compared(spark):
    """Windows of one hash but other words stay apart."""
    import numpy as np
    token = np.array([1, 2, 3, 1, 2, 3, 4], dtype=np.int32)
    at = np.array([0, 1, 3, 4])
    keep = S.window_hash
    try:
        S.window_hash = lambda values, length: np.zeros(len(values) - length + 1, dtype=np.uint64)
        assert S._first_windows(token, at, 3).tolist() == [True, True, False, True]
    finally:
        S.window_hash = keep
