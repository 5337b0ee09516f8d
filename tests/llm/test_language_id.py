import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from reelhouse.llm import language_id as L
from reelhouse.llm.common import held_out
from tests.llm.helpers import DOCS

SYLLABLES = {"xx": ["ba", "do", "ki", "lu"], "yy": ["ßen", "och", "tür", "mm"], "zz": ["qua", "ñi", "rre", "oso"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(spark, n=240):
    rng = random.Random(1)
    rows = [(k, text(rng, lang, rng.randrange(5, 80)), lang, "s", 0) for k in range(n) for lang in ["xyz"[k % 3] * 2]]
    rows += [(n, None, "xx", "s", 0), (n + 1, "12 !!", "yy", "s", 0), (n + 2, text(rng, "zz", 3000), None, "s", 0),
             (None, text(rng, "yy", 30), None, None, None), (0, rows[0][1], "xx", "s", 0)]
    return spark.createDataFrame(rows, DOCS), rows


def brute_phrases(symbols, sample, block):
    """Greedy longest matches by substring search; a letter the sample lacks counts twice."""
    count = 0
    for b in range(0, len(symbols), block):
        piece, i = symbols[b:b + block], 0
        while i < len(piece):
            j = i + 1
            while j <= len(piece) and piece[i:j] in sample:
                j += 1
            count += 1 if j > i + 1 else 2
            i = max(j - 1, i + 1)
    return count


def test_phrases_equal_substring_search():
    rng = random.Random(2)
    model = L.Model({k: [L.fold(text(rng, k, 30)) for _ in range(5)] for k in ("xx", "yy")})
    texts = [text(rng, "xx", 40), text(rng, "yy", 900), "a", "", None, "Ωmega ba do", text(rng, "zz", 20)]
    got, size = model.entropies(texts)
    limit = model.symbol.max() + 1
    rng = random.Random(2)
    for k, lang in enumerate(("xx", "yy")):
        sample = bytes(np.concatenate([np.append(model.symbol[L.fold(text(rng, lang, 30))], limit) for _ in range(5)]).tolist())
        for t, (h, n) in enumerate(zip(got[k], size)):
            symbols = bytes(model.symbol[L.fold(texts[t])].tolist()) if texts[t] else b""
            # symbol 0 (a letter no sample has) never occurs in a sample
            want = brute_phrases(symbols, sample, L.BLOCK) * math.log2(len(sample)) / max(len(symbols), 1)
            assert n == len(symbols) and abs(h - want) < 1e-9


def test_laid_out_edges_are_the_automaton():
    rng = random.Random(4)
    edges = L.suffix_automaton([rng.randrange(1, 900) for _ in range(3000)] + [rng.randrange(1, 4) for _ in range(500)])
    place, owner, target = L.lay_out(edges, 901)
    assert len(set(place.tolist())) == len(edges)
    for state, row in enumerate(edges):
        cells = place[state] + np.arange(901)
        own = np.flatnonzero(owner[cells] == place[state])
        assert own.tolist() == sorted(row) and all(target[place[state] + c] == place[to] for c, to in row.items())


def test_large_scripts_without_a_letter_in_common(spark):
    rng = random.Random(5)
    scripts = {"han": [chr(0x4E00 + i) for i in range(1500)], "hangul": [chr(0xAC00 + i) for i in range(1500)]}
    lean = [1 / (i + 3) for i in range(1500)]
    rows = [(k, "".join(rng.choices(scripts[lang], lean, k=160)), lang, "s", 0)
            for k in range(400) for lang in [("han", "hangul")[k % 2]]]
    rare = [(1000 + k, "".join(rng.choices(scripts[lang][300:900], k=60)), None, "s", 0)
            for k in range(200) for lang in [("han", "hangul")[k % 2]]]
    docs = spark.createDataFrame(rows + rare, DOCS)
    model = L.Model(L.sample(docs))
    assert (model.symbol > 0).sum() > 2000
    got = {r.doc_id: r.lang_pred for r in L.predict(docs, model).collect()}
    assert sum(got[1000 + k] == ("han", "hangul")[k % 2] for k in range(200)) >= 196


def test_clashing_columns_and_ties(spark):
    docs, rows = corpus(spark, 60)
    extra = docs.select("*", *[F.lit("zz").alias(c) for c in ("held_out", "lang_pred", "score", "letters", "o", "t", "count")])
    assert sorted(map(str, L.identify(extra).collect())) == sorted(map(str, L.identify(docs).collect()))
    same = spark.createDataFrame([(k, "abc abd", lang, "s", 0) for k in range(40) for lang in ("bb", "aa")], DOCS)
    assert {r.lang_pred for r in L.identify(same).collect()} == {"aa"}


def test_held_out_accuracy_and_edges(spark):
    docs, rows = corpus(spark)
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    hold = [r for r in rows if r[0] is not None and r[0] < 240 and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert hold and sum(got[r[0]].lang_pred == r[2] for r in hold) >= 0.98 * len(hold)
    assert all(got[r[0]].held_out for r in hold)
    assert (got[240].lang_pred, got[240].score, got[241].lang_pred) == ("und", 0.0, "und")
    assert got[242].lang_pred == "zz" and got[None].lang_pred == "yy" and all(0 <= r.score <= 1 for r in got.values())
    assert L.identify(docs).count() == len(rows)


def test_nothing_is_learned_from_held_out_rows(spark):
    docs, _ = corpus(spark)
    wrong = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "nonsense").otherwise(F.col("lang")))
    assert set(L.sample(wrong)) == {"xx", "yy", "zz"}


def test_no_labels_and_empty(spark):
    docs, rows = corpus(spark)
    out = L.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in out} == {"und"} and len(out) == len(rows)
    assert L.identify(spark.createDataFrame([], DOCS)).count() == 0
