import math
import random
import re
from collections import Counter

import pytest

from reelhouse.llm import lm_scoring as M
from tests.llm.helpers import DOCS, awkward, documents


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(docs, target):
    """Scores by the definition; every word and pair of these small corpora is above its share."""
    sides = [[words(t) for t in target], [words(t) for t in docs]]
    uni = [Counter(w for d in s for w in d) for s in sides]
    pair = [Counter(p for d in s for p in zip(d, d[1:])) for s in sides]
    vocab = set(uni[0]) | set(uni[1])

    def loss(k, prev, w):
        n = sum(uni[k].values())
        p = (uni[k][w] + 1) / (n + len(vocab) + 1)
        if prev is None:
            return -math.log2(p)
        return -math.log2(M.PAIR_WEIGHT * min(pair[k][prev, w] / max(uni[k][prev], 1), 1.0) + (1 - M.PAIR_WEIGHT) * p)

    out = []
    for d in sides[1]:
        out.append([sum(loss(k, a, b) for a, b in zip([None, *d], d)) / len(d) if d else None for k in (0, 1)])
    return out


def test_scores_equal_brute_force(spark):
    rows = awkward() + [(None, "one two", None), (1, awkward()[0][1], "a")]
    target = ["One two three, four", None, "", awkward()[6][1]]
    got = M.cross_entropy_difference(documents(spark, rows, extra=True), spark.createDataFrame([(t,) for t in target], "text string"))
    got = sorted(((r.doc_id, r.n_tokens, r.target_bits, r.background_bits, r.score) for r in got.collect()), key=repr)
    want = brute([t for _, t, _ in rows], target)
    want = sorted(((i, len(words(t)), a, b, None if a is None else a - b) for (i, t, _), (a, b) in zip(rows, want)), key=repr)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        assert g[2:] == (None, None, None) if w[2] is None else g[2:] == pytest.approx(w[2:], abs=1e-4)


def test_target_like_text_scores_lower(spark):
    rng = random.Random(1)
    a = [f"a{k}" for k in range(50)]
    b = [f"b{k}" for k in range(50)]
    make = lambda v: " ".join(rng.choice(v) for _ in range(60))
    rows = [(k, make(a if k % 2 else b), "s") for k in range(60)]
    out = M.cross_entropy_difference(documents(spark, rows), spark.createDataFrame([(make(a),) for _ in range(20)], "text string"))
    score = {r.doc_id: r.score for r in out.collect()}
    assert max(score[k] for k in range(1, 60, 2)) < min(score[k] for k in range(0, 60, 2))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert M.cross_entropy_difference(none, none).count() == 0
    out = M.cross_entropy_difference(documents(spark, awkward()), none).collect()
    assert len(out) == len(awkward())


def test_rare_words_and_pairs_count_at_any_corpus_size(spark, monkeypatch):
    """Scores by the definition, even if a share of the corpus were asked of words and pairs."""
    monkeypatch.setattr(M, "WORD_SHARE", 4, raising=False)
    monkeypatch.setattr(M, "PAIR_SHARE", 4, raising=False)
    rows = [(k, "common word " * 30 + f"rare{k} thing{k % 5} of its own rare{k}", "s") for k in range(40)]
    target = ["common word rare3 thing3", "thing1 of its own"]
    docs = documents(spark, rows).repartition(6)
    got = M.cross_entropy_difference(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    got = {r.doc_id: (r.target_bits, r.background_bits) for r in got.collect()}
    for (k, _, _), want in zip(rows, brute([t for _, t, _ in rows], target)):
        assert got[k] == pytest.approx(tuple(want), abs=1e-9)
