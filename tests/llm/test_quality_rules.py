import random
import re
from collections import Counter

import numpy as np

from reelhouse.llm import quality_rules as Q
from tests.llm.helpers import DOCS, awkward, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The five contract counts of one text, straight from their definitions."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(tri)
    inside = {p for i, t in enumerate(tri) if often[t] > 1 for p in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside))


def prose(rng, n):
    return " ".join(rng.choice(["river", "stone", "walk", "quiet", "morning", "light", "about", "again", "field"]) +
                    rng.choice(["", "s", "ed"]) + str(rng.choice(["", "", ".", ","])) for _ in range(n)) + "."


def corpus(seed=1):
    rng = random.Random(seed)
    good = [(k, "\n".join(prose(rng, 40) for _ in range(5)), "s") for k in range(200)]
    bad = [(1000 + k, re.sub(r"(\w) ", r"\1%%% ", prose(rng, 150)), "s") for k in range(15)]
    bad += [(1100 + k, re.sub(r" ", "!! ", prose(rng, 150)).upper(), "s") for k in range(15)]
    bad += [(1200 + k, prose(rng, 150).replace(" ", " | "), "s") for k in range(15)]
    return good, bad


def test_counts_equal_their_definitions(spark):
    rows = awkward() + [(100, "a b c a b c\na b c\n\na b c\n x \n x ", "s"), (101, "# * $ % & | < > é!\tx\x0by\x1cz", "s"),
                        (None, "x  y", None)]
    got = Q.verdicts(documents(spark, rows, extra=True)).collect()
    want = {i: brute(t) for i, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:6] == want[r.doc_id]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_clean_stays_and_junk_goes(spark):
    good, bad = corpus()
    kept = {r.doc_id for r in Q.verdicts(documents(spark, good + bad)).collect() if r.kept}
    assert kept == {i for i, _, _ in good}


def test_em_equals_a_plain_version():
    """The pattern form of EM against EM over single documents."""
    rng = np.random.default_rng(2)
    votes = rng.choice([-1, 0, 1], size=(300, len(Q.RULES)), p=[0.1, 0.2, 0.7])
    share, rates = Q.fit(sorted(Counter(map(tuple, votes.tolist())).items()))
    s, r = Q.PRIOR_GOOD, Q.PRIOR
    for _ in range(Q.ROUNDS):
        like = [np.prod([r[j][c][v[j] + 1] for j in range(len(Q.RULES))]) for v in votes for c in (0, 1)]
        like = np.array(like).reshape(-1, 2)
        p = s * like[:, 1] / (s * like[:, 1] + (1 - s) * like[:, 0])
        new = np.zeros_like(r)
        for j in range(len(Q.RULES)):
            for c, w, prior in ((0, 1 - p, 1 - Q.PRIOR_GOOD), (1, p, Q.PRIOR_GOOD)):
                n = np.array([w[votes[:, j] == x].sum() for x in (-1, 0, 1)]) + Q.PRIOR[j][c] * prior * Q.PRIOR_SHARE * 300
                new[j][c] = n / n.sum()
        s, r, done = (p.sum() + Q.PRIOR_SHARE * 300 * Q.PRIOR_GOOD) / (300 * (1 + Q.PRIOR_SHARE)), new, np.abs(new - r).max() < 1e-9
        if done:
            break
    assert np.allclose(r, rates, atol=1e-6) and abs(s - share) < 1e-6


def test_filter_keeps_rows_and_columns(spark):
    good, bad = corpus(3)
    docs = documents(spark, good + bad + awkward() + good[:1], extra=True)
    out = Q.keep_good(docs)
    keep = [r.doc_id for r in Q.verdicts(docs).collect() if r.kept]
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == sorted(keep)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert Q.verdicts(none).count() == 0 and Q.keep_good(none).count() == 0
