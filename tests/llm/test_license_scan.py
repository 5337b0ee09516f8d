import math
import random
import re

import pytest

from reelhouse.llm import license_scan as S
from tests.llm.helpers import DOCS, awkward, documents, sentence


def grams(text):
    w = [x for x in re.split("[^a-z0-9]+", text.lower()) if x]
    return set(w) | {f"{a} {b}" for a, b in zip(w, w[1:])}


def brute(model, text):
    """Every paragraph through the model, without triggers: (paragraph, family, probability, similarity)."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        g = grams(line)
        logit = list(model.bias)
        for x in g & set(model.weights):
            logit = [a + b for a, b in zip(logit, model.weights[x])]
        p = [math.exp(x) for x in logit]
        p = [x / sum(p) for x in p]
        top = max(p[1:])
        if top >= model.least and top > p[0]:
            family = S.FAMILIES[p[1:].index(top)]
            like = max(len(g & set(r["pairs"])) / len(r["pairs"]) for r in model.known if r["family"] == family)
            if like >= S.CONFIRM:
                out.append((i, family, top, like))
    return out


def corpus():
    rng = random.Random(1)
    rows = [(k, "\n".join(sentence(rng, 20, 300) + " the of and in a" for _ in range(4)), "s") for k in range(120)]
    for k, family in enumerate(S.FAMILIES):
        for n, notice in enumerate(S.NOTICES[family]):
            rows.append((1000 + 10 * k + n, rows[k][1] + "\n" + notice.upper() + "\n" + rows[k + 1][1], "s"))
    rows += [(2000, "The license plate of the car was found under the bridge.", "s"),
             (2001, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "s")]
    return rows + [(3000 + (i or 0), t, s) for i, t, s in awkward()] + [(None, "Released under the MIT License.", None)]


@pytest.fixture(scope="module")
def scanned(spark):
    rows = corpus() + corpus()[:1]
    docs = documents(spark, rows, extra=True)
    return rows, docs, S.Model(spark, docs), S.scan(docs).collect()


def test_families_are_found_and_other_text_is_unknown(scanned):
    rows, _, _, got = scanned
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for k, family in enumerate(S.FAMILIES):
        for n in range(len(S.NOTICES[family])):
            r = by[1000 + 10 * k + n]
            assert (r.family, r.paragraph, r.n_found, r.n_paragraphs) == (family, 4, 1, 9), (family, n, r)
    assert all(by[i].family == "unknown" and by[i].n_found == 0 for i in [*range(120), 2000, 3004, 3005, 3013])
    assert by[2001].families == "cc-by-nc-4.0,mit" and by[2001].n_found == 3 and by[None].family == "mit"


def test_equals_brute_force_over_all_paragraphs(scanned):
    rows, _, model, got = scanned
    text = {i: t for i, t, _ in rows}
    assert model.triggers
    for r in got:
        want = brute(model, text[r.doc_id])
        assert r.n_found == len(want) and r.families == ",".join(sorted({f for _, f, _, _ in want}))
        if want:
            best = max(want, key=lambda x: (round(x[2], 12), -x[0]))
            assert (r.paragraph, r.family) == best[:2] and r.probability == pytest.approx(best[2]) and r.similarity == pytest.approx(best[3])


def test_plan_has_no_python(scanned):
    _, docs, _, _ = scanned
    plan = S.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_empty_table(spark):
    assert S.scan(spark.createDataFrame([], DOCS)).count() == 0


WRAPPED = {
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy",
            "of this software and associated documentation files (the \"Software\"), to deal",
            "in the Software without restriction, including without limitation the rights",
            "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"],
    "bsd-3-clause": ["Redistribution and use in source and binary forms, with or without",
                     "modification, are permitted provided that the following conditions are met:"],
    "gpl-3.0": ["This program is free software: you can redistribute it and/or modify",
                "it under the terms of the GNU General Public License as published by",
                "the Free Software Foundation, either version 3 of the License, or",
                "(at your option) any later version."]}


def test_wrapped_notices_are_judged_whole(spark):
    rng = random.Random(3)
    rows = [r for r in corpus() if r[0] is not None and r[0] < 1000]
    want = {}
    for family, lines in WRAPPED.items():
        for mark in ("", "# ", " * ", "dnl "):
            i = 5000 + len(want)
            want[i] = family
            text = [sentence(rng, 12), mark.strip(), "Copyright 2020 Someone", mark.strip(), *[mark + x for x in lines], mark.strip(), "x = 1"]
            rows.append((i, "\n".join("" if x == "dnl" else x for x in text), "s"))
    # after a line that is a notice, without a blank line between
    rows.append((6000, "\n".join(["Released under the GNU LGPL v3.", *WRAPPED["mit"]]), "s"))
    got = {r.doc_id: r for r in S.scan(documents(spark, rows)).collect()}
    assert {i: (got[i].family, got[i].n_found, got[i].paragraph) for i in want} == {i: (f, 1, 4) for i, f in want.items()}
    assert got[6000].families == "lgpl-3.0,mit"
    assert all(r.family == "unknown" for i, r in got.items() if i < 1000)


def test_every_paragraph_is_trained_on(spark):
    """Counts of the model are those of all distinct paragraphs, lines and runs of lines alike."""
    rng = random.Random(7)
    rows = [(k, f"{sentence(rng, 9)} of {k}\n{sentence(rng, 9)} of {k}\n\n{sentence(rng, 9)} of {k}", "s") for k in range(500)]
    rows += [(500 + k, rows[k][1], "s") for k in range(50)] + [(900, "Released under the MIT License.", "s")]
    model = S.Model(spark, documents(spark, rows).select("doc_id", "text"))
    assert model.common["of"] == 4 * 500
