"""Licence scan: a trained paragraph classifier with an unknown class.

Paragraphs are bags of word 1- and 2-grams.  A paragraph is a line; lines that
are no notice by themselves are also judged together, from one line without a
letter or digit, or notice, to the next, so that notices wrapped over several
lines, or in comments, are seen whole.  A sparse multinomial
logistic regression over the n-grams of known notices tells licence families
apart and has a class of its own for anything else.  It is trained on the
notices and on the distinct paragraphs of all documents; held-back paragraphs
set the probability below which a prediction counts as unknown.  A prediction
is confirmed by comparing the paragraph with the family's notices (share of the
notice's 2-grams present).

Everything is DataFrame and SQL functions: a paragraph is trained on as the set of
its n-grams that notices have, equal sets are one row with their count, gradients
are aggregates over these rows, and scoring is one projection without a shuffle.  A document is looked
into only if it holds one of the words without which no paragraph can reach
any family (a bound on the weights, so nothing is missed).

Nothing is sampled: every paragraph of every document is trained on or held back,
and judged.

The place of a wrapped notice is its first line; n_paragraphs counts lines.

Edge cases: null or blank texts have 0 paragraphs and family 'unknown'; ties go
to the earlier paragraph; repeated rows get equal results; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEPS = 24
RATE = 4.0
SPARSE = 2e-4              # L1 weight: n-grams that do not help are exactly 0
LEAST = 0.5                # probability of a family, or more if held-back paragraphs ask for it
CONFIRM = 0.6              # share of a notice's 2-grams
UNKNOWN = "unknown"
WRITTEN = r"[\p{L}\p{N}]"
COMMENT = r"(?i)^[^\p{L}\p{N}]*(?:dnl|rem)\b"

# Short public licence notices by family.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd-3-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "Released under the GNU GPL v3.",
    ],
    "lgpl-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "Released under the GNU LGPL v3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "Licensed under the MIT License.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
}
FAMILIES = sorted(NOTICES)


def _words(p: str) -> str:
    return f"filter(split(lower({p}), '[^a-z0-9]+'), x -> x <> '')"


def _pairs(w: str) -> str:
    return f"if(size({w}) < 2, array(), transform(sequence(1, size({w}) - 1), i -> concat({w}[i - 1], ' ', {w}[i])))"


def _grams(w: str) -> str:
    """Distinct 1- and 2-grams of an array of words."""
    return f"array_distinct(concat({w}, {_pairs(w)}))"


def _known_grams(w: str, vocabulary: list[str]) -> str:
    """The distinct 1- and 2-grams of an array of words that are in a vocabulary, sorted."""
    def among(x: str, values) -> str:
        return f"{x} IN ({', '.join(map(_text, sorted(set(values))))})"
    pairs = [g.split(" ") for g in vocabulary if " " in g]
    some = (f"transform(IF(size({w}) < 2, array(), sequence(1, size({w}) - 1)), i -> IF({among(f'{w}[i - 1]', (a for a, _ in pairs))} "
            f"AND {among(f'{w}[i]', (b for _, b in pairs))}, concat({w}[i - 1], ' ', {w}[i]), NULL))")
    return f"sort_array(array_distinct(filter(concat({w}, {some}), x -> {among('x', vocabulary)})))"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(values: list[str]) -> str:
    return f"array({', '.join(values)})"


def _constant(value, kind: str) -> str:
    """A constant of a nested type: one string for the parser, folded once by the optimizer."""
    return f"from_json({_text(json.dumps(value))}, '{kind}')"


def _known(spark: SparkSession) -> DataFrame:
    """(family, notice, pairs): the 2-grams of each notice, distinct."""
    rows = ", ".join(f"({_text(f)}, {_text(n)})" for f in FAMILIES for n in NOTICES[f])
    return spark.sql(f"SELECT family, notice FROM VALUES {rows} AS t(family, notice)").withColumn(
        "w", F.expr(_words("notice"))).withColumn("pairs", F.expr(f"array_distinct({_pairs('w')})")).drop("w")


def _runs(text: str, found: str | None = None) -> str:
    """SQL of the runs of lines (i, p) of a text, parted by lines without a letter or digit and
    by the lines an array ``found`` names as its paragraphs."""
    blank = f"NOT rlike(x.p, {_text(WRITTEN)})"
    if found:
        blank += f" OR exists({found}, f -> f.paragraph = x.i)"
    runs = ("transform(sequence(0, size(c) - 2), k -> slice(l, c[k] + 2, c[k + 1] - c[k] - 1))")
    cuts = f"concat(array(-1), transform(filter(l, x -> {blank}), x -> x.i), array(size(l)))"
    runs = f"transform(array({cuts}), c -> {runs})[0]"
    return (f"filter(transform(array(transform(split({text}, '\n'), (p, i) -> struct(i AS i, p AS p))), l -> {runs})[0], "
            "r -> size(r) > 0)")


def _joined(run: str) -> str:
    """SQL of the text of a run of lines, without the words that mark comments."""
    return f"concat_ws(' ', transform({run}, x -> regexp_replace(x.p, {_text(COMMENT)}, ' ')))"


def _similarity(known: list, family: str | None = None) -> str:
    """SQL of the best share of a notice's 2-grams among an array ``grams``."""
    pairs = _constant([r["pairs"] for r in known if family in (None, r["family"])], "array<array<string>>")
    return f"array_max(transform({pairs}, t -> size(array_intersect(grams, t)) / CAST(size(t) AS DOUBLE)))"


class Model:
    """Weights by n-gram, one array a gram: UNKNOWN first, then FAMILIES."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        self.known = _known(spark).collect()             # the fixed notices
        self.classes = [UNKNOWN, *FAMILIES]
        self.bias = [0.0] * len(self.classes)
        self.weights: dict[str, list[float]] = {}
        self.least = LEAST
        self.common: dict[str, float] = {}
        self._train(spark, docs)
        self.triggers = self._triggers()

    # --- training

    def _examples(self, spark: SparkSession, docs: DataFrame) -> DataFrame:
        """(label, held, grams): the notices, and the distinct paragraphs of all documents labelled by
        their likeness to a notice.  ``held`` paragraphs are kept out of training."""
        near = f"array({', '.join(_similarity(self.known, f) for f in FAMILIES)})"
        label = f"transform(array({near}), n -> IF(array_max(n) >= {CONFIRM}D, CAST(array_position(n, array_max(n)) AS INT), 0))[0]"
        # with fewer 2-grams of notices a paragraph is like none
        least = min(math.ceil(CONFIRM * len(r["pairs"]) - 1e-9) for r in self.known)
        label = f"transform(array(x.grams), grams -> IF(size(filter(grams, g -> contains(g, ' '))) >= {least}, {label}, 0))[0]"
        notices = _known(spark).withColumn("w", F.expr(_words("notice")))
        vocabulary = notices.select(F.explode(F.expr(_grams("w"))).alias("g")).distinct().agg(F.sort_array(F.collect_set("g"))).first()[0]
        self.weights = {g: [0.0] * len(self.classes) for g in vocabulary}
        names = F.create_map(*[F.lit(x) for k, f in enumerate(FAMILIES, 1) for x in (f, k)])
        notices = notices.select(names[F.col("family")].alias("label"), F.lit(False).alias("held"),
                                 F.expr(_known_grams("w", vocabulary)).alias("grams"))
        grams = f"transform(array({_words('p')}), w -> {_known_grams('w', vocabulary)})[0]"
        runs = docs.select(F.explode(F.expr(_runs("text"))).alias("run")).select(
            F.size("run").alias("n"), F.expr(
                f"transform(IF(size(run) = 1, array(run[0].p), concat(transform(run, x -> x.p), array({_joined('run')}))), "
                f"p -> struct(xxhash64(p) AS one, xxhash64('', p) AS two, rlike(lower(p), '[a-z0-9]') AS written, {grams} AS grams))").alias("paras"))
        runs = runs.withColumn("paras", F.expr(
            f"transform(paras, x -> struct(x.one AS one, x.two AS two, x.written AS written, x.grams AS grams, {label} AS label))"))
        # the lines of a wrapped notice are no examples of other text
        lines = runs.select(F.explode(F.expr(
            "CASE WHEN exists(slice(paras, 1, n), x -> x.label > 0) THEN slice(paras, 1, n) "
            "WHEN paras[size(paras) - 1].label > 0 THEN slice(paras, -1, 1) ELSE paras END")).alias("x")).where("x.written")
        # paragraphs with two equal hashes are the same
        lines = lines.select("x.one", "x.two", "x.label", "x.grams").distinct()
        return lines.select("label", (F.pmod("one", F.lit(4)) == 0).alias("held"), "grams").unionByName(notices)

    def _train(self, spark: SparkSession, docs: DataFrame) -> None:
        """Proximal gradient steps; each is one aggregate over the examples.  Examples that look alike
        are one row with their count, and both notices and other text weigh half."""
        rows = self._examples(spark, docs).groupBy("label", "held", "grams").agg(F.count("*").cast("double").alias("n"))
        vocabulary = sorted(self.weights)
        place = F.expr(f"transform(grams, g -> CAST(array_position({_constant(vocabulary, 'array<string>')}, g) AS INT))")
        rows = rows.withColumn("at", place).persist()
        train = rows.where("not held")
        mass = {r["other"]: r["n"] for r in train.groupBy((F.col("label") == 0).alias("other")).agg(F.sum("n").alias("n")).collect()}
        share = F.when(F.col("label") == 0, 0.5 / max(mass.get(True, 0), 1)).otherwise(0.5 / max(mass.get(False, 0), 1))
        train = train.withColumn("mass", F.col("n") * share)
        k = len(self.classes)
        speed: dict[str, list[float]] = {}
        for _ in range(STEPS):
            p = train.withColumn("p", F.expr(self._softmax(self._logits_at(vocabulary))))
            wrong = [F.col("mass") * (F.col("p")[c] - (F.col("label") == c).cast("double")) for c in range(k)]
            each = p.select(F.explode(F.concat("grams", F.array(F.lit("")))).alias("g"), *[w.alias(f"e{c}") for c, w in enumerate(wrong)])
            step = each.groupBy("g").agg(*[F.sum(f"e{c}").alias(f"e{c}") for c in range(k)]).collect()
            for row in step:                             # at most one row for each n-gram of the notices
                grad = [row[f"e{c}"] for c in range(k)]
                fast = speed[row["g"]] = [0.8 * a - RATE * b for a, b in zip(speed.get(row["g"], [0.0] * k), grad)]
                if row["g"] == "":
                    self.bias = [a + b for a, b in zip(self.bias, fast)]
                else:
                    moved = [a + b for a, b in zip(self.weights[row["g"]], fast)]
                    self.weights[row["g"]] = [max(abs(x) - RATE * SPARSE, 0.0) * (1 if x > 0 else -1) for x in moved]
        held = rows.where("held and label = 0").withColumn("p", F.expr(self._softmax(self._logits_at(vocabulary))))
        worst = held.agg(F.max(F.expr(f"array_max(slice(p, 2, {k - 1}))"))).first()[0]
        self.least = min(max(LEAST, worst or 0.0), 0.95)
        self.weights = {g: w for g, w in self.weights.items() if any(w)}
        # how often other text uses a word: the fewer paragraphs a trigger opens, the better
        seen = rows.where("label = 0").select(F.explode("grams").alias("g"), "n").groupBy("g").agg(F.sum("n").alias("n"))
        self.common = {r["g"]: r["n"] for r in seen.collect()}
        rows.unpersist()

    # --- scoring

    def _logits(self, grams: str) -> str:
        start = _constant(self.bias, "array<double>")
        if not self.weights:
            return start
        weights = _constant(self.weights, "map<string, array<double>>")
        return (f"aggregate(array_intersect({grams}, map_keys({weights})), {start}, (acc, g) -> "
                f"zip_with(acc, element_at({weights}, g), (a, b) -> a + b))")

    def _logits_at(self, vocabulary: list[str]) -> str:
        """The same of an array ``at`` of places in the vocabulary (from 1)."""
        weights = _constant([self.weights[g] for g in vocabulary], "array<array<double>>")
        return f"aggregate(at, {_constant(self.bias, 'array<double>')}, (acc, k) -> zip_with(acc, {weights}[k - 1], (a, b) -> a + b))"

    def _probabilities(self, grams: str) -> str:
        return self._softmax(self._logits(grams))

    def _softmax(self, logits: str) -> str:
        exps = f"transform({logits}, x -> exp(x))"
        return (f"transform(array({exps}), e -> transform(e, x -> x / aggregate(e, 0D, (a, b) -> a + b)))[0]")

    def _triggers(self) -> list[str]:
        """Words one of which any paragraph needs to be given a family: for every family the words of
        its strongest n-grams are added until the rest cannot lift it over UNKNOWN."""
        words: set[str] = set()
        for c in range(1, len(self.classes)):
            gain = {g: w[c] - w[0] for g, w in self.weights.items() if w[c] > w[0]}
            while True:
                rest = {g: x for g, x in gain.items() if not set(g.split(" ")) & words}
                if self.bias[c] - self.bias[0] + sum(rest.values()) <= 0:
                    break
                if not rest:
                    return []                            # the bias alone decides: look into every paragraph
                by_word: dict[str, float] = {}
                for g, x in rest.items():
                    for w in g.split(" "):
                        by_word[w] = by_word.get(w, 0.0) + x
                words.add(max(sorted(by_word), key=lambda w: by_word[w] / (1 + self.common.get(w, 0.0) ** 2)))
        return sorted(words)

    def found(self, text: str) -> Column:
        """Array of (paragraph, family, probability, similarity) of the lines of a text that look like licences."""
        return F.expr(self._judged(text, f"transform(split({text}, '\\n'), (p, i) -> struct(i AS i, p AS p))"))

    def wrapped(self, text: str, found: str) -> Column:
        """The same of runs of several lines, none of which is in the array ``found``."""
        runs = f"filter({_runs(text, found)}, r -> size(r) > 1)"
        return F.expr(self._judged(text, f"transform({runs}, r -> struct(r[0].i AS i, {_joined('r')} AS p))"))

    def _judged(self, text: str, lines: str) -> str:
        trigger = r"(?i)(?<![a-z0-9])(?:" + "|".join(self.triggers) + r")(?![a-z0-9])" if self.triggers else ""
        has = lambda x: f"rlike({x}, {_text(trigger)})"
        grams = f"transform(filter({lines}, x -> {has('x.p')}), x -> struct(x.i AS i, {_words('x.p')} AS w))"
        grams = f"transform({grams}, x -> struct(x.i AS i, {_grams('x.w')} AS grams))"
        scored = f"transform({grams}, x -> struct(x.i AS i, x.grams AS grams, {self._probabilities('x.grams')} AS p))"
        best = f"transform({scored}, x -> struct(x.i AS i, x.grams AS grams, x.p AS p, array_max(slice(x.p, 2, {len(FAMILIES)})) AS top))"
        best = f"filter({best}, x -> x.top >= {self.least!r}D AND x.top > x.p[0])"
        names = _array([_text(f) for f in FAMILIES])
        named = (f"transform({best}, x -> struct(x.i AS i, x.grams AS grams, x.top AS top, "
                 f"{names}[CAST(array_position(slice(x.p, 2, {len(FAMILIES)}), x.top) AS INT) - 1] AS family))")
        like = "CASE x.family " + " ".join(
            f"WHEN {_text(f)} THEN {_similarity(self.known, f).replace('grams', 'x.grams')}" for f in FAMILIES) + " END"
        final = (f"transform({named}, x -> struct(CAST(x.i AS LONG) AS paragraph, x.family AS family, "
                 f"x.top AS probability, {like} AS similarity))")
        return f"CASE WHEN {has(text)} THEN {final} END"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, family, probability, similarity, paragraph, n_found, families of every
    document: its most certain confirmed licence paragraph, and how many there are."""
    model = Model(docs.sparkSession, docs.select("doc_id", "text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_paragraphs", F.expr("CAST(size(filter(split(text, '\\n'), p -> trim(p) <> '')) AS LONG)"))
    confirmed = lambda x: x["similarity"] >= CONFIRM
    rows = rows.withColumn("found", F.filter(model.found("text"), confirmed))
    rows = rows.withColumn("found", F.concat("found", F.filter(model.wrapped("text", "found"), confirmed)))
    best = F.expr("array_max(transform(found, x -> struct(x.probability AS probability, -x.paragraph AS place, "
                  "x.family AS family, x.similarity AS similarity)))")
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc_id", "n_paragraphs", F.coalesce("best.family", F.lit(UNKNOWN)).alias("family"),
        F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity"),
        (-F.col("best.place")).alias("paragraph"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_found"),
        F.concat_ws(",", F.sort_array(F.array_distinct(F.col("found.family")))).alias("families"))
