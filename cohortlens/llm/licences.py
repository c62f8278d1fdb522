"""Licence notices by a trained paragraph classifier, with DataFrame functions only on the corpus.

A sparse multinomial logistic regression over word 1- to 3-grams is fitted on the driver to variants of short templates of
each family and to a bounded sample of corpus paragraphs as the class ``other``. Its weights become a small table; the
n-grams of paragraphs that hold any weighted n-gram are joined to it and summed. A temperature fitted to held-out variants
calibrates the probabilities. A paragraph that looks like a licence, but whose best family stays below the threshold,
is ``unknown``. A prediction is confirmed if the paragraph holds enough of the n-grams of one of the family's templates.
"""

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The usual short notices of each family.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"],
    "MIT": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Licensed under the BSD 3-Clause License"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Licensed under the GNU General Public License, version 2 or later"],
    "LGPL": ["licensed under the GNU Lesser General Public License, version 2.1",
             "you can redistribute it under the terms of the GNU Lesser General Public License"],
    "AGPL": ["licensed under the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "CC-BY": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0": ["dedicated to the public domain under CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright"],
    "reserved": ["All rights reserved. No part of this publication may be reproduced without prior written permission",
                 "Copyright. All rights reserved"],
}
# Notices that speak of a licence and name none of the families.
GENERAL = ["Licensed under the terms of the accompanying agreement", "This work is distributed under a license", "See the license file for details",
           "use is subject to license terms", "Released under a custom license"]
OTHER, UNKNOWN = "other", "unknown"
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
SAMPLE = 3000            # different corpus paragraphs in training at most, those with the smallest hash
LONGEST = 16 << 10       # bytes of a paragraph in training at most; longer ones are not taken
FILLERS = 4000           # words that surround variants of templates, from the paragraphs in training
PENALTY, STEPS, LEAST = 0.0005, 200, 0.05
THRESHOLD, SIMILAR = 0.5, 0.6
PIECES = 16              # the rows of one text meet in as many tasks


def grams_of(text: str) -> set[str]:
    words = re.findall(TOKEN, text.lower())
    return {" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def grams(paragraph: Column) -> Column:
    """The distinct word 1- to 3-grams of a paragraph."""
    words = F.regexp_extract_all(F.lower(paragraph), F.lit(TOKEN), F.lit(0))

    def of(n: int) -> Column:
        return F.when(F.size(words) >= n, F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))),
            lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(of(1), of(2), of(3)))


@dataclass
class LicenceModel:
    classes: list[str]
    bias: list[float]
    weights: dict[str, list[float]]
    temperature: float

    def pattern(self) -> str:
        """Finds every lower-cased paragraph with a weighted n-gram: the weighted words, and the longer ones that hold none."""
        grams = sorted(self.weights)
        alone = {g for g in grams if " " not in g}
        needed = sorted({g for g in grams if not alone & set(g.split())})      # others hold a weighted word
        words = [re.escape(g).replace("\\ ", r"[^a-z0-9\n]+") for g in sorted(alone) + needed]
        return r"(?<![a-z0-9])(?:" + "|".join(words) + r")(?![a-z0-9])"


def _variants(text: str, filler: list[str], rng, n: int) -> list[str]:
    words, out = text.split(), [text]
    for _ in range(n):
        a, z = rng.integers(0, max(1, len(words) // 4)), len(words) - rng.integers(0, max(1, len(words) // 4))
        extra = [str(w) for w in rng.choice(filler, size=rng.integers(0, 12))] if filler else []
        cut = int(rng.integers(0, len(extra) + 1))
        out.append(" ".join([*extra[:cut], *words[a:z], *extra[cut:]]))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(paragraphs: list[str], seed: int = 5) -> LicenceModel:
    """Fit to variants of the templates and to corpus paragraphs that share no 3-gram with a template."""
    rng = np.random.default_rng(seed)
    known = {g for ts in [*TEMPLATES.values(), GENERAL] for t in ts for g in grams_of(t) if g.count(" ") == 2}
    plain = sorted(p for p in paragraphs if not known & grams_of(p))
    filler = sorted({w for p in plain for w in p.split()})
    filler = [str(w) for w in rng.choice(filler, size=FILLERS, replace=False)] if len(filler) > FILLERS else filler
    classes = [*TEMPLATES, UNKNOWN, OTHER]
    rows, y = [], []
    for k, name in enumerate(classes[:-1]):
        for t in TEMPLATES.get(name, GENERAL):
            v = _variants(t, filler, rng, 24)
            rows += v
            y += [k] * len(v)
    rows += plain or ["nothing of the kind"]
    y += [len(classes) - 1] * max(1, len(plain))
    bags, y = [grams_of(r) for r in rows], np.array(y)
    # Only n-grams of templates can speak for a family, and only those that plain paragraphs do not use.
    common = set().union(*map(grams_of, plain)) if plain else set()
    terms = sorted({g for ts in [*TEMPLATES.values(), GENERAL] for t in ts for g in grams_of(t)} - common)
    place = {g: i for i, g in enumerate(terms)}
    x = np.zeros((len(rows), len(terms) + 1))
    for i, bag in enumerate(bags):
        x[i, [place[g] for g in bag if g in place]] = 1
    x[:, -1] = 1
    hold = rng.random(len(rows)) < 0.2
    weight = 1 / np.bincount(y, minlength=len(classes))[y]
    target = np.eye(len(classes))[y]

    def solve(use: np.ndarray) -> np.ndarray:
        xs, ts, ws = x[use], target[use], (weight[use] / weight[use].sum())[:, None]
        step = 1 / max(np.linalg.norm(xs * np.sqrt(ws), 2) ** 2, 1e-9)
        w = z = np.zeros((x.shape[1], len(classes)))
        t = 1.0
        for _ in range(STEPS):
            new = z - step * (xs.T @ (ws * (_softmax(xs @ z) - ts)))
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * PENALTY, 0)
            after = (1 + (1 + 4 * t * t) ** 0.5) / 2
            z, w, t = new + (t - 1) / after * (new - w), new, after
        return w
    first = solve(~hold)
    logits = x[hold] @ first
    loss = {t: -np.mean(np.log(_softmax(logits / t)[np.arange(hold.sum()), y[hold]] + 1e-12)) for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0)}
    w = solve(np.ones(len(rows), bool))
    kept = {g: w[i].tolist() for g, i in place.items() if np.abs(w[i]).max() >= LEAST}
    return LicenceModel(classes, w[-1].tolist(), kept, min(loss, key=loss.get))


def paragraphs_of(docs: DataFrame, key: list[str], text: str) -> DataFrame:
    return docs.select(*key, F.posexplode(F.split(F.col(text), "\n")).alias("place", "paragraph"))


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, longest: int = LONGEST) -> LicenceModel:
    """Fit with at most ``sample`` different paragraphs of the corpus beside the templates, none of more than ``longest`` bytes.

    Both are documented bounds of training alone. The paragraphs of the smallest hashes are taken, whole; a cut-off from their
    counted number leaves few for the final choice.
    """
    rows = (docs.select(F.explode(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")).alias("p"))
            .where((F.col("p") != "") & (F.octet_length("p") <= longest)).select("p", F.xxhash64("p").alias("h")))
    different = rows.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    if different > 2 * sample:       # twice the share, so that the estimate's error can't leave too few
        rows = rows.where(F.col("h") < int(-2**63 + 2**64 * (2 * sample / different)))
    return fit([r.p for r in rows.distinct().orderBy("h", "p").limit(sample).toLocalIterator()])


def scan(docs: DataFrame, model: LicenceModel, id_column: str = "doc_id", text: str = "text",
         threshold: float = THRESHOLD, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, family, probability, similarity, confirmed, n_notices) for every row of ``docs``.

    ``family`` is that of the document's best notice (confirmed ones first, then by probability, of 9 digits so that the order of a
    sum can't decide, then by similarity), ``unknown``, or ``none`` for a
    document without notices; a missing or empty text has none. ``n_notices`` counts its paragraphs that are notices. Each row
    is judged by its own text, also when rows share an id or have none: what is found is a matter of the text alone, so
    texts of a weighted n-gram are judged once each, by two hashes of 64 bits, and rows join by them. Other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    pattern = model.pattern()
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    own = [F.xxhash64("text").alias("_h"), F.xxhash64(F.lit(7), "text").alias("_h2")]
    # Rows without text match nothing; a null keeps them from meeting under one key.
    marked = rows.select("doc_id", *[F.when(F.col("text") != "", h).alias(n) for h, n in zip(own, ("_h", "_h2"))])
    texts = rows.where(F.lower("text").rlike(pattern)).select("text", *own)
    found = (paragraphs_of(texts, ["_h", "_h2"], "text").where(F.lower("paragraph").rlike(pattern))
             .dropDuplicates(["_h", "_h2", "place"]).select("_h", "_h2", "place", grams(F.col("paragraph")).alias("grams")))
    table = spark.createDataFrame([(g, [float(v) for v in w]) for g, w in model.weights.items()], "gram string, w array<double>")
    key = ["_h", "_h2", "place"]
    # The table is bounded by the templates. One row per n-gram of a notice, summed by class.
    sums = (found.select(*key, F.explode("grams").alias("gram")).join(F.broadcast(table), "gram")
            .groupBy(*key).agg(F.array(*[F.sum(F.element_at("w", i + 1)) for i in range(len(model.classes))]).alias("s"),
                               F.collect_set("gram").alias("held")))
    k, bias = len(model.classes), F.array(*[F.lit(b) for b in model.bias])
    logits = sums.select(*key, "held", F.zip_with("s", bias, lambda x, b: (x + b) / F.lit(model.temperature)).alias("logits"))
    raised = logits.select(*key, "held", F.transform("logits", lambda v: F.exp(v - F.array_max("logits"))).alias("raised"))
    scored = raised.select(*key, "held", F.transform(
        "raised", lambda v: v / F.aggregate("raised", F.lit(0.0), lambda t, r: t + r)).alias("p"))
    families = F.array(*[F.lit(c) for c in model.classes[:-2]])
    best = F.array_max(F.slice("p", 1, k - 2))
    at = F.array_position(F.col("p"), best)
    judged = (scored.withColumn("best", best)
              .withColumn("family", F.when((best >= threshold) & (at <= k - 2), F.element_at(families, F.least(at, F.lit(k - 2)).cast("int")))
                          .when(F.element_at("p", k) < 1 - threshold, UNKNOWN).otherwise(OTHER))
              .where(F.col("family") != OTHER))
    parts = F.create_map(*[c for name, ts in TEMPLATES.items() for c in (
        F.lit(name), F.array(*[F.array(*[F.lit(g) for g in sorted(grams_of(t) & model.weights.keys())]).cast("array<string>") for t in ts]))])
    compared = judged.withColumn("similarity", F.coalesce(F.array_max(F.transform(
        F.try_element_at(parts, F.col("family")),
        lambda t: F.try_divide(F.size(F.array_intersect(F.col("held"), t)), F.size(t)))), F.lit(0.0)))
    notice = F.struct((F.col("similarity") >= similar).alias("confirmed"), F.round("best", 9).alias("probability"), "similarity", "family")
    per_text = compared.groupBy("_h", "_h2").agg(F.max(notice).alias("n"), F.count(F.lit(1)).alias("n_notices"))
    return (_joined(marked, per_text)
            .select("doc_id", F.coalesce("n.family", F.lit("none")).alias("family"), F.coalesce("n.probability", F.lit(0.0)).alias("probability"),
                    F.coalesce("n.similarity", F.lit(0.0)).alias("similarity"), F.coalesce("n.confirmed", F.lit(False)).alias("confirmed"),
                    F.coalesce("n_notices", F.lit(0)).alias("n_notices")))


def _joined(rows: DataFrame, per_text: DataFrame) -> DataFrame:
    """Every row with what its text has; a text may belong to any share of the rows, so these are dealt to PIECES salts."""
    salted = rows.withColumn("_salt", F.pmod(F.coalesce(F.xxhash64("doc_id", "_h"), F.lit(0)), F.lit(PIECES)).cast("int"))
    copies = per_text.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    return salted.join(copies, ["_h", "_h2", "_salt"], "left")
