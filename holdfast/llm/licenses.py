"""Licence scan: a trained paragraph classifier, confirmed by templates.

Method. Every line of every whole text is a paragraph; one of more than ``LONG`` words is read in windows of ``LONG`` words that
overlap by half, so a notice inside it is not diluted. A multinomial logistic regression with a lasso penalty on word n-grams (one
to three words) gives the probability of each licence family, of ``OTHER`` (a licence of no family that the model knows) and of
``UNKNOWN`` (no licence). It is trained on notices made from the families' names, forms of words and standard sentences, on the same
forms around made-up names, and on at most ``NEGATIVES`` paragraphs of the corpus (those with the lowest hashes that resemble no
template). Two curves are calibrated on forms and names that training has not seen: the probability of any licence, and the
probability that the best family is the right one. A family whose own probability is below ``FLOOR`` is reported as ``OTHER``.
A family is confirmed if the paragraph holds a name of it in full, or covers enough of the word pairs of one of its templates
and the family's name wherever that template has it. ``OTHER`` is never confirmed.

Only n-grams with a weight matter. ``LicenceModel.triggers`` are words without which no paragraph can be a licence: the weights that
speak for a licence in all n-grams free of them do not outweigh the intercept, however often these words meet. Paragraphs without a trigger
are not scored, which loses nothing. All paragraphs are looked at.

Defined results: null and empty texts have no licence. Repeated rows give repeated results; a document gives a row per paragraph
that names a licence, so one document may give several. Other columns are ignored. If the corpus is empty the model is trained on
the fixed sentences alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = 40
NEGATIVES = 3000
PENALTY = 0.001
CONFIRMED = 0.6  # share of a template's word pairs
FLOOR = 0.5  # probability of the family itself
OTHER = "other"
UNKNOWN = "unknown"

# Names, usual forms of notices and standard sentences of public licences.
NAMES = {
    "MIT": ["MIT License", "MIT licence", "MIT", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 License", "Apache Software License 2.0"],
    "GPL": ["GNU General Public License, version 3", "GNU General Public License", "GNU GPL", "GPL-3.0", "GPLv3", "GPLv2", "GNU General Public License, version 2", "GPL-2.0-or-later"],
    "LGPL": ["GNU Lesser General Public License", "LGPL-2.1", "LGPLv3", "GNU Lesser General Public License, version 3", "GNU LGPL"],
    "AGPL": ["GNU Affero General Public License", "AGPL-3.0", "AGPLv3", "GNU Affero General Public License, version 3", "GNU AGPL"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "New BSD License"],
    "MPL": ["Mozilla Public License, version 2.0", "Mozilla Public License", "MPL-2.0", "MPL 2.0"],
    "CC-BY": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "Creative Commons Attribution License", "CC BY 3.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0", "CC BY-SA 3.0"],
    "CC-BY-NC": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0", "CC BY-NC 3.0"],
    "CC0": ["CC0 1.0 Universal", "CC0", "CC0-1.0", "Creative Commons Zero"],
    "ISC": ["ISC License", "ISC"],
    "EPL": ["Eclipse Public License", "EPL-2.0", "Eclipse Public License 2.0"],
}
FORMS = [
    "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.", "This work is licensed under the {}.",
    "This work is licensed under {}.", "This software is distributed under the terms of the {}.", "Available under the {}.", "This project uses the {}.",
    "SPDX-License-Identifier: {}", "Distributed under the {}. See LICENSE for details.", "The content of this page is published under the {}.",
    "This file is covered by the {}.", "License: {}", "You may use this text under the terms of the {}.",
]
SENTENCES = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
    ],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    ],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY": ["You are free to share and adapt the material as long as you give appropriate credit under the Creative Commons Attribution license"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License"],
}
#: Shapes of the names of licences; made-up words, initials and numbers fill them.
SHAPES = [
    "{w} License", "{w} Licence", "{w} Public License", "{w} {v} License", "{w} Software License, Version {n}.{m}", "{w} {v} License, Version {n}.{m}",
    "{w} Open License {n}.{m}", "{w} Commercial License", "{w} {v} Public License {n}.{m}", "{w} General License", "{i}", "{i} License", "{i}-{n}.{m}", "{i} {n}.{m}",
    "{i}v{n}", "terms of the {w} {v} License", "{w} Community License Agreement", "{w} Free Documentation License", "{w} {v} International License",
]
#: Sentences with the words of licences that are none.
OTHERS = [
    "All rights reserved.", "Her driving license expired in May.", "The committee granted permission to use the hall.", "Apache helicopters flew over the valley.",
    "Researchers at MIT published the results.", "The public was free to attend the general meeting.", "This work is based on earlier research.",
    "The software was released under great pressure.", "Available in all good shops.", "The terms of the contract were never published.",
    "The version 2.0 update was released in March.", "He is licensed to practice medicine.", "The creative commons room is on the second floor.",
    "The project is distributed over three sites.", "See the file for details.", "GNU are large antelopes.", "You may use this room.", "Version 3.",
    "The BSD conference was held in Berlin.", "Contact us about commercial terms and attribution.", "Eclipse watchers met at the public library.",
    "Mozilla released a new browser version.", "The license fee is due.", "This page is published by the city.", "Subject to change without notice.",
]


def words_of(text: str) -> list[str]:
    return re.findall(r"\w+", text.lower())


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all n-grams of one to three words, and the word at which each starts."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, " ".join(words).encode().split(b" ")), np.uint64, count=len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ one[1:]
    three = (two[:-1] * np.uint64(0xBF58476D1CE4E5B9)) ^ one[2:]
    n = len(words)
    return np.concatenate([one, two, three]), np.concatenate([np.arange(n), np.arange(n - 1), np.arange(max(0, n - 2))])


def templates() -> dict[str, list[str]]:
    return {f: [form.format(n) for n in names for form in FORMS] + SENTENCES.get(f, []) for f, names in NAMES.items()}


def _pairs(text: str) -> frozenset[tuple[str, str]]:
    words = words_of(text)
    return frozenset(zip(words, words[1:]))


def _holds(words: list[str], name: list[str]) -> bool:
    """Whether the words of ``name`` follow each other in ``words``."""
    n = len(name)
    return any(words[k : k + n] == name for k in range(len(words) - n + 1))


class Confirmer:
    """Compares paragraphs with the templates of a family.

    A name of several words confirms by itself, in full. A form of words around a name of one word, or a standard sentence,
    confirms if enough of its word pairs are covered; a name of the family that it has must then be in the paragraph too."""

    def __init__(self):
        self.names: dict[str, list[list[str]]] = {}
        self.templates: dict[str, list[tuple[frozenset, list[list[str]]]]] = {}
        for family, names in NAMES.items():
            split = [words_of(n) for n in names]
            single = [n for n in names if len(words_of(n)) == 1]
            texts = [form.format(n) for n in single for form in FORMS] + SENTENCES.get(family, [])
            self.names[family] = [n for n in split if len(n) > 1]
            self.templates[family] = [(p, [n for n in split if _holds(words_of(t), n)]) for t in texts if (p := _pairs(t))]

    def cover(self, family: str, text: str) -> float:
        return self.compare(family, words_of(text))[0]

    def compare(self, family: str, words: list[str]) -> tuple[float, bool]:
        """Share of the best template's word pairs that the paragraph covers, and whether it confirms the family."""
        if any(_holds(words, name) for name in self.names.get(family, ())):
            return 1.0, True
        mine = frozenset(zip(words, words[1:]))
        best, confirmed = 0.0, False
        for pairs, names in self.templates.get(family, ()):
            share = len(pairs & mine) / len(pairs)
            best = max(best, share)
            # a name of one word counts where a pair of the template has it, not anywhere in the paragraph
            named = not names or any(_holds(words, n) if len(n) > 1 else any(n[0] in p for p in pairs & mine) for n in names)
            confirmed |= share >= CONFIRMED and named
        return best, confirmed


@dataclass
class LicenceModel:
    families: list[str]  # the last two are OTHER and UNKNOWN
    known: np.ndarray  # sorted n-gram hashes with a weight
    weights: np.ndarray  # n-gram x family
    intercepts: np.ndarray
    calibration: tuple[float, float]  # slope and offset on the log odds of any licence
    own: tuple[float, float] = (1.0, 0.0)  # the same on the log odds of the best family among licences
    triggers: frozenset[str] = field(default_factory=frozenset)  # every licence has one of these words

    def judge(self, words: list[str]) -> tuple[str, float]:
        """Family and its calibrated probability (for OTHER and UNKNOWN, of any licence)."""
        some, best, own = self.odds(np.unique(grams_of(words)[0]))
        some = _curve(self.calibration, some)
        if some <= 0.5:
            return UNKNOWN, some
        p = some * _curve(self.own, own)
        if self.families[best] == OTHER or p < FLOOR:
            return OTHER, some
        return self.families[best], p

    def odds(self, grams: np.ndarray) -> tuple[float, int, float]:
        """Log odds of any licence, the best licence class, and its log odds among the licences."""
        at = np.searchsorted(self.known, grams).clip(max=max(0, len(self.known) - 1))
        at = at[self.known[at] == grams] if len(self.known) else at[:0]
        z = self.intercepts + self.weights[at].sum(axis=0)
        best = int(z[:-1].argmax())
        rest = np.delete(z[:-1], best)
        return float(_log_sum(z[:-1]) - z[-1]), best, float(z[best] - _log_sum(rest))

    def scan(self, text: str, confirmer: Confirmer) -> list[tuple[int, str, float, float, bool]]:
        """(paragraph, family, probability, cover, confirmed) of the paragraphs that name a licence; the best window of each."""
        if self.triggers.isdisjoint(words_of(text)):
            return []
        found = []
        for number, paragraph in enumerate(text.split("\n")):
            words = words_of(paragraph)
            if self.triggers.isdisjoint(words):
                continue
            best = None
            step = LONG // 2
            first = range(0, max(1, len(words) - step), step) if len(words) > LONG else [0]
            for lo in first:
                part = words[lo : lo + LONG]
                if self.triggers.isdisjoint(part):
                    continue
                family, p = self.judge(part)
                if family != UNKNOWN:
                    cover, confirmed = confirmer.compare(family, part)
                    best = max(best or (False, False, 0.0, "", 0.0), (confirmed, family != OTHER, p, family, cover))
            if best:
                found.append((number, best[3], best[2], best[4], best[0]))
        return found

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as two Parquet tables, n-grams with weights and the rest."""
        grams = [(int(g), w.tolist()) for g, w in zip(self.known.view(np.int64), self.weights)]
        spark.createDataFrame(grams, "gram long, weights array<double>").coalesce(1).write.parquet(f"{path}/grams")
        rest = [(self.families, self.intercepts.tolist(), list(self.calibration), list(self.own), sorted(self.triggers))]
        schema = "families array<string>, intercepts array<double>, calibration array<double>, own array<double>, triggers array<string>"
        spark.createDataFrame(rest, schema).coalesce(1).write.parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LicenceModel:
        m = spark.read.parquet(f"{path}/model").first()
        rows = spark.read.parquet(f"{path}/grams").collect()
        known = np.array([r.gram for r in rows], np.int64).view(np.uint64)
        weights = np.array([r.weights for r in rows]).reshape(len(rows), len(m.families))
        order = np.argsort(known)
        return LicenceModel(m.families, known[order], weights[order], np.array(m.intercepts), tuple(m.calibration), tuple(m.own), frozenset(m.triggers))


def _log_sum(z: np.ndarray) -> float:
    return float(z.max() + np.log(np.exp(z - z.max()).sum()))


def _curve(line: tuple[float, float], log_odds: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(line[0] * log_odds + line[1], -500, 500))))


def negatives(docs: DataFrame, most: int = NEGATIVES) -> list[str]:
    """At most ``most`` distinct paragraphs of the corpus, those with the lowest hashes, cut to ``LONG`` words."""
    lines = docs.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("line")).where("line <> ''")
    keyed = lines.select(F.xxhash64("line").alias("h"), "line")
    different = keyed.agg(F.approx_count_distinct("h")).first()[0]
    lowest = int(-(2**63) + 2**64 * min(1.0, 2 * most / max(1, different))) - 1  # about twice as many as are needed
    chosen = keyed.where(F.col("h") <= lowest).groupBy("h").agg(F.min("line").alias("line")).orderBy("h").limit(most)
    words = F.regexp_extract_all(F.lower("line"), F.lit(r"(?U)(\w+)"), F.lit(1))
    return [r.line for r in chosen.select(F.concat_ws(" ", F.slice(words, 1, LONG)).alias("line")).collect()]


def _calibrated(log_odds: np.ndarray, licence: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-out rows, with one virtual row of each class."""
    x = np.column_stack([np.append(log_odds, [0, 0]), np.ones(len(log_odds) + 2)])
    y, b = np.append(licence, [0, 1]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ b)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), x.T @ (y - p) - 1e-2 * (b - [1, 0]))
        b = b + step.clip(-1, 1)
    return float(max(b[0], 0.1)), float(b[1])


def made_names(words: list[str], count: int) -> list[str]:
    """``count`` names of licences that do not exist, from ``words`` and initials; the same for the same words."""
    rng = np.random.default_rng(7)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    taken = {w for names in NAMES.values() for n in names for w in words_of(n)}
    words = sorted(w for w in set(words) - taken if w.isalpha()) or ["acme"]
    names = []
    for k in range(count):
        w, v = (words[j].capitalize() for j in rng.integers(0, len(words), 2))
        initials = "".join(rng.choice(letters, rng.integers(2, 6))) + "PL"[: rng.integers(0, 3)]
        names.append(SHAPES[k % len(SHAPES)].format(w=w, v=v, i=initials, n=rng.integers(1, 5), m=rng.integers(0, 4)))
    return [n for n in names if not taken & {words_of(n)[0]}]


def _notices(names: list[str]) -> list[tuple[int, str]]:
    """Notices of all names in all forms, each with the number of its form."""
    return [(k, form.format(n)) for n in names for k, form in enumerate(FORMS)]


def train(spark: SparkSession, corpus: list[str], made: int = 190) -> LicenceModel:
    """Fit on the templates, ``made`` made-up names and ``corpus`` paragraphs. Every fifth form of words, made-up name and paragraph is
    left for the calibration, so that it sees notices that are worded or named as none of the training rows."""
    families = [*NAMES, OTHER, UNKNOWN]
    other, unknown = len(families) - 2, len(families) - 1
    rows: list[tuple[int, list[str], bool]] = []  # class, words, whether held for the calibration
    for family, names in NAMES.items():
        rows += [(families.index(family), words_of(t), k % 5 == 4) for k, t in _notices(names)]
        rows += [(families.index(family), words_of(n), False) for n in names if len(words_of(n)) > 1]
    # standard sentences are few beside the notices, and often only partly on a line
    for family, texts in SENTENCES.items():
        for words in map(words_of, texts):
            half = len(words) // 2
            rows += [(families.index(family), part, False) for part in (words, words[:half], words[half:]) for _ in range(6)]
    around = [words_of(t)[:12] for t in corpus]
    invented = made_names([w for words in around or map(words_of, OTHERS) for w in words], made)
    for n, name in enumerate(invented):
        # a few forms a name: names differ more than forms do
        rows += [(other, words_of(t), n % 5 == 4) for k, t in _notices([name]) if (k + n) % 3 == 0 and (n % 5 == 4) == (k % 5 == 4)]
    # a notice may share its line with other words
    rows += [(k, w + around[n % len(around)], h) for n, (k, w, h) in enumerate(rows) if around and n % 3 == 0]
    confirmer = Confirmer()
    clean = [t for t in corpus if not any(confirmer.cover(f, t) >= 0.5 for f in NAMES)]
    rows += [(unknown, words_of(t), n % 5 == 4) for n, t in enumerate(clean)] + [(unknown, words_of(t), False) for t in OTHERS for _ in range(5)]
    grams = [np.unique(grams_of(w)[0]) for _, w, _ in rows]
    # n-grams of a single row (made-up names, words around a notice) could only be learnt by heart
    seen, times = np.unique(np.concatenate([g for (k, _, h), g in zip(rows, grams) if k != unknown and not h]), return_counts=True)
    vocabulary = np.unique(np.concatenate([seen[times > 1], *(np.unique(grams_of(words_of(t))[0]) for t in OTHERS)]))

    def vector(g: np.ndarray):
        at = np.searchsorted(vocabulary, g).clip(max=len(vocabulary) - 1)
        at = np.unique(at[vocabulary[at] == g])
        return Vectors.sparse(len(vocabulary), at.tolist(), [1.0] * len(at))

    data = [(float(k), vector(g)) for (k, _, h), g in zip(rows, grams) if not h]
    frame = spark.createDataFrame(data, ["label", "features"])
    fitted = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False).fit(frame.coalesce(1))
    weights = fitted.coefficientMatrix.toArray().T
    used = np.flatnonzero(weights.any(axis=1))
    model = LicenceModel(families, vocabulary[used], weights[used], fitted.interceptVector.toArray(), (1.0, 0.0))
    held = [(k, *model.odds(g)) for (k, _, h), g in zip(rows, grams) if h]
    model.calibration = _calibrated(np.array([x[1] for x in held]), np.array([x[0] != unknown for x in held], float))
    licences = [x for x in held if x[0] != unknown]
    model.own = _calibrated(np.array([x[3] for x in licences]), np.array([x[2] == x[0] for x in licences], float))
    model.triggers = _triggers(model, [w for _, w, _ in rows], [words_of(t) for t in clean])
    return model


def _triggers(model: LicenceModel, rows: list[list[str]], corpus: list[list[str]]) -> frozenset[str]:
    """Words of which each licence has one. The most common words of the corpus are left out one by one, as long as all n-grams
    made of such words alone cannot together lift a paragraph over the bound: each counts with the most that it can add to a
    licence class against UNKNOWN, and those that speak against a licence count nothing."""
    gain = dict(zip(model.known.tolist(), (model.weights[:, :-1] - model.weights[:, -1:]).max(axis=1).clip(min=0).tolist()))
    parts: dict[int, frozenset[str]] = {}
    for words in rows:
        for n in (1, 2, 3):
            for k in range(len(words) - n + 1):
                piece = words[k : k + n]
                h = int(grams_of(piece)[0][-1])  # the longest n-gram comes last
                if h in gain and h not in parts:
                    parts[h] = frozenset(piece)
    vocabulary = {w for words in parts.values() for w in words}
    common: dict[str, int] = dict.fromkeys(vocabulary, 0)
    for words in corpus:
        for w in vocabulary.intersection(words):
            common[w] += 1
    slope, offset = model.calibration
    z = model.intercepts[:-1] - model.intercepts[-1]
    room = -offset / slope - _log_sum(z)  # gains below this leave any licence at 0.5 or less
    free: set[str] = set()
    for word in sorted(vocabulary, key=lambda w: (-common[w], w)):
        if sum(gain[h] for h, words in parts.items() if words <= free | {word}) < room:
            free.add(word)
    return frozenset(vocabulary - free)


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("cover", pa.float64()), ("confirmed", pa.bool_())]
)


def scan(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """(doc_id, paragraph, family, probability, cover, confirmed) per paragraph of ``docs`` that names a licence."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or train(spark, negatives(docs)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        confirmer = Confirmer()
        for batch in batches:
            out: list[list] = [[] for _ in _FOUND]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in shared.value.scan(text or "", confirmer):
                    for column, x in zip(out, (doc, *row)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FOUND)], schema=_FOUND)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(look, "doc_id long, paragraph int, family string, probability double, cover double, confirmed boolean")
