import re

import pytest

from holdfast.llm import licenses
from holdfast.llm.common import table

NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
}


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "/root/testdata/sf0.1", "documents")


@pytest.fixture(scope="module")
def model(spark, docs):
    return licenses.train(spark, licenses.negatives(docs))


def test_sample_is_bounded_and_repeatable(docs):
    a = licenses.negatives(docs, 50)
    assert len(a) == 50 and a == licenses.negatives(docs.repartition(3), 50)


def test_corpus_against_brute_force(docs, model):
    """Every line of the corpus that is one of the notices is found with its family, and no other paragraph is confirmed."""
    got = {(r.doc_id, r.paragraph): r for r in licenses.scan(docs, model).collect()}
    want = {}
    for r in docs.collect():
        for k, line in enumerate(r.text.split("\n")):
            family = NOTICES.get(line)
            if family:
                want[r.doc_id, k] = family
    assert len(want) > 100
    found = {k: got[k].family for k in want if k in got and got[k].confirmed}
    assert found == want
    extra = {k for k, r in got.items() if r.confirmed} - want.keys()
    texts = {r.doc_id: r.text.split("\n") for r in docs.where(docs.doc_id.isin([d for d, _ in extra])).collect()}
    assert all(re.search("licensed|CC BY|MIT License|GPL|GNU|Apache License", texts[d][k]) for d, k in extra)


def test_made_up_paragraphs(model):
    confirmer = licenses.Confirmer()
    scan = lambda t: [(f, c) for _, f, _, _, c in model.scan(t, confirmer)]
    assert scan("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License") == [("LGPL", True)]
    assert scan("Copyright 2020 A. Body\n\nRedistribution and use in source and binary forms, with or without modification, are permitted") == [("BSD", True)]
    assert scan("SPDX-License-Identifier: MPL-2.0") == [("MPL", True)]
    for other in ["", "The old public library was a free place for the general reader.", "Apache helicopters were released in version 2."]:
        assert not any(c for _, c in scan(other))
    filler = " ".join(f"word{k} of the text" for k in range(300))
    assert ("MIT", True) in scan(f"{filler} This code is released under the MIT License. {filler}")


def test_probability_is_calibrated(model):
    assert 0 <= model.judge(["nothing"])[1] < 0.5 and model.judge(["nothing"])[0] == licenses.UNKNOWN
    assert model.judge(licenses.words_of("Released under the MIT License."))[1] > 0.8
    assert 0 < len(model.known) < 5000


def test_licences_outside_the_families(model):
    """Real licences that no training row names, in forms of training and in others: never a family, never confirmed."""
    confirmer = licenses.Confirmer()
    others = [
        "Licensed under the WTFPL.",
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "Licensed under the terms of the Acme Commercial License. All rights reserved.",
        "Distributed under the Boost Software License, Version 1.0.",
        "This software is released under the zlib License.",
        "Licensed under the Artistic License 2.0.",
        "Released under the CDDL 1.0.",
        "This file is part of the kit and is covered by the Sleepycat License.",
        "The library may be used under the terms of the PostgreSQL License.",
        "Released under the Python Software Foundation License.",
    ]
    made = licenses.made_names(["red", "house"], 100)
    assert made == licenses.made_names(["house", "red", "house"], 100) and not any("Sleepycat" in m or "Artistic" in m for m in made)
    for text in others:
        found = model.scan(text, confirmer)
        assert not any(c for *_, c in found) and {f for _, f, *_ in found} <= {licenses.OTHER}, text
    assert sum(bool(model.scan(t, confirmer)) for t in others) >= 8


def test_confirmation_needs_the_name():
    compare = licenses.Confirmer().compare
    words = licenses.words_of
    assert compare("MIT", words("Licensed under the terms of the Acme Commercial License."))[1] is False
    assert compare("MIT", words("MIT people. Licensed under the Acme."))[1] is False
    assert compare("MIT", words("Licensed under MIT."))[1] is True
    assert compare("GPL", words("Licensed under the GNU Lesser General Public License"))[1] is False
    assert compare("CC-BY", words("Licensed under CC BY-NC 4.0."))[1] is False
    lgpl = licenses.SENTENCES["LGPL"][0]
    assert compare("LGPL", words(lgpl))[1] is True and compare("GPL", words(lgpl))[1] is False
    assert compare("GPL", words(lgpl.replace("GNU Lesser General Public", "Acme")))[1] is False
    assert compare(licenses.OTHER, words("Licensed under the Acme License.")) == (0.0, False)


def test_triggers_lose_nothing(docs, model):
    """Paragraphs judged without the test for triggers, in the same windows, give the same rows."""
    confirmer = licenses.Confirmer()
    texts = [r.text or "" for r in docs.where("doc_id < 1500").collect()]
    texts += ["\n".join(licenses.OTHERS), " ".join(licenses.OTHERS), "you may use this file without the following conditions"]
    for text in texts:
        want = set()
        for number, paragraph in enumerate(text.split("\n")):
            words = licenses.words_of(paragraph)
            half = licenses.LONG // 2
            starts = range(0, max(1, len(words) - half), half) if len(words) > licenses.LONG else [0]
            if any(words and model.judge(words[k : k + licenses.LONG])[0] != licenses.UNKNOWN for k in starts):
                want.add(number)
        assert {n for n, *_ in model.scan(text, confirmer)} == want


def test_stored_model(spark, model, tmp_path):
    model.save(spark, f"{tmp_path}/model")
    again = licenses.LicenceModel.load(spark, f"{tmp_path}/model")
    assert (again.known == model.known).all() and (again.weights == model.weights).all() and again.triggers == model.triggers
    for text in [*NOTICES, "Licensed under the WTFPL.", "nothing"]:
        assert again.judge(licenses.words_of(text)) == model.judge(licenses.words_of(text))


def test_samples_are_cut_by_words(spark):
    long = "x" * 2000
    rows = spark.createDataFrame([(1, " ".join([long] * 30 + ["End"] + ["y"] * 50)), (2, None)], "doc_id long, text string")
    [line] = licenses.negatives(rows)
    assert line.split(" ") == [long] * 30 + ["end"] + ["y"] * 9


def test_odd_rows(spark, model):
    notice = next(iter(NOTICES))
    rows = [(1, notice, "x"), (1, notice, "x"), (None, f"a\n{notice}", None), (2, None, None), (3, "", None), (4, notice + "\n" + notice, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = sorted((str(r.doc_id), r.paragraph, r.family) for r in licenses.scan(docs, model).collect())
    assert got == sorted([("1", 0, "MIT")] * 2 + [("None", 1, "MIT"), ("4", 0, "MIT"), ("4", 1, "MIT")])
    assert licenses.scan(docs.limit(0)).count() == 0
