"""License notices as real files hold them: wrapped, behind comment marks, and words that only look like one."""

import random

import pytest

from hourmart.llm import licenses
from tests.llm.test_operators import _words

WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "apache": """# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "gpl": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General
 * Public License as published by the Free Software Foundation""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "mpl": """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this""",
}


def _scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.license_scan(df).collect()}


def test_wrapped_notices(spark):
    got = _scan(spark, ["int main() {}\n" * 30 + t + "\n\nint x;\n" * 30 for t in WRAPPED.values()])
    assert [got[i].labels for i in range(len(WRAPPED))] == list(WRAPPED)
    assert all(got[i].score >= 0.9 for i in got)


def test_words_far_apart_are_no_notice(spark):
    filler = " ".join(f"w{i}" for i in range(40))
    notice = dict(licenses.TEMPLATES)["bsd"].split()
    far = ["released", filler, "under the", filler, "mit", filler, "license"]
    got = _scan(spark, [" ".join(far), f" {filler} ".join(notice), f"{filler} {' '.join(notice)} {filler}"])
    assert [(got[i].labels, got[i].score) for i in range(3)] == [("", 0.0), ("", 0.0), ("bsd", 1.0)]


def test_the_naming_words_decide(spark):
    got = _scan(spark, ["Released under the Apache license.", "released under the GPL license",
                        "The band was released by the label under a license.", "Licensed under CC BY 4.0.",
                        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
                        "licensed under the mit license version 2 0",
                        "This work is licensed under the new general public access rules, license version 3",
                        "released under MIT license", "x\nLicensed under CC\nBY-NC 4"])
    assert [got[i].labels for i in range(9)] == ["apache", "", "", "", "cc-by", "mit", "", "mit", "cc-by-nc"]
    assert [got[i].score for i in range(1, 5)] == [0.0, 0.0, 0.0, 1.0]


def _plain(text):
    """Labels and score of the templates, from every block."""
    w, found, best = _words(text), set(), 0.0
    for label, t in licenses.TEMPLATES:
        words = set(t.split())
        for k in range(len(w)):
            block = set(w[k:k + licenses.longest(len(t.split()))]) & words
            if len(block) >= licenses.needed(len(words)) and block >= set(licenses.naming(t)):
                found.add(label)
                best = max(best, len(block) / len(words))
    return found, best


def test_blocks_against_brute_force(spark):
    rng = random.Random(9)
    texts = []
    for _, t in licenses.TEMPLATES * 6:
        w = [x for x in t.split() if rng.random() > 0.08]
        for _ in range(rng.randint(0, 14)):
            w.insert(rng.randrange(len(w) + 1), rng.choice(["x", "y", "the", "license", "of"]))
        other = [x for x in rng.choice(licenses.TEMPLATES)[1].split() if rng.random() > 0.1]
        texts.append("".join(x + rng.choice([" ", " ", " ", "\n", "\n\n# "]) for x in w + ["z"] * rng.randint(0, 9) + other))
    got = _scan(spark, texts)
    for i, text in enumerate(texts):
        found, best = _plain(text)
        assert got[i].labels == ",".join(sorted(found | set(got[i].base_labels.split(",")) - {""})), text
        assert got[i].score == pytest.approx(1.0 if got[i].n_base else best), text
    assert 0 < sum(r.n_base == 0 and 0 < r.score < 1 for r in got.values())
