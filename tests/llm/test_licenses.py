import random

import pytest

from barpanel.llm import licenses
from tests.llm.helpers import docs, prose

ALL = licenses.templates()
KNOWN = licenses.Templates(ALL, 0.8)


def brute(text, templates=ALL):
    """The best passages among all of a template's length, by definition."""
    words = licenses.normalise(text or "")
    found = set()
    for name, t in templates:
        t = licenses.normalise(t)
        n, b = min(len(t), len(words)), {*zip(t, t[1:])}
        for s in range(len(words) - n + 1) if n > 1 else ():
            a = {*zip(words[s:s + n], words[s + 1:s + n])}
            d = 2 * len(a & b) / (len(a) + len(b))
            if d >= 0.8:
                found.add((-len(a & b), -d, s, name, n))
    out = []
    for _, d, s, name, n in sorted(found):
        if all(s + n <= o or o + m <= s for o, _, m, _ in out):
            out.append((s, name, n, -d))
    return sorted(out)


def texts():
    rng = random.Random(6)
    out = [prose(rng, 60) for _ in range(5)] + [None, "", "License", "the the the"]
    for _, t in sorted(licenses.TEXTS.items()) + rng.sample(ALL, 25):
        w = t.split()
        for k in (0, 1, max(2, len(w) // 12)):  # some words changed
            x = list(w)
            for _ in range(k):
                x[rng.randrange(len(x))] = "changed"
            out.append(f"{prose(rng, 15)}\n{' '.join(x).upper() if k == 1 else ' '.join(x)}\n"
                       f"{prose(rng, 15)}")
    out.append(" ".join(licenses.TEXTS.values()))
    # repeated bigrams, in and around a passage
    out.append("the license the license " + licenses.TEXTS["isc"] + " this copyright notice" * 3)
    out.append("under the under the licensed under the under the MIT License the MIT License")
    return out


def test_matches_are_those_of_all_passages():
    some = 0
    for t in texts():
        got, want = KNOWN.matches(t or ""), brute(t)
        assert [(*x[:3], round(x[3], 12)) for x in got] == [(*x[:3], round(x[3], 12)) for x in want]
        some += bool(want)
    assert some > 60


def test_random_word_salads():
    """Texts made of the templates' own words: many near hits and repeats."""
    rng = random.Random(7)
    few = [("a", "one two three one two four"), ("b", "two three four five"), ("c", "one two"),
           ("d", "five five five six"), ("e", "three four five six seven eight nine ten")]
    known = licenses.Templates(few, 0.8)
    words = sorted({w for _, t in few for w in t.split()} | {"x"})
    for _ in range(400):
        t = " ".join(rng.choices(words, k=rng.randint(0, 25)))
        assert [(*x[:3], round(x[3], 12)) for x in known.matches(t)] == [
            (*x[:3], round(x[3], 12)) for x in brute(t, few)]


@pytest.mark.parametrize("text, want", [
    ("Licensed under the MIT License.", "mit-notice"),
    ("Distributed under the MIT License", "mit-notice"),
    ("The code is available under the MIT license, see LICENSE.", "mit-notice"),
    ("Copyright 2020 Example. All rights reserved.", "all-rights-reserved"),
    ("Licensed under the GNU General Public License version 3 or later.", "gpl-3.0-or-later-notice"),
    ("Released under the GNU General Public License, version 2.", "gpl-2.0-notice"),
    ("This library is licensed under LGPL-3.0.", "lgpl-3.0-notice"),
    ("You may use it under the terms of the GNU Affero General Public License, version 3.",
     "agpl-3.0-notice"),
    ("This project is released under the BSD 3-Clause License.", "bsd-3-clause-notice"),
    ("// SPDX-License-Identifier: Apache-2.0", "apache-2.0-notice"),
    ("# SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0-notice"),
    ("Text is available under CC BY-SA 4.0.", "cc-by-sa-4.0-notice"),
    ("Photos are licensed under CC BY-NC-ND 4.0", "cc-by-nc-nd-4.0-notice"),
    ("Licensed under the Apache License 2.0", "apache-2.0-notice"),
    ("Distributed under the Mozilla Public License 2.0.", "mpl-2.0-notice")])
def test_usual_wordings(text, want):
    rng = random.Random(1)
    got = KNOWN.matches(f"{prose(rng, 20)}. {text} {prose(rng, 20)}")
    assert [m[1] for m in got] == [want]


@pytest.mark.parametrize("text", [
    "The museum is open under the new rules.", "They were released under the bridge.",
    "A license to drive is required.", "All rights of way are reserved for cyclists.",
    "Version 3 of the general plan is public.", "The MIT laboratory published a paper."])
def test_ordinary_sentences_do_not_match(text):
    assert KNOWN.matches(text) == []


def test_exact_templates_score_one(spark):
    names = sorted(licenses.TEXTS)
    df = docs(spark, [f"foo {licenses.TEXTS[n]} bar" for n in names], clash=True)
    got = {(r.doc_id, r.license_id): r.dice for r in licenses.scan(df).collect()}
    assert all(got.get((i, n)) == 1.0 for i, n in enumerate(names))


def test_defined_cases(spark):
    rows = [None, "", "Released under the MIT License.\n" * 3, "x" * 100_000,
            "the license " * 20_000]
    got = licenses.scan(docs(spark, rows, [None, 1, 2, 3, 4])).collect()
    assert [(r.doc_id, r.license_id) for r in got] == [(2, "mit-notice")] * 3
    assert licenses.scan(docs(spark, [])).count() == 0


def test_no_false_version():
    for v, want in (("3", "gpl-3.0-notice"), ("2", "gpl-2.0-notice")):
        got = KNOWN.matches(f"This work is licensed under the GNU General Public License, version {v}.")
        assert [m[1] for m in got] == [want]
