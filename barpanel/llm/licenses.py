"""Licence scans (operator 8).

A text and the licence templates are normalised to lower-case words. A passage
of a text is compared with a template by the Dice coefficient of their sets of
word bigrams, ``2 |A & B| / (|A| + |B|)``; a match needs 0.8 or more.

Templates are the usual texts and headers of licences and, built by rule, their
notices: every name of a licence in every customary wording.

Size bounds prune: a passage of Dice t with a template of b bigrams shares at
least ``t b / (2 - t)`` of them, so templates with fewer different hits in the
whole text are skipped. The rest are compared exactly, with every passage of the
template's length: where a bigram stands for the last time tells for how many
passages it counts as a different one, so the sizes of all of them come from two
running sums.

Defined cases: a null or empty text has no match; a null ``doc_id`` is carried
through; texts of any length are read whole; among overlapping passages the one
that shares most bigrams wins, then the higher Dice, the earlier and the
alphabetically first; repeated rows are scanned one by one; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import pieces, schema_of, texts

MIN_DICE = 0.8

# Public licence texts and headers, names of licences, and the
# customary wordings of a notice.
TEXTS: dict[str, str] = {
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."),
    "gpl-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."),
    "cc-by-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work."),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely."),
}
_GPL = "GNU General Public License"
_CC = "Creative Commons Attribution"
NAMES_OF: dict[str, tuple[str, ...]] = {
    "mit": ("MIT License", "MIT license", "MIT"),
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License",
                   "Apache-2.0"),
    "bsd-2-clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "bsd-3-clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    "bsd": ("BSD License", "BSD-style license"),
    "isc": ("ISC License", "ISC"),
    "gpl-2.0": (f"{_GPL}, version 2", f"{_GPL} v2.0", "GPLv2", "GPL-2.0", "GPL-2.0-only"),
    "gpl-2.0-or-later": (f"{_GPL}, version 2 or later", f"{_GPL}, version 2 or any later version",
                         "GPLv2+", "GPL-2.0-or-later"),
    "gpl-3.0": (f"{_GPL}, version 3", f"{_GPL} v3.0", "GPLv3", "GPL-3.0", "GPL-3.0-only"),
    "gpl-3.0-or-later": (f"{_GPL}, version 3 or later", f"{_GPL}, version 3 or any later version",
                         "GPLv3+", "GPL-3.0-or-later"),
    "lgpl-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1",
                 "LGPL-2.1-only"),
    "lgpl-2.1-or-later": ("GNU Lesser General Public License, version 2.1 or later",
                          "LGPL-2.1-or-later"),
    "lgpl-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0",
                 "LGPL-3.0-only"),
    "lgpl-3.0-or-later": ("GNU Lesser General Public License, version 3 or later",
                          "LGPL-3.0-or-later"),
    "agpl-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0",
                 "AGPL-3.0-only"),
    "agpl-3.0-or-later": ("GNU Affero General Public License, version 3 or later",
                          "AGPL-3.0-or-later"),
    "mpl-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "epl-2.0": ("Eclipse Public License 2.0", "EPL-2.0"),
    "unlicense": ("Unlicense",),
    "cc0-1.0": ("CC0 1.0 Universal", "CC0-1.0"),
    "cc-by-4.0": (f"{_CC} 4.0 International License", "CC BY 4.0", "CC-BY-4.0"),
    "cc-by-sa-4.0": (f"{_CC}-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "cc-by-nc-4.0": (f"{_CC}-NonCommercial 4.0 International License", "CC BY-NC 4.0"),
    "cc-by-nd-4.0": (f"{_CC}-NoDerivatives 4.0 International License", "CC BY-ND 4.0"),
    "cc-by-nc-sa-4.0": (f"{_CC}-NonCommercial-ShareAlike 4.0 International License",
                        "CC BY-NC-SA 4.0"),
    "cc-by-nc-nd-4.0": (f"{_CC}-NonCommercial-NoDerivatives 4.0 International License",
                        "CC BY-NC-ND 4.0"),
}
WORDINGS = ("licensed under the {}", "licensed under {}", "licensed under a {}",
            "released under the {}", "released under {}", "distributed under the {}",
            "distributed under {}", "available under the {}", "available under {}",
            "published under the {}", "governed by the {}", "governed by a {}",
            "under the terms of the {}", "SPDX-License-Identifier: {}")
RIGHTS = ("All rights reserved.",)


def templates() -> list[tuple[str, str]]:
    """(licence id, template): the texts by their own names, the notices as
    ``<licence>-notice``."""
    out = list(TEXTS.items())
    out += [(f"{k}-notice", w.format(n)) for k, names in NAMES_OF.items() for n in names
            for w in WORDINGS]
    return out + [("all-rights-reserved", t) for t in RIGHTS]


_WORD = re.compile(r"[^\W_]+")


def normalise(text: str) -> list[str]:
    """Lower-case runs of letters and digits."""
    return _WORD.findall(text.lower())


class Templates:
    """Templates as sets of bigram codes over their own words. Templates with the
    same licence and the same words count once."""

    def __init__(self, of: list[tuple[str, str]], least: float):
        words = sorted({(k, tuple(normalise(t))) for k, t in of})
        words = [(k, w) for k, w in words if len(w) > 1]
        self.names = [k for k, _ in words]
        self.vocabulary: dict[str, int] = {}
        for _, ws in words:
            for w in ws:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.v = len(self.vocabulary)
        self.n_words = [len(w) for _, w in words]
        self.bigrams = [np.unique(self.codes(np.array([self.vocabulary[w] for w in ws])))
                        for _, ws in words]
        self.least = least
        # the fewest shared bigrams that any match has
        self.shared = np.array([max(1, math.ceil(least * len(b) / (2 - least) - 1e-9))
                                for b in self.bigrams])
        self.known = np.zeros(self.v * self.v, bool)
        self.holders: dict[int, list[int]] = {}
        for k, b in enumerate(self.bigrams):
            self.known[b] = True
            for c in b.tolist():
                self.holders.setdefault(c, []).append(k)

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Codes of the bigrams; -1 if a word is in no template."""
        a, b = ids[:-1], ids[1:]
        return np.where((a >= 0) & (b >= 0), a * self.v + b, -1)

    def matches(self, text: str) -> list[tuple[int, str, int, float]]:
        """(first word, licence id, words, Dice) of the best passages."""
        words = normalise(text)
        if len(words) < 2:
            return []
        get = self.vocabulary.get
        code = self.codes(np.fromiter((get(w, -1) for w in words), np.int64, len(words)))
        some = np.flatnonzero((code >= 0) & self.known[code])
        if not some.size:
            return []
        hits = np.bincount(np.concatenate([self.holders[c] for c in np.unique(code[some]).tolist()]),
                           minlength=len(self.names))
        found, own, prev = [], {}, None
        for k in np.flatnonzero(hits >= self.shared).tolist():
            if prev is None:  # where each bigram of the text stood last
                prev = _previous(_numbered(list(zip(words, words[1:]))))
            size = min(self.n_words[k] - 1, len(code))  # bigrams of a passage
            if size not in own:
                own[size] = _different(np.arange(len(code)), prev, size, len(code))
            b = self.bigrams[k]
            pos = some[np.isin(code[some], b)]
            both = _different(pos, _at(pos, _previous(code[pos])), size, len(code))
            dice = 2 * both / (own[size] + len(b))
            for s in np.flatnonzero((dice >= self.least) & (both > 0)).tolist():
                found.append((-int(both[s]), -float(dice[s]), s, self.names[k], size + 1))
        found.sort()
        out: list[tuple[int, str, int, float]] = []
        taken = np.zeros(len(words), bool)
        for _, d, s, name, n in found:
            if not taken[s:s + n].any():
                taken[s:s + n] = True
                out.append((s, name, n, -d))
        out.sort()
        return out


def _numbered(items: list) -> np.ndarray:
    number: dict = {}
    return np.array([number.setdefault(x, len(number)) for x in items], np.int64)


def _previous(codes: np.ndarray) -> np.ndarray:
    """The index of the same code's last occurrence before each, or -1."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), -1, np.int64)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def _at(pos: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Positions of those indices; -1 stays."""
    return np.where(index >= 0, pos[index], -1)


def _different(pos: np.ndarray, prev: np.ndarray, size: int, n: int) -> np.ndarray:
    """How many different bigrams each passage of ``size`` holds, by its first
    place. A bigram at p counts for the passages that begin after its last
    occurrence and reach p."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.maximum(prev + 1, np.maximum(pos - size + 1, 0)), 1)
    np.add.at(step, pos + 1, -1)
    return np.cumsum(step)[:n - size + 1]


def scan(docs: DataFrame, of: list[tuple[str, str]] | None = None, least: float = MIN_DICE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: ``doc_id``, ``license_id``, ``word_start`` (among the
    normalised words), ``n_words`` and ``dice``. ``of``: (licence id, template) pairs
    in place of :func:`templates`."""
    chosen = list(templates() if of is None else of)
    out = "doc_id long,license_id string,word_start long,n_words long,dice double"

    def run(batches) -> Iterator[pa.RecordBatch]:
        known = Templates(chosen, least)
        for b in pieces(batches, "text"):
            ids = b.column("doc_id").to_pylist()
            rows = [(i, name, s, n, d) for i, t in zip(ids, texts(b))
                    for s, name, n, d in known.matches(t)]
            cols = list(zip(*rows)) or [[]] * 5
            schema = schema_of(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, out)
