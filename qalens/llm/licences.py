"""Licence scan: Dice coefficient over word bigrams against licence templates.

Texts and templates are normalised to lower-case words. A template of ``m`` words is compared
with the windows of ``m`` words of a text (the last ones shorter) by ``2 |A and B| / (|A| + |B|)``
over their sets of word bigrams, wherever the notice stands: over wrapped lines, inside a line,
at the head of a longer file. Windows are placed where the text shares a bigram with the
template. The size bound prunes before any window is looked at: a coefficient of ``least``
needs ``least / (2 - least)`` of the template's bigrams inside the window, so a window with
fewer shared places is passed over; the others are tried from the most shared places down,
until what is left cannot beat the best.

Names that differ in one word share nearly all bigrams, so the words that tell licences apart
must agree too: the modifiers (non-commercial, no derivatives, share alike, lesser, affero) and
the version numbers of the window are those of the template.

Templates are a parameter, and broadcast: they are a fixed list, at most ``MAX_BIGRAMS``
bigrams in all (checked), of two words or more each. The full texts of the Apache, GPL and MPL
licences are not among those given here, their notices are.

Defined results: a null or blank text, or one of a single word, matches nothing; of equal
coefficients the longer template wins, then the first by name; of equal windows the first;
repeated rows are scanned each; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._text import ALNUM_WORDS, LOWER_ASCII, Words, tidy, window_hashes, word_chunks

MAX_BIGRAMS = 1_000_000
LEAST = 0.8

# Notices by which works name their licence, and short licence texts.
TEMPLATES: dict[str, str] = {
    "apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."
    ),
    "cc-by-4.0 line": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0 line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0 line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0 line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0 line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0 line": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-nc-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0 notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc-by-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "gpl-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "lgpl-2.1 line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0 line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-3.0 notice": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "agpl-3.0 line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "bsd-2-clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name "
        "of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission."
    ),
    "bsd-3-clause line": "Licensed under the BSD 3-Clause License.",
    "bsd-2-clause line": "Licensed under the BSD 2-Clause License.",
    "isc text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit line": "Released under the MIT License.",
    "mit notice": "Licensed under the MIT License.",
    "mit text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


#: Words that tell licences apart, by what they mean.
MODIFIERS: dict[str, tuple[str, ...]] = {
    "nc": ("nc", "noncommercial"), "nd": ("nd", "noderivatives", "noderivs"), "sa": ("sa", "sharealike"),
    "lesser": ("lesser", "lgpl"), "affero": ("affero", "agpl"),
}
#: A number after one of these is a version (or names a variant).
BEFORE_NUMBERS = (
    "version", "v", "by", "nc", "nd", "sa", "attribution", "noncommercial", "noderivatives", "sharealike", "gpl", "lgpl",
    "agpl", "license", "apache", "mpl", "bsd",
)
NUMBERS = tuple(str(n) for n in range(100))


def _hashes(words: Sequence[str]) -> np.ndarray:
    (chunk,) = word_chunks(pa.array([" ".join(words)]), ALNUM_WORDS, LOWER_ASCII, 1 << 62)
    return chunk.hashes()


class _Marks:
    """The telling words of a stretch of word hashes."""

    def __init__(self):
        self.modifier = {h: name for name, words in MODIFIERS.items() for h in _hashes(words).tolist()}
        self.before, self.number = set(_hashes(BEFORE_NUMBERS).tolist()), set(_hashes(NUMBERS).tolist())

    def __call__(self, words: list[int]) -> frozenset:
        found = {self.modifier[w] for w in words if w in self.modifier}
        return frozenset(found | {b for a, b in zip(words, words[1:]) if b in self.number and a in self.before})


class _Index:
    """Templates' sizes, telling words, and which templates hold each bigram."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        (chunk,) = word_chunks(pa.array([templates[n] for n in self.names], pa.string()), ALNUM_WORDS, LOWER_ASCII, 1 << 62)
        self.words = chunk.counts
        if len(self.words) and self.words.min() < 2:
            raise ValueError("a template needs two words")
        word, at = chunk.hashes(), chunk.window_starts(2)
        owner_gram = np.unique(np.stack([window_hashes(word, at, 2), chunk.rows()[at].astype(np.uint64)], axis=1), axis=0)
        self.gram, self.owner = owner_gram[:, 0].copy(), owner_gram[:, 1].astype(np.int64)
        if len(self.gram) > MAX_BIGRAMS:
            raise ValueError(f"{len(self.gram)} template bigrams; at most {MAX_BIGRAMS} are broadcast")
        self.sizes = np.bincount(self.owner, minlength=len(self.names))
        self.marks_of = _Marks()
        self.marks = [self.marks_of(word[lo:hi].tolist()) for lo, hi in zip(chunk.first, chunk.first[1:])]


def _best_window(index: _Index, t: int, places: np.ndarray, word: np.ndarray, gram: np.ndarray, stop: int, least: float):
    """Coefficient and first word of the template's best window, None if none reaches ``least``.
    ``places``: where bigrams of the template stand; ``stop``: one past the text's last bigram."""
    span, size = int(index.words[t]) - 1, int(index.sizes[t])
    many = np.searchsorted(places, places + span) - np.arange(len(places))
    tried = np.flatnonzero(many >= least / (2 - least) * size - 1e-9)
    best = None
    for i in tried[np.argsort(-many[tried], kind="stable")].tolist():
        shared_most = min(int(many[i]), size)
        if best is not None and 2 * shared_most / (shared_most + size) < best[0]:
            break
        lo = int(places[i])
        inside = np.unique(gram[lo : min(lo + span, stop)])
        shared = len(np.unique(gram[places[i : i + int(many[i])]]))
        dice = 2 * shared / (len(inside) + size)
        if dice < least or (best is not None and (-dice, lo) >= (-best[0], best[1])):
            continue
        if index.marks_of(word[lo : min(lo + span, stop) + 1].tolist()) == index.marks[t]:
            best = (dice, lo)
    return best


def _matches(chunk: Words, index: _Index, least: float) -> Iterator[tuple[int, int, float, int]]:
    """Row, template, coefficient and line of every text's best window of every template."""
    word = chunk.hashes()
    at = chunk.window_starts(2)
    if not len(at) or not len(index.gram):
        return
    gram = np.zeros(len(word), dtype=np.uint64)
    gram[at] = window_hashes(word, at, 2)
    low = np.searchsorted(index.gram, gram[at])
    known = at[index.gram[np.minimum(low, len(index.gram) - 1)] == gram[at]]
    low = np.searchsorted(index.gram, gram[known], side="left")
    many = np.searchsorted(index.gram, gram[known], side="right") - low
    place = np.repeat(known, many)
    owner = index.owner[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
    row = chunk.rows()[place]
    order = np.lexsort((place, row, owner))
    place, owner, row = place[order], owner[order], row[order]
    edges = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (row[1:] != row[:-1]), [True]))) if len(place) else []
    breaks = None
    for lo, hi in zip(edges, edges[1:]):
        t, r = int(owner[lo]), int(row[lo])
        if hi - lo < least / (2 - least) * index.sizes[t] - 1e-9:
            continue
        best = _best_window(index, t, place[lo:hi], word, gram, int(chunk.first[r + 1]) - 1, least)
        if best is not None:
            breaks = np.flatnonzero(chunk.data == 10) if breaks is None else breaks
            line = np.searchsorted(breaks, chunk.start[best[1]]) - np.searchsorted(breaks, chunk.offsets[r])
            yield r, t, best[0], int(line)


def scan_licences(documents: DataFrame, templates: Mapping[str, str] | None = None, least: float = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the best match (``licence``, ``dice`` and the ``line`` its
    window begins in, from 0; nulls without a match) and ``matches``: the best window of every
    template that reaches ``least``."""
    spark = documents.sparkSession
    index = spark.sparkContext.broadcast(_Index(TEMPLATES if templates is None else templates))
    kind = documents.schema[doc_id].dataType.simpleString()
    struct = pa.struct([("line", pa.int32()), ("licence", pa.string()), ("dice", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            matches: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            best: list[tuple] = [()] * batch.num_rows
            for chunk in word_chunks(batch.column(1), ALNUM_WORDS, LOWER_ASCII):
                for r, t, dice, line in _matches(chunk, own, least):
                    at, key = chunk.lo + r, (-dice, -int(own.sizes[t]), own.names[t], line)
                    matches[at].append({"line": line, "licence": own.names[t], "dice": dice})
                    best[at] = min(best[at], key) if best[at] else key
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([b[2] if b else None for b in best], pa.string()),
                    pa.array([-b[0] if b else None for b in best], pa.float64()),
                    pa.array([b[3] if b else None for b in best], pa.int32()),
                    pa.array([sorted(m, key=lambda x: x["licence"]) for m in matches], pa.list_(struct)),
                ],
                ["doc_id", "licence", "dice", "line", "matches"],
            )

    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        tidy(scan), f"doc_id {kind}, licence string, dice double, line int, matches array<struct<line:int,licence:string,dice:double>>"
    )


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    found = scan_licences(read_supplied(spark, sf_dir, "documents"))
    return found.select("doc_id", "licence", "dice", "line", F.size("matches").cast("bigint").alias("n_matches"))
