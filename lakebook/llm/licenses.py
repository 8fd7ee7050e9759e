"""License scan: winnowed template fingerprints, then banded alignment.

The fingerprints of all templates form an inverted index (fingerprint to template and
place) of fixed size, which travels with the job. A text's own winnowed fingerprints pick
candidate templates and diagonals; a banded alignment around each reports how much of the
template is there and where. Short notices have too few words to be winnowed: all their
pairs of words are indexed, and looked up among all pairs of the text. Texts are read once
and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship_package, whole_text
from .winnow import Rolling, anchors, word_hashes

GRAM = 3
# With three grams in a window, any five words in a row hold a fingerprint.
WIDTH = 3
# Words by which an alignment may leave its diagonal.
BAND = 8
COVERAGE = 0.8
# Templates below so many words are found by any two words in a row: of five words one may
# be another, which leaves no three in a row.
SHORT, PAIR = 12, 2
TOKEN = re.compile(rb"[a-z0-9]+(?:[.-][a-z0-9]+)*")

# Fixed texts: notices and grants of public licenses.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MIT disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. Neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "BSD disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version."
    ),
    "LGPL-2.1-or-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License, or (at your option) any later version."
    ),
    "AGPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}


def tokens(text: str) -> list[bytes]:
    """Lower-case words and numbers without the punctuation around them."""
    return TOKEN.findall(text.encode("utf-8", "surrogatepass").lower())


def fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed fingerprints and their places; short texts keep every gram."""
    if len(hashes) < GRAM:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    grams = Rolling(hashes).grams(GRAM)
    places = np.unique(anchors(grams, min(WIDTH, len(grams))))
    return grams[places], places


@dataclass(frozen=True)
class Postings:
    """Sorted fingerprints and, beside each, the template and the place it comes from."""

    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, int, int]]) -> Postings:
        prints, template, place = zip(*sorted(rows)) if rows else ((), (), ())
        return cls(np.array(prints, dtype=np.uint64), np.array(template, dtype=np.int64), np.array(place, dtype=np.int64))

    def seeds(self, prints: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int]]:
        """Template and diagonal of every fingerprint of a text that is one of these."""
        lo = np.searchsorted(self.prints, prints, side="left")
        hi = np.searchsorted(self.prints, prints, side="right")
        for i in np.flatnonzero(hi > lo).tolist():
            for entry in range(int(lo[i]), int(hi[i])):
                yield int(self.template[entry]), int(places[i] - self.place[entry])


def word_pairs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of neighbouring words and their places."""
    if len(hashes) < PAIR:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    grams = Rolling(hashes).grams(PAIR)
    return grams, np.arange(len(grams))


@dataclass(frozen=True)
class Index:
    """Sorted fingerprints of all templates with their template and place.

    ``pairs`` is the same for the pairs of words of the short ones.
    """

    names: tuple[str, ...]
    words: tuple[tuple[bytes, ...], ...]
    prints: Postings
    pairs: Postings


def build_index(templates: dict[str, str]) -> Index:
    words = tuple(tuple(tokens(text)) for text in templates.values())
    rows: list[tuple[int, int, int]] = []
    pairs: list[tuple[int, int, int]] = []
    for number, template in enumerate(words):
        short = len(template) < SHORT
        prints, places = (word_pairs if short else fingerprints)(word_hashes(list(template)))
        (pairs if short else rows).extend((int(f), number, int(p)) for f, p in zip(prints, places))
    return Index(tuple(templates), words, Postings.of(rows), Postings.of(pairs))


def align(template: tuple[bytes, ...], text: list[bytes], diagonal: int) -> tuple[int, int, int]:
    """Words matched in order near the diagonal, and the span of the match in ``text``.

    Cells more than ``BAND`` words off the diagonal are not looked at. Of equally many
    matches the narrowest span wins, then the first.
    """
    # best[d]: (matches, -start, -end) of the best path that ends at offset d of the row.
    empty = (0, 0, 0)
    best = {d: empty for d in range(-BAND, BAND + 1)}
    for row, word in enumerate(template):
        left, now = empty, {}
        for d in range(-BAND, BAND + 1):
            at = row + diagonal + d
            # From above the same text word is one offset further right.
            choice = max(left, best.get(d + 1, empty))
            if 0 <= at < len(text) and text[at] == word:
                matches, start, _ = best[d]
                step = (matches + 1, start if matches else -at, -(at + 1))
                choice = max(choice, step, key=lambda c: (c[0], c[1] - c[2] if c[0] else 0))
                if choice[0] == step[0] and choice[1] - choice[2] == step[1] - step[2]:
                    choice = max(choice, step)
            now[d] = left = choice
        best = now
    matches, start, end = max(best.values(), key=lambda c: (c[0], c[2] - c[1], c[1]))
    return matches, -start, -end


def scan_text(text: str, index: Index, coverage: float) -> list[tuple[int, float, int, int, int]]:
    """``(template, coverage, matched, start, end)`` of every license text in ``text``.

    A match inside the span of another that has more words is part of that one.
    """
    words = tokens(text)
    hashes = word_hashes(words)
    seeds: dict[int, list[int]] = {}
    for postings, cut in ((index.prints, fingerprints), (index.pairs, word_pairs)):
        if len(postings.prints):
            for number, diagonal in postings.seeds(*cut(hashes)):
                seeds.setdefault(number, []).append(diagonal)
    found = []
    for number, diagonals in seeds.items():
        template, last = index.words[number], None
        for diagonal in sorted(set(diagonals)):
            if last is not None and diagonal - last <= BAND // 2:
                continue  # the band of the one before reaches here
            last = diagonal
            matched, start, end = align(template, words, diagonal)
            if matched >= coverage * len(template):
                found.append((number, matched / len(template), matched, start, end))
    found.sort(key=lambda m: (-m[2], m[3], m[0]))
    kept: list[tuple[int, float, int, int, int]] = []
    for match in found:
        if not any(k[3] <= match[3] and match[4] <= k[4] for k in kept):
            kept.append(match)
    return sorted(kept, key=lambda m: (m[3], m[0]))


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, license, coverage, n_matched, start_word, end_word``: one row per match.

    Word numbers count ``tokens`` of the text, end exclusive. Null and empty texts match
    nothing. Rows with a null id and repeated rows are scanned like any other; an empty
    table gives no rows; other columns are ignored.
    """
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    index = build_index(TEMPLATES if templates is None else templates)
    ship_package(docs.sparkSession)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, out = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for match in scan_text(text, index, coverage):
                    owner.append(row)
                    out.append(match)
            number, share, matched, start, end = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner, pa.int32())),
                    pa.array([index.names[n] for n in number], pa.string()),
                    pa.array(share, pa.float64()),
                    *(pa.array(c, pa.int64()) for c in (matched, start, end)),
                ],
                names=["doc_id", "license", "coverage", "n_matched", "start_word", "end_word"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan,
        f"doc_id {id_type}, license string, coverage double, "
        "n_matched bigint, start_word bigint, end_word bigint",
    )
