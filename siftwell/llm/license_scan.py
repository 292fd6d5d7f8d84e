"""License scans: normalised text against licence templates by the Dice coefficient over word bigrams.

Units of a text are compared: the whole text, its paragraphs, lines and sentences. Dice = 2 common / (a + b) over bigrams with their
counts. It is ``MIN_DICE`` or more only if a unit's number of bigrams is within min / (2 - min) and (2 - min) / min of the
template's; templates outside these bounds are pruned before any bigram is counted.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .decontaminate import words_of

MIN_DICE = 0.8

#: Notices and passages of public licences, (licence, text). A licence may have several.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_PARAGRAPHS = re.compile(r"\n[ \t\r]*\n")
_SENTENCES = re.compile(r"(?<=[.!?:]) +")


def bigrams(words: list) -> Counter:
    return Counter(zip(words, words[1:]))


def units(text: str) -> Iterator[str]:
    """The whole text, then paragraphs, lines and sentences that are smaller than what holds them."""
    yield text
    paragraphs = _PARAGRAPHS.split(text)
    for paragraph in paragraphs:
        if len(paragraphs) > 1:
            yield paragraph
        lines = paragraph.split("\n")
        for line in lines:
            if len(lines) > 1:
                yield line
            sentences = _SENTENCES.split(line)
            if len(sentences) > 1:
                yield from sentences


class Scanner:
    def __init__(self, templates=TEMPLATES, min_dice: float = MIN_DICE):
        self.min_dice = min_dice
        self.ids: dict[bytes, int] = {}
        sized = []
        for name, text in templates:
            counts = bigrams([self.ids.setdefault(w, len(self.ids) + 1) for w in self.words(text)])
            sized.append((sum(counts.values()), name, counts))
        self.templates = sorted(sized, key=lambda t: (t[0], t[1]))
        self.sizes = [t[0] for t in self.templates]
        self.least = min_dice / (2 - min_dice)
        self.smallest = max(1, self.sizes[0] * self.least) if sized else 1
        self.largest = self.sizes[-1] / self.least if sized else 0

    @staticmethod
    def words(text: str) -> list[bytes]:
        return [b"license" if w == b"licence" else w for w in words_of(text)]

    def match(self, words: list[bytes]) -> tuple[float, str] | None:
        """The best template of a unit: its coefficient and licence, ties to the name that sorts first."""
        size = len(words) - 1
        if not self.smallest <= size <= self.largest:
            return None
        ids = [self.ids.get(w, 0) for w in words]
        # Under half of Dice's common bigrams can't come from words that no template has.
        known = sum(1 for a, b in zip(ids, ids[1:]) if a and b)
        if 2 * known < self.min_dice * size:
            return None
        found, counts = None, None
        low = bisect.bisect_left(self.sizes, size * self.least - 1e-9)
        high = bisect.bisect_right(self.sizes, size / self.least + 1e-9)
        for total, name, own in self.templates[low:high]:
            counts = counts or bigrams(ids)
            common = sum(min(n, own[pair]) for pair, n in counts.items() if pair in own)
            dice = 2 * common / (size + total)
            if dice >= self.min_dice and (found is None or (-dice, name) < (-found[0], found[1])):
                found = (dice, name)
        return found

    def scan(self, text: str | None) -> tuple[list[str], float, int]:
        """Licences found, in order; the best coefficient; how many units matched (a unit inside a matching one counts too)."""
        names, top, many = set(), 0.0, 0
        seen: dict[str, tuple[float, str] | None] = {}
        for unit in units(text) if text else ():
            # A word and a space take two bytes at least.
            if len(unit) < 2 * self.smallest:
                continue
            if unit in seen:
                hit = seen[unit]
            else:
                hit = self.match(self.words(unit))
                if len(seen) < 10_000:
                    seen[unit] = hit
            if hit:
                names.add(hit[1])
                top = max(top, hit[0])
                many += 1
        return sorted(names), top, many


def scan_licenses(docs: DataFrame, templates=TEMPLATES, min_dice: float = MIN_DICE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licenses (array), best_dice and n_units of every row.

    Null and empty texts have no licence and a best_dice of 0. Repeated rows give repeated results; extra columns are ignored.
    """
    scanner = Scanner(templates, min_dice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scanner.scan(t.as_py()) for t in batch.column("t")]
            names, top, many = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.list_(pa.string())), pa.array(top, pa.float64()), pa.array(many, pa.int64())], names=["doc_id", "licenses", "best_dice", "n_units"]
            )

    ready = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    schema = T.StructType([ready.schema["doc_id"], T.StructField("licenses", T.ArrayType(T.StringType())), T.StructField("best_dice", T.DoubleType()), T.StructField("n_units", T.LongType())])
    return ready.mapInArrow(run, schema)
