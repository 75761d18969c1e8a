"""License scans: MinHash bands over text windows retrieve templates, containment verifies them."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.rows import ALNUM, Words, extend, mixed, packed, window_hashes

SHINGLE = 5
CONTAINMENT = 0.8
# Chance that a window with enough of a template is not retrieved.
MISS = 1e-6
ROWS = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
# Shingles of all templates together; they are sent to every task.
MAX_SHINGLES = 1_000_000

# Notices and opening paragraphs of public licenses, as their stewards publish them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of runs of five words; fewer words are one run."""
    return window_hashes(hashes, min(SHINGLE, max(1, len(hashes))))


@dataclass(frozen=True)
class Template:
    name: str
    shingles: np.ndarray
    #: Windows start every ``step`` words and are ``size`` words long, so that one
    #: of them holds any passage as long as the template.
    step: int
    size: int
    #: Shingles that must be found.
    least: int
    bands: int


class Index:
    """Templates by their shingles and by the bands of their signatures."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.templates, self.by_size = [], defaultdict(list)
        for name, text in templates:
            words = Words(pa.array([text], pa.string()), ALNUM, lower=True)
            if not len(words.hashes):
                continue
            own, length = np.unique(shingles(words.hashes)), len(words.hashes)
            step = max(1, length // 4)
            size = length + step
            least = math.ceil(CONTAINMENT * len(own) - 1e-9)
            similar = least / (max(1, size - SHINGLE + 1) + len(own) - least)
            bands = math.ceil(math.log(MISS) / math.log(max(1e-12, 1 - similar**ROWS)))
            self.by_size[step, size].append(len(self.templates))
            self.templates.append(Template(name, own, step, size, least, bands))
        self.known = np.unique(np.concatenate([t.shingles for t in self.templates] or [np.empty(0, np.uint64)]))
        if len(self.known) > MAX_SHINGLES:
            raise ValueError(f"the templates have more than {MAX_SHINGLES} shingles")
        most = max([t.bands for t in self.templates], default=0)
        self.seeds = mixed(np.arange(1, ROWS * most + 1, dtype=np.uint64))
        self.tables: dict[tuple, dict[tuple, list[int]]] = {}
        for group, members in self.by_size.items():
            table = self.tables[group] = defaultdict(list)
            for i in members:
                own = self.templates[i]
                signature = self.signatures(own.shingles, np.array([0]), np.array([len(own.shingles)]))[0]
                for band in range(own.bands):
                    table[band, *signature[ROWS * band : ROWS * band + ROWS].tolist()].append(i)

    def signatures(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Least hash under each seed, per range of values; ranges may overlap.

        The values are hashes already, so one multiplication orders them anew.
        """
        low, high = int(starts.min()), int(ends.max())
        edges = np.stack([starts, ends], axis=1).ravel() - low
        padded = np.append(values[low:high], np.uint64(0))
        return np.stack([np.minimum.reduceat((padded ^ seed) * _ODD, edges)[::2] for seed in self.seeds], axis=1)

    def matches(self, words: Words) -> list[list[tuple[str, int, int, float]]]:
        """Per text: (license, first word, word after the last, share found), by place."""
        result: list[list] = [[] for _ in words.counts]
        if not len(self.known) or not len(words.hashes):
            return result
        width = np.minimum(SHINGLE, np.maximum(1, words.counts))
        for row in self._touched(words, width):
            first, last = words.bounds[row], words.bounds[row + 1]
            own = shingles(words.hashes[first:last])
            hits = np.concatenate([[0], np.cumsum(np.isin(own, self.known))])
            found = []
            for (step, size), members in self.by_size.items():
                starts = np.arange(0, last - first, step)
                starts = np.minimum(starts, len(own) - 1)
                ends = np.minimum(starts + max(1, size - SHINGLE + 1), len(own))
                # A window without any known shingle can hold no template.
                some = hits[ends] > hits[starts]
                starts, ends = starts[some], ends[some]
                if len(starts):
                    found += self._verified(own, starts, ends, (step, size), int(width[row]))
            result[row] = _best(found)
        return result

    def _touched(self, words: Words, width: np.ndarray) -> np.ndarray:
        """Texts with a known shingle."""
        runs = window_hashes(words.hashes, SHINGLE)
        at = np.searchsorted(self.known, runs)
        at[at == len(self.known)] = 0
        hit = np.flatnonzero(self.known[at] == runs)
        near = np.zeros(len(words.counts), bool)
        near[words.texts()[hit]] = True
        # Runs of short texts are not among those of five words.
        return np.flatnonzero((words.counts > 0) & (near | (width < SHINGLE)))

    def _verified(self, own, starts, ends, group, width):
        signatures, table = self.signatures(own, starts, ends), self.tables[group]
        bands = max(self.templates[i].bands for i in self.by_size[group])
        for start, end, signature in zip(starts.tolist(), ends.tolist(), signatures.tolist(), strict=True):
            retrieved = set()
            for band in range(bands):
                retrieved.update(table.get((band, *signature[ROWS * band : ROWS * band + ROWS]), ()))
            for i in sorted(retrieved):
                template, window = self.templates[i], own[start:end]
                marks = np.flatnonzero(np.isin(window, template.shingles))
                share = len(np.unique(window[marks])) / len(template.shingles)
                if len(marks) and share * len(template.shingles) >= template.least:
                    yield template.name, start + int(marks[0]), start + int(marks[-1]) + width, share


def _best(found: list[tuple]) -> list[tuple]:
    """Of overlapping matches with one license the one with the largest share, then the longest."""
    kept: list[tuple] = []
    for match in sorted(set(found), key=lambda m: (-m[3], m[1] - m[2], m[1], m[0])):
        if all(match[0] != k[0] or match[1] >= k[2] or match[2] <= k[1] for k in kept):
            kept.append(match)
    return sorted(kept, key=lambda m: (m[1], m[2], m[0]))


FOUND = "n_words bigint, matches array<struct<license: string, start: int, end: int, share: double>>"


def find_licenses(
    documents: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, text: str = "text"
) -> DataFrame:
    """``row`` with ``n_words`` and ``matches``: places that hold at least 0.8 of a template.

    Words are lower-case runs of letters and digits, positions count them. A
    window is retrieved by MinHash bands, as many as miss one in a million at
    the similarity that 0.8 of the template in the longest window has; then the
    distinct shingles of five words are compared. Null and empty texts match nothing; a
    text of fewer words than a shingle is one shingle. Repeated rows are scanned each.
    Without templates nothing matches.
    """
    sent = documents.sparkSession.sparkContext.broadcast(list(templates))

    def make():
        index = Index(sent.value)
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("share", pa.float64())]))

        def apply(texts: pa.StringArray) -> list[pa.Array]:
            words = Words(texts, ALNUM, lower=True)
            found = [[dict(zip(("license", "start", "end", "share"), m, strict=True)) for m in row] for row in index.matches(words)]
            return [pa.array(words.counts.astype(np.int64)), pa.array(found, kind)]

        return apply

    return extend(packed(documents), text, make, FOUND)


def summary(found: DataFrame) -> DataFrame:
    """``row`` with ``n_matches``, the distinct ``licenses`` in order, and ``matches``."""
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select(
        "row", "n_words", F.size("matches").cast("bigint").alias("n_matches"), F.array_join(names, ",").alias("licenses"), "matches"
    )
