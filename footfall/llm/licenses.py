"""Operator 8: licence texts, by MinHash bands over overlapping text windows.

A template is cut into pieces of 2, 4 or 8 three-word shingles (the largest
that fits). A text is cut into windows of twice that size, each overlapping
the next by half, so any run of a piece's length lies whole in some window
and their similarity is 1/2 at least. ``bands_for`` gives the number of bands
with which such a window misses the piece with probability 1e-6 at most.
Templates that share a band with a window are verified exactly: the share of
the template's shingles contained in the best span of the text around it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WordIds, hash_family, runs, shingles, strings, word_ids

SHINGLE_WORDS = 3
SCALES = (2, 4, 8)
ROWS = 1
MISS = 1e-6
CONTAINMENT = 0.8
SLACK = 1.25  # a span may be this much longer than its template
TABLE_BITS = 22
SEED = 30_011

# Notices and opening passages of public licences.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer.""",
    "gpl-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "all-rights-reserved": "Copyright. All rights reserved.",
}


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """Bands of ``rows`` MinHash values with which a pair of that similarity
    shares none with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


BANDS = bands_for(0.5, ROWS, MISS)


@dataclass
class Index:
    """Band keys of all template pieces, and the templates' shingles."""

    names: list[str]
    shingles: list[np.ndarray]
    bits: np.ndarray  # places of the keys, for a first look
    keys: np.ndarray  # sorted
    owner: np.ndarray  # template of each key


def _values(x: np.ndarray, pad: np.ndarray | None, band: int, mul: np.ndarray, add: np.ndarray) -> list[np.ndarray]:
    out = []
    for r in range(band * ROWS, (band + 1) * ROWS):
        v = x * mul[r] + add[r]
        if pad is not None:
            v[pad] = 0xFFFFFFFF
        out.append(v)
    return out


def _keys(values: list[np.ndarray], band: int, scale: int) -> np.ndarray:
    key = np.full(len(values[0]), band * 16 + scale, np.uint64)
    for v in values:
        key = (key << np.uint64(32 if len(values) == 1 else 0)) * np.uint64(1 if len(values) == 1 else 0x9E3779B97F4A7C15) + v
    return key


def _places(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def build(templates: dict[str, str]) -> Index:
    """Index of templates of at least four words (two shingles)."""
    mul, add = hash_family(BANDS * ROWS, SEED)
    names, sets, keys, owner = [], [], [], []
    ids = WordIds()
    for name, text in templates.items():
        words, counts = word_ids([text], ids)
        if len(words) < SHINGLE_WORDS + 1:
            raise ValueError(f"template {name} has fewer than {SHINGLE_WORDS + 1} words")
        flat, _ = shingles(words, counts, SHINGLE_WORDS)
        x = (flat >> np.uint64(32)).astype(np.uint32)
        scale = max(s for s in SCALES if s <= len(flat))
        starts = np.arange(0, len(flat) - scale + 1, scale)
        for band in range(BANDS):
            pieces = [np.array([v[s : s + scale].min() for s in starts]) for v in _values(x, None, band, mul, add)]
            keys.append(_keys(pieces, band, scale))
            owner.append(np.full(len(starts), len(names)))
        names.append(name)
        sets.append(np.unique(flat))
    flat_keys, flat_owner = np.concatenate(keys), np.concatenate(owner)
    order = np.argsort(flat_keys, kind="stable")
    bits = np.zeros(1 << TABLE_BITS, bool)
    bits[_places(flat_keys)] = True
    return Index(names, sets, bits, flat_keys[order], flat_owner[order])


def retrieve(index: Index, flat: np.ndarray, per: np.ndarray) -> set[tuple[int, int, int]]:
    """(text, template, first shingle of the window) that share a band."""
    widest = SCALES[-1]
    padded = -(-per // widest) * widest
    total = int(padded.sum())
    if not total:
        return set()
    first, place = np.cumsum(padded) - padded, np.cumsum(per) - per
    at = np.arange(len(flat)) + np.repeat(first - place, per)
    x = np.zeros(total, np.uint32)
    x[at] = (flat >> np.uint64(32)).astype(np.uint32)
    pad = np.ones(total, bool)
    pad[at] = False
    mul, add = hash_family(BANDS * ROWS, SEED)
    found = set()
    for band in range(BANDS):
        blocks, size = _values(x, pad, band, mul, add), 1
        for scale in SCALES:
            while size < scale:
                blocks, size = [np.minimum(b[0::2], b[1::2]) for b in blocks], size * 2
            keys = _keys([np.minimum(b, np.r_[b[1:], b[-1:]]) for b in blocks], band, scale)
            for w in np.flatnonzero(index.bits[_places(keys)]).tolist():
                lo, hi = (np.searchsorted(index.keys, keys[w], side=s) for s in ("left", "right"))
                for template in index.owner[lo:hi].tolist():
                    doc = int(np.searchsorted(first, w * scale, side="right")) - 1
                    found.add((doc, template, w * scale - int(first[doc])))
    return found


def verify(own: np.ndarray, starts: list[int], template: np.ndarray) -> list[tuple[int, int, float]]:
    """Spans (first and last shingle, containment) of a text that contain the
    share of a template's shingles wanted, around the windows that start at ``starts``."""
    longest = int(len(template) * SLACK) + SHINGLE_WORDS
    out: list[tuple[int, int, float]] = []
    for start in sorted(starts):
        low = max(start - longest, out[-1][1] + 1 if out else 0)
        at = low + np.flatnonzero(np.isin(own[low : start + 2 * SCALES[-1] + longest], template))
        best = (0.0, 0, 0)
        for i, a in enumerate(at):
            span = at[i:][at[i:] < a + longest]
            share = len(np.unique(own[span])) / len(template)
            if share > best[0]:
                best = (share, int(span[0]), int(span[-1]))
        if best[0] >= CONTAINMENT:
            out.append((best[1], best[2], best[0]))
    return out


def _scan(index: Index, texts: list[str], ids: WordIds) -> list[tuple[int, str, int, int, float]]:
    words, counts = word_ids(texts, ids)
    flat, per = shingles(words, counts, SHINGLE_WORDS)
    begin = np.cumsum(per) - per
    by: dict[tuple[int, int], list[int]] = {}
    for doc, template, start in retrieve(index, flat, per):
        by.setdefault((doc, template), []).append(start)
    rows = []
    for (doc, template), starts in by.items():
        own = flat[begin[doc] : begin[doc] + per[doc]]
        for a, b, share in verify(own, starts, index.shingles[template]):
            rows.append((doc, index.names[template], a, b + min(SHINGLE_WORDS, int(counts[doc])), share))
    return sorted(rows)


def licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per licence passage: ``doc_id``, ``license``, ``start_word`` and
    ``end_word`` (words of the text from 0, end exclusive) and ``containment``
    (share of the template's distinct three-word shingles, 0.8 at least).

    Words are lower-case runs of letters, digits and underscores. Null and
    empty texts give no row; a row that repeats gives its rows again; a null
    id stays null. Templates that overlap (a notice within a header) are each
    reported. Other columns of ``docs`` are not used."""
    shared = docs.sparkSession.sparkContext.broadcast(build(templates or TEMPLATES))  # a fixed list

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for run in runs(batches, "text"):
            rows = _scan(shared.value, strings(run.column("text")), ids)
            doc_ids = run.column("doc_id").to_pylist()
            cols = list(zip(*[(doc_ids[d], *r) for d, *r in rows])) or [[]] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "license", "start_word", "end_word", "containment"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run_all, "doc_id long, license string, start_word long, end_word long, containment double")
