"""License phrases and template blocks: an exact set-similarity join of text blocks with license templates.

Words are lower-cased runs of letters, digits and non-ASCII characters.  A template of L words is compared with blocks of 3 L words,
one every L words (a shorter text is one block), so every run of up to 2 L words lies whole in a block, whatever L is.
A block matches a template when it holds at least ``threshold`` of the template's distinct words, and among them all
words that the template's licence is told by (``NAMES``), if any.

The template words are ordered by their frequency in the whole corpus, rarest first; the counts of those few hundred words
are all that reaches the driver.  An index of all template words is looked up once per word of a text; then, per template, each losing no match:

* prefix: of the template's ``|T| - need + l`` rarest words a match holds at least ``l`` different ones (``l`` is a quarter of ``need``);
* length: a block with fewer than ``need`` words is out;
* position: the words found in a block, with the places after the prefix that are left in the order, must come to ``need``.

Surviving blocks are verified by counting their distinct template words.

Results for odd input: null or empty text has no words, no places, null first and last word and score 0; equal rows each
have a result; an empty table gives an empty result; a very long text is read in parts; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrid.llm.shared import ship
from rulegrid.llm.words import ALNUM_WORDS, hash_words, words_of

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as their licences word them, and the label of each.
TEMPLATES = {
    "mit-notice": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-terms": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-notice": "This work is licensed under the GNU General Public License",
    "gpl-terms": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd-terms": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
    'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
    "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}
# Words without which a short notice is another licence's.
NAMES = {"mit-notice": ("mit",), "apache-notice": ("apache",), "gpl-notice": ("gnu", "general", "public"), "cc-notice": ("creative", "commons")}
THRESHOLD = 0.8


def split_words(text: str) -> list[str]:
    """The words of a short text, by the rule of ``ALNUM_WORDS``."""
    data = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return "".join(c if ord(c) > 127 or c.isdigit() or "a" <= c <= "z" else " " for c in data).split()


def _counts(vocabulary: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in words_of(batch["text"], ALNUM_WORDS):
                at = np.minimum(np.searchsorted(vocabulary, part.hashes), len(vocabulary) - 1)
                totals += np.bincount(at[vocabulary[at] == part.hashes], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary.view(np.int64)), pa.array(totals)], names=["word", "n"])

    return run


@dataclass
class Template:
    """rank: place of each vocabulary word in the template's order (rarest in the corpus first), -1 for other words."""

    name: str
    rank: np.ndarray
    distinct: int
    need: int
    step: int  # words of the template; a block has three times as many
    must: list[int]  # ranks


def blocks_with(template: Template, hits: np.ndarray, codes: np.ndarray, of_row: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, int]]:
    """Row and share of every matching block, given the places and vocabulary numbers of template words; and how many blocks each filter left."""
    rank = template.rank[codes]
    at, rank = hits[rank >= 0], rank[rank >= 0]
    least = max(1, template.need // 4)
    prefix = template.distinct - template.need + least
    nothing = np.zeros(0, np.int64), np.zeros(0), {"prefix": 0, "length": 0, "position": 0, "match": 0}
    if not (rank < prefix).any():
        return nothing
    row = of_row[at]
    block = (at - bounds[row]) // template.step
    # A word lies in its own block and the two before; the pairs of block and word, once each.
    row, block, rank = np.tile(row, 3), np.concatenate([block, block - 1, block - 2]), np.tile(rank, 3)
    inside = block >= 0
    number, of = np.unique((row[inside] << 40) | block[inside], return_inverse=True)
    cell = np.unique(of * template.distinct + rank[inside])
    of, rank = cell // template.distinct, cell % template.distinct
    early = np.bincount(of[rank < prefix], minlength=len(number))
    left = early >= least
    counts = {"prefix": int(left.sum())}
    row, start = number >> 40, (number & ((1 << 40) - 1)) * template.step
    left &= np.minimum(3 * template.step, np.diff(bounds)[row] - start) >= template.need
    counts["length"] = int(left.sum())
    # The last prefix word's place bounds what can follow it: all words found early, and every place after the prefix up to the last word found.
    last = np.zeros(len(number), np.int64)
    np.maximum.at(last, of, rank)
    left &= early + np.maximum(last + 1 - prefix, 0) >= template.need
    counts["position"] = int(left.sum())
    kept = left[of]
    held = np.bincount(of[kept], minlength=len(number))
    left &= held >= template.need
    for word in template.must:
        left &= np.bincount(of[kept & (rank == word)], minlength=len(number)) > 0
    counts["match"] = int(left.sum())
    return row[left], held[left] / template.distinct, counts


def _matches(vocabulary: np.ndarray, templates: list[Template], phrases: list[tuple[str, np.ndarray]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(8)]
            for part in words_of(batch["text"], ALNUM_WORDS):
                for row in _scan(part, vocabulary, templates, phrases):
                    for column, value in zip(rows, row):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_blocks"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), *[pa.array(c, k) for c, k in zip(rows, kinds)]], names=["doc_id", *names])

    return run


def _scan(part, vocabulary, templates, phrases) -> Iterator[tuple]:
    h, bounds = part.hashes, part.bounds
    of_row = part.row_of_word()
    places: dict[int, list[tuple[int, str]]] = {}
    for label, phrase in phrases:
        n = len(phrase)
        if len(h) < n:
            continue
        hit = h[: len(h) - n + 1] == phrase[0]
        for j in range(1, n):
            hit &= h[j : len(h) - n + 1 + j] == phrase[j]
        at = np.flatnonzero(hit)
        for p in at[of_row[at] == of_row[at + n - 1]].tolist():
            places.setdefault(int(of_row[p]), []).append((p - int(bounds[of_row[p]]), label))
    found: dict[int, list[tuple[str, float]]] = {}
    code = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    hits = np.flatnonzero(vocabulary[code] == h)
    for template in templates:
        matched, shares, _ = blocks_with(template, hits, code[hits], of_row, bounds)
        for r, share in zip(matched.tolist(), shares.tolist()):
            found.setdefault(r, []).append((template.name, share))
    for r in range(len(bounds) - 1):
        base, more = places.get(r, []), found.get(r, [])
        starts = [p for p, _ in base]
        labels = sorted({x for _, x in base})
        score = max([1.0 if base else 0.0, *(s for _, s in more)])
        yield (
            int(bounds[r + 1] - bounds[r]), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(labels), ",".join(sorted({*labels, *(x for x, _ in more)})), score, len(more),
        )


def template_sets(templates: dict[str, str], threshold: float, often: dict[int, int], names: dict[str, tuple[str, ...]]) -> tuple[np.ndarray, list[Template]]:
    """The vocabulary of all templates, and each with its words in order; often: corpus counts by word."""
    texts = {name: split_words(text) for name, text in templates.items()}
    hashes = {name: np.unique(hash_words(words, ALNUM_WORDS)) for name, words in texts.items()}
    vocabulary = np.unique(np.concatenate(list(hashes.values())))
    out = []
    for name, words in hashes.items():
        order = sorted(words, key=lambda w: (often.get(int(w.view(np.int64)), 0), w))
        rank = np.full(len(vocabulary), -1, np.int64)
        rank[np.searchsorted(vocabulary, np.array(order, np.uint64))] = np.arange(len(order))
        must = [int(rank[np.searchsorted(vocabulary, w)]) for w in hash_words(list(names.get(name, ())), ALNUM_WORDS)]
        out.append(Template(name, rank, len(words), max(1, int(np.ceil(threshold * len(words) - 1e-9))), len(texts[name]), must))
    return vocabulary, out


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, names: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels`` (phrases' and templates'), ``score`` (1 with a phrase, else the best containment of a matching block, else 0)
    and ``n_blocks`` (matching block-template pairs).  ``templates`` need a word each; ``names``: words of a template that a block must hold."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if templates is None:
        templates, names = TEMPLATES, NAMES
    vocabulary, _ = template_sets(templates, threshold, {}, names or {})
    counted = docs.mapInArrow(_counts(vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    _, ordered = template_sets(templates, threshold, dict(zip(counted["word"].to_pylist(), counted["n"].to_pylist())), names or {})
    phrases = [(label, hash_words(phrase.split(), ALNUM_WORDS)) for phrase, label in PHRASES.items()]
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long"
    return docs.mapInArrow(_matches(vocabulary, ordered, phrases), schema)
