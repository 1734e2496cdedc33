"""License texts in documents by an exact set-similarity join.

Templates are short word sequences.  The text blocks are windows of ``2 * STRIDE`` words, one every ``STRIDE``
words, so every span of ``STRIDE`` + 1 words lies whole in a block.  A block matches a template if it holds at
least ``threshold`` of the template's distinct words.  Words are ordered by their frequency in the whole
corpus, rarest first (counted in a first pass, for the words of templates only), which allows three exact filters:

* prefix: a match of a template of m words must hold one of its m - need + 1 rarest words;
* length: a block of fewer distinct words than need can't match;
* position: the p-th word of a template met first leaves at most m - p + 1 words to be shared.

The templates are given, and their number is checked (``MAX_WORDS`` words in all), so their index goes to every
task; blocks are joined where they stand, and only the labels of a document leave the task.

Base phrases are templates too, with threshold 1; in a matching block their words are then looked up in
sequence, which gives the exact places.

Defined results: null or empty text: no words, no places, no labels, score 0.  ``score`` is the highest
containment of a matching template, 0 without one.  Repeated rows each get their result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.text import words_of

STRIDE = 64
THRESHOLD = 0.8
MAX_WORDS = 20_000

# Base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Sentences of public licenses, by label.
TEMPLATES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-warranty": "The software is provided as is, without warranty of any kind, express or implied",
    "apache-2-notice": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-3": "Licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "all-rights": "Copyright. All rights reserved. No part of this publication may be reproduced or distributed without prior written permission",
}


def template_words(text: str) -> list[str]:
    return [w.decode() for w in words_of(text)]


def word_counts(docs: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """How often each word of ``vocabulary`` stands in the whole corpus."""
    wanted = {w.encode() for w in vocabulary}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total.update(w for w in words_of(text) if w in wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = docs.select("text").filter(F.col("text").isNotNull()).mapInArrow(count, "word string, n long")
    return {r[0]: r[1] for r in counted.groupBy("word").agg(F.sum("n")).collect()}


class Index:
    """Prefix words of all templates in the global order, and what a match needs."""

    def __init__(self, templates: list[tuple[str, list[bytes], float, bool]], counts: dict[str, int]):
        self.templates = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for label, sequence, threshold, base in templates:
            ordered = sorted(set(sequence), key=lambda w: (counts.get(w.decode(), 0), w))
            need = max(1, math.ceil(threshold * len(ordered) - 1e-9))
            for p, word in enumerate(ordered[: len(ordered) - need + 1]):
                self.prefix.setdefault(word, []).append((len(self.templates), p))
            self.templates.append((label, sequence, frozenset(ordered), need, base))


def _scan(index: Index, words: list[bytes]) -> tuple[dict[int, set[int]], set[str], float]:
    """Places of base phrases (by start and template), labels, score."""
    at = [i for i, w in enumerate(words) if w in index.prefix] if not index.prefix.keys().isdisjoint(words) else []
    blocks: dict[int, dict[int, int]] = {}
    for i in at:
        last = i // STRIDE
        for b in range(max(0, last - 1), last + 1):
            first = blocks.setdefault(b, {})
            for t, p in index.prefix[words[i]]:
                first[t] = min(p, first.get(t, p))
    places: dict[int, set[int]] = {}
    labels: set[str] = set()
    score = 0.0
    for b, met in blocks.items():
        start = b * STRIDE
        held = set(words[start : start + 2 * STRIDE])
        for t, p in met.items():
            label, sequence, tokens, need, base = index.templates[t]
            if len(held) < need or len(tokens) - p < need:
                continue
            common = len(tokens & held)
            if common < need:
                continue
            if not base:
                labels.add(label)
                score = max(score, common / len(tokens))
                continue
            for i in range(start, min(start + 2 * STRIDE, len(words)) - len(sequence) + 1):
                if words[i] == sequence[0] and words[i : i + len(sequence)] == sequence:
                    places.setdefault(i, set()).add(t)
                    score = 1.0
    return places, labels, score


_SCANNED = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def license_labels(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES,
                   threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    wanted = [(label, template_words(p), 1.0, True) for p, label in base.items()]
    wanted += [(label, template_words(t), threshold, False) for label, t in templates.items()]
    longest = max(len(w) for _, w, _, _ in wanted)
    if longest > STRIDE + 1 or sum(len(w) for _, w, _, _ in wanted) > MAX_WORDS:
        raise ValueError("templates are longer than a block can hold whole, or too many to send to each task")
    counts = word_counts(docs, {w for _, ws, _, _ in wanted for w in ws})
    index = Index([(label, [w.encode() for w in ws], t, b) for label, ws, t, b in wanted], counts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [label for label, *_ in index.templates]
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                places, labels, score = _scan(index, words)
                found = {names[t] for ts in places.values() for t in ts}
                row = (len(words), sum(len(ts) for ts in places.values()), min(places, default=None), max(places, default=None),
                       ",".join(sorted(found)), ",".join(sorted(found | labels)), score)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, {_SCANNED}")
