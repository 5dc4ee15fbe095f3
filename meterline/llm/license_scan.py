"""Licence scan with a positional index of rare words.

Each template is a short text with the phrases that must stand in it. A template's words get an
inverse document frequency, counted over all documents for the (few) words that occur in any
template; the index posts every template under its rarest words, with their positions. A file looks up
its licence words from the rarest down, every hit proposes (template, start of the template in the
file), hits that propose the same start are intersected, and a start is accepted when the mandatory
phrases stand at their places and enough of the template's words agree.

A one-phrase template is accepted only as a whole. It is posted under its rarest word, so
each place of the phrase is proposed by that word and none can be missed.

Defined results: a null or empty text has no words, no places, empty labels and score 0. Overlapping
places count each. Repeated rows are scanned one by one; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import map_batches, utf8

#: Letters lower-cased, everything in ASCII but letters and digits made a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


@dataclass(frozen=True)
class Template:
    """``required`` are phrases of ``text``; ``least`` is the share of its words that must agree."""

    name: str
    label: str
    text: str
    required: tuple[str, ...] = ()
    least: float = 0.8


def phrase(label: str, text: str) -> Template:
    return Template(f"phrase:{label}", label, text, (text,), 1.0)


# Phrases whose places are counted, and their labels.
BASE = (
    phrase("mit", "under the mit license"),
    phrase("apache-2", "apache license version 2"),
    phrase("cc-by-nc", "cc by nc"),
)

# Opening sentences of public licences.
MORE = (
    Template(
        "mit-grant",
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    Template(
        "isc-grant",
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "bsd-grant",
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "apache-notice",
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License",
        ("licensed under the apache license version 2 0",),
    ),
    Template(
        "gpl-notice",
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
        ("gnu general public license",),
    ),
    Template(
        "lgpl-notice",
        "lgpl",
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "mpl-notice",
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "unlicense",
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    phrase("cc-by", "creative commons attribution 4 0"),
    phrase("cc-by", "licensed under cc by 4 0"),
    phrase("cc-by-sa", "cc by sa"),
    phrase("cc0", "cc0 1 0 universal"),
    phrase("gpl", "spdx license identifier gpl"),
    phrase("mit", "spdx license identifier mit"),
    phrase("apache-2", "spdx license identifier apache 2 0"),
    phrase("proprietary", "all rights reserved"),
)

TEMPLATES = BASE + MORE

#: Words of a template under which it is posted, rarest first.
POSTED = 3


@dataclass
class Index:
    words: list[list[bytes]]
    required: list[list[tuple[int, int]]]
    least: list[float]
    labels: list[str]
    base: list[bool]
    idf: dict[bytes, float]
    posts: dict[bytes, list[tuple[int, int]]] = field(default_factory=dict)


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> list[bytes]:
    return sorted({w for t in templates for w in words_of(t.text.encode())})


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict:
    """In how many documents each template word occurs, and the number of documents."""
    counts = map_batches(
        docs.select(F.col("text").cast("string").alias("text")),
        _Frequencies(frozenset(vocabulary(templates))),
        "word binary, n long",
    )
    rows = counts.groupBy("word").agg(F.sum("n").alias("n")).collect()  # one row per template word
    return {bytes(r["word"]): r["n"] for r in rows}


class _Frequencies:
    def __init__(self, words: frozenset):
        self.words = words

    def __call__(self, batch: pa.RecordBatch) -> dict:
        counts: dict[bytes, int] = defaultdict(int)
        texts = utf8(batch, "text")
        for data in texts:
            for w in self.words.intersection(words_of(data)):
                counts[w] += 1
        counts[b""] += len(texts)
        return {"word": list(counts), "n": list(counts.values())}


def build_index(frequencies: dict, templates: tuple[Template, ...] = TEMPLATES) -> Index:
    total = frequencies.get(b"", 0)
    idf = {
        w: math.log((1 + total) / (1 + frequencies.get(w, 0))) for w in vocabulary(templates)
    }
    index = Index([], [], [], [], [], idf)
    posts: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for k, t in enumerate(templates):
        words = words_of(t.text.encode())
        places = []
        for text in t.required:
            want = words_of(text.encode())
            at = [i for i in range(len(words)) if words[i : i + len(want)] == want]
            if not at:
                raise ValueError(f"{t.name}: {text!r} is not part of the template")
            places.append((at[0], len(want)))
        index.words.append(words)
        index.required.append(places)
        index.least.append(t.least)
        index.labels.append(t.label)
        index.base.append(t in BASE)
        # a mandatory phrase must stand at its place, so its rarest word stands there too
        begin, size = places[0] if places else (0, len(words))
        inside = sorted(range(begin, begin + size), key=lambda i: (-idf[words[i]], i))
        outside = sorted(set(range(len(words))) - set(inside), key=lambda i: (-idf[words[i]], i))
        for i in [inside[0], *(inside[1:] + outside)[: POSTED - 1]]:
            posts[words[i]].append((k, i))
    index.posts = dict(posts)
    return index


def places(words: list[bytes], index: Index) -> list[tuple[int, int, float]]:
    """(template, start, share of agreeing words) of each accepted place, by template and start."""
    seen: dict[bytes, list[int]] = defaultdict(list)
    posts = index.posts
    for i, w in enumerate(words):
        if w in posts:
            seen[w].append(i)
    proposed: dict[tuple[int, int], int] = defaultdict(int)
    for w in sorted(seen, key=lambda w: (-index.idf[w], w)):
        for template, offset in posts[w]:
            for i in seen[w]:
                proposed[template, i - offset] += 1
    found = []
    for template, start in sorted(proposed):
        want = index.words[template]
        if any(
            start + a < 0 or words[start + a : start + a + n] != want[a : a + n]
            for a, n in index.required[template]
        ):
            continue
        low = max(0, -start)
        share = sum(map(bytes.__eq__, want[low:], words[start + low : start + len(want)]))
        if share >= index.least[template] * len(want):
            found.append((template, start, share / len(want)))
    return found


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, n_places long"
)


class _Scan:
    def __init__(self, index: Index, id_column: str):
        self.index, self.id_column = index, id_column

    def __call__(self, batch: pa.RecordBatch) -> dict:
        index = self.index
        out: dict[str, list] = {part.split()[0]: [] for part in SCHEMA.split(", ")}
        for data in utf8(batch, "text"):
            words = words_of(data)
            found = places(words, index)
            base = [(t, s) for t, s, _ in found if index.base[t]]
            labels = sorted({index.labels[t] for t, _, _ in found})
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(min((s for _, s in base), default=None))
            out["last_word"].append(max((s for _, s in base), default=None))
            out["base_labels"].append(",".join(sorted({index.labels[t] for t, _ in base})))
            out["labels"].append(",".join(labels))
            out["score"].append(max((share for _, _, share in found), default=0.0))
            out["n_places"].append(len(found))
        return out | {self.id_column: batch.column(self.id_column)}


def scan(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_column: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: words, base places and labels, all labels, best share."""
    index = build_index(document_frequencies(docs, templates), templates)
    kind = dict(docs.dtypes)[id_column]
    narrow = docs.select(id_column, F.col("text").cast("string").alias("text"))
    return map_batches(narrow, _Scan(index, id_column), f"{id_column} {kind}, {SCHEMA}")
