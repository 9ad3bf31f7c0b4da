"""License scans (operator 11): positional rare-token index over licence templates.

A template is a licence notice with the phrases that must stand in it word by word. The
corpus decides which of a template's words are rare: document frequencies of all template
words are counted over every document, and the ``ANCHORS`` words of highest inverse document frequency
(all, in a shorter template) are posted in an index of word -> (template, position).

A file is read once, whole. Each of its words that the index has is looked up; a hit's place in the
file less its position in the template is the offset at which the template would start. Hits of one
template whose offsets lie within ``DRIFT`` words of each other are a placement; its evidence is the share of
the template's anchor weight found there. A placement counts as a match when every key phrase stands
where the placement expects it (within the drift) and the evidence is at least ``SHARE``.

The index is bounded by the templates, so it travels with the tasks; documents are not shuffled,
and nothing of a file is cut: all words and all hits are looked at.

Defined cases: null text is empty (no words, no match, score 0); null and repeated ids and repeated rows are
rows of their own; equal weights are ordered by word, so ties are stable; an empty table gives an
empty result; other columns are read only when asked for with ``keep``.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import utf8

ANCHORS = 10
DRIFT = 3
SHARE = 0.5

#: Byte by byte: A-Z to lower case, every other ASCII character but digits and letters to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    phrases: tuple[str, ...]


#: The phrases that every scan reports, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Customary notices of public licences, each with the words that must stand in it.
TEMPLATES = (
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                    "license as published by the free software foundation either version 3 of the license or at your option any later version",
             ("free software", "gnu general public license")),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
                     "license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
                     "license as published by the free software foundation", ("gnu affero general public license",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
                       "license you may obtain a copy of the license at", ("apache license", "in compliance with the license")),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
                    "files the software to deal in the software without restriction including without limitation the rights to use copy "
                    "modify merge publish distribute sublicense and or sell copies of the software",
             ("permission is hereby granted", "to deal in the software without restriction")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
                    "provided that the above copyright notice and this permission notice appear in all copies", ("with or without fee is hereby granted",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
                    "conditions are met", ("redistribution and use in source and binary forms",)),
    Template("bsd", "released under the bsd license", ("bsd license",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
             ("eclipse public license",)),
    Template("bsl", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
                     "damages arising from the use of this software", ("in no event will the authors be held liable",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
             ("waived all copyright and related or neighboring rights",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
             ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
             ("creative commons attribution noncommercial",)),
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase starts; ``joined`` has single spaces between, before and after the words."""
    out, at, counted, word = [], joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", counted, at)
        out.append(word)
        counted, at = at, joined.find(phrase, at + 1)
    return out


def _between_spaces(phrase: str) -> bytes:
    return b" " + b" ".join(words_of(phrase.encode())) + b" "


# ------------------------------------------------------------------ index
def document_frequencies(texts: DataFrame, words: Sequence[bytes]) -> tuple[int, dict[bytes, int]]:
    """(documents, documents that hold a word, for each of ``words``) over all rows of the one text column."""
    wanted = frozenset(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            held[b""] += batch.num_rows
            for text in utf8(batch.column(0)):
                held.update(wanted.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    rows = texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r["word"]): r["n"] for r in rows}
    return found.pop(b"", 0), found


@dataclass(frozen=True)
class Index:
    """``postings``: word -> (template, position, weight) of its anchors; per template its label, anchor weight,
    number of words and key phrases as (between spaces, position)."""
    postings: dict[bytes, list[tuple[int, int, float]]]
    templates: list[tuple[str, float, int, list[tuple[bytes, int]]]]
    phrases: list[tuple[bytes, str]]

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int]], list[tuple[str, int, int, float]], float]:
        """(words, phrase places, matches, score) of one whole text."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        places = [(label, at) for phrase, label in self.phrases for at in phrase_places(joined, phrase)]
        hits: dict[int, list[tuple[int, int, float]]] = {}
        for at, word in enumerate(words):
            if word in self.postings:
                for template, position, weight in self.postings[word]:
                    hits.setdefault(template, []).append((at - position, position, weight))
        matches, score, known = [], 0.5 if places else 0.0, {}
        for template, found in hits.items():
            label, total, length, phrases = self.templates[template]
            for offset, share in placements(sorted(found), total):
                score = max(score, share / 2)
                if all(_stands(joined, phrase, offset + position, known) for phrase, position in phrases):
                    score = max(score, (share + 1) / 2)
                    if share >= SHARE:
                        matches.append((label, max(offset, 0), min(offset + length + DRIFT, len(words)), share))
        return len(words), sorted(places, key=lambda p: (p[1], p[0])), sorted(matches), min(score, 1.0)


def _stands(joined: bytes, phrase: bytes, at: int, known: dict[bytes, list[int]]) -> bool:
    """Whether the phrase starts within the drift after word ``at``, or before it."""
    if phrase not in known:
        known[phrase] = phrase_places(joined, phrase)
    places = known[phrase]
    nearest = bisect_left(places, at - DRIFT)
    return nearest < len(places) and places[nearest] <= at + DRIFT


def placements(hits: list[tuple[int, int, float]], total: float) -> Iterator[tuple[int, float]]:
    """(first offset, share of the anchor weight) of the hits, sorted by offset, that lie within the drift of each
    other. Of overlapping placements the first of those with the greatest share is given."""
    counts: Counter = Counter()
    weight, end, best = 0.0, 0, None
    for start, (offset, position, own) in enumerate(hits):
        while end < len(hits) and hits[end][0] <= offset + DRIFT:
            if not counts[hits[end][1]]:
                weight += hits[end][2]
            counts[hits[end][1]] += 1
            end += 1
        if best and offset > best[0] + DRIFT:
            yield best
            best = None
        share = weight / total
        if best is None or share > best[1] + 1e-12:
            best = (offset, share)
        counts[position] -= 1
        if not counts[position]:
            weight -= own
    if best:
        yield best


def build_index(texts: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> Index:
    """The anchors of each template by the frequencies of its words in all rows of the one text column."""
    notices = [words_of(t.notice.encode()) for t in templates]
    n, df = document_frequencies(texts, sorted({w for notice in notices for w in notice}))
    postings: dict[bytes, list[tuple[int, int, float]]] = {}
    described = []
    for number, (template, notice) in enumerate(zip(templates, notices)):
        # never zero: a word of every document still tells something
        weight = {w: math.log((n + 2) / (df.get(w, 0) + 1)) for w in notice}
        anchors = set(sorted(weight, key=lambda w: (-weight[w], w))[:ANCHORS])
        total = 0.0
        for position, word in enumerate(notice):
            if word in anchors:
                postings.setdefault(word, []).append((number, position, weight[word]))
                total += weight[word]
        joined = b" " + b" ".join(notice) + b" "
        keys = []
        for phrase in template.phrases:
            places = phrase_places(joined, _between_spaces(phrase))
            if not places:
                raise ValueError(f"the notice of {template.label!r} lacks its key phrase {phrase!r}")
            keys.append((_between_spaces(phrase), places[0]))
        described.append((template.label, total, len(notice), keys))
    return Index(postings, described, [(_between_spaces(p), label) for p, label in phrases])


# ------------------------------------------------------------------ scan
_FOUND = ("n_words bigint, places array<struct<label: string, start: bigint>>, "
          "matches array<struct<label: string, start: bigint, end: bigint, share: double>>, score double")
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))


def scan_licenses(docs: DataFrame, index: Index, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, n_words, places (of the reported phrases), matches (of templates) and score of every row."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [index.scan(t) for t in utf8(batch.column(0))]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[1:], pa.array([r[0] for r in rows], pa.int64()),
                pa.array([[{"label": a, "start": s} for a, s in r[1]] for r in rows], _PLACES),
                pa.array([[{"label": a, "start": s, "end": e, "share": x} for a, s, e, x in r[2]] for r in rows], _MATCHES),
                pa.array([r[3] for r in rows], pa.float64())], [*keep, "n_words", "places", "matches", "score"])

    types = dict(docs.dtypes)
    return docs.select(text, *keep).mapInArrow(scan, ", ".join([*(f"`{c}` {types[c]}" for c in keep), _FOUND]))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan_licenses(docs, build_index(docs.select("text")))
    base, own = F.col("places.label"), F.col("matches.label")
    return found.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
                        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
                        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
                        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"), "score")
