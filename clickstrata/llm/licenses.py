"""License notices in documents, by an exact set-similarity join with license templates.

A text block meets a template when it holds at least ``threshold`` of the
template's distinct words. Blocks are the lines of at most ``span`` words, where
``span`` is the template's length divided by the threshold, and all windows of
``span`` consecutive words, also across lines: a wrapped notice is found, and a
long line is no bag of words. Overlapping windows that meet a template count as
one match, the best and then the first; one that is no better than a line it overlaps is none.
The join orders the templates' words by the
number of times they occur in all documents, rarest first:

* prefix: a block that meets a template of ``m`` words with ``need = ceil(threshold * m)``
  of them holds one of its first ``m - need + 1`` words, so only blocks with one of those are compared;
* position: if the first of them found is number ``i``, at most ``m - i`` words can be shared;
* length: a block of fewer than ``need`` words cannot meet it, nor a window in which ``need`` of its words do not stand.

What remains is counted exactly. The templates are a fixed list of this module
(or the caller's; they are checked to be at most ``MAX_TEMPLATE_WORDS`` words).
Phrases are places where their words stand consecutively, across lines too.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, compared by 64-bit hashes.
A null or empty text has no words, no labels and score 0. Each document row
gives one row, repeated or null ids too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 100_000
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Sentences of public licenses and their usual notices, with the label they stand for.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License"),
    ("agpl", "This work is licensed under the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,line:long,score:double>>"
_MATCHES = pa.list_(pa.struct([("label", pa.string()), ("line", pa.int64()), ("score", pa.float64())]))


def _hashes(text: str) -> np.ndarray:
    return W.words_of(pa.array([text]), W.ALPHANUMERIC).hashes


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted table, or -1."""
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def _low_bits(table: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 16, bool)
    seen[table & np.uint64(0xFFFF)] = True
    return seen


def _numbers(hashes: np.ndarray, table: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words of the sorted table stand, and which they are."""
    at = np.flatnonzero(seen[hashes & np.uint64(0xFFFF)])
    number = _in_sorted(hashes[at], table)
    return at[number >= 0], number[number >= 0]


def word_counts(documents: DataFrame, table: np.ndarray, text_col: str = "text") -> np.ndarray:
    """Occurrences of each word of the sorted table in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(table), np.int64), _low_bits(table)
        for part in W.slices(batches):
            _, number = _numbers(W.words_of(part.column("text"), W.ALPHANUMERIC).hashes, table, seen)
            total += np.bincount(number, minlength=len(table))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(table))), pa.array(total)], ["k", "n"])

    counted = documents.select(F.col(text_col).alias("text")).mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(len(table), np.int64)
    for row in counted.collect():  # one row per template word
        out[row["k"]] = row["n"]
    return out


class Matcher:
    """The templates with their words ordered by rarity; the same on every executor."""

    def __init__(self, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]], threshold: float, table: np.ndarray, counts: np.ndarray) -> None:
        rank = np.empty(len(table), np.int64)
        rank[np.lexsort((table, counts))] = np.arange(len(table))
        self.table, self.seen = table, _low_bits(table)
        self.phrases = [(_hashes(text), label) for text, label in phrases]
        self.labels = [label for label, _ in templates]
        self.sizes, self.needs, self.spans, orders, prefix = [], [], [], [], []
        for k, (_, text) in enumerate(templates):
            words = _hashes(text)
            own = np.searchsorted(table, np.unique(words))
            own = own[np.argsort(rank[own])]
            need = max(1, -(-round(threshold * 1000 * len(own)) // 1000))
            self.sizes.append(len(own))
            self.needs.append(need)
            self.spans.append(max(len(words), -(-len(words) * 1000 // max(1, round(threshold * 1000)))))
            orders.append(own)
            prefix += [(word, k, i) for i, word in enumerate(own[: len(own) - need + 1])]
        # Template word sets as a matrix: fixed and small, templates x their words.
        self.has = np.zeros((len(templates), len(table)), bool)
        for k, own in enumerate(orders):
            self.has[k, own] = True
        self.rare = np.zeros_like(self.has)
        for word, k, _ in prefix:
            self.rare[k, word] = True
        prefix.sort()
        self.prefix_word, self.prefix_template, self.prefix_place = (np.array(x, np.int64) for x in zip(*prefix, strict=True)) if prefix else (np.empty(0, np.int64),) * 3

    def blocks(self, line: np.ndarray, sizes: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(line, template, containment) of the lines that meet a template.

        ``line`` and ``number``: the line of each template word found, in order of
        lines, and which word it is; ``sizes``: number of words per line.
        """
        low = np.searchsorted(self.prefix_word, number)
        many = np.searchsorted(self.prefix_word, number, side="right") - low
        entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        lines, template = np.repeat(line, many), self.prefix_template[entry]
        need, size = np.array(self.needs)[template], np.array(self.sizes)[template]
        open_ = (size - self.prefix_place[entry] >= need) & (sizes[lines] >= need) & (sizes[lines] <= np.array(self.spans)[template])
        for line_no, k in sorted(set(zip(lines[open_].tolist(), template[open_].tolist(), strict=True))):
            words = number[np.searchsorted(line, line_no) : np.searchsorted(line, line_no, side="right")]
            shared = int(self.has[k, np.unique(words)].sum())
            if shared >= self.needs[k]:
                yield line_no, k, shared / self.sizes[k]


    def windows(self, at: np.ndarray, number: np.ndarray, text: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(first word, last word, template, containment) of all windows that meet a template and begin with one of its words.

        ``at`` and ``number``: places of the template words found, and which they are;
        ``text``: the text of each; ``first``: where each text's words begin.
        """
        for k, (size, need, span) in enumerate(zip(self.sizes, self.needs, self.spans, strict=True)):
            own = np.flatnonzero(self.has[k, number])
            if not size or len(own) < need:
                continue
            places, words, texts = at[own], number[own], text[own]
            begin = np.flatnonzero((places[need - 1 :] - places[: len(own) - need + 1] < span) & (texts[need - 1 :] == texts[: len(own) - need + 1]))
            stop = np.searchsorted(places, np.minimum(places[begin] + span, first[texts[begin] + 1]))
            rare = np.concatenate([[0], np.cumsum(self.rare[k, words])])
            some = rare[stop] > rare[begin]
            begin, stop = begin[some], stop[some]
            step = max(1, (1 << 22) // span)
            for low in range(0, len(begin), step):
                a, b = begin[low : low + step], stop[low : low + step]
                inside = a[:, None] + np.arange(int((b - a).max()))
                shown = np.where(inside < b[:, None], words[np.minimum(inside, len(words) - 1)], -1)
                shown.sort(1)
                shared = (shown[:, 0] >= 0).astype(np.int64) + ((shown[:, 1:] != shown[:, :-1]) & (shown[:, 1:] >= 0)).sum(1)
                for x in np.flatnonzero(shared >= need).tolist():
                    yield int(places[a[x]]), int(places[b[x] - 1]), k, int(shared[x]) / size


def _merged(windows: Iterator[tuple[int, int, int, float]], lines: np.ndarray, by_line: dict[tuple[int, int], float]) -> Iterator[tuple[int, int, float]]:
    """(first word, template, containment) of the best of overlapping windows, without those that are no better than a line they overlap."""
    best = None
    for begin, last, k, share in windows:
        if any(by_line.get((line, k), 0.0) >= share for line in range(int(lines[begin]), int(lines[last]) + 1)):
            continue
        if best and best[1] == k and begin <= best[3]:
            best = (*((begin, k, share) if share > best[2] else best[:3]), max(last, best[3]))
            continue
        if best:
            yield best[:3]
        best = (begin, k, share, last)
    if best:
        yield best[:3]


def _lines(found: W.Words, texts: pa.Array) -> np.ndarray:
    """Line number of each word, counted over all texts of the slice; a text begins a new line."""
    data, offsets = W.text_bytes(texts)
    ends = np.union1d(np.flatnonzero(data == 10), offsets[1:] - 1)
    return np.searchsorted(ends, found.places)


def scan_licenses(
    documents: DataFrame,
    *,
    threshold: float = THRESHOLD,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Words, phrase places, labels and the matched blocks (``matches``: label, line from 0 where it begins, containment) per document.

    ``score`` is 1 where a phrase stands, else the largest containment that meets
    the threshold, else 0.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = np.unique(np.concatenate([_hashes(text) for _, text in templates] + [_hashes(text) for text, _ in phrases]))
    if len(table) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have {len(table)} different words, more than {MAX_TEMPLATE_WORDS}")
    matcher = Matcher(phrases, templates, threshold, table, word_counts(rows, table))
    sent = documents.sparkSession.sparkContext.broadcast(matcher)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = sent.value
        for part in W.slices(batches):
            n, found = part.num_rows, W.words_of(part.column("text"), W.ALPHANUMERIC)
            at, number = _numbers(found.hashes, matcher.table, matcher.seen)
            count, first, last = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
            base: list[set[str]] = [set() for _ in range(n)]
            for words, label in matcher.phrases:
                begin = at[found.hashes[at] == words[0]]
                begin = begin[begin + len(words) <= len(found.hashes)]
                for k in range(1, len(words)):
                    begin = begin[found.hashes[begin + k] == words[k]]
                text = found.texts[begin]
                begin, text = begin[found.texts[begin + len(words) - 1] == text], text[found.texts[begin + len(words) - 1] == text]
                place = begin - found.first[text]
                for t, p in zip(text.tolist(), place.tolist(), strict=True):
                    count[t] += 1
                    first[t] = p if first[t] < 0 else min(first[t], p)
                    last[t] = max(last[t], p)
                    base[t].add(label)
            lines = _lines(found, part.column("text"))
            sizes = np.bincount(lines, minlength=int(lines.max(initial=0)) + 1)
            line0 = _first_lines(part.column("text"))
            labels, matches = [set(x) for x in base], [[] for _ in range(n)]
            score = np.where(count > 0, 1.0, 0.0)
            if len(at):
                text_of = np.zeros(len(sizes), np.int64)
                text_of[lines] = found.texts
                met = list(matcher.blocks(lines[at], sizes, number))
                by_line = {(line, k): share for line, k, share in met}
                windows = matcher.windows(at, number, found.texts[at], found.first)
                for line, k, share in met + [(int(lines[begin]), k, share) for begin, k, share in _merged(windows, lines, by_line)]:
                    t = int(text_of[line])
                    labels[t].add(matcher.labels[k])
                    matches[t].append({"label": matcher.labels[k], "line": int(line - line0[t]), "score": share})
                    score[t] = max(score[t], share)
            arrays = [
                part.column("doc_id"),
                pa.array(found.counts(), pa.int64()),
                pa.array(count),
                pa.array(first, mask=first < 0),
                pa.array(last, mask=last < 0),
                pa.array([",".join(sorted(x)) for x in base]),
                pa.array([",".join(sorted(x)) for x in labels]),
                pa.array(score),
                pa.array(matches, _MATCHES),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])

    return rows.mapInArrow(scan, FOUND)


def _first_lines(texts: pa.Array) -> np.ndarray:
    """Number of each text's first line within the slice."""
    data, offsets = W.text_bytes(texts)
    ends = np.union1d(np.flatnonzero(data == 10), offsets[1:] - 1)
    return np.searchsorted(ends, offsets[:-1])
