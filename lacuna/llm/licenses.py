"""License scans: an exact containment join between blocks of text and license templates.

Words are counted over the whole corpus, as far as templates hold them, and put in one order, the
rarest first; the k-th occurrence of a word in a set is a token of its own, so repeats count. A
template of m tokens is met by a block that holds at least ceil(threshold * m) of them. Blocks are
windows of 2 s words that start at every s-th word, s the power of two not below m: any s words in a row lie
whole in one of them.

Three filters leave few pairs of block and template, and never a true one out. Prefix: the pair
shares a token among the m - need + 1 rarest of the template and the v - need + 1 rarest of the block's v
template words (a word in no template comes before all and matches none). Length: the block has
``need`` words that templates hold. Position: the shared token and those that stand behind it on both
sides suffice. What is left is counted exactly.

Templates go to the tasks in groups of at most ``GROUP_WORDS`` words (or one template), one pass over
the texts for each group, so what is broadcast does not grow with their number.

Beside the templates, ``phrases`` are found wherever their words stand consecutively.

Rows: a null text counts as empty and has no places. Repeated rows get equal results, doc_ids may be
null. Of templates met by several blocks, each block is a place. An empty table gives no rows, no
templates leave the phrases alone, templates without a word are met by nothing. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

THRESHOLD = 0.9
GROUP_WORDS, CHUNK = 200_000, 1 << 20
_OCCURRENCES = 1 << 24  # code * this + occurrence is a token
_BREAK = -2  # between texts

#: Phrases and the labels that they give.
PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))

#: Published license notices, by label.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
                   "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
                   "limitations under the License."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                     "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                     "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                     "the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the "
                     "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
                     "without specific prior written permission."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("mit-notice", "Released under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                 "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
                 "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
                 "included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)

# A-Z become a-z; what is neither ASCII letter or digit nor part of a code point above becomes a space
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_WORD).split()


def need(m: int, threshold: float) -> int:
    """Tokens that a block must hold of a template's ``m``."""
    return max(1, math.ceil(threshold * m - 1e-9))


def spacing(m: int) -> int:
    """Words from the start of one block to the next, for a template of ``m`` tokens."""
    return 1 << max(3, (m - 1).bit_length())


class Vocabulary:
    """The words of phrases and templates, numbered in the given order; other words are -1."""

    def __init__(self, words: Iterable[bytes]):
        self.code = {w: i for i, w in enumerate(words)}

    def codes(self, data: bytes) -> np.ndarray:
        """The codes of a text's words, cut out of bounded chunks of it."""
        out, at, get = [], 0, self.code.get
        while at < len(data):
            end = at + CHUNK
            if end < len(data):  # up to a place between words
                part = data[at:end].translate(_WORD)
                while part[-1] != 32 and end < len(data):
                    more = data[end:end + 4096].translate(_WORD)
                    cut = more.find(b" ")
                    part += more if cut < 0 else more[:cut + 1]
                    end += len(more) if cut < 0 else cut + 1
            else:
                part = data[at:].translate(_WORD)
            found = part.split()
            out.append(np.fromiter(map(get, found, repeat(-1)), np.int32, len(found)))
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.int32)


def numbered(codes: np.ndarray) -> np.ndarray:
    """The tokens of a set of words, in the global order: code and occurrence."""
    codes = np.sort(codes).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1]) if len(codes) else np.zeros(0, np.int64)
    return codes * _OCCURRENCES + np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))


class Index:
    """Phrases and templates over one vocabulary, with the templates' prefixes by spacing."""

    def __init__(self, vocabulary: Vocabulary, phrases, templates, threshold: float):
        self.vocabulary = vocabulary
        coded = lambda text: np.array([vocabulary.code[w] for w in words_of(text)], np.int64)
        self.phrases = [(label, coded(text)) for label, text in phrases]
        self.labels, self.tokens, self.prefix = [], [], {}
        for label, text in templates:
            tokens = numbered(coded(text))
            if not len(tokens):
                continue
            index = self.prefix.setdefault(spacing(len(tokens)), {})
            n = need(len(tokens), threshold)
            for i, token in enumerate(tokens[:len(tokens) - n + 1].tolist()):
                index.setdefault(token, []).append((len(self.tokens), i, len(tokens), n))
            self.labels.append(label)
            self.tokens.append(tokens)
        self.starts = {}  # by spacing: whether a word is in a prefix, for codes from -2 on
        for s, index in self.prefix.items():
            self.starts[s] = np.zeros(len(vocabulary.code) + 2, bool)
            self.starts[s][[token // _OCCURRENCES + 2 for token in index]] = True

    def phrase_places(self, codes: np.ndarray) -> Iterator[tuple[str, np.ndarray, int]]:
        """Label, first words and length of each phrase in the codes of several texts."""
        for label, phrase in self.phrases:
            if not len(phrase):
                continue
            rare = int(phrase.argmin())
            at = np.flatnonzero(codes == phrase[rare]) - rare
            at = at[(at >= 0) & (at + len(phrase) <= len(codes))]
            for i, code in enumerate(phrase):
                at = at[codes[at + i] == code]
            yield label, at, len(phrase)

    def template_places(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, str, int, int, float]]:
        """Text, label, first word, word behind the last and containment of each block and template that meet.
        ``starts``, ``sizes``: the place of each text's words in ``codes``."""
        for s, index in self.prefix.items():
            at = np.flatnonzero(self.starts[s][codes + 2])
            if not len(at):
                continue
            text = np.searchsorted(starts, at, "right") - 1
            last = np.maximum(-(-sizes[text] // s) - 2, 0)  # the last block of the text
            block = (at - starts[text]) // s
            pairs = np.concatenate([np.stack([text, np.minimum(block, last)]), np.stack([text, np.clip(block - 1, 0, last)])], axis=1)
            for t, b in np.unique(pairs, axis=1).T.tolist():
                end = min((b + 2) * s, int(sizes[t]))
                here = codes[starts[t] + b * s:starts[t] + end]
                tokens = numbered(here[here >= 0])
                for label, share in self._met(tokens, index):
                    yield t, label, b * s, end, share

    def _met(self, tokens: np.ndarray, index: dict) -> Iterator[tuple[str, float]]:
        v, tried = len(tokens), set()
        for j, token in enumerate(tokens.tolist()):
            for k, i, m, n in index.get(token, ()):
                # length, prefix and position; the first shared token decides, as none stands before it
                if k in tried:
                    continue
                tried.add(k)
                if v >= n and j <= v - n and 1 + min(m - i - 1, v - j - 1) >= n:
                    both = len(np.intersect1d(tokens, self.tokens[k], assume_unique=True))
                    if both >= n:
                        yield self.labels[k], both / m


def _runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of rows of about CHUNK bytes; a row is never cut."""
    at, held = 0, 0
    for i, n in enumerate(column):
        held += len(n.as_buffer()) if n.is_valid else 0
        if held >= CHUNK or i + 1 == len(column):
            yield at, i + 1
            at, held = i + 1, 0


def _coded(vocabulary: Vocabulary, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes of several texts with a break behind each, where each begins, and its number of words."""
    parts = [vocabulary.codes(t.as_py() or b"") for t in column]
    sizes = np.array([len(p) for p in parts], np.int64)
    gap = np.array([_BREAK], np.int32)
    return np.concatenate([x for p in parts for x in (p, gap)]), np.cumsum(sizes + 1) - sizes - 1, sizes


PLACES = "array<struct<label: string, start: long, end: long, score: double, base: boolean>>"


def _counted(rows: DataFrame, words: list[bytes]) -> dict[bytes, int]:
    """How often each of ``words`` occurs in all texts."""
    def run(batches):
        vocabulary, total = Vocabulary(words), np.zeros(len(words) + 1, np.int64)
        for b in batches:
            for t in b.column(1):
                total += np.bincount(vocabulary.codes(t.as_py() or b"") + 1, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(words)), pa.int32()), pa.array(total[1:])], ["code", "n"])

    found = rows.mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    n = {r.code: r.n for r in found.collect()}  # a row for each word of the templates
    return {w: n.get(i, 0) for i, w in enumerate(words)}


def _groups(templates: Sequence[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    out, held = [[]], 0
    for label, text in templates:
        n = len(words_of(text))
        if out[-1] and held + n > GROUP_WORDS:
            out.append([])
            held = 0
        out[-1].append((label, text))
        held += n
    return out


def _scan(rows: DataFrame, phrases, templates, threshold: float) -> DataFrame:
    words = sorted({w for _, text in (*phrases, *templates) for w in words_of(text)})
    n = _counted(rows, words)
    order = sorted(words, key=lambda w: (n[w], w))
    index = rows.sparkSession.sparkContext.broadcast((order, tuple(phrases), tuple(templates), threshold))

    def run(batches):
        order, *rest = index.value
        found = Index(Vocabulary(order), *rest)
        kind = rows_schema
        for b in batches:
            for lo, hi in _runs(b.column(1)):
                part = b.slice(lo, hi - lo)
                codes, starts, sizes = _coded(found.vocabulary, part.column(1))
                places = [list(x) for x in part.column(3).to_pylist()]
                for label, at, length in found.phrase_places(codes):
                    text = np.searchsorted(starts, at, "right") - 1
                    for t, first in zip(text.tolist(), (at - starts[text]).tolist()):
                        places[t].append({"label": label, "start": first, "end": first + length, "score": 1.0, "base": True})
                for t, label, first, end, share in found.template_places(codes, starts, sizes):
                    places[t].append({"label": label, "start": first, "end": end, "score": share, "base": False})
                for x in places:
                    x.sort(key=lambda p: (not p["base"], p["start"], p["end"], p["label"], p["score"]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes), pa.array(places, kind)], ["doc_id", "text", "n_words", "places"])

    rows_schema = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
    return rows.mapInArrow(run, f"doc_id long, text binary, n_words long, places {PLACES}")


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, ``n_words`` and ``places`` of every row of ``docs`` (doc_id, text): where phrases stand (``base``)
    and which blocks meet a template, as label, first word, word behind the last and containment."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "utf-8").alias("text"),
                       F.lit(0).cast("long").alias("n_words"), F.array().cast(PLACES).alias("places"))
    for i, group in enumerate(_groups(templates)):
        rows = _scan(rows, () if i else phrases, group, threshold)
    return rows.select("doc_id", "n_words", "places")


def digests(found: DataFrame) -> DataFrame:
    """The places as counts, labels and the greatest containment."""
    base = F.filter("places", lambda p: p.base)
    starts = F.transform(base, lambda p: p.start)
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p.label))), ",")
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("places", lambda p: p.score)), F.lit(0.0)).alias("score"))
