"""License scan by a positional index of rare licence words.

Templates are short licence texts with phrases that must be there. An index holds, for each word of a template,
the places where it stands. The rarity of these words (at most a few hundred, whatever the corpus holds) is
counted over all documents. For each template that the words of a file could cover, the rarest of them vote for
a place in the file minus their place in the template, and votes of near differences are joined, so words
that were put in or left out do not break a match. So many words vote that the others cannot cover the template
alone: no place that holds it is without a vote, whatever other templates stand in the file. The template with
its differences is then compared in full: every licence word near its place counts with its rarity. A label is
given where a mandatory phrase stands there word by word.

Base labels need the phrase alone: ``mit license``, ``apache license``, ``general public license``.

Defined results: a null text has no words, no labels and score 0; first_word and last_word are null without a
base place; null doc_ids and repeated rows are judged row by row; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math
import string
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, texts

# fixed values: phrases and labels of the base rule
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: label, mandatory phrases (one must stand in the text), template
TEMPLATES = [
    ("mit-notice", ["released under the mit license", "licensed under the mit license"],
     "released under the mit license"),
    ("mit-text", ["permission is hereby granted free of charge to any person obtaining a copy"],
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction including without limitation the rights to "
     "use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2.0", ["licensed under the apache license version 2 0"],
     "licensed under the apache license version 2 0 you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at"),
    ("apache-2.0-notice", ["licensed under the apache license version 2 0"], "licensed under the apache license version 2 0"),
    ("gpl-3.0", ["gnu general public license version 3"],
     "this work is licensed under the gnu general public license version 3"),
    ("gpl-text", ["under the terms of the gnu general public license"],
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation"),
    ("lgpl", ["gnu lesser general public license"],
     "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
     "general public license as published by the free software foundation"),
    ("bsd", ["redistribution and use in source and binary forms with or without modification are permitted"],
     "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met redistributions of source code must retain the above copyright notice this "
     "list of conditions and the following disclaimer"),
    ("isc", ["permission to use copy modify and or distribute this software for any purpose"],
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", ["mozilla public license"],
     "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at"),
    ("cc-by-nc-4.0", ["licensed under cc by nc 4 0"], "licensed under cc by nc 4 0"),
    ("cc-by-4.0", ["licensed under cc by 4 0"], "licensed under cc by 4 0"),
    ("cc-by-sa", ["creative commons attribution sharealike"],
     "this work is licensed under a creative commons attribution sharealike international license"),
]

#: letters and digits stay, A-Z are lower-cased, every byte from 0x80 on is part of a word, the rest ends words
_KEEP = set(map(ord, string.ascii_lowercase + string.digits)) | set(range(0x80, 0x100))
_TABLE = bytes(c if c in _KEEP else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Index:
    """Postings of template words, weighted by how rare they are in the corpus."""

    def __init__(self, templates: list[tuple[str, list[str], str]], rows: int = 0, seen: dict[bytes, int] | None = None,
                 needed: float = 0.6):
        self.labels = [t[0] for t in templates]
        self.phrases = [[tuple(p.encode().split()) for p in t[1]] for t in templates]
        self.words = [t[2].encode().split() for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            for i, w in enumerate(words):
                self.postings[w].append((t, i))
        seen = seen or {}
        self.idf = {w: math.log((rows + 1) / (seen.get(w, 0) + 0.5)) + 0.1 for w in self.postings}
        self.total = [sum(self.idf[w] for w in words) for words in self.words]
        self.needed = needed

    def possible(self, known: set[bytes]) -> set[int]:
        """Templates that these words could cover to the needed share; most files have none."""
        held: dict[int, float] = defaultdict(float)
        for w in known:
            for t, _ in self.postings[w]:
                held[t] += self.idf[w]
        return {t for t, x in held.items() if x >= self.needed * self.total[t]}

    def voters(self, t: int, known: set[bytes], rare: int) -> list[bytes]:
        """The rarest known words of a template: ``rare`` of them, or as many as leave too little without them."""
        left = Counter(w for w in self.words[t] if w in known)
        order = sorted(left, key=lambda w: (-self.idf[w], w))
        rest = sum(n * self.idf[w] for w, n in left.items())
        for k, w in enumerate(order):
            if k >= rare and rest < self.needed * self.total[t] * (1 - 1e-9):
                return order[:k]
            rest -= left[w] * self.idf[w]
        return order

    def scan(self, words: list[bytes], known: set[bytes], rare: int = 12, apart: int = 4) -> tuple[set[str], float]:
        """Labels and the best weighted share of a template that stands in the text."""
        templates, needed = self.possible(known), self.needed
        if not templates:
            return set(), 0.0
        places: dict[bytes, list[int]] = {w: [] for w in known if any(t in templates for t, _ in self.postings[w])}
        for i, w in enumerate(words):
            if w in places:
                places[w].append(i)
        votes: dict[int, set[int]] = {t: set() for t in templates}
        for t in templates:
            for w in self.voters(t, known, rare):
                votes[t].update(p - i for u, i in self.postings[w] if u == t for p in places[w])
        labels, best = set(), 0.0
        for t, found in votes.items():
            starts, last = [], None
            for d in sorted(found):  # near differences are one place of the template
                if last is None or d - last > apart:
                    starts.append([d, d])
                starts[-1][1] = last = d
            for low, high in starts:
                score = self.covered(t, low - apart, high + apart, places)
                if score < needed or score <= best and self.labels[t] in labels:
                    continue
                if any(phrase_places(words, p, max(0, low - apart), high + apart + len(self.words[t])) for p in self.phrases[t]):
                    labels.add(self.labels[t])
                    best = max(best, score)
        return labels, best

    def covered(self, t: int, low: int, high: int, places: dict[bytes, list[int]]) -> float:
        held = 0.0
        for i, w in enumerate(self.words[t]):
            at = places.get(w)
            if at is not None:
                k = bisect_left(at, low + i)
                if k < len(at) and at[k] <= high + i:
                    held += self.idf[w]
        return min(1.0, held / self.total[t])


def phrase_places(words: list[bytes], phrase: tuple[bytes, ...], start: int, end: int) -> list[int]:
    """Where the phrase stands word by word, starting at ``start`` or later and ending before ``end``."""
    out, at, n = [], start - 1, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at + 1, max(0, end - n + 1))
        except ValueError:
            return out
        if tuple(words[at:at + n]) == phrase:
            out.append(at)


_BASE = [(tuple(p.encode().split()), label) for p, label in BASE.items()]


def seen_in(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """Rows, and in how many texts each word of the (small) vocabulary stands."""
    names = sorted(vocabulary)

    def count(batches):
        held, n = Counter(), 0
        for (found,) in texts(batches, "text"):
            for t in found:
                held.update(vocabulary.intersection(words_of(t)))
                n += 1
        yield pa.record_batch([pa.array([-1, *range(len(names))], pa.int32()),
                               pa.array([n, *(held[w] for w in names)], pa.int64())], ["word", "n"])

    sums = dict(docs.mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n")).collect())
    return sums.get(-1, 0), {w: sums.get(i, 0) for i, w in enumerate(names)}


def scan_licenses(docs: DataFrame, templates: list[tuple[str, list[str], str]] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    templates = templates or TEMPLATES
    rows, seen = seen_in(docs.select("text"), set(Index(templates).postings))
    index = Index(templates, rows, seen)

    def scan(batches):
        for ids, found in texts(batches, "doc_id", "text"):
            out = []
            for text in found:
                words = words_of(text)
                unique = set(words)
                known = index.postings.keys() & unique
                at, base, labels, score = [], set(), set(), 0.0
                for phrase, label in _BASE:
                    if unique.issuperset(phrase) and (held := phrase_places(words, phrase, 0, len(words))):
                        at += held
                        base.add(label)
                if known:
                    labels, score = index.scan(words, known)
                out.append((len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                            ",".join(sorted(base | labels)), max(score, 0.5 if base else 0.0)))
            cols = list(zip(*out)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.record_batch([pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                  ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.mapInArrow(scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                 "base_labels string, labels string, score double")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


QUERIES = {"op7_licenses": op7_licenses}
ORACLES: dict[str, str] = {}
