"""License scans through a positional index of rare words.

Templates (license notices and short phrases) are indexed by their words of
highest inverse document frequency, counted over all texts: word -> (template,
place in it). A file looks up its licence words; each posting says at which
word of the file the template would start. Postings of one template that
agree on the start, up to ``SLACK`` inserted or missing words, are a candidate
if at least half of the template's indexed words take part. A candidate
counts only if every mandatory key phrase stands at its place, word for word.

Texts are read as bytes, many at a time, with array operations; the words that
occur in no template are only counted. One pass counts document frequencies
(pre-aggregated; as many rows as templates have words), one finds the
licences: no shuffle of texts, no state between rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import id_and_bytes, joined, slices

#: Indexed words of a template, and words that may be missing or inserted.
RARE, SLACK = 8, 3
#: Bytes of text worked on at a time (a longer row is a piece of its own).
PIECE = 8 << 20


@dataclass(frozen=True)
class Template:
    """``keys``: phrases of ``text`` that must stand at their places. ``exact``: the
    text is one phrase, all of whose places count."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    exact: bool = False

    @cached_property
    def words(self) -> list[bytes]:
        return split(self.text)


#: The base phrases.
BASE = (
    Template("cc-by", "cc by", exact=True),
    Template("gpl", "general public license", exact=True),
    Template("reserved", "all rights reserved", exact=True),
)

#: Notices of common licences, as their own texts or usual references word them.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        ("permission is hereby granted free of charge", "associated documentation files"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "conditions are met"),
    ),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license", "v 2 0")),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc0-1.0", "CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0 universal",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

TEMPLATES = BASE + NOTICES

# byte -> folded byte of a word (letters, digits, all of longer characters) or 0
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[b for b in range(128) if not chr(b).isalnum()]] = 0


def split(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased."""
    codes = _FOLD[np.frombuffer(text.encode(), np.uint8)]
    return [w for w in codes.tobytes().split(b"\0") if w]


@dataclass
class Hits:
    """Words of a piece that occur in templates: ``at`` (number of the word among
    all words of the piece, rising), ``word`` (its number in the vocabulary) and
    ``row``; ``first`` is the number of each row's first word (one more entry: the end)."""

    at: np.ndarray
    word: np.ndarray
    row: np.ndarray
    first: np.ndarray


class Vocabulary:
    """Template words by number, found in bytes by array operations."""

    def __init__(self, templates: Sequence[Template]) -> None:
        self.words = sorted({w for t in templates for w in t.words})
        self.number = {w: i for i, w in enumerate(self.words)}
        self.longest = max(map(len, self.words), default=0)
        heads = np.array([_head(w) for w in self.words], np.uint64)
        self.order = np.argsort(heads, kind="stable")
        self.heads = heads[self.order]

    def find(self, data: np.ndarray, offsets: np.ndarray) -> Hits:
        codes = _FOLD[data]
        inside = codes > 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        start = np.flatnonzero(first)
        length = np.flatnonzero(last) + 1 - start
        begins = np.searchsorted(start, offsets)
        head = np.minimum(length, 255).astype(np.uint64)
        for j in range(7):
            fits = length > j
            letter = codes[np.where(fits, start + j, 0)] if len(codes) else codes
            head = head << np.uint64(8) | np.where(fits, letter, 0).astype(np.uint64)
        at, word = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.heads) and len(start):
            # length and first seven letters: all of a short word; longer ones are compared in full
            low = np.searchsorted(self.heads, head)
            low[low == len(self.heads)] = 0
            at = np.flatnonzero(self.heads[low] == head)
            low = low[at]
            word = np.full(len(at), -1)
            for step in range(len(self.heads)):
                # words of equal length and beginning: few
                place = low + step
                same = (place < len(self.heads)) & (word < 0)
                same[same] = self.heads[place[same]] == head[at[same]]
                if not same.any():
                    break
                number = self.order[place[same]]
                full = self._equal(codes, start[at[same]], length[at[same]], number)
                word[np.flatnonzero(same)[full]] = number[full]
            at, word = at[word >= 0], word[word >= 0]
        return Hits(at, word, np.searchsorted(begins, at, side="right") - 1, begins)

    def _equal(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether the letters after the seventh are those of the template words."""
        out = length <= 7
        for i in np.unique(number[~out]):
            mine = np.flatnonzero(~out & (number == i))
            tail = np.frombuffer(self.words[i], np.uint8)[7:]
            # equal lengths above seven are exact below 255; no template word is that long
            out[mine] = (codes[start[mine, None] + 7 + np.arange(len(tail))] == tail).all(axis=1)
        return out


def _head(word: bytes) -> int:
    return min(len(word), 255) << 56 | int.from_bytes(word[:7].ljust(7, b"\0"), "big")


def _holds(hits: Hits, at: np.ndarray, row: np.ndarray, word: int) -> np.ndarray:
    """Whether the words numbered ``at`` are ``word``, in the row given."""
    if not len(hits.at):
        return np.zeros(len(at), bool)
    i = np.minimum(np.searchsorted(hits.at, at), len(hits.at) - 1)
    return (hits.at[i] == at) & (hits.word[i] == word) & (hits.row[i] == row)


class Index:
    """Postings of the templates' words of highest IDF."""

    def __init__(self, templates: Sequence[Template], vocabulary: Vocabulary, idf: dict[bytes, float]) -> None:
        self.templates, self.vocabulary = templates, vocabulary
        self.numbers = [[vocabulary.number[w] for w in t.words] for t in templates]
        weight = [idf.get(w, 0.0) for w in vocabulary.words]

        def rarest(numbers: list[int], most: int) -> list[int]:
            return sorted(set(numbers), key=lambda i: (-weight[i], i))[:most]

        #: word -> (template, place) of the indexed words
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.indexed = []
        for t, numbers in enumerate(self.numbers):
            rare = set(rarest(numbers, len(numbers) if templates[t].exact else RARE))
            places = [(p, i) for p, i in enumerate(numbers) if i in rare]
            self.indexed.append(places)
            for p, i in places:
                self.postings.setdefault(i, []).append((t, p))
        #: looked up in falling IDF
        self.lookups = sorted(self.postings, key=lambda i: (-weight[i], i))
        self.keys = [[self._key(numbers, split(k), rarest) for k in template.keys] for numbers, template in zip(self.numbers, templates)]

    def _key(self, numbers: list[int], words: list[bytes], rarest) -> tuple[int, list[int], int]:  # noqa: ANN001
        """A key phrase: its place in the template, its words, and the place in it of the rarest."""
        phrase = [self.vocabulary.number[w] for w in words]
        place = next(p for p in range(len(numbers)) if numbers[p : p + len(phrase)] == phrase)
        return place, phrase, phrase.index(rarest(phrase, 1)[0])

    def candidates(self, hits: Hits) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By template, the ``row, low, high`` of starts on which enough postings agree."""
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        order = np.argsort(hits.word, kind="stable")
        bounds = np.searchsorted(hits.word[order], np.arange(len(self.vocabulary.words) + 1))
        for i in self.lookups:
            mine = order[bounds[i] : bounds[i + 1]]
            for t, place in self.postings[i]:
                if len(mine):
                    found.setdefault(t, []).append((hits.row[mine], hits.at[mine] - place, np.full(len(mine), place)))
        out = {}
        for t, parts in found.items():
            row, start, place = (np.concatenate(c) for c in zip(*parts))
            order_t = np.lexsort([start, row])
            row, start, place = row[order_t], start[order_t], place[order_t]
            slack = 0 if self.templates[t].exact else SLACK
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] - start[:-1] > slack)])
            cluster = np.cumsum(new) - 1
            distinct = np.unique(np.stack([cluster, place]), axis=1)[0]
            count = np.bincount(distinct, minlength=cluster[-1] + 1)
            need = len(self.indexed[t]) if self.templates[t].exact else -(-len(self.indexed[t]) // 2)
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(start)) - 1
            good = count >= need
            out[t] = (row[head[good]], start[head[good]], start[tail[good]])
        return out

    def verified(self, hits: Hits, t: int, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which candidates hold every key phrase at its place (an exact template: its whole text)."""
        numbers = self.numbers[t]
        if self.templates[t].exact:
            return np.logical_and.reduce([_holds(hits, low + p, row, i) for p, i in enumerate(numbers)])
        good = np.ones(len(row), bool)
        for place, phrase, anchor in self.keys[t]:
            at = hits.at[hits.word == phrase[anchor]] - anchor
            of = hits.row[hits.word == phrase[anchor]]
            whole = np.ones(len(at), bool)
            for p, i in enumerate(phrase):
                whole &= _holds(hits, at + p, of, i)
            at, of = at[whole], of[whole]
            # words are numbered through all rows: a place of the row at or after the least one
            first = np.maximum(low + place - SLACK, hits.first[row])
            i = np.searchsorted(at, first)
            inside = i < len(at)
            i = np.minimum(i, max(len(at) - 1, 0))
            good &= inside & (at[i] <= high + place + SLACK) & (of[i] == row) if len(at) else False
        return good

    def coverage(self, hits: Hits, t: int, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Share of the template's words that stand at their places, up to the slack."""
        if self.templates[t].exact:
            return np.ones(len(row))
        total = np.zeros(len(row))
        for place, number in enumerate(self.numbers[t]):
            at = hits.at[hits.word == number]
            first = np.maximum(low + place - SLACK, hits.first[row])
            last = np.minimum(high + place + SLACK, hits.first[row + 1] - 1)
            total += np.searchsorted(at, last, side="right") > np.searchsorted(at, first)
        return total / len(self.numbers[t])


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("coverage", pa.float64())])))]
)
FOUND_DDL = "doc_id long, n_words long, places array<struct<label:string,base:boolean,word:long,coverage:double>>"


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """How many rows hold each template word (number -1: all rows)."""
    for part in slices(batches, "body", PIECE):
        hits = vocabulary.find(*joined(part.column("body")))
        held = np.unique(np.stack([hits.row, hits.word]), axis=1)[1]
        n = np.bincount(held, minlength=len(vocabulary.words))
        word = np.append(np.flatnonzero(n), -1)
        yield pa.record_batch([pa.array(word.astype(np.int32)), pa.array(np.append(n[n > 0], part.num_rows))], ["word", "n"])


def _places(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "body", PIECE):
        hits = index.vocabulary.find(*joined(part.column("body")))
        rows: list[list[dict]] = [[] for _ in range(part.num_rows)]
        for t, (row, low, high) in sorted(index.candidates(hits).items()):
            good = index.verified(hits, t, row, low, high)
            row, low, high = row[good], low[good], high[good]
            template = index.templates[t]
            place = np.maximum(low, hits.first[row]) - hits.first[row]
            for r, w, c in zip(row.tolist(), place.tolist(), index.coverage(hits, t, row, low, high).tolist()):
                rows[r].append({"label": template.label, "base": template.exact, "word": w, "coverage": c})
        for found in rows:
            found.sort(key=lambda f: (f["word"], f["label"]))
        yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(hits.first)), pa.array(rows, _FOUND.field("places").type)], schema=_FOUND)


def document_frequencies(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Rows of ``docs``, and of these how many hold each template word."""
    vocabulary = Vocabulary(templates)
    slim = id_and_bytes(docs, id_col, text_col).select("body")
    counts = slim.mapInArrow(lambda it: _frequencies(it, vocabulary), "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # at most one row a template word
    found = {r["word"]: r["n"] for r in counts.collect()}
    return found.pop(-1, 0), {vocabulary.words[i]: n for i, n in found.items()}


def find_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, places`` for every row of ``docs``: ``places`` is an
    array of ``label, base, word, coverage``, by ``word`` (where the
    template starts, words counted from 0). An exact template is listed with every
    place, another once for each stretch of starts that its words agree on.

    Null and empty texts have no words; repeated rows and null ids stay; other
    columns are ignored; an empty table gives no rows.
    """
    total, frequency = document_frequencies(docs, templates, id_col, text_col)
    vocabulary = Vocabulary(templates)
    idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary.words}
    index = Index(templates, vocabulary, idf)
    return id_and_bytes(docs, id_col, text_col).mapInArrow(lambda it: _places(it, index), FOUND_DDL)


def digest(found: DataFrame) -> DataFrame:
    """One row for each row of ``found``: words, base places, and labels, sorted
    and comma-joined. ``score`` is the largest coverage of a place (0 without one)."""
    base = F.filter("places", lambda p: p["base"])

    def labels(places):  # noqa: ANN001, ANN202
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    words = F.transform(base, lambda p: p["word"])
    score = F.coalesce(F.array_max(F.transform("places", lambda p: p["coverage"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"), score.alias("score"),
    )
