"""Licence scans with a generalised suffix automaton over the words of licence templates.

A text is streamed through the automaton, which gives its matching statistics: for each word the
longest run ending there that occurs in some template. Matches that cannot grow are kept if
they are long, laid out against the places they have in a template, and chained in the order of
both text and template; what a chain covers of the template decides on the label. The automaton
depends on the templates alone and is built once in each task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .texts import ALNUM_LOWER, byte_texts, numbered, whole_text, word_lists

# The phrases that name a licence by themselves.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices of public licences.
NOTICES = [
    ("mit", "released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or any later version"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 2 of the License, or any later version"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("all-rights-reserved", "all rights reserved"),
]

#: Words of the shortest match that counts, words between two matches of a chain, and the share
#: of a template that a chain must cover for its label.
LONG, GAP, COVERED = 3, 12, 0.75


def _words(text: str) -> list[bytes]:
    return text.encode().translate(ALNUM_LOWER).split()


class Automaton:
    """All runs of words of the templates, with the places where each ends."""

    def __init__(self, templates: list[tuple[str, list[bytes]]], phrases: dict[str, str]):
        self.labels = [label for label, _ in templates]
        self.sizes = [len(words) for _, words in templates]
        self.numbers: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for k, (_, words) in enumerate(templates):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, self.numbers.setdefault(word, len(self.numbers) + 1))
                ends[last].add((k, at))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            ends[self.link[state]] |= ends[state]
        self.ends = [sorted(ends[state]) for state in range(len(self.next))]
        marks: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for phrase, label in phrases.items():
            words, state = _words(phrase), 0
            for word in words:
                state = self.next[state][self.numbers[word]]
            marks[state].append((len(words), label))
        self.marks: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.marks[state] = self.marks[self.link[state]] + marks[state]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, code: int) -> int:
        """The target of ``state`` under ``code``, cut off so that its longest run is one word longer."""
        target = self.next[state][code]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(code) == target:
            self.next[state][code] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, code: int) -> int:
        if code in self.next[last]:
            return self._split(last, code)
        made = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and code not in self.next[last]:
            self.next[last][code] = made
            last = self.link[last]
        if last >= 0:
            self.link[made] = self._split(last, code)
        return made


class Scan:
    """Matching statistics of one text, fed in pieces."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.state, self.size, self.total = automaton, 0, 0, 0
        self.base: list[tuple[int, str]] = []
        self.matches: list[tuple[int, int, int]] = []  # last word, size, state

    def feed(self, words: list[bytes]) -> None:
        get = self.automaton.numbers.get
        codes = np.fromiter((get(word, 0) for word in words), np.int32, len(words))
        edge = np.diff(np.r_[0, codes != 0, 0].astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # A run of known words that is too short holds no long match, unless it goes on in the next piece.
        inner = (ends - starts >= LONG) | (starts == 0) | (ends == len(codes))
        if len(codes) and codes[0] == 0:
            self.close(self.total)
        for a, b in zip(starts[inner].tolist(), ends[inner].tolist()):
            self._walk(codes[a:b].tolist(), self.total + a)
            if b < len(codes):
                self.close(self.total + b)
        self.total += len(codes)

    def _walk(self, codes: list[int], at: int) -> None:
        a, state, size = self.automaton, self.state, self.size
        for k, code in enumerate(codes, at):
            before, was = state, size
            while state and code not in a.next[state]:
                state = a.link[state]
                size = a.length[state]
            if (following := a.next[state].get(code)) is not None:
                state, size = following, size + 1
            else:
                size = 0
            if size <= was and was >= LONG:
                self.matches.append((k - 1, was, before))
            if size >= LONG:
                for length, label in a.marks[state]:
                    if size >= length:
                        self.base.append((k - length + 1, label))
        self.state, self.size = state, size

    def close(self, at: int) -> None:
        """No match goes on at word ``at``."""
        if self.size >= LONG:
            self.matches.append((at - 1, self.size, self.state))
        self.state = self.size = 0

    def chains(self) -> list[dict]:
        """The best chain of each template in each stretch of the text: label, words of the text, share covered."""
        a, placed = self.automaton, defaultdict(list)
        for last, size, state in self.matches:
            for template, end in a.ends[state]:
                placed[template].append((last - size + 1, end - size + 1, size))
        found = []
        for template, places in placed.items():
            links: list[list[int]] = []  # text end, template end, covered, text start of the chain
            done: list[list[int]] = []
            for start, begin, size in sorted(places):
                best = [start + size, begin + size, size, start]
                for other in reversed(links):
                    if start - other[0] > GAP:
                        break
                    gain = min(size, start + size - other[0], begin + size - other[1])
                    if gain > 0 and begin + size > other[1] and other[2] + gain > best[2] and other[1] - other[2] <= begin:
                        best = [start + size, begin + size, other[2] + gain, other[3]]
                links.append(best)
                links.sort()
                while links and start - links[0][0] > GAP:
                    done.append(links.pop(0))
            done += links
            for end, _, covered, start in _stretches(done):
                found.append({
                    "label": a.labels[template], "first": start, "last": end - 1,
                    "covered": min(1.0, covered / a.sizes[template]),
                })
        return sorted(found, key=lambda x: (x["first"], x["last"], x["label"], -x["covered"]))


def _stretches(chains: list[list[int]]) -> Iterator[list[int]]:
    """Of chains that overlap in the text, the one that covers most."""
    best: list[int] | None = None
    for chain in sorted(chains, key=lambda c: (c[3], c[0])):
        if best is None or chain[3] >= best[0]:
            if best is not None:
                yield best
            best = chain
        elif chain[2] > best[2]:
            best = chain
    if best is not None:
        yield best


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    templates = [(label, _words(phrase)) for phrase, label in BASE.items()] + [(label, _words(text)) for label, text in NOTICES]
    return Automaton(templates, BASE)


def scan(text: bytes, own: Automaton) -> Scan:
    found = Scan(own)
    for words in word_lists(text, ALNUM_LOWER):
        found.feed(words)
    found.close(found.total)
    return found


SPANS = "array<struct<label:string,first:bigint,last:bigint,covered:double>>"
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())]))


def licences(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``row``, word count, places of the base phrases, and template ``spans``.

    A span is the best chain over a stretch of words (from 0) and the share of the template that it
    covers. A null or empty text has no words and no spans; repeated rows get equal results; an
    empty table gives no rows; further columns are ignored.
    """
    rows = whole_text(numbered(docs.select("doc_id", "text"), "row"), "doc_id", "row")
    arrow, kind = to_arrow_type(docs.schema["doc_id"].dataType), docs.schema["doc_id"].dataType.simpleString()
    places = pa.list_(pa.struct([("first", pa.int64()), ("label", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton()
        for batch in batches:
            totals, base, spans = [], [], []
            for text in byte_texts(batch.column("text")):
                found = scan(text, own)
                totals.append(found.total)
                base.append([{"first": at, "label": label} for at, label in found.base])
                spans.append(found.chains())
            columns = [pa.array(totals, pa.int64()), pa.array(base, places), pa.array(spans, _SPANS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(arrow), batch.column("row"), *columns],
                names=["doc_id", "row", "n_words", "base", "spans"],
            )

    return rows.mapInArrow(
        run, f"doc_id {kind}, row bigint, n_words bigint, base array<struct<first:bigint,label:string>>, spans {SPANS}"
    )


def report(docs: DataFrame) -> DataFrame:
    found = licences(docs)
    sure = F.filter("spans", lambda s: s["covered"] >= COVERED)["label"]
    base = F.array_sort(F.array_distinct("base.label"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.first").alias("first_word"), F.array_max("base.first").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base.label", sure))), ",").alias("labels"),
        F.coalesce(F.array_max("spans.covered"), F.lit(0.0)).alias("score"),
    )
