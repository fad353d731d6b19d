"""Licence scans with a generalised suffix automaton over licence words.

The automaton of all templates is small and travels with the code. Every text is streamed once: at each word it gives
the longest match that ends there (matching statistics). Matches that cannot grow are chained per template, in order and
with bounded gaps, into covered spans.
"""

from bisect import bisect
from collections.abc import Iterator, Mapping
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts

SHORTEST = 3
LEAST_COVER = 0.6
LARGEST_GAP = 12

# Phrases that name a licence.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Usual notices, one template per label and wording.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved no part of this work may be reproduced without written permission"),
]

#: Upper-case ASCII to lower case, other ASCII but letters and digits to a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def split_words(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class SuffixAutomaton:
    """All substrings of several word sequences, with the places (sequence, end) of each state."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for end, symbol in enumerate(sequence):
                last = self._extend(last, symbol)
                self.places[last].add((k, end))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]] |= self.places[state]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.places.append(set())
        return len(self.link) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            q = self.next[last][symbol]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, symbol, q)
        state = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)
        return state

    def statistics(self, symbols: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest match that ends at each symbol."""
        state = length = 0
        edges, link, longest = self.next, self.link, self.length
        for symbol in symbols:
            while state and symbol not in edges[state]:
                state = link[state]
                length = longest[state]
            if symbol in edges[state]:
                state = edges[state][symbol]
                length += 1
            yield state, length


class Scanner:
    """Phrases and notices as one automaton; scans one text at a time."""

    def __init__(self, phrases: Mapping[str, str], notices: list[tuple[str, str]]):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.templates = self.phrases + [(text.encode().split(), label) for label, text in notices]
        vocabulary = sorted({w for words, _ in self.templates for w in words})
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.lengths = [len(words) for words, _ in self.templates]
        self.automaton = SuffixAutomaton([[self.ids[w] for w in words] for words, _ in self.templates])
        # A phrase ends in the one state of its suffix-link chain that holds its length, and so in all states below that one.
        above, longest = self.automaton.link, self.automaton.length
        self.ending: list[list[tuple[int, int]]] = [[] for _ in above]
        for state in sorted(range(1, len(above)), key=longest.__getitem__):
            own = {(k, self.lengths[k]) for k, end in self.automaton.places[state]
                   if k < len(self.phrases) and end == self.lengths[k] - 1 and longest[above[state]] < self.lengths[k] <= longest[state]}
            self.ending[state] = sorted(own | set(self.ending[above[state]]))

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Number of words, phrase places (phrase, start) and covered spans (template, start, end, words covered)."""
        words = split_words(text)
        codes = np.fromiter(map(self.ids.get, words, repeat(0)), np.int32, len(words))
        known = np.concatenate([[False], codes > 0, [False]])
        turns = np.nonzero(known[1:] != known[:-1])[0]
        places, matches = [], {}
        for start, end in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            if end - start < SHORTEST:
                continue
            run = list(self.automaton.statistics(codes[start:end].tolist()))
            for i, (state, length) in enumerate(run):
                if length < SHORTEST:
                    continue
                places += [(k, start + i - n + 1) for k, n in self.ending[state] if n <= length]
                if i + 1 == len(run) or run[i + 1][1] <= length:
                    for k, at in self.automaton.places[state]:
                        matches.setdefault(k, []).append((start + i - length + 1, at - length + 1, length))
        spans = [(k, *span) for k, found in sorted(matches.items()) for span in chains(sorted(found))]
        return len(words), sorted(places, key=lambda x: x[1]), [s for s in spans if s[3] >= LEAST_COVER * self.lengths[s[0]]]


def chains(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Best chains (start, end, words covered) of matches (text start, template start, length), disjoint, by text order.

    A chain moves forward in text and template with at most ``LARGEST_GAP`` words left out of the text in between;
    overlaps are counted once.
    """
    best: list[tuple[int, int, int]] = []
    longest = max((n for _, _, n in matches), default=0)
    for k, (x, y, n) in enumerate(matches):
        cover, first = n, x
        for j in range(k - 1, -1, -1):
            a, b, m = matches[j]
            if a + longest + LARGEST_GAP < x:
                break
            gain = n - max(0, a + m - x, b + m - y)
            if a < x and b < y and x - (a + m) <= LARGEST_GAP and gain > 0 and best[j][2] + gain > cover:
                cover, first = best[j][2] + gain, best[j][0]
        best.append((first, x + n, cover))
    out: list[tuple[int, int, int]] = []
    for span in sorted(best, key=lambda s: (-s[2], s[0])):
        at = bisect(out, span)
        if (at == 0 or out[at - 1][1] <= span[0]) and (at == len(out) or span[1] <= out[at][0]):
            out.insert(at, span)
    return out


SCHEMA = ("doc_id {id}, n_words long, places array<struct<label:string,start:long,length:int>>, "
          "spans array<struct<label:string,start:long,end:long,covered:int,cover:double>>")


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: Mapping[str, str] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """Per document: number of words, every place of a phrase, and the covered template spans.

    Null and empty texts have no words and nothing found; repeated rows are scanned each; other columns are not read.
    Phrases have at least three words. A span covers at least 60 % of its template's words.
    """
    scanner = Scanner(phrases, notices)
    schema = SCHEMA.format(id=docs.schema[id_col].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = [t[1] for t in scanner.templates]
        size = scanner.lengths
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            n_words, places, spans = [], [], []
            for i in range(len(column)):
                n, phrase, span = scanner.scan(column[i].as_py())
                n_words.append(n)
                places.append([{"label": label[k], "start": at, "length": size[k]} for k, at in phrase])
                spans.append([{"label": label[k], "start": a, "end": b, "covered": c, "cover": c / size[k]}
                              for k, a, b, c in span])
            place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int32())]))
            cover = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                        ("covered", pa.int32()), ("cover", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(places, place), pa.array(spans, cover)],
                names=["doc_id", "n_words", "places", "spans"])

    return texts(docs, id_col, text_col).mapInArrow(run, schema)
