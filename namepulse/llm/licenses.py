"""License scans by template markup.

A template is a license's wording with two kinds of markup: optional regions, which a text may
leave out, and replaceable regions, which stand for any words up to a number. It is compiled
into a token automaton, whose transitions are words; a place in a text is accepted when all
mandatory wording from there on matches word by word.

Words are runs of letters, digits and non-ASCII characters, A to Z in lower case, so layout and
marks do not matter. Defined results: a null text counts as empty; a text without words or
without a license has empty labels, null places and score 0. Overlapping finds all count.
Repeated rows are scanned each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import once, text_bytes

# Phrases that are looked for as they stand, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Markup: <<optional>> ... <<end>> and <<any N>>, at most N words. A name may have several.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "released under the <<optional>> terms of the <<end>> MIT License"),
    ("mit", "licensed under the <<optional>> terms of the <<end>> MIT License"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files <<optional>> (the "Software") <<end>>, to deal
        in the Software without restriction, including without limitation the rights to use,
        copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice
        <<optional>> (including the next paragraph) <<end>> shall be included in all copies or
        substantial portions of the Software.
        <<optional>> THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any 20>> BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
        THE SOFTWARE. <<end>>""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and <<optional>> /or <<end>> distribute this software
        for any purpose with or without fee is hereby granted, provided that the above copyright
        notice and this permission notice appear in all copies.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: <<optional>> 1. <<end>>
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. <<optional>> 2. <<end>> Redistributions in binary
        form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.""",
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at
        <<any 12>> Unless required by applicable law or agreed to in writing, software distributed
        under the License is distributed on an "AS IS" BASIS""",
    ),
    ("apache-2.0", "licensed under the Apache License <<optional>> , Version <<end>> 2.0"),
    (
        "gpl-3.0",
        """licensed under the <<optional>> terms of the <<end>> GNU General Public License
        <<optional>> , version <<end>> 3 <<optional>> .0 <<end>>""",
    ),
    (
        "gpl-2.0",
        """licensed under the <<optional>> terms of the <<end>> GNU General Public License
        <<optional>> , version <<end>> 2 <<optional>> .0 <<end>>""",
    ),
    (
        "gpl-or-later",
        """This program is free software <<any 1>> you can redistribute it and/or modify it under
        the terms of the GNU General Public License as published by the Free Software Foundation
        <<any 6>> version <<any 4>> or <<optional>> (at your option) <<end>> any later version""",
    ),
    ("cc-by-nc", "licensed under <<any 4>> CC BY-NC <<optional>> -SA <<end>> <<any 1>>"),
    ("cc-by-sa", "licensed under <<any 4>> CC BY-SA"),
    ("cc-by-nd", "licensed under <<any 4>> CC BY-ND"),
    ("cc-by", "licensed under a Creative Commons Attribution <<any 2>> <<optional>> International <<end>> License"),
    ("copyright-reserved", "copyright <<any 12>> all rights reserved"),
]

# Everything but letters, digits and bytes of non-ASCII characters becomes a space.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_TO_WORDS).split()


@dataclass
class Automaton:
    """States 0 to final; from each: by word, by any word, and without one."""

    on_word: list[tuple[bytes, int] | None] = field(default_factory=list)
    on_any: list[int | None] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.on_word.append(None)
        self.on_any.append(None)
        self.free.append([])
        return len(self.free) - 1

    def closure(self, states: set[int]) -> set[int]:
        found, left = set(states), list(states)
        while left:
            for s in self.free[left.pop()]:
                if s not in found:
                    found.add(s)
                    left.append(s)
        return found

    def longest(self, words: list[bytes], start: int) -> int | None:
        """Where the longest accepted run from word `start` ends, or None."""
        final, states, end = len(self.free) - 1, self.closure({0}), None
        if final in states:
            end = start
        for at in range(start, len(words)):
            word, after = words[at], set()
            for s in states:
                if (t := self.on_word[s]) and t[0] == word:
                    after.add(t[1])
                if (t := self.on_any[s]) is not None:
                    after.add(t)
            if not after:
                break
            states = self.closure(after)
            if final in states:
                end = at + 1
        return end


def compiled(template: str) -> tuple[tuple[bytes, ...], Automaton]:
    """(the words before the first markup, the automaton) of a template."""
    automaton, opened, anchor, plain = Automaton(), [], [], True
    last = automaton.state()
    for part in re.split(r"(<<[^>]*>>)", template):
        if part == "<<optional>>":
            opened.append(last)
            plain = False
        elif part == "<<end>>":
            end = automaton.state()
            automaton.free[last].append(end)
            automaton.free[opened.pop()].append(end)
            last = end
        elif part.startswith("<<any"):
            plain = False
            first = last
            for _ in range(int(part[5:-2])):
                after = automaton.state()
                automaton.on_any[last] = after
                # Any number of the words may be missing.
                last = after
            end = automaton.state()
            for s in range(first, end):
                automaton.free[s].append(end)
            last = end
        else:
            for word in words_of(part.encode()):
                if automaton.on_word[last] or automaton.on_any[last] is not None:
                    raise ValueError("a state has one way on")
                after = automaton.state()
                automaton.on_word[last] = (word, after)
                last = after
                if plain:
                    anchor.append(word)
    if opened:
        raise ValueError("an optional region has no end")
    final = automaton.state()
    automaton.free[last].append(final)
    if not anchor:
        raise ValueError("a template begins with mandatory words")
    return tuple(anchor), automaton


class Scanner:
    """All phrases and templates, with the words each begins with as its anchor."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases.items()]
        self.anchors: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, template in templates:
            anchor, automaton = compiled(template)
            # A few words are enough to tell where a template may begin.
            key = b" " + b" ".join(anchor[:4]) + b" "
            self.anchors.setdefault(key, []).append((label, automaton))

    @staticmethod
    def _places(joined: bytes, phrase: bytes) -> list[int]:
        """Word numbers where a phrase with a space at both ends stands."""
        found, at, word, counted = [], joined.find(phrase), 0, 0
        while at >= 0:
            word += joined.count(b" ", counted, at)
            counted = at
            found.append(word)
            at = joined.find(phrase, at + 1)
        return found

    def scan(self, data: bytes):
        words = words_of(data)
        joined = b" " + b" ".join(words) + b" "
        places, spans, labels = [], [], set()
        for phrase, label in self.phrases:
            for at in self._places(joined, b" " + b" ".join(phrase) + b" "):
                places.append(at)
                spans.append((at, at + len(phrase)))
                labels.add(label)
        base = sorted(labels)
        for anchor, automata in self.anchors.items():
            for at in self._places(joined, anchor):
                for label, automaton in automata:
                    end = automaton.longest(words, at)
                    if end is not None:
                        spans.append((at, end))
                        labels.add(label)
        covered, reach = 0, 0
        for begin, end in sorted(spans):
            covered += max(0, end - max(begin, reach))
            reach = max(reach, end)
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(base),
            ",".join(sorted(labels)),
            covered / len(words) if words else 0.0,
            [f"{a}:{b}" for a, b in sorted(set(spans))],
        )


_TYPES = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "word_spans": pa.list_(pa.string()),
}
RESULT = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,"
    "base_labels:string,labels:string,score:double,word_spans:array<string>>"
)


def scanned(
    docs: DataFrame,
    text: str = "text",
    to: str = "license",
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """docs with a struct `to`: n_words; n_base, first_word, last_word and base_labels of the
    phrases; labels of phrases and templates; score, the share of the words that stand in a
    phrase or template; word_spans, all finds as `first:end` in words."""
    scanner = Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)

    def scan(texts: pa.Array) -> pa.Array:
        columns = list(zip(*map(scanner.scan, texts.to_pylist()))) or [[]] * len(_TYPES)
        arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES.values())]
        return pa.StructArray.from_arrays(arrays, list(_TYPES))

    return docs.withColumn(to, once(scan, RESULT)(text_bytes(text)))
