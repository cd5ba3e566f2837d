"""License scan by template markup.

A template is wording with optional regions ``[[...]]``, choices ``{{a|b c}}`` and replaceable regions ``<<n>>`` of up to
``n`` words.  It is compiled once into an automaton over words; a text holds the license where the automaton, started at
the template's fixed opening words, reaches its end: the mandatory wording matches exactly, word by word.

Texts are independent, so one pass over them does it, without a shuffle.  Short base phrases are counted in the same pass.

Defined cases: null text is empty: no words, no labels, score 0; equal rows get equal results; long texts are read whole; other
columns are kept, those named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Public license notices as templates.
TEMPLATES = {
    "mit": [
        "{{released|licensed|distributed|available}} under the [[terms of the]] mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "spdx license identifier mit",
    ],
    "apache-2.0": [
        "licensed under the [[terms of the]] apache license [[version]] 2 0",
        "apache software license [[version]] 2 0",
        "spdx license identifier apache 2 0",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "{{released|licensed}} under the {{new|modified|simplified|2 clause|3 clause}} bsd license",
    ],
    "gpl": [
        "[[this {{work|program|software|library}} is]] {{released|licensed|distributed|free software}} under the [[terms of the]] gnu "
        "[[lesser]] [[affero]] general public license",
        "it under the terms of the gnu [[lesser]] [[affero]] general public license as published by the free software foundation",
    ],
    "cc-by": ["licensed under [[a]] {{cc by|creative commons attribution}} [[international]] 4 0 [[international]] [[license]]"],
    "cc-by-nc": ["licensed under [[a]] {{cc by nc|creative commons attribution noncommercial}} [[international]] 4 0"],
    "cc-by-sa": ["licensed under [[a]] {{cc by sa|creative commons attribution sharealike}} [[international]] 4 0"],
    "copyright": ["copyright [[c]] <<8>> all rights reserved"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}

COLUMNS = {"n_words": T.LongType(), "n_base": T.LongType(), "first_word": T.LongType(), "last_word": T.LongType(),
           "base_labels": T.StringType(), "labels": T.StringType(), "score": T.DoubleType()}

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Automaton:
    """States 0 ... n; ``moves[state]`` maps a word, or None for any word, to the states that follow; ``free`` steps read nothing."""

    def __init__(self, template: str) -> None:
        self.moves: list[dict[bytes | None, set[int]]] = [{}]
        self.free: dict[int, set[int]] = {}
        self.end = self._sequence(re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|<<\d+>>|[^\s\[\]{}<>]+", template), 0)
        self.start = self._close({0})
        self.openings = sorted({w for s in self.start for w in self.moves[s] if w is not None})

    def _new(self) -> int:
        self.moves.append({})
        return len(self.moves) - 1

    def _word(self, at: int, word: bytes | None, to: int | None = None) -> int:
        to = self._new() if to is None else to
        self.moves[at].setdefault(word, set()).add(to)
        return to

    def _skip(self, at: int, to: int) -> None:
        self.free.setdefault(at, set()).add(to)

    def _sequence(self, items: list[str], at: int) -> int:
        opened: list[int] = []
        for item in items:
            if item == "[[":
                opened.append(at)
            elif item == "]]":
                self._skip(opened.pop(), at)
            elif item.startswith("{{"):
                ends = []
                for choice in item[2:-2].split("|"):
                    end = at
                    for word in choice.split():
                        end = self._word(end, word.encode())
                    ends.append(end)
                at = self._new()
                for end in ends:
                    self._skip(end, at)
            elif item.startswith("<<"):
                states = [at]
                for _ in range(int(item[2:-2])):
                    states.append(self._word(states[-1], None))
                at = self._new()
                for state in states:
                    self._skip(state, at)
            else:
                at = self._word(at, item.encode())
        return at

    def _close(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free.get(todo.pop(), ()):
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def longest(self, words: list[bytes], at: int) -> int:
        """How many words from ``at`` on the automaton accepts, at most; 0 if it accepts none."""
        states, best, read = self.start, 0, 0
        while states and at + read < len(words):
            word = words[at + read]
            states = self._close({to for s in states for key in (word, None) for to in self.moves[s].get(key, ())})
            read += 1
            if self.end in states:
                best = read
        return best


class Scanner:
    """All templates, and the two-word openings at which one of them can start."""

    def __init__(self, templates: dict[str, list[str]]) -> None:
        self.starts: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, texts in templates.items():
            for text in texts:
                machine = Automaton(text)
                for first in machine.openings:
                    after = machine._close({to for s in machine.start for to in machine.moves[s].get(first, ())})
                    for second in {w for s in after for w in machine.moves[s]}:
                        key = first if second is None else first + b" " + second
                        self.starts.setdefault(key, []).append((label, machine))
        keys = sorted(self.starts, key=len, reverse=True)
        self.opening = re.compile(b" (?=(" + b"|".join(map(re.escape, keys)) + b") )")

    def scan(self, text: str | None) -> tuple:
        folded = (text or "").encode().translate(_FOLD)
        words = folded.split()
        line = b" " + b" ".join(words) + b" "
        places, base, covered = [], set(), set()
        for phrase, label in PHRASES.items():
            needle, at = b" " + phrase.encode() + b" ", line.find(b" " + phrase.encode() + b" ")
            place = counted = 0
            while at >= 0:
                place += line.count(b" ", counted, at)
                counted = at
                places.append(place)
                base.add(label)
                covered.update(range(place, place + len(phrase.split())))
                at = line.find(needle, at + 1)
        labels = set(base)
        place = counted = 0
        for found in self.opening.finditer(line):
            place += line.count(b" ", counted, found.start())
            counted = found.start()
            for key in (found[1], found[1].split(b" ")[0]):
                for label, machine in self.starts.get(key, ()):
                    if size := machine.longest(words, place):
                        labels.add(label)
                        covered.update(range(place, place + size))
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                ",".join(sorted(labels)), len(covered) / len(words) if words else 0.0)


def find_licenses(docs: DataFrame, column: str = "text", templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels and score, the share of words that licenses cover."""
    keep = [c for c in docs.columns if c not in COLUMNS]
    schema = T.StructType([*docs.select(*keep).schema.fields, *[T.StructField(n, k) for n, k in COLUMNS.items()]])
    chosen = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            rows = [scanner.scan(text.as_py()) for text in batch.column("_read")]
            made = [pa.array([row[n] for row in rows], kind) for n, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=[*keep, *COLUMNS])

    return docs.select(*keep, F.col(column).alias("_read")).mapInArrow(run, schema)
