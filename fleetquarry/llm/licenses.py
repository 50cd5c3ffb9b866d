"""License texts by template markup: optional and replaceable regions compiled into token automata.

A template is wording with two kinds of regions, as license lists write them: ``[[...]]`` may be absent,
``{{name:1-8}}`` stands for 1 to 8 words of any kind. It is compiled into an automaton over words, and all automata
run together. A stretch of a text is accepted if its mandatory wording matches word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import slices

BATCH_BYTES = 2 << 20

# fixed values: phrases that give a label by themselves
PHRASES = {"apache": ["apache license"], "gpl": ["general public license"], "mit": ["mit license"]}

# fixed values: wording of public licenses and of the notices that refer to them
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {{holder:1-12}} BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
    "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
TEMPLATES = {
    "apache-2.0": [
        "licensed under the [[terms of the]] Apache License, [[(the {{quoted:1-2}}),]] Version 2.0",
    ],
    "bsd-2-clause": [_BSD_HEAD],
    "bsd-3-clause": [
        _BSD_HEAD + " [[3.]] Neither the name of {{holder:1-12}} nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ],
    "cc-by-4.0": [
        "licensed under [[a]] CC BY 4.0",
        "[[licensed under a]] Creative Commons Attribution 4.0 International [[Public]] License",
    ],
    "cc-by-nc-4.0": [
        "licensed under [[a]] CC BY-NC 4.0",
        "[[licensed under a]] Creative Commons Attribution-NonCommercial 4.0 International [[Public]] License",
    ],
    "gpl-2.0": [
        "licensed under the [[terms of the]] [[GNU]] General Public License, [[as published by the Free Software Foundation;]] "
        "[[either]] version 2",
    ],
    "gpl-3.0": [
        "licensed under the [[terms of the]] [[GNU]] General Public License, [[as published by the Free Software Foundation;]] "
        "[[either]] version 3",
    ],
    "gpl-3.0-or-later": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "mit": [
        "[[The]] MIT License [[(MIT)]] Copyright [[(c)]] {{years and holder:1-20}} Permission is hereby granted, free of charge",
        "licensed under the [[terms of the]] MIT License",
        "released under the [[terms of the]] MIT License",
    ],
    "mit-text": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "[[(including the next paragraph)]] shall be included in all copies or substantial portions of the Software. [[" + _AS_IS + "]]",
    ],
}

MATCH = "array<struct<label:string,start:long,stop:long,mandatory:long,phrase:boolean>>"


def words_of(text: str) -> list[bytes]:
    """Words after A-Z are lower-cased: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())


def parts_of(template: str) -> list:
    """A template as nested parts: a word (bytes), ("any", least, most), or ("maybe", parts)."""
    out, stack = [], []
    for token in re.findall(r"\[\[|\]\]|\{\{[^{}]*\}\}|(?:(?!\[\[|\]\]|\{\{).)+", template, re.S):
        if token == "[[":
            stack.append(out)
            out = []
        elif token == "]]":
            if not stack:
                raise ValueError(f"an optional region ends that did not begin: {template}")
            inner, out = out, stack.pop()
            out.append(("maybe", inner))
        elif token.startswith("{{"):
            least, most = re.fullmatch(r"\{\{.*:(\d+)-(\d+)\}\}", token).groups()
            out.append(("any", int(least), int(most)))
        else:
            out += words_of(token)
    if stack:
        raise ValueError(f"an optional region has no end: {template}")
    return out


def mandatory(parts: list) -> int:
    """Words that every accepted text has literally."""
    return sum(isinstance(p, bytes) for p in parts)


@dataclass
class Automaton:
    """All templates as one automaton over words, made deterministic as texts are read.

    A state of the nondeterministic automaton is a number; ``by_word``, ``by_any`` and ``free`` are its moves on a
    given word, on any word, and on none; ``final`` the entry it accepts.
    """

    entries: list[tuple[str, int, bool]] = field(default_factory=list)
    by_word: list[dict[bytes, int]] = field(default_factory=list)
    by_any: list[int | None] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    final: list[int | None] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)

    def state(self) -> int:
        self.by_word.append({}), self.by_any.append(None), self.free.append([]), self.final.append(None)
        return len(self.final) - 1

    def add(self, label: str, template: str, phrase: bool = False) -> None:
        parts = parts_of(template)
        first = self.state()
        last = self._chain(parts, first)
        self.final[last] = len(self.entries)
        self.entries.append((label, mandatory(parts), phrase))
        self.starts.append(first)
        if any(self.by_any[s] is not None or self.final[s] is not None for s in self._closed({first})):
            raise ValueError(f"a template needs a word before its first replaceable region: {template}")

    def _chain(self, parts: list, at: int) -> int:
        for part in parts:
            if isinstance(part, bytes):
                after = self.state()
                self.by_word[at][part] = after
            elif part[0] == "any":
                after = at
                steps = []
                for k in range(part[2]):
                    if k >= part[1]:
                        steps.append(after)
                    nxt = self.state()
                    self.by_any[after] = nxt
                    after = nxt
                for s in steps:
                    self.free[s].append(after)
                # a state of its own, so that no literal move joins the region's last one
                nxt = self.state()
                self.free[after].append(nxt)
                after = nxt
            else:
                inner = self.state()
                self.free[at].append(inner)
                after = self.state()
                self.free[self._chain(part[1], inner)].append(after)
                self.free[at].append(after)
            at = after
        return at

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return frozenset(out)

    def ready(self) -> Automaton:
        self._known = {w for moves in self.by_word for w in moves}
        self._start = self._closed(set(self.starts))
        self.firsts = {w for s in self._start for w in self.by_word[s]}
        self._sets: dict[frozenset[int], int] = {}
        self._moves: list[dict[bytes, int]] = []
        self._accepts: list[list[int]] = []
        self._members: list[frozenset[int]] = []
        self._dead, self._begin = self._number(frozenset()), self._number(self._start)
        return self

    def _number(self, states: frozenset[int]) -> int:
        if states not in self._sets:
            self._sets[states] = len(self._members)
            self._members.append(states)
            self._moves.append({})
            self._accepts.append(sorted({self.final[s] for s in states if self.final[s] is not None}))
        return self._sets[states]

    def _step(self, at: int, word: bytes) -> int:
        word = word if word in self._known else b""
        found = self._moves[at].get(word)
        if found is None:
            to = {self.by_word[s][word] for s in self._members[at] if word in self.by_word[s]}
            to |= {self.by_any[s] for s in self._members[at] if self.by_any[s] is not None}
            found = self._moves[at][word] = self._number(self._closed(to))
        return found

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(entry, start, stop) in words: for each entry and start the longest accepted stretch, by start and entry."""
        firsts, out = self.firsts, []
        for start in [i for i, w in enumerate(words) if w in firsts]:
            state, longest = self._begin, {}
            for i in range(start, len(words)):
                state = self._step(state, words[i])
                if state == self._dead:
                    break
                for entry in self._accepts[state]:
                    longest[entry] = i + 1
            out += [(entry, start, stop) for entry, stop in sorted(longest.items())]
        return out


def compiled(templates: Mapping[str, Sequence[str]], phrases: Mapping[str, Sequence[str]]) -> Automaton:
    """The automaton of all templates and phrases."""
    out = Automaton()
    for kind, phrase in ((phrases, True), (templates, False)):
        for label in sorted(kind):
            for template in kind[label]:
                out.add(label, template, phrase)
    return out.ready()


def scan(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, Sequence[str]] = PHRASES,
) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n_words, matches), one row for each row.

    ``matches`` are (label, start, stop, mandatory, phrase): words start to stop (exclusive) are accepted by a template of
    ``label`` or, with ``phrase``, are one of its phrases; ``mandatory`` counts the words that it fixes. Whole
    texts are read. Null and empty texts have no words and no matches; repeated rows and rows without doc_id stay;
    other columns are dropped; an empty table gives no row. Documents are only mapped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(templates, phrases)
        names = ["label", "start", "stop", "mandatory", "phrase"]
        kind = pa.list_(pa.struct(list(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]))))
        for batch in slices(batches, "text", BATCH_BYTES):
            counts, found = [], []
            for text in batch.column("text"):
                words = words_of(text.as_py() or "")
                counts.append(len(words))
                rows = []
                for entry, start, stop in automaton.matches(words):
                    label, fixed, phrase = automaton.entries[entry]
                    rows.append({"label": label, "start": start, "stop": stop, "mandatory": fixed, "phrase": phrase})
                found.append(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, kind)], ["doc_id", "n_words", "matches"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, matches {MATCH}")


def as_pattern(template: str) -> str:
    """A template as a regular expression over words that are each followed by a blank."""

    def text(parts: list) -> str:
        out = ""
        for part in parts:
            if isinstance(part, bytes):
                out += part.decode() + " "
            elif part[0] == "any":
                out += f"(?:[^ ]+ ){{{part[1]},{part[2]}}}"
            else:
                out += f"(?:{text(part[1])})?"
        return out

    return text(parts_of(template))
