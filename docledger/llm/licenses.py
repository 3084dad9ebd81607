"""License scans by template markup.

A template is license wording with two kinds of marked regions: [[ ... ]] is optional wording, which may be missing, and
{{name:least,most}} stands for `least` to `most` words of any kind (a version, a holder, a year). Everything else is
mandatory and must match word for word. A template is compiled into an automaton over words: its states are positions in
the template, an optional region adds a way around itself, a replaceable region counts words. All templates of a set run
together over a text; a run starts where a template's first mandatory words stand, so a scan costs little where there
are none.

Words are found after lower-casing A-Z; a word is a maximal run of characters other than ASCII punctuation, control
characters and spaces, so that any non-ASCII character belongs to a word.

Besides templates, base phrases are counted: every place where a phrase's words stand consecutively.

Defined results: a null text is the empty text with no words and labels '' and score 0. Repeated rows give repeated
results. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices

# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Templates of common license notices. Their labels are SPDX-like names.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [[version]] 2 0",
    "mit-notice": "[[this {{work:1,3}} is]] released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this {{software:1,6}} to deal in the software without restriction",
    "gpl-3.0": "[[this {{work:1,3}} is]] licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 3",
    "gpl-2.0": "[[this {{work:1,3}} is]] licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 2",
    "cc-by-nc-4.0": "licensed under [[a]] cc by nc [[international]] 4 0 [[international]]",
    "cc-by-4.0": "licensed under [[a]] cc by 4 0 [[international]]",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-disclaimer": "this software is provided by {{holder:1,8}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness "
    "for a particular purpose are disclaimed in no event shall {{holder:1,8}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to "
    "procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-endorsement": "neither the name of {{holder:1,10}} nor the names of [[its]] [[the]] contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission",
    "mit-conditions": "the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software",
    "mit-disclaimer": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
    "noninfringement in no event shall the {{holder:1,8}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection "
    "with the software or the use or other dealings in the software",
    "isc": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies",
    "zlib": "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is "
    "granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
    "as a compiled binary for any purpose commercial or non commercial and by any means",
    "apache-header": "you may not use this {{file:1,3}} except in compliance with the license [[you may obtain a copy of the license at {{address:1,8}}]] [[unless required by applicable law or agreed "
    "to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied]]",
    "copyright-notice": "copyright [[c]] {{year:1,2}} {{holder:1,8}} all rights reserved",
}

MARK = re.compile(r"(\[\[|\]\]|\{\{[^}]*\}\})")
#: A-Z become a-z, other ASCII bytes outside words become spaces.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Automaton:
    """word[s]: {word: next state}; skip[s]: states reached without a word; any[s]: next state on any word."""

    word: list[dict[bytes, int]] = field(default_factory=list)
    skip: list[list[int]] = field(default_factory=list)
    any: list[int | None] = field(default_factory=list)

    def state(self) -> int:
        self.word.append({})
        self.skip.append([])
        self.any.append(None)
        return len(self.word) - 1

    def closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run of words from `at`, or -1."""
        now, end, last = self.closed({0}), -1, len(self.word) - 1
        for k in range(at, len(words)):
            now = self.closed({n for s in now for n in (self.word[s].get(words[k]), self.any[s]) if n is not None})
            if last in now:
                end = k + 1
            if not now:
                break
        return end


def compile_template(text: str) -> Automaton:
    """The automaton of a template; its first state is 0 and its last one accepts."""
    out, opened = Automaton(), []
    at = out.state()
    for part in MARK.split(text):
        if part == "[[":
            opened.append(at)
        elif part == "]]":
            end = out.state()
            out.skip[at].append(end)
            out.skip[opened.pop()].append(end)
            at = end
        elif part.startswith("{{"):
            least, most = map(int, part[2:-2].rpartition(":")[2].split(","))
            ways = []
            for k in range(most):
                if k >= least:
                    ways.append(at)
                nxt = out.state()
                out.any[at] = nxt
                at = nxt
            end = out.state()
            for s in [*ways, at]:
                out.skip[s].append(end)
            at = end
        else:
            for w in part.encode().translate(TO_WORDS).split():
                nxt = out.state()
                out.word[at][w] = nxt
                at = nxt
    if opened:
        raise ValueError("an optional region isn't closed")
    end = out.state()
    out.skip[at].append(end)
    return out


def as_regex(template: str) -> str:
    """The template as a regular expression over words with a space before and behind each."""
    out = []
    for part in MARK.split(template):
        if part == "[[":
            out.append("(?:")
        elif part == "]]":
            out.append(")?")
        elif part.startswith("{{"):
            out.append("(?: [^ ]+ ){%s}" % part[2:-2].rpartition(":")[2])
        else:
            out += [f" {w} " for w in part.encode().translate(TO_WORDS).decode().split()]
    return "".join(out)


def anchor(template: str) -> bytes:
    """Mandatory words that stand together: the longest such run of the template."""
    depth, runs = 0, []
    for part in MARK.split(template):
        if part in ("[[", "]]"):
            depth += 1 if part == "[[" else -1
        elif not part.startswith("{{") and not depth:
            runs.append(b" ".join(part.encode().translate(TO_WORDS).split()))
    return max(runs, key=len)


class Scanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.templates = {label: (b" %s " % anchor(t), compile_template(t)) for label, t in templates.items()}
        self.phrases = [(b" %s " % p.encode(), label) for p, label in phrases.items()]

    @staticmethod
    def _places(words: bytes, phrase: bytes) -> list[int]:
        """Byte positions of phrase (with a space at each end) in words (likewise); occurrences may share a space."""
        out, at = [], words.find(phrase)
        while at >= 0:
            out.append(at)
            at = words.find(phrase, at + 1)
        return out

    def scan(self, text: str) -> tuple[int, int, int | None, int | None, list[str], list[str], float]:
        """n_words, base places, first and last of them, base labels, all labels, share of the words inside matches."""
        words = text.encode().translate(TO_WORDS).split()
        line = b" %s " % b" ".join(words)
        hits = [(at, label) for phrase, label in self.phrases for at in self._places(line, phrase)]
        gaps = None  # byte positions of the spaces, made once if a place is asked for

        def word_at(place: int) -> int:
            nonlocal gaps
            if gaps is None:
                gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
            return int(np.searchsorted(gaps, place))

        starts = [word_at(at) for at in (min(hits)[0], max(hits)[0])] if hits else [None, None]
        base, labels, spans = {label for _, label in hits}, set(), []
        for label, (mandatory, automaton) in self.templates.items():
            for at in self._places(line, mandatory):
                # the anchor may stand behind optional or replaceable wording: try each start in reach, the first wins
                stands = word_at(at)
                for start in range(max(0, stands - len(automaton.word)), stands + 1):
                    if (end := automaton.longest(words, start)) >= stands + mandatory.count(b" ") - 1:
                        labels.add(label)
                        spans.append((start, end))
                        break
        covered, upto = 0, 0
        for start, end in sorted(spans):
            covered += max(0, end - max(start, upto))
            upto = max(upto, end)
        score = min(1.0, covered / len(words)) if spans else 0.0
        return len(words), len(hits), starts[0], starts[1], sorted(base), sorted(base | labels), score


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates, phrases = templates or TEMPLATES, phrases or BASE
    names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for b in slices(batches):
            found = [scanner.scan(t or "") for t in b.column(1).to_pylist()]
            cols = list(zip(*found, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    *[pa.array(c, pa.int64()) for c in cols[:4]],
                    *[pa.array([",".join(x) for x in c], pa.string()) for c in cols[4:6]],
                    pa.array(cols[6], pa.float64()),
                ],
                names,
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
