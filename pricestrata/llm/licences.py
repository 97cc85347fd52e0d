"""Licence scan by sentence rules.

A whole text is cut into sentences, each is normalised (lower case; every run of other
characters than a-z and 0-9 becomes one space) and looked up among known licence sentences. The
identifiers found, in text order, are matched against ordered rules: a rule names a licence and
a sequence of identifiers that must stand next to each other in that order. An earlier rule
takes its identifiers, so a later and shorter rule does not report them again.

A known sentence with a stop inside, such as a semicolon, is found only if all its pieces follow
each other: notices of other versions or licences that begin alike are not taken for it.

A stop or a blank line closes a sentence. A single line end closes one or stands for a space,
whichever gives a known sentence at that place, so hard-wrapped licence texts and lines without a
stop are found in one text. Where several known sentences begin at a place, the longest counts. Texts
without a telling word are left out by built-in functions; the others are cut and looked up in Arrow batches; no shuffle.

Defined results
- null or empty text: no sentences, empty lists.
- a licence found several times is named once, n_matches counts all; unmatched identifiers stay in sentence_ids.
- null doc_id is kept, repeated rows give repeated results, extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Known licence sentences (fixed values).
SENTENCES = (
    ("apache-line", "Licensed under the Apache License, Version 2.0."),
    ("apache-a", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("apache-b", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-c", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("apache-d", "See the License for the specific language governing permissions and limitations under the License."),
    ("mit-line", "Released under the MIT License."),
    ("mit-a", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-b", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("gpl3-line", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-a", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-b", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl-c", "See the GNU General Public License for more details."),
    ("cc-by-nc-line", "Licensed under CC BY-NC 4.0."),
    ("cc-by-line", "Licensed under CC BY 4.0."),
    ("cc-by-sa-line", "Licensed under CC BY-SA 4.0."),
    ("mpl-a", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-b", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("isc-a", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense-a", "This is free and unencumbered software released into the public domain."),
    ("unlicense-b", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("boost-line", "Distributed under the Boost Software License, Version 1.0."),
    ("bsd-a", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-b", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-c", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-d", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
)

#: Ordered rules: licence, then its sequence of sentences (fixed values).
RULES = (
    ("BSD-3-Clause", ("bsd-a", "bsd-b", "bsd-c", "bsd-d")),
    ("BSD-2-Clause", ("bsd-a", "bsd-b", "bsd-c")),
    ("Apache-2.0", ("apache-a", "apache-b", "apache-c", "apache-d")),
    ("Apache-2.0", ("apache-a", "apache-b")),
    ("GPL-3.0-or-later", ("gpl-a", "gpl-b", "gpl-c")),
    ("GPL-3.0-or-later", ("gpl-a",)),
    ("MIT", ("mit-a", "mit-b")),
    ("Apache-2.0", ("apache-line",)),
    ("MIT", ("mit-line",)),
    ("GPL-3.0-only", ("gpl3-line",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-line",)),
    ("CC-BY-4.0", ("cc-by-line",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-line",)),
    ("MPL-2.0", ("mpl-a", "mpl-b")),
    ("MPL-2.0", ("mpl-a",)),
    ("ISC", ("isc-a",)),
    ("Unlicense", ("unlicense-a", "unlicense-b")),
    ("Unlicense", ("unlicense-a",)),
    ("BSL-1.0", ("boost-line",)),
)


_CUT = re.compile(r"[.!?:;]+(?:[ \t\r\f\v]+|\n|$)|\n[ \t\r]*\n")
_OTHER = re.compile("[^a-z0-9]+")


def sentences(text: str) -> list[list[str]]:
    """Lines of a lower-case text, normalised, by the sentence that stops and blank lines give."""
    cut = _CUT.sub("\1", text).split("\1")
    lines = ([_OTHER.sub(" ", x).strip() for x in block.split("\n")] for block in cut)
    return [y for y in ([x for x in block if x] for block in lines) if y]


def pieces(sentence: str) -> list[str]:
    """Normalised sentences of a text whose line ends stand for spaces."""
    return [" ".join(lines) for lines in sentences(sentence.lower())]


def known() -> dict[str, str]:
    """First piece of each normalised sentence, to its identifier: where a known sentence may
    begin. The scan itself asks for every piece (see ``Lookup``)."""
    found: dict[str, str] = {}
    for name, text in SENTENCES:
        found.setdefault(pieces(text)[0], name)
    return found


def telling_words() -> list[str]:
    """A few long words of which every known sentence holds at least one."""
    left, out = [set(s.split()) for s in known()], []
    while left:
        every = sorted({w for s in left for w in s if len(w) > 6})
        out.append(max(every, key=lambda w: (sum(w in s for s in left), len(w), w)))
        left = [s for s in left if out[-1] not in s]
    return out


def whole() -> dict[tuple[str, ...], str]:
    """All pieces of each known sentence to its identifier."""
    found: dict[tuple[str, ...], str] = {}
    for name, text in SENTENCES:
        found.setdefault(tuple(pieces(text)), name)
    return found


class Lookup:
    """Identifiers of the known sentences of a text."""

    def __init__(self) -> None:
        self.names = whole()
        #: Beginnings of known sentences by pieces, and of their pieces by words: a search ends where neither fits.
        self.chains = {k[:n] for k in self.names for n in range(1, len(k) + 1)}
        self.begun = {
            " ".join(words[:n]) for k in self.names for words in (p.split() for p in k) for n in range(1, len(words) + 1)
        }

    def _longest(self, lines: list[tuple[int, str]], at: int, done: tuple[str, ...]) -> tuple[int, int, str] | None:
        """Length, place after it and identifier of the longest known sentence that goes on at a line after ``done``."""
        best, joined = None, ""
        for end in range(at, len(lines)):
            if lines[end][0] != lines[at][0]:
                break
            joined = f"{joined} {lines[end][1]}".lstrip()
            if joined not in self.begun:
                break
            chain = (*done, joined)
            if chain not in self.chains:
                continue
            found = [self._longest(lines, end + 1, chain)] if end + 1 < len(lines) else []
            if chain in self.names:
                found.append((len(" ".join(chain)), end + 1, self.names[chain]))
            best = max((x for x in (best, *found) if x), default=None)
        return best

    def identifiers(self, text: str) -> list[str]:
        lines = [(k, line) for k, block in enumerate(sentences(text)) for line in block]
        out, at = [], 0
        while at < len(lines):
            found = self._longest(lines, at, ())
            if found:
                out.append(found[2])
            at = found[1] if found else at + 1
        return out


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lookup = Lookup()
    for batch in batches:
        ids = [lookup.identifiers(t) if t else [] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.string()))], names=["doc_id", "_ids"])


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, n_sentences, n_matches, sentence_ids and licences of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A text without any of these words holds no known sentence and is not cut up.
    low, some = F.lower(text), F.lit(False)
    for word in telling_words():
        some = some | F.contains(low, F.lit(word))
    prepared = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.when(some, low).alias("_low"))
    found = prepared.mapInArrow(_looked_up, "doc_id bigint, _ids array<string>")
    ids = F.col("_ids")
    # Every identifier stands between bars of its own, so neighbours can be taken apart.
    rest = F.array_join(F.transform(ids, lambda x: F.concat(F.lit("|"), x, F.lit("|"))), "")
    out = found.select(
        "doc_id", F.size(ids).cast("bigint").alias("n_sentences"),
        F.array_join(ids, ",").alias("sentence_ids"), rest.alias("_rest"),
    )
    marks = []
    for k, (_, sequence) in enumerate(rules):
        wanted = "".join(f"|{x}|" for x in sequence)
        before = F.length("_rest")
        taken = F.replace(F.col("_rest"), F.lit(wanted), F.lit("/"))
        out = out.withColumns(
            {"_next": taken, f"_m{k}": (before - F.length(taken)) / (len(wanted) - 1)}
        ).drop("_rest").withColumnRenamed("_next", "_rest")
        marks.append(F.col(f"_m{k}"))
    names = F.array(*(F.when(m > 0, F.lit(n)) for m, (n, _) in zip(marks, rules, strict=True)))
    found = F.array_distinct(F.filter(names, lambda x: x.isNotNull()))
    total = marks[0]
    for m in marks[1:]:
        total = total + m
    return out.select(
        "doc_id", "n_sentences", total.cast("bigint").alias("n_matches"), "sentence_ids",
        F.array_join(F.array_sort(found), ",").alias("licences"),
    )
