"""Licence scans by sentence rules.

A text is cut into sentences, each sentence is normalised (lower case, runs of
anything but letters and digits become one blank) and looked up among the known
licence sentences. A line that ends without a mark may go on in the next one (wrapped
text, also behind comment signs): runs of such lines are looked up joined, the longest
known sentence first; a blank line ends a run. The identifiers found, in order, are matched against the rules: a
rule is the ordered sentences of a licence text or notice. At each place the longest
rule wins; a rule may be interrupted by a few unknown sentences (a name, an address),
not by known ones. A rule that is followed up to its start only is reported as a part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import table

# Sentences of licence texts and notices, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-notice-3": "This project is licensed under the MIT License.",
    "mit-notice-4": "This software is released under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or "
                     "substantial portions of the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
             "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
                     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-notice-2": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-notice-3": "Released under the Apache License, Version 2.0.",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License "
                    "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                    "or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-notice-2": "Licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                 "or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "lgpl-notice": "Licensed under the GNU Lesser General Public License, version 3.",
    "agpl-notice": "Licensed under the GNU Affero General Public License, version 3.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-sa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-notice": "To the extent possible under law, the author has dedicated all copyright to the public domain.",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                 "that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                  "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission.",
    "bsd-notice": "Licensed under the BSD License.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}


@dataclass(frozen=True)
class Rule:
    """Ordered sentences that stand for a licence."""

    licence: str
    sentences: tuple[str, ...]


# Rules by licence.
RULES = (
    *(Rule("MIT", (s,)) for s in ("mit-notice", "mit-notice-2", "mit-notice-3", "mit-notice-4", "mit-title", "mit-title-2")),
    Rule("MIT", ("mit-grant", "mit-condition", "as-is", "mit-liability")),
    Rule("MIT", ("mit-title", "mit-grant", "mit-condition", "as-is", "mit-liability")),
    Rule("MIT", ("mit-title-2", "mit-grant", "mit-condition", "as-is", "mit-liability")),
    *(Rule("Apache-2.0", (s,)) for s in ("apache-notice", "apache-notice-2", "apache-notice-3")),
    Rule("Apache-2.0", ("apache-notice-2", "apache-comply", "apache-obtain", "apache-as-is", "apache-see")),
    *(Rule("GPL-3.0", (s,)) for s in ("gpl3-notice", "gpl3-notice-2")),
    Rule("GPL-3.0-or-later", ("gpl-free",)),
    Rule("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-see")),
    Rule("GPL-2.0-or-later", ("gpl2-free",)),
    Rule("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-see")),
    Rule("LGPL-3.0", ("lgpl-notice",)),
    Rule("AGPL-3.0", ("agpl-notice",)),
    *(Rule("CC-BY-NC-4.0", (s,)) for s in ("cc-by-nc-notice", "cc-by-nc-long")),
    *(Rule("CC-BY-4.0", (s,)) for s in ("cc-by-notice", "cc-by-long")),
    *(Rule("CC-BY-SA-4.0", (s,)) for s in ("cc-by-sa-notice", "cc-by-sa-long")),
    Rule("CC0-1.0", ("cc0-notice",)),
    Rule("MPL-2.0", ("mpl-form",)),
    Rule("MPL-2.0", ("mpl-form", "mpl-copy")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("BSD", ("bsd-notice",)),
    Rule("ISC", ("isc-grant",)),
    Rule("Unlicense", ("unlicense",)),
    Rule("proprietary", ("reserved",)),
)
# Unknown sentences that may stand between two sentences of a rule.
GAP = 3

# A sentence ends at a line end, unless it goes on in the next line, or at a mark before white space.
_END = re.compile(r"\n+|(?<=[.!?:;])\s+")
_MARKS = tuple(".!?:;")
_PLAIN = re.compile(r"[\W_]+")


def normalise(sentence: str) -> str:
    return _PLAIN.sub(" ", sentence.lower()).strip()


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the sentences of a text without wrapped lines, in code points."""
    return ((a, b) for a, b, _, _ in pieces(text))


def pieces(text: str) -> Iterator[tuple[int, int, bool, bool]]:
    """Spans of the pieces between marks and line ends, in code points; whether each
    begins its line, and whether its line ends with it."""
    at, begins = 0, True
    for m in _END.finditer(text):
        ends = "\n" in m.group()
        if m.start() > at:
            yield at, m.start(), begins, ends
        at, begins = m.end(), ends
    if at < len(text):
        yield at, len(text), begins, True


class Recogniser:
    """Known sentences and rules, ready to match texts."""

    def __init__(self, known: dict[str, str], rules: tuple[Rule, ...], gap: int = GAP):
        # A licence sentence may itself have several parts, when a mark ends one inside it.
        self.parts = {k: [p for a, b in sentences(s) if (p := normalise(s[a:b]))] for k, s in known.items()}
        # Beginnings of known sentences, by words.
        self.begun = {p[:m.start()] for ps in self.parts.values() for p in ps for m in re.finditer(" |$", p)}
        self.number = {p: i for i, p in enumerate(sorted({p for ps in self.parts.values() for p in ps}))}
        self.rules = sorted({(tuple(self.number[p] for s in r.sentences for p in self.parts[s]), r.licence) for r in rules},
                            key=lambda x: (-len(x[0]), x))
        self.gap = gap

    def known(self, text: str) -> list[tuple[int, int, int, int]]:
        """(identifier, place among the sentences, start, end) of each known sentence."""
        found = [(normalise(text[a:b]), a, b, begins, ends) for a, b, begins, ends in pieces(text)]
        # Whether a piece may go on in the next: the line ends with it, but for no mark, and no blank line follows.
        on = [ends and text[a:b].rstrip()[-1:] not in _MARKS and not text.startswith("\n\n", b) for _, a, b, _, ends in found]
        out, i, place, goes_on = [], 0, -1, False
        while i < len(found):
            words, a, b, begins, ends = found[i]
            if not words:                # a blank line ends a run; signs before a comment's text do not
                goes_on &= not (begins and ends)
                i += 1
                continue
            best, j, joined = None, i, words
            while joined in self.begun:
                if joined in self.number:
                    best = (self.number[joined], j)
                if not on[j]:
                    break
                j += 1
                if j < len(found) and not found[j][0] and not found[j][4]:
                    j += 1
                if j == len(found) or not found[j][0]:
                    break
                joined += " " + found[j][0]
            if best:
                place += 1
                out.append((best[0], place, a, found[best[1]][2]))
                i, goes_on = best[1] + 1, False
            else:                        # the lines of an unknown sentence have one place
                place += not goes_on
                goes_on = on[i]
                i += 1
        return out

    def match(self, text: str | None) -> tuple[int, list[tuple[str, bool, int, int]]]:
        """Known sentences, and (licence, whole, start, end) of each rule met, in order."""
        seq = self.known(text) if text else []
        found, at = [], 0
        while at < len(seq):
            best = None
            for ids, licence in self.rules:
                n = 0
                while n < len(ids) and at + n < len(seq) and seq[at + n][0] == ids[n] \
                        and (n == 0 or seq[at + n][1] - seq[at + n - 1][1] <= self.gap + 1):
                    n += 1
                if n and (best is None or (n == len(ids), n) > best[:2]):
                    best = (n == len(ids), n, licence)
            if best is None:
                at += 1
                continue
            whole, n, licence = best
            found.append((licence, whole, seq[at][2], seq[at + n - 1][3]))
            at += n
        return len(seq), found


def scan(docs: DataFrame, known: dict[str, str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Licences named or contained in each whole text of ``docs`` (doc_id, text): one row per row.

    ``doc_id, n_sentences`` (known licence sentences), ``licenses`` (the licences
    of whole rules, distinct, sorted) and ``matches``, an array of (licence, whole,
    start, end) in code points. Null and empty texts, and texts without a known
    sentence, have none. Repeated rows are scanned alike; a null doc_id is kept;
    extra columns are ignored; an empty table gives an empty result.
    """
    recogniser = Recogniser(known or SENTENCES, rules)
    kind = pa.list_(pa.struct([("license", pa.string()), ("whole", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                out = [recogniser.match(t) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([n for n, _ in out], pa.int64()),
                     pa.array([sorted({x[0] for x in f if x[1]}) for _, f in out], pa.list_(pa.string())),
                     pa.array([[dict(zip(("license", "whole", "start", "end"), x, strict=True)) for x in f]
                               for _, f in out], kind)],
                    names=["doc_id", "n_sentences", "licenses", "matches"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_sentences long, licenses array<string>, "
             "matches array<struct<license:string,whole:boolean,start:long,end:long>>")


def op5_licenses(spark, sf_dir):
    """Licences of every document."""
    spans = F.transform("matches", lambda m: F.concat_ws(
        ":", m["license"], m["start"].cast("string"), m["end"].cast("string"), F.when(m["whole"], "whole").otherwise("part")))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_sentences", F.array_join("licenses", ",").alias("licenses"), F.array_join(spans, ",").alias("matches"))
