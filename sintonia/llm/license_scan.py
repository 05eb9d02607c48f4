"""Licence scans with a generalised suffix automaton of licence tokens.

The notices below are one token sequence with a separator of its own after each; their
suffix automaton is built once per task.  A text streams through it and gives, word by
word, the length of the longest piece of any notice that ends there (matching
statistics).  Maximal pieces of ``min_match`` words are placed in the notices they
occur in; pieces that follow each other in both, with small gaps, are chained, and a
notice whose chain covers ``min_cover`` of its words is a found template span.

Three fixed phrases are counted besides, wherever their words stand consecutively.
The score is the largest share of a notice that a chain covers, 1 with such a phrase.

Defined results: a null or empty text has no words, no labels and score 0; repeated
rows are scanned each; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sintonia.llm.common import table

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Public notices and whole licences, by label.
NOTICES = (
    ("mit", "Released under the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "bsd-2",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "bsd-3",
        """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this
software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act
of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    ),
    (
        "agpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.""",
    ),
    (
        "epl-2.0",
        """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0
which is available at http://www.eclipse.org/legal/epl-2.0""",
    ),
)

#: Bytes that are not of a word become blanks; A-Z become a-z.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass(frozen=True)
class Limits:
    #: Shortest piece (words) that counts, and largest gap (words) within a chain.
    min_match: int = 3
    max_gap: int = 12
    #: Share of a notice's words that a chain must cover.
    min_cover: float = 0.8


class Automaton:
    """Suffix automaton of all notices; ``ends[state]`` are places (notice, last word)
    of the state's pieces."""

    def __init__(self, notices: list[list[bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        last = 0
        for n, words in enumerate(notices):
            for k, w in enumerate(words):
                last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary) + 1))
                self.ends[last].append((n, k))
            last = self._extend(last, -1 - n)  # separator: no text has it
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] += self.ends[s]

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _extend(self, last: int, token: int) -> int:
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            if self.length[p] + 1 == self.length[q]:
                self.link[new] = q
            else:
                twin = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
                self.link[q] = self.link[new] = twin
                while p >= 0 and self.next[p].get(token) == q:
                    self.next[p][token] = twin
                    p = self.link[p]
        return new

    def pieces(self, words: list[bytes], least: int) -> list[tuple[int, int, int]]:
        """Maximal matches of ``least`` words: (last word, length, state)."""
        found = []
        state = length = 0
        step, link, size = self.next, self.link, self.length
        for k, token in enumerate(map(self.vocabulary.get, words)):
            if token is None:
                if length >= least:
                    found.append((k - 1, length, state))
                state = length = 0
                continue
            if token not in step[state]:
                if length >= least:
                    found.append((k - 1, length, state))
                while state and token not in step[state]:
                    state = link[state]
                    length = size[state]
            to = step[state].get(token)
            if to is None:
                state = length = 0
            else:
                state, length = to, length + 1
        if length >= least:
            found.append((len(words) - 1, length, state))
        return found


def chains(pieces: list[tuple[int, int, int]], automaton: Automaton, sizes: list[int], limits: Limits) -> list[tuple[int, int, int, float]]:
    """(notice, first word, last word, share covered) of the best chain that each
    placed piece ends; pieces come in text order."""
    placed: dict[int, list[tuple[int, int, int, int]]] = {}
    for end, length, state in pieces:
        for notice, at in automaton.ends[state]:
            placed.setdefault(notice, []).append((end - length + 1, end, at - length + 1, at))
    out = []
    for notice, spans in placed.items():
        best: list[tuple[int, int]] = []  # words covered, first word
        for k, (a, b, ta, tb) in enumerate(spans):
            covered, first = b - a + 1, a
            for j in range(k - 1, -1, -1):
                pa_, pb, _, ptb = spans[j]
                if a - pb > limits.max_gap + 1 + sizes[notice]:
                    break
                # a piece may begin inside the one before it; then only the rest counts
                shift = max(0, pb + 1 - a, ptb + 1 - ta)
                if pb < b and ptb < tb and a - pb <= limits.max_gap + 1 and ta - ptb <= limits.max_gap + 1 and shift <= b - a:
                    if best[j][0] + b - a + 1 - shift > covered:
                        covered, first = best[j][0] + b - a + 1 - shift, best[j][1]
            best.append((covered, first))
            out.append((notice, first, b, min(1.0, covered / sizes[notice])))
    return out


class Scanner:
    def __init__(self, limits: Limits = Limits(), notices: tuple[tuple[str, str], ...] = NOTICES):
        self.limits = limits
        self.labels = [label for label, _ in notices]
        texts = [words_of(text.encode()) for _, text in notices]
        self.sizes = [len(x) for x in texts]
        self.automaton = Automaton(texts)
        self.phrases = [(b" " + k.encode() + b" ", v) for k, v in PHRASES.items()]

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        starts, base = [], set()
        for phrase, label in self.phrases:
            at = joined.find(phrase)
            while at >= 0:
                starts.append(joined.count(b" ", 0, at))
                base.add(label)
                at = joined.find(phrase, at + 1)
        pieces = self.automaton.pieces(words, self.limits.min_match)
        linked = chains(pieces, self.automaton, self.sizes, self.limits) if pieces else []
        spans = sorted({(self.labels[n], a, b) for n, a, b, share in linked if share >= self.limits.min_cover})
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {s[0] for s in spans})),
            "score": 1.0 if starts else max((share for *_, share in linked), default=0.0),
            "spans": [{"label": s, "first": a, "last": b} for s, a, b in spans],
        }


RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,last:long>>"
_ARROW = pa.schema(
    [(k, pa.int64()) for k in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])))]
)


def scan(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: phrase counts, labels, score and the
    template spans (in words).  No shuffle."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(RESULT).fields])

    def run(batches):
        scanner = Scanner(limits)
        for batch in batches:
            rows = pa.RecordBatch.from_pylist([scanner.scan((t.as_py() or "").encode()) for t in batch.column(1)], schema=_ARROW)
            yield pa.RecordBatch.from_arrays([batch.column(0), *rows.columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op4_license_automaton(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")
