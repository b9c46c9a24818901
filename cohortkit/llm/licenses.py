"""License scans (operator 10).

Three things of a text are compared with license templates by the cosine of
their TF-IDF vectors: the text as a whole, every line, and runs of adjacent
lines (blocks without an empty line between them, and windows of about the
template's number of words, which also cross the empty lines of a comment). A
word's frequency n counts as 1 + ln(n), lest "the" and "of" make all long texts
alike. The inverse document frequencies are those of the templates; a word of no
template weighs as much as the rarest. A line or run that reaches ``LEAST`` is
the document's license header, the best of them if there are several; a text
that does as a whole is a license file and licenses its directory. Documents
without a license of their own inherit that of the nearest directory above them.

Templates are of three kinds: one-sentence notices and SPDX lines, the standard
headers of source files, and whole license texts (``license_texts/``).

Most texts share little with any template. The cosine of a text, or of any part
of it, is at most the length of the template's vector cut down to the text's
words: templates whose cut is shorter than ``LEAST`` are left out for the whole
text. Without one of its heaviest words, a template's other words cannot add up
to ``LEAST`` either, so only lines and windows with such a word are compared.
Both tests are exact. The templates are a parameter and bound what tasks are
sent. Inheritance is settled per directory, by joins of each directory's
ancestors with the licensed ones, and then joined to the documents by
directory.

Defined cases: a null or empty text has no license of its own; ties go to the
template, then the path, that comes first; a null path is the file "" in the
root directory; a file inherits from its own directory first; license files
inherit nothing; repeated rows are answered alike; an empty table gives an
empty result; extra columns are kept (``path``, ``license``, ``how``,
``score``, ``license_path`` are the results' names).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate, chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from cohortkit.llm.common import column_batches, cut

#: Cosine from which a text is taken for a template's.
LEAST = 0.6
ROWS = 1000

_TEXTS = Path(__file__).with_name("license_texts")


def _text(name: str, *changes: tuple[str, str]) -> str:
    """A license text, or one that differs from it by ``changes`` (patterns and what they become)."""
    text = (_TEXTS / f"{name}.txt").read_text(encoding="utf-8")
    for pattern, by in changes:
        text = re.sub(pattern, by, text, flags=re.S)
    return text


def _gnu(license: str, version: str) -> tuple[str, str, str]:
    """The standard header of a GNU license: its first paragraph, two of them, all three."""
    what = "library" if license.startswith("Lesser") and version == "2.1" else "program"
    parts = (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {license} "
             f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
             f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
             f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {license} for more details.",
             f"You should have received a copy of the GNU {license} along with this {what}. If not, see <https://www.gnu.org/licenses/>.")
    return parts[0], "\n".join(parts[:2]), "\n".join(parts)


_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License."""
_SA = ((r"  c\. BY-SA Compatible License.*?(?=\n  d\.)", ""), (r"  b\. ShareAlike\..*?(?=\nSection 4)", ""),
       (r"Attribution and ShareAlike", "Attribution"), (r"Attribution-ShareAlike", "Attribution"))
_NC = ((r"Attribution 4\.0", "Attribution-NonCommercial 4.0"), (r"License are Attribution", "License are Attribution, NonCommercial"),
       (r"(?=  a\. reproduce and Share)", "for NonCommercial purposes only. NonCommercial means not primarily intended for or directed "
        "towards commercial advantage or monetary compensation. "), (r"exercise the Licensed Rights in the", r"\g<0> NonCommercial"))

#: Notices, standard headers and license texts by SPDX id (fixed values).
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": ("Released under the MIT License.", _text("MIT")),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", _APACHE, _APACHE + """
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""", _text("Apache-2.0")),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", *_gnu("General Public License", "3"), _text("GPL-3.0")),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",
                 *_gnu("Lesser General Public License", "3"), _text("LGPL-3.0")),
    "AGPL-3.0": ("This program is licensed under the GNU Affero General Public License, version 3.",
                 *_gnu("Affero General Public License", "3"),
                 _text("GPL-3.0", ("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC"), ("GNU General Public", "GNU Affero General Public"),
                       (r"13\. Use with the GNU Affero General Public License", "13. Remote Network Interaction. If you modify the "
                        "Program, your modified version must prominently offer all users interacting with it remotely through a "
                        "computer network an opportunity to receive the Corresponding Source from a network server."))),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""", _text("MPL-2.0")),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted.", _text("BSD-3-Clause")),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", _text("CC-BY-SA-4.0", *_SA)),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", _text("CC-BY-SA-4.0")),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", _text("CC-BY-SA-4.0", *_SA, *_NC)),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.", _text("CC0-1.0")),
    "Proprietary": ("Copyright. All rights reserved.",),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", *_gnu("General Public License", "2"), _text("GPL-2.0")),
    "LGPL-2.1": ("This library is licensed under the GNU Lesser General Public License, version 2.1.",
                 *_gnu("Lesser General Public License", "2.1"), _text("LGPL-2.1")),
    "BSD-2-Clause": (_text("BSD-3-Clause", (r"3\. Neither.*?permission\.\n", "")),),
}
TEMPLATES = {name: (*texts, *([f"SPDX-License-Identifier: {name}"] if name != "Proprietary" else [])) for name, texts in TEMPLATES.items()}

_TERM = re.compile(r"\w+(?:[.-]\w+)*")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Matcher:
    """TF-IDF vectors of templates; a license may have several."""

    def __init__(self, templates: Mapping[str, str | Sequence[str]], least: float = LEAST):
        each = [(name, text) for name, texts in templates.items() for text in ([texts] if isinstance(texts, str) else texts)]
        self.names, self.least = [name for name, _ in each], least
        counts = [Counter(terms(text)) for _, text in each]
        holds = Counter(w for c in counts for w in c)
        self.idf = {w: 1 + math.log(len(counts) / n) for w, n in holds.items()}
        self.rare = 1 + math.log(len(counts)) if counts else 1.0
        #: words of each template, weights, and those without which ``least`` is out of reach
        self.sizes = [sum(c.values()) for c in counts]
        self.vectors: list[dict[str, float]] = []
        self.heavies: list[frozenset[str]] = []
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, c in enumerate(counts):
            weights = {w: self.weight(w, n) for w, n in c.items()}
            norm = math.sqrt(sum(x * x for x in weights.values()))
            vector = {w: x / norm for w, x in weights.items()}
            for w, x in vector.items():
                self.postings.setdefault(w, []).append((i, x))
            heavy, rest = set(), 1.0
            for w, x in sorted(vector.items(), key=lambda p: (-p[1], p[0])):
                if rest < least * least:
                    break
                heavy.add(w)
                rest -= x ** 2
            self.vectors.append(vector)
            self.heavies.append(frozenset(heavy))
        self.heavy = frozenset(chain.from_iterable(self.heavies))

    def weight(self, word: str, n: int) -> float:
        return (1 + math.log(n)) * self.idf.get(word, self.rare)

    def best(self, words: list[str], among: Sequence[int] | None = None) -> tuple[int, float]:
        """The template nearest to the words, and its cosine."""
        weights = {w: self.weight(w, n) for w, n in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        dots: dict[int, float] = {}
        if among is None:
            for w, weight in weights.items():
                for i, x in self.postings.get(w, ()):
                    dots[i] = dots.get(i, 0.0) + weight * x
        else:
            for i in among:
                vector = self.vectors[i]
                dots[i] = sum(weight * vector[w] for w, weight in weights.items() if w in vector)
        if not dots or not norm:
            return -1, 0.0
        score, i = max((round(d / norm, 12), -i) for i, d in dots.items())
        return -i, score

    def within_reach(self, words: set[str]) -> list[int]:
        """Templates that a text of these words, or a part of it, can reach."""
        squares: dict[int, float] = {}
        for w in words & self.postings.keys():
            for i, x in self.postings[w]:
                squares[i] = squares.get(i, 0.0) + x * x
        return sorted(i for i, square in squares.items() if square >= self.least ** 2 * (1 - 1e-9))

    def reached(self, i: int, words: set[str]) -> bool:
        """If a text of these words, or a part of it, can reach template i."""
        vector = self.vectors[i]
        return sum(vector[w] ** 2 for w in words & vector.keys()) >= self.least ** 2 * (1 - 1e-9)

    def windows(self, lines: list[list[str]], i: int) -> Iterator[tuple[int, int]]:
        """Runs of adjacent lines (first, end) with about as many words as template i
        that reach ``least``, the best of each stretch."""
        upto = [0, *accumulate(map(len, lines))]
        size, vector, heavy, known, rare = self.sizes[i], self.vectors[i], self.heavies[i], self.idf.get, self.rare
        stretches: list[list[int]] = []
        for k, words in enumerate(lines):
            if not heavy.isdisjoint(words):  # a window that reaches ``least`` holds one of these
                first = max(0, bisect_right(upto, upto[k] - size) - 1)
                end = min(len(lines), bisect_left(upto, upto[k + 1] + size))
                if stretches and first <= stretches[-1][1]:
                    stretches[-1][1] = max(end, stretches[-1][1])
                else:
                    stretches.append([first, end])
        for first, end in stretches:
            if not self.reached(i, set(chain.from_iterable(lines[first:end]))):
                continue
            counts: dict[str, int] = {}
            square = dot = most = 0.0
            best = None
            at = first

            scale = [0.0, *(1 + math.log(n) for n in range(1, upto[end] - upto[first] + 1))]

            def put(words: list[str], by: int, counts=counts, scale=scale) -> tuple[float, float]:
                more = over = 0.0
                for w in words:
                    n = counts.get(w, 0)
                    counts[w] = n + by
                    idf = known(w, rare)
                    old, new = scale[n], scale[n + by]
                    more += (new * new - old * old) * idf * idf
                    if w in vector:
                        over += (new - old) * idf * vector[w]
                return more, over

            for k in range(first, end):
                if not lines[k]:
                    continue
                moves = [(k, 1)]
                total = upto[k + 1]
                # shrink while what is left still has the template's words
                j = at
                while j < k and total - upto[j + 1] >= size:
                    moves.append((j, -1))
                    j += 1
                for line, by in moves:
                    more, over = put(lines[line], by)
                    square, dot = square + more, dot + over
                    at = at if by > 0 else line + 1
                    score = dot / math.sqrt(square) if square > 1e-9 else 0.0
                    if score > most:
                        most, best = score, (at, k + 1)
            if best and most >= self.least * (1 - 1e-9):
                yield best

    def scan(self, text: str | None) -> tuple[str | None, float, bool]:
        """License of the text, its cosine, and if the text is a license file."""
        if not text or not self.names:
            return None, 0.0, False
        lines = [terms(line) for line in text.splitlines()]  # no term spans two lines
        words = list(chain.from_iterable(lines))
        among = self.within_reach(set(words))
        if not among:
            return None, 0.0, False
        whole, score = self.best(words, among)
        if score >= self.least:
            return self.names[whole], score, True
        heavy = frozenset().union(*(self.heavies[i] for i in among))
        runs = {(k, k + 1) for k, own in enumerate(lines) if not heavy.isdisjoint(own)}
        bounds = [-1, *(k for k, own in enumerate(lines) if not own), len(lines)]
        for k in sorted({bisect_left(bounds, k) for k, _ in runs}):
            runs.add((bounds[k - 1] + 1, bounds[k]))
        for i in among:
            runs.update(self.windows(lines, i))
        most, found = self.least, -1
        for first, end in runs:
            own = list(chain.from_iterable(lines[first:end]))
            near = self.within_reach(set(own))
            if not near:
                continue
            i, score = self.best(own, near)
            if score > most or score == most and (found < 0 or i < found):
                most, found = score, i
        return (None, 0.0, False) if found < 0 else (self.names[found], most, False)


def scan(files: DataFrame, templates: Mapping[str, str | Sequence[str]] | None = None, least: float = LEAST,
         path: str = "path", text: str = "text") -> DataFrame:
    """(path, license, score, is_file) of every file, and its extra columns."""
    matcher = Matcher(TEMPLATES if templates is None else templates, least)
    names = ["path", "license", "score", "is_file"]
    extra = [c for c in files.columns if c not in (path, text, "how", "license_path", *names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, ROWS):
            found = [matcher.scan(t) for t in batch.column(1).to_pylist()]
            licenses, scores, are = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(licenses, pa.string()), pa.array(scores, pa.float64()), pa.array(are, pa.bool_()),
                 *batch.columns[2:]], [*names, *extra])

    rows = files.select(F.coalesce(F.col(path), F.lit("")).alias("path"), F.col(text).alias("text"), *[F.col(f"`{c}`") for c in extra])
    schema = StructType([StructField("path", StringType()), StructField("license", StringType()), StructField("score", DoubleType()),
                         StructField("is_file", BooleanType()), *rows.schema.fields[2:]])
    return rows.mapInArrow(run, schema)


def _directory(path):
    """Everything before the last slash; "" is the root."""
    return F.regexp_replace(F.concat(F.lit("/"), path), r"/[^/]*$", "")


def inherit(found: DataFrame) -> DataFrame:
    """path, license, how (file, header, inherited, none), score, license_path, and the extra columns."""
    extra = [F.col(f"`{c}`") for c in found.columns if c not in ("path", "license", "score", "is_file")]
    found = cut(found.withColumn("_dir", _directory(F.col("path"))), "licenses")
    licensed = cut(found.filter("is_file").groupBy(F.col("_dir").alias("at")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("path"), F.col("license"))).alias("l")), "license-dirs")
    dirs = found.select("_dir").distinct()
    steps = F.split(F.col("_dir"), "/")  # the first step is ""
    above = dirs.withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(steps)))).withColumn(
        "at", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/"))
    near = above.join(licensed, "at").groupBy("_dir").agg(F.max_by("l", "depth").alias("_l"))
    rows = found.join(cut(near, "license-near"), "_dir", "left")
    own = F.col("license").isNotNull()
    how = F.when(F.col("is_file"), "file").when(own, "header").when(F.col("_l").isNotNull(), "inherited").otherwise("none")
    return rows.select("path", F.coalesce("license", F.col("_l.license")).alias("license"), how.alias("how"),
                       F.when(own, F.col("score")).otherwise(F.coalesce(-F.col("_l.s"), F.lit(0.0))).alias("score"),
                       F.when(own, F.col("path")).otherwise(F.col("_l.path")).alias("license_path"), *extra)
