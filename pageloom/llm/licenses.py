"""Licence texts and notices in documents (operator 2), with DataFrame functions only.

A text's pieces are its sentences and clauses, cut at line ends as well, and
its units are all runs of neighbouring pieces: lines, paragraphs, neighbouring
paragraphs and the whole text are among them. A unit and a template are
compared by the Dice coefficient of their sets of word bigrams. For a threshold
t, a unit that reaches it with a template of m bigrams has at least m*t/(2-t)
of them and at most m*(2-t)/t bigrams; texts and runs beyond that are left out.
Everything is done in the row: nothing is shuffled.

Texts are normalised: lower case, and anything but letters and digits is a
blank. Null and empty texts have no licence. Of a licence's templates the best
counts. Ties for the best licence go to the smaller name. Repeated rows give
repeated results, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import pick
from pageloom.llm.fingerprints import let
from pageloom.llm.license_texts import FULL

THRESHOLD = 0.8

# Licence texts and notices as published.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC0-1.0",
        """To the extent possible under law, the author has waived all copyright and related or neighboring rights to
this work.""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution.""",
    ),
]
TEMPLATES = FULL + TEMPLATES


#: What stands between words.
OTHER = r"[^\p{L}\p{N}]+"
#: Where a piece of text ends: at a line's end, and at blanks after a sentence or clause.
PIECE_ENDS = r"\n|(?<=[.!?:;)])[ \t\r]+"
#: Bigrams counted before a run is given up as too long.
BLOCK = 64


def words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), OTHER, " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def bigrams(text: Column) -> Column:
    """Distinct hashes of the word bigrams of a text."""
    def pairs(w: Column) -> Column:
        two = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))
        return F.when(F.size(w) > 1, F.array_distinct(two)).otherwise(F.transform(w, lambda x: F.xxhash64(x)))

    return let(words(text), pairs)


def template_literals(spark, templates: list[tuple[str, str]]) -> tuple[Column, Column]:
    """An array of (name, bigrams), and one of all their bigrams: some ten thousand numbers, whatever the documents."""
    rows = spark.createDataFrame(templates, "name string, text string").select("name", bigrams(F.col("text")).alias("b"))
    rows = sorted((r.name, r.b) for r in rows.collect())
    array = lambda b: f"array({','.join(f'{x}L' if x > -(1 << 63) else '(-9223372036854775807L - 1L)' for x in b)})"
    each = [f"named_struct('name', '{name}', 'bigrams', {array(b)})" for name, b in rows]
    return F.expr(f"array({','.join(each)})"), F.expr(array(sorted({x for _, b in rows for x in b})))


def pieces(text: Column) -> Column:
    """Words of each piece, of pieces that have any."""
    return F.filter(F.transform(F.split(text, PIECE_ENDS), words), lambda w: F.size(w) > 0)


def grams(split: Column) -> Column:
    """Of pieces with two words or more in all: begins (first word of each piece), and every bigram in order.

    A bigram has its hash, its piece, where it stood before (-1: nowhere), whether it stands
    again later, and whether its second word ends a piece.
    """

    def of(w: Column, owner: Column) -> Column:
        last = F.size(w) - 1
        hashed = F.transform(F.sequence(F.lit(0), last - 1), lambda p: F.struct(F.xxhash64(F.get(w, p), F.get(w, p + 1)).alias("hash"), p.alias("at")))

        def placed(s: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                before, after = F.get(s, i - 1), F.get(s, i + 1)
                return F.struct(
                    x["at"].alias("at"),
                    x["hash"].alias("hash"),
                    F.get(owner, x["at"]).alias("piece"),
                    F.when(before["hash"] == x["hash"], before["at"]).otherwise(-1).alias("before"),
                    F.coalesce(after["hash"] == x["hash"], F.lit(False)).alias("again"),
                    F.coalesce(F.get(owner, x["at"] + 1) != F.get(owner, x["at"] + 2), F.lit(True)).alias("ends"),
                )

            return F.array_sort(F.transform(s, one))

        begins = F.filter(F.sequence(F.lit(0), last), lambda p: F.coalesce(F.get(owner, p) != F.get(owner, p - 1), F.lit(True)))
        return F.struct(begins.alias("begins"), let(F.array_sort(hashed), placed).alias("grams"))

    return let(F.flatten(split), lambda w: let(F.flatten(F.transform(split, lambda x, i: F.transform(x, lambda _: i))), lambda o: of(w, o)))


def best_run(text: Column, template: Column, threshold: float) -> Column:
    """The best score of a template with a run of pieces; text: of grams().

    From each start the distinct bigrams and those of the template are counted on: one is new
    if it stood before the start, or nowhere, before. A run that begins with a piece without
    the template's bigrams, or after which too few of them are left, is no better than another.
    """
    size = F.size(template["bigrams"])
    low, high = F.ceil(size * threshold / (2 - threshold)), F.floor(size * (2 - threshold) / threshold)
    marked = F.transform(text["grams"], lambda g: g.withField("hit", F.array_contains(template["bigrams"], g["hash"])))

    def of(all_grams: Column) -> Column:
        def runs(start: Column) -> Column:
            def step(a: Column, g: Column) -> Column:
                n = a["n"] + (g["before"] < start).cast("int")
                c = a["c"] + ((g["before"] < start) & g["hit"]).cast("int")
                score = F.when(g["ends"], F.greatest(a["best"], F.lit(2.0) * c / (n + size))).otherwise(a["best"])
                return F.struct(n.alias("n"), c.alias("c"), score.alias("best"))

            def block(a: Column, b: Column) -> Column:
                return F.when(a["n"] > high, a).otherwise(F.aggregate(F.slice(all_grams, start + b * BLOCK + 1, BLOCK), a, step))

            none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("c"), F.lit(0.0).alias("best"))
            blocks = F.sequence(F.lit(0), F.floor((F.size(all_grams) - 1 - start) / BLOCK).cast("int"))
            return F.aggregate(blocks, none, block, lambda a: a["best"])

        def from_hits(hits: Column) -> Column:
            left = F.filter(hits, lambda g: ~g["again"])
            starts = F.array_distinct(F.transform(hits, lambda g: F.get(text["begins"], g["piece"])))
            starts = F.filter(starts, lambda s: s <= F.get(left, (F.size(left) - low).cast("int"))["at"])
            return F.coalesce(F.array_max(F.transform(starts, runs)), F.lit(0.0))

        return let(F.filter(all_grams, lambda g: g["hit"]), from_hits)

    return let(marked, of)


def matches(text: Column, templates: Column, known: Column, threshold: float = THRESHOLD) -> Column:
    """(name, score) of every licence that a unit of the text reaches the threshold with, by name.

    known: the distinct bigrams of all templates.
    """

    def candidates(there: Column) -> Column:
        least = lambda t: F.ceil(F.size(t["bigrams"]) * threshold / (2 - threshold))
        return F.filter(templates, lambda t: (F.size(there) >= least(t)) & (F.size(F.array_intersect(t["bigrams"], there)) >= least(t)))

    def scored(possible: Column) -> Column:
        one = lambda g: F.transform(possible, lambda t: F.struct(t["name"].alias("name"), best_run(g, t, threshold).alias("score")))
        found = F.filter(let(let(pieces(text), grams), one), lambda x: x["score"] >= threshold)
        return F.when(F.size(possible) > 0, found).otherwise(F.array().cast("array<struct<name:string,score:double>>"))

    def best(all_found: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.transform(all_found, lambda x: x["name"])))
        top = lambda n: F.array_max(F.transform(F.filter(all_found, lambda x: x["name"] == n), lambda x: x["score"]))
        return F.transform(names, lambda n: F.struct(n.alias("name"), top(n).alias("score")))

    return let(let(let(F.array_intersect(known, bigrams(text)), candidates), scored), best)


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id and found: an array of (name, score)."""
    docs = pick(docs, doc_id="long", text="string")
    literal, known = template_literals(docs.sparkSession, templates)
    return docs.select("doc_id", matches(F.coalesce("text", F.lit("")), literal, known, threshold).alias("found"))
