"""Licence texts and notices in documents, by Dice coefficient over word bigrams.

A document's lines, its whole text and windows of its words are normalised, turned into sets of word bigrams and compared with
licence templates. A Dice coefficient of `percent` / 100 bounds the ratio of the sets' sizes, so a template meets only lines
and texts of an admissible size, by an equi-join on the size. It also needs so many common bigrams that one of any few of the
template's bigrams must be there: documents without are left out, and windows are looked for in documents that have one, by
an equi-join on it. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.llm.common import free_name, stored
from sparkcast.llm.sqltext import lowered, positions

# Phrases by which texts say in one sentence under which licence they are.
NOTICES = {
    "Apache-2.0": "licensed under the Apache License, Version 2.0",
    "MIT": "released under the MIT License",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "MPL-2.0": "subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD-3-Clause": "use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
}
# The headers that licences ask to be put at the start of files.
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by
the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY
or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of the GNU {0} along
with this program. If not, see <https://www.gnu.org/licenses/>."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_CC = """This work is licensed under the Creative Commons {0} 4.0 International License. To view a copy of this license, visit
http://creativecommons.org/licenses/{1}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."""
HEADERS = {
    "Apache-2.0": _APACHE,
    "GPL-2.0": _GNU.format("General Public License", "2"),
    "GPL-3.0": _GNU.format("General Public License", "3"),
    "LGPL-3.0": _GNU.format("Lesser General Public License", "3"),
    "AGPL-3.0": _GNU.format("Affero General Public License", "3"),
    "MPL-2.0": _MPL,
    "CC-BY-4.0": _CC.format("Attribution", "by"),
    "CC-BY-SA-4.0": _CC.format("Attribution-ShareAlike", "by-sa"),
    "CC-BY-NC-4.0": _CC.format("Attribution-NonCommercial", "by-nc"),
}
# The texts of short licences.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
may not be removed or altered from any source distribution."""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"""
_DEALINGS = """ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE = f"""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software
dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the
public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law. {_AS_IS} AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, {_DEALINGS} For more information, please refer to <https://unlicense.org/>"""
_BOOST = f"""Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in
whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
machine-executable object code generated by a source language processor. {_AS_IS}, TITLE AND NON-INFRINGEMENT. IN NO EVENT
SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN
CONTRACT, TORT OR OTHERWISE, {_DEALINGS}"""
#: Texts of licences that are customarily pasted whole.
TEXTS = {"MIT": _MIT, "BSD-2-Clause": _BSD + _BSD_END, "BSD-3-Clause": _BSD + _BSD_NAMES + _BSD_END, "ISC": _ISC, "Zlib": _ZLIB, "Unlicense": _UNLICENSE, "BSL-1.0": _BOOST}
#: Templates go to every task only if they have at most this many rows after expansion by size; larger sets are shuffled.
BROADCAST_ROWS = 100_000


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*NOTICES.items(), *HEADERS.items(), *TEXTS.items()], "license string, text string")


def _words(text: Column) -> Column:
    """The words of the normalised text; a text without words has one empty string."""
    return F.split(F.btrim(F.regexp_replace(lowered(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def _pairs(w: str) -> Column:
    """Word bigrams in order."""
    return F.transform(positions(F.size(w) - 1), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)))


def _with_bigrams(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the distinct word bigrams of the normalised text instead of the text; a single word stands for itself.

    Each step is a column of its own: an expression inside a lambda would be evaluated anew for every element.
    """
    w = free_name(df, "_w")
    split = df.withColumn(w, _words(F.col(text))).drop(text).where(F.get(w, F.lit(0)) != "")
    return split.withColumn(name, F.array_distinct(F.when(F.size(w) == 1, F.col(w)).otherwise(_pairs(w)))).drop(w)


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """df with more columns, each evaluated once: as results of a generator they are not merged into later expressions."""
    for name, value in columns.items():
        df = df.select(*(c for c in df.columns if c != name), F.explode(F.array(value)).alias(name))
    return df


def _has_sign(w: str, known: list[str]) -> Column:
    """Whether a bigram of the words, or a word, is one of `known`. Most words begin none, so few bigrams are built."""
    first = {x.split(" ")[0] for x in known if " " in x}
    begins = lambda i: F.get(w, i).isin(first) & F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)).isin(known)
    return F.exists(positions(F.size(w) - 1), begins) | F.exists(w, lambda x: x.isin([x for x in known if " " not in x]))


def _windows(docs: DataFrame, signs: DataFrame, known: list[str], percent: int) -> DataFrame:
    """(doc_id, line, license, dice) of windows, for documents (doc_id, text) that have one of a template's signs."""
    d = _held(docs.withColumn("row", F.monotonically_increasing_id()), w=_words(F.col("text")))
    d = _held(d, g=_pairs("w")).drop("w")
    here = F.array_intersect("g", F.array(*map(F.lit, known))) if known else F.array_distinct("g")
    d = d.withColumn("sign", F.explode(here)).join(signs, "sign")
    # once for each template, however many of its signs are there; and only if enough bigrams are common
    d = d.where((F.get(F.array_intersect("signs", "g"), F.lit(0)) == F.col("sign")) & (F.size(F.array_intersect("g", "b")) >= F.col("need")))
    d = d.select("doc_id", "row", "text", "license", "g", "b", F.floor(F.col("m") * (200 - percent) / percent + 1e-9).cast("int").alias("longest"))
    # at each place the place before with the same bigram, and whether the template has it
    d = _held(d, s=F.array_sort(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    before = F.transform("s", lambda e, k: F.struct(e["i"].alias("i"), F.when(F.get("s", k - 1)["x"] == e["x"], F.get("s", k - 1)["i"]).otherwise(-1).alias("p"), F.array_contains("b", e["x"]).alias("hit")))
    d = _held(d, s=F.array_sort(before), nb=F.size("b"))

    def best(start: Column) -> Column:
        """The window from there with the largest Dice coefficient; of equal ones the shortest."""

        def step(acc: Column, e: Column) -> Column:
            new = F.when(e["p"] < start, 1).otherwise(0)
            u, c = acc["u"] + new, acc["c"] + F.when(e["hit"], new).otherwise(0)
            dice = 2.0 * c / (u + F.col("nb"))
            more = e["hit"] & (dice > acc["dice"])
            return F.struct(u.alias("u"), c.alias("c"), F.when(more, dice).otherwise(acc["dice"]).alias("dice"), F.when(more, e["i"]).otherwise(acc["end"]).alias("end"))

        zero = F.struct(F.lit(0).alias("u"), F.lit(0).alias("c"), F.lit(0.0).alias("dice"), F.lit(-1).alias("end"))
        return F.aggregate(F.slice("s", start + 1, F.col("longest")), zero, step, lambda a: F.struct((-a["dice"]).alias("far"), start.alias("start"), a["end"].alias("end")))

    hits = F.transform(F.filter("s", lambda e: e["hit"]), lambda e: e["i"])
    d = _held(d, v=F.array_sort(F.filter(F.transform(hits, best), lambda v: -v["far"] * 100 >= percent - 1e-9)))
    # the line of each word, and the lines that match by themselves
    d = _held(d.where(F.size("v") > 0), l=F.transform(F.split("text", "\n"), lambda x: _words(x)))
    d = _held(d, l=F.transform("l", lambda x: F.when(F.get(x, F.lit(0)) == "", 0).otherwise(F.size(x))))
    d = _held(d, of=F.flatten(F.transform("l", lambda n, i: F.array_repeat(i, n))))
    d = _held(d, lines=F.transform("l", lambda n, i: F.array_distinct(F.slice("g", F.greatest(F.array_position("of", i), F.lit(1)).cast("int"), F.greatest(n - 1, F.lit(0))))))
    match = lambda u: 200.0 * F.size(F.array_intersect(u, F.col("b"))) / (F.size(u) + F.col("nb")) >= percent - 1e-9
    d = _held(d, own=F.filter(F.transform("lines", lambda u, i: F.when(match(u), i)), lambda i: i.isNotNull()), u=F.array_distinct("g")).where(~match(F.col("u")))
    spans = F.transform("v", lambda v: F.struct(v["far"], v["start"], v["end"], F.get("of", v["start"]).alias("line"), F.get("of", v["end"] + 1).alias("last")))
    free = F.filter(spans, lambda v: ~F.exists("own", lambda i: i.between(v["line"], v["last"])))
    # best first, those that share a word with a better one are left out
    d = _held(d, v=free).where(F.size("v") > 0)
    none = F.slice("v", 1, 0)
    d = _held(d, v=F.aggregate("v", none, lambda acc, v: F.when(F.exists(acc, lambda o: (v["start"] <= o["end"] + 1) & (o["start"] <= v["end"] + 1)), acc).otherwise(F.concat(acc, F.array(v)))))
    found = d.select("doc_id", "row", "license", F.inline("v")).withColumn("dice", -F.col("far"))
    out = found.groupBy("doc_id", "row", "line").agg(F.min_by(F.struct("license", "dice"), F.struct("far", "license")).alias("m"))
    return out.select("doc_id", "line", "m.license", "m.dice")


def scan_licenses(docs: DataFrame, templates: DataFrame, percent: int = 80) -> DataFrame:
    """Returns (doc_id, line, license, dice): units of documents and the licence they match best.

    A unit is a line (its number, from 0) or, if the text has several, the whole text (line -1). Windows of words (with the
    number of the line they start in) are compared as well: of at most (200 - percent) / percent times the template's words,
    beginning and ending with one of its bigrams, as others match less. Windows in a text, or over a line, that matches the
    licence as a unit are left out; of windows of one licence that share words the best stays, then the first; of windows that
    start in one line, the best. A template of one word is compared with units only. Normalising lower-cases A-Z
    and turns runs of characters other than letters and digits into one space. Dice is 2 * common / (a + b) over distinct
    bigrams; a unit matches at percent / 100 or more, ties go to the first licence by name. Units without words match nothing,
    so null and empty texts give no rows. Repeated rows give repeated results. Templates without words and null licences are
    ignored; extra columns too; an empty table on either side gives an empty result.
    """
    given = _with_bigrams(templates.where("license is not null").select("license", "text"), "text", "b")
    # of any n - need + 1 of a template's n bigrams a matching unit has one; long ones are rare
    need = F.ceil(F.size("b") * F.lit(percent) / F.lit(200 - percent) - F.lit(1e-9)).cast("int")
    by_length = F.transform(F.array_sort(F.transform("b", lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x")))), lambda e: e["x"])
    full = templates.where("license is not null").select("license", "text").withColumn("w", _words(F.col("text"))).where(F.get("w", F.lit(0)) != "")
    full = full.withColumn("b", F.array_distinct(F.when(F.size("w") == 1, F.col("w")).otherwise(_pairs("w"))))
    signs = full.select("license", "b", F.greatest(F.size("w") - 1, F.lit(1)).alias("m"), need.alias("need"), F.slice(by_length, F.lit(1), F.size("b") - need + 1).alias("signs"))
    signs = signs.withColumn("sign", F.explode("signs"))
    docs, known = docs.select("doc_id", "text"), []
    if signs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        # whatever the unit, a sign must be there; texts with one are few, and written once for units and windows
        known = sorted(r.sign for r in signs.select("sign").distinct().collect())
        w = free_name(docs, "_w")
        docs = stored(_held(docs, **{w: _words(F.col("text"))}).where(_has_sign(w, known)).select("doc_id", "text"), "licensed")
        signs = F.broadcast(signs)
    low = F.ceil(F.size("b") * F.lit(percent) / F.lit(200 - percent) - F.lit(1e-9)).cast("int")
    high = F.floor(F.size("b") * F.lit(200 - percent) / F.lit(percent) + F.lit(1e-9)).cast("int")
    sized = given.select("license", "b", F.explode(F.sequence(low, high)).alias("n"))
    if sized.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sized = F.broadcast(sized)
    row = free_name(docs, "row")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    units = docs.select("doc_id", F.monotonically_increasing_id().alias(row), F.concat(F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("unit"))), F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit")))).otherwise(F.array().cast("array<struct<line:int,unit:string>>"))).alias("units"))
    units = units.select("doc_id", row, F.inline("units"))
    met = _with_bigrams(units, "unit", "u").withColumn("n", F.size("u")).join(sized, "n")
    dice = met.withColumn("dice", 2 * F.size(F.array_intersect("u", "b")) / (F.size("u") + F.size("b"))).where(F.col("dice") * 100 >= percent - 1e-9)
    best = dice.groupBy("doc_id", row, "line").agg(F.min_by(F.struct("license", "dice"), F.struct(-F.col("dice"), "license")).alias("m"))
    return best.select("doc_id", "line", "m.license", "m.dice").union(_windows(docs, signs, known, percent))
