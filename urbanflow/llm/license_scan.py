"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

Each line, each block of lines without a blank one between them, and each whole text is a unit with a sparse vector: a
weight tf * idf for each word, with idf from the templates (log((1 + templates) / (1 + templates with the word)) + 1);
words that no template has weigh the most, stop words nothing.  A cosine of MIN_COSINE or more to a template gives its licence; the best
unit (ties: line before block before text, then the earlier, then the smaller licence) is the file's.  An
`SPDX-License-Identifier` line states a licence outright.

Only units that may reach MIN_COSINE are scored, by an exact bound: the words that a unit shares with a template must
carry MIN_COSINE ** 2 of its squared weight, so a unit has at least one of any words that carry more than the rest.
`anchors` takes the heaviest words of each template until they do, everyday words last; a text without any is left out
by the scan.  For the same reason a unit has as many different words of the template as its heaviest words need for that
weight (`enough`); units with fewer are never shuffled.

In a directory the file with the smallest key that has a licence serves as its licence file; files without a licence of
their own take that of the nearest directory above them that has one, by joining each directory to its ancestors and
those to the licence files.

Everything is built-in SQL.  Templates are a parameter of a few hundred words in all.  Inheritance joins directories, not
files, so a directory with a third of all files sends one row per task.

Defined cases: null texts have no lines; null paths have no directory and inherit nothing; null keys have no licence of
their own; rows that share a key are one file, whose licence is the best of theirs; . and - between word characters
belong to a word, all else separates words; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.llm.common import ascii_lower, quoted, written

#: Public licence texts, notices and titles.
PERMIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
REDISTRIBUTE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
SOURCE_BINARY = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
ENDORSE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", f"{REDISTRIBUTE}: {SOURCE_BINARY} {BSD_AS_IS}"],
    "BSD-3-Clause": [REDISTRIBUTE, "BSD 3-Clause License", f"{REDISTRIBUTE}: {SOURCE_BINARY} {ENDORSE} {BSD_AS_IS}", ENDORSE],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [ISC],
    "MIT": ["Released under the MIT License.", "The MIT License (MIT)", PERMIT, f"{PERMIT} {AS_IS}"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
}
MIN_COSINE = 0.8
#: Stop words, which count for nothing, and everyday words, which `anchors` takes last.
STOP = """a above all an and any are as at be but by can do even event for from has have hereby however if in included including into is it its may must neither no nor not of on one or
other otherwise out shall so such that the their there these this to under use used was way where whether which with without you your""".split()
COMMON = set("""2 2.0 29 3 4.0 2004 2007 action appear author authors business charge claim code conditions connection copies copy damage data deal direct file following form forms free general goods
international january june language later law limited list loss materials name names option particular person persons prior program promote provided public publish published purpose required rights
see services software source special specific strict subject terms theory version work written""".split())
WORD = r"[0-9a-z]+(?:[.-][0-9a-z]+)*"
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]+)"
BLANK = r"\n[ \t\r]*\n"
KINDS = ("spdx", "line", "block", "text")
#: What names a unit: the file, the hash of its text, and the unit's kind and place.
UNIT = ("key", "version", "kind", "place")


def words(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(ascii_lower(text), F.lit(f"({WORD})"), F.lit(1)), lambda w: ~w.isin(*STOP))


def flat(templates: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(licence, text) by licence, then text: the order in which ties are broken."""
    return sorted((name, text) for name, texts in templates.items() for text in texts)


def weights(templates: dict[str, list[str]]) -> tuple[dict[str, float], list[dict[str, float]], float]:
    """idf by word, weight / norm by word of each template, and the idf of a word that no template has."""
    tfs = [Counter(w for w in re.findall(WORD, text.lower()) if w not in STOP) for _, text in flat(templates)]
    holders = Counter(word for tf in tfs for word in tf)
    n = len(tfs)
    idf = {word: math.log((1 + n) / (1 + k)) + 1 for word, k in holders.items()}
    norms = [math.sqrt(sum((k * idf[word]) ** 2 for word, k in tf.items())) for tf in tfs]
    return idf, [{word: k * idf[word] / norm for word, k in tf.items()} for tf, norm in zip(tfs, norms, strict=True)], math.log(1 + n) + 1


def anchors(templates: dict[str, list[str]], min_cosine: float) -> list[str]:
    """Words of which every unit has one that reaches min_cosine with any template."""
    out = set()
    for own in weights(templates)[1]:
        carried = 0.0
        for word in sorted(own, key=lambda w: (w in COMMON, -own[w], w)):
            if carried > 1 - (min_cosine - 1e-6) ** 2:
                break
            carried += own[word] ** 2
            out.add(word)
    return sorted(out)


def enough(templates: dict[str, list[str]], min_cosine: float) -> Column:
    """Whether `shared`, the template words of a unit, may reach min_cosine with a template: its heaviest words tell how many it takes."""
    out = F.lit(False)
    for own in weights(templates)[1]:
        need, carried = 0, 0.0
        for w in sorted(own.values(), reverse=True):
            if carried >= (min_cosine - 1e-6) ** 2:
                break
            need, carried = need + 1, carried + w * w
        out = out | (F.size(F.array_intersect("shared", F.array(*map(F.lit, sorted(own))))) >= need)
    return out


def weight_rows(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """word, idf and tw, its weight in each template; a few hundred rows."""
    idf, tw, _ = weights(templates)
    return spark.createDataFrame([(word, idf[word], [t.get(word, 0.0) for t in tw]) for word in sorted(idf)], "word string, idf double, tw array<double>")


def scan(files: DataFrame, templates: dict[str, list[str]], key: str = "doc_id", text: str = "text", min_cosine: float = MIN_COSINE) -> DataFrame:
    """key, license, cosine, kind (of unit) and place (its position among those) of each file with a licence of its own."""
    names = [name for name, _ in flat(templates)]
    has = lambda c: c.rlike("(?i)(?<![0-9a-z])(?:" + "|".join(map(re.escape, anchors(templates, min_cosine))) + ")")
    rows = files.select(quoted(key).alias("key"), F.xxhash64(quoted(text)).alias("version"), quoted(text).alias("text"))
    unit = lambda kind: lambda body, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("place"), body.alias("body"))
    blocks = F.filter(F.transform(F.split("text", BLANK), unit("block")), lambda u: u.body.contains("\n"))
    whole = F.when(F.col("text").contains("\n"), F.array(F.struct(F.lit(KINDS.index("text")).alias("kind"), F.lit(0).alias("place"), F.col("text").alias("body"))))
    units = rows.where(has(F.col("text"))).select("key", "version", F.inline(F.concat(F.transform(F.split("text", "\n"), unit("line")), blocks, F.coalesce(whole, F.array().cast("array<struct<kind:int,place:int,body:string>>")))))
    units = units.where(has(F.col("body")))
    # Exploding an array of one keeps the optimizer from putting the tokens' expression in place of each mention of them.
    once = lambda c, name: F.explode(F.array(c)).alias(name)
    units = units.select(*UNIT, once(words(F.col("body")), "words"))
    known = F.array(*map(F.lit, sorted(weights(templates)[0])))
    units = units.select("*", once(F.array_intersect("words", known), "shared")).where(enough(templates, min_cosine))
    # The squares of all counts, by sorted runs, and the counts of template words: no word but those leaves its row.
    run = lambda a, w: F.when(a.w == w, F.struct(w.alias("w"), (a.n + 1).alias("n"), (a.q + 2 * a.n + 1).alias("q"))).otherwise(F.struct(w.alias("w"), F.lit(1).cast("bigint").alias("n"), (a.q + 1).alias("q")))
    zero = F.lit(0).cast("bigint")
    squares = F.aggregate(F.array_sort("words"), F.struct(F.lit("").alias("w"), zero.alias("n"), zero.alias("q")), run, lambda a: a.q)
    counts = F.transform("shared", lambda w: F.struct(w.alias("word"), F.size(F.filter("words", lambda x: x == w)).cast("bigint").alias("tf")))
    tf = units.select(*UNIT, squares.alias("squares"), F.size("shared").alias("k"), F.inline(counts))
    table, top = weight_rows(files.sparkSession, templates), weights(templates)[2]
    weighed = tf.join(F.broadcast(table), "word").withColumn("w", F.col("tf") * F.col("idf"))
    # Equal rows of one key add up to `times` times their sums.
    square = F.col("squares") * top**2 / F.col("k") + F.col("w") * F.col("w") - F.col("tf") * F.col("tf") * top**2
    dot = lambda i: F.sum(F.col("w") * F.col("tw")[i])
    times = F.count("*") / F.max("k")
    scored = weighed.groupBy(*UNIT).agg(F.sqrt(F.sum(square) * times).alias("norm"), *(dot(i).alias(f"d{i}") for i in range(len(names))))
    each = F.array(*(F.struct((-F.round(F.col(f"d{i}") / F.col("norm"), 6)).alias("c"), F.col("kind"), F.col("place"), F.lit(name).alias("license")) for i, name in enumerate(names)))
    found = scored.select("key", F.array_min(each).alias("b")).where(-F.col("b.c") >= min_cosine)
    stated = rows.where(F.col("text").contains("SPDX-License-Identifier:")).select("key", F.regexp_extract("text", SPDX, 1).alias("license")).where("license <> ''")
    stated = stated.select("key", F.struct(F.lit(-1.0).alias("c"), F.lit(KINDS.index("spdx")).alias("kind"), F.lit(0).alias("place"), "license").alias("b"))
    best = found.unionByName(stated).groupBy("key").agg(F.min("b").alias("b"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("b.kind") + 1)
    return best.select(F.col("key").alias(key), F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"), kind.alias("kind"), F.col("b.place").alias("place"))


def inherit(files: DataFrame, own: DataFrame, path: str = "path", key: str = "doc_id") -> DataFrame:
    """key, path, license, its `origin` (own, directory or null), from_dir, cosine, kind and place of each row of files."""
    own = written(own, "own")  # it is read three times below
    folder = F.when(F.instr(quoted(path), "/") > 0, F.regexp_replace(quoted(path), "/[^/]*$", ""))
    rows = files.select(quoted(key).alias(key), quoted(path).alias(path), folder.alias("dir")).join(own, key, "left")
    held = rows.where("license is not null and dir is not null").groupBy("dir").agg(F.min(F.struct(F.col(key).alias("k"), "license")).alias("f")).select(F.col("dir").alias("up"), F.col("f.license").alias("up_license"))
    parts = F.split("dir", "/")
    ups = rows.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("up"))
    near = ups.join(held, "up").groupBy("dir").agg(F.max(F.struct(F.length("up").alias("n"), "up", "up_license")).alias("b")).select("dir", F.col("b.up").alias("from_dir"), F.col("b.up_license").alias("dir_license"))
    out = rows.join(near, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        key, path, F.coalesce("license", "dir_license").alias("license"),
        F.when(mine, "own").when(F.col("dir_license").isNotNull(), "directory").alias("origin"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"), "cosine", "kind", "place")
