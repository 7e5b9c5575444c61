"""Licence notices in documents, by Dice's coefficient over word bigrams."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import packed, unpacked

#: Public notices of common licences: fixed values.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        'or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        'or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0-1.0": ("CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "bsd": (
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the "
        "names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
}
#: Least coefficient in hundredths.
LEAST = 80
MARK = "[^a-z0-9]+"


def template_bigrams(text: str) -> list[str]:
    """The distinct pairs of neighbouring words, A-Z in lower case and all but letters and digits as spaces."""
    kept = "".join(c if c.isalnum() and c.isascii() else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    words = kept.split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(n: int, least: int) -> tuple[int, int]:
    """Sizes of a bigram set whose coefficient with one of size n can reach least / 100: 2 min / (sum of both) is the most it can be."""
    return -(-least * n // (200 - least)), n * (200 - least) // least


def words_in(unit: Column) -> Column:
    """Runs of ASCII letters and digits, A-Z in lower case. The two other characters that have an ASCII letter in lower case divide words
    as all others do."""
    plain = F.replace(F.replace(unit, F.lit("\u0130"), F.lit(" ")), F.lit("\u212a"), F.lit(" "))
    return F.filter(F.split(F.lower(plain), MARK), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Of a variable of words: an expression would be computed anew for each use."""
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) >= 2, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def least_words(grams: list[str], least: int) -> tuple[list[str], int, list[str], int]:
    """First words of a template's bigrams and how many different ones of them a notice must have at least, and the same of second words.

    A notice shares so many bigrams with the template at least; fewer first words than returned can't begin that many.
    """
    needed = -(-least * (size_bounds(len(grams), least)[0] + len(grams)) // 200)
    out = []
    for side in (0, 1):
        counts = Counter(g.split()[side] for g in grams)
        total = k = 0
        for n in sorted(counts.values(), reverse=True):
            if total >= needed:
                break
            total, k = total + n, k + 1
        out += [sorted(counts), k]
    return tuple(out)


def runs_between(low: int, high: int) -> Column:
    """Of the columns ``sizes`` (words of each paragraph) and ``before`` (words before each, and of all), the first and last places of all
    runs of two paragraphs or more with ``low`` to ``high`` bigrams by their number of words. Paragraphs without words are none, so
    that a run has at most high + 1."""
    n = F.size("sizes")
    words = lambda i, j: F.get("before", j + 1) - F.get("before", i)
    last = lambda i: F.sequence(i + 1, F.least(n - 1, i + high))
    of = lambda i: F.transform(F.filter(last(i), lambda j: words(i, j).between(low + 1, high + 1)), lambda j: F.struct(i.alias("i"), j.alias("j")))
    return F.when(n >= 2, F.flatten(F.transform(F.sequence(F.lit(0), n - 2), of))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))


def license_scan(docs: DataFrame, text_col: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` with ``licenses`` (sorted, distinct), ``license`` and ``license_score`` of the best match, ``n_notices``.

    Compared are each line, each paragraph (between empty lines), each run of paragraphs and the whole text. A unit is a notice of a
    template if Dice's coefficient of their sets of word bigrams is ``least`` hundredths or more; only templates whose size can reach
    that are compared, and runs whose number of words is a template's. Texts without as many words of a template as a notice must have
    are passed over (see least_words). Everything happens inside the row, without a shuffle; the templates are literals of the plan,
    so their number must stay small. n_notices counts lines, paragraphs and whole texts that match, and one more if only runs do.

    Null and empty texts have no notice, a null licence and a score of 0. Ties go to the first template by name. Repeated rows get equal
    results, and an empty table an empty one; input columns of the same names are replaced.
    """
    known = [(name, g) for name in sorted(templates) for t in templates[name] if (g := template_bigrams(t))]
    low = min((size_bounds(len(g), least)[0] for _, g in known), default=1)
    high = max((size_bounds(len(g), least)[1] for _, g in known), default=0)
    strings = lambda xs: F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")
    heads = strings(sorted({b for _, g in known for b in g}))
    rows = packed(docs, text=docs[f"`{text_col}`"]).select("row", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("row", "text", F.array_intersect(words_in(F.col("text")), strings(sorted({w for _, g in known for x in g for w in x.split()}))).alias("met"))
    able = F.lit(False)
    for _, g in known:
        first, n_first, second, n_second = least_words(g, least)
        able = able | (F.size("met") >= max(n_first, n_second)) & (F.size(F.array_intersect("met", strings(first))) >= n_first) & (F.size(F.array_intersect("met", strings(second))) >= n_second)
    rows = rows.select("row", F.when(able, F.col("text")).otherwise(F.lit("")).alias("text"))
    paragraphs = F.split("text", r"\n[\x20\x09-\x0D]*\n")
    units = F.array_distinct(F.concat(F.split("text", "\n"), F.when(F.size(paragraphs) > 1, paragraphs).otherwise(F.array().cast("array<string>")), F.array("text")))
    # n words have at most n - 1 bigrams, and need 2 n - 1 characters
    rows = rows.select("row", F.filter(units, lambda u: F.length(u) >= 2 * low + 1).alias("units"), F.filter(F.transform(paragraphs, words_in), lambda w: F.size(w) > 0).alias("parts"))
    sums = F.aggregate(F.transform("parts", lambda w: F.size(w)), F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    rows = rows.select("row", F.transform("units", words_in).alias("worded"), "parts", F.transform("parts", lambda w: F.size(w)).alias("sizes"), sums.alias("before"))
    rows = rows.select("row", "worded", "parts", runs_between(low, high).alias("runs"))
    joined = F.transform("runs", lambda r: F.flatten(F.slice("parts", r["i"] + 1, r["j"] - r["i"] + 1)))
    rows = rows.select("row", F.transform("worded", bigrams).alias("grams"), F.transform(joined, bigrams).alias("run_grams"))
    fits = lambda c: F.filter(c, lambda g: F.size(g).between(low, high) & F.arrays_overlap(g, heads))
    rows = rows.select("row", fits("grams").alias("grams"), fits("run_grams").alias("run_grams"))

    def matches(g: Column) -> Column:
        found = []
        for name, t in known:
            lo, hi = size_bounds(len(t), least)
            both = F.size(F.array_intersect(g, strings(t)))
            total = F.size(g) + len(t)
            found.append(F.when((F.size(g) >= lo) & (F.size(g) <= hi) & (200 * both >= least * total), F.struct((200.0 * both / total).alias("score"), F.lit(name).alias("name"))))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    kind = "array<struct<score:double,name:string>>"
    hits = lambda c: F.filter(F.transform(c, matches), lambda m: F.size(m) > 0) if known else F.array().cast(f"array<{kind}>")
    rows = rows.select("row", hits("grams").alias("hits"), hits("run_grams").alias("run_hits"))
    count = F.when(F.size("hits") > 0, F.size("hits")).otherwise(F.least(F.lit(1), F.size("run_hits")))
    rows = rows.select("row", count.cast("long").alias("n"), F.flatten(F.concat("hits", "run_hits")).alias("found"))
    best = F.aggregate("found", F.lit(None).cast("struct<score:double,name:string>"), lambda a, x: F.when(a.isNull() | (x["score"] > a["score"]) | ((x["score"] == a["score"]) & (x["name"] < a["name"])), x).otherwise(a))
    rows = rows.select("row", "n", F.array_sort(F.array_distinct(F.transform("found", lambda x: x["name"]))).alias("names"), best.alias("best"))
    return unpacked(rows, docs.columns, licenses=F.col("names"), license=F.col("best.name"), license_score=F.coalesce("best.score", F.lit(0.0)), n_notices=F.col("n"))
