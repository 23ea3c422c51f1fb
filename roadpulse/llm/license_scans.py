"""Licence scans: texts against licence templates by the Dice coefficient of word bigrams.

What is compared are the units of a document: the whole text, each paragraph (between
blank lines) and each line, normalised to lower-case words. A unit matches a template
where 2 * common / (bigrams of the unit + bigrams of the template) reaches DICE. That
needs sizes within DICE / (2 - DICE) of each other, so a unit meets only the templates
that its number of bigrams allows, which for most units are none.

Then the passages: all runs of words, across lines and paragraphs or within a line, of up
to the largest size that the template allows (and as many repeats as the template has).
Per template the best passage is one more match if it scores better than each unit.
``n_units`` counts units only.

A match has at least ``low`` bigrams in common, all of them bigrams of the whole text, so
units and passages are looked at only for templates that share as many with the text.
Passages start and end with a bigram of the template. They take time with the bigrams of a
text that stand as close together as a match needs, times the square of the template.

Native: column expressions within a row, no shuffle and no join; the templates are a
constant of the plan.

Defined cases. Null, empty and one-word texts have no bigrams and match nothing. Repeated
rows are scanned each on its own, a null ``doc_id`` is passed on. Equal scores go to the
template that comes first by name. Other columns of the input are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import let, whole_text

DICE = 0.8

# Licence texts and notices.
TEMPLATES = {
    "Apache-2.0 (name)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (notice)": """Licensed under the Apache License, Version 2.0 (the "License");
        you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and
        limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
        OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
        HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
        EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "CC-BY-4.0 (notice)": """This work is licensed under the Creative Commons Attribution 4.0
        International License.""",
    "CC-BY-NC-4.0 (name)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 (notice)": """This work is licensed under the Creative Commons
        Attribution-ShareAlike 4.0 International License.""",
    "GPL-3.0 (name)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 (notice)": """This program is free software: you can redistribute it and/or modify
        it under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
        See the GNU General Public License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
        OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
        FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "MIT (name)": "Released under the MIT License.",
}


def _words(text: str) -> list[str]:
    return re.findall(r"[\w]+", text.lower())


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, as ``_bigrams`` makes them of a column."""
    w = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def sizes(n: int, dice: float) -> tuple[int, int]:
    """The least and most bigrams of a unit that can reach ``dice`` with n of a template."""
    fits = [m for m in range(1, int(n * 2 / dice) + 2) if 2 * min(m, n) >= dice * (m + n)]
    return min(fits), max(fits)


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda line: F.trim(line))


def _joined(text: Column) -> Column:
    """The words of all lines of a normalised text with one space between them."""
    return F.array_join(F.filter(_lines(text), lambda line: line != ""), " ")


def _units(text: Column) -> Column:
    """Whole, paragraphs and lines of a text that has only words, spaces and \\n, each once."""
    paragraphs = F.transform(F.split(text, r"\n\s*\n"), _joined)
    blank_lines = F.when(text.rlike(r"\n\s*\n"), paragraphs).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(_joined(text)), blank_lines, _lines(text)))


def _all_bigrams(unit: Column) -> Column:
    return F.when(F.size(unit) < 2, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.size(unit) - 1),
            lambda i: F.concat_ws(" ", F.get(unit, i - 1), F.get(unit, i)),
        )
    )


def _bigrams(unit: Column) -> Column:
    return F.array_distinct(_all_bigrams(unit))


def _best_passage(pairs: Column, t: Column, above: Column) -> Column:
    """The best coefficient of a template and a passage if higher than ``above``, else ``above``.

    ``pairs`` are all bigrams of the text in order.
    """

    def from_start(at: Column) -> Column:
        # At 1-based bigram ``at``: its passages grow bigram by bigram.
        def grow(run: Column) -> Column:
            def step(state: Column, j: Column) -> Column:
                pair = F.get(run, j - 1)
                new = (F.array_position(run, pair) == j).cast("int")
                hit = F.array_contains(t["pairs"], pair)
                common, n = state["common"] + new * hit.cast("int"), state["n"] + new
                score = F.when(hit, 2.0 * common / (n + t["n"])).otherwise(F.lit(0.0))
                return F.struct(
                    common.alias("common"), n.alias("n"), F.greatest(state["best"], score).alias("best")
                )

            none = F.struct(F.lit(0).alias("common"), F.lit(0).alias("n"), F.lit(0.0).alias("best"))
            return F.aggregate(F.sequence(F.lit(1), F.size(run)), none, step, lambda state: state["best"])

        return let(F.slice(pairs, at, t["span"]), grow)

    def over(hits: Column) -> Column:
        def step(best: Column, k: Column) -> Column:
            at = F.get(hits, k)
            # A better passage has more than this many bigrams in common, all within the span.
            least = F.greatest(F.floor(best * t["n"] / (2 - best) - 1e-6).cast("int"), F.lit(1))
            dense = F.coalesce(F.get(hits, k + least - 1) < at + t["span"], F.lit(False))
            return F.when(dense & (best < 1.0), F.greatest(best, from_start(at))).otherwise(best)

        return F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), above, step)

    numbers = F.sequence(F.lit(1), F.size(pairs))
    return let(F.filter(numbers, lambda i: F.array_contains(t["pairs"], F.get(pairs, i - 1))), over)


def matches(docs: DataFrame, templates: dict[str, str] | None = None, dice: float = DICE) -> DataFrame:
    """``doc_id``, ``n_units`` and ``matches``: per match of unit or passage its dice, best first."""
    named = sorted((templates or TEMPLATES).items())
    known = [(name, bigrams(text)) for name, text in named]
    rows = [
        F.struct(
            F.lit(name).alias("license"), F.lit(i).alias("place"), F.lit(len(pairs)).alias("n"),
            F.lit(sizes(len(pairs), dice)[0]).alias("low"), F.lit(sizes(len(pairs), dice)[1]).alias("high"),
            F.lit(sizes(len(pairs), dice)[1] + len(_words(named[i][1])) - 1 - len(pairs)).alias("span"),
            F.array(*map(F.lit, pairs)).alias("pairs"),
        )
        for i, (name, pairs) in enumerate(known)
    ]
    # A unit may repeat bigrams, so only the lower bound holds for its number of words.
    least = min(sizes(len(pairs), dice)[0] for _, pairs in known)
    table = F.array(*rows)
    vocabulary = F.array(*map(F.lit, sorted({pair for _, pairs in known for pair in pairs})))

    def near(pairs: Column) -> Column:
        """The templates that share enough bigrams with the text."""
        return let(
            F.array_intersect(pairs, vocabulary),
            lambda shared: F.when(F.size(shared) < least, F.slice(table, 1, 0)).otherwise(
                F.filter(table, lambda t: F.size(F.array_intersect(shared, t["pairs"])) >= t["low"])
            ),
        )

    def scan(unit: Column) -> Column:
        def against(pairs: Column) -> Column:
            n = F.size(pairs)
            fits = F.filter("near", lambda t: (n >= t["low"]) & (n <= t["high"]))
            scores = F.transform(
                fits,
                lambda t: F.struct(
                    (-2.0 * F.size(F.array_intersect(pairs, t["pairs"])) / (n + t["n"])).alias("minus"),
                    t["place"].alias("place"), t["license"].alias("license"),
                ),
            )
            return F.filter(scores, lambda s: s["minus"] <= -dice)

        return let(_bigrams(unit), against)

    def passage(t: Column) -> Column:
        of_units = F.get(F.filter("of_units", lambda s: s["place"] == t["place"]), F.lit(0))
        # The next number below: a coefficient above it reaches the threshold.
        above = F.coalesce(-of_units["minus"], F.lit(math.nextafter(dice, 0)))

        def scored(least_score: Column) -> Column:
            best = F.when(least_score < 1.0, _best_passage(F.col("pairs"), t, least_score))
            return let(best, lambda b: F.struct(
                F.when(b > least_score, -b).alias("minus"), t["place"].alias("place"), t["license"].alias("license"),
            ))

        return let(above, scored)

    text = F.regexp_replace(F.lower(whole_text(F.col("text"))), r"[^\p{L}\p{N}_\n]+", " ")
    normal = docs.select("doc_id", text.alias("t")).select("doc_id", "t", _units(F.col("t")).alias("units"))
    paired = normal.select("*", let(F.split(F.get("units", F.lit(0)), " "), _all_bigrams).alias("pairs"))
    met = paired.select("*", near(F.col("pairs")).alias("near"))
    some = F.size("near") > 0
    split = F.transform("units", lambda u: F.split(u, " "))
    long_enough = F.filter(split, lambda u: F.size(u) > least)
    scanned = met.select(
        "*", F.when(some, F.sort_array(F.flatten(F.transform(long_enough, scan)))).alias("of_units"),
    )
    passages = F.filter(F.transform("near", passage), lambda s: s["minus"].isNotNull())
    found = F.when(some, F.sort_array(F.concat("of_units", passages)))
    empty = F.array().cast("array<struct<license:string,dice:double>>")
    return scanned.select(
        "doc_id", F.size("units").cast("long").alias("n_units"),
        F.coalesce(F.transform(
            found, lambda s: F.struct(s["license"].alias("license"), (-s["minus"]).alias("dice"))
        ), empty).alias("matches"),
    )


def op2_license_scans(spark, sf_dir: str) -> DataFrame:
    best = F.get("matches", F.lit(0))
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_units", F.size("matches").cast("long").alias("n_matches"),
        best["license"].alias("license"), F.round(best["dice"], 6).alias("dice"),
    )


def _template_rows() -> str:
    rows = []
    for i, (name, text) in enumerate(sorted(TEMPLATES.items())):
        pairs = bigrams(text)
        low, high = sizes(len(pairs), DICE)
        span = high + len(_words(text)) - 1 - len(pairs)
        rows.append(f"({i}, '{name}', {len(pairs)}, {low}, {high}, {span}, {pairs!r})")
    return ",\n  ".join(rows)


SQL = rf"""
with templates(place, license, n, low, high, span, pairs) as (values
  {_template_rows()}),
t as (select row_number() over () as row_id, doc_id,
             regexp_replace(lower(coalesce(text, '')), '[^\pL\pN_\n]+', ' ', 'g') as t from documents),
u as (select row_id, doc_id, list_distinct(list_transform(
               list_concat([t], string_split_regex(t, '\n\s*\n'), string_split(t, chr(10))),
               lambda x: trim(regexp_replace(x, '\s+', ' ', 'g')))) as units from t),
w as (select row_id, string_split(unnest(units), ' ') as ws from u),
b as (select row_id, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as pairs
      from w where len(ws) > 1),
m as (select row_id, license, place,
             2.0 * len(list_intersect(b.pairs, templates.pairs)) / (len(b.pairs) + n)::double as dice
      from b join templates on len(b.pairs) between low and high),
-- Passages: all runs of words that start and end with a bigram of a template.
a as (select row_id, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) as pairs
      from (select row_id, string_split(units[1], ' ') as ws from u) where len(ws) > 1),
near as (select row_id, place, license, n, span, a.pairs, templates.pairs as own
         from a join templates on len(list_intersect(list_distinct(a.pairs), templates.pairs)) >= low),
starts as (select *, unnest(range(1, len(pairs) + 1)) as i from near),
runs as (select *, unnest(range(i, least(i + span, len(pairs) + 1))) as j from starts
         where list_contains(own, pairs[i])),
sets as (select row_id, place, license, n, own, list_distinct(pairs[i:j]) as run from runs
         where list_contains(own, pairs[j])),
passages as (select row_id, place, license,
                    max(2.0 * len(list_intersect(run, own)) / (len(run) + n)::double) as dice
             from sets group by all),
of_units as (select row_id, place, max(dice) as dice from m group by all),
found as (select row_id, license, place, dice from m where dice >= {DICE}
          union all
          select row_id, license, place, p.dice from passages p left join of_units o using (row_id, place)
          where p.dice >= {DICE} and (coalesce(o.dice, 0) < {DICE} or p.dice > o.dice)),
best as (select row_id, count(*) as n_matches,
                arg_min(license, {{'a': -dice, 'b': place}}) as license, max(dice) as dice
         from found group by row_id)
select doc_id, cast(len(units) as bigint) as n_units, coalesce(n_matches, 0) as n_matches, license,
       round(dice, 6) as dice
from u left join best using (row_id)"""
