"""Licence scan (DataFrame functions only): windows of normalised words against licence templates by the Dice
coefficient over word bigrams.

A text is normalised to words (A-Z lower-cased, runs of other characters than ``[a-z0-9]`` part words), line breaks
included. A window of a template of n words is n consecutive words of the text, or what is left of it at its end, that begin with a word
pair of the template. ``dice = 2 |A & B| / (|A| + |B|)`` over the distinct word pairs of window and template.

1. Pruning. Sharing x pairs gives at most ``2 x / (x + |B|)``, so a match shares at least ``t |B| / (2 - t)`` pairs with the
   template and holds one of any ``|B| - that + 1`` of them. Texts without the longest word of any of
   these pairs are left out, by one look-up of their words in a literal list.
2. Inverted table: the pairs of the texts that are left are joined with the (fixed, broadcast) table pair -> templates; only
   these shared pairs are shuffled. A text stays a candidate of the templates of which it holds enough distinct ones.
3. Windows. A pair counts in the windows that hold it and not its previous occurrence: these start in one interval. So the
   number of distinct shared pairs of each window is a running sum over interval ends, linear in the pairs. Where windows share
   enough, their own distinct pairs are counted in the same way, over that part of the text.
4. Of matches whose best windows overlap, the one with the better Dice stays (ties: the first template).

SPDX identifiers (``SPDX-License-Identifier: ...``) are a rule of their own, without similarity.

Defined results: a null or empty text has no match and no identifier; a licence with several templates is named once; repeated rows give
repeated results; an empty table gives an empty result; the windows of a very long text are bounded by the text. Other columns, of any
name, play no part.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

THRESHOLD = 0.75

# The published wording of short notices, standard headers and whole licence texts.
TEMPLATES = (
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd-2-clause", "Released under the BSD 2-Clause License."),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("isc", "Released under the ISC License."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("agpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have
        received a copy of the GNU Affero General Public License along with this program."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
        License."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the
        copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission."""),
    ("bsl-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit
        the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
        so, all subject to the following:"""),
    ("gpl-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received
        a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin
        Street, Fifth Floor, Boston, MA 02110-1301 USA."""),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received
        a copy of the GNU General Public License along with this program."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
        AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
        EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
        FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software."""),
    ("mit", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
        OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
        any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"""),
)
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]+(?: (?:AND|OR|WITH) [A-Za-z0-9.+-]+)*)"


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def needed(pairs: int, threshold: float = THRESHOLD) -> int:
    """Fewest shared pairs of a match with a template of so many distinct pairs."""
    return math.ceil(threshold * pairs / (2 - threshold) - 1e-9)


def marker_words(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every text with a match holds at least one."""
    markers = set()
    for _, text in templates:
        bigrams = template_bigrams(text)
        longest = sorted((max(b.split(" "), key=lambda w: (len(w), w)) for b in bigrams), key=lambda w: (len(w), w), reverse=True)
        markers.update(longest[:len(bigrams) - needed(len(bigrams), threshold) + 1])
    return sorted(markers)


def words_of(text: Column) -> Column:
    """Normalised words; what stands between them goes before lower-casing, so only A-Z is concerned."""
    plain = F.lower(F.trim(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")))
    return F.split(plain, " ")


def _pairs(df: DataFrame, *keys: str) -> DataFrame:
    """The keys (r1, r2), place and pair: the word pairs of each text."""
    n = F.greatest(F.size("words") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("words", 1, n), F.slice("words", 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    return df.select(*(keys or ("r1", "r2")), F.posexplode(pairs).alias("place", "pair"))


_KEY = ["r1", "r2", "template"]


def _distinct_in_windows(rows: DataFrame, name: str) -> DataFrame:
    """Per text, template and place (``at``) the number of distinct pairs of ``rows`` in the window that starts there. rows: place and pair of
    occurrences, with the window's length."""
    before = F.lag("place").over(Window.partitionBy(*_KEY, "pair").orderBy("place"))
    # an occurrence counts in the windows that hold it and not the one before it
    start = F.greatest(F.coalesce(F.col("before") + 1, F.lit(0)), F.col("place") - F.col("length") + 2)
    point = lambda at, change: F.struct(at.cast("long").alias("at"), F.lit(change).alias("change"))
    ends = rows.withColumn("before", before).select(*_KEY, F.inline(F.array(point(start, 1), point(F.col("place") + 1, -1), point(F.col("place"), 0))))
    upto = Window.partitionBy(*_KEY).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ends.groupBy(*_KEY, "at").agg(F.sum("change").alias("change")).select(*_KEY, "at", F.sum("change").over(upto).alias(name))


def matches(texts: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """r1, r2, template, name, place, length, dice: the best window of each text (r1, r2, words) and each template that matches it."""
    spark = texts.sparkSession
    listed = [(k, name, len(template_words(text)), len(template_bigrams(text)), needed(len(template_bigrams(text)), threshold)) for k, (name, text) in enumerate(templates)]
    sizes = F.broadcast(spark.createDataFrame(listed, "template int, name string, length int, pairs int, needed int"))
    # the templates are a fixed list: these tables are small whatever the input
    inverted = F.broadcast(spark.createDataFrame([(k, b) for k, (_, text) in enumerate(templates) for b in template_bigrams(text)], "template int, pair string"))

    likely = texts.where(F.arrays_overlap("words", F.array(*map(F.lit, marker_words(templates, threshold)))))
    hits = written(_pairs(likely).join(inverted, "pair").distinct(), "op9-hits")
    enough = (hits.groupBy(*_KEY).agg(F.countDistinct("pair").alias("shared")).join(sizes, "template").where("shared >= needed")
              .select(*_KEY, "length", "needed", "pairs"))
    hits = hits.join(enough, _KEY)
    starts = hits.select(*_KEY, "length", "needed", "pairs", F.col("place").cast("long").alias("at")).distinct()
    starts = written(_distinct_in_windows(hits.select(*_KEY, "place", "pair", "length"), "both").join(starts, [*_KEY, "at"]).where("both >= needed"), "op9-starts")

    # the own pairs are counted only where such windows lie
    spans = starts.groupBy(*_KEY, "length").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    around = (likely.join(spans, ["r1", "r2"]).select(*_KEY, "length", "first", F.slice("words", (F.col("first") + 1).cast("int"), (F.col("last") - F.col("first") + F.col("length")).cast("int")).alias("words"))
              .dropDuplicates(_KEY))
    own = _pairs(around, *_KEY, "length", "first").select(*_KEY, "length", (F.col("place") + F.col("first")).alias("place"), "pair")
    scored = (_distinct_in_windows(own, "own").join(starts, [*_KEY, "at"]).join(sizes.select("template", "name"), "template")
              .withColumn("dice", F.round(2.0 * F.col("both") / (F.col("own") + F.col("pairs")), 6)).where(F.col("dice") >= threshold))
    best = scored.groupBy(*_KEY, "name", "length").agg(F.max(F.struct("dice", (-F.col("at")).alias("back"))).alias("best"))
    return best.select(*_KEY, "name", (-F.col("best.back")).alias("place"), "length", "best.dice")


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_matches (windows that stay), licenses (names in order, joined by commas), best_dice (0 without a
    match, 6 digits) and spdx (identifiers in order, joined by commas)."""
    text = F.coalesce(docs["text"], F.lit(""))
    key = [F.xxhash64(docs["doc_id"], text).alias("r1"), F.hash(docs["doc_id"], text).alias("r2")]
    found = matches(docs.select(*key, words_of(text).alias("words")), templates, threshold)
    all_of = found.groupBy("r1", "r2").agg(F.collect_list(F.struct("template", "name", "place", "length", "dice")).alias("all"))      # at most one per template

    def beaten(x):
        return F.exists("all", lambda y: (y["place"] < x["place"] + x["length"]) & (x["place"] < y["place"] + y["length"])
                        & ((y["dice"] > x["dice"]) | ((y["dice"] == x["dice"]) & (y["template"] < x["template"]))))
    stay = written(all_of.select("r1", "r2", F.filter("all", lambda x: ~beaten(x)).alias("stay")), "op9-found")
    identifiers = F.when(F.contains(text, F.lit("SPDX-License-Identifier:")), F.regexp_extract_all(text, F.lit(SPDX), F.lit(1)))
    listed = docs.select(docs["doc_id"].alias("doc_id"), *key, F.array_join(F.array_sort(F.array_distinct(identifiers)), ",").alias("spdx"))
    return listed.join(stay, ["r1", "r2"], "left").select(
        "doc_id", F.coalesce(F.size("stay"), F.lit(0)).cast("long").alias("n_matches"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("stay", lambda s: s["name"]))), ","), F.lit("")).alias("licenses"),
        F.coalesce(F.array_max(F.transform("stay", lambda s: s["dice"])), F.lit(0.0)).alias("best_dice"), F.coalesce("spdx", F.lit("")).alias("spdx"))


def _oracle(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    pairs = ", ".join(f"({k}, '{b}')" for k, (_, t) in enumerate(templates) for b in template_bigrams(t))
    sizes = ", ".join(f"({k}, '{n}', {len(template_words(t))}, {len(template_bigrams(t))}, {needed(len(template_bigrams(t)), threshold)})" for k, (n, t) in enumerate(templates))
    return f"""
with inverted(template, pair) as (values {pairs}), sizes(template, name, length, pairs, needed) as (values {sizes}),
d as (select doc_id, row_number() over () as rid, coalesce(text, '') as text from documents),
w as (select rid, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') as words from d),
p as (select rid, pos, words[pos] || ' ' || words[pos + 1] as pair from w, unnest(range(1, len(words))) as u(pos)),
c as (select p.rid, template, count(distinct pair) as n from p join inverted using (pair) group by p.rid, template),
k as (select c.rid, s.* from c join sizes s using (template) where c.n >= s.needed),
q as (select distinct k.rid, k.template, p.pos from k join p using (rid) join inverted i on i.template = k.template and i.pair = p.pair),
x as (select q.rid, q.template, q.pos, count(distinct p.pair) as own, count(distinct p.pair) filter (where i.pair is not null) as both_
      from q join sizes s using (template) join p on p.rid = q.rid and p.pos between q.pos and q.pos + s.length - 2
      left join inverted i on i.template = q.template and i.pair = p.pair group by q.rid, q.template, q.pos),
z as (select x.rid, s.template, s.name, s.length, x.pos, round(2.0 * x.both_ / (x.own + s.pairs), 6)::double as dice from x join sizes s using (template)),
b as (select rid, template, any_value(name) as name, any_value(length) as length, max(dice) as dice, arg_max(pos, (dice, -pos)) as pos from z where dice >= {threshold} group by rid, template),
s as (select * from b where not exists (select 1 from b y where y.rid = b.rid and y.pos < b.pos + b.length and b.pos < y.pos + y.length
                                        and (y.dice > b.dice or (y.dice = b.dice and y.template < b.template)))),
f as (select rid, count(*) as n, string_agg(distinct name, ',' order by name) as licenses, max(dice) as dice from s group by rid),
i as (select rid, string_agg(distinct id, ',' order by id) as spdx from (select rid, unnest(regexp_extract_all(text, '{SPDX}', 1)) as id from d) group by rid)
select d.doc_id, coalesce(f.n, 0)::bigint as n_matches, coalesce(f.licenses, '') as licenses, coalesce(f.dice, 0.0)::double as best_dice, coalesce(i.spdx, '') as spdx
from d left join f using (rid) left join i using (rid)
"""


ORACLE = _oracle()
