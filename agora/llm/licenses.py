"""License scans: an exact set-similarity join of license notices with blocks of text. DataFrame functions only.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A
block is ``WIDTH`` words, one every ``STEP`` words, so a text of any length is
blocks of bounded size and every passage of ``STEP`` words stands in one whole.
A template stands in a block if the block holds ``PERCENT`` of its distinct
words or more, ``need`` of them. All such pairs are found:

- the templates' words are ordered by how often the whole table has them,
  rarest first, and sets keep that order. Words of no template are left out;
- length: a block with fewer than ``need`` words cannot hold the template;
- prefix: a block that holds ``need`` of size words has one of the template's
  first size - need + 1, among all but its own last need - 1 words;
- position: at the first common word, what is left of either set must do;
- what is left is verified on the whole sets.

The order is counted over all texts; it decides how much is verified, never
what is found. It has one row per word of the templates, a few hundred, and
their prefixes are sent to the blocks. A block's words come in order from one
intersection, so no text is shuffled: only ids of texts with notices are.

Base labels are phrases that stand word by word. A null text is empty, has no
words and no labels; each of repeated rows has its own; other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.shared import LOWER, UPPER, few, stored

WIDTH, STEP = 256, 128
PERCENT = 80
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices as license holders ask to place them, each of at most ``STEP`` words.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", 'you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("apache", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
               '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
               'language governing permissions and limitations under the License.'),
    ("mit", "Released under the MIT License"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            'modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the '
            'Software is furnished to do so, subject to the following conditions'),
    ("mit", 'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the '
            'warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or '
            'copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, '
            'arising from, out of or in connection with the software or the use or other dealings in the software.'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
            "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY ND 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
]


def template_words(templates: list[tuple[str, str]] = TEMPLATES) -> list[tuple[str, list[str]]]:
    """Label and distinct words of each template."""
    import re

    return [(label, sorted({w for w in re.split(SEPARATORS, text.lower()) if w})) for label, text in templates]


def need(size: int, percent: int = PERCENT) -> int:
    """Words a block must hold of a template of ``size`` words."""
    return max(1, -(-percent * size // 100))


def words(text: Column) -> Column:
    """All words of a text. Only words of ASCII bytes are compared, so Spark's ``lower`` serves, but for the two signs it turns into ASCII letters."""
    odd = F.contains(text, F.lit("İ")) | F.contains(text, F.lit("K"))
    lowered = F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def order_of(docs: DataFrame, text: str, templates: list[tuple[str, list[str]]]) -> list[str]:
    """The templates' words, rarest in the whole table first, ties in the order of their letters."""
    known = sorted({w for _, ws in templates for w in ws})
    every = docs.select(F.explode(words(F.coalesce(F.col(text), F.lit("")))).alias("w")).where(F.col("w").isin(known))
    # One row per word of the templates at most.
    times = {r["w"]: r["n"] for r in every.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(known, key=lambda w: (times.get(w, 0), w))


def _phrase_at(found: Column, i: Column) -> Column:
    """Start and label of the phrase whose first word is number i, or null."""
    out = F.lit(None).cast("struct<start:int,label:string>")
    for phrase, label in PHRASES.items():
        here = None
        for k, w in enumerate(phrase.split()):
            same = F.get(found, i + k) == w
            here = same if here is None else here & same
        out = F.when(here, F.struct(i.alias("start"), F.lit(label).alias("label"))).otherwise(out)
    return out


def base(found: Column) -> Column:
    """Array of (start, label): every place where a phrase stands. Texts without any first word of one are not searched."""
    some = F.arrays_overlap(found, _literal(sorted({p.split()[0] for p in PHRASES})))
    places = F.filter(F.transform(found, lambda w, i: _phrase_at(found, i)), lambda p: p.isNotNull())
    return F.when(some, places).otherwise(F.array().cast("array<struct<start:int,label:string>>"))


def blocks(found: Column) -> Column:
    last = F.greatest(F.ceil((F.size(found) - WIDTH) / STEP), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(found, b * STEP + 1, F.lit(WIDTH)))


def matches(scanned: DataFrame, order: list[str], templates: list[tuple[str, list[str]]], percent: int = PERCENT) -> DataFrame:
    """_row, label, containment of every block and template that meet the threshold; ``scanned``: _row, _words."""
    spark = scanned.sparkSession
    place = {w: k for k, w in enumerate(order)}
    sets = [(t, label, sorted(ws, key=place.get), need(len(ws), percent)) for t, (label, ws) in enumerate(templates) if ws]
    prefixes = [(w, i, t, label, ws, n) for t, label, ws, n in sets for i, w in enumerate(ws[: len(ws) - n + 1])]
    # As many rows as the templates' prefixes have words.
    index = F.broadcast(spark.createDataFrame(prefixes, "token string, i int, template int, label string, tokens array<string>, need int"))
    least = min(n for *_, n in sets)
    rare = _literal(sorted({w for w, *_ in prefixes}, key=place.get))

    cut = scanned.where(F.arrays_overlap("_words", rare)).select("_row", F.explode(blocks(F.col("_words"))).alias("_block"))
    ordered = cut.where(F.arrays_overlap("_block", rare)).select("_row", F.array_intersect(_literal(order), "_block").alias("_set"))
    ordered = ordered.withColumn("_size", F.size("_set")).where(F.col("_size") >= least)
    prefix = F.slice("_set", F.lit(1), F.col("_size") - least + 1)
    met = ordered.select("_row", "_set", "_size", F.posexplode(prefix).alias("j", "token")).join(index, "token")
    size = F.size("tokens")
    met = met.where((F.col("_size") >= F.col("need")) & (F.col("j") <= F.col("_size") - F.col("need")))  # length, prefix
    left = F.least(size - F.col("i"), F.col("_size") - F.col("j"))
    met = met.where(left >= F.col("need"))  # position
    met = met.where(~F.arrays_overlap(F.slice("_set", F.lit(1), F.col("j")), F.col("tokens")))  # at the first common word only
    both = F.size(F.array_intersect("_set", "tokens"))
    return met.withColumn("_both", both).where(F.col("_both") >= F.col("need")).select("_row", "label", (F.col("_both") / size).alias("containment"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
         percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``labels`` holds the base labels and those of the templates found. ``score`` is 1 where a phrase stands, else the
    largest share of a template's words found in a block, of those that meet the threshold, else 0.
    """
    known = template_words(templates)
    order = order_of(docs, text, known)
    place = {w: k for k, w in enumerate(order)}
    firsts = {w for _, ws in known if ws for w in sorted(ws, key=place.get)[: len(ws) - need(len(ws), percent) + 1]}
    rows = docs.select(F.col(key).alias("doc_id"), words(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    rows = rows.withColumn("_base", base(F.col("_words")))
    starts = F.transform("_base", lambda p: p["start"].cast("long"))
    scanned = stored(rows.select(
        F.monotonically_increasing_id().alias("_row"),
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_distinct(F.transform("_base", lambda p: p["label"])).alias("_base_labels"),
        F.when(F.arrays_overlap("_words", _literal(sorted(firsts))), F.col("_words")).alias("_words"),
    ), "scanned")
    found = matches(scanned.select("_row", "_words"), order, known, percent)
    found = found.groupBy("_row").agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"))
    out = scanned.drop("_words").join(few(found, "notices").withColumnRenamed("_row", "_of"), F.col("_row") == F.col("_of"), "left")
    listed = lambda labels: F.array_join(F.sort_array(labels), ",")
    no_labels = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        listed(F.col("_base_labels")).alias("base_labels"),
        listed(F.array_union("_base_labels", F.coalesce("_labels", no_labels))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
