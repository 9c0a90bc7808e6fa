"""Licence scans: lines compared to licence templates by the Dice coefficient of their word bigrams. Native Spark only.

Every line is a passage, and so is the whole text if it is longer than a line. A passage and a template are lower-cased
words of letters, digits and dots within; their distinct bigrams give 2 * common / (passage + template). Dice reaches a
threshold t only if the smaller of two sets has at least t / (2 - t) times the size of the larger, so each passage is
only compared to templates of a fitting size; texts and passages without any word that a match must hold are not cut at all.

One row per document: its matched licences and the best similarity. NULL and empty texts match nothing. Repeated rows
are scanned each; ties of similarity go to the first licence by name; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

THRESHOLD = 0.8

# Licence names and the notices that documents carry.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
)

BREAK = "[^a-z0-9]+"
SCANNED = ("doc_id", "licenses", "best_dice", "n_passages")


@dataclass(frozen=True)
class Template:
    name: str
    bigrams: tuple[str, ...]
    least: int
    most: int
    signs: tuple[str, ...]


def template(name: str, text: str, threshold: float) -> Template | None:
    """Size bounds, and signs: words of which every matching passage holds at least one.

    A match shares more than n * t / (2 - t) of the n bigrams, so it cannot miss all of any n - ceil(n * t / (2 - t)) + 1
    of them; the ones with the longest words are taken, and of each its longest word.
    """
    words = [w for w in re.split(BREAK, text.lower()) if w]
    bigrams = sorted(set(zip(words, words[1:])))
    if not bigrams:
        return None
    n, bound = len(bigrams), threshold / (2 - threshold)
    needed = math.ceil(n * bound - 1e-9)
    rare = sorted(bigrams, key=lambda b: (-max(map(len, b)), b))[: n - needed + 1]
    signs = tuple(sorted({max(b, key=len) for b in rare}))
    return Template(name, tuple(" ".join(b) for b in bigrams), needed, math.floor(n / bound + 1e-9), signs)


def bigrams(passage: Column) -> Column:
    words = F.filter(F.split(F.lower(passage), BREAK), lambda w: w != "")
    behind = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    before = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.array_distinct(F.zip_with(before, behind, lambda a, b: F.concat_ws(" ", a, b)))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, licenses (distinct names, sorted, comma-joined), best_dice and n_passages that matched."""
    known = sorted({t for name, text in templates if (t := template(name, text, threshold))}, key=lambda t: (t.name, t.bigrams))
    signs = sorted({sign for t in known for sign in t.signs})

    def signed(text: Column) -> Column:
        low, out = F.lower(text), F.lit(False)
        for sign in signs:
            out = out | F.contains(low, F.lit(sign))
        return out

    def similarity(pairs: Column, t: Template) -> Column:
        size = F.size(pairs)
        common = F.size(F.array_intersect(pairs, F.array(*map(F.lit, t.bigrams))))
        return F.when(size.between(t.least, t.most), 2 * common / (size + len(t.bigrams))).otherwise(0.0)

    def best(pairs: Column) -> Column:
        """The most similar template; ties go to the first by name."""
        each = F.array(*[F.struct(similarity(pairs, t).alias("dice"), F.lit(-k).alias("place")) for k, t in enumerate(known)])
        return F.array_max(each)

    passages = F.split(F.col("text"), "\n")
    passages = F.when(F.size(passages) > 1, F.concat(passages, F.array("text"))).otherwise(passages)
    names = F.array(*[F.lit(t.name) for t in known])
    none = F.array().cast("array<struct<dice:double,place:int>>")
    rows = texts(docs)
    if not known:
        matched = none
    else:
        matched = F.filter(F.transform(F.transform(F.filter(passages, signed), bigrams), best), lambda m: m["dice"] >= threshold)
        # Most texts hold no sign at all and are not cut.
        matched = F.when(signed(F.col("text")), matched).otherwise(none)
    found = rows.select("doc_id", F.coalesce(matched, none).alias("matched"))
    return found.select(
        "doc_id",
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("matched", lambda m: F.get(names, -m["place"]))))).alias("licenses"),
        F.coalesce(F.array_max(F.transform("matched", lambda m: m["dice"])), F.lit(0.0)).alias("best_dice"),
        F.size("matched").cast("long").alias("n_passages"),
    )


def oracle(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same over `documents` in SQL: every passage against every template, without pruning."""
    values = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(templates))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
t AS (SELECT * FROM (VALUES {values}) v(k, name, body)),
passages AS (
  SELECT r, unnest(CASE WHEN len(string_split(text, chr(10))) > 1 THEN list_append(string_split(text, chr(10)), text)
                        ELSE string_split(text, chr(10)) END) AS body FROM docs),
numbered AS (SELECT row_number() OVER () AS p, r, body FROM passages),
words AS (
  SELECT p, r, list_filter(string_split_regex(lower(body), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM numbered),
pairs AS (
  SELECT p, r, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS b FROM words),
t_words AS (SELECT k, name, list_filter(string_split_regex(lower(body), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM t),
t_pairs AS (SELECT k, name, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS b FROM t_words),
scored AS (
  SELECT p, r, name, CAST(2 * len(list_intersect(x.b, y.b)) AS DOUBLE) / (len(x.b) + len(y.b)) AS dice
  FROM pairs x, t_pairs y WHERE len(x.b) > 0),
best AS (
  SELECT p, r, name, dice FROM scored WHERE dice >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY dice DESC, name) = 1),
grouped AS (
  SELECT r, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(dice) AS best_dice, count(*) AS n_passages FROM best GROUP BY r)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(best_dice, 0.0) AS best_dice, coalesce(n_passages, 0) AS n_passages
FROM docs LEFT JOIN grouped USING (r)"""
