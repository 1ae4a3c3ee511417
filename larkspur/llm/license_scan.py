"""Licence notices in texts, found by Dice's coefficient over word bigrams.

Passages of a text (its lines, and its paragraphs of several lines) are
normalised and compared with normalised templates. Two sets can only reach a
coefficient of t if neither is larger than (2 - t) / t times the other, so each
template is listed under the sizes it can match and passages meet templates by
an equi-join on their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.arrays import each, once
from larkspur.llm.registry import query, table
from larkspur.llm.words import ascii_lower
from larkspur.operators.skew import skew_join

LEAST = 0.8

# Common licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0 Universal."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def normal_words(text: Column) -> Column:
    """Words of a-z and 0-9 after lower-casing A-Z; ``licence`` is spelt ``license``."""
    plain = F.trim(F.regexp_replace(ascii_lower(text), "[^a-z0-9]+", " "))
    return F.split(F.replace(plain, F.lit("licence"), F.lit("license")), " ")


def word_bigrams(text: Column) -> Column:
    """The set of hashes of neighbouring words; a single word stands for itself."""

    def pairs(w: Column) -> Column:
        two = F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda b, i: F.xxhash64(F.get(w, i), b))
        return F.when(F.size(w) > 1, F.array_distinct(two)).otherwise(F.array(F.xxhash64(w[0])))

    return once(normal_words(text), pairs)


def passages(text: Column) -> Column:
    """Lines with a word, and paragraphs (between blank lines) of more than one line."""
    worded = lambda parts: F.filter(parts, lambda p: p.rlike("[A-Za-z0-9]"))
    blocks = F.filter(F.split(text, "\n[ \t\r]*\n"), lambda p: F.contains(F.trim(p, F.lit("\n")), F.lit("\n")))
    return F.concat(worded(F.split(text, "\n")), worded(blocks))


def scan_licenses(docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """(key, license, dice, fits): the licences of each text.

    ``templates`` has license and text; several texts may stand for a licence, and
    the best coefficient counts. ``fits`` counts the pairs of passage and template that reach
    ``least``. Texts without a licence, null and empty texts give no row; rows with
    the same key count as one text. Equal coefficients need no choice: every
    licence that reaches ``least`` is returned. A null key is a key of its own.
    """
    listed = templates.na.drop().select("license", word_bigrams(F.col("text")).alias("_t")).distinct()
    bound = (2 - least) / least
    low = F.ceil(F.size("_t") / F.lit(bound) - 1e-9).cast("int")
    high = F.floor(F.size("_t") * F.lit(bound) + 1e-9).cast("int")
    by_size = listed.select("license", "_t", F.explode(F.sequence(low, high)).alias("_n"))
    found = each(docs.select(F.col(key), F.col(text)), [key], passages(F.col(text)), "_p")
    sets = found.select(key, word_bigrams(F.col("_p")).alias("_s")).withColumn("_n", F.size("_s"))
    met = skew_join(sets, by_size, ["_n"])
    dice = 2 * F.size(F.array_intersect("_s", "_t")) / (F.size("_s") + F.size("_t"))
    near = met.select(key, "license", "_s", dice.alias("dice")).filter(F.col("dice") >= least)
    # a passage that two texts of one licence fit is one passage; the few that are left are grouped
    best = near.groupBy(key, "license").agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("fits"))
    return best


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in TEMPLATES)
    clean = (
        "replace(trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), "
        "'licence', 'license')"
    )
    pairs = (
        "CASE WHEN len({0}) > 1 THEN list_distinct([{0}[i] || ' ' || {0}[i + 1] FOR i IN range(1, len({0}))]) "
        "ELSE [{0}[1]] END"
    )
    return f"""
WITH t(license, text) AS (VALUES {rows}),
tw AS (SELECT license, string_split({clean.format('text')}, ' ') AS w FROM t),
ts AS (SELECT DISTINCT license, list_sort({pairs.format('w')}) AS b FROM tw),
p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS p FROM documents
      UNION ALL
      SELECT doc_id, p FROM (SELECT doc_id, unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) AS p FROM documents)
      WHERE contains(trim(p, chr(10)), chr(10))),
pw AS (SELECT doc_id, string_split({clean.format('p')}, ' ') AS w FROM p WHERE regexp_matches(p, '[A-Za-z0-9]')),
ps AS (SELECT doc_id, {pairs.format('w')} AS s FROM pw),
m AS (SELECT doc_id, license, 2 * len(list_intersect(s, b)) / (len(s) + len(b)) AS dice FROM ps JOIN ts
      ON 2 * least(len(s), len(b)) >= {LEAST} * (len(s) + len(b)) - 1e-9)
SELECT doc_id, license, max(dice) AS dice, count(*) AS fits FROM m WHERE dice >= {LEAST} GROUP BY doc_id, license
"""


@query("op4_license_scan", _oracle())
def op4_license_scan(spark, sf_dir):
    """The licence notices of every document."""
    templates = spark.createDataFrame(TEMPLATES, "license string, text string")
    return scan_licenses(table(spark, sf_dir, "documents"), templates)
