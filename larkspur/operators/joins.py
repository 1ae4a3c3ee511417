"""Joins beyond the plain equi join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.arrays import each
from larkspur.operators.skew import skew_join
from larkspur.session import materialize


def lookup_or_fail(rows: DataFrame, table: DataFrame, on: str, value: str) -> DataFrame:
    """Add ``value`` from ``table``; a key that is not in it fails the job."""
    found = table.select(on, F.col(value).alias("_found"), F.lit(True).alias("_hit"))
    miss = F.raise_error(F.concat(F.lit(f"no {value} for {on} "), F.col(on).cast("string")))
    return (
        skew_join(rows, found, [on], "left", small_rows=0)
        .withColumn(value, F.when(F.col("_hit"), F.col("_found")).otherwise(miss))
        .drop("_found", "_hit")
    )


BLOCK_LETTERS = 256  # of a word that is taken apart at once


def containing_words(words: DataFrame, word: str, lexicon: DataFrame, entry: str) -> DataFrame:
    """Distinct words that hold some lexicon entry as a substring.

    For a lexicon of any size and without comparing every pair: each word is
    taken apart into its pieces of the lengths that entries have, and the
    pieces meet the entries in an equi join. A long word is first cut into blocks that
    overlap by the longest entry, so that its pieces are found near their block's
    beginning and never stand in one row; blocks know their word by a digest.
    """
    entries = lexicon.select(F.col(entry).alias("_piece")).filter(F.trim("_piece") != "").distinct()
    # one row: the distinct lengths of entries, bounded by the longest
    lengths = entries.agg(F.coalesce(F.collect_set(F.length("_piece")), F.array().cast("array<int>")).alias("lengths"))
    distinct = words.select(word).na.drop().distinct()
    measured = distinct.withColumn("_lengths", lengths.scalar()).withColumn("_word", F.sha2(F.col(word), 256))
    longest = F.coalesce(F.array_max("_lengths"), F.lit(0))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.length(word), F.lit(1)) - 1) / BLOCK_LETTERS)),
        lambda b: F.substring(word, (b * BLOCK_LETTERS + 1).cast("int"), longest + BLOCK_LETTERS - 1),
    )
    cut = each(measured, ["_word", "_lengths"], blocks, "_block")
    starts = lambda size: F.when(
        F.length("_block") >= size, F.sequence(F.lit(1), F.least(F.length("_block") - size + 1, F.lit(BLOCK_LETTERS)))
    ).otherwise(F.array().cast("array<int>"))
    pieces = F.flatten(
        F.transform("_lengths", lambda n: F.transform(starts(n), lambda at: F.substring("_block", at, n)))
    )
    hits = each(cut, ["_word"], F.array_distinct(pieces), "_piece").join(entries, "_piece", "left_semi")
    return measured.join(hits.select("_word").distinct(), "_word", "left_semi").select(word)


def with_group_values(df: DataFrame, keys: list[str], **aggregates) -> DataFrame:
    """Give each row the aggregates of its group.

    Aggregating first leaves one row per key to join back, where a window
    would bring a whole group into one task.
    """
    per_key = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggregates.items()])
    return skew_join(df, materialize(per_key, "groups"), keys, "left")
