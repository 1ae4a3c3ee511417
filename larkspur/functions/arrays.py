"""Array and vector expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out a single time, however often ``use`` names it."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def each(df: DataFrame, keep: Sequence[str], array: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per element of a computed array, with its position if named.

    Like explode, null elements aside. Explode itself makes the optimizer add a
    filter on the array's size, which works out the array a second time and
    below any shuffle; the outer form does not.
    """
    if position is None:
        return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, name))
    return rows.filter(F.col(position).isNotNull())


def negatives_to_zero(values: Column) -> Column:
    """Replace the value -1 by 0 in an array."""
    return F.transform(values, lambda v: F.when(v == -1, 0).otherwise(v))


def one_hot(class_id: Column, classes: int) -> Column:
    """Indicator array of a class numbered from 1."""
    return F.transform(F.sequence(F.lit(1), F.lit(classes)), lambda i: (i == class_id).cast("int"))


def label_vocabulary(df: DataFrame, labels: str, limit: int = 10_000) -> DataFrame:
    """One row with the sorted distinct labels of an array column.

    The vocabulary is the width of every indicator row made from it, so more
    than ``limit`` labels is an error and not something to fit in.
    """
    distinct = df.select(F.explode(labels).alias("label")).distinct()
    listed = F.sort_array(F.collect_list("label"))
    return distinct.limit(limit + 1).agg(
        F.when(F.count("label") > limit, F.raise_error(F.lit(f"more than {limit} labels")))
        .otherwise(listed)
        .alias("vocabulary")
    )


def indicators(labels: Column, vocabulary: Column) -> Column:
    return F.transform(vocabulary, lambda v: F.array_contains(labels, v).cast("int"))


def at_least(scores: Column, threshold: float = 0.5) -> Column:
    return F.transform(scores, lambda s: (s >= threshold).cast("int"))


def top_scores(scores: Column, k: int) -> Column:
    """The k best (score, position) pairs, best first; equal scores by position."""
    pairs = F.transform(scores, lambda s, i: F.struct(s.alias("score"), (-i).alias("minus")))
    best = F.slice(F.sort_array(pairs, asc=False), 1, k)
    return F.transform(best, lambda p: F.struct(p["score"].alias("score"), (-p["minus"]).alias("idx")))


def joined(values: Column, sep: str = ",") -> Column:
    return F.array_join(values.cast("array<string>"), sep)


def positional_array(reference: DataFrame, idx: str, value: str, width: int) -> DataFrame:
    """A reference table keyed 0..width-1 as one row holding one array.

    Fails unless there is one value for each position, so what is later
    copied to all tasks has exactly ``width`` elements.
    """
    pairs = F.sort_array(F.collect_list(F.struct(idx, value)))
    return (
        reference.limit(width + 1)
        .agg(pairs.alias("pairs"))
        .select(
            F.when(F.size("pairs") != width, F.raise_error(F.lit(f"expected {width} reference values")))
            .otherwise(F.transform("pairs", lambda p: p[value]))
            .alias("reference")
        )
    )


def picked(flags: Column, reference: Column) -> Column:
    """(idx, value) of the reference values whose flag is 1."""
    zipped = F.zip_with(flags, reference, lambda flag, value: F.struct(flag.alias("flag"), value.alias("value")))
    placed = F.transform(
        zipped, lambda z, i: F.struct(z["flag"].alias("flag"), i.alias("idx"), z["value"].alias("value"))
    )
    return F.filter(placed, lambda p: p["flag"] == 1)


def concat_vectors(parts: Sequence[Column]) -> Column:
    return F.concat(*[p.cast("array<double>") for p in parts])
