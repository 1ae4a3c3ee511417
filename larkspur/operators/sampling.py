"""Splits, samples, slices, class balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, ShortType

from larkspur.operators.chunks import with_ordinal
from larkspur.operators.ranks import rank_values


def _digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), key.cast("string")))


def hash_bucket(key: Column, seed: int) -> Column:
    """A stable number 0..99 for a key; the same for every partition layout."""
    return F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("long") % 100


def split_by_hash(df: DataFrame, key: str, percents: Sequence[int], seed: int) -> list[DataFrame]:
    """Disjoint parts of about the given percentages; no shuffle, repeatable."""
    bucket, parts, start = hash_bucket(F.col(key), seed), [], 0
    for percent in percents:
        parts.append(df.filter((bucket >= start) & (bucket < start + percent)))
        start += percent
    return parts


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in pseudo-random but repeatable choice."""
    return df.orderBy(_digest(F.col(key), seed), key).limit(n)


HEAD_ROWS = 10_000  # of an ordered limit, which goes through one task


def _first_rows(df: DataFrame, order: Sequence[str], n: int, last: bool) -> DataFrame | None:
    """The first (or last) n rows without a sort of the others: cut at the value of the n-th rank, ties numbered.

    None where the first column of the order has nulls or is not a number that a double holds exactly.
    """
    first = F.col(order[0])
    if not isinstance(df.schema[order[0]].dataType, (ByteType, ShortType, IntegerType, FloatType, DoubleType)):
        return None
    total, nulls = df.agg(F.count(F.lit(1)), F.count_if(first.isNull() | F.isnan(first.cast("double")))).first()
    if nulls:
        return None
    if n >= total:
        return df
    _, found = rank_values(df, order[0], lambda rows: [rows - n if last else n - 1])
    ((_, cut),) = found.items()
    inside, tied = (first > cut if last else first < cut), df.filter(first == cut)
    whole = df.filter(inside)
    numbered = with_ordinal(tied, [], order, "_at")
    wanted = F.lit(n) - whole.agg(F.count(F.lit(1))).scalar()
    ties = tied.agg(F.count(F.lit(1))).scalar()
    kept = F.col("_at") > ties - wanted if last else F.col("_at") <= wanted
    return whole.unionByName(numbered.filter(kept).drop("_at"))


def slice_rows(df: DataFrame, order: Sequence[str], start: int | None, stop: int | None, head_rows: int = HEAD_ROWS) -> DataFrame:
    """Rows by position with the meaning of ``[start:stop]``; negatives count from the end.

    A slice of at most ``head_rows`` rows at the front or the back is an ordered limit. A longer one is cut at the value of its
    last rank, which is found by counting, if the order begins with a number; all others number the rows.
    """
    front = not start and stop is not None and stop >= 0
    back = start is not None and start < 0 and stop is None
    if front and stop <= head_rows:
        return df.orderBy(*order).limit(stop)
    if back and -start <= head_rows:
        return df.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(-start)
    if front or back:
        cut = _first_rows(df, order, stop if front else -start, back)
        if cut is not None:
            return cut
    numbered = with_ordinal(df, [], order, "_at")
    position = F.col("_at") - 1
    if (start or 0) < 0 or (stop or 0) < 0:
        total = numbered.agg(F.count(F.lit(1))).scalar()
    else:
        total = F.lit(0)

    def bound(value: int) -> Column:
        return F.lit(value) if value >= 0 else total + value

    if start is not None:
        numbered = numbered.filter(position >= bound(start))
    if stop is not None:
        numbered = numbered.filter(position < bound(stop))
    return numbered.drop("_at")


def oversample(df: DataFrame, minority: Column, copies: int) -> DataFrame:
    """Repeat minority rows, numbering the copies from 1."""
    numbers = F.when(minority, F.sequence(F.lit(1), F.lit(copies))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy_no", F.explode(numbers))
