"""Values at given ranks of a column, found by counting: nothing is sorted or written.

A first pass takes the range. Each further pass counts equal buckets of the ranges that
hold a wanted rank, with the least and greatest value in each; a bucket of one value or
of few rows ends the search. A range shrinks by ``BUCKETS`` in each pass at least, so a handful of passes
is enough for any column, and the driver sees at most ``BUCKETS`` rows for each wanted rank.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
FEW = 4096  # rows whose values are counted one by one


def _bucket(x: Column, low: float, high: float) -> Column:
    half = 0.5 if math.isinf(high - low) else 1.0  # of a range too wide for a number
    width = high * half - low * half
    return F.least(F.lit(BUCKETS - 1), F.floor((x * half - low * half) / width * BUCKETS)).cast("int")


def rank_values(df: DataFrame, value: str, wanted: Callable[[int], Sequence[int]]) -> tuple[int, dict[int, float]]:
    """(n, value at each rank): ranks count the n values that are not null from 0 upwards.

    ``wanted(n)`` gives the ranks to look for. Infinities come first and last, and NaN after them, as Spark orders them.
    ``df`` is read three times and more: give what is cheap to read again.
    """
    x = F.col(value).cast("double")
    plain = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    found = df.agg(
        F.count(x).alias("n"), F.count_if(x == -math.inf).alias("before"), F.count_if(plain).alias("plain"),
        F.count_if((x == math.inf)).alias("after"), F.min(F.when(plain, x)).alias("low"), F.max(F.when(plain, x)).alias("high"),
    ).first()
    n, values, open_ = found["n"], {}, {}
    for rank in sorted({r for r in wanted(n) if 0 <= r < n}):
        if rank < found["before"]:
            values[rank] = -math.inf
        elif rank >= found["before"] + found["plain"]:
            values[rank] = math.inf if rank < n and rank < found["before"] + found["plain"] + found["after"] else math.nan
        elif found["low"] == found["high"]:
            values[rank] = found["low"]
        else:
            open_[rank] = (found["low"], found["high"], found["before"], found["plain"])
    while open_:
        ranges = sorted({span for span in open_.values() if span[3] > FEW})
        few = sorted({span for span in open_.values() if span[3] <= FEW})
        tests = [F.when(plain & x.between(low, high), F.struct(F.lit(i).alias("range"), _bucket(x, low, high).alias("bucket"))) for i, (low, high, _, _) in enumerate(ranges)]
        counted: dict[int, list] = {i: [] for i in range(len(ranges))}
        if tests:
            place = df.select(x.alias("_x"), F.coalesce(*tests).alias("_at")).filter(F.col("_at").isNotNull())
            sums = place.groupBy("_at").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"))
            for r in sums.collect():
                counted[r["_at"]["range"]].append((r["low"], r["high"], r["n"]))
        single = []
        if few:
            inside = reduce(or_, [x.between(low, high) for low, high, _, _ in few])
            single = [(r["_x"], r["_x"], r["n"]) for r in df.filter(plain & inside).groupBy(x.alias("_x")).agg(F.count(F.lit(1)).alias("n")).collect()]
        for rank, (low, high, before, size) in list(open_.items()):
            span = (low, high, before, size)
            rows = counted[ranges.index(span)] if size > FEW else [s for s in single if low <= s[0] <= high]
            for least, most, count in sorted(rows):
                if rank < before + count:
                    if least == most:
                        values[rank] = least
                        del open_[rank]
                    else:
                        open_[rank] = (least, most, before, count)
                    break
                before += count
    return n, values


def quantiles_by_counting(df: DataFrame, value: str, probs: Sequence[float]) -> list[tuple[float, float]]:
    """Exact interpolated quantiles of a column as (prob, quantile); none without values."""
    spots = lambda n: {f((n - 1) * p) for p in probs for f in (math.floor, math.ceil)} if n else set()
    n, at = rank_values(df, value, spots)
    if not n:
        return []
    out = []
    for p in probs:
        place = (n - 1) * p
        low, high = at[math.floor(place)], at[math.ceil(place)]
        out.append((float(p), low if low == high else low + (high - low) * (place - math.floor(place))))
    return out
