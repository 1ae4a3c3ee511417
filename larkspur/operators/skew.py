"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import materialize

HOT_ROWS = 2_000_000  # rows of one key that are too many for one task
SAMPLE = 0.05
SMALL_ROWS = 1_000_000  # a side within both limits is copied to all tasks
SMALL_BYTES = 32 * 1024 * 1024


def heavy_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS, sample: float = SAMPLE) -> DataFrame:
    """(on, _fanout): keys estimated to have more than ``hot_rows`` rows, and the tasks to deal each over.

    There is no limit on their number; as each has its share of the rows, they are few
    beside them. The fan-out is a power of two that brings each task to ``hot_rows`` rows.
    The sample only steers the plan. The join result does not depend on it.
    """
    keys = df.select(*on).na.drop()
    if sample < 1:
        keys = keys.sample(sample, seed=7)
    counted = keys.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows * sample)
    doublings = F.greatest(F.lit(1), F.ceil(F.log2(F.col("_n") / F.lit(hot_rows * sample))))
    fanout = F.pow(F.lit(2.0), doublings).cast("bigint")
    return materialize(counted.select(*on, fanout.alias("_fanout")), "hot")


def is_small(df: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> bool:
    """Measured: does ``df`` have few rows and few bytes? Stops counting past ``rows``."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return found["n"] <= rows and (found["bytes"] or 0) <= size


def skew_join(
    rows: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    sample: float = SAMPLE,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Equi join where ``rows`` may have hot keys and ``other`` has few rows per key.

    If ``other`` is measured to be small it is broadcast and ``rows`` are not
    shuffled at all; ``small_rows=0`` skips the measuring when it is known to
    be large. Otherwise rows of a hot key are dealt over as many
    tasks as its size asks for and the matching rows of ``other`` are copied to each; all other keys join as usual.
    Rows with a null in the key match nothing; where the join keeps them they are dealt
    over all tasks. ``how`` is inner, left, left_semi or left_anti, which never depend on ``rows`` missing
    from one of the salts.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot do a {how} join")
    on = list(on)
    if small_rows and is_small(other, small_rows):
        return rows.join(F.broadcast(other), on, how)
    hot = heavy_keys(rows, on, hot_rows, sample)
    found = not hot.isEmpty()
    if not found and how in ("inner", "left_semi"):
        return rows.join(other, on, how)
    if found:
        hot = F.broadcast(hot) if is_small(hot) else hot
        rows, other = rows.join(hot, on, "left"), other.join(hot, on, "left")
    else:
        rows, other = (side.withColumn("_fanout", F.lit(None).cast("bigint")) for side in (rows, other))
    null_key = reduce(or_, [F.col(c).isNull() for c in on])
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fanout = F.when(null_key, F.lit(tasks).cast("bigint")).otherwise(F.coalesce("_fanout", F.lit(1).cast("bigint")))
    spread = [c for c, kind in rows.dtypes if not kind.startswith(("map", "vector")) and c != "_fanout"]
    # the partition number parts even exact copies of a row, and is the same on a retry
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.spark_partition_id(), *spread), fanout))
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_fanout", F.lit(1).cast("bigint")) - 1)
    copied = other.withColumn("_salt", F.explode(copies)).drop("_fanout")
    return salted.drop("_fanout").join(copied, [*on, "_salt"], how).drop("_salt")
