"""Ordered work over groups of any size.

A window over one large group runs in one task. Here rows are range-partitioned
by (keys, order) instead, so a hot key spreads over many partitions, and the
partition number is written down as ``_chunk``. Work then runs per (keys, chunk),
which is as small as a partition, and only one summary row per (keys, chunk)
has to be put in order per key.

``order`` must be a total order within each key. Rows with a null key are in no
group and are left out, as in the data frames this engine takes over from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larkspur.operators.ranks import quantiles_by_counting
from larkspur.session import materialize

POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low bits


def _not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys)) if keys else df


def order_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` plus ``_chunk`` (partition number) and ``_pos`` (row position in it)."""
    return materialize(_ranged(df, keys, order), "chunks")


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    columns = [*keys, *order]
    row_id = F.monotonically_increasing_id()
    return (
        _not_null(df, keys)
        .repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_rid", row_id)
        .withColumn("_chunk", F.shiftright("_rid", POSITION_BITS))
        .withColumn("_pos", F.col("_rid").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))
        .drop("_rid")
    )


def chunk_offsets(chunked: DataFrame, keys: Sequence[str], weight: Column) -> DataFrame:
    """Per (keys, _chunk): first position, weight inside, weight before, weight of the key.

    The windows run over one row for each chunk of a key, at most as many as
    there are partitions.
    """
    per_chunk = chunked.groupBy(*keys, "_chunk").agg(
        F.min("_pos").alias("_first"), F.sum(weight).alias("_inside")
    )
    per_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = per_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.withColumn(
        "_before", F.coalesce(F.sum("_inside").over(earlier), F.lit(0))
    ).withColumn("_total", F.sum("_inside").over(per_key))


def with_ordinal(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ordinal"
) -> DataFrame:
    """Number the rows of each key from 1 in the given order."""
    chunked = order_chunks(df, keys, order)
    offsets = chunk_offsets(chunked, keys, F.lit(1)).drop("_inside", "_total")
    if not keys:
        offsets = F.broadcast(offsets)  # one row per partition
    return (
        chunked.join(offsets, [*keys, "_chunk"])
        .withColumn(name, F.col("_pos") - F.col("_first") + F.col("_before") + 1)
        .drop("_chunk", "_pos", "_first", "_before")
    )


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column, name: str
) -> DataFrame:
    """Sum of ``weight`` over the earlier rows of the key and this one."""
    chunked = order_chunks(df.withColumn("_weight", weight), keys, order)
    offsets = chunk_offsets(chunked, keys, F.col("_weight")).select(*keys, "_chunk", "_before")
    if not keys:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    return (
        chunked.withColumn("_running", F.sum("_weight").over(inside))
        .join(offsets, [*keys, "_chunk"])
        .withColumn(name, F.col("_running") + F.col("_before"))
        .drop("_chunk", "_pos", "_weight", "_running", "_before")
    )


def with_running_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column, name: str
) -> DataFrame:
    """:func:`with_running_sum` of whole numbers that are never null, summed as the sorted rows of a range pass: rows are shuffled once."""
    ranged = _ranged(df.withColumn("_weight", weight.cast("bigint")), keys, order)
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [batch.column(batch.schema.get_field_index(k)) for k in names]
            new = np.zeros(batch.num_rows, bool)
            for k in held:
                new[1:] |= pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)).to_numpy(zero_copy_only=False)
            new[0] = last is None or last != [k[0].as_py() for k in held]
            weights = batch.column(batch.schema.get_field_index("_weight")).to_numpy()
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))  # of the row's key in the batch
            sums = weights.cumsum()
            sums -= np.where(first >= 0, (sums - weights)[first], -total)
            last, total = [k[len(k) - 1].as_py() for k in held], int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], [*batch.schema.names, "_running"])

    schema = StructType([*ranged.schema.fields, StructField("_running", LongType())])
    chunked = materialize(ranged.mapInArrow(run, schema), "chunks")
    offsets = chunk_offsets(chunked, keys, F.col("_weight")).select(*keys, "_chunk", "_before")
    if not keys:
        offsets = F.broadcast(offsets)
    found = chunked.join(offsets, [*keys, "_chunk"]).withColumn(name, F.col("_running") + F.col("_before"))
    return found.drop("_chunk", "_pos", "_weight", "_running", "_before")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per key with their counts, chunked in value order.

    Counting comes before the range shuffle, so repeated values travel once.
    """
    counts = (
        df.select(*keys, F.col(value).cast("double").alias("_value"))
        .na.drop(subset=["_value"])
        .groupBy(*keys, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return order_chunks(counts, keys, ["_value"])


def quantiles_of_counts(
    chunked: DataFrame, keys: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """Exact interpolated quantiles from :func:`value_counts`: (keys, prob, quantile).

    The ranks asked for pick out single chunks; only those are looked into.
    """
    offsets = chunk_offsets(chunked, keys, F.col("_n"))
    wanted = (
        offsets.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_rank", (F.col("_total") - 1) * F.col("prob"))
        .withColumn("_at", F.explode(F.array_distinct(F.array(F.floor("_rank"), F.ceil("_rank")))))
        .filter((F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_inside")))
        .select(*keys, "_chunk", "prob", "_rank", "_at", "_before")
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_value")
    spots = wanted.select(*keys, "_chunk").distinct()
    upto = chunked.join(spots, [*keys, "_chunk"], "left_semi").withColumn(
        "_upto", F.sum("_n").over(inside)
    )
    at = F.col("_at") - F.col("_before")
    found = upto.join(wanted, [*keys, "_chunk"]).filter(
        (at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_n"))
    )
    low, high = F.min("_value"), F.max("_value")
    share = F.max(F.col("_rank") - F.floor("_rank"))
    return found.groupBy(*keys, "prob").agg((low + (high - low) * share).alias("quantile"))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]
) -> DataFrame:
    """Exact interpolated quantiles per key as (keys, prob, quantile) rows; without keys by counting, now."""
    if not keys:
        found = quantiles_by_counting(df, value, probs)
        return df.sparkSession.createDataFrame(found, "prob double, quantile double")
    return quantiles_of_counts(value_counts(df, keys, value), keys, probs)
