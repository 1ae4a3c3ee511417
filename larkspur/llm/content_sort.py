"""Exact duplicates by sorting content.

Normalised texts are range-partitioned by splitters drawn from a sample, sorted in
their ranges (which spills as it must), and every text is compared in full with the one before it. The
order is that of the first bytes, then of a digest, then of the whole text, then of the key: so
a splitter is short however long the texts, texts that begin alike still part evenly, and a
group of equal texts of any size is dealt over ranges by its keys. Only a full comparison
makes two texts equal. Where a range ends within a group, its last text is compared with the first of the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.registry import query, table
from larkspur.llm.words import ascii_lower
from larkspur.operators.skew import skew_join
from larkspur.session import materialize

LEAD_BYTES = 32  # of a text that stand in a splitter before its digest


def sort_content(docs: DataFrame, key: str, normal: Column, carry: list[str]) -> DataFrame:
    """(_chunk, _at, _run, _key, text_sha256, _edge, carried columns) in content order, written down.

    ``_run`` numbers the groups of equal texts in a range. ``_edge`` has the text of a range's first and last row.
    """
    rows = docs.select(
        F.col(key).alias("_key"),
        *[F.col(c) for c in carry],
        normal.cast("binary").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = rows.select("*", F.sha2("_text", 256).alias("text_sha256"), F.substring("_text", 1, LEAD_BYTES).alias("_lead"))
    order = ["_lead", "text_sha256", "_text", "_key", "_row"]
    # whole texts are left to the sort: a splitter holds what is short
    ranged = rows.repartitionByRange("_lead", "text_sha256", "_key", "_row").sortWithinPartitions(*order)
    kept = ["_key", *carry, "text_sha256"]
    out = ranged.select(*kept, "_text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if f.name != "_text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, at, run = TaskContext.get().partitionId(), 0, -1
        before, waiting = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(batch.num_columns - 1)
            same = np.zeros(batch.num_rows, bool)
            same[0] = before is not None and before.equals(text[0])
            same[1:] = pc.equal(text.slice(1), text.slice(0, len(text) - 1)).to_numpy(zero_copy_only=False)
            runs = run + np.cumsum(~same)
            run, before = int(runs[-1]), text[len(text) - 1]
            if waiting is not None:
                yield labelled(*waiting, None)
            waiting = batch, chunk, at, runs
            at += batch.num_rows
        if waiting is not None:
            yield labelled(*waiting, before)

    def labelled(batch: pa.RecordBatch, chunk: int, at: int, runs: np.ndarray, last) -> pa.RecordBatch:
        n = batch.num_rows
        edge = [None] * n
        if at == 0:
            edge[0] = batch.column(batch.num_columns - 1)[0].as_py()
        if last is not None:
            edge[-1] = last.as_py()
        head = [pa.array(np.full(n, chunk, np.int64)), pa.array(np.arange(at, at + n)), pa.array(runs)]
        return pa.RecordBatch.from_arrays([*head, *batch.columns[:-1], pa.array(edge, pa.binary())], ["_chunk", "_at", "_run", *kept, "_edge"])

    return materialize(out.mapInArrow(compare, f"_chunk long, _at long, _run long, {fields}, _edge binary"), "sorted")


def _chunk_links(ranked: DataFrame) -> DataFrame:
    """(_chunk, _joins, _runs): does a range begin with the text that the range before it ends with? A row for each range."""
    edges = ranked.filter(F.col("_edge").isNotNull())
    per = edges.groupBy("_chunk").agg(
        F.min(F.struct("_at", "_edge"))["_edge"].alias("_first"), F.max(F.struct("_at", "_edge"))["_edge"].alias("_last"), F.max("_run").alias("_runs")
    )
    per = materialize(per, "edges")
    # numbers of ranges alone go through one task, never their texts
    earlier = per.select("_chunk").withColumn("_before", F.lag("_chunk").over(Window.orderBy("_chunk")))
    tails = per.select(F.col("_chunk").alias("_before"), F.col("_last").alias("_tail"))
    met = per.join(earlier, "_chunk").join(tails, "_before", "left")
    return met.select("_chunk", "_runs", F.coalesce(F.col("_first") == F.col("_tail"), F.lit(False)).alias("_joins"))


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: str = "smallest",
    normalise: bool = True,
    carry: list[str] | None = None,
) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256, carried columns): one row for each row of ``docs``.

    Texts are equal when they are the same bytes, with ``normalise`` after lower-casing A-Z. Of equal texts the row with the
    smallest key stays (``keep="largest"``: the largest). A null text is empty, so null and empty texts are one group. A null key is
    smaller than any other. Of rows that repeat a text and its key, one stays. A very long text is one row of the sort.
    An empty table gives no rows. Columns of ``docs`` that are not in ``carry`` are not read; a carried one may
    have any name that is not in the result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep the smallest or the largest, not {keep}")
    carry = list(carry or [])
    taken = {key, "keep_id", "group_size", "kept", "text_sha256"}.intersection(carry)
    if taken:
        raise ValueError(f"names of the result cannot be carried: {sorted(taken)}")
    inner = {c: f"_c{i}" for i, c in enumerate(carry)}  # so that no carried name meets one used here
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select("*", *[F.col(c).alias(n) for c, n in inner.items()]) if inner else docs
    ranked = sort_content(source, key, ascii_lower(plain) if normalise else plain, list(inner.values()))
    pick = F.min if keep == "smallest" else F.max
    per_run = ranked.groupBy("_chunk", "_run").agg(
        pick(F.struct("_chunk", "_at", "_key")).alias("_kept"), F.count(F.lit(1)).alias("_size")
    )
    links = _chunk_links(ranked)
    # a group's number counts the groups begun before it; a range's first run may belong to the one before
    upto = Window.orderBy("_chunk")
    begun = F.col("_runs") + F.when(F.col("_joins"), 0).otherwise(1)
    offsets = links.withColumn("_sum", F.sum(begun).over(upto)).select("_chunk", (F.col("_sum") - F.col("_runs") - 1).alias("_base"))
    numbered = per_run.join(F.broadcast(offsets), "_chunk").withColumn("_group", F.col("_base") + F.col("_run"))  # a row for each range
    numbered = materialize(numbered, "runs")
    groups = numbered.groupBy("_group").agg(pick("_kept").alias("_kept"), F.sum("_size").alias("group_size"))
    results = skew_join(numbered.select("_chunk", "_run", "_group"), groups, ["_group"]).drop("_group")
    joined = skew_join(ranked.drop("_edge"), results, ["_chunk", "_run"])
    kept = (F.col("_chunk") == F.col("_kept._chunk")) & (F.col("_at") == F.col("_kept._at"))
    return joined.select(
        F.col("_key").alias(key), F.col("_kept._key").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256",
        *[F.col(n).alias(c) for c, n in inner.items()],
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest", normalise: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    whole = docs.select(F.col(key).alias("_id"), F.col(text).alias("_t"), F.struct(*docs.columns).alias("own"))
    found = exact_duplicates(whole, "_id", "_t", keep, normalise, ["own"])
    return found.filter("kept").select("own.*")


OP13_SQL = """
    WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
    FROM n"""


@query("op13_exact_dedup", OP13_SQL)
def op13_exact_dedup(spark, sf_dir):
    """Every document with the one of its exact copies that stays, the largest doc_id."""
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")
