"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length for each source. A source whose target is
beyond its size is taken whole as often as it fits; for what is left, a share of
every length is taken and a bounded-knapsack dynamic programme over the lengths
still there fills the rest. The plan only says how many documents of a length
to take; which ones is settled by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.registry import query, table
from larkspur.llm.words import words
from larkspur.operators.chunks import with_ordinal
from larkspur.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
RATIO = 1.5  # words of the mix for each word of input
CEILING = 2  # times a source, and a document, may be taken
BINS = 1024  # of the seeded hash; only the bin where a length's choice ends is ranked
SLACK = 8  # times the longest text: words of a budget that the dynamic programme fills
DP_WORDS = 1 << 20  # words the dynamic programme spans; a budget beyond takes long texts first


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many of each length to take, so that the sum comes as near to ``budget`` from below as found.

    ``lengths`` are distinct, positive and ascending. First an even share of each length, what
    does not go into whole texts carried to the next, but for the words of some long texts; these
    are left to the dynamic programme.
    """
    total = int((lengths * counts).sum())
    if not total or budget <= 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.astype(np.int64)
    taken = np.zeros(len(lengths), np.int64)
    even = budget - min(budget, SLACK * int(lengths[-1]), DP_WORDS)
    owed, used = 0, 0
    for i, (length, n) in enumerate(zip(lengths.tolist(), counts.tolist())):
        owed += length * n
        taken[i] = min(n, max(0, owed * even // total - used) // length)
        used += int(taken[i]) * length
    rest, left = budget - used, counts - taken
    for i in range(len(lengths) - 1, -1, -1):
        if rest <= DP_WORDS:
            break
        more = min(int(left[i]), rest // int(lengths[i]))
        taken[i], left[i], rest = taken[i] + more, left[i] - more, rest - more * int(lengths[i])
    return taken + subset_sum(lengths, left, min(rest, DP_WORDS), seed)


def subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """The counts, at most ``counts``, with the largest sum of lengths up to ``budget``."""
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int64)  # the bundle that first reached a sum
    bundles: list[tuple[int, int]] = []  # (place of the length, number of texts)
    for i in np.random.default_rng(seed).permutation(len(lengths)).tolist():
        length, n, size = int(lengths[i]), int(counts[i]), 1
        n = min(n, budget // length)
        while n > 0 and not reached[budget]:
            size = min(size, n)
            step = size * length
            fresh = reached[: budget + 1 - step] & ~reached[step:]
            by[step:][fresh] = len(bundles)
            reached[step:] |= fresh
            bundles.append((i, size))
            n, size = n - size, size * 2
        if reached[budget]:
            break
    taken, at = np.zeros(len(lengths), np.int64), int(np.flatnonzero(reached)[-1])
    while at:
        i, size = bundles[by[at]]
        taken[i] += size
        at -= size * int(lengths[i])
    return taken


def source_targets(sources: DataFrame, weights: Sequence[float], ratio: float, ceiling: float) -> DataFrame:
    """``sources`` (source, source_size) plus ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn. The words asked for,
    ``ratio`` times all, go out by weight; what is above ``ceiling`` times a source is
    shared anew among the others, until nothing is.
    """
    ordered = with_ordinal(sources.withColumn("_null", F.col("source").isNull()), [], ["_null", "source"], "_place")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ordered.select(
        "source",
        "source_size",
        turn[(F.pmod(F.col("_place") - 1, F.lit(len(weights)))).cast("int")].alias("_w"),
        (F.col("source_size") * F.lit(float(ceiling))).alias("_cap"),
    )
    weighed = materialize(weighed, "weighed")
    first = weighed.agg(F.sum("source_size").alias("all"), F.sum("_w").alias("w")).first()
    asked = ratio * (first["all"] or 0)
    level, found = 0.0, asked / first["w"] if first["w"] else 0.0
    while found != level:  # words for a weight of one; each pass closes at least one more source
        level = found
        over = F.col("_w") * level > F.col("_cap")
        seen = weighed.agg(F.sum(F.when(over, F.col("_cap"))).alias("closed"), F.sum(F.when(~over, F.col("_w"))).alias("w")).first()
        found = (asked - (seen["closed"] or 0.0)) / seen["w"] if seen["w"] else level
    return weighed.select("source", "source_size", F.least(F.col("_w") * level, F.col("_cap")).alias("target"))


_PLAN = "source string, size long, source_size long, target double, passes long, take long"


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    ratio: float = RATIO,
    ceiling: int = CEILING,
    seed: int = 17,
) -> DataFrame:
    """(key, size, source_size, target, copies, taken): how often the mix takes each row.

    ``size`` counts words, 0 for a null or empty text; ``taken`` is ``copies`` times
    ``size``. Texts without words are taken as often as their source is taken whole.
    A null source is a source, the last in order. Rows that repeat a key are texts
    of their own; equal hashes, as of such rows, are told apart by the order in which the rows were
    written down, which changes no count. An empty table gives no rows; other columns are not read.

    Sums of a source differ from its target by less than one word if some choice of
    its lengths does, and never by more than its shortest text left out.
    """
    sized = docs.select(
        F.col(key).alias("key"),
        F.col(source).cast("string").alias("source"),
        F.size(words(F.col(text))).cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key)).alias("_h"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # null sources join like any other
    sized = sized.withColumn("_s", F.coalesce("source", F.lit(""))).withColumn("_z", F.col("source").isNull())
    sized = materialize(sized.withColumn("_bin", F.pmod(F.shiftright("_h", 20), F.lit(BINS)).cast("int")), "sized")

    counted = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sources = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources, weights, ratio, ceiling)
    offered = counted.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
    offered = offered.select("c.source", "size", "n", "source_size", "target")

    def plan(lengths: pd.DataFrame) -> pd.DataFrame:
        """Of one source: as many rows as it has distinct lengths."""
        lengths = lengths.sort_values("size")
        whole, target = int(lengths["source_size"].iloc[0]), float(lengths["target"].iloc[0])
        passes = min(ceiling, int(target // whole)) if whole else 0
        worded = lengths["size"].to_numpy() > 0
        take = np.zeros(len(lengths), np.int64)
        budget = round(target - passes * whole) if passes < ceiling else 0
        take[worded] = fill_budget(lengths["size"].to_numpy()[worded], lengths["n"].to_numpy()[worded], budget, seed)
        return lengths[["source", "size", "source_size", "target"]].assign(passes=passes, take=take)

    planned = offered.groupBy("source").applyInPandas(plan, _PLAN)
    planned = materialize(
        planned.withColumn("_s", F.coalesce("source", F.lit(""))).withColumn("_z", F.col("source").isNull()).drop("source"),
        "plan",
    )

    on = ["_s", "_z", "size"]
    # a length's choice ends inside one bin of the hash: bins before it are taken whole
    some = planned.filter("take > 0").select(*on, "take")
    bins = sized.groupBy(*on, "_bin").agg(F.count(F.lit(1)).alias("n")).join(some, on)
    upto = Window.partitionBy(*on).orderBy("_bin")  # at most BINS rows for each length
    ends = bins.withColumn("_upto", F.sum("n").over(upto)).filter("_upto >= take AND _upto - n < take")
    ends = ends.select(*on, F.col("_bin").alias("_end"), (F.col("take") - F.col("_upto") + F.col("n")).alias("_need"))
    ends = planned.join(ends, on, "left")
    met = sized.join(ends, on)
    last = Window.partitionBy(*on).orderBy("_h", "_row")
    edge = met.filter("_bin = _end").withColumn("_in", F.row_number().over(last) <= F.col("_need"))
    rest = met.filter("_end IS NULL OR _bin <> _end").withColumn("_in", F.coalesce(F.col("_bin") < F.col("_end"), F.lit(False)))
    both = rest.unionByName(edge).withColumn("copies", F.col("passes") + F.col("_in").cast("bigint"))
    return both.select(
        F.col("key").alias(key), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


@query("op2_mix_sources")
def op2_mix_sources(spark, sf_dir):
    """The mix of all documents by source."""
    return mix_sources(table(spark, sf_dir, "documents")).drop("copies")
