"""Ranks found by counting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import ranks
from larkspur.operators.filters import near_median
from larkspur.operators.sampling import slice_rows

CASES = {
    "ties": [1.0] * 400 + [2.0] * 50 + [-3.5] * 7,
    "spread": [10.0**k * s for k in range(-300, 300, 3) for s in (1, -1)],
    "narrow": [1.0 + i * 2**-52 for i in range(300)] * 2,
    "extreme": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1.0] * 9,
    "one": [7.0],
    "infinite": [-math.inf, math.inf, math.inf, 0.0, 1.0, 2.0],
    "none": [],
}


@pytest.mark.parametrize("few", [1, 4096])
@pytest.mark.parametrize("name", sorted(CASES))
def test_every_rank_is_exact(spark, name, few, monkeypatch):
    monkeypatch.setattr(ranks, "FEW", few)
    monkeypatch.setattr(ranks, "BUCKETS", 16)
    values = CASES[name][:]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in [*values, None, None]], "v double").repartition(3)
    some = lambda n: range(0, n, max(1, n // 7))
    n, found = ranks.rank_values(df, "v", some)
    assert n == len(values) and found == {r: sorted(values)[r] for r in some(n)}


def test_nan_is_last(spark):
    df = spark.createDataFrame([(v,) for v in (math.nan, 1.0, math.inf, 2.0, None)], "v double")
    n, found = ranks.rank_values(df, "v", lambda n: range(n))
    assert n == 4 and [found[r] for r in range(3)] == [1.0, 2.0, math.inf] and math.isnan(found[3])


def test_quantiles_equal_numpy(spark):
    dice = random.Random(4)
    values = [round(dice.gauss(0, 3), 2) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0, 0.1, 0.25, 0.5, 0.99, 1]
    for p, q in ranks.quantiles_by_counting(df, "v", probs):
        assert q == pytest.approx(np.quantile(values, p), abs=1e-12)
    assert ranks.quantiles_by_counting(df.limit(0), "v", probs) == []
    assert near_median(df.limit(0), "v", 1.0).count() == 0


def test_no_sort_and_no_write(spark, monkeypatch):
    def forbidden(*_):
        raise AssertionError("nothing is to be written")

    monkeypatch.setattr("larkspur.session.scratch_path", forbidden)
    plan = near_median(spark.range(1000).withColumn("v", F.col("id").cast("double")), "v", 10.0)
    assert "Sort" not in plan._jdf.queryExecution().toString() and plan.count() == 20


@pytest.mark.parametrize("start, stop", [(None, 0), (None, 7), (-9, None), (0, 100), (None, 500), (-500, None), (3, 20), (-30, -4)])
def test_long_slices_are_cut_at_a_value(spark, start, stop):
    dice = random.Random(8)
    rows = [(dice.randint(0, 9), i, dice.choice("ab")) for i in range(120)]
    df = spark.createDataFrame(rows, "v int, i int, s string").repartition(4)
    want = sorted(rows)[start:stop]
    assert sorted(map(tuple, slice_rows(df, ["v", "i"], start, stop, head_rows=5).collect())) == want
    texts = sorted((r[2], r[1]) for r in rows)[start:stop]
    got = slice_rows(df.select("s", "i"), ["s", "i"], start, stop, head_rows=5)
    assert sorted(map(tuple, got.collect())) == texts
