"""Ordered and skew-safe work against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import chunks, grouping, skew
from larkspur.operators.filters import in_period, near_median, not_in
from larkspur.operators.joins import containing_words, lookup_or_fail, with_group_values
from larkspur.operators.sampling import oversample, sample_rows, slice_rows, split_by_hash


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows of which key 'hot' has a third or more, with repeated and null values."""
    dice = random.Random(5)
    rows = []
    for i in range(300):
        key = "hot" if dice.random() < 0.4 else dice.choice("abcdefg")
        value = None if dice.random() < 0.05 else float(dice.randint(0, 20))
        rows.append((i, key, value, "x" * dice.randint(0, 9)))
    return rows, spark.createDataFrame(rows, "id long, key string, value double, text string").repartition(5)


def test_ordinals_number_each_key(skewed):
    rows, df = skewed
    got = {(r["key"], r["id"]): r["ordinal"] for r in chunks.with_ordinal(df, ["key"], ["id"]).collect()}
    seen = Counter()
    for i, key, _, _ in rows:
        seen[key] += 1
        assert got[(key, i)] == seen[key]
    assert len(got) == len(rows)


def test_ordinals_without_key_and_order_of_several_columns(skewed):
    rows, df = skewed
    got = chunks.with_ordinal(df, [], ["text", "id"]).collect()
    want = sorted(rows, key=lambda r: (r[3], r[0]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["ordinal"])] == [r[0] for r in want]
    assert sorted(r["ordinal"] for r in got) == list(range(1, len(rows) + 1))


def test_running_sum(skewed):
    rows, df = skewed
    got = chunks.with_running_sum(df, ["key"], ["id"], F.length("text"), "upto")
    sums, want = Counter(), {}
    for i, key, _, text in rows:
        sums[key] += len(text)
        want[i] = sums[key]
    assert {r["id"]: r["upto"] for r in got.collect()} == want


def test_rows_with_a_null_key_are_in_no_group(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id long, key string")
    assert [r["id"] for r in chunks.with_ordinal(df, ["key"], ["id"]).collect()] == [2]


def test_quantiles_equal_numpy(skewed):
    rows, df = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    groups = defaultdict(list)
    for _, key, value, _ in rows:
        if value is not None:
            groups[key].append(value)
    got = {(r["key"], r["prob"]): r["quantile"] for r in chunks.exact_quantiles(df, ["key"], "value", probs).collect()}
    assert set(got) == {(k, p) for k in groups for p in probs}
    for (key, prob), value in got.items():
        assert value == pytest.approx(np.quantile(groups[key], prob))


def test_quantile_of_all_rows_and_of_none(spark, skewed):
    rows, df = skewed
    values = [v for _, _, v, _ in rows if v is not None]
    assert chunks.exact_quantiles(df, [], "value", [0.5]).first()["quantile"] == np.median(values)
    assert chunks.exact_quantiles(df.filter("id < 0"), [], "value", [0.5]).collect() == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    _, df = skewed
    other = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("z", 4)], "key string, n int")
    got = skew.skew_join(df, other, ["key"], how, hot_rows=20, sample=1.0, small_rows=0)
    assert "_salt" in got._jdf.queryExecution().toString()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got.collect(), key=key) == sorted(df.join(other, ["key"], how).collect(), key=key)


def test_heavy_keys_and_composite_keys(skewed):
    _, df = skewed
    two = df.withColumn("k2", F.lit(1))
    hot = skew.heavy_keys(two, ["key", "k2"], hot_rows=60, sample=1.0).collect()
    assert [(r["key"], r["k2"]) for r in hot] == [("hot", 1)] and hot[0]["_fanout"] in (2, 4, 8)
    near = skew.heavy_keys(two, ["key"], hot_rows=60, sample=0.5).collect()
    assert {r["key"] for r in near} <= {"hot"}
    joined = skew.skew_join(two, two.groupBy("key", "k2").count(), ["key", "k2"], hot_rows=60, sample=1.0, small_rows=0)
    assert joined.count() == 300


def test_every_hot_key_is_split(spark):
    """Six hundred keys that are each too large, and a null key."""
    df = spark.range(6000).select(F.when(F.col("id") >= 600, F.col("id") % 600).alias("key"), "id")
    hot = skew.heavy_keys(df, ["key"], hot_rows=4, sample=1.0)
    assert hot.count() == 600 and hot.filter("_fanout < 2").count() == 0
    other = spark.range(0, 600, 2).select(F.col("id").alias("key"), F.lit(1).alias("n"))
    for how in ("left", "left_anti", "inner", "left_semi"):
        got = skew.skew_join(df, other, ["key"], how, hot_rows=4, sample=1.0, small_rows=0)
        want = df.join(other, ["key"], how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_null_keys_are_dealt_over_tasks(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("key"), "id")
    other = spark.range(4000).select(F.col("id").alias("key"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = skew.skew_join(df, other, ["key"], "left", small_rows=0)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) < 1500


def test_small_sides_are_measured(spark, skewed):
    _, df = skewed
    assert skew.is_small(df) and not skew.is_small(df, rows=299) and not skew.is_small(df, size=100)
    plan = lambda j: j._jdf.queryExecution().optimizedPlan().toString()
    keys = df.groupBy("key").count()
    assert "strategy=broadcast" in plan(skew.skew_join(df, keys, ["key"]))
    assert "strategy=broadcast" not in plan(skew.skew_join(df, keys, ["key"], small_rows=3))


def test_skew_join_refuses_outer_sides_it_cannot_salt(skewed):
    _, df = skewed
    with pytest.raises(ValueError):
        skew.skew_join(df, df, ["id"], "right")


def test_parts_are_whole_and_bounded(spark, skewed):
    rows, df = skewed
    df = df.withColumn("key", F.when(F.col("key") != "a", F.col("key")))  # a null key is a group too
    want = defaultdict(list)
    for _, key, _, text in rows:
        want[None if key == "a" else key].append(text)
    whole = grouping.collect_parts(df, ["key"], ["id"], "text").collect()
    assert {r["key"]: r["values"] for r in whole} == want
    assert {r["part"] for r in whole} == {0}
    split = grouping.collect_parts(df, ["key"], ["id"], "text", part_rows=7).collect()
    again = defaultdict(list)
    for r in sorted(split, key=lambda r: (str(r["key"]), r["part"])):
        assert r["n"] == len(r["values"]) <= 7
        again[r["key"]] += r["values"]
    assert again == want
    assert len(split) == sum(-(-len(v) // 7) for v in want.values())


def test_first_and_repeated_rows(skewed):
    rows, df = skewed
    first = grouping.keep_first(df, ["key"], ["id"]).collect()
    want = {}
    for row in rows:
        want.setdefault(row[1], row)
    assert {r["key"]: tuple(r) for r in first} == want
    repeated = grouping.repeated_rows(df, ["key"], ["id"]).collect()
    assert {r["id"] for r in repeated} == {r[0] for r in rows} - {r[0] for r in want.values()}


def test_group_values_come_back_to_each_row(skewed):
    rows, df = skewed
    sizes = Counter(r[1] for r in rows)
    got = with_group_values(df, ["key"], n=F.count(F.lit(1))).collect()
    assert len(got) == len(rows) and all(r["n"] == sizes[r["key"]] for r in got)


def test_histogram_closes_the_last_bin_and_lists_empty_ones(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.5,), (10.0,), (None,)], "v double")
    got = sorted((r["bin"], r["n"]) for r in grouping.histogram(df, "v", 5).collect())
    assert got == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 2)]
    flat = grouping.histogram(df.filter("v = 1"), "v", 2).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["n"]) for r in flat] == [(0.5, 1.0, 0), (1.0, 1.5, 1)]


def test_box_stats(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 7.0)]
    got = {r["k"]: r for r in grouping.box_stats(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    assert (got["a"]["q1"], got["a"]["median"], got["a"]["q3"]) == (2.0, 3.0, 4.0)
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["outliers"]) == (1.0, 4.0, 1)
    assert (got["b"]["whisker_low"], got["b"]["outliers"]) == (7.0, 0)


def test_density_has_mass_one(spark):
    rows = [(random.Random(i).gauss(0, 2),) for i in range(200)]
    points = grouping.kernel_density(spark.createDataFrame(rows, "v double"), "v", points=200).orderBy("x").collect()
    step = points[1]["x"] - points[0]["x"]
    assert sum(p["density"] for p in points) * step == pytest.approx(1, abs=0.01)
    with pytest.raises(ValueError):
        grouping.kernel_density(spark.createDataFrame([(1.0,)], "v double"), "v")


def test_words_containing_an_entry(spark):
    dice = random.Random(2)
    words = ["".join(dice.choices("abc", k=dice.randint(1, 7))) for _ in range(200)] + ["", "été"]
    entries = ["ab", "cca", "", " ", "té", "abcabcabc"]
    got = containing_words(
        spark.createDataFrame([(w,) for w in words], "w string"), "w",
        spark.createDataFrame([(e,) for e in entries], "e string"), "e",
    )
    want = {w for w in words if any(e.strip() and e in w for e in entries)}
    found = [r["w"] for r in got.collect()]
    assert set(found) == want and len(found) == len(want)


def test_a_missed_lookup_fails(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "k string")
    table = spark.createDataFrame([("a", 1), ("c", None)], "k string, v int")
    assert lookup_or_fail(rows.filter("k = 'a'"), table, "k", "v").collect() == [("a", 1)]
    with pytest.raises(Exception, match="no v for k b"):
        lookup_or_fail(rows, table, "k", "v").collect()


def test_filters(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    assert [r["v"] for r in near_median(df, "v", 0.6).collect()] == [2.0, 3.0]
    days = spark.sql("SELECT * FROM VALUES (DATE'2016-12-31'), (DATE'2017-01-01'), (DATE'2017-12-31'), (DATE'2018-01-01') t(d)")
    assert days.filter(in_period(F.col("d"), "2017-01", "2017-12")).count() == 2
    assert days.filter(in_period(F.col("d"), "2017")).count() == 2
    names = spark.createDataFrame([("a",), ("b",), (None,)], "n string")
    assert {r["n"] for r in names.filter(not_in(F.col("n"), ["a"])).collect()} == {"b", None}


def test_splits_samples_slices_copies(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    parts = split_by_hash(df, "k", [80, 20], seed=1)
    found = [{r["k"] for r in p.collect()} for p in parts]
    assert found[0] | found[1] == set(range(1000)) and not found[0] & found[1]
    assert 700 < len(found[0]) < 900
    assert found[0] == {r["k"] for r in split_by_hash(df.repartition(7), "k", [80, 20], seed=1)[0].collect()}
    assert sample_rows(df, "k", 5, 0).collect() == sample_rows(df.repartition(3), "k", 5, 0).collect()
    numbers = list(range(1000))
    for start, stop in ((None, 3), (-4, None), (5, 8), (990, -5), (-8, -3)):
        assert sorted(r["k"] for r in slice_rows(df, ["k"], start, stop).collect()) == numbers[start:stop]
    copies = oversample(df.filter("k < 2"), F.col("k") == 1, 3).collect()
    assert sorted(map(tuple, copies)) == [(0, 1), (1, 1), (1, 2), (1, 3)]


def test_a_very_long_word_is_searched_in_blocks(spark):
    long = "ab" * 50_000
    words = [long + "needle" + long, long, "xneedlex", "need", "a" * 255 + "needle", "b" * 256 + "needle", None]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    entries = spark.createDataFrame([("needle",), ("zz",), (" ",), ("q" * 300,)], "entry string")
    got = {r["word"] for r in containing_words(df, "word", entries, "entry").collect()}
    assert got == {w for w in words if w and "needle" in w}
    assert containing_words(df, "word", entries.limit(0), "entry").count() == 0
