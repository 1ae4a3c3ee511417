"""The registry, plan shapes, and results against SQL on the smallest tables."""

import re
from pathlib import Path

import pytest

from larkspur.check import compare
from larkspur.plans.catalog import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test data")

# one or two of each kind; ``python -m larkspur.check`` runs all
COMPARED = [
    "area_price_top", "outlier_median", "array_replace_negative", "join_inner", "join_substring_exists",
    "join_positional", "lookup_terms", "group_concat_text", "calorie_avg", "histogram", "box_stats",
    "kernel_density", "segment_sentences", "argmax_category", "topk_scores", "index_assign", "slice_rows",
    "report_duplicates", "remove_stopwords", "strip_accents", "pad_tokens", "weekday_name", "multi_label_binarize",
    "decode_multi_hot", "scan_geojson", "sink_token_files", "count_vectorize", "chi2_select", "naive_bayes",
    "word_sentiment", "minmax_scale", "eval_class_report", "eval_log_loss", "model_roundtrip",
]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 140


@needs_data
@pytest.mark.parametrize("name", COMPARED)
def test_query_matches_its_sql(spark, name):
    assert compare(spark, SMALL, name).startswith("match")


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["time_slice"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    plan = plan_of(QUERIES["group_count"](spark, SMALL))
    assert "l_orderkey" not in plan  # an unused outer side is not read
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>", plan)


@needs_data
@pytest.mark.parametrize("name", ["tag_entities", "remove_stopwords", "select_pos_tokens"])
def test_text_work_neither_joins_nor_leaves_the_engine(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Join" not in plan and "Python" not in plan and plan.count("Exchange (") <= 2


@needs_data
def test_no_query_plans_a_nested_loop_or_product(spark):
    for name in ["join_substring_exists", "kernel_density", "outlier_median", "eval_class_report", "naive_bayes"]:
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
