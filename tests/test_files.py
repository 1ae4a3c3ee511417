"""Readers and writers on small files."""

import json
from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from larkspur import session
from larkspur.sources import scan, sink


def test_csv_with_index_column_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text(',id,text\n0,7,"two\nlines, ""quoted"""\n1,8,\n')
    rows = scan.read_csv(spark, str(tmp_path / "a.csv"), "id int, text string", index=True, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(7, 'two\nlines, "quoted"'), (8, None)]


def test_csv_sink_joins_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id int, l array<string>")
    sink.write_csv(df, str(tmp_path / "o"))
    rows = scan.read_csv(spark, str(tmp_path / "o"), "id int, l string").orderBy("id").collect()
    assert [r["l"] for r in rows] == ["a,b", None] or [r["l"] for r in rows] == ["a,b", ""]


def test_json_lines_pick_declared_fields(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1,"b":{"c":"x"},"d":2}\n{"a":2}\n')
    rows = scan.read_json_lines(spark, str(tmp_path / "a.json"), "a int, b struct<c:string>")
    assert [(r["a"], r["b"] and r["b"]["c"]) for r in rows.collect()] == [(1, "x"), (2, None)]


def test_geojson_file_over_several_lines(spark, tmp_path):
    shape = {"type": "Polygon", "coordinates": [[[1, 2], [3, 4]]]}
    features = [{"type": "Feature", "properties": {"n": name}, "geometry": shape} for name in "ab"]
    (tmp_path / "m.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=2))
    rows = scan.read_features(spark, str(tmp_path / "m.json"), "n:string").collect()
    assert [r["n"] for r in rows] == ["a", "b"] and json.loads(rows[0]["geometry"]) == shape


def test_feature_sink_nests_the_geometry(spark, tmp_path):
    df = spark.createDataFrame([("a", '{"type":"Point","coordinates":[1,2]}')], "n string, g string")
    sink.write_features(df, str(tmp_path / "f"), ["n"], "g")
    line = json.loads(spark.read.text(str(tmp_path / "f")).first()["value"])
    assert line == {"type": "Feature", "properties": {"n": "a"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}


def test_text_folder_and_label_files(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "x.txt").write_text("one\ntwo")
    assert scan.read_text_files(spark, str(folder)).collect() == [("x.txt", "one\ntwo")]
    (tmp_path / "labels.txt").write_text("/1/a.jpg 1 -1 0\n\n/2/b.jpg 0\n")
    rows = scan.read_label_file(spark, str(tmp_path / "labels.txt")).orderBy("path").collect()
    assert [(r["path"], r["labels"]) for r in rows] == [("/1/a.jpg", [1, -1, 0]), ("/2/b.jpg", [0])]
    (tmp_path / "list.txt").write_text("10\n20\n\n30\n")
    listed = scan.read_reference_list(spark, str(tmp_path / "list.txt")).collect()
    assert [(r["idx"], r["value"]) for r in listed] == [(0, "10"), (1, "20"), (3, "30")]


def test_numbered_lines_are_not_shuffled(spark, tmp_path):
    rows = [(f, i, f"{f}{i}", "O") for f in "ab" for i in range(500)] + [(None, 0, "lost", "O")]
    df = spark.createDataFrame(rows, "file string, at int, word string, label string")
    sink.write_token_files(df, str(tmp_path / "n"), "file", ["at"], max_lines=7)
    got = scan.read_numbered_tokens(spark, str(tmp_path / "n"), "file")
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    found = sorted((r["file"], r["line"], r["word"], r["label"]) for r in got.collect())
    assert found == [(f, i + 1, f"{f}{i}", "O") for f in "ab" for i in range(500)]


def test_token_files_keep_line_order_over_pieces(spark, tmp_path):
    rows = [("hot", 1, i, f"w{i}", "O") for i in range(500)] + [("b", 1, 0, "salt", "B-OTH")]
    df = spark.createDataFrame(rows, "file string, doc int, pos int, word string, label string").repartition(6)
    sink.write_token_files(df, str(tmp_path / "o"), "file", ["doc", "pos"], max_lines=40)
    lines = scan.read_token_labels(spark, str(tmp_path / "o")).orderBy("file", "piece", "chunk", "pos").collect()
    assert [r["word"] for r in lines if r["file"] == "hot"] == [f"w{i}" for i in range(500)]
    assert [(r["word"], r["label"]) for r in lines if r["file"] == "b"] == [("salt", "B-OTH")]
    assert len({r["file_name"] for r in lines if r["file"] == "hot"}) > 5


def test_more_than_a_thousand_files_of_one_task_keep_their_order(spark, tmp_path):
    rows = [("a", i, f"w{i}", "O") for i in range(1100)]
    df = spark.createDataFrame(rows, "file string, pos int, word string, label string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        sink.write_token_files(df, str(tmp_path / "o"), "file", ["pos"], max_lines=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    lines = scan.read_token_labels(spark, str(tmp_path / "o")).orderBy("piece", "chunk", "pos").collect()
    assert [r["word"] for r in lines] == [f"w{i}" for i in range(1100)] and lines[-1]["chunk"] == 1099


def test_run_parameters_are_typed(spark, tmp_path):
    runs = {"params": [{"runid": "1", "alpha": "1.5", "beta": "1.1", "k": "10", "iterations": "100"}]}
    (tmp_path / "p.json").write_text(json.dumps(runs, indent=1))
    assert [tuple(r) for r in scan.read_run_params(spark, str(tmp_path / "p.json")).collect()] == [(1, 1.5, 1.1, 10, 100)]


def test_bundles_are_bounded_and_complete(spark, tmp_path):
    sink.write_bundles(spark.range(25), str(tmp_path / "b"), ["id"], "items", F.col("id").cast("string"), size=10)
    found = [json.loads(r["value"])["items"] for r in spark.read.text(str(tmp_path / "b")).collect()]
    assert sorted(len(f) for f in found) == [5, 10, 10] and sorted(sum(found, [])) == list(range(25))


def test_libsvm_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(5.0, Vectors.dense([0.0, 2.0, 0.0]))], ["stars", "features"])
    sink.write_libsvm(df, str(tmp_path / "l"), "stars")
    row = scan.read_libsvm(spark, str(tmp_path / "l"), 3).first()
    assert row["label"] == 5.0 and list(row["features"]) == [0, 2, 0]


def test_chunked_files_and_single_stats_file(spark, tmp_path):
    sink.write_chunked(spark.range(95).coalesce(1), str(tmp_path / "c"), rows=30)
    sizes = spark.read.parquet(str(tmp_path / "c")).groupBy("_metadata.file_name").count().collect()
    assert sorted(r["count"] for r in sizes) == [5, 30, 30, 30]
    sink.write_run_stats(spark.range(9).repartition(4), str(tmp_path / "s"))
    assert len(list((tmp_path / "s").glob("*.csv"))) == 1


def _session(conf, master, checkpoints=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoints)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf), sparkContext=context)


def test_scratch_folder_comes_from_the_session(spark):
    assert session.scratch_root(_session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    assert session.scratch_root(_session(None, "yarn", "hdfs:///set")) == "hdfs:///set"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(_session(None, "yarn"))
    df = session.materialize(spark.range(3), "x")
    assert df.count() == 3
    assert all(session.scratch_root(spark).removeprefix("file:") in f for f in df.inputFiles())


def test_spread_leaves_inputs_with_enough_splits_alone(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(1000).repartition(40).write.parquet(str(tmp_path / "many"))
    one, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
    assert session.spread(one).rdd.getNumPartitions() == 8
    spark.conf.set("spark.sql.files.openCostInBytes", "134217728")
    try:
        assert session.spread(many) is many
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [0, 1])
def test_empty_inputs(spark, tmp_path, size):
    df = spark.range(size).select(F.col("id").alias("runid"), F.lit("x").alias("v"))
    sink.write_run_stats(df, str(tmp_path / "s"))
    assert scan.read_csv(spark, str(tmp_path / "s"), "runid bigint, v string").count() == size


def test_parts_of_a_text_share_files(spark, tmp_path):
    odd = ["", "one\ntwo", "\n", "back\\slash \\n \\s \\\\", "\\", "ends\n", " blanks  ", "\r\n\ttab", "5 first", "é \u2028 \x0b"]
    rows = [(k, i, odd[(i + j) % len(odd)]) for j, k in enumerate(["a", "b/c d", None]) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, part long, text string").repartition(7)
    path = str(tmp_path / "parts")
    sink.write_text_parts(df, path, "k", "part", "text", most=10)
    got = scan.read_text_parts(spark, path).select("k", "part", "content").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(rows, key=str)
    files = [f for f in (tmp_path / "parts").rglob("*.txt")]
    assert 3 <= len(files) <= 18 and all(len(f.read_bytes().split(b"\n")) <= 11 for f in files)
