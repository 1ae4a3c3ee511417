"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.chunks import with_ordinal


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; array columns become comma-joined text."""
    columns = [
        F.array_join(F.col(name).cast("array<string>"), ",").alias(name) if kind.startswith("array") else F.col(name)
        for name, kind in df.dtypes
    ]
    df.select(*columns).write.csv(path, header=True, escape='"')


def write_json_runs(df: DataFrame, path: str, run: str = "runid") -> None:
    """JSON lines in one folder per run."""
    df.write.partitionBy(run).json(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")).write.format(
        "libsvm"
    ).save(path)


def write_run_stats(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Run statistics as CSV: one file, written by one task, or one for each task."""
    write_csv(df.coalesce(1) if single_file else df, path)


def write_token_files(
    df: DataFrame, path: str, file: str, order: Sequence[str], max_lines: int = 1_000_000
) -> None:
    """'word tag' lines in one folder per input file.

    The lines are range-partitioned by file and order, so a long file is
    written by many tasks. Each task's lines are in a folder below the file's named by its number,
    ``piece``; a task that writes more than ``max_lines`` numbers its files. Both are
    numbers, not names to sort by: ``read_token_labels`` gives them as ``piece`` and ``chunk``.
    """
    (
        df.repartitionByRange(file, *order)
        .sortWithinPartitions(file, *order)
        .select(file, F.spark_partition_id().alias("piece"), F.concat_ws(" ", "word", "label").alias("value"))
        .write.partitionBy(file, "piece")
        .option("maxRecordsPerFile", max_lines)
        .text(path)
    )


def write_text_parts(df: DataFrame, path: str, folder: str, part: str, text: str, most: int = 256) -> None:
    """Texts of a folder as numbered lines, ``most`` parts to a file; ``read_text_parts`` gives them back.

    A line has the part's number and its text, in which backslashes and line breaks are written as two characters. So the
    number of files, which the driver lists, follows from the folders and the size, not from the parts.
    """
    plain = F.replace(F.replace(F.col(text), F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))
    rows = df.repartition(F.col(folder), F.floor(F.col(part) / most))
    lines = rows.select(folder, F.concat_ws(" ", F.col(part).cast("string"), plain).alias("value"))
    lines.write.partitionBy(folder).option("maxRecordsPerFile", most).text(path)


def write_chunked(df: DataFrame, path: str, rows: int = 5000) -> None:
    """Parquet files of at most ``rows`` rows."""
    df.write.option("maxRecordsPerFile", rows).parquet(path)


def feature_json(properties: Sequence[str], geometry: str):
    """A GeoJSON feature as text; ``geometry`` is a column of JSON text."""
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(*properties).alias("properties"),
            F.parse_json(geometry).alias("geometry"),
        )
    )


def write_features(df: DataFrame, path: str, properties: Sequence[str], geometry: str) -> None:
    """One GeoJSON feature per line."""
    df.select(feature_json(properties, geometry).alias("value")).write.text(path)


def write_bundles(df: DataFrame, path: str, order: Sequence[str], name: str, item, size: int = 1000) -> None:
    """Lines that are JSON objects with a list ``name`` of at most ``size`` items each.

    ``item`` is a column of JSON text.
    """
    numbered = with_ordinal(df, [], order, "_at").withColumn("_bundle", F.floor((F.col("_at") - 1) / size))
    bundles = numbered.groupBy("_bundle").agg(
        F.sort_array(F.collect_list(F.struct("_at", item.alias("item")))).alias("items")
    )
    items = F.array_join(F.transform("items", lambda e: e["item"]), ",")
    bundles.select(F.concat(F.lit(f'{{"{name}":['), items, F.lit("]}")).alias("value")).write.text(path)
