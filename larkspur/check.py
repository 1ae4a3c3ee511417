"""Compare registered queries with their SQL: ``python -m larkspur.check DIR [names]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from larkspur.plans.catalog import ORACLES, QUERIES


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [_cell(v) for v in value]
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark: SparkSession, sf_dir: str, name: str) -> str:
    import duckdb

    start = time.time()
    result = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in result.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return f"rows   {name} {len(rows)} rows {took:.1f}s"
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    start = time.time()
    answer = db.execute(ORACLES[name])
    names, types = [d[0] for d in answer.description], [str(d[1]) for d in answer.description]
    expected = answer.fetchall()
    oracle_took = time.time() - start
    if sorted(names) != sorted(result.columns):
        return f"FAILED {name} columns {sorted(result.columns)} vs {sorted(names)}"
    kinds = dict(zip(names, types))
    odd = {c: (k, kinds[c]) for c, k in result.dtypes if SAME_TYPE.get(k, k) != kinds[c]}
    got, want = _rows(result.columns, rows), _rows(names, expected)
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"FAILED {name} {len(got)} vs {len(want)} rows, e.g. {str(bad)[:900]}"
    note = f" types {odd}" if odd else ""
    empty = " EMPTY" if not rows else ""
    return f"match  {name} {len(rows)} rows{empty} {took:.1f}s (sql {oracle_took:.1f}s){note}"


def main() -> None:
    from larkspur.session import build_session, drop_scratch

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in QUERIES:
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            print(compare(spark, sf_dir, name), flush=True)
        except Exception as error:  # report and go on
            print(f"ERROR  {name} {type(error).__name__}: {str(error)[:900]}", flush=True)
        drop_scratch(spark)


if __name__ == "__main__":
    main()
