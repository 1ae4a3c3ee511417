"""Numbers held in slices of a corpus, looked up in a table of any size.

A slice is a row with packed numbers and a ``slice`` that names it. A table measured to be
small is sent to every task. Otherwise the distinct numbers of each slice meet the table
in a join that parts frequent ones, and what a slice has found goes back to it: at
most as many rows as it has distinct numbers, so no task holds more than its slice asks for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.skew import skew_join

SMALL_TABLE = 1_000_000  # rows of a table that is sent to every task, 8 bytes for each of its columns
SLICE_BITS = 33


class Found:
    """Distinct keys in order, and what stands beside them."""

    def __init__(self, keys: np.ndarray, values: list[np.ndarray]):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], [v[order] for v in values]

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Which keys are known, and the values of those that are."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        return known, [v[at[known]] for v in self.values]


def slice_names() -> Iterator[int]:
    """Numbers that name the slices a task makes; once they are written down they are settled."""
    name = TaskContext.get().partitionId() << SLICE_BITS
    while True:
        yield name
        name += 1


def sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def record(values: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of one row; arrays of numbers are packed where the schema has bytes."""
    cells = []
    for field in schema:
        value = values[field.name]
        if pa.types.is_binary(field.type) and isinstance(value, np.ndarray):
            value = value.tobytes()
        cells.append(pa.array([value], field.type))
    return pa.RecordBatch.from_arrays(cells, schema=schema)


def with_lookup(
    slices: DataFrame,
    keys_of: Callable[[dict], np.ndarray],
    table: DataFrame,
    run: Callable[[dict, Found], Iterator[pa.RecordBatch]],
    schema: str,
    small_table: int = SMALL_TABLE,
) -> DataFrame:
    """``run(slice, found)`` for every slice, given as a dict of its columns.

    ``table`` has a column ``key`` of distinct longs, all others are longs too. ``keys_of(slice)``
    are the numbers that the slice will ask for, repeats allowed.
    """
    values = [c for c in table.columns if c != "key"]
    if table.limit(small_table + 1).count() <= small_table:
        held = table.select("key", *values).toArrow()
        columns = [np.asarray(held.column(c).to_numpy(), np.int64) for c in ["key", *values]]
        sent = slices.sparkSession.sparkContext.broadcast(columns)

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                for i in range(batch.num_rows):
                    found = found or Found(sent.value[0], sent.value[1:])
                    yield from run(batch.slice(i, 1).to_pylist()[0], found)

        return slices.mapInArrow(whole, schema)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys = np.unique(keys_of(row)).astype(np.int64)
                name = pa.array(np.full(len(keys), row["slice"], np.int64))
                yield pa.RecordBatch.from_arrays([name, pa.array(keys)], ["slice", "key"])

    met = skew_join(slices.mapInArrow(asked, "slice long, key long"), table, ["key"], small_rows=0)
    own = met.groupBy("slice").agg(*[F.collect_list(c).alias(f"_{c}") for c in ["key", *values]])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                columns = [np.array(row.pop(f"_{c}") or [], np.int64) for c in ["key", *values]]
                yield from run(row, Found(columns[0], columns[1:]))

    return slices.join(own, "slice", "left").mapInArrow(part, schema)
