"""Logistic regression on hashed words, for rows in the hundreds of millions.

Loss, scaling, start and search are those of MLlib's ``LogisticRegression`` with an intercept. The rows are packed into arrays
once; a pass over them is a few array operations in each task, whose sums are added up before they come to the driver.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

CHUNK = 1 << 16  # rows that a task works on at once, about
TASKS = 4  # tasks of a pass for each core, at most
LONG = 64  # bytes of a word that is hashed beside others
MEMORY = 10  # steps that the search remembers
TRIES = 10  # of a line search, and of its narrowing
FLAT = 20  # last losses whose greatest is compared with the newest


def _mixed(k: np.ndarray) -> np.ndarray:
    k = k * np.uint32(0xCC9E2D51)
    return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)


def _murmur(words: list[bytes]) -> np.ndarray:
    """The hash that MLlib's ``FeatureHasher`` gives to texts: 32 bits of MurmurHash3, seed 42."""
    lengths = np.array([len(w) for w in words], np.int64)
    wide = int(lengths.max(initial=0)) // 4 * 4 + 4
    blocks = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), "<u4").reshape(len(words), -1)
    found = np.full(len(words), 42, np.uint32)
    for j in range(blocks.shape[1]):
        k = found ^ _mixed(blocks[:, j])
        turned = (k << np.uint32(13) | k >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
        found = np.where(j < lengths // 4, turned, np.where((j == lengths // 4) & (lengths % 4 > 0), k, found))
    found ^= lengths.astype(np.uint32)
    found = (found ^ found >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    found = (found ^ found >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return found ^ found >> np.uint32(16)


def hashed_places(column: pa.Array, name: str, width: int) -> np.ndarray:
    """Place of each text of a column by the hash of ``name=text``; ``width`` for a null."""
    coded = column.dictionary_encode()
    start, words = f"{name}=".encode(), coded.dictionary.cast(pa.binary()).to_pylist()
    keys = [start + w for w in words]
    codes = np.zeros(len(keys), np.uint32)
    short = np.array([len(w) <= LONG for w in keys], bool)
    if short.any():
        codes[short] = _murmur([w for w in keys if len(w) <= LONG])
    for i in np.flatnonzero(~short):
        codes[i] = _murmur([keys[i]])[0]
    places = np.append(codes.view(np.int32).astype(np.int64) % width, width).astype(np.int32)
    return places[coded.indices.fill_null(len(keys)).to_numpy(zero_copy_only=False)]


def _columns(batch: pa.RecordBatch, inputs: Sequence[str], width: int) -> np.ndarray:
    """Hashed places, a line for each input."""
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    return np.stack([hashed_places(column[name], name, width) for name in inputs])


def _least_type(numbers: np.ndarray) -> np.ndarray:
    """The numbers in the narrowest of a few types that holds them all."""
    for kind in (np.uint8, np.uint16, np.int32):
        narrow = numbers.astype(kind)
        if (narrow == numbers).all():
            return narrow
    return numbers


def _place(key: int) -> int:
    return key


def _packed(rows: DataFrame, label: str, weight: str, inputs: Sequence[str], width: int) -> RDD:
    """(places, label, weight) of some rows after the other, as arrays."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            held.append((_columns(batch, inputs, width), y == 1, n))
            count += batch.num_rows
            if count >= CHUNK:
                yield packed(held)
                held, count = [], 0
        if count:
            yield packed(held)

    def packed(held: list) -> pa.RecordBatch:
        places, y, n = (np.concatenate(x, -1) for x in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps((_least_type(places), y, _least_type(n)))], pa.binary())], ["data"])

    found = rows.select(label, weight, *inputs).mapInArrow(pack, "data binary").rdd
    most = TASKS * found.context.defaultParallelism
    return (found.coalesce(most) if found.getNumPartitions() > most else found).map(lambda r: bytes(r[0]))


def _added(packed: RDD, use: Callable[[list[np.ndarray], np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum of what ``use`` gives for all rows, added up in one task: the driver gets it once."""

    def run(parts: Iterator) -> Iterator:
        total = None
        for data in parts:
            places, y, n = pickle.loads(data)
            found = use([p.astype(np.intp) for p in places], y, n.astype(np.float64))
            if total is None:
                total = found
            else:
                total += found
        if total is not None:
            yield 0, total

    def add(parts: Iterator) -> Iterator:
        total = None
        for _, part in parts:
            total = part if total is None else total + part
        if total is not None:
            yield total

    found = packed.mapPartitions(run).partitionBy(1, _place).mapPartitions(add).collect()
    return found[0] if found else None


def _statistics(width: int):
    """Weight of the rows, of those of label 1, the sum of its squares; sums and sums of squares of the columns."""

    def use(places: list[np.ndarray], y: np.ndarray, n: np.ndarray) -> np.ndarray:
        sums = sum(np.bincount(p, n, width + 1) for p in places)
        squares = sums.copy()
        for a in range(len(places)):
            for b in range(a):  # a place hit by two inputs has the value 2
                some = places[a] == places[b]
                squares += 2 * np.bincount(places[a][some], n[some], width + 1)
        return np.concatenate([[n.sum(), n[y].sum(), n @ n], sums[:width], squares[:width]])

    return use


def _gradient(table: np.ndarray, intercept: float):
    """Loss, its slope by the intercept, and by each column."""

    def use(places: list[np.ndarray], y: np.ndarray, n: np.ndarray) -> np.ndarray:
        margin = np.full(len(y), intercept)
        for p in places:
            margin += table.take(p, mode="clip")
        whole = 1 + np.exp(-np.abs(margin))
        lost = np.log(whole) + np.maximum(margin, 0) - y * margin
        slope = np.exp(np.minimum(margin, 0))
        slope /= whole
        slope -= y
        slope *= n
        found = np.zeros(2 + len(table))
        found[:2] = n @ lost, slope.sum()
        for p in places:
            found[2:] += np.bincount(p, slope, len(table))
        return found[:-1]

    return use


class _Stuck(Exception):
    """A search that finds no better point."""


def _between(low: tuple, high: tuple) -> float:
    """Least point of the cubic through values and slopes at two steps, not too near either."""
    (a, value_a, slope_a), (b, value_b, slope_b) = sorted((low[:3], high[:3]))
    d1 = slope_a + slope_b - 3 * (value_a - value_b) / (a - b)
    inside = d1 * d1 - slope_a * slope_b
    d2 = math.sqrt(inside) if inside >= 0 else math.nan
    below = slope_b - slope_a + 2 * d2
    step = b - (b - a) * (slope_b + d2 - d1) / below if below else math.nan
    low_end, high_end = a + 0.1 * (b - a), a + 0.9 * (b - a)
    return low_end if step < low_end else high_end if step > high_end else step


def _line(at_step: Callable[[float], tuple], start: tuple, step: float) -> tuple:
    """A step, ``step`` tried first, that meets the strong Wolfe conditions: (step, value, slope along the line, point, gradient)."""
    _, value, slope = start[:3]
    if slope > 0:
        raise _Stuck("not a way down")
    enough = lambda c: c[1] <= value + 1e-4 * c[0] * slope
    level = lambda c: abs(c[2]) <= 0.9 * abs(slope)

    def zoom(low: tuple, high: tuple) -> tuple:
        for _ in range(TRIES):
            c = at_step(_between(low, high))
            if not enough(c) or c[1] >= low[1]:
                high = c
                continue
            if level(c):
                return c
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _Stuck("no step in the bracket")

    low = start
    for turn in range(TRIES):
        c = at_step(step)
        if not math.isfinite(c[1]):
            step /= 2
            continue
        if not enough(c) or (c[1] >= low[1] and turn):
            return zoom(low, c)
        if level(c):
            return c
        if c[2] >= 0:
            return zoom(c, low)
        low, step = c, step * 1.5
    raise _Stuck("no bracket")


def _way(slope: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Where to go by the last moves and turns, newest first."""
    way, shares = slope.copy(), []
    for move, turn in history:
        shares.append((move @ way) / (move @ turn))
        way -= shares[-1] * turn
    if history:
        move, turn = history[0]
        if not move @ turn >= 0:
            raise _Stuck("history without curvature")
        way *= (move @ turn) / (turn @ turn)
    for share, (move, turn) in zip(reversed(shares), reversed(history), strict=True):
        way += (share - (turn @ way) / (move @ turn)) * move
    if not np.isfinite(way).all():
        raise _Stuck("history without curvature")
    return -way


def least(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, iterations: int, tolerance: float) -> tuple[np.ndarray, list[float]]:
    """Limited-memory BFGS as MLlib's fits use it: the point found, and the losses on the way."""
    value, slope = loss(x)
    values, recent, history, failed, first = [value], [math.inf], [], False, value
    while len(values) <= iterations:
        if len(recent) >= 2 and abs(value - max(recent)) <= tolerance * first:
            break
        if np.linalg.norm(slope) <= max(tolerance * value, 1e-8):
            break
        try:
            way = _way(slope, history)

            def at_step(step: float, x=x, way=way) -> tuple:
                point = x + step * way
                value, slope = loss(point)
                return step, value, float(slope @ way), point, slope

            begin = 1.0 if len(values) > 1 else 1 / float(np.linalg.norm(way))
            step, new_value, _, point, new_slope = _line(at_step, (0.0, value, float(slope @ way)), begin)
            if step * np.linalg.norm(slope) < 1e-10:
                raise _Stuck("no step")
        except _Stuck:
            if failed:
                break
            failed, history = True, []
            continue
        failed, history = False, [(point - x, new_slope - slope), *history][:MEMORY]
        x, value, slope = point, new_value, new_slope
        values.append(value)
        recent = [*recent, value][-FLAT:]
    return x, values


@dataclass
class HashedLogit:
    """Weights of the columns, ``intercept``, and the losses of the fit."""

    weights: np.ndarray
    intercept: float
    losses: list[float]
    inputs: Sequence[str]

    def predict(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep`` of ``rows`` with their ``prediction``."""
        width, inputs, intercept = len(self.weights), self.inputs, self.intercept
        sent = rows.sparkSession.sparkContext.broadcast(np.append(self.weights, 0.0))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.rename_columns(names)
                margin = sent.value[_columns(batch, inputs, width)].sum(0) + intercept
                found = pa.array((margin > 0).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(keep))), found], [*keep, "prediction"])

        kept, names = rows.select(*keep), list(dict.fromkeys([*keep, *inputs]))
        return rows.select(*names).mapInArrow(run, StructType([*kept.schema.fields, StructField("prediction", DoubleType())]))


def fit_hashed(
    rows: DataFrame, inputs: Sequence[str], width: int, label: str, weight: str, reg: float, iterations: int, tolerance: float = 1e-6
) -> HashedLogit:
    """A model of the 0/1 column ``label`` from the texts of ``inputs``, hashed to ``width`` columns; a row counts ``weight`` times.

    ``reg`` / 2 times the squares of the weights of columns scaled to unit deviation is added to the mean loss. Rows of one
    label only are predicted as that. The rows are read once.
    """
    context = rows.sparkSession.sparkContext
    packed = _packed(rows, label, weight, inputs, width).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _added(packed, _statistics(width))
        if found is None:
            raise ValueError("there are no rows to fit")
        (total, ones, squared), sums, squares = np.split(found, [3, 3 + width])
        if ones in (0, total):
            return HashedLogit(np.zeros(width), math.inf if ones else -math.inf, [], inputs)
        mean = sums / total
        free = total - squared / total
        deviation = np.sqrt(np.maximum(squares - total * mean**2, 0) / free) if free > 0 else np.zeros(width)
        scale = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1), 0.0)

        def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
            sent = context.broadcast((np.append(x[:-1] * scale, 0.0), float(x[-1] - x[:-1] @ (scale * mean))))
            use = lambda places, y, n: _gradient(*sent.value)(places, y, n)
            lost, at_intercept, *_ = found = _added(packed, use)
            sent.destroy()
            slope = scale * found[2:] - scale * mean * at_intercept
            return lost / total + reg / 2 * float(x[:-1] @ x[:-1]), np.append(slope / total + reg * x[:-1], at_intercept / total)

        start = np.append(np.zeros(width), math.log(ones / (total - ones)))
        found, losses = least(loss, start, iterations, tolerance)
        weights = found[:-1] * scale
        return HashedLogit(weights, float(found[-1] - weights @ mean), losses, inputs)
    finally:
        packed.unpersist()
