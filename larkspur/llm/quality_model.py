"""Quality classifier: logistic regression over hashed word n-grams.

Features are the words, their shapes (runs of capitals, letters, digits; other
characters as they are) and neighbouring pairs of both, hashed to a fixed number of
weights. Shards of the training rows are fitted side by side with
follow-the-regularised-leader updates and their weights averaged. A score is the
sparse dot product of a text's features with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bytetext import Words, hash_runs, mix64, utf8
from larkspur.llm.registry import query, table

BITS = 18  # 2 ** BITS weights; the first is the bias
MAX_TRAINING = 32_768  # labelled rows that a model is fitted on, about; more are sampled by hash
SHARD_ROWS = 4_096  # training rows of a shard, about; their number sets that of the shards
EPOCHS = 8
SLICE_BYTES = 1 << 20  # text handled at once; its words take some fifty times as much
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.05, 0.01


def _shape_hashes(words: Words) -> np.ndarray:
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("A") : ord("Z") + 1] = ord("A")
    kind[ord("a") : ord("z") + 1] = ord("a")
    kind[0x80:] = ord("a")
    kind[ord("0") : ord("9") + 1] = ord("9")
    shape = kind[words.raw]
    first = np.zeros(len(shape), bool)
    first[words.starts] = True
    kept = first.copy()
    kept[1:] |= shape[1:] != shape[:-1]
    starts = np.flatnonzero(first[kept])
    lengths = np.diff(np.append(starts, int(kept.sum())))
    place = np.arange(int(kept.sum())) - np.repeat(starts, lengths)
    return hash_runs(shape[kept], place, starts)


def _pairs(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    same = row[1:] == row[:-1]
    joined = mix64(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    return joined[same], row[1:][same]


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value), ordered by row and bucket. Words and shapes have length one each; the bias is 1."""
    words = Words(texts)
    plain = words.hashes()
    shapes = _shape_hashes(words)
    again = np.zeros(len(plain), np.uint64)  # a word that repeats the one before has a shape of its own
    again[1:] = (plain[1:] == plain[:-1]) & (words.row[1:] == words.row[:-1])
    shapes = mix64(shapes + again)
    blocks = []
    for n, hashes in enumerate((plain, shapes)):
        two, two_row = _pairs(hashes, words.row)
        found = np.concatenate([mix64(hashes + np.uint64(4 * n + 1)), mix64(two + np.uint64(4 * n + 2))])
        row = np.concatenate([words.row, two_row])
        bucket = (found >> np.uint64(64 - bits)).astype(np.int64)
        key, count = np.unique(row << bits | np.maximum(bucket, 1), return_counts=True)
        row, value = key >> bits, np.log1p(count)
        norm = np.sqrt(np.bincount(row, value * value, minlength=words.rows))
        blocks.append((row, key & ((1 << bits) - 1), value / norm[row]))
    blocks.append((np.arange(words.rows), np.zeros(words.rows, np.int64), np.ones(words.rows)))
    row, bucket, value = (np.concatenate(x) for x in zip(*blocks))
    order = np.lexsort((bucket, row))
    return row[order], bucket[order], value[order]


def _parts(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    size, at = utf8(texts)[1], 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, size[at] + most, "right")) - 1)
        yield texts.slice(at, end - at)
        at = end


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of the regularised leader for gradient sums ``z`` and squared sums ``n``."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit_shard(rows: list[tuple[float, np.ndarray, np.ndarray]], bits: int = BITS) -> np.ndarray:
    """Weights after ``EPOCHS`` passes over (label, buckets, values) rows."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    shuffle = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in shuffle.permutation(len(rows)):
            label, at, x = rows[i]
            x = x.astype(np.float64)  # narrow until it is used
            w = _leader(z[at], n[at])
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return _leader(z, n)


def fit_quality(labelled: DataFrame, order: str, text: str = "text", label: str = "label", bits: int = BITS) -> np.ndarray:
    """Weights learned from the rows of ``labelled``; about ``MAX_TRAINING`` of them at most.

    Rows with a null label are left out. ``order`` (any column, as a row's key) only
    deals rows over shards and fixes their order. Without rows all weights are 0.
    """
    labelled = labelled.filter(F.col(label).isNotNull())
    shards = max(1, round(labelled.count() / SHARD_ROWS))
    rows = labelled.select(
        F.pmod(F.xxhash64(F.lit(3), order), F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64(F.lit(4), order).alias("place"),
        F.col(label).cast("double").alias("label"),
        F.col(text).cast("string").alias("text"),
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _parts(batch.column(3)):
                row, bucket, value = features(part, bits)
                cuts = np.searchsorted(row, np.arange(len(part) + 1))
                sparse = [
                    pa.array([a[b:e].astype(kind).tobytes() for b, e in zip(cuts, cuts[1:])], pa.binary())
                    for a, kind in ((bucket, "<i4"), (value, "<f4"))
                ]
                head = batch.slice(at, len(part)).columns[:3]
                yield pa.RecordBatch.from_arrays([*head, *sparse], ["shard", "place", "label", "buckets", "nums"])
                at += len(part)

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        """Of about SHARD_ROWS rows."""
        shard = shard.assign(_b=shard["buckets"]).sort_values(["place", "label", "_b"])
        data = [
            (y, np.frombuffer(b, "<i4"), np.frombuffer(v, "<f4"))
            for y, b, v in zip(shard["label"], shard["buckets"], shard["nums"])
        ]
        w = fit_shard(data, bits)
        at = np.flatnonzero(w)
        return pd.DataFrame({"shard": shard["shard"].iloc[0], "bucket": at, "weight": w[at]})

    sparse = rows.mapInArrow(hashed, "shard int, place long, label double, buckets binary, nums binary")
    fitted = sparse.groupBy("shard").applyInPandas(fit, "shard int, bucket long, weight double")
    # a row for each of the fixed number of weights and each of at most MAX_TRAINING / SHARD_ROWS shards
    found = fitted.toPandas().sort_values(["shard", "bucket"])
    weights = np.zeros(1 << bits)
    np.add.at(weights, found["bucket"].to_numpy(), found["weight"].to_numpy())
    return weights / max(1, found["shard"].nunique())


def score_quality(weights: np.ndarray):
    """A column function: probability that a text is good, 0 to 1. Null and empty texts score the bias."""
    bits = len(weights).bit_length() - 1

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = []
        for part in _parts(texts):
            row, bucket, value = features(part, bits)
            found.append(np.bincount(row, weights[bucket] * value, minlength=len(part)))
        total = np.concatenate(found) if found else np.zeros(0)
        return pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    return score


def held_out(key, parts: int, rest: int):
    """Is crc32 of the key as text ``rest`` modulo ``parts``? False for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == rest, F.lit(False))


def training_labels(labels: DataFrame, key: str, label: str, most: int = MAX_TRAINING) -> DataFrame:
    """(key, label) of about ``most`` labelled keys at most, picked by hash; the lower label of a key with two."""
    known = labels.select(key, F.col(label).alias("label")).na.drop().groupBy(key).agg(F.min("label").alias("label"))
    known = known.filter(~held_out(F.col(key), 3, 1))
    share = min(1.0, most / max(1, known.count()))
    return known.filter(F.pmod(F.xxhash64(F.lit(6), key), F.lit(1 << 20)) < int(share * (1 << 20)))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``; a row for each row.

    Learns from the labelled rows whose crc32 of the key modulo 3 is not 1. Only the text
    is scored. Null and empty texts are scored by the bias alone. Repeated keys are scored one
    by one, and each counts in training. Columns named score or predicted are replaced.
    """
    # bounded by MAX_TRAINING rows of a key and a label
    chosen = F.broadcast(training_labels(labels, key, label))
    training = docs.select(key, text).join(chosen.withColumnRenamed("label", "_label"), key)
    score = score_quality(fit_quality(training, key, text, "_label"))
    scored = docs.drop("score", "predicted").withColumn("score", score(F.col(text).cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op1_quality_model")
def op1_quality_model(spark, sf_dir):
    """Every document's quality score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")
