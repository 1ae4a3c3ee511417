"""A training corpus from raw documents, in five stages.

Each stage reads what the one before it wrote. All but the last return the columns
of ``documents``; null, empty and repeated rows pass through each as its operator says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.jaccard_join import near_duplicates
from larkspur.llm.language import identify_languages
from larkspur.llm.mixing import mix_sources
from larkspur.llm.packing import pack, public_tokenizer
from larkspur.llm.quality_model import quality_scores
from larkspur.session import materialize

LEAST_SHARE = 0.5  # of a text's letters in its main language
SHINGLE, PERCENT = 5, 80  # near duplicates share 80 % of their runs of five words; op6's own contract has others

ORACLE_SQL = None  # classifiers, seeded choices and tokens have no SQL; tests hold the stages against brute force


def _row_key(docs: DataFrame) -> Column:
    """What a row holds, ordered by doc_id with null last; only rows that are equal share it."""
    known = F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id")
    return F.struct(*known, F.xxhash64(*docs.columns).alias("h"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the quality classifier, learned from the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own = F.struct(*docs.columns).alias("own")
    scored = quality_scores(docs.select("doc_id", "text", own), labels)
    return scored.filter("predicted = 1").select("own.*")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with letters of which at least ``LEAST_SHARE`` are in one language."""
    own = F.struct(*docs.columns).alias("own")
    found = identify_languages(docs.select("doc_id", "text", "lang", own))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("own.*")


def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the text with the smallest doc_id; equal rows once."""
    keyed = docs.withColumn("_key", _row_key(docs))
    found = near_duplicates(keyed, "_key", size=SHINGLE, percent=PERCENT)
    kept = found.filter(F.col("_key") == F.col("component_id")).select("_key").distinct()
    return keyed.join(kept, "_key").dropDuplicates(["_key"]).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as often as the mix of the sources takes it."""
    keyed = docs.withColumn("_key", _row_key(docs))
    taken = mix_sources(keyed, "_key").groupBy("_key").agg(F.sum("copies").alias("_copies")).filter("_copies > 0")
    once = keyed.join(taken, "_key").dropDuplicates(["_key"])
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_copy")
    return once.select(*docs.columns, copy).drop("_copy")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the texts in sequences of tokens."""
    pieces = pack(docs, public_tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("language identification", keep_known_language),
    ("n-gram Jaccard join", keep_one_of_a_group),
    ("mixing sources to target weights", mix),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
