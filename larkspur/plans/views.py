"""Tables of a data folder, and the role views the queries read.

Each view exists twice: as a DataFrame and as SQL for the oracle.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.sampling import hash_bucket
from larkspur.session import spread

CLASSES = 10  # food classes in the vector table
WIDTH = 64  # elements of a vector

VIEW_SQL = {
    "business_v": """
        SELECT concat('src', s_suppkey) AS business_id, s_name AS name, n_name AS city,
               r_name AS state,
               CASE s_suppkey % 5 WHEN 0 THEN 'Restaurants, Chinese, Thai'
                    WHEN 1 THEN 'Restaurants, Italian, Pizza'
                    WHEN 2 THEN 'Shopping, Fashion'
                    WHEN 3 THEN 'Restaurants, Nightlife' ELSE NULL END AS categories,
               CASE s_suppkey % 4 WHEN 0 THEN 'with,that,from' WHEN 1 THEN 'les,des la,that'
                    WHEN 2 THEN 'los,that' ELSE 'und,der,that' END AS themes
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "reviews_v": """
        SELECT d.doc_id AS review_id, d.source AS business_id, d.text, d.lang,
               CAST(1 + 2*coalesce(l.quality,0) + 2*(1-coalesce(l.toxic,1)) AS DOUBLE) AS stars
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "tips_v": """
        SELECT conv_id, turn, concat('src', conv_id % 20) AS business_id, text
        FROM conversations WHERE role = 'user'""",
    "listings_v": """
        SELECT o_orderkey AS id, r_name AS neighbourhood_group, n_name AS neighbourhood,
               o_orderpriority AS room_type, o_totalprice AS price,
               coalesce(x.n, 0) AS number_of_reviews, CAST(x.m AS DATE) AS last_review,
               o_orderkey % 366 AS availability_365,
               40.7e0 + ((o_orderkey*7919) % 2000 - 1000)/1e4 AS latitude,
               -74.0e0 + ((o_orderkey*6101) % 2000 - 1000)/1e4 AS longitude
        FROM orders JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey
                    LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_shipdate) AS m
                               FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_orderkey) x
                      ON x.l_orderkey = o_orderkey""",
    "map_v": """
        SELECT n_name AS neighbourhood, r_name AS neighbourhood_group,
               s_suppkey AS feature_id, s_acctbal AS area
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "food_v": """
        SELECT vec_id, embedding, label + 1 AS class_id, label % 2 AS y3,
               concat('/', CAST(label + 1 AS VARCHAR), '/', CAST(vec_id AS VARCHAR), '.jpg') AS path,
               CASE WHEN ('0x' || substr(md5('5' || CAST(vec_id AS VARCHAR)), 1, 8))::UBIGINT % 100 < 10 THEN 'test'
                    WHEN ('0x' || substr(md5('5' || CAST(vec_id AS VARCHAR)), 1, 8))::UBIGINT % 100 < 20 THEN 'val'
                    ELSE 'train' END AS split,
               list_transform(embedding, lambda e: CASE WHEN e > 0.1e0 THEN 1
                              WHEN e < -0.1e0 THEN -1 ELSE 0 END) AS y2_raw,
               list_transform(embedding, lambda e: CASE WHEN e > 0.1e0 THEN 1 ELSE 0 END) AS y2,
               list_transform(range(0, 10), lambda c: list_sum(list_transform(
                   list_filter(embedding, lambda e, i: (i - 1) % 10 = c),
                   lambda e: CAST(e AS DOUBLE)))) AS scores
        FROM embeddings""",
    "calories_v": """
        SELECT CAST(p_partkey % 64 AS INTEGER) AS idx, max(p_size) * 10 AS calories,
               min(p_name) AS name
        FROM part GROUP BY 1""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it names, as common table expressions."""
    used = [name for name in VIEW_SQL if re.search(rf"\b{name}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({VIEW_SQL[name].strip()})" for name in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


class Tables:
    """The given tables of one folder, and the role views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        return spread(self.read("documents"), "doc_id")

    @cached_property
    def conversations(self) -> DataFrame:
        return spread(self.read("conversations"), "conv_id", "turn")

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "r_name"
        )

    @cached_property
    def business(self) -> DataFrame:
        key = F.col("s_suppkey")
        kind, theme = key % 5, key % 4
        return (
            self.read("supplier")
            .join(self.places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.concat(F.lit("src"), key.cast("string")).alias("business_id"),
                F.col("s_name").alias("name"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                F.when(kind == 0, "Restaurants, Chinese, Thai")
                .when(kind == 1, "Restaurants, Italian, Pizza")
                .when(kind == 2, "Shopping, Fashion")
                .when(kind == 3, "Restaurants, Nightlife")
                .alias("categories"),
                F.when(theme == 0, "with,that,from")
                .when(theme == 1, "les,des la,that")
                .when(theme == 2, "los,that")
                .otherwise("und,der,that")
                .alias("themes"),
            )
        )

    @cached_property
    def review_texts(self) -> DataFrame:
        """Reviews without stars, for work on the text alone: the text is not joined and not shuffled."""
        return self.documents.select(
            F.col("doc_id").alias("review_id"), F.col("source").alias("business_id"), "text", "lang"
        )

    @cached_property
    def reviews(self) -> DataFrame:
        quality, toxic = F.coalesce("quality", F.lit(0)), F.coalesce("toxic", F.lit(1))
        stars = self.read("labels").select(F.col("doc_id").alias("review_id"), "quality", "toxic")
        return self.review_texts.join(stars, "review_id", "left").select(
            "review_id",
            "business_id",
            "text",
            "lang",
            (1 + 2 * quality + 2 * (1 - toxic)).cast("double").alias("stars"),
        )

    @cached_property
    def tips(self) -> DataFrame:
        return (
            self.conversations.filter(F.col("role") == "user")
            .select(
                "conv_id",
                "turn",
                F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("business_id"),
                "text",
            )
        )

    @cached_property
    def listings(self) -> DataFrame:
        review = (
            self.read("lineitem")
            .filter(F.col("l_returnflag") == "N")
            .groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("m"))
        )
        key = F.col("o_orderkey")
        return (
            self.read("orders")
            .join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(review, key == F.col("l_orderkey"), "left")
            .select(
                key.alias("id"),
                F.col("r_name").alias("neighbourhood_group"),
                F.col("n_name").alias("neighbourhood"),
                F.col("o_orderpriority").alias("room_type"),
                F.col("o_totalprice").alias("price"),
                F.coalesce("n", F.lit(0)).cast("bigint").alias("number_of_reviews"),
                F.col("m").cast("date").alias("last_review"),
                (key % 366).alias("availability_365"),
                (40.7 + ((key * 7919) % 2000 - 1000) / F.lit(1e4)).alias("latitude"),
                (-74.0 + ((key * 6101) % 2000 - 1000) / F.lit(1e4)).alias("longitude"),
            )
        )

    @cached_property
    def map_features(self) -> DataFrame:
        """Map areas; several share one (neighbourhood, neighbourhood_group)."""
        return (
            self.read("supplier")
            .join(self.places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("n_name").alias("neighbourhood"),
                F.col("r_name").alias("neighbourhood_group"),
                F.col("s_suppkey").alias("feature_id"),
                F.col("s_acctbal").alias("area"),
            )
        )

    @cached_property
    def food(self) -> DataFrame:
        label, vec_id = F.col("label"), F.col("vec_id")
        wide = F.col("embedding").cast("array<double>")
        bucket = hash_bucket(vec_id, 5)
        return self.read("embeddings").select(
            "vec_id",
            "embedding",
            (label + 1).alias("class_id"),
            (label % 2).alias("y3"),
            F.concat(
                F.lit("/"), (label + 1).cast("string"), F.lit("/"), vec_id.cast("string"), F.lit(".jpg")
            ).alias("path"),
            F.when(bucket < 10, "test").when(bucket < 20, "val").otherwise("train").alias("split"),
            F.transform(wide, lambda e: F.when(e > 0.1, 1).when(e < -0.1, -1).otherwise(0)).alias("y2_raw"),
            F.transform(wide, lambda e: F.when(e > 0.1, 1).otherwise(0)).alias("y2"),
            F.transform(
                F.sequence(F.lit(0), F.lit(CLASSES - 1)),
                lambda c: F.aggregate(
                    F.filter(wide, lambda _, i: i % CLASSES == c), F.lit(0.0), lambda a, e: a + e
                ),
            ).alias("scores"),
        )

    @cached_property
    def calories(self) -> DataFrame:
        """One reference value per vector position, so never more than ``WIDTH`` rows."""
        return (
            self.read("part")
            .groupBy((F.col("p_partkey") % WIDTH).cast("int").alias("idx"))
            .agg((F.max("p_size") * 10).alias("calories"), F.min("p_name").alias("name"))
        )
