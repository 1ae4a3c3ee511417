"""Array, map and vector operators."""

from pyspark.sql import functions as F

from larkspur.functions.arrays import (
    concat_vectors,
    each,
    indicators,
    joined,
    label_vocabulary,
    one_hot,
    picked,
    positional_array,
)
from larkspur.functions.text import plain_words, split_trim
from larkspur.operators.chunks import with_ordinal
from larkspur.operators.skew import skew_join
from larkspur.plans.ordering import WORDS_SQL
from larkspur.plans.registry import query
from larkspur.plans.views import CLASSES, WIDTH


@query("one_hot", """
    SELECT vec_id, array_to_string(list_transform(range(1, 11),
           lambda i: CASE WHEN i = class_id THEN 1 ELSE 0 END), ',') AS y1 FROM food_v""")
def one_hot_classes(t):
    return t.food.select("vec_id", joined(one_hot(F.col("class_id"), CLASSES)).alias("y1"))


@query("multi_label_binarize", """
    WITH labels AS (SELECT business_id, list_transform(string_split(categories, ','), lambda p: trim(p, ' ')) AS l
                    FROM business_v WHERE categories IS NOT NULL),
    vocabulary AS (SELECT list(v ORDER BY v) AS v FROM (SELECT DISTINCT unnest(l) AS v FROM labels))
    SELECT business_id, array_to_string(list_transform(v, lambda x:
           CASE WHEN list_contains(l, x) THEN 1 ELSE 0 END), ',') AS y FROM labels, vocabulary""")
def multi_label_binarize(t):
    labels = t.business.na.drop(subset=["categories"]).select(
        "business_id", split_trim(F.col("categories")).alias("labels")
    )
    wide = labels.withColumn("vocabulary", label_vocabulary(labels, "labels").scalar())
    return wide.select("business_id", joined(indicators(F.col("labels"), F.col("vocabulary"))).alias("y"))


@query("label_encode", """
    SELECT id, room_type, dense_rank() OVER (ORDER BY room_type) - 1 AS code FROM listings_v""")
def label_encode(t):
    """Class names numbered in sorted order; only the distinct names are numbered."""
    rows = t.listings.select("id", "room_type")
    codes = with_ordinal(rows.select("room_type").distinct(), [], ["room_type"])
    return skew_join(rows, codes.select("room_type", (F.col("ordinal") - 1).alias("code")), ["room_type"])


@query("word_index", f"""
    WITH words AS (SELECT word, row_number() OVER (ORDER BY word) AS idx FROM ({WORDS_SQL}))
    SELECT d.conv_id, d.turn, pos, d.word, words.idx FROM (
        SELECT conv_id, turn, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word
        FROM (SELECT conv_id, turn, string_split(lower(text), ' ') AS w FROM conversations)) d
    JOIN words ON words.word = d.word""")
def word_index(t):
    """A dictionary made from the documents, used on every word of each turn; unknown words are left out."""
    words = each(t.documents, [], plain_words(F.col("text")), "word").distinct()
    index = with_ordinal(words, [], ["word"], "idx")
    said = each(t.conversations, ["conv_id", "turn"], F.split(F.lower("text"), " "), "word", "pos")
    return skew_join(said, index, ["word"]).select("conv_id", "turn", "pos", "word", "idx")


@query("vector_concat", """
    SELECT vec_id, len(v) AS size, round(list_sum(v), 4) AS total FROM (
        SELECT vec_id, list_concat(list_transform(range(1, 11), lambda i: CASE WHEN i = class_id THEN 1.0e0 ELSE 0.0e0 END),
               list_transform(y2, lambda f: f * 1.0e0), scores) AS v FROM food_v)""")
def vector_concat(t):
    parts = [one_hot(F.col("class_id"), CLASSES), F.col("y2"), F.col("scores")]
    wide = t.food.select("vec_id", concat_vectors(parts).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return wide.select("vec_id", F.size("v").cast("bigint").alias("size"), F.round(total, 4).alias("total"))


@query("exact_match_rows", """
    SELECT vec_id, y2 = list_transform(y2_raw, lambda v: CASE WHEN v = -1 THEN 0 ELSE v END) AS cleaned_equal,
           y2 = y2_raw AS raw_equal FROM food_v""")
def exact_match_rows(t):
    cleaned = F.transform("y2_raw", lambda v: F.when(v == -1, 0).otherwise(v))
    return t.food.select(
        "vec_id", (F.col("y2") == cleaned).alias("cleaned_equal"), (F.col("y2") == F.col("y2_raw")).alias("raw_equal")
    )


@query("decode_multi_hot", """
    SELECT vec_id, coalesce(string_agg(name, ',' ORDER BY p.idx) FILTER (WHERE flag = 1), '') AS names FROM (
        SELECT vec_id, unnest(y2) AS flag, generate_subscripts(y2, 1) - 1 AS idx FROM food_v) p
    JOIN calories_v c ON c.idx = p.idx GROUP BY 1""")
def decode_multi_hot(t):
    names = positional_array(t.calories, "idx", "name", WIDTH)
    rows = t.food.select("vec_id", "y2").withColumn("names", names.scalar())
    chosen = F.transform(picked(F.col("y2"), F.col("names")), lambda p: p["value"])
    return rows.select("vec_id", F.array_join(chosen, ",").alias("names"))
