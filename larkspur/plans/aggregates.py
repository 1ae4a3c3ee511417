"""Aggregations and distributions."""

from pyspark.sql import functions as F

from larkspur.functions.arrays import each, picked, positional_array
from larkspur.functions.text import (
    STOP_WORDS,
    gap_tokens,
    remove_words,
    sentence_tokens,
    token_sentences,
    word_tokens,
)
from larkspur.operators.chunks import exact_quantiles
from larkspur.operators.grouping import (
    box_stats,
    collect_parts,
    histogram,
    kernel_density,
    letter_values,
)
from larkspur.plans.registry import query
from larkspur.plans.views import WIDTH
from larkspur.session import materialize

STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + ")"
PLAIN_SQL = r"""list_filter(regexp_split_to_array(regexp_replace(lower(regexp_replace({0}, '[[:punct:]]', '', 'g')),
    '[0-9]', '', 'g'), '\s'), lambda w: w <> '')"""
SENTENCE_SQL = r"list_filter(regexp_split_to_array(text, '[.!?]+(?:\s+|\z)'), lambda s: trim(s, ' ') <> '')"


@query("group_count", """
    SELECT neighbourhood_group, room_type, count(*) AS n FROM listings_v GROUP BY 1, 2""")
def group_count(t):
    return t.listings.groupBy("neighbourhood_group", "room_type").agg(F.count("id").alias("n"))


@query("group_mean", """
    SELECT neighbourhood, neighbourhood_group, round(avg(price), 4) AS price FROM listings_v GROUP BY 1, 2""")
def group_mean(t):
    return t.listings.groupBy("neighbourhood", "neighbourhood_group").agg(
        F.round(F.avg("price"), 4).alias("price")
    )


@query("group_sum", """
    SELECT neighbourhood, neighbourhood_group, CAST(sum(number_of_reviews) AS BIGINT) AS number_of_reviews
    FROM listings_v GROUP BY 1, 2""")
def group_sum(t):
    return t.listings.groupBy("neighbourhood", "neighbourhood_group").agg(
        F.sum("number_of_reviews").alias("number_of_reviews")
    )


@query("group_collect_list", """
    SELECT business_id, part, count(*) AS n, string_agg(text, ' | ' ORDER BY conv_id, turn) AS tips
    FROM (SELECT *, (row_number() OVER (PARTITION BY business_id ORDER BY conv_id, turn) - 1) // 5 AS part FROM tips_v)
    GROUP BY 1, 2""")
def group_collect_list(t):
    """Tips of each business in parts of five."""
    parts = collect_parts(t.tips, ["business_id"], ["conv_id", "turn"], "text", part_rows=5)
    return parts.select("business_id", "part", "n", F.array_join("values", " | ").alias("tips"))


@query("group_concat_text", """
    SELECT business_id, part, string_agg(text, ' ' ORDER BY review_id) AS review_combined
    FROM (SELECT *, (row_number() OVER (PARTITION BY business_id ORDER BY review_id) - 1) // 8 AS part FROM reviews_v)
    GROUP BY 1, 2""")
def group_concat_text(t):
    """Reviews of each business joined, in parts of eight."""
    parts = collect_parts(t.review_texts, ["business_id"], ["review_id"], "text", part_rows=8)
    return parts.select("business_id", "part", F.array_join("values", " ").alias("review_combined"))


PROFILED = ["id", "neighbourhood", "price", "last_review", "latitude"]


def _profile(df, value, name):
    """One pass for all columns, turned into one row per column."""
    counted = df.agg(*[value(c).alias(c) for c in PROFILED])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias(name)) for c in PROFILED]
    return counted.select(F.inline(F.array(*pairs)))


def _profile_sql(value, name):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {value.format(c)} AS {name} FROM listings_v" for c in PROFILED
    )


@query("profile_counts", _profile_sql("count({})", "filled"))
def profile_counts(t):
    return _profile(t.listings.select(*PROFILED), F.count, "filled")


@query("profile_nulls", _profile_sql("count(*) - count({})", "missing"))
def profile_nulls(t):
    return _profile(t.listings.select(*PROFILED), lambda c: F.count_if(F.col(c).isNull()), "missing")


@query("distinct_values", "SELECT DISTINCT room_type FROM listings_v")
def distinct_values(t):
    return t.listings.select("room_type").distinct()


@query("median_global", """
    SELECT round(median(price), 6) AS median_price FROM listings_v""")
def median_global(t):
    prices = materialize(t.listings.select("price"), "prices")  # a join, read more than once
    return exact_quantiles(prices, [], "price", [0.5]).select(F.round("quantile", 6).alias("median_price"))


@query("percent_share", """
    SELECT class_id, n, round(n * 100.0e0 / sum(n) OVER (), 6) AS percent
    FROM (SELECT class_id, count(*) AS n FROM food_v GROUP BY 1)""")
def percent_share(t):
    counts = t.food.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    total = t.food.agg(F.count(F.lit(1)))
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total.scalar(), 6))


@query("positional_sum", """
    SELECT CAST(pos - 1 AS INTEGER) AS pos, CAST(sum(flag) AS BIGINT) AS total FROM (
        SELECT unnest(y2) AS flag, generate_subscripts(y2, 1) AS pos FROM food_v) GROUP BY 1""")
def positional_sum(t):
    return t.food.select(F.posexplode("y2").alias("pos", "flag")).groupBy("pos").agg(F.sum("flag").alias("total"))


CALORIE_SQL = """
    SELECT vec_id, list_transform(list_filter(range(1, 65), lambda i: y2[i] = 1),
           lambda i: cal[i]) AS picks
    FROM food_v, (SELECT list(calories ORDER BY idx) AS cal FROM calories_v)"""


def _with_calories(t):
    reference = positional_array(t.calories, "idx", "calories", WIDTH)
    rows = t.food.select("vec_id", "y2").withColumn("reference", reference.scalar())
    values = F.transform(picked(F.col("y2"), F.col("reference")), lambda p: p["value"])
    return rows.select("vec_id", values.alias("values"))


@query("calorie_sum", f"""
    SELECT vec_id, CAST(coalesce(list_sum(picks), 0) AS BIGINT) AS calories FROM ({CALORIE_SQL})""")
def calorie_sum(t):
    total = F.aggregate("values", F.lit(0).cast("bigint"), lambda a, v: a + v)
    return _with_calories(t).select("vec_id", total.alias("calories"))


@query("calorie_avg", f"""
    SELECT vec_id, round(CASE WHEN len(picks) > 0 THEN list_sum(picks) * 1.0e0 / len(picks) END, 6) AS calories
    FROM ({CALORIE_SQL})""")
def calorie_avg(t):
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    mean = F.try_divide(total, F.size("values"))
    return _with_calories(t).select("vec_id", F.round(mean, 6).alias("calories"))


@query("max_sentence_len", f"""
    SELECT CAST(max(len({PLAIN_SQL.format('s')}) + 1) AS INTEGER) AS longest, count(*) AS sentences
    FROM (SELECT unnest({SENTENCE_SQL}) AS s FROM documents)""")
def max_sentence_len(t):
    parts = token_sentences(sentence_tokens(F.col("text")))
    sizes = t.documents.select(F.transform(parts, F.size).alias("sizes"))
    return sizes.agg(
        F.max(F.array_max("sizes")).alias("longest"), F.sum(F.size("sizes")).alias("sentences")
    )


@query("vocab_size", r"""
    SELECT count(DISTINCT w) AS words, count(*) AS tokens FROM (
        SELECT unnest(list_filter(regexp_split_to_array(lower(text), '\W'), lambda w: length(w) >= 4)) AS w
        FROM documents)""")
def vocab_size(t):
    words = each(t.documents, [], gap_tokens(F.col("text")), "w")
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count("w").alias("words"), F.sum("n").alias("tokens"))


@query("row_counts", """
    SELECT 'business' AS name, count(*) AS n FROM business_v WHERE contains(categories, 'Restaurants')
    UNION ALL
    SELECT 'reviews', count(*) FROM reviews_v r JOIN business_v b ON r.business_id = b.business_id
    WHERE contains(b.categories, 'Restaurants')""")
def row_counts(t):
    restaurants = t.business.filter(F.col("categories").contains("Restaurants")).select("business_id")
    reviews = t.review_texts.groupBy("business_id").agg(F.count(F.lit(1)).alias("n")).join(restaurants, "business_id")
    return restaurants.agg(F.count(F.lit(1)).alias("n")).select(F.lit("business").alias("name"), "n").union(
        reviews.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("reviews"), "n")
    )


@query("count_where", """
    SELECT count(*) FILTER (WHERE categories IS NULL) AS without_category,
           count(*) FILTER (WHERE categories = 'Shopping, Fashion') AS fashion FROM business_v""")
def count_where(t):
    kind = F.col("categories")
    return t.business.agg(
        F.count_if(kind.isNull()).alias("without_category"),
        F.count_if(kind == "Shopping, Fashion").alias("fashion"),
    )


@query("term_frequency", rf"""
    SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS word FROM conversations)
    WHERE word NOT IN {STOP_SQL} GROUP BY 1 ORDER BY n DESC, word LIMIT 200""")
def term_frequency(t):
    """The 200 most frequent words, as drawn in a word cloud."""
    words = each(t.conversations, [], remove_words(word_tokens(F.col("text"))), "word")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(200)


@query("histogram", """
    WITH b AS (SELECT min(price) AS low, max(price) AS high FROM listings_v),
    counts AS (SELECT least(CAST(floor((price - low) / (high - low) * 20) AS BIGINT), 19) AS bin, count(*) AS n
               FROM listings_v, b WHERE price IS NOT NULL GROUP BY 1)
    SELECT r.bin, round(low + (high - low) / 20 * r.bin, 4) AS lower,
           round(low + (high - low) / 20 * (r.bin + 1), 4) AS upper, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(0, 20)) AS bin) r CROSS JOIN b LEFT JOIN counts c ON c.bin = r.bin""")
def listing_histogram(t):
    bins = histogram(t.listings.select("price"), "price", 20)
    return bins.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


@query("histogram_lengths", f"""
    WITH sizes AS (SELECT len({PLAIN_SQL.format('s')}) + 1 AS v
                   FROM (SELECT unnest({SENTENCE_SQL}) AS s FROM documents)),
    b AS (SELECT min(v) * 1.0e0 AS low, max(v) * 1.0e0 AS high FROM sizes),
    counts AS (SELECT least(CAST(floor((v - low) / (high - low) * 5) AS BIGINT), 4) AS bin, count(*) AS n
               FROM sizes, b GROUP BY 1)
    SELECT r.bin, round(low + (high - low) / 5 * r.bin, 4) AS lower,
           round(low + (high - low) / 5 * (r.bin + 1), 4) AS upper, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(0, 5)) AS bin) r CROSS JOIN b LEFT JOIN counts c ON c.bin = r.bin""")
def histogram_lengths(t):
    """Sentence lengths in five bins."""
    parts = token_sentences(sentence_tokens(F.col("text")))
    sizes = each(t.documents, [], F.transform(parts, F.size), "size")
    bins = histogram(materialize(sizes, "sizes"), "size", 5)
    return bins.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


@query("box_stats", """
    WITH q AS (SELECT neighbourhood_group, quantile_cont(availability_365, 0.25) AS q1,
                      quantile_cont(availability_365, 0.5) AS median, quantile_cont(availability_365, 0.75) AS q3
               FROM listings_v GROUP BY 1),
    f AS (SELECT l.neighbourhood_group, q1, median, q3, availability_365 AS v,
                 availability_365 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM listings_v l JOIN q ON l.neighbourhood_group = q.neighbourhood_group)
    SELECT neighbourhood_group, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           CAST(min(v) FILTER (WHERE inside) AS DOUBLE) AS whisker_low,
           CAST(max(v) FILTER (WHERE inside) AS DOUBLE) AS whisker_high,
           count(*) FILTER (WHERE NOT inside) AS outliers
    FROM f GROUP BY neighbourhood_group, q1, median, q3""")
def listing_box_stats(t):
    stats = box_stats(t.listings, "neighbourhood_group", "availability_365")
    rounded = [F.round(c, 6).alias(c) for c in ("q1", "median", "q3")]
    return stats.select("neighbourhood_group", *rounded, "whisker_low", "whisker_high", "outliers")


LETTERS_SQL = " UNION ALL ".join(
    f"""SELECT neighbourhood_group, {d} AS level, round(quantile_cont(price, {0.5**d}), 6) AS lower,
        round(quantile_cont(price, {1 - 0.5**d}), 6) AS upper FROM listings_v GROUP BY 1"""
    for d in range(1, 6)
)


@query("letter_values", LETTERS_SQL)
def listing_letter_values(t):
    found = letter_values(t.listings, "neighbourhood_group", "price", 5)
    return found.select(
        "neighbourhood_group", "level", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper")
    )


@query("kernel_density", """
    WITH s AS (SELECT count(price) AS n, stddev_samp(price) * pow(count(price), -0.2) AS h,
                      min(price) AS lo, max(price) AS hi FROM listings_v),
    g AS (SELECT CAST(p AS INTEGER) AS point, lo - 3 * h + p * (hi - lo + 6 * h) / 99 AS x, n, h
          FROM s, (SELECT unnest(range(0, 100)) AS p))
    SELECT point, round(x, 2) AS x, round(sum(exp(-0.5 * pow((price - x) / h, 2))) / (n * h * sqrt(2 * pi())), 10)
           AS density
    FROM g, listings_v GROUP BY point, x, n, h""")
def price_density(t):
    prices = materialize(t.listings.select("price"), "prices")
    return kernel_density(prices, "price").select(
        "point", F.round("x", 2).alias("x"), F.round("density", 10).alias("density")
    )


@query("strip_points", "SELECT room_type, price FROM listings_v")
def strip_points(t):
    return t.listings.select("room_type", "price")
