"""Joins."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.functions.arrays import each, joined, picked, positional_array
from larkspur.functions.text import gap_tokens, plain_words
from larkspur.operators.chunks import with_ordinal
from larkspur.operators.grouping import keep_first
from larkspur.operators.joins import containing_words, lookup_or_fail
from larkspur.operators.skew import skew_join
from larkspur.plans.projections import NEAR_SQL, listings_near_centre
from larkspur.plans.registry import query
from larkspur.plans.views import WIDTH


@query("join_inner", """
    SELECT r.review_id, b.business_id, b.name, r.stars, r.text
    FROM reviews_v r JOIN business_v b ON b.business_id = r.business_id
    WHERE contains(b.categories, 'Restaurants')""")
def join_inner(t):
    restaurants = t.business.filter(F.col("categories").contains("Restaurants"))
    reviews = t.reviews.select("review_id", "business_id", "stars", "text")
    return skew_join(reviews, restaurants.select("business_id", "name"), ["business_id"])


@query("join_right", """
    SELECT r.business_id, b.categories, r.reviews
    FROM (SELECT * FROM business_v WHERE regexp_matches(categories, 'Chinese|Italian|Pizza')) b
    RIGHT JOIN (SELECT business_id, count(*) AS reviews FROM reviews_v GROUP BY 1) r
      ON b.business_id = r.business_id""")
def join_right(t):
    chosen = t.business.filter(F.col("categories").rlike("Chinese|Italian|Pizza"))
    reviews = t.review_texts.groupBy("business_id").agg(F.count(F.lit(1)).alias("reviews"))
    return chosen.select("business_id", "categories").join(reviews, "business_id", "right")


@query("join_composite", """
    WITH areas AS (SELECT neighbourhood, neighbourhood_group, min(feature_id) AS feature_id
                   FROM map_v GROUP BY 1, 2),
    prices AS (SELECT neighbourhood, neighbourhood_group, avg(price) AS price FROM listings_v GROUP BY 1, 2)
    SELECT a.neighbourhood, a.neighbourhood_group, a.feature_id, round(p.price, 4) AS price
    FROM areas a JOIN prices p ON a.neighbourhood = p.neighbourhood
                              AND a.neighbourhood_group = p.neighbourhood_group""")
def join_composite(t):
    place = ["neighbourhood", "neighbourhood_group"]
    areas = keep_first(t.map_features, place, ["feature_id"]).drop("area")
    prices = t.listings.groupBy(*place).agg(F.round(F.avg("price"), 4).alias("price"))
    return areas.join(prices, place)


@query("join_semi", """
    SELECT conv_id, turn, business_id, text FROM tips_v
    WHERE business_id IN (SELECT business_id FROM business_v WHERE contains(categories, 'Restaurants'))""")
def join_semi(t):
    chosen = t.business.filter(F.col("categories").contains("Restaurants"))
    return skew_join(t.tips, chosen.select("business_id"), ["business_id"], "left_semi")


@query("join_label_lookup", """
    SELECT l.doc_id, l.quality, array_to_string(y2, ',') AS labels FROM labels l JOIN food_v f ON f.vec_id = l.doc_id
    WHERE l.doc_id IN (SELECT vec_id FROM food_v)""")
def join_label_lookup(t):
    """Labels of the listed rows; the list is another table, cut to what the food table has, and a miss would fail."""
    listed = t.read("labels").select(F.col("doc_id").alias("vec_id"), "quality")
    listed = skew_join(listed, t.food.select("vec_id"), ["vec_id"], "left_semi")
    labels = t.food.select("vec_id", joined(F.col("y2")).alias("labels"))
    found = lookup_or_fail(listed, labels, "vec_id", "labels")
    return found.select(F.col("vec_id").alias("doc_id"), "quality", "labels")


@query("join_substring_exists", r"""
    WITH doc_words AS (
        SELECT unnest(regexp_split_to_array(regexp_replace(lower(regexp_replace(text, '[[:punct:]]', '', 'g')),
               '[0-9]', '', 'g'), '\s')) AS word FROM documents),
    counted AS (SELECT word, count(*) AS n FROM doc_words WHERE word <> '' GROUP BY 1),
    entries AS (
        SELECT DISTINCT word AS entry FROM (
            SELECT unnest(regexp_split_to_array(regexp_replace(lower(regexp_replace(text, '[[:punct:]]', '', 'g')),
                   '[0-9]', '', 'g'), '\s')) AS word FROM benchmark) WHERE length(word) >= 6)
    SELECT word, n, EXISTS (SELECT 1 FROM entries WHERE contains(word, entry)) AS tagged FROM counted""")
def join_substring_exists(t):
    words = each(t.documents, [], plain_words(F.col("text")), "word")
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    entries = each(t.read("benchmark"), [], plain_words(F.col("text")), "entry").filter(F.length("entry") >= 6)
    hits = containing_words(counted, "word", entries, "entry").withColumn("_hit", F.lit(True))
    return counted.join(hits, "word", "left").select(
        "word", "n", F.coalesce("_hit", F.lit(False)).alias("tagged")
    )


WORD_SQL = r"list_filter(regexp_split_to_array(lower(text), '\W'), lambda w: length(w) >= 4)"


@query("lookup_terms", f"""
    WITH words AS (SELECT stars, unnest({WORD_SQL}) AS word FROM reviews_v),
    vocabulary AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx
                   FROM (SELECT DISTINCT word FROM words)),
    ranked AS (SELECT stars, word, row_number() OVER (PARTITION BY stars ORDER BY count(*) DESC, word) AS rank
               FROM words GROUP BY 1, 2)
    SELECT r.stars, string_agg(CAST(v.idx AS VARCHAR), ',' ORDER BY r.rank) AS term_indices,
           string_agg(r.word, ',' ORDER BY r.rank) AS term_words
    FROM ranked r JOIN vocabulary v ON r.word = v.word WHERE r.rank <= 10 GROUP BY 1""")
def lookup_terms(t):
    """Topic-like rows hold term indices; the vocabulary gives the words back."""
    words = each(t.reviews, ["stars"], gap_tokens(F.col("text")), "word")
    vocabulary = with_ordinal(words.select("word").distinct(), [], ["word"], "ordinal").select(
        "word", (F.col("ordinal") - 1).alias("idx")
    )
    best = Window.partitionBy("stars").orderBy(F.desc("n"), "word")
    top = (
        words.groupBy("stars", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.row_number().over(best))
        .filter("rank <= 10")
    )
    indices = (
        top.join(vocabulary, "word")
        .groupBy("stars")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "idx"))), lambda e: e["idx"]).alias("indices"))
    )
    named = indices.select("stars", F.posexplode("indices").alias("pos", "idx")).join(vocabulary, "idx")
    ordered = F.sort_array(F.collect_list(F.struct("pos", "idx", "word")))
    return named.groupBy("stars").agg(ordered.alias("terms")).select(
        "stars", joined(F.col("terms.idx")).alias("term_indices"), joined(F.col("terms.word")).alias("term_words")
    )


@query("join_positional", """
    SELECT vec_id, CAST(p.pos - 1 AS INTEGER) AS idx, c.calories FROM (
        SELECT vec_id, unnest(y2) AS flag, generate_subscripts(y2, 1) AS pos FROM food_v) p
    JOIN calories_v c ON c.idx = p.pos - 1 WHERE p.flag = 1""")
def join_positional(t):
    reference = positional_array(t.calories, "idx", "calories", WIDTH)
    food = t.food.select("vec_id", "y2").withColumn("reference", reference.scalar())
    return food.select("vec_id", F.inline(picked(F.col("y2"), F.col("reference")))).select(
        "vec_id", "idx", F.col("value").alias("calories")
    )


@query("concat_columns", """
    SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def concat_columns(t):
    return t.documents.select("doc_id", "n_chars").join(t.read("labels"), "doc_id")


@query("area_price_top", f"""
    WITH {NEAR_SQL},
    areas AS (SELECT neighbourhood, neighbourhood_group, min(feature_id) AS feature_id FROM map_v GROUP BY 1, 2),
    prices AS (SELECT neighbourhood, neighbourhood_group, round(avg(price), 4) AS price FROM near GROUP BY 1, 2)
    SELECT a.neighbourhood, a.neighbourhood_group, a.feature_id, p.price
    FROM areas a JOIN prices p ON a.neighbourhood = p.neighbourhood
                              AND a.neighbourhood_group = p.neighbourhood_group
    ORDER BY p.price DESC, a.neighbourhood LIMIT 10""")
def area_price_top(t):
    """Outlier filter, mean price by area, join with the map, ten dearest areas."""
    place = ["neighbourhood", "neighbourhood_group"]
    near = listings_near_centre(t, *place, "price")
    prices = near.groupBy(*place).agg(F.round(F.avg("price"), 4).alias("price"))
    areas = keep_first(t.map_features, place, ["feature_id"]).drop("area")
    return areas.join(prices, place).orderBy(F.desc("price"), "neighbourhood").limit(10)
