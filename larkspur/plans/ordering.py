"""Windows, sorting, sampling, splitting and set operations."""

from pyspark.sql import functions as F

from larkspur.functions.arrays import each, positional_array, top_scores
from larkspur.functions.text import phrase_count, plain_words, sentence_tokens, token_sentences
from larkspur.operators.chunks import with_ordinal
from larkspur.operators.grouping import keep_first, repeated_rows
from larkspur.operators.joins import with_group_values
from larkspur.operators.sampling import hash_bucket, oversample, sample_rows, slice_rows, split_by_hash
from larkspur.operators.skew import skew_join
from larkspur.plans.aggregates import PLAIN_SQL, SENTENCE_SQL
from larkspur.plans.registry import query
from larkspur.plans.views import WIDTH


@query("window_group_transform", """
    SELECT review_id, business_id, count(*) OVER (PARTITION BY business_id) AS reviews,
           round(avg(stars) OVER (PARTITION BY business_id), 6) AS mean_stars FROM reviews_v""")
def window_group_transform(t):
    rows = t.reviews.select("review_id", "business_id", "stars")
    return with_group_values(
        rows, ["business_id"], reviews=F.count(F.lit(1)), mean_stars=F.round(F.avg("stars"), 6)
    ).drop("stars")


@query("segment_sentences", f"""
    WITH parts AS (SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS no
                   FROM (SELECT doc_id, {SENTENCE_SQL} AS s FROM documents))
    SELECT doc_id, CAST(no - 1 AS INTEGER) AS sentence,
           array_to_string(list_append({PLAIN_SQL.format('s')}, '.'), ' ') AS words FROM parts""")
def segment_sentences(t):
    cut = each(t.documents, ["doc_id"], token_sentences(sentence_tokens(F.col("text"))), "words", "sentence")
    return cut.withColumn("words", F.array_join("words", " "))


WORD = r"[^\p{L}\p{N}_]"
ARGMAX_SQL = rf"""
    WITH spaced AS (SELECT business_id, regexp_replace(text, '({WORD})', '\1\1', 'g') AS text FROM reviews_v
                    UNION ALL
                    SELECT business_id, regexp_replace(text, '({WORD})', '\1\1', 'g') FROM tips_v),
    candidates AS (SELECT business_id, unnest(c) AS theme, generate_subscripts(c, 1) AS pos
                   FROM (SELECT business_id, string_split(themes, ',') AS c FROM business_v)),
    counted AS (
        SELECT c.business_id, c.theme, c.pos, CAST(coalesce(sum(len(regexp_extract_all(s.text,
               '(?:^|{WORD})' || replace(c.theme, ' ', '  ') || '(?:$|{WORD})'))), 0) AS BIGINT) AS n
        FROM candidates c JOIN spaced s ON s.business_id = c.business_id GROUP BY 1, 2, 3)
    SELECT business_id, theme AS class, n FROM (
        SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY n DESC, pos) AS rank FROM counted)
    WHERE rank = 1"""


@query("argmax_category", ARGMAX_SQL)
def argmax_category(t):
    """The candidate found most often in a business's texts; the first one on a tie or without a hit.

    Texts are counted one by one and only the counts are brought together.
    """
    themes = t.business.select("business_id", F.split("themes", ",").alias("themes"))
    texts = t.review_texts.select("business_id", "text").union(t.tips.select("business_id", "text"))
    matched = skew_join(texts, themes, ["business_id"])
    counts = matched.select(
        "business_id",
        F.posexplode("themes").alias("pos", "class"),
        "text",
    ).select("business_id", "pos", "class", phrase_count(F.col("text"), F.col("class")).alias("n"))
    totals = counts.groupBy("business_id", "pos", "class").agg(F.sum("n").alias("n"))
    best = F.max(F.struct("n", (-F.col("pos")).alias("minus"), "class")).alias("best")
    return totals.groupBy("business_id").agg(best).select("business_id", "best.class", "best.n")


@query("topk_scores", """
    WITH cells AS (SELECT vec_id, unnest(scores) AS score, generate_subscripts(scores, 1) - 1 AS idx FROM food_v),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, idx) AS rank FROM cells)
    SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(ranked.idx AS INTEGER) AS idx, round(score, 6) AS score,
           name FROM ranked JOIN calories_v c ON c.idx = ranked.idx WHERE rank <= 5""")
def topk_scores(t):
    """Top five of each row's scores with the name of the position; ranked inside the row."""
    names = positional_array(t.calories, "idx", "name", WIDTH)
    scored = t.food.select("vec_id", "scores").withColumn("names", names.scalar())
    rows = scored.select("vec_id", "names", F.posexplode(top_scores(F.col("scores"), 5)).alias("at", "hit"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("rank"),
        "hit.idx",
        F.round("hit.score", 6).alias("score"),
        F.get("names", F.col("hit.idx")).alias("name"),
    )


WORDS_SQL = f"SELECT DISTINCT unnest({PLAIN_SQL.format('text')}) AS word FROM documents"


@query("index_assign", f"""
    SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM ({WORDS_SQL})""")
def index_assign(t):
    words = each(t.documents, [], plain_words(F.col("text")), "word").distinct()
    return with_ordinal(words, [], ["word"]).select("word", (F.col("ordinal") - 1).alias("idx"))


@query("top_n", """
    SELECT neighbourhood, room_type, count(*) AS n FROM listings_v GROUP BY 1, 2
    ORDER BY n DESC, neighbourhood, room_type LIMIT 20""")
def top_n(t):
    counts = t.listings.groupBy("neighbourhood", "room_type").agg(F.count("id").alias("n"))
    return counts.orderBy(F.desc("n"), "neighbourhood", "room_type").limit(20)


@query("head_n", "SELECT id, neighbourhood, price FROM listings_v ORDER BY id LIMIT 5")
def head_n(t):
    return t.listings.select("id", "neighbourhood", "price").orderBy("id").limit(5)


@query("sample_n", """
    SELECT id, price, last_review FROM listings_v WHERE last_review IS NOT NULL
    ORDER BY md5('0' || CAST(id AS VARCHAR)), id LIMIT 5""")
def sample_n(t):
    dated = t.listings.select("id", "price", "last_review").na.drop(subset=["last_review"])
    return sample_rows(dated, "id", 5, seed=0)


@query("split_hash", """
    SELECT review_id, CASE WHEN b < 80 THEN 'train' ELSE 'test' END AS part FROM (
        SELECT review_id, ('0x' || substr(md5('1' || CAST(review_id AS VARCHAR)), 1, 8))::UBIGINT % 100 AS b
        FROM reviews_v)""")
def split_hash(t):
    train, test = split_by_hash(t.review_texts.select("review_id"), "review_id", [80, 20], seed=1)
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query("split_buckets", """
    SELECT bucket, count(*) AS n FROM (
        SELECT CAST(('0x' || substr(md5('10' || CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT % 100 AS BIGINT)
               AS bucket FROM orders) GROUP BY 1""")
def split_buckets(t):
    """Size of each of the hundred split buckets."""
    bucket = hash_bucket(F.col("o_orderkey"), 10).alias("bucket")
    return t.read("orders").groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


@query("split_by_list", """
    SELECT vec_id, path, CASE WHEN quality = 1 THEN 'train' ELSE 'test' END AS part
    FROM food_v JOIN (SELECT DISTINCT doc_id, quality FROM labels) ON doc_id = vec_id""")
def split_by_list(t):
    """Rows that stand in a list with its part; the list is another table, and rows it does not name are left out."""
    listed = t.read("labels").select(F.col("doc_id").alias("vec_id"), "quality").distinct()
    part = F.when(F.col("quality") == 1, "train").otherwise("test").alias("part")
    rows = t.food.select("vec_id", "path")
    return skew_join(rows, listed.select("vec_id", part), ["vec_id"]).select("vec_id", "path", "part")


@query("slice_rows", """
    WITH r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS place, count(*) OVER () AS n FROM food_v)
    SELECT 'head' AS piece, vec_id FROM r WHERE place < 90
    UNION ALL SELECT 'tail', vec_id FROM r WHERE place >= n - 60""")
def slices(t):
    """Three whole batches of 30 from the front, two from the end."""
    rows = t.food.select("vec_id")
    head = slice_rows(rows, ["vec_id"], None, 3 * 30).select(F.lit("head").alias("piece"), "vec_id")
    tail = slice_rows(rows, ["vec_id"], -2 * 30, None).select(F.lit("tail").alias("piece"), "vec_id")
    return head.union(tail)


@query("oversample_minority", """
    SELECT vec_id, y3, CAST(c AS INTEGER) AS copy_no
    FROM (SELECT vec_id, y3, unnest(CASE WHEN y3 = 0 THEN [1, 2, 3, 4, 5] ELSE [1] END) AS c FROM food_v)""")
def oversample_minority(t):
    return oversample(t.food.select("vec_id", "y3"), F.col("y3") == 0, 5)


@query("drop_duplicates_all", "SELECT DISTINCT business_id, lang, stars FROM reviews_v")
def drop_duplicates_all(t):
    return t.reviews.select("business_id", "lang", "stars").dropDuplicates()


@query("drop_duplicates_key", """
    SELECT neighbourhood, neighbourhood_group, feature_id, area FROM (
        SELECT *, row_number() OVER (PARTITION BY neighbourhood, neighbourhood_group ORDER BY feature_id) AS rn
        FROM map_v) WHERE rn = 1""")
def drop_duplicates_key(t):
    return keep_first(t.map_features, ["neighbourhood", "neighbourhood_group"], ["feature_id"])


@query("report_duplicates", """
    SELECT neighbourhood, neighbourhood_group, feature_id, area FROM (
        SELECT *, row_number() OVER (PARTITION BY neighbourhood, neighbourhood_group ORDER BY feature_id) AS rn
        FROM map_v) WHERE rn > 1""")
def report_duplicates(t):
    return repeated_rows(t.map_features, ["neighbourhood", "neighbourhood_group"], ["feature_id"])


@query("label_set_overlap", """
    SELECT vec_id, CAST(len(list_intersect(a, p)) AS INTEGER) AS shared,
           CAST(len(list_distinct(list_concat(a, p))) AS INTEGER) AS either FROM (
        SELECT vec_id, list_filter(range(1, 65), lambda i: y2[i] = 1) AS a,
               list_filter(range(1, 65), lambda i: embedding[i] > 0.05e0) AS p FROM food_v)""")
def label_set_overlap(t):
    places = F.sequence(F.lit(1), F.size("y2"))
    actual = F.filter(places, lambda i: F.element_at("y2", i) == 1)
    wide = F.col("embedding").cast("array<double>")
    predicted = F.filter(places, lambda i: F.element_at(wide, i) > 0.05)
    sets = t.food.select("vec_id", actual.alias("a"), predicted.alias("p"))
    return sets.select(
        "vec_id",
        F.size(F.array_intersect("a", "p")).alias("shared"),
        F.size(F.array_union("a", "p")).alias("either"),
    )
