"""String, text, date and math functions."""

from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.functions.arrays import at_least, joined
from larkspur.plans.aggregates import PLAIN_SQL, SENTENCE_SQL, STOP_SQL
from larkspur.plans.joins import WORD_SQL
from larkspur.plans.ordering import WORD
from larkspur.plans.registry import query

ALLOWED = ["Chinese", "Italian", "Thai", "Pizza"]
ALLOWED_SQL = "('Chinese', 'Italian', 'Thai', 'Pizza')"
CONFINED = ["Chinese", "Fast Food", "Italian", "Pizza", "Sandwiches"]
CONFINED_SQL = "('Chinese', 'Fast Food', 'Italian', 'Pizza', 'Sandwiches')"


@query("split_list", """
    SELECT business_id, unnest(string_split(categories, ',')) AS part FROM business_v
    WHERE categories IS NOT NULL""")
def split_list(t):
    named = t.business.na.drop(subset=["categories"])
    return named.select("business_id", F.explode(F.split("categories", ",")).alias("part"))


@query("split_trim", """
    SELECT business_id, array_to_string(list_transform(string_split(categories, ','), lambda p: trim(p, ' ')), '|')
           AS parts FROM business_v""")
def split_trim(t):
    return t.business.select("business_id", F.array_join(tx.split_trim(F.col("categories")), "|").alias("parts"))


@query("assign_labels", f"""
    SELECT business_id, CASE WHEN kept = '' THEN 'other' ELSE kept END AS label FROM (
        SELECT business_id, array_to_string(list_filter(list_transform(string_split(categories, ','),
               lambda p: trim(p, ' ')), lambda p: p IN {ALLOWED_SQL}), ',') AS kept
        FROM business_v WHERE categories IS NOT NULL)""")
def assign_labels(t):
    named = t.business.na.drop(subset=["categories"])
    label = tx.keep_listed(tx.split_trim(F.col("categories")), ALLOWED, default="other")
    return named.select("business_id", label.alias("label"))


@query("confined_labels", f"""
    SELECT business_id, array_to_string(list_filter(list_transform(string_split(categories, ','),
           lambda p: trim(p, ' ')), lambda p: p IN {CONFINED_SQL}), ',') AS labels
    FROM business_v WHERE categories IS NOT NULL""")
def confined_labels(t):
    named = t.business.na.drop(subset=["categories"])
    return named.select(
        "business_id", tx.keep_listed(tx.split_trim(F.col("categories")), CONFINED).alias("labels")
    )


@query("whole_word_count", rf"""
    SELECT review_id, len(regexp_extract_all(regexp_replace(text, '({WORD})', '\1\1', 'g'),
           '(?:^|{WORD})des  la(?:$|{WORD})')) AS des_la,
           len(regexp_extract_all(regexp_replace(text, '({WORD})', '\1\1', 'g'), '(?:^|{WORD})that(?:$|{WORD})'))
           AS that
    FROM reviews_v""")
def whole_word_count(t):
    count = lambda phrase: tx.phrase_count(F.col("text"), F.lit(phrase)).cast("bigint")
    return t.review_texts.select("review_id", count("des la").alias("des_la"), count("that").alias("that"))


@query("lower_text", "SELECT item_id, lower(text) AS text FROM benchmark")
def lower_text(t):
    return t.read("benchmark").select("item_id", F.lower("text").alias("text"))


@query("strip_punct", "SELECT doc_id, regexp_replace(text, '[[:punct:]]', '', 'g') AS text FROM documents")
def strip_punct(t):
    return t.documents.select("doc_id", tx.strip_punctuation(F.col("text")).alias("text"))


@query("strip_digits", "SELECT doc_id, regexp_replace(text, '[0-9]', '', 'g') AS text FROM documents")
def strip_digits(t):
    return t.documents.select("doc_id", tx.strip_digits(F.col("text")).alias("text"))


@query("ws_tokens", f"SELECT doc_id, array_to_string({PLAIN_SQL.format('text')}, ' ') AS tokens FROM documents")
def ws_tokens(t):
    return t.documents.select("doc_id", F.array_join(tx.plain_words(F.col("text")), " ").alias("tokens"))


@query("field_extract", """
    SELECT conv_id, turn, split_part(text, ' ', 1) AS first, split_part(text, ' ', 2) AS second
    FROM conversations""")
def field_extract(t):
    fields = F.split("text", " ")
    return t.conversations.select(
        "conv_id", "turn", fields[0].alias("first"), F.coalesce(F.get(fields, 1), F.lit("")).alias("second")
    )


@query("regex_tokens", f"SELECT review_id, array_to_string({WORD_SQL}, ' ') AS tokens FROM reviews_v")
def regex_tokens(t):
    return t.review_texts.select("review_id", F.array_join(tx.gap_tokens(F.col("text")), " ").alias("tokens"))


KEPT_SQL = f"list_filter({WORD_SQL}, lambda w: w NOT IN {STOP_SQL})"


@query("remove_stopwords", f"SELECT review_id, array_to_string({KEPT_SQL}, ' ') AS tokens FROM reviews_v")
def remove_stopwords(t):
    tokens = tx.remove_words(tx.gap_tokens(F.col("text")))
    return t.review_texts.select("review_id", F.array_join(tokens, " ").alias("tokens"))


@query("strip_accents", "SELECT review_id, strip_accents(text) AS text FROM reviews_v")
def strip_accents(t):
    return t.review_texts.select("review_id", tx.strip_accents(F.col("text")).alias("text"))


@query("word_tokens", r"""
    SELECT review_id, array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}'), ' ') AS tokens
    FROM reviews_v""")
def word_tokens(t):
    return t.review_texts.select("review_id", F.array_join(tx.word_tokens(F.col("text")), " ").alias("tokens"))


MARKED_SQL = f"""array_to_string(list_transform({SENTENCE_SQL}, lambda s:
    array_to_string(list_concat(['sentence_start'], list_append({PLAIN_SQL.format('s')}, '.')), ' ')), ' ')"""


@query("sentence_tokens", f"SELECT doc_id, {MARKED_SQL} AS tokens FROM documents")
def sentence_tokens(t):
    return t.documents.select(
        "doc_id", F.array_join(tx.sentence_tokens(F.col("text")), " ").alias("tokens")
    )


@query("path_class", "SELECT path, CAST(split_part(path, '/', 2) AS INTEGER) AS class_id FROM food_v")
def path_class(t):
    return t.food.select("path", F.get(F.split("path", "/"), 1).try_cast("int").alias("class_id"))


@query("pad_tokens", f"""
    SELECT doc_id, array_to_string(list_concat({PLAIN_SQL.format('text')},
           list_transform(range(0, 52), lambda i: 'PADword'))[1:52], ' ') AS tokens FROM documents""")
def pad_tokens(t):
    padded = tx.pad(tx.plain_words(F.col("text")), 52, "PADword")
    return t.documents.select("doc_id", F.array_join(padded, " ").alias("tokens"))


@query("pad_labels", f"""
    SELECT doc_id, array_to_string(list_concat(list_transform({PLAIN_SQL.format('text')},
           lambda w: CASE WHEN contains(w, 'tion') THEN 1 ELSE 0 END),
           list_transform(range(0, 52), lambda i: 0))[1:52], '') AS labels FROM documents""")
def pad_labels(t):
    flags = F.transform(tx.plain_words(F.col("text")), lambda w: w.contains("tion").cast("int"))
    return t.documents.select("doc_id", joined(tx.pad(flags, 52, 0), "").alias("labels"))


@query("parse_date", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS day FROM orders""")
def parse_date(t):
    """Dates arrive as text; text that is no date becomes null."""
    texts = t.read("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"))
    return texts.select("o_orderkey", F.try_to_date("text", "yyyy-MM-dd").alias("day"))


@query("date_parts", """
    SELECT id, CAST(year(last_review) AS INTEGER) AS year, CAST(month(last_review) AS INTEGER) AS month
    FROM listings_v WHERE last_review IS NOT NULL""")
def date_parts(t):
    dated = t.listings.select("id", "last_review").na.drop()
    return dated.select("id", F.year("last_review").alias("year"), F.month("last_review").alias("month"))


@query("weekday_name", """
    SELECT id, strftime(last_review, '%A') AS weekday FROM listings_v WHERE last_review IS NOT NULL""")
def weekday_name(t):
    dated = t.listings.select("id", "last_review").na.drop()
    return dated.select("id", F.date_format("last_review", "EEEE").alias("weekday"))


@query("log_price", """
    SELECT id, round(CASE WHEN price - 1000 > 0 THEN ln(price - 1000) END, 6) AS log_price FROM listings_v""")
def log_price(t):
    """Logarithm, null at zero and below."""
    return t.listings.select("id", F.round(F.ln(F.col("price") - 1000), 6).alias("log_price"))


@query("threshold_scores", """
    SELECT vec_id, array_to_string(list_transform(scores, lambda s: CASE WHEN s >= 0.5e0 THEN 1 ELSE 0 END), '')
           AS flags FROM food_v""")
def threshold_scores(t):
    return t.food.select("vec_id", joined(at_least(F.col("scores")), "").alias("flags"))
