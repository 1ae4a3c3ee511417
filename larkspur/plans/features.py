"""Text features in long form, word selection, sentiment, tagging, scaling, naive Bayes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.functions.arrays import each
from larkspur.learning import terms
from larkspur.operators.joins import containing_words
from larkspur.operators.sampling import hash_bucket, split_by_hash
from larkspur.operators.skew import skew_join
from larkspur.plans.files import LEXICON
from larkspur.plans.registry import query
from larkspur.plans.texts import KEPT_SQL, MARKED_SQL
from larkspur.session import materialize, scratch_path
from larkspur.sources import scan

COUNTS_SQL = f"""
    tokens AS (SELECT review_id, unnest({KEPT_SQL}) AS term FROM reviews_v),
    counts AS (SELECT review_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2)"""
TRAIN_SQL = "('0x' || substr(md5('1' || CAST(review_id AS VARCHAR)), 1, 8))::UBIGINT % 100 < 80"


def review_counts(t):
    kept = tx.remove_words(tx.gap_tokens(F.col("text")))
    return terms.term_counts(t.review_texts.select("review_id", kept.alias("tokens")), "review_id", "tokens")


def in_train():
    return hash_bucket(F.col("review_id"), 1) < 80


@query("count_vectorize", f"""
    WITH {COUNTS_SQL},
    vocabulary AS (SELECT term, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS idx
                   FROM counts WHERE {TRAIN_SQL} GROUP BY term)
    SELECT review_id, c.term, idx, tf FROM counts c JOIN vocabulary v ON v.term = c.term""")
def count_vectorize(t):
    """Vocabulary of the training part, used on all reviews."""
    counts = review_counts(t)
    vocabulary = terms.fit_vocabulary(counts.filter(in_train()))
    return terms.count_vectorize(counts, vocabulary).select("review_id", "term", "idx", "tf")


def _idf_sql(expression, fit="true"):
    return f"""WITH {COUNTS_SQL}, n AS (SELECT count(*) AS n FROM reviews_v WHERE {fit}),
    idf AS (SELECT term, {expression} AS idf FROM counts, n WHERE {fit} GROUP BY term, n.n),
    weights AS (SELECT review_id, c.term, tf * idf AS weight FROM counts c JOIN idf ON idf.term = c.term)"""


@query("tfidf_mllib", _idf_sql("ln((n.n + 1.0e0) / (count(*) + 1))") + """
    SELECT review_id, term, round(weight, 6) AS weight FROM weights""")
def tfidf_mllib(t):
    weights = terms.with_idf(review_counts(t), t.review_texts, smooth=False)
    return weights.select("review_id", "term", F.round("weight", 6).alias("weight"))


def _unit_sql(fit="true"):
    return _idf_sql("ln((n.n + 1.0e0) / (count(*) + 1)) + 1", fit) + """,
    unit AS (SELECT review_id, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY review_id)) AS weight
             FROM weights)"""


UNIT_SQL = _unit_sql()


def unit_weights(t, fit_on="all"):
    """Weights of all reviews; document frequencies from all of them or from the training part."""
    fit = in_train() if fit_on == "train" else None
    weights = terms.with_idf(review_counts(t), t.review_texts, smooth=True, fit=fit)
    return terms.unit_length(weights, "review_id")


@query("tfidf_l2", UNIT_SQL + " SELECT review_id, term, round(weight, 6) AS weight FROM unit")
def tfidf_l2(t):
    return unit_weights(t).select("review_id", "term", F.round("weight", 6).alias("weight"))


def _chi2_sql(fit="true"):
    return _unit_sql(fit) + f""",
    fitted AS (SELECT * FROM reviews_v WHERE {fit}),
    share AS (SELECT stars, count(*) * 1.0e0 / (SELECT count(*) FROM fitted) AS share FROM fitted GROUP BY 1),
    mass AS (SELECT term, sum(weight) AS mass FROM unit WHERE {fit} GROUP BY 1),
    observed AS (SELECT u.term, r.stars, sum(weight) AS o FROM unit u JOIN fitted r ON r.review_id = u.review_id
                 GROUP BY 1, 2),
    chi AS (SELECT m.term, round(sum((coalesce(o.o, 0) - mass * share) * (coalesce(o.o, 0) - mass * share)
                   / (mass * share)), 6) AS chi2
            FROM mass m CROSS JOIN share s LEFT JOIN observed o ON o.term = m.term AND o.stars = s.stars GROUP BY 1)"""


CHI2_SQL = _chi2_sql()


@query("chi2_select", CHI2_SQL + """
    SELECT 'body_' || term AS feature, round(chi2, 4) AS chi2,
           row_number() OVER (ORDER BY chi2 DESC, term) AS rank FROM chi QUALIFY rank <= 500""")
def chi2_select(t):
    """The 500 terms that tell the star classes apart best, with prefixed names."""
    classes = t.reviews.select("review_id", "stars")
    weights = terms.with_classes(unit_weights(t), classes, "review_id", "stars")
    scores = terms.chi2_scores(weights, classes, "review_id", "stars")
    best = terms.k_best(scores, 500)
    return best.select(F.concat(F.lit("body_"), "term").alias("feature"), F.round("chi2", 4).alias("chi2"), "rank")


def star_classes(t, fit_on="all"):
    classes = t.reviews.select("review_id", "stars")
    return classes.filter(in_train()) if fit_on == "train" else classes


def chi2_ranks(t, weights, k, fit_on="all"):
    """The ``k`` best terms, by all reviews or by the training part; ``weights`` hold the classes of that part."""
    classes = star_classes(t, fit_on)
    scores = terms.chi2_scores(weights, classes, "review_id", "stars")
    return materialize(terms.k_best(scores, k), "ranks")


SWEEP = list(range(100, 701, 100))


@query("chi2_k_sweep", _chi2_sql(TRAIN_SQL) + f""",
    ranked AS (SELECT term, row_number() OVER (ORDER BY chi2 DESC, term) AS rank FROM chi QUALIFY rank <= 700),
    bounds AS (SELECT u.term, rank, CASE WHEN count(*) < (SELECT count(*) FROM fitted) THEN least(min(weight), 0)
               ELSE min(weight) END AS low, max(weight) AS high FROM unit u JOIN ranked r ON r.term = u.term
               WHERE {TRAIN_SQL} GROUP BY 1, 2),
    scaled AS (SELECT review_id, u.term, rank, coalesce((weight - low) / nullif(high - low, 0), 0) AS w
               FROM unit u JOIN bounds b ON b.term = u.term),
    ks AS (SELECT unnest(range(100, 701, 100)) AS k),
    train AS (SELECT review_id, stars FROM reviews_v WHERE {TRAIN_SQL}),
    masses AS (SELECT term, rank, stars, sum(w) AS mass FROM scaled s JOIN train t ON t.review_id = s.review_id
               GROUP BY 1, 2, 3),
    prior AS (SELECT stars, ln(count(*) * 1.0e0 / (SELECT count(*) FROM train)) AS prior FROM train GROUP BY 1),
    totals AS (SELECT k, p.stars, prior, ln(coalesce(sum(mass) FILTER (WHERE rank <= k), 0) + k) AS log_all
               FROM ks CROSS JOIN prior p LEFT JOIN masses m ON m.stars = p.stars GROUP BY 1, 2, 3),
    lengths AS (SELECT review_id, k, sum(w) AS w FROM scaled, ks WHERE rank <= k GROUP BY 1, 2),
    gains AS (SELECT review_id, k, m.stars, sum(w * ln(mass + 1)) AS g
              FROM scaled s JOIN masses m ON m.term = s.term JOIN ks ON s.rank <= k GROUP BY 1, 2, 3),
    scored AS (SELECT r.review_id, r.stars, t.k, t.stars AS class,
                      round(prior + coalesce(g, 0) - coalesce(w, 0) * log_all, 6) AS s
               FROM reviews_v r CROSS JOIN totals t LEFT JOIN lengths l ON l.review_id = r.review_id AND l.k = t.k
               LEFT JOIN gains g ON g.review_id = r.review_id AND g.k = t.k AND g.stars = t.stars),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY review_id, k ORDER BY s DESC, class) = 1)
    SELECT k, CASE WHEN {TRAIN_SQL} THEN 'train' ELSE 'test' END AS part,
           round(avg(CASE WHEN class = stars THEN 1.0e0 ELSE 0.0e0 END), 6) AS accuracy FROM best GROUP BY 1, 2""")
def chi2_k_sweep(t):
    """Accuracy of naive Bayes on the best 100, 200, ... 700 scaled terms, train and test.

    Document frequencies, choice and scaling are those of the training part.

    One pass serves all sizes: a term's gain goes to its rank's block of 100,
    and the blocks add up to the score of each size.
    """
    reviews = t.reviews.select("review_id", "stars")
    classes = star_classes(t, "train")
    weights = materialize(terms.with_classes(unit_weights(t, "train"), classes, "review_id", "stars"), "tfidf")
    chosen = chi2_ranks(t, weights, SWEEP[-1], "train")
    ranks = F.broadcast(chosen.select("term", "rank"))  # 700 rows
    picked = weights.join(ranks, "term", "left_semi")
    scaled = materialize(terms.min_max_terms(picked, t.reviews, "review_id", in_train()).join(ranks, "term"), "scaled")
    train, _ = split_by_hash(reviews, "review_id", [80, 20], seed=1)
    train = materialize(train, "train")
    blocks = scaled.withColumn("block", F.floor((F.col("rank") - 1) / 100))
    masses = materialize(
        blocks.join(train, "review_id").groupBy("block", "term", "stars").agg(F.sum("weight").alias("mass")), "masses"
    )
    docs = train.agg(F.count(F.lit(1))).scalar()
    priors = train.groupBy("stars").agg(F.ln(F.count(F.lit(1)) / docs).alias("prior"))
    upto = Window.partitionBy("stars").orderBy("block")
    # classes times seven blocks
    totals = (
        priors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(len(SWEEP) - 1)).cast("array<bigint>")))
        .join(masses.groupBy("block", "stars").agg(F.sum("mass").alias("mass")), ["block", "stars"], "left")
        .withColumn("all", F.sum(F.coalesce("mass", F.lit(0.0))).over(upto))
        .select("block", "stars", "prior", F.ln(F.col("all") + (F.col("block") + 1) * 100).alias("log_all"))
        .groupBy("block")
        .agg(F.collect_list(F.struct("stars", "prior", "log_all")).alias("classes"))
    )
    gains = masses.groupBy("term").agg(
        F.collect_list(F.struct("stars", F.ln(F.col("mass") + 1).alias("gain"))).alias("gains")
    )
    plain = F.array(F.struct(F.lit(None).cast("double").alias("stars"), F.lit(1.0).alias("gain")))
    parts = (
        blocks.join(F.broadcast(gains), "term", "left")  # 700 rows
        .withColumn("gains", F.concat(F.coalesce("gains", F.array().cast("array<struct<stars:double,gain:double>>")), plain))
        .select("review_id", "block", "weight", F.inline("gains"))
        .groupBy("review_id", "block", F.col("stars").alias("class"))
        .agg(F.sum(F.col("weight") * F.col("gain")).alias("s"))
        .groupBy("review_id")
        .agg(F.collect_list(F.struct("block", "class", "s")).alias("parts"))
    )

    def upto_block(test):
        kept = F.filter("parts", lambda p: (p["block"] <= F.col("block")) & test(p))
        return F.aggregate(kept, F.lit(0.0), lambda a, p: a + p["s"])

    spread = reviews.join(parts, "review_id", "left").withColumn(
        "parts", F.coalesce("parts", F.array().cast("array<struct<block:bigint,class:double,s:double>>"))
    )
    table = totals.agg(F.collect_list(F.struct("block", "classes")).alias("t"))
    scored = spread.withColumn("t", table.scalar()).select("review_id", "stars", "parts", F.inline("t"))
    weight = upto_block(lambda p: p["class"].isNull())
    best = F.array_max(
        F.transform(
            "classes",
            lambda c: F.struct(
                F.round(
                    c["prior"] + upto_block(lambda p: p["class"] == c["stars"]) - weight * c["log_all"], 6
                ).alias("s"),
                (-c["stars"]).alias("minus"),
            ),
        )
    )
    hit = (-best["minus"] == F.col("stars")).cast("double")
    part = F.when(hash_bucket(F.col("review_id"), 1) < 80, "train").otherwise("test")
    return (
        scored.select(((F.col("block") + 1) * 100).alias("k"), part.alias("part"), hit.alias("hit"))
        .groupBy("k", "part")
        .agg(F.round(F.avg("hit"), 6).alias("accuracy"))
    )


def _list_sql(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


NOUN_SQL = f"""((w IN {_list_sql(tx.NOUN_WORDS)} OR regexp_matches(w, '({"|".join(tx.NOUN_SUFFIXES)})$'))
    AND w NOT IN {_list_sql(tx.ADJECTIVE_WORDS)})"""
ADJ_SQL = f"""((w IN {_list_sql(tx.ADJECTIVE_WORDS)} OR regexp_matches(w, '({"|".join(tx.ADJECTIVE_SUFFIXES)})$'))
    AND w NOT IN {_list_sql(tx.NOUN_WORDS)})"""


def _select_sql(test):
    return f"CASE WHEN len(k) = 0 THEN ['na'] ELSE list_filter(k, lambda w: {test}) END"


@query("select_pos_tokens", f"""
    SELECT review_id, array_to_string({_select_sql(NOUN_SQL)}, ' ') AS nouns,
           array_to_string({_select_sql(ADJ_SQL)}, ' ') AS adjectives,
           array_to_string({_select_sql(NOUN_SQL + ' OR ' + ADJ_SQL)}, ' ') AS both
    FROM (SELECT review_id, {KEPT_SQL} AS k FROM reviews_v)""")
def select_pos_tokens(t):
    kept = t.review_texts.select("review_id", tx.remove_words(tx.gap_tokens(F.col("text"))).alias("k"))
    words = lambda kind: F.array_join(tx.select_words(F.col("k"), kind), " ")
    return kept.select(
        "review_id",
        words("noun").alias("nouns"),
        words("adjective").alias("adjectives"),
        words("noun_adjective").alias("both"),
    )


POLARITY_SQL = (
    "CASE "
    + " ".join(f"WHEN w IN {_list_sql(words)} THEN {value}" for value, words in tx.POLARITY_WORDS.items())
    + " "
    + " ".join(f"WHEN regexp_matches(w, '^({'|'.join(p)})') THEN {value}" for value, p in tx.POLARITY_PREFIXES.items())
    + " "
    + " ".join(f"WHEN regexp_matches(w, '({'|'.join(p)})$') THEN {value}" for value, p in tx.POLARITY_SUFFIXES.items())
    + " ELSE 2 END"
)
SCORED_SQL = f"""SELECT review_id, list_transform({_select_sql(ADJ_SQL)}, lambda w: {POLARITY_SQL}) AS s
    FROM (SELECT review_id, {KEPT_SQL} AS k FROM reviews_v)"""


def adjective_scores(t):
    words = tx.select_words(tx.remove_words(tx.gap_tokens(F.col("text"))), "adjective")
    return t.review_texts.select("review_id", words.alias("words"))


@query("word_sentiment", "SELECT review_id, "
    + ", ".join(f"CAST(len(list_filter(s, lambda v: v = {v})) AS DOUBLE) AS n{v}" for v in range(5))
    + f", round(CASE WHEN len(s) = 0 THEN -1.0e0 ELSE list_sum(s) * 1.0e0 / len(s) END, 6) AS mean FROM ({SCORED_SQL})")
def word_sentiment(t):
    """Scores of the adjectives of each review as a fixed-size histogram and their mean."""
    found = adjective_scores(t).select("review_id", tx.polarity_histogram(F.col("words")).alias("h"))
    counts = [F.col("h")[v].alias(f"n{v}") for v in range(5)]
    return found.select("review_id", *counts, F.round(F.col("h")[5], 6).alias("mean"))


@query("doc_sentiment", f"""
    SELECT review_id, CASE WHEN len(s) = 0 THEN -1 ELSE CAST(floor(list_sum(s) * 1.0e0 / len(s) + 0.5e0) AS INTEGER) END
           AS sentiment FROM ({SCORED_SQL})""")
def doc_sentiment(t):
    return adjective_scores(t).select("review_id", tx.document_polarity(F.col("words")).alias("sentiment"))


LEXICON_TEST = " OR ".join(f"contains(w, '{entry}')" for entry in LEXICON)


@query("tag_entities", f"""
    SELECT doc_id, array_to_string(list_transform(string_split({MARKED_SQL}, ' '),
           lambda w: w || CASE WHEN {LEXICON_TEST} THEN ' B-OTH' ELSE ' O' END), chr(10)) AS tagged
    FROM documents WHERE len({MARKED_SQL}) > 0
    UNION ALL SELECT doc_id, '' FROM documents WHERE len({MARKED_SQL}) = 0""")
def tag_entities(t):
    """Every document as 'word tag' lines, tagged inside its row."""
    tag = lambda w: F.when(tx.has_entry(w, LEXICON), tx.ENTITY).otherwise(tx.OTHER)
    lines = F.transform(tx.sentence_tokens(F.col("text")), lambda w: F.concat_ws(" ", w, tag(w)))
    return t.documents.select("doc_id", F.array_join(lines, "\n").alias("tagged"))


@query("tag_by_lexicon", r"""
    WITH d AS (SELECT doc_id, string_split(""" + MARKED_SQL + r""", ' ') AS w FROM documents WHERE len(""" + MARKED_SQL + r""") > 0),
    tokens AS (SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word FROM d),
    entries AS (SELECT DISTINCT word AS entry FROM (
        SELECT unnest(regexp_split_to_array(regexp_replace(lower(regexp_replace(text, '[[:punct:]]', '', 'g')),
               '[0-9]', '', 'g'), '\s')) AS word FROM benchmark) WHERE length(word) >= 6),
    hits AS (SELECT word FROM (SELECT DISTINCT word FROM tokens) WHERE EXISTS (SELECT 1 FROM entries WHERE contains(word, entry)))
    SELECT doc_id, pos, t.word, CASE WHEN h.word IS NULL THEN 'O' ELSE 'B-OTH' END AS label
    FROM tokens t LEFT JOIN hits h ON h.word = t.word""")
def tag_by_lexicon(t):
    """Tokens of all documents with a tag, by a lexicon read from a file and met on distinct words."""
    path = scratch_path(t.spark, "lexicon")
    listed = each(t.read("benchmark"), [], tx.plain_words(F.col("text")), "value").filter(F.length("value") >= 6)
    listed.distinct().write.text(path)
    lexicon = scan.read_reference_list(t.spark, path)
    tokens = each(t.documents, ["doc_id"], tx.sentence_tokens(F.col("text")), "word", "pos")  # made anew by each pass: no copy of them is written
    hits = materialize(containing_words(tokens, "word", lexicon, "value").withColumn("_hit", F.lit(True)), "hits")
    label = F.when(F.col("_hit"), tx.ENTITY).otherwise(tx.OTHER).alias("label")
    return skew_join(tokens, hits, ["word"], "left").select("doc_id", "pos", "word", label)


@query("naive_bayes", f"""
    WITH {COUNTS_SQL},
    train AS (SELECT review_id, stars FROM reviews_v WHERE {TRAIN_SQL}),
    masses AS (SELECT term, stars, sum(tf) AS mass FROM counts c JOIN train r ON r.review_id = c.review_id GROUP BY 1, 2),
    v AS (SELECT count(DISTINCT term) AS v FROM masses),
    classes AS (SELECT t.stars, ln(count(*) * 1.0e0 / (SELECT count(*) FROM train)) AS prior,
                       ln(coalesce(any_value(m.all_mass), 0) + (SELECT v FROM v)) AS log_all
                FROM train t LEFT JOIN (SELECT stars, sum(mass) AS all_mass FROM masses GROUP BY 1) m ON m.stars = t.stars
                GROUP BY 1),
    known AS (SELECT review_id, c.term, tf FROM counts c WHERE term IN (SELECT term FROM masses)),
    lengths AS (SELECT review_id, sum(tf) AS w FROM known GROUP BY 1),
    gains AS (SELECT review_id, stars, sum(tf * ln(mass + 1)) AS g FROM known k JOIN masses m ON m.term = k.term GROUP BY 1, 2),
    scored AS (SELECT r.review_id, c.stars, round(prior + coalesce(g, 0) - coalesce(w, 0) * log_all, 6) AS s
               FROM reviews_v r CROSS JOIN classes c LEFT JOIN lengths l ON l.review_id = r.review_id
               LEFT JOIN gains g ON g.review_id = r.review_id AND g.stars = c.stars)
    SELECT review_id, stars AS predicted FROM scored
    QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY s DESC, stars) = 1""")
def naive_bayes(t):
    """Multinomial naive Bayes of the stars on term counts: fit on 80 %, predicted for all."""
    counts = review_counts(t)
    reviews = t.reviews.select("review_id", "stars")
    train, _ = split_by_hash(reviews, "review_id", [80, 20], seed=1)
    weights = counts.select("review_id", "term", F.col("tf").cast("double").alias("weight"))
    masses = terms.fit_naive_bayes(weights, train, "review_id", "stars")
    return terms.predict_naive_bayes(masses, train, weights, reviews, "review_id", "stars")


@query("minmax_scale", """
    WITH cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM food_v),
    b AS (SELECT pos, min(x) AS low, max(x) AS high FROM cells GROUP BY 1)
    SELECT vec_id, CAST(c.pos AS INTEGER) AS pos, round(coalesce((x - low) / nullif(high - low, 0), 0), 6) AS scaled
    FROM cells c JOIN b ON b.pos = c.pos""")
def minmax_scale(t):
    """Each vector position scaled to [0, 1]; the bounds are one array of the vector's width."""
    wide = t.food.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    bounds = (
        wide.select(F.posexplode("x").alias("pos", "v"))
        .groupBy("pos")
        .agg(F.min("v").alias("low"), F.max("v").alias("high"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "low", "high"))).alias("b"))
    )
    scaled = F.zip_with(
        "x", "b", lambda x, b: F.coalesce(F.try_divide(x - b["low"], b["high"] - b["low"]), F.lit(0.0))
    )
    rows = wide.withColumn("b", bounds.scalar()).select("vec_id", F.posexplode(scaled).alias("pos", "scaled"))
    return rows.withColumn("scaled", F.round("scaled", 6))
