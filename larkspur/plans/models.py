"""Models: topics, ratings, classifiers. Results of iterative fits have no SQL."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.functions.arrays import concat_vectors, indicators, joined, label_vocabulary, one_hot, positional_array
from larkspur.learning import heads, labels, metrics, ratings, terms, topics
from larkspur.learning.sparse import term_vectors
from larkspur.operators.sampling import hash_bucket, split_by_hash
from larkspur.operators.skew import skew_join
from larkspur.plans.evaluation import _rounded
from larkspur.plans.features import chi2_ranks, star_classes, unit_weights
from larkspur.plans.files import LEXICON
from larkspur.plans.registry import query
from larkspur.plans.views import CLASSES, WIDTH
from larkspur.session import materialize, scratch_path
from larkspur.sources import scan, sink

ROUNDS = 100
TOPIC_SETTINGS = {"em": (20, 3.0, 1.1, ROUNDS, "em"), "online": (10, 0.1, 0.1, ROUNDS, "online")}  # k, alpha, beta
MARGIN_ROUNDS = 100
FOREST_DEPTH = 10
FOREST_TERMS = 500


def _input(t, kind="noun"):
    return topics.topic_input(t.review_texts, "review_id", "text", kind)


def _topic_rows(found):
    flat = found.select("topic", F.posexplode(F.arrays_zip("termwords", "termWeights")).alias("pos", "e"))
    return flat.select("topic", "pos", F.col("e.termwords").alias("word"), F.col("e.termWeights").alias("weight"))


@query("lda_em_topics")
def lda_em_topics(t):
    data = _input(t)
    model = topics.fit_topics(data.train, *TOPIC_SETTINGS["em"])
    return _topic_rows(topics.topic_terms(model, data.vocabulary))


@query("lda_online_topics")
def lda_online_topics(t):
    data = _input(t)
    model = topics.fit_topics(data.train, *TOPIC_SETTINGS["online"])
    return _topic_rows(topics.topic_terms(model, data.vocabulary))


@query("lda_doc_topics")
def lda_doc_topics(t):
    """Topic shares of every review, training and test part, by both optimizers."""
    data = _input(t)
    both = data.train.union(data.test)
    found = None
    for name, settings in TOPIC_SETTINGS.items():
        model = topics.fit_topics(data.train, *settings)
        share = F.posexplode(heads.vector_to_array("topicDistribution")).alias("topic", "share")
        rows = model.transform(both).select(F.lit(name).alias("optimizer"), "review_id", share)
        found = rows if found is None else found.union(rows)
    return found


@query("lda_metrics")
def lda_metrics(t):
    data = _input(t)
    rows = []
    for name, settings in TOPIC_SETTINGS.items():
        stats = topics.topic_stats(topics.fit_topics(data.train, *settings), data)
        rows += [(name, measure, value) for measure, value in stats.items()]
    return t.spark.createDataFrame(rows, "optimizer string, measure string, value double")


@query("lda_param_runs")
def lda_param_runs(t):
    """One run per region, by either optimizer in turn: parameters from a file of nested text values, statistics per run."""
    em = F.col("r_regionkey") % 2 == 1  # whose parameters must be above 1
    regions = t.read("region").select(
        F.col("r_regionkey").alias("runid"),
        F.when(em, 3.0).otherwise(0.1).alias("alpha"),
        ((F.col("r_regionkey") + F.when(em, 10).otherwise(1)) / F.lit(10.0)).alias("beta"),
        (F.col("r_regionkey") + 2).alias("k"),
        F.lit(ROUNDS).alias("iterations"),
    )
    path = scratch_path(t.spark, "params")
    item = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in regions.columns]))
    sink.write_bundles(regions, path, ["runid"], "params", item)
    params = scan.read_run_params(t.spark, path, multi_line=False)
    stats, found = topics.parameter_runs(_input(t), params, ["online", "em"])
    stats_path, topic_path = scratch_path(t.spark, "stats"), scratch_path(t.spark, "topics")
    sink.write_run_stats(stats, stats_path)
    sink.write_json_runs(found, topic_path)
    return scan.read_csv(t.spark, stats_path, topics.STATS_SCHEMA)


def _restaurant_reviews(t):
    restaurants = t.business.filter(F.col("categories").contains("Restaurants")).select("business_id")
    rows = t.reviews.select("review_id", "business_id", "text", "stars")
    return skew_join(rows, restaurants, ["business_id"]).drop("business_id")


SET_NAMES = ("lda", "tfidf", "sentiment", "lda_sentiment", "tfidf_sentiment")
SETS_SQL = " UNION ALL ".join(f"SELECT '{k}_{s}' AS feature_set" for k in ratings.KINDS for s in SET_NAMES)


@query("rating_feature_sets", f"""
    SELECT feature_set, count(*) AS rows, round(avg(stars), 6) AS mean_label
    FROM ({SETS_SQL}) CROSS JOIN (SELECT stars FROM reviews_v r JOIN business_v b ON b.business_id = r.business_id
                                  WHERE contains(categories, 'Restaurants')) GROUP BY 1""")
def rating_feature_sets(t):
    """Fifteen feature sets written as LIBSVM and counted back: rows and labels of each."""
    reviews = materialize(_restaurant_reviews(t), "reviews")
    counted = None
    for kind in ratings.KINDS:
        sets = ratings.rating_features(reviews, "review_id", "text", "stars", kind)
        for part, rows in sets.items():
            name = f"{kind}_{part}"
            path = scratch_path(t.spark, name)
            sink.write_libsvm(rows, path)
            label = F.split("value", " ")[0].cast("double")
            back = t.spark.read.text(path).agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("mean_label"))
            back = back.select(F.lit(name).alias("feature_set"), "rows", F.round("mean_label", 6).alias("mean_label"))
            counted = back if counted is None else counted.union(back)
    return counted


@query("rating_regression")
def rating_regression(t):
    """Predicted stars of the held-out reviews from the sentiment of their adjectives."""
    words = tx.select_words(tx.remove_words(tx.gap_tokens(F.col("text"))), "adjective")
    features = array_to_vector(tx.polarity_histogram(words)).alias("features")
    rows = materialize(t.reviews.select("review_id", F.col("stars").alias("label"), features), "ratings")
    train, test = split_by_hash(rows, "review_id", [80, 20], seed=1)
    return ratings.fit_rating(train).transform(test).select("review_id", "label", "prediction")


@query("regression_summary")
def regression_summary(t):
    """One row of statistics and coefficients for each of the fifteen feature sets; predictions of the test rows are written as JSON."""
    reviews = materialize(_restaurant_reviews(t), "reviews")
    found = None
    for kind in ratings.KINDS:
        for name, rows in ratings.rating_features(reviews, "review_id", "text", "stars", kind).items():
            train, test = split_by_hash(materialize(rows, name), "review_id", [80, 20], seed=1)
            path = scratch_path(t.spark, f"predictions_{kind}_{name}")
            summary = ratings.rating_summary(ratings.fit_rating(train), train, test, path)
            used = F.size(F.filter("coefficients", lambda c: c != 0)).alias("used_features")
            summary = summary.select(F.lit(name).alias("feature_set"), F.lit(kind).alias("words"), used, "*")
            found = summary if found is None else found.union(summary)
    return found


@query("random_forest")
def random_forest(t):
    """Stars from the best terms, chosen and weighed on the training part, 75 trees; accuracy on both parts."""
    classes = star_classes(t, "train")
    weights = materialize(terms.with_classes(unit_weights(t, "train"), classes, "review_id", "stars"), "tfidf")
    chosen = chi2_ranks(t, weights, FOREST_TERMS, "train")
    dense = terms.dense_terms(weights, chosen, t.reviews, "review_id", FOREST_TERMS)
    rows = dense.join(t.reviews.select("review_id", F.col("stars").alias("label")), "review_id")
    rows = materialize(rows.withColumn("features", array_to_vector("features")), "rows")
    train, test = split_by_hash(rows, "review_id", [80, 20], seed=1)
    model = RandomForestClassifier(numTrees=75, maxDepth=FOREST_DEPTH, seed=37).fit(train)
    scores = [
        metrics.accuracy(model.transform(part), "label", "prediction").select(F.lit(name).alias("part"), "accuracy")
        for name, part in (("train", train), ("test", test))
    ]
    return scores[0].union(scores[1])


def _labelled_reviews(t):
    """Reviews with the label indicators of their business and counts of all terms of the training part."""
    named = t.business.na.drop(subset=["categories"]).select(
        "business_id", tx.split_trim(F.col("categories")).alias("labels")
    )
    vocabulary = label_vocabulary(named, "labels")
    names = vocabulary.first()["vocabulary"]
    flags = named.select("business_id", indicators(F.col("labels"), F.array(*map(F.lit, names))).alias("y"))
    texts = t.reviews.select("review_id", "business_id", "text").na.fill("", ["text"])
    kept = tx.remove_words(tx.gap_tokens(F.col("text")))
    rows = skew_join(texts, flags, ["business_id"]).select("review_id", "y", kept.alias("words"))
    return term_vectors(rows, "words", hash_bucket(F.col("review_id"), 1) < 70), names


@query("binary_relevance")
def binary_relevance(t):
    """Labels of the business from the review's words: three kinds of binary models, 70/30 split.

    All see all terms. Margin and naive Bayes models are fitted for all labels at once, forests one at a time.
    """
    found, names = _labelled_reviews(t)
    rows, width, count = found.rows, max(found.size, 1), len(names)
    train, test = split_by_hash(rows.drop("features"), "review_id", [70, 30], seed=1)
    margin = labels.fit_labels(train, "y", count, width, "squared_hinge", reg=0.01, iterations=MARGIN_ROUNDS)
    bayes = labels.naive_bayes_labels(train, "y", count, width)
    train_rows, test_rows = split_by_hash(rows, "review_id", [70, 30], seed=1)
    forest = lambda: RandomForestClassifier(numTrees=75, maxDepth=FOREST_DEPTH, seed=37)
    predicted = {
        "margin": labels.predict_labels(margin, test, ["y"]),
        "naive_bayes": labels.predict_labels(bayes, test, ["y"]),
        "forest": heads.binary_relevance(train_rows.select("y", "features"), test_rows, "y", count, forest, threads=1),
    }
    places = lambda c: F.filter(F.sequence(F.lit(1), F.size(c)), lambda i: F.element_at(c, i) == 1)
    scored = None
    for name, kind in predicted.items():
        sets = kind.select(places("y").alias("a"), places("predicted").alias("p"))
        scores = metrics.multilabel_scores(sets, "a", "p").select(F.lit(name).alias("model"), "*")
        scored = scores if scored is None else scored.union(scores)
    return scored


def _food_rows(t):
    """Vectors with their labels: class, every position of Y2, vegan flag and mean calories."""
    total = F.aggregate(
        F.zip_with("y2", "reference", lambda y, c: (y * c).cast("double")), F.lit(0.0), lambda a, v: a + v
    )
    reference = positional_array(t.calories, "idx", "calories", WIDTH)
    rows = t.food.withColumn("reference", reference.scalar()).select(
        "vec_id",
        "split",
        (F.col("class_id") - 1).cast("double").alias("food"),
        F.col("y3").cast("double").alias("vegan"),
        "y2",
        one_hot(F.col("class_id"), CLASSES).alias("y1"),
        F.coalesce(F.try_divide(total, F.aggregate("y2", F.lit(0), lambda a, v: a + v)), F.lit(0.0)).alias("calories"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    rows = materialize(rows, "food")
    return rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test")


@query("class_softmax")
def class_softmax(t):
    train, test = _food_rows(t)
    model = heads.logistic("food", "food").setFamily("multinomial").fit(train)
    return _rounded(metrics.class_report(model.transform(test), "food", "food_pred"))


@query("multilabel_logit")
def multilabel_logit(t):
    train, test = _food_rows(t)
    predicted = heads.label_heads(train, test, "y2", WIDTH, WIDTH, ["y2"])
    return _rounded(metrics.label_report(predicted, "y2", "predicted"))


@query("binary_logit")
def binary_logit(t):
    train, test = _food_rows(t)
    predicted = heads.logistic("vegan", "vegan").fit(train).transform(test)
    scored = predicted.select("vec_id", "vegan", "vegan_pred", heads.probability_of("vegan_prob", 1).alias("probability"))
    return scored


@query("parallel_heads")
def parallel_heads(t):
    """Food class, every ingredient and vegan flag side by side on one vector."""
    train, test = _food_rows(t)
    labelled = heads.label_heads(train, test, "y2", WIDTH, WIDTH, ["vec_id"])
    predicted = heads.parallel_heads({"food": "food", "vegan": "vegan"}).fit(train).transform(test)
    both = predicted.select("vec_id", "food_pred", "vegan_pred").join(labelled, "vec_id")
    return both.select("vec_id", "food_pred", joined(F.col("predicted")).alias("labels_pred"), "vegan_pred")


@query("stacked_heads")
def stacked_heads(t):
    """Food class first; its scores help every ingredient, whose scores help the vegan flag."""
    train, test = _food_rows(t)
    predicted = heads.stacked_heads(train, test, "food", "y2", WIDTH, "vegan", WIDTH, ["vec_id"])
    return predicted.select("vec_id", "first_pred", joined(F.col("predicted")).alias("labels_pred"), "last_pred")


@query("calorie_regression")
def calorie_regression(t):
    """Mean calories from the ingredients, and from food class plus ingredients; linear and boosted trees."""
    train, test = _food_rows(t)
    inputs = {"ingredients": [F.col("y2")], "class_ingredients": [F.col("y1"), F.col("y2")]}
    found = None
    for name, parts in inputs.items():
        features = array_to_vector(concat_vectors(parts)).alias("features")
        fit_rows, test_rows = (p.select("calories", features) for p in (train, test))
        for kind, model in (
            ("linear", LinearRegression(labelCol="calories", maxIter=100, regParam=0.01)),
            ("trees", GBTRegressor(labelCol="calories", maxIter=50, maxDepth=5, seed=37)),
        ):
            predicted = model.fit(fit_rows).transform(test_rows)
            scores = metrics.regression_scores(predicted, "calories", "prediction")
            scores = scores.select(F.lit(name).alias("input"), F.lit(kind).alias("model"), "*")
            found = scores if found is None else found.union(scores)
    return found


@query("token_classifier")
def token_classifier(t):
    """Entity label of a token from the word and its neighbours; report on held-out documents."""
    tokens = t.documents.select("doc_id", tx.sentence_tokens(F.col("text")).alias("tokens"))
    label = lambda w: F.when(tx.has_entry(w, LEXICON), 1.0).otherwise(0.0)
    parts = split_by_hash(tokens, "doc_id", [90, 10], seed=2018)
    train, test = (heads.context_counts(p, "doc_id", "tokens", label) for p in parts)
    predicted = heads.fit_contexts(train).predict(test, "label", "n")
    pairs = predicted.groupBy("label", "prediction").agg(F.sum("n").cast("bigint").alias("tokens"))
    return pairs


@query("model_roundtrip", "SELECT vec_id, true AS same FROM food_v WHERE split = 'test'")
def model_roundtrip(t):
    """A saved and loaded pipeline predicts the same."""
    train, test = _food_rows(t)
    fitted = Pipeline(stages=[heads.logistic("food", "food"), heads.logistic("vegan", "vegan")]).fit(train)
    path = scratch_path(t.spark, "model")
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    names = ["vec_id", "food_pred", "vegan_pred"]
    again = loaded.transform(test).select("vec_id", F.struct("food_pred", "vegan_pred").alias("after"))
    return (
        fitted.transform(test)
        .select(*names)
        .join(again, "vec_id")
        .select("vec_id", (F.struct("food_pred", "vegan_pred") == F.col("after")).alias("same"))
    )
