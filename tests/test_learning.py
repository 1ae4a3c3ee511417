"""Features, models and metrics."""

import math
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer, FeatureHasher
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from larkspur.learning import heads, logistic, metrics, ratings, terms, topics
from larkspur.learning.em_topics import EmTopics
from larkspur.plans import models


@pytest.fixture(scope="module")
def corpus(spark):
    dice = random.Random(3)
    rows = []
    for i in range(80):
        label = float(dice.choice([1, 3, 5]))
        pool = ["common", "food"] + {1.0: ["cold", "slow"], 3.0: ["table", "menu"], 5.0: ["great", "fresh"]}[label]
        rows.append((i, label, dice.choices(pool, k=dice.randint(0, 8))))
    return rows, spark.createDataFrame(rows, "doc int, label double, tokens array<string>")


def test_counts_and_vocabulary(corpus):
    rows, df = corpus
    counts = terms.term_counts(df, "doc", "tokens")
    want = {(i, w): n for i, _, ws in rows for w, n in Counter(ws).items()}
    assert {(r["doc"], r["term"]): r["tf"] for r in counts.collect()} == want
    total = Counter(w for _, _, ws in rows for w in ws)
    order = sorted(total, key=lambda w: (-total[w], w))
    assert [r["term"] for r in terms.fit_vocabulary(counts).orderBy("idx").collect()] == order
    assert [r["term"] for r in terms.fit_vocabulary(counts, size=3).orderBy("idx").collect()] == order[:3]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_in_their_row_and_over_rows_of_one_document(spark):
    rows = [(1, ["a", "a", None, "b"]), (2, ["b"]), (2, ["b", "c"]), (None, ["x"]), (None, ["x", "y"]), (3, []), (4, None)]
    got = terms.term_counts(spark.createDataFrame(rows, "doc int, tokens array<string>"), "doc", "tokens")
    found = {(r["doc"], r["term"]): r["tf"] for r in got.collect()}
    assert got.count() == len(found)
    assert found == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 2, (2, "c"): 1, (None, "x"): 2, (None, "y"): 1}
    assert got.schema["tf"].dataType.simpleString() == "bigint"


def test_classes_come_to_the_weights_where_these_lie(spark, corpus):
    _, df = corpus
    weights = terms.unit_length(terms.with_idf(terms.term_counts(df, "doc", "tokens"), df, smooth=True), "doc")
    labels = df.select("doc", "label").union(df.filter("doc < 9").select("doc", "label"))  # some twice
    scores = lambda w: {r["term"]: r["chi2"] for r in terms.chi2_scores(w, labels, "doc", "label").collect()}
    held = terms.with_classes(weights, labels.hint("shuffle_merge"), "doc", "label")
    joined = held.count(), weights.count()
    assert joined[0] == joined[1] and _plan(held).count("Window [") == 1
    plain, want = weights.join(labels, "doc"), defaultdict(float)
    for r in plain.collect():
        want[(r["term"], r["label"])] += r["weight"]
    cells = held.select("term", "weight", F.inline("classes")).groupBy("term", "label").agg(F.sum(F.col("weight") * F.col("rows")).alias("o"))
    got = {(r["term"], r["label"]): r["o"] for r in cells.collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(v) for k, v in want.items())
    assert scores(held) == pytest.approx(scores(weights))


def test_idf_equals_the_library(corpus):
    _, df = corpus
    counts = terms.term_counts(df, "doc", "tokens")
    ours = {(r["doc"], r["term"]): r["weight"] for r in terms.with_idf(counts, df, smooth=False).collect()}
    vectorizer = CountVectorizer(inputCol="tokens", outputCol="c").fit(df)
    vectors = vectorizer.transform(df)
    weighted = IDF(inputCol="c", outputCol="w").fit(vectors).transform(vectors)
    for row in weighted.select("doc", vector_to_array("w").alias("w")).collect():
        for word, value in zip(vectorizer.vocabulary, row["w"]):
            assert ours.get((row["doc"], word), 0.0) == pytest.approx(value)


def test_unit_length_and_chi2_by_hand(corpus):
    rows, df = corpus
    counts = terms.term_counts(df, "doc", "tokens")
    unit = terms.unit_length(terms.with_idf(counts, df, smooth=True), "doc").collect()
    norms = defaultdict(float)
    for r in unit:
        norms[r["doc"]] += r["weight"] ** 2
    assert all(n == pytest.approx(1) for n in norms.values())
    weights = counts.select("doc", "term", F.col("tf").cast("double").alias("weight"))
    got = {r["term"]: r["chi2"] for r in terms.chi2_scores(weights, df.select("doc", "label"), "doc", "label").collect()}
    labels = Counter(label for _, label, _ in rows)
    mass, seen = Counter(), Counter()
    for _, label, words in rows:
        for w in words:
            mass[w] += 1
            seen[(w, label)] += 1
    for term, score in got.items():
        want = sum(
            (seen[(term, c)] - mass[term] * n / len(rows)) ** 2 / (mass[term] * n / len(rows)) for c, n in labels.items()
        )
        assert score == pytest.approx(want)
    best = terms.k_best(terms.chi2_scores(weights, df.select("doc", "label"), "doc", "label"), 2).orderBy("rank").collect()
    want_order = sorted(got, key=lambda w: (-round(got[w], 6), w))[:2]
    assert [(r["rank"], r["term"]) for r in best] == [(1, want_order[0]), (2, want_order[1])]


@pytest.mark.parametrize("smoothing", [1.0, 0.5])
def test_naive_bayes_agrees_with_the_library(corpus, smoothing):
    _, df = corpus
    counts = terms.term_counts(df, "doc", "tokens")
    weights = counts.select("doc", "term", F.col("tf").cast("double").alias("weight"))
    labels = df.select("doc", "label")
    masses = terms.fit_naive_bayes(weights, labels, "doc", "label")
    ours = terms.predict_naive_bayes(masses, labels, weights, df, "doc", "label", smoothing)
    index = df.withColumn("y", (F.col("label") - 1) / 2)
    vectors = CountVectorizer(inputCol="tokens", outputCol="features").fit(index).transform(index)
    model = NaiveBayes(labelCol="y", smoothing=smoothing).fit(vectors)
    library = {r["doc"]: r["prediction"] * 2 + 1 for r in model.transform(vectors).collect()}
    got = {r["doc"]: r["predicted"] for r in ours.collect()}
    assert set(got) == set(library)
    agree = [d for d in got if got[d] == library[d]]
    # exact ties may go either way
    assert len(agree) >= len(got) - 2


def test_min_max_and_dense_terms(spark):
    weights = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (1, "b", 3.0)], "doc int, term string, weight double")
    docs = spark.createDataFrame([(1,), (2,)], "doc int")
    got = {(r["doc"], r["term"]): r["weight"] for r in terms.min_max_terms(weights, docs, "doc").collect()}
    assert got == {(1, "a"): 0.0, (2, "a"): 1.0, (1, "b"): 1.0}
    ranks = spark.createDataFrame([("b", 1), ("a", 2), ("z", 3)], "term string, rank bigint")
    rows = terms.dense_terms(weights, ranks, docs, "doc", 3).orderBy("doc").collect()
    assert [r["features"] for r in rows] == [[3.0, 2.0, 0.0], [0.0, 4.0, 0.0]]


@pytest.fixture(scope="module")
def reviews(spark, corpus):
    rows, _ = corpus
    texts = [(i, " ".join(ws) if i else None, label) for i, label, ws in rows]
    return spark.createDataFrame(texts, "review_id int, text string, stars double")


def test_missing_text_has_no_words(reviews):
    rows = topics.review_words(reviews, "review_id", "text", {"words": None}).orderBy("review_id").collect()
    assert rows[0]["words"] == [] and len(rows) == 80


@pytest.mark.parametrize("optimizer,alpha,beta", [("online", 0.1, 0.1), ("em", 3.0, 1.1)])
def test_topics(spark, reviews, optimizer, alpha, beta):
    data = topics.topic_input(reviews, "review_id", "text", kind=None)
    words = topics.review_words(reviews, "review_id", "text", {"w": None})
    train = {r["review_id"] for r in data.train.collect()}
    known = {w for r in words.collect() if r["review_id"] in train for w in r["w"]}
    assert {r["term"] for r in data.vocabulary.collect()} == known and data.size == len(known)
    assert train.isdisjoint({r["review_id"] for r in data.test.collect()})
    model = topics.fit_topics(data.train, 2, alpha, beta, 3, optimizer)
    shares = model.transform(data.test).select(vector_to_array("topicDistribution").alias("s")).collect()
    assert all(sum(r["s"]) == pytest.approx(1) or sum(r["s"]) == 0 for r in shares)
    found = topics.topic_terms(model, data.vocabulary, 3).collect()
    assert len(found) == 2 and all(set(r["termwords"]) <= known for r in found)
    assert all(math.isfinite(v) for v in topics.topic_stats(model, data).values())


def test_em_topics_are_those_of_the_library_without_its_graph(spark, reviews):
    data = topics.topic_input(reviews, "review_id", "text", kind=None)
    ours = topics.fit_topics(data.train, 3, 3.0, 1.1, 12, "em")
    assert isinstance(ours, EmTopics)
    library = LDA(k=3, maxIter=12, optimizer="em", docConcentration=[3.0], topicConcentration=1.1, seed=topics.SEED).fit(data.train)
    counts = {r["idx"]: r["counts"] for r in ours.counts.collect()}
    want = library.topicsMatrix().toArray()
    assert sorted(counts) == list(range(len(want)))
    assert all(counts[i] == pytest.approx(list(want[i]), abs=1e-4, rel=1e-4) for i in counts)
    assert ours.trainingLogLikelihood() == pytest.approx(library.trainingLogLikelihood(), rel=1e-5)
    for part in (data.train, data.test):
        assert ours.logLikelihood(part) == pytest.approx(library.logLikelihood(part), rel=1e-3)
        share = lambda m: [r["s"] for r in m.transform(part).orderBy("review_id").select(vector_to_array("topicDistribution").alias("s")).collect()]
        for a, b in zip(share(ours), share(library), strict=True):
            assert a == pytest.approx(b, abs=2e-3)
    stats = topics.topic_stats(ours, data)
    assert stats["testperplexity"] == pytest.approx(library.logPerplexity(data.test), rel=1e-3)
    tops = lambda m: {r["topic"]: r["termWeights"] for r in m.describeTopics(3).collect()}
    assert all(tops(ours)[k] == pytest.approx(v, abs=1e-4) for k, v in tops(library).items())


def test_em_topics_of_vectors_alone(spark, reviews):
    data = topics.topic_input(reviews, "review_id", "text", kind=None)
    whole = topics.fit_topics(data.train, 2, 3.0, 1.1, 4, "em")
    plain = topics.fit_topics(data.train.select("features"), 2, 3.0, 1.1, 4, "em")
    assert plain.totals == pytest.approx(whole.totals)


def test_parameter_runs(spark, reviews):
    data = topics.topic_input(reviews, "review_id", "text", kind=None)
    params = spark.createDataFrame([(2, 0.1, 0.1, 3, 1), (1, 0.5, 0.2, 2, 2)], "runid int, alpha double, beta double, k int, iterations int")
    stats, found = topics.parameter_runs(data, params, ["online"])
    rows = stats.collect()
    assert [(r["runid"], r["k"], r["iterations"]) for r in rows] == [(1, 2, 2), (2, 3, 1)]
    assert all(r["executiontime"] > 0 and r["vocablength"] == data.size for r in rows)
    assert Counter(r["runid"] for r in found.collect()) == {1: 2, 2: 3}
    with pytest.raises(TypeError):
        topics.parameter_runs(data, params, "online")


def test_rating_features_and_regression(reviews):
    sets = ratings.rating_features(reviews, "review_id", "text", "stars", "noun_adjective", k=2, iterations=2)
    assert set(sets) == {"lda", "tfidf", "sentiment", "lda_sentiment", "tfidf_sentiment"}
    widths = {n: {len(r["features"]) for r in d.collect()} for n, d in sets.items()}
    assert widths["lda"] == {2} and widths["lda_sentiment"] == {3} and widths["sentiment"] == {6}
    assert {w + 6 for w in widths["tfidf"]} == widths["tfidf_sentiment"]
    rows = sets["sentiment"]
    model = ratings.fit_rating(rows)
    summary = ratings.rating_summary(model, rows, rows).first()
    assert summary["train_rmse"] == pytest.approx(summary["test_rmse"])


def test_regression_summary_has_coefficients_and_writes_predictions(spark, monkeypatch, tmp_path):
    rows = [(f"r{i}", "b", " ".join(["good", "bad", "fresh"][: i % 3 + 1]), float(i % 3 + 1)) for i in range(40)]
    reviews = spark.createDataFrame(rows, "review_id string, business_id string, text string, stars double")
    tables = SimpleNamespace(
        spark=spark,
        reviews=reviews,
        business=spark.createDataFrame([("b", "Restaurants")], "business_id string, categories string"),
    )

    def features(reviews, key, text, label, kind):
        size = F.size(F.split(text, " ")).cast("double")
        return {"one": reviews.select(key, F.col(label).alias("label"), array_to_vector(F.array(size, F.lit(1.0))).alias("features"))}

    monkeypatch.setattr(ratings, "KINDS", ("noun",))
    monkeypatch.setattr(ratings, "rating_features", features)
    monkeypatch.setattr(models, "scratch_path", lambda spark, name: str(tmp_path / name))
    row = models.regression_summary(tables).first()
    assert len(row["coefficients"]) == 2 and sum(c != 0 for c in row["coefficients"]) == row["used_features"] == 1
    found = spark.read.json(str(tmp_path / "predictions_noun_one")).collect()
    _, test = models.split_by_hash(reviews, "review_id", [80, 20], seed=1)
    assert {r["review_id"] for r in found} == {r["review_id"] for r in test.collect()} and found
    for r in found:
        assert r["prediction"] == pytest.approx(row["intercept"] + row["coefficients"][0] * r["label"])


def test_forest_of_binary_relevance_sees_words_beyond_the_commonest(spark):
    common = " ".join(f"filler{i}" for i in range(500))
    marks = " ".join(f"marker{i}" for i in range(600))
    rows = [(f"r{i}", "ab"[i % 5 < 2], f"{common} {common} {marks if i % 5 < 2 else ''}") for i in range(60)]
    tables = SimpleNamespace(
        business=spark.createDataFrame([("a", "Other"), ("b", "Rare")], "business_id string, categories string"),
        reviews=spark.createDataFrame(rows, "review_id string, business_id string, text string"),
    )
    scores = {r["model"]: r for r in models.binary_relevance(tables).collect()}
    assert all(value == 1.0 for value in scores["forest"][1:])


def test_binary_relevance_with_constant_labels(spark):
    rows = [([float(i), float(-i)], [int(i > 5), 1, 0]) for i in range(10)]
    df = spark.createDataFrame(rows, "v array<double>, y array<int>").select(array_to_vector("v").alias("features"), "y")
    got = heads.binary_relevance(df, df, "y", 3, lambda: LogisticRegression(maxIter=20)).collect()
    assert all(r["predicted"] == r["y"] for r in got)


def test_stacked_heads_see_the_scores_before(spark):
    dice = random.Random(2)
    rows = []
    for i in range(200):
        x = [dice.gauss(0, 1), dice.gauss(0, 1)]
        rows.append((i, x, float(x[0] > 0) + float(x[0] > 1), [int(x[1] > 0), int(x[0] > 1), 1], float(x[0] + x[1] > 0)))
    df = spark.createDataFrame(rows, "id int, v array<double>, a double, y array<int>, b double").withColumn("features", array_to_vector("v"))
    out = heads.stacked_heads(df, df, "a", "y", 3, "b", 2, ["id", "y", "a", "b"]).collect()
    assert len(out) == 200 and out[0].__fields__ == ["id", "y", "a", "b", "first_pred", "predicted", "last_pred"]
    assert sum(r["predicted"] == r["y"] for r in out) >= 190 and sum(r["last_pred"] == r["b"] for r in out) >= 190


def test_context_rows(spark):
    df = spark.createDataFrame([(1, ["x", "y"])], "doc int, tokens array<string>")
    got = heads.context_rows(df, "doc", "tokens", lambda w: (w == "y").cast("double")).collect()
    assert [tuple(r) for r in got] == [(1, "", "x", "y", 0.0), (1, "x", "y", "", 1.0)]


@pytest.fixture(scope="module")
def contexts(spark):
    dice, rows = random.Random(4), []
    words = [*(f"w{i}" for i in range(25)), "", None, "\u00e9t\u00e9", "x" * 200, "two words"]
    for _ in range(600):
        row = dice.choice(words), dice.choice(words), dice.choice(words)
        rows.append((*row, float(dice.random() < (0.9 if (row[1] or "")[-1:] in "13" else 0.2)), float(dice.randint(1, 400))))
    return spark.createDataFrame(rows, "previous string, word string, next string, label double, n double").repartition(3)


@pytest.mark.parametrize("width", [16, 60, heads.HASHED])  # with few columns, words of one row meet in one
def test_hashed_logistic_regression_is_that_of_mllib(contexts, width):
    hasher = FeatureHasher(inputCols=heads.CONTEXT, outputCol="features", numFeatures=width)
    stages = [hasher, LogisticRegression(maxIter=30, regParam=0.0001, weightCol="n")]
    model = Pipeline(stages=stages).fit(contexts)
    found = logistic.fit_hashed(contexts, heads.CONTEXT, width, "label", "n", 0.0001, 30)
    assert found.losses == pytest.approx(model.stages[1].summary.objectiveHistory, rel=1e-9)
    assert found.weights == pytest.approx(model.stages[1].coefficients.toArray(), abs=1e-6)
    assert found.intercept == pytest.approx(model.stages[1].intercept, abs=1e-6)
    order = [*heads.CONTEXT, "label", "n", "prediction"]
    want = Counter(map(tuple, model.transform(contexts).select(order).collect()))
    assert Counter(map(tuple, found.predict(contexts, *order[:-1]).collect())) == want


def test_hashed_rows_are_made_once_and_held_in_few_bytes(spark, contexts):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    heads.fit_contexts(contexts.mapInArrow(count, contexts.schema), 3)
    assert made.value == 600
    words = contexts.na.fill("").withColumn("n", F.lit(1.0)).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(100))))
    packed = logistic._packed(words.coalesce(1), "label", "n", heads.CONTEXT, heads.HASHED)
    assert packed.map(len).sum() < 9 * 60_000


def test_hashed_logistic_regression_of_one_label(contexts):
    for label in (0.0, 1.0):
        same = contexts.withColumn("label", F.lit(label))
        assert {r[0] for r in heads.fit_contexts(same).predict(contexts, "n").select("prediction").collect()} == {label}
    with pytest.raises(ValueError):
        heads.fit_contexts(contexts.limit(0))


def test_context_counts(spark):
    rows = [(1, ["x", "y"]), (2, ["x", "y", None, "x"]), (3, []), (4, None), (5, ["x", "y"])]
    df = spark.createDataFrame(rows, "doc int, tokens array<string>")
    got = heads.context_counts(df, "doc", "tokens", lambda w: (w == "y").cast("double")).collect()
    want = {("", "x", "y", 0.0): 3, ("x", "y", "", 1.0): 3, ("y", None, "x", None): 1, ("", "x", "", 0.0): 1}
    assert {(r["previous"], r["word"], r["next"], r["label"]): r["n"] for r in got} == want


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    report = {r["class"]: r for r in metrics.class_report(df, "y", "p").collect()}
    assert report["a"]["precision"] == 1 and report["a"]["recall"] == 0.5
    assert report["b"]["precision"] == pytest.approx(1 / 3) and report["c"]["f1"] == 0
    assert report["micro avg"]["f1"] == 0.5 and report["macro avg"]["recall"] == 0.5
    assert report["weighted avg"]["support"] == 4
    assert metrics.accuracy(df, "y", "p").first()[0] == 0.5
    sets = spark.createDataFrame([([1, 2], [2, 3]), ([1], []), ([], [])], "a array<int>, p array<int>")
    scores = metrics.multilabel_scores(sets, "a", "p").first()
    assert scores["jaccard"] == pytest.approx((1 / 3 + 0) / 2)
    assert (scores["precision"], scores["recall"]) == (0.5, 0.25)
    flags = spark.createDataFrame([([1, 0, 1], [1, 1, 0])], "a array<int>, p array<int>")
    assert metrics.micro_f1(flags, "a", "p").first()[0] == pytest.approx(0.5, abs=1e-6)
    ranks = spark.createDataFrame([([0.1, 0.5, 0.5], 2)], "s array<double>, i int")
    assert metrics.top_k_accuracy(ranks, "s", F.col("i"), 1).first()[0] == 0
    assert metrics.top_k_accuracy(ranks, "s", F.col("i"), 2).first()[0] == 1
    numbers = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "y double, p double")
    assert metrics.regression_scores(numbers, "y", "p").first().asDict() == {
        "rmse": math.sqrt(0.5), "mae": 0.5, "mse": 0.5, "r2": 0.5
    }
    losses = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, p double")
    assert metrics.binary_log_loss(losses, "y", "p").first()[0] == pytest.approx(-math.log(1e-7) / 2, rel=1e-3)
