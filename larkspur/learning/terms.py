"""Term statistics in long form: (document, term, weight) rows.

Nothing here is as wide as the vocabulary, so it has no size limit. All joins
on a term go through the skew-safe join, since a frequent term can stand in a
large share of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.arrays import each, once
from larkspur.operators.chunks import with_ordinal
from larkspur.operators.skew import skew_join
from larkspur.session import materialize


def counted_terms(tokens: Column) -> Column:
    """The distinct tokens of an array in order, with their counts: array of (term, tf). Nulls do not count."""
    none = F.array().cast("array<struct<term:string,tf:int>>")

    def runs(words: Column) -> Column:
        fresh = lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1))
        begins = F.filter(F.sequence(F.lit(0), F.size(words) - 1), fresh)
        run = lambda b: F.transform(
            b,
            lambda at, k: F.struct(
                F.get(words, at).alias("term"), (F.coalesce(F.get(b, k + 1), F.size(words)) - at).cast("int").alias("tf")
            ),
        )
        return F.when(F.size(words) > 0, once(begins, run)).otherwise(none)

    return once(F.sort_array(F.filter(tokens, lambda w: w.isNotNull())), runs)


def term_counts(df: DataFrame, doc: str, tokens: str) -> DataFrame:
    """(doc, term, tf), written down once because every statistic reads it again.

    Words are counted inside their row; only documents that have several rows, or no key, are summed over rows.
    """
    flat = lambda rows: each(rows, [doc], counted_terms(F.col(tokens)), "t").select(doc, "t.term", F.col("t.tf").cast("bigint").alias("tf"))
    again = df.na.drop(subset=[doc]).groupBy(doc).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    again = materialize(again.select(doc, F.lit(True).alias("_again")), "again")
    if again.isEmpty() and df.filter(F.col(doc).isNull()).isEmpty():
        return materialize(flat(df), "terms")
    marked = skew_join(df.select(doc, tokens), again, [doc], "left")
    several = F.col(doc).isNull() | F.coalesce("_again", F.lit(False))
    summed = flat(marked.filter(several)).groupBy(doc, "term").agg(F.sum("tf").alias("tf"))
    return materialize(flat(marked.filter(~several)).unionByName(summed), "terms")


def fit_vocabulary(counts: DataFrame, size: int | None = None) -> DataFrame:
    """(term, n, df, idx): all terms, or the ``size`` most frequent, numbered from 0 by falling frequency."""
    totals = counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
    ranked = with_ordinal(totals.withColumn("_less", -F.col("n")), [], ["_less", "term"], "idx").drop("_less")
    kept = ranked if size is None else ranked.filter(F.col("idx") <= size)
    return kept.withColumn("idx", F.col("idx") - 1)


def count_vectorize(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Counts of known terms with their index."""
    return skew_join(counts, vocabulary.select("term", "idx"), ["term"])


def with_idf(counts: DataFrame, documents: DataFrame, smooth: bool, fit: Column | None = None) -> DataFrame:
    """Add ``weight`` = tf * idf.

    ``smooth``: ln((1 + n) / (1 + df)) + 1, else ln((n + 1) / (df + 1)). ``fit`` picks
    the documents that n and df are counted in; terms that none of them has are left out.
    """
    counted, documents = (counts, documents) if fit is None else (counts.filter(fit), documents.filter(fit))
    frequency = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = documents.agg(F.count(F.lit(1))).scalar()
    idf = F.ln((total + 1) / (F.col("df") + 1)) + (1 if smooth else 0)
    weighted = frequency.select("term", idf.alias("idf"))
    return skew_join(counts, weighted, ["term"]).withColumn("weight", F.col("tf") * F.col("idf")).drop("idf")


def unit_length(weights: DataFrame, doc: str) -> DataFrame:
    """Scale each document's weights to length 1.

    The window is over one document's terms, which came from a single row.
    """
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(doc)))
    return weights.select(doc, "term", (F.col("weight") / norm).alias("weight"))


def with_classes(weights: DataFrame, classes: DataFrame, doc: str, label: str) -> DataFrame:
    """Add ``classes``, the (label, rows) of each document, null where it has none.

    Right behind :func:`unit_length` the weights lie by document, so that they are not shuffled for it.
    """
    counted = classes.na.drop(subset=[doc]).groupBy(doc, label).agg(F.count(F.lit(1)).alias("rows"))
    return weights.join(counted.groupBy(doc).agg(F.collect_list(F.struct(label, "rows")).alias("classes")), doc, "left")


def chi2_scores(weights: DataFrame, classes: DataFrame, doc: str, label: str) -> DataFrame:
    """(term, chi2) of the summed weights per class against the class shares; ``weights`` may hold :func:`with_classes`."""
    held = weights if "classes" in weights.columns else with_classes(weights, classes, doc, label)
    cells = held.select("term", "weight", F.inline("classes"))
    observed = cells.groupBy("term", label).agg(F.sum(F.col("weight") * F.col("rows")).alias("observed"))
    total = classes.agg(F.count(F.lit(1))).scalar()
    shares = classes.groupBy(label).agg(F.count(F.lit(1)).alias("_docs")).withColumn("share", F.col("_docs") / total)
    cells = observed.join(shares.select(label, "share"), label)
    per_term = cells.groupBy("term").agg(
        F.sum("observed").alias("mass"), F.collect_list(F.struct("observed", "share")).alias("cells")
    )
    # classes in which the term has no weight add their whole expected mass
    gap = lambda c: F.col("mass") * c["share"] - c["observed"]
    found = F.aggregate("cells", F.lit(0.0), lambda a, c: a + gap(c) * gap(c) / (F.col("mass") * c["share"]))
    covered = F.aggregate("cells", F.lit(0.0), lambda a, c: a + c["share"])
    return per_term.select("term", (found + F.col("mass") * (1 - covered)).alias("chi2"))


def k_best(scores: DataFrame, k: int, digits: int = 6) -> DataFrame:
    """The k terms with the highest score as (rank, term, chi2); equal scores by term."""
    best = scores.select("term", F.round("chi2", digits).alias("chi2")).orderBy(F.desc("chi2"), "term").limit(k)
    over_k_rows = Window.partitionBy(F.lit(0)).orderBy(F.desc("chi2"), "term")
    return best.withColumn("rank", F.row_number().over(over_k_rows).cast("bigint"))


def min_max_terms(weights: DataFrame, documents: DataFrame, doc: str, fit: Column | None = None) -> DataFrame:
    """Scale each term's weights to [0, 1], absent terms counting as 0; a constant term gives 0.

    ``fit`` picks the documents that give the bounds; others may go beyond 1.
    """
    fitted, documents = (weights, documents) if fit is None else (weights.filter(fit), documents.filter(fit))
    total = documents.agg(F.count(F.lit(1))).scalar()
    bounds = fitted.groupBy("term").agg(
        F.min("weight").alias("low"), F.max("weight").alias("high"), F.count(F.lit(1)).alias("docs")
    )
    low = F.when(F.col("docs") < total, F.least("low", F.lit(0.0))).otherwise(F.col("low"))
    bounds = bounds.select("term", low.alias("low"), F.col("high"))
    scaled = F.coalesce(F.try_divide(F.col("weight") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
    return skew_join(weights, bounds, ["term"]).select(doc, "term", scaled.alias("weight"))


def fit_naive_bayes(weights: DataFrame, classes: DataFrame, doc: str, label: str) -> DataFrame:
    """Per term the summed weight in each class where it occurs: (term, label, mass)."""
    return materialize(
        weights.join(classes, doc).groupBy("term", label).agg(F.sum("weight").alias("mass")), "nb"
    )


def class_terms(masses: DataFrame, classes: DataFrame, label: str, smoothing: float) -> DataFrame:
    """One row: array of (label, log prior, log of the class mass with smoothing)."""
    terms = masses.agg(F.countDistinct("term")).scalar()
    docs = classes.agg(F.count(F.lit(1))).scalar()
    per_class = (
        classes.groupBy(label)
        .agg(F.count(F.lit(1)).alias("docs"))
        .join(masses.groupBy(label).agg(F.sum("mass").alias("all")), label, "left")
    )
    mass = F.coalesce("all", F.lit(0.0)) + smoothing * terms
    entry = F.struct(F.col(label).alias("label"), F.ln(F.col("docs") / docs).alias("prior"), F.ln(mass).alias("mass"))
    return per_class.agg(F.sort_array(F.collect_list(entry)).alias("classes"))


def predict_naive_bayes(
    masses: DataFrame,
    classes: DataFrame,
    weights: DataFrame,
    documents: DataFrame,
    doc: str,
    label: str,
    smoothing: float = 1.0,
) -> DataFrame:
    """Most probable class per document as (doc, predicted); unknown terms are skipped.

    A term absent from a class adds ln(smoothing), so only the classes in
    which it occurs are joined and summed.
    """
    base = F.ln(F.lit(float(smoothing)))
    gain = F.ln(F.col("mass") + smoothing) - base
    per_term = masses.groupBy("term").agg(
        F.collect_list(F.struct(F.col(label).alias("label"), gain.alias("gain"))).alias("gains")
    )
    known = skew_join(weights.select(doc, "term", "weight"), per_term, ["term"])
    # the row with a null label carries the plain weight of the document
    every = F.array(F.struct(F.lit(None).cast(masses.schema[label].dataType).alias("label"), F.lit(1.0).alias("gain")))
    sums = (
        known.select(doc, "weight", F.inline(F.concat("gains", every)))
        .groupBy(doc, "label")
        .agg(F.sum(F.col("weight") * F.col("gain")).alias("s"))
        .groupBy(doc)
        .agg(F.collect_list(F.struct("label", "s")).alias("sums"))
    )
    none = F.array().cast("array<struct<label:{},s:double>>".format(masses.schema[label].dataType.simpleString()))
    rows = (
        documents.select(doc)
        .join(sums, doc, "left")
        .withColumn("sums", F.coalesce("sums", none))
        .withColumn("classes", class_terms(masses, classes, label, smoothing).scalar())
    )

    def pick(test):
        return F.aggregate(F.filter("sums", test), F.lit(0.0), lambda a, e: a + e["s"])

    weight = pick(lambda e: e["label"].isNull())
    scored = F.transform(
        F.col("classes"),
        lambda c, i: F.struct(
            F.round(c["prior"] + pick(lambda e: e["label"] == c["label"]) + weight * (base - c["mass"]), 6).alias("s"),
            (-i).alias("first"),
            c["label"].alias("label"),
        ),
    )
    return rows.select(doc, F.array_max(scored)["label"].alias("predicted"))


def dense_terms(weights: DataFrame, chosen: DataFrame, documents: DataFrame, doc: str, k: int) -> DataFrame:
    """(doc, features array of length k) for the terms of :func:`k_best`."""
    placed = weights.join(F.broadcast(chosen.select("term", "rank").filter(F.col("rank") <= k)), "term")  # k rows
    rows = placed.groupBy(doc).agg(F.map_from_entries(F.collect_list(F.struct("rank", "weight"))).alias("m"))
    empty = F.create_map().cast("map<bigint,double>")
    filled = documents.select(doc).join(rows, doc, "left").withColumn("m", F.coalesce("m", empty))
    ranks = F.sequence(F.lit(1), F.lit(k)).cast("array<bigint>")
    return filled.select(
        doc, F.transform(ranks, lambda r: F.coalesce(F.try_element_at("m", r), F.lit(0.0))).alias("features")
    )
