"""Phrases whose words keep company, mined by joins of sorted occurrence relations (SETM).

A relation holds the occurrences of the frequent phrases of one length, in the order of their
places, packed in slices of the corpus of one group (language). Places count words and
the signs that end a piece alike, so phrases at neighbouring places lie in one piece.
A relation is written down, merged with itself at neighbouring places (two phrases of k words
that overlap in k - 1 are one of k + 1), counted by pair, and semi-joined with the pairs
that are frequent: what is left is the relation of the next length.

A phrase is a number of its length: the pair of numbers of its first and last k words names
one of k + 1 words exactly, without hashes, and no phrase's text is moved before the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.bytetext import slices
from larkspur.llm.lookup import SMALL_TABLE, Found, record, slice_names, sum_by, with_lookup
from larkspur.llm.registry import query, table
from larkspur.operators.chunks import with_ordinal
from larkspur.operators.skew import skew_join
from larkspur.session import materialize

LEAST = 100  # occurrences of a phrase
LONGEST = 5  # words of a phrase
TOP = 2000  # phrases of a group
SLICE_BYTES = 4 << 20
FLUSH = 2_000_000  # distinct pairs that a task holds before it sends them
MOST_PHRASES = 1 << 31  # frequent phrases of a length that a pair of numbers in 64 bits can tell apart

_TOKEN = re.compile(rb"[.,;:!?\n-\r]|[^ \t.,;:!?\n-\r]+")
_ENDS = [bytes([b]) for b in b".,;:!?\n\x0b\x0c\r"]

_WORDS = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary())])
_GRAMS = pa.schema([("slice", pa.int64()), ("size", pa.int64()), ("mask", pa.binary()), ("grams", pa.binary())])


def word_occurrences(docs: DataFrame, text: str, group: str) -> DataFrame:
    """(slice, lang, words, counts, codes): the places of a slice as positions in its words, -1 where a piece ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = slice_names()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                by_lang: dict[str, list[bytes]] = {}
                for lang, whole in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    by_lang.setdefault(lang, []).append(whole)
                for lang, texts in by_lang.items():
                    tokens = _TOKEN.findall(b"\n".join(texts).lower())  # of bytes: A-Z alone
                    known = dict.fromkeys(tokens)
                    for end in _ENDS:
                        known.pop(end, None)
                    code = {w: i for i, w in enumerate(known)}
                    code.update(dict.fromkeys(_ENDS, -1))
                    codes = np.fromiter(map(code.__getitem__, tokens), np.int32, len(tokens))
                    counts = np.bincount(codes[codes >= 0], minlength=len(known))
                    words = [w.decode() for w in known]
                    yield record({"slice": next(names), "lang": lang, "words": words, "counts": counts.tolist(), "codes": codes}, _WORDS)

    rows = docs.select(
        F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    schema = "slice long, lang string, words array<string>, counts array<long>, codes binary"
    return materialize(rows.mapInArrow(run, schema), "words")


def _packed(name: int, at: np.ndarray, grams: np.ndarray, size: int) -> pa.RecordBatch:
    mask = np.zeros(size, bool)
    mask[at] = True
    return record({"slice": name, "size": size, "mask": np.packbits(mask), "grams": grams.astype(np.uint32)}, _GRAMS)


def _places(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The places of a relation's slice in order, and the phrase at each."""
    at = np.flatnonzero(np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=row["size"]))
    return at, np.frombuffer(row["grams"], np.uint32).astype(np.int64)


def _pairs(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Merge of a slice with itself at neighbouring places: place and pair of numbers."""
    at, grams = _places(row)
    next_to = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[next_to], grams[next_to] << 32 | grams[next_to + 1]


def first_relation(words: DataFrame, frequent: DataFrame, small_table: int = SMALL_TABLE) -> DataFrame:
    """Occurrences of frequent words: each slice's words semi-joined with (lang, word, id).

    Up to ``small_table`` frequent words are sent to every task and looked up there; of more, those of a slice are found by a join.
    """
    schema = "slice long, size long, mask binary, grams binary"

    def relation(name: int, codes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        grams = ids[codes]  # the last is that of ends
        at = np.flatnonzero(grams >= 0)
        return _packed(name, at, grams[at], len(codes))

    if frequent.limit(small_table + 1).count() <= small_table:
        held = frequent.select("lang", "word", "id").toArrow()
        known = {}
        for lang in pc.unique(held.column("lang")).to_pylist():
            own = held.filter(pc.equal(held.column("lang"), lang))
            known[lang] = own.column("word").cast(pa.string()).combine_chunks(), own.column("id").to_numpy()
        sent = words.sparkSession.sparkContext.broadcast(known)

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                name, lang, local, codes = (batch.column(j) for j in range(4))
                for i in range(batch.num_rows):
                    some, ids = sent.value.get(lang[i].as_py(), (None, None))
                    if some is None:
                        continue
                    place = pc.index_in(local[i].values.cast(pa.string()), value_set=some)
                    found = place.is_valid().to_numpy(zero_copy_only=False)
                    if found.any():
                        own = np.full(len(found) + 1, -1, np.int64)
                        own[:-1][found] = ids[place.drop_null().to_numpy()]
                        yield relation(name[i].as_py(), np.frombuffer(codes[i].as_buffer(), np.int32), own)

        return materialize(words.select("slice", "lang", "words", "codes").mapInArrow(look, schema), "grams")

    local = words.select("slice", "lang", F.posexplode("words").alias("code", "word"))
    met = skew_join(local, frequent, ["lang", "word"]).groupBy("slice")
    own = met.agg(F.collect_list("code").alias("code"), F.collect_list("id").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                codes = np.frombuffer(row["codes"], np.int32)
                ids = np.full(int(codes.max(initial=-1)) + 2, -1, np.int64)
                ids[np.array(row["code"])] = row["id"]
                yield relation(row["slice"], codes, ids)

    joined = words.select("slice", "codes").join(own, "slice")
    return materialize(joined.mapInArrow(run, schema), "grams")


def count_pairs(relation: DataFrame) -> DataFrame:
    """(key, n): how often two phrases of the relation stand at neighbouring places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                found = _pairs(batch.slice(i, 1).to_pylist()[0])[1]
                found, times = sum_by(found, np.ones(len(found), np.int64))
                keys, counts = sum_by(np.concatenate([keys, found]), np.concatenate([counts, times]))
                if len(keys) > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])
                    keys, counts = keys[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    return relation.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def next_relation(relation: DataFrame, frequent: DataFrame, small_table: int) -> DataFrame:
    """Occurrences of the phrases one word longer that are in ``frequent`` (key, id)."""

    def run(row: dict, found: Found) -> Iterator[pa.RecordBatch]:
        at, keys = _pairs(row)
        known, (ids,) = found(keys)
        if known.any():
            yield _packed(row["slice"], at[known], ids, row["size"])

    schema = "slice long, size long, mask binary, grams binary"
    return materialize(with_lookup(relation, lambda row: _pairs(row)[1], frequent, run, schema, small_table), "grams")


def _numbered(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``counts`` with an ``id`` from 0 in the order of ``keys``."""
    made = materialize(with_ordinal(counts, [], keys, "id").withColumn("id", F.col("id") - 1), "frequent")
    if (made.agg(F.max("id")).first()[0] or 0) >= MOST_PHRASES:
        raise ValueError(f"more than {MOST_PHRASES} frequent phrases of one length")
    return made


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int | None = TOP,
    small_table: int = SMALL_TABLE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each group that hold together best.

    Texts are lower-cased (A-Z only), cut into pieces at ``.,;:!?`` and line ends, and those into words at
    blanks and tabs. A phrase of 2 to ``longest`` words that occurs at least ``least`` times in its group, overlaps
    included, is a candidate. Cut after its first words, it has the counts l and r of its parts; n is the number of words of the group. The cut with
    the lowest floor(1000 * a * n / (l * r)), the earliest of equal ones, gives the score. Candidates that lie inside
    a longer one as frequent as themselves go. The first ``top`` of each group by score, count and text are returned
    (None: all).

    A null or empty text has no words, a null group is ``und``, repeated rows count as often as they stand there. A
    long text or a long piece is one slice of its own and is not cut. An empty table gives no rows. Columns other than
    ``text`` and ``group`` are not read.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    words = word_occurrences(docs, text, group)
    whole = F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c)
    totals = words.groupBy("lang").agg(F.sum(whole).alias("total"))
    counted = (
        words.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("c"))))
        .groupBy("lang", "word")
        .agg(F.sum("c").alias("a"))
        .filter(F.col("a") >= least)
    )
    frequent = _numbered(counted, ["lang", "word"])
    relation = first_relation(words, frequent.select("lang", "word", "id"), small_table)
    none = F.array().cast("array<bigint>")
    phrases = frequent.select("id", "lang", F.array("word").alias("words"), "a", none.alias("ls"), none.alias("rs"))
    found = None
    for size in range(2, longest + 1):
        pairs = _numbered(count_pairs(relation).filter(F.col("n") >= least), ["key"])
        parts = pairs.select(
            "id", "key", F.col("n").alias("a"), F.shiftright("key", 32).alias("first"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("rest")
        )
        longer = _longer(parts, phrases)
        if size > 2:
            phrases = _mark_covered(phrases, parts)
            found = phrases if found is None else found.unionByName(phrases)
        phrases = materialize(longer, "phrases")
        if size < longest:
            relation = next_relation(relation, pairs.select("key", "id"), small_table)
    last = phrases.withColumn("covered", F.lit(False))
    found = last if found is None else found.unionByName(last)
    return _best(found.filter(~F.col("covered")), totals, top)


def _longer(parts: DataFrame, phrases: DataFrame) -> DataFrame:
    """The phrases that pairs of shorter ones make, with the counts of the parts at every cut."""
    first = phrases.select(
        F.col("id").alias("first"), "lang", F.col("words").alias("_w"), F.col("a").alias("_fa"), F.col("ls").alias("_ls")
    )
    rest = phrases.select(
        F.col("id").alias("rest"), F.element_at("words", -1).alias("_last"), F.col("a").alias("_ra"), F.col("rs").alias("_rs")
    )
    both = skew_join(skew_join(parts, first, ["first"]), rest, ["rest"])
    return both.select(
        "id", "lang", F.concat("_w", F.array("_last")).alias("words"), "a",
        F.concat("_ls", F.array("_fa")).alias("ls"), F.concat(F.array("_ra"), "_rs").alias("rs"),
    )


def _mark_covered(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """``covered``: some phrase one word longer is as frequent; one of more words would make that one so too."""
    ends = parts.select("a", F.explode(F.array("first", "rest")).alias("id"))
    above = ends.groupBy("id").agg(F.max("a").alias("_above"))
    return skew_join(phrases, above, ["id"], "left").withColumn("covered", F.coalesce(F.col("_above") >= F.col("a"), F.lit(False))).drop("_above")


def _best(found: DataFrame, totals: DataFrame, top: int | None) -> DataFrame:
    """Scores and ranks. Decimals of 38 digits hold the products, and ``div`` drops the fraction."""
    wide = lambda c: c.cast("decimal(38,0)")
    above = F.lit(1000).cast("decimal(38,0)") * wide(F.col("a")) * wide(F.col("total"))
    cuts = F.transform(
        F.arrays_zip(F.col("ls").alias("l"), F.col("rs").alias("r")),
        lambda c, i: F.struct(F.call_function("div", F.col("_above"), wide(c["l"]) * wide(c["r"])).alias("score"), i, c["l"].alias("l"), c["r"].alias("r")),
    )
    scored = skew_join(found, totals, ["lang"]).withColumn("_above", above).withColumn("_cut", F.array_min(cuts))
    flat = scored.select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"),
        F.col("total").alias("n"), F.col("_cut.score").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is None:
        down = flat.withColumn("_s", -F.col("score")).withColumn("_a", -F.col("a"))
        ranked = with_ordinal(down, ["lang"], ["_s", "_a", "phrase"], "rank")
    else:
        # the best of each part of a group first, so that no task ranks a whole group
        tasks = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        some = flat.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(tasks)))
        place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
        some = some.withColumn("_place", place("lang", "_part")).filter(F.col("_place") <= top)
        ranked = some.withColumn("rank", place("lang")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(p) AS piece_text FROM (
            SELECT lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents)),
    worded AS (SELECT lang, list_filter(regexp_split_to_array(piece_text, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
    sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY 1),
    spans AS (SELECT lang, w, unnest(range(1, 6)) AS m FROM worded),
    starts AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM spans WHERE len(w) >= m),
    grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a FROM starts GROUP BY 1, 2, 3),
    frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE a >= 100),
    candidates AS (SELECT * FROM frequent WHERE m > 1),
    cuts AS (SELECT lang, phrase, m, a, w, unnest(range(1, m)) AS k FROM candidates),
    parts AS (
        SELECT c.lang, c.phrase, c.m, c.a, c.k, f.a AS l, g.a AS r, n,
               (1000::HUGEINT * c.a * n) // (f.a::HUGEINT * g.a) AS score
        FROM cuts c JOIN sizes s ON s.lang = c.lang
        JOIN frequent f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1:c.k], ' ')
        JOIN frequent g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
    lowest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_ AS (
        SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(a) AS above FROM (
            SELECT lang, w, m, a, j, unnest(range(1, m - j + 2)) AS i FROM (
                SELECT *, unnest(range(2, m)) AS j FROM candidates)) GROUP BY 1, 2),
    kept AS (SELECT l.* FROM lowest l LEFT JOIN inner_ x ON x.lang = l.lang AND x.phrase = l.phrase
             WHERE x.above IS NULL OR 100 * x.above < 100 * l.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
           a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
    FROM kept QUALIFY rank <= 2000"""


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark, sf_dir):
    """The first 2,000 phrases of every language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))
