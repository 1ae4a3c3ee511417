"""Small tables with the awkward cases, and plain versions of what operators share."""

import random
import re
import zlib

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("score", "size", "n", "key", "id", "name", "kept", "row", "spans")],
    ]
)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def crc(key, parts):
    return zlib.crc32(str(key).encode()) % parts


def odd_rows(seed=1):
    """Null, empty, blank, very long, repeated and unusual texts; null ids, languages and sources."""
    pick = random.Random(seed)
    some = ["the", "of", "house", "runs", "Quick", "blue", "tree", "éclair", "x1", "night"]
    prose = lambda n: " ".join(pick.choice(some) + pick.choice(["", "", ".", "\n"]) for _ in range(n))
    shared = prose(60)
    texts = [
        None, "", " \t\n\x0b\f\r ", "one", "one two", "ONE TWO", "one two three four", shared, shared, shared + " more",
        prose(30_000), "a" * 60_000, "12 34 !!! ### $$", "Привет мир это текст", "\U0001f600 \U0001f600 smile", "a  b\n\n c ",
        "\u00a0nbsp\u2003wide", "line\nline\nline", prose(25), prose(200),
    ]
    rows = []
    for i, text in enumerate(texts):
        lang = pick.choice(["en", "fr", None])
        source = pick.choice(["a", "b", "é", None])
        rows.append((i, text, lang, source, len(text or ""), *["x"] * 9))
    rows.append((None, "no id at all here", None, None, None, *[None] * 9))
    rows += [rows[7], rows[7], rows[4], rows[0]]
    return rows


def odd_docs(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
