"""Language identification with spans of mixed-language text.

Words are runs of letters. The script of a word narrows the languages it can be in,
hashed character n-grams score it in each, and Viterbi's algorithm with a penalty
for switching labels the words of a text. The language with most letters is the
text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bytetext import mix64, utf8
from larkspur.llm.registry import query, table

BUCKETS_BITS = 16  # hashed n-grams of a language
ORDERS = (1, 2, 3)
MAX_PER_LANGUAGE = 2_000  # training texts of a language, about; more are sampled by hash
SWITCH = 8.0  # log-probability that a change of language costs
WEIGHT = 0.5  # of an n-gram's log-probability: neighbouring n-grams are not independent
FOREIGN = 30.0  # what a word in a script that the language does not use costs
USED = 0.01  # share of a language's letters from which it uses a script
SLICE_BYTES = 1 << 20

# First and last code point of script ranges, as in the Unicode charts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F), ("sinhala", 0x0D80, 0x0DFF), ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF),
    ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x323AF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it a letter, its lower case, its script."""
    every = 0x110000
    letter = np.fromiter((chr(i).isalpha() for i in range(every)), bool, every)
    lower = np.arange(every, dtype=np.uint32)
    for i in np.flatnonzero(letter[:0x20000]).tolist():
        small = chr(i).lower()
        if len(small) == 1:
            lower[i] = ord(small)
    script = np.zeros(every, np.uint8)
    for name, first, last in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return letter, lower, script


class Letters:
    """Words of a column of texts as lower-cased code points."""

    def __init__(self, texts: pa.Array):
        letter, lower, script = _characters()
        data, offsets = utf8(texts)
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        before = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=before[1:])
        at = before[offsets]
        self.rows = len(texts)
        solid = letter[points]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        edges = at[:-1][at[:-1] < len(points)]
        first[edges] |= solid[edges]
        begins = np.flatnonzero(first)
        self.row = np.searchsorted(at, begins, "right") - 1
        self.begin = begins - at[self.row]  # in the text
        self.points = lower[points[solid]]
        self.starts = np.flatnonzero(first[solid])
        self.lengths = np.diff(np.append(self.starts, len(self.points)))
        self.script = script[self.points[self.starts]] if len(begins) else np.zeros(0, np.uint8)
        self.counts = np.bincount(self.row, minlength=self.rows)

    def ngrams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order: hashed n-grams in word order, and each word's first; a mark stands at both ends."""
        n = len(self.starts)
        width = self.lengths + 2
        ends = np.cumsum(width)
        padded = np.ones(int(ends[-1]) if n else 0, np.uint64)
        word = np.repeat(np.arange(n), self.lengths)
        padded[np.arange(len(self.points)) + 2 * word + 1] = self.points
        owner = np.repeat(np.arange(n), width)
        for order in ORDERS:
            m = max(0, len(padded) - order + 1)
            found = np.full(m, order, np.uint64)
            for k in range(order):
                found = found * np.uint64(0x9E3779B97F4A7C15) + padded[k : k + m]
            whole = owner[:m] == owner[order - 1 :]
            starts = np.concatenate([[0], np.cumsum(width - order + 1)[:-1]]) if n else np.zeros(0, np.int64)
            yield (mix64(found[whole]) >> np.uint64(64 - BUCKETS_BITS)).astype(np.int64), starts.astype(np.int64)


class LanguageModel:
    """Log-probability of each hashed n-gram in each language, and which scripts it uses."""

    def __init__(self, names: list[str], texts: np.ndarray, grams: np.ndarray, scripts: np.ndarray):
        """Counts by language: texts, n-grams by bucket, letters of word beginnings by script."""
        self.names, self.texts = names, texts
        smooth = grams + 0.5
        self.table = np.ascontiguousarray((WEIGHT * np.log(smooth / smooth.sum(1, keepdims=True))).T.astype(np.float32))
        self.uses = scripts >= USED * np.maximum(scripts.sum(1, keepdims=True), 1)
        self.uses &= scripts > 0

    def word_scores(self, words: Letters) -> np.ndarray:
        """(word, language), the best 0. A word in a script that no language uses says nothing."""
        total = np.zeros((len(words.starts), len(self.names)), np.float32)
        for grams, starts in words.ngrams():
            if len(grams):
                total += np.add.reduceat(self.table[grams], starts, axis=0)
        able = self.uses[:, words.script].T
        total[~able] = -np.inf
        known = able.any(1)
        total[known] -= total[known].max(1, keepdims=True)
        total[~known] = 0.0
        return np.maximum(total, -FOREIGN)

    def label_words(self, words: Letters) -> np.ndarray:
        """The language of each word on the best path through its text, all texts step by step at once."""
        score, n_lang = self.word_scores(words), len(self.names)
        stay = np.ones((len(score), n_lang), bool)
        jump = np.zeros(len(score), np.int32)
        first = np.concatenate([[0], np.cumsum(words.counts)[:-1]])
        order = np.argsort(-words.counts, kind="stable")
        count, first = words.counts[order], first[order]
        steps = int(count[0]) if len(count) else 0
        active = np.searchsorted(-count, -np.arange(steps), "left")  # texts with more than t words come first
        label = np.zeros(len(score), np.int32)
        if not steps:
            return label
        path = score[first[: active[0]]].copy()
        last = np.zeros(active[0], np.int32)
        for t in range(1, steps):
            n = active[t]
            if n < len(path):
                last[n : len(path)] = path[n:].argmax(1)
                path = path[:n]
            at = first[:n] + t
            best = path.argmax(1)
            turn = path[np.arange(n), best] - SWITCH
            stay[at] = path >= turn[:, None]
            jump[at] = best
            path = np.maximum(path, turn[:, None]) + score[at]
            path -= path.max(1, keepdims=True)
        last[: len(path)] = path.argmax(1)
        state = last
        for t in range(steps - 1, -1, -1):
            n = active[t]
            at = first[:n] + t
            label[at] = state[:n]
            state[:n] = np.where(stay[at, state[:n]], state[:n], jump[at])
        return label

    def read(self, texts: pa.Array) -> tuple[list, np.ndarray, list]:
        """Language, score and spans (language, first and last code point + 1) of each text."""
        words = Letters(texts)
        label = self.label_words(words)
        n_lang = len(self.names)
        letters = np.bincount(words.row * n_lang + label, words.lengths, minlength=words.rows * n_lang)
        letters = letters.reshape(words.rows, n_lang)
        total = letters.sum(1)
        best = letters.argmax(1)
        # without any evidence: the language of most training texts, at score 0
        seen = self.uses.any(0)[words.script]
        evidence = np.bincount(words.row, seen * words.lengths, minlength=words.rows)
        best[evidence == 0] = int(np.argmax(self.texts))
        score = np.where(evidence > 0, letters[np.arange(words.rows), best] / np.maximum(total, 1), 0.0)
        names = [self.names[b] if t else "und" for b, t in zip(best.tolist(), total.tolist())]
        new = np.ones(len(label), bool)
        new[1:] = (label[1:] != label[:-1]) | (words.row[1:] != words.row[:-1])
        at = np.flatnonzero(new)
        stop = np.append(at[1:], len(label))[: len(at)] - 1
        spans: list[list] = [[] for _ in range(words.rows)]
        ends = words.begin + words.lengths
        for r, s, b, e in zip(words.row[at].tolist(), label[at].tolist(), words.begin[at].tolist(), ends[stop].tolist()):
            spans[r].append({"lang": self.names[s], "begin": b, "end": e})
        return names, score, spans


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    size, at = utf8(texts)[1], 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES, "right")) - 1)
        yield texts.slice(at, end - at)
        at = end


def fit_languages(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model from about ``MAX_PER_LANGUAGE`` texts of each language; rows with a null text or language are left out.

    What reaches the driver is one number for each of the fixed buckets of each language.
    """
    known = labelled.select(*dict.fromkeys([key, text, lang])).filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(lang).agg(F.count(F.lit(1)).alias("_texts"))
    share = F.least(F.lit(1.0), F.lit(float(MAX_PER_LANGUAGE)) / F.col("_texts"))
    # one row for each language
    some = known.join(F.broadcast(sizes), lang).filter(
        F.pmod(F.xxhash64(F.lit(9), key), F.lit(1 << 20)) < F.floor(share * (1 << 20))
    )
    scripts = len(SCRIPT_NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            at = 0
            for part in _parts(batch.column(1)):
                words = Letters(part)
                for name in dict.fromkeys(langs[at : at + len(part)]):
                    own = langs[at : at + len(part)] == name
                    mine = own[words.row]
                    total = totals.setdefault(name, np.zeros((1 << BUCKETS_BITS) + scripts + 1, np.int64))
                    total[-1] += own.sum()
                    total[1 << BUCKETS_BITS : -1] += np.bincount(words.script[mine], minlength=scripts)
                    for grams, starts in words.ngrams():
                        size = np.diff(np.append(starts, len(grams)))
                        total[: 1 << BUCKETS_BITS] += np.bincount(grams[np.repeat(mine, size)], minlength=1 << BUCKETS_BITS)
                at += len(part)
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["lang", "place", "n"]
            )

    texts = some.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = texts.repartition(SHARDS).mapInArrow(count, "lang string, place long, n long")
    found = counts.groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(found["lang"].unique())
    every = np.zeros((len(names), (1 << BUCKETS_BITS) + scripts + 1))
    every[[names.index(x) for x in found["lang"]], found["place"].to_numpy()] = found["n"].to_numpy()
    return LanguageModel(names, every[:, -1], every[:, : 1 << BUCKETS_BITS], every[:, 1 << BUCKETS_BITS : -1])


SHARDS = 12  # tasks that count a bounded sample


def read_languages(model: LanguageModel):
    """A column function: struct of ``lang_pred``, ``score`` and ``spans`` for a text."""
    kind = "lang_pred string, score double, spans array<struct<lang:string,begin:bigint,end:bigint>>"
    span = pa.list_(pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf(kind)
    def read(texts: pa.Array) -> pa.Array:
        if not model.names:
            n = len(texts)
            columns = [pa.array(["und"] * n), pa.array(np.zeros(n)), pa.array([[]] * n, span)]
            return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "spans"])
        names, scores, spans = [], [], []
        for part in _parts(texts):
            a, b, c = model.read(part)
            names, spans = names + a, spans + c
            scores.append(b)
        score = pa.array(np.concatenate(scores) if scores else np.zeros(0))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), score, pa.array(spans, span)], ["lang_pred", "score", "spans"])

    return read


def identify_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (the share of letters in that language) and ``spans``; a row for each row.

    Learns from rows with a language whose crc32 of the key modulo 4 is not 2; only the
    text is read for a prediction. A null text, or one without a letter, is ``und`` with
    score 0; so is every text if nothing can be learned. Languages with as many letters go
    by name. Repeated rows are read one by one. Columns with the new names are replaced.
    """
    from larkspur.llm.quality_model import held_out

    model = fit_languages(docs.filter(~held_out(F.col(key), 4, 2) & F.col(key).isNotNull()), key, text, lang)
    rest = docs.drop("lang_pred", "score", "spans")
    found = rest.withColumn("_read", read_languages(model)(F.col(text).cast("string")))
    return found.select(*rest.columns, "_read.lang_pred", "_read.score", "_read.spans")


@query("op10_languages")
def op10_languages(spark, sf_dir):
    """Every document's language."""
    from larkspur.llm.quality_model import held_out

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify_languages(docs)
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
