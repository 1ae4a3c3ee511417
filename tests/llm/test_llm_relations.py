"""Phrases, token alignment and content sort: against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import SMALL, lower, no_docs, odd_docs, odd_rows

from larkspur.llm import alignment, collocations, content_sort, lookup
from larkspur.llm.catalog import QUERIES

needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test data")


# phrases


def best_phrases(rows, least, longest, top):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts[lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, found in counts.items():
        kept = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        inside = set()
        for q, b in kept.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    if b >= kept.get(q[i : i + m], 0):
                        inside.add(q[i : i + m])
        rows = []
        for p, a in kept.items():
            score, k = min((1000 * a * sizes[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            if p not in inside:
                rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -s))
    return sorted(out)


def prose(seed, texts=60):
    pick = random.Random(seed)
    some = ["new", "York", "city", "of", "the", "Éclair", "x1", " ", "sun"]
    cut = [" ", " ", " ", "  ", "\t", ". ", "\n", ", ", "!"]
    return [
        ("".join(pick.choice(some) + pick.choice(cut) for _ in range(pick.randint(0, 60))) + "in the long run of it", pick.choice(["en", "fr", None, "und", ""]))
        for _ in range(texts)
    ]


@pytest.mark.parametrize("least, longest, top", [(2, 5, 2000), (3, 2, 4), (5, 3, None), (1, 4, 7)])
@pytest.mark.parametrize("small", [0, 1000])
def test_phrases_equal_a_plain_count(spark, least, longest, top, small, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 300)
    rows = prose(least)
    docs = spark.createDataFrame([(t, g, 1, "x", "y") for t, g in rows], "text string, lang string, n int, score string, slice string").repartition(3)
    got = collocations.collocations(docs, least=least, longest=longest, top=top, small_table=small)
    assert sorted(tuple(r) for r in got.collect()) == best_phrases(rows, least, longest, top)


def test_frequent_words_are_found_by_either_way(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 300)
    docs = spark.createDataFrame(prose(7) + [("", "de"), (None, None), ("nowhere else", "fr")], "text string, lang string").repartition(3)
    words = collocations.word_occurrences(docs, "text", "lang")
    frequent = [("en", "york", 3), ("en", "éclair", 0), ("und", "york", 5), ("", "sun", 7), ("xx", "of", 2)]
    frequent = spark.createDataFrame(frequent, "lang string, word string, id long")
    joined = sorted(tuple(r) for r in collocations.first_relation(words, frequent, 0).collect())
    # the rows that a join makes of them grow with the words that become frequent, so few are looked up in place
    monkeypatch.setattr(collocations, "skew_join", None)
    found = sorted(tuple(r) for r in collocations.first_relation(words, frequent, 10).collect())
    assert found == joined and joined
    empty = collocations.first_relation(words, frequent.filter("false"), 10)
    assert empty.count() == 0


def test_phrases_of_odd_rows(spark):
    rows = [(r[1], r[2]) for r in odd_rows()]
    got = collocations.collocations(odd_docs(spark), least=3)
    assert sorted(tuple(r) for r in got.collect()) == best_phrases(rows, 3, 5, 2000)
    assert collocations.collocations(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(odd_docs(spark), longest=1)


def test_scores_beyond_64_bits(spark):
    wide = [(1, "en", ["a", "b", "c"], 2 * 10**12, [5 * 10**12, 2 * 10**12], [2 * 10**12, 3 * 10**12])]
    found = spark.createDataFrame(wide, "id long, lang string, words array<string>, a long, ls array<long>, rs array<long>")
    totals = spark.createDataFrame([("en", 7 * 10**13)], "lang string, total long")
    row = collocations._best(found, totals, 10).first()
    scores = [1000 * 2 * 10**12 * 7 * 10**13 // (x * y) for x, y in zip(wide[0][4], wide[0][5])]
    assert row["score"] == min(scores) and row["l"] == wide[0][4][scores.index(min(scores))]


# alignment


def token_bytes(work, ids, kind):
    return [(work.a_bytes if kind == "a" else work.b_bytes)[i] for i in ids]


def plain_alignment(rows):
    """Whole texts encoded at once, ends from the tokens' bytes alone."""
    work = alignment.Aligner(*alignment.public_files())
    docs = []
    for key, text in rows:
        want = (" " + text).encode() if text else b""
        a = work.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = work.b.encode(text) if text else []
        x, y = token_bytes(work, a, "a"), token_bytes(work, b, "b")
        if not text or b"".join(x) != want or b"".join(y) != want:
            docs.append((key, None))
            continue
        ea, eb = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
        cuts = sorted(set(ea) & set(eb))
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(ea[i] - len(x[i]), eb[j] - len(y[j])) < min(ea[i], eb[j])] if len(a) < 400 else None
        groups, low = [], 0
        for cut in cuts:
            groups.append((low, cut, [t for t, e in zip(a, ea) if low < e <= cut], [t for t, e in zip(b, eb) if low < e <= cut]))
            low = cut
        docs.append((key, (a, b, groups, links)))
    return docs


def expected(rows):
    docs = plain_alignment(rows)
    df = Counter(p for _, d in docs if d for p in set(d[3]))
    most = Counter()
    for (a, _), n in df.items():
        most[a] = max(most[a], n)
    out = []
    for key, d in docs:
        if d is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        digest = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for _, _, x, y in groups)
        best = sum(df[p] == most[p[0]] for p in links)
        out.append((key, len(a), len(b), len(groups), len(links), best, sum(df[p] for p in links), hashlib.sha256(digest.encode()).hexdigest()))
    return sorted(out, key=str), df, most


TEXTS = [
    None, "", " ", "  two  blanks ", "plain words here", "Plain words, here!", "été où çà", "漢字 and かな mixed 漢", "😀😀 smile 👩‍👩‍👧", "line\nline\n\n end",
    "tab\tand \t blank", "<|endoftext|> and </s> <s> <unk> <0x41>", "▁ lower ▁block", "nbsp here   there", "a" * 300, "x́y ́z",
    "\x1c odd \x1f", "don't we'll", "12345 67,890.12", "한국어 텍스트 예", "word " * 60, "null \x00 byte", "▁▁", "ﬁ ligature ½", "plain words here",
]


@pytest.mark.parametrize("small", [0, 100_000])
def test_alignment_equals_whole_texts(spark, small, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_BYTES", 200)
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, TEXTS[3]), (3, "other text")]
    docs = spark.createDataFrame([(k, t, "x", 5) for k, t in rows], "doc_id long, text string, slice string, n int").repartition(3)
    got, pairs = alignment.align_tokens(docs, *alignment.public_files(), small_table=small)
    want, df, most = expected(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert {(r["a_id"], r["b_id"]): (r["n"], r["best"]) for r in pairs.collect()} == {p: (n, n == most[p[0]]) for p, n in df.items()}


def test_spans_are_the_groups(spark):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = defaultdict(list)
    for r in alignment.aligned_spans(docs, *alignment.public_files()).orderBy("doc_id", "group").collect():
        got[r["doc_id"]].append((r["begin"], r["end"], r["a_ids"], r["b_ids"]))
    assert dict(got) == {k: d[2] for k, d in plain_alignment(rows) if d}


def test_known_pieces_are_forgotten(monkeypatch):
    work = alignment.Aligner(*alignment.public_files())
    first = [alignment._slice(work, [t or "" for t in TEXTS])[c] for c in ("sha", "n_groups")]
    monkeypatch.setattr(alignment, "KNOWN_BYTES", 1)
    for _ in range(2):
        assert [alignment._slice(work, [t or "" for t in TEXTS])[c] for c in ("sha", "n_groups")] == first
    assert "a" * 300 not in work.known


def test_alignment_of_odd_tables(spark):
    got, pairs = alignment.align_tokens(odd_docs(spark), *alignment.public_files())
    assert got.count() == len(odd_rows())
    long = got.filter("doc_id = 10").first()  # 30,000 words
    assert long["n_a"] > 30_000 and long["n_links"] == long["n_a"] + long["n_b"] - long["n_groups"]
    got, pairs = alignment.align_tokens(no_docs(spark), *alignment.public_files())
    assert got.count() == 0 and pairs.count() == 0


@needs_data
def test_alignment_of_the_query(spark):
    some = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in some.select("doc_id", "text").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op12_align_tokens"](spark, SMALL).collect()}
    assert found.keys() == rows.keys()
    for key, d in plain_alignment(rows.items()):
        a, b, groups, _ = d or ([], [], [], None)
        assert (found[key]["n_a"], found[key]["n_b"], found[key]["n_groups"]) == (len(a), len(b), len(groups))
        digest = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for _, _, x, y in groups)
        assert found[key]["groups_sha256"] == (hashlib.sha256(digest.encode()).hexdigest() if d else "")


# lookups


@pytest.mark.parametrize("small", [0, 10])
def test_lookups_by_either_way(spark, small):
    keys = [[1, 5, 5, 9], [], [5, 2**40, -3]]
    slices = spark.createDataFrame([(i, bytearray(np.array(k, np.int64).tobytes())) for i, k in enumerate(keys)], "slice long, asked binary")
    table = spark.createDataFrame([(5, 50), (2**40, 7), (-3, 1), (8, 8)], "key long, v long")
    asked = lambda row: np.frombuffer(row["asked"], np.int64)

    def run(row, found):
        known, (v,) = found(asked(row))
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([row["slice"]]), pa.array([int(known.sum())]), pa.array([int(v.sum())])], ["slice", "hits", "total"])

    got = lookup.with_lookup(slices, asked, table, run, "slice long, hits long, total long", small)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 2, 100), (1, 0, 0), (2, 3, 58)]


# content sort


def plain_copies(rows, keep):
    groups = defaultdict(list)
    for key, text in rows:
        groups[lower(text)].append(key)
    rank = lambda k: (k is not None, k or 0)
    pick = min if keep == "smallest" else max
    return sorted(
        ((k, pick(g, key=rank), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for k in g), key=str
    )


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("partitions", [1, 40])
def test_copies_are_found_over_ranges(spark, keep, partitions, monkeypatch):
    pick = random.Random(partitions)
    rows = [(i, "Hot text of THIRD of the rows") for i in range(300)]
    rows += [(i, pick.choice(["a", "A", "", None, "é", "É", "x" * 500, "X" * 500, "x" * 500 + "y"])) for i in range(300, 400)]
    rows += [(i, "begins alike, begins alike, begins alike " + str(i % 150)) for i in range(400, 800)]
    rows += [(None, "a"), (None, None), (None, "only here"), (None, "only here"), (5, "a"), (5, "a")]
    pick.shuffle(rows)
    docs = spark.createDataFrame([(k, t, "q", "r") for k, t in rows], "doc_id long, text string, _chunk string, kept_ string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = content_sort.exact_duplicates(docs, keep=keep).collect()
        left = content_sort.drop_exact_duplicates(docs, keep=keep).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == plain_copies(rows, keep)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) == len(left)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert sorted(str(r["doc_id"]) for r in left) == sorted(str(r["doc_id"]) for r in kept)
    assert left[0].__fields__ == ["doc_id", "text", "_chunk", "kept_"]


def test_equal_digests_do_not_make_equal_texts(spark, monkeypatch):
    monkeypatch.setattr(content_sort.F, "sha2", lambda c, n: F.lit("same"))
    docs = spark.createDataFrame([(i, "a text whose first bytes are the same" + str(i % 3)) for i in range(30)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = content_sort.exact_duplicates(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {(r["doc_id"] % 3, r["keep_id"], r["group_size"]) for r in got} == {(0, 0, 10), (1, 1, 10), (2, 2, 10)}


def test_copies_of_odd_tables(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = content_sort.exact_duplicates(odd_docs(spark), carry=["score", "row"])
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got.collect()), key=str) == plain_copies(rows, "smallest")
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "score", "row"]
    exact = content_sort.exact_duplicates(odd_docs(spark), normalise=False).filter("group_size > 1").select("doc_id").collect()
    assert {r[0] for r in exact} == {0, 1, 4, 7, 8}
    assert content_sort.exact_duplicates(no_docs(spark)).count() == 0
    for wrong in ({"keep": "first"}, {"carry": ["kept"]}):
        with pytest.raises(ValueError):
            content_sort.exact_duplicates(odd_docs(spark).withColumn("kept", F.lit(1)), **wrong)
