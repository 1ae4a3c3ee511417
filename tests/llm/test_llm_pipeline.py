"""The pipeline's stages, each against a plain version on its own input."""

import importlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from samples import SMALL, no_docs, odd_docs, odd_rows, words
from test_llm_models import plain_components
from test_llm_search import nearest, plain_ids, targets

import corpus_pipeline
from larkspur.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test data")


def as_rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def check_groups(before, after):
    """One row of each component is left, that with the smallest id."""
    want = {key for _, _, key in plain_components(before) if key is not None}
    kept = Counter(r[0] for r in after if r[0] is not None)
    assert set(kept) == want and set(kept.values()) <= {1}


def check_mix(before, after):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r[3]] += len(words(r[1]))
    for r in after:
        taken[r[3]] += len(words(r[1]))
    want = targets(dict(sizes), (3, 1, 2), 1.5, 2)
    for s in sizes:
        assert taken[s] == nearest([len(words(r[1])) for r in before if r[3] == s], want[s])
    times, there = Counter(after), Counter(before)
    assert set(times) <= set(there) and all(n <= 2 * there[r] for r, n in times.items())


def check_windows(before, pieces):
    lengths = Counter((r[0], len(plain_ids(r[1]))) for r in before)
    got = Counter()
    for p in pieces:
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
    assert got == Counter({k: k[1] * n for k, n in lengths.items()})


@needs_data
def test_every_stage_on_what_the_one_before_kept(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "language identification", "n-gram Jaccard join", "mixing sources to target weights", "packing",
    ]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    seen = [as_rows(docs)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SMALL), "stage")
        assert docs.columns == COLUMNS
        seen.append(as_rows(docs))
    raw, good, known, single, mixed = seen
    assert set(good) <= set(raw) and set(known) <= set(good) and set(single) <= set(known)
    right = [labels[r[0]] == (r in set(good)) for r in raw if r[0] in labels]
    assert sum(right) >= 0.95 * len(right)
    lettered = [r for r in good if any(c.isalpha() for c in r[1] or "")]
    assert len(known) >= 0.98 * len(lettered)
    check_groups(known, single)
    check_mix(single, mixed)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_windows(mixed, pieces)
    assert corpus_pipeline.run(spark, SMALL).count() == len(pieces)


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [r for r in odd_rows() if len(r[1] or "") < 20_000]
    labels = [(i, int(i % 3 > 0), 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for wide in (odd_docs(spark, rows), no_docs(spark)):
        docs = materialize(wide.select(*COLUMNS), "odd")
        before = as_rows(docs)
        by_name = {n: f(spark, docs, str(tmp_path)) for n, f in corpus_pipeline.STAGES}
        for name, out in by_name.items():
            if name != "packing":
                assert out.columns == COLUMNS and set(as_rows(out)) <= set(before)
        check_groups(before, as_rows(by_name["n-gram Jaccard join"]))
        check_mix(before, as_rows(by_name["mixing sources to target weights"]))
        check_windows(before, by_name["packing"].collect())


def test_near_duplicates_are_of_five_words_and_four_fifths(spark):
    base = [f"w{i}" for i in range(200)]
    short = [f"v{i}" for i in range(50)]
    texts = [
        base, base + [f"x{i}" for i in range(40)],  # 196 of 236 runs of five
        short, short[:25] + ["other"] + short[26:],  # 41 of 51
        [f"u{i}" for i in range(200)], [f"u{i}" for i in range(200)] + [f"y{i}" for i in range(52)],  # 196 of 248
    ]
    rows = [(i, " ".join(t), "en", "a", len(" ".join(t))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = as_rows(corpus_pipeline.keep_one_of_a_group(spark, docs, SMALL))
    want = {key for _, _, key in plain_components(rows, 5, 80)}
    assert sorted(r[0] for r in got) == sorted(want) == [0, 2, 4, 5]
    assert {key for _, _, key in plain_components(rows)} == set(range(6))


def test_the_rest_stands_without_the_subpackage(monkeypatch):
    import builtins

    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}
    whole = builtins.__import__

    def without(name, *args, **more):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return whole(name, *args, **more)

    monkeypatch.setattr(builtins, "__import__", without)
    importlib.reload(entry)
    assert len(entry.queries()) > 140 and not any(q.startswith("op") and q[2].isdigit() for q in entry.queries())
