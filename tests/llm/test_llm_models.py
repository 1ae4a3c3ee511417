"""Classifier, languages, language model, near duplicates: brute force and held-out accuracy."""

import math
import mmap
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import crc, lower, no_docs, odd_docs, odd_rows, words

from larkspur.llm import jaccard_join, language, lm_score, quality_model
from larkspur.llm.catalog import QUERIES
from larkspur.llm.components import components
from larkspur.llm.elias_fano import START, Sequence, Trie, build_trie

MIDDLE = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not Path(MIDDLE).exists(), reason="no test data")


# quality classifier


def test_quality_of_held_out_texts(spark):
    if not Path(MIDDLE).exists():
        pytest.skip("no test data")
    got = QUERIES["op1_quality_model"](spark, MIDDLE)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    assert got.count() == docs.count() and got.filter("score < 0 OR score > 1").count() == 0
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 80 and all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)


def test_quality_of_odd_texts(spark):
    labels = spark.createDataFrame([(3, 1, "x"), (3, 0, "x"), (7, 1, "x"), (13, 0, "x"), (None, 1, "x"), (4, None, "x"), (999, 1, "x")], "doc_id long, quality int, text string")
    got = quality_model.quality_scores(odd_docs(spark), labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    by_text = defaultdict(set)
    for r in got:
        by_text[r["text"]].add(r["score"])
    assert all(len(s) == 1 for s in by_text.values()) and by_text[None] == by_text[""]
    none = quality_model.quality_scores(odd_docs(spark), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_model.quality_scores(no_docs(spark), labels).count() == 0


def test_a_score_is_the_dot_product_of_the_features():
    import pyarrow as pa

    texts = pa.array(["The THE the 12!", "", None, "a a a a", "x" * 500])
    row, bucket, value = quality_model.features(texts, 10)
    weights = np.random.default_rng(1).normal(size=1 << 10)
    dense = np.zeros((5, 1 << 10))
    np.add.at(dense, (row, bucket), value)
    want = 1 / (1 + np.exp(-dense @ weights))
    got = quality_model.score_quality(weights).func(texts).to_numpy()
    assert np.allclose(got, want) and np.allclose(got[1], got[2])


def test_updates_follow_the_regularised_leader():
    data = [(1.0, np.array([0, 2]), np.array([1.0, 0.5])), (0.0, np.array([0, 3]), np.array([1.0, 2.0]))]
    z, n = {}, {}
    alpha, beta, l1, l2 = quality_model.ALPHA, quality_model.BETA, quality_model.L1, quality_model.L2
    weight = lambda i: 0.0 if abs(z.get(i, 0)) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)
    order = np.random.default_rng(5)
    for _ in range(quality_model.EPOCHS):
        for k in order.permutation(2):
            y, at, x = data[k]
            w = [weight(i) for i in at]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i, a, v in zip(at, w, x):
                g = (p - y) * v
                sigma = (math.sqrt(n.get(i, 0) + g * g) - math.sqrt(n.get(i, 0))) / alpha
                z[i], n[i] = z.get(i, 0) + g - sigma * a, n.get(i, 0) + g * g
    got = quality_model.fit_shard(data, 2)
    assert np.allclose(got, [weight(i) if i in z else 0 for i in range(4)])


# languages


@needs_data
def test_languages_of_held_out_texts(spark):
    got = QUERIES["op10_languages"](spark, MIDDLE)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and len(held) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)


def test_spans_of_a_mixed_text(spark):
    en, fr, ru = "the quick house runs over there with them", "le chat est dans la maison avec nous", "привет мир это просто текст для нас"
    rows = [(i, t, name) for i in range(40) for t, name in ((en, "en"), (fr, "fr"), (ru, "ru"))]
    docs = spark.createDataFrame([(i, t, n) for i, (_, t, n) in enumerate(rows)] + [(9000, f"{en}. {fr}. {ru}! {en}", None)], "doc_id long, text string, lang string")
    row = language.identify_languages(docs).filter("doc_id = 9000").first()
    assert [s["lang"] for s in row["spans"]] == ["en", "fr", "ru", "en"] and row["lang_pred"] == "en"
    assert row["text"][row["spans"][2]["begin"] : row["spans"][2]["end"]] == ru
    assert row["score"] == pytest.approx(2 * len(en.replace(" ", "")) / sum(len(x.replace(" ", "")) for x in (en, en, fr, ru)))


def test_languages_of_odd_texts(spark):
    rows = odd_rows()
    got = language.identify_languages(odd_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    learned = {r[2] for r in rows if r[0] is not None and crc(r[0], 4) != 2 and r[2] and r[1] is not None}
    for r in got:
        if any(c.isalpha() for c in r["text"] or ""):
            assert r["lang_pred"] in learned and 0 <= r["score"] <= 1
        else:
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0, [])
    nothing = language.identify_languages(odd_docs(spark, rows).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == len(rows)
    assert language.identify_languages(no_docs(spark)).count() == 0


def test_viterbi_finds_the_best_path():
    import itertools

    import pyarrow as pa

    pick = np.random.default_rng(2)
    texts = pa.array(["ab cd ef gh", "x", "", "q r s t u"])
    model = language.LanguageModel(["a", "b", "c"], np.ones(3), np.ones((3, 1 << language.BUCKETS_BITS)), np.ones((3, len(language.SCRIPT_NAMES))))
    scores = pick.normal(size=(10, 3)).astype(np.float32) * 8
    model.word_scores = lambda words_: scores
    got = model.label_words(language.Letters(texts))
    for begin, end in ((0, 4), (4, 5), (5, 10)):
        value = lambda p: sum(scores[begin + i, s] for i, s in enumerate(p)) - language.SWITCH * sum(a != b for a, b in zip(p, p[1:]))
        best = max(value(p) for p in itertools.product(range(3), repeat=end - begin))
        assert value(got[begin:end].tolist()) == pytest.approx(best, abs=1e-3)


# language model


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (200, 300), (300, 1 << 40)])
def test_sequences_keep_their_values(n, universe):
    pick = np.random.default_rng(n)
    values = np.sort(pick.integers(0, universe, n))
    layout, (low, high) = Sequence.encode(values, universe)
    found = Sequence(**layout, low=low, high=high)
    assert (found[np.arange(n)] == values).all()
    keys = np.unique(np.concatenate([values, values + 1, pick.integers(0, universe, 50), [0, universe + 5]]))
    assert (found.successor(keys) == np.searchsorted(values, keys)).all()


def plain_counts(texts):
    two, three = Counter(), Counter()
    for t in texts:
        for i, w in enumerate(t):
            two[(t[i - 1] if i else START, w)] += 1
            if i:
                three[(t[i - 2] if i > 1 else START, t[i - 1], w)] += 1
    return two, three


def test_trie_probabilities_in_a_mapped_file(tmp_path):
    pick = random.Random(3)
    texts = [[pick.choice([0, 3, 3, 4, 5]) for _ in range(pick.randint(0, 9))] + [1] for _ in range(60)]
    two, three = plain_counts(texts)
    three = Counter({g: n for g, n in three.items() if n > 1})
    follows = np.bincount([w for t in texts for w in t], minlength=6).astype(float)
    contexts = follows.copy()
    contexts[1], contexts[START] = 0, len(texts)
    arrays = [np.array(sorted(c)).reshape(-1, k) for c, k in ((two, 2), (three, 3))]
    counts = [np.array([c[tuple(g)] for g in a.tolist()], float) for c, a in zip((two, three), arrays)]
    buffer, layout = build_trie(6, [follows, contexts], arrays[0], counts[0], arrays[1], counts[1])
    file = tmp_path / "trie"
    file.write_bytes(buffer)
    with file.open("rb") as f:
        trie = Trie(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), layout)

    p1 = np.where(np.arange(6) == START, 0, follows + 0.1)
    p1 /= p1.sum()

    def backed(kept, lower, w):
        rest = 1 - sum(lower(x) for x in kept)
        if rest < 1e-9:
            return kept[w] / sum(kept.values())
        return kept[w] if w in kept else (1 - sum(kept.values())) / rest * lower(w)

    def p2(v, w):
        return backed({x: (n - 0.75) / max(1, contexts[v]) for (a, x), n in two.items() if a == v}, lambda x: p1[x], w)

    def p3(u, v, w):
        kept = {x: (n - 0.75) / two[u, v] for (a, b, x), n in three.items() if (a, b) == (u, v)}
        return backed(kept, lambda x: p2(v, x), w)

    for v in (0, 3, START):
        assert sum(p2(v, w) for w in range(6) if w != START) == pytest.approx(1)
    seq = np.array([w for t in texts for w in t])
    first = np.array([i == 0 for t in texts for i in range(len(t))])
    want = [math.log10(p3(t[i - 2] if i > 1 else START, t[i - 1], w) if i else p2(START, w)) for t in texts for i, w in enumerate(t)]
    assert np.allclose(trie.log_probabilities(seq, first), want, atol=1e-4)


def check_base(got, rows):
    tokens = [(r[0], r[1], [*words(lower(r[1])), None]) for r in rows]
    train = [t for k, _, t in tokens if k is None or crc(k, 10) != 0]
    c = Counter(w for t in train for w in t)
    total, types = sum(c.values()), len(c)
    want = Counter()
    for k, _, t in tokens:
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t)
        want[k, k is not None and crc(k, 10) == 0, len(t), sum(c[w] > 0 for w in t), total, round(base, 5)] += 1
    found = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got)
    assert found == want


@pytest.mark.parametrize("frequent, least", [(5e-6, 1e-4), (0.05, 0.2), (1.1, 1.1)])
def test_base_scores_are_exact(spark, monkeypatch, frequent, least):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "CLASS", least)
    rows = odd_rows()
    got = lm_score.score_texts(odd_docs(spark, rows)).collect()
    check_base(got, rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def backed_off_scores(rows, least, fewest=2):
    """Log10 probability of each (key, text), by dictionaries of all n-grams."""
    tokens = [(r[0], r[1], [*words(lower(r[1])), None]) for r in rows]
    train = [t for k, _, t in tokens if k is None or crc(k, 10) != 0]
    c = Counter(w for t in train for w in t)
    total, types = sum(c.values()), len(c)
    own = {w for w in c if w is not None and c[w] >= max(fewest, least * total)}
    classed = lambda t: [w if w is None or w in own else "" for w in t]
    follow, two, three = Counter(), defaultdict(Counter), defaultdict(Counter)
    for t in map(classed, train):
        follow.update(t)
        for i, w in enumerate(t):
            two[t[i - 1] if i else 0][w] += 1
            if i:
                three[t[i - 2] if i > 1 else 0, t[i - 1]][w] += 1
    mass = total + 0.1 * (len(own) + 2)
    p1 = lambda w: (follow[w] + 0.1) / mass

    def backed(n, lower_p, w):
        kept = {x: max(k - 0.75, 0.1875) / sum(n.values()) for x, k in n.items()}
        rest = 1 - sum(lower_p(x) for x in kept)
        if kept and rest < 1e-9:
            return kept[w] / sum(kept.values())
        return kept[w] if w in kept else (1 - sum(kept.values())) / rest * lower_p(w) if kept else lower_p(w)

    p2 = lambda v, w: backed(two[v], p1, w)
    other = math.log10(follow[""] + 0.1 * (types - len(own) - 1 + 1))
    for key, text, plain in tokens:
        t = classed(plain)
        chain = [p2(0, t[0]), *(backed(three[t[i - 2] if i > 1 else 0, t[i - 1]], lambda x, i=i: p2(t[i - 1], x), t[i]) for i in range(1, len(t)))]
        yield key, sum(map(math.log10, chain)) + sum(math.log10(c[w] + 0.1) - other for w, k in zip(plain, t) if k == "")


@pytest.mark.parametrize("gram, tokens", [(0, 4_000_000), (0.01, 100), (1, 7)])
def test_no_n_gram_is_left_to_the_back_off(spark, monkeypatch, gram, tokens):
    monkeypatch.setattr(lm_score, "CLASS", 0.02)
    monkeypatch.setattr(lm_score, "FREQUENT", 0.01)
    monkeypatch.setattr(lm_score, "GRAM", gram)  # the shards look up what is rarer
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", tokens)
    some = random.Random(7)
    rows = [(i, " ".join(some.choice("a A b c d e f3 ,g hh é".split()) * some.choice([1, 1, 1, 2]) for _ in range(some.randrange(30)))) for i in range(90)]
    rows += [(i, f"a rare{i} b a", ) for i in range(90, 120)] + [(3, "a b a b"), (3, "a b a b"), (None, "b a"), (120, None), (121, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows = [(k, t or "") for k, t in rows]
    want = Counter((k, round(x, 3)) for k, x in backed_off_scores(rows, 0.02))
    near = Counter((r["doc_id"], round(r["score"], 3)) for r in lm_score.score_texts(docs).collect())
    key = lambda e: (e[0] is None, e[0] or 0, e[1])
    found, wanted = sorted(near.elements(), key=key), sorted(want.elements(), key=key)
    assert [k for k, _ in found] == [k for k, _ in wanted]
    assert [x for _, x in found] == pytest.approx([x for _, x in wanted], abs=3e-3)


def test_rare_words_have_n_grams_of_their_own(spark, monkeypatch):
    """Scores are those of all words' n-grams, whatever is sent to the tasks and however the shards are cut."""
    some = random.Random(5)
    vocabulary = "a A b c d e f3 ,g hh é".split() + [f"rare{i}" for i in range(60)]
    rows = [(i, " ".join(some.choice(vocabulary[: some.choice([4, 70])]) for _ in range(some.randrange(30)))) for i in range(90)]
    rows += [(i, "one phrase of words met nowhere else") for i in range(90, 94)] + [(3, "a b a b"), (3, "a b a b"), (None, "b a"), (120, None), (121, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((k is None, k or 0, x) for k, x in backed_off_scores([(k, t or "") for k, t in rows], 0, 1))
    for frequent, gram, tokens in ((5e-6, 1e-5, 2_000_000), (0.02, 0.002, 60), (1.1, 0, 7), (0.01, 1, 30)):
        monkeypatch.setattr(lm_score, "FREQUENT", frequent)
        monkeypatch.setattr(lm_score, "GRAM", gram)
        monkeypatch.setattr(lm_score, "SHARD_TOKENS", tokens)
        got = lm_score.score_texts(docs).collect()
        check_base(got, [(k, t or "") for k, t in rows])
        found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in got)
        assert [f[:2] for f in found] == [w[:2] for w in want]
        assert [f[2] for f in found] == pytest.approx([w[2] for w in want], abs=3e-3)


@pytest.mark.parametrize("others", [40, 1500])
def test_a_phrase_is_known_whatever_the_size_of_the_corpus(spark, others):
    some = random.Random(others)
    phrase = [f"p{i}" for i in range(30)]
    mixed = some.sample(phrase, 30)
    rows = [(i, " ".join(phrase)) for i in range(20)] + [(i, " ".join(f"w{some.randrange(others)}" for _ in range(200))) for i in range(100, 100 + others)]
    rows += [(-1, " ".join(mixed)), (-2, " ".join(phrase))]
    got = {r["doc_id"]: r["score"] for r in lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[-2] > got[-1] + 10


def test_model_without_training_or_rows(spark):
    assert lm_score.score_texts(no_docs(spark)).count() == 0
    held = [r for r in [(i, "a b a", None, None, 0, *["x"] * 9) for i in range(60)] if crc(r[0], 10) == 0]
    got = lm_score.score_texts(odd_docs(spark, held)).collect()
    assert len(got) == len(held) > 0 and all(r["score"] == r["base_score"] == 0 and r["n_known"] == 0 for r in got)


@needs_data
def test_the_model_beats_its_base_on_held_out_texts(spark):
    got = QUERIES["op8_lm_score"](spark, MIDDLE).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.98 * sum(r["base_score"] for r in held)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    check_base(got, [tuple(r) for r in docs])


# near duplicates


def plain_components(rows, size=4, percent=85):
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    keys = {i: min((rows[j][0] for j in g if rows[j][0] is not None), default=None) for g in groups.values() for i in g}
    return Counter((rows[i][0], len(sets[i]), keys[i]) for i in range(len(rows)))


def near_copies(n, seed):
    """Copies of a few texts with words changed, some just within and some just beyond the threshold."""
    pick = random.Random(seed)
    words_ = [f"w{i}" for i in range(400)]
    bases = [[pick.choice(words_) for _ in range(pick.choice([6, 9, 40, 120]))] for _ in range(6)]
    bases.append(bases[3][:60] + bases[2][:10])
    rows = []
    for i in range(n):
        text = list(pick.choice(bases))
        for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):
            text[pick.randrange(len(text))] = pick.choice(words_)
        rows.append((1000 + i, " ".join(text), None, None, 0, *["x"] * 9))
    pick.shuffle(rows)
    return rows


def test_components_of_odd_texts(spark):
    rows = odd_rows()
    got = jaccard_join.near_duplicates(odd_docs(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == plain_components(rows)
    assert jaccard_join.near_duplicates(no_docs(spark)).count() == 0


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 16)])
def test_components_are_whole(spark, monkeypatch, seed, block):
    """Also with buckets over many blocks, and candidates in several passes."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SPARSE", 1 if block < 100 else 32)
    monkeypatch.setattr(jaccard_join, "PASSES", ((0, 1), (1, 3), (3, 1 << 62)))
    rows = near_copies(160, seed)
    got = jaccard_join.near_duplicates(odd_docs(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == plain_components(rows)


@pytest.mark.parametrize("seed", range(6))
def test_trees_leave_out_no_link(seed):
    pick = np.random.default_rng(seed)
    base = [np.unique(pick.integers(0, 1 << 62, int(n)).astype(np.uint64)) for n in (20, 60, 300, 1000)]
    sets = []
    for _ in range(80):
        s = base[pick.integers(0, 4)]
        kept = s[pick.random(len(s)) > pick.choice([0, 0.02, 0.1])]
        sets.append(np.unique(np.concatenate([kept, pick.integers(0, 1 << 62, int(pick.integers(0, 3))).astype(np.uint64)])))
    n = np.array([len(s) for s in sets])
    maps = [np.frombuffer(jaccard_join.bitmap(s), "<u8") for s in sets]
    ids, side = np.arange(80) * 3, np.zeros(80, np.int8)
    links = {
        (3 * i, 3 * j) for i in range(80) for j in range(i + 1, 80)
        if 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (n[i] + n[j] - k)
    }
    level = np.floor(np.log(n) / -math.log(0.85) + 1e-9).astype(np.int64)

    def bucket(component, side):
        lowers = np.unique(np.concatenate([level - 1, level])).tolist()
        return np.concatenate([jaccard_join.pair_bucket(ids, n, component, maps, level, side, c, 85) for c in lowers])

    found = bucket(ids, side)
    pairs = {(a, b) for a, b, _ in found.tolist()}
    assert links <= pairs and len(pairs) == len(found) < 80 * 79 // 2
    half = (np.arange(80) % 2).astype(np.int8)
    across = {(a, b) for a, b, _ in bucket(ids, half).tolist()}
    assert {(a, b) for a, b in links if (a // 3 + b // 3) % 2} <= across
    assert not len(bucket(np.zeros(80, np.int64), side))


def test_every_pair_that_links_shares_a_prefix_token():
    for n in range(6, 200):
        for m in range(-(-85 * n // 100), n + 1):
            least = -(-85 * (n + m) // 185)
            assert least >= n - jaccard_join.prefix_length(n, 85) + 1 or m < least


def test_components_by_stars(spark):
    pick = random.Random(1)
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, i) for i in range(300, 340)] + [(7, 7), (9, 8), (8, 9)]
    edges += [(pick.randrange(400, 480), pick.randrange(400, 480)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_are_made_slice_by_slice(spark, monkeypatch):
    assert jaccard_join.SLICE_BYTES <= 1 << 20  # what a worker took for its largest slice it keeps
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(i, base + f" end{i % 3}") for i in range(9)] + [(20, base + " " + base), (21, None), (22, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    whole = sorted(tuple(r) for r in jaccard_join.near_duplicates(docs).collect())
    monkeypatch.setattr(jaccard_join, "SLICE_BYTES", 100)
    assert sorted(tuple(r) for r in jaccard_join.near_duplicates(docs).collect()) == whole
    assert {c for k, _, c in whole if k < 9} == {0}
