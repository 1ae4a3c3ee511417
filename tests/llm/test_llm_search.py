"""Exact top-k, mixing, packing: against brute force and round trips."""

import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from samples import SMALL, no_docs, odd_docs, odd_rows, words

from larkspur.check import compare
from larkspur.llm import mixing, packing, topk_search
from larkspur.llm.catalog import ORACLES, QUERIES

needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test data")


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name, monkeypatch):
    monkeypatch.setattr("larkspur.check.QUERIES", QUERIES)
    monkeypatch.setattr("larkspur.check.ORACLES", ORACLES)
    assert compare(spark, SMALL, name).startswith("match")


def best(rows, k, is_query):
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if is_query(q):
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("slices, blocks", [(1, (7, 3)), (2, (16, 4)), (3, (1000, 1000))])
def test_topk_is_exact(spark, slices, blocks):
    pick = random.Random(slices)
    rows = [(i, [pick.choice([-1.5, -0.25, 0.0, 0.5, 2.0]) for _ in range(5)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0]), (80, [float("nan")] * 5), (100, [float("inf")] + [0.0] * 4), (None, [1.0] * 5)]
    rows += [(120, [1e4] * 5), (122, [1.0, 2.0]), (140, []), (123, [3e5, -3e5, 1.0, 1.0, 1.0])] + [(7, rows[7][1])] * 2
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = topk_search.exact_topk(table, lambda key: key % 20 == 0, k=6, slices=slices, row_block=blocks[0], query_block=blocks[1])
    found = sorted(tuple(r) for r in got.collect())
    assert found == best([(i, [*v, 0, 0, 0, 0, 0][:5] if v is not None else None) for i, v in rows], 6, lambda q: q % 20 == 0)


def test_topk_of_small_tables(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk_search.exact_topk(table, lambda k: k % 20 == 0).collect()] == [(0, 1, 1, 64 * 32)]
    assert topk_search.exact_topk(table, lambda k: k < 0).count() == 0
    assert topk_search.exact_topk(table.limit(0), lambda k: k % 20 == 0).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_budgets_are_met(seed):
    pick = random.Random(seed)
    lengths = np.array(sorted(pick.sample(range(1, 40), pick.randint(1, 8))))
    counts = np.array([pick.randint(1, 5) for _ in lengths])
    budget = pick.randint(0, int((lengths * counts).sum()))
    taken = mixing.subset_sum(lengths, counts, budget, 3)
    sums = {0}
    for length, n in zip(lengths.tolist(), counts.tolist()):
        sums = {s + k * length for s in sums for k in range(n + 1)}
    assert (taken <= counts).all() and (taken >= 0).all()
    assert int((taken * lengths).sum()) == max(s for s in sums if s <= budget)
    filled = mixing.fill_budget(lengths, counts, budget, 3)
    assert (filled <= counts).all() and (filled >= 0).all() and (filled * lengths).sum() <= budget


def targets(sizes, weights, ratio, ceiling):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    asked, closed = ratio * sum(sizes.values()), set()
    while True:
        rest = asked - sum(ceiling * sizes[s] for s in closed)
        total = sum(weight[s] for s in names if s not in closed)
        share = {s: ceiling * sizes[s] if s in closed else rest * weight[s] / total for s in names}
        over = {s for s in names if s not in closed and share[s] > ceiling * sizes[s]}
        if not over:
            return share
        closed |= over


def nearest(lengths, target):
    """The most words, up to the target, that texts of these lengths give, each taken once more than the whole fits."""
    whole = sum(lengths)
    passes = min(2, int(target // whole)) if whole else 0
    budget = round(target - passes * whole) if passes < 2 else 0
    sums = 1
    for n in lengths:
        sums |= sums << n
    return passes * whole + (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1


def test_mix_meets_targets(spark):
    pick = random.Random(4)
    rows = [(1000 + i, " ".join(["w"] * pick.choice([0, 1, 2, 3, 5, 8, 40])), None, pick.choice(["b", "a", "a", "a", "ü", "Z", None]), 0, *["x"] * 9) for i in range(300)]
    rows += odd_rows()
    got = mixing.mix_sources(odd_docs(spark, rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    source = {r[0]: r[3] for r in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = targets(dict(sizes), (3, 1, 2), 1.5, 2)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert taken[s] == nearest([len(words(r[1])) for r in rows if r[3] == s], want[s]), s
    again = mixing.mix_sources(odd_docs(spark, rows).repartition(3)).collect()
    order = lambda x: sorted((str(r["doc_id"]), r["copies"]) for r in x)
    assert order(got) == order(again)


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(no_docs(spark)).count() == 0
    blank = mixing.mix_sources(odd_docs(spark, odd_rows()[:3])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in blank] == [(0, 0, 0.0)] * 3


def plain_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check_pack(pieces, rows, window):
    ids = defaultdict(list)
    for r in rows:
        ids[r[0]].append(plain_ids(r[1]).tobytes())
    by_doc = defaultdict(list)
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"])
        by_doc[p["doc_id"]].append(p)
    for doc, wanted in ids.items():
        mine = sorted(by_doc[doc], key=lambda p: p["start"])
        # rows with one id may have equal texts: all their pieces together cover each text as often
        cover = Counter()
        for p in mine:
            same = [w for w in wanted if len(w) // 4 == p["doc_tokens"]]
            assert any(w[4 * p["start"] : 4 * (p["start"] + p["length"])] == p["ids"] for w in same)
            cover.update((p["doc_tokens"], k) for k in range(p["start"], p["start"] + p["length"]))
        assert cover == Counter((len(w) // 4, k) for w in wanted for k in range(len(w) // 4))
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    padded = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    assert padded == 0 and sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("window", [1024, 64])
def test_packing_loses_nothing(spark, window):
    rows = [r for r in odd_rows() if len(r[1] or "") < 100_000]
    pieces = packing.pack(odd_docs(spark, rows), packing.public_tokenizer(), window=window, round_tokens=4 * window).collect()
    check_pack(pieces, rows, window)
    assert packing.pack(no_docs(spark), packing.public_tokenizer()).count() == 0


def test_rounds_hold_the_target_shares(spark):
    rows = [(i, "word " * (5 + i % 40), None, "a" if i % 3 else "b", 0, *["x"] * 9) for i in range(600)]
    shares = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, share double")
    pieces = packing.pack(odd_docs(spark, rows), packing.public_tokenizer(), shares=shares, window=64, round_tokens=1024).collect()
    source = {r[0]: r[3] for r in rows}
    total = sum(p["length"] for p in pieces if source[p["doc_id"]] == "b")
    early = [p for p in pieces if p["sequence_id"] * 64 < 1.5 * total]  # both queues still have documents
    share = sum(p["length"] for p in early if source[p["doc_id"]] == "b") / sum(p["length"] for p in early)
    assert abs(share - 0.5) < 0.03


@pytest.mark.parametrize("target", [{"a": 0.5, "b": 0.3, "c": 0.2}, None])
def test_every_window_holds_the_target_shares(spark, target):
    rows = [(i, "word " * (5 + i % 90), None, "aabc"[i % 4], 0, *["x"] * 9) for i in range(400)]
    shares = spark.createDataFrame(list(target.items()), "source string, share double") if target else None
    pieces = packing.pack(odd_docs(spark, rows), packing.public_tokenizer(), shares=shares, window=64).collect()
    check_pack(pieces, rows, 64)
    source, windows, total = {r[0]: r[3] for r in rows}, defaultdict(Counter), Counter()
    for p in pieces:
        windows[p["sequence_id"]][source[p["doc_id"]]] += p["length"]
        total[source[p["doc_id"]]] += p["length"]
    want = target or {s: n / total.total() for s, n in total.items()}
    running = int(min(total[s] / want[s] for s in want)) // 64 - 1  # windows before a queue is dry
    assert running > 50
    for k in range(running):
        assert all(abs(windows[k][s] - 64 * want[s]) <= 2 for s in want), (k, windows[k])


def test_rounds_are_the_tokens_due_first():
    queues, shares = [500, 40, 333, 7], [0.5, 0.3, 0.2, 1e-9]
    rounds = packing.Rounds(queues, shares, 64, 64)
    due = sorted(((t + 0.5) / p, s, t) for s, (n, p) in enumerate(zip(queues, shares)) for t in range(n))
    want = {}
    ends = [*range(0, 833, 64), *packing.tail_cuts(880, 64)]
    for a, b in zip(ends, ends[1:]):
        want.update({token: a + i for i, token in enumerate(sorted((s, t) for _, s, t in due[a:b]))})
    spans = [(s, a, min(a + 30, n)) for s, n in enumerate(queues) for a in range(0, n, 30)]
    queue, begin, end = (np.array(x) for x in zip(*spans))
    got = [(queue[i], begin[i] + low + k, at + k) for part in rounds.pieces(queue, begin, end) for i, low, high, at in zip(*part) for k in range(high - low)]
    assert len(got) == 880 and {(s, t): at for s, t, at in got} == want


@pytest.mark.parametrize("text", ["a b", " a", "a ", "a  b", "a\nb", "a \n b", "a\n\nb", "a\tb c", "é\u00a0b c", "x\u2028y z", "don't  stop 12 34", "a\r\nb c", "\n", ""])
def test_pieces_are_encoded_as_the_whole(text):
    joined = b"".join([plain_ids(p)[:-1].tobytes() for p in packing.text_pieces(text)])
    assert "".join(packing.text_pieces(text)) == text and joined == plain_ids(text)[:-1].tobytes()


@pytest.mark.parametrize("text", ["don't can't. x's!", "word... (more) a|b #tag $5 5% é! ß, naïve: Привет. 日本 a\0b", "<|endoftext|> a<|endoftext|>", "ABC.DEF, x--y ''q''", "a1 1a a_b a-b"])
def test_cached_pieces_have_the_same_ids(text):
    code = packing.Encoder(packing.public_tokenizer())
    assert code.direct
    for _ in range(2):  # new, then known
        got = [np.frombuffer(x, code.kind).astype("<u4").tobytes() for x in code.encode([text, text + " end"])]
        assert got == [plain_ids(text)[:-1].tobytes(), plain_ids(text + " end")[:-1].tobytes()]


def test_tail_is_not_padded():
    assert packing.tail_cuts(1024 + 700) == [1024 + 512, 1024 + 640, 1024 + 672, 1024 + 688, 1024 + 696, 1024 + 700]
    assert packing.tail_cuts(2048) == [] and packing.tail_cuts(0) == []


@pytest.mark.parametrize("shares", [None, "equal", "other"])
def test_rounds_are_found_in_few_steps(shares, monkeypatch):
    pick = np.random.default_rng(5)
    queues = pick.integers(1_000_000, 90_000_000, 20)
    share = {None: queues / queues.sum(), "equal": np.full(20, 0.05), "other": (np.arange(20) + 1) / 210}[shares]
    rounds = packing.Rounds(queues.tolist(), share.tolist(), 1024, 1024)
    r = np.unique(np.concatenate([pick.integers(1, rounds.whole, 2000), [1, 2, rounds.whole - 1, rounds.whole]]))
    asked, due = [], rounds._due
    monkeypatch.setattr(rounds, "_due", lambda time: asked.append(len(time)) or due(time))
    given = rounds.given(r)
    assert sum(asked) < (45 if shares == "equal" else 20) * len(r)  # queues of one share have tokens due together
    low, high = np.zeros(len(r), np.int64), np.full(len(r), rounds.latest)
    for _ in range(64):  # the last float at which no more are due than wanted
        middle = low + (high - low) // 2
        more = due(middle.view(np.float64)).sum(1) > rounds.ends(r)
        low, high = np.where(more, low, middle), np.where(more, middle, high)
    before, after = due(low.view(np.float64)), due(high.view(np.float64))
    rest = rounds.ends(r) - before.sum(1)
    for k in range(20):
        took = np.clip(rest, 0, after[:, k] - before[:, k])
        assert (given[:, k] == before[:, k] + took).all()
        rest = rest - took


def test_runs_are_cut_at_the_ends_of_sequences():
    pick = random.Random(8)
    for total, window in ((1000, 64), (960, 64), (31, 32), (5, 1), (64, 32)):
        tail = packing.tail_cuts(total, window)
        ends = [*range(window, total - total % window + 1, window), *tail]
        cuts = sorted({0, total, *(pick.randrange(total) for _ in range(12))})
        got = list(zip(*(x.tolist() for x in packing.cut_places(np.array(cuts[:-1]), np.array(cuts[1:]), total - total % window, tail, window))))
        want = []
        for run, (low, high) in enumerate(zip(cuts, cuts[1:])):
            for sequence, (b, e) in enumerate(zip([0, *ends], ends)):
                if max(b, low) < min(e, high):
                    want.append((run, sequence, b, max(b, low), min(e, high)))
        assert got == want
