"""Near-duplicate documents by the Jaccard similarity of their word shingles.

Equal sets are first made one. Sets that may be similar share a token among the
rarest of each (prefix filtering; rarity is counted over all documents), and so
meet in the token's bucket. In a bucket every set is first held against the one
with most shared tokens, which joins large groups of copies at once. What is
still apart is paired by signature trees: the leaves are sets with a bitmap of
their tokens, a node holds its children's bitmaps combined by OR and their range of
sizes, and a pair of nodes is dropped if the largest overlap that bitmaps and
sizes allow is too small. Every pair that is left is verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bytetext import Words, mix64, shingles, slices
from larkspur.llm.components import components
from larkspur.llm.registry import query, table
from larkspur.operators.skew import skew_join
from larkspur.session import materialize

SLICE_BYTES = 1 << 20  # of text whose sets a task holds at once; a worker keeps what its largest slice took
COUNTER_BITS = 20  # counters of token frequency; they only order tokens
CHUNK = 1 << 14  # counters sent as one record
FILTER_BITS = 24  # of the filter that tells which sets to write down
BLOCK = 1024  # sets of a bucket in one task
FANOUT = 8  # children of a node
SPARSE = 32  # candidates of a set in a bucket, on average, that need no passes
PASSES = ((0, 4), (4, 64), (64, 1 << 62))  # candidates of a set in a bucket, about; between passes components grow


class Sets:
    """Distinct shingles of a column of texts, sorted within each row."""

    def __init__(self, texts: pa.Array, size: int):
        words = Words(texts)
        hashes = words.hashes()
        tokens, row = shingles(hashes, words.counts, size)
        of_word = np.repeat(words.counts, words.counts)
        for few in range(1, size):  # a text with fewer words is one shingle
            some = words.counts * (words.counts == few)
            one, _ = shingles(hashes[of_word == few], some, few)
            tokens = np.concatenate([tokens, mix64(one + np.uint64(few))])
            row = np.concatenate([row, np.flatnonzero(some)])
        if len(row) and (np.diff(row) < 0).any():
            order = np.argsort(row, kind="stable")
            tokens, row = tokens[order], row[order]
        cuts = np.searchsorted(row, np.arange(words.rows + 1))
        self.of = [np.unique(tokens[b:e]) for b, e in zip(cuts, cuts[1:])]
        self.sizes = np.array([len(s) for s in self.of], np.int64)

    def names(self) -> list[bytes | None]:
        """A 128-bit fingerprint of each set; None for an empty one."""
        found = []
        for s in self.of:
            if not len(s):
                found.append(None)
                continue
            sums = [mix64(s + np.uint64(k)).sum(dtype=np.uint64) for k in (11, 12)]
            found.append(np.array(sums, "<u8").tobytes())
        return found


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of which one is shared with every other set that it links with."""
    return n - -(-n * percent // 100) + 1


def bitmap(tokens: np.ndarray) -> bytes:
    """A bit for each token among four to eight times as many; longer maps fold onto shorter ones."""
    size = 1 << max(6, math.ceil(math.log2(4 * len(tokens))))
    bits = np.zeros(size, bool)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The same map with fewer 64-bit words."""
    return bits if len(bits) == words else np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Overlap that sets with this sum of sizes need to link."""
    return -(-percent * sizes // (100 + percent))


class Tree:
    """Nodes over sets, level by level from the leaves: bitmap, sizes, the most tokens that share bits, components."""

    def __init__(self, bits: np.ndarray, n: np.ndarray, component: np.ndarray):
        extra = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, n, n, extra, component, component)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, extra, c_low, c_high = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                 np.maximum.reduceat(extra, at), np.minimum.reduceat(c_low, at), np.maximum.reduceat(c_high, at))
            )

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``node``, child) for nodes of ``level``."""
        count = np.minimum(FANOUT, len(self.levels[level - 1][1]) - node * FANOUT)
        parent = np.repeat(np.arange(len(node)), count)
        inside = np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count)
        return parent, node[parent] * FANOUT + inside


def join_trees(left: Tree, right: Tree, percent: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaf pairs (and the largest overlap they can have) that may link and are in different components.

    ``same``: both are one tree, and each pair comes once.
    """
    a_level, b_level = len(left.levels) - 1, len(right.levels) - 1
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        kept_a, kept_b, most = [], [], []
        a_bits, a_low, a_high, a_extra, a_c, a_d = left.levels[a_level]
        b_bits, b_low, b_high, b_extra, b_c, b_d = right.levels[b_level]
        for at in range(0, len(a), 1 << 16):
            x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            ok = (100 * a_high[x] >= percent * b_low[y]) & (100 * b_high[y] >= percent * a_low[x])
            ok &= ~((a_c[x] == a_d[x]) & (b_c[y] == b_d[y]) & (a_c[x] == b_c[y]))
            if same and a_level == b_level:
                ok &= (x < y) if a_level == 0 else (x <= y)
            x, y = x[ok], y[ok]
            shared = np.bitwise_count(a_bits[x] & b_bits[y]).sum(1, dtype=np.int64)
            overlap = shared + np.minimum(a_extra[x], b_extra[y])
            ok = overlap >= needed(a_low[x] + b_low[y], percent)
            kept_a.append(x[ok])
            kept_b.append(y[ok])
            most.append(overlap[ok])
        a, b, top = (np.concatenate(k) for k in (kept_a, kept_b, most))
        if not a_level and not b_level or not len(a):
            return a, b, top
        # the higher tree goes down first, so that both reach their leaves together
        down_a, down_b = a_level >= b_level, b_level >= a_level
        if down_a:
            place, a = left.children(a_level, a)
            b, a_level = b[place], a_level - 1
        if down_b:
            place, b = right.children(b_level, b)
            a, b_level = a[place], b_level - 1


def pair_bucket(ids, n, component, maps, level, side, lower: int, percent: int) -> np.ndarray:
    """Candidate pairs (a, b, largest overlap) of a bucket's sets, or of its sides 0 and 1.

    The sets are of the size classes ``lower`` and the next, by ``level``; pairs of the upper class
    alone are left to its own bucket.
    """
    found = [np.zeros((0, 3), np.int64)]
    sides = ((0, 1), (1, 0)) if side.any() else ((0, 0),)
    for upper in (lower, lower + 1):
        for s, t in sides[:1] if upper == lower else sides:
            x = np.flatnonzero((level == lower) & (side == s))
            y = np.flatnonzero((level == upper) & (side == t))
            if not len(x) or not len(y):
                continue
            words = min(len(maps[i]) for i in np.concatenate([x, y]))
            x, y = (z[np.lexsort((ids[z], n[z], component[z]))] for z in (x, y))
            trees = [Tree(np.stack([fold(maps[i], words) for i in z]), n[z], component[z]) for z in (x, y)]
            a, b, most = join_trees(*trees, percent, upper == lower and s == t)
            a, b = ids[x[a]], ids[y[b]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b), most], 1))
    return np.concatenate(found)


def _scan(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """A row for each document (key, name, n), and records of token counts (chunk, counts), written down."""
    schema = f"key {docs.schema[key].dataType.simpleString()}, name binary, n long, chunk int, counts binary"
    names = ["key", "name", "n", "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(1 << COUNTER_BITS, np.int64), None
        for batch in batches:
            kind = batch.column(0).type
            for part in slices(batch, "text", SLICE_BYTES):
                sets = Sets(part.column(1), size)
                for s in sets.of:
                    counts[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)] += 1
                none = pa.nulls(part.num_rows)
                columns = [part.column(0), pa.array(sets.names(), pa.binary()), pa.array(sets.sizes)]
                yield pa.RecordBatch.from_arrays([*columns, none.cast(pa.int32()), none.cast(pa.binary())], names)
        used = [c for c in range(len(counts) // CHUNK) if counts[c * CHUNK : (c + 1) * CHUNK].any()]
        if used:
            records = [counts[c * CHUNK : (c + 1) * CHUNK].astype("<i8").tobytes() for c in used]
            none = pa.nulls(len(used))
            columns = [none.cast(kind), none.cast(pa.binary()), none.cast(pa.int64()), pa.array(used, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(records, pa.binary())], names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, schema), "sets")


def _frequencies(scanned: DataFrame) -> np.ndarray:
    """The counters of all documents; their number is fixed."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(counts.as_buffer(), "<i8")
                total[chunk] = total[chunk] + part if chunk in total else part
        if total:
            data = [c.astype("<i8").tobytes() for c in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(data, pa.binary())], ["chunk", "counts"])

    chunks = (1 << COUNTER_BITS) // CHUNK
    records = scanned.filter("chunk IS NOT NULL").select("chunk", "counts")
    summed = records.repartition(chunks, "chunk").mapInArrow(add, "chunk int, counts binary")
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    for row in summed.toLocalIterator():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] += np.frombuffer(row["counts"], "<i8")
    return np.minimum(counts, (1 << 32) - 1).astype(np.uint32)


def _signatures(docs: DataFrame, text: str, size: int, percent: int, frequency) -> DataFrame:
    """(id, name, n, bits, prefix) of each distinct set that can link with another; ids are its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = frequency.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = Sets(part.column(0), size)
                seen: dict[bytes, tuple] = {}
                for s, name in zip(sets.of, sets.names()):
                    # a set whose every partner would have to be equal has none
                    if name is None or name in seen or 100 * len(s) < percent * (len(s) + 1):
                        continue
                    rare = np.lexsort((s, counts[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]))
                    chosen = s[rare[: prefix_length(len(s), percent)]].view(np.int64)
                    seen[name] = (len(s), bitmap(s), chosen)
                columns = [list(seen), *([v[j] for v in seen.values()] for j in range(3))]
                kinds = [pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["name", "n", "bits", "prefix"])

    rows = docs.select(F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(run, "name binary, n long, bits binary, prefix array<bigint>").dropDuplicates(["name"])
    return materialize(found.withColumn("id", F.monotonically_increasing_id()), "signatures")


def _filter_bits(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over names: nine bytes of a name are its three places."""
    places = F.array(*[F.conv(F.hex(F.substring("name", 1 + 3 * k, 3)), 16, 10).cast("bigint") for k in range(3)])
    marks = wanted.select(F.explode(places).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    words = marks.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    filled = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    held = words.toPandas()  # at most one row for each word of the filter
    filled[held["word"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64)
    return np.unpackbits(filled.view(np.uint8), bitorder="little")


def _written_sets(docs: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """(id, tokens) of the sets in ``wanted`` (id, name), from the texts again.

    A filter spares most of the others the way; what it lets through in error the join drops.
    """
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(_filter_bits(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(bits.value)
        done: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = Sets(part.column(0), size)
                names, tokens = [], []
                for s, name in zip(sets.of, sets.names()):
                    if name is None or name in done:
                        continue
                    if all(marked[int.from_bytes(name[k : k + 3], "big")] for k in (0, 3, 6)):
                        done.add(name)
                        names.append(name)
                        tokens.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))], ["name", "tokens"]
                )

    rows = docs.select(F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(run, "name binary, tokens array<bigint>")
    return materialize(found.join(wanted, "name").select("id", "tokens").dropDuplicates(["id"]), "tokens")


def _verified(pairs: DataFrame, docs: DataFrame, text: str, size: int, percent: int, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, from the whole sets."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = materialize(signatures.select("id", "name").join(ids, "id"), "wanted")
    sets = _written_sets(docs, text, size, wanted)
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.withColumn("i", F.size(F.array_intersect("x", "y")))
    linked = both.filter(100 * F.col("i") >= percent * (F.size("x") + F.size("y") - F.col("i")))
    return materialize(linked.select("a", "b"), "links")


def _possible(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and bitmaps allow a link."""
    side = lambda k: signatures.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.filter(100 * F.greatest("n_a", "n_b") * percent <= 10_000 * F.least("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(3), batch.column(5))):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                words = min(len(x), len(y))
                x, y = fold(x, words), fold(y, words)
                extra = min(n_a[i] - np.bitwise_count(x).sum(dtype=np.int64), n_b[i] - np.bitwise_count(y).sum(dtype=np.int64))
                keep[i] = np.bitwise_count(x & y).sum(dtype=np.int64) + extra >= needed(n_a[i] + n_b[i], percent)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return both.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a long, b long")


def _size_class(n, percent: int):
    """Sets that link are in the same class of sizes or in neighbouring ones."""
    return F.floor(F.ln(n) / F.lit(-math.log(percent / 100)) + F.lit(1e-9)).cast("int")


BUCKET = ["token", "lower"]


def _tree_pairs(shared: DataFrame, signatures: DataFrame, percent: int, first: int, last: int) -> DataFrame:
    """Candidates (a, b) of the buckets in ``shared`` (token, lower, level, id, component), once or more; and rows
    (-1, n) for candidates beyond ``last``.

    Buckets of the same sets are one. A large bucket is dealt over blocks of sets, and every
    two blocks meet in one task.
    """
    sizes = shared.groupBy(*BUCKET).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        *[F.sum(F.xxhash64(F.lit(k), "id").cast("decimal(38,0)")).alias(f"m{k}") for k in (1, 2)],
    )
    mixed = sizes.filter("low < high").groupBy("lower", "rows", "m1", "m2").agg(F.min("token").alias("token"))
    mixed = mixed.select(*BUCKET, F.ceil(F.col("rows") / BLOCK).cast("bigint").alias("blocks"))
    rows = shared.join(mixed, BUCKET).join(signatures.select("id", "n", "bits"), "id")
    rows = rows.withColumn("k", F.pmod(F.xxhash64("id"), F.col("blocks")))
    rows = rows.withColumn("p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    key = [*BUCKET, "lo", "hi"]
    rows = rows.select(
        *BUCKET, F.least("k", "p").alias("lo"), F.greatest("k", "p").alias("hi"), (F.col("p") < F.col("k")).alias("side"),
        "id", "component", "n", "bits", "level",
    )
    dealt = rows.repartition(*key).sortWithinPartitions(*key, "id")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Runs of rows with one (token, lower, lo, hi); at most two blocks."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(j).to_numpy().astype(np.int64) for j in range(4)], 1)
            cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist()
            if held and any(held[-1].column(j)[-1] != batch.column(j)[0] for j in range(4)):
                yield pa.Table.from_batches(held)
                held = []
            for b, e in zip([0, *cuts], [*cuts, batch.num_rows]):
                if b:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(b, e - b))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, left, held = [], 0, 0
        for group in groups(batches):
            lower, side, ids, component, n, level = (group.column(j).to_numpy() for j in (1, 4, 5, 6, 7, 9))
            maps = [np.frombuffer(x.as_buffer(), "<u8") for x in group.column(8)]
            found = pair_bucket(ids, n, component, maps, level, side.astype(np.int8), int(lower[0]), percent)
            some, more = _dealt(found, len(ids), first, last)
            left += more
            out.append(some)
            held += len(some)
            if held > 1 << 18:
                done = np.unique(np.concatenate(out), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(done[:, 0].copy()), pa.array(done[:, 1].copy())], ["a", "b"])
                out, held = [], 0
        out.append(np.array([[-1, left]] if left else np.zeros((0, 2)), np.int64))
        done = np.unique(np.concatenate(out), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(done[:, 0].copy()), pa.array(done[:, 1].copy())], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _dealt(pairs: np.ndarray, sets: int, first: int, last: int) -> tuple[np.ndarray, int]:
    """The pairs of a bucket that this pass takes, and the number that is left to later ones.

    A bucket with few pairs for its sets gives them all at once. Of others a hash deals the
    pairs, so that whatever the components are by then, none is passed over.
    """
    if len(pairs) <= SPARSE * sets:
        return pairs[:, :2], 0
    a, b = pairs[:, 0].astype(np.uint64), pairs[:, 1].astype(np.uint64)
    turn = (mix64(a * np.uint64(0x9E3779B97F4A7C15) + b) % np.uint64(max(1, sets))).astype(np.int64)
    return pairs[(turn >= first) & (turn < last), :2], int((turn >= last).sum())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """(key, n_shingles, component_id): a row for each row of ``docs``.

    The set of a text are its distinct shingles of ``size`` words, A-Z lower-cased; a shorter
    text is one shingle. Texts link if ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest key reachable by links, the own one included. A null
    text, or one without words, has no shingle, links with nothing and is its own
    component. Rows that repeat a key are texts of their own; a null key counts as none, so a component
    of null keys alone is null. An empty table gives no rows. Other columns are not read.

    Shingles are told apart by 64-bit hashes and sets by 128 bits. No link between different
    sets is left out: every pair that shares a bucket is verified, ruled out by its sizes
    and bitmaps, or already in one component.
    """
    spark = docs.sparkSession
    scanned = _scan(docs, key, text, size)
    rows = scanned.filter("chunk IS NULL").select("key", "name", "n")
    frequency = spark.sparkContext.broadcast(_frequencies(scanned))
    signatures = _signatures(docs, text, size, percent, frequency)

    tokens = signatures.select("id", "n", F.explode("prefix").alias("token"))
    several = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("token")
    # a token's sets meet by neighbouring classes of sizes
    placed = tokens.join(several, "token").withColumn("level", _size_class(F.col("n"), percent)).drop("n")
    placed = placed.withColumn("lower", F.explode(F.array(F.col("level") - 1, F.col("level"))))
    placed = materialize(placed, "placed")
    crowded = placed.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(*BUCKET)
    shared = materialize(placed.join(crowded, BUCKET), "shared")
    # the set with most shared tokens is the likeliest centre of a group of copies
    weight = shared.groupBy("id").agg(F.count(F.lit(1)).alias("w"))
    centre = shared.join(weight, "id").groupBy(*BUCKET).agg(F.max(F.struct("w", (-F.col("id")).alias("c"))).alias("top"))
    starred = shared.join(centre.select(*BUCKET, (-F.col("top.c")).alias("centre")), BUCKET).filter("id <> centre")
    pairs = starred.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    links = _verified(materialize(_possible(pairs, signatures, percent), "pairs"), docs, text, size, percent, signatures)
    nodes = components(links)

    for first, last in PASSES:
        known = shared.join(nodes.withColumnRenamed("node", "id"), "id", "left")
        known = known.select(*BUCKET, "level", "id", F.coalesce("component", "id").alias("component"))
        found = materialize(_tree_pairs(known, signatures, percent, first, last), "candidates")
        pairs = found.filter("a >= 0").distinct()
        if found.filter("a >= 0").limit(1).count():
            more = _verified(pairs, docs, text, size, percent, signatures)
            if not more.isEmpty():
                links = links.union(more)
                nodes = components(links)
        if not found.filter("a < 0").limit(1).count():
            break

    least = rows.filter("name IS NOT NULL").groupBy("name").agg(F.min("key").alias("least"))
    placed = least.join(signatures.select("id", "name"), "name", "left").join(
        nodes.withColumnRenamed("node", "id"), "id", "left"
    )
    smallest = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("smallest"))
    placed = placed.join(smallest, "component", "left").select("name", F.coalesce("smallest", "least").alias("component_id"))
    worded = skew_join(rows.filter("name IS NOT NULL"), placed, ["name"], "left")
    empty = rows.filter("name IS NULL").withColumn("component_id", F.col("key"))
    both = worded.select("key", "n", "component_id").unionByName(empty.select("key", "n", "component_id"))
    return both.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


@query("op6_jaccard_join")
def op6_jaccard_join(spark, sf_dir):
    """Every document's component of near duplicates."""
    return near_duplicates(table(spark, sf_dir, "documents"))
