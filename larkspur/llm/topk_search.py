"""Exact top-k inner products by a uniform threshold, in three phases.

The components are cut into slices. A node holds one slice of a block of rows
and only sees local scores, whose sum over the slices is the score. Phase one
gathers each query's best local scores of every slice; the exact scores of those
rows give a cutoff that the k-th best cannot lie below. In phase two every node
collects the entries whose local score reaches the cutoff divided by the number
of slices: a row that reaches the cutoff must do so in some slice. Phase three
resolves their other local scores at the block's other nodes, in the same task, and
only what reaches the cutoff is sent and ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.registry import query, table
from larkspur.session import materialize

K = 20
SLICES = 2
ROW_BLOCK = 4096
QUERY_BLOCK = 1024
PAIRS_PER_TASK = 8

_BLOCK = "block long, slice int, width int, kind string, ids binary, vectors binary"
_ENTRY = pa.schema(
    [("qb", pa.int32()), ("qi", pa.int32()), ("rb", pa.int64()), ("ri", pa.int32()),
     ("query_id", pa.int64()), ("vec_id", pa.int64()), ("slice", pa.int32()), ("part", pa.int64())]
)
_ENTRY_DDL = "qb int, qi int, rb long, ri int, query_id long, vec_id long, slice int, part long"


def integer_vectors(embeddings: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): components as floor(scale * x); rows with a null or non-finite part or a null id are left out."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))
    rows = embeddings.filter(F.col(key).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col(key).cast("bigint").alias("id"), whole.alias("v"))


def _blocks(rows: DataFrame, size: int, width: int, slices: int, label: str) -> DataFrame:
    """Blocks of about ``size`` rows, one record for each slice, written down so that block numbers hold."""
    count = rows.count()
    cuts = [round(width * j / slices) for j in range(slices + 1)]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column(1)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                dense = np.zeros((part.num_rows, width), np.int64)
                dense[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                most = int(np.abs(dense).max(initial=0))
                kind = "i1" if most < 128 else "i4" if most < 1 << 31 else "i8"
                ids = part.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                records = [
                    {"block": block, "slice": j, "width": cuts[j + 1] - cuts[j], "kind": kind, "ids": ids,
                     "vectors": dense[:, cuts[j] : cuts[j + 1]].astype("<" + kind).tobytes()}
                    for j in range(slices)
                ]
                block += 1
                yield pa.RecordBatch.from_pylist(records, schema=_block_schema())

    dealt = rows.repartition(max(1, math.ceil(count / size)))
    return materialize(dealt.mapInArrow(build, _BLOCK), label)


def _block_schema() -> pa.Schema:
    return pa.schema(
        [("block", pa.int64()), ("slice", pa.int32()), ("width", pa.int32()), ("kind", pa.string()),
         ("ids", pa.binary()), ("vectors", pa.binary())]
    )


def _matrix(record: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(record[f"{side}_ids"], "<i8")
    flat = np.frombuffer(record[f"{side}_vectors"], "<" + record[f"{side}_kind"])
    return ids, flat.reshape(len(ids), record["width"])


def _scores(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact integer products, in floating point where its mantissa holds them."""
    reach = float(np.abs(q, dtype=np.float64).max(initial=0)) * float(np.abs(r, dtype=np.float64).max(initial=0)) * max(1, q.shape[1])
    kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
    return q.astype(kind) @ r.astype(kind).T


def _entries(record: dict, qi: np.ndarray, ri: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    q_ids, r_ids = np.frombuffer(record["q_ids"], "<i8"), np.frombuffer(record["r_ids"], "<i8")
    n = len(qi)
    columns = [
        np.full(n, record["qb"], np.int32), qi.astype(np.int32), np.full(n, record["rb"]), ri.astype(np.int32),
        q_ids[qi], r_ids[ri], np.full(n, record["slice"], np.int32), part.astype(np.int64),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_ENTRY)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def exact_topk(
    embeddings: DataFrame,
    is_query,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = 64,
    slices: int = SLICES,
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query.

    ``is_query`` is a condition on ``key``. Candidates are all rows but those with
    the query's own key; ties go to the smaller key, and rows that repeat a key are
    candidates of their own. A query with fewer candidates returns all. Vectors
    that are null or hold a null or non-finite component, and null keys, take no
    part; a shorter vector counts as filled up with zeros. Without queries, and on
    an empty table, the result is empty. Other columns are not read.

    Queries meet rows as blocks. What is sent are blocks and entries that reach a
    cutoff; nothing of the size of the table is broadcast or collected.
    """
    rows = integer_vectors(embeddings, key, vector, scale)
    rows = materialize(rows, "vectors")
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 1)
    slices = max(1, min(slices, width))
    r = _blocks(rows, row_block, width, slices, "row-blocks")
    q = _blocks(rows.filter(is_query(F.col("id"))), query_block, width, slices, "query-blocks")

    # every block of queries is sent to every node: an equi-join on the blocks' numbers
    numbered = q.filter("slice = 0").select("block", F.row_number().over(Window.orderBy("block")).alias("qb"))
    n_queries, n_rows = q.filter("slice = 0").count(), r.filter("slice = 0").count()
    tasks = max(1, math.ceil(n_queries * n_rows * slices / PAIRS_PER_TASK))
    left = q.join(numbered, "block").select("qb", "slice", F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"), F.col("vectors").alias("q_vectors"))
    right = r.select(F.col("block").alias("rb"), "slice", "width", F.col("ids").alias("r_ids"), F.col("kind").alias("r_kind"), F.col("vectors").alias("r_vectors"))
    each = F.array() if not n_queries else F.sequence(F.lit(1), F.lit(n_queries))
    sent = right.withColumn("qb", F.explode(each.cast("array<int>")))
    nodes = sent.join(left, ["qb", "slice"]).repartition(tasks, "qb", "rb", "slice")

    def local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in _records(batches):
            (q_ids, qm), (r_ids, rm) = _matrix(record, "q"), _matrix(record, "r")
            s = _scores(qm, rm).astype(np.float64)
            s[q_ids[:, None] == r_ids] = -np.inf
            n = min(k, s.shape[1])
            top = np.argpartition(-s, n - 1, axis=1)[:, :n]
            part = np.take_along_axis(s, top, 1)
            qi, at = np.nonzero(np.isfinite(part))
            yield _entries(record, qi, top[qi, at], part[qi, at])

    place = ["qb", "qi", "rb", "ri"]
    names = ["query_id", "vec_id"]
    lists = nodes.mapInArrow(local_lists, _ENTRY_DDL)
    by_slice = Window.partitionBy("qb", "qi", "slice").orderBy(F.desc("part"), "vec_id", "rb", "ri")
    heads = lists.withColumn("_n", F.row_number().over(by_slice)).filter(F.col("_n") <= k).drop("_n")
    heads = materialize(heads, "lists")

    def resolve(entries: DataFrame) -> DataFrame:
        """Exact scores of the (query, row) places in ``entries``, missing slices asked of their nodes."""
        known = entries.groupBy(*place, *names).agg(
            F.sum("part").alias("sum"), F.collect_set("slice").alias("seen")
        )
        known = materialize(known, "known")
        every = F.array(*[F.lit(j) for j in range(slices)])
        asked = known.select(*place, F.explode(F.array_except(every, F.col("seen"))).alias("slice"))
        # a request of at most as many places as the two blocks have pairs that reached the cutoff
        requests = asked.groupBy("qb", "rb", "slice").agg(F.collect_list(F.struct("qi", "ri")).alias("places"))

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    one = batch.slice(i, 1)
                    places = one.column(one.schema.get_field_index("places")).flatten()
                    qi, ri = (places.field(f).to_numpy(zero_copy_only=False) for f in ("qi", "ri"))
                    record = one.drop_columns(["places"]).to_pylist()[0]
                    (_, qm), (_, rm) = _matrix(record, "q"), _matrix(record, "r")
                    for at in range(0, len(qi), 1 << 16):
                        a, b = qi[at : at + (1 << 16)], ri[at : at + (1 << 16)]
                        yield _entries(record, a, b, np.einsum("ij,ij->i", qm[a].astype(np.int64), rm[b].astype(np.int64)))

        answers = requests.join(right, ["rb", "slice"]).join(left, ["qb", "slice"]).mapInArrow(answer, _ENTRY_DDL)
        both = known.select(*place, *names, "sum").union(answers.select(*place, *names, "part"))
        return both.groupBy(*place, *names).agg(F.sum("sum").alias("score"))

    best = Window.partitionBy("qb", "qi").orderBy(F.desc("score"), "vec_id", "rb", "ri")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    cutoffs = ranked(resolve(heads)).groupBy("qb", "qi").agg(
        F.min("score").alias("score"), F.count(F.lit(1)).alias("found")
    )
    # queries with fewer than k rows so far have no cutoff; a block has at most query_block cutoffs
    cutoffs = cutoffs.filter(F.col("found") >= k).groupBy("qb").agg(F.collect_list(F.struct("qi", "score")).alias("cutoffs"))
    cutoffs = materialize(cutoffs, "cutoffs")
    # all slices of a block of rows stand together, so that what is missing is resolved where it lies
    def whole(side: DataFrame, by: str, name: str) -> DataFrame:
        cells = F.struct(*[c for c in side.columns if c != by])
        return side.groupBy(by).agg(F.sort_array(F.collect_list(cells)).alias(name))

    asked = whole(left.select("slice", "qb", "q_ids", "q_kind", "q_vectors"), "qb", "queries").join(cutoffs, "qb", "left")
    held = whole(right.select("slice", "rb", "width", "r_ids", "r_kind", "r_vectors"), "rb", "rows")
    held = held.withColumn("qb", F.explode(each.cast("array<int>")))
    pairs = held.join(asked, "qb").repartition(tasks, "qb", "rb")

    def sufficient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in _records(batches):
            parts = []
            for a, b in zip(record["queries"], record["rows"]):
                node = {**a, **b}
                parts.append(_scores(_matrix(node, "q")[1], _matrix(node, "r")[1]))
            q_ids, r_ids = np.frombuffer(node["q_ids"], "<i8"), np.frombuffer(node["r_ids"], "<i8")
            least = np.full((len(q_ids), 1), -np.inf)
            for c in record["cutoffs"] or []:
                least[c["qi"]] = c["score"]
            share = least / slices  # a row that reaches the cutoff reaches this in some slice
            enough = np.zeros(parts[0].shape, bool)
            for part in parts:
                enough |= part >= share
            enough &= q_ids[:, None] != r_ids
            qi, ri = np.nonzero(enough)
            node |= {"qb": record["qb"], "rb": record["rb"], "slice": -1}
            for at in range(0, len(qi), 1 << 18):
                a, b = qi[at : at + (1 << 18)], ri[at : at + (1 << 18)]
                total = sum(part[a, b].astype(np.int64) for part in parts)
                reach = total >= least[a, 0]
                yield _entries(node, a[reach], b[reach], total[reach])

    entries = pairs.mapInArrow(sufficient, _ENTRY_DDL).withColumnRenamed("part", "score")
    return ranked(entries).select("query_id", "rank", "vec_id", "score")


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.v, r.v)::BIGINT AS score
      FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0),
n AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM n WHERE rank <= 20
"""


@query("op3_topk_search", OP3_SQL)
def op3_topk_search(spark, sf_dir):
    """The 20 best rows for every vector whose id is divisible by 20."""
    return exact_topk(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0)
