"""Packing documents into windows of tokens with a controlled mixture.

Every source is a queue. The t-th token of a queue with target p is due at (t - 1/2) / p;
the tokens due first, as many as a round has, are the round. So each round takes from every
queue its target's part, whole tokens aside, and what a round owes is carried on; the
others share what a queue that ran dry leaves. A round is a window unless told otherwise:
in it a queue's tokens stand together, and a document is cut where its queue's quota ends.
What a queue has given before a round follows from the targets and the queues' lengths,
and a document's place in its queue from running sums over range-partitioned rows, so no
task sees a whole queue.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bytetext import slices
from larkspur.llm.registry import query, table
from larkspur.operators.chunks import with_running_sum
from larkspur.session import materialize

WINDOW = 1024  # tokens of a sequence
END_ID = 0  # closes every document
KNOWN_BYTES = 96 << 20  # pieces of text and their ids that a worker remembers
SLICE_BYTES = 1 << 20
CELLS = 1 << 20  # numbers of (round, queue) that a task holds at a time

_BLANK = re.compile(r"[^\S \n]")  # white space beside blanks and line breaks
_CUT = re.compile(r"(?<=\S)\n(?=\S)|(?<=\S)(?= \S)")
_ENDS = ".,;:!?()[]{}|#$%&*<>\"+-=/"  # characters that a splitter parts from letters before them


def text_pieces(text: str) -> list[str]:
    """Pieces that a byte-level BPE tokenizer encodes one by one as it does the whole.

    Its splitter never joins a character with a blank or line break behind it, so the text
    may be cut before a single blank and around a single line break.
    """
    runs = ("  ", "\n\n", " \n", "\n ", "\0")
    if not text[:1].isspace() and not text[-1:].isspace() and not any(r in text for r in runs) and not _BLANK.search(text):
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
    pieces, at = [], 0
    for cut in _CUT.finditer(text):
        pieces.append(text[at : cut.start()])
        if cut.end() > cut.start():
            pieces.append("\n")
        at = cut.end()
    pieces.append(text[at:])
    return pieces


# Latin letters, perhaps after a blank: one word to the splitter
_plain = re.compile(" ?[" + "".join(c for c in map(chr, range(0x250)) if c.isalpha()) + "]+").fullmatch


class Encoder:
    """A tokenizer file, and the ids of pieces met before."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        splitter = str(self.tokenizer.pre_tokenizer)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # of a byte-level model without more steps, words can be given to the model itself
        self.direct = (
            splitter.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in splitter
            and self.tokenizer.normalizer is None and not any(_plain(t) for t in special)
        )
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printed]
        self.letters = {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(other)}

    def _learn(self, pieces: set[str]) -> None:
        direct = list(filter(_plain, pieces)) if self.direct else []
        whole = list(pieces.difference(direct))
        found = [np.array(f.ids, self.kind).tobytes() for f in self.tokenizer.encode_batch(whole, add_special_tokens=False)]
        tokenize, letters, blank = self.tokenizer.model.tokenize, self.letters, self.letters[32]
        code = "H" if self.kind == "<u2" else "I"
        for piece in direct:
            # of ASCII letters and blanks the blank alone is written otherwise
            spelt = piece.replace(" ", blank) if piece.isascii() else piece.encode().decode("latin-1").translate(letters)
            found.append(array(code, [t.id for t in tokenize(spelt)]).tobytes())
        self._keep(whole + direct, found)

    def _keep(self, pieces: list[str], ids: list[bytes]) -> None:
        self.known.update(zip(pieces, ids))
        # with the two objects and their entry
        self.held += 180 * len(pieces) + 2 * sum(map(len, pieces)) + sum(map(len, ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian numbers of ``kind``."""
        split = [text_pieces(t) for t in texts]
        every = set().union(*split)
        new = every.difference(self.known)
        if self.held > KNOWN_BYTES:
            self.known.clear()
            self.held = 0
            new = every
        if self.direct:
            # a word and the signs behind it are encoded apart
            parted = {}
            for piece in new:
                core = piece.rstrip(_ENDS)
                if len(core) < len(piece) and core and _plain(core):
                    parted[piece] = (core, piece[len(core) :])
            parts = {p for pair in parted.values() for p in pair}
            self._learn((new - parted.keys() | parts) - self.known.keys())
            known = self.known
            self._keep(list(parted), [known[core] + known[signs] for core, signs in parted.values()])
        else:
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each worker."""
    return Encoder(path)


def tokenize(docs: DataFrame, key: str, text: str, source: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(row, key, source, n, ids): a row for each document, written down; ``n`` counts the closing id.

    ``ids`` take two bytes each if the vocabulary allows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        end = np.array([end_id], code.kind).tobytes()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids = [x + end for x in code.encode([t or "" for t in part.column(3).to_pylist()])]
                counts = pa.array([len(x) // len(end) for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], counts, pa.array(ids, pa.binary())], ["row", "key", "source", "n", "ids"]
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.col(source).cast("string").alias("source"),
        F.col(text).cast("string").alias("text"),
    )
    kind = docs.schema[key].dataType.simpleString()
    return materialize(rows.mapInArrow(run, f"row long, key {kind}, source string, n long, ids binary"), "tokens")


def tail_cuts(total: int, window: int = WINDOW) -> list[int]:
    """Ends of the sequences that hold what does not fill a window: falling powers of two, not padded."""
    at, cuts = total - total % window, []
    for bit in reversed(range(window.bit_length())):
        if total % window >> bit & 1:
            at += 1 << bit
            cuts.append(at)
    return cuts


class Rounds:
    """What every queue has given at the end of each round.

    ``queues`` are the queues' tokens, ``shares`` their positive targets. All tasks get the same numbers:
    of the floats at which no more than a round's tokens are due the largest is taken, and of tokens due
    together those of the first queues.
    """

    def __init__(self, queues: list[int], shares: list[float], size: int, window: int):
        self.queues, self.shares, self.size = np.array(queues, np.int64), np.array(shares, np.float64), size
        self.total = int(self.queues.sum())
        self.whole = self.total // size
        rest = [x for x in tail_cuts(self.total, window) if x > self.whole * size]
        self.rest = np.array([self.whole * size, *rest, *([self.total] if self.total > max([self.whole * size, *rest]) else [])], np.int64)
        self.latest = np.array([2 * (self.queues / self.shares).max() + 2 / self.shares.min()]).view(np.int64)[0]

    def ends(self, r: np.ndarray) -> np.ndarray:
        """Where rounds begin in the stream; the last begin is its end."""
        return np.where(r <= self.whole, r * self.size, self.rest[np.clip(r - self.whole, 0, len(self.rest) - 1)])

    def _round_of(self, place: np.ndarray) -> np.ndarray:
        late = self.whole - 1 + np.searchsorted(self.rest, place, "right")
        return np.minimum(np.where(place < self.whole * self.size, place // self.size, late), self.whole + len(self.rest) - 2)

    def _due(self, time: np.ndarray) -> np.ndarray:
        return np.minimum(self.queues, np.floor(time[:, None] * self.shares + 0.5)).astype(np.int64)

    def _place(self, time: np.ndarray) -> np.ndarray:
        step = max(1, CELLS // len(self.queues))
        parts = [self._due(time[i : i + step]).sum(1) for i in range(0, len(time), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _bracket(self, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Times, as the bits of floats, of which the first has no more than ``want`` tokens due and the second more."""
        dry = self.queues / self.shares
        # tokens due without rounding to whole ones, at the times when a queue runs dry
        times = np.unique(np.concatenate([[0.0], dry]))
        due = np.minimum(self.queues, times[:, None] * self.shares).sum(1)
        slack = len(self.queues) + 1
        low = np.maximum(0.0, np.interp(want - slack, due, times) * (1 - 1e-9)).view(np.int64)
        high = np.minimum((np.interp(want + slack, due, times) * (1 + 1e-9)).view(np.int64), self.latest)
        high = np.where(want + slack >= due[-1], self.latest, high)
        return np.where(self._due(low.view(np.float64)).sum(1) > want, 0, low), np.where(
            self._due(high.view(np.float64)).sum(1) > want, high, self.latest
        )

    def given(self, r: np.ndarray) -> np.ndarray:
        """A row for each round: tokens that each queue has given before it."""
        want = self.ends(r)
        low, high = self._bracket(want)
        before, after = self._due(low.view(np.float64)), self._due(high.view(np.float64))
        # when as many tokens are due as wanted, no later time tells more
        live = np.flatnonzero((before.sum(1) < want) & (high - low > 1))
        while len(live):  # floats above zero are ordered as their bits
            middle = low[live] + (high[live] - low[live]) // 2
            due = self._due(middle.view(np.float64))
            total = due.sum(1)
            more = total > want[live]
            up, down = live[more], live[~more]
            high[up], after[up] = middle[more], due[more]
            low[down], before[down] = middle[~more], due[~more]
            live = live[(more | (total < want[live])) & (high[live] - low[live] > 1)]
        tied = after - before
        open_ = (want - before.sum(1))[:, None] - (np.cumsum(tied, 1) - tied)
        return before + np.clip(open_, 0, tied)

    def _touched(self, queue: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and last round that tokens begin .. end - 1 can be in."""
        share = self.shares[queue]
        first, last = (begin + 0.5) / share, (end - 0.5) / share
        return self._round_of(self._place(first * (1 - 1e-12))), self._round_of(self._place(last * (1 + 1e-12)))

    def pieces(self, queue: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, from, to, place in the stream) of the parts of rows that lie in their queue from begin to end."""
        first, last = self._touched(queue, begin, end)
        sparse = last - first > 2 * (end - begin)  # most rounds hold none of the row's tokens
        step = max(1, CELLS // (2 * len(self.queues)))
        for i in range(len(queue)):
            if sparse[i]:
                at = np.arange(begin[i], end[i])
                low, high = self._touched(np.full(len(at), queue[i]), at, at + 1)
                span = high - low + 1
                rounds = np.unique(np.repeat(low - (np.cumsum(span) - span), span) + np.arange(span.sum()))
                for k in range(0, len(rounds), step):
                    yield self._cut(np.full(len(rounds[k : k + step]), i), rounds[k : k + step], queue, begin, end)
        # rows side by side, as many as there is room for
        dense = np.flatnonzero(~sparse)
        span = (last - first + 1)[dense]
        upto = np.cumsum(span)
        for k in range(0, int(span.sum()), step):
            some = np.arange(k, min(k + step, int(upto[-1])))
            which = np.searchsorted(upto, some, "right")
            rows = dense[which]
            yield self._cut(rows, first[rows] + some - (upto[which] - span[which]), queue, begin, end)

    def _cut(self, rows: np.ndarray, rounds: np.ndarray, queue: np.ndarray, begin: np.ndarray, end: np.ndarray):
        known, at = np.unique(np.concatenate([rounds, rounds + 1]), return_inverse=True)
        given = self.given(known)
        before, after = given[at[: len(rounds)]], given[at[len(rounds) :]]
        own, each = queue[rows], np.arange(len(rows))
        ahead = np.cumsum(after - before, 1)[each, own] - (after - before)[each, own]
        low, high = np.maximum(begin[rows], before[each, own]), np.minimum(end[rows], after[each, own])
        place = self.ends(rounds) + ahead + low - before[each, own]
        some = low < high
        return rows[some], (low - begin[rows])[some], (high - begin[rows])[some], place[some]


def layout(tokens: DataFrame, shares: DataFrame | None, window: int, round_tokens: int, seed: int) -> tuple[DataFrame, Rounds | None]:
    """(row, queue, begin): where each document begins in its queue; and the rounds, none without documents."""
    narrow = tokens.select(
        "row",
        F.coalesce("source", F.lit("")).alias("_s"),
        F.col("source").isNull().alias("_z"),
        "n",
        F.xxhash64(F.lit(seed), "key").alias("_h"),
    )
    sums = narrow.groupBy("_s", "_z").agg(F.sum("n").alias("_queue"))
    if shares is None:
        share = sums.withColumn("_share", F.col("_queue").cast("double"))
    else:
        given = shares.select(
            F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_z"), F.col("share").alias("_share")
        )
        # a queue without a positive target waits for the others
        share = sums.join(given, ["_s", "_z"], "left").withColumn("_share", F.greatest(F.coalesce("_share", F.lit(0.0)), F.lit(1e-9)))
    found = share.orderBy("_z", "_s").collect()  # a row for each source
    places = with_running_sum(narrow, ["_s", "_z"], ["_h", "row"], F.col("n"), "_end")
    numbers = tokens.sparkSession.createDataFrame(
        [(r["_s"], r["_z"], i) for i, r in enumerate(found)], "_s string, _z boolean, queue int"
    )
    placed = places.join(F.broadcast(numbers), ["_s", "_z"]).select("row", "queue", (F.col("_end") - F.col("n")).alias("begin"))
    whole = sum(r["_share"] for r in found)
    rounds = Rounds([r["_queue"] for r in found], [r["_share"] / whole for r in found], round_tokens, window) if found else None
    return placed, rounds


def cut_places(begin: np.ndarray, end: np.ndarray, full: int, tail: list[int], window: int) -> tuple[np.ndarray, ...]:
    """Runs of the stream cut where sequences end: (run, sequence, where it begins, begin, end) of each part, in order."""
    inner, whole = np.array([full, *tail], np.int64), full // window

    def sequence_of(at: np.ndarray) -> np.ndarray:
        return np.where(at < full, at // window, whole + np.searchsorted(inner, at, "right") - 1)

    def base_of(sequence: np.ndarray) -> np.ndarray:
        return np.where(sequence < whole, sequence * window, inner[np.clip(sequence - whole, 0, len(inner) - 1)])

    low = sequence_of(begin)
    parts = sequence_of(end - 1) - low + 1
    run = np.repeat(np.arange(len(begin)), parts)
    sequence = low[run] + np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    base = base_of(sequence)
    return run, sequence, base, np.maximum(begin[run], base), np.minimum(end[run], base_of(sequence + 1))


def _numbers(cells: pa.Array, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of bytes, ``total`` of one width, and where those of each cell begin."""
    kind = np.int64 if pa.types.is_large_binary(cells.type) else np.int32
    _, offsets, data = cells.buffers()
    at = np.frombuffer(offsets, kind)[cells.offset : cells.offset + len(cells) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    width = len(data) // total
    return data.view(f"<u{width}"), (at[:-1] - at[0]) // width


def _runs(ids: np.ndarray, begin: np.ndarray, length: np.ndarray) -> pa.Array:
    """Runs of numbers as bytes of four each."""
    ends = np.cumsum(length)
    at = np.arange(ends[-1]) + np.repeat(begin - (ends - length), length)
    offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(ids[at].astype("<u4"))])


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shares: DataFrame | None = None,
    window: int = WINDOW,
    round_tokens: int | None = None,
    end_id: int = END_ID,
    seed: int = 23,
) -> DataFrame:
    """(key, start, length, doc_tokens, sequence_id, offset, ids): one row for each piece of a document.

    ``tokenizer`` is the path of a tokenizer file that every worker can open. ``shares``
    (source, share) are the target proportions; without it, those of the tokens, with
    which all queues end together. Sequences have ``window`` tokens (a power of two); what is
    left at the end fills sequences of falling powers of two, so nothing is padded.
    Each round of ``round_tokens``, a window if not given, holds the target shares until a queue is dry.
    Every task knows all sources, and a round takes time with their number. ``ids`` are little-endian unsigned 32-bit.

    A null text is empty: its document is the closing id alone. A null source is a
    queue of its own. Rows that repeat a key are documents of their own. The order in
    a queue is that of a seeded hash of the key, then of the rows as written down. An
    empty table gives no rows. Other columns are not read.
    """
    tokens = tokenize(docs, key, text, source, tokenizer, end_id)
    places, rounds = layout(tokens, shares, window, round_tokens or window, seed)
    total = rounds.total if rounds else 0
    full, tail = total - total % window, tail_cuts(total, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, counts = batch.column(0), batch.column(3).to_numpy()
            queue, begins = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            ids, first = _numbers(batch.column(4), int(counts.sum()))
            for rows, low, high, place in rounds.pieces(queue, begins, begins + counts):
                which, sequence, base, begin, stop = cut_places(place, place + high - low, full, tail, window)
                start, length, rows = low[which] + begin - place[which], stop - begin, rows[which]
                held = np.cumsum(length)
                at = 0
                while at < len(rows):
                    to = max(at + 1, int(np.searchsorted(held, held[at] + SLICE_BYTES, "right")))
                    some = slice(at, to)
                    numbers = [start[some], length[some], counts[rows[some]], sequence[some], (begin - base)[some]]
                    cells = _runs(ids, first[rows[some]] + start[some], length[some])
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows[some])), *map(pa.array, numbers), cells], names)
                    at = to

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    met = tokens.select("row", "key", "n", "ids").join(places, "row").select("key", "queue", "begin", "n", "ids")
    return met.mapInArrow(cut, schema).withColumnRenamed("key", key)


def public_tokenizer() -> str:
    """The path of the tokenizer file that the query uses."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_pack")
def op7_pack(spark, sf_dir):
    """All documents packed; each piece's ids by their checksum."""
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
