"""Aligning the tokens of two tokenizers on the bytes of a text.

Both tokenizers tell which part of the text a token comes from: tokenizers in characters, sentencepiece in
bytes. These spans are the coarse cuts. Tokens that hold a part of a character, and byte-fallback tokens,
have spans that overlap or are empty; between the coarse cuts the bytes that tokens stand for part them.
Bytes at which tokens of both end part a text into groups.

A text is cut before single blanks, where no token of either kind can lie across, and a piece met before is not
aligned again; new ones are encoded side by side. Links are counted in slices of the corpus, summed by pair of ids, and looked up by slice again.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bytetext import slices
from larkspur.llm.lookup import SMALL_TABLE, Found, record, slice_names, sum_by, with_lookup
from larkspur.llm.registry import query, table
from larkspur.operators.skew import skew_join
from larkspur.session import materialize

SLICE_BYTES = 1 << 20
KNOWN_BYTES = 160 << 20  # of pieces and their alignments that a worker remembers
JOINED = 1 << 14  # characters of new pieces that are encoded as one text
LONG_PIECE = 64  # characters from which a piece is not remembered
FLUSH = 2_000_000  # distinct pairs that a task holds before it sends them

_ODD = re.compile(r"[^\S ] | [^\S ]|  |^ | $")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies print for each byte: itself if visible, else the next free one from 256."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(other)}


def text_pieces(text: str) -> list[str]:
    """Pieces of a text, each without the blank before it: cut at blanks between visible characters."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def token_ends(begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where tokens end in bytes: at the end of their span, or by their own bytes where the next one's span overlaps it or is empty."""
    shared = ends == begins
    shared[:-1] |= (begins[1:] < ends[:-1]) | (ends[1:] == ends[:-1])
    shared[-1:] = False
    own = np.cumsum(sizes)
    sure = np.maximum.accumulate(np.where(shared, -1, np.arange(len(ends))))
    return own + np.where(sure >= 0, ends[sure] - own[sure], 0)


class Aligned:
    """Tokens of both kinds of one text, links and groups: a link for each run of bytes that holds no end of a token inside."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray):
        self.a, self.b, self.a_ends, self.b_ends = a, b, a_ends, b_ends
        self.link_ends = np.unique(np.concatenate([a_ends, b_ends]))
        i, j = np.searchsorted(a_ends, self.link_ends), np.searchsorted(b_ends, self.link_ends)
        self.pairs = a[i] << 32 | b[j]
        self.cuts = self.link_ends[(a_ends[i] == self.link_ends) & (b_ends[j] == self.link_ends)]
        # the group of each token
        self.a_groups, self.b_groups = np.searchsorted(self.cuts, a_ends), np.searchsorted(self.cuts, b_ends)


class Aligner:
    """Two tokenizer files, and what is known of pieces met before."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = byte_letters()
        self.a_bytes = [bytes(byte[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in held]) for held in (self.a_bytes, self.b_bytes))
        # ids as text, with what stands behind one in a group and behind the last one
        self.a_text = [np.array([f"{i}{end}".encode() for i in range(len(self.a_bytes))], object) for end in ",|"]
        self.b_text = [np.array([f"{i}{end}".encode() for i in range(len(self.b_bytes))], object) for end in ",;"]
        splitter = str(self.a.pre_tokenizer)
        self.cuts = (
            splitter.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in splitter
            and self.a.normalizer is None and not any("▁" in p.lstrip("▁") for p in pieces)
        )
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.groups: list[bytes] = []
        self.sizes = np.zeros((1024, 5), np.int64)  # tokens of both, groups, links, where the links begin; -1 tokens: unequal bytes
        self.links = np.zeros(1 << 16, np.int64)
        self.linked = 0

    def align(self, text: str) -> Aligned | None:
        """A blank and ``text``, aligned; None if the tokens of either kind do not spell it."""
        want = b" " + text.encode()
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        whole = self.b.encode_as_proto(text).pieces
        a, b = encoded.ids, [p.id for p in whole]
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        spans = np.array(encoded.offsets, np.int64).reshape(-1, 2)
        if len(want) > len(text) + 1:  # characters to bytes
            starts = np.flatnonzero(np.frombuffer(want, np.uint8) & 0xC0 != 0x80)
            spans = np.append(starts, len(want))[spans]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends = token_ends(spans[:, 0], spans[:, 1], self.a_sizes[a])
        # sentencepiece puts the first blank itself, and its spans do not count it
        begins, ends = (np.array(x, np.int64) + 1 for x in ([p.begin for p in whole], [p.end for p in whole]))
        begins[:1] = 0
        return Aligned(a, b, a_ends, token_ends(begins, ends, self.b_sizes[b]))

    def learn(self, pieces: list[str]) -> None:
        """Align new pieces, many in one text where blanks may part them."""
        joined, size = [], 0
        for piece in pieces:
            if not piece or piece[0].isspace() or piece[-1].isspace() or not self.cuts or len(piece) > JOINED:
                self._add([piece])
                continue
            joined.append(piece)
            size += len(piece)
            if size > JOINED:
                self._add(joined)
                joined, size = [], 0
        if joined:
            self._add(joined)

    def _add(self, pieces: list[str]) -> None:
        found = self.align(" ".join(pieces))
        if found is None and len(pieces) > 1:
            self._add(pieces[: len(pieces) // 2])
            self._add(pieces[len(pieces) // 2 :])
            return
        first, n = len(self.groups), len(pieces)
        while first + n > len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.known.update(zip(pieces, range(first, first + n)))
        if found is None:
            self.groups.append(b"")
            self.sizes[first] = (-1, -1, 0, 0, self.linked)
            return
        ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        upto = [np.searchsorted(x, ends, "right") for x in (found.a_ends, found.b_ends, found.cuts, found.link_ends)]
        self.sizes[first : first + n, :4] = np.stack([np.diff(u, prepend=0) for u in upto], 1)
        self.sizes[first : first + n, 4] = self.linked + np.concatenate([[0], upto[3][:-1]])
        while self.linked + len(found.pairs) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[self.linked : self.linked + len(found.pairs)] = found.pairs
        self.linked += len(found.pairs)
        texts = self._texts(found)
        low = 0
        for high in (upto[0] + upto[1]).tolist():
            self.groups.append(b"".join(texts[low:high])[:-1])
            low = high
        self.held += 300 * n + 2 * int(ends[-1]) + 8 * len(found.pairs) + sum(map(len, texts))

    def _texts(self, found: Aligned) -> list[bytes]:
        """The ids of all groups as text, one by one with what stands behind."""
        parts = []
        for ids, group, text in ((found.a, found.a_groups, self.a_text), (found.b, found.b_groups, self.b_text)):
            last = np.append(group[1:] != group[:-1], True)
            parts.append(np.where(last, text[1][ids], text[0][ids]))
        order = np.argsort(np.concatenate([found.a_groups * 2, found.b_groups * 2 + 1]), kind="stable")
        return np.concatenate(parts)[order].tolist()

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts in order, and how many pieces each text has."""
        if self.held > KNOWN_BYTES:
            self.forget()
        split = [text_pieces(t) if self.cuts else [t] for t in texts]
        new = set().union(*split).difference(self.known)
        self.learn(list(new))
        known = self.known
        flat = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64)
        for piece in new:
            if len(piece) >= LONG_PIECE:
                del known[piece]
        return flat, np.array([len(pieces) for pieces in split], np.int64)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each worker."""
    return Aligner(a_path, b_path)


def _expand(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... for each run of the given length."""
    return np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _upto(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs that end before ``ends``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(np.concatenate([[0], total[ends]]))


def _slice_schema(kind: str) -> str:
    return (
        f"slice long, keys array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, sha array<string>, "
        "entries array<long>, width int, codes binary, times binary, pairs binary, docs binary"
    )


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def link_slices(docs: DataFrame, key: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """Slices of documents: sizes and group digests of each, the pairs linked in each and how often; written down."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, names, form = aligner(a_path, b_path), slice_names(), None
        for batch in batches:
            form = form or pa.schema([
                ("slice", pa.int64()), ("keys", pa.list_(batch.schema.field("key").type)), *[(c, pa.list_(pa.int64())) for c in ("n_a", "n_b", "n_groups")],
                ("sha", pa.list_(pa.string())), ("entries", pa.list_(pa.int64())), ("width", pa.int32()), *[(c, pa.binary()) for c in ("codes", "times", "pairs", "docs")],
            ])
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column(1).to_pylist()
                yield record({"slice": next(names), "keys": part.column(0).to_pylist(), **_slice(work, texts)}, form)

    return materialize(_texts(docs, key, text).mapInArrow(run, _slice_schema(kind.simpleString())), "links")


def _slice(work: Aligner, texts: list[str]) -> dict:
    flat, counts = work.numbers(texts)
    ends = np.cumsum(counts)
    sizes = work.sizes[flat]
    good = (_upto(sizes[:, 0] < 0, ends) == 0) & np.array([t != "" for t in texts], bool)
    n_a, n_b, n_groups = (np.where(good, _upto(sizes[:, c], ends), 0) for c in range(3))
    sha, groups, first = [], work.groups, 0
    for ok, end in zip(good.tolist(), ends.tolist()):
        sha.append(hashlib.sha256(b";".join([groups[i] for i in flat[first:end].tolist()])).hexdigest() if ok else "")
        first = end
    kept = np.repeat(good, counts)
    lengths, begins = sizes[kept, 3], sizes[kept, 4]
    pairs, links = np.unique(work.links[_expand(begins, lengths)], return_inverse=True)
    doc = np.repeat(np.repeat(np.arange(len(texts)), counts)[kept], lengths)
    both, times = sum_by(doc << 32 | links, np.ones(len(links), np.int64))
    code = both & 0xFFFFFFFF
    entries = np.bincount(both >> 32, minlength=len(texts))
    width = 2 if len(pairs) < 1 << 16 else 4
    return {
        "n_a": n_a.tolist(), "n_b": n_b.tolist(), "n_groups": n_groups.tolist(), "sha": sha, "entries": entries.tolist(), "width": width,
        "codes": code.astype(f"<u{width}"), "times": times.astype("<u4"), "pairs": pairs, "docs": np.bincount(code, minlength=len(pairs)).astype("<u4"),
    }


def pair_counts(links: DataFrame) -> DataFrame:
    """(key, n, best): documents that have each pair linked, and whether no pair of its first id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for pairs, docs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(pairs, np.int64), np.frombuffer(docs, "<u4").astype(np.int64)
                keys, counts = sum_by(np.concatenate([keys, more[0]]), np.concatenate([counts, more[1]]))
                if len(keys) > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])
                    keys, counts = keys[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    counted = links.select("pairs", "docs").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "pairs")
    first = F.shiftright("key", 32)
    most = counted.groupBy(first.alias("_a")).agg(F.max("n").alias("_most"))
    marked = skew_join(counted.withColumn("_a", first), most, ["_a"])
    return materialize(marked.select("key", "n", (F.col("n") == F.col("_most")).cast("bigint").alias("best")), "pairs")


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", small_table: int = SMALL_TABLE
) -> tuple[DataFrame, DataFrame]:
    """Alignments of every text, and (a_id, b_id, n, best): how many documents have the tokens linked.

    The first frame has (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256). ``a_path`` is a byte-level file for
    tokenizers, ``b_path`` a model for sentencepiece; every worker must be able to open both. A text is encoded with a blank before it and without
    special tokens, whose strings in a text are text. Tokens of both whose bytes overlap are linked; bytes where
    tokens of both end part groups. ``n_best`` counts the links whose pair is linked in as many documents as any pair of its first id,
    ``count_sum`` adds up the documents of the links' pairs, and the digest is that of ``a1,a2|b1;a3|b2``.

    A null or empty text, and one whose tokens do not spell it, has no tokens: zeros and an empty digest. Rows that repeat
    a key are documents of their own. A long text is one slice of its own; it is not cut but at blanks. An empty table gives no
    rows. Other columns are not read. :func:`aligned_spans` gives the groups themselves.
    """
    links = link_slices(docs, key, text, a_path, b_path)
    counted = pair_counts(links)
    kind = docs.schema[key].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(row: dict, found: Found) -> Iterator[pa.RecordBatch]:
        _, (n, best) = found(np.frombuffer(row["pairs"], np.int64))
        codes = np.frombuffer(row["codes"], f"<u{row['width']}").astype(np.int64)
        times = np.frombuffer(row["times"], "<u4").astype(np.int64)
        ends = np.cumsum(np.array(row["entries"], np.int64))
        sums = [_upto(v, ends) for v in (times, times * best[codes], times * n[codes])]
        columns = [row["n_a"], row["n_b"], row["n_groups"], *[s.tolist() for s in sums]]
        cells = [pa.array(c, pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays([keys_array(row["keys"]), *cells, pa.array(row["sha"], pa.string())], ["key", *names, "groups_sha256"])

    form = _arrow_type(docs, key)

    def keys_array(keys: list) -> pa.Array:
        return pa.array(keys, form)

    schema = f"key {kind}, {', '.join(f'{c} long' for c in names)}, groups_sha256 string"
    rows = with_lookup(links, lambda row: np.frombuffer(row["pairs"], np.int64), counted, run, schema, small_table)
    low = F.col("key").bitwiseAND(F.lit((1 << 32) - 1))
    pairs = counted.select(F.shiftright("key", 32).alias("a_id"), low.alias("b_id"), "n", (F.col("best") == 1).alias("best"))
    return rows.withColumnRenamed("key", key), pairs


def _arrow_type(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def aligned_spans(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, group, begin, end, a_ids, b_ids): the groups of every text in order, with their bytes of a blank and the text.

    Cases are those of :func:`align_tokens`; a text without tokens has no row.
    """
    kind, form = docs.schema[key].dataType.simpleString(), _arrow_type(docs, key)
    names = ["key", "group", "begin", "end", "a_ids", "b_ids"]
    types = [form, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def groups(work: Aligner, whole: str) -> Iterator[tuple]:
        found = work.align(whole)
        if found is None:
            return
        a, b, begin = found.a.tolist(), found.b.tolist(), 0
        i = j = 0
        upto = (np.searchsorted(x, found.cuts, "right").tolist() for x in (found.a_ends, found.b_ends))
        for number, (end, x, y) in enumerate(zip(found.cuts.tolist(), *upto)):
            yield number, begin, end, a[i:x], b[j:y]
            begin, i, j = end, x, y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(a_path, b_path)
        for batch in batches:
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(name, *g) for g in (groups(work, whole) if whole else ())]
                for k in range(0, len(rows), 10_000):
                    columns = zip(*rows[k : k + 10_000])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = f"key {kind}, group long, begin long, end long, a_ids array<long>, b_ids array<long>"
    return _texts(docs, key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


def public_files() -> tuple[str, str]:
    """The two tokenizer files that the query uses."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_align_tokens")
def op12_align_tokens(spark, sf_dir):
    """Every document's tokens of both kinds, aligned, with what the corpus says of the links."""
    return align_tokens(table(spark, sf_dir, "documents"), *public_files())[0]
