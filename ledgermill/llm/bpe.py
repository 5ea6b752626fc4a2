"""Byte-level BPE over rank files: encoding by rounds on padded matrices, and decoding.

Each match of the split pattern is encoded by itself.  A batch's distinct pieces are laid out as
padded matrices, one per length bucket.  In a round every row merges its leftmost pair of minimum
rank; ranks come from a hashed table of all pairs that form a token, merged rows are compacted by
one column, rows without a pair leave the matrix.  Pieces longer than LONG bytes form a matrix of
one row whose round merges all places of the minimum rank at once where that equals merging them
one after the other, which is tested; otherwise it merges the leftmost.  So a piece of a million
equal letters takes a few rounds.

Defined results: a null or empty text has no ids; repeated rows are encoded like any other; an
existing column of the result's name is replaced.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import slices

NONE = np.iinfo(np.int32).max
#: Longest piece, in bytes, of the matrices with many rows.
LONG = 128
#: Cells of one matrix.
CELLS = 1 << 20
#: Distinct pieces a worker remembers; then it starts anew, which changes no result.
MEMO = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open addressing on (left, right): the rank of the token that the two form, else NONE."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys = self._key(left, right)
        self.bits = max(4, int(len(keys) * 4 - 1).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        self.probes, slot, todo = 0, self._slot(keys), np.arange(len(keys))
        while len(todo):
            at = (slot[todo] + self.probes) & self.mask
            free = self.keys[at] == -1
            _, first = np.unique(at[free], return_index=True)
            placed = todo[free][first]
            where = (slot[placed] + self.probes) & self.mask
            self.keys[where], self.ranks[where] = keys[placed], rank[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            self.probes += 1

    @staticmethod
    def _key(left, right):
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys):
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left, right)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for p in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + p) & self.mask
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit & (found != -1)]
        return out


class Tokenizer:
    """Ranks of a file of base64 tokens, with memoised pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        ranks = {base64.b64decode(t): int(r) for t, r in pairs}
        self.split = regex.compile(pattern)
        tokens = [b""] * (max(ranks.values()) + 1)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            tokens[r] = token
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self.pairs = PairTable(*(np.array(x, np.int32) for x in (left, right, rank)))
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.ends = np.cumsum([len(t) for t in tokens])
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.forget()

    def forget(self):
        self.code: dict[str, int] = {}
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    # Encoding

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, offsets of the texts)."""
        if len(self.code) > MEMO:
            self.forget()
        code, find = self.code, self.split.findall
        codes, ends, known = [], [0], len(self.code)
        for text in texts:
            for piece in find(text) if text else ():
                at = code.get(piece)
                if at is None:
                    at = code[piece] = len(code)
                codes.append(at)
            ends.append(len(codes))
        if len(code) > known:
            new = list(code)[known:] if known == 0 else self._last(len(code) - known)
            self._remember(self.pieces([p.encode() for p in new]))
        codes = np.array(codes, np.int64)
        ids, offsets = gather(self.flat, self.starts[codes], self.sizes[codes])
        return ids, offsets[np.array(ends)]

    def _last(self, n: int) -> list[str]:
        keys = reversed(self.code)
        return [next(keys) for _ in range(n)][::-1]

    def _remember(self, encoded: tuple[np.ndarray, np.ndarray]):
        flat, sizes = encoded
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])

    def pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in one array, number of ids of each)."""
        length = np.array([len(p) for p in pieces], np.int64)
        raw = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        start = np.cumsum(length) - length
        size, parts, owner = np.zeros(len(pieces), np.int64), [], []
        bucket = np.where(length > LONG, -1, np.ceil(np.log2(np.maximum(length, 1))).astype(int))
        for b in np.unique(bucket):
            rows = np.flatnonzero(bucket == b)
            step = 1 if b < 0 else max(1, CELLS >> int(b))
            for i in range(0, len(rows), step):
                part = rows[i:i + step]
                if b < 0:
                    done = [(part, self._long(raw[start[part[0]]:start[part[0]] + length[part[0]]])[None])]
                else:
                    at = start[part, None] + np.arange(1 << int(b))
                    inside = np.arange(1 << int(b)) < length[part, None]
                    m = np.where(inside, raw[np.minimum(at, len(raw) - 1)], -1)
                    done = self._matrix(part, m)
                for who, ids in done:
                    real = ids >= 0
                    size[who] = real.sum(1)
                    parts.append(ids[real])
                    owner.append(np.repeat(who, size[who]))
        if not parts:
            return np.zeros(0, np.int32), size
        order = np.argsort(np.concatenate(owner), kind="stable")
        return np.concatenate(parts)[order], size

    def _ranks(self, m: np.ndarray) -> np.ndarray:
        return np.where(m[:, 1:] < 0, NONE, self.pairs.get(m[:, :-1].ravel(), m[:, 1:].ravel())
                        .reshape(len(m), -1))

    def _matrix(self, rows: np.ndarray, m: np.ndarray):
        """Yield (rows, their ids padded with -1) as rows run out of pairs."""
        ranks = self._ranks(m)
        while m.shape[1] > 1:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(m)), at]
            live = best != NONE
            if not live.all():
                yield rows[~live], m[~live]
                rows, m, ranks, at, best = rows[live], m[live], ranks[live], at[live], best[live]
                if not len(rows):
                    return
            line = np.arange(len(m))
            m[line, at] = best
            cols = np.arange(m.shape[1] - 1)
            m = np.take_along_axis(m, cols + (cols > at[:, None]), 1)
            cols = cols[:-1]
            ranks = np.take_along_axis(ranks, cols + (cols >= at[:, None]), 1)
            for off in (-1, 0):
                ok = np.flatnonzero((at + off >= 0) & (at + off + 1 < m.shape[1]))
                a, b = m[ok, at[ok] + off], m[ok, at[ok] + off + 1]
                ranks[ok, at[ok] + off] = np.where(b < 0, NONE, self.pairs.get(a, b))
        yield rows, m

    def _long(self, ids: np.ndarray) -> np.ndarray:
        ids = ids.copy()
        ranks = np.append(self.pairs.get(ids[:-1], ids[1:]), np.int32(NONE))
        while (best := ranks.min()) != NONE:
            at = np.flatnonzero(ranks == best)
            run = np.flatnonzero(np.diff(at, prepend=-9) != 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            merged = np.full(len(at), best, np.int32)
            around = [self.pairs.get(ids[at[at > 0] - 1], merged[at > 0])]
            right = at + 2 < len(ids)
            around.append(self.pairs.get(merged[right], ids[at[right] + 2]))
            around.append(self.pairs.get(merged[:1], merged[:1]))
            if min(x.min(initial=NONE) for x in around) < best:
                at = at[:1]  # a new pair would come before the next place
            ids[at] = best
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, ranks, at = ids[keep], ranks[keep], at - np.arange(len(at))
            for p in (at[at > 0] - 1, at):
                inner = p[p + 1 < len(ids)]
                ranks[inner] = self.pairs.get(ids[inner], ids[inner + 1])
            ranks[-1] = NONE
        return ids

    # Decoding

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all lists in one array, offsets of the lists)."""
        size = self.lengths[ids]
        out, at = gather(self.bytes, self.ends[ids] - size, size)
        return out, at[offsets]


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Concatenate flat[start:start + size]; also the offsets of the parts in the result."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return flat[index], offsets


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(path, pattern)


def _decoded(tok: Tokenizer, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    data, offsets = tok.decode(flat, ends)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _source(docs: DataFrame, keep: list[str] | None, new: dict[str, T.DataType], column: str, own: str):
    """(columns to keep, result's schema, the input with `column` under the name `own`)."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(k, t) for k, t in new.items()])
    return kept, schema, docs.select(*[F.col(f"`{c}`") for c in kept], F.col(column).alias(own))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
           decoded: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) and `ids`, the token ids of the whole text.

    With `decoded`, also a column of that name with the bytes that the ids decode to, so that a
    round trip takes one pass and one worker for each task.
    """
    new = {ids: T.ArrayType(T.IntegerType(), False)} | ({decoded: T.BinaryType()} if decoded else {})
    kept, schema, source = _source(docs, keep, new, text, "x4_text")

    def run(batches):
        tok = tokenizer(path, pattern)
        for batch in batches:
            column, rest = batch.column("x4_text"), batch.select(kept)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy(), 1 << 19):
                flat, offsets = tok.encode(column.slice(a, b - a).to_pylist())
                made = [pa.ListArray.from_arrays(offsets.astype(np.int32), flat)]
                if decoded:
                    made.append(_decoded(tok, flat, offsets))
                yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, *made], [*kept, *new])

    return source.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) and `out`, the bytes that the ids stand for."""
    kept, schema, source = _source(docs, keep, {out: T.BinaryType()}, ids, "x4_ids")

    def run(batches):
        tok = tokenizer(path, pattern)
        for batch in batches:
            lists, rest = batch.column("x4_ids"), batch.select(kept)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            for a, b in slices(4 * sizes):
                flat = lists.slice(a, b - a).flatten().to_numpy()
                part = _decoded(tok, flat, np.concatenate([[0], np.cumsum(sizes[a:b])]))
                yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, part], [*kept, out])

    return source.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, carry: list[str]) -> DataFrame:
    """Encode, decode, and the digests of both sides."""
    both = encode(docs, path, pattern, decoded="decoded", keep=carry)
    return both.select(
        *carry, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: tokens and digests of every document."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN, ["doc_id"])
