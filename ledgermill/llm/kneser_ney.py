"""Interpolated modified Kneser-Ney scoring with bigrams counted in Spark.

Words are lower-cased runs of non-space characters; every text ends in one end token.  The model is
a folder of segments in the shared folder, which workers map into memory and never load whole:

- words: sorted 64-bit hashes with counts and the running total of the counts.  A word's place in
  that order is its id.
- bigrams: sorted numbers context * (V + 1) + word with counts, and per context how many bigrams
  occur once, twice and more often.  A segment holds an equal share of the tokens: a bigram lies at
  (tokens of earlier contexts) + (its word's place, as a share) * (tokens of its context), so the
  bigrams of a very frequent context are cut among segments as well.
- continuations: by word id, the number of different contexts of the word.

Map tasks add up counts before they send them, as sorted packed arrays, one row per segment; a
segment is written by the one task that merges its arrays, under a temporary name first, so a task
that runs again leaves the same file.  Counts cover all training texts; nothing is pruned.  Hashes
stand for words: with V different words two share a hash with probability V * V / 2 ** 65.

Defined results: a null or empty text is the end token alone; an unknown word gets the share of the
uniform distribution over the vocabulary and one more; without training text all scores are 0; rows
without an id count as training rows; repeated rows are counted each time.
"""

from __future__ import annotations

import json
import mmap
import os
import sys
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import LOWER_BYTES, settle, shared_folder, slices

END, START = b"\n", b" "  # no words, as they are white space
#: Tokens whose counts a map task adds up before it sends them.
BUFFER = 1 << 22
#: Tokens of a bigram segment, at most.
SEGMENT = 1 << 23
#: Words a worker remembers ids or counts of; then it starts anew.
MEMO = 300_000
_CODEC = pa.Codec("zstd", 1)


def tokens(text: str | None) -> list[bytes]:
    out = (text or "").encode().translate(LOWER_BYTES).split()
    out.append(END)
    return out


# Packed arrays

def pack(values: np.ndarray) -> bytes:
    """Sorted numbers, as differences by byte planes."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return _CODEC.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_CODEC.decompress(data, 8 * n, asbytes=True), np.uint8)
    return np.cumsum(planes.reshape(8, n).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def packed(segment: np.ndarray, keys: np.ndarray, counts: np.ndarray):
    """A batch with a row for each run of equal segments of sorted keys."""
    cut = np.flatnonzero(np.diff(segment, prepend=-1)) if len(segment) else np.zeros(0, np.int64)
    parts = list(zip(cut, np.append(cut[1:], len(keys))))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(segment[a]) for a, _ in parts], pa.int32()),
         pa.array([int(b - a) for a, b in parts], pa.int32()),
         pa.array([pack(keys[a:b]) for a, b in parts], pa.binary()),
         pa.array([pack(np.cumsum(counts[a:b])) for a, b in parts], pa.binary())],
        ["seg", "n", "keys", "counts"])


PACKED = "seg int, n int, keys binary, counts binary"


def merged(batches):
    """(segment, sorted keys, summed counts) of a task's packed rows."""
    parts: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            parts.setdefault(r["seg"], []).append(r)
    for seg, rows in sorted(parts.items()):
        keys = np.concatenate([unpack(r["keys"], r["n"]) for r in rows])
        counts = np.concatenate([np.diff(unpack(r["counts"], r["n"]), prepend=np.uint64(0)) for r in rows])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        yield seg, keys[first], np.add.reduceat(counts, first)


# Segment files

def write(folder: str, name: str, arrays: dict[str, np.ndarray]):
    head = json.dumps({k: [a.dtype.str, len(a)] for k, a in arrays.items()}).encode()
    head += b" " * (-len(head) % 8)
    temp = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(temp, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            f.write(a.tobytes() + bytes(-a.nbytes % 8))
    os.replace(temp, f"{folder}/{name}")


def read(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory."""
    with open(f"{folder}/{name}", "rb") as f:
        more = {"trackfd": False} if sys.version_info >= (3, 13) else {}
        data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **more)
    at = int.from_bytes(data[:8], "little")
    out, place = {}, 8 + at
    for k, (kind, n) in json.loads(data[8:place]).items():
        out[k] = np.frombuffer(data, kind, n, place)
        place += -(-out[k].nbytes // 8) * 8
    return out


class Model:
    """Reads segments on demand.  `meta` holds what the driver knows: sizes by segment and discounts."""

    def __init__(self, meta: dict):
        self.meta, self.folder = meta, meta["folder"]
        self.starts = np.concatenate([[0], np.cumsum(meta["sizes"])]).astype(np.int64)
        self.mass = np.concatenate([[0], np.cumsum(meta["totals"])]).astype(np.int64)
        self.v, self.n = int(self.starts[-1]), int(self.mass[-1])
        self.docs, self.width = meta["docs"], int(self.starts[-1]) + 1
        self.filled = set(meta.get("filled", ()))
        self.open: dict[str, dict] = {}
        self.ids: dict[bytes, int] = {}

    def file(self, name: str) -> dict[str, np.ndarray]:
        if name not in self.open:
            self.open[name] = read(self.folder, name)
        return self.open[name]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of hashes, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        order = np.argsort(hashes)
        seg = segment_of(hashes[order], len(self.meta["sizes"]))
        for s, a, b in runs(seg):
            if self.meta["sizes"][s]:
                known, h = self.file(f"words-{s}")["hash"], hashes[order[a:b]]
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                out[order[a:b]] = np.where(known[at] == h, at + self.starts[s], -1)
        return out

    def take(self, kind: str, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of sorted ids; 0 for those out of the vocabulary."""
        out = np.zeros(len(ids), np.int64)
        inside = np.flatnonzero((ids >= 0) & (ids < self.v))
        seg = np.searchsorted(self.starts, ids[inside], side="right") - 1
        for s, a, b in runs(seg):
            rows = inside[a:b]
            out[rows] = self.file(f"{kind}-{s}")[name][ids[rows] - self.starts[s]]
            if name == "before":
                out[rows] += self.mass[s]
        return out

    def encode(self, words: list[bytes]) -> np.ndarray:
        if len(self.ids) > MEMO:
            self.ids = {}
        ids = self.ids
        new = [w for w in dict.fromkeys(words) if w not in ids]
        if new:
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in new], np.uint64)
            ids.update(zip(new, self.find(hashes).tolist()))
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def contexts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of the context, tokens of earlier ones) for sorted ids; V is a text's start."""
        count, before = self.take("words", "count", ids), self.take("words", "before", ids)
        count[ids == self.v], before[ids == self.v] = self.docs, self.n
        return count, before

    def segments(self, count, before, word) -> np.ndarray:
        share = before + count * (word / self.width)
        total = max(self.n + self.docs, 1)
        return np.minimum(share * (self.meta["segments"] / total), self.meta["segments"] - 1).astype(np.int64)

    def bigrams(self, u: np.ndarray, w: np.ndarray):
        """Sorted distinct bigrams of two known words each, their segments, and where each came from."""
        keys, back = np.unique(u * self.width + w, return_inverse=True)
        u, w = keys // self.width, keys % self.width
        distinct, at = np.unique(u, return_inverse=True)
        count, before = self.contexts(distinct)
        return keys, self.segments(count[at], before[at], w), back

    # Probabilities

    def word_shares(self, w: np.ndarray) -> np.ndarray:
        """The continuation probability of sorted ids, -1 for an unknown word."""
        m, total = self.meta["m"], self.meta["types"]
        if not total:
            return np.full(len(w), 1 / (self.v + 1))
        d = np.array([0.0, *self.meta["d_words"]])
        k = self.take("cont", "n", w)
        rest = sum(x * y for x, y in zip(d[1:], [m[0], m[1], sum(m[2:])])) / total
        return (k - d[np.minimum(k, 3)]) / total + rest / (self.v + 1)

    def context_rests(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, discounted mass) of sorted distinct context ids."""
        count, before = self.contexts(u)
        out = np.zeros(len(u))
        low = self.segments(count, before, np.zeros(len(u)))
        high = self.segments(count, before, np.full(len(u), self.width - 1))
        open_ = np.flatnonzero(count > 0)
        for s in np.unique(np.concatenate([low[open_], high[open_]])) if len(open_) else ():
            self._add_rests(int(s), u, open_[(low[open_] == s) | (high[open_] == s)], out)
        for i in open_[high[open_] > low[open_] + 1]:  # few, as each takes up a whole segment
            for s in range(int(low[i]) + 1, int(high[i])):
                self._add_rests(s, u, np.array([i]), out)
        return count, out

    def _add_rests(self, s: int, u, rows, out):
        if s in self.filled:
            part = self.file(f"bigrams-{s}")
            at = np.minimum(np.searchsorted(part["context"], u[rows]), len(part["context"]) - 1)
            hit = part["context"][at] == u[rows]
            d = self.meta["d"]
            rest = d[0] * part["once"][at] + d[1] * part["twice"][at] + d[2] * part["more"][at]
            out[rows] += np.where(hit, rest, 0.0)

    def counts(self, keys: np.ndarray, seg: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for s, a, b in runs(seg):
            if s in self.filled:
                part = self.file(f"bigrams-{s}")
                at = np.minimum(np.searchsorted(part["key"], keys[a:b]), len(part["key"]) - 1)
                out[a:b] = np.where(part["key"][at] == keys[a:b], part["count"][at], 0)
        return out

    def score(self, texts: list[str | None]) -> list[np.ndarray]:
        """n_tokens, n_known, base score and score of each text."""
        size, words = [], []
        for t in texts:
            part = tokens(t)
            size.append(len(part))
            words += part
        size = np.array(size)
        first = np.cumsum(size) - size
        w = self.encode(words)
        u = np.roll(w, 1)
        u[first] = self.v
        distinct, at = np.unique(w, return_inverse=True)
        count = self.take("words", "count", distinct)
        base = np.log10((count + 1) / (self.n + self.v + 1))[at]
        p = self.word_shares(distinct)[at]
        contexts, of = np.unique(u, return_inverse=True)
        total, rest = self.context_rests(contexts)
        c = np.zeros(len(w), np.int64)
        both = np.flatnonzero((u >= 0) & (w >= 0))
        if len(both):
            keys, seg, back = self.bigrams(u[both], w[both])
            c[both] = self.counts(keys, seg)[back]
        d = np.array([0.0, *self.meta["d"]])
        total, rest = total[of], rest[of]
        known = total > 0
        safe = np.where(known, total, 1)
        p = np.where(known, (c - d[np.minimum(c, 3)]) / safe + rest / safe * p, p)
        return [size, np.add.reduceat((count > 0)[at].astype(np.int64), first),
                np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first)]


def runs(sorted_: np.ndarray):
    """(value, from, to) of the runs of equal values."""
    cut = np.flatnonzero(np.diff(sorted_, prepend=-1)) if len(sorted_) else []
    for a, b in zip(cut, [*cut[1:], len(sorted_)]):
        yield int(sorted_[a]), int(a), int(b)


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)


@lru_cache(maxsize=1)
def _opened(meta: str) -> Model:
    return Model(json.loads(meta))


def opened(meta: dict) -> Model:
    return _opened(json.dumps(meta))


def discounts(n: list[int]) -> list[float]:
    """The three discounts from how many counts are 1, 2, 3 and 4.

    Half the count where the estimate is not between 0 and the count, as in very small tables:
    unseen bigrams keep a share in any case.
    """
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.0 for i in range(3)]
    return [d if 0 < d < i + 1 else (i + 1) / 2 for i, d in enumerate(found)]


# Training

def train(docs: DataFrame, text: str = "text") -> dict:
    """Count all texts; returns the description of the model, whose arrays lie in the shared folder."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "kneser-ney")
    os.makedirs(folder, exist_ok=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(text).alias("x10_text"))

    def count_words(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            column = batch.column(0)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                for t in column.slice(a, b - a).to_pylist():
                    for w in tokens(t):
                        seen[w] = seen.get(w, 0) + 1
                if len(seen) > MEMO:
                    yield sent(seen)
                    seen = {}
        if seen:
            yield sent(seen)

    def sent(seen):
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in seen], np.uint64)
        counts = np.fromiter(seen.values(), np.int64, len(seen))
        order = np.argsort(hashes)
        return packed(segment_of(hashes[order], parts), hashes[order], counts[order])

    def write_words(batches):
        for seg, keys, counts in merged(batches):
            write(folder, f"words-{seg}", {"hash": keys, "count": counts,
                                           "before": np.cumsum(counts) - counts})
            at = np.flatnonzero(keys == np.uint64(xxhash.xxh64_intdigest(END)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in (
                    seg, len(keys), int(counts.sum()), int(counts[at].sum()))],
                ["seg", "size", "total", "docs"])

    rows = (texts.mapInArrow(count_words, PACKED).repartition(parts, "seg")
            .mapInArrow(write_words, "seg long, size long, total long, docs long").collect())
    sizes, totals = [0] * parts, [0] * parts
    for r in rows:
        sizes[r["seg"]], totals[r["seg"]] = r["size"], r["total"]
    n, n_docs = sum(totals), sum(r["docs"] for r in rows)
    if (sum(sizes) + 1) ** 2 >= 1 << 63:
        raise ValueError("more different words than a bigram's number can hold")
    meta = {"folder": folder, "sizes": sizes, "totals": totals, "docs": n_docs,
            "segments": max(parts, -(-n // SEGMENT))}

    def count_bigrams(batches):
        model, held, size = opened(meta), [], 0
        for batch in batches:
            column = batch.column(0)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                words, starts = [], []
                for t in column.slice(a, b - a).to_pylist():
                    starts.append(len(words))
                    words += tokens(t)
                w = model.encode(words)
                u = np.roll(w, 1)
                u[starts] = model.v
                held.append(u * model.width + w)
                size += len(w)
                if size > BUFFER:
                    yield sent_bigrams(model, held)
                    held, size = [], 0
        if size:
            yield sent_bigrams(model, held)

    def sent_bigrams(model, held):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        _, seg, _ = model.bigrams(keys // model.width, keys % model.width)
        return packed(seg, keys, counts)

    def write_bigrams(batches):
        model = opened(meta)
        for seg, keys, counts in merged(batches):
            keys = keys.astype(np.int64)
            context, word = keys // model.width, keys % model.width
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
            each = {k: np.add.reduceat(x.astype(np.int64), first) for k, x in (
                ("once", counts == 1), ("twice", counts == 2), ("more", counts > 2))}
            write(folder, f"bigrams-{seg}", {"key": keys, "count": counts, "context": context[first], **each})
            words, n = np.unique(word, return_counts=True)
            at = np.searchsorted(model.starts, words, side="right") - 1
            yield packed(at, words, n)
            stats = np.array([len(keys), *((counts == i).sum() for i in (1, 2, 3, 4))], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1 - seg], pa.int32()), pa.array([0], pa.int32()),
                 pa.array([stats.tobytes()], pa.binary()), pa.array([b""], pa.binary())],
                ["seg", "n", "keys", "counts"])

    sent_on = settle(texts.mapInArrow(count_bigrams, PACKED).repartition(meta["segments"], "seg")
                     .mapInArrow(write_bigrams, PACKED), "kneser-ney-words")
    stats = sent_on.where("seg < 0").select("seg", "keys").collect()  # a row for each segment
    kinds = np.sum([np.frombuffer(r["keys"], np.int64) for r in stats], axis=0) if stats else [0] * 5
    meta["filled"] = sorted(-1 - r["seg"] for r in stats)

    def write_continuations(batches):
        model = opened(meta)
        for seg, words, n in merged(batches):
            dense = np.zeros(meta["sizes"][seg], np.int64)
            dense[words.astype(np.int64) - model.starts[seg]] = n
            write(folder, f"cont-{seg}", {"n": dense})
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x)], pa.int64()) for x in (*((n == i).sum() for i in (1, 2, 3, 4)), (n > 4).sum())],
                ["m1", "m2", "m3", "m4", "m5"])

    rows = (sent_on.where("seg >= 0").repartition(parts, "seg")
            .mapInArrow(write_continuations, "m1 long, m2 long, m3 long, m4 long, m5 long").collect())
    m = [sum(r[i] for r in rows) for i in range(5)]
    return meta | {"types": int(kinds[0]), "d": discounts([int(x) for x in kinds[1:]]),
                   "m": m, "d_words": discounts(m[:4])}


def score(docs: DataFrame, meta: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default), n_tokens, n_known, train_tokens, base_score and score."""
    new = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(),
           "base_score": T.DoubleType(), "score": T.DoubleType()}
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(k, t) for k, t in new.items()])

    def run(batches):
        model = opened(meta)
        for batch in batches:
            column, rest = batch.column("x10_text"), batch.select(kept)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                n, known, base, full = model.score(column.slice(a, b - a).to_pylist())
                trained = np.full(b - a, model.n, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(a, b - a).columns, *map(pa.array, (n, known, trained, base, full))],
                    [*kept, *new])

    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("x10_text"))
    return source.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: scores of every document; learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)).alias("held_out"))
    model = train(docs.where("NOT held_out"))
    return score(docs, model, keep=["doc_id", "held_out"])
