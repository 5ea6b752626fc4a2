"""SimHash near-deduplication with a generalised pigeonhole search.

Fingerprints of 64 bits are compared by distinct value.  The bits are grouped into m partitions so
that correlated bits lie together and the other partitions stay selective.  If two fingerprints
differ in at most t bits and partition i is searched up to radius r_i with the r_i + 1 summing to
t + 1, they meet in some partition.  For every fingerprint the radii are chosen by dynamic
programming over estimated costs: probes to send, and candidates to expect from the distribution of
distances within blocks of eight bits.  m itself is the one of least estimated mean cost.  All
choices only move work; every pair within t bits is found with any of them.

A bucket is what shares partition and value.  Buckets are compared in blocks of at most BLOCK
members, larger ones as all pairs of blocks in tasks of their own, and give a spanning forest of
their verified links instead of all pairs.

Defined results: a text without words has fingerprint 0 and is linked like any other; with fewer
words than a shingle the whole sequence is the one shingle; a null id sorts last and never names a
component with another id; rows equal in id and text are one document of which one row stays.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import LOWER_BYTES, bitmaps, passing, settle, slices
from ledgermill.llm.graph import components

#: Members of a bucket that are compared with each other in one step.
BLOCK = 4096
#: Partitions to choose from.
CHOICES = (2, 3, 4, 5)
#: Cost of a probe row, in compared candidates.
PROBE = 400.0
_SHINGLES = 1 << 18


def fingerprint(text: str | None, width: int) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit number."""
    words = (text or "").encode().translate(LOWER_BYTES).split()
    if not words:
        return 0
    width = min(width, len(words))
    joined, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start, stop = (end - size)[:len(words) - width + 1], end[width - 1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(start), _SHINGLES):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(
            start[i:i + _SHINGLES].tolist(), stop[i:i + _SHINGLES].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):
            total += bits[j:j + 255].sum(0, dtype=np.uint8)
    set_ = (2 * total > len(start)).astype(np.uint8)
    return int(np.packbits(set_, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = 4) -> DataFrame:
    """The columns `keep` and fp, the fingerprint of the whole text."""
    def run(batches):
        for batch in batches:
            column, rest = batch.column("x2_text"), batch.select(keep)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                fp = [fingerprint(t, width) for t in column.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(a, b - a).columns, pa.array(fp, pa.int64())], [*keep, "fp"])

    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("x2_text"))
    return source.mapInArrow(run, f"{schema}, fp long")


# Grouping bits, estimating candidates

def _numbers(df: DataFrame, make) -> np.ndarray:
    """Sum over all partitions of `df` of the arrays that make(values) gives for a batch's fp."""
    def run(batches):
        total = None
        for batch in batches:
            part = make(batch.column("fp").to_numpy().view(np.uint64))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.astype(np.int64))],
                ["at", "n"])

    rows = df.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = {r["at"]: r["n"] for r in rows.collect()}  # as many rows as the array has places
    return np.array([out[i] for i in range(len(out))], np.int64)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _products(values: np.ndarray) -> np.ndarray:
    total = np.zeros((64, 64))
    for i in range(0, len(values), 1 << 16):
        x = _bits(np.ascontiguousarray(values[i:i + (1 << 16)])).astype(np.float32)
        total += x.T @ x
    return total.ravel()


def group_bits(products: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m groups of nearly equal size, correlated bits together, greedily."""
    joint = products.reshape(64, 64) / max(n, 1)
    p = np.diag(joint)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((joint - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(64)), []
    for g in range(m):
        size = len(left) // (m - g)
        pool = sorted(left)
        group = [max(pool, key=lambda b: (corr[b, pool].sum(), -b))]
        left.discard(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        groups.append(group)
    return groups


def _blocks(group: list[int]) -> list[list[int]]:
    return [group[i:i + 8] for i in range(0, len(group), 8)]


def _project(values: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for i, b in enumerate(bits):
        out |= ((values >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    return out


class Plan:
    """Partitions with the distributions of distance inside their blocks."""

    def __init__(self, groups: list[list[int]], counts: np.ndarray, n: int, distance: int):
        self.groups, self.n, self.distance = groups, n, distance
        self.blocks = [_blocks(g) for g in groups]
        v = np.arange(256)
        gap = np.bitwise_count((v[:, None] ^ v).astype(np.uint8))
        self.near, at = [], 0
        self.mean = []
        for blocks in self.blocks:
            tables, mean = [], np.ones(1)
            for _ in blocks:
                h = counts[at:at + 256] / max(n, 1)
                at += 256
                table = np.stack([((gap == d) * h).sum(1) for d in range(distance + 1)], 1)
                tables.append(table)
                mean = np.convolve(mean, h @ table)[:distance + 1]
            self.near.append(tables)
            self.mean.append(np.pad(mean, (0, distance + 1 - len(mean))))
        full = np.uint64(0)
        self.masks, self.flips = [], []
        for g in groups:
            self.masks.append(sum((np.uint64(1 << b) for b in g), full))
        self.probes = [np.cumsum([comb(len(g), r) for r in range(distance + 1)]) for g in groups]

    def costs(self, i: int, shares: np.ndarray) -> np.ndarray:
        """Estimated cost of giving partition i 0 to t + 1 units, for rows of distance shares."""
        reach = PROBE * self.probes[i] + self.n * np.cumsum(shares, -1)
        return np.concatenate([np.zeros((*reach.shape[:-1], 1)), reach], -1)

    def shares(self, i: int, values: np.ndarray) -> np.ndarray:
        """Estimated share of all fingerprints at each distance from the value in partition i."""
        t, out = self.distance + 1, None
        for bits, table in zip(self.blocks[i], self.near[i]):
            part = table[_project(values, bits)]
            if out is None:
                out = part
            else:
                out = sum(np.pad(out[:, :t - d] * part[:, d:d + 1], ((0, 0), (d, 0))) for d in range(t))
        return out

    def allocate(self, costs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Units for each partition, of least total cost and t + 1 in sum; and that cost."""
        units = self.distance + 1
        best = np.full((len(costs[0]), units + 1), np.inf)
        best[:, 0] = 0
        choice = []
        for cost in costs:
            options = np.stack([np.pad(best[:, :units + 1 - k], ((0, 0), (k, 0)), constant_values=np.inf)
                                + cost[:, k:k + 1] for k in range(units + 1)], 2)
            choice.append(options.argmin(2))
            best = options.min(2)
        left = np.full(len(best), units)
        out = np.zeros((len(costs), len(best)), np.int64)
        for i in range(len(costs) - 1, -1, -1):
            out[i] = choice[i][np.arange(len(best)), left]
            left = left - out[i]
        return out, best[:, units]

    def mean_cost(self) -> float:
        return float(self.allocate([self.costs(i, m[None]) for i, m in enumerate(self.mean)])[1][0])

    def rings(self, i: int, radius: int) -> np.ndarray:
        """Changes of 1 to `radius` bits in partition i."""
        bits = [np.uint64(1 << b) for b in self.groups[i]]
        return np.array([np.bitwise_or.reduce(np.array(c, np.uint64)) for r in range(1, radius + 1)
                         for c in combinations(bits, r)], np.uint64)


def plan(uniq: DataFrame, distance: int) -> Plan:
    """Fit the grouping and the estimates to all distinct fingerprints."""
    products = _numbers(uniq, lambda v: np.append(_products(v), len(v)))
    products = products if len(products) else np.zeros(4097, np.int64)
    n = int(products[-1])
    grouped = [group_bits(products[:-1], n, m) for m in CHOICES]
    flat = [b for groups in grouped for g in groups for b in _blocks(g)]
    counts = _numbers(uniq, lambda v: np.concatenate(
        [np.bincount(_project(v, b), minlength=256) for b in flat]))
    counts = counts if len(counts) else np.zeros(256 * len(flat), np.int64)
    plans, at = [], 0
    for groups in grouped:
        size = 256 * sum(len(_blocks(g)) for g in groups)
        plans.append(Plan(groups, counts[at:at + size], n, distance))
        at += size
    return min(plans, key=Plan.mean_cost)


# Probing and verifying

def _probe(values: np.ndarray, p: Plan):
    """(part, key, fp) of the home rows and of the probes of a batch."""
    units, _ = p.allocate([p.costs(i, p.shares(i, values)) for i in range(len(p.groups))])
    for i, mask in enumerate(p.masks):
        home = values & mask
        yield i, home, values
        for u in range(2, p.distance + 2):
            rows = np.flatnonzero(units[i] == u)
            if len(rows):
                ring = p.rings(i, u - 1)
                for j in range(0, len(rows), max(1, (1 << 20) // len(ring))):
                    part = rows[j:j + max(1, (1 << 20) // len(ring))]
                    yield i, (home[part, None] ^ ring).ravel(), np.repeat(values[part], len(ring))


def probes(uniq: DataFrame, p: Plan) -> DataFrame:
    def run(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for i, key, fp in _probe(values, p):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), i, np.int32)), pa.array(key.view(np.int64)),
                     pa.array(fp.view(np.int64))], ["part", "key", "fp"])

    return uniq.select("fp").mapInArrow(run, "part int, key long, fp long")


def forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct values, as stars."""
    centre, leaf = [], []
    while len(values) > 1:
        root, values = values[0], values[1:]
        front = [root]
        while front and len(values):
            near = np.bitwise_count(values ^ front.pop()) <= distance
            if near.any():
                found = values[near]
                leaf.append(found)
                centre.append(np.full(len(found), root))
                front.extend(found)
                values = values[~near]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(centre), np.concatenate(leaf)) if centre else (empty, empty)


def _links(group: np.ndarray, fp: np.ndarray, distance: int):
    """Verified links of sorted groups: short runs by shifts over the batch, long ones by forests."""
    first = np.flatnonzero(np.diff(group, prepend=group[0] - 1) != 0)
    size = np.diff(np.append(first, len(group)))
    short = np.repeat(size <= 16, size)
    for s in range(1, min(16, int(size.max()))):
        a = np.flatnonzero((group[:-s] == group[s:]) & short[s:])
        a = a[np.bitwise_count(fp[a] ^ fp[a + s]) <= distance]
        if len(a):
            yield fp[a], fp[a + s]
    for i in np.flatnonzero(size > 16):
        u, v = forest(np.unique(fp[first[i]:first[i] + size[i]]), distance)
        if len(u):
            yield u, v


def links(rows: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) between fingerprints, enough to connect all that are linked."""
    bucket = ["part", "key"]
    large = (rows.groupBy(*bucket).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
             .select(*bucket, F.ceil(F.col("n") / (BLOCK // 2)).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda c: F.least(mine, c) * F.col("blocks").cast("long") + F.greatest(mine, c))
    dealt = rows.join(settle(large, "simhash-large"), bucket, "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))).select(*bucket, F.explode(pairs).alias("pair"), "fp")
    keys = [*bucket, "pair"]
    sorted_ = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        rest = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in (*keys, "fp")]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            new = np.zeros(len(cols[0]), bool)
            for c in cols[:3]:
                new[1:] |= c[1:] != c[:-1]
            last = np.flatnonzero(new)
            cut = last[-1] if len(last) else 0
            rest = [c[cut:] for c in cols]
            if cut:
                yield from out(np.cumsum(new[:cut]), cols[3][:cut])
        if rest is not None and len(rest[0]):
            yield from out(np.zeros(len(rest[0]), np.int64), rest[3])

    def out(group, fp):
        for u, v in _links(group, fp.view(np.uint64), distance):
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return sorted_.mapInArrow(run, "u long, v long")


def linked(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root): for each fingerprint with a smaller one in its component, the least one."""
    uniq = settle(fps.select("fp").distinct(), "simhash-distinct")
    found = links(settle(probes(uniq, plan(uniq, distance)), "simhash-probes"), distance)
    return components(found).select(F.col("u").alias("fp"), F.col("v").alias("root"))


def label_near(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4,
               distance: int = 4) -> DataFrame:
    """Each row's id, fp and component_id, the smallest id in its component."""
    fps = settle(fingerprints(docs, [id_col], text, width), "simhash-fingerprints")
    smallest = fps.groupBy("fp").agg(F.min(id_col).alias("low"))
    rooted = smallest.join(linked(fps, distance), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    rooted = settle(rooted, "simhash-roots")
    names = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4,
             distance: int = 4) -> DataFrame:
    """One row of each component, the smallest id's, all columns as they were.

    A document is known by (id, hash of its text).  Rows whose bit is not set among the documents
    to drop or repeated pass straight through; the others are settled by an anti join.
    """
    marked = docs.withColumn("x2_id", F.col(id_col)).withColumn("x2_hash", F.xxhash64(F.col(text)))
    fps = settle(fingerprints(marked, ["x2_id", "x2_hash"], text, width), "simhash-fingerprints")
    return keep_least(docs.columns, marked, fps, linked(fps, distance))


def keep_least(columns: list[str], marked: DataFrame, fps: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows that stay of `marked`, by the fp of each (x2_id, x2_hash) and the roots of fps."""
    mine = [F.col(f"`{c}`") for c in columns]
    rank = F.struct(F.isnull("x2_id").alias("z"), F.col("x2_id").alias("id"),
                    F.col("x2_hash").alias("h"))
    uniq = fps.groupBy("fp").agg(F.min(rank).alias("low"))
    rooted = settle(uniq.join(roots, "fp", "left")
                    .withColumn("root", F.coalesce("root", "fp")), "simhash-roots")
    first = rooted.groupBy("root").agg(F.min("low").alias("first"))
    stays = rooted.join(first, "root").select("fp", "first")
    out = (fps.groupBy("fp", "x2_id", "x2_hash").agg(F.count("*").alias("n")).join(stays, "fp")
           .select("x2_id", "x2_hash", "n", (rank == F.col("first")).alias("kept"))
           .where("n > 1 OR NOT kept"))
    out = settle(out, "simhash-out")
    key = F.xxhash64("x2_id", "x2_hash")
    flagged = passing(marked, key, settle(bitmaps(out.select(key.alias("key"))), "simhash-bits"), "x2_in")
    alone = flagged.where("NOT x2_in").select(*mine)
    gone = out.where("NOT kept").select(F.col("x2_id").alias("x2_gone"), F.col("x2_hash").alias("x2_at"))
    rivals = flagged.where("x2_in").join(
        gone, F.col("x2_id").eqNullSafe(F.col("x2_gone")) & F.col("x2_hash").eqNullSafe(F.col("x2_at")),
        "left_anti")
    return alone.unionByName(rivals.dropDuplicates(["x2_id", "x2_hash"]).select(*mine))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return label_near(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
