"""Ranked lexical search: the best documents of each query by best-first intervals over range maxima.

Queries are read in blocks of BLOCK terms.  For each block one pass over the documents keeps the
postings of the block's terms, a second one counts how many documents hold each term, and a third
one searches.  There the documents of a segment are numbered, and a term's postings carry their
impact, the addend of the score.  A sparse table over the postings answers range-maximum queries, so
the sum of a query's range maxima bounds every document of an interval.  Intervals are taken by
falling bound: one is split at the document with the largest impact in it, which is scored, and its
two sides get bounds of their own; one of at most LEAF documents is scored in whole.  A search ends
where no bound reaches the score of the worst kept document.  That score is carried on from segment
to segment of a task, and each task returns the best rows of all its segments.

Segments are bounded by their postings, blocks by their terms, so a worker's memory does not grow
with the table.  All figures are 64-bit integers but for the logarithm in a term's weight.

Defined results: a null text and one without a term has no score and does not count; query rows of
one id are one query with the terms of all of them, a null id is an id; every document row is ranked
by itself, also where rows repeat; equal scores go by ascending id, nulls last; an empty table gives
an empty result.  Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.llm.common import lower_ascii, settle, slices

#: A term: a run of ASCII letters and digits and of all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same rule for bytes of UTF-8: A-Z to lower case, every separator to a blank.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))

#: Terms of the queries that are searched together, and postings of a segment (about).
BLOCK, POSTINGS = 1 << 19, 1 << 18
#: Documents of an interval that is scored in whole, and intervals that are taken in one step.
LEAF, STEP = 96, 64


def blocks(items: DataFrame, id_col: str, text: str) -> Iterator[list[tuple]]:
    """(id, its distinct terms) of all queries that have a term, in lists of about BLOCK terms.

    The driver reads the queries partition by partition and holds one list at a time.
    """
    found = F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(TERM), F.lit(0))
    rows = (items.select(F.col(id_col).alias("id"), F.explode(found).alias("term"))
            .groupBy("id").agg(F.sort_array(F.collect_set("term")).alias("terms")))
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row.id, row.terms))
        size += len(row.terms)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def postings(docs: DataFrame, id_col: str, text: str, vocabulary) -> DataFrame:
    """One row for each document with a term: id, n (its terms), and those in `vocabulary` with their counts."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        number = vocabulary.value.get
        total = max(len(vocabulary.value), 1)
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            for a, b in slices(pc.fill_null(pc.binary_length(column), 0).to_numpy()):
                ns, keys = [], []
                for i, t in enumerate(column.slice(a, b - a).to_pylist()):
                    words = (t or b"").translate(_BYTES).split()
                    ns.append(len(words))
                    ids = np.fromiter(map(number, words, repeat(-1)), np.int64, len(words))
                    keys.append(ids[ids >= 0] + i * total)
                key, tf = np.unique(np.concatenate(keys), return_counts=True)
                ends = np.searchsorted(key, np.arange(b - a + 1) * total).astype(np.int32)
                made = [pa.array(ns, pa.int64()),
                        pa.ListArray.from_arrays(ends, (key % total).astype(np.int32)),
                        pa.ListArray.from_arrays(ends, tf.astype(np.int64))]
                out = pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), *made],
                                                 ["id", "n", "terms", "tf"])
                yield out.filter(pc.greater(out.column("n"), 0))

    return source.mapInArrow(run, f"id {kind}, n long, terms array<int>, tf array<long>")


def frequencies(found: DataFrame, terms: int) -> np.ndarray:
    """For each of the block's terms the number of documents that hold it."""
    def run(batches):
        for batch in batches:
            n = np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["term", "n"])

    out = np.zeros(terms, np.int64)
    counted = found.select("terms").mapInArrow(run, "term int, n long")
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.term] = row.n
    return out


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Segment:
    """Postings of some documents with range maxima; documents are numbered 0 to size - 1."""

    def __init__(self, n, ends, terms, tf, weights, documents, length):
        self.size = len(n)
        m = 50 + (50 * n * documents) // length
        doc = np.repeat(np.arange(self.size), np.diff(ends))
        impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        keys = terms.astype(np.int64) * self.size + doc
        order = np.argsort(keys, kind="stable")
        order = order[impact[order] > 0]
        self.keys, self.impact, self.doc = keys[order], impact[order], doc[order]
        longest = np.bincount(self.keys // self.size).max() if len(order) else 1
        self.table = [np.arange(len(order), dtype=np.int32)]
        for j in range(int(longest).bit_length() - 1):
            low = self.table[-1]
            high = np.concatenate([low[1 << j:], low[len(low) - min(1 << j, len(low)):]])
            self.table.append(np.where(self.impact[high] > self.impact[low], high, low))
        self.table = np.stack(self.table)

    def at(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """[docs, terms]: the first posting of a term at a document or behind it."""
        return np.searchsorted(self.keys, (terms[None, :] * self.size + docs[:, None]).ravel()).reshape(
            len(docs), len(terms))

    def bounds(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of posting ranges: the sum of their maxima, and the document of the largest."""
        some = end > first
        level = np.maximum(np.frexp(end - first)[1] - 1, 0)
        width = np.left_shift(1, level)
        a = self.table[level, np.where(some, first, 0)]
        b = self.table[level, np.where(some, end - width, 0)]
        best = np.where(self.impact[b] > self.impact[a], b, a)
        value = np.where(some, self.impact[best], 0)
        top = value.argmax(1)
        return value.sum(1), self.doc[best[np.arange(len(best)), top]]

    def scores(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents in the posting ranges, and the sums of their impacts there."""
        size = (end - first).ravel()
        offset = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(first.ravel() - offset, size)
        total = np.zeros(self.size, np.int64)
        np.add.at(total, self.doc[at], self.impact[at])
        docs = np.flatnonzero(total)
        return docs, total[docs]

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Offer to `best` all documents that can be among its rows."""
        if not len(self.keys):
            return
        terms = terms[np.searchsorted(self.keys, terms * self.size)
                      < np.searchsorted(self.keys, (terms + 1) * self.size)]
        if not len(terms):
            return
        step = max(1, min(STEP, (1 << 16) // len(terms)))
        low, high = np.array([0]), np.array([self.size])
        bound, split = self.bounds(self.at(terms, low), self.at(terms, high))
        while True:
            alive = bound >= max(best.floor, 1)
            low, high, bound, split = low[alive], high[alive], bound[alive], split[alive]
            if not len(bound):
                return
            order = np.argsort(-bound, kind="stable")
            now, later = order[:step], order[step:]
            small = now[high[now] - low[now] <= LEAF]
            if len(small):
                best.offer(self, *self.scores(self.at(terms, low[small]), self.at(terms, high[small])))
            wide = now[high[now] - low[now] > LEAF]
            kept = [low[later]], [high[later]], [bound[later]], [split[later]]
            if len(wide):
                a, d, b = low[wide], split[wide], high[wide]
                start, here, end = self.at(terms, a), self.at(terms, d), self.at(terms, b)
                after = self.at(terms, d + 1)
                hit = after > here
                best.offer(self, d, np.where(hit, self.impact[np.minimum(here, len(self.keys) - 1)], 0).sum(1))
                for lo, hi, x, y in ((a, d, start, here), (d + 1, b, after, end)):
                    value, at = self.bounds(x, y)
                    for part, new in zip(kept, (lo, hi, value, at)):
                        part.append(new)
            low, high, bound, split = (np.concatenate(p) for p in kept)


class Best:
    """The k best documents of one query so far: highest score, then least rank of the id."""

    def __init__(self, k: int):
        self.k, self.floor = k, 0
        self.score, self.null, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def offer(self, segment, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= max(self.floor, 1)
        if not good.any():
            return
        score = np.concatenate([self.score, scores[good]])
        null = np.concatenate([self.null, segment.null[docs[good]]])
        ids = np.concatenate([self.id, segment.ids[docs[good]]])
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.null, self.id = score[order], null[order], ids[order]
        if len(order) == self.k:
            self.floor = int(self.score[-1])


def ranked(found: DataFrame, plan, k: int) -> DataFrame:
    """(item, id, score): the k best documents of each query of the block, for each task."""
    def run(batches):
        weights, documents, length, starts, flat = plan.value
        best = [Best(k) for _ in range(len(starts) - 1)]
        for batch in batches:
            lists = batch.column("terms")
            sizes = pc.list_value_length(lists).to_numpy()
            for a, b in slices(sizes, POSTINGS):
                ids = batch.column("id").slice(a, b - a)
                segment = Segment(
                    batch.column("n").slice(a, b - a).to_numpy(),
                    np.concatenate([[0], np.cumsum(sizes[a:b])]), lists.slice(a, b - a).flatten().to_numpy(),
                    batch.column("tf").slice(a, b - a).flatten().to_numpy(), weights, documents, length)
                segment.null = ids.is_null().to_numpy(zero_copy_only=False)
                segment.ids = pc.fill_null(ids, 0).to_numpy()
                for i, mine in enumerate(best):
                    segment.search(flat[starts[i]:starts[i + 1]], mine)
        for i, mine in enumerate(best):
            if len(mine.id):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine.id), i, np.int32)), pa.array(mine.id, pa.int64(), mask=mine.null),
                     pa.array(mine.score)], ["item", "id", "score"])

    return found.mapInArrow(run, "item int, id long, score long")


def _block(docs: DataFrame, block: list[tuple], kind, id_col: str, text: str, k: int) -> DataFrame:
    """(item_id, id, score) of the best documents of a block's queries, settled."""
    spark = docs.sparkSession
    terms = sorted({t for _, of_item in block for t in of_item})
    number = {t: i for i, t in enumerate(terms)}
    vocabulary = spark.sparkContext.broadcast({t.encode(): i for t, i in number.items()})
    found = settle(postings(docs, id_col, text, vocabulary), "lexical-postings")
    documents, length = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = frequencies(found, len(terms))
    weights = np.array([weight(int(n), documents) if n else 0 for n in df], np.int64)
    flat = [np.array([number[t] for t in of_item if weights[number[t]] > 0], np.int64) for _, of_item in block]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in flat])])
    plan = spark.sparkContext.broadcast((weights, documents, length, starts, np.concatenate(flat)))
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"item int, item_id {kind}")
    best = ranked(found, plan, k).join(names, "item").select("item_id", "id", "score")
    return settle(best, "lexical-best")


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the k documents with the highest scores above 0 of each query."""
    kind = items.schema[item_id].dataType.simpleString()
    best = docs.sparkSession.createDataFrame([], f"item_id {kind}, id long, score long")
    for block in blocks(items, item_id, item_text):
        best = best.unionByName(_block(docs, block, kind, id_col, text, k))
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", F.col("id").alias("doc_id"), "score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the 50 best documents of each benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                  spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
g AS (SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS terms FROM d WHERE len(t) > 0),
p AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM p, g GROUP BY term, docs),
s AS (
  SELECT item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(t) * docs) // terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (r), g GROUP BY item_id, r),
o AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, doc_id, score
  FROM s JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 50
"""
