"""Quality rules: a decision list learned from labelled statistics, behind fixed base rules.

Statistics of whole texts are computed once.  Sequential covering learns when to drop: a rule is
grown condition by condition, each the threshold of most information gain over candidate thresholds
from all values, until it covers no good row; then last conditions are taken off while the share of
bad rows among the covered falls neither on rows held back from growing nor on all.  A rule that is
right too seldom ends the list; else the rows it covers go and the next is grown.
The list is ordered and readable, and becomes one Spark conditional expression.

Only rows that pass the base rules are learned from, and of these a bounded sample: of each label the SAMPLE labelled rows with the smallest hash of
their id.  Everything else covers all rows.

Defined results: a null or empty text has no words, statistics 0, and fails the base rules; without
labelled rows the list is empty and keeps whatever passes the base rules; rows with a null id or
label are not learned from; rows of one id and label are learned from as one; repeated rows are judged each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import settle, share, slices

#: Labelled rows of each class that the list is learned from, on average at most.
SAMPLE = 10_000
#: Words of a window whose repeats count.
WINDOW = 8
#: Conditions of a rule, rules of a list, candidate thresholds of a statistic.
CONDITIONS, RULES, THRESHOLDS = 4, 12, 64
#: Share of bad rows among those a rule covers, and their least number, on rows held back.
PRECISION, COVERED = 0.995, 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_distinct_words", "n_upper", "n_digits", "n_marks")
_SPACES = b" \t\n\x0b\f\r"
_SETS = {"n_symbols": b"#*$%&|<>", "n_upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "n_digits": b"0123456789",
         "n_marks": b"!?"}
_ODD = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of WINDOW words that occur twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD
    h = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        h = (h + mixed[i:i + n]) * _ODD
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():  # equal windows have equal hashes
        return 0
    rank = ids
    for step in (1, 2, 4):  # exact: ranks of windows of 2, 4 and 8 words
        pairs = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The COUNTS of a text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
    size = {k: len(raw) - len(raw.translate(None, v)) for k, v in _SETS.items()}
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    return (len(words), len(text) - spaces, size["n_symbols"], len(lines) - len(set(lines)),
            repeated_words(ids), len(lines), len(code), size["n_upper"], size["n_digits"], size["n_marks"])


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) and the COUNTS of the whole text."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches):
        for batch in batches:
            column, rest = batch.column("x5_text"), batch.select(kept)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                rows = np.array([measure(t) for t in column.slice(a, b - a).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(a, b - a).columns, *(pa.array(np.ascontiguousarray(c)) for c in rows.T)],
                    [*kept, *COUNTS])

    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("x5_text"))
    return source.mapInArrow(run, schema)


def features() -> dict[str, Column]:
    """Statistics that conditions test, from COUNTS; 0 where a text has no words or lines."""
    def per(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {"words": F.col("n_words").cast("double"), "word_length": per("word_chars", "n_words"),
            "symbols": per("n_symbols", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"),
            "repeats": per("n_repeat_words", "n_words"), "distinct": per("n_distinct_words", "n_words"),
            "upper": per("n_upper", "word_chars"), "digits": per("n_digits", "word_chars"),
            "marks": per("n_marks", "n_words"), "line_words": per("n_words", "n_lines")}


# Learning

@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def rows(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


def covered(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.rows(x)
    return out


def grow(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        before = math.log2(p / (p + n)) if p else 0.0
        best, choice = 1e-9, None
        for name in sorted(x):
            values = np.unique(x[name][inside])
            middle = (values[1:] + values[:-1]) / 2
            if len(middle) > THRESHOLDS:
                middle = middle[np.linspace(0, len(middle) - 1, THRESHOLDS).astype(int)]
            for t in middle:
                for above in (True, False):
                    c = Condition(name, above, float(t))
                    rows = inside & c.rows(x)
                    p1, n1 = (rows & bad).sum(), (rows & ~bad).sum()
                    gain = p1 * (math.log2(p1 / (p1 + n1)) - before) if p1 else 0.0
                    if gain > best:
                        best, choice = gain, c
        if choice is None:
            break
        rule.append(choice)
        inside &= choice.rows(x)
    return rule


def prune(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray,
          part: np.ndarray) -> tuple[list[Condition], float, int]:
    """The shortest beginning of the rule that covers no smaller share of bad rows than the whole rule.

    The share counts on the rows held back from growing and on all rows.  Returns the smaller of the
    two, and the rows held back that are covered.
    """
    def shares(size: int) -> tuple[float, float, int]:
        rows = covered(rule[:size], x, len(bad))
        held = rows & ~part
        return (float(bad[held].mean()) if held.any() else 0.0,
                float(bad[rows].mean()) if rows.any() else 0.0, int(held.sum()))

    whole = shares(len(rule))
    for size in range(1, len(rule) + 1):
        some = shares(size)
        if some[0] >= whole[0] and some[1] >= whole[1]:
            return rule[:size], min(some[:2]), some[2]
    return rule, min(whole[:2]), whole[2]


def learn(x: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray) -> list[list[Condition]]:
    """An ordered list of rules to drop; `part` is true for the rows to grow on."""
    out: list[list[Condition]] = []
    left = np.ones(len(bad), bool)
    while len(out) < RULES and (left & part & bad).any():
        a = left & part
        rule = grow({k: v[a] for k, v in x.items()}, bad[a])
        if not rule:
            break
        rule, share, n = prune(rule, {k: v[left] for k, v in x.items()}, bad[left], part[left])
        if share < PRECISION or n < COVERED:
            break
        out.append(rule)
        left &= ~covered(rule, x, len(bad))
    return out


def train(measured_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          label: str = "quality") -> list[list[Condition]]:
    """Learn from rows whose label is 0 (bad) or another number (good)."""
    marks = labels.select(F.col(id_col).alias("x5_id"), (F.col(label) == 0).alias("bad"))
    marks = marks.where("x5_id IS NOT NULL AND bad IS NOT NULL").withColumn(
        "key", F.xxhash64(F.col("x5_id")))
    chosen = F.lit(False)
    for r in marks.groupBy("bad").count().collect():  # two rows at most
        chosen = chosen | ((F.col("bad") == r["bad"]) & (share(F.col("key")) < SAMPLE / r["count"]))
    chosen = marks.where(chosen).distinct()
    names = list(features())
    rows = (measured_docs.where(~base_failed()).join(chosen, F.col(id_col) == F.col("x5_id"))
            .select("key", "bad", *[c.alias(n) for n, c in features().items()])
            .groupBy("key", "bad").agg(*[F.max(n).alias(n) for n in names])
            .orderBy("key", "bad").collect())
    if not rows:
        return []
    x = {n: np.array([r[n] for r in rows]) for n in names}
    part = np.array([r["key"] % 3 != 0 for r in rows])
    return learn(x, np.array([r["bad"] for r in rows]), part)


def expression(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that fits, null if none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        fits = F.lit(True)
        for c in rules[i]:
            fits = fits & c.column()
        out = F.when(fits, F.lit(i + 1)).otherwise(out)
    return out


def base_failed() -> Column:
    """The fixed rules: too few words, or too many in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(measured_docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """Add base_failed, rule (the first of the list that fits) and kept."""
    return (measured_docs.withColumn("base_failed", base_failed()).withColumn("rule", expression(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: statistics and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = settle(measured(docs, keep=["doc_id"]), "quality-counts")
    rules = train(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(rows, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept", "rule")
