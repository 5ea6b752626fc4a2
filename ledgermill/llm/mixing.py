"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only.

Leaves are (domain, language, source).  A budget of tokens runs down the tree: the children of a
node share its budget by weight, but none gets more than its leaves can give in `max_epochs` epochs.
What a child cannot take goes to its siblings by weight, and only what all of them together cannot
take leaves the node, to the node's own siblings.  That is water filling, level by level from the
root: sorted by capacity over weight, the first k children are full and the others get equal amounts
per weight.  What is left for them per weight rises with every child that is full and falls behind
the last one, so its largest value is the water level.

A leaf's quota is whole epochs and a prefix of one more.  Each epoch has an order of its own, by
hash of seed, epoch, id and text; a document is in the prefix if the tokens up to and including it
fit into the rest of the quota.  Prefix sums run over BINS ranges of the hash per leaf first; only
the one bin where the quota ends is summed row by row.

Defined results: a null category is a category of its own; a null text has no tokens; a weight of 0
gets nothing, without any weight siblings share equally; repeated rows have equal places in the
order and are taken one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.llm.common import WORD, settle

#: Ranges of the hash in which tokens are summed before any row is looked at.
BINS = 4096
LEVELS = ("domain", "language", "source")
_HEX = 13  # hex digits of a digest that make an exact number


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weight_of(column: str, weights: Mapping[str, float], other: float) -> Column:
    """The weight of a category's value; `other` where none is given."""
    out = F.lit(float(other))
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(float(w))).otherwise(out)
    return out


def _fill(children: DataFrame, parent: list[str]) -> DataFrame:
    """Add `quota`: water filling of `budget` among the rows of a parent by weight up to capacity.

    One row for each node of the tree, so windows by parent are as small as the tree.
    """
    every = W.partitionBy(*parent)
    share = F.when(F.sum("weight").over(every) > 0, F.col("weight")).otherwise(F.lit(1.0))
    rows = children.withColumn("w", share).withColumn(
        "full_at", F.when(F.col("w") > 0, F.col("capacity") / F.col("w")).otherwise(F.lit(float("inf"))))
    order = every.orderBy("full_at", *LEVELS[:len(parent) + 1])
    upto, later = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    rows = rows.withColumn("rest", F.col("budget") - F.coalesce(F.sum("capacity").over(upto), F.lit(0.0)))
    rows = rows.withColumn("per", F.try_divide(
        F.greatest(F.col("rest"), F.lit(0.0)), F.sum("w").over(later)))
    open_ = (F.col("w") > 0) & (F.col("per") < F.col("full_at"))
    rows = rows.withColumn("level", F.max(F.when(open_, F.col("per"))).over(every))
    return rows.withColumn("quota", F.when(F.col("w") <= 0, F.lit(0.0)).otherwise(F.least(
        F.col("capacity"), F.coalesce(F.col("level") * F.col("w"), F.col("capacity"))))).drop(
            "w", "full_at", "rest", "per", "level")


def quotas(leaves: DataFrame, weights: Mapping[str, Mapping[str, float]], budget: Column,
           max_epochs: int, other: float = 1.0) -> DataFrame:
    """The leaves (domain, language, source, tokens) with quota, epochs and prefix."""
    parent, above = [], None
    nodes = leaves.withColumn("capacity", F.col("tokens") * F.lit(float(max_epochs)))
    for depth, level in enumerate(LEVELS):
        names = list(LEVELS[:depth + 1])
        part = nodes.groupBy(*names).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        part = part.withColumn("weight", weight_of(level, weights.get(level, {}), other))
        if above is None:
            every = W.partitionBy(F.lit(1))  # the domains, one row each
            part = part.withColumn("budget", F.sum("tokens").over(every) * budget)
        else:
            part = part.join(above.withColumnRenamed("quota", "budget"), parent)
        filled = _fill(part, parent)
        above, parent = filled.select(*names, "quota"), names
    # settled so that a rounding in a plan that runs again cannot move a quota
    out = filled.withColumn("quota", F.floor(F.col("quota") + 1e-6))
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(F.lit(0))
    return settle(out.select(*LEVELS, "tokens", "quota", epochs.cast("long").alias("epochs"))
                  .withColumn("prefix", F.col("quota") - F.col("epochs") * F.col("tokens")), "mix-quotas")


def _place(seed: str, epoch: Column) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(
        F.col("mix_id").cast("string"), F.lit("")), F.col("mix_hash")))
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("long")


def _keys(domain: Column, id_col: str, text: str, language: str, source: str) -> list[Column]:
    return [F.col(id_col).alias("mix_id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("mix_hash"),
            *(F.coalesce(c, F.lit("(none)")).alias(n) for n, c in zip(
                LEVELS, (domain, F.col(language), F.col(source))))]


def _ends(rows: DataFrame, weights, budget: float, max_epochs: int, seed: str) -> DataFrame:
    """For each leaf its quota, whole epochs, prefix, the bin where that ends and the tokens before."""
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    quota = quotas(leaves, weights, F.lit(float(budget)), max_epochs).drop("tokens")
    placed = _placed(rows.join(quota, list(LEVELS)), seed)
    bins = placed.groupBy(*LEVELS, "bin").agg(
        F.sum("tokens").alias("in_bin"), F.first("prefix").alias("prefix"))
    before = W.partitionBy(*LEVELS).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("in_bin").over(before), F.lit(0)))
    last = bins.where("before + in_bin > prefix").groupBy(*LEVELS).agg(
        F.min("bin").alias("end"), F.min_by("before", "bin").alias("before"))
    return settle(quota.join(last, list(LEVELS), "left"), "mix-ends")


def _placed(rows: DataFrame, seed: str) -> DataFrame:
    return rows.withColumn("place", _place(seed, F.col("epochs") + 1)).withColumn(
        "bin", F.floor(F.col("place") / ((1 << (4 * _HEX)) // BINS)))


def _decided(rows: DataFrame, ends: DataFrame, seed: str) -> DataFrame:
    """Add place and `copies`, null for the rows in the bin where their leaf's prefix ends."""
    known = F.when(F.col("end").isNull() | (F.col("bin") < F.col("end")), F.col("epochs") + 1).when(
        F.col("bin") > F.col("end"), F.col("epochs"))
    return _placed(rows.join(ends, list(LEVELS)), seed).withColumn("copies", known.cast("long"))


def _at_edge(decided: DataFrame) -> DataFrame:
    """The rows in the last bins, summed one by one."""
    order = W.partitionBy(*LEVELS).orderBy("place", "mix_hash", "mix_id").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    fits = F.col("before") + F.sum("tokens").over(order) <= F.col("prefix")
    return decided.where("copies IS NULL").withColumn("copies", F.col("epochs") + fits.cast("long"))


def plan(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]],
         budget: float, max_epochs: int, seed: str, id_col: str = "doc_id", text: str = "text",
         language: str = "lang", source: str = "source") -> DataFrame:
    """Narrow rows: mix_id, mix_hash, the leaf, tokens, the leaf's quota, and copies of the row."""
    rows = settle(docs.select(*_keys(domain, id_col, text, language, source),
                              n_words(F.col(text)).alias("tokens")), "mix-tokens")
    decided = _decided(rows, _ends(rows, weights, budget, max_epochs, seed), seed)
    return decided.where("copies IS NOT NULL").unionByName(_at_edge(decided)).select(
        "mix_id", "mix_hash", *LEVELS, "tokens", "quota", "copies")


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]], budget: float,
        max_epochs: int, seed: str, id_col: str = "doc_id", text: str = "text",
        language: str = "lang", source: str = "source") -> DataFrame:
    """The selected rows, all columns as they were, as many times as epochs take them.

    Outside the last bins a row's copies follow from its own hash and its leaf's figures, so texts
    are not shuffled for them; the leaves' table is broadcast only where it is small.
    """
    keys = _keys(domain, id_col, text, language, source)
    rows = settle(docs.select(*keys, n_words(F.col(text)).alias("tokens")), "mix-tokens")
    ends = _ends(rows, weights, budget, max_epochs, seed)
    edge = _at_edge(_decided(rows, ends, seed)).groupBy("mix_id", "mix_hash", *LEVELS).agg(
        F.sum("copies").alias("e_copies"), F.count("*").alias("e_rows"))
    edge = settle(edge.select(F.col("mix_id").alias("e_id"), F.col("mix_hash").alias("e_hash"),
                              *[F.col(n).alias(f"e_{n}") for n in LEVELS], "e_copies", "e_rows"), "mix-edge")
    names = docs.columns
    full = docs.select(*[F.col(f"`{c}`").alias(f"mix_{i}") for i, c in enumerate(names)], *keys)
    decided = _decided(full, ends, seed)
    on = F.col("mix_id").eqNullSafe(F.col("e_id")) & (F.col("mix_hash") == F.col("e_hash"))
    for n in LEVELS:
        on = on & (F.col(n) == F.col(f"e_{n}"))
    # equal rows share their copies: each gets the whole part, the first ones one more
    turn = F.row_number().over(W.partitionBy("mix_hash", "mix_id", *LEVELS).orderBy("place"))
    last = decided.where("copies IS NULL").join(edge, on).withColumn("turn", turn).withColumn(
        "copies", F.floor(F.col("e_copies") / F.col("e_rows"))
        + (F.col("turn") <= F.col("e_copies") % F.col("e_rows")).cast("long"))
    kept = [f"mix_{i}" for i in range(len(names))]
    chosen = decided.where("copies > 0").select(*kept, "copies").unionByName(
        last.where("copies > 0").select(*kept, "copies"))
    return chosen.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[F.col(k).alias(c) for k, c in zip(kept, names)])


#: Parameters of the query and of the pipeline: domains are made of the sources' numbers.
SEED = "ledgermill"
BUDGET, MAX_EPOCHS = 0.8, 2
WEIGHTS = {
    "domain": {"web": 0.5, "books": 0.3, "code": 0.2},
    "language": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
}


def domain_of(source: str = "source") -> Column:
    number = F.regexp_extract(F.col(source), r"([0-9]+)$", 1).try_cast("long") % 5
    return (F.when(number.isNull(), "other").when(number < 3, "web").when(number == 3, "books")
            .otherwise("code"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every document with its leaf, tokens, the leaf's quota and how often it is taken."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = plan(docs, domain_of(), WEIGHTS, BUDGET, MAX_EPOCHS, SEED)
    return rows.select(F.col("mix_id").alias("doc_id"), *LEVELS, "tokens", "quota", "copies")


def _oracle() -> str:
    case = {level: "CASE " + level + "".join(
        f" WHEN '{k}' THEN {float(w)}" for k, w in WEIGHTS.get(level, {}).items()) + " ELSE 1.0 END"
        if WEIGHTS.get(level) else "1.0" for level in LEVELS}
    steps = []
    for depth, level in enumerate(LEVELS):
        names = ", ".join(LEVELS[:depth + 1])
        parent = ", ".join(LEVELS[:depth]) or "1"
        above = (f"(SELECT {BUDGET} * sum(tokens) AS budget FROM leaves) a ON true" if not depth else
                 f"q{depth - 1} a USING ({parent})")
        budget = "a.budget" if not depth else "a.quota"
        steps.append(f"""
c{depth} AS (SELECT {names}, {budget} AS budget, n.capacity, {case[level]} AS weight FROM (
    SELECT {names}, sum(tokens) * {float(MAX_EPOCHS)} AS capacity FROM leaves GROUP BY {names}) n
  JOIN {above}),
w{depth} AS (SELECT *, CASE WHEN sum(weight) OVER (PARTITION BY {parent}) > 0 THEN weight ELSE 1.0 END AS w FROM c{depth}),
f{depth} AS (SELECT *, CASE WHEN w > 0 THEN capacity / w ELSE 'infinity'::DOUBLE END AS full_at FROM w{depth}),
p{depth} AS (SELECT *, greatest(budget - coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY full_at, {names}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
    / nullif(sum(w) OVER (PARTITION BY {parent} ORDER BY full_at, {names}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS per FROM f{depth}),
l{depth} AS (SELECT *, max(CASE WHEN w > 0 AND per < full_at THEN per END) OVER (PARTITION BY {parent}) AS level FROM p{depth}),
q{depth} AS (SELECT {names}, CASE WHEN w <= 0 THEN 0.0 ELSE least(capacity, coalesce(level * w, capacity)) END AS quota
  FROM l{depth})""")
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS language, coalesce(source, '(none)') AS source,
         TRY_CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT) % 5 AS number,
         md5(coalesce(text, '')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens
  FROM documents),
rows_ AS (SELECT *, CASE WHEN number IS NULL THEN 'other' WHEN number < 3 THEN 'web' WHEN number = 3 THEN 'books' ELSE 'code' END AS domain FROM d),
leaves AS (SELECT domain, language, source, sum(tokens) AS tokens FROM rows_ GROUP BY ALL),{",".join(steps)},
z AS (SELECT domain, language, source, tokens AS total, floor(quota + 1e-6)::BIGINT AS quota FROM leaves
  JOIN q2 USING (domain, language, source)),
e AS (SELECT *, CASE WHEN total > 0 THEN quota // total ELSE 0 END AS epochs FROM z),
placed AS (SELECT r.*, e.quota, e.epochs, e.quota - e.epochs * e.total AS prefix,
    ('0x' || md5('{SEED}|' || (e.epochs + 1)::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '') || '|' || h)[1:{_HEX}])::BIGINT AS place
  FROM rows_ r JOIN e USING (domain, language, source))
SELECT doc_id, domain, language, source, tokens::BIGINT AS tokens, quota,
  (epochs + CASE WHEN sum(tokens) OVER (PARTITION BY domain, language, source ORDER BY place, h, doc_id
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= prefix THEN 1 ELSE 0 END)::BIGINT AS copies
FROM placed
"""


ORACLE = _oracle()
