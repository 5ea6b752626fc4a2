"""Agreement of the class read off a filing with the register's category as of the filing date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The register's accounts categories by size.
CATEGORY_SIZES = {
    "MICRO ENTITY": "small", "SMALL": "small", "TOTAL EXEMPTION SMALL": "small", "TOTAL EXEMPTION FULL": "small",
    "UNAUDITED ABRIDGED": "small", "AUDITED ABRIDGED": "small", "DORMANT": "small",
    "MEDIUM": "medium", "FULL": "large", "GROUP": "large", "LARGE": "large",
}


def category_size(category: Column) -> Column:
    """Size of a register category; null where the category does not tell one."""
    found = F.lit(None).cast("string")
    for name, size in CATEGORY_SIZES.items():
        found = F.when(F.upper(F.trim(category)) == name, size).otherwise(found)
    return found


def as_of(events: DataFrame, history: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Events with the ``value`` that was valid at ``at``: the last one of the key on that day or before.

    ``history(key, valid_from, value)``.  Both sides meet in one window over the key's dates, so no
    pair is formed that is not wanted; events without an earlier entry get null.
    """
    columns = [c for c in events.columns if c != value]
    row = F.struct(*[F.col(c) for c in columns])
    both = events.select(F.col(key).alias("_k"), F.col(at).cast("date").alias("_at"), F.lit(1).alias("_side"),
                         F.lit(None).cast(history.schema[value].dataType).alias("_v"), row.alias("_e")).unionByName(
        history.select(F.col(key).alias("_k"), F.col("valid_from").cast("date").alias("_at"), F.lit(0).alias("_side"),
                       F.col(value).alias("_v")), allowMissingColumns=True)
    upto = W.partitionBy("_k").orderBy("_at", "_side", "_v").rowsBetween(W.unboundedPreceding, 0)
    # an entry without a value ends the one before it, so entries travel as structs
    last = F.last(F.when(F.col("_side") == 0, F.struct("_v")), ignorenulls=True).over(upto)
    return both.withColumn("_last", last).where("_side = 1 AND _at IS NOT NULL").select("_e.*", F.col("_last._v").alias(value))


def matrix(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, n, share of the left class) of all pairs with both classes known."""
    counts = pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(left, right).agg(
        F.count("*").alias("n"))
    # as many rows as pairs of classes
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(left)))


def kappa(counts: DataFrame, left: str, right: str) -> DataFrame:
    """(n, agreed, expected, kappa): observed agreement, that by chance, and what is left above chance."""
    zero, n = F.lit(0).cast("long"), F.col("n")
    ends = F.explode(F.array(
        F.struct(F.col(left).alias("c"), n.alias("a"), zero.alias("b"), F.when(F.col(left) == F.col(right), n).otherwise(0).alias("s")),
        F.struct(F.col(right).alias("c"), zero.alias("a"), n.alias("b"), zero.alias("s"))))
    margins = counts.select(ends.alias("e")).groupBy("e.c").agg(*[F.sum(f"e.{k}").alias(k) for k in "abs"])
    total = margins.agg(F.sum("a").alias("n"), F.sum("s").alias("same"), F.sum(F.col("a").cast("double") * F.col("b")).alias("both"))
    agreed, expected = F.col("same") / F.col("n"), F.col("both") / (F.col("n").cast("double") * F.col("n"))
    return total.where("n > 0").select("n", agreed.alias("agreed"), expected.alias("expected"),
                                       F.try_divide(agreed - expected, 1 - expected).alias("kappa"))


def verdicts(filings: DataFrame, dated: DataFrame, history: DataFrame) -> DataFrame:
    """Per filing: slots by status, whether they are complete, both sizes and whether they agree.

    ``filings(filing_id, reason, size, mode, slots)`` of ``sections.filings_of``, which carries class and slots
    in one row, so that documents are read once; ``dated(filing_id, company_number, filing_date)``;
    ``history(company_number, valid_from, category)``.  Slots are counted over all documents of a filing.
    A class ``unknown`` has no small or medium flag and stands for large.  ``core_found`` says whether a
    full filing of a large company has its strategic, directors' and auditor's reports; null for others.
    """
    def core(s: Column) -> Column:
        return (s["status"] == "found") & s["section_id"].isin("strategic_report", "directors_report", "auditor_report")

    def of(name: str):
        return lambda s: s["status"] == name

    tests = {**{s: of(s) for s in ("found", "not_present", "not_found")}, "_core": core}
    size = F.when(F.col("size") == "unknown", "large").otherwise(F.col("size"))
    counted = filings.where("filing_id IS NOT NULL").select(
        "filing_id", "reason", size.alias("filing_size"), "mode",
        *[F.size(F.filter("slots", test)).cast("long").alias(n) for n, test in tests.items()])
    every = W.partitionBy("filing_id")
    classed = counted.withColumns({n: F.sum(n).over(every) for n in tests}).where("reason IS NULL")
    registered = as_of(dated, history, "company_number", "filing_date", "category")
    rows = classed.join(registered.select(
        "filing_id", category_size(F.col("category")).alias("register_size")), "filing_id", "left")
    return rows.select(
        "filing_id", "found", "not_present", "not_found",
        (F.col("found") + F.col("not_present") + F.col("not_found") == 12).alias("complete"),
        "filing_size", "register_size", (F.col("filing_size") == F.col("register_size")).alias("agrees"),
        F.when((F.col("filing_size") == "large") & (F.col("mode") == "full"), F.col("_core") == 3).alias("core_found"))
