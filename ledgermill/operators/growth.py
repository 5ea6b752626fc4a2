"""Growth over statement years.

All windows run over (company, year) rows that are already aggregated, so a window holds
one row per reporting year of one company, however many facts the company has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.functions.numbers import safe_div


def _by_year():
    return W.partitionBy("company_number").orderBy("year")


def with_current_year(rows: DataFrame) -> DataFrame:
    """Add the last statement year of the company."""
    return rows.withColumn("current_year",
                           F.max("year").over(W.partitionBy("company_number")))


def current_rows(rows: DataFrame) -> DataFrame:
    """The row of each company's current year, found by aggregation without a sort."""
    cols = [c for c in rows.columns if c != "company_number"]
    return rows.groupBy("company_number").agg(
        F.max_by(F.struct(*cols), "year").alias("r")).select("company_number", "r.*")


def yoy(current: Column, prior: Column) -> Column:
    return safe_div(current - prior, F.abs(prior))


def with_yoy(rows: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Growth against the previous statement year, even across a gap in years."""
    return rows.withColumns({
        out: yoy(F.col(m), F.lag(m).over(_by_year())) for m, out in metrics.items()})


def _base(value: str, years_back: int) -> Column:
    """Latest (year, value) at or before year - years_back with a positive value."""
    frame = _by_year().rangeBetween(W.unboundedPreceding, -years_back)
    return F.max(F.when(F.col(value) > 0, F.struct("year", F.col(value).alias("v")))).over(frame)


def with_as_of(rows: DataFrame, value: str, years_back: int) -> DataFrame:
    """Add base_year and base_value of the as-of lookup."""
    return rows.withColumn("_b", _base(value, years_back)).withColumns({
        "base_year": F.col("_b.year"), "base_value": F.col("_b.v")}).drop("_b")


def compound(last: Column, first: Column, years: Column) -> Column:
    return F.when((first > 0) & (last > 0) & (years > 0),
                  F.pow(last / first, F.lit(1.0) / years) - 1)


def with_cagr(rows: DataFrame, value: str, years_back: int, out: str) -> DataFrame:
    """Compound growth of every year against its as-of base."""
    based = with_as_of(rows, value, years_back)
    return based.withColumn(out, compound(
        F.col(value), F.col("base_value"), F.col("year") - F.col("base_year"))).drop(
            "base_year", "base_value")


def backfill_cagr(history: DataFrame, value: str = "value", years_back: int = 3) -> DataFrame:
    """Growth of the last positive year over its as-of base, one row per company."""
    positive = history.where(F.col(value) > 0)
    based = with_as_of(positive, value, years_back)
    last = based.groupBy("company_number").agg(
        F.max_by(F.struct("year", value, "base_year", "base_value"), "year").alias("l"))
    return last.select("company_number", F.round(compound(
        F.col(f"l.{value}"), F.col("l.base_value"), F.col("l.year") - F.col("l.base_year")),
        4).alias("revenue_cagr_3y"))


def history_cagr(history: DataFrame, value: str = "value", out: str = "cagr") -> DataFrame:
    """Growth from the first to the last year on record, both of them positive."""
    v = F.when(F.col(value).isNotNull(), F.col("year"))
    ends = history.groupBy("company_number").agg(
        F.min_by(value, v).alias("f"), F.max_by(value, v).alias("l"),
        F.min(v).alias("fy"), F.max(v).alias("ly"))
    return ends.select("company_number", F.round(compound(
        F.col("l"), F.col("f"), F.col("ly") - F.col("fy")), 4).alias(out))
