"""Tagged facts: lookups, guards and first/newest-wins aggregation.

Ordering keys are packed into one BIGINT.  ``min_by``/``max_by`` over a long and a double
keep fixed-width buffers, so Spark aggregates by hash with map-side combine; a struct key
would force a sort of the whole fact table before the first aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import lookups, schemas
from ledgermill.functions import numbers, text

ENTITY_WIDE = r"^(Consolidated|EntityWide|Group|EntityOfficersDirectorsMember$|EntityOfficersMember$)"

# Namespace fragments by taxonomy family, in match order.
FAMILY_NAMESPACES = [
    ("xbrl.frc.org.uk/%/core", "core"), ("xbrl.frc.org.uk/%/FRS-102", "frs-102"),
    ("xbrl.frc.org.uk/%/FRS-105", "frs-105"), ("xbrl.frc.org.uk/%/aurep", "aurep"),
    ("xbrl.frc.org.uk/%/direp", "direp"), ("xbrl.frc.org.uk/%/bus", "bus"),
    ("xbrl.ifrs.org/", "ifrs"),
]


def recency(filing_date: Column, tiebreak: Column) -> Column:
    """Orderable DECIMAL(38,0): later filing date wins, then the larger tiebreak of any BIGINT."""
    days = F.unix_date(filing_date).cast("decimal(10,0)")
    return (days * F.lit("10000000000000000000").cast("decimal(20,0)") + tiebreak.cast("bigint")).cast("decimal(38,0)")


def map_tags(facts: DataFrame, extra: dict[str, str] | None = None,
             how: str = "inner") -> DataFrame:
    """Attach the canonical ``field`` of each fact; unmapped facts drop out (or stay, ``left``)."""
    table = F.broadcast(lookups.tag_map(facts.sparkSession, extra))
    keyed = facts.withColumn("tag", text.local_name(F.col("name")))
    return keyed.join(table, "tag", how).drop("tag")


def unknown_tags(facts: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Facts whose tag is in no lookup."""
    table = F.broadcast(lookups.tag_map(facts.sparkSession, extra))
    keyed = facts.withColumn("tag", text.local_name(F.col("name")))
    return keyed.join(table, "tag", "left_anti").drop("tag")


def map_tags_tiered(facts: DataFrame, tiers: DataFrame) -> DataFrame:
    """Tiered lookup on ``tiers(family, tag, field)``: own family first, then ``_any``.

    ``facts`` carries ``family``; both lookups are broadcasts of the same small table.
    """
    keyed = facts.withColumn("tag", text.local_name(F.col("name")))
    own = F.broadcast(tiers.where("family <> '_any'").select("family", "tag", F.col("field").alias("_own")))
    shared = F.broadcast(tiers.where("family = '_any'").select(
        "tag", F.col("field").alias("_any")))
    return (keyed.join(own, ["family", "tag"], "left").join(shared, "tag", "left")
            .withColumn("tier", F.when(F.col("_own").isNotNull(), F.lit("family"))
                        .when(F.col("_any").isNotNull(), F.lit("_any")))
            .withColumn("field", F.coalesce("_own", "_any")).drop("_own", "_any", "tag"))


def family_of(uri: Column) -> Column:
    """Taxonomy family of a namespace URI."""
    branch = None
    for pattern, family in FAMILY_NAMESPACES:
        cond = uri.like("%" + pattern + "%")
        branch = F.when(cond, F.lit(family)) if branch is None else branch.when(
            cond, F.lit(family))
    return branch.otherwise(F.lit("_any"))


def join_contexts(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Resolve facts against a separate context table; facts without a year drop out."""
    dated = contexts.where(F.col("year").isNotNull())
    return facts.join(dated, ["filing_id", "ctx_id"], "inner")


def entity_wide(members: Column) -> Column:
    """Is every dimension member an entity-wide default?"""
    return F.forall(members, lambda m: m.rlike(ENTITY_WIDE))


def plain_facts(facts: DataFrame, allow_entity_wide: bool = False) -> DataFrame:
    """Drop dimensional facts; optionally keep those with only entity-wide members."""
    keep = ~F.col("dimensional")
    if allow_entity_wide:
        keep = keep | entity_wide(F.col("members"))
    return facts.where(keep)


def unit_verdict(unit: Column, field: Column) -> Column:
    """keep, keep_unchecked (no unit given) or the reason a fact is skipped."""
    counted = field.isin(lookups.COUNT_FIELDS)
    return (F.when(unit.isNull(), "keep_unchecked")
            .when(unit == "iso4217:GBP", "keep")
            .when(unit.startswith("iso4217:"), "skip_currency")
            .when(counted, "keep")
            .otherwise("skip_non_money"))


def parse_values(facts: DataFrame, decimals_as_scale: bool = False) -> DataFrame:
    """Add the numeric ``value`` of each fact and drop nil ones.

    With ``decimals_as_scale`` a fact without a scale is shifted by its negative decimals.
    """
    scale = F.col("scale")
    if decimals_as_scale:
        scale = numbers.scale_or_decimals(scale, F.col("decimals")).cast("string")
    value = numbers.tagged_number(F.col("raw"), scale, F.col("sign"))
    # The one-element explode binds the value, so that the filter does not parse it once more.
    return facts.select("*", F.explode(F.array(value)).alias("value")).where(F.col("value").isNotNull())


def rejected_scales(facts: DataFrame) -> DataFrame:
    """Facts whose scale is not an integer: they give no value and are reported here."""
    scale = F.col("scale")
    return facts.where(scale.isNotNull() & (F.trim(scale) != "")
                       & scale.try_cast("int").isNull())


FIRST_KEYS = ["company_number", "filing_id", "recency", "year", "field"]


def first_in_document(facts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One value per filing, year and field: the earliest in document order."""
    return facts.groupBy(*(keys or FIRST_KEYS)).agg(F.min_by("value", "ord").alias("value"))


def newest_filing(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Newest non-null value per cell; older filings only fill gaps."""
    order = F.when(F.col("value").isNotNull(), F.col("recency"))
    return cells.groupBy(*(keys or ["company_number", "year", "field"])).agg(
        F.max_by("value", order).alias("value"))


def provenance(facts: DataFrame) -> DataFrame:
    """Which tag, raw text, scale and sign produced each first-in-document value."""
    detail = F.struct("ord", "name", "raw", "scale", "sign", "value")
    return facts.groupBy("company_number", "filing_id", "recency", "year", "field").agg(
        F.min(detail).alias("p")).select(
            "company_number", "filing_id", "recency", "year", "field", "p.*")


def collisions(facts: DataFrame) -> DataFrame:
    """Facts dropped by first-wins that disagree with the kept tag and value.

    The kept fact per cell is aggregated first and joined back, so no cell is ever
    collected into one window frame.
    """
    cell = ["filing_id", "year", "field"]
    kept = facts.groupBy(*cell).agg(
        F.min("ord").alias("kept_ord"), F.min_by("name", "ord").alias("kept_tag"),
        F.min_by("value", "ord").alias("kept_value"))
    return facts.join(kept, cell).where(
        (F.col("ord") > F.col("kept_ord")) & (F.col("name") != F.col("kept_tag"))
        & (F.col("value") != F.col("kept_value"))
    ).select(*cell, "kept_tag", "kept_value", F.col("name").alias("dropped_tag"),
             F.col("value").alias("dropped_value"))


def statement_rows(cells: DataFrame, years: DataFrame | None = None,
                   fields: list[str] | None = None) -> DataFrame:
    """One wide row per company and year.

    ``years(company_number, year)`` adds years seen without any fact.  They enter as cells
    with a null field, so the spine costs no join.
    """
    fields = fields or schemas.ROW_FIELDS
    if years is not None:
        spine = years.select("company_number", "year", F.lit(None).cast("string").alias("field"),
                             F.lit(None).cast("double").alias("value")).distinct()
        cells = cells.select("company_number", "year", "field", "value").unionByName(spine)
    return cells.groupBy("company_number", "year").pivot("field", fields).agg(F.first("value"))


def statement_maps(rows: DataFrame) -> DataFrame:
    """Year-keyed statement maps per company, years ascending."""
    def packed(fields, name):
        entry = F.struct(F.col("year").cast("string").alias("key"),
                         F.struct(*fields).alias("value"))
        return F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(name)

    return rows.groupBy("company_number").agg(
        packed(schemas.INCOME_FIELDS, "income_statement"),
        packed(schemas.BALANCE_FIELDS, "balance_sheet"),
        packed(schemas.CASH_FLOW_FIELDS, "cash_flow_statement"))


def cell_stack(rows: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Wide rows back to (company_number, year, field, value), nulls included."""
    fields = fields or schemas.STATEMENT_FIELDS
    return rows.unpivot(["company_number", "year"], fields, "field", "value")
