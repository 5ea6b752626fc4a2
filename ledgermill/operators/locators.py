"""Statutory sections of printed filings: classes, entity changes, texts and their evaluation.

Locators and votes are in evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.functions import text
from ledgermill.operators import tokens as tok

# Phrases that tell the class of a printed filing.
CLASS_PHRASES = {
    "frs_105": "frs 105", "micro_entity": "micro-entity", "micro_entity_2": "micro entity",
    "section_1a": "section 1a", "small_regime": "small companies regime",
    "small_entities": "small entities", "s1a": " s1a",
    "uk_ias": "uk-adopted international accounting standards", "uk_ifrs": "uk-adopted ifrs",
    "ifrs": "international financial reporting standards", "s444": "section 444(4)",
    "opted_out": "opted not to deliver", "profit_and_loss": "profit and loss",
    "abbreviated": "abbreviated", "accounts": "accounts",
}


def with_class(d: DataFrame) -> DataFrame:
    """Add size, mode and reasons to documents with a flag for each phrase and ``last_page``."""
    c = F.col
    micro = c("frs_105") | c("micro_entity") | c("micro_entity_2")
    small = c("section_1a") | c("small_regime") | c("small_entities") | c("s1a")
    large = c("uk_ias") | c("uk_ifrs") | c("ifrs") | (c("last_page") >= 60)
    size = (F.when(micro, "micro").when(small, "small").when(large, "large")
            .when(c("last_page") < 15, "micro").when(c("last_page") < 30, "small")
            .otherwise("medium"))
    d = d.withColumn("size", size)
    filleted = c("s444") | (c("opted_out") & c("profit_and_loss"))
    minimal = (c("size") == "micro") & (c("last_page") <= 10)
    short = c("abbreviated") & c("accounts")
    mode = (F.when(filleted, "filleted").when(minimal, "micro_minimal")
            .when(short, "abbreviated").otherwise("full"))
    reasons = F.array_compact(F.array(
        F.when(micro, "frs_105_marker").when(small, "frs_102_s1a_marker").when(
            large, "ifrs_or_60plus_pages"),
        F.when(filleted, "s444_filleted").when(minimal, "micro_minimal_by_page_count").when(
            short, "abbreviated_marker")))
    return d.withColumns({"mode": mode, "reasons": reasons})


def expected_printed(section: Column, size: Column, mode: Column) -> Column:
    """Is the section due in a printed filing of this class?"""
    reports = ["strategic_report", "section_172", "principal_risks", "viability_statement"]
    left_out = reports + ["directors_report", "directors_responsibilities", "auditor_report",
                          "going_concern_directors"]
    return ~((size.isin("micro", "small") & section.isin(reports))
             | ((mode == "filleted") & section.isin(left_out))
             | ((mode == "micro_minimal")
                & ~section.isin("accounting_policies", "going_concern_note")))


def entity_changes(pages: DataFrame) -> DataFrame:
    """Other signs of a second entity: a new registration number, a level-one heading again
    after the audit report, a second contents page; the first page of each."""
    order = W.partitionBy("doc_id").orderBy("page")
    number = text.registration_number(F.col("text"))
    seen = pages.select(
        "doc_id", "page", number.alias("number"),
        F.upper("top25").contains("CONTENTS").alias("toc"),
        text.first_anchor(F.col("top15"), ["strategic_report", "directors_report"]).alias("h"),
        (text.first_anchor(F.col("top15"), ["auditor_report"]).isNotNull()).alias("audit"))
    last_number = F.last("number", ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, -1))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    flags = seen.withColumns({
        "new_number": (F.col("number") != last_number),
        "second_toc": F.col("toc") & F.coalesce(F.max(F.col("toc")).over(before), F.lit(False)),
        "after_audit": F.col("h").isNotNull() & F.coalesce(
            F.max(F.col("audit")).over(before), F.lit(False)),
    })
    return flags.groupBy("doc_id").agg(*[
        F.min(F.when(F.col(n), F.col("page"))).alias(n)
        for n in ("new_number", "second_toc", "after_audit")])


def section_texts(placed: DataFrame, pages: DataFrame) -> DataFrame:
    """Text of each found section: its pages joined by blank lines.

    The range join runs as an equi join on exploded page numbers.
    """
    spans = placed.where("start is not null").select(
        "doc_id", "section_id", F.explode(F.sequence("start", "end")).alias("page"))
    return spans.join(pages.select("doc_id", "page", "text"), ["doc_id", "page"]).groupBy(
        "doc_id", "section_id").agg(tok.joined_text(["page"], sep="\n\n").alias("text"))


def evaluation(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """Per section: labelled slots, share found and share with the exact page range.

    Null-safe keys beside the test of the labels' own leave the found side without a filter of its own, so
    that sides of the same origin can share one exchange.
    """
    mine = labelled.select("doc_id", "section_id", F.col("start").alias("l_start"), F.col("end").alias("l_end"))
    theirs = found.select(F.col("doc_id").alias("_doc"), F.col("section_id").alias("_section"), "start", "end")
    same = (F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("section_id").eqNullSafe(F.col("_section"))
            & F.col("doc_id").isNotNull() & F.col("section_id").isNotNull())
    pair = mine.join(theirs, same, "left")
    exact = (F.col("start") == F.col("l_start")) & (F.col("end") == F.col("l_end"))
    return pair.groupBy("section_id").agg(
        F.count("*").alias("labelled"), F.avg(F.col("start").isNotNull().cast("int")).alias(
            "found_rate"),
        F.avg(F.coalesce(exact, F.lit(False)).cast("int")).alias("exact_rate"))
