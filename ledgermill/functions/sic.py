"""Industry codes: parsing, hierarchy and sector lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import lookups


def sic_code(raw: Column) -> Column:
    """Leading five-digit code of a register entry such as ``62012 Business software``."""
    first = F.element_at(F.split(F.trim(raw), r"\s+"), 1)
    return F.when(first.rlike("^[0-9]{5}$"), first)


def sic_description(raw: Column) -> Column:
    """Text after the code, null when there is no code."""
    return F.when(sic_code(raw).isNotNull(),
                  F.trim(F.substring(F.trim(raw), F.lit(6), F.length(raw))))


def sic_excluded(code: Column) -> Column:
    """Dormant, non-trading, household and extraterritorial codes."""
    division = F.substring(code, 1, 2).cast("int")
    return code.isin(lookups.SIC_EXCLUDED_CODES) | division.isin(lookups.SIC_EXCLUDED_DIVISIONS)


def with_hierarchy(df: DataFrame, code: str = "code") -> DataFrame:
    """Add division, group, class, subclass and the section letter.

    The section ranges are 21 rows, so the range join stays a broadcast.
    """
    levels = df.withColumns({
        "division": F.substring(code, 1, 2).cast("int"),
        "sic_group": F.substring(code, 1, 3),
        "sic_class": F.substring(code, 1, 4),
        "subclass": F.col(code),
    })
    ranges = F.broadcast(lookups.sic_sections(df.sparkSession))
    return levels.join(ranges, F.col("division").between(F.col("lo"), F.col("hi")), "left").drop(
        "lo", "hi")


def _entry(table: dict, key: Column) -> Column:
    """Literal-map lookup; the tables hold under a hundred rows, so no join is needed."""
    pairs = []
    for k, (sector, sub) in table.items():
        pairs += [F.lit(k), F.struct(F.lit(sector).alias("sector"), F.lit(sub).alias("sub_sector"))]
    return F.try_element_at(F.create_map(*pairs), key)


def sector_of(code: Column) -> Column:
    """STRUCT<sector, sub_sector> of a code as an expression, usable inside array functions."""
    division = F.substring(code, 1, 2).cast("int")
    klass = F.substring(code, 1, 4).cast("int")
    by_class = F.when(division.isin(lookups.SIC_CLASS_DIVISIONS),
                      _entry(lookups.SIC_CLASS_SECTORS, klass))
    return F.when(~sic_excluded(code), F.coalesce(by_class, _entry(lookups.SIC_DIVISION_SECTORS, division)))


def with_sector(df: DataFrame, code: str = "code") -> DataFrame:
    """Add sector and sub_sector by two broadcast lookups (class override, then division)."""
    spark = df.sparkSession
    keyed = df.withColumns({
        "_div": F.substring(code, 1, 2).cast("int"),
        "_cls": F.substring(code, 1, 4).cast("int"),
        "_out": F.coalesce(sic_excluded(F.col(code)), F.lit(True)),
    })
    joined = (
        keyed
        .join(F.broadcast(lookups.sic_classes(spark)),
              (F.col("_cls") == F.col("class"))
              & F.col("_div").isin(lookups.SIC_CLASS_DIVISIONS) & ~F.col("_out"), "left")
        .join(F.broadcast(lookups.sic_divisions(spark)),
              (F.col("_div") == F.col("division")) & ~F.col("_out"), "left")
    )
    return joined.withColumns({
        "sector": F.coalesce("class_sector", "div_sector"),
        "sub_sector": F.coalesce("class_sub_sector", "div_sub_sector"),
    }).drop("_div", "_cls", "_out", "class", "class_sector", "class_sub_sector", "division",
            "div_sector", "div_sub_sector")
