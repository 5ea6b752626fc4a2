"""Sector classification of companies by their industry codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import sic

SECONDARY = ["sic_code_2", "sic_code_3", "sic_code_4"]


def classify(df: DataFrame) -> DataFrame:
    """Sector, sub-sector, exclusion and multi-sector flag per company; one narrow stage."""
    coded = df.withColumn("code", sic.sic_code(F.col("sic_code_1"))).withColumns({
        "excluded": sic.sic_excluded(F.col("code")),
        "description": sic.sic_description(F.col("sic_code_1")),
        "secondary": F.array_compact(F.array(*[
            F.when(sic.sic_code(F.col(c)).isNotNull(), F.struct(
                sic.sic_code(F.col(c)).alias("code"),
                sic.sic_description(F.col(c)).alias("description"),
                sic.sector_of(sic.sic_code(F.col(c)))["sector"].alias("sector")))
            for c in SECONDARY])),
    })
    with_sector = sic.with_sector(coded)
    other = F.exists("secondary", lambda s: s["sector"].isNotNull()
                     & ~s["sector"].eqNullSafe(F.col("sector")))
    return with_sector.withColumns({
        "multi_sector": F.col("code").isNotNull() & other,
        "outcome": F.when(F.col("code").isNull(), "no_sic").when(F.col("excluded"), "excluded")
        .when(F.col("sector").isNull(), "unknown_division").otherwise("classified"),
        "in_sector_counts": F.coalesce(F.col("sector") != "Public Services", F.lit(False)),
    })


def sic_metadata(classified: DataFrame) -> DataFrame:
    """Nested industry-code object per classified company, as JSON."""
    primary = F.struct("code", "description", "sector", "sub_sector", "excluded")
    secondary = F.transform("secondary", lambda s: F.struct(s["code"], s["description"]))
    body = F.struct(primary.alias("primary"), secondary.alias("secondary"),
                    F.when(F.col("multi_sector"), F.lit(True)).alias("multi_sector"))
    return classified.where("code is not null").select(
        "company_number", F.to_json(F.struct(body.alias("sic_codes"))).alias("metadata_patch"))


def outcome_counts(classified: DataFrame) -> DataFrame:
    return classified.agg(
        *[F.count_if(F.col("outcome") == o).alias(o)
          for o in ("classified", "excluded", "no_sic", "unknown_division")],
        F.count_if("multi_sector").alias("multi_sector"))


def sector_distribution(classified: DataFrame) -> DataFrame:
    return classified.where("sector is not null").groupBy("sector").agg(
        F.count("*").alias("n")).orderBy(F.desc("n"), "sector")


def key_batches(classified: DataFrame, size: int = 200) -> DataFrame:
    """Keys of each (sector, sub_sector) in batches of about ``size`` for bulk writes.

    The batch number is a hash spread over the group's size, so even a sector holding a
    third of all companies is split over many small groups.
    """
    coded = classified.where("code is not null")
    sizes = coded.groupBy("sector", "sub_sector").agg(F.count("*").alias("n"))
    joined = coded.alias("c").join(
        F.broadcast(sizes.alias("s")),
        F.col("c.sector").eqNullSafe(F.col("s.sector"))
        & F.col("c.sub_sector").eqNullSafe(F.col("s.sub_sector")))
    batch = F.pmod(F.xxhash64("company_number"), F.ceil(F.col("n") / size))
    return joined.groupBy("c.sector", "c.sub_sector", batch.alias("batch")).agg(
        F.collect_list("company_number").alias("keys"))
