"""Register snapshots: scan, tidy, filter and shape into the company table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Source column -> typed column of the company table.
TYPED_SOURCE = {
    "SICCode.SicText_1": "sic_code_1", "SICCode.SicText_2": "sic_code_2",
    "CompanyStatus": "company_status", "Accounts.AccountCategory": "accounts_category",
    "IncorporationDate": "incorporation_date", "CompanyCategory": "company_category",
}
# Source column -> key of the metadata object.
METADATA_SOURCE = {
    "SICCode.SicText_3": "sic_code_3", "SICCode.SicText_4": "sic_code_4",
    "RegAddress.PostCode": "postcode", "RegAddress.AddressLine1": "address_line_1",
    "RegAddress.AddressLine2": "address_line_2", "RegAddress.PostTown": "post_town",
    "RegAddress.County": "county", "RegAddress.Country": "country",
    "RegAddress.CareOf": "care_of", "RegAddress.POBox": "po_box",
    "CountryOfOrigin": "country_of_origin", "Accounts.AccountRefDay": "account_ref_day",
    "Accounts.AccountRefMonth": "account_ref_month",
    "Accounts.NextDueDate": "accounts_next_due_date",
    "Accounts.LastMadeUpDate": "accounts_last_made_up_date",
}
# Columns that hold counts.
COUNT_COLUMNS = [
    "Mortgages.NumMortCharges", "Mortgages.NumMortOutstanding",
    "Mortgages.NumMortPartSatisfied", "Mortgages.NumMortSatisfied",
    "LimitedPartnerships.NumGenPartners", "LimitedPartnerships.NumLimPartners",
]
KEPT_CATEGORIES = ["SMALL", "MEDIUM", "LARGE"]
NULL_WORDS = ["nan", "NaN", "None"]
EMPTY_COLUMNS = ["company_description", "risks", "qualitative_data"]


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All parts of a snapshot (folder or glob) as strings, headers trimmed."""
    raw = spark.read.option("header", True).option("inferSchema", False).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return trim_headers(raw)


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def _name(column: str):
    return F.col(f"`{column}`")


def blank_nulls(df: DataFrame) -> DataFrame:
    """Missing values and the words that stand for them become empty strings."""
    return df.select(*[
        F.when(_name(c).isNull() | _name(c).isin(NULL_WORDS), "").otherwise(_name(c)).alias(c)
        for c in df.columns])


def keep_target(df: DataFrame) -> DataFrame:
    """Active companies that file small, medium or large accounts."""
    category = F.upper(F.trim(_name("Accounts.AccountCategory")))
    return df.where(category.isin(KEPT_CATEGORIES)
                    & (F.trim(_name("CompanyStatus")) == "Active"))


def spaces_for_marks(df: DataFrame) -> DataFrame:
    """Hyphens and underscores in every string column become spaces."""
    return df.select(*[
        F.translate(_name(n), "-_", "  ").alias(n) if t == "string" else _name(n)
        for n, t in df.dtypes])


def count_columns(df: DataFrame) -> DataFrame:
    """Count columns as integers, blank or unreadable ones as 0."""
    return df.select(*[
        F.coalesce(_name(c).try_cast("double").try_cast("int"), F.lit(0)).alias(c)
        if c in COUNT_COLUMNS else _name(c) for c in df.columns])


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.nullif(_name(n), F.lit("")).alias(n) if t == "string" else _name(n)
        for n, t in df.dtypes])


def add_empty_columns(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("string") for c in names or EMPTY_COLUMNS})


def clean(df: DataFrame) -> DataFrame:
    """Filter and clean a trimmed snapshot; one narrow stage, no shuffle."""
    return add_empty_columns(count_columns(spaces_for_marks(keep_target(df))))


def to_companies(df: DataFrame) -> DataFrame:
    """Company records: typed columns, the rest packed into a JSON object, state pending.

    Blank values are left out of both; an object with nothing in it is null.
    """
    typed = [F.nullif(_name(s), F.lit("")).alias(t) for s, t in TYPED_SOURCE.items()
             if s in df.columns]
    packed = [F.nullif(_name(s), F.lit("")).alias(k) for s, k in METADATA_SOURCE.items()
              if s in df.columns]
    metadata = (F.nullif(F.to_json(F.struct(*packed)), F.lit("{}")) if packed
                else F.lit(None).cast("string"))
    return df.select(
        _name("CompanyNumber").alias("company_number"), _name("CompanyName").alias("company_name"),
        F.lit("pending").alias("pipeline_status"), *typed, metadata.alias("metadata"))


def ingest(raw: DataFrame) -> DataFrame:
    """Untidy snapshot to company records in a single stage."""
    return to_companies(blank_nulls(clean(trim_headers(raw))))


def violations(cleaned: DataFrame) -> DataFrame:
    """One row of post-ingest violation counts; all zero on a good load."""
    strings = [n for n, t in cleaned.dtypes if t == "string" and n not in EMPTY_COLUMNS]
    marks = F.lit(False)
    nan_words = F.lit(False)
    for n in strings:
        marks = marks | F.coalesce(_name(n).rlike("[-_]"), F.lit(False))
        nan_words = nan_words | F.coalesce(_name(n) == "NaN", F.lit(False))
    blanks = F.lit(False)
    for n in COUNT_COLUMNS:
        if n in cleaned.columns:
            blanks = blanks | _name(n).isNull()
    category = F.upper(F.trim(_name("Accounts.AccountCategory")))
    return cleaned.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~category.isin(KEPT_CATEGORIES)).alias("bad_category"),
        F.count_if(F.trim(_name("CompanyStatus")) != "Active").alias("bad_status"),
        F.count_if(marks).alias("marks_left"), F.count_if(nan_words).alias("nan_words"),
        F.count_if(blanks).alias("blank_counts"),
        F.lit(sum(c != c.strip() for c in cleaned.columns)).cast("bigint").alias(
            "untrimmed_headers"))
