"""Semi-structured metadata: extraction, backfill, merge and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Typed column -> path inside the metadata object.
BACKFILL_PATHS = {
    "pipeline_status": "$.pipeline.status", "filing_format": "$.filing_format",
    "last_accounts_date": "$.last_accounts_date", "sic_code_1": "$.sic_code_1",
    "sic_code_2": "$.sic_code_2", "company_status": "$.company_status",
    "company_category": "$.company_category", "accounts_category": "$.accounts_category",
    "incorporation_date": "$.incorporation_date",
}
DATE_COLUMNS = ["last_accounts_date"]


def stored(path: str, column: str, metadata: str = "metadata") -> Column:
    """Metadata value at a path, as the typed column holds it."""
    text = F.get_json_object(F.col(metadata), path)
    return F.try_to_date(text, "yyyy-MM-dd") if column in DATE_COLUMNS else text


def _present(df: DataFrame) -> dict[str, str]:
    return {c: p for c, p in BACKFILL_PATHS.items() if c in df.columns}


def backfill(df: DataFrame) -> DataFrame:
    """Fill empty typed columns from the metadata object; filled ones are never touched."""
    return df.withColumns({c: F.coalesce(F.col(c), stored(p, c))
                           for c, p in _present(df).items()})


def backfill_counts(df: DataFrame) -> DataFrame:
    """How many rows a backfill would fill, per column."""
    return df.agg(*[F.count_if(F.col(c).isNull() & stored(p, c).isNotNull()).alias(c)
                    for c, p in _present(df).items()])


def mismatches(df: DataFrame) -> DataFrame:
    """Rows per column whose typed value differs from the metadata value."""
    return df.agg(*[F.count_if(stored(p, c).isNotNull() & ~F.col(c).eqNullSafe(stored(p, c)))
                    .alias(c) for c, p in _present(df).items()])


def _is_object(text: Column) -> Column:
    return F.coalesce(text.startswith("{"), F.lit(False))


def _shallow(text: Column) -> Column:
    return F.from_json(text, "map<string,variant>")


def merge_patch(metadata: Column, patch: Column) -> Column:
    """Metadata with a patch applied: keys overwrite, object on object merges one level.

    Variants keep numbers, strings and JSON null apart; a null patch changes nothing and a
    null metadata starts from an empty object.
    """
    empty = F.create_map().cast("map<string,variant>")
    old = F.coalesce(_shallow(metadata), empty)
    new = F.coalesce(_shallow(patch), empty)

    def one(_, a, b):
        ta, tb = F.to_json(a), F.to_json(b)
        inner = F.map_zip_with(_shallow(ta), _shallow(tb), lambda _, x, y: F.coalesce(y, x))
        both = _is_object(ta) & _is_object(tb)
        return F.when(both, F.parse_json(F.to_json(inner))).otherwise(F.coalesce(b, a))

    return F.to_json(F.map_zip_with(old, new, one))


def flatten_balance(df: DataFrame, column: str) -> DataFrame:
    """Rows (.., field, year, value) of a balance object, one level of nesting tolerated.

    Accepts ``{sub: {field: {year: value}}}`` and ``{field: {year: value}}`` side by side.
    """
    outer = F.from_json(F.col(column), "map<string,map<string,string>>")
    keys = [c for c in df.columns if c != column]
    level = df.select(*keys, F.explode(outer).alias("k1", "inner")).select(
        *keys, "k1", F.explode("inner").alias("k2", "v"))
    nested = _is_object(F.col("v"))
    years = F.when(nested, F.from_json("v", "map<string,double>")).otherwise(
        F.create_map("k2", F.col("v").try_cast("double")))
    return level.withColumn("field", F.when(nested, F.col("k2")).otherwise(F.col("k1"))).select(
        *keys, "field", F.explode(years).alias("year", "value")).withColumn(
        "year", F.col("year").try_cast("int"))


def lift_note_charges(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """Depreciation and amortisation from note rows where the statement lacks them.

    ``rows(company_number, year, depreciation, amortisation, ..)``,
    ``notes(company_number, year, field, value)``; both keyed by company and year.
    """
    lifted = notes.where(F.col("field").isin("depreciation", "amortisation")).groupBy(
        "company_number", "year").agg(
        F.max(F.when(F.col("field") == "depreciation", F.col("value"))).alias("_dep"),
        F.max(F.when(F.col("field") == "amortisation", F.col("value"))).alias("_am"))
    return rows.join(lifted, ["company_number", "year"], "left").withColumns({
        "depreciation": F.coalesce("depreciation", "_dep"),
        "amortisation": F.coalesce("amortisation", "_am")}).drop("_dep", "_am")


def readable_object(text: Column) -> Column:
    """Metadata as a variant, null when it is not valid JSON."""
    return F.try_parse_json(text)


# --- metadata as binary variants -------------------------------------------
_FIELDS = "map<string,variant>"


def _fields(value: Column) -> Column:
    """The fields of a variant that is an object, else null."""
    return F.try_variant_get(value, "$", _FIELDS)


def merge_variants(metadata: Column, patch: Column) -> Column:
    """Like merge_patch, on VARIANT columns: no value is turned into text or parsed on the way.

    Keys of the patch overwrite, object on object merges one level; anything that is no object counts
    as an empty one at the top.  Fields come out in the order of their names.
    """
    empty = F.create_map().cast(_FIELDS)

    def one(_, a, b):
        x, y = _fields(a), _fields(b)
        inner = F.to_variant_object(F.map_zip_with(x, y, lambda _, s, t: F.coalesce(t, s)))
        return F.when(x.isNotNull() & y.isNotNull(), inner).otherwise(F.coalesce(b, a))

    return F.to_variant_object(F.map_zip_with(
        F.coalesce(_fields(metadata), empty), F.coalesce(_fields(patch), empty), one))


def with_variants(df: DataFrame, *columns: str) -> DataFrame:
    """JSON text columns as VARIANT; text that is not valid JSON becomes null."""
    return df.withColumns({c: F.try_parse_json(c) for c in columns})


def variant_leaves(df: DataFrame, column: str) -> DataFrame:
    """(.., path, value): what the top level and the objects on it hold, arrays and deeper objects as JSON text.

    JSON null is the text ``null``; an empty object is a leaf of its own.
    """
    keys = [c for c in df.columns if c != column]
    top = df.select(*keys, F.explode(_fields(F.col(column))).alias("k1", "v1"))
    inner = F.when(F.size(F.coalesce(_fields(F.col("v1")), F.create_map().cast(_FIELDS))) > 0, _fields(F.col("v1")))
    leaves = top.select(*keys, "k1", F.explode(F.coalesce(inner, F.create_map(F.lit(""), F.col("v1")))).alias("k2", "v"))
    path = F.when(F.col("k2") == "", F.col("k1")).otherwise(F.concat_ws(".", "k1", "k2"))
    return leaves.select(*keys, path.alias("path"), F.to_json("v").alias("value"))


def backfill_variant(df: DataFrame) -> DataFrame:
    """Like backfill, for a VARIANT metadata column."""
    def stored_value(column: str, path: str) -> Column:
        found = F.try_variant_get("metadata", path, "string")
        return F.try_to_date(found, "yyyy-MM-dd") if column in DATE_COLUMNS else found

    return df.withColumns({c: F.coalesce(F.col(c), stored_value(c, p)) for c, p in _present(df).items()})


def variant_schema(df: DataFrame, column: str) -> DataFrame:
    """(path, type, n): the types that occur at each path, and in how many rows."""
    keys = df.select(F.explode(_fields(F.col(column))).alias("k1", "v1"))
    inner = keys.where(F.size(F.coalesce(_fields(F.col("v1")), F.create_map().cast(_FIELDS))) > 0).select(
        "k1", F.explode(_fields(F.col("v1"))).alias("k2", "v"))
    # the names of an object's fields would make a type of every row
    kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0).alias("type")
    both = keys.select(F.col("k1").alias("path"), F.col("v1").alias("v")).unionByName(
        inner.select(F.concat_ws(".", "k1", "k2").alias("path"), "v"))
    return both.select("path", kind).groupBy("path", "type").agg(F.count("*").alias("n"))
