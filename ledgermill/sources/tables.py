"""Table reads and writes: scans, appends, keyed updates, upserts and schema growth.

No lakehouse format is assumed.  Updates produce the next snapshot of a table as a join;
where the catalog supports row-level writes, ``merge_statement`` gives the MERGE.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach (spark.checkpoint.dir).

    Only a local session, whose driver and executors are one process, may go without it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="ledgermill-")


def run_path(spark: SparkSession, name: str) -> str:
    """A folder of this run's own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Deal an input out to so many partitions, for costly row work behind few splits."""
    return df.repartition(partitions, key)


def select_where(table: DataFrame, columns: list[str], limit: int | None = None,
                 **equal) -> DataFrame:
    """Projection, equality filters and an optional limit; all pushed to the scan."""
    out = table
    for name, value in equal.items():
        out = out.where(F.col(name) == value)
    out = out.select(*columns)
    return out.limit(limit) if limit else out


def select_in(table: DataFrame, key: str, values: list) -> DataFrame:
    return table.where(F.col(key).isin(values))


def jdbc_scan(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
              partitions: int, **options) -> DataFrame:
    """Parallel paged scan of a database table over ranges of a numeric key."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high,
        numPartitions=partitions, **options).load()


def describe_columns(df: DataFrame) -> list[tuple]:
    """(position, name, type, nullable) of every column."""
    return [(i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def append_jdbc(df: DataFrame, url: str, table: str, batch: int = 500, **options) -> None:
    df.write.mode("append").format("jdbc").options(
        url=url, dbtable=table, batchsize=batch, **options).save()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def create_if_missing(spark: SparkSession, name: str, schema: T.StructType,
                      fmt: str = "parquet") -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}")


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add missing columns as typed nulls; existing ones are left alone."""
    new = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def update_keyed(target: DataFrame, updates: DataFrame, key: str,
                 columns: list[str]) -> DataFrame:
    """Replace columns of the rows that have an update (nulls included).

    ``updates`` must be unique by key.
    """
    u = updates.select(key, F.lit(True).alias("_hit"),
                       *[F.col(c).alias(f"_u_{c}") for c in columns])
    joined = target.join(u, key, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c) for c in target.columns])


def upsert(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows by key: new ones are added, existing ones overwritten."""
    r = rows.select(F.col(key).alias("_k"), *[
        F.col(c).alias(f"_u_{c}") for c in rows.columns if c != key])
    joined = target.join(r, F.col(key) == F.col("_k"), "full_outer")
    hit = F.col("_k").isNotNull()
    return joined.select(F.coalesce(key, "_k").alias(key), *[
        F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
        if c in rows.columns else F.col(c) for c in target.columns if c != key])


def merge_statement(target: str, source: str, key: str, columns: list[str]) -> str:
    """MERGE for catalogs with row-level writes."""
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns)
    names = ", ".join([key, *columns])
    values = ", ".join(f"s.{c}" for c in [key, *columns])
    return (f"MERGE INTO {target} t USING {source} s ON t.{key} = s.{key} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
