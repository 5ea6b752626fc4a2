"""Helpers shared by the operators: the shared folder, settled tables, bounded slices of a batch."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white space characters that separate words: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\f\r"
#: Fixed pattern of a word in Java's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir).

    Only a local session, where driver and executors are one process, may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.gettempdir() + "/ledgermill-shared"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession, label: str) -> str:
    """Like shared_path, as a mounted path: memory mapping needs one on every node."""
    path = urlparse(shared_path(spark, label))
    if path.scheme not in ("", "file"):
        raise ValueError("memory mapping needs spark.checkpoint.dir on a mounted file system, "
                         f"not {path.scheme}:")
    return path.path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a set of bitmaps: 2 MB, the bound of what is broadcast.
BITS = 1 << 24


def bitmaps(keys: DataFrame) -> DataFrame:
    """The set of the long column `key`, modulo BITS, as at most BITS / 32768 rows of 4 KB.

    A filter of fixed size in front of an exact step: it lets through every member and, by chance,
    some others, all of them once the set is far larger than BITS.
    """
    slot = F.pmod(F.col("key"), F.lit(BITS)) + 1
    return (keys.groupBy(F.bitmap_bucket_number(slot).alias("bits_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits_map")))


def passing(df: DataFrame, key: Column, maps: DataFrame, flag: str) -> DataFrame:
    """Add `flag`: whether the bit of `key` is set."""
    slot = F.pmod(key, F.lit(BITS)) + 1
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits_map", (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = byte.cast("int").bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return (df.withColumn("bits_bucket", F.bitmap_bucket_number(slot))
            .join(F.broadcast(maps), "bits_bucket", "left")
            .withColumn(flag, F.coalesce(bit, F.lit(False))).drop("bits_bucket", "bits_map"))


def share(key: Column) -> Column:
    """A 64-bit hash as a number from 0 up to 1, for samples that a row's own hash decides."""
    return F.shiftrightunsigned(key, 11) / float(1 << 53)


def lower_ascii(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: The same table for bytes.translate.
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def slices(lengths, size: int = 1 << 21):
    """(start, end) ranges of a batch that hold about `size` characters, one text at least."""
    start = total = 0
    for i, n in enumerate(lengths):
        total += int(n) + 64
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)
