"""Exact deduplication by progressive refinement, with DataFrame functions only.

Texts are equal when identical after deleting the six ASCII white space characters.  Three rounds
narrow down which rows can have an equal: by length of the normalised text, by a hash of its
prefix, by SHA-256 of all of it.  What survives a round is handed to the next scan as bitmaps of a
fixed total size, so that no text is shuffled to find out whether it needs its full hash.  A bit
set by chance only costs one more full hash; groups are formed on full hashes.

Defined results: null counts as the empty text; a null id sorts behind every other; of rows that
are equal in id and in text one stays; an empty table gives an empty table.  Columns beside id and
text are passed on unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import SPACES, bitmaps, passing, settle

#: Characters of the normalised text that the second round hashes.
PREFIX = 64


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """Add x9_norm and x9_candidate: whether length and prefix occur more than once."""
    rows = docs.withColumn("x9_norm", normalised(F.col(text)))
    length = F.octet_length("x9_norm").cast("long")
    prefix = F.xxhash64(length, F.substring("x9_norm", 1, PREFIX))
    repeated = F.col("x9_n") > 1

    lengths = rows.groupBy(length.alias("key")).agg(F.count("*").alias("x9_n")).where(repeated)
    lengths = settle(bitmaps(lengths), "exact-lengths")
    longs = passing(rows.select("x9_norm"), length, lengths, "x9_len").where("x9_len")
    prefixes = longs.groupBy(prefix.alias("key")).agg(F.count("*").alias("x9_n")).where(repeated)
    prefixes = settle(bitmaps(prefixes), "exact-prefixes")
    both = passing(passing(rows, length, lengths, "x9_len"), prefix, prefixes, "x9_pre")
    return both.withColumn("x9_candidate", F.col("x9_len") & F.col("x9_pre")).drop("x9_len", "x9_pre")


def _groups(hashed: DataFrame) -> DataFrame:
    """For each full hash that occurs: its rows, and the first of them in keeping order."""
    return (hashed.groupBy("x9_full", "x9_id", "x9_chars").agg(F.count("*").alias("x9_m"))
            .groupBy("x9_full").agg(
                F.sum("x9_m").alias("x9_size"),
                F.min(F.struct((-F.col("x9_chars")).alias("c"), F.isnull("x9_id").alias("z"),
                               F.col("x9_id").alias("id"))).alias("x9_first")))


def _hashed(docs: DataFrame, id_col: str, text: str, keep: Sequence[Column]) -> DataFrame:
    full = F.when(F.col("x9_candidate"), F.unhex(F.sha2(F.col("x9_norm"), 256)))
    return _with_candidates(docs, text).select(
        *keep, full.alias("x9_full"), F.col(id_col).alias("x9_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("x9_chars"))


def label_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 carry: Sequence[str] = ()) -> DataFrame:
    """Each row's id, keep_id, group_size and kept, with the columns in `carry`.

    Of equal texts the row with the most code points in the original text stays, then the smallest
    id.  Only narrow rows are shuffled.  Rows equal in everything are counted before the join and
    dealt out again behind it, so a row repeated many times is no hot key; large groups of different
    ids are left to adaptive skew joins.
    """
    hashed = settle(_hashed(docs, id_col, text, [F.col(c) for c in carry]), "exact-hashes")
    alone = hashed.where("x9_full IS NULL").select(
        *carry, F.col("x9_id").alias(id_col), F.col("x9_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    some = hashed.where("x9_full IS NOT NULL")
    rows = some.groupBy("x9_full", "x9_id", "x9_chars", *carry).agg(
        F.sequence(F.lit(1), F.count("*").cast("int")).alias("x9_turns"))
    stays = (F.col("x9_id").eqNullSafe(F.col("x9_first.id"))
             & (F.col("x9_chars") == -F.col("x9_first.c")) & (F.col("x9_turn") == 1))
    grouped = (rows.join(_groups(some), "x9_full").withColumn("x9_turn", F.explode("x9_turns"))
               .select(*carry, F.col("x9_id").alias(id_col), F.col("x9_first.id").alias("keep_id"),
                       F.col("x9_size").alias("group_size"), stays.alias("kept")))
    return alone.unionByName(grouped)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns as they were.

    Rows without a candidate pass straight through.  The others meet the list of rows that stay by
    (hash, id, length), so copies of one text are spread by their ids.
    """
    mine = [F.col(f"`{c}`") for c in docs.columns]
    winners = settle(
        _groups(_hashed(docs, id_col, text, []).where("x9_full IS NOT NULL"))
        .select("x9_full", F.col("x9_first.id").alias("x9_wid"),
                (-F.col("x9_first.c")).alias("x9_wchars")), "exact-winners")
    marked = _with_candidates(docs, text)
    alone = marked.where(~F.col("x9_candidate")).select(*mine)
    rivals = (marked.where("x9_candidate")
              .withColumn("x9_hash", F.unhex(F.sha2(F.col("x9_norm"), 256)))
              .withColumn("x9_chars", F.length(F.coalesce(F.col(text), F.lit("")))).drop("x9_norm"))
    on = ((F.col("x9_hash") == F.col("x9_full")) & (F.col("x9_chars") == F.col("x9_wchars"))
          & F.col(id_col).eqNullSafe(F.col("x9_wid")))
    best = rivals.join(winners, on, "left_semi").dropDuplicates(["x9_hash"]).select(*mine)
    return alone.unionByName(best)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: one row per document, dropped ones too, with the digest of the normalised text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumn("text_sha256", F.sha2(normalised(F.col("text")), 256))
    return label_copies(docs, carry=["text_sha256"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS c,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(t) AS text_sha256
FROM n
WINDOW w AS (PARTITION BY t ORDER BY c DESC, doc_id NULLS LAST)
"""
