"""Shards of nearly equal bytes: a k-d tree over metadata, cut at distributed weighted medians.

The points of the tree are the groups of equal texts, each at the coordinates of its first row and as
heavy as all its rows, so copies share a shard.  A group of more than 1 / FINE of a shard's bytes
(or of its even share of rows) becomes several points of about that size: it is kept together as
well, unless a cut falls into it.  A node of s shards is cut along the dimension in which its points
lie widest, measured by the whole table's extent, where s // 2 of its s shares of bytes lie on the
left.  Points that agree in that dimension follow each other by the hash of their text and their
number in the group.  Leaves are single shards; their number is given or follows from the bytes
wanted in one.

A median is found for all nodes of a level at once: the sums of weights in BINS ranges of the
node's interval, the range where the share ends, and again in that range until it holds one point.
A round brings one row for each node to the driver.  A node's points are never sorted or gathered.
The splits go back to the points as a table of one row for each node.  Slots are numbered in buckets
of about BUCKET rows, behind the sums of the buckets before.

Defined results: a null text is the empty one and has the size 1; null coordinates count as 0; rows
with a null or repeated id are placed like others; a row larger than a shard's share makes its shard
larger, and where there are fewer points than shards some stay empty; an empty table gives an empty
table.  Other columns are passed on only where named.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.llm.common import settle

#: Parts of a shard that a group may fill as one point; ranges of a round; rows of a bucket of slots.
FINE, BINS, BUCKET = 100, 2048, 1 << 16
#: Most nodes whose splits are broadcast (about 64 bytes each); more are joined by shuffle.
BROADCAST = 1 << 16
#: Levels after which the points' nodes are written instead of derived again.
LEVELS = 4


def prefix_code(name: Column) -> Column:
    """A number that orders strings by their first seven bytes."""
    head = F.hex(F.substring(F.encode(name, "UTF-8"), 1, 7))
    return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("long")


def dimensions(text: str = "text") -> dict[str, Column]:
    """Those of the table documents: language, source, id, and the size on a logarithmic scale."""
    return {"lang": prefix_code(F.col("lang")), "source": prefix_code(F.col("source")),
            "doc_id": F.col("doc_id").cast("long"),
            "size": F.round(F.log2(F.coalesce(F.octet_length(text), F.lit(0)) + 1.0) * 1024).cast("long")}


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST else df


def measured(docs: DataFrame, dims: Mapping[str, Column], text: str, carry: list[str]) -> DataFrame:
    """One narrow row for each document: row number, size, checksum, hash of the text, coordinates.

    Coordinates are halved, so that differences of any two are 64-bit numbers.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    x = F.array(*[F.shiftright(F.coalesce(c, F.lit(0)).cast("long"), 1) for c in dims.values()])
    return docs.select(
        *[F.col(f"`{c}`") for c in carry], F.monotonically_increasing_id().alias("x11_row"),
        (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(whole), 1).alias("x11_group"), x.alias("x11_x"))


def _pieces(rows: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(points, rows with the number of their piece); points have group, piece, w and x."""
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    groups = settle(rows.groupBy("x11_group").agg(
        F.sum("size").alias("w"), F.count("*").alias("n"),
        F.min_by("x11_x", F.struct("x11_x", "x11_row")).alias("x")), "kd-groups")
    parts = F.least(F.col("n"), F.greatest(F.ceil(F.col("w") * FINE * shards / F.lit(max(total, 1))),
                                           F.ceil(F.col("n") * FINE * shards / F.lit(max(n, 1)))))
    sized = groups.withColumn("parts", parts)
    # one in FINE of a shard's bytes or rows: there are at most 2 * FINE * shards such groups
    heavy = settle(sized.where("parts > 1").select("x11_group", "parts", "x"), "kd-heavy")
    many = _small(heavy.select("x11_group", "parts"), 2 * FINE * shards)
    rows = rows.join(many, "x11_group", "left").withColumn(
        "x11_piece", F.coalesce(F.pmod(F.xxhash64("x11_row"), F.col("parts")), F.lit(0)).cast("int"))
    cut = (rows.where("parts > 1").groupBy("x11_group", "x11_piece").agg(F.sum("size").alias("w"))
           .join(_small(heavy.select("x11_group", "x"), 2 * FINE * shards), "x11_group"))
    points = sized.where("parts <= 1").select("x11_group", F.lit(0).alias("x11_piece"), "w", "x").unionByName(cut)
    return points, rows.drop("parts", "x11_x")


def _value(state: str = "part") -> Column:
    """A point's value in the part of its key that the node's round looks at."""
    return (F.when(F.col(state) == 0, F.col("x")[F.col("dim")])
            .when(F.col(state) == 1, F.col("x11_group")).otherwise(F.col("x11_piece").cast("long")))


def _medians(points: DataFrame, nodes: list[dict]) -> list[dict]:
    """For each node the point in which its left share of bytes ends, and the weight before it.

    A node is a dict of node, dim, lo and hi (the extent in dim), w, left and shards.
    """
    spark, done = points.sparkSession, []
    open_ = [{**n, "part": 0, "before": 0, "at_x": 0, "at_group": 0} for n in nodes]
    while open_:
        rows = [(n["node"], n["dim"], n["part"], n["lo"], n["hi"], (n["hi"] - n["lo"]) // BINS + 1,
                 n["at_x"], n["at_group"], n["before"], (n["w"] * n["left"]) // n["shards"]) for n in open_]
        state = spark.createDataFrame(rows, "node long, dim int, part int, lo long, hi long, width long, "
                                            "at_x long, at_group long, before long, goal long")
        inside = (points.join(_small(state, len(rows)), "node").withColumn("v", _value())
                  .where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                  .where((F.col("part") < 1) | (F.col("x")[F.col("dim")] == F.col("at_x")))
                  .where((F.col("part") < 2) | (F.col("x11_group") == F.col("at_group"))))
        bins = (inside.withColumn("bin", F.expr("(v - lo) div width")).groupBy("node", "bin", "before", "goal").agg(
            F.sum("w").alias("w"), F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
            F.min(F.struct(F.col("x")[F.col("dim")].alias("x"), "x11_group", "x11_piece")).alias("first")))
        upto = F.sum("w").over(W.partitionBy("node").orderBy("bin")) + F.col("before")
        last = W.partitionBy("node").orderBy(F.desc("bin"))
        found = (bins.withColumn("upto", upto).withColumn("is_last", F.row_number().over(last) == 1)
                 .where((F.col("upto") > F.col("goal")) | F.col("is_last"))
                 .groupBy("node").agg(F.min_by(F.struct("w", "n", "lo", "hi", "first", "upto"), "bin").alias("b")))
        hit = {r.node: r.b for r in found.collect()}
        going = []
        for n in open_:
            b = hit[n["node"]]
            n = {**n, "before": b.upto - b.w, "lo": b.lo, "hi": b.hi}
            if b.n == 1:
                done.append({**n, "cut": (b.first.x, b.first.x11_group, b.first.x11_piece), "at_w": b.w})
            elif b.lo < b.hi:
                going.append(n)
            else:  # all agree in this part of the key: on to the next one
                at = {"at_x": b.lo} if n["part"] == 0 else {"at_group": b.lo}
                going.append({**n, **at, "part": n["part"] + 1, "lo": 0,
                              "hi": (1 << 63) - 1 if n["part"] == 0 else (1 << 31) - 1})
        open_ = going
    return done


def _descend(points: DataFrame, splits: list[dict]) -> DataFrame:
    """Points of a split node go to its left or right child, whose first shard they take."""
    rows = [(s["node"], s["dim"], *s["cut"], s["takes"], s["left"]) for s in splits]
    table = points.sparkSession.createDataFrame(
        rows, "node long, dim int, cut_x long, cut_group long, cut_piece int, takes boolean, left int")
    key = F.struct(F.col("x")[F.col("dim")].alias("a"), F.col("x11_group").alias("b"), F.col("x11_piece").alias("c"))
    cut = F.struct(F.col("cut_x").alias("a"), F.col("cut_group").alias("b"), F.col("cut_piece").alias("c"))
    right = F.when(F.col("takes").isNull(), F.lit(None)).when(F.col("takes"), key > cut).otherwise(key >= cut)
    return (points.join(_small(table, len(rows)), "node", "left").withColumn("right", right)
            .select(F.coalesce(F.col("node") * 2 + F.col("right").cast("int"), F.col("node")).alias("node"),
                    (F.col("shard") + F.when(F.col("right"), F.col("left")).otherwise(0)).alias("shard"),
                    "x11_group", "x11_piece", "w", "x"))


def tree(points: DataFrame, shards: int, dims: int) -> DataFrame:
    """Add `shard` and `node` to points (x11_group, x11_piece, w, x)."""
    points = points.withColumn("node", F.lit(1).cast("long")).withColumn("shard", F.lit(0))
    share, whole, level = {1: shards}, None, 0
    while True:
        wide = [n for n, s in share.items() if s > 1]
        if not wide:
            return points
        ends = [f(F.col("x")[d]).alias(f"{name}{d}") for d in range(dims) for name, f in (("lo", F.min), ("hi", F.max))]
        found = {r.node: r for r in points.groupBy("node").agg(F.sum("w").alias("w"), F.count("*").alias("n"), *ends)
                 .where(F.col("n") > 0).collect()}
        nodes = []
        for n in wide:
            r = found.get(n)
            if r is None:
                continue
            extent = [r[f"hi{d}"] - r[f"lo{d}"] for d in range(dims)]
            whole = whole or [max(e, 1) for e in extent]
            dim = max(range(dims), key=lambda d: (extent[d] / whole[d], -d))
            nodes.append({"node": n, "dim": dim, "lo": r[f"lo{dim}"], "hi": r[f"hi{dim}"], "w": r.w,
                          "left": share[n] // 2, "shards": share[n]})
        if not nodes:
            return points
        splits = _medians(points, nodes)
        for s in splits:  # the point goes where the left side comes closer to its share; left on the right if equal
            with_it, without = ((s["before"] + x) * s["shards"] - s["w"] * s["left"] for x in (s["at_w"], 0))
            s["takes"] = abs(with_it) < abs(without)
        points = _descend(points, splits)
        share = {c: k for n in nodes for c, k in (
            (2 * n["node"], n["left"]), (2 * n["node"] + 1, n["shards"] - n["left"]))}
        level += 1
        if level % LEVELS == 0:
            points = settle(points, "kd-level")


def _slots(rows: DataFrame, shards: int) -> DataFrame:
    """Add `slot`: numbers from 0 in each shard."""
    buckets = rows.groupBy("shard").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("buckets"))
    rows = rows.join(_small(buckets, shards), "shard").withColumn("bucket", F.pmod(F.xxhash64("x11_row"), F.col("buckets")))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("x11_row"))
    return (rows.withColumn("inside", inside).join(starts, ["shard", "bucket"])
            .withColumn("slot", (F.col("start") + F.col("inside") - 1).cast("long")))


def shard(docs: DataFrame, dims: Mapping[str, Column], shards: int | None = None, target_bytes: int | None = None,
          text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `carry`, size, text_crc32, shard and slot of every row.

    Give the number of shards, or the bytes that a shard should hold.
    """
    rows = settle(measured(docs, dims, text, list(carry)), "kd-rows")
    if shards is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        shards = max(1, -(-total // target_bytes))
    points, rows = _pieces(rows, shards)
    placed = tree(settle(points, "kd-points"), shards, len(dims)).select("x11_group", "x11_piece", "shard")
    rows = settle(rows.join(placed, ["x11_group", "x11_piece"]), "kd-placed")
    return _slots(rows, shards).select(*[F.col(f"`{c}`") for c in carry], "size", "text_crc32", "shard", "slot")


def query(spark, sf_dir: str) -> DataFrame:
    """op11: shard and slot of every document by 16 leaves of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard(docs, dimensions(), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
