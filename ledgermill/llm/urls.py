"""URL verdicts: rules first, then naive Bayes over words cut from hosts and paths.

Names in hosts and paths are written together; a unigram model over the words of page titles, of path
parts and of the hyphened and last parts of hosts cuts them by Viterbi into the likeliest words.  The
dictionary is a table of all words, joined to the substrings of the distinct hosts and paths.  A multinomial naive Bayes over
these tokens, hashed to FEATURES places, judges what no rule decides.  Pages whose host holds a seed
word are trained as unwanted.  The others have no label: a first model takes all of them as wanted,
the final one only those that the first does not judge unwanted.  All counts cover
the whole table.  What workers get has a fixed size: a bitmap of the words and FEATURES weights.

Defined results: a null url, or one without ://, has an empty host and path and no tokens, so the
verdict is that of the class which is more frequent; equal odds are allowed; the longest rule that
fits wins, of equally long ones the one that is given first; repeated rows are judged each.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import bitmaps, lower_ascii, passing, settle

#: Longest word.  Places for hashed tokens.
LONGEST, FEATURES = 24, 1 << 16
SMOOTHING = 1.0
#: Names longer than this are cut into pieces of this length first.
NAME = 512
#: Parameter: words that mark an unwanted host.
SEEDS = ("casino", "poker", "betting", "pills", "viagra", "pharma", "porn", "xxx", "spam", "warez",
         "bets", "bookmaker", "bookmakers", "gambling", "jackpot", "slots", "sportsbook",
         "adult", "adults", "erotic", "escort", "escorts", "hentai", "nude", "nudes", "sexy", "webcams",
         "ads", "adserver", "adservice", "adtech", "clicktracker", "doubleclick", "popunder", "tracker",
         "trackers", "tracking")
#: Fixed values of the rules: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z in lower case; else ''."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; else ''."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


# Segmentation

def dictionary(pages: DataFrame, url: str, page: str, seeds: Sequence[str]) -> DataFrame:
    """(word, n): how often each word occurs in titles, path parts and delimited host parts; seeds once at least."""
    title = F.regexp_extract(F.col(page), r"(?is)<title[^>]*>(.*?)</title", 1)
    letters = F.lower(F.concat_ws(" ", title, path_of(F.col(url))))
    labels = F.split(host_of(F.col(url)), r"\.")
    hyphened = F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-")))
    known = F.array_append(hyphened, F.element_at(labels, -1))
    words = F.concat(F.regexp_extract_all(letters, F.lit(r"([a-z]+)"), F.lit(1)),
                     F.filter(known, lambda x: x.rlike("^[a-z]+$")))
    word = F.explode(words).alias("word")
    counted = pages.select(word).where(F.length("word") <= LONGEST).groupBy("word").agg(F.count("*").alias("n"))
    given = pages.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, seeds)).cast("array<string>")).alias("word"))
    return settle(counted.unionByName(given.withColumn("n", F.lit(1).cast("long")))
                  .groupBy("word").agg(F.max("n").alias("n")), "url-dictionary")


def segment(name: str, words: dict[str, float]) -> list[str]:
    """The likeliest cut of a name into words; unknown ones cost a power of ten for each letter."""
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        value, start = -math.inf, end - 1
        for at in range(max(0, end - LONGEST), end):
            known = words.get(name[at:end])
            cost = known if known is not None else words[""] - 2.3 * (end - at) - 2.3
            if best[at] + cost > value:
                value, start = best[at] + cost, at
        best.append(value)
        back.append(start)
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def names_of(text: str) -> list[str]:
    """The runs of letters that are cut into words."""
    return [run[i:i + NAME] for run in re.findall(r"[a-z]+", text.lower()) for i in range(0, len(run), NAME)]


def substrings(text: str) -> set[str]:
    return {name[a:b] for name in names_of(text)
            for a in range(len(name)) for b in range(a + 1, min(a + LONGEST, len(name)) + 1)}


def tokenised(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Add host_words and path_words to rows with host and path.

    Each distinct host and path is met by the counts of all its substrings that are words; a bitmap
    of the words keeps most others from being shuffled.
    """
    texts = settle(rows.select(F.explode(F.array("host", "path")).alias("text")).distinct(), "url-texts")
    total = words.agg(F.sum("n")).first()[0] or 1

    def explode(batches):
        for batch in batches:
            column = batch.column("text").to_pylist()
            for i in range(0, len(column), 256):
                pairs = [(t, w) for t in column[i:i + 256] for w in substrings(t)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in pairs], pa.string()), pa.array([w for _, w in pairs], pa.string())],
                    ["text", "word"])

    def cut(batches):
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                known = {f["word"]: math.log(f["n"] / total) for f in found or ()} | {"": -math.log(total)}
                out.append([w for name in names_of(text) for w in segment(name, known)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), pa.array(out, pa.list_(pa.string()))], ["text", "words"])

    maps = settle(bitmaps(words.select(F.xxhash64("word").alias("key"))), "url-bits")
    some = passing(texts.mapInArrow(explode, "text string, word string"), F.xxhash64("word"), maps, "x7_in")
    found = (some.where("x7_in").join(words, "word").groupBy("text")
             .agg(F.collect_list(F.struct("word", "n")).alias("found")))
    parts = settle(texts.join(found, "text", "left").select("text", "found")
                   .mapInArrow(cut, "text string, words array<string>"), "url-parts")
    for c in ("host", "path"):
        rows = rows.join(parts.select(F.col("text").alias(c), F.col("words").alias(f"{c}_words")), c)
    return rows


# Naive Bayes

def place(token: str) -> int:
    return zlib.crc32(token.encode()) % FEATURES


def seeded(seeds: Sequence[str]) -> Column:
    return F.arrays_overlap("host_words", F.array(*map(F.lit, seeds)).cast("array<string>"))


def train(rows: DataFrame, seeds: Sequence[str]) -> tuple[float, np.ndarray]:
    """(log prior odds, log odds of each place) for unwanted against wanted."""
    marked = rows.select(seeded(seeds).alias("unwanted"), F.concat(
        F.transform("host_words", lambda w: F.concat(F.lit("h:"), w)),
        F.transform("path_words", lambda w: F.concat(F.lit("p:"), w))).alias("tokens"))
    size = {r["unwanted"]: r["count"] for r in marked.groupBy("unwanted").count().collect()}
    at = F.pmod(F.crc32(F.col("token").cast("binary")), F.lit(FEATURES)).alias("at")
    counted = (marked.select("unwanted", F.explode("tokens").alias("token"))
               .groupBy("unwanted", at).count().collect())  # at most 2 * FEATURES rows
    n = np.zeros((2, FEATURES))
    for r in counted:
        n[int(r["unwanted"]), r["at"]] += r["count"]
    n += SMOOTHING * (n.sum(0) > 0)  # places without a token say nothing
    odds = np.zeros(FEATURES)
    some = n[0] > 0
    odds[some] = np.log(n[1, some] / n[1].sum()) - np.log(n[0, some] / n[0].sum())
    prior = math.log((size.get(True, 0) + 1) / (size.get(False, 0) + 1))
    return prior, odds


def judged(rows: DataFrame, prior: float, odds: np.ndarray) -> DataFrame:
    """Add `odds`, the log odds that a url is unwanted."""
    kept = rows.columns
    sent = rows.sparkSession.sparkContext.broadcast(odds)

    def run(batches):
        for batch in batches:
            value = [prior + sum(sent.value[place("h:" + w)] for w in h) + sum(sent.value[place("p:" + w)] for w in p)
                     for h, p in zip(batch.column("host_words").to_pylist(), batch.column("path_words").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value, pa.float64())], [*kept, "odds"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, odds double")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, seeds: Sequence[str] = SEEDS,
          id_col: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """id, host, path, rule, verdict, the words cut from host and path, and the odds."""
    words = dictionary(pages, url, page, seeds)
    rows = pages.select(F.col(id_col), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = settle(tokenised(rows, words), "url-words")
    labelled = judged(rows, *train(rows, seeds)).where(seeded(seeds) | (F.col("odds") <= 0))
    labelled = settle(labelled.select("host_words", "path_words"), "url-labelled")
    found = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("odds") > 0, "block").otherwise("allow")
    return judged(rows, *train(labelled, seeds)).withColumn("found", found).select(
        id_col, "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", own).alias("verdict"), "host_words", "path_words", "odds")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: host, path, rule and verdict of every page."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
