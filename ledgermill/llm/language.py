"""Language identification by the nearest of several centroids per language.

A text is the vector of its hashed character 1- to 3-grams over lower-cased letters, other runs
being one space: log(1 + count) times inverse document frequency, of length one.  Document
frequencies cover every training row.  The centroids of a language are clusters, by cosine, of a
sample of its training rows, repeats counted once: those whose hash of id and text lies in the part
of its range that holds SAMPLE of the language's rows on average.  The language of the nearest centroid is predicted; its cosine is the score.

Rejection is by distance: a text is rejected if its cosine is below SLACK times the lowest one that
sampled rows of the predicted language with as many n-grams or more have to their own centroids.  Short
texts are measured by pieces of the sampled rows, cut off at powers of two: below a row's own length its
pieces count like rows, but for the LEAST part of them with the lowest cosines, which hold hardly a word.

Defined results: null, empty and letterless texts are `und`, score 0, rejected; equal cosines go to
the language that sorts first; without training rows every text is `und`; repeated rows get equal
predictions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import share, slices
from ledgermill.llm.transducer import LETTER, classes

#: Hashed n-gram places.
SIZE = 1 << 13
#: Sampled training rows of a language, on average at most; centroids of a language.
SAMPLE, CENTROIDS = 1000, 4
SLACK = 0.5
#: The part of a length's pieces that sets no floor; characters of the shortest piece.
LEAST, PIECE = 0.02, 16
ROUNDS = 12
UNKNOWN = "und"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def blocks(lengths):
    """Slices of a batch, of 64 texts at most as each takes a row of SIZE counts."""
    return slices(np.maximum(lengths, SIZE), 64 * SIZE)


def counts(texts: list[str | None]) -> np.ndarray:
    """n-gram counts, a row for each text."""
    lowered = [(t or "").lower() for t in texts]
    joined = " ".join(lowered) + " "
    point = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter = classes()[point] == LETTER
    point = np.where(letter, point, 32)
    keep = letter | (np.roll(letter, 1) & (owner == np.roll(owner, 1)))
    point, owner, letter = point[keep].astype(np.uint64), owner[keep], letter[keep]
    out = np.zeros(len(texts) * SIZE, np.int32)
    shift = np.uint64(64 - SIZE.bit_length() + 1)
    for n in (1, 2, 3):
        if len(point) < n:
            break
        rows = len(point) - n + 1
        h = np.full(rows, n, np.uint64)
        for i in range(n):
            h = (h + point[i:i + rows]) * _MIX[i]
        inside = (owner[:rows] == owner[n - 1:]) & (letter[:rows] if n == 1 else True)
        at = owner[:rows] * SIZE + (h >> shift).astype(np.int64)
        out += np.bincount(at[inside], minlength=len(out)).astype(np.int32)
    return out.reshape(len(texts), SIZE)


def vectors(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(n.astype(np.float32)) * idf
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def level(n: np.ndarray) -> np.ndarray:
    """Number of binary digits of a text's n-grams."""
    return np.ceil(np.log2(n.sum(1) + 1)).astype(int)


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids; the first is the mean's nearest row, each further one the worst served row."""
    mean = x.mean(0)
    centres = [x[(x @ mean).argmax()]]
    while len(centres) < min(k, len(x)):
        served = (x @ np.array(centres).T).max(1)
        centres.append(x[served.argmin()])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        mine = (x @ centres.T).argmax(1)
        total = (mine[None, :] == np.arange(len(centres))[:, None]).astype(x.dtype) @ x  # no copies of the rows
        total = np.where(np.bincount(mine, minlength=len(centres))[:, None] > 0, total, centres)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = total / np.where(size > 0, size, 1)
    return centres


def pieces(text: str) -> list[str]:
    """The text, and its first 16, 32, .. characters below half of its length."""
    return [text, *(text[:1 << j] for j in range(PIECE.bit_length() - 1, len(text).bit_length() - 1))]


def _sparse(sample: DataFrame) -> DataFrame:
    """The n-gram counts of sampled rows and of their pieces: at most SIZE numbers for each."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(pc.utf8_length(texts).to_numpy(), 64 * SIZE):
                parts = [pieces(t) for t in texts.slice(a, b - a).to_pylist()]
                row = np.repeat(np.arange(a, b), [len(p) for p in parts])
                whole = [i == 0 for p in parts for i in range(len(p))]
                flat = [t for p in parts for t in p]
                for c, d in blocks([len(t) for t in flat]):
                    n = counts(flat[c:d])
                    at = [np.flatnonzero(x) for x in n]
                    of = pa.array(row[c:d])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("lang").take(of), batch.column("key").take(of), pa.array(whole[c:d]),
                         pa.array([x.astype(np.int32) for x in at], pa.list_(pa.int32())),
                         pa.array([x[i] for x, i in zip(n, at)], pa.list_(pa.int32()))],
                        ["lang", "key", "whole", "at", "n"])

    return sample.mapInArrow(run, "lang string, key long, whole boolean, at array<int>, n array<int>")


def _frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold an n-gram, by place, and all rows."""
    def run(batches):
        total = np.zeros(SIZE + 1, np.int64)
        for batch in batches:
            column = batch.column(0)
            for a, b in blocks(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                n = counts(column.slice(a, b - a).to_pylist())
                total += np.append((n > 0).sum(0), len(n))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SIZE + 1, dtype=np.int32)), pa.array(total)], ["at", "n"])

    rows = docs.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(SIZE + 1, np.int64)
    for r in rows:
        out[r["at"]] = r["n"]
    return out[:-1], int(out[-1])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> dict:
    """Learn from the rows of `docs` with a language and a text."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"),
                       F.xxhash64(F.col(id_col), F.col(text)).alias("key"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    found, n = _frequencies(rows.select("text"))
    idf = (np.log((1 + n) / (1 + found)) + 1).astype(np.float32)
    bounds = rows.groupBy("lang").count().collect()  # a row for each language
    if not bounds:
        return {"langs": [], "centres": np.zeros((0, SIZE), np.float32), "idf": idf,
                "floors": np.zeros((0, 64))}
    chosen = F.lit(False)
    for r in bounds:
        chosen = chosen | ((F.col("lang") == r["lang"]) & (share(F.col("key")) < SAMPLE / r["count"]))
    sample = rows.where(chosen).dropDuplicates(["lang", "key"]).select("lang", "key", "text")

    def dense(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        x, size = np.zeros((len(part), SIZE), np.float32), np.zeros(len(part), int)
        for i, (at, n) in enumerate(zip(part["at"], part["n"])):
            x[i, at] = vectors(n[None, :], idf[at])[0]
            size[i] = level(n[None, :])[0]
        return x, size

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["whole", "key"], ascending=[False, True], kind="stable")
        x, size = dense(part[part["whole"]])
        some = size > 0
        centres = cluster(x if some.all() else x[some], CENTROIDS) if some.any() else np.zeros((1, SIZE))
        near = (x @ centres.T).max(1)
        floors = [float(near[some & (size >= min(i, size.max()))].min(initial=1.0)) for i in range(64)]
        parts = part[~part["whole"]]
        cosines, levels = [near[:0]], [size[:0]]
        for i in range(0, len(parts), 256):
            y, z = dense(parts.iloc[i:i + 256])
            cosines.append((y @ centres.T).max(1))
            levels.append(z)
        cosines, levels = np.concatenate(cosines), np.concatenate(levels)
        for i in range(64):
            mine = cosines[levels == i]
            if len(mine):
                floors[:i + 1] = np.minimum(floors[:i + 1], np.quantile(mine, LEAST))
        return pd.DataFrame({"lang": part["lang"].iloc[0], "centre": [c.tolist() for c in centres],
                             "floors": [floors] * len(centres)})

    fitted = _sparse(sample).groupBy("lang").applyInPandas(
        fit, "lang string, centre array<float>, floors array<double>").collect()
    fitted.sort(key=lambda r: (r["lang"], r["centre"]))
    return {"langs": [r["lang"] for r in fitted], "idf": idf,
            "centres": np.array([r["centre"] for r in fitted], np.float32),
            "floors": np.array([r["floors"] for r in fitted])}


def predict(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default), lang_pred, score and rejected."""
    new = {"lang_pred": T.StringType(), "score": T.DoubleType(), "rejected": T.BooleanType()}
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(k, t) for k, t in new.items()])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x CENTROIDS x SIZE floats

    def run(batches):
        m = sent.value
        langs, centres, floors = np.array(m["langs"], object), m["centres"], m["floors"]
        for batch in batches:
            column, rest = batch.column(text), batch.select(kept)
            for a, b in blocks(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                n = counts(column.slice(a, b - a).to_pylist())
                size = level(n)
                if len(langs):
                    near = vectors(n, m["idf"]) @ centres.T
                    best = near.argmax(1)
                    score = np.clip(near.max(1).astype(float), 0, 1)
                    score = np.where(size > 0, score, 0.0)
                    name = np.where(size > 0, langs[best], UNKNOWN)
                    bad = (size == 0) | (score < SLACK * floors[best, size])
                else:
                    score, bad = np.zeros(b - a), np.ones(b - a, bool)
                    name = np.full(b - a, UNKNOWN, object)
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(a, b - a).columns, pa.array(name.tolist(), pa.string()),
                     pa.array(score), pa.array(bad)], [*kept, *new])

    source = docs.select(*[F.col(f"`{c}`") for c in kept],
                         *([] if text in kept else [F.col(text)]))  # a text that stays is sent once
    return source.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def accepted(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """The rows of `docs` whose language is known, all columns as they were."""
    model = train(docs.where(~held_out(id_col)), text, lang, id_col)
    names = docs.columns
    plain = docs.toDF(*[f"x3_{i}" for i in range(len(names))])
    kept = predict(plain, model, f"x3_{names.index(text)}")
    return kept.where("NOT rejected").select(*[F.col(f"x3_{i}").alias(c) for i, c in enumerate(names)])


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the language of every document, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", held_out())
    model = train(docs.where("NOT held_out"))
    return predict(docs.select("doc_id", "held_out", "text"), model, keep=["doc_id", "held_out"])
