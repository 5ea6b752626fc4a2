"""Small tables with the cases that every operator has a defined result for."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators also use for results
    *(T.StructField(n, T.StringType()) for n in (
        "kept", "ids", "fp", "key", "copies", "tokens", "n_words", "score", "rank", "host", "decoded",
        "lang_pred", "component_id", "text_sha256", "domain", "quota", "Rejected"))])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    *(T.StructField(n, T.StringType()) for n in ("text", "path", "host", "rule", "odds", "votes"))])


def sentence(rng: random.Random, n: int, letters: str) -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(n))


def documents() -> list[tuple]:
    rng = random.Random(7)
    base = sentence(rng, 300, "abcdefgh")
    words = base.split()
    near = [" ".join([*words[:i], "changed", *words[i + 1:]]) for i in (5, 100, 200, 299)]
    texts = [
        (1, base, "en", "src1"), (1, base, "en", "src1"),  # a repeated row
        (1, base + " ", "en", "src1"),  # the same id, another text that counts as equal
        (2, None, "en", "src1"), (3, "", "de", "src2"), (4, " \n\t\x0b\f\r ", None, None),
        (None, base.replace(" ", "\n"), "en", "src3"), (None, "no id here", "en", None),
        (None, "no id here", "en", None), (5, "x" * 20_000, "en", "src1"),
        (6, "word " * 4_000, "de", "src4"), (7, "ÀÉ İ ß Σ ﬁ 日本語 \u00a0 e\u0301 x", "fr", "src1"),
        (8, "<|endoftext|> special <|startoftext|>", "en", "src1"), (9, "12 34!! $$ 5%", "en", "srcx"),
        (10, "line a\nline a\n\nline a \nline b\nline b", "es", "src9"),
        (11, "it's we're I'LL 'S ''s don't", "en", "src1"), (12, "a", "en", "src1"), (13, "A", "en", "src1"),
        *((20 + i, t, "en", "src1") for i, t in enumerate(near)),
        *((30 + i, sentence(rng, 40, "abcdef" if i % 2 else "uvwxyz"), "en" if i % 2 else "de", "src2")
          for i in range(30)),
    ]
    return [(i, t, a, b, None if t is None else len(t), *["x"] * 17) for i, t, a, b in texts]


#: Queries of the lexical search: one id twice, none, no term, no id.
ITEMS = [(1, "Changed a b c abc bad cab word"), (1, "LINE b"), (2, None), (3, " .,! "), (None, "x id no"),
         (4, "日本語 é ß Σ 12 34"), (5, "word"), (6, "nothing-of-this-kind"), (7, "a")]
TURNS = [(1, 0, "user", "Hello."), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, None, None, None)]


def write(spark, folder: str, rows=None, pages=None, labels=None) -> str:
    def put(name, data, schema):
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")

    put("documents", documents() if rows is None else rows, DOCUMENTS)
    put("pages", [] if pages is None else pages, PAGES)
    put("labels", [(i, int(i % 5 != 0), 0) for i in range(70)] if labels is None else labels,
        "doc_id long, quality int, toxic int")
    put("benchmark", ITEMS if rows is None else [], "item_id long, text string")
    put("conversations", TURNS if rows is None else [], "conv_id long, turn long, role string, text string")
    return folder
