"""Scalar functions and clustering on small cases."""

import pytest
from pyspark.sql import functions as F

from ledgermill import lookups
from ledgermill.functions import numbers, sic, text
from ledgermill.operators import agreement, evidence, facts, json_ops, tokens


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


@pytest.mark.parametrize("raw,scale,sign,want", [
    ("1,234", "3", None, 1234000.0), ("5", None, "-", -5.0), ("-", None, None, None),
    ("", None, None, None), ("12 345.5", None, None, 12345.5), ("x", None, None, None),
    ("7", "abc", None, None)])
def test_tagged_number(spark, raw, scale, sign, want):
    got = values(spark, [(raw, scale, sign)], "r string, s string, g string",
                 numbers.tagged_number(F.col("r"), F.col("s"), F.col("g")))
    assert got == [(want,)]


@pytest.mark.parametrize("s,want", [
    ("(9,453", -9453), ("54.043", 54043), ("–", 0), ("£1,000", 1000), ("(12)", -12),
    ("nil", None), ("abc", None), (".", 0)])
def test_printed_number(spark, s, want):
    assert values(spark, [(s,)], "s string", numbers.printed_number(F.col("s"))) == [(want,)]


@pytest.mark.parametrize("s,want", [
    ("1,234", True), ("nil", True), ("-", True), ("note 12", False), ("", False),
    ("12 months", False), ("£(45)", True), ("( )", False)])
def test_number_text(spark, s, want):
    assert values(spark, [(s,)], "s string", numbers.is_number_text(F.col("s"))) == [(want,)]


def test_sic(spark):
    rows = [("62012 Business software",), ("64209 x",), ("26600 y",), ("99999 Dormant",),
            ("EMPTY",), ("26110 z",), ("32500 m",)]
    df = spark.createDataFrame(rows, "raw string").select(sic.sic_code(F.col("raw")).alias("code"))
    got = [(r.code, r.sector, r.sub_sector) for r in sic.with_sector(df).collect()]
    assert sorted(got, key=str) == sorted([
        ("62012", "Technology", "Software"), ("64209", "Financials", "Asset Management"),
        ("26600", "Healthcare", "Medical Devices & Equipment"), ("99999", None, None),
        (None, None, None), ("26110", None, None),
        ("32500", "Healthcare", "Medical Devices & Equipment")], key=str)


def test_tag_table():
    t = lookups.tag_table({"MyOwnTurnover": "revenue"})
    assert len(lookups.tag_table()) == 282
    assert t["NetCashFromOperatingActivities"] == "net_cash_operating"
    assert t["InterestPayableAndSimilarCharges"] == "finance_costs"
    assert t["CostSalesBeforeExceptionalItems"] == "cost_of_sales"
    assert t["PropertyPlantAndEquipment"] == "tangible_fixed_assets"
    assert t["NoncurrentAssets"] == t["NonCurrentAssets"] == "total_fixed_assets"
    assert t["Equity"] == t["TotalEquity"] == "total_equity"
    assert t["MyOwnTurnover"] == "revenue"
    # exact names only: no joining word, suffix or capital is folded
    for name in ("Unknown", "OfficeCosts", "CostSalesOf", "DebtorsBeforeExceptionalItems", "turnover"):
        assert name not in t


def test_division_table():
    assert len(lookups.SIC_DIVISION_SECTORS) == 83 and lookups.SIC_DIVISION_SECTORS[32][0] == "Industrial"


def test_chained_and_anchored_rows(spark):
    ys = [1.0, 10.0, 25.0, 50.0, 90.0, 100.0]
    df = spark.createDataFrame([(1, 1, y) for y in ys], "doc_id long, page int, y double")
    chained = {r.y: r.row for r in tokens.islands(df, tokens.PAGE, "y", 20, "row").collect()}
    anchored = {r.y: r.row for r in tokens.anchored_rows(df, tokens.PAGE, "y", 20, "row").collect()}
    assert [chained[y] for y in ys] == [0, 0, 0, 1, 2, 2]
    assert [anchored[y] for y in ys] == [0, 0, 1, 2, 3, 3]


@pytest.mark.parametrize("old,patch,want", [
    ('{"a":1,"n":{"x":1,"y":2},"s":"q"}', '{"a":"z","n":{"y":3,"w":null},"b":[1,2],"s":null}',
     {"a": "z", "n": {"w": None, "x": 1, "y": 3}, "s": None, "b": [1, 2]}),
    (None, '{"k":1}', {"k": 1}), ('{"k":1}', None, {"k": 1}),
    ('{"k":{"a":1}}', '{"k":5}', {"k": 5})])
def test_json_merge(spark, old, patch, want):
    import json

    got = values(spark, [(old, patch)], "m string, p string",
                 json_ops.merge_patch(F.col("m"), F.col("p")))
    assert json.loads(got[0][0]) == want


def test_unit_guard_and_members(spark):
    rows = [("iso4217:GBP", "revenue", ["GroupX"]), ("iso4217:USD", "revenue", ["Segment"]),
            ("xbrli:pure", "employees", []), ("xbrli:pure", "revenue", ["Group", "Other"]),
            (None, "cash", ["EntityOfficersMember"])]
    got = values(spark, rows, "u string, f string, m array<string>",
                 facts.unit_verdict(F.col("u"), F.col("f")), facts.entity_wide(F.col("m")))
    assert got == [("keep", True), ("skip_currency", False), ("keep", True),
                   ("skip_non_money", False), ("keep_unchecked", True)]


def test_phrase_over_page_end(spark):
    pages = spark.createDataFrame([(1, 1, "prepared under section"), (1, 2, "1a of frs"),
                                   (1, 3, "102")], "doc_id long, page int, text string")
    r = tokens.phrase_flags(pages, {"a": "section 1a", "b": "frs 102", "c": "frs 105"}).collect()[0]
    assert (r.a, r.b, r.c, r.last_page) == (True, True, False, 3)


def test_vote_prefers_signals_then_rank_then_start(spark):
    pool = spark.createDataFrame(
        [(1, "auditor_report", 3, None, "toc"), (1, "auditor_report", 7, None, "hard_anchor"),
         (1, "auditor_report", 8, None, "running_header"), (1, "section_172", 9, None, "toc"),
         (1, "section_172", 5, None, "toc"), (1, "section_172", 2, None, "numbered_note")],
        "doc_id long, section_id string, start_page int, end_page int, signal string")
    got = {r.section_id: (r.start, r.signals, r.confidence)
           for r in evidence.vote(pool, []).collect()}
    assert got == {"auditor_report": (7, ["hard_anchor", "running_header"], "high"),
                   "section_172": (5, ["toc"], "low")}


def test_fuzzy_and_dates(spark):
    got = values(spark, [("THE STRATEGIC REPROT 2020".split(),)], "w array<string>",
                 text.fuzzy_contains(F.col("w"), "STRATEGIC REPORT"),
                 text.fuzzy_contains(F.col("w"), "AUDITOR REPORT"))
    assert got == [(True, False)]
    assert values(spark, [("2025-04-30",), ("x",)], "d string", text.year_of(F.col("d"))) == [
        (2025,), (None,)]


def test_tagged_numbers_are_strict(spark):
    raws = {"\u00a012\u202f345\u00a0": 12345.0, "1,234.5": 1234.5, "-.5": -0.5, "5d": None, "1f": None, "nan": None,
            "Infinity": None, "": None, "1e3": None, "1.2.3": None, None: None}
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r.raw: r.v for r in df.select("raw", numbers.tagged_number(
        F.col("raw"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("v")).collect()}
    assert got == raws


def test_variants_merge_like_text(spark):
    rows = [('{"a":1,"n":{"x":1,"y":2},"s":"q"}', '{"a":"z","n":{"y":3,"w":null},"b":[1,2],"s":null}',
             '{"a":"z","b":[1,2],"n":{"w":null,"x":1,"y":3},"s":null}'),
            (None, '{"k":1}', '{"k":1}'), ('{"k":1}', None, '{"k":1}'), ("[1]", '{"k":2}', '{"k":2}'),
            ("{broken", '{"k":2}', '{"k":2}'), (None, None, "{}"), ('{"n":{}}', '{"n":{"x":1}}', '{"n":{"x":1}}'),
            ('{"n":1}', '{"n":{"x":1}}', '{"n":{"x":1}}'), ('{"n":{"x":{"p":1}}}', '{"n":{"x":{"q":2}}}', '{"n":{"x":{"q":2}}}')]
    df = json_ops.with_variants(spark.createDataFrame(rows, "m string, p string, want string"), "m", "p")
    got = df.select(F.to_json(json_ops.merge_variants(F.col("m"), F.col("p"))).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_variant_leaves_and_schema(spark):
    df = json_ops.with_variants(spark.createDataFrame(
        [(1, '{"a":null,"n":{"x":1.5,"y":{"z":1}},"e":{},"l":[1]}'), (2, '{"a":2}'), (3, None), (4, "[]")],
        "id int, m string"), "m")
    leaves = {(r.id, r.path): r.value for r in json_ops.variant_leaves(df, "m").collect()}
    assert leaves == {(1, "a"): "null", (1, "n.x"): "1.5", (1, "n.y"): '{"z":1}', (1, "e"): "{}", (1, "l"): "[1]", (2, "a"): "2"}
    kinds = {(r.path, r.type): r.n for r in json_ops.variant_schema(df, "m").collect()}
    assert kinds == {("a", "VOID"): 1, ("a", "BIGINT"): 1, ("n", "OBJECT"): 1, ("n.x", "DECIMAL"): 1,
                     ("n.y", "OBJECT"): 1, ("e", "OBJECT"): 1, ("l", "ARRAY"): 1}


def test_as_of_takes_the_last_entry_before(spark):
    history = spark.createDataFrame([("a", "2020-01-01", "SMALL"), ("a", "2021-01-01", "FULL"), ("a", "2022-01-01", None),
                                     ("b", "2020-06-01", "MEDIUM")], "k string, valid_from string, category string")
    events = spark.createDataFrame([(1, "a", "2019-12-31"), (2, "a", "2020-01-01"), (3, "a", "2020-12-31"), (4, "a", "2021-07-01"),
                                    (5, "a", "2023-01-01"), (6, "b", "2024-01-01"), (7, "c", "2024-01-01"), (7, "c", "2024-01-01")],
                                   "id int, k string, day string")
    got = sorted((r.id, r.category) for r in agreement.as_of(events, history, "k", "day", "category").collect() if r.id < 7)
    assert got == [(1, None), (2, "SMALL"), (3, "SMALL"), (4, "FULL"), (5, None), (6, "MEDIUM")]
    assert agreement.as_of(events, history, "k", "day", "category").count() == 8


def test_agreement_above_chance(spark):
    pairs = spark.createDataFrame([("small", "small")] * 20 + [("small", "large")] * 5 + [("large", "small")] * 10
                                  + [("large", "large")] * 15 + [("medium", None)] * 3, "x string, y string")
    counts = agreement.matrix(pairs, "x", "y")
    assert {(r.x, r.y): r.n for r in counts.collect()} == {("small", "small"): 20, ("small", "large"): 5, ("large", "small"): 10,
                                                           ("large", "large"): 15}
    r = agreement.kappa(counts, "x", "y").collect()[0]
    assert (r.n, round(r.agreed, 6), round(r.expected, 6), round(r.kappa, 6)) == (50, 0.7, 0.5, 0.4)
    assert agreement.kappa(counts.limit(0), "x", "y").collect() == []
