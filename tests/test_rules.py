"""Rules against a row-by-row model, golden balances and properties."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.operators import facts, growth, rules

SCHEMA = T.StructType([T.StructField("company_number", T.StringType()),
                       T.StructField("year", T.IntegerType())]
                      + [T.StructField(f, T.DoubleType()) for f in schemas.ROW_FIELDS])


def frame(spark, rows):
    data = [tuple(r.get(f.name) for f in SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, SCHEMA)


def model_fill(row):
    """Small independent model of the fills, one rule at a time."""
    r = dict(row)
    filled = []

    def put(name, value):
        if r.get(name) is None and value is not None:
            r[name] = value
            filled.append(name)

    def add(*names):
        vals = [r.get(n) for n in names]
        return None if None in vals else sum(vals)

    def diff(a, b):
        return None if r.get(a) is None or r.get(b) is None else r[a] - r[b]

    def some(names, least):
        vals = [r[n] for n in names if r.get(n) is not None]
        return sum(vals) if len(vals) >= least else None

    def plus(base, names, least=0):
        extra = [r[n] for n in names if r.get(n) is not None]
        start = add(*base)
        return None if start is None or len(extra) < least else start + sum(extra)

    put("gross_profit", add("revenue", "cost_of_sales"))
    put("revenue", diff("gross_profit", "cost_of_sales"))
    put("cost_of_sales", diff("gross_profit", "revenue"))
    other = [r.get("other_operating_income"), r.get("income_from_group_undertakings")]
    put("revenue", (sum(v or 0 for v in other) or None) if other != [None, None] else None)
    put("operating_profit", plus(["gross_profit"], ["distribution_costs", "admin_expenses",
                                                    "other_operating_income"], 1))
    put("profit_before_tax", plus(["operating_profit"], ["finance_income", "finance_costs"]))
    put("profit_after_tax", add("profit_before_tax", "tax_expense"))
    put("tax_expense", diff("profit_after_tax", "profit_before_tax"))
    put("total_fixed_assets", some(["intangible_assets", "goodwill", "tangible_fixed_assets",
                                    "right_of_use_assets", "investment_properties",
                                    "investments_fixed"], 2))
    put("total_current_assets", some(["inventories", "trade_receivables", "other_receivables",
                                      "cash", "short_term_investments"], 2))
    put("total_assets", add("total_fixed_assets", "total_current_assets"))
    put("total_liabilities", add("total_current_liabilities", "total_noncurrent_liabilities"))
    put("net_assets", add("total_assets", "total_liabilities"))
    put("total_equity", plus(["share_capital", "retained_earnings"],
                             ["share_premium", "other_reserves", "minority_interest"]))
    put("net_change_cash", diff("closing_cash", "opening_cash"))
    put("closing_cash", add("opening_cash", "net_change_cash"))
    return r, filled


def random_rows(n=300, seed=3):
    rnd = random.Random(seed)
    return [{"company_number": str(i), "year": 2020,
             **{f: float(rnd.randint(-50, 50)) for f in schemas.ROW_FIELDS
                if rnd.random() < 0.4}} for i in range(n)]


def test_fills_match_model(spark):
    rows = random_rows()
    got = {r.company_number: r for r in rules.fill_gaps(frame(spark, rows)).collect()}
    for row in rows:
        want, filled = model_fill(row)
        out = got[row["company_number"]]
        for f in schemas.STATEMENT_FIELDS:
            assert out[f] == want.get(f), (row, f)
        assert [a.field for a in out.gap_audit] == filled


def test_signs_are_idempotent_and_logged(spark):
    once = rules.normalise_signs(frame(spark, random_rows())).drop("sign_audit")
    twice = rules.normalise_signs(once)
    assert twice.where(F.size("sign_audit") > 0).count() == 0
    row = rules.normalise_signs(frame(spark, [
        {"company_number": "1", "year": 2020, "cost_of_sales": 5.0, "revenue": 9.0,
         "cash": -2.0}])).collect()[0]
    assert (row.cost_of_sales, row.revenue, row.cash) == (-5.0, 9.0, 2.0)
    assert {(a.field, a.original, a.corrected) for a in row.sign_audit} == {
        ("cost_of_sales", 5.0, -5.0), ("cash", -2.0, 2.0)}


def test_fill_never_overwrites(spark):
    rows = random_rows(seed=9)
    before = {r["company_number"]: r for r in rows}
    for r in rules.fill_gaps(frame(spark, rows)).collect():
        for f in schemas.STATEMENT_FIELDS:
            if before[r.company_number].get(f) is not None:
                assert r[f] == before[r.company_number][f]


def test_golden_balances(spark):
    rows = [{"company_number": "a", "year": 2022, "share_capital": 370.0,
             "retained_earnings": 13347.0},
            {"company_number": "a", "year": 2023, "share_capital": 370.0,
             "retained_earnings": 51384.0}]
    got = {r.year: r.total_equity for r in rules.compute(frame(spark, rows)).collect()}
    assert got == {2022: 13717.0, 2023: 51754.0}


def test_checks_and_ratios(spark):
    rows = [
        {"company_number": "bad", "year": 2020, "total_assets": 103.0,
         "total_liabilities": -0.0, "net_assets": 100.0},
        {"company_number": "ok", "year": 2020, "total_assets": 101.0,
         "total_liabilities": -0.0, "net_assets": 100.0},
        {"company_number": "ratio", "year": 2020, "revenue": 0.0, "gross_profit": 5.0,
         "operating_profit": 10.0, "net_cash_operating": 1.0, "capex_ppe": -5.0},
    ]
    got = {r.company_number: r for r in rules.compute(frame(spark, rows)).collect()}
    assert [f.rule for f in got["bad"].failed] == ["bs_balance"]
    assert got["ok"].failed == []
    assert got["ratio"].gross_margin_pct is None and got["ratio"].fcf == -4.0
    assert got["ratio"].cash_conversion is None


def test_as_of_growth(spark):
    h = spark.createDataFrame([("a", y, v) for y, v in (
        (2018, 100.0), (2020, 110.0), (2021, -1.0), (2023, 121.0))],
        "company_number string, year int, value double")
    r = growth.with_as_of(h, "value", 3).where("year = 2023").collect()[0]
    assert (r.base_year, r.base_value) == (2020, 110.0)
    assert growth.backfill_cagr(h).collect()[0].revenue_cagr_3y == round(1.1 ** (1 / 3) - 1, 4)
    yoy = growth.with_yoy(h, {"value": "g"}).where("year = 2020").collect()[0]
    assert abs(yoy.g - 0.1) < 1e-12


def test_newest_filing_is_order_independent(spark):
    cells = [("a", 2020, "cash", 1.0, 10), ("a", 2020, "cash", 2.0, 30),
             ("a", 2020, "cash", None, 40), ("a", 2021, "cash", 5.0, 20)]
    schema = "company_number string, year int, field string, value double, recency long"
    for rows in (cells, cells[::-1]):
        got = {r.year: r.value for r in facts.newest_filing(
            spark.createDataFrame(rows, schema)).collect()}
        assert got == {2020: 2.0, 2021: 5.0}
