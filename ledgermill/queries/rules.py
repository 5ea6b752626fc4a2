"""Queries over the statement rules and growth measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions import numbers
from ledgermill.operators import growth, rules
from ledgermill.plans import bridge
from ledgermill.queries.base import query, sql, view

NEG, POS = rules.NEGATIVE_FIELDS, rules.POSITIVE_FIELDS


def _signed(src):
    fixes = [f"CASE WHEN {f} > 0 THEN -{f} ELSE {f} END AS {f}" for f in NEG]
    fixes += [f"CASE WHEN {f} < 0 THEN -{f} ELSE {f} END AS {f}" for f in POS]
    return f"SELECT * REPLACE ({', '.join(fixes)}) FROM {src}"


def _z(f):
    return f"coalesce({f}, 0)"


def _n(*fs):
    return " + ".join(f"(CASE WHEN {f} IS NULL THEN 0 ELSE 1 END)" for f in fs)


_FIXED = ("intangible_assets", "goodwill", "tangible_fixed_assets", "right_of_use_assets",
          "investment_properties", "investments_fixed")
_CURRENT = ("inventories", "trade_receivables", "other_receivables", "cash",
            "short_term_investments")
_FILLS = [
    ("gross_profit", "revenue + cost_of_sales"),
    ("revenue", "gross_profit - cost_of_sales"),
    ("cost_of_sales", "gross_profit - revenue"),
    ("revenue", "nullif(coalesce(other_operating_income, income_from_group_undertakings * 0)"
                " + coalesce(income_from_group_undertakings, 0), 0)"),
    ("operating_profit",
     f"CASE WHEN {_n('distribution_costs', 'admin_expenses', 'other_operating_income')} >= 1 THEN "
     f"gross_profit + {_z('distribution_costs')} + {_z('admin_expenses')}"
     f" + {_z('other_operating_income')} END"),
    ("profit_before_tax", f"operating_profit + {_z('finance_income')} + {_z('finance_costs')}"),
    ("profit_after_tax", "profit_before_tax + tax_expense"),
    ("tax_expense", "profit_after_tax - profit_before_tax"),
    ("total_fixed_assets",
     f"CASE WHEN {_n(*_FIXED)} >= 2 THEN {' + '.join(map(_z, _FIXED))} END"),
    ("total_current_assets",
     f"CASE WHEN {_n(*_CURRENT)} >= 2 THEN {' + '.join(map(_z, _CURRENT))} END"),
    ("total_assets", "total_fixed_assets + total_current_assets"),
    ("total_liabilities", "total_current_liabilities + total_noncurrent_liabilities"),
    ("net_assets", "total_assets + total_liabilities"),
    ("total_equity", f"share_capital + retained_earnings + {_z('share_premium')}"
                     f" + {_z('other_reserves')} + {_z('minority_interest')}"),
    ("net_change_cash", "closing_cash - opening_cash"),
    ("closing_cash", "opening_cash + net_change_cash"),
]
_METRICS = [
    {"gross_margin_pct": "gross_profit / nullif(revenue, 0)",
     "operating_margin_pct": "operating_profit / nullif(revenue, 0)",
     "net_margin_pct": "profit_after_tax / nullif(revenue, 0)",
     "ebitda": f"operating_profit + abs({_z('depreciation')}) + abs({_z('amortisation')})",
     "return_on_assets": "profit_after_tax / nullif(total_assets, 0)",
     "return_on_equity": "profit_after_tax / nullif(total_equity, 0)",
     "total_capex": f"abs(capex_ppe) + abs({_z('capex_intangibles')})",
     "net_debt": f"abs({_z('short_term_borrowings')}) + abs({_z('long_term_borrowings')})"
                 f" + abs({_z('lease_liabilities_noncurrent')}) - cash"
                 f" - {_z('short_term_investments')}",
     "current_ratio": "abs(total_current_assets) / nullif(abs(total_current_liabilities), 0)",
     "quick_ratio": f"(total_current_assets - {_z('inventories')})"
                    " / nullif(abs(total_current_liabilities), 0)",
     "debt_to_equity": f"(abs({_z('short_term_borrowings')}) + abs({_z('long_term_borrowings')}))"
                       " / nullif(total_equity, 0)",
     "interest_cover": "operating_profit / nullif(abs(finance_costs), 0)",
     "asset_turnover": "revenue / nullif(total_assets, 0)",
     "revenue_per_employee": "revenue / nullif(employees, 0)",
     "profit_per_employee": "operating_profit / nullif(employees, 0)"},
    {"ebitda_margin": "ebitda / nullif(revenue, 0)",
     "fcf": "coalesce(net_cash_operating, operating_cash_flow) - total_capex",
     "capex_to_revenue": "total_capex / nullif(revenue, 0)",
     "net_debt_to_ebitda": "CASE WHEN ebitda > 0 THEN net_debt / ebitda END"},
    {"cash_conversion": "CASE WHEN ebitda > 0 AND fcf >= 0 THEN fcf / ebitda END"},
]
_CHECKS = [
    ("bs_balance", 0.02, "total_assets + total_liabilities", "net_assets"),
    ("equity_balance", 0.02, "net_assets", "total_equity"),
    ("pl_gross_profit", 0.02, "revenue + cost_of_sales", "gross_profit"),
    ("pl_profit_after_tax", 0.02, "profit_before_tax + tax_expense", "profit_after_tax"),
    ("cf_cash_movement", 0.02, "opening_cash + net_change_cash", "closing_cash"),
    ("cf_net_change", 0.05, "net_cash_operating + net_cash_investing + net_cash_financing",
     "net_change_cash"),
]
for sfx in ("", "_s"):
    view(f"signed{sfx}", _signed(f"rows{sfx}"), f"rows{sfx}")
    prev = f"signed{sfx}"
    for i, (target, expr) in enumerate(_FILLS):
        view(f"fill{i}{sfx}", f"SELECT * REPLACE (coalesce({target}, {expr}) AS {target}) "
             f"FROM {prev}", prev)
        prev = f"fill{i}{sfx}"
    view(f"filled{sfx}", f"SELECT * FROM {prev}", prev)
    prev = f"filled{sfx}"
    for i, level in enumerate(_METRICS):
        view(f"metric{i}{sfx}", f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in level.items())} "
             f"FROM {prev}", prev)
        prev = f"metric{i}{sfx}"
    view(f"computed{sfx}", f"SELECT * FROM {prev}", prev)

def _half_up(x):
    """Four places, ties away from zero on the printed decimal, as Spark rounds."""
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(38, 18)), 4) AS double)"


FLIPPED = " UNION ALL ".join(
    [f"SELECT company_number, year, '{f}' AS field, {f} AS original FROM rows_s WHERE {f} > 0"
     for f in NEG]
    + [f"SELECT company_number, year, '{f}' AS field, {f} AS original FROM rows_s WHERE {f} < 0"
       for f in POS])
FAILED = " UNION ALL ".join(
    f"SELECT company_number, year, '{n}' AS rule, round({e}, 4) AS expected, "
    f"round({a}, 4) AS actual, "
    f"round(abs(({a}) - {e}) / greatest(abs({e}), abs({a}), 1), 4) AS diff_pct "
    f"FROM computed WHERE abs(({a}) - {e}) / greatest(abs({e}), abs({a}), 1) > {t}"
    for n, t, a, e in _CHECKS)


def computed(spark, d, company="l_suppkey"):
    return rules.compute(bridge.statement_rows(spark, d, company))


@query("r1_sign_normalisation", sql(
    f"SELECT company_number, year, {', '.join(NEG + POS)} FROM signed", "signed"))
def r1(spark, d):
    return rules.normalise_signs(bridge.statement_rows(spark, d)).select(
        "company_number", "year", *NEG, *POS)


@query("r1_sign_audit", sql(f"SELECT *, -original AS corrected FROM ({FLIPPED})", "rows_s"))
def r1_audit(spark, d):
    rows = rules.normalise_signs(bridge.statement_rows(spark, d, "o_custkey"))
    return rows.select("company_number", "year", F.explode("sign_audit").alias("a")).select(
        "company_number", "year", "a.field", "a.original", "a.corrected")


@query("r2_gap_fills", sql(
    f"SELECT company_number, year, {', '.join(schemas.STATEMENT_FIELDS)} FROM filled_s",
    "filled_s"))
def r2(spark, d):
    rows = rules.fill_gaps(rules.normalise_signs(bridge.statement_rows(spark, d, "o_custkey")))
    return rows.select("company_number", "year", *schemas.STATEMENT_FIELDS)


@query("r2_gap_fill_audit", sql(" UNION ALL ".join(
    f"SELECT a.company_number, a.year, '{t}' AS field, b.{t} AS value "
    f"FROM {'signed_s' if i == 0 else f'fill{i - 1}_s'} a JOIN fill{i}_s b "
    f"USING (company_number, year) WHERE a.{t} IS NULL AND b.{t} IS NOT NULL"
    for i, (t, _) in enumerate(_FILLS)), "filled_s"))
def r2_audit(spark, d):
    rows = rules.fill_gaps(rules.normalise_signs(bridge.statement_rows(spark, d, "o_custkey")))
    return rows.select("company_number", "year", F.explode("gap_audit").alias("a")).select(
        "company_number", "year", "a.field", "a.value")


@query("r3_derived_metrics", sql(
    f"SELECT company_number, year, {', '.join(schemas.DERIVED_FIELDS)} FROM computed",
    "computed"))
def r3(spark, d):
    return computed(spark, d).select("company_number", "year", *schemas.DERIVED_FIELDS)


@query("r4_validation_failures", sql(FAILED, "computed"))
def r4(spark, d):
    return rules.failed_checks(computed(spark, d))


@query("r5_compute_sparse", sql(
    f"SELECT company_number, year, {', '.join(schemas.DERIVED_FIELDS)}, net_assets, revenue "
    "FROM computed_s", "computed_s"))
def r5(spark, d):
    return computed(spark, d, "o_custkey").select(
        "company_number", "year", *schemas.DERIVED_FIELDS, "net_assets", "revenue")


@query("r6_display_columns", sql(
    "SELECT company_number, year, revenue, "
    + ", ".join(f"{_half_up(f)} AS {f}" for f in schemas.DERIVED_FIELDS)
    + ", cast(employees AS int) AS employees FROM computed QUALIFY year = max(year) OVER "
      "(PARTITION BY company_number)", "computed"))
def r6(spark, d):
    return rules.display_columns(growth.current_rows(
        computed(spark, d).drop("sign_audit", "gap_audit", "failed")))


def _cagr_sql(table, value, years, places=6):
    _rounded, _places = ("round(", f", {places})") if places else ("", "")
    return (f"SELECT c.company_number, c.year, CASE WHEN c.{value} > 0 THEN "
            f"{_rounded}pow(c.{value} / b.{value}, 1.0 / (c.year - b.year)) - 1{_places} END AS cagr "
            f"FROM {table} c LEFT JOIN {table} b ON b.company_number = c.company_number AND "
            f"b.year = (SELECT max(x.year) FROM {table} x WHERE x.company_number = "
            f"c.company_number AND x.{value} > 0 AND x.year <= c.year - {years})")


@query("r7_cross_period", sql(f"""
    SELECT l.company_number, l.year, round(l.ry, 4) AS revenue_yoy_growth,
           round(l.ey, 4) AS ebitda_yoy_growth, round(l.py, 4) AS profit_yoy_growth,
           round(a.cagr, 4) AS revenue_cagr_3yr, round(b.cagr, 4) AS revenue_cagr_5yr
    FROM (SELECT company_number, year,
            (revenue - lag(revenue) OVER w) / abs(nullif(lag(revenue) OVER w, 0)) AS ry,
            (ebitda - lag(ebitda) OVER w) / abs(nullif(lag(ebitda) OVER w, 0)) AS ey,
            (profit_after_tax - lag(profit_after_tax) OVER w)
              / abs(nullif(lag(profit_after_tax) OVER w, 0)) AS py,
            max(year) OVER (PARTITION BY company_number) AS cy
          FROM computed WINDOW w AS (PARTITION BY company_number ORDER BY year)) l
    JOIN ({_cagr_sql('computed', 'revenue', 3)}) a USING (company_number, year)
    JOIN ({_cagr_sql('computed', 'revenue', 5)}) b USING (company_number, year)
    WHERE l.year = l.cy""", "computed"))
def r7(spark, d):
    rows = computed(spark, d).select("company_number", "year", "revenue", "ebitda",
                                     "profit_after_tax")
    grown = growth.with_yoy(rows, {"revenue": "revenue_yoy_growth", "ebitda": "ebitda_yoy_growth",
                                   "profit_after_tax": "profit_yoy_growth"})
    grown = growth.with_cagr(grown, "revenue", 3, "revenue_cagr_3yr")
    grown = growth.with_cagr(grown, "revenue", 5, "revenue_cagr_5yr")
    current = growth.with_current_year(grown).where("year = current_year")
    return current.select("company_number", "year",
                          *[F.round(f, 4).alias(f) for f in schemas.CROSS_PERIOD_FIELDS])


@query("r8_legacy_fallbacks", sql("""
    SELECT company_number, year, round(ebitda / nullif(revenue, 0), 4) AS ebitda_margin,
           CASE WHEN ebitda > 0 AND fcf >= 0 THEN round(fcf / ebitda, 4) END AS cash_conversion
    FROM computed QUALIFY year = max(year) OVER (PARTITION BY company_number)""", "computed"))
def r8(spark, d):
    null = F.lit(None).cast("double")
    cur = growth.current_rows(computed(spark, d).select(
        "company_number", "year", "revenue", "ebitda", "fcf"))
    return rules.legacy_fallbacks(cur.withColumns(
        {"ebitda_margin": null, "cash_conversion": null})).select(
        "company_number", "year", "ebitda_margin", "cash_conversion")


@query("r9_filing_measures", sql("""
    SELECT company_number, year,
      operating_profit + abs(coalesce(depreciation, 0)) + abs(coalesce(amortisation, 0))
        AS filing_ebitda,
      operating_cash_flow - abs(coalesce(capex_ppe, 0)) - abs(coalesce(capex_intangibles, 0))
        AS filing_fcf,
      'operating_profit (' || cast(cast(operating_profit AS bigint) AS varchar)
        || ') + |depreciation| (' || cast(cast(abs(coalesce(depreciation, 0)) AS bigint) AS varchar)
        || ') + |amortisation| (' || cast(cast(abs(coalesce(amortisation, 0)) AS bigint) AS varchar)
        || ')' AS ebitda_formula
    FROM rows""", "rows"))
def r9(spark, d):
    return rules.filing_measures(bridge.statement_rows(spark, d)).select(
        "company_number", "year", "filing_ebitda", "filing_fcf", "ebitda_formula")


@query("r11_roll_forward_checks", sql("""
    SELECT company_number, year,
      lag(retained_earnings) OVER (PARTITION BY company_number ORDER BY year)
        + profit_after_tax - retained_earnings AS retained_gap,
      operating_profit + coalesce(finance_income, 0) + coalesce(finance_costs, 0)
        - profit_before_tax AS pbt_gap
    FROM computed""", "computed"))
def r11(spark, d):
    return rules.roll_forward_checks(computed(spark, d))


@query("r13_rows_split_and_joined", sql("""
    SELECT company_number, year, revenue, net_assets, closing_cash, employees FROM rows""",
                                        "rows"))
def r13(spark, d):
    from ledgermill.operators import facts as ops

    maps = ops.statement_maps(bridge.statement_rows(spark, d))
    inc = maps.select("company_number", F.explode("income_statement").alias("year", "i"),
                      "balance_sheet", "cash_flow_statement")
    flat = inc.select(
        "company_number", F.col("year").cast("int").alias("year"), "i.revenue",
        F.col("balance_sheet")[F.col("year")]["net_assets"].alias("net_assets"),
        F.col("cash_flow_statement")[F.col("year")]["closing_cash"].alias("closing_cash"))
    emp = bridge.cells(spark, d).where("field = 'employees'").select(
        "company_number", "year", F.col("value").alias("employees"))
    return flat.join(emp, ["company_number", "year"], "left")


@query("e2_current_year", sql("""
    SELECT company_number, year, max(year) OVER (PARTITION BY company_number) AS current_year
    FROM rows""", "rows"))
def e2(spark, d):
    return growth.with_current_year(bridge.statement_rows(spark, d)).select(
        "company_number", "year", "current_year")


@query("e3_yoy_growth", sql("""
    SELECT company_number, year, value, (value - lag(value) OVER w) / abs(nullif(lag(value)
      OVER w, 0)) AS value_yoy
    FROM history WINDOW w AS (PARTITION BY company_number ORDER BY year)""", "history"))
def e3(spark, d):
    return growth.with_yoy(bridge.history(spark, d), {"value": "value_yoy"})


@query("c13_as_of_base", sql("""
    SELECT c.company_number, c.year, b.year AS base_year, b.value AS base_value
    FROM history c LEFT JOIN history b ON b.company_number = c.company_number AND b.year =
      (SELECT max(x.year) FROM history x WHERE x.company_number = c.company_number
       AND x.value > 0 AND x.year <= c.year - 3)""", "history"))
def c13(spark, d):
    return growth.with_as_of(bridge.history(spark, d), "value", 3).select(
        "company_number", "year", "base_year", "base_value")


@query("e4_cagr_3y_5y", sql(f"""
    SELECT a.company_number, a.year, a.cagr AS cagr_3y, b.cagr AS cagr_5y
    FROM ({_cagr_sql('history', 'value', 3)}) a JOIN ({_cagr_sql('history', 'value', 5)}) b
    USING (company_number, year)""", "history"))
def e4(spark, d):
    h = growth.with_cagr(bridge.history(spark, d), "value", 3, "cagr_3y")
    return growth.with_cagr(h, "value", 5, "cagr_5y").select(
        "company_number", "year", F.round("cagr_3y", 6).alias("cagr_3y"),
        F.round("cagr_5y", 6).alias("cagr_5y"))


@query("e5_backfill_cagr", sql(f"""
    SELECT company_number, {_half_up('cagr')} AS revenue_cagr_3y
    FROM ({_cagr_sql('history', 'value', 3, None)}) QUALIFY year = max(year) OVER
      (PARTITION BY company_number)""", "history"))
def e5(spark, d):
    return growth.backfill_cagr(bridge.history(spark, d))


@query("e6_history_cagr", sql("""
    SELECT company_number, CASE WHEN max(year) > min(year) THEN round(pow(arg_max(value, year)
      / arg_min(value, year), 1.0 / (max(year) - min(year))) - 1, 4) END AS cagr
    FROM history GROUP BY company_number""", "history"))
def e6(spark, d):
    return growth.history_cagr(bridge.history(spark, d))


@query("h11_safe_division", sql("""
    SELECT company_number, year, revenue / nullif(employees - employees, 0) AS by_zero,
           revenue / nullif(employees, 0) AS per_head FROM rows""", "rows"))
def h11(spark, d):
    rows = bridge.statement_rows(spark, d)
    emp = F.col("employees")
    return rows.select("company_number", "year",
                       numbers.safe_div(F.col("revenue"), emp - emp).alias("by_zero"),
                       numbers.safe_div(F.col("revenue"), emp).alias("per_head"))


@query("h12_h13_h14_null_aware_sums", sql(f"""
    SELECT company_number, year, revenue + cost_of_sales AS required_sum,
      CASE WHEN {_n('share_premium', 'other_reserves')} >= 1 THEN share_capital
        + {_z('share_premium')} + {_z('other_reserves')} END AS optional_sum,
      CASE WHEN {_n(*_CURRENT)} >= 2 THEN {' + '.join(map(_z, _CURRENT))} END AS component_sum
    FROM rows_s""", "rows_s"))
def h12(spark, d):
    c = F.col
    return bridge.statement_rows(spark, d, "o_custkey").select(
        "company_number", "year",
        numbers.sum_required(c("revenue"), c("cost_of_sales")).alias("required_sum"),
        numbers.sum_with_optional([c("share_capital")],
                                  [c("share_premium"), c("other_reserves")], 1).alias(
            "optional_sum"),
        numbers.sum_components([c(f) for f in _CURRENT]).alias("component_sum"))


@query("h15_h25_display_format", sql("""
    SELECT company_number, year, '£' || format('{:,}', cast(revenue AS bigint)) AS revenue_text,
           round(gross_profit / nullif(revenue, 0), 4) AS gross_margin
    FROM computed""", "computed"))
def h15(spark, d):
    return computed(spark, d).select(
        "company_number", "year", numbers.money(F.col("revenue")).alias("revenue_text"),
        F.round("gross_margin_pct", 4).alias("gross_margin"))


@query("b21_issue_flags", sql("""
    SELECT company_number, concat_ws(',',
      CASE WHEN revenue IS NULL THEN 'no_revenue' END,
      CASE WHEN ebitda IS NULL AND revenue IS NOT NULL THEN 'no_ebitda_with_revenue' END,
      CASE WHEN ebitda IS NOT NULL AND ebitda_margin IS NULL THEN 'no_margin_with_ebitda' END,
      CASE WHEN ebitda IS NOT NULL AND (depreciation IS NULL OR amortisation IS NULL)
           THEN 'ebitda_approx' END,
      CASE WHEN cash_conversion = 0 AND fcf < 0 THEN 'cash_conv_zero_neg_fcf' END,
      CASE WHEN ebitda < 0 AND cash_conversion IS NOT NULL THEN 'cash_conv_with_neg_ebitda' END)
      AS issues
    FROM computed_s QUALIFY year = max(year) OVER (PARTITION BY company_number)""", "computed_s"))
def b21(spark, d):
    cur = growth.current_rows(computed(spark, d, "o_custkey").select(
        "company_number", "year", "revenue", "ebitda", "ebitda_margin", "depreciation",
        "amortisation", "cash_conversion", "fcf"))
    return cur.select("company_number", F.array_join(rules.issue_flags(cur), ",").alias("issues"))


@query("b22_ebitda_method", sql("""
    SELECT CASE WHEN ebitda IS NULL THEN NULL
      WHEN depreciation IS NULL AND amortisation IS NULL
        THEN 'approximated (D&A unavailable, EBITDA = operating_profit)'
      WHEN amortisation IS NULL THEN 'partial (amortisation unavailable, treated as 0)'
      WHEN depreciation IS NULL THEN 'partial (depreciation unavailable, treated as 0)' END
      AS method, count(*) AS n FROM computed_s GROUP BY 1""", "computed_s"))
def b22(spark, d):
    method = rules.ebitda_method(F.col("depreciation"), F.col("amortisation"), F.col("ebitda"))
    return computed(spark, d, "o_custkey").groupBy(method.alias("method")).agg(
        F.count("*").alias("n"))


@query("d31_batch_totals", sql("""
    SELECT count(*) AS companies, count(revenue) AS with_revenue, count(ebitda) AS with_ebitda,
      cast(sum(CASE WHEN revenue IS NULL OR ebitda IS NULL OR ebitda_margin IS NULL
        OR depreciation IS NULL OR amortisation IS NULL THEN 1 ELSE 0 END) AS bigint) AS with_issues
    FROM (SELECT * FROM computed_s QUALIFY year = max(year) OVER (PARTITION BY company_number))""",
                               "computed_s"))
def d31(spark, d):
    cur = growth.current_rows(computed(spark, d, "o_custkey").select(
        "company_number", "year", "revenue", "ebitda", "ebitda_margin", "depreciation",
        "amortisation", "cash_conversion", "fcf"))
    return cur.agg(F.count("*").alias("companies"), F.count("revenue").alias("with_revenue"),
                   F.count("ebitda").alias("with_ebitda"),
                   F.count_if(F.size(rules.issue_flags(cur)) > 0).alias("with_issues"))


@query("b20_typed_and_metadata_split", sql("""
    SELECT company_number, round(ebitda_margin, 4) AS ebitda_margin,
           (CASE WHEN return_on_assets IS NULL THEN 0 ELSE 1 END)
           + (CASE WHEN net_debt IS NULL THEN 0 ELSE 1 END) AS metadata_hits,
           net_debt AS net_debt
    FROM computed_s QUALIFY year = max(year) OVER (PARTITION BY company_number)""", "computed_s"))
def b20(spark, d):
    from ledgermill.operators import payload

    cur = growth.current_rows(computed(spark, d, "o_custkey").drop(
        "sign_audit", "gap_audit", "failed"))
    split = payload.split_payload(rules.display_columns(cur))
    has = [F.get_json_object("metadata_patch", f"$.{k}").isNotNull().cast("int")
           for k in ("return_on_assets", "net_debt")]
    return split.select(
        "company_number", "ebitda_margin",
        F.coalesce(has[0] + has[1], F.lit(0)).alias("metadata_hits"),
        F.get_json_object("metadata_patch", "$.net_debt").cast("double").alias("net_debt"))


@query("b19_usable_filings", sql(f"""
    SELECT company_number, filing_id FROM facts_s
    WHERE field IN ({', '.join(repr(x) for x in schemas.INCOME_FIELDS + schemas.BALANCE_FIELDS)})
    GROUP BY 1, 2""", "facts_s"))
def b19(spark, d):
    usable = F.bool_or(F.col("field").isin(schemas.INCOME_FIELDS + schemas.BALANCE_FIELDS)
                       & F.col("value").isNotNull())
    return bridge.facts(spark, d, "o_custkey").groupBy("company_number", "filing_id").agg(
        usable.alias("usable")).where("usable").drop("usable")


@query("a0_latest_overview", sql("""
    SELECT company_number, year, revenue, ebitda_margin, ry AS revenue_yoy FROM (
      SELECT *, (revenue - lag(revenue) OVER w) / abs(nullif(lag(revenue) OVER w, 0)) AS ry
      FROM computed WINDOW w AS (PARTITION BY company_number ORDER BY year))
    QUALIFY year = max(year) OVER (PARTITION BY company_number)""", "computed"))
def overview(spark, d):
    """Latest-year revenue, EBITDA margin and revenue growth per company."""
    rows = computed(spark, d).select("company_number", "year", "revenue", "ebitda_margin")
    grown = growth.with_yoy(rows, {"revenue": "revenue_yoy"})
    return growth.current_rows(grown)


@query("e17_ordered_output", sql("""
    SELECT company_number, year, value FROM history ORDER BY value DESC, company_number, year
    LIMIT 50""", "history"))
def e17(spark, d):
    return bridge.history(spark, d).orderBy(F.desc("value"), "company_number", "year").limit(50)
