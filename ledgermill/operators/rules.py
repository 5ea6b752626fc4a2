"""Ordered statement rules: signs, gap fills, derived metrics and checks.

Rules are column builders applied to one wide row per (company, year).  Nothing here
shuffles: a whole run is a stack of projections inside one code-generated stage.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions.numbers import (
    safe_div, sum_components, sum_required, sum_with_optional,
)

# Sign convention.
NEGATIVE_FIELDS = [
    "cost_of_sales", "distribution_costs", "admin_expenses", "finance_costs", "tax_expense",
    "depreciation", "amortisation", "employee_costs", "total_current_liabilities",
    "total_noncurrent_liabilities", "total_liabilities", "trade_payables", "other_payables",
    "short_term_borrowings", "long_term_borrowings", "lease_liabilities_noncurrent", "provisions",
    "pension_obligations", "capex_ppe", "capex_intangibles", "repayment_borrowings",
    "dividends_paid_cf", "lease_payments", "tax_paid", "net_cash_investing", "net_cash_financing",
]
POSITIVE_FIELDS = [
    "revenue", "gross_profit", "total_assets", "total_current_assets", "total_fixed_assets",
    "cash", "inventories", "trade_receivables", "net_assets", "total_equity", "share_capital",
    "proceeds_borrowings", "proceeds_disposal_ppe",
]

AUDIT_TYPE = ("struct<type:string,field:string,original:double,corrected:double,"
              "value:double,note:string>")


def c(name: str) -> Column:
    return F.col(name)


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def size_of(name: str) -> Column:
    return F.abs(or_zero(name))


class GapFill(NamedTuple):
    target: str
    note: str
    build: Callable[[], Column]


class Metric(NamedTuple):
    name: str
    requires: list[str]
    build: Callable[[], Column]


class Check(NamedTuple):
    name: str
    tolerance: float
    actual: Callable[[], Column]
    expected: str


def _fallback_revenue() -> Column:
    a, b = c("other_operating_income"), c("income_from_group_undertakings")
    total = or_zero("other_operating_income") + or_zero("income_from_group_undertakings")
    return F.when((a.isNotNull() | b.isNotNull()) & (total != 0), total)


GAP_FILLS = [
    GapFill("gross_profit", "revenue + cost_of_sales",
            lambda: sum_required(c("revenue"), c("cost_of_sales"))),
    GapFill("revenue", "gross_profit - cost_of_sales",
            lambda: c("gross_profit") - c("cost_of_sales")),
    GapFill("cost_of_sales", "gross_profit - revenue",
            lambda: c("gross_profit") - c("revenue")),
    GapFill("revenue", "other_operating_income + income_from_group_undertakings",
            _fallback_revenue),
    GapFill("operating_profit", "gross_profit + operating lines (at least 1)",
            lambda: sum_with_optional(
                [c("gross_profit")],
                [c("distribution_costs"), c("admin_expenses"), c("other_operating_income")], 1)),
    GapFill("profit_before_tax", "operating_profit + finance lines",
            lambda: sum_with_optional(
                [c("operating_profit")], [c("finance_income"), c("finance_costs")])),
    GapFill("profit_after_tax", "profit_before_tax + tax_expense",
            lambda: sum_required(c("profit_before_tax"), c("tax_expense"))),
    GapFill("tax_expense", "profit_after_tax - profit_before_tax",
            lambda: c("profit_after_tax") - c("profit_before_tax")),
    GapFill("total_fixed_assets", "sum of non-current components (at least 2)",
            lambda: sum_components([
                c("intangible_assets"), c("goodwill"), c("tangible_fixed_assets"),
                c("right_of_use_assets"), c("investment_properties"), c("investments_fixed")])),
    GapFill("total_current_assets", "sum of current components (at least 2)",
            lambda: sum_components([
                c("inventories"), c("trade_receivables"), c("other_receivables"), c("cash"),
                c("short_term_investments")])),
    GapFill("total_assets", "total_fixed_assets + total_current_assets",
            lambda: sum_required(c("total_fixed_assets"), c("total_current_assets"))),
    GapFill("total_liabilities", "total_current_liabilities + total_noncurrent_liabilities",
            lambda: sum_required(c("total_current_liabilities"),
                                 c("total_noncurrent_liabilities"))),
    GapFill("net_assets", "total_assets + total_liabilities",
            lambda: sum_required(c("total_assets"), c("total_liabilities"))),
    GapFill("total_equity", "share_capital + retained_earnings + other equity lines",
            lambda: sum_with_optional(
                [c("share_capital"), c("retained_earnings")],
                [c("share_premium"), c("other_reserves"), c("minority_interest")])),
    GapFill("net_change_cash", "closing_cash - opening_cash",
            lambda: c("closing_cash") - c("opening_cash")),
    GapFill("closing_cash", "opening_cash + net_change_cash",
            lambda: sum_required(c("opening_cash"), c("net_change_cash"))),
]

METRICS = [
    Metric("gross_margin_pct", [], lambda: safe_div(c("gross_profit"), c("revenue"))),
    Metric("operating_margin_pct", [], lambda: safe_div(c("operating_profit"), c("revenue"))),
    Metric("net_margin_pct", [], lambda: safe_div(c("profit_after_tax"), c("revenue"))),
    Metric("ebitda", [],
           lambda: c("operating_profit") + size_of("depreciation") + size_of("amortisation")),
    Metric("ebitda_margin", [], lambda: safe_div(c("ebitda"), c("revenue"))),
    Metric("return_on_assets", [], lambda: safe_div(c("profit_after_tax"), c("total_assets"))),
    Metric("return_on_equity", [], lambda: safe_div(c("profit_after_tax"), c("total_equity"))),
    Metric("total_capex", [], lambda: F.abs(c("capex_ppe")) + size_of("capex_intangibles")),
    Metric("fcf", [], lambda: c("net_cash_operating") - c("total_capex")),
    Metric("fcf", [], lambda: F.when(c("net_cash_operating").isNull(),
                                     c("operating_cash_flow") - c("total_capex"))),
    Metric("cash_conversion", [],
           lambda: F.when((c("ebitda") > 0) & (c("fcf") >= 0), safe_div(c("fcf"), c("ebitda")))),
    Metric("capex_to_revenue", [], lambda: safe_div(c("total_capex"), c("revenue"))),
    Metric("net_debt", [],
           lambda: size_of("short_term_borrowings") + size_of("long_term_borrowings")
           + size_of("lease_liabilities_noncurrent") - c("cash")
           - or_zero("short_term_investments")),
    Metric("net_debt_to_ebitda", [],
           lambda: F.when(c("ebitda") > 0, safe_div(c("net_debt"), c("ebitda")))),
    Metric("current_ratio", [], lambda: safe_div(F.abs(c("total_current_assets")),
                                                 F.abs(c("total_current_liabilities")))),
    Metric("quick_ratio", [], lambda: safe_div(c("total_current_assets") - or_zero("inventories"),
                                               F.abs(c("total_current_liabilities")))),
    Metric("debt_to_equity", [],
           lambda: safe_div(size_of("short_term_borrowings") + size_of("long_term_borrowings"),
                            c("total_equity"))),
    Metric("interest_cover", [],
           lambda: safe_div(c("operating_profit"), F.abs(c("finance_costs")))),
    Metric("asset_turnover", [], lambda: safe_div(c("revenue"), c("total_assets"))),
    Metric("revenue_per_employee", [], lambda: safe_div(c("revenue"), c("employees"))),
    Metric("profit_per_employee", [], lambda: safe_div(c("operating_profit"), c("employees"))),
]

CHECKS = [
    Check("bs_balance", 0.02, lambda: c("total_assets") + c("total_liabilities"), "net_assets"),
    Check("equity_balance", 0.02, lambda: c("net_assets"), "total_equity"),
    Check("pl_gross_profit", 0.02, lambda: c("revenue") + c("cost_of_sales"), "gross_profit"),
    Check("pl_profit_after_tax", 0.02, lambda: c("profit_before_tax") + c("tax_expense"),
          "profit_after_tax"),
    Check("cf_cash_movement", 0.02, lambda: c("opening_cash") + c("net_change_cash"),
          "closing_cash"),
    Check("cf_net_change", 0.05,
          lambda: c("net_cash_operating") + c("net_cash_investing") + c("net_cash_financing"),
          "net_change_cash"),
]


def _audit(entries: list[Column]) -> Column:
    return F.array_compact(F.array(*entries))


def _entry(kind: str, field: str, original=None, corrected=None, value=None,
           note: str | None = None) -> Column:
    null = F.lit(None).cast("double")
    return F.struct(
        F.lit(kind).alias("type"), F.lit(field).alias("field"),
        (null if original is None else original).alias("original"),
        (null if corrected is None else corrected).alias("corrected"),
        (null if value is None else value).alias("value"),
        F.lit(note).cast("string").alias("note"))


def normalise_signs(rows: DataFrame) -> DataFrame:
    """Force the sign convention; flips are listed in ``sign_audit``."""
    wrong = {f: c(f) > 0 for f in NEGATIVE_FIELDS} | {f: c(f) < 0 for f in POSITIVE_FIELDS}
    audit = _audit([
        F.when(bad, _entry("sign_correction", f, original=c(f), corrected=-c(f)))
        for f, bad in wrong.items()])
    fixed = {f: F.when(bad, -c(f)).otherwise(c(f)) for f, bad in wrong.items()}
    others = [x for x in rows.columns if x not in fixed]
    return rows.select(*others, *[e.alias(f) for f, e in fixed.items()],
                       audit.alias("sign_audit"))


def fill_gaps(rows: DataFrame) -> DataFrame:
    """Apply the gap fills in order; filled values are listed in ``gap_audit``.

    A rule sees the results of earlier rules and never overwrites a value.
    """
    out = rows
    fills = []
    for i, rule in enumerate(GAP_FILLS):
        fill = f"_fill{i}"
        out = out.withColumn(fill, F.when(c(rule.target).isNull(), rule.build()))
        out = out.withColumn(rule.target, F.coalesce(c(rule.target), c(fill)))
        fills.append((fill, rule))
    audit = _audit([
        F.when(c(fill).isNotNull(),
               _entry("gap_fill", r.target, value=c(fill), note=f"{r.target} = {r.note}"))
        for fill, r in fills])
    return out.withColumn("gap_audit", audit).drop(*[f for f, _ in fills])


def derive_metrics(rows: DataFrame) -> DataFrame:
    """Add the derived metrics in order; a metric already set is kept."""
    out = rows
    for m in METRICS:
        value = m.build()
        out = out.withColumn(
            m.name, F.coalesce(c(m.name), value) if m.name in out.columns else value)
    return out


def validate(rows: DataFrame) -> DataFrame:
    """Add ``failed``: the checks whose two sides differ by more than their tolerance."""
    entries = []
    for k in CHECKS:
        actual, expected = k.actual(), c(k.expected)
        diff = F.abs(actual - expected) / F.greatest(F.abs(expected), F.abs(actual), F.lit(1.0))
        entries.append(F.when(diff > k.tolerance, F.struct(
            F.lit(k.name).alias("rule"), F.round(expected, 4).alias("expected"),
            F.round(actual, 4).alias("actual"), F.round(diff, 4).alias("diff_pct"))))
    return rows.withColumn("failed", _audit(entries))


def compute(rows: DataFrame) -> DataFrame:
    """Signs, gap fills, metrics and checks for every (company, year) row."""
    return validate(derive_metrics(fill_gaps(normalise_signs(rows))))


def audit_log(computed: DataFrame) -> DataFrame:
    """Long audit table of a computed run."""
    both = F.concat(c("sign_audit"), c("gap_audit"))
    return computed.select("company_number", "year", F.explode(both).alias("a")).select(
        "company_number", "year", "a.*")


def failed_checks(computed: DataFrame) -> DataFrame:
    """Long table of failed checks."""
    return computed.select("company_number", "year", F.explode("failed").alias("f")).select(
        "company_number", "year", "f.*")


def display_columns(current: DataFrame) -> DataFrame:
    """Display form of current-year rows: ratios to four places, amounts as they are."""
    plain = ["revenue"]
    rounded = schemas.DERIVED_FIELDS
    return current.select(
        "company_number", "year", *plain, *[F.round(c(f), 4).alias(f) for f in rounded],
        c("employees").cast("int").alias("employees"))


def ebitda_method(depreciation: Column, amortisation: Column, ebitda: Column) -> Column:
    """How complete the inputs of EBITDA were; null when complete or not computed."""
    return F.when(ebitda.isNull(), None).when(
        depreciation.isNull() & amortisation.isNull(),
        "approximated (D&A unavailable, EBITDA = operating_profit)").when(
        amortisation.isNull(), "partial (amortisation unavailable, treated as 0)").when(
        depreciation.isNull(), "partial (depreciation unavailable, treated as 0)")


def legacy_fallbacks(current: DataFrame) -> DataFrame:
    """Margin and conversion from display values where the rules left them empty."""
    margin = F.when((c("revenue") != 0) & (c("ebitda") != 0),
                    F.round(safe_div(c("ebitda"), c("revenue")), 4))
    conversion = F.when((c("ebitda") > 0) & (c("fcf") >= 0),
                        F.round(safe_div(c("fcf"), c("ebitda")), 4))
    return current.withColumns({
        "ebitda_margin": F.coalesce("ebitda_margin", margin),
        "cash_conversion": F.coalesce("cash_conversion", conversion)})


def filing_measures(rows: DataFrame) -> DataFrame:
    """EBITDA and free cash flow as one filing states them, with their formulas."""
    dep, am = size_of("depreciation"), size_of("amortisation")
    ppe, intang = size_of("capex_ppe"), size_of("capex_intangibles")
    fmt = F.format_string
    return rows.withColumns({
        "filing_ebitda": c("operating_profit") + dep + am,
        "filing_fcf": c("operating_cash_flow") - (ppe + intang),
    }).withColumns({
        "ebitda_formula": F.when(c("filing_ebitda").isNotNull(), fmt(
            "operating_profit (%.0f) + |depreciation| (%.0f) + |amortisation| (%.0f)",
            c("operating_profit"), dep, am)),
        "fcf_formula": F.when(c("filing_fcf").isNotNull(), fmt(
            "operating_cash_flow (%.0f) - |capex_ppe| (%.0f) - |capex_intangibles| (%.0f)",
            c("operating_cash_flow"), ppe, intang)),
    })


def issue_flags(current: DataFrame) -> Column:
    """Names of the oddities of an extracted company."""
    flags = [
        ("no_revenue", c("revenue").isNull()),
        ("no_ebitda_with_revenue", c("ebitda").isNull() & c("revenue").isNotNull()),
        ("no_margin_with_ebitda", c("ebitda").isNotNull() & c("ebitda_margin").isNull()),
        ("ebitda_approx", ebitda_method(c("depreciation"), c("amortisation"),
                                        c("ebitda")).isNotNull()),
        ("cash_conv_zero_neg_fcf", (c("cash_conversion") == 0) & (c("fcf") < 0)),
        ("cash_conv_with_neg_ebitda", (c("ebitda") < 0) & c("cash_conversion").isNotNull()),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in flags]))


def roll_forward_checks(rows: DataFrame) -> DataFrame:
    """Retained-earnings roll-forward and profit-before-tax build-up of adjacent rows."""
    from pyspark.sql import Window as W

    by_year = W.partitionBy("company_number").orderBy("year")
    opening = F.lag("retained_earnings").over(by_year)
    build = (c("operating_profit") + or_zero("finance_income")
             + or_zero("finance_costs"))
    return rows.select(
        "company_number", "year",
        (opening + c("profit_after_tax") - c("retained_earnings")).alias("retained_gap"),
        (build - c("profit_before_tax")).alias("pbt_gap"))


def printed_checks(rows: DataFrame) -> DataFrame:
    """Checks of figures read off printed pages: absolute tolerance 1, cash tie within 1%.

    ``rows`` is wide with printed line items and cash-flow fields per (doc, year).
    """
    rev = F.coalesce(c("turnover"), c("revenue"))
    net = c("operating_cash_flow") + c("net_cash_investing") + c("net_cash_financing")
    bs_cash = F.coalesce(c("cash_at_bank"), c("cash_and_equivalents"))
    tests = [
        ("assets_less_liabilities_vs_funds",
         c("total_assets_less_current_liabilities") != c("shareholders_funds")),
        ("net_assets_vs_equity", c("net_assets") != c("total_equity")),
        ("gross_profit",
         (F.abs(rev + c("cost_of_sales") - c("gross_profit")) > 1)
         & (F.abs(rev - c("cost_of_sales") - c("gross_profit")) > 1)),
        ("cash_flow_total", F.abs(net - c("net_change_cash")) > 1),
        ("cash_movement",
         F.abs(c("opening_cash") + c("net_change_cash") - c("closing_cash")) > 1),
        ("cash_tie", (c("closing_cash") != 0)
         & (F.abs(c("closing_cash") - bs_cash)
            / F.greatest(F.abs(c("closing_cash")), F.lit(1.0)) > 0.01)),
    ]
    keys = [k for k in ("doc_id", "company_number", "year") if k in rows.columns]
    flags = F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in tests]))
    return rows.select(*keys, F.explode(flags).alias("failed_check"))
