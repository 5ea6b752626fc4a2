"""Field groups and table schemas shared by all operators."""

from pyspark.sql import types as T

# Canonical statement fields in presentation order.
INCOME_FIELDS = [
    "revenue", "cost_of_sales", "gross_profit", "distribution_costs", "admin_expenses",
    "other_operating_income", "income_from_group_undertakings", "employee_costs", "depreciation",
    "amortisation", "operating_profit", "finance_income", "finance_costs", "profit_before_tax",
    "tax_expense", "profit_after_tax",
]
BALANCE_FIELDS = [
    "intangible_assets", "goodwill", "tangible_fixed_assets", "right_of_use_assets",
    "investment_properties", "investments_fixed", "total_fixed_assets", "inventories",
    "trade_receivables", "other_receivables", "cash", "short_term_investments",
    "total_current_assets", "total_assets", "trade_payables", "other_payables",
    "short_term_borrowings", "long_term_borrowings", "lease_liabilities_noncurrent", "provisions",
    "pension_obligations", "total_current_liabilities", "total_noncurrent_liabilities",
    "total_liabilities", "net_assets", "share_capital", "share_premium", "retained_earnings",
    "other_reserves", "minority_interest", "total_equity",
]
CASH_FLOW_FIELDS = [
    "operating_cash_flow", "net_cash_operating", "capex_ppe", "capex_intangibles",
    "net_cash_investing", "repayment_borrowings", "proceeds_borrowings", "proceeds_disposal_ppe",
    "dividends_paid_cf", "lease_payments", "tax_paid", "net_cash_financing", "opening_cash",
    "closing_cash", "net_change_cash",
]
STATEMENT_FIELDS = INCOME_FIELDS + BALANCE_FIELDS + CASH_FLOW_FIELDS
ROW_FIELDS = STATEMENT_FIELDS + ["employees"]

# Metrics derived from one year, then those that compare years.
DERIVED_FIELDS = [
    "gross_margin_pct", "operating_margin_pct", "net_margin_pct", "ebitda", "ebitda_margin",
    "return_on_assets", "return_on_equity", "total_capex", "fcf", "cash_conversion",
    "capex_to_revenue", "net_debt", "net_debt_to_ebitda", "current_ratio", "quick_ratio",
    "debt_to_equity", "interest_cover", "asset_turnover", "revenue_per_employee",
    "profit_per_employee",
]
CROSS_PERIOD_FIELDS = [
    "revenue_yoy_growth", "ebitda_yoy_growth", "profit_yoy_growth", "revenue_cagr_3yr",
    "revenue_cagr_5yr",
]
# Cash-flow rows read from positioned tokens also carry the non-cash add-backs.
STATEMENT_OF_FIELD = {
    **{f: "income_statement" for f in INCOME_FIELDS},
    **{f: "balance_sheet" for f in BALANCE_FIELDS},
    **{f: "cash_flow_statement" for f in CASH_FLOW_FIELDS},
    "employees": "employees",
}

# Columns always written to the result table (null clears a stale value).
TYPED_COLUMNS = ["revenue", "ebitda", "ebitda_margin", "fcf", "cash_conversion", "employees"]
# Keys that only travel in the free-form metadata object, and only when present.
METADATA_COLUMNS = [
    "gross_margin_pct", "operating_margin_pct", "net_margin_pct", "return_on_assets",
    "return_on_equity", "total_capex", "capex_to_revenue", "net_debt", "net_debt_to_ebitda",
    "current_ratio", "quick_ratio", "debt_to_equity", "interest_cover", "asset_turnover",
    "revenue_per_employee", "profit_per_employee",
]

FACTS = T.StructType([
    T.StructField("company_number", T.StringType()),
    T.StructField("filing_id", T.StringType()),
    T.StructField("ord", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("ctx_id", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("scale", T.StringType()),
    T.StructField("decimals", T.StringType()),
    T.StructField("sign", T.StringType()),
    T.StructField("raw", T.StringType()),
])
CONTEXTS = T.StructType([
    T.StructField("filing_id", T.StringType()),
    T.StructField("ctx_id", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("ctx_type", T.StringType()),
    T.StructField("dimensional", T.BooleanType()),
    T.StructField("members", T.ArrayType(T.StringType())),
])
TOKENS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("x0", T.DoubleType()),
    T.StructField("y0", T.DoubleType()),
    T.StructField("x1", T.DoubleType()),
    T.StructField("y1", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("conf", T.DoubleType()),
    T.StructField("page_width", T.DoubleType()),
    T.StructField("page_height", T.DoubleType()),
])
COMPANIES = T.StructType([
    T.StructField("company_number", T.StringType(), False),
    T.StructField("company_name", T.StringType()),
    T.StructField("company_status", T.StringType()),
    T.StructField("accounts_category", T.StringType()),
    T.StructField("company_category", T.StringType()),
    T.StructField("sic_code_1", T.StringType()),
    T.StructField("sic_code_2", T.StringType()),
    T.StructField("incorporation_date", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("sub_sector", T.StringType()),
    T.StructField("pipeline_status", T.StringType()),
    T.StructField("filing_format", T.StringType()),
    T.StructField("last_accounts_date", T.DateType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("ebitda", T.DoubleType()),
    T.StructField("ebitda_margin", T.DoubleType()),
    T.StructField("fcf", T.DoubleType()),
    T.StructField("cash_conversion", T.DoubleType()),
    T.StructField("employees", T.IntegerType()),
    T.StructField("revenue_cagr_3y", T.DoubleType()),
    T.StructField("revenue_cagr_5y", T.DoubleType()),
    T.StructField("metadata", T.StringType()),
])
