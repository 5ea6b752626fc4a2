"""Views of the sample star-schema tables as filing-analytics inputs.

The sample tables hold no filings.  Each bridge maps rows one to one (or explodes them row
by row) onto one of our canonical inputs, so the work of every query grows with the tables.
The row arithmetic is written once as SQL expressions that Spark and the comparison engine
both accept, so both sides of a comparison start from the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators import facts as facts_ops
from ledgermill.sources.tables import spread

# (tag, canonical field or None): cycled over line items as fact names.
BRIDGE_TAGS = [
    ("core:TurnoverRevenue", "revenue"), ("core:Turnover", "revenue"),
    ("core:CostSales", "cost_of_sales"), ("core:CostOfSales", "cost_of_sales"),
    ("core:GrossProfitLoss", "gross_profit"), ("core:DistributionCosts", "distribution_costs"),
    ("core:AdministrativeExpenses", "admin_expenses"),
    ("core:OtherOperatingIncomeFormat1", "other_operating_income"),
    ("core:IncomeFromSharesInGroupUndertakings", "income_from_group_undertakings"),
    ("core:StaffCosts", "employee_costs"),
    ("core:DepreciationAmortisationExpense", "depreciation"),
    ("core:AmortisationExpense", "amortisation"),
    ("core:OperatingProfitLoss", "operating_profit"),
    ("core:ProfitLossFromOperatingActivities", "operating_profit"),
    ("core:InterestReceivableSimilarIncome", "finance_income"),
    ("core:InterestPayableAndSimilarCharges", "finance_costs"),
    ("core:ProfitLossBeforeTax", "profit_before_tax"), ("core:TaxOnProfit", "tax_expense"),
    ("core:ProfitLoss", "profit_after_tax"), ("core:IntangibleAssets", "intangible_assets"),
    ("core:GoodwillNet", "goodwill"), ("core:PropertyPlantAndEquipment", "tangible_fixed_assets"),
    ("core:RightOfUseAssets", "right_of_use_assets"),
    ("core:InvestmentProperty", "investment_properties"),
    ("core:FixedAssetInvestments", "investments_fixed"), ("core:FixedAssets", "total_fixed_assets"),
    ("core:NonCurrentAssets", "total_fixed_assets"), ("core:Stocks", "inventories"),
    ("core:TradeDebtors", "trade_receivables"), ("core:OtherDebtors", "other_receivables"),
    ("core:CashBankOnHand", "cash"), ("core:CashCashEquivalents", "cash"),
    ("core:CurrentAssetInvestments", "short_term_investments"),
    ("core:CurrentAssets", "total_current_assets"), ("core:TotalAssets", "total_assets"),
    ("core:TradeCreditors", "trade_payables"), ("core:OtherCreditors", "other_payables"),
    ("core:BankLoansOverdrafts", "short_term_borrowings"),
    ("core:BorrowingsDueAfterOneYear", "long_term_borrowings"),
    ("core:LeaseLiabilitiesNoncurrent", "lease_liabilities_noncurrent"),
    ("core:Provisions", "provisions"), ("core:PensionProvision", "pension_obligations"),
    ("core:CreditorsDueWithinOneYear", "total_current_liabilities"),
    ("core:CreditorsDueAfterOneYear", "total_noncurrent_liabilities"),
    ("core:TotalLiabilities", "total_liabilities"), ("core:NetAssetsLiabilities", "net_assets"),
    ("core:CalledUpShareCapital", "share_capital"), ("core:SharePremiumAccount", "share_premium"),
    ("core:ProfitAndLossAccount", "retained_earnings"), ("core:OtherReserves", "other_reserves"),
    ("core:MinorityInterest", "minority_interest"), ("core:ShareholdersFunds", "total_equity"),
    ("core:Equity", "total_equity"), ("core:CashGeneratedFromOperations", "operating_cash_flow"),
    ("core:NetCashFromOperatingActivities", "net_cash_operating"),
    ("core:PurchaseOfPropertyPlantAndEquipment", "capex_ppe"),
    ("core:PurchaseIntangibleAssets", "capex_intangibles"),
    ("core:NetCashUsedInInvestingActivities", "net_cash_investing"),
    ("core:RepaymentsOfBorrowings", "repayment_borrowings"),
    ("core:NewBorrowings", "proceeds_borrowings"),
    ("core:ProceedsSaleTangibleFixedAssets", "proceeds_disposal_ppe"),
    ("core:DividendsPaid", "dividends_paid_cf"), ("core:PaymentsForLeaseLiabilities", "lease_payments"),
    ("core:TaxPaid", "tax_paid"), ("core:NetCashUsedInFinancingActivities", "net_cash_financing"),
    ("core:CashCashEquivalentsAtBeginningOfPeriod", "opening_cash"),
    ("core:CashCashEquivalentsAtEndOfPeriod", "closing_cash"),
    ("core:ChangeInCashCashEquivalents", "net_change_cash"),
    ("core:AverageNumberEmployeesDuringPeriod", "employees"),
    ("core:UnlistedLine", None), ("ifrs:OtherComprehensiveLine", None), ("bus:NotMoney", None),
    ("ifrs:Revenue", "revenue"), ("UnqualifiedLine", None), ("Goodwill", "goodwill"),
]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def sql_list(values: list, duck: bool) -> str:
    items = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"[{items}]" if duck else f"array({items})"


def pick(values: list, index: str, duck: bool) -> str:
    """Element of a literal list by zero-based SQL index expression."""
    return f"{'list_extract' if duck else 'element_at'}({sql_list(values, duck)}, {index} + 1)"


def fact_columns(company: str, duck: bool) -> dict[str, str]:
    """Line item joined to its order, as one tagged fact."""
    q = "cast(l_quantity as int)"
    disc = "cast(round(l_discount * 100) as int)"
    tax = "cast(round(l_tax * 100) as int)"
    pounds = "cast(floor(l_extendedprice) as bigint)"
    commas = f"format('{{:,}}', {pounds})" if duck else f"format_number({pounds}, 0)"
    days = ("date_diff('day', date '1992-01-01', cast(l_shipdate as date))" if duck else
            "datediff(cast(l_shipdate as date), date '1992-01-01')")
    epoch = ("date_diff('day', date '1970-01-01', cast(o_orderdate as date))" if duck else
             "datediff(cast(o_orderdate as date), date '1970-01-01')")
    wide = "hugeint" if duck else "decimal(38,0)"
    wide_of = (lambda n: f"{n}::hugeint") if duck else (lambda n: f"cast({n} as decimal(20,0))")
    dim = "(l_returnflag = 'R' and l_linestatus = 'O')"
    one = (lambda v: f"['{v}']") if duck else (lambda v: f"array('{v}')")
    empty = "cast([] as varchar[])" if duck else "cast(array() as array<string>)"
    return {
        "company_number": f"cast({company} as string)",
        "filing_id": "cast(l_orderkey as string)",
        "filing_date": "cast(o_orderdate as date)",
        "recency": f"cast(cast({epoch} as {wide}) * {wide_of(10 ** 19)} + l_orderkey as {wide})",
        "ord": f"cast(((cast(l_linenumber as {wide}) * {wide_of(10 ** 12)} + l_partkey)"
               f" * {wide_of(10 ** 10)} + cast(round(l_extendedprice * 100) as bigint))"
               f" * {wide_of(10 ** 5)} + {days} as {wide})",
        "year": "cast(year(l_shipdate) as int)",
        "ctx_id": f"concat('c', cast(year(l_shipdate) as string), "
                  f"case when {dim} then 'd' else '' end)",
        "dimensional": dim,
        "members": f"case when not {dim} then {empty} when l_linenumber % 2 = 0 then "
                   f"{one('ConsolidatedGroup')} else {one('SegmentMember')} end",
        "name": pick([t for t, _ in BRIDGE_TAGS],
                     f"(({q} * 7 + l_linenumber) % {len(BRIDGE_TAGS)})", duck),
        "unit": f"case when {tax} = 8 then 'iso4217:USD' when {tax} = 7 then null "
                f"when {tax} = 6 then 'xbrli:pure' else 'iso4217:GBP' end",
        "scale": "case when l_linenumber = 7 then '3' when l_linenumber = 3 then '0' end",
        "decimals": f"case when {disc} = 4 then '-3' when {disc} = 5 then 'INF' else '2' end",
        "sign": f"case when {disc} in (1, 2) then '-' end",
        "raw": f"case when l_linenumber = 5 and {disc} = 10 then '-' else {commas} end",
    }


def dealt(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    """A sample table dealt out by key: a table in one small file would be one task's work."""
    return spread(table(spark, d, name), key, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fact_rows(spark: SparkSession, d: str, company: str = "l_suppkey") -> DataFrame:
    """Unparsed tagged facts; ``company`` picks the dense or sparse grouping."""
    joined = dealt(spark, d, "lineitem", "l_orderkey").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*[F.expr(e).alias(n) for n, e in fact_columns(company, False).items()])


def facts(spark: SparkSession, d: str, company: str = "l_suppkey") -> DataFrame:
    """Parsed, mapped, non-dimensional facts."""
    rows = facts_ops.plain_facts(fact_rows(spark, d, company))
    return facts_ops.map_tags(facts_ops.parse_values(rows))


def cells(spark: SparkSession, d: str, company: str = "l_suppkey") -> DataFrame:
    """Merged cells over all filings of a company."""
    return facts_ops.newest_filing(facts_ops.first_in_document(facts(spark, d, company)))


def statement_rows(spark: SparkSession, d: str, company: str = "l_suppkey") -> DataFrame:
    return facts_ops.statement_rows(cells(spark, d, company))


def contexts(spark: SparkSession, d: str) -> DataFrame:
    """Period contexts named by the facts of each filing."""
    rows = fact_rows(spark, d)
    return rows.groupBy("filing_id", "ctx_id").agg(
        F.min("year").alias("year"), F.bool_or("dimensional").alias("dimensional"))


FILING_COLUMNS = {
    "company_number": "cast(o_custkey as string)",
    "filing_id": "cast(o_orderkey as string)",
    "filing_seq": "o_orderkey",
    "type": "case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'AA' "
            "when o_orderpriority = '4-NOT SPECIFIED' then 'CS01' else 'AP01' end",
    "filing_date": "case when o_orderkey % 41 = 0 then null "
                   "else substring(cast(cast(o_orderdate as date) as string), 1, 10) end",
    "paper_filed": "o_orderstatus = 'P'",
    "metadata_url": "case when o_orderkey % 17 = 0 then null when o_orderkey % 3 = 0 then "
                    "concat('/document/', cast(o_orderkey as string)) else "
                    "concat('https://docs.example.org/document/', cast(o_orderkey as string)) end",
}


def filing_columns(duck: bool) -> dict[str, str]:
    both = sql_list(["application/pdf", "application/xhtml+xml"], duck)
    pdf = sql_list(["application/pdf"], duck)
    return {**FILING_COLUMNS,
            "resources": f"case when o_orderstatus = 'F' then {both} else {pdf} end"}


def filings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        *[F.expr(e).alias(n) for n, e in filing_columns(False).items()])


def history(spark: SparkSession, d: str) -> DataFrame:
    """(company_number, year, value): yearly totals, exact by decimal addition."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return table(spark, d, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("company_number"),
        F.year("o_orderdate").alias("year"),
    ).agg(F.sum(amount).cast("double").alias("value"))


REGISTER_COLUMNS = {
    " CompanyName": "case when c_custkey % 53 = 0 then 'nan' else concat(c_name, '_plc-', "
                    "n_name) end",
    "CompanyNumber": "lpad(cast(c_custkey as string), 8, '0')",
    "CompanyStatus ": "case c_mktsegment when 'BUILDING' then 'Liquidation' "
                      "when 'MACHINERY' then ' Active ' else 'Active' end",
    "Accounts.AccountCategory": "case c_custkey % 6 when 0 then ' small ' when 1 then 'Medium' "
                                "when 2 then 'LARGE' when 3 then 'DORMANT' when 4 then 'SMALL' "
                                "else 'TOTAL EXEMPTION FULL' end",
    "CompanyCategory": "case when c_custkey % 2 = 0 then 'Private Limited Company' "
                       "else 'Public-Limited_Company' end",
    "IncorporationDate": "concat(cast(1950 + c_nationkey as string), '-01-02')",
    "SICCode.SicText_1": "case when c_custkey % 9 = 0 then 'NaN' else concat(lpad(cast("
                         "(c_custkey * 37) % 100000 as string), 5, '0'), ' Activity-', "
                         "cast(c_nationkey as string)) end",
    "SICCode.SicText_2": "case when c_custkey % 4 = 0 then concat(lpad(cast("
                         "(c_custkey * 91) % 100000 as string), 5, '0'), ' Other') else '' end",
    "RegAddress.PostTown": "case when c_custkey % 5 = 0 then null else n_name end",
    "RegAddress.Country": "case when c_custkey % 7 = 0 then 'None' else 'UNITED-KINGDOM' end",
    "Mortgages.NumMortCharges": "case when c_custkey % 3 = 0 then null else "
                                "cast(c_nationkey as string) end",
    "Mortgages.NumMortOutstanding": "case when c_custkey % 4 = 1 then 'nan' else '2' end",
}


def register(spark: SparkSession, d: str) -> DataFrame:
    """Raw register snapshot: all strings, untidy headers and values."""
    joined = table(spark, d, "customer").join(
        F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(*[F.expr(e).cast("string").alias(n)
                           for n, e in REGISTER_COLUMNS.items()])


SIC_COLUMNS = {
    "company_number": "cast(p_partkey as string)",
    "sic_code_1": "case when p_partkey % 23 = 0 then 'EMPTY' when p_partkey % 29 = 0 then "
                  "'None Supplied' when p_partkey % 31 = 0 then '99999 Dormant Company' "
                  "when p_partkey % 37 = 0 then '2660 short' else concat(lpad(cast("
                  "(p_partkey * 377) % 100000 as string), 5, '0'), ' ', p_name) end",
    "sic_code_2": "case when p_size % 3 = 0 then concat(lpad(cast((p_partkey * 611) % 100000 "
                  "as string), 5, '0'), '  ', p_type) end",
    "sic_code_3": "case when p_size % 5 = 0 then '64209 Holding companies' end",
    "sic_code_4": "case when p_size % 7 = 0 then '62012 Business software' end",
}


def sic_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        *[F.expr(e).alias(n) for n, e in SIC_COLUMNS.items()])


# Companies as stored before a migration: half the values still sit in the JSON overflow.
COMPANY_COLUMNS = {
    "company_number": "cast(event_id as string)",
    "pipeline_status": "case when event_id % 3 = 0 then 'extracted' end",
    "filing_format": "case when event_id % 4 = 0 then 'ixbrl' end",
    "last_accounts_date": "cast(null as date)",
    "sic_code_1": "case when event_id % 6 = 0 then '62012' end",
    "metadata": "case when event_id % 11 = 0 then null else concat("
                "'{\"pipeline\":{\"status\":\"', event_type, '\",\"tries\":', "
                "cast(event_id % 5 as string), '},\"filing_format\":\"scanned_pdf\",', "
                "case when event_id % 7 = 0 then '' else concat('\"last_accounts_date\":\"', "
                "cast(cast(ts as date) as string), '\",') end, "
                "'\"sic_code_1\":\"', cast(user_id as string), '\",\"props\":', props, '}') end",
}
# A JSON patch per company: one overwrite, one nested object, one null, one new key.
PATCH_COLUMN = ("case when event_id % 13 = 0 then null else concat('{\"filing_format\":\"ixbrl\","
                "\"pipeline\":{\"status\":\"extracted\",\"run\":', cast(event_id % 9 as string), "
                "'},\"sic_code_1\":null,\"tags\":[1,2]}') end")


def companies(spark: SparkSession, d: str) -> DataFrame:
    return dealt(spark, d, "events", "event_id").select(
        *[F.expr(e).alias(n) for n, e in COMPANY_COLUMNS.items()],
        F.expr(PATCH_COLUMN).alias("patch"))


# --- positioned tokens ----------------------------------------------------
# Page headings, row labels and phrases cycled over the words of each document, so that
# prose pages also carry statements, contents pages, notes and sign-offs.
HEADINGS = [
    "STRATEGIC REPORT", "INCOME STATEMENT", "BALANCE SHEET", "CASH FLOW STATEMENT",
    "NOTES TO THE FINANCIAL STATEMENTS", "INDEPENDENT AUDITOR'S REPORT",
    "DIRECTORS' REPORT", "STATEMENT OF DIRECTORS' RESPONSIBILITIES", "Accounting policies",
    "Going concern", "EXAMPLE TRADING LIMITED 01234567", "BALANCE SHEET CONTINUED",
]
ROW_LABELS = [
    "Turnover", "Cost of sales", "Gross profit", "Administrative expenses", "Other",
    "Operating profit", "Tangible assets", "Debtors", "Cash at bank", "Creditors",
    "Called up share capital", "Net cash from operating activities", "Tax paid",
    "Cash and cash equivalents at beginning", "Depreciation charge for the year", "Staff costs",
    "Directors", "Production staff", "Average number", "Total assets", "Borrowings", "Trade and other payables",
    "3. Accounting policies",
]
PHRASES = [
    "", "in our opinion", "approved by the board of directors on", "section 444(4)", "FRS 102",
    "key audit matters", "pages 3 to 9", "year ended 31 March 2021", "small companies regime",
    "international financial reporting standards", "property, plant and equipment",
    "total equity", "average number of employees", "£'000", "",
]
TOKENS_PER_PAGE = 200


def token_columns(duck: bool) -> dict[str, str]:
    """Layout of word ``i`` (zero based) of document ``doc_id`` on its page."""
    # A page holds 20 lines of 10 columns; every fourth line sits close under the one above.
    line = "cast(floor((i % 200) / 10) as int)"
    col = "cast(i % 10 as int)"
    page = "cast(floor(i / 200) as int)"
    # One document in five repeats a heading over four pages, alone in the top band.
    repeats = "doc_id % 5 = 1"
    heading = pick(HEADINGS, f"cast((doc_id + case when {repeats} then cast(floor({page} / 4) as "
                             f"int) else {page} * 5 end) % {len(HEADINGS)} as int)", duck)
    contents = f"(doc_id % 4 = 0 and {page} = 1)"
    title = pick(HEADINGS[:10], f"cast((doc_id + {line}) % 10 as int)", duck)
    label = pick(ROW_LABELS, f"cast((doc_id * 3 + {page} * 7 + {line}) % {len(ROW_LABELS)} as int)",
                 duck)
    phrase = pick(PHRASES, f"cast((doc_id + {page} * 2 + {line}) % {len(PHRASES)} as int)", duck)
    whole = f"length(word) * 1000 + i % 977 + {col}"
    commas = f"format('{{:,}}', {whole})" if duck else f"format_number({whole}, 0)"
    number = (f"case cast((i + doc_id) % 7 as int) when 0 then concat('(', {commas}) when 1 then "
              f"replace({commas}, ',', '.') when 2 then '-' else {commas} end")
    year = f"cast(2015 + doc_id % 9 - case when {col} = 9 then 1 else 0 end as string)"
    text = (
        f"case when {line} = 0 and {col} = 0 then case when {contents} then 'CONTENTS' "
        f"else {heading} end "
        f"when {contents} and {col} = 0 then {title} "
        f"when {contents} and {col} = 9 then cast(1 + i % 5 as string) "
        f"when {line} = 0 and doc_id % 3 = 0 then upper(replace(word, 'ß', 'ss')) "
        f"when {line} = 1 and {col} in (7, 9) then {year} "
        f"when {col} = 0 then concat({label}, ' ', word) "
        f"when {col} = 2 and {line} = 10 then concat({phrase}, ' ', word) "
        f"when {col} in (7, 9) and {line} % 4 <> 2 then {number} "
        f"when {col} = 5 and doc_id % 2 = 0 then cast(1 + i % 29 as string) "
        f"else word end")
    y = (f"cast(20 + 38 * {line} - case when {line} % 4 = 3 then 21 else 0 end "
         f"+ ({col} % 3) * 2 + case when {repeats} and {line} = 0 and {col} > 0 then 30 else 0 end "
         "as double)")
    x = f"cast(30 + 50 * {col} as double)"
    return {
        "doc_id": "doc_id", "page": f"{page} + 1", "i": "cast(i as bigint)",
        "x0": x, "y0": y, "x1": f"{x} + 40", "y1": f"{y} + 10", "text": text,
        "conf": "cast(0.4 + (i % 60) / 100.0 as double)",
        "page_width": "cast(595 as double)", "page_height": "cast(842 as double)",
    }


def tokens(spark: SparkSession, d: str) -> DataFrame:
    """Every word of every document as a positioned token."""
    words = dealt(spark, d, "documents", "doc_id").select(
        "doc_id", F.posexplode(F.split("text", r"[ \t\n\r]+")).alias("i", "word"))
    return words.select(*[F.expr(e).alias(n) for n, e in token_columns(False).items()])


# --- body text with statutory headings ------------------------------------
BODY_HEADINGS = [
    "Strategic Report", "Some news", "Report of the Directors", "Section 172(1)",
    "Principal risks and uncertainties", "Viability statement", "Going concern",
    "Statement of Directors' Responsibilities", "Independent Auditor's Report",
    "Principal activities", "Basis of preparation", "Critical accounting judgements", "Other",
]


def body_expr(duck: bool) -> str:
    """Document text with a heading before every line."""
    n = len(BODY_HEADINGS)
    if duck:
        heads = sql_list(BODY_HEADINGS, True)
        return ("array_to_string(list_transform(string_split(text, chr(10)), lambda l, k: "
                f"list_extract({heads}, cast((doc_id + (k - 1) * 3) % {n} as int) + 1) "
                "|| chr(10) || l), chr(10))")
    heads = sql_list(BODY_HEADINGS, False)
    return (f"array_join(transform(split(text, '\\n'), (l, k) -> concat(element_at({heads}, "
            f"cast((doc_id + k * 3) % {n} as int) + 1), '\\n', l)), '\\n')")


def bodies(spark: SparkSession, d: str) -> DataFrame:
    return dealt(spark, d, "documents", "doc_id").select(
        F.col("doc_id").cast("string").alias("filing_id"),
        F.expr(body_expr(False)).alias("body_text"))


# --- tagged markup --------------------------------------------------------
# One small tagged document per order: three contexts, up to six facts, flags, narrative.
def markup_expr() -> str:
    """Tagged document of an order row (Spark side only; the comparison reads the columns)."""
    year = "cast(year(o_orderdate) as string)"
    prior = "cast(year(o_orderdate) - 1 as string)"
    key = "cast(o_orderkey as string)"
    pence = "cast(round(o_totalprice * 100) as bigint)"
    q = "'\"'"

    def fact(name, ctx, raw, attrs=""):
        return (f"concat('<td><ix:nonFraction name=\"{name}\" contextRef=\"{ctx}\" "
                f"unitRef=\"GBP\"{attrs}>', {raw}, '</ix:nonFraction></td>')")

    def note(name, value):
        return (f"concat('<p><ix:nonNumeric name=\"{name}\" contextRef=\"cur\">', {value}, "
                "'</ix:nonNumeric></p>')")

    context = ("concat('<xbrli:context id=\"{id}\"><xbrli:entity><xbrli:identifier>', " + key
               + ", '</xbrli:identifier>{seg}</xbrli:entity><xbrli:period>', {period}, "
                 "'</xbrli:period></xbrli:context>')")
    duration = (f"concat('<xbrli:startDate>', {year}, '-01-01</xbrli:startDate><xbrli:endDate>', "
                f"{year}, '-12-31</xbrli:endDate>')")
    instant = f"concat('<xbrli:instant>', {prior}, '-12-31</xbrli:instant>')"
    segment = ("<xbrli:segment><xbrldi:explicitMember dimension=\"core:D\">core:SegmentMember"
               "</xbrldi:explicitMember></xbrli:segment>")
    parts = [
        "'<html xmlns:core=\"http://xbrl.frc.org.uk/fr/2023-01-01/core\"><head><title>t</title>"
        "<style>p{margin:0}</style></head><body><ix:header><ix:references>'",
        f"case when o_orderkey % 10 = 0 then '' else concat('<link:schemaRef xlink:href=', {q}, "
        f"'http://xbrl.frc.org.uk/FRS-102/', cast(2018 + o_orderkey % 6 as string), "
        f"'-01-01/FRS-102.xsd', {q}, '/>') end",
        "'</ix:references><ix:resources>'",
        context.format(id="cur", seg="", period=duration),
        context.format(id="prv", seg="", period=instant),
        context.format(id="dim", seg=segment, period=duration),
        "'</ix:resources></ix:header><h1>Annual report</h1><table><tr>'",
        fact("core:TurnoverRevenue", "cur", f"format_number({pence}, 0)"),
        fact("core:TurnoverRevenue", "prv", "format_number(o_custkey, 0)", ' scale="3"'),
        fact("core:TurnoverRevenue", "dim", "'77'"),
        fact("core:Turnover", "cur", "'9'"),
        fact("core:TaxOnProfit", "cur", "format_number(o_custkey + 1, 0)", ' sign="-"'),
        fact("core:CashBankOnHand", "cur", "case when o_orderkey % 4 = 0 then '-' else " + key
             + " end", ' decimals="0"'),
        fact("core:OtherUnmappedLine", "cur", "'1'"),
        # a nil fact, numbers that are none, typographic blanks and references, a fact in a fact
        "'<td><ix:nonFraction name=\"core:CostSales\" contextRef=\"cur\" xsi:nil=\"true\"/></td>'",
        fact("core:DistributionCosts", "cur", "'7'"),
        fact("core:Provisions", "cur", "'5d'"),
        fact("core:Accruals", "cur", "'nan'"),
        fact("core:Stocks", "cur", f"concat('&#160;12&nbsp;', {key}, '&#xa0;')"),
        "'<td><ix:nonFraction name=\"core:FixedAssets\" contextRef=\"cur\">&#163; <b>'",
        fact("core:CurrentAssets", "cur", key).replace("<td>", "").replace("</td>", ""),
        "'</b></ix:nonFraction></td>'",
        "'</tr></table>'",
        note("bus:EntityDormantTruefalse", "case when o_orderkey % 9 = 0 then 'true' else '' end"),
        "case when o_orderkey % 2 = 0 then "
        + note("direp:StatementThatAccountsHaveBeenPreparedInAccordanceWithProvisions"
               "SmallCompaniesRegime", "'small'") + " else '' end",
        "case when o_orderkey % 6 = 0 then "
        + note("direp:StatementThatMembersHaveNotRequiredCompanyToObtainAnAudit", "'no audit'")
        + " else '' end",
        "case when o_orderkey % 5 = 0 then "
        + note("bus:ReportIncludesStrategicReportTruefalse", "'true'") + " else '' end",
        "case when o_orderkey % 7 = 0 then "
        + note("core:FinancialStatementsArePreparedOnGoing-concernBasisTruefalse", "'true'")
        + " else '' end",
        "case when o_orderkey % 8 = 0 then "
        + note("direp:EntityHasTakenExemptionUnderCompaniesActInNotPublishingItsOwn"
               "ProfitLossAccountTruefalse", "'true'") + " else '' end",
        "case when o_orderkey % 4 = 1 then "
        + note("bus:AccountsStatusAuditedOrUnaudited", "'audited'") + " else '' end",
        note("bus:DescriptionPrincipalActivities", f"concat('Trading in lot ', {key})"),
        "'<div><ix:nonNumeric name=\"core:RevenueRecognitionPolicy\" contextRef=\"cur\">Outer '",
        f"concat('<ix:nonNumeric name=\"core:ProvisionsPolicy\" contextRef=\"cur\">inner ', {key},"
        " '</ix:nonNumeric>')",
        "' tail</ix:nonNumeric></div>'",
        note("aurep:BasisForOpinionAuditorsOnEntity", "'basis &amp; grounds'"),
        note("aurep:OpinionAuditorsOnEntity", "'true and fair'"),
        note("core:SomethingElse", "'x'"),
        f"concat('<h2>Strategic report</h2><p>Plan ', {key}, '</p><h2>Going concern</h2>"
        "<p>We go on.</p>')",
        "'</body></html>'",
    ]
    return "concat(" + ", ".join(parts) + ")"


def markup(spark: SparkSession, d: str) -> DataFrame:
    """(company_number, filing_id, filing_date, recency, content): one document per order."""
    o = dealt(spark, d, "orders", "o_orderkey")
    date = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_custkey").cast("string").alias("company_number"),
        F.col("o_orderkey").cast("string").alias("filing_id"),
        date.alias("filing_date"), facts_ops.recency(date, F.col("o_orderkey")).alias("recency"),
        F.expr(markup_expr()).alias("content"))
