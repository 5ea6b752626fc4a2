"""Queries over positioned tokens: clustering, page text, page roles, printed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import lookups
from ledgermill.functions import numbers, text
from ledgermill.operators import rules
from ledgermill.operators import tokens as ops
from ledgermill.plans import bridge
from ledgermill.queries.base import query, select_list, sql, view

_N = r"regexp_replace(trim(text), '[^0-9(),.\-–— £$]', '', 'g')"
IS_NUM = (f"(trim(text) IN ('-', '–', '—', '.', 'nil', 'Nil', 'NIL') OR "
          f"(regexp_matches(text, '[0-9]') AND length({_N}) / length(trim(text)) >= 0.8))")
_BARE = "translate(trim(text), '() £$', '')"
_DIG = f"translate({_BARE}, ',.', '')"
NUM = (f"(CASE WHEN {_BARE} IN ('-', '–', '—', '', '.') THEN 0 ELSE "
       f"(CASE WHEN starts_with(trim(text), '(') THEN -1 ELSE 1 END) * "
       f"(CASE WHEN regexp_matches({_DIG}, '^-?[0-9]+$') THEN try_cast({_DIG} AS bigint) "
       f"ELSE cast(trunc(try_cast(translate({_BARE}, ',', '') AS double)) AS bigint) END) END)")

view("words", r"""
    SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM
      (SELECT doc_id, regexp_split_to_array(text, '[ \t\n\r]+') AS w FROM documents)""")
view("tok0", f"SELECT {select_list(bridge.token_columns(True))} FROM words", "words")
view("tok", f"""SELECT *, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, {IS_NUM} AS is_num,
    CASE WHEN {IS_NUM} THEN {NUM} END AS v FROM tok0""", "tok0")
view("pg", """
    SELECT doc_id, page, string_agg(text, ' ' ORDER BY y, x, text) AS text, avg(conf) AS quality,
      coalesce(string_agg(text, ' ' ORDER BY y, x, text) FILTER (y <= page_height * 0.05), '')
        AS top05,
      coalesce(string_agg(text, ' ' ORDER BY y, x, text) FILTER (y <= page_height * 0.15), '')
        AS top15,
      coalesce(string_agg(text, ' ' ORDER BY y, x, text) FILTER (y <= page_height * 0.25), '')
        AS top25, count(*) FILTER (y <= page_height * 0.25) AS n25,
      count(*) FILTER (y <= page_height * 0.25 AND upper(text) = text AND lower(text) <> text)
        AS caps25
    FROM tok GROUP BY 1, 2""", "tok")


def _any(col, phrases):
    return "(" + " OR ".join(f"contains({col}, '{p}')" for p in phrases) + ")"


view("pflags", f"""
    SELECT doc_id, page, (contains(upper(text), 'OPTED NOT TO DELIVER') AND
        contains(upper(text), 'PROFIT AND LOSS')) OR contains(upper(text), 'SECTION 444(4)') AS f,
      {_any('upper(top15)', ops.INCOME_TITLES)} AND
        NOT contains(upper(text), 'OPTED NOT TO DELIVER') AS inc,
      {_any('upper(top15)', ops.BALANCE_TITLES)} AND NOT contains(upper(top15), 'CONTINUED') AS bal,
      {_any('upper(top15)', ops.CASH_TITLES)} AND NOT contains(upper(top15), 'CONTINUED') AS cf,
      contains(upper(top15), 'NOTES TO THE') AND contains(upper(top15), 'FINANCIAL STATEMENTS')
        AS nt, contains(upper(top25), 'CONTENTS') AS toc FROM pg""", "pg")
view("r1", """SELECT doc_id, bool_or(f) AS filleted,
    CASE WHEN NOT bool_or(f) THEN min(page) FILTER (inc AND NOT toc) END AS income_page
    FROM pflags GROUP BY 1""", "pflags")
view("r2", """SELECT r1.doc_id, filleted, income_page, min(page) FILTER (bal AND NOT toc AND
    page IS DISTINCT FROM income_page) AS balance_page
    FROM r1 JOIN pflags USING (doc_id) GROUP BY 1, 2, 3""", "r1")
view("r3", """SELECT r2.doc_id, filleted, income_page, balance_page, min(page) FILTER (cf AND
    NOT toc AND page IS DISTINCT FROM income_page AND page IS DISTINCT FROM balance_page)
    AS cashflow_page FROM r2 JOIN pflags USING (doc_id) GROUP BY 1, 2, 3, 4""", "r2")
view("notepages", """SELECT doc_id, page FROM r3 JOIN pflags USING (doc_id) WHERE nt AND NOT toc
    AND page IS DISTINCT FROM income_page AND page IS DISTINCT FROM balance_page
    AND page IS DISTINCT FROM cashflow_page""", "r3")
view("stpages", """
    SELECT doc_id, 'income_statement' AS statement, income_page AS page FROM r3
      WHERE income_page IS NOT NULL
    UNION ALL SELECT doc_id, 'balance_sheet', balance_page FROM r3 WHERE balance_page IS NOT NULL
    UNION ALL SELECT doc_id, 'cash_flow_statement', cashflow_page FROM r3
      WHERE cashflow_page IS NOT NULL
    UNION ALL SELECT doc_id, 'notes', page FROM notepages""", "notepages")
view("docyears", """
    SELECT doc_id, max(yr) AS current_year, max(yr) FILTER (rk = 2) AS prior_year FROM (
      SELECT DISTINCT t.doc_id, cast(trim(text) AS int) AS yr, dense_rank() OVER
        (PARTITION BY t.doc_id ORDER BY trim(text) DESC) AS rk
      FROM tok t JOIN (SELECT DISTINCT doc_id, page FROM stpages WHERE statement <> 'notes') s
      ON t.doc_id = s.doc_id AND t.page = s.page
      WHERE regexp_full_match(trim(text), '20[0-9]{2}')) GROUP BY 1""", "tok", "stpages")
view("joined", "SELECT doc_id, string_agg(text, ' ' ORDER BY page) AS text, max(page) AS last "
     "FROM pg GROUP BY 1", "pg")
_ESC = [p.replace("'", "''") for p in lookups.UKGAAP_SIGNALS]
view("dialects", "SELECT doc_id, CASE WHEN "
     + " + ".join(f"max(contains(lower(text), '{p}')::int)" for p in lookups.IFRS_SIGNALS) + " > "
     + " + ".join(f"max(contains(lower(text), '{p}')::int)" for p in _ESC)
     + " THEN 'ifrs' ELSE 'uk_gaap' END AS dialect FROM joined GROUP BY 1", "joined")
view("notecol", """
    SELECT doc_id, page, avg(x) AS note_x FROM tok WHERE is_num AND v BETWEEN 1 AND 30
      AND x > page_width * 0.35 AND x < page_width * 0.55 GROUP BY 1, 2
    HAVING count(*) >= 2 AND max(x) - min(x) < 30""", "tok")
view("ctok", """
    SELECT t.*, note_x, current_year, prior_year,
      coalesce(v = current_year OR v = prior_year, false) AS is_year,
      coalesce(abs(x - note_x) < 25, false) AS near_note
    FROM tok t JOIN (SELECT DISTINCT doc_id, page FROM stpages) s USING (doc_id, page)
    LEFT JOIN notecol USING (doc_id, page) LEFT JOIN docyears USING (doc_id)""",
     "tok", "stpages", "notecol", "docyears")
view("xclus", """
    SELECT doc_id, page, k, avg(x) AS cx, max(page_width) AS w FROM (
      SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY x) AS k
      FROM (SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY doc_id, page ORDER BY x) > 60
              THEN 1 ELSE 0 END AS new
            FROM ctok WHERE is_num AND abs(v) > 50 AND NOT coalesce(is_year, false)
              AND x > page_width * 0.4 AND NOT near_note)) GROUP BY 1, 2, 3""", "ctok")
view("vcols", """
    SELECT doc_id, page,
      CASE WHEN n <= 2 THEN cs[1] ELSE list_sum(cs[1:n // 2]) / (n // 2) END AS c1,
      CASE WHEN n = 1 THEN w * 0.85 WHEN n = 2 THEN cs[2]
        ELSE list_sum(cs[n // 2 + 1:]) / (n - n // 2) END AS c2
    FROM (SELECT doc_id, page, list(cx ORDER BY cx) AS cs, count(*) AS n, max(w) AS w
          FROM xclus GROUP BY 1, 2)""", "xclus")
view("ztok", """
    SELECT *, CASE WHEN x < page_width * 0.4 THEN 'label' WHEN near_note THEN 'note'
        WHEN x < (c1 + c2) / 2 THEN 'c1' ELSE 'c2' END AS zone,
      sum(new) OVER (PARTITION BY doc_id, page ORDER BY y, x, text ROWS UNBOUNDED PRECEDING) AS row
    FROM (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY doc_id, page ORDER BY y, x, text) > 20
            THEN 1 ELSE 0 END AS new FROM ctok JOIN vcols USING (doc_id, page))""",
     "ctok", "vcols")
view("trows", """
    SELECT doc_id, page, row,
      coalesce(lower(trim(string_agg(text, ' ' ORDER BY x, y, text) FILTER (zone = 'label'))), '')
        AS label,
      count(*) FILTER (is_num AND zone IN ('c1', 'c2')) AS n_numbers,
      list(v ORDER BY y DESC, x DESC, text DESC)
        FILTER (zone = 'c1' AND is_num AND NOT is_year AND v IS NOT NULL)[1] AS v1,
      list(v ORDER BY y DESC, x DESC, text DESC)
        FILTER (zone = 'c2' AND is_num AND NOT is_year AND v IS NOT NULL)[1] AS v2
    FROM ztok GROUP BY 1, 2, 3""", "ztok")
_LISTS = [("income_statement", "uk_gaap", lookups.INCOME_LABELS_UKGAAP),
          ("income_statement", "ifrs", lookups.INCOME_LABELS_IFRS),
          ("balance_sheet", "uk_gaap", lookups.BALANCE_LABELS_UKGAAP),
          ("balance_sheet", "ifrs", lookups.BALANCE_LABELS_IFRS),
          ("cash_flow_statement", "uk_gaap", lookups.CASHFLOW_LABELS),
          ("cash_flow_statement", "ifrs", lookups.CASHFLOW_LABELS),
          ("notes", "uk_gaap", lookups.NOTES_LABELS), ("notes", "ifrs", lookups.NOTES_LABELS)]
view("labels_", "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{d}', {i}, '{p}', '{f}')" for s, d, entries in _LISTS
    for i, (p, f) in enumerate(entries)) + ") t(statement, dialect, ord, pattern, field)")
view("lrows", """
    SELECT r.*, s.statement, d.dialect,
      (SELECT arg_min(field, ord) FROM labels_ l WHERE l.statement = s.statement
        AND l.dialect = d.dialect AND contains(r.label, l.pattern)) AS own,
      (SELECT list(DISTINCT field) FROM labels_ l WHERE l.statement = s.statement
        AND l.dialect = d.dialect AND contains(r.label, l.pattern)) AS named
    FROM trows r JOIN stpages s USING (doc_id, page) JOIN dialects d USING (doc_id)""",
     "trows", "stpages", "dialects", "labels_")
view("krows", """
    SELECT *, CASE WHEN label <> '' AND n_numbers = 0 THEN
        CASE WHEN own IS NOT NULL AND len(list_filter(coalesce(nxt, []), lambda f: f <> own)) > 0
          THEN 'nil' ELSE 'carry' END
        WHEN n_numbers > 0 THEN 'value' ELSE 'blank' END AS kind
    FROM (SELECT *, lead(named) OVER (PARTITION BY doc_id, page, statement ORDER BY row) AS nxt
          FROM lrows)""", "lrows")
view("crows", """
    SELECT *, CASE WHEN kind = 'nil' THEN label ELSE trim(coalesce(string_agg(
        CASE WHEN label <> '' THEN label END, ' ') OVER (PARTITION BY doc_id, page, statement,
        island ORDER BY row ROWS UNBOUNDED PRECEDING), '')) END AS full_label
    FROM (SELECT *, coalesce(sum(CASE WHEN kind = 'carry' THEN 0 ELSE 1 END) OVER
            (PARTITION BY doc_id, page, statement ORDER BY row
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM krows)""",
     "krows")
view("pfacts", """
    SELECT doc_id, statement, printed_field, cur AS current, pri AS prior, page * 1000000 + row AS place FROM (
      SELECT *, (SELECT arg_min(field, ord) FROM labels_ l WHERE l.statement = c.statement
          AND l.dialect = c.dialect AND contains(c.full_label, l.pattern)) AS printed_field,
        CASE WHEN kind = 'nil' THEN 0 ELSE v1 END AS cur,
        CASE WHEN kind = 'nil' THEN 0 ELSE v2 END AS pri
      FROM crows c WHERE kind IN ('nil', 'value'))
    WHERE printed_field IS NOT NULL AND (cur IS NOT NULL OR pri IS NOT NULL)
    QUALIFY row_number() OVER (PARTITION BY doc_id, statement, printed_field
      ORDER BY page DESC, row DESC) = 1""", "crows", "labels_")


def _pages(spark, d):
    return ops.page_text(bridge.tokens(spark, d))


def _prepared(spark, d):
    t = bridge.tokens(spark, d)
    docs = ops.documents(ops.page_text(t))
    return t, docs, ops.statement_pages(docs)


def _facts(spark, d):
    t, _, roles = _prepared(spark, d)
    return ops.printed_facts(t, roles)


@query("h3_h4_printed_numbers", sql("""
    SELECT doc_id, count(*) AS n, sum(v)::bigint AS total, count(*) FILTER (v < 0) AS negatives,
           count(*) FILTER (v = 0) AS zeros FROM tok WHERE is_num GROUP BY 1""", "tok"))
def h3(spark, d):
    t = ops.number_tokens(bridge.tokens(spark, d))
    v = numbers.printed_number(F.col("text"))
    return t.withColumn("v", v).groupBy("doc_id").agg(
        F.count("*").alias("n"), F.sum("v").alias("total"),
        F.count_if(F.col("v") < 0).alias("negatives"), F.count_if(F.col("v") == 0).alias("zeros"))


@query("d21_d22_page_text", sql("""
    SELECT doc_id, page, md5(text) AS text_hash, round(quality, 6) AS quality FROM pg""", "pg"))
def d21(spark, d):
    return _pages(spark, d).select("doc_id", "page", F.md5("text").alias("text_hash"),
                                   F.round("quality", 6).alias("quality"))


@query("h21_h22_top_bands", sql("""
    SELECT doc_id, page, upper(top05) AS top05, md5(top15) AS top15, md5(top25) AS top25,
           n25, caps25, contains(upper(top25), 'CONTENTS')::int AS is_contents
    FROM (SELECT * REPLACE (translate(top05, 'ßẞ', 'ss') AS top05) FROM pg)""", "pg"))
def h21(spark, d):
    p = ops.with_band_flags(_pages(spark, d))
    return p.select("doc_id", "page",
                    F.upper(F.translate("top05", "ßẞ", "ss")).alias("top05"),
                    F.md5("top15").alias("top15"), F.md5("top25").alias("top25"), "n25", "caps25",
                    F.col("is_contents").cast("int").alias("is_contents"))


@query("e7_column_clusters", sql("""
    SELECT doc_id, page, count(DISTINCT k)::bigint AS clusters, count(*) AS n FROM (
      SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY x) AS k
      FROM (SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY doc_id, page ORDER BY x) > 60
              THEN 1 ELSE 0 END AS new FROM tok WHERE is_num)) GROUP BY 1, 2""", "tok"))
def e7(spark, d):
    t = ops.number_tokens(ops.with_centres(bridge.tokens(spark, d)))
    return ops.islands(t, ops.PAGE, "x", ops.COLUMN_GAP, "k").groupBy(*ops.PAGE).agg(
        (F.max("k") + 1).cast("bigint").alias("clusters"), F.count("*").alias("n"))


def _rows_sql(gap):
    return sql(f"""
    SELECT doc_id, page, row, count(*) AS n, min(y) AS top FROM (
      SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY y)
        AS row FROM (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY doc_id, page ORDER BY y)
        > {gap} THEN 1 ELSE 0 END AS new FROM tok)) GROUP BY 1, 2, 3""", "tok")


@query("e8_chained_rows_20", _rows_sql(20))
def e8(spark, d):
    t = ops.with_centres(bridge.tokens(spark, d))
    return ops.islands(t, ops.PAGE, "y", ops.ROW_GAP, "row").groupBy(*ops.PAGE, "row").agg(
        F.count("*").alias("n"), F.min("y").alias("top"))


@query("e8_chained_rows_15", _rows_sql(15))
def e8b(spark, d):
    t = ops.with_centres(bridge.tokens(spark, d))
    return ops.islands(t, ops.PAGE, "y", ops.CONTENTS_ROW_GAP, "row").groupBy(
        *ops.PAGE, "row").agg(F.count("*").alias("n"), F.min("y").alias("top"))


@query("e9_anchored_rows", "WITH RECURSIVE " + sql("""
    SELECT doc_id, page, row, count(*) AS n, min(t.y) AS top FROM tok t JOIN (
      WITH RECURSIVE ys AS (SELECT DISTINCT doc_id, page, y, dense_rank() OVER
          (PARTITION BY doc_id, page ORDER BY y) AS k FROM tok),
      f AS (SELECT doc_id, page, y, k, y AS anchor, 0 AS row FROM ys WHERE k = 1
        UNION ALL SELECT ys.doc_id, ys.page, ys.y, ys.k,
          CASE WHEN ys.y - f.anchor > 20 THEN ys.y ELSE f.anchor END,
          f.row + CASE WHEN ys.y - f.anchor > 20 THEN 1 ELSE 0 END
        FROM f JOIN ys ON ys.doc_id = f.doc_id AND ys.page = f.page AND ys.k = f.k + 1)
      SELECT * FROM f) r USING (doc_id, page, y) GROUP BY 1, 2, 3""", "tok")[len("WITH "):])
def e9(spark, d):
    t = ops.with_centres(bridge.tokens(spark, d))
    return ops.anchored_rows(t, ops.PAGE, "y", ops.ROW_GAP, "row").groupBy(
        *ops.PAGE, "row").agg(F.count("*").alias("n"), F.min("y").alias("top"))


@query("s9_e15_page_roles", sql("""
    SELECT r3.doc_id, filleted::int AS filleted, income_page, balance_page, cashflow_page,
           string_agg(page::varchar, ',' ORDER BY page) AS notes_pages
    FROM r3 LEFT JOIN notepages n ON n.doc_id = r3.doc_id GROUP BY 1, 2, 3, 4, 5""",
                                "r3", "notepages"))
def s9(spark, d):
    return ops.page_roles(_pages(spark, d)).withColumns({
        "filleted": F.col("filleted").cast("int"),
        "notes_pages": F.nullif(F.array_join(F.col("notes_pages").cast("array<string>"), ","),
                                F.lit(""))})


@query("d28_year_columns", sql("SELECT * FROM docyears", "docyears"))
def d28(spark, d):
    return ops.year_columns(_pages(spark, d))


@query("d27_dialect", sql("SELECT * FROM dialects", "dialects"))
def d27(spark, d):
    return ops.with_dialect(_pages(spark, d))


@query("s10_note_column", sql("SELECT doc_id, page, round(note_x, 6) AS note_x FROM notecol",
                              "notecol"))
def s10(spark, d):
    return ops.note_column(bridge.tokens(spark, d)).withColumn("note_x", F.round("note_x", 6))


@query("s11_table_rows", sql("""
    SELECT doc_id, page, row, label, n_numbers, v1, v2 FROM trows""", "trows"))
def s11(spark, d):
    t, _, roles = _prepared(spark, d)
    return ops.table_rows(t, roles).drop("statement", "dialect", "current_year",
                                         "prior_year")


@query("e10_e11_carried_labels", sql("""
    SELECT doc_id, page, statement, row, kind, full_label FROM crows""", "crows"))
def e10(spark, d):
    t, _, roles = _prepared(spark, d)
    rows = ops.with_named_fields(ops.table_rows(t, roles))
    return ops.carried_labels(rows).select("doc_id", "page", "statement", "row", "kind",
                                           "full_label")


@query("c9_label_theta_join", sql("""
    SELECT doc_id, page, statement, row, own AS printed_field FROM lrows WHERE own IS NOT NULL""",
                                  "lrows"))
def c9(spark, d):
    t, _, roles = _prepared(spark, d)
    rows = ops.table_rows(t, roles).withColumn("full_label", F.col("label"))
    return ops.match_labels(rows).select("doc_id", "page", "statement", "row", "printed_field")


@query("s12_printed_facts", sql("SELECT * EXCLUDE (place) FROM pfacts", "pfacts"))
def s12(spark, d):
    return _facts(spark, d).drop("dialect", "current_year", "prior_year", "place")


_MAP = ([("income_statement", k, v) for k, v in lookups.PRINTED_INCOME.items()]
        + [("balance_sheet", k, v) for k, v in lookups.PRINTED_BALANCE.items()]
        + [("cash_flow_statement", k, k) for k in lookups.PRINTED_CASHFLOW])
view("printedmap", "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{p}', '{f}')" for s, p, f in _MAP) + ") t(statement, printed_field, field)")
view("plong", """
    SELECT doc_id, statement, printed_field, place, current_year AS year, current AS value
      FROM pfacts JOIN docyears USING (doc_id) WHERE current IS NOT NULL
    UNION ALL SELECT doc_id, statement, printed_field, place, prior_year, prior
      FROM pfacts JOIN docyears USING (doc_id) WHERE prior IS NOT NULL AND prior_year IS NOT NULL""",
     "pfacts", "docyears")
view("pcanon", """
    SELECT doc_id, year, field, statement AS source, value::double AS value FROM (
      SELECT l.*, m.field FROM plong l JOIN printedmap m USING (statement, printed_field)
      UNION ALL SELECT *, printed_field FROM plong WHERE statement = 'notes'
        AND printed_field IN ('depreciation', 'amortisation'))
    QUALIFY row_number() OVER (PARTITION BY doc_id, year, field
      ORDER BY (statement = 'notes'), place DESC) = 1""", "plong", "printedmap")


@query("c20_r12_canonical_printed_facts", sql("SELECT * FROM pcanon", "pcanon"))
def r12(spark, d):
    return ops.canonical_facts(_facts(spark, d))


_WIDE = ["turnover", "revenue", "cost_of_sales", "gross_profit", "operating_cash_flow",
         "net_cash_investing", "net_cash_financing", "net_change_cash", "opening_cash",
         "closing_cash", "cash_at_bank", "cash_and_equivalents", "net_assets", "total_equity",
         "total_assets_less_current_liabilities", "shareholders_funds"]


@query("r10_printed_checks", sql("""
    SELECT doc_id, year, unnest(list_filter([
      CASE WHEN abs(rev + cost_of_sales - gross_profit) > 1
        AND abs(rev - cost_of_sales - gross_profit) > 1 THEN 'gross_profit' END,
      CASE WHEN closing_cash <> 0 AND abs(closing_cash - bs_cash) / greatest(abs(closing_cash), 1)
        > 0.01 THEN 'cash_tie' END,
      CASE WHEN net_assets <> total_equity THEN 'net_assets_vs_equity' END],
      lambda x: x IS NOT NULL)) AS failed_check
    FROM (SELECT doc_id, year, coalesce(turnover, revenue) AS rev,
      coalesce(cash_at_bank, cash_and_equivalents) AS bs_cash, * EXCLUDE (doc_id, year) FROM (
        SELECT doc_id, year, """ + ", ".join(
    f"max(value) FILTER (printed_field = '{f}') AS {f}" for f in _WIDE)
    + " FROM plong WHERE statement <> 'notes' GROUP BY 1, 2))", "plong"))
def r10(spark, d):
    long = ops.by_year(_facts(spark, d).where("statement <> 'notes'"))
    wide = long.groupBy("doc_id", "year").pivot("printed_field", _WIDE).agg(F.max("value"))
    return rules.printed_checks(wide)


_LOW = "lower(trim(text))"
_STAFF = _any("lower(p.text)", ["staff costs", "average number of persons",
                                "average number of employees", "average headcount"])
_STOPS = _any("low", ["aggregate", "payroll", "wages", "salaries", "incurred", "costs",
                      "remuneration", "auditor"])
view("emp", f"""
    SELECT n.doc_id, min(n.page) AS page FROM notepages n JOIN pg p USING (doc_id, page)
    LEFT JOIN (SELECT DISTINCT doc_id, page, true AS hit FROM tok WHERE x < page_width * 0.35
      AND {_LOW} = 'employees') h USING (doc_id, page)
    WHERE ({_STAFF} AND {_any('lower(p.text)', ['no.', 'average number'])})
      OR (hit AND contains(lower(p.text), 'employees')) GROUP BY 1""", "notepages", "pg", "tok")
view("hc", f"""
    SELECT t.doc_id, x, y, {_LOW} AS low, is_num, v, x < page_width * 0.35 AS lft,
      x < page_width * 0.5 AS lab, coalesce(v = current_year OR v = prior_year, false) AS is_year
    FROM tok t JOIN emp USING (doc_id, page) LEFT JOIN docyears USING (doc_id)""",
     "tok", "emp", "docyears")
view("hc1", """
    SELECT hc.*, s FROM hc JOIN (SELECT doc_id, min(y) AS s FROM hc WHERE lft AND
      (low IN ('staff', 'employees') OR contains(low, 'staff costs')) GROUP BY 1) USING (doc_id)""",
     "hc")
view("hc2", """
    SELECT hc1.*, b FROM hc1 LEFT JOIN (SELECT doc_id, min(y) AS b FROM hc1 WHERE y >= s AND
      low IN ('no.', 'no', 'average', 'number') GROUP BY 1) USING (doc_id)""", "hc1")
view("hc3", f"""
    SELECT hc2.* FROM hc2 LEFT JOIN (SELECT doc_id, min(y) AS e FROM hc2 WHERE lft AND y > b AND
      {_STOPS} GROUP BY 1) USING (doc_id) WHERE y BETWEEN s AND coalesce(e, 'infinity'::double)""", "hc2")
view("hc4", f"""
    SELECT doc_id, row, list(v ORDER BY x, y, v) FILTER (is_num AND NOT is_year AND v > 0) AS vs,
      trim(coalesce(string_agg(low, ' ' ORDER BY x, y, low) FILTER (NOT is_num AND lab), ''))
        AS label
    FROM hc3 JOIN (
      WITH RECURSIVE ys AS (SELECT DISTINCT doc_id, y, dense_rank() OVER (PARTITION BY doc_id
          ORDER BY y) AS k FROM hc3),
      f AS (SELECT doc_id, y, k, y AS anchor, 0 AS row FROM ys WHERE k = 1 UNION ALL
        SELECT ys.doc_id, ys.y, ys.k, CASE WHEN ys.y - f.anchor > 20 THEN ys.y ELSE f.anchor END,
          f.row + CASE WHEN ys.y - f.anchor > 20 THEN 1 ELSE 0 END
        FROM f JOIN ys ON ys.doc_id = f.doc_id AND ys.k = f.k + 1)
      SELECT doc_id, y, row FROM f) r USING (doc_id, y) GROUP BY 1, 2""", "hc3")
_TOT = " ".join(f"WHEN contains(label, '{p}') THEN {str(t).lower()}"
                for p, t in lookups.HEADCOUNT_LABELS)
view("hc5", f"""
    SELECT *, CASE WHEN own IS NULL AND label = '' AND coalesce(sum(CASE WHEN own = false THEN 1
        ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND
        1 PRECEDING), 0) > 0 THEN true ELSE own END AS is_total
    FROM (SELECT *, CASE {_TOT} END AS own FROM hc4 WHERE len(vs) > 0)""", "hc4")


@query("d30_s13_headcount", sql("""
    SELECT * FROM (SELECT doc_id,
      CASE WHEN bool_or(is_total) THEN arg_min(vs, row) FILTER (is_total)[1]
        ELSE nullif(sum(vs[1]) FILTER (is_total = false), 0) END::bigint AS current,
      CASE WHEN bool_or(is_total) THEN arg_min(vs, row) FILTER (is_total)[2]
        ELSE nullif(sum(vs[2]) FILTER (is_total = false), 0) END::bigint AS prior
      FROM hc5 GROUP BY 1) WHERE current IS NOT NULL OR prior IS NOT NULL""", "hc5"))
def s13(spark, d):
    t = bridge.tokens(spark, d)
    pg = ops.page_text(t)
    docs = ops.documents(pg)
    return ops.headcount(t, ops.employee_page(pg, docs, t), docs)


view("p2", f"""
    SELECT doc_id, page, contains(upper(top25), 'CONTENTS') AS toc,
      (contains(upper(top25), 'OPTED NOT TO DELIVER') AND contains(upper(top25),
        'PROFIT AND LOSS')) OR contains(upper(top25), 'SECTION 444(4)') AS f,
      {_any('upper(top25)', ops.INCOME_TITLES)}
        AND NOT contains(upper(top25), 'OPTED NOT TO DELIVER') AS inc,
      {_any('upper(top25)', ops.BALANCE_TITLES)} AND NOT contains(upper(top25), 'CONTINUED')
        AS bal,
      {_any('upper(top25)', ops.CASH_TITLES)} AND NOT contains(upper(top25), 'CONTINUED') AS cf,
      contains(upper(top25), 'NOTES TO THE') AND contains(upper(top25), 'FINANCIAL STATEMENTS')
        AS nt, max(page) OVER (PARTITION BY doc_id) AS last, top25 FROM pg""", "pg")
view("p2i", """SELECT doc_id, CASE WHEN NOT bool_or(f) THEN min(page) FILTER (inc AND NOT toc) END
    AS ip FROM p2 GROUP BY 1""", "p2")
view("p2b", """SELECT doc_id, ip, min(page) FILTER (bal AND NOT toc AND page IS DISTINCT FROM ip)
    AS bp FROM p2 JOIN p2i USING (doc_id) GROUP BY 1, 2""", "p2", "p2i")
view("p2c", """SELECT doc_id, ip, bp, min(page) FILTER (cf AND NOT toc AND page IS DISTINCT FROM ip
    AND page IS DISTINCT FROM bp) AS cp FROM p2 JOIN p2b USING (doc_id) GROUP BY 1, 2, 3""",
     "p2", "p2b")


def anchor_sql(col, sid):
    pattern = dict(lookups.SECTION_ANCHORS)[sid].replace("'", "''")
    return f"regexp_matches({col}, '(?i){pattern}')"


ANY_ANCHOR = "(" + " OR ".join(anchor_sql("top25", s) for s, _ in lookups.SECTION_ANCHORS) + ")"


@query("g6_s22_c14_second_pass_pages", sql(f"""
    SELECT doc_id, page FROM p2 JOIN p2c USING (doc_id) WHERE toc OR (nt AND NOT toc)
      OR page IN (ip, bp, cp) OR page IN (ip - 1, ip + 1, bp - 1, bp + 1, cp - 1, cp + 1)
      OR {ANY_ANCHOR}""", "p2", "p2c"))
def s22(spark, d):
    return ops.second_pass_pages(_pages(spark, d))


@query("d40_low_confidence", sql("""
    SELECT doc_id, page, round(avg(conf), 6) AS mean_conf FROM tok WHERE is_num GROUP BY 1, 2
    HAVING avg(conf) < 0.5""", "tok"))
def d40(spark, d):
    t = ops.number_tokens(bridge.tokens(spark, d))
    return t.groupBy(*ops.PAGE).agg(F.round(F.avg("conf"), 6).alias("mean_conf")).where(
        "mean_conf < 0.5")


@query("d42_dialect_by_matches", sql("""
    SELECT doc_id, arg_min(dialect, (-n, dialect)) AS dialect FROM (
      SELECT r.doc_id, l.dialect, count(DISTINCT (r.page, r.row)) AS n FROM trows r
      JOIN stpages s USING (doc_id, page) JOIN labels_ l ON l.statement = s.statement
        AND contains(r.label, l.pattern) WHERE r.n_numbers > 0 GROUP BY 1, 2) GROUP BY 1""",
                                     "trows", "stpages", "labels_"))
def d42(spark, d):
    t, _, roles = _prepared(spark, d)
    rows = ops.table_rows(t, roles).where("n_numbers > 0").drop("dialect")
    table = F.broadcast(lookups.label_table(spark))
    hit = rows.join(table, "statement").where(F.col("label").contains(F.col("pattern")))
    n = hit.groupBy("doc_id", "dialect", "page", "row").agg(F.lit(1).alias("one")).groupBy(
        "doc_id", "dialect").agg(F.count("*").alias("n"))
    best = F.struct(-F.col("n"), "dialect")
    return n.groupBy("doc_id").agg(F.min_by("dialect", best).alias("dialect"))


@query("h28_currency_scale", sql("""
    SELECT scale, count(*) AS n FROM (SELECT CASE
        WHEN regexp_matches(lower(text), '£\\s*m\\b|£\\s*million|in millions') THEN 'millions'
        WHEN regexp_matches(lower(text), '£\\s*''?000|in thousands') THEN 'thousands'
        ELSE 'pounds' END AS scale FROM pg) GROUP BY 1""", "pg"))
def h28(spark, d):
    return _pages(spark, d).groupBy(text.currency_scale(F.col("text")).alias("scale")).agg(
        F.count("*").alias("n"))


@query("h29_text_page_probe", sql("""
    SELECT doc_id, (len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) > 20
        AND length(regexp_replace(text, '[^\\pL]', '', 'g')) / nullif(length(regexp_replace(text,
        '\\s', '', 'g')), 0) > 0.5)::int AS is_text FROM documents"""))
def h29(spark, d):
    return bridge.table(spark, d, "documents").select(
        "doc_id", F.coalesce(text.text_page(F.col("text")), F.lit(False)).cast("int").alias(
            "is_text"))
