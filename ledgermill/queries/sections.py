"""Queries over tagged markup and over the sections of tagged and printed filings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import lookups
from ledgermill.functions import text
from ledgermill.operators import agreement
from ledgermill.operators import evidence as ev
from ledgermill.operators import facts as fact_ops
from ledgermill.operators import locators as loc
from ledgermill.operators import sections as sec
from ledgermill.operators import tokens as tok
from ledgermill.plans import bridge, filing_merge
from ledgermill.queries.base import query, sql, view
from ledgermill.queries.pages import _any, anchor_sql
from ledgermill.sources import markup

# --- markup (expected rows come straight from the order columns) ------------
_Y = "cast(year(o_orderdate) AS int)"
view("mfacts", f"""
    SELECT o_custkey, o_orderkey, ord, name, yr AS year, dim, raw, scale, sign FROM (
      SELECT *, unnest(range(14)) AS ord,
        unnest(['core:TurnoverRevenue', 'core:TurnoverRevenue', 'core:TurnoverRevenue',
          'core:Turnover', 'core:TaxOnProfit', 'core:CashBankOnHand', 'core:OtherUnmappedLine',
          'core:CostSales', 'core:DistributionCosts', 'core:Provisions', 'core:Accruals',
          'core:Stocks', 'core:FixedAssets', 'core:CurrentAssets']) AS name,
        unnest([{_Y}, {_Y} - 1, {_Y}, {_Y}, {_Y}, {_Y}, {_Y}, {_Y}, {_Y}, {_Y}, {_Y}, {_Y},
          {_Y}, {_Y}]) AS yr,
        unnest(list_transform(range(14), lambda i: i = 2)) AS dim,
        unnest([format('{{:,}}', cast(round(o_totalprice * 100) AS bigint)),
          format('{{:,}}', o_custkey), '77', '9', format('{{:,}}', o_custkey + 1),
          CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE cast(o_orderkey AS varchar) END, '1',
          '', '7', '5d', 'nan', '12' || chr(160) || o_orderkey, '£' || o_orderkey,
          o_orderkey::varchar]) AS raw,
        unnest(list_transform(range(14), lambda i: CASE WHEN i = 1 THEN '3' END)) AS scale,
        unnest(list_transform(range(14), lambda i: CASE WHEN i = 4 THEN '-' END)) AS sign FROM orders)""")
view("mcells", f"""
    SELECT company_number, year, field, value FROM (
      SELECT cast(o_custkey AS varchar) AS company_number, {_Y} AS year, 'revenue' AS field,
        round(o_totalprice * 100) AS value, o_orderdate, o_orderkey FROM orders
      UNION ALL SELECT cast(o_custkey AS varchar), {_Y} - 1, 'revenue', o_custkey * 1000.0,
        o_orderdate, o_orderkey FROM orders
      UNION ALL SELECT cast(o_custkey AS varchar), {_Y}, 'tax_expense', -(o_custkey + 1.0),
        o_orderdate, o_orderkey FROM orders
      UNION ALL SELECT cast(o_custkey AS varchar), {_Y}, 'cash', o_orderkey::double, o_orderdate,
        o_orderkey FROM orders WHERE o_orderkey % 4 <> 0
      UNION ALL SELECT cast(o_custkey AS varchar), {_Y}, 'distribution_costs', 7.0, o_orderdate,
        o_orderkey FROM orders
      UNION ALL SELECT cast(o_custkey AS varchar), {_Y}, 'inventories',
        ('12' || o_orderkey)::double, o_orderdate, o_orderkey FROM orders
      UNION ALL SELECT cast(o_custkey AS varchar), {_Y}, 'total_current_assets',
        o_orderkey::double, o_orderdate, o_orderkey FROM orders)
    QUALIFY row_number() OVER (PARTITION BY company_number, year, field
      ORDER BY cast(o_orderdate AS date) DESC, o_orderkey DESC) = 1""")


@query("a12_markup_facts", sql("""
    SELECT cast(o_orderkey AS varchar) AS filing_id, ord, name, year, dim::int AS dimensional,
           raw, scale, sign FROM mfacts""", "mfacts"))
def a12(spark, d):
    return markup.facts(bridge.markup(spark, d)).select(
        "filing_id", "ord", "name", "year", F.col("dimensional").cast("int").alias("dimensional"),
        "raw", "scale", "sign")


@query("a13_markup_contexts", f"""
    SELECT cast(o_orderkey AS varchar) AS filing_id, unnest(['cur', 'prv', 'dim']) AS ctx_id,
      unnest([{_Y}, {_Y} - 1, {_Y}]) AS year, unnest(['duration', 'instant', 'duration']) AS ctx_type,
      unnest([0, 0, 1]) AS dimensional, unnest([NULL, NULL, 'SegmentMember']) AS member
    FROM orders""")
def a13(spark, d):
    return markup.contexts(bridge.markup(spark, d)).select(
        "filing_id", "ctx_id", "year", "ctx_type",
        F.col("dimensional").cast("int").alias("dimensional"),
        F.get("members", F.lit(0)).alias("member"))


@query("a14_nested_narrative", """
    SELECT o_orderkey::varchar AS filing_id, unnest(['core:RevenueRecognitionPolicy',
      'core:ProvisionsPolicy', 'bus:DescriptionPrincipalActivities',
      'aurep:BasisForOpinionAuditorsOnEntity']) AS name,
      unnest(['Outer inner ' || o_orderkey || ' tail', 'inner ' || o_orderkey,
        'Trading in lot ' || o_orderkey, 'basis & grounds']) AS text FROM orders""")
def a14(spark, d):
    return markup.narrative(bridge.markup(spark, d)).where(F.col("name").isin(
        "core:RevenueRecognitionPolicy", "core:ProvisionsPolicy",
        "bus:DescriptionPrincipalActivities", "aurep:BasisForOpinionAuditorsOnEntity")).drop("ord")


_ENT = "x"
# The references that occur in the pages; &amp; last, so that nothing is decoded twice.
for _e, _c in [("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&pound;", "£"), ("&lt;", "<"),
               ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]:
    _ENT = f"replace({_ENT}, '{_e.replace(chr(39), chr(39) * 2)}', '{_c.replace(chr(39), chr(39) * 2)}')"


@query("a15_visible_body_text", f"""
    SELECT page_id, md5(array_to_string(list_filter(list_transform(regexp_split_to_array(
        regexp_replace(CASE WHEN inner_ <> '' THEN inner_ ELSE v END, '(?s)<!--.*?-->', '', 'g'),
        '<[^>]*>'), lambda x: trim({_ENT}, chr(32) || chr(9) || chr(10) || chr(13))),
        lambda x: x <> ''), chr(10))) AS text_hash
    FROM (SELECT page_id, v, regexp_extract(v, '(?is)<body\\b[^>]*>(.*)</body>', 1) AS inner_ FROM (
      SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<ix:header\\b.*?</ix:header>', '',
        'g'), '(?is)<(script|style)\\b.*?</(script|style)>', '', 'g') AS v FROM pages))""")
def a15(spark, d):
    return bridge.table(spark, d, "pages").select(
        "page_id", F.md5(markup.body_text(F.col("html"))).alias("text_hash"))


@query("a11_documents_as_files", "SELECT count(*) AS n, sum(length(html))::bigint AS chars "
                                 "FROM pages")
def a11(spark, d):
    from ledgermill.sources import filings as fl
    from ledgermill.sources import tables

    path = tables.run_path(spark, "documents")
    # One text file per task stands for landed documents; lines are rejoined on read.
    rows = bridge.table(spark, d, "pages").select(F.to_json(F.struct("html")).alias("value"))
    rows.write.text(path)
    landed = fl.landed_markup(spark, path)
    lines = landed.select(F.explode(F.split("content", "\n")).alias("j")).where("j <> ''")
    return lines.select(F.get_json_object("j", "$.html").alias("h")).agg(
        F.count("*").alias("n"), F.sum(F.length("h")).alias("chars"))


@query("h26_taxonomy_version", """
    SELECT o_orderkey::varchar AS filing_id, CASE WHEN o_orderkey % 10 = 0 THEN 'frc-uk-2023'
      ELSE 'frc-uk-' || (2018 + o_orderkey % 6) END AS version FROM orders""")
def h26(spark, d):
    return bridge.markup(spark, d).select(
        "filing_id", markup.taxonomy_version(F.col("content")).alias("version"))


@query("j2_merged_cells", sql("SELECT * FROM mcells", "mcells"))
def j2(spark, d):
    return filing_merge.tagged_cells(bridge.markup(spark, d))


@query("j2_merged_statements", sql(f"""
    SELECT y.company_number, y.year,
      max(value) FILTER (field = 'revenue') AS revenue,
      max(value) FILTER (field = 'tax_expense') AS tax_expense,
      max(value) FILTER (field = 'cash') AS cash
    FROM (SELECT cast(o_custkey AS varchar) AS company_number, {_Y} AS year FROM orders
          UNION SELECT cast(o_custkey AS varchar), {_Y} - 1 FROM orders) y
    LEFT JOIN mcells USING (company_number, year) GROUP BY 1, 2""", "mcells"))
def j2_rows(spark, d):
    return filing_merge.tagged_statements(bridge.markup(spark, d)).select(
        "company_number", "year", "revenue", "tax_expense", "cash")


_SMALL, _FILL = "o_orderkey % 2 = 0", "o_orderkey % 8 = 0"
_SIZE = f"CASE WHEN {_SMALL} THEN 'small' WHEN o_orderkey % 5 = 0 THEN 'medium' ELSE 'unknown' END"


@query("s1_c7_filing_class", f"""
    SELECT o_orderkey::varchar AS filing_id, {_SIZE} AS size,
      CASE WHEN {_FILL} THEN 'filleted' ELSE 'full' END AS mode,
      CASE WHEN o_orderkey % 6 = 0 THEN 0 WHEN o_orderkey % 4 = 1 THEN 1 END AS audited,
      (o_orderkey % 9 = 0)::int AS dormant, (o_orderkey % 7 = 0)::int AS going_concern_asserted
    FROM orders""")
def s1(spark, d):
    docs = bridge.markup(spark, d)
    return sec.classify_filings(docs).withColumns({
        c: F.col(c).cast("int") for c in ("audited", "dormant", "going_concern_asserted")})


@query("h27_three_state_flag", """
    SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'value' ELSE 'empty' END AS state, count(*) AS n
    FROM orders GROUP BY 1""")
def h27(spark, d):
    docs = bridge.markup(spark, d)
    flag = markup.narrative(docs).where("name = 'bus:EntityDormantTruefalse'").groupBy(
        "filing_id").agg(F.min_by("text", "ord").alias("t"))
    state = F.when(F.col("t").isNull(), "missing").when(F.col("t") == "", "empty").otherwise(
        "value")
    return docs.select("filing_id").join(flag, "filing_id", "left").groupBy(
        state.alias("state")).agg(F.count("*").alias("n"))


@query("s3_expected_sections", f"""
    SELECT filing_id, section_id, (CASE
      WHEN section_id IN ('strategic_report', 'principal_risks') THEN size <> 'small'
      WHEN section_id = 'section_172' THEN size = 'unknown'
      WHEN section_id = 'viability_statement' THEN false
      WHEN section_id IN ('directors_report', 'principal_activity', 'going_concern_directors')
        THEN NOT (size = 'small' AND filleted)
      WHEN section_id = 'auditor_report' THEN size <> 'small'
      WHEN section_id = 'critical_estimates' THEN NOT (size = 'small' AND filleted)
      ELSE true END)::int AS expected
    FROM (SELECT o_orderkey::varchar AS filing_id, {_SIZE} AS size, {_FILL} AS filleted,
      unnest([{', '.join(repr(s) for s in lookups.SECTION_IDS)}]) AS section_id FROM orders)""")
def s3(spark, d):
    docs = bridge.markup(spark, d)
    cls = sec.classify_filings(docs)
    ids = F.array(*[F.lit(s) for s in lookups.SECTION_IDS])
    return cls.select("*", F.explode(ids).alias("section_id")).select(
        "filing_id", "section_id", sec.expected_section(
            F.col("section_id"), F.col("size"), F.col("mode"), F.col("audited")).cast(
            "int").alias("expected"))


@query("s5_c5_d23_d24_tag_layer", """
    SELECT o_orderkey::varchar AS filing_id, unnest(['principal_activity', 'accounting_policies',
        'auditor_report']) AS section_id,
      unnest(['Trading in lot ' || o_orderkey,
        'Outer inner ' || o_orderkey || ' tail' || chr(10) || chr(10) || 'inner ' || o_orderkey,
        'true and fair' || chr(10) || chr(10) || 'basis & grounds']) AS text,
      unnest([0, 2, 2]) AS n_sub, unnest([NULL, NULL, 'true and fair']) AS opinion FROM orders""")
def s5(spark, d):
    return sec.tag_layer(bridge.markup(spark, d)).select(
        "filing_id", "section_id", "text", F.size("subsections").alias("n_sub"),
        F.try_element_at("subsections", F.lit("opinion")).alias("opinion"))


@query("c6_flag_exclusion_and_unknowns", """
    SELECT 'core:SomethingElse' AS name, count(*) AS n FROM orders""")
def c6(spark, d):
    return sec.unmapped_narrative(bridge.markup(spark, d)).groupBy("name").agg(
        F.count("*").alias("n"))


_FOUND = {"strategic_report": "ixbrl_text", "going_concern_note": "ixbrl_text",
          "principal_activity": "ixbrl_tag", "accounting_policies": "ixbrl_tag",
          "auditor_report": "ixbrl_tag"}


view("tagged_slots", f"""
    SELECT filing_id, section_id, CASE WHEN source IS NOT NULL THEN 'found' WHEN due THEN
      'not_found' ELSE 'not_present' END AS status, source FROM (
      SELECT *, CASE section_id {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _FOUND.items())}
          WHEN 'going_concern_directors' THEN CASE WHEN flag THEN 'ixbrl_flag' END END AS source,
        CASE WHEN section_id IN ('principal_risks') THEN size <> 'small'
          WHEN section_id = 'section_172' THEN size = 'unknown'
          WHEN section_id = 'viability_statement' THEN false
          WHEN section_id IN ('directors_report', 'going_concern_directors', 'critical_estimates')
            THEN NOT (size = 'small' AND filleted) ELSE true END AS due
      FROM (SELECT o_orderkey::varchar AS filing_id, {_SIZE} AS size, {_FILL} AS filleted,
        o_orderkey % 7 = 0 AS flag,
        unnest([{', '.join(repr(s) for s in lookups.SECTION_IDS)}]) AS section_id FROM orders))""")


@query("s7_s8_resolved_sections", sql("SELECT * FROM tagged_slots", "tagged_slots"))
def s7(spark, d):
    return sec.sections_of(bridge.markup(spark, d)).select(
        "filing_id", "section_id", "status", "source")


_CATEGORIES = ["SMALL", "MEDIUM", "FULL", "NO ACCOUNTS FILED"]
_CAT = "[" + ", ".join(f"'{c}'" for c in _CATEGORIES) + "]"
view("register_history", f"""
    SELECT c_custkey::varchar AS company_number, unnest([DATE '1996-03-01', DATE '1998-06-01']) AS valid_from,
      unnest([{_CAT}[c_custkey % 4 + 1], {_CAT}[(c_custkey + 1) % 4 + 1]]) AS category FROM customer""")
view("verdicts", f"""
    SELECT filing_id, found, not_present, not_found, (found + not_present + not_found = 12)::int AS complete,
      filing_size, register_size, (filing_size = register_size)::int AS agrees,
      CASE WHEN filing_size = 'large' AND mode = 'full' THEN (core = 3)::int END AS core_found
    FROM (SELECT filing_id, count(*) FILTER (status = 'found') AS found, count(*) FILTER (status = 'not_present')
        AS not_present, count(*) FILTER (status = 'not_found') AS not_found, count(*) FILTER (status = 'found' AND
        section_id IN ('strategic_report', 'directors_report', 'auditor_report')) AS core
      FROM tagged_slots GROUP BY 1)
    JOIN (SELECT o_orderkey::varchar AS filing_id, CASE WHEN {_SIZE} = 'unknown' THEN 'large' ELSE {_SIZE} END
        AS filing_size, CASE WHEN {_FILL} THEN 'filleted' ELSE 'full' END AS mode,
        CASE h.category WHEN 'SMALL' THEN 'small' WHEN 'MEDIUM' THEN 'medium' WHEN 'FULL' THEN 'large' END
        AS register_size
      FROM orders o ASOF LEFT JOIN register_history h ON o.o_custkey::varchar = h.company_number
        AND o.o_orderdate::date >= h.valid_from) USING (filing_id)""", "tagged_slots", "register_history")


def _verdicts(spark, d):
    docs = bridge.markup(spark, d)
    orders = bridge.table(spark, d, "orders")
    dated = orders.select(F.col("o_orderkey").cast("string").alias("filing_id"),
                          F.col("o_custkey").cast("string").alias("company_number"),
                          F.col("o_orderdate").cast("date").alias("filing_date"))
    names = F.array(*[F.lit(c) for c in _CATEGORIES])
    key = F.col("c_custkey").cast("int")
    history = bridge.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("company_number"), F.inline(F.array(
        F.struct(F.lit("1996-03-01").cast("date").alias("valid_from"), F.get(names, key % 4).alias("category")),
        F.struct(F.lit("1998-06-01").cast("date").alias("valid_from"), F.get(names, (key + 1) % 4).alias("category")))))
    return agreement.verdicts(sec.filings_of(docs, fields=("section_id", "status")), dated, history)


@query("d38_section_acceptance", sql("SELECT * FROM verdicts", "verdicts"))
def d38(spark, d):
    return _verdicts(spark, d).withColumns({c: F.col(c).cast("int") for c in ("complete", "agrees", "core_found")})


@query("d38_class_agreement", sql("""
    SELECT filing_size, register_size, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY filing_size) AS share
    FROM verdicts WHERE register_size IS NOT NULL GROUP BY 1, 2""", "verdicts"))
def d38_matrix(spark, d):
    return agreement.matrix(_verdicts(spark, d), "filing_size", "register_size")


@query("d38_class_kappa", sql("""
    SELECT n, agreed, expected, (agreed - expected) / (1 - expected) AS kappa FROM (
      SELECT (SELECT count(*) FROM v) AS n, (SELECT avg((filing_size = register_size)::int) FROM v) AS agreed,
        (SELECT sum(a * b) FROM (SELECT filing_size AS c, count(*)::double / (SELECT count(*) FROM v) AS a FROM v GROUP BY 1)
          JOIN (SELECT register_size AS c, count(*)::double / (SELECT count(*) FROM v) AS b FROM v GROUP BY 1) USING (c))
          AS expected)""".replace("FROM v", "FROM (SELECT * FROM verdicts WHERE register_size IS NOT NULL)"), "verdicts"))
def d38_kappa(spark, d):
    pairs = agreement.matrix(_verdicts(spark, d), "filing_size", "register_size")
    return agreement.kappa(pairs, "filing_size", "register_size")


# --- body text ------------------------------------------------------------
view("bodies", f"SELECT doc_id::varchar AS filing_id, {bridge.body_expr(True)} AS body_text "
     "FROM documents")


def _hits(section, rank):
    p = "'(?i)" + dict(lookups.SECTION_ANCHORS)[section].replace("'", "''") + "'"
    return (f"SELECT filing_id, {rank} AS rank, '{section}' AS section_id, "
            f"list_sum(list_transform(parts[1:k], lambda t: len(t))) + "
            f"coalesce(list_sum(list_transform(ms[1:k - 1], lambda t: len(t))), 0) AS start "
            f"FROM (SELECT filing_id, parts, ms, unnest(range(1, len(ms) + 1)) AS k FROM "
            f"(SELECT filing_id, regexp_split_to_array(body_text, {p}) AS parts, "
            f"regexp_extract_all(body_text, {p}, 0) AS ms FROM bodies))")


view("hits", " UNION ALL ".join(
    _hits(s, r) for r, (s, _) in enumerate(lookups.SECTION_ANCHORS)
    if s != "going_concern_directors"), "bodies")


@query("c10_anchor_offsets", sql("""
    SELECT filing_id, section_id, cast(start AS int) AS start FROM hits""", "hits"))
def c10(spark, d):
    return sec.anchor_hits(bridge.bodies(spark, d)).select(
        "filing_id", "section_id", F.col("offset").alias("start"))


@query("s6_e13_text_layer", sql("""
    SELECT filing_id, section_id, cast(start AS int) AS start, cast(nxt AS int) AS "end",
      md5(trim(substr(body_text, cast(start AS int) + 1, cast(nxt - start AS int)),
        chr(32) || chr(9) || chr(10) || chr(13))) AS text_hash
    FROM (SELECT h.*, body_text, coalesce(lead(start) OVER (PARTITION BY filing_id
            ORDER BY start, rank), len(body_text)) AS nxt FROM hits h JOIN bodies USING (filing_id))
    WHERE nxt > start QUALIFY row_number() OVER (PARTITION BY filing_id, section_id
      ORDER BY start) = 1""", "hits", "bodies"))
def s6(spark, d):
    return sec.text_layer(bridge.bodies(spark, d)).select(
        "filing_id", "section_id", "start", "end", F.md5("text").alias("text_hash"))


@query("h20_document_metadata", r"""
    SELECT doc_id, nullif(regexp_extract(t, '\b([0-9]{8})\b', 1), '') AS number,
      nullif(regexp_extract(t, '(?i)YEAR ENDED\s+([0-9]{1,2}\s+\w+\s+[0-9]{4})', 1), '') AS ended,
      nullif(trim(regexp_extract(t,
        '([A-Z][A-Z0-9 &,.''()\-]+(?:LIMITED|PLC|LTD|LLP))', 1)), '') AS company
    FROM (SELECT doc_id, text || ' EXAMPLE ' || upper(lang) || ' PLC 0123456'
      || doc_id % 10 || ' year ended 31 March 20' || (10 + doc_id % 10) AS t FROM documents)""")
def h20(spark, d):
    t = F.concat("text", F.lit(" EXAMPLE "), F.upper("lang"), F.lit(" PLC 0123456"),
                 F.col("doc_id") % 10, F.lit(" year ended 31 March 20"),
                 F.col("doc_id") % 10 + 10)
    return bridge.table(spark, d, "documents").select(
        "doc_id", text.registration_number(t).alias("number"), text.year_ended(t).alias("ended"),
        text.cover_company(t).alias("company"))


@query("h24_page_references", sql("""
    SELECT doc_id, page, array_to_string(regexp_extract_all(text,
      '(?i)(pages? [0-9]+ (?:to|-) [0-9]+)', 1), ';') AS refs FROM pg
    WHERE regexp_matches(text, '(?i)pages? [0-9]+ (?:to|-) [0-9]+')""", "pg"))
def h24(spark, d):
    refs = text.pages_referred(F.col("text"))
    return tok.page_text(bridge.tokens(spark, d)).where(F.size(refs) > 0).select(
        "doc_id", "page", F.array_join(refs, ";").alias("refs"))


@query("h23_fuzzy_heading", sql("""
    SELECT DISTINCT doc_id, page FROM (
      SELECT doc_id, page, w[k] || ' ' || w[k + 1] AS two FROM (
        SELECT doc_id, page, w, unnest(range(1, len(w))) AS k FROM (
          SELECT doc_id, page, string_split(upper(translate(top25, 'ßẞ', 'ss')), ' ') AS w
          FROM pg)))
    WHERE levenshtein(two, 'STRATEGIC REPROT') <= 2""", "pg"))
def h23(spark, d):
    words = F.split(F.upper(F.translate("top25", "ßẞ", "ss")), " ")
    return tok.page_text(bridge.tokens(spark, d)).where(
        text.fuzzy_contains(words, "STRATEGIC REPROT")).select("doc_id", "page")


# --- printed sections -----------------------------------------------------
def _first(col, only=None):
    arms = [f"WHEN {anchor_sql(col, s)} THEN '{s}'" for s, _ in lookups.SECTION_ANCHORS
            if not only or s in only]
    return "CASE " + " ".join(arms) + " END"


_BODY = _any("lower(text)", lookups.AUDITOR_BODY_PHRASES)
_CLS = {k: f"contains(lower(text), '{p}')" for k, p in loc.CLASS_PHRASES.items()}
view("dclass", f"""
    SELECT doc_id, size, last AS page_count, CASE WHEN {_CLS['s444']} OR ({_CLS['opted_out']} AND
        {_CLS['profit_and_loss']}) THEN 'filleted' WHEN size = 'micro' AND last <= 10 THEN
        'micro_minimal' WHEN {_CLS['abbreviated']} AND {_CLS['accounts']} THEN 'abbreviated'
        ELSE 'full' END AS mode
    FROM (SELECT *, CASE WHEN {_CLS['frs_105']} OR {_CLS['micro_entity']} OR
        {_CLS['micro_entity_2']} THEN 'micro' WHEN {_CLS['section_1a']} OR {_CLS['small_regime']}
        OR {_CLS['small_entities']} OR {_CLS['s1a']} THEN 'small' WHEN {_CLS['uk_ias']} OR
        {_CLS['uk_ifrs']} OR {_CLS['ifrs']} OR last >= 60 THEN 'large' WHEN last < 15 THEN 'micro'
        WHEN last < 30 THEN 'small' ELSE 'medium' END AS size FROM joined)""", "joined")
view("range_", f"""
    SELECT doc_id, min(page) AS first, coalesce((list(page ORDER BY page) FILTER (audit))[2] - 1,
      max(page)) AS last, max(page) AS document_end
    FROM (SELECT doc_id, page, {anchor_sql('text', 'auditor_report')} AND {_BODY} AS audit FROM pg)
    GROUP BY 1""", "pg")
view("tocpages", """
    SELECT doc_id, page, last FROM (SELECT *, max(page) OVER (PARTITION BY doc_id) AS last FROM pg)
    WHERE contains(upper(top25), 'CONTENTS')""", "pg")
view("toctok", """
    SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY y, x, text) AS row,
      regexp_full_match(rtrim(trim(text), '.'), '[0-9]+') AS digits,
      CASE WHEN try_cast(rtrim(trim(text), '.') AS int) BETWEEN 1 AND last THEN
        CASE WHEN regexp_full_match(rtrim(trim(text), '.'), '[0-9]+') THEN
          try_cast(rtrim(trim(text), '.') AS int) END END AS n
    FROM (SELECT t.*, last, CASE WHEN y - lag(y) OVER (PARTITION BY doc_id, page
            ORDER BY y, x, text) > 15 THEN 1 ELSE 0 END AS new
          FROM tok t JOIN tocpages USING (doc_id, page))""", "tok", "tocpages")
view("cand_a", f"""
    SELECT doc_id, {_first('title')} AS section_id, n AS start_page, NULL::int AS end_page,
      'toc' AS signal FROM (
      SELECT r.doc_id, r.page, r.row, r.n, trim(string_agg(t.text, ' ' ORDER BY t.x, t.y, t.text))
        AS title
      FROM (SELECT doc_id, page, row, x, n FROM toctok WHERE n IS NOT NULL QUALIFY row_number()
              OVER (PARTITION BY doc_id, page, row ORDER BY x DESC, y DESC, text DESC) = 1) r
      JOIN toctok t ON t.doc_id = r.doc_id AND t.page = r.page AND t.row = r.row
        AND NOT t.digits AND t.x < r.x - 5 GROUP BY 1, 2, 3, 4)
    WHERE length(title) >= 3 AND {_first('title')} IS NOT NULL""", "toctok")
view("cand_b", f"""
    SELECT doc_id, section_id, page AS start_page, NULL::int AS end_page, 'hard_anchor' AS signal
    FROM (SELECT *, unnest([{', '.join(f"CASE WHEN {anchor_sql('top25', s)} THEN '{s}' END"
                                       for s, _ in lookups.SECTION_ANCHORS)}]) AS section_id
      FROM (SELECT *, body OR coalesce(nb AND np = page + 1, false) AS confirmed FROM (
        SELECT *, {_BODY} AS body, lead({_BODY}) OVER (PARTITION BY doc_id ORDER BY page) AS nb,
          lead(page) OVER (PARTITION BY doc_id ORDER BY page) AS np FROM pg))
      WHERE n25 <= 40 OR caps25 / n25 >= 0.5)
    WHERE section_id IS NOT NULL AND (section_id <> 'auditor_report' OR confirmed)""", "pg")
view("bands", """
    SELECT doc_id, page, string_agg(text, ' ' ORDER BY x, y, text)
        FILTER (y <= page_height * 0.05) AS header,
      string_agg(text, ' ' ORDER BY y, x, text) FILTER (y <= page_height * 0.30) AS top30
    FROM tok GROUP BY 1, 2""", "tok")
view("cand_c", f"""
    SELECT h.doc_id, {_first('header')} AS section_id, lo AS start_page, hi AS end_page,
      'running_header' AS signal
    FROM (SELECT doc_id, trim(header) AS header, count(*) AS n, min(page) AS lo, max(page) AS hi
          FROM bands WHERE trim(header) <> '' GROUP BY 1, 2 HAVING count(*) >= 3) h
    LEFT JOIN (SELECT doc_id, lower(nullif(trim(regexp_extract(top30,
        '([A-Z][A-Za-z0-9 &,.''()\\-]+?(?:LIMITED|PLC|LTD|LLP))', 1)), '')) AS company
      FROM bands WHERE page = 1) c ON c.doc_id = h.doc_id
    WHERE (company IS NULL OR NOT contains(lower(header), company))
      AND {_first('header')} IS NOT NULL""", "bands")
view("cand_d", f"""
    SELECT doc_id, {_first('trim(top05)')} AS section_id, page AS start_page, NULL::int AS end_page,
      'all_caps_first_line' AS signal FROM pg
    WHERE upper(trim(top05)) = trim(top05) AND lower(trim(top05)) <> trim(top05)
      AND {_first('trim(top05)')} IS NOT NULL""", "pg")
_NOTE = ["accounting_policies", "critical_estimates", "going_concern_note"]
view("lines_", """
    SELECT doc_id, page, row, string_agg(text, ' ' ORDER BY x, y, text) AS line FROM (
      SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY y, x, text) AS row FROM (
        SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY doc_id, page ORDER BY y, x, text) > 15
          THEN 1 ELSE 0 END AS new FROM tok)) GROUP BY 1, 2, 3""", "tok")
view("cand_f", f"""
    SELECT doc_id, {_first('h', _NOTE)} AS section_id, page AS start_page, NULL::int AS end_page,
      'numbered_note' AS signal FROM (SELECT *, regexp_extract(line,
        '^\\s*[0-9]+(?:\\.[0-9]+)*[._\\s]+([A-Z][^\\n]*)$', 1) AS h FROM lines_)
    WHERE {_first('h', _NOTE)} IS NOT NULL""", "lines_")
view("pool", " UNION ALL ".join(f"SELECT * FROM cand_{k}" for k in "abcdf"),
     "cand_a", "cand_b", "cand_c", "cand_d", "cand_f")
_RANK = " ".join(f"WHEN '{s}' THEN {r}" for s, r in lookups.LOCATOR_RANKS)
view("votes", f"""
    SELECT doc_id, section_id, start, signals, CASE WHEN n >= 2 THEN 'high' ELSE 'low' END
      AS confidence
    FROM (SELECT doc_id, section_id, g, min(start_page) AS start, count(DISTINCT signal) AS n,
        max(CASE signal {_RANK} END) AS rank,
        string_agg(DISTINCT signal, ',' ORDER BY signal) AS signals
      FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id, section_id ORDER BY start_page) AS g
        FROM (SELECT *, CASE WHEN start_page - lag(start_page) OVER (PARTITION BY doc_id,
                section_id ORDER BY start_page) > 1 THEN 1 ELSE 0 END AS new
              FROM pool JOIN range_ USING (doc_id) WHERE start_page BETWEEN first AND last))
      GROUP BY 1, 2, 3)
    QUALIFY row_number() OVER (PARTITION BY doc_id, section_id
      ORDER BY n DESC, rank DESC, start) = 1""", "pool", "range_")
_ORD = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(lookups.SECTION_IDS))
_SIGN = lookups.SIGNOFF_PATTERN
view("signed_", f"SELECT doc_id, page FROM pg WHERE regexp_matches(text, '(?i){_SIGN}')", "pg")
view("placed", f"""
    SELECT e.doc_id, section_id, start, coalesce((SELECT min(page) FROM signed_ s WHERE
      s.doc_id = e.doc_id AND s.page BETWEEN e.start AND e.ends), ends) AS "end", signals,
      confidence
    FROM (SELECT v.*, CASE WHEN lead(start) OVER o IS NULL THEN last ELSE greatest(start, lead(start) OVER o - 1)
            END AS ends
          FROM votes v JOIN range_ USING (doc_id)
          WINDOW o AS (PARTITION BY doc_id ORDER BY start, CASE section_id {_ORD} END)) e""", "votes", "range_", "signed_")
view("due_", f"""
    SELECT doc_id, section_id, NOT ((size IN ('micro', 'small') AND section_id IN ('strategic_report',
          'section_172', 'principal_risks', 'viability_statement')) OR (mode = 'filleted' AND section_id IN
          ('strategic_report', 'section_172', 'principal_risks', 'viability_statement',
           'directors_report', 'directors_responsibilities', 'auditor_report',
           'going_concern_directors')) OR (mode = 'micro_minimal' AND section_id NOT IN
          ('accounting_policies', 'going_concern_note'))) AS due
    FROM (SELECT *, unnest([{', '.join(repr(s) for s in lookups.SECTION_IDS)}]) AS section_id
          FROM dclass)""", "dclass")
view("slots", """
    SELECT doc_id, section_id, CASE WHEN start IS NOT NULL THEN 'found' WHEN due THEN 'not_found'
      ELSE 'not_present' END AS status, start, "end", coalesce(signals, '') AS signals,
      coalesce(confidence, 'low') AS confidence
    FROM due_ LEFT JOIN placed USING (doc_id, section_id)""", "due_", "placed")


def _docs(spark, d):
    return ev.documents(bridge.tokens(spark, d))


def _listed(df):
    return df.withColumn("signals", F.array_join("signals", ","))


@query("s2_printed_class", sql("SELECT doc_id, size, mode, page_count FROM dclass", "dclass"))
def s2(spark, d):
    return _docs(spark, d).select("doc_id", "size", "mode", "page_count")


@query("s4_expected_printed", sql("""
    SELECT section_id, count(*) FILTER (status <> 'not_present') AS due_or_found FROM slots
    GROUP BY 1""", "slots"))
def s4(spark, d):
    return ev.printed_sections(_docs(spark, d)).groupBy("section_id").agg(
        F.count_if(F.col("status") != "not_present").alias("due_or_found"))


@query("s14_printed_contents", sql("SELECT * FROM cand_a", "cand_a"))
def s14(spark, d):
    return ev.candidates(_docs(spark, d), "toc")


@query("s15_c15_heading_anchors", sql("SELECT * FROM cand_b", "cand_b"))
def s15(spark, d):
    return ev.candidates(_docs(spark, d), "hard_anchor")


@query("s16_d26_running_headers", sql("SELECT * FROM cand_c", "cand_c"))
def s16(spark, d):
    return ev.candidates(_docs(spark, d), "running_header")


@query("s17_capital_first_lines", sql("SELECT * FROM cand_d", "cand_d"))
def s17(spark, d):
    return ev.candidates(_docs(spark, d), "all_caps_first_line")


@query("s18_signoffs", sql("SELECT * FROM signed_", "signed_"))
def s18(spark, d):
    return ev.signoffs(_docs(spark, d))


@query("s19_numbered_notes", sql("SELECT * FROM cand_f", "cand_f"))
def s19(spark, d):
    return ev.candidates(_docs(spark, d), "numbered_note")


@query("s21_e16_primary_range", sql("SELECT * FROM range_", "range_"))
def s21(spark, d):
    return _docs(spark, d).select("doc_id", "first", "last", "document_end")


@query("g5_candidate_pool", sql("""
    SELECT signal, section_id, count(*) AS n FROM pool GROUP BY 1, 2""", "pool"))
def g5(spark, d):
    return ev.candidates(_docs(spark, d)).groupBy("signal", "section_id").agg(F.count("*").alias("n"))


@query("c17_candidates_in_range", sql("""
    SELECT doc_id, count(*) AS n FROM pool JOIN range_ USING (doc_id)
    WHERE start_page BETWEEN first AND last GROUP BY 1""", "pool", "range_"))
def c17(spark, d):
    inside = F.filter("pool", lambda c: c["start_page"].between(F.col("first"), F.col("last")))
    return _docs(spark, d).select("doc_id", F.size(inside).cast("long").alias("n")).where("n > 0")


@query("d29_e14_section_vote", sql("SELECT * FROM votes", "votes"))
def d29(spark, d):
    return _listed(ev.first_pass(_docs(spark, d)).where("start IS NOT NULL")).select(
        "doc_id", "section_id", "start", "signals", "confidence")


@query("e12_c16_section_ends", sql("SELECT * FROM placed", "placed"))
def e12(spark, d):
    return _listed(ev.placed(_docs(spark, d))).select(
        "doc_id", "section_id", "start", "end", "signals", "confidence")


@query("s20_printed_sections", sql("SELECT * FROM slots", "slots"))
def s20(spark, d):
    return _listed(ev.printed_sections(_docs(spark, d)))


@query("d25_section_texts", sql("""
    SELECT s.doc_id, section_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY page))
      AS text_hash
    FROM slots s JOIN pg ON pg.doc_id = s.doc_id AND page BETWEEN start AND "end" GROUP BY 1, 2""",
                                "slots", "pg"))
def d25(spark, d):
    t = bridge.tokens(spark, d)
    return loc.section_texts(ev.printed_sections(ev.documents(t)), tok.page_text(t)).select(
        "doc_id", "section_id", F.md5("text").alias("text_hash"))


view("nums", f"""
    SELECT *, last_value(number IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
      min(CASE WHEN toc THEN page END) OVER (PARTITION BY doc_id) AS t1,
      min(CASE WHEN audit THEN page END) OVER (PARTITION BY doc_id) AS a1
    FROM (SELECT doc_id, page, nullif(regexp_extract(text, '\\b([0-9]{{8}})\\b', 1), '') AS number,
      contains(upper(top25), 'CONTENTS') AS toc,
      {_first('top15', ['strategic_report', 'directors_report'])} IS NOT NULL AS h,
      {anchor_sql('top15', 'auditor_report')} AS audit FROM pg)""", "pg")


@query("s26_entity_changes", sql("""
    SELECT doc_id, min(page) FILTER (number <> prev) AS new_number,
      min(page) FILTER (toc AND page > t1) AS second_toc,
      min(page) FILTER (h AND page > a1) AS after_audit
    FROM nums GROUP BY 1""", "nums"))
def s26(spark, d):
    return loc.entity_changes(tok.page_text(bridge.tokens(spark, d)))


@query("s23_within_parent", sql("""
    SELECT c.doc_id, c.section_id, c.start_page, c.signal FROM pool c JOIN placed p
      ON p.doc_id = c.doc_id AND p.section_id = CASE WHEN c.section_id IN ('principal_risks',
        'section_172') THEN 'strategic_report' WHEN c.section_id IN ('principal_activity',
        'going_concern_directors') THEN 'directors_report' WHEN c.section_id IN
        ('critical_estimates', 'going_concern_note') THEN 'accounting_policies' END
    WHERE c.start_page BETWEEN p.start AND p."end" """, "pool", "placed"))
def s23(spark, d):
    return ev.within_parent(_docs(spark, d)).select("doc_id", "section_id", "start_page", "signal")


# --- second pass: parents by themselves, then children inside them ---------
_KIDS = ", ".join(f"'{k}'" for k in ev.PARENTS)
_PARENT = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ev.PARENTS.items())


def _ends(src):
    return f"""
    SELECT e.* EXCLUDE (ends), coalesce((SELECT min(page) FROM signed_ s WHERE s.doc_id = e.doc_id
      AND s.page BETWEEN e.start AND e.ends), ends) AS "end"
    FROM (SELECT v.*, CASE WHEN lead(start) OVER o IS NULL THEN last ELSE greatest(start, lead(start) OVER o - 1)
            END AS ends
          FROM {src} v JOIN range_ USING (doc_id)
          WINDOW o AS (PARTITION BY doc_id ORDER BY start, CASE section_id {_ORD} END)) e"""


view("level1", _ends(f"(SELECT * FROM votes WHERE section_id NOT IN ({_KIDS}))"), "votes", "range_", "signed_")
view("scoped_lines", " UNION ALL ".join(f"""
    SELECT DISTINCT doc_id, '{k}' AS section_id, page FROM lines_
    WHERE len(string_split(line, ' ')) <= {ev.LINE_WORDS} AND {anchor_sql('line', k)}""" for k in ev.PARENTS),
     "lines_")
view("kids", f"""
    SELECT k.doc_id, k.section_id, k.parent, p.start AS p_start, p."end" AS p_end
    FROM (SELECT doc_id, section_id, CASE section_id {_PARENT} END AS parent FROM
      (SELECT doc_id, unnest([{_KIDS}]) AS section_id FROM range_)) k
    LEFT JOIN level1 p ON p.doc_id = k.doc_id AND p.section_id = k.parent""", "range_", "level1")
view("strict_", """
    SELECT k.doc_id, k.section_id, c.start_page, c.signal FROM kids k JOIN pool c USING (doc_id, section_id)
    WHERE c.start_page BETWEEN p_start AND p_end""", "kids", "pool")
view("inside_", """
    SELECT DISTINCT * FROM (SELECT * FROM strict_ UNION ALL
      SELECT k.doc_id, k.section_id, s.page, 'scoped_line' FROM kids k JOIN scoped_lines s USING (doc_id, section_id)
      WHERE s.page BETWEEN p_start AND p_end AND NOT EXISTS (SELECT 1 FROM strict_ x
        WHERE x.doc_id = k.doc_id AND x.section_id = k.section_id))""", "strict_", "kids", "scoped_lines")
view("kid_votes", f"""
    SELECT doc_id, section_id, start, signals, CASE WHEN n >= 2 THEN 'high' ELSE 'low' END AS confidence
    FROM (SELECT doc_id, section_id, g, min(start_page) AS start, count(DISTINCT signal) AS n,
        max(coalesce(CASE signal {_RANK} END, 0)) AS rank, string_agg(DISTINCT signal, ',' ORDER BY signal) AS signals
      FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id, section_id ORDER BY start_page) AS g
        FROM (SELECT *, CASE WHEN start_page - lag(start_page) OVER (PARTITION BY doc_id,
                section_id ORDER BY start_page) > 1 THEN 1 ELSE 0 END AS new FROM inside_)) GROUP BY 1, 2, 3)
    QUALIFY row_number() OVER (PARTITION BY doc_id, section_id ORDER BY n DESC, rank DESC, start) = 1""", "inside_")
view("chosen2", """
    SELECT doc_id, section_id, start, signals, confidence, 1 AS pass, NULL AS parent, NULL::int AS p_end, "end" AS own
    FROM level1
    UNION ALL SELECT k.doc_id, k.section_id, v.start, v.signals, v.confidence, 1, NULL, NULL, NULL
      FROM kids k JOIN votes v USING (doc_id, section_id) WHERE p_start IS NULL
    UNION ALL SELECT k.doc_id, k.section_id, v.start, v.signals, v.confidence, 2, k.parent, k.p_end, NULL
      FROM kids k JOIN kid_votes v USING (doc_id, section_id)""", "level1", "kids", "votes", "kid_votes")
view("placed2", _ends("chosen2"), "chosen2", "range_", "signed_")


@query("s23_second_pass", sql("""
    SELECT s.doc_id, s.section_id, CASE WHEN p.start IS NOT NULL THEN 'found' WHEN s.due THEN 'not_found'
        ELSE 'not_present' END AS status, p.start,
      CASE WHEN own IS NOT NULL THEN own ELSE least(p."end", coalesce(p.p_end, p."end")) END AS "end",
      coalesce(p.signals, '') AS signals, coalesce(p.confidence, 'low') AS confidence, p.pass,
      CASE WHEN k.p_start IS NOT NULL THEN k.parent END AS parent
    FROM due_ s LEFT JOIN placed2 p USING (doc_id, section_id) LEFT JOIN kids k USING (doc_id, section_id)""",
                               "due_", "placed2", "kids"))
def s23_second(spark, d):
    return _listed(ev.two_pass(_docs(spark, d)))


@query("d39_locator_evaluation", sql("""
    SELECT section_id, count(*) AS labelled, 1.0::double AS found_rate,
      avg(CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END) AS exact_rate
    FROM slots WHERE status = 'found' GROUP BY 1""", "slots"))
def d39(spark, d):
    # Labels: the found ranges, shifted by a page on odd documents.
    # Dealt out by slot, both sides of the evaluation share one exchange, and the evidence is worked out once.
    found = ev.printed_sections(_docs(spark, d)).where("status = 'found'").select(
        "doc_id", "section_id", "start", "end").repartition("doc_id", "section_id")
    labels = found.select("doc_id", "section_id", "start",
                          (F.col("end") + F.col("doc_id") % 2).cast("int").alias("end"))
    return loc.evaluation(found, labels)


@query("s25_tagged_over_printed", sql("""
    SELECT doc_id::varchar AS company_number, s.section_id,
      CASE WHEN h.filing_id IS NOT NULL OR status <> 'found' THEN 'tagged' ELSE 'printed' END
        AS source,
      CASE WHEN h.filing_id IS NOT NULL THEN 'found' ELSE status END AS status
    FROM (SELECT doc_id, section_id, CASE WHEN status = 'found' THEN 'found' ELSE 'not_found' END
            AS status FROM slots) s
    LEFT JOIN (SELECT DISTINCT filing_id, section_id FROM hits) h
      ON h.filing_id = s.doc_id::varchar AND h.section_id = s.section_id""", "slots", "hits"))
def s25(spark, d):
    slots = ev.printed_sections(_docs(spark, d)).select(
        F.col("doc_id").cast("string").alias("company_number"), "section_id",
        F.when(F.col("status") == "found", "found").otherwise("not_found").alias("status"),
        F.lit(None).cast("string").alias("text"))
    texts = sec.text_layer(bridge.bodies(spark, d)).select(
        F.col("filing_id").alias("company_number"), "section_id", "text")
    return sec.prefer_tagged_slots(slots, texts).drop("text")


@query("s24_assembled_result", sql("""
    SELECT d.doc_id, d.dialect, filleted::int AS filleted, income_page, balance_page,
      (SELECT count(*) FROM pfacts p WHERE p.doc_id = d.doc_id AND statement = 'balance_sheet')
        AS balance_items,
      CASE WHEN filleted AND d.dialect = 'uk_gaap' THEN NULL ELSE
        (SELECT count(*) FROM pfacts p WHERE p.doc_id = d.doc_id
           AND statement = 'income_statement') END AS income_items
    FROM dialects d JOIN r3 USING (doc_id)""", "dialects", "r3", "pfacts"))
def s24(spark, d):
    a = filing_merge.assembled(bridge.tokens(spark, d))
    return a.select(
        "doc_id", "dialect", F.col("filleted").cast("int").alias("filleted"), "income_page",
        "balance_page",
        F.coalesce(F.aggregate(F.map_values("balance_sheet"), F.lit(0),
                               lambda s, m: s + F.size(m)), F.lit(0)).cast("bigint").alias(
            "balance_items"),
        F.when(~F.col("filleted") | (F.col("dialect") == "ifrs"),
               F.coalesce(F.size("income_statement"), F.lit(0))).cast("bigint").alias(
            "income_items"))


@query("j3_printed_merge", sql("""
    SELECT company_number, year, field, value FROM (
      SELECT (doc_id // 4)::varchar AS company_number, year, field, value, doc_id FROM pcanon)
    QUALIFY row_number() OVER (PARTITION BY company_number, year, field
      ORDER BY doc_id DESC) = 1""", "pcanon"))
def j3(spark, d):
    # Documents of one company: newer documents have larger numbers.
    facts = filing_merge.printed_cells(bridge.tokens(spark, d))
    cells = facts.select(
        F.floor(F.col("doc_id") / 4).cast("string").alias("company_number"), "year", "field", "value",
        F.col("doc_id").cast("decimal(38,0)").alias("recency"))
    return fact_ops.newest_filing(cells)
