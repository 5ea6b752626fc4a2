"""Queries over the register, sectors, metadata objects and filing lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import lookups
from ledgermill.functions import sic
from ledgermill.operators import json_ops, sectors
from ledgermill.plans import bridge
from ledgermill.queries.base import query, sql, view
from ledgermill.sources import filings as fl
from ledgermill.sources import register as reg
from ledgermill.sources import tables

_CATS = "upper(trim(\"Accounts.AccountCategory\")) IN ('SMALL', 'MEDIUM', 'LARGE')"
_STR = [c for c in bridge.REGISTER_COLUMNS if not c.startswith("Mortgages")]


def _src(c):
    return f'"{c}"'


view("tidy", "SELECT " + ", ".join(
    f"CASE WHEN {_src(c)} IS NULL OR {_src(c)} IN ('nan', 'NaN', 'None') THEN '' "
    f"ELSE {_src(c)} END AS {_src(c.strip())}" for c in bridge.REGISTER_COLUMNS)
    + " FROM register", "register")
view("cleaned", "SELECT " + ", ".join(
    [f"translate({_src(c)}, '-_', '  ') AS {_src(c.strip())}" for c in _STR]
    + [f"coalesce(try_cast(try_cast({_src(c)} AS double) AS int), 0) AS {_src(c)}"
       for c in bridge.REGISTER_COLUMNS if c.startswith("Mortgages")])
    + f" FROM register WHERE {_CATS} AND trim(\"CompanyStatus \") = 'Active'", "register")
view("ingested", """
    SELECT "CompanyNumber" AS company_number, blank("CompanyName", '') AS company_name,
      'pending' AS pipeline_status,
      nullif(blank("SICCode.SicText_1", ''), '') AS sic_code_1,
      nullif(blank("SICCode.SicText_2", ''), '') AS sic_code_2,
      nullif("CompanyStatus", '') AS company_status,
      nullif("Accounts.AccountCategory", '') AS accounts_category,
      "IncorporationDate" AS incorporation_date, "CompanyCategory" AS company_category,
      nullif(blank("RegAddress.PostTown", ''), '') AS post_town,
      nullif(blank("RegAddress.Country", ''), '') AS country
    FROM cleaned""".replace("blank(", "replace_null_word("), "cleaned")


def _words(body):
    """Expand replace_null_word(x, '') into a CASE over the null words."""
    import re

    return re.sub(
        r"replace_null_word\((\"[^\"]+\"), ''\)",
        r"CASE WHEN \1 IS NULL OR \1 IN ('nan', 'NaN', 'None') THEN '' ELSE \1 END", body)


def _ingest_sql(body):
    return _words(sql(body, "ingested"))


@query("a3_a4_tidy_snapshot", sql("SELECT * FROM tidy", "tidy"))
def a3(spark, d):
    df = reg.blank_nulls(reg.trim_headers(bridge.register(spark, d)))
    return df


@query("a1_a2_a17_csv_round_trip", sql("""
    SELECT "CompanyNumber", "CompanyStatus " AS "CompanyStatus",
           "Accounts.AccountCategory" FROM register""", "register"))
def a1(spark, d):
    path = tables.run_path(spark, "register-csv")
    raw = bridge.register(spark, d)
    tables.write_csv(raw.repartition(4, "CompanyNumber"), path)
    return reg.scan(spark, f"{path}/*.csv").select(
        "CompanyNumber", "CompanyStatus", "`Accounts.AccountCategory`")


@query("a5_filtered_projection_limit", sql("""
    SELECT count(*) AS n FROM (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
      LIMIT 50)"""))
def a5(spark, d):
    return tables.select_where(bridge.table(spark, d, "customer"), ["c_custkey", "c_name"],
                               limit=50, c_mktsegment="BUILDING").agg(F.count("*").alias("n"))


@query("a6_full_scan", "SELECT c_custkey, c_name FROM customer")
def a6(spark, d):
    return bridge.table(spark, d, "customer").select("c_custkey", "c_name")


@query("a7_in_list_scan", """SELECT n_nationkey, n_name FROM nation
    WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_24')""")
def a7(spark, d):
    return tables.select_in(bridge.table(spark, d, "nation"), "n_name",
                            ["NATION_1", "NATION_7", "NATION_24"]).select("n_nationkey", "n_name")


_INTRO = [(1, "o_orderkey", "bigint"), (2, "o_custkey", "bigint"), (3, "o_orderstatus", "string"),
          (4, "o_totalprice", "double"), (5, "o_orderdate", "timestamp_ntz"), (6, "o_orderpriority", "string")]


@query("a16_column_introspection", " UNION ALL ".join(
    f"SELECT {p} AS ordinal, '{n}' AS name, '{t}' AS type, count({n}) AS filled FROM orders"
    for p, n, t in _INTRO))
def a16(spark, d):
    o = bridge.table(spark, d, "orders")
    shape = tables.describe_columns(bridge.table(spark, d, "orders"))
    facts = F.create_map(*[x for p, n, t, _ in shape for x in (
        F.lit(n), F.struct(F.lit(p).alias("ordinal"), F.lit(t).alias("type")))])
    counts = o.agg(*[F.count(c).alias(c) for c in o.columns]).unpivot(
        [], o.columns, "name", "filled")
    return counts.select(facts[F.col("name")]["ordinal"].alias("ordinal"), "name",
                         facts[F.col("name")]["type"].alias("type"), "filled")


@query("b1_category_filter", sql(f"SELECT \"CompanyNumber\" AS company_number FROM register "
                                 f"WHERE {_CATS}", "register"))
def b1(spark, d):
    df = reg.trim_headers(bridge.register(spark, d))
    return df.where(F.upper(F.trim("`Accounts.AccountCategory`")).isin(reg.KEPT_CATEGORIES)).select(
        F.col("CompanyNumber").alias("company_number"))


@query("b2_status_filter", sql("SELECT \"CompanyNumber\" AS company_number FROM register "
                               "WHERE trim(\"CompanyStatus \") = 'Active'", "register"))
def b2(spark, d):
    df = reg.trim_headers(bridge.register(spark, d))
    return df.where(F.trim("CompanyStatus") == "Active").select(
        F.col("CompanyNumber").alias("company_number"))


@query("b3_b4_b5_cleaned_register", sql("""
    SELECT "CompanyName" AS company_name, "CompanyNumber" AS company_number,
      "CompanyCategory" AS category, nullif("SICCode.SicText_2", '') AS sic_2,
      "Mortgages.NumMortCharges" AS charges, "Mortgages.NumMortOutstanding" AS outstanding
    FROM cleaned""", "cleaned"))
def b3(spark, d):
    df = reg.blanks_to_null(reg.clean(reg.trim_headers(bridge.register(spark, d))))
    return df.select(
        F.col("CompanyName").alias("company_name"), F.col("CompanyNumber").alias("company_number"),
        F.col("CompanyCategory").alias("category"), F.col("`SICCode.SicText_2`").alias("sic_2"),
        F.col("`Mortgages.NumMortCharges`").alias("charges"),
        F.col("`Mortgages.NumMortOutstanding`").alias("outstanding"))


@query("b6_empty_columns", sql("""
    SELECT count(*) AS n, count(NULL) AS descriptions, count(NULL) AS risks FROM register""",
                               "register"))
def b6(spark, d):
    df = reg.add_empty_columns(reg.trim_headers(bridge.register(spark, d)))
    return df.agg(F.count("*").alias("n"), F.count("company_description").alias("descriptions"),
                  F.count("risks").alias("risks"))


@query("b7_b8_b9_j11_ingest", _ingest_sql("""
    SELECT company_number, company_name, pipeline_status, sic_code_1, sic_code_2, company_status,
      accounts_category, incorporation_date, company_category, post_town, country FROM ingested"""))
def j11(spark, d):
    df = reg.ingest(bridge.register(spark, d))
    return df.select("*", F.get_json_object("metadata", "$.post_town").alias("post_town"),
                     F.get_json_object("metadata", "$.country").alias("country")).drop("metadata")


@query("d37_post_ingest_checks", sql("""
    SELECT count(*) AS n_rows, 0 AS bad_category, 0 AS bad_status, 0 AS marks_left,
      cast(sum(CASE WHEN "SICCode.SicText_1" = 'NaN' THEN 1 ELSE 0 END) AS bigint) AS nan_words,
      0 AS blank_counts, 0 AS untrimmed_headers FROM cleaned""", "cleaned"))
def d37(spark, d):
    return reg.violations(reg.clean(reg.trim_headers(bridge.register(spark, d))))


@query("d13_value_counts", sql("""
    SELECT 'category' AS name, "Accounts.AccountCategory" AS value, count(*) AS n FROM cleaned
    GROUP BY 2 UNION ALL SELECT 'status', "CompanyStatus", count(*) FROM cleaned GROUP BY 2""",
                               "cleaned"))
def d13(spark, d):
    df = reg.clean(reg.trim_headers(bridge.register(spark, d)))
    counts = [df.groupBy(F.lit(n).alias("name"), F.col(f"`{c}`").alias("value")).agg(
        F.count("*").alias("n")) for n, c in (("category", "Accounts.AccountCategory"),
                                              ("status", "CompanyStatus"))]
    return counts[0].unionByName(counts[1])


@query("g1_concatenate_parts", """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def g1(spark, d):
    a = bridge.table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"))
    b = bridge.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


# --- sectors --------------------------------------------------------------
_CODE = "CASE WHEN regexp_matches(split_part({c}, ' ', 1), '^[0-9]{{5}}$') THEN " \
        "split_part({c}, ' ', 1) END"
view("sic_class", "SELECT * FROM (VALUES " + ", ".join(
    f"({c}, '{s}', '{u}')" for c, (s, u) in lookups.SIC_CLASS_SECTORS.items())
    + ") t(cls, sector, sub_sector)")
view("sic_div", "SELECT * FROM (VALUES " + ", ".join(
    f"({x}, '{s}', '{u}')" for x, (s, u) in lookups.SIC_DIVISION_SECTORS.items())
    + ") t(div, sector, sub_sector)")
view("sic_codes", "SELECT company_number, slot, raw, " + _CODE.format(c="raw")
     + " AS code FROM (SELECT company_number, unnest([1, 2, 3, 4]) AS slot, "
     "unnest([sic_code_1, sic_code_2, sic_code_3, sic_code_4]) AS raw FROM sic)", "sic")
view("sic_sectors", """
    SELECT c.*, out, CASE WHEN NOT out THEN coalesce(k.sector, v.sector) END AS sector,
      CASE WHEN NOT out THEN coalesce(k.sub_sector, v.sub_sector) END AS sub_sector FROM (
      SELECT *, code IN ('99999', '74990') OR code[1:2] IN ('97', '98', '99') AS out
      FROM sic_codes) c
    LEFT JOIN sic_class k ON k.cls = cast(code[1:4] AS int) AND code[1:2] IN ('26', '32', '64')
    LEFT JOIN sic_div v ON v.div = cast(code[1:2] AS int)""", "sic_codes", "sic_class", "sic_div")
view("classified", """
    SELECT p.company_number, p.code, p.out AS excluded, p.sector, p.sub_sector,
      p.code IS NOT NULL AND EXISTS (SELECT 1 FROM sic_sectors s WHERE s.slot > 1
        AND s.company_number = p.company_number AND s.sector IS NOT NULL
        AND s.sector IS DISTINCT FROM p.sector) AS multi_sector,
      CASE WHEN p.code IS NULL THEN 'no_sic' WHEN p.out THEN 'excluded'
           WHEN p.sector IS NULL THEN 'unknown_division' ELSE 'classified' END AS outcome
    FROM sic_sectors p WHERE slot = 1""", "sic_sectors")


@query("h6_h7_sic_parse", sql("""
    SELECT company_number, code,
           CASE WHEN code IS NOT NULL THEN trim(substr(raw, 6)) END AS description
    FROM sic_codes WHERE slot = 1""", "sic_codes"))
def h6(spark, d):
    return bridge.sic_rows(spark, d).select(
        "company_number", sic.sic_code(F.col("sic_code_1")).alias("code"),
        sic.sic_description(F.col("sic_code_1")).alias("description"))


@query("h8_sic_exclusion", sql(
    "SELECT company_number, cast(out AS int) AS excluded FROM sic_sectors WHERE slot = 1",
    "sic_sectors"))
def h8(spark, d):
    code = sic.sic_code(F.col("sic_code_1"))
    return bridge.sic_rows(spark, d).select(
        "company_number", sic.sic_excluded(code).cast("int").alias("excluded"))


@query("h9_sic_hierarchy", sql("""
    SELECT company_number, cast(code[1:2] AS int) AS division, code[1:3] AS sic_group,
           code[1:4] AS sic_class, code AS subclass, section FROM sic_codes LEFT JOIN (VALUES """
    + ", ".join(f"('{s}', {lo}, {hi})" for s, lo, hi in lookups.SIC_SECTIONS)
    + """) r(section, lo, hi) ON cast(code[1:2] AS int) BETWEEN lo AND hi WHERE slot = 1""",
                               "sic_codes"))
def h9(spark, d):
    rows = bridge.sic_rows(spark, d).select(
        "company_number", sic.sic_code(F.col("sic_code_1")).alias("code"))
    return sic.with_hierarchy(rows).drop("code")


@query("c8_sic_sector_lookup", sql(
    "SELECT company_number, code, sector, sub_sector FROM sic_sectors WHERE slot = 1",
    "sic_sectors"))
def c8(spark, d):
    rows = bridge.sic_rows(spark, d).select(
        "company_number", sic.sic_code(F.col("sic_code_1")).alias("code"))
    return sic.with_sector(rows)


@query("j4_j5_sector_job", sql("""
    SELECT company_number, sector, sub_sector, outcome,
           cast(multi_sector AS int) AS multi_sector FROM classified""", "classified"))
def j4(spark, d):
    return sectors.classify(bridge.sic_rows(spark, d)).select(
        "company_number", "sector", "sub_sector", "outcome",
        F.col("multi_sector").cast("int").alias("multi_sector"))


@query("j4_sic_metadata", sql("""
    SELECT p.company_number, p.code, count(s.code) AS n_secondary FROM classified p
    LEFT JOIN sic_codes s ON s.company_number = p.company_number AND s.slot > 1
    WHERE p.code IS NOT NULL GROUP BY 1, 2""", "classified", "sic_codes"))
def j4_meta(spark, d):
    meta = sectors.sic_metadata(sectors.classify(bridge.sic_rows(spark, d)))
    return meta.select(
        "company_number",
        F.get_json_object("metadata_patch", "$.sic_codes.primary.code").alias("code"),
        F.json_array_length(F.get_json_object("metadata_patch", "$.sic_codes.secondary")).cast(
            "bigint").alias("n_secondary"))


@query("d10_outcome_counts", sql("""
    SELECT count(*) FILTER (outcome = 'classified') AS classified,
      count(*) FILTER (outcome = 'excluded') AS excluded,
      count(*) FILTER (outcome = 'no_sic') AS no_sic,
      count(*) FILTER (outcome = 'unknown_division') AS unknown_division,
      count(*) FILTER (multi_sector) AS multi_sector FROM classified""", "classified"))
def d10(spark, d):
    return sectors.outcome_counts(sectors.classify(bridge.sic_rows(spark, d)))


@query("d11_sector_distribution", sql("""
    SELECT sector, count(*) AS n FROM classified WHERE sector IS NOT NULL GROUP BY 1""",
                                      "classified"))
def d11(spark, d):
    return sectors.sector_distribution(sectors.classify(bridge.sic_rows(spark, d)))


@query("d12_keys_by_sector", sql("""
    SELECT sector, sub_sector, count(*) AS n FROM classified WHERE code IS NOT NULL
    GROUP BY 1, 2""", "classified"))
def d12(spark, d):
    batches = sectors.key_batches(sectors.classify(bridge.sic_rows(spark, d)))
    return batches.groupBy("sector", "sub_sector").agg(
        F.sum(F.size("keys")).alias("n"))


@query("b24_sector_count_flag", sql("""
    SELECT coalesce(sector NOT IN ('Public Services'), false)::int AS in_sector_counts,
           count(*) AS n FROM classified GROUP BY 1""", "classified"))
def b24(spark, d):
    return sectors.classify(bridge.sic_rows(spark, d)).groupBy(
        F.col("in_sector_counts").cast("int").alias("in_sector_counts")).agg(
        F.count("*").alias("n"))


@query("a21_bulk_sector_update", sql("""
    SELECT company_number, CASE WHEN code IS NOT NULL THEN sector ELSE 'stale' END AS sector
    FROM classified""", "classified"))
def a21(spark, d):
    rows = bridge.sic_rows(spark, d)
    target = rows.select("company_number", F.lit("stale").alias("sector"))
    updates = sectors.classify(rows).where("code is not null").select("company_number", "sector")
    return tables.update_keyed(target, updates, "company_number", ["sector"])


# --- metadata -------------------------------------------------------------
_DATE = "strftime(try_cast(metadata ->> '$.last_accounts_date' AS date), '%Y-%m-%d')"
view("migrated", f"""
    SELECT company_number, coalesce(pipeline_status, metadata ->> '$.pipeline.status')
      AS pipeline_status, coalesce(filing_format, metadata ->> '$.filing_format') AS filing_format,
      {_DATE} AS last_accounts_date, coalesce(sic_code_1, metadata ->> '$.sic_code_1')
      AS sic_code_1 FROM companies""", "companies")


@query("b10_json_path_extraction", sql("""
    SELECT company_number, metadata ->> '$.pipeline.status' AS status,
           cast(metadata ->> '$.props.k' AS int) AS k FROM companies""", "companies"))
def b10(spark, d):
    return bridge.companies(spark, d).select(
        "company_number", F.get_json_object("metadata", "$.pipeline.status").alias("status"),
        F.get_json_object("metadata", "$.props.k").cast("int").alias("k"))


@query("b11_b12_backfill", sql("SELECT * FROM migrated", "migrated"))
def b11(spark, d):
    return json_ops.backfill(bridge.companies(spark, d)).select(
        "company_number", "pipeline_status", "filing_format",
        F.col("last_accounts_date").cast("string").alias("last_accounts_date"), "sic_code_1")


@query("b11_backfill_counts", sql(f"""
    SELECT count(*) FILTER (pipeline_status IS NULL AND metadata ->> '$.pipeline.status'
             IS NOT NULL) AS pipeline_status,
           count(*) FILTER (filing_format IS NULL AND metadata IS NOT NULL) AS filing_format,
           count({_DATE}) AS last_accounts_date,
           count(*) FILTER (sic_code_1 IS NULL AND metadata IS NOT NULL) AS sic_code_1
    FROM companies""", "companies"))
def b11_counts(spark, d):
    return json_ops.backfill_counts(bridge.companies(spark, d))


@query("a23_j7_migration_job", sql("""
    SELECT count(pipeline_status) AS pipeline_status, count(filing_format) AS filing_format,
      count(last_accounts_date) AS last_accounts_date, 0 AS company_status,
      0 AS accounts_category FROM migrated""", "migrated"))
def j7(spark, d):
    grown = tables.add_columns(bridge.companies(spark, d), {
        "pipeline_status": "string", "filing_format": "string", "last_accounts_date": "date",
        "company_status": "string", "accounts_category": "string"})
    return json_ops.backfill(grown).agg(*[F.count(c).alias(c) for c in (
        "pipeline_status", "filing_format", "last_accounts_date", "company_status",
        "accounts_category")])


@query("j8_typed_versus_metadata", sql("""
    SELECT count(*) FILTER (m.pipeline_status IS DISTINCT FROM c.metadata ->> '$.pipeline.status'
             AND c.metadata IS NOT NULL) AS pipeline_status,
           count(*) FILTER (m.filing_format <> 'scanned_pdf' AND c.metadata IS NOT NULL)
             AS filing_format, 0 AS last_accounts_date,
           count(*) FILTER (m.sic_code_1 IS DISTINCT FROM c.metadata ->> '$.sic_code_1'
             AND c.metadata IS NOT NULL) AS sic_code_1
    FROM migrated m JOIN companies c USING (company_number)""", "migrated", "companies"))
def j8(spark, d):
    return json_ops.mismatches(json_ops.backfill(bridge.companies(spark, d)))


@query("d6_filtered_counts", sql("""
    SELECT count(*) AS n, count(pipeline_status) AS pipeline_status,
      count(filing_format) AS filing_format, count(metadata) AS metadata FROM companies""",
                                 "companies"))
def d6(spark, d):
    cols = ("pipeline_status", "filing_format", "metadata")
    return bridge.companies(spark, d).agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNotNull()).alias(c) for c in cols])


@query("d7_population_check", sql("""
    SELECT unnest(['pipeline_status', 'filing_format', 'sic_code_1']) AS name,
      unnest([a, b, c]) AS filled, n AS expected,
      unnest([CASE WHEN a = n THEN 'PASS' ELSE 'FAIL' END, CASE WHEN b = n THEN 'PASS' ELSE 'FAIL'
        END, CASE WHEN c = n THEN 'PASS' ELSE 'FAIL' END]) AS result
    FROM (SELECT count(pipeline_status) AS a, count(filing_format) AS b, count(sic_code_1) AS c,
            count(*) AS n FROM migrated)""", "migrated"))
def d7(spark, d):
    cols = ["pipeline_status", "filing_format", "sic_code_1"]
    one = json_ops.backfill(bridge.companies(spark, d)).agg(
        F.count("*").alias("expected"), *[F.count(c).alias(c) for c in cols])
    return one.unpivot("expected", cols, "name", "filled").withColumn(
        "result", F.when(F.col("filled") == F.col("expected"), "PASS").otherwise("FAIL"))


@query("d8_d9_status_counts", sql("""
    SELECT coalesce(pipeline_status, 'none') AS pipeline_status, count(*) AS n FROM migrated
    GROUP BY 1""", "migrated"))
def d8(spark, d):
    return json_ops.backfill(bridge.companies(spark, d)).groupBy(
        F.coalesce("pipeline_status", F.lit("none")).alias("pipeline_status")).agg(
        F.count("*").alias("n"))


@query("d41_exact_status_count", sql("""
    SELECT count(*) AS n FROM migrated WHERE pipeline_status = 'extracted'""", "migrated"))
def d41(spark, d):
    return json_ops.backfill(bridge.companies(spark, d)).where(
        "pipeline_status = 'extracted'").agg(F.count("*").alias("n"))


@query("j13_status_sweep", sql("""
    SELECT company_number, CASE WHEN filing_format = 'scanned_pdf' THEN 'failed'
      ELSE pipeline_status END AS pipeline_status FROM migrated""", "migrated"))
def j13(spark, d):
    return json_ops.backfill(bridge.companies(spark, d)).select(
        "company_number", F.when(F.col("filing_format") == "scanned_pdf", "failed").otherwise(
            F.col("pipeline_status")).alias("pipeline_status"))


@query("e18_random_sample", sql("""
    SELECT company_number, pipeline_status, filing_format FROM migrated
    ORDER BY md5(company_number || '|7'), company_number LIMIT 5""", "migrated"))
def e18(spark, d):
    # Ordered by a seeded hash: a random-looking sample that any engine repeats.
    order = F.md5(F.concat("company_number", F.lit("|7")))
    return json_ops.backfill(bridge.companies(spark, d)).select(
        "company_number", "pipeline_status", "filing_format").orderBy(order, "company_number").limit(5)


@query("e19_limit", sql("SELECT count(*) AS n FROM (SELECT * FROM companies LIMIT 10)",
                        "companies"))
def e19(spark, d):
    return bridge.companies(spark, d).limit(10).agg(F.count("*").alias("n"))


_HAS = "metadata IS NOT NULL"
_PAT = "patch IS NOT NULL"


@query("h16_metadata_merge", sql(f"""
    SELECT company_number,
      CASE WHEN {_PAT} THEN 'extracted' ELSE metadata ->> '$.pipeline.status' END AS status,
      CASE WHEN {_HAS} THEN cast(metadata ->> '$.pipeline.tries' AS int) END AS tries,
      CASE WHEN {_PAT} THEN cast(patch ->> '$.pipeline.run' AS int) END AS run,
      CASE WHEN {_PAT} THEN 'ixbrl' WHEN {_HAS} THEN 'scanned_pdf' END AS filing_format,
      CASE WHEN {_PAT} THEN NULL ELSE metadata ->> '$.sic_code_1' END AS sic_code_1,
      cast(metadata ->> '$.props.k' AS int) AS k,
      CASE WHEN {_PAT} THEN 2 END AS tag_2
    FROM companies""", "companies"))
def h16(spark, d):
    m = json_ops.merge_patch(F.col("metadata"), F.col("patch"))

    def at(path):
        return F.get_json_object("m", path)

    return bridge.companies(spark, d).withColumn("m", m).select(
        "company_number", at("$.pipeline.status").alias("status"),
        at("$.pipeline.tries").cast("int").alias("tries"),
        at("$.pipeline.run").cast("int").alias("run"), at("$.filing_format").alias("filing_format"),
        at("$.sic_code_1").alias("sic_code_1"), at("$.props.k").cast("int").alias("k"),
        at("$.tags[1]").cast("int").alias("tag_2"))


# --- the same on binary variants: whole objects are compared, leaf by leaf ---
view("meta_top", """
    SELECT company_number, j.key AS k1, j.value AS v1, j.type AS t1, side FROM (
      SELECT company_number, 0 AS side, metadata AS m FROM companies WHERE metadata IS NOT NULL
      UNION ALL SELECT company_number, 1, patch FROM companies WHERE patch IS NOT NULL) x,
      json_each(x.m::json) j""", "companies")
view("meta_both", """
    SELECT company_number, k1, count(*) FILTER (t1 = 'OBJECT') = 2 AS merged, max(side) AS newest
    FROM meta_top GROUP BY 1, 2""", "meta_top")
view("meta_leaf", """
    SELECT company_number, k1, side, NULL AS k2, CASE WHEN v1 IS NULL THEN 'null' ELSE v1::varchar END AS v, t1 AS t
      FROM meta_top WHERE t1 <> 'OBJECT'
    UNION ALL SELECT company_number, k1, side, j.key, j.value::varchar, j.type FROM meta_top, json_each(v1) j
      WHERE t1 = 'OBJECT'""", "meta_top")
view("meta_merged", """
    SELECT l.company_number, l.k1, l.k2, l.v, l.t FROM meta_leaf l JOIN meta_both b USING (company_number, k1)
    WHERE (b.merged OR l.side = b.newest)
    QUALIFY row_number() OVER (PARTITION BY l.company_number, l.k1, l.k2 ORDER BY l.side DESC) = 1""",
     "meta_leaf", "meta_both")


@query("h16_variant_merge", sql("""
    SELECT company_number, k1 || coalesce('.' || k2, '') AS path, v AS value FROM meta_merged""", "meta_merged"))
def h16_variant(spark, d):
    both = json_ops.with_variants(bridge.companies(spark, d).select("company_number", "metadata", "patch"),
                                  "metadata", "patch")
    merged = both.select("company_number", json_ops.merge_variants(F.col("metadata"), F.col("patch")).alias("m"))
    return json_ops.variant_leaves(merged, "m")


@query("h16_variant_schema", sql("""
    SELECT path, type, count(*) AS n FROM (
      SELECT k1 || coalesce('.' || k2, '') AS path, CASE WHEN t IN ('UBIGINT', 'BIGINT') THEN 'BIGINT'
        WHEN t = 'VARCHAR' THEN 'STRING' WHEN t = 'NULL' THEN 'VOID' ELSE t END AS type FROM meta_merged
      UNION ALL SELECT DISTINCT ON (company_number, k1) k1, 'OBJECT' FROM meta_merged WHERE k2 IS NOT NULL)
    GROUP BY 1, 2""", "meta_merged"))
def h16_schema(spark, d):
    both = json_ops.with_variants(bridge.companies(spark, d), "metadata", "patch")
    merged = both.select(json_ops.merge_variants(F.col("metadata"), F.col("patch")).alias("m"))
    return json_ops.variant_schema(merged, "m")


@query("b10_variant_paths", sql("""
    SELECT company_number, metadata ->> '$.pipeline.status' AS status,
           cast(metadata ->> '$.props.k' AS int) AS k FROM companies""", "companies"))
def b10_variant(spark, d):
    m = json_ops.with_variants(bridge.companies(spark, d), "metadata")
    return m.select("company_number", F.try_variant_get("metadata", "$.pipeline.status", "string").alias("status"),
                    F.try_variant_get("metadata", "$.props.k", "int").alias("k"))


@query("b11_variant_backfill", sql("SELECT * FROM migrated", "migrated"))
def b11_variant(spark, d):
    return json_ops.backfill_variant(json_ops.with_variants(bridge.companies(spark, d), "metadata")).select(
        "company_number", "pipeline_status", "filing_format",
        F.col("last_accounts_date").cast("string").alias("last_accounts_date"), "sic_code_1")


@query("h17_tolerant_json", """
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE cast(props ->> '$.k' AS int) END
      AS k FROM events""")
def h17(spark, d):
    broken = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{"), "props")).otherwise(
        F.col("props"))
    v = json_ops.readable_object(broken)
    return bridge.table(spark, d, "events").select(
        "event_id", F.try_variant_get(v, "$.k", "int").alias("k"))


_BALANCE = ("concat('{\"fixed_assets\":{\"tangible_assets\":{\"2020\":', cast(o_custkey as string),"
            " ',\"2019\":', cast(o_orderkey % 97 as string), '}},\"net_assets\":{\"2020\":', "
            "cast(o_orderkey as string), '}}')")


@query("h18_flatten_balance", """
    SELECT o_orderkey, 'tangible_assets' AS field, 2020 AS year, o_custkey::double AS value
      FROM orders UNION ALL
    SELECT o_orderkey, 'tangible_assets', 2019, (o_orderkey % 97)::double FROM orders UNION ALL
    SELECT o_orderkey, 'net_assets', 2020, o_orderkey::double FROM orders""")
def h18(spark, d):
    df = bridge.table(spark, d, "orders").select("o_orderkey", F.expr(_BALANCE).alias("b"))
    return json_ops.flatten_balance(df, "b")


@query("h19_note_charges", sql("""
    SELECT company_number, year, coalesce(depreciation, dep) AS depreciation,
           coalesce(amortisation, am) AS amortisation FROM rows_s LEFT JOIN (
      SELECT cast(o_custkey AS varchar) AS company_number, cast(year(o_orderdate) AS int) AS year,
        max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::double END) AS dep,
        max(CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey::double END) AS am
      FROM orders GROUP BY 1, 2) USING (company_number, year)""", "rows_s"))
def h19(spark, d):
    notes = bridge.table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("company_number"),
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderkey") % 2 == 0, "depreciation").otherwise("amortisation").alias(
            "field"), F.col("o_orderkey").cast("double").alias("value"))
    return json_ops.lift_note_charges(
        bridge.statement_rows(spark, d, "o_custkey"), notes).select(
        "company_number", "year", "depreciation", "amortisation")


@query("a19_keyed_update", sql("""
    SELECT company_number, CASE WHEN cast(company_number AS bigint) % 5 = 0 THEN NULL
      ELSE pipeline_status END AS pipeline_status,
      CASE WHEN cast(company_number AS bigint) % 5 = 0 THEN 'ixbrl' ELSE filing_format END
      AS filing_format FROM companies""", "companies"))
def a19(spark, d):
    t = bridge.companies(spark, d).select("company_number", "pipeline_status", "filing_format")
    u = t.where(F.col("company_number").cast("bigint") % 5 == 0).select(
        "company_number", F.lit(None).cast("string").alias("pipeline_status"),
        F.lit("ixbrl").alias("filing_format"))
    return tables.update_keyed(t, u, "company_number", ["pipeline_status", "filing_format"])


@query("a20_upsert", """
    SELECT coalesce(a.k, b.k) AS key, coalesce(b.name, a.name) AS name FROM
      (SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey % 3 <> 0) a
      FULL JOIN (SELECT c_custkey AS k, 'new' AS name FROM customer WHERE c_custkey % 2 = 0) b
      ON a.k = b.k""")
def a20(spark, d):
    c = bridge.table(spark, d, "customer")
    t = c.where("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    u = c.where("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("key"), F.lit("new").alias("name"))
    return tables.upsert(t, u, "key")


@query("a18_a22_append_and_read_back", "SELECT count(*) * 2 AS n, sum(c_custkey)::bigint * 2 AS s "
                                       "FROM customer")
def a18(spark, d):
    path = tables.run_path(spark, "companies")
    c = bridge.table(spark, d, "customer").select("c_custkey")
    tables.append(c, path)
    tables.append(c, path)
    return spark.read.parquet(path).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("s"))


@query("a24_json_export", """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer""")
def a24(spark, d):
    text_ = bridge.table(spark, d, "customer").select(F.to_json(F.struct(
        F.col("c_custkey").alias("key"), F.struct(F.col("c_name").alias("name"),
                                                  F.col("c_mktsegment").alias("segment")).alias(
            "profile"))).alias("j"))
    return text_.select(F.get_json_object("j", "$.key").cast("bigint").alias("key"),
                        F.get_json_object("j", "$.profile.name").alias("name"),
                        F.get_json_object("j", "$.profile.segment").alias("segment"))


_WANTED = ["pipeline", "filing_format", "last_accounts_date", "employees"]


@query("g3_schema_difference", sql(f"""
    SELECT side, name, count(*) AS n FROM (
      SELECT 'extra' AS side, unnest(list_filter(json_keys(metadata), lambda k:
        NOT list_contains({_WANTED}, k))) AS name FROM companies WHERE metadata IS NOT NULL
      UNION ALL SELECT 'missing', unnest(list_filter({_WANTED}, lambda k:
        NOT list_contains(json_keys(metadata), k))) FROM companies WHERE metadata IS NOT NULL)
    GROUP BY 1, 2""", "companies"))
def g3(spark, d):
    """Keys of the stored objects against the expected keys, both ways."""
    have = F.json_object_keys("metadata")
    want = F.array(*[F.lit(k) for k in _WANTED])
    sides = F.array(F.struct(F.lit("extra").alias("side"), F.array_except(have, want).alias("k")),
                    F.struct(F.lit("missing").alias("side"), F.array_except(want, have).alias("k")))
    return bridge.companies(spark, d).where("metadata is not null").select(
        F.inline(sides)).select("side", F.explode("k").alias("name")).groupBy(
        "side", "name").agg(F.count("*").alias("n"))


@query("c12_remaining_keys", """
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders
      WHERE o_orderstatus = 'F') ORDER BY c_custkey LIMIT 20""")
def c12(spark, d):
    done = bridge.table(spark, d, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey")).distinct()
    return bridge.table(spark, d, "customer").select("c_custkey").join(
        done, "c_custkey", "left_anti").orderBy("c_custkey").limit(20)


@query("c19_source_lookup", """
    SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer
      ON o_custkey = c_custkey""")
def c19(spark, d):
    c = bridge.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return bridge.table(spark, d, "orders").join(
        c, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "c_name", "c_mktsegment")


@query("j6_cagr_backfill_job", sql("""
    SELECT count(*) FILTER (lo <= hi - 3) AS updated, count(*) FILTER (lo > hi - 3) AS skipped
    FROM (SELECT company_number, min(year) AS lo, max(year) AS hi FROM history GROUP BY 1)""",
                                   "history"))
def j6(spark, d):
    from ledgermill.operators import growth

    new = growth.backfill_cagr(bridge.history(spark, d))
    return new.agg(F.count("revenue_cagr_3y").alias("updated"),
                   F.count_if(F.col("revenue_cagr_3y").isNull()).alias("skipped"))


# --- filing lists ---------------------------------------------------------
_FMT = """CASE WHEN list_contains(resources, 'application/xhtml+xml') THEN 'ixbrl'
    WHEN NOT paper_filed THEN 'electronic_pdf' ELSE 'scanned_pdf' END"""
view("aa_ranked", f"""
    SELECT *, {_FMT} AS format, row_number() OVER (PARTITION BY company_number
      ORDER BY filing_date DESC NULLS LAST, filing_seq DESC) AS rank
    FROM filings WHERE type = 'AA'""", "filings")


@query("a8_e1_newest_filings", sql(
    "SELECT company_number, filing_id, filing_date, rank FROM aa_ranked WHERE rank <= 5",
    "aa_ranked"))
def a8(spark, d):
    return fl.newest(fl.accounts_only(bridge.filings(spark, d)), 5).select(
        "company_number", "filing_id", "filing_date", "rank")


@query("a9_latest_filing", sql(
    "SELECT company_number, filing_id FROM aa_ranked WHERE rank = 1", "aa_ranked"))
def a9(spark, d):
    return fl.latest(fl.accounts_only(bridge.filings(spark, d))).select(
        "company_number", "filing_id")


@query("a10_document_lookup", sql("""
    SELECT filing_id, CASE WHEN metadata_url LIKE 'http%' THEN metadata_url
      WHEN metadata_url IS NOT NULL THEN 'https://document-api.example.org' || metadata_url END
      AS url, CASE WHEN metadata_url LIKE 'http%' THEN filing_seq END AS size
    FROM filings""", "filings"))
def a10(spark, d):
    f = bridge.filings(spark, d)
    docs = f.where(F.col("metadata_url").startswith("http")).select(
        F.col("metadata_url").alias("url"), F.col("filing_seq").alias("size"))
    return fl.with_documents(f, docs).select("filing_id", "url", "size")


@query("b13_b14_readable_accounts", sql("""
    SELECT filing_id FROM filings WHERE type = 'AA'
      AND (filing_date IS NULL OR filing_date >= '1997')""", "filings"))
def b13(spark, d):
    return fl.readable_dates(fl.accounts_only(bridge.filings(spark, d)), "1997").select("filing_id")


@query("b15_filing_format", sql(f"SELECT filing_id, {_FMT} AS format FROM filings", "filings"))
def b15(spark, d):
    return fl.with_format(bridge.filings(spark, d)).select("filing_id", "format")


@query("d14_format_counts", sql(f"""
    SELECT {_FMT} AS format, count(*) AS n FROM filings GROUP BY 1 UNION ALL
    SELECT 'no_filing', (SELECT count(*) FROM customer WHERE c_custkey NOT IN
      (SELECT o_custkey FROM orders))""", "filings"))
def d14(spark, d):
    counts = fl.with_format(bridge.filings(spark, d)).groupBy("format").agg(
        F.count("*").alias("n"))
    have = bridge.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    none = bridge.table(spark, d, "customer").join(have, "c_custkey", "left_anti").agg(
        F.lit("no_filing").alias("format"), F.count("*").alias("n"))
    return counts.unionByName(none)


@query("d34_companies_with_format", sql(f"""
    SELECT count(DISTINCT company_number) AS n FROM filings WHERE {_FMT} = 'ixbrl'""", "filings"))
def d34(spark, d):
    f = fl.with_format(bridge.filings(spark, d))
    per = f.groupBy("company_number").agg(F.bool_or(F.col("format") == "ixbrl").alias("has"))
    return per.agg(F.count_if("has").alias("n"))


@query("j10_filing_triage", sql("""
    SELECT company_number, string_agg(format, ',' ORDER BY rank) AS formats,
           arg_min(format, rank) AS overall
    FROM aa_ranked WHERE rank <= 3 GROUP BY company_number""", "aa_ranked"))
def j10(spark, d):
    return fl.triage(bridge.filings(spark, d))


@query("b23_skip_reasons", sql("""
    SELECT cast(c_custkey AS varchar) AS company_number,
      CASE WHEN formats IS NULL THEN 'no_filing'
        WHEN NOT list_contains(formats, 'ixbrl') THEN 'all filings are ' ||
          array_to_string(formats, '/')
        WHEN c_acctbal < 0 THEN 'no data' END AS reason
    FROM customer LEFT JOIN (SELECT company_number, list(DISTINCT format ORDER BY format)
      AS formats FROM aa_ranked WHERE rank <= 3 GROUP BY 1)
    ON company_number = cast(c_custkey AS varchar)""", "aa_ranked"))
def b23(spark, d):
    t = fl.triage(bridge.filings(spark, d))
    c = bridge.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("company_number"), "c_acctbal")
    return c.join(t, "company_number", "left").select(
        "company_number", fl.skip_reason(
            F.when(F.col("formats").isNotNull(), 1), F.col("formats"),
            F.col("c_acctbal") >= 0).alias("reason"))
