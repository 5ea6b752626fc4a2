"""Queries over tagged facts, filings and their merge into statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import lookups, schemas
from ledgermill.functions import numbers, text
from ledgermill.operators import facts as ops
from ledgermill.plans import bridge
from ledgermill.queries.base import query, sql

FACT_KEYS = ["company_number", "filing_id", "year", "field"]


@query("h1_tagged_number", sql("""
    SELECT name, count(*) AS n_facts, count(v) AS n_values, sum(v) AS total FROM (
      SELECT name, CASE WHEN raw = '-' THEN NULL ELSE cast(replace(raw, ',', '') AS double)
        * CASE WHEN scale = '3' THEN 1000 ELSE 1 END * CASE WHEN sign = '-' THEN -1 ELSE 1 END END v
      FROM fact_rows) GROUP BY name""", "fact_rows"))
def h1(spark, d):
    rows = bridge.fact_rows(spark, d)
    v = numbers.tagged_number(F.col("raw"), F.col("scale"), F.col("sign"))
    return rows.groupBy("name").agg(F.count("*").alias("n_facts"), F.count(v).alias("n_values"),
                                    F.sum(v).alias("total"))


@query("h2_scale_or_decimals", sql("""
    SELECT coalesce(scale, 'none') AS scale, decimals,
           CASE WHEN scale IS NOT NULL THEN cast(scale AS int)
                WHEN decimals = '-3' THEN 3 ELSE 0 END AS shift, count(*) AS n
    FROM fact_rows GROUP BY 1, 2, 3""", "fact_rows"))
def h2(spark, d):
    return bridge.fact_rows(spark, d).groupBy(
        F.coalesce("scale", F.lit("none")).alias("scale"), "decimals",
        numbers.scale_or_decimals(F.col("scale"), F.col("decimals")).alias("shift"),
    ).agg(F.count("*").alias("n"))


@query("h5_year_of_text", sql("""
    SELECT filing_id, cast(substr(filing_date, 1, 4) AS int) AS year FROM filings""", "filings"))
def h5(spark, d):
    return bridge.filings(spark, d).select(
        "filing_id", text.year_of(F.col("filing_date")).alias("year"))


@query("h10_tag_name_parts", sql("""
    SELECT CASE WHEN contains(name, ':') THEN split_part(name, ':', 1) ELSE '_any' END AS prefix,
           CASE WHEN contains(name, ':') THEN split_part(name, ':', 2) ELSE name END AS local,
           count(*) AS n FROM fact_rows GROUP BY 1, 2""", "fact_rows"))
def h10(spark, d):
    return bridge.fact_rows(spark, d).groupBy(
        text.prefix_of(F.col("name")).alias("prefix"),
        text.local_name(F.col("name")).alias("local")).agg(F.count("*").alias("n"))


@query("c1_tag_to_field", sql("""
    SELECT field, name, count(*) AS n, cast(count(DISTINCT company_number) AS bigint) AS companies
    FROM fact_rows JOIN tags ON name = tag GROUP BY field, name""", "fact_rows", "tags"))
def c1(spark, d):
    return ops.map_tags(bridge.fact_rows(spark, d)).groupBy("field", "name").agg(
        F.count("*").alias("n"), F.countDistinct("company_number").alias("companies"))


@query("c2_tiered_tag_lookup", sql("""
    SELECT name, CASE WHEN field IS NULL THEN NULL WHEN name LIKE 'core:%' THEN 'family'
                 ELSE '_any' END AS tier,
           field, count(*) AS n FROM fact_rows LEFT JOIN tags ON name = tag GROUP BY 1, 2, 3""",
                                     "fact_rows", "tags"))
def c2(spark, d):
    base = lookups.tag_map(spark)
    tiers = base.select(F.lit("core").alias("family"), "*").unionByName(
        base.select(F.lit("_any").alias("family"), "*"))
    rows = bridge.fact_rows(spark, d).withColumn("family", text.prefix_of(F.col("name")))
    return ops.map_tags_tiered(rows, tiers).groupBy("name", "tier", "field").agg(
        F.count("*").alias("n"))


_URIS = ["http://xbrl.frc.org.uk/fr/2023-01-01/core", "http://xbrl.frc.org.uk/FRS-102/2023/FRS-102",
         "http://xbrl.frc.org.uk/reports/2022/aurep", "http://xbrl.frc.org.uk/cd/2022/business",
         "http://xbrl.ifrs.org/taxonomy/2021", "urn:other"]


@query("c3_namespace_family", sql(f"""
    SELECT family, count(*) AS n FROM (
      SELECT CASE o_orderkey % 6 WHEN 0 THEN 'core' WHEN 1 THEN 'frs-102' WHEN 2 THEN 'aurep'
             WHEN 3 THEN 'bus' WHEN 4 THEN 'ifrs' ELSE '_any' END AS family FROM orders)
    GROUP BY family"""))
def c3(spark, d):
    uri = F.expr(bridge.pick(_URIS, "cast(o_orderkey % 6 as int)", False))
    return bridge.table(spark, d, "orders").groupBy(ops.family_of(uri).alias("family")).agg(
        F.count("*").alias("n"))


@query("c4_fact_context_join", sql("""
    SELECT company_number, year, count(*) AS n, cast(sum(CASE WHEN dimensional THEN 1 ELSE 0 END)
           AS bigint) AS n_dimensional
    FROM fact_rows GROUP BY 1, 2""", "fact_rows"))
def c4(spark, d):
    rows = bridge.fact_rows(spark, d).drop("year", "dimensional")
    return ops.join_contexts(rows, bridge.contexts(spark, d)).groupBy(
        "company_number", "year").agg(
        F.count("*").alias("n"), F.count_if("dimensional").alias("n_dimensional"))


@query("b16_plain_facts", sql("""
    SELECT company_number, count(*) AS n FROM fact_rows WHERE NOT dimensional GROUP BY 1""",
                              "fact_rows"))
def b16(spark, d):
    return ops.plain_facts(bridge.fact_rows(spark, d)).groupBy("company_number").agg(
        F.count("*").alias("n"))


@query("b17_entity_wide_members", sql("""
    SELECT company_number, count(*) AS n FROM fact_rows
    WHERE NOT dimensional OR members[1] = 'ConsolidatedGroup' GROUP BY 1""", "fact_rows"))
def b17(spark, d):
    return ops.plain_facts(bridge.fact_rows(spark, d), allow_entity_wide=True).groupBy(
        "company_number").agg(F.count("*").alias("n"))


_VERDICT = """CASE WHEN unit IS NULL THEN 'keep_unchecked' WHEN unit = 'iso4217:GBP' THEN 'keep'
    WHEN unit = 'iso4217:USD' THEN 'skip_currency' WHEN field = 'employees' THEN 'keep'
    ELSE 'skip_non_money' END"""


@query("b18_unit_guard", sql(f"""
    SELECT field, {_VERDICT} AS verdict, count(*) AS n FROM fact_rows JOIN tags ON name = tag
    GROUP BY 1, 2""", "fact_rows", "tags"))
def b18(spark, d):
    rows = ops.map_tags(bridge.fact_rows(spark, d))
    return rows.groupBy(
        "field", ops.unit_verdict(F.col("unit"), F.col("field")).alias("verdict")).agg(
        F.count("*").alias("n"))


@query("d20_unit_skip_share", sql(f"""
    SELECT count(*) AS filings, cast(sum(CASE WHEN skips = 0 THEN 1 ELSE 0 END) AS bigint)
           AS clean_filings, cast(sum(skips) AS bigint) AS skipped_facts FROM (
      SELECT filing_id, sum(CASE WHEN {_VERDICT} LIKE 'skip%' THEN 1 ELSE 0 END) AS skips
      FROM fact_rows JOIN tags ON name = tag GROUP BY filing_id)""", "fact_rows", "tags"))
def d20(spark, d):
    rows = ops.map_tags(bridge.fact_rows(spark, d))
    skip = ops.unit_verdict(F.col("unit"), F.col("field")).startswith("skip")
    per = rows.groupBy("filing_id").agg(F.count_if(skip).alias("skips"))
    return per.agg(F.count("*").alias("filings"), F.count_if(F.col("skips") == 0).alias("clean_filings"),
                   F.sum("skips").alias("skipped_facts"))


@query("d1_first_in_document", sql(
    "SELECT company_number, filing_id, year, field, value FROM first_facts", "first_facts"))
def d1(spark, d):
    return ops.first_in_document(bridge.facts(spark, d)).drop("recency")


@query("d2_newest_filing_wins", sql(
    "SELECT company_number, year, field, value FROM cells", "cells"))
def d2(spark, d):
    return bridge.cells(spark, d)


@query("c11_gap_merge_sparse", sql(
    "SELECT company_number, year, field, value FROM cells_s", "cells_s"))
def c11(spark, d):
    return bridge.cells(spark, d, "o_custkey")


@query("d3_history_merge", sql("""
    SELECT company_number, field, year, value FROM cells
    WHERE field IN ('revenue', 'operating_profit', 'employees')""", "cells"))
def d3(spark, d):
    kept = bridge.facts(spark, d).where(
        F.col("field").isin("revenue", "operating_profit", "employees"))
    return ops.newest_filing(ops.first_in_document(kept))


@query("d4_pivot_statement_rows", sql(
    "SELECT company_number, year, " + ", ".join(schemas.ROW_FIELDS) + " FROM rows", "rows"))
def d4(spark, d):
    return bridge.statement_rows(spark, d)


@query("d4_rows_with_year_spine", sql("""
    SELECT s.company_number, s.year, r.revenue, r.net_assets FROM
      (SELECT DISTINCT company_number, year FROM fact_rows_s) s
      LEFT JOIN rows_s r ON s.company_number = r.company_number AND s.year = r.year""",
                                      "fact_rows_s", "rows_s"))
def d4_spine(spark, d):
    years = bridge.fact_rows(spark, d, "o_custkey").select("company_number", "year")
    return ops.statement_rows(bridge.cells(spark, d, "o_custkey"), years,
                              ["revenue", "net_assets"])


@query("d5_year_keyed_maps", sql("""
    SELECT company_number, count(*) AS n_years, min(year) AS first_year, max(year) AS last_year,
           string_agg(cast(year AS varchar) || '=' || coalesce(cast(cast(revenue AS bigint)
             AS varchar), 'null'), ',' ORDER BY year) AS revenue_map
    FROM rows GROUP BY company_number""", "rows"))
def d5(spark, d):
    maps = ops.statement_maps(bridge.statement_rows(spark, d))
    entries = F.map_entries("income_statement")
    return maps.select(
        "company_number", F.size(entries).cast("bigint").alias("n_years"),
        F.element_at(entries, 1)["key"].cast("int").alias("first_year"),
        F.element_at(entries, -1)["key"].cast("int").alias("last_year"),
        F.array_join(F.transform(entries, lambda e: F.concat(
            e["key"], F.lit("="),
            F.coalesce(e["value"]["revenue"].cast("bigint").cast("string"), F.lit("null")))),
            ",").alias("revenue_map"))


@query("j9_value_provenance", sql("""
    SELECT company_number, filing_id, year, field, name, raw, scale, sign, value
    FROM first_facts""", "first_facts"))
def j9(spark, d):
    return ops.provenance(bridge.facts(spark, d)).drop("recency", "ord")


@query("c18_provenance_of_cells", sql("""
    SELECT c.company_number, c.year, c.field, c.value, p.name, p.raw FROM cells c JOIN (
      SELECT * FROM first_facts QUALIFY row_number() OVER
        (PARTITION BY company_number, year, field ORDER BY recency DESC) = 1) p
    ON c.company_number = p.company_number AND c.year = p.year AND c.field = p.field""",
                                      "cells", "first_facts"))
def c18(spark, d):
    keys = ["company_number", "year", "field"]
    found = ops.provenance(bridge.facts(spark, d))
    newest = found.groupBy(*keys).agg(
        F.max_by(F.struct("name", "raw"), "recency").alias("p")).select(*keys, "p.*")
    return bridge.cells(spark, d).join(newest, keys, "left")


@query("d17_unknown_tags", sql("""
    SELECT CASE WHEN contains(name, ':') THEN split_part(name, ':', 1) ELSE '_any' END AS family,
           CASE WHEN contains(name, ':') THEN split_part(name, ':', 2) ELSE name END AS local,
           count(*) AS n
    FROM fact_rows WHERE name NOT IN (SELECT tag FROM tags) GROUP BY 1, 2
    ORDER BY n DESC, family, local LIMIT 20""", "fact_rows", "tags"))
def d17(spark, d):
    missing = ops.unknown_tags(bridge.fact_rows(spark, d))
    return missing.groupBy(
        text.prefix_of(F.col("name")).alias("family"),
        text.local_name(F.col("name")).alias("local")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "family", "local").limit(20)


@query("d18_tag_coverage", sql("""
    SELECT name, filings, filings / (SELECT count(DISTINCT filing_id) FROM fact_rows) AS share
    FROM (SELECT name, count(DISTINCT filing_id) AS filings FROM fact_rows GROUP BY name)""",
                               "fact_rows"))
def d18(spark, d):
    # Deduplicating (tag, filing) first keeps a hot tag spread over all tasks.
    rows = bridge.fact_rows(spark, d)
    pairs = rows.groupBy("name", "filing_id").agg(F.lit(1).alias("one"))
    per_tag = pairs.groupBy("name").agg(F.count("*").alias("filings"))
    total = rows.select("filing_id").distinct().agg(F.count("*").alias("total"))
    one = F.lit(1).alias("one")
    return per_tag.select("*", one).join(F.broadcast(total.select("*", one)), "one").select(
        "name", "filings", (F.col("filings") / F.col("total")).alias("share"))


@query("d19_value_collisions", sql("""
    SELECT k.filing_id, k.year, k.field, k.name AS kept_tag, k.value AS kept_value,
           f.name AS dropped_tag, f.value AS dropped_value
    FROM (SELECT * FROM facts QUALIFY row_number() OVER
            (PARTITION BY filing_id, year, field ORDER BY ord) = 1) k
    JOIN facts f ON k.filing_id = f.filing_id AND k.year = f.year AND k.field = f.field
    WHERE f.ord > k.ord AND f.name <> k.name AND f.value <> k.value""", "facts"))
def d19(spark, d):
    return ops.collisions(bridge.facts(spark, d))


@query("d33_tags_by_field", sql("""
    SELECT field, string_agg(DISTINCT name, ',' ORDER BY name) AS tags
    FROM facts GROUP BY field""", "facts"))
def d33(spark, d):
    # Distinct (field, tag) pairs are bounded by the taxonomy.
    pairs = bridge.facts(spark, d).select("field", "name").distinct()
    return pairs.groupBy("field").agg(
        F.array_join(F.array_sort(F.collect_list("name")), ",").alias("tags"))


@query("d15_average_filled_cells", sql("""
    SELECT avg(n) AS avg_cells, count(*) AS companies FROM (
      SELECT company_number, count(*) AS n FROM cells_s WHERE field <> 'employees'
      GROUP BY company_number)""", "cells_s"))
def d15(spark, d):
    rows = bridge.statement_rows(spark, d, "o_custkey")
    filled = sum((F.col(f).isNotNull().cast("long") for f in schemas.STATEMENT_FIELDS), F.lit(0))
    per = rows.groupBy("company_number").agg(F.sum(filled).alias("n")).where("n > 0")
    return per.agg(F.avg("n").alias("avg_cells"), F.count("*").alias("companies"))


@query("d16_always_null_fields", sql(f"""
    SELECT f.field, (SELECT count(DISTINCT company_number) FROM cells_s) - count(c.company_number)
           AS companies_null
    FROM (SELECT unnest([{', '.join(repr(x) for x in schemas.STATEMENT_FIELDS)}]) AS field) f
    LEFT JOIN (SELECT DISTINCT company_number, field FROM cells_s) c ON f.field = c.field
    GROUP BY f.field""", "cells_s"))
def d16(spark, d):
    names = schemas.STATEMENT_FIELDS
    per = bridge.statement_rows(spark, d, "o_custkey").groupBy("company_number").agg(
        *[F.count(f).alias(f) for f in names])
    total = per.agg(*[F.count_if(F.col(f) == 0).alias(f) for f in names])
    return total.unpivot([], names, "field", "companies_null")


@query("g4_fields_null_everywhere", sql(f"""
    SELECT f.field FROM (SELECT unnest([{', '.join(repr(x) for x in schemas.ROW_FIELDS)},
      'net_assets_before_lt_liab']) AS field) f
    WHERE f.field NOT IN (SELECT field FROM cells)""", "cells"))
def g4(spark, d):
    wanted = schemas.ROW_FIELDS + ["net_assets_before_lt_liab"]
    filled = F.array_distinct(F.collect_set("field"))  # at most as many as there are fields
    held = bridge.cells(spark, d).where(F.col("field").isin(wanted)).agg(filled.alias("held"))
    return held.select(F.explode(F.array_except(F.array(*map(F.lit, wanted)), "held")).alias("field"))


@query("d35_years_per_statement", sql(f"""
    SELECT company_number,
      string_agg(cast(year AS varchar), ',' ORDER BY year) FILTER (inc) AS income_years,
      string_agg(cast(year AS varchar), ',' ORDER BY year) FILTER (bs) AS balance_years,
      cast(arg_max(op, year) AS int) AS has_operating_profit,
      cast(arg_max(dep, year) AS int) AS has_depreciation
    FROM (SELECT company_number, year, operating_profit IS NOT NULL AS op,
            depreciation IS NOT NULL AS dep,
            coalesce({', '.join(schemas.INCOME_FIELDS)}) IS NOT NULL AS inc,
            coalesce({', '.join(schemas.BALANCE_FIELDS)}) IS NOT NULL AS bs FROM rows_s)
    GROUP BY company_number""", "rows_s"))
def d35(spark, d):
    rows = bridge.statement_rows(spark, d, "o_custkey")
    inc = F.coalesce(*schemas.INCOME_FIELDS).isNotNull()
    bs = F.coalesce(*schemas.BALANCE_FIELDS).isNotNull()

    def years(cond, name):
        found = F.array_join(F.sort_array(F.collect_set(F.when(cond, F.col("year")))), ",")
        return F.nullif(found, F.lit("")).alias(name)

    return rows.groupBy("company_number").agg(
        years(inc, "income_years"), years(bs, "balance_years"),
        F.max_by(F.col("operating_profit").isNotNull().cast("int"), "year").alias(
            "has_operating_profit"),
        F.max_by(F.col("depreciation").isNotNull().cast("int"), "year").alias("has_depreciation"))


@query("d36_cells_per_statement", sql(f"""
    SELECT company_number, statement, count(*) AS n_cells,
           cast(count(DISTINCT year) AS bigint) AS n_years FROM (
      SELECT *, CASE WHEN field IN ({', '.join(repr(x) for x in schemas.INCOME_FIELDS)})
        THEN 'income_statement' WHEN field IN ({', '.join(repr(x) for x in schemas.BALANCE_FIELDS)})
        THEN 'balance_sheet' ELSE 'cash_flow_statement' END AS statement FROM cells
      WHERE field <> 'employees') GROUP BY 1, 2""", "cells"))
def d36(spark, d):
    statement = F.create_map(*[F.lit(x) for kv in schemas.STATEMENT_OF_FIELD.items() for x in kv])
    stacked = ops.cell_stack(bridge.statement_rows(spark, d)).where("value is not null")
    return stacked.groupBy("company_number", statement[F.col("field")].alias("statement")).agg(
        F.count("value").alias("n_cells"), F.countDistinct("year").alias("n_years"))


@query("d32_latest_employees", sql("""
    SELECT company_number, cast(arg_max(value, year) AS bigint) AS employees,
           string_agg(cast(year AS varchar) || '=' || cast(cast(value AS bigint) AS varchar), ','
             ORDER BY year) AS history
    FROM cells WHERE field = 'employees' GROUP BY company_number""", "cells"))
def d32(spark, d):
    emp = ops.newest_filing(ops.first_in_document(
        bridge.facts(spark, d).where("field = 'employees'")))
    pair = F.struct("year", F.concat("year", F.lit("="), F.col("value").cast("bigint")).alias("t"))
    return emp.groupBy("company_number").agg(
        F.max_by("value", "year").cast("bigint").alias("employees"),
        F.array_join(F.transform(F.sort_array(F.collect_list(pair)), lambda p: p["t"]), ",").alias(
            "history"))


@query("g2_union_of_years", sql("""
    SELECT DISTINCT company_number, year FROM cells WHERE field <> 'employees'""", "cells"))
def g2(spark, d):
    # The years of the three statements in one pass over the cells.
    fields = schemas.INCOME_FIELDS + schemas.BALANCE_FIELDS + schemas.CASH_FLOW_FIELDS
    return bridge.cells(spark, d).where(F.col("field").isin(fields)).select(
        "company_number", "year").distinct()


@query("g7_later_overwrites", sql("""
    SELECT company_number, coalesce(b.value, a.value) AS value, a.value AS old_value FROM
      (SELECT company_number, max(value) AS value FROM cells WHERE field = 'cash' GROUP BY 1) a
      LEFT JOIN (SELECT company_number, max(value) AS value FROM cells WHERE field = 'goodwill'
                 GROUP BY 1) b USING (company_number)""", "cells"))
def g7(spark, d):
    c = bridge.cells(spark, d)
    wide = c.groupBy("company_number").agg(
        F.max(F.when(F.col("field") == "cash", F.col("value"))).alias("a"),
        F.max(F.when(F.col("field") == "goodwill", F.col("value"))).alias("b")).where(
        "a is not null")
    first = F.create_map(F.lit("v"), F.col("a"))
    later = F.create_map(F.lit("v"), F.coalesce("b", "a"))
    merged = F.map_zip_with(first, later, lambda k, x, y: F.coalesce(y, x))
    return wide.select("company_number", merged["v"].alias("value"), F.col("a").alias("old_value"))


@query("g8_prefixed_audit_merge", sql("""
    SELECT company_number, string_agg('filing_' || cast(rk AS varchar) || '_' || field, ','
           ORDER BY rk, field) AS keys
    FROM (SELECT DISTINCT company_number, field, recency,
            dense_rank() OVER (PARTITION BY company_number ORDER BY recency DESC) AS rk
          FROM first_facts_s) WHERE rk <= 5 GROUP BY company_number""", "first_facts_s"))
def g8(spark, d):
    from pyspark.sql import Window as W

    first = ops.first_in_document(bridge.facts(spark, d, "o_custkey"))
    keys = first.select("company_number", "recency", "field").distinct()
    filings = keys.select("company_number", "recency").distinct()
    newest = filings.withColumn("rk", F.row_number().over(
        W.partitionBy("company_number").orderBy(F.desc("recency")))).where("rk <= 5")
    top = keys.join(newest, ["company_number", "recency"])
    item = F.struct("rk", "field")
    return top.groupBy("company_number").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(item)),
        lambda i: F.concat(F.lit("filing_"), i["rk"], F.lit("_"), i["field"])), ",").alias("keys"))
