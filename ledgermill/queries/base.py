"""Query registry and the comparison SQL each query is checked against."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ledgermill import schemas
from ledgermill.plans import bridge


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(fn, oracle)
        return fn
    return wrap


def view(name: str, body: str, *needs: str) -> None:
    """Define a named sub-select for comparison SQL."""
    VIEWS[name] = (needs, body)


def sql(body: str, *needs: str) -> str:
    """Comparison SQL with the named sub-selects it needs, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in columns.items())


# --- inputs ---------------------------------------------------------------
for suffix, company in (("", "l_suppkey"), ("_s", "o_custkey")):
    view(f"fact_rows{suffix}",
         f"SELECT {select_list(bridge.fact_columns(company, True))} "
         "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    view(f"facts{suffix}", f"""
        SELECT company_number, filing_id, filing_date, recency, ord, f.year, name, field, raw,
               scale, sign,
               (CASE WHEN sign = '-' THEN -1.0 ELSE 1.0 END)
               * cast(replace(raw, ',', '') AS double)
               * (CASE WHEN scale = '3' THEN 1000.0 ELSE 1.0 END) AS value
        FROM fact_rows{suffix} f JOIN tags ON name = tag
        WHERE raw <> '-' AND NOT dimensional""", f"fact_rows{suffix}", "tags")
    view(f"first_facts{suffix}", f"""
        SELECT company_number, filing_id, recency, year, field, value, ord, name, raw, scale, sign
        FROM facts{suffix} QUALIFY row_number() OVER
            (PARTITION BY company_number, filing_id, year, field ORDER BY ord) = 1""",
         f"facts{suffix}")
    view(f"cells{suffix}", f"""
        SELECT company_number, year, field, value FROM first_facts{suffix} QUALIFY row_number()
        OVER (PARTITION BY company_number, year, field ORDER BY recency DESC) = 1""",
         f"first_facts{suffix}")
    pivot = ", ".join(
        f"max(CASE WHEN field = '{f}' THEN value END) AS {f}" for f in schemas.ROW_FIELDS)
    view(f"rows{suffix}",
         f"SELECT company_number, year, {pivot} FROM cells{suffix} GROUP BY company_number, year",
         f"cells{suffix}")

view("tags", "SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', '{f}')" for t, f in bridge.BRIDGE_TAGS if f) + ") t(tag, field)")
view("filings", f"SELECT {select_list(bridge.filing_columns(True))} FROM orders")
view("history", """
    SELECT cast(o_custkey AS varchar) AS company_number, cast(year(o_orderdate) AS int) AS year,
           cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS value
    FROM orders GROUP BY 1, 2""")
view("register", f"SELECT {select_list(bridge.REGISTER_COLUMNS)} "
     "FROM customer JOIN nation ON c_nationkey = n_nationkey")
view("sic", f"SELECT {select_list(bridge.SIC_COLUMNS)} FROM part")
view("companies", f"SELECT {select_list(bridge.COMPANY_COLUMNS)}, {bridge.PATCH_COLUMN} AS patch "
     "FROM events")
