"""Positioned tokens: clustering, page text, page roles and printed tables.

A page is bounded by its paper size, so windows and ordered arrays are partitioned by
(doc, page) and never by document.  Only small per-page results are grouped by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill import lookups
from ledgermill.functions import numbers, text

PAGE = ["doc_id", "page"]
LABEL_EDGE = 0.40
NOTE_ZONE = (0.35, 0.55)
COLUMN_GAP = 60
ROW_GAP = 20
CONTENTS_ROW_GAP = 15
NOTE_REACH = 25


def with_centres(tokens: DataFrame) -> DataFrame:
    return tokens.withColumns({"x": (F.col("x0") + F.col("x1")) / 2,
                               "y": (F.col("y0") + F.col("y1")) / 2})


def number_tokens(tokens: DataFrame) -> DataFrame:
    """Tokens that look like a number.

    The one-element explode binds the text, so that a costly text is built once per token and not
    once for each time that the test names it.
    """
    bound = tokens.select(*[c for c in tokens.columns if c != "text"], F.explode(F.array("text")).alias("text"))
    return bound.where(numbers.is_number_text(F.col("text")))


def islands(df: DataFrame, keys: list[str], position: str, gap: float, out: str,
            ties: list[str] | None = None) -> DataFrame:
    """Number chained clusters: a new one starts where the step from the previous exceeds gap."""
    order = W.partitionBy(*keys).orderBy(position, *(ties or []))
    step = F.col(position) - F.lag(position).over(order)
    return df.withColumn("_new", F.coalesce((step > gap).cast("int"), F.lit(0))).withColumn(
        out, F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int")).drop(
        "_new")


def anchored_rows(df: DataFrame, keys: list[str], position: str, gap: float,
                  out: str) -> DataFrame:
    """Number clusters measured from their first member.

    A fold over the distinct positions of a page finds where rows begin (bounded by the page
    height); a member's number is how many rows begin at or above it.
    """
    others = [c for c in df.columns if c not in keys]

    def step(starts, p):
        return F.when((F.size(starts) == 0) | (p - F.element_at(starts, -1) > gap),
                      F.concat(starts, F.array(p))).otherwise(starts)

    pages = df.groupBy(*keys).agg(
        F.collect_list(F.struct(*others)).alias("_items"),
        F.sort_array(F.collect_set(position)).alias("_ys"))
    starts = pages.select(*keys, "_items", F.aggregate(
        "_ys", F.array().cast("array<double>"), step).alias("_starts"))
    return starts.select(*keys, "_starts", F.inline("_items")).withColumn(
        out, F.size(F.filter("_starts", lambda a: a <= F.col(position))) - 1).drop("_starts")


def joined_text(order: list[str], value: str = "text", sep: str = " ") -> Column:
    """Ordered string aggregate."""
    item = F.struct(*order, F.col(value).alias("_t"))
    return F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda t: t["_t"]), sep)


def _cut(frac: float) -> str:
    return f"_c{round(frac * 100):02d}"


def page_text(tokens: DataFrame, items: bool = False) -> DataFrame:
    """(doc_id, page, text, quality, top bands): one row per page.

    With ``items`` also the page's (y, x, text) in reading order, for steps that need rows.

    A page's tokens are collected once, in reading order; text and bands are cut from that array,
    so tokens are shuffled once for every operator that reads page text.  The bands of a page
    without a height are shares of its range of y.
    """
    pages = with_centres(tokens).groupBy(*PAGE).agg(
        F.sort_array(F.collect_list(F.struct("y", "x", "text"))).alias("_t"),
        F.max("page_height").alias("_h"), F.min("y").alias("_lo"), F.max("y").alias("_hi"),
        F.coalesce(F.avg("conf"), F.lit(1.0)).alias("quality"),
        F.collect_set(F.when(F.trim("text").startswith("20") & F.trim("text").rlike("^20[0-9]{2}$"),
                             F.trim("text").cast("int"))).alias("year_tokens"))

    # The cuts are columns, so that they are found once for each page and not for each token.
    pages = pages.withColumns({_cut(frac): F.coalesce(
        F.col("_h") * frac, F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac) for frac in (0.05, 0.15, 0.25, 0.30)})

    def inside(frac):
        return F.filter("_t", lambda t: t["y"] <= F.col(_cut(frac)))

    def joined(items):
        return F.array_join(F.transform(items, lambda t: t["text"]), " ")

    across = F.sort_array(F.transform("_t05", lambda t: F.struct(t["x"], t["y"], t["text"])))
    # Upper case: changed by lower() and unchanged by upper().
    caps = F.filter("_t25", lambda t: (F.upper(t["text"]) == t["text"]) & (F.lower(t["text"]) != t["text"]))
    return pages.withColumns({"_t05": inside(0.05), "_t25": inside(0.25)}).select(
        *PAGE, joined(F.col("_t")).alias("text"), "quality", joined(F.col("_t05")).alias("top05"),
        joined(across).alias("header"), joined(inside(0.15)).alias("top15"),
        joined(F.col("_t25")).alias("top25"), joined(inside(0.30)).alias("top30"),
        F.size("_t25").cast("long").alias("n25"), F.size(caps).cast("long").alias("caps25"), "year_tokens",
        *([F.col("_t").alias("items")] if items else []))


def with_band_flags(pages: DataFrame) -> DataFrame:
    return pages.withColumn("is_contents", F.upper("top25").contains("CONTENTS"))


# --- page roles -----------------------------------------------------------
# Titles of statement pages.
INCOME_TITLES = ["INCOME STATEMENT", "PROFIT AND LOSS ACCOUNT",
                 "STATEMENT OF COMPREHENSIVE INCOME",
                 "STATEMENT OF INCOME AND RETAINED EARNINGS", "INCOME AND RETAINED EARNINGS"]
BALANCE_TITLES = ["BALANCE SHEET", "STATEMENT OF FINANCIAL POSITION"]
CASH_TITLES = ["CASH FLOW STATEMENT", "STATEMENT OF CASH FLOWS", "CASH FLOWS"]


def phrase_flags(pages: DataFrame, phrases: dict[str, str], extra: list[Column] = ()) -> DataFrame:
    """One row per document: does each (lower-case) phrase occur anywhere in its text?

    Phrases are tested per page and OR-ed, so no document text is assembled.  A phrase may
    run over a page end, so the joint of every two pages is tested as well.  ``extra``
    aggregates over the pages ride along in the same pass.
    """
    reach = max(len(p) for p in phrases.values())
    low = F.lower("text")
    kept = [c for c in pages.columns if c not in (*PAGE, "text")]
    inside = pages.select(*PAGE, *kept, F.substring(low, 1, reach).alias("head"),
                          F.right(low, F.lit(reach)).alias("tail"),
                          *[low.contains(p).alias(n) for n, p in phrases.items()])
    following = F.lead("head").over(W.partitionBy("doc_id").orderBy("page"))
    joint = F.concat_ws(" ", "tail", "following")
    return inside.withColumn("following", following).groupBy("doc_id").agg(
        F.max("page").alias("last_page"), *extra,
        *[F.bool_or(F.col(n) | joint.contains(p)).alias(n) for n, p in phrases.items()])


DIALECT_PHRASES = {f"i{k}": p for k, p in enumerate(lookups.IFRS_SIGNALS)} | {
    f"u{k}": p for k, p in enumerate(lookups.UKGAAP_SIGNALS)}


def documents(pages: DataFrame, marks: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: filleted, statement pages, notes pages, years and dialect.

    ``marks`` names boolean columns of the pages; each comes back as the array of the pages that have it,
    beside the document's ``last_page``.

    The first page in page order takes each statement role, and a page takes one role only.
    The title tests are reduced to one small struct per titled page, so a single pass over
    the pages and one ordered fold per document settle everything.
    """
    up, top = F.upper("text"), F.upper("top15")
    not_continued = ~top.contains("CONTINUED")
    filleted = (up.contains("OPTED NOT TO DELIVER") & up.contains("PROFIT AND LOSS")) | (
        up.contains("SECTION 444(4)"))
    titled = F.struct(
        F.col("page"),
        (text.contains_any(top, INCOME_TITLES)
         & ~up.contains("OPTED NOT TO DELIVER")).alias("inc"),
        (text.contains_any(top, BALANCE_TITLES) & not_continued).alias("bal"),
        (text.contains_any(top, CASH_TITLES) & not_continued).alias("cf"),
        (top.contains("NOTES TO THE") & top.contains("FINANCIAL STATEMENTS")).alias("nt"),
        F.col("year_tokens").alias("years"))
    flagged = with_band_flags(pages).select(
        *PAGE, "text", filleted.alias("filleted"),
        F.when(~F.col("is_contents"), titled).alias("c"), *marks)
    small = flagged.select(*PAGE, "text", "filleted", *marks, F.when(
        F.col("c.inc") | F.col("c.bal") | F.col("c.cf") | F.col("c.nt"), F.col("c")).alias(
        "candidate"))
    docs = phrase_flags(small, DIALECT_PHRASES, [
        F.bool_or("filleted").alias("filleted"),
        F.sort_array(F.collect_list("candidate")).alias("cs"),
        *[F.collect_list(F.when(F.col(m), F.col("page"))).alias(m) for m in marks]])
    start = F.struct(*[F.lit(None).cast("int").alias(n) for n in ("i", "b", "c")])

    def step(acc, p):
        inc = p["inc"] & acc["i"].isNull() & ~F.col("filleted")
        bal = ~inc & p["bal"] & acc["b"].isNull()
        cf = ~inc & ~bal & p["cf"] & acc["c"].isNull()
        return F.struct(
            F.when(inc, p["page"]).otherwise(acc["i"]).alias("i"),
            F.when(bal, p["page"]).otherwise(acc["b"]).alias("b"),
            F.when(cf, p["page"]).otherwise(acc["c"]).alias("c"))

    folded = docs.withColumn("r", F.aggregate("cs", start, step))
    taken = F.array(F.col("r.i"), F.col("r.b"), F.col("r.c"))

    def is_taken(p):
        return F.exists(taken, lambda t: t.eqNullSafe(p["page"]))

    notes = F.transform(F.filter("cs", lambda p: p["nt"] & ~is_taken(p)), lambda p: p["page"])
    years = F.sort_array(F.array_distinct(F.flatten(F.transform(
        F.filter("cs", is_taken), lambda p: p["years"]))), False)
    score = {s: sum((F.col(n).cast("int") for n in DIALECT_PHRASES if n[0] == s), F.lit(0))
             for s in "iu"}
    return folded.select(
        "doc_id", "filleted", F.col("r.i").alias("income_page"),
        F.col("r.b").alias("balance_page"), F.col("r.c").alias("cashflow_page"),
        notes.alias("notes_pages"), F.get(years, F.lit(0)).alias("current_year"),
        F.get(years, F.lit(1)).alias("prior_year"),
        F.when(score["i"] > score["u"], "ifrs").otherwise("uk_gaap").alias("dialect"),
        *marks, *(["last_page"] if marks else []))


def page_roles(pages: DataFrame) -> DataFrame:
    """(doc_id, filleted, income_page, balance_page, cashflow_page, notes_pages)."""
    return documents(pages).drop("current_year", "prior_year", "dialect")


def year_columns(pages: DataFrame) -> DataFrame:
    """(doc_id, current_year, prior_year): the two latest year tokens of statement pages."""
    return documents(pages).select("doc_id", "current_year", "prior_year").where(
        "current_year is not null")


def with_dialect(pages: DataFrame) -> DataFrame:
    """(doc_id, dialect): more international than local phrases means ifrs."""
    return documents(pages).select("doc_id", "dialect")


def statement_pages(docs: DataFrame) -> DataFrame:
    """One row per statement or notes page with its document's years and dialect.

    A page has one role, so the result is unique by page.  Income is absent when filleted.
    """
    def one(name, col):
        return F.struct(F.lit(name).alias("statement"), F.col(col).alias("page"))

    fixed = F.array(one("income_statement", "income_page"), one("balance_sheet", "balance_page"),
                    one("cash_flow_statement", "cashflow_page"))
    notes = F.transform("notes_pages", lambda p: F.struct(
        F.lit("notes").alias("statement"), p.alias("page")))
    held = [c for c in ("current_year", "prior_year", "dialect") if c in docs.columns]
    return docs.select("doc_id", *held, F.inline(F.concat(fixed, notes))).where(
        "page is not null")


# --- printed tables -------------------------------------------------------
def _over_page() -> W:
    return W.partitionBy(*PAGE)


def with_note_column(t: DataFrame) -> DataFrame:
    """Add v, is_num and note_x: centre of the page's column of small integers, if any.

    ``t`` has centres.  Window aggregates over the page, so tokens are not joined to
    themselves and one shuffle by page serves all table steps.
    """
    lo, hi = NOTE_ZONE
    t = t.withColumns({"v": numbers.printed_number(F.col("text")),
                       "is_num": numbers.is_number_text(F.col("text"))})
    zone = (F.col("x") > F.col("page_width") * lo) & (F.col("x") < F.col("page_width") * hi)
    nx = F.when(F.col("is_num") & F.col("v").between(1, 30) & zone, F.col("x"))
    w = _over_page()
    return t.withColumns({"_n": F.count(nx).over(w), "_lo": F.min(nx).over(w),
                          "_hi": F.max(nx).over(w), "_avg": F.avg(nx).over(w)}).withColumn(
        "note_x", F.when((F.col("_n") >= 2) & (F.col("_hi") - F.col("_lo") < 30),
                         F.col("_avg"))).drop("_n", "_lo", "_hi", "_avg")


def note_column(tokens: DataFrame) -> DataFrame:
    """(doc_id, page, note_x) of the pages that have a notes column."""
    return with_note_column(with_centres(tokens)).groupBy(*PAGE).agg(
        F.max("note_x").alias("note_x")).where("note_x is not null")


def with_value_columns(t: DataFrame) -> DataFrame:
    """Add c1 and c2, the centres of the current and prior value columns of the page.

    ``t`` carries note_x and the document's two years.  With more than two clusters the
    left half is averaged into the current column and the right half into the prior one.
    Pages without values drop out.
    """
    near_note = F.coalesce(F.abs(F.col("x") - F.col("note_x")) < NOTE_REACH, F.lit(False))
    is_year = F.coalesce((F.col("v") == F.col("current_year"))
                         | (F.col("v") == F.col("prior_year")), F.lit(False))
    t = t.withColumns({"near_note": near_note, "is_year": is_year})
    is_val = F.coalesce(F.col("is_num") & (F.abs(F.col("v")) > 50) & ~is_year & ~near_note
                        & (F.col("x") > F.col("page_width") * LABEL_EDGE), F.lit(False))
    t = islands(t.withColumn("is_val", is_val), [*PAGE, "is_val"], "x", COLUMN_GAP, "k")
    cx = F.avg("x").over(W.partitionBy(*PAGE, "is_val", "k"))
    t = t.withColumn("cx", F.when(F.col("is_val"), cx))
    t = t.withColumn("cs", F.sort_array(F.collect_set("cx").over(_over_page()))).where(
        F.size("cs") > 0)
    n = F.size("cs")
    half = F.floor(n / 2).cast("int")

    def mean(a, count):
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / count

    return t.withColumns({
        "c1": F.when(n <= 2, F.get("cs", F.lit(0))).otherwise(
            mean(F.slice("cs", F.lit(1), half), half)),
        "c2": F.when(n == 1, F.col("page_width") * 0.85).when(n == 2, F.get("cs", F.lit(1)))
        .otherwise(mean(F.slice("cs", half + 1, n - half), n - half)),
    }).drop("is_val", "k", "cx", "cs")


def table_rows(tokens: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of the statement pages: label text, last number per value column.

    ``pages`` (see statement_pages) picks the pages first, so the costly branch reads only
    them.  One row per (doc, page, row number) with the page's statement,
    dialect and years.
    """
    held = ["statement", "dialect", "current_year", "prior_year"]
    # Only the document is a key, so tokens that are dealt out by it are not shuffled again, and a document's
    # few pages are hashed, so that its tokens pass by unsorted.
    few = pages.withColumnsRenamed({"doc_id": "_doc", "page": "_page"}).hint("shuffle_hash")
    on_page = (F.col("doc_id") == F.col("_doc")) & (F.col("page") <= F.col("_page")) & (F.col("page") >= F.col("_page"))
    t = with_centres(tokens.join(few, on_page).drop("_doc", "_page")).select(
        *PAGE, *held, "x", "y", "text", "page_width")
    t = with_value_columns(with_note_column(t))
    t = islands(t, PAGE, "y", ROW_GAP, "row", ["x", "text"])
    middle = (F.col("c1") + F.col("c2")) / 2
    zone = (F.when(F.col("x") < F.col("page_width") * LABEL_EDGE, "label")
            .when(F.col("near_note"), "note").when(F.col("x") < middle, "c1").otherwise("c2"))
    t = t.withColumns({"zone": zone,
                       "v": F.when(F.col("is_num") & ~F.col("is_year"), F.col("v"))})
    pos = F.struct("y", "x", "text")
    label = F.when(F.col("zone") == "label", F.struct("x", "y", F.col("text").alias("_t")))
    return t.groupBy(*PAGE, "row").agg(
        *[F.first(c).alias(c) for c in held],
        F.lower(F.trim(F.array_join(F.transform(
            F.sort_array(F.collect_list(label)), lambda e: e["_t"]), " "))).alias("label"),
        F.count_if(F.col("is_num") & F.col("zone").isin("c1", "c2")).alias("n_numbers"),
        F.max_by("v", F.when((F.col("zone") == "c1") & F.col("v").isNotNull(), pos)).alias("v1"),
        F.max_by("v", F.when((F.col("zone") == "c2") & F.col("v").isNotNull(), pos)).alias("v2"))


def carried_labels(rows: DataFrame) -> DataFrame:
    """Value rows with the label-only rows above them prefixed, plus nil lines.

    ``rows`` carries ``own_field`` (the field its own label names).  A label-only row is a
    nil line (0, 0) when it names a field and the next row names another; otherwise its
    text is carried down to the next row with numbers.
    """
    order = W.partitionBy(*PAGE).orderBy("row")
    has_numbers = F.col("n_numbers") > 0
    label_only = (F.col("label") != "") & ~has_numbers
    nil = label_only & F.col("own_field").isNotNull() & F.coalesce(
        F.exists(F.lead("named_fields").over(order), lambda f: f != F.col("own_field")),
        F.lit(False))
    kind = F.when(nil, "nil").when(label_only, "carry").when(has_numbers, "value").otherwise(
        "blank")
    r = rows.withColumn("kind", kind)
    # Anything that is not carried text closes an island of pending labels.
    closes = (F.col("kind") != "carry").cast("int")
    r = r.withColumn("island", F.coalesce(F.sum(closes).over(
        order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    in_island = W.partitionBy(*PAGE, "island").orderBy("row")
    carried = F.array_join(F.collect_list(F.when(F.col("label") != "", F.col("label"))).over(
        in_island.rowsBetween(W.unboundedPreceding, 0)), " ")
    return r.withColumn("full_label", F.when(F.col("kind") == "nil", F.col("label")).otherwise(
        F.trim(carried)))


def label_fields(label: Column, rules: list[tuple[str, str]]) -> Column:
    """All fields a label names, in match order (the first is the field of the line)."""
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(f).alias("f")) for p, f in rules])
    return F.transform(F.filter(table, lambda r: label.contains(r["p"])), lambda r: r["f"])


LABEL_LISTS = {
    ("income_statement", "uk_gaap"): lookups.INCOME_LABELS_UKGAAP,
    ("income_statement", "ifrs"): lookups.INCOME_LABELS_IFRS,
    ("balance_sheet", "uk_gaap"): lookups.BALANCE_LABELS_UKGAAP,
    ("balance_sheet", "ifrs"): lookups.BALANCE_LABELS_IFRS,
    ("cash_flow_statement", None): lookups.CASHFLOW_LABELS,
    ("notes", None): lookups.NOTES_LABELS,
}


def named_fields(label: Column) -> Column:
    """Fields a label names under the label list of the row's statement and dialect."""
    branch = None
    for (statement, dialect), rules in LABEL_LISTS.items():
        cond = F.col("statement") == statement
        if dialect:
            cond = cond & (F.col("dialect") == dialect)
        found = label_fields(label, rules)
        branch = F.when(cond, found) if branch is None else branch.when(cond, found)
    return branch


def with_named_fields(rows: DataFrame) -> DataFrame:
    """Add the fields a row's own label names, and the first of them."""
    return rows.withColumn("named_fields", named_fields(F.col("label"))).withColumn(
        "own_field", F.get("named_fields", F.lit(0)))


def match_labels(rows: DataFrame) -> DataFrame:
    """Label theta join as a broadcast: first list pattern contained in ``full_label``."""
    table = F.broadcast(lookups.label_table(rows.sparkSession))
    hit = rows.join(table, ["statement", "dialect"]).where(
        F.col("full_label").contains(F.col("pattern")))
    return hit.groupBy(*PAGE, "statement", "dialect", "row", "full_label").agg(
        F.min_by("printed_field", "rule_order").alias("printed_field"))


def printed_facts(tokens: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, statement, printed_field, dialect, years, current, prior) of statement pages.

    The last matching row of a statement wins, and a later notes page wins over an earlier.
    """
    rows = with_named_fields(table_rows(tokens, pages))
    carried = carried_labels(rows).where(F.col("kind").isin("nil", "value"))
    matched = carried.withColumns({
        "printed_field": F.get(named_fields(F.col("full_label")), F.lit(0)),
        "current": F.when(F.col("kind") == "nil", F.lit(0).cast("bigint")).otherwise(F.col("v1")),
        "prior": F.when(F.col("kind") == "nil", F.lit(0).cast("bigint")).otherwise(F.col("v2")),
    }).where(F.col("printed_field").isNotNull()
             & (F.col("current").isNotNull() | F.col("prior").isNotNull()))
    place = F.col("page").cast("bigint") * 1000000 + F.col("row")
    return matched.groupBy("doc_id", "statement", "printed_field").agg(
        *[F.first(c).alias(c) for c in ("dialect", "current_year", "prior_year")],
        F.max_by(F.struct("current", "prior"), place).alias("v"), F.max(place).alias("place")).select(
        "doc_id", "statement", "printed_field", "dialect", "current_year", "prior_year", "v.*", "place")


def by_year(facts: DataFrame) -> DataFrame:
    """(doc_id, statement, printed_field, place, year, value): one row per figure and year."""
    return facts.select(
        "doc_id", "statement", "printed_field", "place", F.inline(F.array(
            F.struct(F.col("current_year").alias("year"), F.col("current").alias("value")),
            F.struct(F.col("prior_year").alias("year"), F.col("prior").alias("value"))))).where(
        "value is not null and year is not null")


def canonical_facts(facts: DataFrame) -> DataFrame:
    """(doc_id, year, statement, field, value): printed figures under canonical names.

    Depreciation and amortisation in notes are lifted where no cash-flow line gives them.  Where
    several printed items name one field, the one that is printed last counts.  One lookup names both, so
    that the tables are read once.
    """
    spark = facts.sparkSession
    lifted = lookups.small_table(spark, [("notes", f, f) for f in ("depreciation", "amortisation")],
                                 "statement string, printed_field string, field string")
    fields = lookups.printed_fields(spark).unionByName(lifted)
    both = by_year(facts).join(F.broadcast(fields), ["statement", "printed_field"])
    rank = F.when(F.col("statement") == "notes", 0).otherwise(1)
    return both.groupBy("doc_id", "year", "field").agg(
        F.max_by(F.struct(F.col("statement").alias("source"), F.col("value").cast("double").alias("value")),
                 F.struct(rank, "place")).alias("v")).select(
        "doc_id", "year", "field", "v.*")


# --- page selection -------------------------------------------------------
def second_pass_pages(pages: DataFrame) -> DataFrame:
    """Pages worth the costly pass: contents, statement and notes pages, heading pages, and
    the neighbours of statement pages.

    ``pages`` needs only top-band text, so the choice is made before the full tokens are read, and
    it is read once: a document's row holds its marked pages and those of its statements.
    """
    heading = F.size(text.all_anchors(F.upper("top25"))) > 0
    cheap = pages.withColumns({"top15": F.col("top25"), "text": F.col("top25"), "is_heading": heading})
    docs = documents(cheap, ("is_contents", "is_heading"))
    fixed = F.array_compact(F.array("income_page", "balance_page", "cashflow_page"))
    near = F.filter(F.flatten(F.transform(fixed, lambda p: F.array(p - 1, p + 1))),
                    lambda p: p.between(1, F.col("last_page")) & F.col("doc_id").isNotNull())
    return docs.select("doc_id", F.explode(F.array_distinct(F.concat(
        fixed, "notes_pages", "is_heading", "is_contents", near))).alias("page"))


# --- headcount ------------------------------------------------------------
def employee_page(pages: DataFrame, roles: DataFrame, tokens: DataFrame) -> DataFrame:
    """(doc_id, page): the first notes page with a staff table."""
    low = F.lower("text")
    staff = text.contains_any(low, ["staff costs", "average number of persons",
                                    "average number of employees", "average headcount"])
    strong = staff & (low.contains("no.") | low.contains("average number"))
    notes = statement_pages(roles).where("statement = 'notes'").select(*PAGE)
    t = with_centres(tokens)
    heading = t.where((F.col("x") < F.col("page_width") * 0.35)
                      & (F.lower(F.trim("text")) == "employees")).select(*PAGE).distinct()
    weak = F.col("h").isNotNull() & low.contains("employees")
    found = pages.join(notes, PAGE, "left_semi").join(
        heading.withColumn("h", F.lit(True)), PAGE, "left").where(strong | weak)
    return found.groupBy("doc_id").agg(F.min("page").alias("page"))


def headcount(tokens: DataFrame, staff_pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, current, prior): average employees from the staff note.

    A labelled total (or an unlabelled number row under the categories) wins; otherwise the
    category rows are summed.
    """
    chosen = staff_pages.join(docs.select("doc_id", "current_year", "prior_year"), "doc_id", "left")
    t = with_centres(tokens.join(chosen, PAGE)).select(
        *PAGE, "x", "y", "text", "page_width", "current_year", "prior_year",
        F.lower(F.trim("text")).alias("low"))
    left = F.col("x") < F.col("page_width") * 0.35
    head = left & (F.col("low").isin("staff", "employees") | F.col("low").contains("staff costs"))
    w = _over_page()
    t = t.withColumn("start", F.min(F.when(head, F.col("y"))).over(w)).where("start is not null")
    begin = F.col("low").isin("no.", "no", "average", "number") & (F.col("y") >= F.col("start"))
    t = t.withColumn("begin", F.min(F.when(begin, F.col("y"))).over(w))
    stops = ["aggregate", "payroll", "wages", "salaries", "incurred", "costs", "remuneration",
             "auditor"]
    stop = left & text.contains_any(F.col("low"), stops) & (F.col("y") > F.col("begin"))
    t = t.withColumn("stop", F.min(F.when(stop, F.col("y"))).over(w)).where(
        F.col("y").between(F.col("start"), F.coalesce("stop", F.lit(float("inf")))))
    t = anchored_rows(t, PAGE, "y", ROW_GAP, "row")
    v = numbers.printed_number(F.col("text"))
    is_num = numbers.is_number_text(F.col("text"))
    is_year = F.coalesce((v == F.col("current_year")) | (v == F.col("prior_year")), F.lit(False))
    number = F.when(is_num & ~is_year & (v > 0), F.struct("x", "y", v.alias("_v")))
    part = F.when(~is_num & (F.col("x") < F.col("page_width") * 0.5),
                  F.struct("x", "y", F.col("low").alias("_t")))
    rows = t.groupBy(*PAGE, "row").agg(
        F.transform(F.sort_array(F.collect_list(number)), lambda e: e["_v"]).alias("vs"),
        F.trim(F.array_join(F.transform(F.sort_array(F.collect_list(part)),
                                        lambda e: e["_t"]), " ")).alias("label"))
    rows = rows.where(F.size("vs") > 0).withColumn(
        "is_total", text.first_label(F.col("label"), lookups.HEADCOUNT_LABELS))
    order = W.partitionBy(*PAGE).orderBy("row")
    subs_before = F.coalesce(F.sum((F.col("is_total") == F.lit(False)).cast("int")).over(
        order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("is_total", F.coalesce(
        "is_total", F.when((F.col("label") == "") & (subs_before > 0), F.lit(True))))
    first_total = F.when(F.col("is_total"), F.col("row"))
    one, two = F.get("vs", F.lit(0)), F.get("vs", F.lit(1))
    sub = F.col("is_total") == F.lit(False)
    docs = rows.groupBy("doc_id").agg(
        F.min_by(F.struct(one.alias("a"), two.alias("b")), first_total).alias("t"),
        F.sum(F.when(sub, one)).alias("s1"), F.sum(F.when(sub, two)).alias("s2"))
    pick = F.col("t").isNotNull()
    return docs.select(
        "doc_id", F.when(pick, F.col("t.a")).otherwise(F.nullif("s1", F.lit(0))).alias("current"),
        F.when(pick, F.col("t.b")).otherwise(F.nullif("s2", F.lit(0))).alias("prior")).where(
        "current is not null or prior is not null")
