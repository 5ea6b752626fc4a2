"""Section evidence of printed filings: one pass over the pages, then one fold by document.

A page's tokens are collected once.  Everything that a locator needs is read off that row and kept
as narrow structs; a document's structs are sorted by page and turned into its class, its primary
range, its sign-offs and the pool of candidates.  Votes, ends and the second pass are windows and
aggregates within a document, whose rows are together already.  So tokens are shuffled by page and
evidence by document, and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill import lookups
from ledgermill.functions import text
from ledgermill.operators import locators as loc
from ledgermill.operators import tokens as tok

#: A child section and the section whose pages it is looked for in.
PARENTS = {"principal_risks": "strategic_report", "section_172": "strategic_report",
           "principal_activity": "directors_report", "going_concern_directors": "directors_report",
           "critical_estimates": "accounting_policies", "going_concern_note": "accounting_policies"}
NOTE_SECTIONS = ["accounting_policies", "critical_estimates", "going_concern_note"]
#: Words of a printed line that the second pass takes for a heading.
LINE_WORDS = 12
SCOPED = "scoped_line"


def printed_rows(items: Column) -> Column:
    """Array of a page's printed rows: its (y, x, text) cut where y steps by more than the gap.

    A row starts at the first item of a y, so only the distinct y of a page are tested.  The one-element
    transforms bind what is used more than once.
    """
    def cut(ys: Column, items: Column, starts: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(ys)))
        return F.zip_with(starts, ends, lambda a, b: F.slice(items, a + 1, b - a))

    def first_items(ys: Column, steps: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: (i == 0) | (
            F.get(steps, i) - F.get(steps, i - 1) > tok.CONTENTS_ROW_GAP))
        return F.transform(heads, lambda i: F.when(i == 0, 0).otherwise(
            F.array_position(ys, F.get(steps, i)).cast("int") - 1))

    def rows(ys: Column) -> Column:
        starts = _bound(F.array_distinct(ys), lambda steps: first_items(ys, steps))
        return _bound(starts, lambda at: cut(ys, items, at))

    return _bound(items["y"], rows)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is found once, as the element of an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _across(row: Column) -> Column:
    """A printed row's (x, y, text) from left to right."""
    return F.sort_array(F.transform(row, lambda t: F.struct(t["x"].alias("x"), t["y"].alias("y"),
                                                            t["text"].alias("text"))))


def _contents_row(row: Column) -> Column:
    """Of a row from left to right: (number, section of the title left of it), the rightmost first."""
    def bare(t):
        return F.rtrim(F.trim(t["text"]), F.lit("."))

    numbers = F.filter(F.transform(F.filter(row, lambda t: bare(t).rlike("^[0-9]+$")), lambda t: F.struct(
        t["x"].alias("x"), bare(t).try_cast("int").alias("n"))), lambda t: t["n"] >= 1)
    words = F.filter(row, lambda t: ~bare(t).rlike("^[0-9]+$"))
    titled = F.transform(F.reverse(numbers), lambda t: F.struct(t["n"].alias("n"), F.trim(F.array_join(F.transform(
        F.filter(words, lambda w: w["x"] < t["x"] - 5), lambda w: w["text"]), " ")).alias("title")))
    return F.transform(titled, lambda t: F.struct(t["n"].alias("n"), F.when(
        F.length(t["title"]) >= 3, text.first_anchor(t["title"])).alias("section_id")))


def page_evidence(tokens: DataFrame) -> DataFrame:
    """(doc_id, page, said, places, named): one narrow row for each page, from one scan of the tokens.

    ``said`` tells class, range and sign-offs, ``places`` what the locators read and ``named`` the child
    sections that short lines name.  They are columns of their own, so that a query which asks for one
    does not work out the others.
    """
    pages = tok.page_text(tokens, items=True)
    rows = F.transform(printed_rows(F.col("items")), _across)
    pages = pages.withColumn("is_contents", F.upper("top25").contains("CONTENTS")).withColumn("rows", rows)
    lines = F.transform("rows", lambda r: F.array_join(F.transform(r, lambda t: t["text"]), " "))
    pages = pages.withColumn("lines", lines).withColumn("low", F.lower("text"))

    heading = r"^\s*[0-9]+(?:\.[0-9]+)*[._\s]+([A-Z][^\n]*)$"
    notes = F.array_compact(F.transform(F.transform(
        F.filter("lines", lambda s: s.rlike(heading)), lambda s: F.regexp_extract(s, heading, 1)),
        lambda s: text.first_anchor(s, NOTE_SECTIONS)))
    short = F.filter("lines", lambda s: F.size(F.split(s, " ")) <= LINE_WORDS)
    scoped = F.array_distinct(F.flatten(F.transform(short, lambda s: text.all_anchors(s, list(PARENTS)))))
    line = F.trim("top05")
    capital = (F.upper(line) == line) & (F.lower(line) != line)
    header = F.nullif(F.trim("header"), F.lit(""))
    body = text.contains_any(F.col("low"), lookups.AUDITOR_BODY_PHRASES)
    audit = F.col("text").rlike("(?i)" + dict(lookups.SECTION_ANCHORS)["auditor_report"]) & body
    reach = max(len(p) for p in loc.CLASS_PHRASES.values())
    return pages.select(*tok.PAGE, F.struct(
        F.col("page"), audit.alias("audit"),
        F.col("text").rlike("(?i)" + lookups.SIGNOFF_PATTERN).alias("signed"),
        F.substring("low", 1, reach).alias("head"), F.right("low", F.lit(reach)).alias("tail"),
        *[F.col("low").contains(p).alias(f"is_{n}") for n, p in loc.CLASS_PHRASES.items()]).alias("said"), F.struct(
        F.col("page"),
        F.when((F.col("n25") <= 40) | (F.col("caps25") / F.col("n25") >= 0.5),
               text.all_anchors(F.col("top25"))).alias("anchors"),
        body.alias("body"),
        F.when(text.first_anchor(header).isNotNull(), header).alias("header"),
        F.when(F.col("page") == 1, F.lower(text.header_company(F.col("top30")))).alias("company"),
        F.when(capital, text.first_anchor(line)).alias("capital"),
        F.when(F.col("is_contents"), F.transform("rows", _contents_row)).alias("contents"),
        notes.alias("notes")).alias("places"), F.struct(F.col("page"), scoped.alias("scoped")).alias("named"))


def _candidate(section: Column, page: Column, signal: str, end: Column | None = None) -> Column:
    return F.struct(section.alias("section_id"), page.alias("start_page"),
                    (F.lit(None).cast("int") if end is None else end).alias("end_page"), F.lit(signal).alias("signal"))


def _pool(ps: Column, last: Column) -> Column:
    """Array of candidates of all locators from a document's pages in order."""
    contents = F.transform(
        F.flatten(F.flatten(F.transform(F.filter(ps, lambda p: p["contents"].isNotNull()), lambda p: F.array(
            F.transform(p["contents"], lambda row: F.get(F.filter(row, lambda c: c["n"] <= last), F.lit(0))))))),
        lambda c: _candidate(c["section_id"], c["n"], "toc"))

    def anchored(p, i):
        following = F.get(ps, i + 1)
        confirmed = p["body"] | F.coalesce(following["body"] & (following["page"] == p["page"] + 1), F.lit(False))
        return F.transform(F.filter(F.coalesce(p["anchors"], F.array().cast("array<string>")),
                                    lambda s: (s != "auditor_report") | confirmed),
                           lambda s: _candidate(s, p["page"], "hard_anchor"))

    company = F.get(F.filter(ps, lambda p: p["page"] == 1), F.lit(0))["company"]
    names = F.array_distinct(F.array_compact(F.transform(ps, lambda p: p["header"])))
    headers = F.filter(F.transform(names, lambda h: F.struct(h.alias("h"), F.transform(
        F.filter(ps, lambda p: p["header"] == h), lambda p: p["page"]).alias("at"))),
        lambda h: (F.size(h["at"]) >= 3) & (company.isNull() | ~F.lower(h["h"]).contains(company)))
    running = F.transform(headers, lambda h: _candidate(
        text.first_anchor(h["h"]), F.get(h["at"], F.lit(0)), "running_header", F.element_at(h["at"], -1)))
    capital = F.transform(F.filter(ps, lambda p: p["capital"].isNotNull()),
                          lambda p: _candidate(p["capital"], p["page"], "all_caps_first_line"))
    notes = F.flatten(F.transform(ps, lambda p: F.transform(
        p["notes"], lambda s: _candidate(s, p["page"], "numbered_note"))))
    return F.filter(F.concat(contents, F.flatten(F.transform(ps, anchored)), running, capital, notes),
                    lambda c: c["section_id"].isNotNull())


def _said(name: str, phrase: str) -> Column:
    """Is a class phrase on a page of ``said`` or over one of the ``joints``?"""
    return F.exists("said", lambda p: p[f"is_{name}"]) | F.exists("joints", lambda j: j.contains(phrase))


def documents(tokens: DataFrame) -> DataFrame:
    """One row for each document: class, primary range, sign-off pages, pool and scoped lines."""
    docs = page_evidence(tokens).groupBy("doc_id").agg(
        F.max("page").alias("last_page"), F.min("page").alias("first"),
        *[F.sort_array(F.collect_list(c)).alias(c) for c in ("said", "places", "named")])
    audits = F.transform(F.filter("said", lambda p: p["audit"]), lambda p: p["page"])
    # a phrase may run over a page end, so the joints of neighbouring pages are tested as well
    joints = F.transform("said", lambda p, i: F.concat_ws(" ", p["tail"], F.get(F.col("said"), i + 1)["head"]))
    docs = docs.withColumn("joints", joints)
    docs = docs.withColumns({n: _said(n, p) for n, p in loc.CLASS_PHRASES.items()})
    scoped = F.flatten(F.transform("named", lambda p: F.transform(
        p["scoped"], lambda s: _candidate(s, p["page"], SCOPED))))
    classed = loc.with_class(docs)
    return classed.select(
        "doc_id", "size", "mode", F.col("last_page").alias("page_count"), "reasons", "first",
        F.coalesce(F.get(audits, F.lit(1)) - 1, F.col("last_page")).alias("last"),
        F.col("last_page").alias("document_end"),
        F.transform(F.filter("said", lambda p: p["signed"]), lambda p: p["page"]).alias("signed"),
        _pool(F.col("places"), F.col("last_page")).alias("pool"), scoped.alias("scoped"))


def candidates(docs: DataFrame, signal: str | None = None) -> DataFrame:
    """The pool as rows; that of one locator where it is named."""
    # Of an array by its name Spark would infer a filter on its size, for which the pool is built again.
    wanted = F.filter("pool", lambda c: F.lit(True) if signal is None else c["signal"] == signal)
    return docs.select("doc_id", F.inline(wanted))


def signoffs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.explode("signed").alias("page"))


def vote(rows: DataFrame, carry: list[str]) -> DataFrame:
    """One row for each (doc_id, section_id): start, signals and confidence of its best group.

    Rows without a start keep the section in the result.  ``carry`` columns are equal within a section.
    """
    key = ["doc_id", "section_id"]
    held = [F.any_value(c).alias(c) for c in carry]
    unique = rows.groupBy(*key, "start_page", "signal").agg(F.count("*").alias("_n"), *held)
    rank = F.coalesce(*[F.when(F.col("signal") == s, r) for s, r in lookups.LOCATOR_RANKS], F.lit(0))
    groups = (tok.islands(unique, key, "start_page", 1, "g", ["signal"]).withColumn("rank", rank)
              .groupBy(*key, "g").agg(F.sort_array(F.collect_set("signal")).alias("signals"),
                                      F.max("rank").alias("rank"), F.min("start_page").alias("start"), *held))
    best = F.struct(F.size("signals"), "rank", -F.col("start"))
    return groups.groupBy(*key).agg(F.max_by(F.struct("start", "signals"), best).alias("b"), *held).select(
        *key, "b.start", "b.signals",
        F.when(F.size("b.signals") >= 2, "high").otherwise("low").alias("confidence"), *carry)


def _ordinal() -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in lookups.SECTION_IDS]), F.col("section_id"))


def with_ends(rows: DataFrame, *within: str) -> DataFrame:
    """Add ``end``: before the next start of the document (and ``within``) or on the range's last page,
    cut at the first sign-off inside."""
    order = W.partitionBy("doc_id", *within).orderBy(F.asc_nulls_last("start"), "ordinal")
    ended = rows.withColumn("ordinal", _ordinal()).withColumn("end", F.when(
        F.col("start").isNull(), None).when(F.lead("start").over(order).isNull(), F.col("last")).otherwise(
        F.greatest(F.col("start"), F.lead("start").over(order) - 1)))
    cut = F.array_min(F.filter("signed", lambda p: p.between(F.col("start"), F.col("end"))))
    return ended.withColumn("cut", cut).withColumn("end", F.coalesce("cut", "end")).drop("cut", "ordinal")


_HELD = ["size", "mode", "first", "last", "signed", "pool", "scoped"]


def first_pass(docs: DataFrame) -> DataFrame:
    """Twelve rows for each document with start, signals and confidence; start is null where nothing is found."""
    none = F.array(*[_candidate(F.lit(s), F.lit(None).cast("int"), "") for s in lookups.SECTION_IDS])
    inside = F.filter("pool", lambda c: c["start_page"].between(F.col("first"), F.col("last")))
    rows = docs.select("doc_id", *_HELD, F.inline(F.concat(none, inside)))
    return vote(rows.withColumn("signal", F.nullif("signal", F.lit(""))), _HELD)


def placed(docs: DataFrame) -> DataFrame:
    """The sections that the first pass finds, with their ends."""
    return with_ends(first_pass(docs)).where("start IS NOT NULL")


def _status(section: Column) -> Column:
    due = loc.expected_printed(section, F.col("size"), F.col("mode"))
    return F.when(F.col("start").isNotNull(), "found").when(due, "not_found").otherwise("not_present")


def printed_sections(docs: DataFrame) -> DataFrame:
    """Twelve slots for each document with their status."""
    return with_ends(first_pass(docs)).select(
        "doc_id", "section_id", _status(F.col("section_id")).alias("status"), "start", "end", "signals", "confidence")


def within_parent(docs: DataFrame) -> DataFrame:
    """Child candidates that lie in the range that the first pass gives their parent."""
    of = F.create_map(*[F.lit(x) for kv in PARENTS.items() for x in kv])
    rows = with_ends(first_pass(docs)).where("start IS NOT NULL")
    mine = F.filter("pool", lambda c: (of[c["section_id"]] == F.col("section_id"))
                    & c["start_page"].between(F.col("start"), F.col("end")))
    return rows.where(F.col("section_id").isin(*PARENTS.values())).select("doc_id", F.inline(mine))


def two_pass(docs: DataFrame) -> DataFrame:
    """Twelve slots for each document: parents first, then their children within the parents' pages.

    A parent runs up to the next section that is nobody's child.  A child is voted on again among the
    candidates inside its parent; where there are none, the short lines of the parent's pages that name
    it are taken (signal ``scoped_line``).  Without its parent a child keeps the first pass's result.
    ``pass`` says which pass placed a section, ``parent`` the section it was looked for in.
    """
    child = F.col("section_id").isin(*PARENTS)
    first = with_ends(first_pass(docs).withColumn("child", child), "child")
    every = W.partitionBy("doc_id")
    spans = F.collect_list(F.when(~F.col("child") & F.col("start").isNotNull(), F.struct(
        "section_id", "start", "end"))).over(every)
    of = F.create_map(*[F.lit(x) for kv in PARENTS.items() for x in kv])
    rows = first.withColumn("spans", spans).withColumn("parent", of[F.col("section_id")])
    span = F.get(F.filter("spans", lambda s: s["section_id"] == F.col("parent")), F.lit(0))
    rows = rows.withColumn("span", span).drop("spans")

    def inside(pool):
        return F.filter(pool, lambda c: (c["section_id"] == F.col("section_id"))
                        & c["start_page"].between(F.col("span.start"), F.col("span.end")))

    none = F.array(_candidate(F.col("section_id"), F.lit(None).cast("int"), ""))
    rows = rows.withColumn("strict", inside("pool")).withColumn("found", F.when(F.col("span").isNull(), none).when(
        F.size("strict") > 0, F.col("strict")).otherwise(F.concat(none, inside("scoped"))))
    before = F.struct("start", "end", "signals", "confidence").alias("before")
    again = vote(rows.select(
        "doc_id", "section_id", "size", "mode", "last", "signed", "parent", "span", "child", before,
        F.explode("found").alias("c")).select(
        "*", "c.start_page", F.nullif("c.signal", F.lit("")).alias("signal")).drop("c"),
        ["size", "mode", "last", "signed", "parent", "span", "child", "before"])
    scoped = F.col("span").isNotNull()
    settled = again.select(
        "doc_id", "section_id", "size", "mode", "last", "signed", "parent", "span", "before", "child",
        *[F.when(scoped, F.col(c)).otherwise(F.col(f"before.{c}")).alias(c) for c in ("start", "signals", "confidence")])
    ended = with_ends(settled)
    end = (F.when(F.col("start").isNull(), None).when(~F.col("child"), F.col("before.end"))
           .when(scoped, F.least("end", "span.end")).otherwise(F.col("end")))
    return ended.select(
        "doc_id", "section_id", _status(F.col("section_id")).alias("status"), "start", end.alias("end"), "signals",
        "confidence", F.when(F.col("start").isNull(), None).when(scoped, 2).otherwise(1).alias("pass"),
        F.when(scoped, F.col("parent")).alias("parent"))
