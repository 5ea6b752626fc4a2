"""Markup, printed pages, sources and streaming on small fixtures."""

import decimal
import random

import pytest
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions import text
from ledgermill.operators import evidence, facts, locators, sections, tokens
from ledgermill.plans import filing_merge
from ledgermill.sources import filings, markup, register, tables
from ledgermill.streaming import jobs

DOC = """<html><body><ix:header><xbrli:context id="c1"><xbrli:period><xbrli:startDate>2023-01-01
</xbrli:startDate><xbrli:endDate>2023-12-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="c2"><xbrli:entity><xbrli:segment/></xbrli:entity><xbrli:period>
<xbrli:instant>2023-12-31</xbrli:instant></xbrli:period></xbrli:context></ix:header>
<script>var x = 1;</script><p>Strategic report</p><p>Growth &amp; plans.</p>
<ix:nonFraction name="core:TurnoverRevenue" contextRef="c1" scale="3"><b>1,234</b></ix:nonFraction>
<ix:nonfraction contextref='c1' name='core:TaxOnProfit' sign='-'>5</ix:nonfraction>
<ix:nonFraction name="core:TurnoverRevenue" contextRef="c2">7</ix:nonFraction>
<ix:nonFraction name="core:Equity" contextRef="none">8</ix:nonFraction>
<ix:nonNumeric name="core:RevenueRecognitionPolicy">A <ix:nonNumeric name="core:ProvisionsPolicy">
b</ix:nonNumeric> c</ix:nonNumeric></body></html>"""


def docs(spark, content=DOC):
    return spark.createDataFrame([("co", "f1", 5, content)],
                                 "company_number string, filing_id string, recency long,"
                                 " content string")


def test_markup_facts_and_merge(spark):
    rows = markup.facts(docs(spark)).orderBy("ord").collect()
    assert [(r.name, r.raw, r.scale, r.sign, r.dimensional) for r in rows] == [
        ("core:TurnoverRevenue", "1,234", "3", None, False),
        ("core:TaxOnProfit", "5", None, "-", False),
        ("core:TurnoverRevenue", "7", None, None, True)]
    cells = {r.field: r.value for r in filing_merge.tagged_cells(docs(spark)).collect()}
    assert cells == {"revenue": 1234000.0, "tax_expense": -5.0}


def test_body_and_narrative(spark):
    body = docs(spark).select(markup.body_text(F.col("content"))).collect()[0][0]
    assert body.split("\n")[:2] == ["Strategic report", "Growth & plans."]
    assert "var x" not in body
    got = [(r.name, r.text) for r in markup.narrative(docs(spark)).orderBy("ord").collect()]
    assert got == [("core:RevenueRecognitionPolicy", "A b c"), ("core:ProvisionsPolicy", "b")]


def test_nil_and_nested_facts(spark):
    head = DOC[:DOC.index("<script>")]
    body = ("<ix:nonFraction name='core:C' contextRef='c1' xsi:nil='true' /><ix:nonFraction name='core:D' "
            "contextRef='c1'>7</ix:nonFraction><ix:nonFraction name='core:A' contextRef='c1'>1<b>0</b>"
            "<ix:nonFraction name='core:B' contextRef='c1'><ix:nonFraction name='core:E' contextRef='c1'>5"
            "</ix:nonFraction></ix:nonFraction>&#8217;&rsquo;&#x2019;&#146;&nosuch; &amp;lt;</ix:nonFraction>"
            "<ix:nonFraction name='core:Open' contextRef='c1'>9")
    rows = markup.facts(docs(spark, head + body)).orderBy("ord").collect()
    assert [(r.name, r.raw) for r in rows] == [
        ("core:C", ""), ("core:D", "7"), ("core:A", "105’’’’&nosuch; &lt;"), ("core:B", "5"), ("core:E", "5")]
    note = ('<ix:nonNumeric name="core:Outer">text <ix:nonNumeric name="core:Flag"/> tail</ix:nonNumeric>')
    got = {r.name: r.text for r in markup.narrative(docs(spark, note)).collect()}
    assert got == {"core:Outer": "text tail", "core:Flag": ""}


def test_facts_against_a_parser(spark):
    """Random nesting of numeric elements against a recursive reading."""
    rnd = random.Random(9)
    want = []

    def build(depth):
        out, text_ = "", ""
        for _ in range(rnd.randint(1, 3)):
            kind = rnd.random()
            if kind < 0.3:
                word = str(rnd.randint(1, 99))
                out, text_ = out + f"<b>{word}</b>", text_ + word
            elif kind < 0.5 or not depth:
                want.append([f"core:N{len(want)}", ""])
                out += f"<ix:nonFraction name='{want[-1][0]}' contextRef='c1'/>"
            else:
                slot = len(want)
                want.append([f"core:N{slot}", ""])
                inner, t = build(depth - 1)
                want[slot][1] = t
                out += f"<ix:nonFraction name='core:N{slot}' contextRef='c1'>{inner}</ix:nonFraction>"
                text_ += t
        return out, text_

    content = DOC[:DOC.index("<script>")] + "".join(build(3)[0] for _ in range(5))
    got = [[r.name, r.raw] for r in markup.facts(docs(spark, content)).orderBy("ord").collect()]
    assert got == want


def test_nested_narrative_against_recursion(spark):
    rnd = random.Random(5)

    def build(depth):
        parts, plain = [], []
        for k in range(rnd.randint(1, 3)):
            word = f"w{rnd.randint(0, 99)}"
            parts.append(word)
            plain.append(word)
            if depth and rnd.random() < 0.6:
                inner, text_ = build(depth - 1)
                name = f"core:N{depth}{k}"
                parts.append(f'<ix:nonNumeric name="{name}">{inner}</ix:nonNumeric>')
                plain.append(text_)
                want.append((name, text_))
        return " ".join(parts), " ".join(plain)

    want: list = []
    content, _ = build(4)
    got = [(r.name, r.text) for r in markup.narrative(docs(spark, content)).collect()]
    assert sorted(got) == sorted(want)


def test_twelve_slots(spark):
    out = sections.sections_of(docs(spark)).collect()
    assert len(out) == 12
    by = {r.section_id: r for r in out}
    assert by["strategic_report"].source == "ixbrl_text"
    assert by["accounting_policies"].text == "A b c\n\nb"
    assert by["viability_statement"].status == "not_present"


def page(doc, pnum, lines, width=600.0, height=800.0):
    """Tokens of a page from (y, [(x, text), ..]) lines."""
    return [(doc, pnum, float(x), float(y), float(x), float(y), t, 0.9, width, height)
            for y, row in lines for x, t in row]


def printed(spark, rows):
    return spark.createDataFrame(rows, schemas.TOKENS)


def test_printed_statement(spark):
    balance = page(1, 1, [
        (20, [(60, "BALANCE SHEET")]), (100, [(400, "2023"), (520, "2022")]),
        (140, [(60, "Fixed"), (100, "assets")]),
        (180, [(60, "Tangible assets"), (250, "4"), (400, "1,200"), (520, "(300")]),
        (220, [(60, "Debtors")]),
        (260, [(60, "Stock"), (250, "5"), (400, "54.043"), (520, "-")]),
        (300, [(60, "Called up")]),
        (340, [(60, "share capital"), (400, "370"), (520, "370")]),
        (380, [(60, "Profit and loss account"), (400, "51,384"), (520, "13,347")])])
    t = printed(spark, balance)
    info = tokens.documents(tokens.page_text(t))
    d = info.collect()[0]
    assert (d.balance_page, d.current_year, d.prior_year, d.dialect) == (1, 2023, 2022, "uk_gaap")
    got = {r.printed_field: (r.current, r.prior) for r in tokens.printed_facts(
        t, tokens.statement_pages(info)).collect()}
    assert got == {"tangible_assets": (1200, -300), "debtors": (0, 0), "stock": (54043, 0),
                   "called_up_share_capital": (370, 370), "retained_earnings": (51384, 13347)}


def staff_note(spark, rows):
    cover = page(1, 1, [(20, [(60, "BALANCE SHEET")]), (100, [(400, "2023"), (520, "2022")])])
    note = page(1, 2, [(20, [(60, "NOTES TO THE FINANCIAL STATEMENTS")])] + rows)
    t = printed(spark, cover + note)
    pages = tokens.page_text(t)
    info = tokens.documents(pages)
    return [(r.current, r.prior) for r in tokens.headcount(
        t, tokens.employee_page(pages, info, t), info).collect()]


def test_headcount_total_and_sum(spark):
    head = [(100, [(60, "Staff costs")]), (130, [(400, "2023"), (520, "2022")]),
            (150, [(400, "No."), (520, "No.")]),
            (190, [(60, "Production"), (400, "10"), (520, "9")]),
            (230, [(60, "Sales"), (400, "4"), (520, "3")])]
    end = [(310, [(60, "Wages and salaries"), (400, "99,000"), (520, "88,000")])]
    assert staff_note(spark, head + end) == [(14, 12)]
    total = [(270, [(60, "Total"), (400, "15"), (520, "13")])]
    assert staff_note(spark, head + total + end) == [(15, 13)]
    bare = [(270, [(400, "16"), (520, "11")])]
    assert staff_note(spark, head + bare + end) == [(16, 11)]


def test_headcount_has_no_bounds(spark):
    """Six-figure totals count, and rows far below the heading where no stop word ends the note."""
    head = [(100, [(60, "Staff costs")]), (130, [(400, "2023"), (520, "2022")]),
            (150, [(400, "No."), (520, "No.")])]
    assert staff_note(spark, head + [(700, [(60, "Total"), (400, "120,000"), (520, "118,500")])]) == [(120000, 118500)]


def test_locators_have_no_bounds(spark):
    rows = [r for p in range(1, 6) for r in page(1, p, [(20, [(60, f"Cover {p}")])])]
    rows += page(1, 6, [(20, [(60, "CONTENTS")]), (60, [(60, "Strategic report"), (500, "7")])])
    title = "THE STRATEGIC REPORT OF THE BOARD FOR THE LONG YEAR THAT ENDED ON THE LAST DAY OF MARCH"
    rows += page(1, 7, [(10, [(60, title)]), (700, [(60, "x")])])
    heading = "1. Accounting policies and " + "further matters " * 6 + "set out below"
    rows += page(1, 8, [(300, [(60, heading)])])
    found = evidence.documents(printed(spark, rows))
    by_signal = {}
    for r in evidence.candidates(found).collect():
        by_signal.setdefault(r.signal, []).append((r.section_id, r.start_page))
    assert len(title.split()) > 15 and len(heading) > 90
    assert by_signal["toc"] == by_signal["all_caps_first_line"] == [("strategic_report", 7)]
    assert by_signal["numbered_note"] == [("accounting_policies", 8)]


def report(spark, doc=1):
    """A report whose children stand in lines inside their parents, and once more outside."""
    rows = [r for p in range(1, 21) for r in page(doc, p, [(400, [(60, f"Text of page {p} goes on")])])]
    for at, title in ((3, "STRATEGIC REPORT"), (8, "DIRECTORS REPORT"), (14, "ACCOUNTING POLICIES")):
        rows += page(doc, at, [(20, [(60, title)])])
    rows += page(doc, 5, [(500, [(60, "Principal risks and uncertainties")])])
    rows += page(doc, 10, [(500, [(60, "Going concern")])])
    rows += page(doc, 16, [(500, [(60, "Going concern")])])
    rows += page(doc, 12, [(500, [(60, "Section 172(1) statement")])])  # not in its parent
    rows += page(doc, 2, [(500, [(60, "Principal activities")])])  # not in its parent either
    rows += page(doc, 17, [(500, [(60, "We explain here at great length why no critical judgements or any other "
                                       "critical estimates were made at all")])])  # no heading
    return rows


def test_second_pass_finds_children_in_their_parents(spark):
    found = evidence.documents(printed(spark, report(spark)))
    first = {r.section_id for r in evidence.placed(found).collect()}
    assert first == {"strategic_report", "directors_report", "accounting_policies"}
    got = {r.section_id: (r.start, r.end, r["pass"], r.parent, r.signals) for r in evidence.two_pass(found).collect()
           if r.start is not None}
    scoped = [evidence.SCOPED]
    assert got == {
        "strategic_report": (3, 7, 1, None, ["all_caps_first_line", "hard_anchor"]),
        "directors_report": (8, 13, 1, None, ["all_caps_first_line", "hard_anchor"]),
        "accounting_policies": (14, 20, 1, None, ["all_caps_first_line", "hard_anchor"]),
        "principal_risks": (5, 7, 2, "strategic_report", scoped),
        "going_concern_directors": (10, 13, 2, "directors_report", scoped),
        "going_concern_note": (16, 20, 2, "accounting_policies", scoped)}


def test_second_pass_prefers_candidates_and_keeps_orphans(spark):
    rows = report(spark) + page(1, 9, [(20, [(60, "GOING CONCERN")])])
    # a second document without the parent of the risks, which the first pass places by its heading
    rows += [r for p in range(1, 5) for r in page(2, p, [(400, [(60, f"Page {p}")])])]
    rows += page(2, 3, [(20, [(60, "PRINCIPAL RISKS")])])
    got = {(r.doc_id, r.section_id): (r.start, r["pass"], r.signals) for r in evidence.two_pass(
        evidence.documents(printed(spark, rows))).collect() if r.start is not None}
    assert got[1, "going_concern_directors"] == (9, 2, ["all_caps_first_line", "hard_anchor"])
    assert got[1, "going_concern_note"] == (16, 2, [evidence.SCOPED])
    assert got[2, "principal_risks"] == (3, 1, ["all_caps_first_line", "hard_anchor"])


def test_sections_take_two_shuffles(spark, tmp_path):
    """One scan of the tokens, one shuffle by page, one by document, and no join."""
    printed(spark, report(spark)).write.parquet(str(tmp_path / "tokens"))
    t = spark.read.parquet(str(tmp_path / "tokens"))
    for out in (evidence.printed_sections, evidence.two_pass, evidence.within_parent):
        plan = out(evidence.documents(t))._jdf.queryExecution().executedPlan().toString()
        assert (plan.count("FileScan"), plan.count("Exchange"), plan.count("Join")) == (1, 2, 0), out.__name__


def test_headings_are_found_as_one_by_one(spark):
    """One traversal gives the places that a search for each section alone gives, overlaps included."""
    import re

    from ledgermill import lookups

    rng = random.Random(9)
    words = ["Strategic", "report", "of", "the", "directors", "Directors'", "REPORT", "Section 172(1)", "s. 172", "\n",
             "principal", "risks", "activities", "going  concern", "statement", "responsibilities", "independent",
             "auditor's", "basis of preparation", "critical", "accounting", "policies", "estimates", "x", "misstatement",
             "viability", "é", "😀"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["Strategic report of the directors report of the directors", "", "Strategic report", "report of the directors report"]
    got = {}
    df = spark.createDataFrame(list(enumerate(texts)), "filing_id int, body_text string")
    for r in sections.anchor_hits(df).collect():
        got.setdefault(r.filing_id, []).append((r.offset, r.section_id))
    for i, t in enumerate(texts):
        want = sorted((m.start(), s) for s, p in lookups.SECTION_ANCHORS if s != "going_concern_directors"
                      for m in re.finditer(p, t, re.I))
        assert sorted(got.get(i, [])) == want, t


def test_broken_document_is_rejected(spark, tmp_path):
    """Documents that cannot be read give a row with the reason; the others have all their slots."""
    rows = [("good", DOC), ("null", None), ("blank", " \n"), ("text", "no tags"), ("cut", DOC[:900]), ("empty", "<html></html>")]
    spark.createDataFrame(rows, "filing_id string, content string").write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    out = sections.sections_of(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("FileScan"), plan.count("ArrowEvalPython"), plan.count("Exchange")) == (1, 1, 0)
    got = {}
    for r in out.collect():
        got.setdefault(r.filing_id, []).append((r.section_id, r.status, r.reason))
    assert got["null"] == got["blank"] == [(None, "rejected", "no content")] and got["text"] == [(None, "rejected", "no markup")]
    assert all(len(got[k]) == 12 for k in ("good", "cut", "empty"))
    bad = spark.createDataFrame([("a", DOC), ("b", "<p>bad</p>")], "filing_id string, content string")

    def failing(content):
        return (None, "ValueError: bad markup") if "bad" in content else markup.read_narrative(content)

    got = {r.filing_id: r.reason for r in sections.sections_of(bad, failing).where("status = 'rejected'").collect()}
    assert got == {"b": "ValueError: bad markup"}


def test_reader_reports_what_it_cannot_read(monkeypatch):
    monkeypatch.setattr(markup, "_elements", lambda content: 1 // 0)
    found, reason = markup.read_narrative("<p>")
    assert found is None and reason.startswith("ZeroDivisionError: ")


def test_references_as_browsers_read_them(spark):
    import html

    texts = ["a &amp; b &ampx &pound5 &nbsp x &copy2024 &notit; &not; &#163 &#xA3; &# &zzz; &eacute;&eacute &; &amp;lt;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.v for r in df.select(markup.decode(F.col("t")).alias("v")).collect()] == [html.unescape(t) for t in texts]


def test_recency_orders_any_tiebreak(spark):
    big = (1 << 62) + 1
    df = spark.createDataFrame([("2024-01-02", 1), ("2024-01-01", big), ("2024-01-01", big - 1)], "d string, n long")
    rows = df.orderBy(facts.recency(F.to_date("d"), F.col("n"))).collect()
    assert [r.n for r in rows] == [big - 1, big, 1]


def test_shared_folder_is_needed(spark):
    assert tables.run_path(spark, "x") != tables.run_path(spark, "x")

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        tables.shared_dir(Cluster)


def test_sources_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A-1", " Active", "small"), ("nan", "Active", "LARGE"),
                                ("b_2", "Dissolved", "SMALL")],
                               ["CompanyName ", "CompanyStatus", " Accounts.AccountCategory"])
    tables.write_csv(df.repartition(2), str(tmp_path / "csv"))
    back = register.scan(spark, str(tmp_path / "csv"))
    assert back.columns == ["CompanyName", "CompanyStatus", "Accounts.AccountCategory"]
    kept = register.spaces_for_marks(register.keep_target(register.blank_nulls(back)))
    assert sorted(r.CompanyName for r in kept.collect()) == ["", "A 1"]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "f1.xhtml").write_text("<p>x</p>\n<p>y</p>")
    row = filings.landed_markup(spark, str(tmp_path / "docs")).collect()[0]
    assert (row.filing_id, row.content) == ("f1", "<p>x</p>\n<p>y</p>")
    assert filings.landed_documents(spark, str(tmp_path / "docs")).count() == 1
    tables.write_json(kept, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_tables(spark, tmp_path):
    grown = tables.add_columns(spark.range(1), {"id": "string", "sector": "string"})
    assert grown.dtypes == [("id", "bigint"), ("sector", "string")]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lm LOCATION '{tmp_path}'")
    for _ in range(2):
        tables.create_if_missing(spark, "lm.companies", schemas.COMPANIES)
    assert spark.table("lm.companies").columns == schemas.COMPANIES.fieldNames()
    spark.sql("DROP DATABASE lm CASCADE")
    assert "WHEN NOT MATCHED THEN INSERT (k, v)" in tables.merge_statement("t", "s", "k", ["v"])


def test_batches_are_appended_and_never_rewritten(spark, tmp_path):
    """Runs over new, late and repeated filings add files of their own and leave the others as they are."""
    src, root = str(tmp_path / "in"), tmp_path / "out"

    def arrive(*rows):
        data = [(c, 2020, "cash", v, decimal.Decimal(n)) for c, v, n in rows]
        spark.createDataFrame(data, jobs.CELLS).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(jobs.CELLS).parquet(src)
        return {r.company_number: r.value for r in jobs.merge_late_filings(spark, stream, str(root)).collect()}

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (root / "cells").rglob("batch=[0-9]*/*.parquet")}

    assert arrive(("a", 1.0, 5), ("b", 1.0, 5)) == {"a": 1.0, "b": 1.0}
    before = files()
    assert arrive(("a", 2.0, 7), ("a", 9.0, 6)) == {"a": 2.0, "b": 1.0}
    between = files()
    assert arrive(("a", 0.5, 3), ("b", 1.0, 5), ("b", None, 9), ("c", None, 1)) == {"a": 2.0, "b": 1.0, "c": None}
    after = files()
    assert before.items() < between.items() < after.items()
    # the state itself holds the newest filing, so a late one is not even appended as its own value
    last = spark.read.schema(jobs.CELLS).parquet(*[p for p in after if p not in between])
    assert {r.company_number: r.value for r in last.collect()} == {"a": 2.0, "b": 1.0, "c": None}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 2020, "cash", 1.0, decimal.Decimal(1))], jobs.CELLS)
    for _ in range(2):
        rows.write.mode("overwrite").parquet(f"{root}/cells/batch=0")
    assert jobs.stored_cells(spark, root).count() == 1


def test_stream_takes_the_first_value_of_a_document(spark, tmp_path):
    content = DOC.replace('<ix:nonFraction name="core:Equity"', '<ix:nonFraction name="core:Turnover" contextRef="c1">5'
                          '</ix:nonFraction><ix:nonFraction name="core:Equity"')
    docs(spark, content).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs(spark).schema).parquet(str(tmp_path / "in"))
    got = {r.field: r.value for r in jobs.extract_stream(spark, stream, str(tmp_path / "out")).collect()}
    assert got["revenue"] == 1234000.0
    want = {r.field: r.value for r in filing_merge.tagged_cells(docs(spark, content)).collect()}
    assert got == want


def test_late_filings_in_any_order(spark, tmp_path):
    rows = [("a", 2020, "cash", 1.0, 10), ("a", 2020, "cash", 2.0, 30),
            ("a", 2019, "cash", 3.0, 10), ("b", 2020, "cash", 4.0, 20),
            ("a", 2020, "cash", 9.0, 20)]
    rows = [(*r[:4], decimal.Decimal(r[4])) for r in rows]
    want = {("a", 2020): 2.0, ("a", 2019): 3.0, ("b", 2020): 4.0}
    for k, order in enumerate(([0, 1, 2, 3, 4], [1, 4, 0, 3, 2], [4, 3, 2, 1, 0])):
        src = tmp_path / f"in{k}"
        for i in order:
            spark.createDataFrame([rows[i]], jobs.CELLS).coalesce(1).write.mode("append").parquet(
                str(src))
        stream = spark.readStream.schema(jobs.CELLS).option("maxFilesPerTrigger", 1).parquet(
            str(src))
        out = jobs.merge_late_filings(spark, stream, str(tmp_path / f"out{k}"))
        assert {(r.company_number, r.year): r.value for r in out.collect()} == want
    # A later run picks up only what is new and keeps the stored cells.
    late = spark.createDataFrame([("a", 2020, "cash", 7.0, decimal.Decimal(40))], jobs.CELLS).coalesce(1)
    late.write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(jobs.CELLS).parquet(str(src))
    out = jobs.merge_late_filings(spark, stream, str(tmp_path / "out2"))
    assert {(r.company_number, r.year): r.value for r in out.collect()} == {
        **want, ("a", 2020): 7.0}
    # Nothing new: the stored cells stand.
    stream = spark.readStream.schema(jobs.CELLS).parquet(str(src))
    out = jobs.merge_late_filings(spark, stream, str(tmp_path / "out2"))
    assert out.count() == 3


def test_guards_of_the_merge(spark):
    """Units, entity-wide members, decimals and tiers, each alone."""
    content = """<xbrli:context id="c1"><xbrli:period><xbrli:endDate>2023-12-31</xbrli:endDate></xbrli:period>
</xbrli:context><xbrli:context id="g"><xbrli:entity><xbrli:segment><xbrldi:explicitMember dimension="d">
core:ConsolidatedGroup</xbrldi:explicitMember></xbrli:segment></xbrli:entity><xbrli:period><xbrli:endDate>2023-12-31
</xbrli:endDate></xbrli:period></xbrli:context>
<ix:nonFraction name="core:Turnover" contextRef="g" unitRef="iso4217:GBP">1</ix:nonFraction>
<ix:nonFraction name="core:Stocks" contextRef="c1" unitRef="iso4217:USD">2</ix:nonFraction>
<ix:nonFraction name="core:Debtors" contextRef="c1" unitRef="iso4217:GBP" decimals="-3">3</ix:nonFraction>
<ix:nonFraction name="own:Special" contextRef="c1" unitRef="iso4217:GBP">4</ix:nonFraction>"""

    def cells(**guards):
        return {r.field: r.value for r in filing_merge.tagged_cells(docs(spark, content), **guards).collect()}

    plain = {"inventories": 2.0, "trade_receivables": 3.0}
    assert cells() == plain
    assert cells(entity_wide=True) == plain | {"revenue": 1.0}
    assert cells(check_units=True) == {"trade_receivables": 3.0}
    assert cells(decimals_as_scale=True) == plain | {"trade_receivables": 3000.0}
    tiers = spark.createDataFrame([("own", "Special", "cash"), ("_any", "Stocks", "inventories")],
                                  "family string, tag string, field string")
    assert cells(tiers=tiers) == {"cash": 4.0, "inventories": 2.0}


def test_bands_of_a_page_without_height(spark):
    rows = [(*r[:9], None) for r in page(1, 1, [(100, [(60, "TOP")]), (200, [(60, "mid")]), (500, [(60, "end")])])]
    got = tokens.page_text(printed(spark, rows)).collect()[0]
    assert (got.top05, got.top25, got.top30, got.n25) == ("TOP", "TOP mid", "TOP mid", 2)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_facts_read_each_attribute_once(spark):
    plan = _plan(markup.facts(docs(spark)).select("year", "raw"))
    assert plan.count("contextref") == 1 and "unitref" not in plan and "decimals" not in plan
    content = DOC.replace("1,234", "a &amp; <b>1</b>&#163;<ix:nonFraction name='core:X' contextRef='c1'/>2")
    rows = markup.facts(docs(spark, content)).orderBy("ord").collect()
    assert [(r.ord, r.raw, r.year) for r in rows] == [
        (0, "a &1£2", 2023), (1, "", 2023), (2, "5", 2023), (3, "7", 2023)]


def test_a_value_is_parsed_once(spark):
    frame = spark.createDataFrame([("1", None, None), ("x", None, None)], "raw string, scale string, sign string")
    valued = facts.parse_values(frame)
    assert [r.value for r in valued.collect()] == [1.0]
    df = spark.range(3).select(F.reverse(F.col("id").cast("string")).alias("raw"), F.lit(None).cast("string").alias(
        "scale"), F.lit(None).cast("string").alias("sign"))
    assert _plan(facts.parse_values(df)).count("[+-]?[0-9]*") == 1


def test_number_tokens_build_their_text_once(spark):
    df = spark.range(4).select("id", F.reverse(F.col("id").cast("string")).alias("text"))
    found = tokens.number_tokens(df)
    assert _plan(found).count("reverse(") == 1
    assert sorted(r.text for r in found.collect()) == ["0", "1", "2", "3"]
    words = spark.createDataFrame([("a",), ("1,000",), (None,), ("-",)], "text string")
    assert sorted(r.text for r in tokens.number_tokens(words).collect()) == ["-", "1,000"]


def test_pool_is_built_once(spark):
    page = spark.createDataFrame([(1, 1, 0.0, 0.0, 1.0, 1.0, "Strategic report", 1.0, 595.0, 842.0)],
                                 "doc_id int, page int, x0 double, y0 double, x1 double, y1 double, text string, "
                                 "conf double, page_width double, page_height double")
    pool = evidence.candidates(evidence.documents(page))
    assert _plan(pool).count("running_header") == 1
    assert {r.signal for r in pool.collect()} == {"hard_anchor"}


def test_fuzzy_words_are_split_once(spark):
    df = spark.createDataFrame([("A STRATEGIC REPORT B",), ("STRATEGIC",), ("NO SUCH HEADING",), (None,)], "t string")
    hit = df.where(text.fuzzy_contains(F.split(F.upper("t"), " "), "STRATEGIC REPROT"))
    assert [r.t for r in hit.collect()] == ["A STRATEGIC REPORT B"]
    assert _plan(hit).count("upper(") == 1


def test_facts_of_odd_markup(spark):
    """Each opening tag and text of the one scan reads as the column expressions read it."""
    tags = ["<ix:nonFraction name='a' contextRef=\"c1\">", "<IX:NONFRACTION contextref = 'c1' NAME='b:c'\n scale='3' sign=\"-\">",
            "<ix:nonFraction contextRef='c1' name=\"x sign=\" title=\"y\" decimals='2'>", "<ix:nonFraction contextRef='c1' name=''>"]
    texts = ["1,2", "  7 ", "&#163;<b> 5</b>", "a<!-- <b>9 -->&amp;lt;&nosuch;&pound5&", "&#0;&#129;&#65279;&#1114112;&#x1F600;😀"]
    head = DOC[:DOC.index("<script>")]
    rows = [(str(i), t, x, f"{head}</ix:nonfraction>{t}{x}</ix:nonFraction ><ix:nonFractional name='n' contextRef='c1'>")
            for i, (t, x) in enumerate((t, x) for t in tags for x in texts)]
    df = spark.createDataFrame([*rows, ("null", "", "", None)], "filing_id string, tag string, piece string, content string")
    got = {r.filing_id: r for r in markup.facts(df).collect()}
    assert len(got) == len(rows)
    wanted = df.select("filing_id", *[markup.attribute(F.col("tag"), n).alias(n) for n in ("name", "scale", "sign", "decimals")],
                       markup.strip_tags(F.col("piece"), "").alias("raw"))
    for r in wanted.where("filing_id <> 'null'").collect():
        assert r.asDict() == {k: got[r.filing_id][k] for k in r.asDict()}


def test_facts_come_from_one_scan(spark):
    """No lambda runs over a document's pieces, and no context travels with each fact."""
    plan = _plan(markup.facts(docs(spark)))
    assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan and "regexp" not in plan


def test_statements_read_documents_once(spark, tmp_path):
    """Years without facts come out of the reading that gives the facts."""
    docs(spark, DOC.replace("2023-12-31</xbrli:instant>", "2021-12-31</xbrli:instant>")).write.parquet(str(tmp_path / "docs"))
    rows = filing_merge.tagged_statements(spark.read.parquet(str(tmp_path / "docs")), {"Equity": "shareholders_funds"})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("FileScan"), plan.count("ArrowEvalPython")) == (1, 1)
    assert rows.columns == ["company_number", "year", *schemas.ROW_FIELDS]
    assert {r.year: (r.revenue, r.tax_expense) for r in rows.collect()} == {2023: (1234000.0, -5.0), 2021: (None, None)}


def test_filings_in_one_scan(spark):
    """Tags, headings and their texts of the one scan are those of the single layers; no lambda runs over a body."""
    from ledgermill import lookups

    rnd = random.Random(4)
    names = [n for n, _, _ in lookups.NARRATIVE_TAGS] + ["core:Other", "bus:EntityDormantTruefalse"]
    words = ["Strategic report", "of the directors", "report", "Section 172(1)", "\n", "<b>Going concern</b>", "misstatement",
             "basis of preparation", "critical estimates", "x", "é", "😀", "&amp;", "&nbsp;", "<!-- c -->", "<script>", "</script>",
             "<body>", "</body>", "<ix:header>", "</ix:header>", "<style>a</style>", "²", "Strategic\u00a0report"]
    texts = [" ".join(rnd.choice(words) if rnd.random() < 0.7 else f'<ix:nonNumeric name="{rnd.choice(names)}">'
                      f'{rnd.choice(["true", "", "a <b>b</b> &amp; c"])}</ix:nonNumeric>' for _ in range(rnd.randint(1, 40)))
             for _ in range(150)]
    df = spark.createDataFrame([(str(i), "<p>" + t) for i, t in enumerate(texts)], "filing_id string, content string")
    found = sections.sections_of(df)
    tagged = found.where("source = 'ixbrl_tag'").select("filing_id", "section_id", "text", "source_tags",
                                                        F.coalesce("subsections", F.create_map().cast("map<string,string>")))
    assert sorted(map(repr, map(tuple, tagged.collect()))) == sorted(map(repr, map(tuple, sections.tag_layer(df).collect())))
    bodies = df.select("filing_id", markup.body_text(F.col("content")).alias("body_text"))
    got = {r.filing_id: sections.read_hits(r.body_text) for r in bodies.collect()}
    want: dict = {}
    for r in sections.anchor_hits(bodies).collect():
        want.setdefault(r.filing_id, []).append((r.offset, r.section_id))
    assert {k: sorted(v) for k, v in got.items() if v} == {k: sorted(v) for k, v in want.items()}
    assert [markup.read_body(r[0]) for r in df.select("content").collect()] == [r.body_text for r in bodies.collect()]
    plan = _plan(sections.filings_of(df, fields=("section_id", "status")))
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan


def test_printed_cells_read_tables_once(spark, tmp_path):
    """Canonical figures come from one branch, and tokens dealt out by document are not shuffled again for their tables."""
    printed(spark, report(spark)).write.parquet(str(tmp_path / "tokens"))
    t = tables.spread(spark.read.parquet(str(tmp_path / "tokens")), "doc_id", 4)
    plan = filing_merge.printed_cells(t)._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("FileScan"), plan.count("REPARTITION_BY_NUM"), plan.count("SortMergeJoin")) == (2, 2, 0)
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "page#" in x]


def test_lifted_notes_and_cash_flow_lines(spark):
    rows = [(1, "notes", "depreciation", 5, 2, 10), (1, "notes", "amortisation", 7, None, 11), (2, "notes", "depreciation", 3, 4, 9),
            (1, "cash_flow_statement", "depreciation", 6, None, 4), (1, "notes", "employees", 8, 9, 12)]
    facts_ = spark.createDataFrame([(d, s, f, "uk_gaap", 2021, 2020, c, p, at) for d, s, f, c, p, at in rows],
                                   "doc_id long, statement string, printed_field string, dialect string, current_year int, "
                                   "prior_year int, current long, prior long, place long")
    got = {(r.doc_id, r.year, r.field): (r.source, r.value) for r in tokens.canonical_facts(facts_).collect()}
    assert got == {(1, 2021, "depreciation"): ("cash_flow_statement", 6.0), (1, 2020, "depreciation"): ("notes", 2.0),
                   (1, 2021, "amortisation"): ("notes", 7.0), (2, 2021, "depreciation"): ("notes", 3.0),
                   (2, 2020, "depreciation"): ("notes", 4.0)}


def test_evaluation_shares_one_exchange(spark):
    """Sides of one origin are worked out once; slots without a document count as not found."""
    slots = spark.createDataFrame([(1, "a", 1, 2), (2, "a", 3, 3), (None, "a", 1, 1), (3, "b", 1, 1)],
                                  "doc_id long, section_id string, start int, end int").repartition("doc_id", "section_id")
    labels = slots.select("doc_id", "section_id", "start", (F.col("end") + F.col("doc_id") % 2).cast("int").alias("end"))
    out = locators.evaluation(slots, labels)
    got = {r.section_id: (r.labelled, round(r.found_rate, 3), round(r.exact_rate, 3)) for r in out.collect()}
    assert got == {"a": (3, 0.667, 0.333), "b": (1, 1.0, 0.0)}
    assert "isnotnull" not in out._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[-1]
