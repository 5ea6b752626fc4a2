"""Statutory sections of tagged filings: classification, tag layer, text layer, resolution.

A filing's narrative elements are read once, beside its row; flags, tags, headings and slots follow in
that row, so nothing is shuffled.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import lookups

GOING_CONCERN_TEXT = "Financial statements are prepared on a going concern basis."


_FLAGS = [*lookups.FLAG_TAGS, *lookups.DECLARATION_TAGS]


def with_class(rows: DataFrame) -> DataFrame:
    """Add size, mode, audited, dormant and going_concern_asserted, from the flags among ``items``.

    The first element of a flag counts; null means missing and '' means present but empty.  Flags are
    picked out first, so that each is looked up once among a few.
    """
    columns = rows.columns
    flags = F.filter("items", lambda e: _is_flag(e["name"]))
    named = rows.withColumn("_flags", F.explode(F.array(F.struct(
        F.transform(flags, lambda e: e["name"]).alias("names"), F.transform(flags, lambda e: e["text"]).alias("texts")))))
    rows = named.select(*columns, *[_at("_flags.texts", "_flags.names", n).alias(f"_{f}") for n, f in _FLAGS])
    has = {f: F.col(f"_{f}").isNotNull() for _, f in lookups.DECLARATION_TAGS}
    said = {f: F.coalesce(F.col(f"_{f}") == v, F.lit(False)) for f, v in (
        ("has_strategic_report", "true"), ("pl_omitted_exemption", "true"), ("audit_status", "audited"),
        ("entity_dormant", "true"), ("going_concern_asserted", "true"))}
    size = (F.when(has["small_regime"] | has["prepared_as_small"] | has["audit_exempt_s477"], "small")
            .when(has["medium_regime"] | said["has_strategic_report"], "medium").otherwise("unknown"))
    mode = F.when(has["filleted_s444_5a"] | said["pl_omitted_exemption"], "filleted").otherwise("full")
    audited = F.when(has["audit_exempt_s477"] | has["members_waived_audit"], False).when(said["audit_status"], True)
    return rows.select(*columns, size.alias("size"), mode.alias("mode"), audited.alias("audited"),
                       said["entity_dormant"].alias("dormant"),
                       said["going_concern_asserted"].alias("going_concern_asserted"))


def _at(values: str, names: str, name: str | Column) -> Column:
    """The value beside the first occurrence of a name, null where there is none."""
    return F.get(F.col(values), F.array_position(F.col(names), name).cast("int") - 1)


def scanned(documents: DataFrame, read=None) -> DataFrame:
    """Documents with ``items`` (their narrative elements, flags included) and ``reason`` where unreadable.

    The one Python stage of the layer; all that follows is read off the row.
    """
    from ledgermill.sources import markup

    found = markup.narrative_column(F.col("content"), *([read] if read else []))
    return documents.withColumn("_n", found).select(*documents.columns, "_n.items", "_n.reason")


def classify_filings(documents: DataFrame) -> DataFrame:
    """(filing_id, size, mode, audited, dormant, going_concern_asserted) of every readable document."""
    rows = scanned(documents).where("reason IS NULL").select("filing_id", "items")
    return with_class(rows).drop("items")


def _is_flag(name: Column) -> Column:
    return name.isin(*[n for n, _ in _FLAGS])


def unmapped_narrative(documents: DataFrame) -> DataFrame:
    """(filing_id, ord, name, text) of elements that are neither flags nor of a known section."""
    known = [n for n, _, _ in lookups.NARRATIVE_TAGS]
    other = F.filter("items", lambda e: ~_is_flag(e["name"]) & ~e["name"].isin(*known))
    return scanned(documents).select("filing_id", F.inline(other))


def tag_sections(items: Column) -> Column:
    """ARRAY<STRUCT<section_id, text, source_tags, subsections>> of the sections that tags fill.

    Texts follow the canonical sub-section order, then document order; the last text of a
    sub-section wins its key.
    """
    place = F.create_map(*[F.lit(x) if isinstance(x, str) else x for n, s, k in lookups.NARRATIVE_TAGS for x in (n, F.struct(
        F.lit(s).alias("section_id"), F.lit(k).cast("string").alias("subsection"),
        F.lit(lookups.AUDITOR_SUBSECTIONS.index(k) + 1 if k in lookups.AUDITOR_SUBSECTIONS else 999).alias("sub_order")))])
    plain = F.filter(items, lambda e: (e["text"] != "") & ~_is_flag(e["name"]))
    mapped = F.filter(F.transform(plain, lambda e: F.struct(
        e["ord"].alias("ord"), e["name"].alias("name"), e["text"].alias("text"), place[e["name"]].alias("at"))),
        lambda e: e["at"].isNotNull())

    def filled(mine):
        ordered = F.sort_array(F.transform(mine, lambda e: F.struct(
            e["at"]["sub_order"].alias("a"), e["ord"].alias("b"), e["text"].alias("text"))))
        subs = F.sort_array(F.transform(F.filter(mine, lambda e: e["at"]["subsection"].isNotNull()), lambda e: F.struct(
            e["ord"].alias("ord"), e["at"]["subsection"].alias("k"), e["text"].alias("text"))), False)
        keys = F.array_distinct(F.transform(subs, lambda e: e["k"]))
        return F.struct(
            F.get(mine, F.lit(0))["at"]["section_id"].alias("section_id"),
            F.array_join(F.transform(ordered, lambda e: e["text"]), "\n\n").alias("text"),
            F.transform(mine, lambda e: e["name"]).alias("source_tags"),
            F.map_from_entries(F.transform(keys, lambda k: F.struct(
                k, F.get(F.filter(subs, lambda e: e["k"] == k), F.lit(0))["text"]))).alias("subsections"))

    ids = F.array(*[F.lit(i) for i in lookups.SECTION_IDS])
    groups = F.transform(ids, lambda i: F.filter(mapped, lambda e: e["at"]["section_id"] == i))
    return F.transform(F.filter(groups, lambda g: F.size(g) > 0), filled)


def tag_layer(documents: DataFrame) -> DataFrame:
    """(filing_id, section_id, text, source_tags, subsections) from tags."""
    return scanned(documents).select("filing_id", F.inline(tag_sections(F.col("items"))))


#: All heading patterns by section; the two going-concern slots share one.
_HEADINGS = [(rank, s, p) for rank, (s, p) in enumerate(lookups.SECTION_ANCHORS) if s != "going_concern_directors"]
#: A place where a heading starts, found in one traversal: first a letter that one can start with, then its words.
HEADING_START = "(?i)(?=[sdrpvgiabck])(?=" + "|".join(p for _, _, p in _HEADINGS) + ")"


def heading_pieces(body: Column) -> Column:
    """The body cut before every heading; a heading may reach over two further cuts inside it."""
    return F.split(body, HEADING_START, -1)


def piece_hits(pieces: Column) -> Column:
    """Array of (offset, rank, section_id) of the headings that begin the pieces, by offset.

    Of headings of one section that overlap the first counts, as in a search for that section alone.
    """
    def labelled(piece, i):
        head = F.array_join(F.slice(pieces, i + 1, 3), "")
        found = F.lit(None)
        for rank, section, pattern in reversed(_HEADINGS):
            whole = F.regexp_extract(head, f"(?i)^(?:{pattern})", 0)
            found = F.when(whole != "", F.struct(
                F.lit(rank).alias("rank"), F.lit(section).alias("section_id"), F.length(whole).alias("n"))).otherwise(found)
        return F.struct(F.length(piece).alias("length"), found.alias("h"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<offset: int, rank: int, section_id: string, n: int>>").alias("found"))

    def step(acc, p):
        inside = F.exists(acc["found"], lambda k: (k["section_id"] == p["h"]["section_id"])
                          & (acc["at"] < k["offset"] + k["n"]))
        return F.struct((acc["at"] + p["length"]).alias("at"), F.when(p["h"].isNull() | inside, acc["found"]).otherwise(
            F.array_append(acc["found"], F.struct(
                acc["at"].alias("offset"), p["h"]["rank"].alias("rank"), p["h"]["section_id"].alias("section_id"),
                p["h"]["n"].alias("n")))).alias("found"))

    hits = F.aggregate(F.transform(pieces, labelled), start, step)["found"]
    return F.transform(hits, lambda h: F.struct(h["offset"].alias("offset"), h["rank"].alias("rank"),
                                                h["section_id"].alias("section_id")))


def _with_hits(bodies: DataFrame) -> DataFrame:
    """Add ``hits``.  The one-element explodes keep Spark from evaluating an array once per use."""
    cut = bodies.withColumn("_pieces", F.explode(F.array(heading_pieces(F.col("body_text")))))
    return cut.withColumn("hits", F.explode(F.array(piece_hits(F.col("_pieces"))))).drop("_pieces")


def anchor_hits(bodies: DataFrame) -> DataFrame:
    """(filing_id, offset, rank, section_id) of every heading in the bodies."""
    return _with_hits(bodies).select("filing_id", F.inline("hits"))


def text_sections(body: Column, marks: Column) -> Column:
    """ARRAY<STRUCT<section_id, start, end, text>>: slices between headings, a section's first non-empty one."""
    def piece(h, k):
        end = F.coalesce(F.get(marks, k + 1)["offset"], F.length(body))
        cut = F.substring(body, h["offset"] + 1, end - h["offset"])
        return F.struct(h["section_id"].alias("section_id"), h["offset"].alias("start"),
                        end.alias("end"), F.trim(cut, F.lit(" \t\n\r")).alias("text"))

    # of a section's headings only the first and those at the place of the one before can be needed
    first = F.filter(F.transform(marks, piece), lambda p: p["text"] != "")
    empty = F.array().cast("array<struct<section_id: string, start: int, end: int, text: string>>")
    return F.aggregate(first, empty, lambda acc, p: F.when(
        F.exists(acc, lambda k: k["section_id"] == p["section_id"]), acc).otherwise(F.array_append(acc, p)))


def text_layer(bodies: DataFrame) -> DataFrame:
    """(filing_id, section_id, start, end, text): slices between headings; row-local."""
    marked = _with_hits(bodies)
    return marked.select("filing_id", F.inline(text_sections(F.col("body_text"), F.col("hits"))))


def expected_section(section: Column, size: Column, mode: Column, audited: Column) -> Column:
    """Should a filing of this class carry the section?"""
    small, medium = size == "small", size == "medium"
    large = size.isin("large", "unknown")
    filleted = mode == "filleted"
    bigger = medium | large
    directors = (small & ~filleted) | bigger
    return (F.when(section.isin("strategic_report", "principal_risks"), bigger)
            .when(section == "section_172", large)
            .when(section == "viability_statement", F.lit(False))
            .when(section.isin("directors_report", "principal_activity",
                               "going_concern_directors"), directors)
            .when(section == "auditor_report", F.coalesce(audited, F.lit(False)) | bigger)
            .when(section == "critical_estimates", ~small | ~filleted)
            .otherwise(F.lit(True)))


def absence_reason(section: Column, size: Column, mode: Column) -> Column:
    """Why a section that is not expected is missing."""
    text = F.concat
    return (F.when(section == "section_172",
                   text(F.lit("Not required for "), size, F.lit(" filings (large only)")))
            .when(section.isin("strategic_report", "principal_risks"),
                  text(F.lit("Not required for "), size, F.lit(" filings")))
            .when(section == "viability_statement",
                  "Only required for premium-listed companies")
            .when(section.isin("directors_report", "principal_activity",
                               "going_concern_directors"),
                  text(F.lit("Not delivered in "), mode, F.lit(" filings")))
            .when(section == "auditor_report", "Company is audit-exempt")
            .when(section == "critical_estimates",
                  text(F.lit("Not required for "), size, F.lit(" "), mode, F.lit(" filings")))
            .otherwise("Expected but not found"))


SLOT = ("section_id", "status", "text", "source", "start", "end", "signals", "source_tags", "subsections", "confidence", "reason")


def _slot(section: Column, tag: Column, text: Column, fields: tuple[str, ...]) -> Column:
    """One resolved section of a classified row: by tag, text or flag, else not_present or not_found."""
    size, mode = F.col("size"), F.col("mode")
    by_tag, by_text = tag.isNotNull(), text.isNotNull()
    by_flag = (section == "going_concern_directors") & F.col("going_concern_asserted")
    expected = expected_section(section, size, mode, F.col("audited"))
    source = F.when(by_tag, "ixbrl_tag").when(by_text, "ixbrl_text").when(by_flag, "ixbrl_flag")
    slot = {
        "section_id": section,
        "status": F.when(source.isNotNull(), "found").when(~expected, "not_present").otherwise("not_found"),
        "text": F.when(by_tag, tag["text"]).when(by_text, text["text"]).when(by_flag, GOING_CONCERN_TEXT),
        "source": source,
        "start": F.when(~by_tag, text["start"]), "end": F.when(~by_tag, text["end"]),
        "signals": F.when(by_tag, F.array(F.lit("ixbrl_tag"))).when(by_text, F.array(F.lit("hard_anchor"))).when(
            by_flag, F.array(F.lit("ixbrl_flag"))),
        "source_tags": F.when(by_tag, tag["source_tags"]).when(by_flag & ~by_text, F.array(F.lit(
            lookups.FLAG_TAGS[6][0]))),
        "subsections": F.when(by_tag & (F.size(tag["subsections"]) > 0), tag["subsections"]),
        "confidence": F.when(by_tag, "high").when(by_text, "medium").when(by_flag, "high"),
        "reason": F.when(source.isNull() & ~expected, absence_reason(section, size, mode))}
    return F.struct(*[slot[f].alias(f) for f in fields])


# --- one document in hand ---------------------------------------------------
# Python twins of the expressions above, for filings whose class, tags and headings are read in one go.
_HEADING = re.compile("(?=[sdrpvgiabck])(?=" + "|".join(
    "(" + p.replace(r"\b", r"(?u:\b)") + ")" for _, _, p in _HEADINGS) + ")", re.I | re.A)
_FLAG_NAMES = frozenset(n for n, _ in _FLAGS)
_PLACES = {n: (s, k, lookups.AUDITOR_SUBSECTIONS.index(k) + 1 if k in lookups.AUDITOR_SUBSECTIONS else 999)
           for n, s, k in lookups.NARRATIVE_TAGS}


def read_hits(body: str) -> list[tuple[int, str]]:
    """(offset, section) of every heading, as ``anchor_hits`` finds them."""
    found, reach = [], {}
    for m in _HEADING.finditer(body):
        k = m.lastindex
        section = _HEADINGS[k - 1][1]
        if m.start() >= reach.get(section, 0):
            found.append((m.start(), section))
            reach[section] = m.end(k)
    return found


def read_tags(items: list[tuple[int, str, str]]) -> list[tuple[str, str, list[str], list[tuple[str, str]]]]:
    """(section, text, source tags, sub-sections) of a document's elements, as ``tag_sections`` gives them."""
    groups: dict[str, list] = {}
    for ord_, name, text in items:
        if text and name in _PLACES and name not in _FLAG_NAMES:
            section, sub, order = _PLACES[name]
            groups.setdefault(section, []).append((order, ord_, text, name, sub))
    found = []
    for section in lookups.SECTION_IDS:
        if mine := groups.get(section):
            subs: dict[str, str] = {}
            for _, _, text, _, sub in sorted(mine, key=lambda e: -e[1]):
                if sub is not None:
                    subs.setdefault(sub, text)
            found.append((section, "\n\n".join(e[2] for e in sorted(mine)), [e[3] for e in mine], list(subs.items())))
    return found


def read_texts(body: str, settled: set[str]) -> list[tuple[str, int, int, str]]:
    """(section, start, end, text) of the first non-empty slice of each section that no tag settles.

    Both going-concern slots share one heading: it belongs to the note unless the note is settled.
    """
    note, directors = "going_concern_note", "going_concern_directors"
    hits = [(at, directors if s == note and note in settled else s) for at, s in read_hits(body)]
    marks = [h for h in hits if h[1] not in settled]
    found: dict[str, tuple] = {}
    for (at, section), (end, _) in zip(marks, [*marks[1:], (len(body), "")]):
        if section not in found and (text := body[at:end].strip(" \t\n\r")):
            found[section] = (section, at, end, text)
    return list(found.values())


_FILING = pa.struct([
    ("reason", pa.string()),
    ("items", pa.list_(pa.struct([("ord", pa.int32()), ("name", pa.string()), ("text", pa.string())]))),
    ("tags", pa.list_(pa.struct([("section_id", pa.string()), ("text", pa.string()), ("source_tags", pa.list_(pa.string())),
                                 ("subsections", pa.map_(pa.string(), pa.string()))]))),
    ("texts", pa.list_(pa.struct([("section_id", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])))])
FILING_TYPE = ("struct<reason: string, items: array<struct<ord: int, name: string, text: string>>, tags: array<struct<"
               "section_id: string, text: string, source_tags: array<string>, subsections: map<string, string>>>, "
               "texts: array<struct<section_id: string, start: int, end: int, text: string>>>")


def filing_column(content: Column, read=None, whole: bool = True) -> Column:
    """STRUCT<reason, items, tags, texts>: why a document cannot be read, or its flags and what tags and headings fill.

    Without ``whole`` the sections come without their texts, tags and sub-sections, which nobody then moves.
    """
    from ledgermill.sources import markup

    read = read or markup.read_narrative

    def one(content):
        items, reason = read(content)
        if items is None or reason is not None:
            return reason, [], [], []
        tags = read_tags(items)
        texts = read_texts(markup.read_body(content), {t[0] for t in tags}) if content is not None else []
        if not whole:
            tags, texts = [(t[0], None, None, None) for t in tags], [(*t[:3], None) for t in texts]
        return None, [i for i in items if i[1] in _FLAG_NAMES], tags, texts

    @F.arrow_udf(FILING_TYPE)
    def scan(contents: pa.Array) -> pa.Array:
        reasons, *lists = zip(*map(one, markup.batch_texts(contents))) if len(contents) else [()] * 4
        return pa.StructArray.from_arrays([pa.array(reasons, pa.string()), *[
            markup.batch_lists(rows, f.type.value_type) for rows, f in zip(lists, list(_FILING)[1:])]], fields=list(_FILING))

    return scan.asNondeterministic()(content)  # else a filter on the result would run it twice


def filings_of(documents: DataFrame, read=None, fields: tuple[str, ...] = SLOT) -> DataFrame:
    """(filing_id, reason, size, mode, slots): class and all twelve slots of every tagged document, in one pass.

    A document that cannot be read has its reason and one slot with the status ``rejected``.  ``fields``
    names what is worked out of each slot.
    """
    whole = bool({"text", "source_tags", "subsections"} & {*fields})
    found = filing_column(F.col("content"), read, whole)
    rows = with_class(documents.select("filing_id", found.alias("_n")).select(
        "filing_id", "_n.reason", "_n.items", "_n.tags", "_n.texts")).drop("items")
    for layer in ("tags", "texts"):
        rows = rows.withColumn(f"{layer}_ids", F.explode(F.array(F.transform(layer, lambda t: t["section_id"]))))
    # one lambda for the twelve slots: written out they outgrow what is compiled
    slots = F.transform(F.array(*[F.lit(i) for i in lookups.SECTION_IDS]), lambda i: _slot(
        i, _at("tags", "tags_ids", i), _at("texts", "texts_ids", i), fields))
    rejected = F.array(F.struct(*[
        (F.lit("rejected") if n == "status" else F.col("reason") if n == "reason" else F.lit(None)).alias(n) for n in fields]))
    return rows.select("filing_id", "reason", "size", "mode", F.explode(F.array(F.when(
        F.col("reason").isNull(), slots).otherwise(rejected))).alias("slots"))


def sections_of(documents: DataFrame, read=None) -> DataFrame:
    """All twelve slots of every tagged document, from its own row in one pass.

    A document that cannot be read gives one row with the status ``rejected`` and the reason, and
    the others go on.
    """
    return filings_of(documents, read).select("filing_id", F.inline("slots"))


def preferred(rows: DataFrame) -> DataFrame:
    """Of rows (company, section, rank, status, text) the found one of the lowest rank, else the lowest rank.

    Each column is picked by itself, so that texts which nobody asks for are not moved.
    """
    best = F.struct((F.col("status") != "found").cast("int"), "rank")
    return rows.groupBy("company_number", "section_id").agg(
        *[F.min_by(c, best).alias(c) for c in ("rank", "status", "text")]).select(
        "company_number", "section_id", F.when(F.col("rank") == 0, "tagged").otherwise("printed").alias("source"),
        "status", "text")


def prefer_tagged(tagged: DataFrame, printed: DataFrame) -> DataFrame:
    """Tagged sections over printed ones per (company, section)."""
    t = tagged.select("company_number", "section_id", F.lit(0).alias("rank"), "status", "text")
    p = printed.select("company_number", "section_id", F.lit(1).alias("rank"), "status", "text")
    return preferred(t.unionByName(p))


def prefer_tagged_slots(slots: DataFrame, texts: DataFrame) -> DataFrame:
    """``prefer_tagged`` of printed slots and the texts of the same slots, with one pass over the slots.

    ``slots(company_number, section_id, status, text)`` meet ``texts(company_number, section_id, text)``;
    each pair gives its tagged and its printed row.
    """
    held = texts.select("company_number", "section_id", F.col("text").alias("_tagged"), F.lit(True).alias("_hit"))
    status = F.when(F.col("_hit"), "found").otherwise("not_found")
    sides = F.array(F.struct(F.lit(0).alias("rank"), status.alias("status"), F.col("_tagged").alias("text")),
                    F.struct(F.lit(1).alias("rank"), F.col("status").alias("status"), F.col("text").alias("text")))
    return preferred(slots.join(held, ["company_number", "section_id"], "left").select(
        "company_number", "section_id", F.inline(sides)))
