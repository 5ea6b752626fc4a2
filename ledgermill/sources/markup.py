"""Tagged documents: facts, contexts, narrative and visible text from their markup.

Everything a document needs is in its own row, so facts find their context inside the row
and nothing is shuffled until the facts are aggregated.
"""

from __future__ import annotations

import html
import html.entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import text

CONTEXT = r"(?is)<xbrli:context\b[^>]*>.*?</xbrli:context>"

# Blanks that surround printed values: ASCII white space, no-break and typographic spaces.
BLANKS = " \t\n\r\x0b\f\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\ufeff"


def attribute(element: Column, name: str) -> Column:
    """Attribute of the opening tag, null when absent."""
    opening = F.substring_index(element, ">", 1)
    return F.get(F.regexp_extract_all(
        opening, F.lit(rf"(?i)\s{name}\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1)), F.lit(0))


#: Names of most references that occur; all others are looked up in the full table.
COMMON = ["amp", "nbsp", "lt", "gt", "quot", "apos", "pound", "ndash", "rsquo"]
#: References that also count without a semicolon, longest names first.
_BARE = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def decode(value: Column) -> Column:
    """Character references, named and numeric, as the characters they stand for."""
    names = sorted(n[:-1] for n in html.entities.html5 if n.endswith(";"))
    named = F.create_map(*[F.lit(x) for n in names for x in (n, html.entities.html5[n + ";"])])
    windows = F.array(*[F.lit(html.unescape(f"&#{n};")) for n in range(128, 160)])

    def by_name(ref: Column) -> Column:
        found = F.when(ref == COMMON[0], html.entities.html5[COMMON[0] + ";"])
        for n in COMMON[1:]:
            found = found.when(ref == n, html.entities.html5[n + ";"])
        return found.otherwise(F.try_element_at(named, ref))

    def bound(value: Column, use) -> Column:
        """``use`` of a value that is found once, as the element of an array."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def character(ref: Column) -> Column:
        number = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 8), 16, 10)).otherwise(
            F.substring(ref, 2, 8)).try_cast("int")
        return F.when(~ref.startswith("#"), by_name(ref)).otherwise(bound(number, lambda point: F.when(
            point.between(128, 159), F.try_element_at(windows, point - 127)).when(
            point.between(1, 55295) | point.between(57344, 1114111),
            F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))))

    def replaced(part: Column, ref: Column, end: int) -> Column:
        return F.concat(character(ref), F.substring(part, F.length(ref) + end, F.length(part)))

    def piece(part: Column, i: Column) -> Column:
        closed = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        open_ = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|" + "|".join(_BARE) + ")", 1)
        whole = bound(closed, lambda ref: F.when(ref != "", replaced(part, ref, 2)))
        bare = bound(open_, lambda ref: F.when(ref != "", replaced(part, ref, 1)))
        return F.when(i == 0, part).otherwise(F.coalesce(whole, bare, F.concat(F.lit("&"), part)))

    return F.when(value.contains("&"), F.array_join(F.transform(F.split(value, "&"), piece), "")).otherwise(value)


def strip_tags(fragment: Column, sep: str = " ") -> Column:
    """Text nodes of a fragment, trimmed and joined by ``sep``."""
    nodes = F.split(F.regexp_replace(fragment, r"(?s)<!--.*?-->", ""), r"<[^>]*>")
    clean = F.transform(nodes, lambda n: F.trim(decode(n), F.lit(BLANKS)))
    return F.array_join(F.filter(clean, lambda n: n != ""), sep)


def body_text(content: Column) -> Column:
    """Visible text of a document: no header block, scripts or styles; one node per line."""
    visible = F.regexp_replace(content, r"(?is)<ix:header\b.*?</ix:header>", "")
    visible = F.regexp_replace(visible, r"(?is)<(script|style)\b.*?</(script|style)>", "")
    inner = F.regexp_extract(visible, r"(?is)<body\b[^>]*>(.*)</body>", 1)
    return strip_tags(F.when(inner != "", inner).otherwise(visible), "\n")


def _context(element: Column) -> Column:
    end = F.regexp_extract(element, r"(?is)<xbrli:enddate[^>]*>\s*(.*?)\s*</xbrli:enddate>", 1)
    instant = F.regexp_extract(element, r"(?is)<xbrli:instant[^>]*>\s*(.*?)\s*</xbrli:instant>", 1)
    members = F.regexp_extract_all(
        element, F.lit(r"(?is)<xbrldi:explicitmember[^>]*>\s*(.*?)\s*</xbrldi:explicitmember>"),
        F.lit(1))
    # One-element transforms bind what is used more than once.
    return F.get(F.transform(F.array(end), lambda e: F.get(F.transform(
        F.array(F.when(e != "", e).otherwise(instant)), lambda date: F.struct(
            attribute(element, "id").alias("ctx_id"),
            text.year_of(date).alias("year"),
            F.when(e != "", "duration").when(date != "", "instant").alias("ctx_type"),
            element.rlike("(?i)<xbrli:segment").alias("dimensional"),
            F.transform(members, text.local_name).alias("members"))), F.lit(0))), F.lit(0))


def context_array(content: Column) -> Column:
    """Contexts of a document that name a period."""
    found = F.transform(F.regexp_extract_all(content, F.lit(CONTEXT), F.lit(0)), _context)
    return F.filter(found, lambda c: c["ctx_type"].isNotNull())


def contexts(documents: DataFrame) -> DataFrame:
    """Context rows of every document."""
    return documents.select("filing_id", F.inline(context_array(F.col("content"))))


# The scans below read a document in one go on Arrow batches beside its row: as lambdas over arrays the
# same steps cost several times as much.  ASCII keeps case folding and blanks as in the patterns above.
_FACT_EDGE = re.compile(r"(<(?:ix:nonfraction(?u:\b)[^>]*|/ix:nonfraction\s*)>)", re.I | re.A)
_CONTEXT_OPEN = re.compile(r"<xbrli:context(?u:\b)[^>]*>", re.I | re.A)
_CONTEXT_CLOSE = re.compile(r"</xbrli:context>", re.I | re.A)
_END_DATE = re.compile(r"<xbrli:enddate[^>]*>\s*(.*?)\s*</xbrli:enddate>", re.I | re.A | re.S)
_INSTANT = re.compile(r"<xbrli:instant[^>]*>\s*(.*?)\s*</xbrli:instant>", re.I | re.A | re.S)
_MEMBER = re.compile(r"<xbrldi:explicitmember[^>]*>\s*(.*?)\s*</xbrldi:explicitmember>", re.I | re.A | re.S)
_SEGMENT = re.compile("<xbrli:segment", re.I | re.A)
_YEAR = re.compile(r" *([0-9]{4})")
_READ = ("name", "unitref", "scale", "decimals", "sign")
_REFERENCE = re.compile(r"(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_BARE_REFERENCE = re.compile(r"#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|" + "|".join(_BARE))


def _attributes(names: tuple[str, ...]):
    """A reader of the first value of each name in an opening tag, as ``attribute`` reads each by itself."""
    every = re.compile(r"\s(" + "|".join(names) + r")\s*=\s*[\"']([^\"']*)[\"']", re.I | re.A)
    single = {n: re.compile(rf"\s{n}\s*=\s*[\"']([^\"']*)[\"']", re.I | re.A) for n in names}

    def read(tag: str) -> dict[str, str]:
        pairs = every.findall(tag)
        if tag.count("=") > len(pairs) and any("=" in v for _, v in pairs):  # a value may hold another attribute's start
            return {n: m.group(1) for n, p in single.items() if (m := p.search(tag))}
        return {n.lower(): v for n, v in reversed(pairs)}

    return read


def _character(ref: str) -> str | None:
    """The character of a reference, as in ``decode``."""
    if ref[0] != "#":
        return html.entities.html5.get(ref + ";")
    point = int(ref[2:], 16) if ref[1] in "xX" else int(ref[1:])
    if 128 <= point <= 159:
        return html.unescape(f"&#{point};")
    if point == 0xFEFF:  # read as a byte order mark
        return ""
    return chr(point) if 1 <= point <= 55295 or 57344 <= point <= 1114111 else None


def _decoded(value: str) -> str:
    """``decode`` of a text in hand."""
    if "&" not in value:
        return value
    first, *parts = value.split("&")
    out = [first]
    for part in parts:
        closed = _REFERENCE.match(part)
        found = _character(closed.group(1)) if closed else None
        if found is not None:
            out += [found, part[closed.end():]]
            continue
        bare = _BARE_REFERENCE.match(part)
        found = _character(bare.group(0)) if bare else None
        out += ["&", part] if found is None else [found, part[bare.end():]]
    return "".join(out)


def _stripped(fragment: str, sep: str) -> str:
    """``strip_tags`` of a fragment in hand."""
    nodes = _MARKUP.split(_COMMENT.sub("", fragment) if "<!--" in fragment else fragment)
    return sep.join([t for n in nodes if n and (t := (_decoded(n) if "&" in n else n).strip(BLANKS))])


_COMMENT = re.compile(r"<!--.*?-->", re.S)
_MARKUP = re.compile(r"<[^>]*>")
_id_of = _attributes(("id",))
#: Openings and closings of what a document does not show, in the order in which it is cut out.
_UNSEEN = [tuple(re.compile(p, re.I | re.A) for p in pair) for pair in (
    (r"<ix:header(?u:\b)", "</ix:header>"), (r"<(?:script|style)(?u:\b)", "</(?:script|style)>"))]
_BODY = re.compile(r"<body(?u:\b)[^>]*>(.*)</body>", re.I | re.A | re.S)


def _without(content: str, opening: re.Pattern, closing: re.Pattern) -> str:
    """The content without what lies from each opening to the next closing; both go as well."""
    kept, at = [], 0
    while (start := opening.search(content, at)) and (end := closing.search(content, start.end())):
        kept.append(content[at:start.start()])
        at = end.end()
    return "".join([*kept, content[at:]])


def read_body(content: str) -> str:
    """``body_text`` of a document in hand."""
    visible = content
    for pair in _UNSEEN:
        visible = _without(visible, *pair)
    inner = _BODY.search(visible)
    return _stripped(inner.group(1) if inner and inner.group(1) else visible, "\n")


def read_contexts(content: str) -> list[tuple[str | None, int | None, bool, list[str]]]:
    """(id, year, dimensional, members) of the contexts of a document that name a period."""
    found, at = [], 0
    while opening := _CONTEXT_OPEN.search(content, at):
        closing = _CONTEXT_CLOSE.search(content, opening.end())
        if not closing:
            break
        at = closing.end()
        element = content[opening.start():at]
        date = _END_DATE.search(element)
        if not date or not date.group(1):
            date = _INSTANT.search(element)
        if not date or not date.group(1):
            continue
        year = _YEAR.match(date.group(1))
        dimensional = bool(_SEGMENT.search(element))
        members = [m.rpartition(":")[2] for m in _MEMBER.findall(element)]
        found.append((_id_of(opening.group(0)[:-1]).get("id"), int(year.group(1)) if year else None, dimensional, members))
    return found


def read_facts(content: str, attributes, reference: str = "contextref", years: str | None = None) -> list[tuple]:
    """(ord, ctx_id, year, dimensional, members, attributes .., raw) of the numeric elements with a dated context.

    The markup is cut at the elements' tags.  A self-closing element is empty; another one ends at the
    edge that brings its depth back.  Elements that are never closed drop out, before they are numbered.
    ``years`` adds every year of a context as a fact of that name with the value 0.
    """
    cut = _FACT_EDGE.split(content)
    contexts = read_contexts(content) if len(cut) > 1 or years else []
    held = {c[0]: c for c in contexts if c[0] is not None}
    tags, pieces = cut[1::2], cut[2::2]
    ends: dict[int, int] = {}
    open_: list[int] = []
    for i, tag in enumerate(tags):
        if tag.startswith("</"):
            if open_:
                ends[open_.pop()] = i
        elif tag.endswith("/>"):
            ends[i] = i
        else:
            open_.append(i)
    found = []
    for ord_, i in enumerate(sorted(ends)):
        read = attributes(tags[i][:-1])
        context = held.get(read.get(reference))
        if context is None or context[1] is None:
            continue
        raw = pieces[i] if ends[i] == i + 1 else "<i>".join(pieces[i:ends[i]])
        raw = _stripped(raw, "") if "<" in raw or "&" in raw else raw.strip(BLANKS)
        get = read.get
        found.append((ord_, *context, get("name"), get("unitref"), get("scale"), get("decimals"), get("sign"), raw))
    if years:
        seen = dict.fromkeys(c[1] for c in contexts if c[1] is not None)
        found += [(len(ends) + k, None, y, False, [], years, None, None, None, None, "0") for k, y in enumerate(seen)]
    return found


_FACT = pa.struct([("ord", pa.int64()), ("ctx_id", pa.string()), ("year", pa.int32()), ("dimensional", pa.bool_()),
                   ("members", pa.list_(pa.string())), ("name", pa.string()), ("unit", pa.string()), ("scale", pa.string()),
                   ("decimals", pa.string()), ("sign", pa.string()), ("raw", pa.string())])
FACTS_TYPE = ("array<struct<ord: bigint, ctx_id: string, year: int, dimensional: boolean, members: array<string>, name: string, "
              "unit: string, scale: string, decimals: string, sign: string, raw: string>>")


def batch_texts(contents: pa.Array) -> list[str | None]:
    """The texts of a batch; bytes that are no text are replaced, as the engine does."""
    try:
        return contents.to_pylist()
    except UnicodeDecodeError:
        raw = contents.cast(pa.large_binary() if pa.types.is_large_string(contents.type) else pa.binary())
        return [None if b is None else b.decode("utf-8", "replace") for b in raw.to_pylist()]


def batch_lists(rows: list[list[tuple]], kind: pa.StructType) -> pa.Array:
    """A batch's lists of rows, built column by column."""
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    columns = list(zip(*[x for r in rows for x in r])) or [()] * len(kind)
    flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def facts_column(content: Column, years: str | None = None) -> Column:
    """ARRAY<STRUCT>: the numeric elements of a document with their contexts and attributes."""
    @F.arrow_udf(FACTS_TYPE)
    def read(contents: pa.Array, references: pa.Array) -> pa.Array:
        reference = references[0].as_py() if len(references) else "contextref"
        attributes = _attributes((reference, *_READ))
        return batch_lists([[] if c is None else read_facts(c, attributes, reference, years) for c in batch_texts(contents)], _FACT)

    return read.asNondeterministic()(content, F.lit("contextref"))  # else a filter on the result would run it twice


def facts(documents: DataFrame, years: str | None = None) -> DataFrame:
    """Fact rows of every document, context resolved inside the row.

    Facts without a dated context drop out; the last context of an id counts.  With ``years`` every year
    that a context names comes along as a fact of that name, so that documents are read once for both.
    """
    keys = [c for c in documents.columns if c != "content"]
    rows = documents.select(*keys, facts_column(F.col("content"), years).alias("_f")).select(*keys, F.explode("_f").alias("_e"))
    return rows.select(*keys, *[F.col(f"_e.{c}").alias(c) for c in (
        "ord", "name", "ctx_id", "year", "dimensional", "members", "unit", "scale", "decimals", "sign", "raw")])


def seen_years(documents: DataFrame) -> DataFrame:
    """(company_number, year) of every context, with or without facts."""
    years = F.array_distinct(F.transform(context_array(F.col("content")), lambda c: c["year"]))
    return documents.select("company_number", F.explode(years).alias("year")).where(
        "year is not null").distinct()


_EDGE = re.compile(r"<ix:nonnumeric\b([^>]*)>|</ix:nonnumeric\s*>", re.I)
_NAME = re.compile(r"\sname\s*=\s*[\"']([^\"']*)[\"']", re.I)
_TAG = re.compile(r"<!--.*?-->|<[^>]*>", re.S)


def _elements(content: str) -> list[tuple[int, str, str]]:
    """(ord, name, text) of the narrative elements of one document, nested ones included."""
    found, open_ = [], []
    for edge in _EDGE.finditer(content):
        if edge.group(0).startswith("</"):
            if open_:
                slot, start = open_.pop()
                nodes = _TAG.split(content[start:edge.start()])
                text_ = " ".join(t for t in (html.unescape(n).strip() for n in nodes) if t)
                found[slot][2] = text_
        else:
            name = _NAME.search(edge.group(1))
            if not edge.group(0).endswith("/>"):
                open_.append((len(found), edge.end()))
            found.append([len(found), name.group(1) if name else "", ""])
    return [tuple(f) for f in found if ":" in f[1]]


def read_narrative(content: str | None) -> tuple[list[tuple[int, str, str]] | None, str | None]:
    """(elements, None) of a document, or (None, the reason why it cannot be read)."""
    if content is None or not content.strip():
        return None, "no content"
    if "<" not in content:
        return None, "no markup"
    try:
        return _elements(content), None
    except Exception as e:  # a broken document is reported, it does not end the job
        return None, f"{type(e).__name__}: {e}"


NARRATIVE_TYPE = "struct<items: array<struct<ord: int, name: string, text: string>>, reason: string>"
_ITEM = pa.struct([("ord", pa.int32()), ("name", pa.string()), ("text", pa.string())])


def narrative_column(content: Column, read=read_narrative) -> Column:
    """STRUCT<items, reason>: the narrative elements of a document, or why there are none.

    They nest, which no regular expression can balance, so a small scan runs on Arrow batches beside
    the row; documents are independent rows, so it needs no shuffle.
    """
    @F.arrow_udf(NARRATIVE_TYPE)
    def scan(contents: pa.Array) -> pa.Array:
        found = [read(c) for c in contents.to_pylist()]
        rows = [None if items is None else [dict(zip(("ord", "name", "text"), i)) for i in items] for items, _ in found]
        return pa.StructArray.from_arrays(
            [pa.array(rows, pa.list_(_ITEM)), pa.array([reason for _, reason in found], pa.string())], ["items", "reason"])

    return scan.asNondeterministic()(content)  # else a filter on the result would run it twice


def narrative(documents: DataFrame) -> DataFrame:
    """(filing_id, ord, name, text) of narrative elements."""
    return documents.select("filing_id", narrative_column(F.col("content")).alias("_n")).select(
        "filing_id", F.inline("_n.items"))


def taxonomy_version(content: Column) -> Column:
    """Taxonomy and year from the schema reference, else the namespaces, else unknown."""
    ref = F.regexp_extract(content, r"(?is)<link:schemaref\b[^>]*href=[\"']([^\"']*)[\"']", 1)
    spaces = F.array_join(F.regexp_extract_all(
        content, F.lit(r"(?i)xmlns:\w+=[\"']([^\"']*)[\"']"), F.lit(1)), " ")

    def version(uri: Column) -> Column:
        frc = F.regexp_extract(uri, r"xbrl\.frc\.org\.uk/\S*?(20[0-9]{2})", 1)
        ifrs = F.regexp_extract(uri, r"xbrl\.ifrs\.org/\S*?(20[0-9]{2})", 1)
        return F.when(frc != "", F.concat(F.lit("frc-uk-"), frc)).when(
            ifrs != "", F.concat(F.lit("ifrs-"), ifrs))

    return F.coalesce(version(ref), version(spaces), F.lit("unknown"))
