"""Text functions over page text, labels and headings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill import lookups


def year_of(text: Column) -> Column:
    """Leading four-digit year of a date text."""
    return F.regexp_extract(F.trim(text), r"^([0-9]{4})", 1).try_cast("int")


def local_name(name: Column) -> Column:
    """Part after the last colon of a qualified tag name."""
    return F.substring_index(name, ":", -1)


def prefix_of(name: Column) -> Column:
    """Part before the first colon, ``_any`` when there is none."""
    return F.when(name.contains(":"), F.substring_index(name, ":", 1)).otherwise(F.lit("_any"))


def registration_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\b([0-9]{8})\b", 1), F.lit(""))


def year_ended(text: Column) -> Column:
    return F.nullif(
        F.regexp_extract(text, r"(?i)YEAR ENDED\s+([0-9]{1,2}\s+\w+\s+[0-9]{4})", 1), F.lit(""))


def cover_company(text: Column) -> Column:
    """Upper-case company name on a cover."""
    return F.nullif(F.trim(F.regexp_extract(
        text, r"([A-Z][A-Z0-9 &,.'()\-]+(?:LIMITED|PLC|LTD|LLP))", 1)), F.lit(""))


def header_company(text: Column) -> Column:
    """Shortest mixed-case company name, used to rule out running headers."""
    return F.nullif(F.trim(F.regexp_extract(
        text, r"([A-Z][A-Za-z0-9 &,.'()\-]+?(?:LIMITED|PLC|LTD|LLP))", 1)), F.lit(""))


def contains_any(text: Column, phrases: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in phrases])


def currency_scale(text: Column) -> Column:
    """Units a statement declares; recorded only, never applied."""
    lowered = F.lower(text)
    return (F.when(lowered.rlike(r"£\s*m\b|£\s*million|in millions"), "millions")
            .when(lowered.rlike(r"£\s*'?000|in thousands"), "thousands")
            .otherwise("pounds"))


def first_label(label: Column, rules: list[tuple[str, object]]) -> Column:
    """Value of the first rule whose pattern is contained in the label."""
    branch = None
    for pattern, value in rules:
        cond = label.contains(pattern)
        branch = F.when(cond, F.lit(value)) if branch is None else branch.when(
            cond, F.lit(value))
    return branch


def _anchors(only: list[str] | None) -> tuple[list[tuple[str, str]], str]:
    """(section, pattern) of the named sections, and one pattern for all of them."""
    chosen = [(s, "(?i)" + p) for s, p in lookups.SECTION_ANCHORS if not only or s in only]
    return chosen, "(?i)" + "|".join(dict.fromkeys(p[4:] for _, p in chosen))


def first_anchor(text: Column, only: list[str] | None = None) -> Column:
    """First section whose heading pattern occurs in the text, in match order.

    One pattern for all decides first, so most texts are read once.
    """
    chosen, any_of = _anchors(only)
    branch = F.when(~text.rlike(any_of), F.lit(None).cast("string"))
    for section, pattern in chosen:
        branch = branch.when(text.rlike(pattern), F.lit(section))
    return branch


def all_anchors(text: Column, only: list[str] | None = None) -> Column:
    """Array of every section whose heading pattern occurs in the text."""
    chosen, any_of = _anchors(only)
    found = F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(s)) for s, p in chosen]))
    return F.when(text.rlike(any_of), found).otherwise(
        F.when(text.isNotNull(), F.array().cast("array<string>")))


def pages_referred(text: Column) -> Column:
    """Array of page ranges named as ``pages n to m``."""
    return F.regexp_extract_all(text, F.lit(r"(?i)(pages? [0-9]+ (?:to|-) [0-9]+)"), F.lit(1))


def text_page(text: Column) -> Column:
    """Is a page born-digital text: more than 20 words and mostly letters?"""
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    solid = F.length(F.regexp_replace(text, r"\s", ""))
    return (words > 20) & (F.try_divide(letters, solid) > 0.5)


def fuzzy_contains(words: Column, phrase: str) -> Column:
    """Does a run of words equal the phrase within one edit per six characters?

    ``words`` is the upper-cased word array of one page; windows have the phrase's length.
    """
    n = len(phrase.split())
    budget = max(1, len(phrase) // 6)

    def found(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(1)))
        window = F.transform(starts, lambda i: F.array_join(F.slice(ws, i, n), " "))
        return (F.size(ws) >= n) & F.exists(
            window, lambda w: F.levenshtein(w, F.lit(phrase), budget).between(0, budget))

    # The one-element array binds the words, which would be split again for every window.
    return F.exists(F.array(words), found)
