"""Parsers of numbers and short grammars in text. A text that doesn't parse gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(text: Column) -> Column:
    """Whole dollars of "$1,262,500"."""
    return F.regexp_replace(F.trim(text), "[$,]", "").try_cast("long")


def percent(text: Column) -> Column:
    """Number of "75%"."""
    return F.regexp_replace(F.trim(text), "%+$", "").try_cast("double")


def whole(text: Column) -> Column:
    """A text of digits only, as a number."""
    return F.when(F.trim(text).rlike(r"^\d+$"), F.trim(text).try_cast("long"))


def comma_whole(text: Column) -> Column:
    """Digits with thousands separators, as a number."""
    return whole(F.regexp_replace(text, ",", ""))


def decimal_number(text: Column) -> Column:
    """A decimal number; null for an empty text."""
    return F.trim(text).try_cast("double")


def attainment(text: Column) -> Column:
    """Struct (year, round) of "23/1" or "23/1*"; null for other texts."""
    pattern = r"^(\d\d)/([1-7])\*?$"
    return F.when(
        text.rlike(pattern),
        F.struct((F.regexp_extract(text, pattern, 1).cast("int") + 2000).alias("year"), F.regexp_extract(text, pattern, 2).cast("int").alias("round")),
    )


def fraction_value(text: Column) -> Column:
    """Value of "13/15" as a ratio, "31:22" in minutes, "75%" as a number, or a plain number."""
    left = lambda sep: F.substring_index(text, sep, 1).try_cast("double")
    right = lambda sep: F.substring_index(text, sep, -1).try_cast("double")
    ratio = F.try_divide(left("/"), right("/"))
    clock = left(":") + right(":") / 60
    return F.when(text.contains("/"), ratio).when(text.contains(":"), clock).when(text.endswith("%"), percent(text)).otherwise(decimal_number(text))


def roster_cell(cell: Column) -> Column:
    """Struct (name, draft_pick) of "Name (N)"; null for blank cells, cells without letters and OPEN places."""
    text = F.trim(cell)
    pattern = r"^(.*?)\s*\((\d+)\)\s*$"
    vacant = text.isNull() | F.upper(text).startswith("OPEN") | ~text.rlike(r"\p{L}")
    named = F.when(text.rlike(pattern), F.struct(F.regexp_extract(text, pattern, 1).alias("name"), F.regexp_extract(text, pattern, 2).cast("int").alias("draft_pick")))
    return F.when(~vacant, F.coalesce(named, F.struct(text.alias("name"), F.lit(None).cast("int").alias("draft_pick"))))


def height_code(code: Column) -> Column:
    """Inches of an F-II-T code: 6040 is 76.0."""
    text = F.trim(code)
    digit = lambda start, n: F.substring(text, start, n).cast("int")
    return F.when(text.rlike(r"^\d{4}$"), F.round(digit(1, 1) * 12 + digit(2, 2) + digit(4, 1) / 10, 1))


def height_text(inches: Column, separator: str = "'", end: str = '"') -> Column:
    """6'2" (or 6-2) from inches; null for null or zero."""
    n = F.round(inches).cast("int")
    return F.when(n > 0, F.concat(F.floor(n / 12).cast("string"), F.lit(separator), (n % 12).cast("string"), F.lit(end)))


def height_inches(text: Column) -> Column:
    """Inches from 6'2" or 6-2."""
    pattern = r"^\s*(\d)\s*['\-]\s*(\d{1,2})\"?\s*$"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1).cast("int") * 12 + F.regexp_extract(text, pattern, 2).cast("int"))


def long_date(text: Column) -> Column:
    """Date of "October 2, 2026"."""
    return F.try_to_date(text, "MMMM d, yyyy") if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(text, F.lit("MMMM d, yyyy")))


def first_field(text: Column, separator: str) -> Column:
    """The text before a separator."""
    return F.substring_index(text, separator, 1)


def after_mark(text: Column, mark: str) -> Column:
    """What follows the last occurrence of a mark, null if it doesn't occur."""
    return F.when(text.contains(mark), F.substring_index(text, mark, -1))


def digits_in(text: Column, pattern: str) -> Column:
    """First group of a pattern as a number, null without a match."""
    return F.regexp_extract(text, pattern, 1).try_cast("long")


def _labelled_values(parts: Column) -> Column:
    """Array of (label, value) from parts like "13 GP"; parts of one word are left out."""
    trimmed = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p.contains(" "))
    return F.transform(trimmed, lambda p: F.struct(F.trim(F.regexp_replace(p, r"^\S+ ", "")).alias("label"), F.substring_index(p, " ", 1).alias("value")))


def season_line(text: Column) -> Column:
    """Struct (season, school, gp, stats, career) of "2025: School | 13 GP | 87 Rec; Career: 38 GP | ...".

    The last season block counts; null if no block is a season. ``stats`` is an
    array of (label, value) without GP, ``career`` all of the last career block, null without one.
    """
    headed = F.filter(F.transform(F.split(text, ";"), lambda b: F.trim(b)), lambda b: b.contains(":"))
    head = lambda b: F.trim(F.substring_index(b, ":", 1))
    rest = lambda b: F.split(F.regexp_replace(b, r"^[^:]*:", ""), r"\|")
    season = F.try_element_at(F.filter(headed, lambda b: head(b).rlike(r"^\d+$")), F.lit(-1))
    career = F.try_element_at(F.filter(headed, lambda b: F.lower(head(b)) == "career"), F.lit(-1))
    parts = rest(season)
    items = _labelled_values(F.slice(parts, F.lit(2), F.size(parts)))
    return F.when(
        season.isNotNull(),
        F.struct(
            head(season).alias("season"),
            F.trim(F.get(parts, F.lit(0))).alias("school"),
            F.get(F.filter(items, lambda x: x["label"] == "GP"), F.lit(0))["value"].alias("gp"),
            F.filter(items, lambda x: x["label"] != "GP").alias("stats"),
            _labelled_values(rest(career)).alias("career"),
        ),
    )
