"""Name and label normalisers. The variants differ on purpose: each source family needs its own key."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Generational suffixes that a key leaves out as whole words.
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "vi", "v")


@functools.cache
def _fold_table() -> tuple[str, str]:
    """Latin letters whose decomposition starts with a plain letter, and those letters, by rule."""
    pairs = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFKD", chr(code))
        if len(base) > 1 and base[0].isascii() and base[0].isalpha() and all(unicodedata.combining(c) for c in base[1:]):
            pairs[chr(code)] = base[0]
    return "".join(pairs), "".join(pairs.values())


def fold_accents(c: Column) -> Column:
    """The text without accents on Latin letters, composed or combining."""
    return F.regexp_replace(F.translate(c, *_fold_table()), r"\p{Mn}", "")


def squeeze(c: Column) -> Column:
    """Inner white space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _without_suffix_words(lowered: Column, words: Sequence[str] = SUFFIXES) -> Column:
    return F.array_join(F.filter(F.split(squeeze(lowered), " "), lambda t: ~t.isin(*words)), " ")


def match_key(name: Column, accents: bool = False) -> Column:
    """Letters only, in lower case and glued together; '' for a missing name.

    Suffixes go as whole words before punctuation does, so the initials of
    "V.J." stay. ``accents`` folds accented letters instead of dropping them.
    """
    text = F.coalesce(name, F.lit(""))
    lowered = F.regexp_replace(F.lower(fold_accents(text) if accents else text), r"\.", "")
    return F.regexp_replace(_without_suffix_words(lowered), "[^a-z]", "")


def spaced_key(name: Column) -> Column:
    """Lower-case words with single spaces: accents folded, hyphens as spaces, suffixes dropped."""
    text = F.regexp_replace(F.lower(fold_accents(F.coalesce(name, F.lit("")))), "-", " ")
    text = F.regexp_replace(text, r"\b(jr|sr|ii|iii|iv)\b\.?", "")
    return squeeze(F.regexp_replace(text, "[^a-z ]", ""))


def loose_key(name: Column) -> Column:
    """Lower-case words without suffixes or any character but plain letters (accented ones are dropped)."""
    text = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\b(jr|sr|ii|iii|iv)\b\.?", "")
    return squeeze(F.regexp_replace(text, "[^a-z ]", ""))


def glued_key(name: Column) -> Column:
    """Letters and digits glued together, accents folded, suffixes (also V) dropped."""
    text = F.lower(fold_accents(F.coalesce(name, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(text, r"\b(jr|sr|ii|iii|iv|v)\b\.?", ""), "[^a-z0-9]", "")


def review_key(name: Column) -> Column:
    """Words of letters: points, quotes and hyphens close up, suffixes (also V) dropped."""
    text = F.regexp_replace(F.lower(fold_accents(F.coalesce(name, F.lit("")))), r"[.'`\-]", "")
    text = F.regexp_replace(text, r"\b(jr|sr|ii|iii|iv|v)\b", "")
    return squeeze(F.regexp_replace(text, "[^a-z ]", ""))


def roster_key(name: Column) -> Column:
    """Words with accents folded, points and apostrophes closed up, hyphens as spaces, suffixes dropped."""
    text = F.regexp_replace(F.lower(fold_accents(F.coalesce(name, F.lit("")))), r"[.'’]", "")
    return squeeze(F.regexp_replace(F.regexp_replace(text, "[-–]", " "), r"\b(jr|sr|ii|iii|iv)\b", ""))


def hyphen_head(name: Column) -> Column:
    """The name with only the first half of a hyphenated last word; null for other names."""
    words = F.split(squeeze(name), " ")
    last = F.element_at(words, -1)
    head = F.array_append(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), F.element_at(F.split(last, "-"), 1))
    return F.when((F.size(words) >= 2) & last.contains("-"), F.array_join(head, " "))


def title_case(c: Column) -> Column:
    """Upper case for every letter that follows no letter, lower case for the others."""
    letters = F.split(c, "")
    after_letter = lambda i: F.coalesce(F.get(letters, i - 1).rlike(r"\p{L}"), F.lit(False))
    return F.array_join(F.transform(letters, lambda x, i: F.when((i > 0) & after_letter(i), F.lower(x)).otherwise(F.upper(x))), "")


def display_name(name: Column, romans: Sequence[str] = ("IV", "VI")) -> Column:
    """Title case with pointed initials (AJ gives A.J.), pointed Jr. and Sr., and capital numerals.

    Two different capitals are initials unless they are one of ``romans``.
    """
    keep = "".join(rf"(?!{r}\b)" for r in romans)
    text = F.regexp_replace(F.trim(name), rf"\b{keep}([A-Z])(?!\1)([A-Z])\b", "$1.$2.")
    text = F.regexp_replace(F.regexp_replace(title_case(text), r"\b(Jr|Sr)\.", "$1"), r"\b(Jr|Sr)\b", "$1.")
    for written, numeral in (("Ii", "II"), ("Iii", "III"), ("Iv", "IV"), ("Vi", "VI")):
        text = F.regexp_replace(text, rf"\b{written}\b", numeral)
    return text


def listed_name(raw: Column) -> Column:
    """"Last, First 23/1" as "First Last": a trailing word with digits or a slash is dropped, a comma flips the parts."""
    text = F.trim(F.regexp_replace(raw, r"\s+\S*[\d/]\S*$", ""))
    parts = F.split(text, ",", 2)
    flipped = F.when(F.size(parts) == 2, F.concat(F.trim(F.get(parts, F.lit(1))), F.lit(" "), F.trim(F.get(parts, F.lit(0))))).otherwise(text)
    return F.array_join(F.transform(F.split(squeeze(flipped), " "), _cased_word), " ")


def _cased_word(word: Column) -> Column:
    upper = F.upper(word)
    plain = F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))
    cased = F.when(upper.isin("II", "III", "IV", "V", "DJ", "AJ", "CJ", "TJ", "OJ", "BJ"), upper)
    return cased.when(upper.isin("JR", "SR", "JR.", "SR."), plain).otherwise(plain)


def initial_last(name: Column) -> Column:
    """Struct of first initial and last-name key, null for fewer than two words besides suffixes."""
    words = F.filter(F.split(squeeze(display_name(name)), " "), lambda t: ~F.regexp_replace(F.lower(t), r"\.", "").isin("jr", "sr", "ii", "iii", "iv", "v"))
    return F.when(
        F.size(words) >= 2,
        F.struct(F.lower(F.substring(F.get(words, F.lit(0)), 1, 1)).alias("initial"), match_key(F.element_at(words, -1)).alias("last")),
    )


def token_set(name: Column, accents: bool = True) -> Column:
    """Sorted distinct word keys of a name."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(squeeze(F.coalesce(name, F.lit(""))), " "), lambda t: match_key(t, accents)), lambda t: t != "")))


def is_token_subset(a: Column, b: Column) -> Column:
    """Whether every word of ``a`` is one of ``b``; false for an empty ``a``."""
    return (F.size(a) > 0) & (F.size(F.array_except(a, b)) == 0)


def school_key(school: Column, aliases: Mapping[str, str]) -> Column:
    """Letters and digits of a school, after its alias."""
    text = F.lower(F.trim(F.coalesce(school, F.lit(""))))
    return F.regexp_replace(mapped(text, aliases, default=text), "[^a-z0-9]", "")


def slug(c: Column) -> Column:
    """Lower-case words joined by hyphens; apostrophes close up."""
    text = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "'", "")
    return F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def last_segment(c: Column, fixes: Mapping[str, str], longest: int = 3) -> Column:
    """Last part of an "A/B" code, after its fix; null for a part that is neither fixed nor short."""
    part = F.trim(F.element_at(F.split(F.coalesce(c, F.lit("")), "/"), -1))
    return F.coalesce(mapped(part, fixes), F.when(F.length(part) <= longest, part))


def split_first_space(c: Column) -> Column:
    """Struct of the first word and the rest ('' if there is none)."""
    return F.struct(F.substring_index(c, " ", 1).alias("head"), F.when(c.contains(" "), F.regexp_replace(c, r"^[^ ]* ", "")).otherwise("").alias("rest"))


def mapped(c: Column, table: Mapping[str, str | None], default: Column | None = None) -> Column:
    """Value of a literal table; ``default`` (null if not given) for a missing key. A null value of the table stays null."""
    if not table:
        return default if default is not None else F.lit(None).cast("string")
    found = None
    for key, value in table.items():
        found = F.when(c == key, F.lit(value)) if found is None else found.when(c == key, F.lit(value))
    return found.otherwise(default if default is not None else F.lit(None).cast("string"))


def join_or_null(items: Column, separator: str) -> Column:
    """Items joined by a separator, null for none."""
    return F.when(F.size(items) > 0, F.array_join(items, separator))


def record_text(wins: Column, losses: Column, ties: Column) -> Column:
    """W-L, or W-L-T if there are ties."""
    parts = F.array(*[x.cast("string") for x in (wins, losses, ties)])
    return F.when(ties > 0, F.array_join(parts, "-")).otherwise(F.array_join(F.slice(parts, 1, 2), "-"))


def dollars(amount: Column) -> Column:
    """Whole dollars with thousands separators; null stays null."""
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def html_escaped(c: Column) -> Column:
    """Text safe inside HTML."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def https_only(url: Column) -> Column:
    """The address if it is https, else null."""
    return F.when(url.rlike("^https://"), url)


def salary_text(total: Column, years: Column) -> Column:
    """"$12.5M / 3yr" of a total in dollars and its years; null if either is null or zero."""
    known = (F.coalesce(total, F.lit(0)) != 0) & (F.coalesce(years, F.lit(0)) != 0)
    return F.when(known, F.concat(F.lit("$"), F.format_number(F.bround(total / 1_000_000, 1), 1), F.lit("M / "), years.cast("string"), F.lit("yr")))
