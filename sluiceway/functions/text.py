"""Text functions: trimming, spacing, case, transliteration, joining."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluiceway.functions import let


def trimws(c: Column) -> Column:
    """Without spaces, tabs and line ends at both ends."""
    return F.btrim(c, F.lit(" \t\r\n"))


def squish(c: Column) -> Column:
    """Trimmed, with one space for each run of white space, Unicode's included."""
    return trimws(F.regexp_replace(c, r"(?U)\s+", " "))


def nonblank(c: Column) -> Column:
    """``c`` trimmed; null if nothing is left."""
    return F.nullif(trimws(c), F.lit(""))


def icontains(c: Column, pattern: str) -> Column:
    """Whether the regular expression occurs, without regard to case; false for null."""
    return F.coalesce(c.rlike(f"(?iu){pattern}"), F.lit(False))


#: Letters that fall into several, and marks that fall into others.
EXPANSIONS = {"ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "TH", "þ": "th", "…": "...", "ﬁ": "fi", "ﬂ": "fl"}
SINGLE = {"Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "ı": "i", "‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "–": "-", "—": "-", "‐": "-", "‑": "-", "−": "-", "«": "<", "»": ">", " ": " "}


def _plain_letters() -> dict[str, str]:
    """Accented Latin letters and their base letters, by Unicode's decompositions."""
    out = {}
    for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)):
        for c in map(chr, block):
            base = unicodedata.normalize("NFKD", c)[0]
            if base != c and base.isascii():
                out[c] = base
    return {k: v for k, v in out.items() if k not in EXPANSIONS}


LETTERS = _plain_letters() | SINGLE


def latin_ascii(c: Column) -> Column:
    """Latin letters and common marks as ASCII; combining accents are dropped, other scripts stay."""
    for k, v in EXPANSIONS.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return F.regexp_replace(F.translate(c, "".join(LETTERS), "".join(LETTERS.values())), r"\p{Mn}+", "")


def sentence_case(c: Column) -> Column:
    """Lower case but for the first letter and letters after a question or exclamation mark."""
    start = lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))
    parts = F.split(F.lower(c), r"(?<=[?!]\s)")
    return F.array_join(F.transform(parts, start), "")


def title_case(c: Column) -> Column:
    """Each word with a capital, after hyphens too."""
    return F.array_join(F.transform(F.split(c, "-"), F.initcap), "-")


def collapse_unique(values: Column, separator: str = "; ") -> Column:
    """Trimmed, non-blank values in order of first appearance, joined; null if none is left."""
    kept = F.array_distinct(F.filter(F.transform(values, trimws), lambda v: v != ""))
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def shouting(c: Column) -> Column:
    """Whether a text is all capitals and has letters."""
    return (c == F.upper(c)) & c.rlike("[A-Z]")


def clean_title(c: Column) -> Column:
    """Markup of italics, small capitals and subscripts dropped; titles in capitals in sentence case."""
    return let(F.regexp_replace(c, r"(?i)</?(?:i|scp|sub)>", ""), lambda t: F.when(shouting(t), sentence_case(t)).otherwise(t))


def first_value(values: Column) -> Column:
    """The first element of an array as a string, null if there is none."""
    return F.get(values, F.lit(0)).cast("string")


def number(c: Column) -> Column:
    """A double, or null for what isn't a number."""
    return c.try_cast("double")
