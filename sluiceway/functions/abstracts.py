"""Abstracts: text out of markup, and headings glued to its start."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluiceway.functions import let
from sluiceway.functions.text import trimws

# What a value is dropped for, and what is removed from its start, in this order.
DROPPED = (
    r"(?i)^Author(?:\(s\)|s)?\s*:",
    r"(?i)corresponding\s+author",
    r"^(?:©|\(c\)|&copy;|(?i:copyright))",
    r"^\[.*\]$",
    r"(?i)American\s+Meteorological\s+Society",
    r"(?i)Jim\s+Goodridge",
)
CUT_AFTER = ("20192", "12180-8349", "95819", "33559")
DROPPED_LATER = r"(?i)SFEWS\s+Editors"
HEADINGS = (r"(?i)^Background\s+", r"(?i)^A\s*bstract\s+", r"(?i)^Objective\s+", r"(?i)^Introduction\s+", r"^ABSTRACT\s*", r"(?i)^Abstract\.?\s+")
GLUED = ("Background", "Key Takeaways", "Context", "Objective", "Motivation", "Motivations")
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def strip_prefixes(c: Column) -> Column:
    """An abstract without heading, address and label at its start; null for notices that aren't abstracts. Null and empty stay."""

    def body(w: Column) -> Column:
        dropped = F.lit(False)
        for pattern in DROPPED:
            dropped = dropped | w.rlike(pattern)
        out = w
        for token in CUT_AFTER:
            out = F.regexp_replace(out, rf"(?s)^.*?{token}", "")
        keep = lambda v: F.when(~v.rlike(DROPPED_LATER), v)
        out = let(out, keep)
        for pattern in HEADINGS:
            out = F.regexp_replace(out, pattern, "")
        for label in GLUED:
            out = F.regexp_replace(F.regexp_replace(out, rf"^{label}(?! )[:;,-]*", ""), rf"^{label}\s+", "")
        return F.when(~dropped, trimws(out))

    start = F.regexp_replace(trimws(c), r"^['\"]+", "")
    return F.when(c.isNull() | (c == ""), c).otherwise(let(start, body))


def text_of_markup(c: Column) -> Column:
    """The text of an XML or HTML fragment: tags dropped, entities decoded."""
    out = F.regexp_replace(c, r"(?s)<!--.*?-->|<[/!?A-Za-z][^<>]*>", "")
    for k, v in ENTITIES.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def clean_jats(c: Column) -> Column:
    """An abstract in markup as plain text without its heading; null for null, empty and dropped ones."""
    text = let(trimws(text_of_markup(c)), lambda t: F.when(t == "", c).otherwise(t))
    text = F.regexp_replace(F.regexp_replace(text, r"^Abstract\.\s*", ""), r"^AbstractS(?!\b)", "S")
    text = F.regexp_replace(text, r"^Abstract(?=[A-Z])", "")
    return F.when(c.isNull() | (c == ""), None).otherwise(strip_prefixes(text))
