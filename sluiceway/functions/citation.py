"""Citations in Harvard style, and how an agency contributed to a work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluiceway.functions import let
from sluiceway.functions.text import trimws

#: Authors that are listed before "et al.".
MOST_AUTHORS = 8


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _dotted(c: Column) -> Column:
    """``c`` and a full stop; empty for null and empty."""
    return let(_text(c), lambda v: F.when(v == "", "").otherwise(F.concat(v, F.lit("."))))


def author(name: Column) -> Column:
    """"Surname, F.M." of a name whose last word is the surname; a single word stays."""
    initial = lambda w: F.substring(F.regexp_replace(w, "[^A-Za-z]", ""), 1, 1)

    def of(words: Column) -> Column:
        first = F.filter(F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), initial), lambda x: x != "")
        return F.when(F.size(words) < 2, F.get(words, F.lit(0))).when(F.size(first) == 0, F.element_at(words, -1)).otherwise(F.concat(F.element_at(words, -1), F.lit(", "), F.array_join(F.transform(first, lambda x: F.concat(x, F.lit("."))), "")))

    return let(F.split(trimws(name), r"\s+"), of)


def joined(names: Column) -> Column:
    """"A", "A and B" or "A, B, and C"."""

    def of(x: Column) -> Column:
        n = F.size(x)
        most = F.array_join(F.slice(x, 1, F.greatest(n - 1, F.lit(0))), ", ")
        return F.when(n <= 0, "").when(n == 1, F.get(x, F.lit(0))).when(n == 2, F.concat_ws(" and ", x)).otherwise(F.concat(most, F.lit(", and "), F.get(x, n - 1)))

    return let(names, of)


def author_list(authors: Column) -> Column:
    """All authors, or the first MOST_AUTHORS and "et al"; empty without authors."""
    kept = F.array_distinct(F.filter(F.transform(F.coalesce(authors, F.array().cast("array<string>")), trimws), lambda v: v != ""))
    return let(kept, lambda k: F.when(F.size(k) > MOST_AUTHORS, F.concat(joined(F.transform(F.slice(k, 1, MOST_AUTHORS), author)), F.lit(" et al"))).otherwise(joined(F.transform(k, author))))


def authors_part(authors: Column) -> Column:
    return let(author_list(authors), lambda v: F.when((v == "") | F.endswith(v, F.lit(".")), v).otherwise(F.concat(v, F.lit("."))))


def year_part(year: Column) -> Column:
    return F.coalesce(F.concat(F.lit("("), year.cast("string"), F.lit(").")), F.lit(""))


def volume_part(volume: Column, issue: Column) -> Column:
    v, i = _text(volume), _text(issue)
    return F.when(v == "", "").when(i == "", F.concat(v, F.lit("."))).otherwise(F.concat(v, F.lit("("), i, F.lit(").")))


def pages_part(first: Column, last: Column) -> Column:
    a, b = _text(first), _text(last)
    return F.when(a == "", "").when((b == "") | (a == b), F.concat(a, F.lit("."))).otherwise(F.concat(a, F.lit("-"), b, F.lit(".")))


def doi_part(doi: Column) -> Column:
    d = _text(doi)
    return F.when(d == "", "").otherwise(F.concat(F.lit("doi:"), d, F.lit(".")))


def harvard(authors: Column, year: Column, title: Column, journal: Column, volume: Column, issue: Column, first_page: Column, last_page: Column, doi: Column) -> Column:
    """The parts that are there, with a space between them."""
    parts = F.array(authors_part(authors), year_part(year), _dotted(title), _dotted(journal), volume_part(volume, issue), pages_part(first_page, last_page), doi_part(doi))
    return F.array_join(F.filter(parts, lambda p: p != ""), " ")


def contribution(sole: Column, lead: Column, some: Column, funded: Column) -> Column:
    """"sole authored", "lead authored" or "co-authored", and "funded", of each row by itself."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    role = F.when(yes(sole), "sole authored").when(yes(lead), "lead authored").when(yes(some), "co-authored")
    return F.concat_ws("; ", role, F.when(yes(funded), "funded"))
