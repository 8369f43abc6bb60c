"""Which works an agency wrote or paid for: patterns in nested authors, affiliations and funders.

A matcher takes a nested column and a regular expression and gives a boolean column; filters take
any such function. Patterns are looked for without regard to case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import icontains
from sluiceway.operators.authors import crossref_authors, filled, openalex_author_affiliations

Matcher = Callable[[Column, str], Column]
ROLES = ("any", "lead", "sole")


def _any(values: Column, pattern: str) -> Column:
    return F.coalesce(F.exists(values, lambda v: icontains(v, pattern)), F.lit(False))


def crossref_author_matches(author: Column, pattern: str) -> Column:
    """Whether the pattern stands in any name or affiliation of any author."""
    leaves = lambda a: F.concat(F.array(a["name"], a["literal"], a["given"], a["family"], F.concat_ws(" ", a["given"], a["family"])), filled(a["affiliation"]))
    return F.coalesce(F.exists(author, lambda a: _any(leaves(a), pattern)), F.lit(False))


def normalized_author_matches(authors: Column, pattern: str) -> Column:
    """The same for ``array<struct<author_name, author_affiliation>>``."""
    return F.coalesce(F.exists(authors, lambda a: icontains(a["author_affiliation"], pattern) | icontains(a["author_name"], pattern)), F.lit(False))


def openalex_authorship_matches(authorships: Column, pattern: str) -> Column:
    """Whether the pattern stands in an affiliation, typed or recognised; names don't count."""
    one = lambda a: icontains(a["affiliation_raw"], pattern) | _any(F.transform(filled(a["affiliations"], "array<struct<display_name:string>>"), lambda x: x["display_name"]), pattern)
    return F.coalesce(F.exists(authorships, one), F.lit(False))


def filter_works(works: DataFrame, pattern: str, column: str, matcher: Matcher) -> DataFrame:
    """Works whose nested column the matcher finds the pattern in. A missing column is an error."""
    if column not in works.columns:
        raise ValueError(f"no column {column!r}")
    return works.filter(matcher(F.col(column), pattern))


def filter_crossref(works: DataFrame, pattern: str, column: str = "author", matcher: Matcher = crossref_author_matches) -> DataFrame:
    return filter_works(works, pattern, column, matcher)


def filter_openalex(works: DataFrame, pattern: str, column: str = "authorships", matcher: Matcher = openalex_authorship_matches) -> DataFrame:
    return filter_works(works, pattern, column, matcher)


def flag_names(flag: str | list[str] | dict[str, str], roles: tuple[str, ...]) -> dict[str, str]:
    """The name of each role's flag. From one name: x_author gives x_lead_author, others x_lead."""
    if isinstance(flag, dict):
        if missing := [r for r in roles if r not in flag]:
            raise ValueError(f"no flag for {missing}")
        return {r: flag[r] for r in roles}
    if isinstance(flag, list):
        if len(flag) != 1:
            raise ValueError("several flags must be named by role")
        flag = flag[0]
    own = lambda r: flag if r == "any" else f"{flag.removesuffix('_author')}_{r}_author" if flag.endswith("_author") else f"{flag}_{r}"
    return {r: own(r) for r in roles}


def crossref_roles(author: Column, pattern: str, compat: bool = False) -> dict[str, Column]:
    """any: somewhere; lead: the first author's affiliation; sole: all known affiliations, of which there is one at least."""
    people = crossref_authors(author, compat)
    own = F.filter(F.transform(people, lambda p: p["author_affiliation"]), lambda v: v.isNotNull())
    lead = icontains(F.get(people, F.lit(0))["author_affiliation"], pattern)
    sole = F.coalesce((F.size(own) > 0) & F.forall(own, lambda v: icontains(v, pattern)), F.lit(False))
    return {"any": crossref_author_matches(author, pattern) | lead | sole, "lead": lead, "sole": sole}


def openalex_roles(authorships: Column, pattern: str) -> dict[str, Column]:
    """any: somewhere; lead: an affiliation of the first author; sole: all affiliations of all authors that have some."""
    each = F.transform(authorships, openalex_author_affiliations)
    every = F.flatten(F.filter(each, lambda v: v.isNotNull()))
    lead = _any(F.get(each, F.lit(0)), pattern)
    sole = F.coalesce((F.size(every) > 0) & F.forall(every, lambda v: icontains(v, pattern)), F.lit(False))
    return {"any": openalex_authorship_matches(authorships, pattern) | lead | sole, "lead": lead, "sole": sole}


def detect_authorship(works: DataFrame, pattern: str, source: str, column: str | None = None, flag="has_affiliation_match", roles: tuple[str, ...] = ("any",)) -> DataFrame:
    """Appends a flag for each role. ``source`` is crossref or openalex."""
    if bad := set(roles) - set(ROLES):
        raise ValueError(f"unknown roles {sorted(bad)}")
    column = column or {"crossref": "author", "openalex": "authorships"}[source]
    if column not in works.columns:
        raise ValueError(f"no column {column!r}")
    found = (crossref_roles if source == "crossref" else openalex_roles)(F.col(column), pattern)
    return works.withColumns({name: found[role] for role, name in flag_names(flag, tuple(roles)).items()})


def crossref_funder_matches(funder: Column, pattern: str) -> Column:
    return F.coalesce(F.exists(funder, lambda f: icontains(f["name"], pattern) | icontains(f["award"], pattern)), F.lit(False))


def openalex_grant_matches(grants: Column, pattern: str) -> Column:
    return _any(grants, pattern)


def detect_funding(works: DataFrame, pattern: str, source: str, column: str | None = None, flag: str = "has_funding_match") -> DataFrame:
    """Appends whether a funder or award has the pattern."""
    column = column or {"crossref": "funder", "openalex": "grants"}[source]
    if column not in works.columns:
        raise ValueError(f"no column {column!r}")
    return works.withColumn(flag, (crossref_funder_matches if source == "crossref" else openalex_grant_matches)(F.col(column), pattern))
