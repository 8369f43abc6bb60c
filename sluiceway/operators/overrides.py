"""Corrections by hand: names replaced, names blocked, flags and first authors set for single DOIs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Replacements = list[tuple[str, str]]


def _one(c: Column, replacements: Replacements) -> Column:
    """One after the other, so a replacement may be replaced again."""
    done: list[tuple[str, str]] = []
    for old, _ in dict(replacements).items():
        value = old
        for a, b in replacements:
            value = b if value == a else value
        done.append((old, value))
    # a name that is only reached by a replacement keeps the rest of the chain
    return reduce(lambda rest, pair: F.when(c == pair[0], pair[1]).otherwise(rest), reversed(done), c)


def replace_names(names: Column, replacements: Replacements) -> Column:
    """Exact replacements in an array of names; its order and length stay."""
    return F.transform(names, lambda n: _one(n, replacements))


def replace_pair_names(pairs: Column, replacements: Replacements) -> Column:
    """The same on the ``author`` of author-affiliation pairs."""
    return F.transform(pairs, lambda p: p.withField("author", _one(p["author"], replacements)))


def block_pairs(pairs: Column, blocked: list[str], field: str = "canonical_affiliation") -> Column:
    """Pairs whose affiliation isn't blocked; null stays."""
    return F.filter(pairs, lambda p: p[field].isNull() | ~p[field].isin(blocked)) if blocked else pairs


def block_values(values: Column, blocked: list[str]) -> Column:
    """Values that aren't blocked; repeated ones and null stay."""
    return F.filter(values, lambda v: v.isNull() | ~v.isin(blocked)) if blocked else values


def override_flags(works: DataFrame, overrides: list[tuple[str, list[str], bool]], key: str = "doi") -> DataFrame:
    """Sets flags for all rows of a DOI: (doi, flags, value). The last override of a flag wins; flags the table doesn't have are left out."""
    last: dict[str, dict[str, bool]] = {}
    for doi, flags, value in overrides:
        for f in flags:
            if f in works.columns:
                last.setdefault(f, {})[doi] = value
    pick = lambda f, by: reduce(lambda rest, v: F.when(F.col(key).isin([d for d, x in by.items() if x == v]), v).otherwise(rest), (True, False), F.col(f))
    return works.withColumns({f: pick(f, by) for f, by in last.items()}) if last else works
