"""DOIs as the registry writes them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A DOI ends at white space, quotes, closing brackets, commas and semicolons.
DOI = r"\b10\.\d{4,9}/[^\s\"\)\],;]+"


def clean_doi(c: Column) -> Column:
    """The first DOI in ``c`` in upper case; null if there is none."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), r"^[\"']|[\"']$", "")
    return F.upper(F.regexp_substr(bare, F.lit(DOI)))
