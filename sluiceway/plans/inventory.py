"""The engine's entry points: finding works, harmonising their metadata, publishing the inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions import citation, text
from sluiceway.functions.abstracts import clean_jats, strip_prefixes
from sluiceway.functions.doi import clean_doi
from sluiceway.operators import authors as A
from sluiceway.operators import fuzzy, harmonize, predicates

#: Columns of the inventory whose text is brought to ASCII; abstracts keep theirs.
PLAIN = ("title", "journal", "publisher", "authors", "affiliations", "citation")


def crossref_branch(works: DataFrame, pattern: str, registry: DataFrame | None = None, since: int | None = None, compat: bool = False) -> DataFrame:
    """Crossref works with clean DOI, text abstract, normalised authors and flags, in the harmonised columns."""
    out = works.withColumn("doi", clean_doi(F.col("doi"))).filter("doi is not null")
    out = predicates.detect_authorship(out, pattern, "crossref", flag="dwr_author", roles=("any", "lead", "sole"))
    out = predicates.detect_funding(out, pattern, "crossref", flag="dwr_funding_other")
    pairs = A.crossref_pairs(F.col("author"), compat)
    out = out.select(
        "cr_id", "doi", text.clean_title(F.col("title")).alias("title"), clean_jats(F.col("abstract")).alias("abstract"), F.col("container_title").alias("journal"),
        F.substring(F.coalesce("published_online", "created"), 1, 4).try_cast("int").alias("publication_year"), F.col("url").alias("landing_page_url"),
        F.col("is_referenced_by_count").try_cast("int").alias("cited_by_count"), "volume", "publisher", A.crossref_author_names(F.col("author")).alias("authors"),
        A.pair_affiliations(pairs).alias("unique_affiliations"), pairs.alias("pairs"), "dwr_author", "dwr_lead_author", "dwr_sole_author", "dwr_funding_other",
    )
    return _registered(out, registry, since)


def openalex_branch(works: DataFrame, pattern: str, registry: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """OpenAlex works likewise."""
    out = works.withColumn("doi", clean_doi(F.col("doi"))).filter("doi is not null")
    out = predicates.detect_authorship(out, pattern, "openalex", flag="dwr_author", roles=("any", "lead", "sole"))
    out = predicates.detect_funding(out, pattern, "openalex", flag="dwr_funding_other")
    out = out.select(
        "oa_id", "doi", text.clean_title(F.col("title")).alias("title"), strip_prefixes(F.col("abstract")).alias("abstract"), F.col("source_display_name").alias("journal"), "publication_year",
        "is_oa", "is_oa_anywhere", "oa_status", "landing_page_url", "pdf_url", "license", "cited_by_count", "first_page", "last_page", "volume", "issue", "publisher",
        A.openalex_author_names(F.col("authorships")).alias("authors"), A.openalex_affiliations(F.col("authorships")).alias("unique_affiliations"), "authorships",
        "dwr_author", "dwr_lead_author", "dwr_sole_author", "dwr_funding_other",
    )
    return _registered(out, registry, since)


def _registered(works: DataFrame, registry: DataFrame | None, since: int | None) -> DataFrame:
    out = works if since is None else harmonize.since(works, since)
    return out if registry is None else out.join(registry, "doi", "left")


def published(records: DataFrame, classification: DataFrame | None = None, roster: DataFrame | None = None, pattern: str | None = None, key: str = "record_id") -> DataFrame:
    """The inventory: scalar columns only, with citation, contribution and, given a roster, the division of the first affiliated author."""
    out = records
    if roster is not None and pattern is not None:
        out = fuzzy.annotate_divisions(out, roster, pattern, "dwr_author")
    if classification is not None:
        out = out.join(classification, key, "left")
    out = out.withColumns({
        "citation": citation.harvard(F.col("authors"), F.col("publication_year"), F.col("title"), F.col("journal"), F.col("volume"), F.col("issue"), F.col("first_page"), F.col("last_page"), F.col("doi")),
        "contribution": citation.contribution(F.col("dwr_sole_author"), F.col("dwr_lead_author"), F.col("dwr_author"), F.col("dwr_funding_other")),
        "affiliations": text.collapse_unique(F.transform("author_affiliations", lambda p: p["canonical_affiliation"])),
    }).withColumn("authors", text.collapse_unique(F.col("authors")))
    out = out.withColumns({c: text.latin_ascii(F.col(c)) for c in PLAIN})
    first = [key, "doi", "title", "authors", "affiliations", "journal", "publication_year", "contribution", "citation"]
    extra = [c for c in ("second_level", "first_level", "confidence", "first_affiliated_author", "first_affiliated_author_position", "first_affiliated_author_division") if c in out.columns]
    rest = ["abstract", "is_oa", "is_oa_anywhere", "oa_status", "landing_page_url", "pdf_url", "license", "cited_by_count", "first_page", "last_page", "volume", "issue", "publisher", "doi_source", *harmonize.FLAGS]
    return out.select(*first, *extra, *rest)
