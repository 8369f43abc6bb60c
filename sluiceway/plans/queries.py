"""Queries of the core's operators over the driver's tables; SQL that gives the same rows is in ``oracles``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions import citation, institutions, text
from sluiceway.functions.abstracts import clean_jats, strip_prefixes
from sluiceway.functions.doi import clean_doi
from sluiceway.operators import authors as A
from sluiceway.operators import fuzzy, harmonize, lanes, overrides, predicates, registry, shredding
from sluiceway.plans import inventory
from sluiceway.plans.oracles import ORACLES  # noqa: F401
from sluiceway.session import table
from sluiceway.sources import fetch, readers

PATTERN = "water stewardship"
FUND = "science fund"
AGENCY = "Halvern Department of Water Stewardship"
ROLES = ("any", "lead", "sole")
RENAMED = [("Deborah Bonipakris Jr.", "Deborah Bonipakris"), ("Deborah Bonipakris", "Deborah A. Bonipakris"), ("Kate Zatélastel", "Katherine Zatélastel")]
OVERRIDDEN = [{"doi": "10.90024/GEQF.2022.73454892", "author": "Deborah Bonipakris", "position": 3, "year": None}, {"doi": "10.90029/SJRB_33630511", "author": "Katherine Zatélastel", "position": 1, "year": 2021}, {"doi": "10.1/NOT.THERE", "author": "Nobody", "position": 1, "year": None}]
BLOCKED = ["Mermot Engineering Consultants", "Stimast Water District"]


def joined(values, by: str = "; "):
    return F.array_join(values, by)


def doi_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dois_manual").select("line_id", clean_doi(F.col("doi")).alias("doi"))


def doi_extract(spark: SparkSession, d: str) -> DataFrame:
    return registry.extract_dois(table(spark, d, "all_metadata"))


def doi_registry(spark: SparkSession, d: str) -> DataFrame:
    return registry.doi_registry({"manual": table(spark, d, "dois_manual"), "crossref": table(spark, d, "crossref_metadata"), "openalex": table(spark, d, "openalex_metadata")})


def doi_blocklist(spark: SparkSession, d: str) -> DataFrame:
    return registry.without(doi_clean(spark, d).filter("doi is not null"), table(spark, d, "crossref_metadata"))


def doi_chunks(spark: SparkSession, d: str) -> DataFrame:
    return registry.chunked(table(spark, d, "dois_manual").select("line_id"), "line_id", 50)


def strategies(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "crossref_metadata")
    found = fetch.run_strategies([
        fetch.Strategy(lambda: works, filter=lambda w: predicates.filter_crossref(w, PATTERN), post=lambda w: w.select("cr_id", F.lit("affiliation").alias("found_by"))),
        fetch.Strategy(lambda: works, filter=lambda w: w.filter(predicates.crossref_funder_matches(F.col("funder"), FUND)), post=lambda w: w.select("cr_id", F.lit("funder").alias("found_by"))),
    ])
    return found


def crossref_roles(spark: SparkSession, d: str) -> DataFrame:
    return predicates.detect_authorship(table(spark, d, "crossref_metadata"), PATTERN, "crossref", flag="dwr_author", roles=ROLES).select("cr_id", "dwr_author", "dwr_lead_author", "dwr_sole_author")


def openalex_roles(spark: SparkSession, d: str) -> DataFrame:
    return predicates.detect_authorship(table(spark, d, "openalex_metadata"), PATTERN, "openalex", flag="flag", roles=ROLES).select("oa_id", "flag", "flag_lead", "flag_sole")


def openalex_filter(spark: SparkSession, d: str) -> DataFrame:
    return predicates.filter_openalex(table(spark, d, "openalex_metadata"), PATTERN).select("oa_id")


def crossref_funding(spark: SparkSession, d: str) -> DataFrame:
    return predicates.detect_funding(table(spark, d, "crossref_metadata"), FUND, "crossref", flag="funded").select("cr_id", "funded")


def openalex_funding(spark: SparkSession, d: str) -> DataFrame:
    return predicates.detect_funding(table(spark, d, "openalex_metadata"), FUND, "openalex", flag="funded").select("oa_id", "funded")


def crossref_authors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crossref_metadata").select("cr_id", F.posexplode(A.crossref_authors(F.col("author"))).alias("pos", "a")).select("cr_id", "pos", "a.author_name", "a.author_affiliation")


def crossref_names(spark: SparkSession, d: str) -> DataFrame:
    pairs = A.crossref_pairs(F.col("author"))
    return table(spark, d, "crossref_metadata").select("cr_id", joined(A.crossref_author_names(F.col("author"))).alias("names"), _pairs(pairs, "affiliation").alias("pairs"), joined(A.pair_affiliations(pairs), "|").alias("affiliations"))


def openalex_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "openalex_metadata").select("oa_id", joined(A.openalex_author_names(F.col("authorships"))).alias("names"), joined(A.openalex_affiliations(F.col("authorships")), "|").alias("affiliations"))


def affiliation_values(spark: SparkSession, d: str) -> DataFrame:
    return A.affiliation_values(table(spark, d, "all_metadata"), "unique_affiliations")


def _lookup(spark: SparkSession, d: str) -> DataFrame:
    """A lookup in which a fifth of the names are missing and every seventh has a second entry that must not count."""
    listed = table(spark, d, "institutions").filter("institution_id % 5 <> 0")
    first = listed.select(F.col("canonical").alias("original"), F.upper("canonical").alias("canonical"), F.col("institution_id").alias("place"))
    later = listed.filter("institution_id % 7 = 0").select(F.col("canonical").alias("original"), F.concat(F.lit("A SECOND "), "canonical").alias("canonical"), (F.col("institution_id") + 100_000).alias("place"))
    return first.unionByName(later)


def _pairs(pairs, value: str) -> Column:
    """Pairs as text."""
    return joined(F.transform(pairs, lambda p: F.concat(F.coalesce(p["author"], F.lit("")), F.lit(" @ "), F.coalesce(p[value], F.lit("")))))


def canonical_affiliations(spark: SparkSession, d: str) -> DataFrame:
    out = A.canonical_affiliations(table(spark, d, "all_metadata"), _lookup(spark, d), "record_id", "unique_affiliations")
    return out.select("record_id", joined("canonical_affiliations").alias("canonical_affiliations"))


def crossref_canonical_pairs(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "crossref_metadata").select("cr_id", A.crossref_pairs(F.col("author")).alias("pairs"))
    out = A.crossref_canonical_pairs(works, _lookup(spark, d), "cr_id", "pairs")
    return out.select("cr_id", F.posexplode("author_affiliations").alias("pos", "p")).select("cr_id", "pos", "p.author", "p.canonical_affiliation")


def openalex_canonical_pairs(spark: SparkSession, d: str) -> DataFrame:
    out = A.openalex_canonical_pairs(table(spark, d, "openalex_metadata"), _lookup(spark, d), "oa_id", "authorships")
    return out.select("oa_id", F.posexplode("author_affiliations").alias("pos", "p")).select("oa_id", "pos", "p.author", "p.canonical_affiliation")


def institution_rules(spark: SparkSession, d: str) -> DataFrame:
    values = affiliation_values(spark, d)
    return values.select("original", institutions.output_form(institutions.finalized(F.col("original"), agency=AGENCY)).alias("canonical"))


def affiliation_lookup(spark: SparkSession, d: str) -> DataFrame:
    return lanes.offline_lookup(affiliation_values(spark, d), agency=AGENCY)


def affiliation_prompts(spark: SparkSession, d: str) -> DataFrame:
    return lanes.group_prompts(affiliation_values(spark, d)).select("key", "prompt", F.size("ids").alias("entries"))


def harmonized(spark: SparkSession, d: str) -> DataFrame:
    first = inventory.openalex_branch(table(spark, d, "openalex_metadata"), PATTERN)
    second = inventory.crossref_branch(table(spark, d, "crossref_metadata"), PATTERN)
    out = harmonize.harmonized(first, second, known=doi_registry(spark, d))
    return out.withColumns({"authors": joined("authors"), "unique_affiliations": joined("unique_affiliations", "|")})


def openalex_strategies(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "openalex_metadata")
    return fetch.run_strategies([
        fetch.Strategy(lambda: works, filter=lambda w: predicates.filter_openalex(w, PATTERN), post=lambda w: w.select("oa_id", F.lit("affiliation").alias("found_by"))),
        fetch.Strategy(lambda: works, filter=lambda w: w.filter(predicates.openalex_grant_matches(F.col("grants"), FUND)), post=lambda w: w.select("oa_id", F.lit("grant").alias("found_by"))),
    ])


def recent_works(spark: SparkSession, d: str) -> DataFrame:
    return harmonize.since(table(spark, d, "all_metadata"), 2022).select("record_id", "publication_year")


def default_funding(spark: SparkSession, d: str) -> DataFrame:
    return harmonize.default_flag(table(spark, d, "all_metadata"), "dwr_funding_other", F.col("doi_source") == "manual").select("record_id", "dwr_funding_other")


def flag_override(spark: SparkSession, d: str) -> DataFrame:
    set_ = [("10.90024/GEQF.2022.73454892", ["dwr_author", "nothing"], True), ("10.90029/SJRB_33630511", ["dwr_author", "dwr_lead_author"], False), ("10.90029/SJRB_33630511", ["dwr_author"], True)]
    return overrides.override_flags(table(spark, d, "all_metadata"), set_).select("record_id", "dwr_author", "dwr_lead_author")


def name_replacements(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "all_metadata")
    return records.select("record_id", joined(overrides.replace_names(F.col("authors"), RENAMED)).alias("authors"), joined(F.transform(overrides.replace_pair_names(F.col("author_affiliations"), RENAMED), lambda p: p["author"])).alias("pair_authors"))


def blocked_affiliations(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "all_metadata")
    return records.select("record_id", _pairs(overrides.block_pairs(F.col("author_affiliations"), BLOCKED), "canonical_affiliation").alias("pairs"), joined(overrides.block_values(F.col("canonical_affiliations"), BLOCKED)).alias("kept"))


def abstract_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", strip_prefixes(F.col("text")).alias("abstract"))


def jats_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crossref_metadata").select("cr_id", clean_jats(F.col("abstract")).alias("abstract"))


def clean_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_metadata").select("record_id", text.clean_title(F.col("title")).alias("title"))


def plain_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_metadata").select("record_id", F.posexplode("authors").alias("pos", "a")).select("record_id", "pos", text.latin_ascii(F.col("a")).alias("author"))


def collapsed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_metadata").select("record_id", text.collapse_unique(F.col("authors")).alias("authors"), text.collapse_unique(F.transform("author_affiliations", lambda p: p["canonical_affiliation"])).alias("affiliations"))


def citations(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "all_metadata").select("record_id", citation.harvard(c("authors"), c("publication_year"), c("title"), c("journal"), c("volume"), c("issue"), c("first_page"), c("last_page"), c("doi")).alias("citation"))


def contributions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_metadata").select("record_id", citation.contribution(F.col("dwr_sole_author"), F.col("dwr_lead_author"), F.col("dwr_author"), F.col("dwr_funding_other")).alias("contribution"))


def first_affiliated(spark: SparkSession, d: str) -> DataFrame:
    x = fuzzy.first_affiliated(F.col("authors"), F.col("author_affiliations"), PATTERN)
    return table(spark, d, "all_metadata").select("record_id", x.alias("x")).select("record_id", F.col("x.author").alias("author"), F.col("x.position").cast("int").alias("position"))


def fuzzy_division(spark: SparkSession, d: str) -> DataFrame:
    out = fuzzy.annotate_divisions(table(spark, d, "all_metadata"), table(spark, d, "employees"), PATTERN, "dwr_author")
    return out.select("record_id", "first_affiliated_author", "first_affiliated_author_division")


def first_author_override(spark: SparkSession, d: str) -> DataFrame:
    """Three first authors set by hand, matched by the record's year or by another."""
    works = fuzzy.annotate_divisions(table(spark, d, "all_metadata"), table(spark, d, "employees"), PATTERN, "dwr_author")
    set_ = [(x["doi"], x["author"], x["position"], x["year"]) for x in OVERRIDDEN]
    out = fuzzy.override_first_affiliated(works, table(spark, d, "employees"), set_)
    return out.select("record_id", "first_affiliated_author", "first_affiliated_author_position", "first_affiliated_author_division")


def roster_names(spark: SparkSession, d: str) -> DataFrame:
    return readers.title_cased(table(spark, d, "employees").select("employee_name", "year"), ["employee_name"])


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    return lanes.taxonomy(table(spark, d, "disciplines_taxonomy"))


def label_rollup(spark: SparkSession, d: str) -> DataFrame:
    areas = lanes.taxonomy(table(spark, d, "disciplines_taxonomy")).select("first_level", "second_level")
    return table(spark, d, "discipline_labels").join(F.broadcast(areas), "second_level", "left")  # a fixed short list


def article_prompts(spark: SparkSession, d: str) -> DataFrame:
    areas = lanes.taxonomy_prompt(table(spark, d, "disciplines_taxonomy"))
    return table(spark, d, "all_metadata").select("record_id", lanes.article_prompt(F.col("title"), F.col("abstract"), areas).alias("prompt"))


def answers_parsed(spark: SparkSession, d: str) -> DataFrame:
    share = (F.pmod("record_id", F.lit(7)) - 2) / 4
    said = F.concat(F.lit('{"second_level": "'), "second_level", F.lit('", "confidence": '), share.cast("string"), F.lit(', "note": "  seen   twice "}'))
    broken = F.when(F.pmod("record_id", F.lit(5)) == 0, "no answer").otherwise(said)
    return lanes.classified(table(spark, d, "discipline_labels").select("record_id", broken.alias("answer")), table(spark, d, "disciplines_taxonomy"), "record_id")


def most_cited(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_metadata").select("record_id", "cited_by_count").orderBy(F.desc_nulls_last("cited_by_count"), "record_id").limit(25)


def final_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The published inventory; the area of a record is the first by name of those it was labelled with."""
    areas = label_rollup(spark, d).groupBy("record_id").agg(F.min(F.struct("second_level", "first_level")).alias("x")).select("record_id", "x.second_level", "x.first_level")
    return inventory.published(table(spark, d, "all_metadata"), areas, table(spark, d, "employees"), PATTERN)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    first, second = (shredding.children(table(spark, d, t), t) for t in ("openalex_metadata", "crossref_metadata"))
    return first.unionByName(second)


def p7_tables(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables with the elements' own fields, as text."""
    parts = [shredding.flat_tables(table(spark, d, t), *shredding.BIBLIOGRAPHIC[t]) for t in ("openalex_metadata", "crossref_metadata")]
    pairs = F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return parts[0].unionByName(parts[1]).withColumn("fields", joined(pairs))


QUERIES = {
    f.__name__: f
    for f in (
        p7_found, p7_tables, doi_clean, doi_extract, doi_registry, doi_blocklist, doi_chunks, strategies, crossref_roles, openalex_roles, openalex_filter, crossref_funding, openalex_funding, crossref_authors, crossref_names,
        openalex_names, affiliation_values, canonical_affiliations, crossref_canonical_pairs, openalex_canonical_pairs, institution_rules, affiliation_lookup, affiliation_prompts, harmonized, openalex_strategies, first_author_override, recent_works,
        default_funding, flag_override, name_replacements, blocked_affiliations, abstract_prefixes, jats_text, clean_titles, plain_text, collapsed, citations, contributions, first_affiliated, fuzzy_division,
        roster_names, taxonomy, label_rollup, article_prompts, answers_parsed, most_cited, final_inventory,
    )
}
