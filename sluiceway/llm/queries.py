"""Queries of the subpackage's operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import canonical, format_duplicates, fusion, linking, mixing, packing, repetition, subjects, tokens, variants
from sluiceway.session import cut, table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "dois_manual").select(F.lit("dois_manual").alias("table_name"), F.col("line_id").alias("id"), F.col("doi").alias("value"))
    records = table(spark, d, "all_metadata").select(F.lit("all_metadata").alias("table_name"), F.col("record_id").alias("id"), F.col("doi").alias("value"))
    return format_duplicates.copies(lines.unionByName(records), within="table_name").select("table_name", "first_id", "copy_id")

#: The employer whose roster `employees` is.
AGENCY = "Halvern Department of Water Stewardship"


def typed_names(spark: SparkSession, d: str) -> DataFrame:
    """Every string in the three fields of problem 1, as ``name``."""
    authors = table(spark, d, "all_metadata").select(F.explode("authors").alias("name"))
    roster = table(spark, d, "employees")
    return authors.unionByName(roster.select(F.col("employee_name").alias("name"))).unionByName(roster.select(F.col("employee_alternate_name").alias("name")))


def p1_clusters(spark: SparkSession, d: str) -> DataFrame:
    return variants.clusters(typed_names(spark, d))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.variants(p1_clusters(spark, d)).select("name_a", "name_b")


def p2_mapping(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonicalized(table(spark, d, "all_metadata"), table(spark, d, "institutions"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_mapping(spark, d).select("record_id", "field", "pos", F.col("entry").cast("int").alias("institution_id"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return canonical.unmatched(p2_mapping(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return fusion.best(table(spark, d, "all_metadata"))


def p3_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each group, built from the best values."""
    built = fusion.survivors(table(spark, d, "all_metadata"))
    return built.withColumn("authors_crossref", F.array_join("authors_crossref", "; "))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.unlabelled(table(spark, d, "all_metadata"), table(spark, d, "discipline_labels"), most=2).select("record_id", "second_level")


def p5_composition(spark: SparkSession, d: str) -> DataFrame:
    areas = subjects.assigned(table(spark, d, "all_metadata"), table(spark, d, "discipline_labels"))
    return subjects.composition(areas, table(spark, d, "disciplines_taxonomy"))


def p6_linked(spark: SparkSession, d: str) -> DataFrame:
    return linking.linked(table(spark, d, "all_metadata"), table(spark, d, "employees"), AGENCY)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_linked(spark, d).select("roster_id", "record_id")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(table(spark, d, "documents"), table(spark, d, "container_sizes"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(p8_packed(spark, d), table(spark, d, "container_sizes"))


def p8_checked(spark: SparkSession, d: str) -> DataFrame:
    """For each kind of container: documents packed, containers that hold more than they may, documents with tokens missing or twice, documents split without need or unevenly."""
    kinds, docs = table(spark, d, "container_sizes"), table(spark, d, "documents")
    bins = cut(p8_packed(spark, d)).join(F.broadcast(kinds.select("container", "capacity_tokens").distinct()), "container")
    full = bins.groupBy("container", "capacity_tokens", "shard", "bin").agg(F.sum("tokens").alias("held")).groupBy("container", "capacity_tokens").agg(F.sum(F.when(F.col("held") > F.col("capacity_tokens"), 1).otherwise(0)).alias("overfull"))
    whole = docs.select(F.col("doc_id").alias("doc"), tokens.token_count(F.col("text")).alias("n"))
    each = bins.groupBy("container", "capacity_tokens", "doc").agg(F.sum("tokens").alias("held"), F.count("*").alias("parts"), F.sum(F.when(F.col("first_token") == F.col("part") * F.col("capacity_tokens"), 0).otherwise(1)).alias("shifted")).join(whole, "doc")
    wrong = (F.col("held") != F.col("n")) | (F.col("shifted") > 0)
    split = F.col("parts") != F.greatest(F.lit(1), F.ceil(F.col("n") / F.col("capacity_tokens")))
    each = each.groupBy("container").agg(F.count("*").alias("documents"), F.sum(wrong.cast("int")).alias("not_whole"), F.sum(split.cast("int")).alias("split_without_need"))
    return full.join(each, "container").select("container", "capacity_tokens", "documents", "overfull", "not_whole", "split_without_need")


def p9_checked(spark: SparkSession, d: str) -> DataFrame:
    """For each source: slots used too often, blocks whose tokens overlap or are more than a block, whether the share reached is within 0.01 of what caps and targets allow."""
    docs, targets = table(spark, d, "documents"), table(spark, d, "mix_targets")
    got = cut(mixing.mixed(docs, targets, whole=True)).join(F.broadcast(targets), "source")
    often = got.groupBy("source", "doc", "first_token").agg(F.count("*").alias("n"), F.first("max_repeats").alias("most")).groupBy("source").agg(F.sum(F.when(F.col("n") > F.col("most"), 1).otherwise(0)).alias("too_often"))
    blocks = got.groupBy("source", "slot").agg(F.sum("tokens").alias("n")).groupBy("source").agg(F.sum(F.when(F.col("n") > mixing.BLOCK, 1).otherwise(0)).alias("too_long"))
    shares = mixing.reported(docs, targets, whole=True)
    short = (F.col("tokens") >= F.col("available") * F.col("max_repeats") * 0.99) & (F.col("share") <= F.col("target_share") + 0.01)
    reached = shares.select("source", "target_share", "max_repeats", (short | (F.col("share") >= F.col("target_share") - 0.01)).alias("as_far_as_it_goes"))
    return reached.join(often, "source").join(blocks, "source")


def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"), whole=True)


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.reported(table(spark, d, "documents"), table(spark, d, "mix_targets"), whole=True)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(table(spark, d, "documents")).select("doc_id")


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(table(spark, d, "documents"))


QUERIES = {
    "p1_found": p1_found, "p1_clusters": p1_clusters,
    "p2_found": p2_found, "p2_report": p2_report,
    "p3_found": p3_found, "p3_survivors": p3_survivors, "p4_found": p4_found, "p5_found": p5_found, "p5_composition": p5_composition,
    "p6_found": p6_found, "p6_linked": p6_linked,
    "p8_packed": p8_packed, "p8_report": p8_report, "p8_checked": p8_checked,
    "p9_mixed": p9_mixed, "p9_shares": p9_shares, "p9_checked": p9_checked, "p10_found": p10_found, "p10_shares": p10_shares,
}

def _cores(name: str, key: str) -> str:
    """The core of each DOI of a table, in SQL."""
    plain = "url_decode(url_decode(replace(replace(doi, '+', '%2B'), '%25', '%')))"
    plain = rf"regexp_replace({plain}, '[\p{{Cf}}\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]+', '', 'g')"
    plain = rf"regexp_replace({plain}, '[\s\p{{Z}}]*([./_()\p{{Pd}}])[\s\p{{Z}}]*', '\1', 'g')"
    found = rf"""regexp_extract({plain}, '(?:^|[^0-9.])10\.([0-9]{{4,9}})/+([^\s\p{{Z}}&;,"''“”‘’<>\[\]{{}}|?#=]+)', ['a', 'b'])"""
    return rf"""select '{name}' as table_name, {key} as id, f.a || '/' || regexp_replace(lower(f.b), '[^\p{{L}}\p{{N}}]+', '', 'g') as core from (select {key}, {found} as f from {name} where doi is not null) where regexp_replace(f.b, '[^\p{{L}}\p{{N}}]+', '', 'g') <> ''"""


ORACLES = {
    "p8_checked": "select container, capacity_tokens, (select count(*) from documents) as documents, cast(0 as bigint) as overfull, cast(0 as bigint) as not_whole, cast(0 as bigint) as split_without_need from container_sizes where capacity_tokens > 0",
    "p9_checked": "select source, target_share, max_repeats, true as as_far_as_it_goes, cast(0 as bigint) as too_often, cast(0 as bigint) as too_long from mix_targets where target_share > 0 and source in (select source from documents)",
    "p4_found": f"""with c as ({_cores("dois_manual", "line_id")} union all {_cores("all_metadata", "record_id")}), g as (select *, min(id) over (partition by table_name, core) as first_id from c)
    select table_name, first_id, id as copy_id from g where id <> first_id""",
}
