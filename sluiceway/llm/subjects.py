"""Problem 5: the subject areas of each document, by weighted terms found with a multi-pattern automaton.

A term counts by its rarity in the whole corpus, more in the title, and little where the text only
sets itself off from it. Sums are normalized by length; the threshold for each area is calibrated
on labelled records, and every area above its own is assigned.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.subject_terms import TERMS
from sluiceway.session import cut

TITLE_WEIGHT, CONTRAST_WEIGHT, LENGTH = 2.0, 0.2, 400
#: Labels from which an area has its own threshold; steps of scores for each doubling that are summed apart.
OWN_LABELS, STEPS = 60, 256
DEFAULT_THRESHOLD, FEW_LABELS = 0.55, 10
#: Words before a term that set the text off from it.
CONTRAST = re.compile(r"(?:unlike|contrary to|in contrast (?:to|with)|as opposed to|rather than|apart from|not about)(?: \w+){0,3} $")
TAG = re.compile(r"</?[a-z][^<>]*>")
SPACE = re.compile(r"[\s­​-‏⁠﻿]+")


def plain(text: str | None) -> str:
    """Lower case, without markup, with single spaces."""
    return SPACE.sub(" ", TAG.sub("", html.unescape(html.unescape(text or "").casefold()))).strip() if text else ""


def automaton(terms: dict[str, str]):
    """An Aho-Corasick automaton of the terms; each carries (area number, term number, length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    number = 0
    for i, area in enumerate(sorted(terms)):
        for term in terms[area].split(";"):
            if term := term.strip().casefold():
                known = found.get(term, ())
                found.add_word(term, (*known, (i, number, len(term))))
                number += 1
    if number:
        found.make_automaton()
    return found if number else None


def hits(found, text: str) -> Iterator[tuple[int, int, bool]]:
    """(area, term, only in contrast) for each whole-word occurrence."""
    if found is None or not text:
        return
    for end, terms in found.iter(text):
        after = text[end + 1 : end + 2]
        if after.isalnum() or after == "-":
            continue
        for area, term, n in terms:
            start = end - n + 1
            before = text[start - 1] if start else " "
            if not (before.isalnum() or before == "-"):
                yield area, term, bool(CONTRAST.search(text[max(0, start - 60) : start]))


def term_hits(records: DataFrame, key: str, title: str, abstract: str, terms: dict[str, str]) -> DataFrame:
    """``key, area, term, weight, words``: what each record says of each term, before rarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = automaton(terms)
        for batch in batches:
            rows = []
            for k, t, a in zip(batch.iloc[:, 0], batch.iloc[:, 1], batch.iloc[:, 2], strict=True):
                t, a = plain(t), plain(a)
                sums: dict[tuple[int, int], float] = {}
                for text, w in ((t, TITLE_WEIGHT), (a, 1.0)):
                    for area, term, contrast in hits(found, text):
                        sums[area, term] = sums.get((area, term), 0.0) + w * (CONTRAST_WEIGHT if contrast else 1.0)
                words = t.count(" ") + a.count(" ") + 2
                rows += [(k, area, term, w, words) for (area, term), w in sums.items()]
            yield pd.DataFrame(rows, columns=["key", "area", "term", "weight", "words"])

    kind = dict(records.dtypes)[key]
    return records.select(key, title, abstract).mapInPandas(run, f"key {kind}, area int, term int, weight double, words int")


def scored(records: DataFrame, key: str = "record_id", title: str = "title", abstract: str = "abstract", terms: dict[str, str] | None = None) -> DataFrame:
    """``key, area, score`` for each record and area with a hit. Rarities come from all records."""
    terms = TERMS if terms is None else terms
    found = cut(term_hits(records, key, title, abstract, terms))
    seen = {r.term: r.n for r in found.groupBy("term").agg(F.count("*").alias("n")).collect()}  # a row for each curated term
    if not seen:
        return found.select("key", F.lit("").alias("area"), F.lit(0.0).alias("score")).limit(0)
    documents = records.count()
    rarity = {t: math.log1p(documents / n) for t, n in seen.items()}
    mean = sum(rarity[t] * n for t, n in seen.items()) / sum(seen.values())
    weights = F.create_map(*(F.lit(x) for t, r in rarity.items() for x in (t, r / mean)))
    names = F.array(*(F.lit(a) for a in sorted(terms)))
    score = F.sum(F.col("weight") * F.try_element_at(weights, "term")) / (1 + F.max("words") / LENGTH)
    return found.groupBy("key", "area").agg(score.alias("score")).select("key", F.get(names, F.col("area")).alias("area"), "score")


def threshold(score: np.ndarray, true: np.ndarray, missed: int) -> float:
    """The threshold of the best F1, in the middle of the gap it lies in. ``missed``: true areas without a hit. ``thresholds`` does the same over a table."""
    order = np.argsort(-score, kind="stable")
    s, t = score[order], true[order]
    f1 = 2 * np.cumsum(t) / (np.arange(1, len(t) + 1) + t.sum() + missed)
    f1[:-1][s[:-1] == s[1:]] = -1
    i = int(f1.argmax())
    return float((s[i] + (s[i + 1] if i + 1 < len(s) else 0.0)) / 2)


def thresholds(pairs: DataFrame, missed: int) -> DataFrame:
    """``part, t, n, trues``: ``threshold`` of each area, and under "" of all, with its pairs and true ones; from ``area, score, true`` of hits.

    Sums run over steps of scores first, then within each, so no task needs all pairs of an area. Only "" counts what is missed.
    """
    step = F.floor(F.log2("score") * STEPS).alias("step")
    each = pairs.select(F.explode(F.array(F.lit(""), "area")).alias("part"), "score", "true").groupBy("part", step, "score").agg(F.count("*").alias("n"), F.count_if("true").alias("t"))
    down, whole = Window.partitionBy("part").orderBy(F.desc("step")), Window.partitionBy("part")
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    steps = each.groupBy("part", "step").agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.max("score").alias("top"))  # bounded by the range of scores
    steps = steps.select("part", "step", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"), F.lead("top").over(down).alias("below"), F.sum("n").over(whole).alias("all"), F.sum("t").over(whole).alias("trues"))
    inside = Window.partitionBy("part", "step").orderBy(F.desc("score"))
    to_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    each = each.select("part", "step", "score", F.sum("n").over(to_here).alias("n"), F.sum("t").over(to_here).alias("t"), F.lead("score").over(inside).alias("next")).join(steps, ["part", "step"])
    f1 = 2 * (F.col("t0") + F.col("t")) / (F.col("n0") + F.col("n") + F.col("trues") + F.when(F.col("part") == "", missed).otherwise(0))
    best = F.max(F.struct(f1.alias("f1"), "score", F.coalesce("next", "below", F.lit(0.0)).alias("next"))).alias("best")
    return each.groupBy("part").agg(best, F.first("all").alias("n"), F.first("trues").alias("trues")).select("part", ((F.col("best.score") + F.col("best.next")) / 2).alias("t"), "n", "trues")


def calibrated(scores: DataFrame, labels: DataFrame, key: str = "record_id", area: str = "second_level") -> dict[str, float]:
    """The threshold of each area, from all labelled records; under "" the one for all."""
    truth = labels.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.trim(area).alias("area")).distinct().withColumn("true", F.lit(True))
    pairs = cut(scores.join(truth.select("key"), "key", "left_semi").join(truth, ["key", "area"], "full").select("area", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("true", F.lit(False)).alias("true")))
    found = {r.part: r for r in thresholds(pairs.filter("score > 0"), pairs.filter("score = 0").count()).collect()}  # a row for each area
    if not found or not found[""].trues:
        return {"": DEFAULT_THRESHOLD}
    n = found[""].trues
    out = {"": (found[""].t * n + DEFAULT_THRESHOLD * FEW_LABELS) / (n + FEW_LABELS)}  # a handful of labels says little
    for a, own in found.items():
        if a and own.trues >= OWN_LABELS:
            out[a] = (own.t * own.n + out[""] * OWN_LABELS) / (own.n + OWN_LABELS)
    return out


def assigned(records: DataFrame, labels: DataFrame, key: str = "record_id", title: str = "title", abstract: str = "abstract", area: str = "second_level", terms: dict[str, str] | None = None, most: int | None = None) -> DataFrame:
    """The areas of every record: ``key, area, score``, every one over its threshold, best first in ``place``; with ``most`` only so many of a record.

    Null and empty texts show no area; texts of any length are read whole; equal records get equal
    areas; ties go to the area first by name; an empty table gives an empty result; without labels a
    default threshold holds; further columns are ignored. A record's scores are one small group.
    """
    scores = cut(scored(records, key, title, abstract, terms))
    limits = calibrated(scores, labels, key, area)
    own = F.create_map(*(F.lit(x) for a, t in limits.items() for x in (a, t)))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "area"))
    over = scores.filter(F.col("score") >= F.coalesce(F.try_element_at(own, "area"), F.lit(limits[""])))
    over = over.withColumn("place", place)
    return (over if most is None else over.filter(F.col("place") <= most)).select(F.col("key").alias(key), F.col("area").alias(area), "score", "place")


def unlabelled(records: DataFrame, labels: DataFrame, key: str = "record_id", **names) -> DataFrame:
    """``assigned`` without the labelled records."""
    return assigned(records, labels, key, **names).join(labels.select(key).distinct(), key, "left_anti")


def composition(areas: DataFrame, taxonomy: DataFrame, area: str = "second_level") -> DataFrame:
    """How many records each area of the taxonomy has: ``first_level, second_level, records, share``, areas without records too."""
    count = areas.groupBy(area).agg(F.count("*").alias("records"))
    out = taxonomy.select(F.trim("first_level").alias("first_level"), area).join(count, area, "left").withColumn("records", F.coalesce("records", F.lit(0)))
    return out.select("first_level", area, "records", F.try_divide("records", F.sum("records").over(Window.partitionBy())).alias("share"))  # a fixed list
