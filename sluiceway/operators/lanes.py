"""Values judged by an outside model: batches, retries, fallbacks and parsing, around an injected client.

A client is made inside the worker by a factory and takes a list of prompts to a list of answers
(text). No client is built in; without one, cached answers are joined instead. A batch that fails is
tried again with fewer prompts at once and longer waits, then prompt by prompt; a prompt that fails
to the end gives a null answer and its error, never a failed task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions import institutions
from sluiceway.functions.text import nonblank, squish
from sluiceway.session import cut

Client = Callable[[list[str]], list[str]]


@dataclass(frozen=True)
class Limits:
    """``active`` prompts at once, ``rpm`` of them a minute in each partition, ``retries``, and seconds to wait after the k-th failure, times k."""

    active: int = 5
    rpm: int = 60
    retries: int = 2
    backoff: float = 2.0

    def after(self, attempt: int) -> Limits:
        return Limits(max(1, self.active // (attempt + 1)), max(10, int(self.rpm * 0.7**attempt)), self.retries, self.backoff)


def answered(prompts: list[str], client: Client, limits: Limits, sleep: Callable[[float], None] = time.sleep) -> list[tuple[str | None, str | None]]:
    """(answer, error) for each prompt."""
    for attempt in range(limits.retries + 1):
        now, out = limits.after(attempt) if attempt else limits, []
        try:
            for i in range(0, len(prompts), now.active):
                part = prompts[i : i + now.active]
                got = client(part)
                if len(got) != len(part):
                    raise ValueError(f"{len(got)} answers to {len(part)} prompts")
                out += [(a, None) for a in got]
                if i + now.active < len(prompts):
                    sleep(60 * len(part) / now.rpm)
            return out
        except Exception:  # noqa: BLE001 - whatever the client raises
            if attempt < limits.retries:
                sleep(limits.backoff * (attempt + 1))
    out = []
    for p in prompts:
        try:
            out.append((client([p])[0], None))
        except Exception as e:  # noqa: BLE001
            out.append((None, str(e)))
    return out


def asked(prompts: DataFrame, factory: Callable[[], Client], limits: Limits = Limits(), batch: int = 250, partitions: int = 8) -> DataFrame:
    """Adds ``answer`` and ``error`` to ``key, prompt``. The partitions bound how many clients run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in batches:
            got = [x for i in range(0, len(pdf), batch) for x in answered(list(pdf["prompt"].iloc[i : i + batch]), client, limits)]
            yield pdf.assign(answer=[a for a, _ in got], error=[e for _, e in got])

    return prompts.select("key", "prompt").repartition(partitions, "key").mapInPandas(run, f"key {dict(prompts.dtypes)['key']}, prompt string, answer string, error string")


def lines(*parts) -> Column:
    return F.concat_ws("\n", *parts)


def affiliation_prompt(value: Column) -> Column:
    """The prompt for one affiliation."""
    return lines(F.lit("Give the institution this affiliation names, in its official English form."), F.lit("Leave out departments, addresses and countries. Answer [NA] if it names none."), F.lit('Answer as JSON: {"canonical_institution": "..."}'), F.concat(F.lit("Affiliation: "), value))


def identifier(value: Column) -> Column:
    """The id of a value in prompts: sixteen digits of its MD5 digest, the same on every engine."""
    return F.concat(F.lit("a"), F.substring(F.md5(value), 1, 16))


def group_prompts(values: DataFrame, size: int = 10) -> DataFrame:
    """``key, prompt, ids``: prompts for groups of ``original`` values, each with an id; groups are by hash, about ``size`` each."""
    n = max(1, -(-values.count() // size))
    group = F.pmod(F.conv(F.substring(F.md5("original"), 25, 8), 16, 10).cast("bigint"), F.lit(n))
    each = values.select(group.alias("key"), identifier(F.col("original")).alias("id"), "original")
    entry = F.transform(F.array_sort(F.collect_list(F.struct("id", "original"))), lambda x: F.concat(x["id"], F.lit(": "), x["original"]))
    head = "For each line give the institution it names, in its official English form, or [NA]. Answer as a JSON array of {id, canonical_institution}."
    return each.groupBy("key").agg(lines(F.lit(head), F.array_join(entry, "\n")).alias("prompt"), F.sort_array(F.collect_list("id")).alias("ids"))


def group_answers(answers: DataFrame) -> DataFrame:
    """``id, canonical`` from JSON arrays or single objects; the id may be called identifier, the name canonical or institution."""
    entry = "struct<id:string,identifier:string,canonical_institution:string,canonical:string,institution:string>"
    many = F.coalesce(F.from_json("answer", f"array<{entry}>"), F.array(F.from_json("answer", entry)))
    x = answers.select(F.explode(many).alias("x")).filter("x is not null")
    return x.select(F.coalesce("x.id", "x.identifier").alias("id"), institutions.cleaned(F.coalesce("x.canonical_institution", "x.canonical", "x.institution")).alias("canonical")).filter("id is not null")


def single_answer(answer: Column) -> Column:
    """The name in an answer to one prompt: of the JSON field, or of text after an optional "key:"."""
    return F.coalesce(F.get_json_object(answer, "$.canonical_institution"), F.regexp_replace(answer, r"^[A-Za-z_ ]+[:=]\s*", ""), F.lit(""))


def resolved(values: DataFrame, answers: DataFrame, **agency) -> DataFrame:
    """``original, canonical``: the lookup made of ``original`` values and ``id, canonical`` answers.

    An empty answer falls back on a guess from the value; an omitted one stays null. Overrides and
    both passes of the rewriting follow.
    """
    each = values.select("original", identifier(F.col("original")).alias("id")).join(answers, "id", "left")
    raw = F.when(F.col("canonical") == "", institutions.fallback(F.col("original"))).otherwise(F.col("canonical"))
    staged = each.select("original", institutions.overridden(F.col("original"), raw).alias("raw"))
    return staged.select("original", institutions.output_form(institutions.finalized(F.col("raw"), **agency)).alias("canonical"))


def offline_lookup(values: DataFrame, cached: DataFrame | None = None, **agency) -> DataFrame:
    """The lookup without a model: cached proposals (``original, canonical``) where there are some, else the guess."""
    each = values.select("original") if cached is None else values.select("original").join(cached.select("original", F.col("canonical").alias("proposed")), "original", "left")
    raw = institutions.fallback(F.col("original")) if cached is None else F.coalesce("proposed", institutions.fallback(F.col("original")))
    staged = each.select("original", institutions.overridden(F.col("original"), raw).alias("raw"))
    return staged.select("original", institutions.output_form(institutions.finalized(F.col("raw"), **agency)).alias("canonical"))


def canonicalized(values: DataFrame, factory: Callable[[], Client], limits: Limits = Limits(10, 200, 2, 2.0), size: int = 10, **agency) -> DataFrame:
    """``original, canonical``: the lookup of distinct affiliations, asked in groups, and one by one where a group's answer is empty or lacks them; see ``resolved`` for what follows."""
    prompts = group_prompts(values, size).select("key", "prompt")
    answers = cut(group_answers(asked(prompts, factory, limits)))
    each = values.select(F.col("original"), identifier(F.col("original")).alias("id"))
    left = each.join(answers.filter("canonical is null or canonical <> ''"), "id", "left_anti")  # null: it names none
    again = asked(left.select(F.col("id").alias("key"), affiliation_prompt(F.col("original")).alias("prompt")), factory, limits)
    again = again.select(F.col("key").alias("id"), institutions.cleaned(single_answer(F.col("answer"))).alias("canonical"))
    return resolved(values, answers.join(again.select("id"), "id", "left_anti").unionByName(again), **agency)


# Subject areas of articles


def taxonomy(rows: DataFrame) -> DataFrame:
    """``first_level, second_level, description`` in order of the second; checked, trimmed, null as empty."""
    columns = ("first_level", "second_level", "description")
    if missing := set(columns) - set(rows.columns):
        raise ValueError(f"the taxonomy lacks {sorted(missing)}")
    return rows.select(*(F.coalesce(F.trim(c), F.lit("")).alias(c) for c in columns)).orderBy("second_level")


def articles(rows: DataFrame) -> DataFrame:
    """``doi, title, abstract``; a null title is empty."""
    if missing := {"doi", "title", "abstract"} - set(rows.columns):
        raise ValueError(f"the articles lack {sorted(missing)}")
    return rows.select("doi", F.coalesce("title", F.lit("")).alias("title"), "abstract")


def taxonomy_prompt(rows: DataFrame) -> str:
    """One line for each area; the taxonomy is a fixed short list."""
    return "\n".join(f"- {r.second_level}: {r.description}" for r in taxonomy(rows).collect())


def article_prompt(title: Column, abstract: Column, areas: str) -> Column:
    say = lambda label, c: F.concat(F.lit(label + ": "), F.coalesce(nonblank(c), F.lit("[Missing]")))
    return lines(F.lit("Choose the one area below that fits the article best. Answer as JSON: {second_level, confidence, note}."), F.lit(areas), say("Title", title), say("Abstract", abstract))


def clamped(c: Column) -> Column:
    """Between 0 and 1; null stays null."""
    return F.when(c.isNull(), None).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def note(c: Column) -> Column:
    return F.nullif(squish(c), F.lit(""))


def classified(answers: DataFrame, areas: DataFrame, key: str = "doi", raw: bool = False) -> DataFrame:
    """``key, second_level, first_level, confidence, note`` of JSON answers; unknown areas and unreadable answers are null."""
    x = answers.withColumn("x", F.from_json("answer", "second_level string, confidence string, note string"))
    known = F.broadcast(taxonomy(areas).select(F.col("second_level").alias("_area"), "first_level"))  # a fixed short list
    out = x.join(known, F.col("x.second_level") == F.col("_area"), "left")
    return out.select(F.col(key), F.col("_area").alias("second_level"), "first_level", clamped(F.col("x.confidence").try_cast("double")).alias("confidence"), note(F.col("x.note")).alias("note"), *([F.col("answer").alias("raw_response")] if raw else []))


def classify(rows: DataFrame, areas: DataFrame, factory: Callable[[], Client], limits: Limits = Limits(), key: str = "doi", raw: bool = False) -> DataFrame:
    """Asks for the area of each article (``key, title, abstract``); see ``classified``. A failed prompt gives nulls."""
    prompts = rows.select(F.col(key).alias("key"), article_prompt(F.coalesce("title", F.lit("")), F.col("abstract"), taxonomy_prompt(areas)).alias("prompt"))
    return classified(asked(prompts, factory, limits).withColumnRenamed("key", key), areas, key, raw)
