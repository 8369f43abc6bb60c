"""Works from outside: keyed fetches in batches, searches by strategies, look-ups of funders.

What talks to a service is an injected function. A batch that fails gives a row with its error and
no work; the job goes on.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.abstracts import strip_prefixes
from sluiceway.functions.text import icontains
from sluiceway.operators.registry import chunk_list

#: Takes a list of keys or of parameters to works as dictionaries.
Fetch = Callable[[list[str]], list[dict]]


def fetch_works(dois: DataFrame, factory: Callable[[], Fetch], schema: str, chunk: int = 50, pause: float = 0.1, partitions: int = 4) -> DataFrame:
    """Works of the DOIs, ``chunk`` in a request; columns of ``schema`` and ``error``, which is set on one row for each failed request."""
    names = [f.name for f in SparkSession.active().createDataFrame([], schema).schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = factory()
        for pdf in batches:
            for part in chunk_list(list(pdf["doi"]), chunk):
                try:
                    rows = [{n: w.get(n) for n in names} | {"error": None} for w in fetch(part)]
                except Exception as e:  # noqa: BLE001 - whatever the service raises
                    rows = [dict.fromkeys(names) | {"error": f"{type(e).__name__}: {e}"}]
                yield pd.DataFrame(rows, columns=[*names, "error"], dtype=object)
                time.sleep(pause)

    return dois.select("doi").distinct().repartition(partitions, "doi").mapInPandas(run, f"{schema}, error string")


def crossref_metadata(dois: DataFrame, factory: Callable[[], Fetch], schema: str, chunk: int = 50, **options) -> DataFrame:
    return fetch_works(dois, factory, schema, chunk, **options)


def openalex_metadata(dois: DataFrame, factory: Callable[[], Fetch], schema: str, **options) -> DataFrame:
    """One DOI a request; headings of abstracts are dropped."""
    out = fetch_works(dois, factory, schema, 1, **options)
    return out.withColumn("abstract", strip_prefixes(F.col("abstract"))) if "abstract" in out.columns else out


def search_works(spark: SparkSession, search: Callable[..., list[dict]], schema: str, page: int = 1000, **parameters) -> DataFrame:
    """One search, ``page`` works at a time (``offset`` and ``rows`` tell the service which) until a page isn't full; an empty table when it finds nothing."""
    found: list[dict] = []
    while True:
        part = search(**parameters, offset=len(found), rows=page)
        found += part
        if len(part) < page:
            break
    return spark.createDataFrame(found, schema) if found else spark.createDataFrame([], schema)


def snapshot_works(works: DataFrame, dois: DataFrame) -> DataFrame:
    """The keyed fetch from a stored snapshot."""
    return works.join(dois.select("doi").distinct(), "doi", "left_semi")


def funder_ids(funders: DataFrame, query: str, limit: int = 5, name: str = "name", key: str = "id") -> list[str]:
    """Ids of funders whose name has the query, without the address before them; an empty query is an error."""
    if not query or not query.strip():
        raise ValueError("the query is empty")
    rows = funders.filter(icontains(F.col(name), query)).orderBy(key).limit(limit)
    return [r[0] for r in rows.select(F.substring_index(key, "/", -1)).collect()]


def identity(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class Strategy:
    """A way to find works: fetch with arguments, then filter, then finish."""

    fetch: Callable[..., DataFrame]
    args: dict = field(default_factory=dict)
    filter: Callable[[DataFrame], DataFrame] = identity
    post: Callable[[DataFrame], DataFrame] = identity


def stacked(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def run_strategies(strategies: list[Strategy], combine: Callable[[list[DataFrame]], DataFrame] = stacked) -> DataFrame:
    """What all strategies find, combined."""
    if not strategies:
        raise ValueError("there are no strategies")
    return combine([s.fetch(**s.args).transform(s.filter).transform(s.post) for s in strategies])
