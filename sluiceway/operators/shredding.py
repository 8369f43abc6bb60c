"""Problem 7: nested records taken apart column by column, with repetition and definition levels.

Every leaf path of a nested column becomes one flat column of values, each with a repetition level
(at which repeated field of the path it starts a new entry) and a definition level (how far down
the path is defined). The tables of the repeated ancestors are rebuilt from those levels alone,
with running sums, so that every row knows its parent and its place. All steps work on whole Arrow
columns with numpy; there is no loop over records.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = r"^[\s\pZ\p{Cf}\p{Cc}]*$"


@dataclass
class Leaf:
    """One leaf path: levels of all its entries, and the values of the fully defined ones in order."""

    path: tuple[str, ...]
    rep: np.ndarray
    deff: np.ndarray
    #: Record of each entry.
    record: np.ndarray
    values: pa.Array
    max_def: int
    #: For each repeated field on the path: (its path, definition level of an entry in it).
    lists: tuple[tuple[tuple[str, ...], int], ...]


def shred(column: pa.Array, name: str) -> list[Leaf]:
    """The leaves of one nested Arrow column. ``null`` and empty lists differ by one definition level."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    zeros = np.zeros(n, np.int32)
    leaves: list[Leaf] = []
    _walk(column, np.arange(n), np.arange(n), zeros, zeros, 0, (name,), (), leaves)
    return leaves


def _walk(values: pa.Array, at: np.ndarray, record: np.ndarray, rep: np.ndarray, deff: np.ndarray, depth: int, path, lists, out: list[Leaf]) -> None:
    """``at[i]``: the element of ``values`` that entry i stands for, -1 if the path ended above."""
    there = at >= 0
    valid = np.zeros(len(at), bool)
    if there.any():
        mask = np.asarray(pc.is_valid(values))
        valid[there] = mask[at[there]]
    deff = np.where(valid, depth + 1, deff).astype(np.int32)
    at = np.where(valid, at, -1)
    kind = values.type
    if pa.types.is_struct(kind):
        for i in range(kind.num_fields):
            _walk(pc.struct_field(values, [i]), at, record, rep, deff, depth + 1, (*path, kind.field(i).name), lists, out)
    elif pa.types.is_list(kind) or pa.types.is_large_list(kind):
        level = len(lists) + 1
        starts = np.asarray(values.offsets)[:-1].astype(np.int64)
        sizes = np.diff(np.asarray(values.offsets).astype(np.int64))
        n = np.zeros(len(at), np.int64)
        n[valid] = sizes[at[valid]]
        copies = np.maximum(n, 1)
        entry = np.repeat(np.arange(len(at)), copies)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(copies) - copies, copies)
        filled = n[entry] > 0
        child = np.full(len(entry), -1, np.int64)
        child[filled] = starts[at[entry[filled]]] + place[filled]
        rep2 = np.where(place == 0, rep[entry], level).astype(np.int32)
        deff2 = np.where(filled, depth + 2, deff[entry]).astype(np.int32)
        _walk(values.values, child, record[entry], rep2, deff2, depth + 2, path, (*lists, (path, depth + 2)), out)
    else:
        out.append(Leaf(path, rep, deff, record, values.take(pa.array(at[valid])), depth + 1, lists))


def places(leaf: Leaf, level: int) -> tuple[np.ndarray, np.ndarray]:
    """From levels only: for each entry the row of the ``level``-th repeated ancestor it lies in (-1: in none), and each row's first entry."""
    defined = leaf.deff >= leaf.lists[level - 1][1]
    starts = defined & (leaf.rep <= level)
    row = np.cumsum(starts) - 1
    return np.where(defined, row, -1), np.flatnonzero(starts)


def ordinals(leaf: Leaf, level: int, first: np.ndarray) -> np.ndarray:
    """The place, from 0, within its list of each row that starts at the entries ``first``."""
    new = np.zeros(len(leaf.rep), np.int64)
    new[first] = 1
    count = np.cumsum(new)
    begins = leaf.rep < level
    base = np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))
    before = np.where(new[base] == 1, count[base] - 1, count[base])
    return (count - 1 - before)[first]


def blank(values: pa.Array) -> np.ndarray:
    """Whether each value is a string without visible content. Values of other kinds are content."""
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        return np.asarray(pc.fill_null(pc.match_substring_regex(values, BLANK), True))
    return np.zeros(len(values), bool)


def tables(column: pa.Array, name: str) -> dict[tuple[str, ...], dict]:
    """For each repeated ancestor: ``record``, ``place`` (a column per level), ``content`` (some leaf below it holds more than blanks) and its own scalar ``fields``."""
    leaves = shred(column, name)
    out: dict[tuple[str, ...], dict] = {}
    for leaf in leaves:
        full = leaf.deff == leaf.max_def
        visible = np.zeros(len(full), bool)
        visible[full] = ~blank(leaf.values)
        for level in range(1, len(leaf.lists) + 1):
            path = leaf.lists[level - 1][0]
            row, first = places(leaf, level)
            got = out.setdefault(path, {"content": np.zeros(len(first), bool), "fields": {}})
            if "record" not in got:
                up = [ordinals(leaf, j, f)[r[first]] for j in range(1, level) for r, f in [places(leaf, j)]]
                got |= {"record": leaf.record[first], "place": [*up, ordinals(leaf, level, first)]}
            held = visible & (row >= 0)
            got["content"] |= np.bincount(row[held], minlength=len(first)).astype(bool)
            if level == len(leaf.lists):
                at = np.full(len(first), -1, np.int64)
                at[row[full & (row >= 0)]] = np.arange(full.sum())
                label = "_".join(leaf.path[len(path):]) or "value"
                got["fields"][label] = leaf.values.take(pa.array(at, mask=at < 0))
    return out


def flat_tables(df: DataFrame, parent: str, columns: dict[str, dict[tuple[str, ...], str]]) -> DataFrame:
    """The elements with content of every repeated ancestor: ``child, parent_id, pos, subpos, fields``.

    ``columns``: for each nested column the names of its ancestors' tables by path; ancestors that
    aren't named are left out. ``pos`` is the place in the outer list, ``subpos`` in the inner one
    (-1 without). ``fields`` holds the element's own scalar fields as strings, by name; nulls are
    left out of it. An element has content if some string in it or below it is neither null nor
    blank. Null and empty lists, null elements and an empty table give no rows; repeated rows give
    theirs each. A narrow operator: one pass over the rows, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, (_, named) in enumerate(columns.items()):
                for path, t in tables(batch.column(i + 1), batch.schema.names[i + 1]).items():
                    child = named.get(path[1:])
                    if child is None:
                        continue
                    keep = np.flatnonzero(t["content"])
                    place = [p[keep] for p in t["place"]]
                    sub = place[1] if len(place) > 1 else np.full(len(keep), -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keep), child, object), pa.string()), ids.take(pa.array(t["record"][keep])).cast(pa.int64()), pa.array(place[0].astype(np.int32)), pa.array(sub.astype(np.int32)), _maps(t["fields"], keep)],
                        names=["child", "parent_id", "pos", "subpos", "fields"],
                    )

    return df.select(parent, *columns).mapInArrow(run, "child string, parent_id bigint, pos int, subpos int, fields map<string,string>")


def _maps(fields: dict[str, pa.Array], keep: np.ndarray) -> pa.Array:
    """A map of each kept row's fields, built column by column."""
    n, names = len(keep), list(fields)
    if not names:
        return pa.MapArray.from_arrays(np.zeros(n + 1, np.int32), pa.array([], pa.string()), pa.array([], pa.string()))
    taken = [fields[k].take(pa.array(keep)).cast(pa.string()) for k in names]
    there = np.stack([np.asarray(pc.is_valid(v)) for v in taken], axis=1)
    order = (np.arange(len(names)) * n)[None, :] + np.arange(n)[:, None]
    flat = pa.concat_arrays(taken).take(pa.array(order[there]))
    keys = pa.array(np.array(names, object)[np.nonzero(there)[1]], pa.string())
    return pa.MapArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)), keys, flat)


#: What problem 7 names: nested column, path below it, name of the flat table.
BIBLIOGRAPHIC = {
    "openalex_metadata": ("oa_id", {"authorships": {(): "authorship", ("affiliations",): "authorship_affiliation"}}),
    "crossref_metadata": ("cr_id", {"author": {(): "author", ("affiliation",): "author_affiliation"}, "funder": {(): "funder"}}),
}


def children(df: DataFrame, source: str) -> DataFrame:
    """``flat_tables`` of one of the two metadata tables, without the fields."""
    parent, columns = BIBLIOGRAPHIC[source]
    return flat_tables(df, parent, columns).select("child", "parent_id", "pos", "subpos")
