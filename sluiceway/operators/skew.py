"""Joins whose keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.session import cut

#: How many groups may count as hot. What is broadcast is at most so many rows, whatever the input.
MOST_HOT = 1000
#: Groups of fewer rows than this never need help.
HOT_ROWS = 20_000
#: About so many rows of either side of a join meet in one cell of a crowded key.
SIDE = 128


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, most_hot: int = MOST_HOT, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Give each row of ``rows`` the columns of its group, which is one row of ``groups``.

    ``size`` is the column of ``groups`` with the number of rows in the group. The ``most_hot``
    largest groups are broadcast, so their rows stay where they are; any other group has at most
    1/``most_hot`` of all rows and is joined by a shuffle. Rows without a group are left out.
    Null keys match nothing.
    """
    hot = groups.filter(F.col(size) >= hot_rows).orderBy(F.desc(size), *on).limit(most_hot)
    hot_keys = hot.select(*on)
    near = rows.join(F.broadcast(hot), on)
    far = rows.join(F.broadcast(hot_keys), on, "left_anti").join(groups.join(F.broadcast(hot_keys), on, "left_anti"), on)
    return near.unionByName(far)


def crowded(first: DataFrame, second: DataFrame, on: str, side: int = SIDE) -> DataFrame:
    """``on, _rows, _columns``: keys with more than ``side`` squared pairs, and into how many parts the rows of ``first`` and of ``second`` are cut.

    It has at most a row for each ``side`` squared pairs of the join, and is written out, so that it
    is broadcast only where it is small.
    """
    size = lambda df, n: df.groupBy(on).agg(F.count("*").alias(n))
    parts = lambda n: F.ceil(F.col(n) / side)
    both = size(first, "_a").join(size(second, "_b"), on).filter(F.col("_a") * F.col("_b") > side * side)
    return cut(both.select(on, parts("_a").alias("_rows"), parts("_b").alias("_columns")))


def in_cells(df: DataFrame, keys: DataFrame, on: str, place: str) -> DataFrame:
    """Adds ``_cell`` and ``_crowded``: a row of a crowded key stands in each cell of its row (``place`` is first) or column (second) of the key's grid, or in all (every).

    A row of the first and one of the second side meet in exactly one cell. All rows of other keys
    are in cell 0. The part follows from the row's plain columns, so rows alike in all of them stay together.
    """
    part = lambda n: F.pmod(F.xxhash64(*(c for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct")))), F.col(n))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    cells = {
        "first": F.transform(upto(F.col("_columns")), lambda i: part("_rows") * F.col("_columns") + i),
        "second": F.transform(upto(F.col("_rows")), lambda i: i * F.col("_columns") + part("_columns")),
        "every": upto(F.col("_rows") * F.col("_columns")),
    }[place]
    there = F.col("_rows").isNotNull()
    cell = F.when(there, cells).otherwise(F.array(F.lit(0).cast("bigint")))
    return df.join(keys, on, "left").select(*df.columns, there.alias("_crowded"), F.explode(cell).alias("_cell"))
