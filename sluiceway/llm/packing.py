"""Problem 8: filling fixed-capacity containers, by best-fit decreasing with a segment tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import tokens
from sluiceway.session import cut

#: Items that one task packs, about. So many leave hardly more room over than all items at once would.
SHARD_ITEMS = 200_000


class OpenBins:
    """The open bins by the room left in them: a segment tree over all capacities counts them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, name: int) -> None:
        self.bins[room].append(name)
        i = room + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out the bin with the least room of ``size`` or more: (room, name)."""
        count, i = self.count, size + self.leaves
        if i >= 2 * self.leaves:
            return None
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):  # up, until a subtree to the right holds a bin
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: largest items first, each into the fullest bin that has room for it, else a new one. No size exceeds ``capacity``."""
    tree, out, n = OpenBins(capacity), np.zeros(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        got = tree.tightest(size)
        room, name = got if got else (capacity, n)
        n += got is None
        out[i] = name
        tree.add(room - size, name)
    return out


def packed(documents: DataFrame, containers: DataFrame, key: str = "doc_id", text: str = "text", path: str = tokens.VOCABULARY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Pack all documents into containers of each kind: ``container, shard, bin, doc, part, first_token, tokens``.

    ``containers`` is a fixed short list: ``container, capacity_tokens``; kinds without a positive
    capacity are left out. A document larger than the capacity is split into full containers of its
    own and one rest; no other one is split. Documents are packed in shards of about ``shard_items``
    parts, spread by hash, each by one task. Null, empty and tokenless documents are items of size 0 and
    share a container; equal documents count each; an empty table gives an empty result; further
    columns are ignored.
    """
    sized = cut(documents.select(F.col(key).alias("doc"), tokens.token_count(F.col(text), path).alias("n")))
    kinds = [(r.container, int(r.capacity_tokens)) for r in containers.select("container", "capacity_tokens").filter("capacity_tokens > 0").distinct().collect()]
    if not kinds:
        return sized.limit(0).selectExpr("'' container", "0 shard", "0L bin", "doc", "0 part", "0 first_token", "0 tokens")
    parts_of = [F.sum(F.greatest(F.lit(1), F.ceil(F.col("n") / k))) for _, k in kinds]
    shards = [max(1, round((n or 0) / shard_items)) for n in sized.agg(*parts_of).first()]
    kind = F.explode(F.array(*(F.struct(F.lit(c).alias("container"), F.lit(k).alias("capacity"), F.lit(m).alias("shards")) for (c, k), m in zip(kinds, shards, strict=True)))).alias("kind")
    items = sized.select("doc", "n", kind).select("doc", "n", F.pmod(F.xxhash64("doc"), "kind.shards").cast("int").alias("shard"), "kind.container", "kind.capacity")
    parts = F.expr("explode(sequence(0, greatest(0, ceil(n / capacity) - 1))) AS part")
    items = items.select("*", parts).selectExpr("container", "shard", "capacity", "doc", "cast(part as int) part", "cast(part * capacity as int) first_token", "cast(least(capacity, n - part * capacity) as int) tokens")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc", "part"], kind="stable", ignore_index=True)
        pdf["bin"] = best_fit_decreasing(pdf["tokens"].to_numpy(), int(pdf["capacity"].iat[0]))
        return pdf[["container", "shard", "bin", "doc", "part", "first_token", "tokens"]]

    doc = dict(sized.dtypes)["doc"]
    return items.groupBy("container", "shard").applyInPandas(pack, f"container string, shard int, bin bigint, doc {doc}, part int, first_token int, tokens int")


def report(bins: DataFrame, containers: DataFrame) -> DataFrame:
    """How well each kind of container is filled: ``container, capacity_tokens, bins, documents, tokens, filled``."""
    own = bins.groupBy("container").agg(F.countDistinct("shard", "bin").alias("bins"), F.countDistinct("doc").alias("documents"), F.sum("tokens").alias("tokens"))
    return own.join(F.broadcast(containers.select("container", "capacity_tokens").distinct()), "container").withColumn("filled", F.col("tokens") / (F.col("bins") * F.col("capacity_tokens")))
