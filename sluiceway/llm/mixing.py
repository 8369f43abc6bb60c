"""Problem 9: mixing sources to target weights, by blocks, multinomial counts and pseudorandom permutations.

The tokens of each source are laid end to end and cut into blocks of one length. How many blocks each
output shard takes from each source is drawn by dealing: a keyed permutation of all slots shuffles
as many cards of each source as its share wants, and a shard takes the next cards. The counts are
those of a multinomial whose totals are held to the targets, so shares don't drift, at any size and
without one shard waiting for another. The k-th slot of a source takes the block that a keyed
permutation of the source's block numbers gives for k; every block is used once before any is used
again, and none more often than the source's cap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm import tokens
from sluiceway.session import cut

BLOCK, SHARD_BLOCKS, SEED = 256, 4096, 20240501
#: Tokens in the runs that a source's blocks are cut from; a run is ordered by one task.
RUN_TOKENS = 50_000_000
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``index`` under a keyed permutation of 0..n-1 each: a Feistel network, walked until it falls inside."""
    index, n, key = index.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    bits = np.ceil(np.log2(np.maximum(n.astype(float), 2)) / 2).astype(np.uint64) + np.uint64(1)
    half = (np.uint64(1) << bits) - np.uint64(1)

    def rounds(x, k, b, m):
        left, right = x >> b, x & m
        for r in range(4):
            left, right = right, left ^ (mixed_bits(right + mixed_bits(k + np.uint64(r))) & m)
        return (left << b) | right

    with np.errstate(over="ignore"):
        out = rounds(index, key, bits, half)
        out_of = out >= n
        while out_of.any():
            out[out_of] = rounds(out[out_of], key[out_of], bits[out_of], half[out_of])
            out_of = out >= n
    return out.astype(np.int64)


def blocks(documents: DataFrame, sources: list[str], key: str, text: str, source: str, path: str, block: int) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """Pieces of documents by block, ``source, block, doc, first_token, tokens``, and the numbers of blocks and of tokens of each source."""
    own = documents.filter(F.col(source).isin(sources)).select(F.col(source).alias("source"), F.col(key).alias("doc"), tokens.token_count(F.col(text), path).alias("n"))
    own = cut(own.filter("n > 0"))
    totals = {r.source: r.n for r in own.groupBy("source").agg(F.sum("n").alias("n")).collect()}  # a row for each source of the fixed list
    runs = F.create_map(*(F.lit(x) for s in sources for x in (s, max(1, round(totals.get(s, 0) / RUN_TOKENS)))))
    own = own.withColumn("run", F.pmod(F.xxhash64("doc", F.lit(SEED)), F.try_element_at(runs, "source")))
    order = Window.partitionBy("source", "run").orderBy(F.xxhash64(F.lit(SEED), "doc"), "doc").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("start", F.coalesce(F.sum("n").over(order), F.lit(0)))
    lengths = own.groupBy("source", "run").agg(F.ceil(F.sum("n") / block).alias("blocks"))  # a row for each RUN_TOKENS
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    lengths = cut(lengths.withColumn("base", F.coalesce(F.sum("blocks").over(before), F.lit(0))))
    have = dict.fromkeys(sources, 0) | {r.source: r.n for r in lengths.groupBy("source").agg(F.sum("blocks").alias("n")).collect()}
    own = own.join(lengths.drop("blocks"), ["source", "run"])
    cuts = own.withColumn("k", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("n") - 1) / block))))
    begin, end = F.greatest(F.col("start"), F.col("k") * block), F.least(F.col("start") + F.col("n"), (F.col("k") + 1) * block)
    pieces = cuts.select("source", (F.col("base") + F.col("k")).alias("block"), "doc", (begin - F.col("start")).cast("int").alias("first_token"), (end - begin).cast("int").alias("tokens"))
    return pieces, have, totals


def dealt(weight: np.ndarray, most: np.ndarray, n: int) -> np.ndarray:
    """``n`` slots, or as many as there may be, by weight; what a source can't fill goes to the others by their weights."""
    n, open_ = min(n, int(most.sum())), np.ones(len(weight), bool)
    share = weight * n
    while (over := open_ & (share > most)).any():
        open_ &= ~over
        share = np.where(open_, weight * (n - most[~open_].sum()) / max(weight[open_].sum(), 1e-300), most)
    want = np.minimum(np.floor(share).astype(np.int64), most)
    while want.sum() < n:  # what rounding left
        for i in np.argsort(-(share - want), kind="stable"):
            if want.sum() < n and want[i] < most[i]:
                want[i] += 1
    return want


def wanted(targets: list[tuple[str, float, int]], have: dict[str, int], slots: int | None, whole: bool = False) -> dict[str, int]:
    """How many slots each source fills.

    ``slots`` defaults to the most for which every source that has blocks reaches its share within its cap;
    if ``whole``, it is the number of all blocks at least, and what a source can't fill goes to the others.
    """
    live = [(s, w, c * have[s]) for s, w, c in targets if w > 0 and c > 0 and have.get(s)]
    if not live:
        return {}
    weight = np.array([w for _, w, _ in live])
    weight, most = weight / weight.sum(), np.array([c for *_, c in live], np.int64)
    n = int(np.floor((most / weight).min())) if slots is None else slots
    want = dealt(weight, most, max(n, sum(have[s] for s, *_ in live)) if whole and slots is None else n)
    return {s: int(k) for (s, *_), k in zip(live, want, strict=True)}


def drawn(slot: np.ndarray, want: list[int], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The source (by its place in ``want``) and the source's ordinal that each slot gets: slots are shuffled by one permutation, and each source holds as many places of it as it wants."""
    total, ends = sum(want), np.cumsum(np.array(want, np.int64))
    place = permuted(slot, np.full(len(slot), total), np.full(len(slot), seed))
    which = np.searchsorted(ends, place, side="right")
    return which, place - np.concatenate([[0], ends])[which]


def mixed(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", path: str = tokens.VOCABULARY, block: int = BLOCK, slots: int | None = None, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED, whole: bool = False) -> DataFrame:
    """The mixture: ``shard, slot, source, block, use, doc, first_token, tokens``, a row for each piece of a document in a slot.

    ``targets`` is a fixed short list ``source, target_share, max_repeats``. Sources without a
    target, and null, empty and tokenless documents, take no part; sources without documents leave
    their share to the others; ``use`` counts from 0 and stays below the source's ``max_repeats``. A
    run of a source is ordered by one task and holds about RUN_TOKENS tokens, so a source may hold
    any share of all rows. If ``whole``, the mixture has as many blocks as the sources together, and
    a source too small for its share, used ``max_repeats`` times, leaves the rest to the others;
    else it has the most blocks for which every share is reached. An empty table gives an empty
    result; further columns are ignored.
    """
    return _mixed(documents, targets, key, text, source, path, block, slots, shard_blocks, seed, whole)[0]


def _mixed(documents: DataFrame, targets: DataFrame, key: str, text: str, source: str, path: str, block: int, slots: int | None, shard_blocks: int, seed: int, whole: bool) -> tuple[DataFrame, dict[str, int]]:
    """The mixture, and the number of tokens that each source has."""
    spark = documents.sparkSession
    aims = [(r.source, float(r.target_share or 0), int(r.max_repeats or 0)) for r in targets.select("source", "target_share", "max_repeats").filter("source is not null").collect()]
    pieces, have, totals = blocks(documents, [s for s, *_ in aims], key, text, source, path, block)
    want = wanted(aims, have, slots, whole)
    order, number = list(want), {s: i for i, (s, *_) in enumerate(aims)}
    counts = [want[s] for s in order]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, which_of, names = np.array([have[s] for s in order], np.int64), np.array([number[s] for s in order], np.int64), np.array(order, object)
        for batch in batches:
            slot = batch["id"].to_numpy(np.int64)
            if not len(slot):
                continue
            which, ordinal = drawn(slot, counts, seed)
            use = ordinal // n[which]
            yield pd.DataFrame({"shard": slot // shard_blocks, "slot": slot, "source": names[which], "use": use.astype(np.int32), "block": permuted(ordinal % n[which], n[which], which_of[which] * 1_000_003 + use + seed)})

    kind = "shard bigint, slot bigint, source string, use int, block bigint"
    slot = spark.range(sum(counts)).mapInPandas(deal, kind)
    return slot.join(pieces, ["source", "block"]).select("shard", "slot", "source", "block", "use", "doc", "first_token", "tokens"), totals


def shares(mixture: DataFrame, targets: DataFrame, available: dict[str, int] | None = None) -> DataFrame:
    """What the mixture came to: ``source, target_share, max_repeats, tokens, share, most_uses, shortfall, available, used``.

    ``shortfall`` is what the share lacks of its target; ``used`` is the part of the source's
    ``available`` tokens that occur in the mixture at all, null if these aren't given.
    """
    got = mixture.groupBy("source").agg(F.sum("tokens").alias("tokens"), (F.max("use") + 1).alias("most_uses"), F.sum(F.when(F.col("use") == 0, F.col("tokens")).otherwise(0)).alias("once"))
    out = targets.select("source", "target_share", "max_repeats").join(got, "source", "left")
    whole = F.sum("tokens").over(Window.partitionBy())  # over the fixed list of sources
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("tokens", "most_uses", "once")}).withColumn("share", F.try_divide("tokens", whole))
    there = F.lit(None) if available is None else F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for k, v in (available or {"": 0}).items() for x in (k, v))), "source"), F.lit(0))
    out = out.withColumn("available", there.cast("bigint")).withColumn("shortfall", F.greatest(F.col("target_share") - F.coalesce("share", F.lit(0.0)), F.lit(0.0)))
    return out.select("source", "target_share", "max_repeats", "tokens", "share", "most_uses", "shortfall", "available", F.try_divide("once", "available").alias("used"))


def reported(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", path: str = tokens.VOCABULARY, block: int = BLOCK, slots: int | None = None, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED, whole: bool = False) -> DataFrame:
    """``shares`` of the mixture that ``mixed`` makes, with what each source has."""
    mixture, available = _mixed(documents, targets, key, text, source, path, block, slots, shard_blocks, seed, whole)
    return shares(mixture, targets, available)
