"""Problem 1: variant spellings of names typed by people, by MinHash banding, Monge-Elkan and star clustering.

Distinct names are split into surname and given names. Candidates are names with the same (formal)
first initial whose surnames fall into one bucket of a MinHash banding over padded q-grams; the
number of bands follows from the collision curve for the likeness at which recall is wanted.
Candidates are verified by Monge-Elkan likeness, and the links are gathered into stars: the names
with the most links become centres, every other name joins the centre it is most like.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import names as N
from sluiceway.session import cut

Q, ROWS = 2, 3
#: Jaccard likeness of padded q-grams that two surnames one slip apart have at least, about, and the share of such pairs to be found.
LIKENESS, RECALL = 0.45, 0.97
ALIKE = 0.78
#: Letters up to which surnames are also indexed by what is left of them without as many letters as they may have slips: two slips
#: make shorter words less like than LIKENESS (two swaps in n letters leave (n - 5) / (n + 7)), and the banding misses them.
INDEXED = 15
#: Pairs under two entries above which only names whose first given names may be one are compared; letters up to which given names are told apart for that.
MANY_PAIRS, GIVEN_INDEXED = 10_000, 30
SEED = 7


def bands(likeness: float = LIKENESS, recall: float = RECALL, rows: int = ROWS) -> int:
    """How many bands of ``rows`` rows find a pair of this likeness with this probability: 1 - (1 - s^r)^b >= recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - likeness**rows))


def shortened(word: str) -> set[str]:
    """A word of at most INDEXED letters and what is left of it without one letter, from TWO_SLIPS letters on without up to two.

    Two words that ``names.slips`` takes for one, both indexed, share one of these: every slip, a swap too, is made good by leaving out a letter of each.
    """
    if len(word) > INDEXED:
        return set()
    out = last = {word}
    for _ in range(2 if len(word) >= N.TWO_SLIPS else 1):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


def signatures(words: list[str], count: int) -> np.ndarray:
    """MinHash signatures of padded q-grams, ``count`` a word; all words at once. Empty words count as one gram."""
    grams = [[hash_of(p[i : i + Q]) for i in range(len(p) - Q + 1)] for p in ("^" * (Q - 1) + w + "$" * (Q - 1) for w in words)]
    sizes = np.array([len(g) for g in grams])
    flat = np.array([x for g in grams for x in g], np.uint64)
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(1, 2**61, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**61, count, dtype=np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.empty((len(words), count), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(count):
            h = flat * a[i] + b[i]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out[:, i] = np.minimum.reduceat(h ^ (h >> np.uint64(32)), starts)
    return out


def hash_of(gram: str) -> int:
    """The same number in every process."""
    out = 1469598103934665603
    for c in gram:
        out = ((out ^ ord(c)) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return out


def keyed(names: DataFrame) -> DataFrame:
    """``name, node, entry, surname``: each name's spelling-free form and the (initial, surname) entries it may stand under. ``names``: see ``names.with_given``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, known in zip(batch["name"], batch["given"], strict=True):
                if words := N.group_words(N.fold(name)):
                    node = "g|" + " ".join(words)
                    rows += [(name, node, f"{N.initials_of(words)}|{words[0]}", words[0]), (name, node, f"{words[1][0]}|{words[0]}", words[0]), (name, node, f"|{N.initials_of(words)}", N.initials_of(words))]
                    continue
                ways = N.readings(name, frozenset(known) if known is not None else frozenset())
                surname, own = ways[0]
                if not surname:
                    continue
                node = f"p|{surname}|{' '.join(own)}"
                for s, g in ways:
                    initial = N.NICKNAMES.get(g[0], g[0])[:1] if g else ""
                    rows.append((name, node, f"{initial}|{s}", s))
            yield pd.DataFrame(rows, columns=["name", "node", "entry", "surname"])

    return names.select("name", "given").mapInPandas(run, "name string, node string, entry string, surname string")


def banded(entries: DataFrame, likeness: float = LIKENESS, recall: float = RECALL) -> DataFrame:
    """``entry, band`` for each entry and band of the banding, and for each of the shortened forms of a surname of at most INDEXED letters."""
    count = bands(likeness, recall)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            s = signatures(list(batch["surname"]), count * ROWS).reshape(len(batch), count, ROWS)
            with np.errstate(over="ignore"):
                key = np.zeros((len(batch), count), np.uint64)
                for r in range(ROWS):
                    key = (key ^ s[:, :, r]) * np.uint64(0x100000001B3)
                own = np.array([hash_of(e.split("|")[0]) for e in batch["entry"]], np.uint64)
                key = (key + own[:, None]) * np.uint64(0x9E3779B97F4A7C15) + np.arange(count, dtype=np.uint64)
            yield pd.DataFrame({"entry": np.repeat(batch["entry"].to_numpy(), count), "band": key.astype(np.int64).ravel()})
            left = [[hash_of(f"{e.partition('|')[0]}|{x}") for x in shortened(w)] for e, w in zip(batch["entry"], batch["surname"], strict=True)]
            yield pd.DataFrame({"entry": np.repeat(batch["entry"].to_numpy(), [len(x) for x in left]), "band": np.array([h for x in left for h in x], np.uint64).astype(np.int64)})

    spread = max(2, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a set number, or few tasks would hash all
    return entries.select("entry", "surname").repartition(spread, "entry").mapInPandas(run, "entry string, band bigint")


def _shortened(group: str, other: str) -> float:
    """Likeness of a group's name and its short form, "First XYZ" or its initials."""
    words, (_, surname, given) = group[2:].split(" "), other.split("|")
    if not given:
        return 0.9 if surname == N.initials_of(words) else 0.0
    return 0.9 * N.token_similarity(words[0], surname) if "".join(given.split()) == N.initials_of(words[1:]) else 0.0


def _likeness(a: str, b: str) -> float:
    if a[0] == "g" or b[0] == "g":
        if a[0] != b[0]:
            return _shortened(*((a, b) if a[0] == "g" else (b, a)))
        x, y = tuple(a[2:].split(" ")), tuple(b[2:].split(" "))
        return N.monge_elkan(x, y) if len(x) == len(y) and all(N.token_similarity(i, j) >= 0.65 for i, j in zip(x, y, strict=True)) else 0.0
    (_, sa, ga), (_, sb, gb) = a.split("|"), b.split("|")
    x, y = (sa, tuple(ga.split())), (sb, tuple(gb.split()))
    best = N.alike(x, y)
    if best < ALIKE and x[1] and y[1]:  # one may be the wrong way round
        best = max(best, N.alike((x[1][0], (*x[1][1:], sa)), y) * 0.97, N.alike(x, (y[1][0], (*y[1][1:], sb))) * 0.97)
    return best


def verified(pairs: DataFrame, least: float = ALIKE) -> DataFrame:
    """``a, b, score`` of the candidate pairs that are alike."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = np.array([_likeness(a, b) for a, b in zip(batch["a"], batch["b"], strict=True)], float)
            yield batch.assign(score=score)[score >= least]

    return pairs.mapInPandas(run, "a string, b string, score double")


def given_keys(node: str, entry: str) -> set[str] | None:
    """What the first given name of a node, or the second word of a group's name, has in common with every one that ``names.token_similarity`` may take for it; null if it may go with any (an initial, or none). ``entry``: that the node stands under, in the one order or turned round."""
    if node[0] == "g":
        word = node[2:].split(" ")[1]
    else:
        _, surname, own = node.split("|")
        own = own.split(" ")
        word = own[0] if entry.partition("|")[2] == surname else own[1] if len(own) > 1 else surname
    if len(word) <= 1:
        return None
    if len(word) > GIVEN_INDEXED:
        return {"long"}
    forms = {word, N.NICKNAMES.get(word, word)}
    out = {x for w in forms for x in _without(w, 2 if len(w) >= N.TWO_SLIPS else 1)}
    if len(word) > GIVEN_INDEXED - 3:
        out.add("long")
    if (full := N.NICKNAMES.get(word[:-1])) is not None:  # an initial stuck to a nickname
        out.add(full)
    return out


def _without(word: str, letters: int) -> set[str]:
    """``word`` and what is left of it without up to so many letters."""
    out = last = {word}
    for _ in range(letters):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


def among_many(near: DataFrame, at: DataFrame) -> DataFrame:
    """``a, b``: the pairs of nodes under pairs of entries (``entry, entry2``) whose given names may be one. ``at``: node, entry.

    Names with only an initial are compared with all; there are few such under one entry.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [given_keys(n, e) for n, e in zip(batch["node"], batch["entry"], strict=True)]
            keys = [sorted(k) if k is not None else [None] for k in keys]
            sizes = [len(k) for k in keys]
            yield pd.DataFrame({"entry": np.repeat(batch["entry"].to_numpy(), sizes), "node": np.repeat(batch["node"].to_numpy(), sizes), "given": [x for k in keys for x in k]})

    own = near.select("entry").unionByName(near.select(F.col("entry2").alias("entry"))).distinct()
    told = cut(at.join(own, "entry", "left_semi").select("entry", "node").mapInPandas(run, "entry string, node string, given string"))
    a, b = told.withColumnRenamed("node", "a"), told.select(F.col("entry").alias("entry2"), F.col("node").alias("b"), "given")
    same = near.join(a.filter("given is not null"), "entry").join(b.filter("given is not null"), ["entry2", "given"])
    every = lambda x, node: x.select(x.columns[0], node).distinct()
    bare = near.join(a.filter("given is null"), "entry").join(every(b, "b"), "entry2").select("a", "b").unionByName(near.join(b.filter("given is null"), "entry2").join(every(a, "a"), "entry").select("a", "b"))
    return same.select("a", "b").unionByName(bare)


def links(keys: DataFrame, likeness: float = LIKENESS, recall: float = RECALL, least: float = ALIKE, many: int = MANY_PAIRS) -> DataFrame:
    """``a, b, score`` with a < b: verified links between nodes.

    Under entries with few nodes all are compared; where there would be more than ``many`` pairs, those whose given names may be one (the others fail the check anyway).
    """
    at = cut(keys.select("node", "entry").distinct())
    entries = keys.select("entry", "surname").distinct()
    band = cut(banded(entries, likeness, recall))
    other = band.withColumnRenamed("entry", "entry2")
    near = band.join(other, "band").filter("entry < entry2").select("entry", "entry2").distinct()
    short = lambda c: F.substring_index(c, "|", -1)
    near = near.filter(F.levenshtein(short(F.col("entry")), short(F.col("entry2"))) <= F.when(F.least(F.length(short(F.col("entry"))), F.length(short(F.col("entry2")))) >= N.TWO_SLIPS, 4).otherwise(2))
    near = near.unionByName(entries.select("entry", F.col("entry").alias("entry2")).distinct())
    size = at.groupBy("entry").agg(F.count("*").alias("n"))
    near = cut(near.join(size, "entry").join(size.select(F.col("entry").alias("entry2"), F.col("n").alias("m")), "entry2"))
    few, crowded = near.filter(F.col("n") * F.col("m") <= many), near.filter(F.col("n") * F.col("m") > many)
    pairs = few.join(at.withColumnRenamed("node", "a"), "entry").join(at.select(F.col("node").alias("b"), F.col("entry").alias("entry2")), "entry2").select("a", "b")
    pairs = pairs.unionByName(among_many(crowded.select("entry", "entry2"), at))
    pairs = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return verified(pairs, least)


def stars(edges: DataFrame) -> DataFrame:
    """``node, centre, score`` from links: star clustering.

    In each round the free nodes that come before all their free neighbours, by number of links,
    length and then hash, become centres, and free neighbours of new centres are taken; a node joins
    the centre it is most like. Every node of ``edges`` is in one star; a node is never farther than
    one link from its centre. Among nodes with as many links the hash makes the order random, so
    chains of any length take a number of rounds that grows with the logarithm of theirs.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("peer"), "score").unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("peer"), "score"))
    degree = both.groupBy("node").agg(F.count("*").alias("links"))
    # a bare word, such as initials that several groups share, becomes a centre last
    rank = lambda c: F.struct(c.rlike(r"^p\|[^|]*\|$").alias("bare"), (-F.col("links")).alias("l"), (-F.length(c)).alias("n"), F.xxhash64(c).alias("h"), c.alias("c"))
    ranked = degree.select("node", rank(F.col("node")).alias("rank"))
    both = cut(both.join(ranked, "node").join(ranked.select(F.col("node").alias("peer"), F.col("rank").alias("peer_rank")), "peer"))
    free, centres = both, None
    while True:
        best = free.groupBy("node").agg(F.first("rank").alias("rank"), F.min("peer_rank").alias("first"))
        new = cut(best.filter("rank < first").select(F.col("node").alias("centre")))
        if new.isEmpty():
            break
        centres = new if centres is None else centres.unionByName(new)
        taken = new.select(F.col("centre").alias("gone")).unionByName(free.join(new, free["peer"] == new["centre"], "left_semi").select(F.col("node").alias("gone"))).distinct()
        free = cut(free.join(taken, free["node"] == taken["gone"], "left_anti").join(taken, free["peer"] == taken["gone"], "left_anti"))
    if centres is None:
        return both.selectExpr("node", "peer centre", "score").limit(0)
    leaves = both.join(centres, both["peer"] == centres["centre"]).join(centres.select(F.col("centre").alias("node")), "node", "left_anti")
    joined = leaves.groupBy("node").agg(F.max(F.struct("score", (-F.col("peer_rank.l")).alias("l"), F.col("centre"))).alias("x")).select("node", "x.centre", "x.score")
    own = centres.select(F.col("centre").alias("node"), "centre", F.lit(1.0).alias("score"))
    rest = degree.select("node").join(own.select("node").unionByName(joined.select("node")), "node", "left_anti").select("node", F.col("node").alias("centre"), F.lit(1.0).alias("score"))
    return own.unionByName(joined).unionByName(rest)


def clusters(names: DataFrame, likeness: float = LIKENESS, recall: float = RECALL, least: float = ALIKE) -> DataFrame:
    """``name, cluster, score`` for each different string of the column ``name``; the cluster is named by its centre.

    Nulls and strings without letters belong to no cluster; any difference makes strings different;
    repeated rows count once; texts of any length are taken whole; an empty table gives an empty
    result; further columns are ignored. Buckets hold distinct surnames of one initial, never
    mentions, so a name borne by a third of all rows is one entry.
    """
    distinct = names.select("name").filter("name is not null").distinct()
    keys = cut(keyed(N.with_given(distinct)))
    star = stars(cut(links(keys, likeness, recall, least)))
    nodes = keys.select("name", "node").distinct().join(star, "node", "left")
    return nodes.select("name", F.coalesce("centre", "node").alias("cluster"), F.coalesce("score", F.lit(1.0)).alias("score"))


def variants(members: DataFrame) -> DataFrame:
    """``name_a, name_b, cluster``: each pair of different strings of one cluster, the first before the second by code point."""
    other = members.select(F.col("name").alias("name_b"), "cluster")
    return members.select(F.col("name").alias("name_a"), "cluster").join(other, "cluster").filter("name_a < name_b").select("name_a", "name_b", "cluster")
