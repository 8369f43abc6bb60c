"""Problem 2: mapping free-entered values to a canonical list, with a BK-tree under a true edit metric.

A typed value is cut into its parts (department, name, place, ...); every part is brought to the
spelling of the list (case, accents, known abbreviations and languages) and looked up in the tree.
The tree holds the entries' names and, marked, their initials, and returns every entry within the
threshold: that of initials is 0, and they need the entry's place beside them where several entries
share them. Each distinct value is looked up once.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.bktree import BKTree, one_edit
from sluiceway.operators.skew import join_groups
from sluiceway.session import cut

#: Entries in one tree at most; a longer list is searched in shards of this size, whose hits are weighed together.
SHARD_ENTRIES = 50_000
#: Edits allowed, and the shortest part that may have any.
EDITS, LEAST_FUZZY = 1, 9
NONE = -1
#: Stands before initials in the tree.
MARK = "\u001f"
#: Ways in which an entry is hit, in order of preference; and that a part or a text of the value is a place of the list.
EXACT, NEAR, INITIALS, PLACE_PART, PLACE_TEXT = range(5)

ABBREVIATIONS = {
    "dept": "department", "dep": "department", "dpt": "department", "univ": "university", "uni": "university", "u": "university", "inst": "institute", "lab": "laboratory", "labs": "laboratory",
    "laboratories": "laboratory", "natl": "national", "nat'l": "national", "nat": "natural", "res": "resources", "resour": "resources", "sci": "science", "&": "and", "auth": "authority",
    "dst": "district", "dist": "district", "eng": "engineering", "engrg": "engineering", "engr": "engineering", "consult": "consultants", "geol": "geological", "surv": "survey", "tech": "technology",
    "technol": "technology", "cons": "conservation", "conserv": "conservation", "ag": "agriculture", "agric": "agriculture", "coll": "college", "mus": "museum", "hist": "history", "stew": "stewardship",
    "stewardsh": "stewardship", "universite": "university", "universidad": "university", "universita": "university", "universitat": "university", "universidade": "university", "de": "of", "di": "of", "da": "of",
}
SMALL = {"of", "and", "the", "for", "in", "at"}
PARTS = re.compile(r"[,;()\[\]|/\n\r\t]| - | – | — ")


def fold(text: str) -> str:
    """Case, accents, invisible characters, entities and spacing aside."""
    text = (html.unescape(text) if "&" in text else text).casefold()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return " ".join(text.replace("’", "'").split())


def spelled(part: str) -> str:
    """A part in the spelling of the list: abbreviations and other languages written out."""
    words = [w for w in (x.strip(".:\"'“”*") if x != "." else "" for x in part.split()) if w]
    words = [ABBREVIATIONS.get(w, w) for w in words]
    if words[:1] == ["the"]:
        words = words[1:]
    if words[:1] == ["university"] and len(words) == 2 and words[1] != "of":
        words.insert(1, "of")
    return " ".join(words)


def initials(name: str) -> str:
    return "".join(w[0] for w in name.split() if w not in SMALL)


def read(value: str | None) -> tuple[list[str], list[str]]:
    """The parts of a typed value, and the texts to look up: the parts in the spelling of the list, and neighbours that belong together."""
    parts = [p.strip() for p in PARTS.split(fold(value or "")) if p.strip()]
    texts = [spelled(p) for p in parts]
    texts += [f"{b} {a}" for a, b in zip(texts, texts[1:], strict=False) if b.endswith(" of")] + [f"{a} {b}" for a, b in zip(texts, texts[1:], strict=False) if a.endswith((" and", " &")) or b.startswith("and ")]
    return parts, texts


class Matcher:
    """A reference list, or a shard of it, ready for look-ups."""

    def __init__(self, entries: list[tuple[int, str, str]], edits: int = EDITS):
        names: dict[str, list[int]] = {}
        self.place: dict[int, str] = {}
        for key, name, place in entries:
            full = spelled(fold(name or ""))
            if not full:
                continue
            names.setdefault(full, []).append(key)
            names.setdefault(MARK + initials(full), []).append(key)
            self.place[key] = fold(place or "")
        self.places = set(self.place.values()) - {""}
        self.tree, self.edits = BKTree(names), edits

    @lru_cache(maxsize=200_000)  # noqa: B019
    def near(self, part: str) -> tuple[tuple[int, str], ...]:
        """Entries within the threshold of a part. A swap of neighbours is one slip of the hand but two edits, so the tree is asked for one edit more."""
        if len(part) < LEAST_FUZZY:
            return ()
        return tuple((min(k, self.edits), name) for k, name in self.tree.within(part, self.edits + 1) if name[0] != MARK and (k <= self.edits or (self.edits == 1 and one_edit(part, name))))

    def best(self, value: str | None) -> tuple[int, int]:
        """(edits, entry) of the nearest entry, or (-1, NONE). A tie that the place doesn't settle gives none."""
        parts, texts = read(value)
        if not parts:
            return -1, NONE
        said = {p.strip(" .") for p in parts} & self.places
        texts = [t for t in texts if t not in self.places]
        for found in ({(0, key) for t in texts for key in self.tree.ids.get(t, ())}, None):
            if found is None:
                found = {(k, key) for t in texts for k, name in self.near(t) for key in self.tree.ids[name]}
            if found:
                return self._one(found, said, False) or (-1, NONE)
        return self._one({(self.edits + 1, key) for key in self.short(parts)}, said, True) or (-1, NONE)

    def short(self, parts: list[str]) -> set[int]:
        """Entries whose initials are a part."""
        asked = {MARK + p.replace(".", "").replace(" ", "") for p in parts if len(p.replace(".", "")) >= 3}
        return {key for x in asked for _, name in self.tree.within(x, 0) for key in self.tree.ids[name]}

    def hits(self, value: str | None) -> set[tuple[int, int, int, bool, str]]:
        """(way, edits, entry, whether its place stands beside it, text) of every entry of the shard that a value may mean, and the places of the shard in it; ``weighed`` has the rest of ``best``."""
        parts, texts = read(value)
        beside = {p.strip(" .") for p in parts}
        here = lambda key: self.place[key] in beside and self.place[key] != ""
        out = {(PLACE_PART, 0, NONE, True, p) for p in beside & self.places} | {(PLACE_TEXT, 0, NONE, True, t) for t in self.places.intersection(texts)}
        for t in texts:
            out |= {(EXACT, 0, key, here(key), t) for key in self.tree.ids.get(t, ())}
            out |= {(NEAR, k, key, here(key), t) for k, name in self.near(t) for key in self.tree.ids[name]}
        return out | {(INITIALS, self.edits + 1, key, here(key), "") for key in self.short(parts)}

    def _one(self, found: set[tuple[int, int]], said: set[str], strict: bool) -> tuple[int, int] | None:
        if strict and said:
            found = {x for x in found if self.place[x[1]] in said}
        if not found:
            return None
        nearest = [x for x in found if x[0] == min(found)[0]]
        if len(nearest) > 1:
            nearest = [x for x in nearest if self.place[x[1]] in said]
        return nearest[0] if len(nearest) == 1 else None


@lru_cache(maxsize=2)
def _matcher(entries: tuple[tuple[int, str, str], ...], edits: int) -> Matcher:
    """Built once in each Python worker."""
    return Matcher(list(entries), edits)


def mapped(values: DataFrame, reference: DataFrame, key: str = "institution_id", name: str = "canonical", place: str = "city", edits: int = EDITS, shard: int = SHARD_ENTRIES) -> DataFrame:
    """``value, times, entry, edits`` for distinct values and how often they occur: the entry meant, or NONE.

    The list is broadcast if it has at most ``shard`` entries; a longer one is searched shard by
    shard, and all hits of a value are weighed together, so the shards make no difference.
    """
    rows = reference.select(F.col(key).cast("bigint").alias("k"), F.col(name).alias("n"), F.col(place).alias("p")).filter("k is not null and n is not null")
    count = rows.count()
    shards = max(1, -(-count // shard))
    found = None
    for i in range(shards):
        own = rows if shards == 1 else rows.filter(F.pmod(F.xxhash64("k"), F.lit(shards)) == i)
        entries = tuple((r.k, r.n, r.p) for r in own.collect())  # about SHARD_ENTRIES at most

        def run(batches: Iterator[pd.DataFrame], entries=entries) -> Iterator[pd.DataFrame]:
            matcher = _matcher(entries, edits)
            for batch in batches:
                got = [matcher.best(v) for v in batch["value"]]
                yield pd.DataFrame({"value": batch["value"], "times": batch["times"], "entry": [g[1] for g in got], "edits": [g[0] for g in got]})

        def run_shard(batches: Iterator[pd.DataFrame], entries=entries) -> Iterator[pd.DataFrame]:
            matcher = _matcher(entries, edits)
            for batch in batches:
                yield pd.DataFrame([(v, *h) for v in batch["value"] for h in matcher.hits(v)], columns=["value", "way", "edits", "entry", "here", "text"])

        if shards == 1:
            return values.select("value", "times").mapInPandas(run, "value string, times bigint, entry bigint, edits int")
        part = values.select("value").mapInPandas(run_shard, "value string, way int, edits int, entry bigint, here boolean, text string")
        found = part if found is None else found.unionByName(part)
    return weighed(values, cut(found))


def weighed(values: DataFrame, found: DataFrame) -> DataFrame:
    """``value, times, entry, edits`` from the hits of all shards, in the order of ``Matcher.best``: exact before near before initials, then by edits, ties by the place beside the name."""
    said = found.filter(F.col("way") == PLACE_PART).select("value", F.lit(True).alias("said")).distinct()
    places = found.filter(F.col("way") == PLACE_TEXT).select("value", "text").distinct()
    hits = found.filter(F.col("way") <= INITIALS).join(places, ["value", "text"], "left_anti").join(said, "value", "left")
    hits = hits.filter((F.col("way") != INITIALS) | F.col("said").isNull() | F.col("here"))
    alike = hits.groupBy("value", "way", "edits").agg(F.collect_set("entry").alias("all"), F.collect_set(F.when(F.col("here"), F.col("entry"))).alias("here"))
    nearest = alike.groupBy("value").agg(F.min_by(F.struct("all", "here", "edits"), F.struct("way", "edits")).alias("x"))
    entry = F.when(F.size("x.all") == 1, F.get("x.all", F.lit(0))).when(F.size("x.here") == 1, F.get("x.here", F.lit(0)))
    out = values.join(nearest, "value", "left").select("value", "times", entry.alias("entry"), F.col("x.edits").alias("edits"))
    return out.select("value", "times", F.coalesce("entry", F.lit(NONE)).cast("bigint").alias("entry"), F.when(F.col("entry").isNull(), -1).otherwise(F.col("edits")).cast("int").alias("edits"))


def elements(records: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field, pos, value`` for each element of each array; null and empty arrays have none."""
    parts = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("values")) for f in fields))
    each = records.select(F.col(key).alias("key"), F.explode(parts).alias("x"))
    return each.select("key", "x.field", F.posexplode("x.values").alias("pos", "value"))


def canonicalized(records: DataFrame, reference: DataFrame, key: str = "record_id", fields: tuple[str, ...] = ("unique_affiliations", "canonical_affiliations"), **names) -> DataFrame:
    """``key, field, pos, entry, edits`` for each element of the array fields: the entry of the list it means, NONE (-1) if none.

    Null, empty and very long values, and values that two entries match equally well, get NONE;
    equal records give their rows each; empty tables give an empty result (an empty list gives
    NONE throughout); further columns are ignored. Values are looked up once each, however often
    they occur; the rows of very frequent ones are joined by broadcast, see ``join_groups``.
    """
    rows = elements(records, key, list(fields)).withColumn("value", F.coalesce("value", F.lit("")))
    counted = rows.groupBy("value").agg(F.count("*").alias("times"))
    table = cut(mapped(counted, reference, **names))
    return join_groups(rows, table, ["value"], "times").select(F.col("key").alias(key), "field", "pos", "entry", "edits")


def unmatched(mapping: DataFrame) -> DataFrame:
    """How many elements of each field found an entry: ``field, elements, exact, fuzzy, by_initials, unmatched``."""
    kind = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return mapping.groupBy("field").agg(F.count("*").alias("elements"), kind(F.col("edits") == 0).alias("exact"), kind((F.col("edits") > 0) & (F.col("edits") <= EDITS)).alias("fuzzy"), kind(F.col("edits") > EDITS).alias("by_initials"), kind(F.col("entry") == NONE).alias("unmatched"))
