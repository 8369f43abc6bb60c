"""Names typed by people: their parts, and how alike two names are."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import latin_ascii
from sluiceway.operators.skew import join_groups

#: Letters from which a word may be two edits from its like, not one.
TWO_SLIPS = 8

NICKNAMES = {
    nick: full
    for full, nicks in {
        "abigail": "abby abbie gail", "alexander": "alex alec sasha xander", "andrew": "andy drew", "anthony": "tony", "barbara": "barb barbie babs", "benjamin": "ben benny benji", "charles": "charlie chuck chas chaz",
        "christopher": "chris kit topher", "daniel": "dan danny", "deborah": "deb debbie debby", "edward": "ed eddie ted teddy ned", "elizabeth": "liz beth lizzie betty eliza betsy", "francisco": "paco pancho frank",
        "gabriela": "gaby gabby", "gregory": "greg", "isabella": "bella izzy", "james": "jim jimmy jamie", "jeffrey": "jeff geoff", "jennifer": "jen jenny jenn", "joseph": "joe joey", "katherine": "kate kathy katie kat kay",
        "kenneth": "ken kenny", "lawrence": "larry", "margaret": "peggy maggie meg marge", "matthew": "matt", "michael": "mike mick mickey", "nicholas": "nick nicky", "patricia": "pat patty trish tricia",
        "philip": "phil", "raymond": "ray", "rebecca": "becky becca", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert", "ronald": "ron ronnie", "samuel": "sam sammy", "steven": "steve",
        "susan": "sue susie suzy", "theodore": "theo", "thomas": "tom tommy", "timothy": "tim timmy", "victoria": "vicky vicki tori", "william": "bill will billy willy liam", "stephen": "steph",
    }.items()
    for nick in nicks.split()
}
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "hon", "rev", "eng", "ing"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "phd", "md", "pe", "pg", "msc", "bsc", "dsc", "esq", "mph", "dphil", "scd", "ms", "ma"}
GROUP = {"group", "team", "consortium", "committee", "program", "programme", "network", "collaboration", "project", "initiative", "partnership", "council", "commission", "center", "centre", "institute", "survey", "laboratory", "department", "panel", "board", "society", "association", "agency", "office", "division", "unit", "union", "alliance", "forum", "service"}
GROUP_SHORT = {"grp": "group", "gp": "group", "cons": "consortium", "consort": "consortium", "comm": "committee", "cttee": "committee", "prog": "program", "programme": "program", "mon": "monitoring", "res": "research", "tech": "technical", "sci": "science", "wkg": "working", "work": "working", "ctr": "center", "centre": "center", "&": "and", "tm": "team"}
WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Without accents and invisible characters; case kept."""
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")


def group_words(text: str) -> list[str] | None:
    """The words of a group's name in one spelling; null for a person's."""
    bare = re.sub(r"\([^()]*\)", " ", text.casefold())
    kind, of, topic = bare.partition(" of the ")
    if of and GROUP.intersection(re.findall(r"[a-z]+", kind)):  # "Working Group of the X" is the "X Working Group"
        bare = f"{topic} {kind}"
    words = [GROUP_SHORT.get(w, w) for w in re.findall(r"[^\W\d_]+|&", bare)]
    if len(words) >= 3 and GROUP.intersection(words):
        return [w for w in words if w not in ("the", "of", "and", "for")]
    return None


def initials_of(words: list[str]) -> str:
    return "".join(w[0] for w in words)


def split_name(text: str, given: frozenset[str] = frozenset()) -> tuple[str, tuple[str, ...], bool]:
    """A person's name as (surname, given names and initials, sure of the order), folded and in lower case.

    "Last, First M." is told by the comma, "Last F. M." by the initials at the end, "Last First" by
    ``given``, the tokens known as given names. Titles, suffixes and marks are dropped.
    """
    text = re.sub(r"(?<=[^\W\d_])(?<![A-Z])([A-Z])(?=\.?(?:\s|,|$))", r" \1", fold(text))
    parts = [[w for w in WORD.findall(p.replace("'", "").replace("’", ""))] for p in re.sub(r"\b(?:Ph\.?\s?D|M\.?D|P\.?E|P\.?G|Sc\.?D)\b\.?", " ", text, flags=re.I).split(",")]
    parts = [[w for w in p if w.casefold() not in TITLES and w.casefold() not in SUFFIXES or (len(w) <= 2 and w.isupper() and len(p) > 1 and w.casefold() not in ("jr", "sr", "dr"))] for p in parts]
    parts = [p for p in parts if p]
    if not parts:
        return "", (), True
    short = lambda w: len(w) == 1 or (len(w) <= 5 and w.isupper() and not re.search(r"[AEIOUY]", w[1:]) or len(w) == 2 and w.isupper())
    spread = lambda ws, loud: tuple(x for w in ws for x in (list(w.casefold()) if short(w) and not loud else [w.casefold()]))
    loud = all(w.isupper() for p in parts for w in p)
    if len(parts) == 1 and len(parts[0]) == 2 and len(parts[0][1]) == 2 and text == text.lower() and len(parts[0][0]) > 3:
        return parts[0][0].casefold(), tuple(parts[0][1].casefold()), True  # "smith jk"
    if len(parts) > 1:
        return "".join(parts[0]).casefold(), spread([w for p in parts[1:] for w in p], loud and max(len(w) for p in parts[1:] for w in p) > 3), True
    words = parts[0]
    if len(words) == 1:
        return words[0].casefold(), (), True
    tail = [i for i, w in enumerate(words) if len(w) > 1 and not (short(w) and i > 0 and (not loud or len(w) <= 2))]
    if tail and tail[-1] == 0:  # a long word, then initials only
        return words[0].casefold(), spread(words[1:], False), True
    first, last = words[0].casefold(), words[-1].casefold()
    a, b = len(first) == 1 or first in given or first in NICKNAMES, last in given or last in NICKNAMES
    if b and not a:
        return first, spread(words[1:], loud), True
    return last, spread(words[:-1], loud), a


def readings(text: str, given: frozenset[str] = frozenset()) -> list[tuple[str, tuple[str, ...]]]:
    """(surname, given names) of a name in the order ``split_name`` takes it for and, where that isn't sure, the other way round; one of a group's name."""
    surname, own, sure = split_name(text, given)
    if sure or not own or group_words(fold(text)):
        return [(surname, own)]
    return [(surname, own), (own[0], (*own[1:], surname))]


def osa(a: str, b: str, most: int = 3) -> int:
    """Edits between two words, a swap of neighbours being one; ``most`` + 1 if more than ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            k = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                k = min(k, before[j - 2] + 1)
            new.append(k)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


@lru_cache(maxsize=500_000)
def token_similarity(a: str, b: str) -> float:
    """1 for equal tokens or a name and its nickname; 0.9 for a name and its initial; else by edits, 0 below 0.65."""
    if a == b:
        return 1.0
    fa, fb = NICKNAMES.get(a, a), NICKNAMES.get(b, b)
    if fa == fb:
        return 1.0
    if NICKNAMES.get(a[:-1]) == fb or NICKNAMES.get(b[:-1]) == fa:  # an initial stuck to it
        return 0.95
    if len(a) == 1 or len(b) == 1:
        return 0.9 if a[0] == b[0] or fa[0] == fb[0] else 0.0
    s = max(_by_edits(a, b), _by_edits(fa, fb))
    return s if s >= 0.65 else 0.0


def slips(a: str, b: str) -> int:
    """Edits that two spellings of one word of this length may be apart."""
    return 2 if min(len(a), len(b)) >= TWO_SLIPS else 1


def _by_edits(a: str, b: str) -> float:
    d = osa(a, b, 2)
    return 1 - d / max(len(a), len(b)) if d <= slips(a, b) else 0.0


def monge_elkan(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """The mean, over the tokens of the shorter name, of each one's best likeness in the other."""
    if len(a) > len(b):
        a, b = b, a
    return sum(max(token_similarity(x, y) for y in b) for x in a) / len(a) if a else 0.0


def alike(a: tuple[str, tuple[str, ...]], b: tuple[str, tuple[str, ...]]) -> float:
    """Monge-Elkan likeness of two split names; 0 if surnames or first given names contradict each other."""
    (sa, ga), (sb, gb) = a, b
    d = osa(sa, sb, 2)
    if d > slips(sa, sb):
        return 0.0
    surname = 1 - d / max(len(sa), len(sb))
    if not ga or not gb:
        return 0.0 if bool(ga) != bool(gb) else surname
    if token_similarity(ga[0], gb[0]) < 0.65:
        return 0.0
    n = min(len(ga), len(gb))
    return (monge_elkan(ga, gb) * n + surname) / (n + 1)


def known_given(names: DataFrame, column: str = "name") -> DataFrame:
    """``t, g``: tokens that stand where given names stand, and how often; counted over all names.

    "Last, First" shows the order for sure and counts three times.
    """
    plain = F.regexp_replace(F.lower(latin_ascii(F.col(column))), r"[^\p{L}, ]", " ")
    comma = F.contains(plain, F.lit(","))
    tokens = lambda c: F.filter(F.split(F.trim(c), r"\s+"), lambda x: F.length(x) > 2)
    back, front = tokens(F.substring_index(plain, ",", 1)), tokens(F.substring_index(plain, ",", -1))
    first, last = F.when(comma, F.get(front, F.lit(0))).otherwise(F.get(back, F.lit(0))), F.when(comma, F.get(back, F.lit(0))).otherwise(F.try_element_at(back, F.lit(-1)))
    weight = F.when(comma, 3).otherwise(1)
    each = names.filter(F.col(column).isNotNull() & (F.size(back) > F.when(comma, 0).otherwise(1))).select(F.explode(F.array(F.struct(first.alias("t"), weight.alias("g"), F.lit(0).alias("s")), F.struct(last.alias("t"), F.lit(0).alias("g"), weight.alias("s")))).alias("x"))
    return each.filter("x.t is not null").groupBy("x.t").agg(F.sum("x.g").alias("g"), F.sum("x.s").alias("s")).filter("g >= 3 and g > 2 * s").select("t", "g")


def with_given(names: DataFrame) -> DataFrame:
    """``name, given``: each different name with those of its words that are known as given names (null without any). A word that a large share of the names has is joined by broadcast."""
    distinct = names.select("name").filter("name is not null").distinct()
    words = F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(latin_ascii(F.col("name"))), "['\u2019]", ""), r"[^\p{L}]+"), lambda x: F.length(x) > 2))
    found = join_groups(distinct.select("name", F.explode(words).alias("t")), known_given(distinct), ["t"], "g")
    return distinct.join(found.groupBy("name").agg(F.collect_set("t").alias("given")), "name", "left")
