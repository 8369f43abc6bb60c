"""The subpackage's operators against brute force, and on nulls, empty and very long texts, ties, repeated rows and empty tables."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import bktree, canonical, format_duplicates, fusion, linking, mixing, names, packing, repetition, subjects, tokens, trees, variants

LONG = "water " * 20_000


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# 1


def test_split_names():
    given = frozenset({"feng", "charles"})
    cases = {
        "Bonipakris UR": ("bonipakris", ("u", "r")), "Bonipakris, Bill": ("bonipakris", ("bill",)), "Dr. L. M. Neferitos": ("neferitos", ("l", "m")), "A. H. Luvibavis, Ph.D.": ("luvibavis", ("a", "h")),
        "Krifubafus Feng": ("krifubafus", ("feng",)), "JOSÉ NOLIBRADEL": ("nolibradel", ("jose",)), "EmekaD. Dikiluté": ("dikilute", ("emeka", "d")), "Feng Krukrubrivas Jr.": ("krukrubrivas", ("feng",)), "": ("", ()), "123": ("", ()),
    }
    assert {k: names.split_name(k, given)[:2] for k in cases} == cases


def test_alike():
    p = lambda t: names.split_name(t)[:2]
    for a, b in (("Bill Bonipakris", "Bonipakris, William"), ("Charles R Bonipakris", "Charles Robert Bonipakris"), ("Hana Luvibavis", "Hnaa Luvibavsi")):
        assert names.alike(p(a), p(b)) >= variants.ALIKE
    for a, b in (("Hana Luvibavis", "Lars Luvibavis"), ("Hana Luvibavis", "Hana Restanakun"), ("A. B. Luvibavis", "A. C. Luvibavis")):
        assert names.alike(p(a), p(b)) < variants.ALIKE


def test_collision_curve():
    b = variants.bands(0.5, 0.97, 3)
    assert 1 - (1 - 0.5**3) ** b >= 0.97 > 1 - (1 - 0.5**3) ** (b - 1)
    words = ["krukrubrivas", "krukrubrivsa", "bonipakris"]
    s = variants.signatures(words, 600)
    grams = [{f"^{w}$"[i : i + 2] for i in range(len(w) + 1)} for w in words]
    for i, j in ((0, 1), (0, 2)):
        assert abs((s[i] == s[j]).mean() - len(grams[i] & grams[j]) / len(grams[i] | grams[j])) < 0.08


def test_short_and_twice_misspelt_surnames_meet(spark):
    """Every pair of surnames of at most INDEXED letters that ``slips`` takes for one shares a bucket."""
    rng = random.Random(9)
    slip = lambda w, i: rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i] + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "q" + w[i + 1 :]])
    pairs = []
    while len(pairs) < 300:
        a = "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, variants.INDEXED)))
        b = slip(a, rng.randrange(len(a) - 1))
        b = slip(b, rng.randrange(len(b) - 1)) if len(a) > names.TWO_SLIPS else b
        if a != b and names.osa(a, b) <= names.slips(a, b) and max(len(a), len(b)) <= variants.INDEXED:
            pairs.append((a, b))
    df = spark.createDataFrame([(f"k|{w}", w) for w in {w for p in pairs for w in p}], "entry string, surname string")
    buckets = {}
    for r in variants.banded(df).collect():
        buckets.setdefault(r.entry, set()).add(r.band)
    assert not [(a, b) for a, b in pairs if not buckets[f"k|{a}"] & buckets[f"k|{b}"]]


def test_variants(spark):
    people = ["Katherine Zatélastel", "Kate Zatélastel", "ZATÉLASTEL, KATHERINE", "K. Zatélastel", "Kahterine Zatélastel", "Hiroshi Zatélastel", "H. Zatélastel", "Bresulusto Wetland Working Group", "Bresulusto Wetland Working Group (BWWG)", "Bresulusto WWG", "Working Group of the Bresulusto Wetland", "Bresulusto Levee Working Group", None, "", "  ", "Katherine Zatélastel", LONG]
    df = spark.createDataFrame([(p, 1) for p in people], "name string, cluster int")
    got = rows(variants.variants(variants.clusters(df)), "name_a", "name_b")
    groups = (people[:5], people[5:7], people[7:11])
    assert got == sorted(tuple(sorted(p)) for g in groups for p in itertools.combinations(g, 2))
    assert variants.clusters(df.limit(0)).count() == 0


def test_stars(spark):
    edges = [("hub", x, 0.9) for x in "abc"] + [("a", "b", 0.8), ("c", "far", 0.95), ("x", "y", 0.9)]
    df = spark.createDataFrame([(min(a, b), max(a, b), s) for a, b, s in edges], "a string, b string, score double")
    got = {r.node: r.centre for r in variants.stars(df).collect()}
    assert got["a"] == got["b"] == got["hub"] == "hub" and set(got) == {"hub", "a", "b", "c", "far", "x", "y"} and got["x"] == got["y"]
    near = {frozenset(e[:2]) for e in edges}
    assert all(n == c or frozenset((n, c)) in near for n, c in got.items())


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain of 4,000 equal links: the rounds grow with the logarithm, as ties are broken by hash."""
    written = []
    monkeypatch.setattr(variants, "cut", lambda df, own=variants.cut: written.append(1) or own(df))
    edges = spark.range(4000).selectExpr("concat('p|n', lpad(id, 5, '0'), '|x') a", "concat('p|n', lpad(id + 1, 5, '0'), '|x') b", "0.9D score")
    star = variants.stars(edges)
    assert star.count() == star.select("node").distinct().count() == 4001 and len(written) < 2 * 12 + 2


def test_many_given_names_under_one_surname(spark, monkeypatch):
    """Told apart by given names, names find the same links as if all were compared."""
    rng = random.Random(3)
    given = ["".join(rng.choice("aeioubdkrst") for _ in range(rng.randint(2, 10))) for _ in range(120)] + ["kate", "katherine", "kathy", "kathyr", "bob", "robert", "elizabethannamariatheodoralouise", "elizabethannamariatheodoraluise", "elizabethannamariatheodoralo", "k", "r", "k a"]
    given += [slipped(rng, g) for g in given if 3 < len(g) < 30]
    nodes = sorted({f"p|zorbal|{g}" for g in given} | {"p|zorbal|", "g|zorbal wetland group", "g|zorbal wetlnad group", "p|zorbal|w g"})
    keys = spark.createDataFrame([(n, e, "zorbal") for n in nodes for e in ("k|zorbal", "k|zorball")] + [(f"p|{g}|zorbal", "k|zorbal", "zorbal") for g in given[:60]], "node string, entry string, surname string")
    every, told = (rows(variants.links(keys, many=m)) for m in (10**9, 1))
    assert every == told and len(every) > 190


def test_crowded_surname(spark):
    """Twenty thousand given names under one surname and initial would make 200 million pairs; the compared ones grow with the names."""
    rng = random.Random(5)
    given = sorted({"k" + "".join(rng.choice("aeioubdgklmnprstvz") for _ in range(9)) for _ in range(20_000)})
    keys = spark.createDataFrame([(f"p|zorbal|{g}", "k|zorbal") for g in given], "node string, entry string")
    near = spark.createDataFrame([("k|zorbal", "k|zorbal")], "entry string, entry2 string")
    assert variants.among_many(near, keys).filter("a < b").distinct().count() < 20 * len(given)


# 2


def edits(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
    return d[len(a), len(b)]


def test_tree_against_brute_force():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(150)})
    tree = bktree.BKTree({w: [i] for i, w in enumerate(words)})
    for w in words[::7] + ["", "abcabcabcabcabc", "zz"]:
        for most in (0, 1, 2, 4):
            assert tree.within(w, most) == sorted((k, x) for x in words for k in [edits(w, x)] if k <= most)
    assert bktree.one_edit("abcd", "abdc") and bktree.one_edit("abc", "abxc") and bktree.one_edit("", "a") and not bktree.one_edit("abcd", "badc")


ENTRIES = [(1, "Halvern Department of Water Stewardship", "Tolvenas"), (2, "University of Skeporm", "Urosurk"), (3, "Dirkerrk Department of Natural Resources", "Napent"), (4, "Drilliz Department of Natural Resources", "Vellkat")]
TYPED = {
    "School of Environment, Halvern Dept. of Water Stewardsh. (Tolvenas)": 1, "H.D.W.S., Tolvenas": 1, "hdws": 1, "Université de Skeporm": 2, "Skeporm, University of; Urosurk, Halvern": 2, "Universität Skeporm": 2, "University of Skepomr": 2, "DDNR, Vellkat": 4, "DDNR": -1,
    "Department of Natural Resources, Napent": -1, "Tolvenas": -1, "University of Bransiz": -1, "Retired": -1, "": -1, LONG: -1, "The UNIVERSITY of Skeporm": 2,
}


@pytest.mark.parametrize("shard", [50_000, 1])
def test_mapping(spark, shard):
    df = spark.createDataFrame([(i, [t, t], None, "x") for i, t in enumerate(TYPED)] + [(99, None, [], "x"), (100, [None], None, "x")], "record_id long, unique_affiliations array<string>, canonical_affiliations array<string>, value string")
    ref = spark.createDataFrame(ENTRIES, "institution_id int, canonical string, city string")
    got = rows(canonical.canonicalized(df, ref, shard=shard), "record_id", "field", "pos", "entry")
    assert got == sorted([(i, "unique_affiliations", p, e) for i, e in enumerate(TYPED.values()) for p in (0, 1)] + [(100, "unique_affiliations", 0, -1)])
    assert canonical.canonicalized(df.limit(0), ref).count() == 0
    assert {r.entry for r in canonical.canonicalized(df, ref.limit(0)).collect()} == {-1}


@pytest.mark.parametrize("shard", [1, 2, 3])
def test_shards_make_no_difference(spark, shard):
    """Ties inside a shard and between shards, settled by place or not, as in one tree."""
    entries = [(1, "Northern Water Board", "Arvo"), (2, "Northern Water Board", "Belt"), (3, "Northern Water Bord", "Cray"), (4, "Southern River Institute", "Arvo"), (5, "Sandy Rock Institute", "Dell"), (6, "Southern Rivers Institute", "Belt"), (7, "Arvo Lake Trust", "Cray"), (8, "Arvo Lake Trust", "Eskerdale"), (9, "Eskerdale", "Belt"), (10, "Northern Water Board", None)]
    typed = ["Northern Water Board", "Northern Water Board, Belt", "Northern Water Bord", "Northern Water Boad, Cray", "Northern Water Boad, Arvo", "SRI", "SRI, Dell", "SRI, Belt", "S.R.I., Cray", "Southern River Institute, Belt", "Southern Riverr Institute", "Arvo Lake Trust", "Arvo Lake Trst, Eskerdale", "Eskerdale", "Eskerdale, Belt", "ALT, Cray", "NWB", "", "nothing"]
    values = spark.createDataFrame([(t, 1) for t in typed], "value string, times long")
    ref = spark.createDataFrame(entries, "institution_id int, canonical string, city string")
    tree = canonical.Matcher(entries)
    assert rows(canonical.mapped(values, ref, shard=shard), "value", "edits", "entry") == sorted((t, *tree.best(t)) for t in typed)


# 3

RECORD = "record_id long, doi string, doi_source string, title_openalex string, title_crossref string, abstract_crossref string, authors_crossref array<string>, authors array<string>, retrieved_at timestamp, field string"


def record(i, t, to=None, tc=None, ab=None, au=None, doi="10.1234/a1", n=2):
    from datetime import datetime

    return (i, doi, "manual", to, tc, ab, au, ["x"] * n, None if t is None else datetime(2024, 1, t), "f")


def test_best_values(spark):
    two = ["Ann Lee", "Bo Roe"]
    data = [
        record(1, 1, "Water and flow in X", "Water and flow in X", "A long text. It ends.", two), record(2, 2, "<i>Water</i> and flow in X", "Water and fl", "A long text. It", ["Ann Lee", "et al."]), record(3, 3, "Untitled", "Water and flow in X", None, ["Ann Lee"]),
        record(4, 4, "", None, "A long te�t. It ends.", ["Ann Lee", None]), record(5, 4, " ", "NA", "See full text.", ["Staff"]), record(6, 5, "Another title", None, "© 2020 P.", []),
        record(7, 1, "Alone", "Alone", "Whole.", two, "10.1234/b2"), record(8, 1, "T", None, None, None, "DOI:10.1234/C3 ", n=0), record(9, 1, "T", None, None, None, "10.1234/(c3)", n=0), record(10, None, "T", None, None, None, "10.1234/c3", n=0), record(11, 2, "X", None, None, None, "no doi"), record(12, 2, None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, RECORD)
    assert rows(fusion.best(df)) == sorted([(1, "title_openalex", 6), (1, "title_crossref", 3), (1, "abstract_crossref", 1), (1, "authors_crossref", 1), (8, "title_openalex", 8)])
    assert fusion.best(df.limit(0)).count() == 0
    (built,) = [r for r in fusion.survivors(df).collect() if r.first_record_id == 1]
    assert built.title_openalex == "Another title" and built.authors_crossref == two


def test_fusion_of_odd_rows(spark):
    """Texts of any length count whole, repeated rows and ties give the first key, rows of nulls give no row of their own, clashing columns are left alone."""
    cut = LONG[:-30]
    data = [record(5, 1, LONG + "ends", None, None, None), record(4, 1, LONG + "ends", None, None, None), record(6, 2, cut, None, None, None), record(7, 3), record(8, None), record(1, 9, doi="10.1234/z"), record(2, 9, doi="10.1234/z")]
    df = spark.createDataFrame(data, RECORD).selectExpr("*", "'x' core", "1 src", "2 h", "3 size", "4 p")
    assert rows(fusion.best(df)) == [(4, "title_openalex", 4)]
    assert fusion.survivors(df).count() == 1


def test_votes_are_counted_exactly(spark):
    """Each of 2,000 values has twelve different votes of one source and one that is repeated."""
    claimed = spark.range(2000).selectExpr("cast(id as string) core", "explode(sequence(0, 12)) v", "id").selectExpr("core", "id * 100 + v id", "timestamp'2024-01-01' t", "'s' source", "id * 100 + v % 12 print", "2L size", "0 longest", "1L h0", "cast(null as long) h1", "cast(null as long) h2", "cast(null as long) h3")
    got = fusion.votes(claimed).selectExpr("family", "h", "size(votes) n", "votes[0].src src", "votes[0].k k", "votes[0].at.neg + cast(core as long) * 100 first").distinct().collect()
    assert [tuple(r) for r in got] == [("title", 1, 1, "s/title_openalex", 12, 0)]


def test_frequent_texts_stand_in(spark):
    """An abstract and a title of more than 200 characters that forty works share stand in for missing ones."""
    title, abstract = "The same long heading of a series " * 7 + "ends here", "No description was supplied by the publisher of this work."
    data = [record(2 * i + j, 1, title, f"Title {i} of its own", abstract if i else "One abstract. It ends.", None, f"10.1234/s{i}") for i in range(40) for j in (1, 2)]
    got = {(r.field, r.first_record_id) for r in fusion.best(spark.createDataFrame(data, RECORD)).collect()}
    assert not [f for f, _ in got if f == "title_openalex"] and ("abstract_crossref", 1) in got
    data = [record(2 * i + j, 1, f"Title {i} of its own", None, abstract, None, f"10.1234/s{i}") for i in range(40) for j in (1, 2)]
    assert {r.field for r in fusion.best(spark.createDataFrame(data, RECORD)).collect()} == {"title_openalex"}


WORK = "Flow of water in basin {} at low stage"


def claimed(i, g, source, t, title):
    row = list(record(i, t, title, doi=f"10.1234/w{g}"))
    row[2] = source
    return tuple(row)


def copied_works(count, copier):
    """Works whose whole title one source has; another cuts two in five, and ``copier`` repeats it two times in three."""
    rng, data = random.Random(2), []
    for g in range(count):
        whole = WORK.format(g)
        cut = whole.rsplit(" ", rng.randint(1, 3))[0] if g % 5 < 2 else whole
        data += [claimed(10 * g, g, "careful", 1, whole), claimed(10 * g + 1, g, "hasty", 2, cut)]
        data += [claimed(10 * g + 2, g, copier, 3, cut)] if g % 3 else []
    return data


def test_a_copier_does_not_outvote_the_truth(spark):
    """What two sources say alike outvotes one while their dependence isn't known; once it is estimated, the copied cut titles lose."""
    data = copied_works(200, "copier")
    df = spark.createDataFrame(data, RECORD)
    expected = {}
    for g in range(200):
        own = [r for r in data if r[1] == f"10.1234/w{g}" and r[3] == WORK.format(g)]
        expected[10 * g] = max(own, key=lambda r: (r[8], -r[0]))[0]
    pick = lambda **k: {r.first_record_id: r.best_record_id for r in fusion.best(df, **k).collect()}
    assert pick() == expected
    blind = pick(rounds=0)
    assert sum(blind[g] != expected[g] for g in expected) > 30
    _, _, by = fusion.judged(df)
    dependence = {frozenset((r.a.split("/")[0], r.b.split("/")[0])): r.p for r in by.dependence.collect()}
    assert dependence[frozenset(("hasty", "copier"))] > 0.9 > 0.1 > dependence[frozenset(("careful", "hasty"))]
    accuracy = {r.src.split("/")[0]: r.a for r in by.accuracy.collect()}
    assert accuracy["careful"] > 0.9 > 0.8 > accuracy["hasty"]


def test_independent_votes_confirm_a_shorter_title(spark):
    """A shorter title that many sources of their own give is a whole one, though a longer one goes on with a word."""
    data = [claimed(10 * g + j, g, f"s{j}", 1 + j, WORK.format(g)) for g in range(30) for j in range(4)]
    data += [claimed(1000 + j, 99, f"s{j}", 1 + j, "Flow of water" if j < 3 else "Flow of water in winter") for j in range(4)] + [claimed(2000 + j, 98, f"s{j}", 9 - j, "Flow of water" if j < 1 else "Flow of water in winter") for j in range(4)]
    got = {r.first_record_id: r.best_record_id for r in fusion.best(spark.createDataFrame(data, RECORD)).collect()}
    v = {(r.core, len(r.votes)): r.p for r in fusion.judged(spark.createDataFrame(data, RECORD))[0].collect()}
    assert got[1000] == 1003 and got[2000] == 2001 and v["1234/w99", 3] > 0.5 > v["1234/w98", 1]


def test_many_sources(spark):
    """Forty sources, each with its own accuracy."""
    rng, data = random.Random(5), []
    for g in range(120):
        for j in rng.sample(range(40), 5):
            data.append(claimed(100 * g + j, g, f"s{j}", rng.randint(1, 28), WORK.format(g) if j % 4 or rng.random() < 0.4 else WORK.format(g)[: rng.randint(8, 30)] + "..."))
    df = spark.createDataFrame(data, RECORD)
    _, _, by = fusion.judged(df)
    accuracy = {int(r.src.split("/")[0][1:]): r.a for r in by.accuracy.collect()}
    assert len(accuracy) == 40 and min(a for j, a in accuracy.items() if j % 4) > 0.8 > max(a for j, a in accuracy.items() if j % 4 == 0)
    own = {r[0]: r[3] for r in data}
    assert all(own[r.best_record_id].endswith("stage") for r in fusion.best(df).collect())


def test_continuations_over_range_borders(spark):
    """In every split of the order a text finds what goes on beyond it, also in a group larger than a range."""
    texts = sorted({"ab"[i % 2] * (1 + i // 7) + "c" * (i % 3) for i in range(90)})
    rows_ = [(core, "title", t, fam_hash) for core in "xy" for fam_hash, t in enumerate(texts)]
    v = spark.createDataFrame([(*r, "none") for r in rows_], "core string, family string, value string, h long, sign string")
    got = {(r.core, r.h): r.rest for r in fusion.continued(v).collect()}
    more = {(c, h): [u for u in texts if u != t and u.startswith(t)] for c, _, t, h in rows_}
    assert set(got) == {k for k, m in more.items() if m} and all(texts[h] + rest in more[c, h] for (c, h), rest in got.items())


def test_signs_against_plain_patterns(spark):
    """The cheap screens let every value through that a pattern matches."""
    values = ["", " ", "Whole title", "A &lt;b&gt;c", "<i>A</i>", "A�B", "wa eqÃ©ivalent", "â€“", "&#x2013;r", "Cut...", "Cut …", "x [truncated]", "x (abridged)", "x [ more ] y", "Untitled", "[Title not available]", "(n/a)", " NA. ", "TBA", "See full text.", "© 2020 P.", "(c) 2020", "Copyright 2020", "By X. All rights reserved", "no title ....", "Anonymous", "Ends ", "---", "??", "Test", "Testing water", "<Not a tag", "a & b", "None of the above", LONG]
    df = spark.createDataFrame([(v,) for v in values], "value string").select("value", fusion.sign(F.col("value"), "title").alias("s"), *(F.btrim("value", F.lit(" \t\r\n")).rlike(p).alias(n) if n == "stand-in" else F.col("value").rlike(p).alias(n) for n, p in (("garbled", fusion.GARBLED), ("markup", fusion.MARKUP), ("omission", fusion.OMISSION), ("stand-in", f"{fusion.STAND_INS}|{fusion.NOTICE}"))))
    for r in df.collect():
        expected = "blank" if not r.value.strip(" ") else next((n for n in ("garbled", "markup", "omission", "stand-in") if r[n]), "no end" if r.value[-1].isspace() else "none")
        assert r.s == expected, r.value


# 4

SAME = ["10.90042/aosf.2025.58995853", "https://doi.example.org/10.90042 / (AOSF)202558995853", "info:doi/10.90042%2Faosf_2025_58995853.\r", "“10.90042/aosf​-2025–58995853”", "id=https://x/10.90042/aosf.2025.58995853&date=2020", "2024; 10.90042//aosf.2025.58995853", "10.90042%252Faosf.2025.58995853 ; 2020"]
OTHER = ["10.90042/aosf.2025.58995853v2", "10.90042/aosf.2025.58995853.s001", "10.90043/aosf.2025.58995853", "10.90042/aosf.2025.58995854"]
NONE = [None, "", "no doi yet", "10.555", "https://doi.example.org/", "10.90042/", "doi:", "10.90042/ . "]


def test_formatting(spark):
    data = [(i, t, "w") for i, t in enumerate([*SAME, *OTHER, *NONE, SAME[0]])]
    df = spark.createDataFrame(data, "id long, value string, _core string")
    got = rows(format_duplicates.copies(df))
    assert got == [(0, i, len(SAME) + 1) for i in [*range(1, len(SAME)), len(data) - 1]]
    assert format_duplicates.copies(df.limit(0)).count() == 0
    assert sorted(r.n_copies for r in format_duplicates.collapsed(df).collect()) == [1, 1, 1, 1, len(SAME) + 1]
    for hot in (1, 2):  # large classes are taken another way
        assert rows(format_duplicates.copies(df, most_hot=hot, hot_rows=2)) == got
    long = spark.createDataFrame([(1, LONG + "10.1234/a1"), (2, "10.1234/A1 " + LONG)], "id long, value string")
    assert rows(format_duplicates.copies(long)) == [(1, 2, 2)]


def dressed(rng, doi):
    """``doi`` written in some way: case, marks, blanks, encoding, label, resolver, quotes, other fields."""
    head, suffix = doi.split("/")
    suffix = "".join(rng.choice(["", "", "", ".", "-", "_", "–", "\u200b", " . ", "("]) + c for c in suffix) if rng.random() < 0.5 else suffix
    text = f"{head}{rng.choice(['/', '//', ' / ', '%2F', '%252F'])}{suffix}"
    text = rng.choice([str, str.upper, lambda t: t.replace("10.", "10 . ", 1)])(text)
    return rng.choice(["", "doi:", "https://doi.example.org/", "\u201c", "2024; ", "id=", "DOI ", "vol 10. 3; ", "\ufeff"]) + text + rng.choice(["", ".", "\u201d", "; 2020", "&date=2020", " ", "\r", ", p. 10.", "?x=1"])


def test_classes_lose_no_copy(spark):
    """Values with one core have one class, however they are written; what is found equals grouping by the core alone."""
    rng = random.Random(7)
    dois = [f"10.{rng.randint(1000, 999999)}/" + "".join(rng.choice("abc019") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    data = [(i, dressed(rng, rng.choice(dois))) for i in range(3000)] + [(5000 + i, t) for i, t in enumerate(NONE)]
    df = spark.createDataFrame(data, "id long, value string").select("*", format_duplicates.doi_core(F.col("value")).alias("core"), format_duplicates.doi_class(F.col("value")).alias("class"), format_duplicates.simple_letters(F.col("value")).alias("simple")).cache()
    found = df.filter("core is not null")
    assert found.groupBy("core").agg(F.countDistinct("class").alias("n")).filter("n <> 1").count() == 0 and found.filter("class is null").count() == 0
    assert found.filter("simple is not null and simple <> replace(core, '/', '')").count() == 0 and found.filter("simple is not null").count() > 400
    groups = {}
    for r in found.orderBy("id").collect():
        groups.setdefault(r.core, []).append(r.id)
    assert rows(format_duplicates.copies(df.select("id", "value"))) == sorted((g[0], i, len(g)) for g in groups.values() for i in g[1:])


# 5


def test_subjects(spark):
    terms = {"snow": "snow pillows; glacier retreat", "law": "water rights; court rulings"}
    data = [
        (1, "On <i>snow</i> pillows", "Glacier retreat went on."), (2, None, "Unlike studies of water rights, this one is of snow pillows and of SNOW&nbsp;PILLOWS."), (3, None, None), (4, "", "Nothing here; snow pillowset and xsnow pillows."), (5, "Court rulings, glacier retreat", "Snow pillows. Water rights."), (6, LONG, "snow pillows " * 3),
        (1, "On <i>snow</i> pillows", "Glacier retreat went on."),
    ]
    df = spark.createDataFrame([(*r, "z") for r in data], "record_id long, title string, abstract string, area string")
    labels = spark.createDataFrame([], "record_id long, second_level string")
    found = {(r.record_id, r.second_level) for r in subjects.assigned(df, labels, terms=terms).collect()}
    assert found >= {(1, "snow"), (2, "snow"), (5, "snow"), (5, "law")} and not any(k in (3, 4) or (k, a) == (2, "law") for k, a in found)
    assert subjects.assigned(df.limit(0), labels, terms=terms).count() == 0
    assert rows(subjects.unlabelled(df, spark.createDataFrame([(1, "snow")], "record_id long, second_level string"), terms=terms), "record_id")[0] == (2,)
    mix = subjects.composition(subjects.assigned(df, labels, terms=terms), spark.createDataFrame([("a ", "snow"), ("b", "law"), ("b", "none")], "first_level string, second_level string"))
    assert {r.second_level: r.records for r in mix.collect()}["none"] == 0


def test_threshold():
    score, true = np.array([3.0, 2.0, 1.0, 0.5]), np.array([True, True, False, False])
    assert subjects.threshold(score, true, 0) == 1.5


def test_thresholds_of_all_labels(spark):
    """The thresholds are those of all 24,000 labelled records; the last 4,000 in the order of hashes, which a sample lacks, are of another kind."""
    late = {r.id for r in spark.range(24000).orderBy(F.xxhash64("id").desc()).limit(4000).collect()}
    rng = random.Random(3)
    scores = [(i, a, rng.choice([rng.random() * (3 if a == "law" else 1), rng.randint(1, 8) / 8])) for i in range(24000) for a in ("law", "snow", "rare") if rng.random() < (0.002 if a == "rare" else 0.7)]
    truth = {(i, a) for i, a, s in scores if s + rng.gauss(0, 0.2) > (0.3 if i in late else 0.7)} | {(i, "law") for i in range(0, 24000, 50)}
    labels = [(i, a + " ") for i, a in truth] + [(i, "none") for i in range(24000)]
    got = subjects.calibrated(spark.createDataFrame(scores, "key long, area string, score double"), spark.createDataFrame(labels, "record_id long, second_level string"))

    def best(areas, missed):
        own = [(s, (i, a) in truth) for i, a, s in scores if a in areas]
        return subjects.threshold(np.array([s for s, _ in own]), np.array([t for _, t in own]), missed), len(own), sum(t for _, t in own)

    alone, _, n = best(("law", "snow", "rare"), len(truth - {(i, a) for i, a, _ in scores}) + 24000)
    whole = (alone * n + subjects.DEFAULT_THRESHOLD * subjects.FEW_LABELS) / (n + subjects.FEW_LABELS)
    expected = {"": whole}
    for a in ("law", "snow", "rare"):
        alone, pairs, n = best((a,), 0)
        if n >= subjects.OWN_LABELS:
            expected[a] = (alone * pairs + whole * subjects.OWN_LABELS) / (pairs + subjects.OWN_LABELS)
    assert "law" in expected and "rare" not in expected
    assert got.keys() == expected.keys() and all(abs(got[a] - t) < 1e-12 for a, t in expected.items())


# 6


def test_linking(spark):
    agency = "Halvern Department"
    mine, other, unknown = [("x", agency)], [("x", "Elsewhere")], [("x", None)]
    kind = "record_id long, authors array<string>, author_affiliations array<struct<author:string,canonical_affiliation:string>>, publication_year int, dwr_author boolean, dwr_lead_author boolean, name string"
    recs = [
        (1, ["K. Zatélastel"], mine, 2023, True, True, "n"), (2, ["Katherine Zatélastel"], other, 2023, False, False, "n"), (3, ["ZATELASTEL, KATE"], unknown, 2023, True, None, "n"), (4, ["Katherine Zatélastel"], mine, 2021, True, True, "n"), (5, ["Hana Luvibavis", None], None, 2023, True, True, "n"),
        (6, None, None, 2023, True, True, "n"), (7, ["Kahterine Zatélastel"], mine, None, True, True, "n"), (8, ["Katherine Zatélastel"], unknown, 2023, False, None, "n"), (1, ["K. Zatélastel"], mine, 2023, True, True, "n"), (9, [LONG, ""], None, 2023, True, True, "n"),
    ]
    staff = [(1, "Katherine Zatélastel", None, "FY2023"), (2, "katherine zatélastel", None, " 2023"), (3, "Hana Karabakrakran", "Luvibavis, Hana", "2023.0"), (4, None, None, "2023"), (5, "Katherine Zatélastel", None, None)]
    roster = spark.createDataFrame([(*s, 0) for s in staff], "roster_id long, employee_name string, employee_alternate_name string, year string, key int")
    df = spark.createDataFrame(recs, kind)
    got = linking.linked(df, roster, agency).collect()
    assert sorted((r.roster_id, r.record_id) for r in got) == [(1, 1), (1, 3), (2, 1), (2, 3), (3, 5)] and all(0 < r.confidence <= 1 for r in got)
    assert linking.linked(df.limit(0), roster, agency).count() == 0 and linking.linked(df, roster.limit(0), agency).count() == 0


def test_linking_reads_unsure_names_both_ways(spark):
    agency = "Halvern Department"
    authors = ["Mobrugetral Andrew N", "Vishiodral Mtthew", "Bresulusto Wetland Working Group"]
    kind = "record_id long, authors array<string>, author_affiliations array<struct<author:string,canonical_affiliation:string>>, publication_year int, dwr_author boolean, dwr_lead_author boolean"
    df = spark.createDataFrame([(i, [a], [(a, agency)], 2023, True, True) for i, a in enumerate(authors)], kind)
    staff = [(10, "Andrew N. Mobrugetral"), (11, "Matthew Vishiodral"), (12, "W. Bresulusto"), (13, "Matthew Mobrugetral")]
    roster = spark.createDataFrame([(*s, None, "2023") for s in staff], "roster_id long, employee_name string, employee_alternate_name string, year string")
    assert rows(linking.linked(df, roster, agency), "roster_id", "record_id") == [(10, 0), (11, 1)]


def slipped(rng, w):
    i = rng.randrange(len(w) - 1)
    return rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i] + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + rng.choice("aeiou") + w[i + 1 :]])


def test_hashing_recall():
    """Attributes one slip apart share a bucket in 97 of 100 cases, one pair of others in ten at most does; without the walks' vectors far fewer do."""
    rng = random.Random(4)
    syllables = [c + v for c in ["k", "r", "b", "t", "z", "v", "n", "st", "kr", "l", "m", "d", "p", "s", "g"] for v in "aeiou"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(3, 5))) for _ in range(600)]
    own, slips = [f"k|{w}" for w in words], [f"k|{slipped(rng, w)}" for w in words]
    edges = [(f"r{i}", x) for i in range(600) for x in (own[i], slips[i - 1], f"y={2015 + i % 9}", "e=own")]
    vectors = linking.train(own + slips, edges)
    planes = linking.planes_for(1200)
    met = lambda v, x, y: (v.buckets(x, planes, linking.tables_for(planes)) == v.buckets(y, planes, linking.tables_for(planes))).any(axis=1).mean()
    assert met(vectors, own, slips) >= 0.97
    others = rng.sample(own, 600)
    assert met(vectors, own, others) < 0.1
    bare = linking.Vectors({}, np.zeros((0, linking.TRAINED)), np.zeros(0), np.zeros(linking.TRAINED + linking.IDENTITY))
    assert met(bare, own, slips) < met(vectors, own, slips) - 0.05


def test_planes_and_tables():
    """A plane more for twice the attributes; the tables keep the recall."""
    assert [linking.planes_for(n) for n in (0, 1, 1000, 2000, 10**9)] == [8, 8, 10, 11, 30]
    for planes in (8, 12, 20):
        t, same = linking.tables_for(planes), (1 - np.arccos(linking.LIKENESS) / np.pi) ** planes
        assert 1 - (1 - same) ** t >= linking.RECALL > 1 - (1 - same) ** (t - 1)


def test_confidence_is_fitted_to_second_spellings(spark):
    """Of candidates with equal likeness those with a second spelling of another person make the curve say so."""
    same = spark.createDataFrame([(f"Ann Lee{chr(97 + i % 26)}ron", f"A Lee{chr(97 + i % 26)}ron", 0.9 - 0.4 * (i % 2), 0.9, i) for i in range(400)], "a string, b string, cosine double, likeness double, i int")
    own = same.selectExpr("b name", "case when i % 2 = 0 then a else concat('Zoe ', split(a, ' ')[1]) end second")
    constant, slope, weight = linking.calibration(same.drop("i"), own)
    p = lambda c: 1 / (1 + np.exp(-(constant + slope * c + weight * 0.9)))
    assert p(0.9) > 0.5 > p(0.5)
    assert linking.calibration(same.drop("i"), own.limit(0)) == linking.PRIOR


def test_given_names_are_counted_over_all(spark):
    """A token is known as a given name by where it stands, however many others are more frequent."""
    typed = [f"Name{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)} Zorbal" for i in range(6000) for _ in range(1)] + ["Lars Omdahl", "Lars Karst", "Lars Enberg", "Lindqvist Lars", None, ""]
    got = {r.name: r.given for r in names.with_given(spark.createDataFrame([(t,) for t in typed], "name string")).collect()}
    assert got["Lindqvist Lars"] == ["lars"] and got["Lars Karst"] == ["lars"] and got[""] is None and None not in got
    assert names.split_name("Lindqvist Lars", frozenset(got["Lindqvist Lars"]))[:2] == ("lindqvist", ("lars",))


# 8


def test_best_fit_against_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        capacity = rng.randint(1, 40)
        sizes = np.array([rng.randint(0, capacity) for _ in range(rng.randint(0, 60))], int)
        rooms, expected = [], []
        for i in np.argsort(-sizes, kind="stable"):
            fit = [r for r in rooms if r[0] >= sizes[i]]
            tight = min((r[0] for r in fit), default=None)
            if tight is None:
                rooms.append([capacity - sizes[i]])
            else:
                next(r for r in fit if r[0] == tight)[0] -= sizes[i]
            expected.append(sorted(r[0] for r in rooms))
        got = packing.best_fit_decreasing(sizes, capacity)
        used = np.bincount(got, sizes, minlength=len(rooms)) if len(sizes) else np.zeros(0)
        assert sorted(capacity - used) == (expected[-1] if expected else [])


def test_packing(spark):
    texts = ["one two three", "", None, LONG, "one two three", "x"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, bin int")
    kinds = spark.createDataFrame([("a", 8), ("b", 5000), ("none", 0), ("null", None)], "container string, capacity_tokens int")
    got = packing.packed(df, kinds, shard_items=3).collect()
    size = {r.doc_id: r.n for r in df.select("doc_id", tokens.token_count(F.col("text")).alias("n")).collect()}
    for kind, capacity in (("a", 8), ("b", 5000)):
        own = [r for r in got if r.container == kind]
        assert {d: sum(r.tokens for r in own if r.doc == d) for d in size} == size
        assert all(sum(r.tokens for r in own if (r.shard, r.bin) == b) <= capacity for b in {(r.shard, r.bin) for r in own})
        assert all(len([r for r in own if r.doc == d]) == max(1, -(-n // capacity)) for d, n in size.items())
    assert packing.packed(df.limit(0), kinds).count() == 0 and packing.packed(df, kinds.limit(0)).count() == 0
    assert {r.container for r in packing.report(packing.packed(df, kinds), kinds).collect()} == {"a", "b"}


# 9


def test_permutation():
    for n in (1, 2, 3, 100, 1000):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 7))
        assert sorted(got) == list(range(n))
    assert (mixing.permuted(np.arange(100), np.full(100, 100), np.full(100, 8)) != mixing.permuted(np.arange(100), np.full(100, 100), np.full(100, 9))).any()


def test_wanted():
    have = {"a": 100, "b": 30, "c": 10, "d": 5}
    targets = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 9), ("d", 0.0, 1), ("e", 0.5, 3)]
    assert mixing.wanted(targets, have, None) == {"a": 100, "b": 60, "c": 40}
    assert mixing.wanted([("a", 0.5, 1), ("b", 0.5, 1)], {"a": 10, "b": 2}, 20) == {"a": 10, "b": 2}
    assert mixing.wanted([("a", 1.0, 1)], {}, None) == {}
    large = mixing.wanted(targets, {k: v * 10**10 for k, v in have.items()}, None)  # shares are the same at any size
    assert large == {"a": 100 * 10**10, "b": 60 * 10**10, "c": 40 * 10**10}


def test_draws_are_multinomial_held_to_totals():
    """Every ordinal of a source comes once; the counts of shards scatter as draws without replacement do, on both sides of 10^9 slots."""
    want = [3000, 1500, 500]
    which, ordinal = mixing.drawn(np.arange(5000), want, 3)
    assert all(sorted(ordinal[which == i]) == list(range(n)) for i, n in enumerate(want))
    for scale in (1, 10**6, 10**8):  # up to 5 * 10^11 slots
        part = [mixing.drawn(np.arange(100) + 100 * scale * k, [n * scale for n in want], 5)[0] for k in range(50)]
        counts = np.array([np.bincount(x, minlength=3) for x in part])
        assert (abs(counts.mean(axis=0) - [60, 30, 10]) < [2.5, 2.5, 1.6]).all() and (abs(counts.var(axis=0) / [24, 21, 9] - 1) < 0.6).all()


def test_mixing(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))), "small" if i % 10 == 0 else "big", 0) for i in range(200)] + [(500, None, "big", 0), (501, "", "small", 0), (502, "x y", None, 0), (503, "x y", "else", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, block int")
    targets = spark.createDataFrame([("small", 0.4, 3), ("big", 0.6, 1), ("missing", 0.0, 2)], "source string, target_share double, max_repeats int")
    got = mixing.mixed(df, targets, block=8).collect()
    uses = {}
    for r in got:
        for t in range(r.first_token, r.first_token + r.tokens):
            uses[r.doc, t] = uses.get((r.doc, t), 0) + 1
    own = {d: s for d, _, s, _ in docs}
    assert max(v for (d, _), v in uses.items() if own[d] == "small") == 3 and max(v for (d, _), v in uses.items() if own[d] == "big") == 1
    share = {r.source: r.share for r in mixing.shares(mixing.mixed(df, targets, block=8), targets).collect()}
    assert abs(share["small"] - 0.4) < 0.02 and share["missing"] == 0
    assert mixing.mixed(df.limit(0), targets).count() == 0


def test_small_sources_dont_shrink_the_mixture(spark):
    """All blocks' worth is mixed; a source too small for its share is used up to its cap and reported, and the others get the rest."""
    targets = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("none", 0.1, 1)]
    assert mixing.wanted(targets, {"a": 100, "b": 60, "c": 1}, None, whole=True) == {"a": 98, "b": 59, "c": 4}
    assert mixing.wanted(targets, {"a": 10, "b": 100, "c": 1}, None, whole=True) == {"a": 10, "b": 97, "c": 4}
    docs = [(i, " ".join("abcdefgh"[(i + j) % 8] for j in range(16)), "small" if i == 0 else "big") for i in range(101)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    wanted = spark.createDataFrame([("small", 0.4, 2), ("big", 0.6, 1), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    got = {r.source: r for r in mixing.reported(df, wanted, block=8, whole=True).collect()}
    assert sum(r.available for r in got.values()) - 16 <= sum(r.tokens for r in got.values()) <= sum(r.available for r in got.values())
    assert got["small"].used == 1 and got["small"].most_uses == 2 and got["big"].used > 0.98 and got["none"].used is None
    assert abs(got["small"].shortfall - (0.4 - got["small"].share)) < 1e-9 and got["small"].shortfall > 0.37 and got["big"].shortfall == 0


# 10


def brute_share(text, run=8):
    w = repetition.words(text)
    covered = set()
    for i in range(len(w) - run + 1):
        if any(w[j : j + run] == w[i : i + run] for j in range(i)):
            covered.update(range(i, i + run))
    return len(covered) / len(w) if w else 0.0


def test_repetition_against_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        text = " ".join(rng.choice(["a", "b", "3", "C,"]) for _ in range(rng.randint(0, 60)))
        assert abs(repetition.repeated_share(text) - brute_share(text)) < 1e-9


def test_repetitive(spark):
    one = "the river rose by many feet over that long night. "
    other = "each of these words stands here only once and never comes back again to anyone who reads it. "
    data = [(1, one + one), (2, other), (3, None), (4, ""), (5, other + one + one.upper().replace("feet", "12 feet!")), (6, LONG), (7, one + one), (8, "9 " * 50)] + [(100 + i, f"{other} {i} " + "".join(chr(97 + (i * j) % 26) for j in range(30))) for i in range(40)]
    df = spark.createDataFrame([(k, t, 0.0) for k, t in data], "doc_id long, text string, score double")
    assert rows(repetition.repetitive(df), "doc_id") == [(k,) for k, t in data if brute_share(t[:3000] if t else "") >= 0.3]
    assert repetition.repetitive(df.limit(0)).count() == 0


def made_documents(rng, count):
    data = []
    for i in range(count):
        w = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(8, 200))]
        kind, n = rng.randrange(4), rng.randint(0, len(w))
        data.append((i, " ".join([w + w[:n], w * rng.randint(1, 4), w[:n] + w + w[:n], w][kind])))
    return data


def test_trees_find_what_they_have_not_seen(spark):
    """Trained on 300 of 3,000 documents, the trees find 99 of 100 repetitive ones, and none that isn't."""
    data = made_documents(random.Random(12), 3000)
    df = spark.createDataFrame(data, "doc_id long, text string")
    expected = {i for i, t in data if repetition.repeated_share(t) >= 0.3}
    got = {r.doc_id: r for r in repetition.repetitive(df, sample=300).collect()}
    assert 500 < len(expected) < 2500 and set(got) <= expected and len(got) >= 0.99 * len(expected)
    assert all(abs(r.share - repetition.repeated_share(dict(data)[k])) < 1e-12 for k, r in got.items())


def test_the_trees_decide(spark, monkeypatch):
    """No document is found past the trees."""

    class Clearing:
        def score(self, x):
            return np.zeros(len(x))

    monkeypatch.setattr(repetition, "train", lambda *_: (Clearing(), 0.5))
    assert repetition.repetitive(spark.createDataFrame(made_documents(random.Random(1), 40), "doc_id long, text string")).count() == 0


def test_monotone_trees():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] + 0.3 * rng.standard_normal(2000) - 0.5 * x[:, 1]) > 0.3).astype(float)
    model = trees.fit(x, y, (1, -1, 0))
    assert ((model.score(x) > 0.5) == y).mean() > 0.75
    for f, sign in ((0, 1), (1, -1)):
        grid = np.repeat(x[:50], 20, axis=0)
        grid[:, f] = np.tile(np.linspace(0, 1, 20), 50)
        steps = np.diff(model.score(grid).reshape(50, 20), axis=1) * sign
        assert (steps >= -1e-12).all()


def test_repetition_of_a_rare_kind(spark):
    """A few documents repeat themselves in runs of eight words, the others whole, not at all or in runs of seven; the few lie last in the order of hashes, so that a sample lacks them."""
    rng = random.Random(5)

    def fresh(n):
        return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]

    def scattered():
        w = fresh(64)
        return " ".join(w[:50] + [x for i in (0, 17, 34) for x in (*w[i : i + 8], w[50 + i // 17])] + w[:8])

    def common():
        w = fresh(60)
        return " ".join(rng.choice([w, w + w, w + [x for i in range(0, 49, 7) for x in (*w[i : i + 7], *fresh(1))] + w[5:14]]))

    ids = [r.id for r in spark.range(3600).orderBy(F.xxhash64("id")).collect()]
    df = spark.createDataFrame([(i, common()) for i in ids[:-8]] + [(i, scattered()) for i in ids[-8:]], "doc_id long, text string")
    expected = {r.doc_id for r in df.collect() if repetition.repeated_share(r.text) >= repetition.SHARE}
    assert expected >= set(ids[-8:]) and {r.doc_id for r in repetition.repetitive(df).collect()} == expected
