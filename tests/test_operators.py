"""The core's operators on small tables."""


import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.operators import authors as A
from sluiceway.operators import fuzzy, harmonize, lanes, overrides, predicates, registry, shredding
from sluiceway.operators.skew import join_groups
from sluiceway.sources import fetch, readers, sinks

AUTHOR = "array<struct<name:string,literal:string,given:string,family:string,affiliation:array<string>>>"


def people(*affiliations, name="A"):
    return [(None, None, name, str(i), None if a is None else [a]) for i, a in enumerate(affiliations)]


@pytest.mark.parametrize(
    ("author", "compat", "flags"),
    [
        (people("Org", "Univ"), False, (True, True, False)), (people("Univ", "Org"), False, (True, False, False)), (people("Org", "Org"), False, (True, True, True)), (people("Org", None), False, (True, True, True)),
        ([(None, None, "A", "0", ["Org"]), (None, None, "A", "1", [None])], True, (True, True, False)), (people("Univ", name="Org Team"), False, (True, False, False)), ([], False, (False, False, False)), (None, False, (False, False, False)),
    ],
)
def test_roles(spark, author, compat, flags):
    roles = predicates.crossref_roles(F.col("a"), "org", compat)
    assert tuple(spark.createDataFrame([(author,)], f"a {AUTHOR}").select(*(roles[r] for r in predicates.ROLES)).first()) == flags


def test_flag_names():
    assert predicates.flag_names("dwr_author", predicates.ROLES) == {"any": "dwr_author", "lead": "dwr_lead_author", "sole": "dwr_sole_author"}
    assert predicates.flag_names("flag", ("any", "sole")) == {"any": "flag", "sole": "flag_sole"}
    for bad in ({"any": "x"}, ["a", "b"]):
        with pytest.raises(ValueError):
            predicates.flag_names(bad, predicates.ROLES)


def test_registry(spark):
    sources = {"manual": ["10.1234/a", "10.1234/A", "x"], "crossref": ["10.1234/a", "10.5555/b"], "openalex": ["10.5555/B", "10.7777/c", None]}
    got = registry.doi_registry({k: spark.createDataFrame([(v,) for v in vs], "doi string") for k, vs in sources.items()})
    assert {tuple(r) for r in got.collect()} == {("10.1234/A", "manual"), ("10.5555/B", "crossref"), ("10.7777/C", "openalex")}


def test_extract(spark):
    df = spark.createDataFrame([("10.1234/a",), ("10.1234/A",), (None,)], "doi string")
    assert [r.doi for r in registry.extract_dois(df).collect()] == ["10.1234/A"]
    with pytest.warns(UserWarning):
        assert registry.extract_dois(df, "id").count() == 0
    with pytest.raises(ValueError):
        registry.extract_dois(df, "id", strict=True)


def test_chunks(spark):
    got = registry.chunked(spark.range(10).withColumnRenamed("id", "i"), "i", 4).orderBy("i").collect()
    assert [r.chunk for r in got] == [0] * 4 + [1] * 4 + [2] * 2
    assert registry.chunk_list(list(range(5)), 2) == [[0, 1], [2, 3], [4]] and registry.or_else(None, 3) == 3 and registry.or_else(0, 3) == 0


def test_names_and_affiliations(spark):
    df = spark.createDataFrame([([("Org", " ", None, None, None), (None, None, "Ann", "Lee", [" x ", "y"]), (None, None, None, None, None), (None, None, "Ann", "Lee", [])],), (None,)], f"a {AUTHOR}")
    got = df.select(A.crossref_author_names(F.col("a")).alias("n"), A.crossref_pairs(F.col("a")).alias("p")).collect()
    assert got[0].n == ["Org", "Ann Lee"] and [tuple(p) for p in got[0].p] == [("Org", None), ("Ann Lee", "x"), ("Ann Lee", None)]
    assert got[1].n == [] and got[1].p is None


def test_coalescing(spark):
    df = spark.createDataFrame([([None], ["b"]), ([], ["b"]), (None, ["b"]), (["a", None], ["b"]), (None, None)], "a array<string>, b array<string>")
    assert [r.x for r in df.select(harmonize.first_list(F.col("a"), F.col("b")).alias("x")).collect()] == [["b"], ["b"], ["b"], ["a", None], None]


def test_harmonized_crowded(spark):
    """A DOI with many rows in both sources, and with many in one only: all pairs once, and not all of them in one task."""
    a = [("x", i) for i in range(300)] + [("only", i) for i in range(300)] + [("y", 1), ("y", 2), (None, 3), ("z", 4)]
    b = [("x", i) for i in range(200)] + [("rest", i) for i in range(300)] + [("y", 5), (None, 6), (None, 7), ("w", 8)]
    first, second = spark.createDataFrame(a, "doi string, oa_status int"), spark.createDataFrame(b, "doi string, volume int")
    known = spark.createDataFrame([("x", "m"), ("y", "n"), ("w", "n"), ("v", "n")], "doi string, doi_source string")
    source = dict(known.collect())
    wanted = [(k, v, i, source.get(k)) for k, i in a for v in ([w for j, w in b if j == k and k] or [None])]
    wanted += [(k, v, None, source.get(k)) for k, v in b if not k or k not in {j for j, _ in a}]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = harmonize.harmonized(first, second).select("doi", F.spark_partition_id().alias("at")).filter("doi = 'x'").groupBy("at").count().collect()
        assert sum(r["count"] for r in plain) == 60_000 and max(r["count"] for r in plain) < 60_000
        for side in (16, 128, 1000):
            out = harmonize.harmonized(first, second, known=known, side=side)
            got = out.select("doi", "volume", "oa_status", "doi_source", F.spark_partition_id().alias("at")).collect()
            assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(map(str, wanted)), side
            tasks = [sum(r.at == n for r in got if r.doi == "x") for n in range(4)]
            assert side > 200 or max(tasks) < 45_000, tasks
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replacements(spark):
    df = spark.createDataFrame([(["A", "B", "C", None],)], "n array<string>")
    assert df.select(overrides.replace_names(F.col("n"), [("A", "B"), ("B", "D")])).first()[0] == ["D", "D", "C", None]
    assert df.select(overrides.replace_names(F.col("n"), [("B", "D"), ("A", "B")])).first()[0] == ["B", "D", "C", None]
    assert df.select(overrides.block_values(F.col("n"), ["B"])).first()[0] == ["A", "C", None]


def test_flag_overrides(spark):
    df = spark.createDataFrame([("x", False), ("x", True), ("y", None)], "doi string, f boolean")
    got = overrides.override_flags(df, [("x", ["f", "g"], False), ("x", ["f"], True)])
    assert [r.f for r in got.collect()] == [True, True, None]


def match(spark, name, year, roster):
    index = fuzzy.roster_index(spark.createDataFrame([(i, n, None, dv, y) for i, (n, dv, y) in enumerate(roster)], "roster_id long, employee_name string, employee_alternate_name string, division_adjusted string, year string"))
    rows = fuzzy.matched(spark.createDataFrame([(name, year)], "name string, year int"), index).collect()
    return rows[0].division if rows else None


@pytest.mark.parametrize(
    ("name", "year", "roster", "division"),
    [
        ("Iris Roos Jacobs", 2025, [("Iris Jacobs", "A", "2025")], None), ("Iris R. Jacobs", 2025, [("Iris Jacobs", "A", "2025")], "A"), ("Iris R. Jacobs", 2025, [("Iris Jacobs", "A", "2010")], "A"),
        ("Iris R. Jacobs", 2025, [("Iris Jacobs", "A", "2024"), ("Iris Jacobs", "B", "2025")], "B"), ("Iris R. Jacobs", None, [("Iris Jacobs", "A", "2024"), ("Iris Jacobs", "B", "2025")], "A"), ("Iris Jacobs", 2025, [], None),
        ("Iris Jacobs", 2025, [("Iris Jakobs", "A", "2025.0")], "A"),
    ],
)
def test_division(spark, name, year, roster, division):
    assert match(spark, name, year, roster) == division


def test_division_against_everybody(spark):
    """The two equi-joins find what comparing every author with every roster row finds."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(2, 7)))
    roster = [(f"{word()} {word()}", f"D{i}", str(rng.choice([2019, 2020, 2023]))) for i in range(60)]
    asked = [(f"{word()} {word()}", rng.choice([2018, 2020, 2022, 2030, None])) for _ in range(60)]
    index = fuzzy.roster_index(spark.createDataFrame([(i, n, None, dv, y) for i, (n, dv, y) in enumerate(roster)], "roster_id long, employee_name string, employee_alternate_name string, division_adjusted string, year string"))
    got = {(r.name, r.year): r.division for r in fuzzy.matched(spark.createDataFrame(asked, "name string, year int"), index).collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    for name, year in asked:
        rows = [(i, n, dv, int(y)) for i, (n, dv, y) in enumerate(roster)]
        if year is not None and any(abs(y - year) <= 1 for *_, y in rows):
            rows = [r for r in rows if abs(r[3] - year) <= 1]
        last = [r for r in rows if r[1].split()[-1] == name.split()[-1]]
        best = min((edits(name, r[1]) / max(len(name), len(r[1])), 0 if year is None else abs(r[3] - year), r[0], r[2]) for r in last or rows)
        assert got.get((name, year)) == (best[3] if best[0] <= 0.3 else None), (name, year)


def test_group_join(spark):
    rows = spark.createDataFrame([(k,) for k in "aaaaabbc"] + [(None,)], "k string")
    groups = spark.createDataFrame([("a", 5, "A"), ("b", 2, "B"), ("z", 9, "Z")], "k string, n int, v string")
    for hot in (1, 3, 100):
        assert sorted(r.v for r in join_groups(rows, groups, ["k"], "n", hot_rows=hot).collect()) == ["A"] * 5 + ["B"] * 2


# Shredding


def test_levels():
    """The levels of the nested-records paper's example of links and names."""
    kind = pa.struct([("backward", pa.list_(pa.int64())), ("forward", pa.list_(pa.int64()))])
    leaves = shredding.shred(pa.array([{"backward": None, "forward": [20, 40, 60]}, {"backward": [10, 30], "forward": [80]}, None], kind), "links")
    by = {leaf.path[-1]: leaf for leaf in leaves}
    assert by["forward"].rep.tolist() == [0, 1, 1, 0, 0] and by["forward"].values.to_pylist() == [20, 40, 60, 80]
    assert by["backward"].rep.tolist() == [0, 0, 1, 0] and by["backward"].deff.tolist()[0] == 1 and by["backward"].deff.tolist()[-1] == 0


VALUES = [None, "", "  ​", "x"]


def nested(rng, depth=2):
    if rng.random() < 0.2:
        return None
    inner = lambda: None if rng.random() < 0.2 else {"d": rng.choice(VALUES)}
    return [None if rng.random() < 0.2 else {"n": rng.choice(VALUES), "in": None if rng.random() < 0.2 else [inner() for _ in range(rng.randint(0, 3))]} for _ in range(rng.randint(0, 3))]


def test_shredding_against_brute_force():
    rng = random.Random(3)
    records = [nested(rng) for _ in range(400)]
    kind = pa.list_(pa.struct([("n", pa.string()), ("in", pa.list_(pa.struct([("d", pa.string())])))]))
    got = shredding.tables(pa.array(records, kind).slice(3), "c")
    full = lambda v: v == "x"
    outer, inner = [], []
    for r, rec in enumerate(records[3:]):
        for p, e in enumerate(rec or []):
            inside = (e or {}).get("in") or []
            outer.append((r, p, bool(e) and (full(e["n"]) or any(i and full(i["d"]) for i in inside)), (e or {}).get("n")))
            inner += [(r, p, q, bool(i) and full(i["d"]), (i or {}).get("d")) for q, i in enumerate(inside)]
    a, b = got["c",], got["c", "in"]
    assert list(zip(a["record"].tolist(), a["place"][0].tolist(), a["content"].tolist(), a["fields"]["n"].to_pylist(), strict=True)) == outer
    assert list(zip(b["record"].tolist(), b["place"][0].tolist(), b["place"][1].tolist(), b["content"].tolist(), b["fields"]["d"].to_pylist(), strict=True)) == inner


def test_flat_tables(spark):
    schema = "oa_id long, authorships array<struct<display_name string, affiliation_raw string, affiliations array<struct<display_name string>>>>, pos int, child string"
    rows = [(1, [("A", None, [("x",), (None,), (" ",)]), None, (None, " ", None)], 9, "z"), (2, None, 9, "z"), (3, [], 9, "z"), (1, [("A", None, None)], 9, "z")]
    got = sorted(tuple(r) for r in shredding.children(spark.createDataFrame(rows, schema), "openalex_metadata").collect())
    assert got == [("authorship", 1, 0, -1), ("authorship", 1, 0, -1), ("authorship_affiliation", 1, 0, 0)]
    assert shredding.children(spark.createDataFrame([], schema), "openalex_metadata").count() == 0


# Model lanes and sources


def test_retries():
    calls, waits = [], []

    def client(prompts):
        calls.append(len(prompts))
        if len(calls) <= 2 or "bad" in prompts:
            raise RuntimeError("busy")
        return [p.upper() for p in prompts]

    got = lanes.answered(["a", "b", "bad"], client, lanes.Limits(active=4, rpm=60, retries=2, backoff=3), waits.append)
    assert got[:2] == [("A", None), ("B", None)] and got[2] == (None, "busy")
    assert [w for w in waits if w in (3, 6)] == [3, 6]


def test_lane(spark):
    values = spark.createDataFrame([("UC Davis, CA 95616",), ("Cornell",)], "original string")
    prompts = lanes.group_prompts(values, 10).select("key", "prompt")

    def factory():
        import json

        def client(asked):
            out = []
            for p in asked:
                ids = [line.split(": ") for line in p.split("\n")[1:]]
                out.append(json.dumps([{"id": i, "canonical_institution": "" if v.startswith("UC") else v} for i, v in ids]))
            return out

        return client

    answers = lanes.group_answers(lanes.asked(prompts, factory, lanes.Limits(rpm=100000)))
    assert {tuple(r) for r in lanes.resolved(values, answers).collect()} == {("UC Davis, CA 95616", "UC Davis"), ("Cornell", "Cornell University")}


def test_empty_answers_are_asked_again(spark):
    """Values that a group's answer leaves out or empty are asked one by one; what stays empty is guessed, [NA] is none."""
    values = spark.createDataFrame([("UC Davis, CA 95616",), ("Cornell",), ("Acme, Inc",), ("Retired",)], "original string")

    def factory():
        import json

        def client(asked):
            out = []
            for p in asked:
                if "Affiliation: " in p:
                    out.append('{"canonical_institution": "Acme Ltd."}' if "Acme" in p else "")
                    continue
                entries = [line.split(": ", 1) for line in p.split("\n")[1:]]
                known = {"Cornell": "Cornell", "UC Davis, CA 95616": "", "Retired": "[NA]"}
                out.append(json.dumps([{"id": i, "canonical_institution": known[v]} for i, v in entries if v in known]))
            return out

        return client

    got = {r.original: r.canonical for r in lanes.canonicalized(values, factory, lanes.Limits(rpm=100000)).collect()}
    assert got == {"UC Davis, CA 95616": "UC Davis", "Cornell": "Cornell University", "Acme, Inc": "Acme", "Retired": None}


def test_searches_are_paged(spark):
    calls = []

    def search(query, offset, rows):
        calls.append(offset)
        return [{"doi": f"{query}/{i}"} for i in range(offset, min(offset + rows, 25))]

    assert fetch.search_works(spark, search, "doi string", page=10, query="10.1").count() == 25 and calls == [0, 10, 20]
    assert fetch.search_works(spark, lambda **_: [], "doi string").count() == 0


def test_normalized_matcher(spark):
    works = spark.createDataFrame([([("Ann", "Org")],), ([("Org Team", None)],), ([("Bo", "Univ")],), (None,)], "author array<struct<author_name:string,author_affiliation:string>>")
    got = predicates.filter_works(works, "org", "author", predicates.normalized_author_matches)
    assert got.count() == 2


def test_first_entry_of_a_lookup_counts(spark):
    works = spark.createDataFrame([(1, [" x  y", "z"])], "id int, u array<string>")
    lookup = spark.createDataFrame([("x y", "B", 1), ("x y", "A", 2)], "original string, canonical string, place int")
    assert [r.canonical_affiliations for r in A.canonical_affiliations(works, lookup, "id", "u").collect()] == [["B"]]
    assert [r.canonical_affiliations for r in A.canonical_affiliations(works, lookup.drop("place"), "id", "u").collect()] == [["A"]]


def test_clusters_must_name_their_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from sluiceway import session

    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        session.shared_dir(unset)
    assert session.cut(spark.range(3)).count() == 3
    session.swept(spark)


def test_answers(spark):
    areas = spark.createDataFrame([("f ", "s", "d")], "first_level string, second_level string, description string")
    said = ['{"second_level": "s", "confidence": 1.5, "note": " a   b "}', '{"second_level": "s", "confidence": -2, "note": ""}', '{"second_level": "t", "confidence": null}', "no", None]
    got = lanes.classified(spark.createDataFrame(list(enumerate(said)), "doi int, answer string"), areas).orderBy("doi").collect()
    assert [tuple(r)[1:] for r in got] == [("s", "f", 1.0, "a b"), ("s", "f", 0.0, None), (None, None, None, None), (None, None, None, None), (None, None, None, None)]


def test_classify(spark):
    areas = spark.createDataFrame([("f", "snow", "d")], "first_level string, second_level string, description string")
    rows = spark.createDataFrame([("1", "Snow pillows", None), ("2", None, "x")], "doi string, title string, abstract string")

    def factory():
        return lambda asked: ['{"second_level": "snow", "confidence": 0.5, "note": ""}' if "Title: Snow" in p and "Abstract: [Missing]" in p else "?" for p in asked]

    got = lanes.classify(rows, areas, factory, lanes.Limits(rpm=100000)).orderBy("doi").collect()
    assert [tuple(r) for r in got] == [("1", "snow", "f", 0.5, None), ("2", None, None, None, None)]


def test_normalized_twice(spark):
    df = spark.createDataFrame([([("Org", None, None, None, ["x"])],)], f"author {AUTHOR}")
    once = A.normalized_authors(df)
    assert A.normalized_authors(once) is once and [tuple(a) for a in once.first().author] == [("Org", "x")]
    flat = spark.createDataFrame([(("a ", " ", None),)], "a struct<affiliation1:string,affiliation_name:string,other:string>")
    assert flat.select(A.scalar_affiliations(F.col("a"), ["affiliation1", "affiliation_name", "other"])).first()[0] == ["a"]


def test_override_first(spark):
    works = spark.createDataFrame([(1, "10.1/A", 2025, None, None, None), (2, "10.1/A", 2025, "B", 1, "D"), (3, None, 2025, "B", 1, "D")], "record_id int, doi string, publication_year int, first_affiliated_author string, first_affiliated_author_position int, first_affiliated_author_division string")
    roster = spark.createDataFrame([(1, "Iris Jacobs", None, "X", "2019"), (2, "Iris Jacobs", None, "Y", "2025")], "roster_id int, employee_name string, employee_alternate_name string, division_adjusted string, year string")
    got = fuzzy.override_first_affiliated(works, roster, [("10.1/A", "Q", 9, None), ("10.1/A", "Iris Jacobs", 3, 2019)])
    assert sorted(tuple(r)[3:] for r in got.collect() if r.record_id == 1) == [("Iris Jacobs", 3, "X")] and {tuple(r)[3:] for r in got.collect() if r.record_id > 1} == {("B", 1, "D")}


def test_fetch(spark):
    dois = spark.createDataFrame([(f"10.1/{i}",) for i in range(5)], "doi string")

    def factory():
        def get(keys):
            if "10.1/3" in keys:
                raise RuntimeError("down")
            return [{"doi": k, "title": "T"} for k in keys]

        return get

    got = fetch.fetch_works(dois, factory, "doi string, title string", chunk=1, pause=0).collect()
    assert sorted(r.doi for r in got if r.error is None) == ["10.1/0", "10.1/1", "10.1/2", "10.1/4"] and [r.error for r in got if r.error] == ["RuntimeError: down"]


def test_strategies(spark):
    one = lambda n: spark.createDataFrame([(i,) for i in range(n)], "i int")
    got = fetch.run_strategies([fetch.Strategy(one, {"n": 3}, lambda d: d.filter("i > 0")), fetch.Strategy(one, {"n": 1}, post=lambda d: d.withColumn("z", F.lit(1)))])
    assert sorted((r.i, r.z) for r in got.collect() if r.z) == [(0, 1)] and got.count() == 3


def test_files(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('﻿first_level,second_level\n"a ""b"" ", c \n', encoding="utf-8")
    assert [tuple(r) for r in readers.read_csv(spark, str(path), "first_level string, second_level string").collect()] == [('a "b"', "c")]
    df = spark.createDataFrame([('x "y"', None)], "a string, b string")
    sinks.write_csv(df, str(tmp_path / "out"), single=True)
    assert next((tmp_path / "out").glob("*.csv")).read_text().splitlines() == ["a,b", '"x ""y""",']
    with pytest.raises(ValueError):
        sinks.write_csv(spark.createDataFrame([([1],)], "a array<int>"), str(tmp_path / "no"))
    sinks.write_table(df, str(tmp_path / "p"))
    assert readers.read_snapshot(spark, str(tmp_path / "p"), "a string, b string").count() == 1
    assert readers.read_snapshot(spark, str(tmp_path / "q"), "a string").count() == 0


def test_stream(spark, tmp_path):
    from sluiceway.streaming.registry import new_dois

    folder = tmp_path / "in"
    spark.createDataFrame([("10.1234/a", "2024-01-01 00:00:00"), ("doi:10.1234/A", "2024-01-01 01:00:00"), ("-", "2024-01-01 00:00:00")], "doi string, at string").selectExpr("doi", "cast(at as timestamp) at").write.parquet(str(folder))
    stream = new_dois(spark.readStream.schema("doi string, at timestamp").parquet(str(folder)), "at")
    query = stream.writeStream.format("memory").queryName("new_dois").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(120)
    assert [r.doi for r in spark.table("new_dois").collect()] == ["10.1234/A"]


