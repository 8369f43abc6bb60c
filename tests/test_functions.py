"""Golden cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from sluiceway.functions import abstracts, citation, doi, institutions, text


def values(spark, given, function, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i int, v {kind}").select("i", function(F.col("v")).alias("x")).orderBy("i").collect()
    return [r.x for r in rows]


def check(spark, function, cases, kind="string"):
    assert dict(zip(map(str, cases), values(spark, list(cases), function, kind), strict=True)) == {str(k): v for k, v in cases.items()}


def test_clean_doi(spark):
    check(spark, doi.clean_doi, {'"10.1234/abc"': "10.1234/ABC", "https://doi.org/10.5678/foo ": "10.5678/FOO", "https://doi.org10.1016/j.x": None, "https://www.doi.org/": None, "doi:10.1000/x(1)y": "10.1000/X(1", "10.123/abc": None, "10.1234/abc.": "10.1234/ABC.", "see 10.1234/a;b and 10.9999/z": "10.1234/A", "": None, None: None})


def test_clean_doi_twice(spark):
    once = values(spark, ["doi:10.1000/x(1)y", "10.1234/abc."], doi.clean_doi)
    assert values(spark, once, doi.clean_doi) == once


def test_abstract_prefixes(spark):
    cases = {
        "Abstract Water flows": "Water flows", "ABSTRACTWater": "Water", "BackgroundWater": "Water", "Background: X": "X", "Contextual analysis": "ual analysis", "Motivations matter": "s matter", "Abstract. X": "X",
        "Key Takeaways: Y": "Y", "[Translated title]": None, "© 2020 Pub": None, "(c) 2020": None, "Author(s): X": None, "See the corresponding author for more": None, "(C) 2020": "(C) 2020", "Address 95819 Body": "Body", "": "", None: None,
    }
    check(spark, abstracts.strip_prefixes, cases)


def test_jats(spark):
    check(spark, abstracts.clean_jats, {"<jats:title>Abstract</jats:title><jats:p>Snow melts</jats:p>": "Snow melts", "<p>A &amp; B</p>": "A & B", "": None, None: None, "<p></p>": "<p></p>", "AbstractSnow": "Snow", "p < 5 and q > 3": "p < 5 and q > 3"})


def test_titles(spark):
    check(spark, text.clean_title, {"<i>SALMON</i> IN THE DELTA": "Salmon in the delta", "CO<sub>2</sub> flux": "CO2 flux", "1234": "1234", "WHO? NOBODY": "Who? Nobody", None: None})


def test_plain_text(spark):
    check(spark, text.latin_ascii, {"Élodie Straße": "Elodie Strasse", "Ærø – “x”": 'AEro - "x"', "é": "e", "水": "水", "": "", None: None})


def test_names_of_institutions(spark):
    both = lambda c: institutions.output_form(institutions.finalized(c))
    check(spark, both, {
        "Univ. of California, Davis": "University. of California Davis", "University of California - Davis": "University of California Davis", "University of California at Davis": "University of California Davis",
        "Cal State East Bay": "California State University East Bay", "University College Dublin": "University College Dublin", "NOAA Fisheries": "United States National Oceanic and Atmospheric Administration",
        "NASA Ames Research Center": "United States National Aeronautics and Space Administration", "U.S. Geological Survey, Menlo Park": "United States Geological Survey", "Cornell": "Cornell University", "Woodard Curran, Inc.": "Woodard Curran",
        "Acme Co., Ltd.": "Acme", "Lawrence Berkeley National Lab": "Lawrence Berkeley National Laboratory", "": "", None: None,
    })


def test_agency(spark):
    rule = lambda c: institutions.normalized(c, agency="Halvern Department of Water Stewardship", places=("Halvern", "Tolvenas"))
    check(spark, rule, {"Department of Water Stewardship": "Halvern Department of Water Stewardship", "Department of Water Stewardship, Tolvenas": "Tolvenas", "Water Lab, Halvern Department of Water Stewardship": "Halvern Department of Water Stewardship"})


def test_overrides(spark):
    both = lambda c: institutions.overridden(c, c)
    check(spark, both, {"Ohio State University": "Ohio State University", "NA": None, "Rutgers Univ": "Rutgers University", "CONICET, Argentina": "CONICET", "x": "x", None: None})


def test_fallback(spark):
    check(spark, institutions.fallback, {"Dept of Biology, UC Davis, Davis, CA 95616, USA": "Dept of Biology", "Stanford University, Stanford, California 94305": "Stanford University"})


@pytest.mark.parametrize(
    ("authors", "expected"),
    [(["Ann Smith", "Bo Doe"], "Smith, A. and Doe, B."), (["Ann Smith", "Bo Doe", "Cy Roe"], "Smith, A., Doe, B., and Roe, C."), (["Plato"], "Plato."), (["Daphne A. Gille"], "Gille, D.A."), ([], ""), (None, ""), ([" ", None], "")],
)
def test_authors(spark, authors, expected):
    assert values(spark, [authors], citation.authors_part, "array<string>") == [expected]


def test_many_authors(spark):
    (got,) = values(spark, [[f"A{i} B{i}" for i in range(9)]], citation.authors_part, "array<string>")
    assert got.endswith("and B7, A. et al.") and "B8" not in got


def test_citation(spark):
    row = spark.createDataFrame([(["Ann Smith", "Bo Doe"], 2023, "My title", "J Hydrol", "12", "3", "100", "110", "10.1/A"), (None, None, None, None, None, "3", "100", "100", None)], "a array<string>, y int, t string, j string, v string, i string, f string, l string, d string")
    got = [r.x for r in row.select(citation.harvard(*map(F.col, "aytjvifld")).alias("x")).collect()]
    assert got == ["Smith, A. and Doe, B. (2023). My title. J Hydrol. 12(3). 100-110. doi:10.1/A.", "100."]


def test_contribution(spark):
    rows = [(True, True, True, True), (False, True, True, False), (False, False, True, False), (False, False, False, True), (False, False, False, False), (None, None, None, None)]
    df = spark.createDataFrame(rows, "s boolean, l boolean, a boolean, f boolean")
    assert [r.x for r in df.select(citation.contribution(*map(F.col, "slaf")).alias("x")).collect()] == ["sole authored; funded", "lead authored", "co-authored", "funded", "", ""]


def test_collapse(spark):
    assert values(spark, [[" a", "b", "a ", "", None], [], None], text.collapse_unique, "array<string>") == ["a; b", None, None]
