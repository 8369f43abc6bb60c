"""Names of institutions rewritten to one spelling, by ordered rules over whole columns.

Every rule is one regular expression replacement, so a value's expression grows by one call a rule.
Rewriting is meant for the distinct names, see ``operators.affiliations``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluiceway.functions import let
from sluiceway.functions.text import latin_ascii, squish, trimws

NOAA, NASA = "National Oceanic and Atmospheric Administration", "National Aeronautics and Space Administration"
CUNY, SUNY = "City University of New York", "State University of New York"

# Abbreviations written out, in this order.
ABBREVIATIONS = (
    (r"(?i)\bUniv\.?\b", "University"),
    (r"(?i)\bInst\.?\b", "Institute"),
    (r"(?i)\bDept\.?\b", "Department"),
    (r"(?i)\bIntl\.?\b", "International"),
    (r"(?i)\bUniv\.? of", "University of"),
    (r"(?i)\bLab\.?\b", "Laboratory"),
    (r"(?i)\bMt\.(?=\s|$)", "Mount"),
    (r"(?i)\bMt\b", "Mount"),
)
# What a sub-unit's name starts with.
SUBUNITS = "Department|Dept|Division|School|College|Center|Centre|Institute|Laboratory|Lab|Office|Section|Program|Bureau|Delta Modeling Section"
# What is cut off behind a university's name.
INNER_UNITS = "College|School|Department|Division|Institute|Center|Faculty|Program"
# What a company's name ends with.
COMPANY = r"(?i),?\s+(?:LLC|L\.L\.C\.|Co\.?|Company|Ltd\.?|Limited|Inc\.?|Incorporated|Corporation|Corp\.?)(?:\.|,)?(?=$|\s|\.)"
# Whole names that are known under another, in this order; the left side is an anchored pattern.
KNOWN = (
    ("AECOM", "AECOM"),
    ("Jet Propulsion Laboratory.*", "California Institute of Technology"),
    ("ICF International", "ICF"),
    ("IIT@MIT", "Massachusetts Institute of Technology"),
    ("Cal State East Bay", "California State University, East Bay"),
    (r"Leibniz[-\s]?Institute of Freshwater Ecology and Inland Fisheries", "Leibniz Institute of Freshwater Ecology and Inland Fisheries"),
    ("Metropolitan Water District", "Metropolitan Water District of Southern California"),
    ("The Metropolitan Water District of Southern California", "Metropolitan Water District of Southern California"),
    ("CalTrout", "California Trout"),
    ("NSW Government", "New South Wales Government"),
    (r"National Center for Agro[-\s]?Meteorology", "National Center for Agro Meteorology"),
    ("National Institute of Meteorological Sciences/Korea Meteorological Administration", "National Institute of Meteorological Sciences"),
    ("National Weather Service", "United States National Weather Service"),
    ("National Oceanic and Atmospheric Administration", "United States National Oceanic and Atmospheric Administration"),
    ("Nevada Seismological Laboratory University of Nevada Reno", "University of Nevada Reno"),
    ("Penn State University", "Pennsylvania State University"),
    ("Power China Huadong Engineering", "PowerChina"),
    ("Purdue University West Lafayette", "Purdue University"),
    ("Rutgers University Newark", "Rutgers University"),
    ("San Jose State University Research Foundation", "San Jose State University"),
    ("Scripps", "Scripps Institution of Oceanography"),
    ("Southern California Coastal Water Research Project Authority", "Southern California Coastal Water Research Project"),
    ("Stony Brook University State University of New York", "Stony Brook University"),
    ("United States Department of Agriculture Natural Resources Conservation Service", "United States Department of Agriculture"),
    ("United States Department of Agriculture Agricultural Research Service", "United States Department of Agriculture"),
    (r"Universita[_\s]+de[_\s]+Bourgogne", "Universita de Bourgogne"),
    (r"Universit\s*extAllCaps\{e\}extAllCaps\{e\}\s+Toulouse\s+III\s*[-–]?\s*Paul\s+Sabatier", "Universite Toulouse III"),
    ("University", "University College Dublin"),
    ("University at Buffalo", "University at Buffalo State University of New York"),
    ("University for Atmospheric Research", "University Corporation for Atmospheric Research"),
    ("University of California Cooperative Extension", "University of California Agriculture and Natural Resources"),
    ("University of California at Davis", "University of California Davis"),
    ("University of California at Merced", "University of California Merced"),
    ("University of Colorado at Boulder", "University of Colorado Boulder"),
    ("University of Illinois at Urbana Champaign", "University of Illinois Urbana Champaign"),
    ("University of North Carolina Chapel Hill", "University of North Carolina at Chapel Hill"),
    ("Wageningen University and Research", "Wageningen University"),
    ("Xi'an University", "Xi'an University of Technology"),
    ("Bureau of Reclamation", "United States Bureau of Reclamation"),
    ("Bureau of Land Management", "United States Bureau of Land Management"),
    ("USGS Pacific Coastal and Marine Science Center", "United States Geological Survey"),
    ("United States Army RDECOM", "United States Army Engineer Research and Development Center"),
    ("European Centre for Medium-Range Forecasts", "European Centre for Medium-Range Weather Forecasts"),
    ("European Centre for Medium-Range Weather Forecasting", "European Centre for Medium-Range Weather Forecasts"),
    ("Florida A&M University[-–]Florida State University.*", "Florida A&M University"),
    ("State University of New York College of Environmental Science and Forestry", "State University of New York"),
    ("The Graduate Center,? CUNY", "City University of New York"),
    ("The Graduate Center of the City University of New York", "City University of New York"),
    ("The Graduate Center City University of New York", "City University of New York"),
    ("Johns Hopkins University Applied Physics Laboratory", "Johns Hopkins University"),
    ("Monterey Bay Aquarium Research Institute", "Monterey Bay Aquarium"),
    ("Monterey Bay Aquarium Institute", "Monterey Bay Aquarium"),
)
# Agencies of one department, told by what stands anywhere in the name.
DEPARTMENT = (
    (r"USDA[\s-]*ARS|United States Department of Agriculture[,\s-]*(?:Agricultural Research Service|ARS)", "United States Department of Agriculture"),
    ("National Clonal Germplasm Repository", "United States Department of Agriculture"),
    ("United States Department of Agriculture.*Forest Service", "United States Forest Service"),
    ("USDA.*Forest Service", "United States Forest Service"),
    ("USDA.*Natural Resources Conservation Service", "United States Department of Agriculture"),
    ("National Aeronautics and Space Administration.*(?:Goddard|Ames)", "National Aeronautics and Space Administration"),
)
# Synonyms; pattern, name, without regard to case.
SYNONYMS = (("^Scripps Institution of Oceanography.*$", "Scripps Institution of Oceanography", True),)
# Last corrections of canonical names; contained in the value, or the whole of it.
OUTPUT = (
    ("United States Geological Survey", "United States Geological Survey"),
    ("National Aeronautics and Space Administration", "United States National Aeronautics and Space Administration"),
    ("Rutgers", "Rutgers University"),
    ("Cramer Fish Sciences", "Cramer Fish Sciences"),
    (r"\bICF\b", "ICF"),
    ("United States Environmental Protection Agency", "United States Environmental Protection Agency"),
)


@dataclass(frozen=True)
class Override:
    """``target`` where ``pattern`` is found in the original or the current canonical name; the whole name with ``exact``."""

    target: str | None
    pattern: str
    of_original: bool = False
    exact: bool = False
    any_case: bool = True


# Countries and states at the end of an address.
COUNTRY = r"United States(?: of America)?|USA|U\.S\.A\.?|U\.S\."
STATES = "CA|California|OR|Oregon|WA|Washington|NV|Nevada|AZ|Arizona|TX|Texas"
# Overrides of proposed names, in this order.
OVERRIDES = (
    Override("National Ecological Observation Network Battelle", "National Ecological Observation Network", of_original=True),
    Override("CONICET", "CONICET", of_original=True),
    Override("Ducks Unlimited", "Ducks Unlimited", of_original=True),
    Override("United States Environmental Protection Agency", "Environmental Protection Agency", exact=True),
    Override("Cramer Fish Sciences", "Cramer Fish Sciences"),
    Override("Ramboll", "Ramboll"),
    Override("Broad Institute", "Broad Institute", of_original=True),
    Override("National Center for Atmospheric Research", "NCAR", of_original=True, any_case=False),
    Override(None, "NA", exact=True),
    Override("United States National Aeronautics and Space Administration", "National Aeronautics and Space Administration", exact=True),
    Override("United States National Park Service", "National Park Service", exact=True),
    Override("NorthWest Research Associates", "North West Research Associates", exact=True),
    Override("The Ohio State University", "Ohio State University", exact=True),
    Override("Rutgers University", "Rutgers"),
    Override("United States National Oceanic and Atmospheric Administration", "NOAA/Earth System", of_original=True),
    Override("United States Geological Survey", "United States Geological Survey"),
    Override("ICF", "ICF"),
)


def _whole(c: Column, pattern: str, target: str) -> Column:
    """``target`` for values that contain the pattern, in any case."""
    return F.regexp_replace(c, f"(?is)^.*(?:{pattern}).*$", target)


def _fold(c: Column, rules) -> Column:
    for pattern, target in rules:
        c = F.regexp_replace(c, pattern, target)
    return c


def without_the(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)^The\s+", "")


def normalized(c: Column, agency: str | None = None, places: tuple[str, ...] = ()) -> Column:
    """One pass of all rules; the patterns in it are fixed values. ``agency``: "<place> <name>", the full name that "<name>", alone or with one of ``places``, stands for."""
    v = F.regexp_replace(latin_ascii(trimws(c)), r"\s+", " ")
    v = _fold(v, ABBREVIATIONS)
    v = F.regexp_replace(v, rf"(?i)^(?:(?:{SUBUNITS})[^,]*,\s*)+", "")
    v = F.regexp_replace(v, rf"(?i)^(.*?university[^,]*)(?:,?\s*(?:{INNER_UNITS}).*)$", "$1")
    v = trimws(F.regexp_replace(v, rf"(?i)^({SUNY}).*$", "$1"))
    v = F.regexp_replace(v, r"(?i)(University of [^,\r\n]+?)[-–]\s*([A-Za-z0-9&.'() ]+)", "$1, $2")
    v = F.regexp_replace(v, r"(?i)\bUniversity of California at\s+", "University of California ")
    v = trimws(F.regexp_replace(v, COMPANY, ""))
    if agency:
        name = re.escape(agency.split(" ", 1)[1])
        v = _whole(v, re.escape(agency), agency)
        v = F.regexp_replace(v, rf"(?is)^(?=.*{name})(?=.*(?:{'|'.join(places)})).*$", agency) if places else v
        v = F.regexp_replace(v, rf"(?i)^{name}$", agency)
    v = _whole(v, r"\bCUNY\b", CUNY)
    v = _whole(v, r"\bNASA\b", NASA)
    v = _fold(v, ((r"(?i)\bNOAA\b", NOAA), (r"(?i)National Oceanic and Atmospheric Admin\.?", NOAA)))
    v = _fold(v, ((rf"(?i)({NOAA}).*", "$1"), ("(?i)Administrationistration", "Administration")))
    v = _fold(v, ((r"(?i)^cornell$", "Cornell University"), (r"(?i)^rutgers$", "Rutgers University")))
    v = _fold(v, ((r"(?<![A-Za-z])U\.S\.(?![A-Za-z])", "United States"), (r"(?<![A-Za-z])US(?![A-Za-z])", "United States")))
    for pattern, target in DEPARTMENT:
        v = _whole(v, pattern, target)
    v = F.regexp_replace(v, r",\s*(?:USA|United States of America)$", "")
    v = F.replace(v, F.lit(" & "), F.lit(" and "))
    v = let(v, lambda x: F.when(x.rlike("(?i)university"), trimws(F.regexp_replace(F.regexp_replace(x, "[,–-]+", " "), r"\s+", " "))).otherwise(x))
    v = _fold(v, ((f"(?i)^{pattern}$", target) for pattern, target in KNOWN))
    return trimws(F.regexp_replace(v, r",\s*,", ", "))


def with_synonyms(c: Column, synonyms=SYNONYMS) -> Column:
    return _fold(c, ((("(?i)" if any_case else "") + pattern, target) for pattern, target, any_case in synonyms))


def finalized(c: Column, **agency) -> Column:
    """Two passes with the synonyms between them; rules of the first pass may need those of the second."""
    return normalized(with_synonyms(normalized(c, **agency)), **agency)


def overridden(original: Column, canonical: Column, rules: tuple[Override, ...] = OVERRIDES) -> Column:
    """The overrides, each on what the ones before made of it, and no leading "The"."""
    v = canonical
    for r in rules:
        if r.exact:
            v = F.nullif(v, F.lit(r.pattern)) if r.target is None else F.regexp_replace(v, f"^{re.escape(r.pattern)}$", r.target)
        elif r.of_original:
            found = F.coalesce(original.rlike(("(?i)" if r.any_case else "") + re.escape(r.pattern)), F.lit(False))
            v = F.when(found, r.target).otherwise(v)
        else:
            v = _whole(v, re.escape(r.pattern), r.target)
    return without_the(v)


def output_form(c: Column) -> Column:
    """The last corrections; the text "NA" is null. Applying it again changes nothing."""
    for pattern, target in OUTPUT:
        c = _whole(c, pattern, target)
    return F.nullif(without_the(c), F.lit("NA"))


def fallback(c: Column) -> Column:
    """A guess without a lookup: no trailing country, no state and number, then what stands before the first comma."""
    v = squish(c)
    v = F.regexp_replace(v, rf",?\s*(?:{COUNTRY})\s*$", "")
    v = F.regexp_replace(v, rf",?\s*(?:{STATES})\s*\d{{3,5}}.*$", "")
    return let(trimws(F.substring_index(v, ",", 1)), lambda x: F.when(x == "", c).otherwise(x))


def cleaned(c: Column) -> Column:
    """Squished; null is empty and "[NA]" null."""
    return F.nullif(squish(F.coalesce(c, F.lit(""))), F.lit("[NA]"))
