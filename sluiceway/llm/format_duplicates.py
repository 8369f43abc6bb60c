"""Problem 4: records that are the same but for formatting, by progressive partition refinement.

A value's *core* is the DOI in it, freed of its dress; finding it takes decoding and several regular
expressions. So rows are first classed by invariants that cost next to nothing, the length and letter
histogram of what stands from "10." to the next sign that ends a DOI, without marks. Only in classes
with several members the core is found and compared. Values in which that simple reading might
differ from the core's (encoded ones, blanks around marks, letters beyond ASCII, more than one "10.")
are classed by their core itself. Equal cores have equal invariants, so no copy is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions import let
from sluiceway.operators.skew import HOT_ROWS, MOST_HOT, join_groups
from sluiceway.session import cut

INVISIBLE = r"[\p{Cf}\p{Cc}&&[^\s]]+"
AROUND = r"[\s\p{Z}]*([./_()\p{Pd}])[\s\p{Z}]*"
WHOLE_DOI = r"(?<![0-9.])10\.([0-9]{4,9})/+([^\s\p{Z}&;,\"'“”‘’<>\[\]{}|?#=]+)"


def decoded(value: Column) -> Column:
    """``value`` with percent encoding undone, twice if need be; what can't be decoded stays."""
    once = lambda v: F.coalesce(F.try_url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))), v)
    return F.when(F.contains(value, F.lit("%")), let(let(value, once), once)).otherwise(value)


def doi_core(value: Column) -> Column:
    """The DOI in ``value`` as registrant/suffix of lower-case letters and digits; null without a whole DOI.

    A label, resolver, quotes, brackets, other fields of the line, spaces, invisible characters,
    percent encoding, punctuation and case make no difference; letters, digits and parts do.
    """
    plain = F.regexp_replace(F.regexp_replace(let(value, decoded), INVISIBLE, ""), AROUND, "$1")
    found = F.lower(F.regexp_substr(plain, F.lit(WHOLE_DOI)))
    suffix = lambda c: F.regexp_replace(F.substr(c, F.locate("/", c)), r"[^\p{L}\p{N}]+", "")
    return let(found, lambda c: let(suffix(c), lambda x: F.when(x != "", F.concat(F.substr(F.substring_index(c, "/", 1), F.lit(4)), F.lit("/"), x))))


#: Signs that end a DOI, blanks, invisible signs, and marks that are no part of its letters and digits.
ENDS = "&;,\"'“”‘’<>[]{}|?#="
BLANKS = " \t\r\n\u000b\u000c\u00a0\u2002\u2003\u2009\u202f\u3000"
UNSEEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
MARKS = "./_()-–—:*+!@$^~`\\\u2010\u2011\u2012"
#: Marks that blanks may stand around within a DOI, see AROUND.
JOINTS = "./_()-–—\u2010\u2011\u2012"


def simple_letters(value: Column) -> Column:
    """The letters and digits from after the only "10." to the end of the DOI there, in lower case; null where the core may have others. No regular expression but for one of one sign."""

    def of(text: Column) -> Column:
        start = F.locate("10.", text)
        rest = F.substr(text, start + 3)
        run = F.substring_index(F.substring_index(rest, "\n", 1), " ", 1)
        letters = F.translate(run, MARKS, "")
        before = F.when(start > 1, F.substr(text, start - 1, F.lit(1))).otherwise("")
        joints = F.translate(text, JOINTS, "." * len(JOINTS))
        odd = (start == 0) | F.contains(rest, F.lit("10.")) | F.contains(text, F.lit("%")) | F.contains(joints, F.lit(" .")) | F.contains(joints, F.lit(". ")) | before.between("0", "9") | (before == ".") | (F.octet_length(letters) != F.length(letters))
        return F.when(~odd, letters)

    return let(F.translate(F.lower(value), BLANKS + ENDS + UNSEEN, " " * len(BLANKS) + "\n" * len(ENDS)), of)


def invariant(letters: Column) -> Column:
    """Length and letter histogram of ``letters``, as one number."""
    return F.xxhash64(F.length(letters), F.sort_array(F.split(letters, "")))


def doi_class(value: Column) -> Column:
    """The class of a value: invariants of the simple reading, else of the core; null without either."""
    return let(F.coalesce(simple_letters(value), F.replace(doi_core(value), F.lit("/"), F.lit(""))), invariant)


def copies(rows: DataFrame, key: str = "id", value: str = "value", core=doi_core, classes=doi_class, within: str | None = None, most_hot: int = MOST_HOT, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Collapse rows that differ only in formatting.

    Input: ``key`` (unique, orderable), ``value`` (string) and, with ``within``, the column that
    keeps tables apart. Output: ``[within,] first_id, copy_id, n_copies``, a row for each row that
    has the same core as a row with a smaller key. Rows with a null, empty or coreless value
    belong to no group; further columns are ignored; an empty input gives an empty result; equal
    rows are copies of each other. The at most ``most_hot`` largest classes are only ever counted by
    partial aggregates and joined by broadcast, see ``join_groups``; any other has at most
    1/``most_hot`` of all rows and is shuffled once.
    """
    part = F.col(within) if within else F.lit("")
    raw = cut(rows.select(part.alias("_within"), F.col(key).alias("_id"), F.col(value).alias("_value"), classes(F.col(value)).alias("_class")).filter("_class is not null"))  # a value that isn't there has no class
    several = raw.groupBy("_within", "_class").agg(F.count("*").alias("_members")).filter("_members > 1")
    on = ["_within", "_class"]
    hot = several.filter(F.col("_members") >= hot_rows).orderBy(F.desc("_members"), *on).limit(most_hot)
    with_core = lambda df: df.withColumn("_core", core(F.col("_value"))).filter("_core is not null").select("_within", "_class", "_id", "_core")
    near = with_core(raw.join(F.broadcast(hot.select(*on)), on))
    groups = near.groupBy("_within", "_core").agg(F.min("_id").alias("first_id"), F.count("*").alias("n_copies")).filter("n_copies > 1")
    near = join_groups(near, groups, ["_within", "_core"], "n_copies", most_hot, hot_rows)
    far = with_core(raw.join(several.join(F.broadcast(hot.select(*on)), on, "left_anti").select(*on), on))
    same = Window.partitionBy("_within", "_class", "_core")  # lies where the class lies
    far = far.withColumn("first_id", F.min("_id").over(same)).withColumn("n_copies", F.count("*").over(same))
    out = near.select("_within", "_id", "first_id", "n_copies").unionByName(far.select("_within", "_id", "first_id", "n_copies")).filter(F.col("_id") != F.col("first_id"))
    return out.select(*([F.col("_within").alias(within)] if within else []), "first_id", F.col("_id").alias("copy_id"), "n_copies")


def collapsed(rows: DataFrame, key: str = "id", value: str = "value", core=doi_core) -> DataFrame:
    """One row for each core, with its smallest key and number of copies: ``core, first_id, n_copies``."""
    cores = rows.select(F.col(key).alias("_id"), core(F.col(value)).alias("core")).filter(F.col("core").isNotNull())
    return cores.groupBy("core").agg(F.min("_id").alias("first_id"), F.count("*").alias("n_copies"))
