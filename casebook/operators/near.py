"""Near misses: names within one or two edits of a request, by an index of deletions.

Two texts within k edits have a common remainder after at most k deletions from each, and so have their last WINDOW
characters (an insertion moves a character over the window's edge, and costs a deletion less). The index has each name's
remainders; a request's remainders are joined with them on equality, and what is found is verified by edit distance. No
request is compared with all names. Names that share a long ending differ in the window, so the window takes the end.

Null names and requests are near nothing. Repeated names count once (with the least urn); repeated requests each have
their rows. Ties go by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EDITS, WINDOW = 2, 10


def less_one(text: Column) -> Column:
    """All texts that a deletion makes of one, itself first."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    return F.array_union(F.array(text), F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text)))))


def remainders(text: Column, edits: int = EDITS, window: int = WINDOW) -> Column:
    """Distinct remainders of the last `window` characters after at most `edits` deletions."""
    out = F.array(F.right(text, F.lit(window)))
    for _ in range(edits):
        out = F.array_distinct(F.flatten(F.transform(out, less_one)))
    return out


def index(names: DataFrame, name: str, urn: str = "urn", edits: int = EDITS) -> DataFrame:
    """part, name, urn: a row for each remainder of each distinct name."""
    once = names.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(urn).alias("urn"))
    return once.select(F.explode(remainders(F.col("name"), edits)).alias("part"), "name", "urn")


def lookup(requests: DataFrame, request: str, names: DataFrame, edits: int = EDITS, limit: int = 5) -> DataFrame:
    """The requests' rows with the names near them: name, urn, distance, place (from 1), the nearest `limit`."""
    asked = requests.where(F.col(request).isNotNull()).select(F.col(request).alias("asked")).distinct()
    found = asked.select("asked", F.explode(remainders(F.col("asked"), edits)).alias("part")).join(names, "part").select("asked", "name", "urn").distinct()
    near = found.withColumn("distance", F.levenshtein("asked", "name")).where(F.col("distance") <= edits)
    first = near.withColumn("place", F.row_number().over(Window.partitionBy("asked").orderBy("distance", "name"))).where(F.col("place") <= limit)
    return requests.join(first, F.col(request) == F.col("asked")).drop("asked")
