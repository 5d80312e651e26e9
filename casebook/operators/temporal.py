"""Versions in time: half-open validity, as-of joins, amendments, timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.sources.shared import dealt


def timeline(versions: DataFrame, key: str, start: str, size: int = 0) -> DataFrame:
    """Distinct (key, start) with `end` (the next start; null for the last) and `seq` from 1. `size`: about how many versions
    there are, where they may be many."""
    w = Window.partitionBy(key).orderBy(start)
    return dealt(versions.select(key, start), size, key).distinct().select(key, start, F.lead(start).over(w).alias("end"), F.row_number().over(w).cast("long").alias("seq"))


def amendments(versions: DataFrame, key: str, start: str = "start") -> DataFrame:
    """key, versions, first_version, last_version of a timeline."""
    return versions.groupBy(key).agg(F.count(F.lit(1)).alias("versions"), F.min(start).alias("first_version"), F.max(start).alias("last_version"))


def in_force(at: Column, start: Column, end: Column) -> Column:
    return F.coalesce((start <= at) & (end.isNull() | (at < end)), F.lit(False))


def as_of(requests: DataFrame, versions: DataFrame, key: str, at: str, start: str = "start", end: str = "end") -> DataFrame:
    """Every request with the versions in force: an equi-join on the key with the range as a residual, never a range join."""
    v = versions.withColumnRenamed(key, "__key")
    return requests.join(v, (F.col(key) == F.col("__key")) & in_force(F.col(at), F.col(start), F.col(end)), "left").drop("__key")


def _number(at: Column, kind: str) -> Column:
    return F.unix_date(at).cast("long") if kind == "date" else F.unix_micros(at.cast("timestamp")) if kind.startswith("timestamp") else at.cast("long")


def _time(number: Column, kind: str) -> Column:
    return F.date_from_unix_date(number.cast("int")) if kind == "date" else F.timestamp_micros(number).cast(kind) if kind.startswith("timestamp") else number.cast(kind)


def as_of_status(requests: DataFrame, versions: DataFrame, key: str, at: str, request_id: list[str], start: str = "start", end: str = "end", size: int = 0) -> DataFrame:
    """One row a request: status (ok, not_in_force, ambiguous_version), matches, and the version's start where it is one.

    A sweep, not a join: a version adds one and its start where it begins, and takes both back where it ends. Summed in the
    order of time they tell how many versions are in force and, if that is one, which; overlaps are of no matter. Times are
    whole numbers here. A key's time is cut into buckets of some 90 days; what was in force before a bucket comes from sums
    of buckets, so a hot key is dealt out over its time, and no row is made of a request and a version. `size`: about how many requests
    (and changes) there are, which sets the number of tasks where they are many.
    """
    kind = versions.schema[start].dataType.simpleString()
    width = {"date": 90}.get(kind, 90 * 86_400_000_000 if kind.startswith("timestamp") else 1 << 20)
    s, e = _number(F.col(start), kind), _number(F.col(end), kind)
    some = versions.where(F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))
    change = lambda rows, when, sign: rows.select(F.col(key).alias("k"), when.alias("t"), F.lit(sign).cast("long").alias("n"), (sign * s).alias("s"))
    changes = dealt(change(some, s, 1).unionByName(change(some.where(F.col(end).isNotNull()), e, -1)), size, "k", "t").groupBy("k", "t").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    asked = requests.select(F.col(key).alias("k"), _number(F.col(at), requests.schema[at].dataType.simpleString()).alias("t"), F.struct(*request_id).alias("id"))
    bucket = F.floor(F.col("t") / width).alias("b")
    zero = F.lit(0).cast("long")
    met = dealt(changes.select("k", bucket, "n", "s").unionByName(asked.select("k", bucket, zero.alias("n"), zero.alias("s"))), size, "k", "b")
    met = dealt(met.groupBy("k", "b").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), size, "k")
    earlier = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    before = met.select("k", "b", *(F.coalesce(F.sum(c).over(earlier), zero).alias(f"{c}0") for c in ("n", "s")))
    none = F.lit(None).cast(asked.schema["id"].dataType)
    events = changes.select("k", "t", bucket, "n", "s", none.alias("id"), F.lit(False).alias("asks")).unionByName(asked.select("k", "t", bucket, zero.alias("n"), zero.alias("s"), "id", F.lit(True).alias("asks")))
    upto = Window.partitionBy("k", "b").orderBy("t", "asks").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt(events, size, "k", "b").withColumns({c: F.sum(c).over(upto) for c in ("n", "s")}).where("asks")
    # null keys and times meet nothing here and count as nothing below, so the rows stay where the sweep has put them
    joined = swept.join(dealt(before, size, "k", "b"), ["k", "b"], "left")
    n, total = (F.when(F.col("k").isNotNull() & F.col("t").isNotNull(), F.col(c) + F.col(f"{c}0")).otherwise(zero) for c in ("n", "s"))
    rows = joined.select("id.*", n.alias("matches"), F.when(n == 1, _time(total, kind)).alias("version"))
    n = F.sum("matches")  # rows of one request are one
    out = dealt(rows, size, *request_id).groupBy(*request_id).agg(n.alias("matches"), F.when(n == 1, F.min("version")).alias("version"))
    return out.withColumn("status", F.when(F.col("matches") == 0, "not_in_force").when(F.col("matches") == 1, "ok").otherwise("ambiguous_version"))


def available(versions: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """The ranges of each key, by start."""
    return versions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(start).alias("start"), F.col(end).alias("end")))).alias("available"))


def by_month(intervals: DataFrame, start: str, end: str, last: Column) -> DataFrame:
    """A row for each month that an interval meets: an equi-key for joins by range alone."""
    return intervals.withColumn("bucket", F.explode(F.sequence(F.trunc(start, "month"), F.trunc(F.coalesce(F.date_sub(end, 1), last), "month"), F.expr("interval 1 month"))))
