"""The document envelope, its enumerations, and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The closed sets of the data model.
CORPORA = ["act", "sl", "judgment", "pdpc", "hansard", "bill"]
URN_GRAMMAR = r"^urn:sg:(?:act|sl|judgment|pdpc|hansard|bill)(?::[A-Za-z0-9._-]+)+(?:@\d{4}-\d{2}-\d{2})?$"
SHA_PATTERN = r"^[0-9a-f]{64}$"

PROVENANCE = "struct<source_url:string,retrieved_at:timestamp,snapshot_sha256:string,adapter:string,adapter_version:string,parser_rev:int>"
DOCUMENT = f"urn string, corpus string, authority string, title string, citation string, issued date, in_force_from date, in_force_to date, language string, text string, parts array<string>, parent string, meta string, provenance {PROVENANCE}"
REF = "`from` string, `to` string, kind string, raw string, confidence double, resolver string"
CHECKPOINT = "key string, at timestamp, note string"


def valid_urn(urn: Column) -> Column:
    """One match of the grammar, with segments that aren't empty; a date must be one, and only legislation takes it."""
    date = F.get(F.split(urn, "@"), F.lit(1))
    dated = date.isNull() | (F.try_to_timestamp(date, F.lit("yyyy-MM-dd")).isNotNull() & (urn.startswith("urn:sg:act:") | urn.startswith("urn:sg:sl:")))
    return F.coalesce(urn.rlike(URN_GRAMMAR) & dated, F.lit(False))


def validate_documents(docs: DataFrame) -> DataFrame:
    """Each row with `violations`: the names of the rules that it breaks, in order. All rules run in one projection."""
    rules = [
        ("urn", ~valid_urn(F.col("urn"))),
        ("corpus", ~F.coalesce(F.col("corpus").isin(CORPORA), F.lit(False))),
        ("title", F.coalesce(F.length(F.trim("title")), F.lit(0)) == 0),
        ("issued", F.col("issued").isNull()),
        ("text", F.col("text").isNull()),
        ("in_force_from", F.col("corpus").isin("act", "sl") & F.col("in_force_from").isNull()),
    ]
    if "parent" in docs.columns:
        rules.append(("parent", F.col("parent").isNotNull() & ~valid_urn(F.col("parent"))))
    if "parts" in docs.columns:
        rules.append(("parts", F.exists(F.coalesce("parts", F.array().cast("array<string>")), lambda p: ~valid_urn(p))))
    if "provenance" in docs.columns:
        p = F.col("provenance")
        rules.append(("provenance", ~F.coalesce(p["snapshot_sha256"].rlike(SHA_PATTERN) & (p["parser_rev"] >= 1), F.lit(False))))
    return docs.withColumn("violations", F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules))))
