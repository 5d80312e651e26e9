"""Sharding by jump consistent hashing: DataFrame functions only.

A key is the seed of a linear congruential generator; each draw says at which number of shards the key next moves, so the
shard for n shards is the last jump below n. No table of shards is kept, and shards that are appended take only the keys
that move into them, about one in n + 1 for one more. The generator's 64-bit product is made of 32-bit halves, since
long arithmetic may not wrap.

Places within a shard follow the key's order. They are numbered in two steps, so that no task holds a shard: rows are
ranged by key and written; each task's rows of a shard are counted; a row's place is what earlier tasks have of its shard
plus its place in its own task.

Whole numbers are keys as they are, other types by xxhash64. Null keys count as 0 and stand first. Equal keys share a
shard; repeated rows each have a place (their order is the order they were read in), and however many there are, they are
spread over tasks. Null texts are empty. Very long texts are measured where they are read and never shuffled. An empty
table gives no row. Columns other than the key and the text are ignored by `shard`, and written by `write_shards`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import fresh, join_by_size, materialise

#: The generator's factor (a fixed value of the published algorithm).
FACTOR = 2862933555777941757
LOW16, LOW32 = 0xFFFF, 0xFFFFFFFF
#: Jumps that are made before asking whether any is left.
JUMPS = 40


def _and(x: Column, mask: int) -> Column:
    return x.bitwiseAND(F.lit(mask).cast("long"))


def _high(x: Column, bits: int) -> Column:
    return F.shiftrightunsigned(x, bits)


def _times(x: Column, factor: int) -> Column:
    """Both below 2 ** 32: the product's lower 32 bits."""
    return _and(_and(x, LOW16) * factor + _and(_high(x, 16) * factor, LOW16) * 65536, LOW32)


def _draw(high: Column, low: Column) -> tuple[Column, Column]:
    """Halves of key * FACTOR + 1, modulo 2 ** 64."""
    fh, fl = FACTOR >> 32, FACTOR & LOW32
    upper = _high(low, 16) * fl
    total = _and(low, LOW16) * fl + _and(upper, LOW16) * 65536 + 1
    return _and(_high(total, 32) + _high(upper, 16) + _times(high, fl) + _times(low, fh), LOW32), _and(total, LOW32)


def jumps(key: Column, shards: int) -> Column:
    """The shards of a long key, as a struct: `now` of `shards`, `grown` of one more."""
    most = shards + 1

    def jump(s: Column, _: Column) -> Column:
        high, low = _draw(s["high"], s["low"])
        further = F.floor((s["at"] + 1).cast("double") * (F.lit(2147483648.0) / (_high(high, 1) + 1).cast("double")))
        return F.when(s["at"] >= most, s).otherwise(F.struct(high.alias("high"), low.alias("low"), further.alias("at"), F.when(s["at"] < shards, s["at"]).otherwise(s["now"]).alias("now"), s["at"].alias("grown")))

    # at most `most` jumps, nearly always a few: the second fold is entered only by keys that have some left
    def some(s: Column, n: Column) -> Column:
        return F.when(s["at"] >= most, s).otherwise(F.aggregate(F.sequence(F.lit(1), n), s, jump))

    zero = F.lit(0).cast("long")
    start = F.struct(_high(key, 32).alias("high"), _and(key, LOW32).alias("low"), zero.alias("at"), zero.alias("now"), zero.alias("grown"))
    return F.aggregate(F.array(F.lit(min(JUMPS, most)), F.lit(max(1, most - JUMPS))), start, some)


def key_of(rows: DataFrame, key: str) -> Column:
    column = rows[f"`{key}`"]
    whole = rows.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    return F.coalesce(column.cast("long"), F.lit(0).cast("long")) if whole else F.when(column.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(column))


def shard_of(rows: DataFrame, key: str, shards: int) -> Column:
    return jumps(key_of(rows, key), shards)["now"].cast("int")


def placed(rows: DataFrame, order: list[Column], shard: str) -> DataFrame:
    """`rows` with `slot`, gapless from 0 within a shard, in the order given."""
    p = fresh(rows.columns)
    rid, part, n = f"{p}rid", f"{p}part", f"{p}n"
    ranged = rows.withColumn(rid, F.monotonically_increasing_id()).repartitionByRange(*order, F.col(rid))
    held = materialise(ranged.withColumn(part, F.spark_partition_id()))
    counts = held.groupBy(shard, part).agg(F.count(F.lit(1)).alias(n))
    before = materialise(counts.select(shard, part, (F.sum(n).over(Window.partitionBy(shard).orderBy(part)) - F.col(n)).alias(n)))  # a row for each task and shard
    own = F.row_number().over(Window.partitionBy(shard, part).orderBy(*order, rid)) - 1
    return join_by_size(held.withColumn("slot", own), before, [shard, part], "inner", before.count()).withColumn("slot", (F.col("slot") + F.col(n)).cast("long")).drop(rid, part, n)


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id (the key), size (bytes of the text, plus 1), text_crc32, law, shard, slot, grown_shard."""
    body = F.encode(F.coalesce(docs[f"`{text}`"], F.lit("")), "utf-8")
    rows = docs.select(docs[f"`{key}`"].alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), jumps(key_of(docs, key), shards).alias("to"))
    rows = rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("to.now").cast("int").alias("shard"), F.col("to.grown").cast("int").alias("grown_shard"))
    return placed(rows, [F.col("doc_id").asc_nulls_first()], "shard").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """Whole rows as Parquet, one folder `shard=i` a shard; each has a file from every task, so a large shard isn't one task's."""
    if "shard" in docs.columns:
        raise ValueError("the rows have a column shard, which names the folders")
    docs.withColumn("shard", shard_of(docs, key, shards)).write.mode("overwrite").partitionBy("shard").parquet(path)


def leaving(docs: DataFrame, old: int, new: int, key: str = "doc_id") -> DataFrame:
    """Rows that change their shard when `old` shards become `new`, with `old_shard` and `new_shard`; of growth, all go to
    the shards that were appended."""
    p = fresh(docs.columns)
    rows = docs.withColumns({f"{p}a": shard_of(docs, key, old), f"{p}b": shard_of(docs, key, new)}).where(F.col(f"{p}a") != F.col(f"{p}b"))
    return rows.withColumnsRenamed({f"{p}a": "old_shard", f"{p}b": "new_shard"})


def sql(shards: int = 8) -> str:
    """DuckDB SQL for `shard` over documents, with unique doc_ids. CRC-32 by bytes, over a table made by its rule."""
    most = shards + 1
    steps = ["s0 AS (SELECT doc_id, CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END AS key, 0::BIGINT AS jump, 0::BIGINT AS now, 0::BIGINT AS grown FROM documents)"]
    for i in range(most):
        further = "floor((jump + 1)::DOUBLE * (2147483648::DOUBLE / ((key >> 33) + 1)::DOUBLE))::BIGINT"
        steps.append(f"t{i} AS (SELECT doc_id, CASE WHEN jump < {most} THEN (key * {FACTOR} + 1) % 18446744073709551616 ELSE key END AS key, jump, CASE WHEN jump < {shards} THEN jump ELSE now END AS now, CASE WHEN jump < {most} THEN jump ELSE grown END AS grown FROM s{i})")
        steps.append(f"s{i + 1} AS (SELECT doc_id, key, CASE WHEN jump < {most} THEN {further} ELSE jump END AS jump, now, grown FROM t{i})")
    table = "list_transform(range(256), lambda c: list_reduce(list_prepend(c, range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"
    crc = "xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda x, y: xor(x >> 8, t[1 + (xor(x, y) & 255)])), 4294967295)"
    return f"""WITH {", ".join(steps)},
tab AS MATERIALIZED (SELECT {table} AS t),
body AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
raw AS (SELECT doc_id, size, list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM body)
SELECT doc_id, size::BIGINT AS size, {crc}::BIGINT AS text_crc32, 'key' AS law, now::INTEGER AS shard, row_number() OVER (PARTITION BY now ORDER BY doc_id) - 1 AS slot, grown::INTEGER AS grown_shard
FROM raw JOIN s{most} USING (doc_id), tab"""


SQL = sql()
