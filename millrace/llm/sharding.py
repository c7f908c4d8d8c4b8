"""Sharding by extendible hashing, with DataFrame functions only.

Rows are hashed; a shard is a prefix of hash bits. The directory starts with one shard, and only a shard above
the byte limit is split on its next bit, until every shard fits. Bits are taken eight at a time: the bytes per
slot of eight more bits are counted for the rows of oversized slots alone, and the directory of a round says
for each slot which shard (how many bits) it belongs to.

Rows of one hash value cannot be parted by bits. If they exceed the limit they go to overflow pages in key
order, each within the limit (a row above half the limit has a page of its own); a single row larger than the
limit is a shard of its own and is reported with fits = false.

Defined results: a null key is hashed as an empty one, a null or empty text has 0 bytes; rows that repeat stay
rows and share a shard or its pages; an empty table gives no rows; other columns are ignored by ``assign`` and
kept by ``write_shards``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.plans.durable import staged
from millrace.plans.ordering import running_sums
from millrace.plans.sizing import broadcast_if_small

SHARD_BYTES = 64 << 20
HASH_BITS = 48
STEP = 8


def hash_bits(key: Column) -> Column:
    """The first 48 bits of the MD5 of a key, as a number."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _bits(slot: Column, depth: Column) -> Column:
    """A shard's name: its prefix of ``depth`` bits, "" for the shard of all rows."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.conv(slot.cast("string"), 10, 2), depth, "0"))


def directory(keyed: DataFrame, limit: int, depth: int) -> DataFrame:
    """(slot, local_depth, shard_bytes) for slots of ``depth`` bits; local_depth is null where ``depth`` bits are too few.

    ``keyed`` has _hash and _bytes. A slot's shard is the shortest prefix whose bytes fit, beyond the bits that
    were found too few before.
    """
    slots = (keyed.groupBy(F.shiftright("_hash", HASH_BITS - depth).alias("slot"))
             .agg(F.sum("_bytes").alias("_sum")))
    parent = F.shiftright("slot", STEP)
    first = 0 if depth == STEP else depth - STEP + 1
    lengths = range(first, depth + 1)
    totals = slots.select("slot", *[
        F.sum("_sum").over(W.partitionBy(parent, F.shiftright("slot", depth - n))).alias(f"_t{n}") for n in lengths])
    local = F.coalesce(*[F.when(F.col(f"_t{n}") <= limit, F.lit(n)) for n in lengths])
    return totals.select("slot", local.alias("local_depth"), F.coalesce(
        *[F.when(F.col(f"_t{n}") <= limit, F.col(f"_t{n}")) for n in lengths]).alias("shard_bytes"))


def assign(df: DataFrame, limit: int = SHARD_BYTES, key_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(key, n_bytes, shard, local_depth, shard_bytes, fits) for every row."""
    rest = staged(df.select(F.col(key_column).alias("_key"), hash_bits(F.col(key_column)).alias("_hash"),
                            F.coalesce(F.octet_length(text_column), F.lit(0)).cast("bigint").alias("_bytes")), "keys")
    done: list[DataFrame] = []
    for depth in range(STEP, HASH_BITS + 1, STEP):
        slots = staged(directory(rest, limit, depth), "slots")
        placed = (rest.withColumn("slot", F.shiftright("_hash", HASH_BITS - depth))
                  .join(broadcast_if_small(slots), "slot"))
        prefix = F.call_function("shiftright", F.col("slot"), depth - F.col("local_depth"))
        done.append(placed.where(F.col("local_depth").isNotNull())
                    .select("_key", "_bytes", _bits(prefix, F.col("local_depth")).alias("shard"), "local_depth", "shard_bytes"))
        if slots.where(F.col("local_depth").isNull()).isEmpty():
            break
        rest = staged(placed.where(F.col("local_depth").isNull()).select("_key", "_hash", "_bytes"), "oversized")
    else:
        done.append(_overflow(rest, limit))
    return (reduce(DataFrame.unionByName, done)
            .select(F.col("_key").alias(key_column), F.col("_bytes").alias("n_bytes"), "shard", "local_depth", "shard_bytes",
                    (F.col("shard_bytes") <= limit).alias("fits")))


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Pages of rows that share all bits. Pages start at multiples of half the limit and take rows of up to half of it."""
    half = max(1, limit // 2)
    numbered = rows.withColumn("_n", F.monotonically_increasing_id())
    small = running_sums(staged(numbered.where(F.col("_bytes") <= half), "small"), ["_bytes", "_n"],
                         {"_end": F.col("_bytes")}, ["_hash"])
    small = small.withColumn("_page", F.concat(F.lit("p"), F.floor((F.col("_end") - F.col("_bytes")) / half).cast("string")))
    large = numbered.where(F.col("_bytes") > half).withColumn("_page", F.concat(F.lit("r"), F.col("_n").cast("string")))
    paged = small.select("_key", "_hash", "_bytes", "_page").unionByName(large.select("_key", "_hash", "_bytes", "_page"))
    sizes = paged.groupBy("_hash", "_page").agg(F.sum("_bytes").alias("shard_bytes"))
    return (paged.join(sizes, ["_hash", "_page"])
            .select("_key", "_bytes", F.concat_ws("-", _bits(F.col("_hash"), F.lit(HASH_BITS)), "_page").alias("shard"),
                    F.lit(HASH_BITS).alias("local_depth"), "shard_bytes"))


def write_shards(df: DataFrame, path: str, limit: int = SHARD_BYTES, key_column: str = "doc_id", text_column: str = "text") -> None:
    """Writes the rows of ``df`` under ``path``, one folder per shard. Keys must be unique."""
    shards = assign(df, limit, key_column, text_column).select(F.col(key_column).alias("_key"), "shard")
    (df.join(shards, df[key_column].eqNullSafe(shards["_key"])).drop("_key")
     .repartition("shard").write.partitionBy("shard").parquet(path))
