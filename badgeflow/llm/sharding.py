"""Jump consistent hashing: stable keys to shards without a ring table.

Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm". The key
seeds a linear congruential generator; each number says to how many shards the
key may still stay where it is, and at the next count it jumps to the new shard.
So with one more shard a key stays or moves to the new one, and nothing is stored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import let, table

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
TWO_64 = 18446744073709551616
TWO_33 = 8589934592
TWO_31 = 2147483648
# Steps that every key takes.
STEPS = 64


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to shards - 1, of a 64-bit key (read as unsigned; NULL as 0).

    The state is an exact decimal, as a 64-bit product may overflow a bigint.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    wide = F.coalesce(key, F.lit(0)).cast("decimal(20,0)")
    state = F.when(wide < 0, wide + F.lit(Decimal(TWO_64)).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")
    multiplier = F.lit(MULTIPLIER).cast("decimal(19,0)")
    modulus = F.lit(Decimal(TWO_64)).cast("decimal(20,0)")

    def jump(acc: Column, _: Column) -> Column:
        def moved(next_state: Column) -> Column:
            high = F.floor(next_state / F.lit(TWO_33).cast("decimal(10,0)")).cast("double") + F.lit(1.0)
            target = F.floor((acc["to"] + F.lit(1)).cast("double") * (F.lit(float(TWO_31)) / high)).cast("long")
            return F.struct(next_state.alias("state"), acc["to"].alias("at"), target.alias("to"))

        advanced = ((acc["state"] * multiplier + F.lit(1)) % modulus).cast("decimal(20,0)")
        return F.when(acc["to"] < shards, let(advanced, moved)).otherwise(acc)

    start = F.struct(state.alias("state"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("to"))
    # Nearly all keys are done after ln(shards) jumps or a few more. Every jump moves up by at
    # least one shard, so `shards` steps always suffice; only keys not done take the rest.
    first = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, STEPS))), start, jump)
    if shards <= STEPS:
        return first["at"].cast("int")

    def rest(acc: Column) -> Column:
        further = F.aggregate(F.sequence(F.lit(STEPS + 1), F.lit(shards)), acc, jump, lambda a: a["at"].cast("int"))
        return F.when(acc["to"] < shards, further).otherwise(acc["at"].cast("int"))

    return let(first, rest)


def shard(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", buckets: int = 4096) -> DataFrame:
    """Every row with its shard, its slot in the shard and its shard among one more.

    Law ``key``: the key and the shard count alone decide. Slots run gapless from 0
    in each shard, ordered by (key mod buckets, key, checksum). They are numbered in
    buckets whose sizes are counted first, so no task sees a whole shard.

    NULL keys count as key 0; NULL texts have no bytes (size 1, checksum 0, as empty
    texts). Rows with equal keys share a shard and have slots of their own. Other
    columns of ``df`` are not read, so their names cannot clash.
    """
    bytes_ = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = df.select(
        F.col(key).cast("long").alias("key"),
        (F.octet_length(bytes_) + 1).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
    ).select(
        "*",
        jump_hash(F.col("key"), shards).alias("shard"),
        jump_hash(F.col("key"), shards + 1).alias("grown_shard"),
        F.pmod(F.coalesce("key", F.lit(0)), F.lit(buckets)).cast("int").alias("bucket"),
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "bucket")
        .count()
        .select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "text_crc32", "size")
    return (
        rows.withColumn("number", F.row_number().over(inside))
        .join(offsets, ["shard", "bucket"])
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            "shard",
            (F.col("offset") + F.col("number") - 1).alias("slot"),
            "grown_shard",
        )
    )


def op2_jump_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7, and where they would be with a ninth."""
    return shard(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
