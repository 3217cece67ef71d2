"""Small filters of the fact's keys, so that a load need not look for what is not there.

A filter of a date is a number of blocks of 32,768 bits. A key (badge, time) belongs to
one block of its date and sets a few bits there (a blocked Bloom filter). What has not
all its bits set is not in the fact; what has them may be, and is looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .staging import DEDUP_KEY

BLOCK_BITS = 1 << 15
BITS_PER_KEY = 4
# Blocks per date: 64 hold a quarter of a million keys at eight bits each. A store for
# more events a day takes more, once and for all.
BLOCKS = 64
KEY_FILTER_SCHEMA = "event_date date, blocks int, block int, bits binary, load_id long"


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64(*DEDUP_KEY), F.lit(blocks)).cast("int")


def _bits() -> Column:
    """Positions in the block."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *DEDUP_KEY), F.lit(BLOCK_BITS)) for i in range(BITS_PER_KEY)])


def key_filter(rows: DataFrame, load_id: int, blocks: int = BLOCKS) -> DataFrame:
    """The filters of the dates of ``rows``: what their keys set."""
    return (
        rows.select(
            F.to_date("event_timestamp").alias("event_date"),
            F.lit(blocks).alias("blocks"),
            _block(blocks).alias("block"),
            F.explode(_bits()).alias("bit"),
        )
        .filter("event_date IS NOT NULL AND block IS NOT NULL")
        .groupBy("event_date", "blocks", "block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .withColumn("load_id", F.lit(load_id).cast("long"))
    )


def merged(filters: DataFrame) -> DataFrame:
    """One row a date and block, of any number of loads."""
    return filters.groupBy("event_date", "blocks", "block").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.max("load_id").alias("load_id")
    )


def is_set(bits: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set; bits count from the lowest of each byte."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.call_function("shiftright", byte, position.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def possibly_loaded(rows: DataFrame, filters: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The keys of ``rows`` that a filter of their date holds: all that are in the fact,
    and few more.

    Rows meet the filters by date and block, a shuffle of keys only; ``filters`` is to be
    pruned to the dates of the rows by the caller. Filters made with another number of
    blocks are an error, as they would answer wrongly.
    """
    asked = rows.select(*DEDUP_KEY).withColumns(
        {"_date": F.to_date("event_timestamp"), "_block": _block(blocks), "_at": _bits()}
    )
    other = F.raise_error(F.lit(f"a key filter was not made with {blocks} blocks a date")).cast("binary")
    held = merged(filters).select(
        F.col("event_date").alias("_date"),
        F.col("block").alias("_block"),
        F.when(F.col("blocks") == blocks, F.col("bits")).otherwise(other).alias("bits"),
    )
    everywhere = F.forall("_at", lambda at: is_set(F.col("bits"), at))
    return asked.join(held, ["_date", "_block"]).filter(everywhere).select(*DEDUP_KEY)
