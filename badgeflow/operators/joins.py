"""Joins to dimensions.

No join here forces a broadcast of a dimension: users grow with the data. Spark
broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where
adaptive execution splits partitions of hot keys. ``salted_join`` spreads hot
keys by plan instead, for jobs that must not rely on run-time statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_SHARE = 200


def heavy_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys holding at least 1/share of all rows, so at most ``share`` of them.

    Rows that are counts already say so in a column ``n``.
    """
    size = F.sum("n") if "n" in rows.columns else F.count(F.lit(1))
    counts = rows.groupBy(key).agg(size.alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.filter(F.col("n") * share >= total).select(key)


def salted_join(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: tuple[str, ...],
    salts: int = 32,
    how: str = "inner",
) -> DataFrame:
    """Equi-join in which every hot key is spread over ``salts`` partitions.

    Only the dimension rows of hot keys are repeated. ``hot`` comes from
    ``heavy_keys`` and is bounded by its share, hence the broadcast.
    """
    flagged = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    left = (
        rows.join(flagged, key, "left")
        .withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)))
        .drop("_hot")
    )
    right = (
        dim.join(flagged, key, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                    F.array(F.lit(0))
                )
            ),
        )
        .drop("_hot")
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")
