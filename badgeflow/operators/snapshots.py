"""Net changes between two states of a table that is rewritten, as a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def net_changes(before: DataFrame, after: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """What turned ``before`` into ``after``: rows with ``_action`` and ``_is_update``.

    Rows are compared by a 128-bit digest of all columns and counted, so equal rows may
    be there several times and only the surplus is a change. Rows gone and rows come that
    share the key columns are paired, as far as there are both, and marked as an update;
    what is left over is a plain DELETE or INSERT. Rows are counted where they are read,
    and equal rows of both states meet by their digest alone: a key that holds very many
    unchanged rows costs what its changes cost.
    """
    columns = before.columns
    whole = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    row_id = F.unhex(F.left(F.sha2(F.encode(whole, "UTF-8"), 256), F.lit(32)))

    def side(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*columns, row_id.alias("_digest"), F.lit(sign).alias("_sign"))

    counted = (
        side(before, -1)
        .unionByName(side(after.select(*columns), 1))
        .groupBy("_digest")
        .agg(F.sum("_sign").alias("_surplus"), *[F.first(c).alias(c) for c in columns])
        .filter(F.col("_surplus") != 0)
    )
    changed = counted.select(
        *columns,
        "_digest",
        (F.col("_surplus") > 0).alias("_came"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_surplus"))).alias("_copy"),
    )
    in_key = Window.partitionBy(*key, "_came").orderBy("_digest", "_copy")
    sides = Window.partitionBy(*key)
    paired = changed.withColumn("_place", F.row_number().over(in_key)).withColumns(
        {"_came_n": F.count_if("_came").over(sides), "_gone_n": F.count_if(~F.col("_came")).over(sides)}
    )
    return paired.select(
        *columns,
        F.when(F.col("_came"), "INSERT").otherwise("DELETE").alias("_action"),
        (F.col("_place") <= F.least("_came_n", "_gone_n")).alias("_is_update"),
        F.xxhash64(*columns).alias("_row_id"),
    )
