"""Ratios, shares and the exact median."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

GIB = float(1024**3)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; NULL where the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(ratio(F.lit(100.0) * part.cast("double"), whole), digits)


def gib(num_bytes: Column) -> Column:
    return num_bytes.cast("double") / F.lit(GIB)


def mean(value: Column) -> Column:
    """Average of an exact number, summed exactly and divided once as double."""
    return ratio(F.sum(value), F.count(value))


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """(v, n): how often each value occurs, NULL left out."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def median_of_longs(df: DataFrame, value: str, bucket: int = 3600) -> DataFrame:
    """Exact, interpolated median of an integer column as one row ``median``."""
    return median_of_counts(value_counts(df, value), bucket)


def median_of_counts(counts: DataFrame, bucket: int = 3600) -> DataFrame:
    """The same from ``value_counts``.

    Values are counted first (map-side combined), then ranked in two steps:
    over coarse buckets of ``bucket`` values, and inside the one or two buckets
    that hold the middle ranks. Neither ranked set grows with the row count:
    the first is bounded by value range / bucket, the second by 2 x bucket.
    """
    hist = counts.withColumn("b", F.floor(F.col("v") / F.lit(bucket)).cast("long"))
    up_to = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    coarse = (
        hist.groupBy("b")
        .agg(F.sum("n").alias("bn"))
        .withColumn("before", F.coalesce(F.sum("bn").over(up_to), F.lit(0)))
        .withColumn("total", F.sum("bn").over(everything))
        .withColumn("lo", F.floor((F.col("total") - 1) / 2))
        .withColumn("hi", F.floor(F.col("total") / 2))
        .filter((F.col("before") <= F.col("hi")) & (F.col("lo") < F.col("before") + F.col("bn")))
    )
    in_bucket = Window.partitionBy("b").orderBy("v")
    ranked = (
        hist.join(F.broadcast(coarse), "b")  # at most two rows
        .withColumn("last", F.col("before") + F.sum("n").over(in_bucket) - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    hits = [
        F.max(F.when(F.col(rank).between(F.col("first"), F.col("last")), F.col("v")))
        for rank in ("lo", "hi")
    ]
    return ranked.agg(((hits[0] + hits[1]) / F.lit(2.0)).cast("double").alias("median"))
