"""Seasonal profiles, peaks, missing months and segments of published series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def seasonal_profile(points: DataFrame, series: list[str]) -> DataFrame:
    v = F.col("value")
    return points.groupBy(*series, F.month("month").alias("calendar_month")).agg(F.median(v).alias("median"), F.min(v).alias("min"), F.max(v).alias("max"), F.countDistinct(F.year("month")).alias("n_years"))


def seasonal_peak(points: DataFrame, series: list[str]) -> DataFrame:
    """Month of the highest median, the first of equals, with the all-time extremes."""
    profile = seasonal_profile(points, series)
    return profile.groupBy(*series).agg(F.max_by("calendar_month", F.struct("median", -F.col("calendar_month"))).alias("peak_month"), F.max("median").alias("peak_median"), F.max("max").alias("all_time_max"), F.min("min").alias("all_time_min"))


def missing_months(points: DataFrame, series: list[str]) -> DataFrame:
    span = points.groupBy(*series).agg(F.min("month").alias("_a"), F.max("month").alias("_z"))
    months = span.select(*series, F.explode(F.sequence("_a", "_z", F.expr("interval 1 month"))).alias("month"))
    return months.join(points.select(*series, "month").distinct(), [*series, "month"], "left_anti")


def contiguous_segments(points: DataFrame, series: list[str]) -> DataFrame:
    """Runs of adjacent months inside a year; single months are dropped."""
    rows = points.select(*series, F.year("month").alias("year"), F.month("month").alias("_m")).distinct()
    island = F.col("_m") - F.row_number().over(Window.partitionBy(*series, "year").orderBy("_m"))
    return rows.withColumn("_i", island).groupBy(*series, "year", "_i").agg(F.min("_m").alias("from_month"), F.max("_m").alias("to_month"), F.count("*").alias("n")).where("n > 1").drop("_i")


def latest_vs_typical(points: DataFrame, series: list[str]) -> DataFrame:
    """Latest value less the median of the same calendar month in other years."""
    last = points.groupBy(*series).agg(F.max("month").alias("_l"))
    rows = points.join(last, series).where(F.month("month") == F.month("_l"))
    now = F.max(F.when(F.col("month") == F.col("_l"), F.col("value")))
    return rows.groupBy(*series).agg(F.max("_l").alias("month"), (now - F.median(F.when(F.col("month") != F.col("_l"), F.col("value")))).alias("difference"))
