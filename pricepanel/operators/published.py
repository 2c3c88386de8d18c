"""Published series: rows with basis and regime, coverage as loaded, plausible values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.operators.index_numbers import ERAS, detect_basis, methodology_era
from pricepanel.operators.vintages import months_between_first


def plausible_values(rows: DataFrame, value: str = "index_value", low: float | None = 10.0, high: float | None = 500.0) -> DataFrame:
    """Values from ``low`` to ``high``, as of a regional grid; without bounds all above zero."""
    return rows.where(F.col(value).between(low, high) if low is not None else F.col(value) > 0)


def published_rows(values: DataFrame, series: list[str], eras=ERAS) -> DataFrame:
    """Each value as a 4-place decimal with the basis of its series, the regime of its month, and is_current, true on every row."""
    basis = detect_basis(values.select(*series, F.col("index_month").alias("month"), F.col("index_value").alias("level")), series)
    named = values.join(basis, series)
    return named.withColumns({"index_value": F.col("index_value").cast("decimal(18,4)"), "methodology_era": methodology_era(F.col("index_month"), eras), "is_current": F.lit(True)})


def coverage_report(values: DataFrame, source: str, eras=ERAS) -> DataFrame:
    """Per source what was loaded: values, distinct months, first and last, calendar span and holes in it, and sorted locations, regimes and bases."""
    sorted_set = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    span = months_between_first(F.max("index_month"), F.min("index_month")) + 1
    bases = [sorted_set("basis").alias("bases")] if "basis" in values.columns else []
    return values.groupBy(source).agg(
        F.count("*").alias("n_values"), F.countDistinct("index_month").alias("n_months"), F.min("index_month").alias("first_month"), F.max("index_month").alias("last_month"), span.alias("span_months"),
        (span - F.countDistinct("index_month")).alias("n_holes"), sorted_set("location").alias("locations"), sorted_set(methodology_era(F.col("index_month"), eras)).alias("eras"), *bases,
    )
