"""Scoring reconstructions against the published series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.operators.index_numbers import ERAS, methodology_era, month_number


def score_join(recon: DataFrame, published: DataFrame, on: list[str]) -> DataFrame:
    """Reconstructed and published values of the same cell and month; 'all' rows and null keys meet nothing."""
    return recon.join(published, on)


def scored_pairs(rows: DataFrame, variant: list[str], usable_only: bool = True, eras=ERAS) -> DataFrame:
    """Each month of a variant with the one before: changes on both sides and the spliced nowcast's error.

    ``usable_only`` keeps consecutive months of one regime; without it, adjacent rows pair even over gaps.
    """
    w = Window.partitionBy(*variant).orderBy("index_month")
    out = rows.withColumns({"_pm": F.lag("index_month").over(w), "_pr": F.lag("reconstructed").over(w), "_pp": F.lag("published").over(w)}).where("_pm is not null and _pr <> 0 and _pp <> 0")
    if usable_only:
        out = out.where((month_number("index_month") - month_number("_pm") == 1) & (methodology_era(F.col("index_month"), eras) == methodology_era(F.col("_pm"), eras)))
    dr, dp = (F.col("reconstructed") / F.col("_pr") - 1) * 100, (F.col("published") / F.col("_pp") - 1) * 100
    return out.withColumns({"error": dr - dp, "published_change": dp, "nowcast_error": F.abs(F.col("_pp") * F.col("reconstructed") / F.col("_pr") - F.col("published"))}).drop("_pm", "_pr", "_pp")


def score_variant(pairs: DataFrame, variant: list[str]) -> DataFrame:
    """Mean absolute error, bias, spliced nowcast error and MAPE of each variant."""
    return pairs.groupBy(*variant).agg(
        F.count("*").alias("n_pairs"), F.avg(F.abs("error")).alias("mae"), F.avg("error").alias("bias"), F.avg("nowcast_error").alias("nowcast_mae"),
        F.avg(F.when(F.col("published_change") != 0, F.abs(F.col("error") / F.col("published_change")) * 100)).alias("mape"),
    )


def rolling_mae(pairs: DataFrame, variant: list[str]) -> DataFrame:
    """Mean over k = 1 .. n - 1 of the first k absolute errors' mean; fewer than two pairs give null."""
    order = Window.partitionBy(*variant).orderBy("index_month")
    out = pairs.withColumns({"_m": F.avg(F.abs("error")).over(order.rowsBetween(Window.unboundedPreceding, 0)), "_last": F.lead("index_month").over(order).isNull()})
    return out.groupBy(*variant).agg(F.avg(F.when(~F.col("_last"), F.col("_m"))).alias("rolling_mae"))


def longest_run(rows: DataFrame, keys: list[str], month: str = "index_month", eras=ERAS) -> DataFrame:
    """Most consecutive months of one regime, by gaps and islands."""
    months = rows.select(*keys, month).distinct().withColumn("_era", methodology_era(F.col(month), eras))
    island = month_number(month) - F.row_number().over(Window.partitionBy(*keys, "_era").orderBy(month))
    runs = months.withColumn("_i", island).groupBy(*keys, "_era", "_i").agg(F.count("*").alias("_n"))
    return runs.groupBy(*keys).agg(F.max("_n").alias("longest_run"))


def provenance_blockers(rows: DataFrame) -> DataFrame:
    """(blocker, n) for what forbids a final verdict; one aggregate, no window."""
    one = rows.agg(
        F.count_if("weights_are_placeholder").alias("a"), F.count_if("source_is_cached").alias("b"), F.count_if(~F.col("index_day_exact")).alias("c"), F.count_if(F.col("rate_basis") == "any").alias("d"),
        F.count_if(~F.col("board_basis_known")).alias("e"), F.greatest(F.countDistinct("era") - 1, F.lit(0)).alias("f"), F.coalesce(F.sum("n_churned"), F.lit(0)).alias("g"),
    )
    return one.selectExpr("stack(7, 'placeholder_weights', a, 'cached_source', b, 'inexact_index_day', c, 'any_rate_basis', d, 'unknown_board', e, 'several_eras', f, 'churned_items', g) as (blocker, n)").where("n > 0")


def distinct_months(rows: DataFrame, month: str = "index_month") -> DataFrame:
    """How many months two series share at all, in one row: the overlap of fares, which may have gaps."""
    return rows.agg(F.count_distinct(month).alias("n_months"))


def verdict(overlap: DataFrame, blockers: DataFrame, least: int = 3) -> DataFrame:
    """One row: INSUFFICIENT_DATA under ``least`` months of overlap, PROVISIONAL with blockers, else SCORED.

    ``overlap`` has longest_run (stays: months in a row of one regime) or n_months (fares: distinct months); the greatest counts.
    """
    months = overlap.agg(F.coalesce(F.max("n_months" if "n_months" in overlap.columns else "longest_run"), F.lit(0)).alias("overlap_months"))
    counted = blockers.agg(F.count("*").alias("n_blockers"))
    said = F.when(F.col("overlap_months") < least, "INSUFFICIENT_DATA").when(F.col("n_blockers") > 0, "PROVISIONAL").otherwise("SCORED")
    return months.crossJoin(counted).withColumn("verdict", said)


def best_variant(scores: DataFrame, cell: list[str], name: str = "variant") -> DataFrame:
    """The variant of the least error in each cell and how many were compared; ties by name."""
    w = Window.partitionBy(*cell)
    ranked = scores.where("mae is not null").withColumns({"_k": F.row_number().over(w.orderBy("mae", name)), "n_compared": F.count("*").over(w)})
    return ranked.where("_k = 1").drop("_k")
