"""Health, concern and export aggregates over a panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.operators.reconcile import cell_stats, same


def of_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def statuses() -> list[Column]:
    return [of_status("ok").alias("n_ok"), of_status("no_data").alias("n_no_data"), of_status("error").alias("n_error")]


def collection_health(panel: DataFrame) -> DataFrame:
    return panel.agg(F.countDistinct("scrape_date").alias("n_days"), F.countDistinct("scrape_date", "run_id").alias("n_runs"), *statuses(), F.min("scrape_date").alias("first_day"), F.max("scrape_date").alias("last_day"))


def by_series(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Statuses, averages and the mean of each row's excess over the cheapest, in per cent."""
    p, c = F.col("price_gbp"), F.col("price_cheapest_gbp")
    return panel.groupBy(*keys).agg(*statuses(), F.avg(p).alias("mean"), F.avg(c).alias("mean_cheapest"), (100 * F.avg(F.try_divide(p - c, c))).alias("pct_above_cheapest"), F.avg("minutes_off").alias("minutes_off"))


def by_region(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Over ok rows: properties, mean, greatest over least price, and mean counts returned, considered and dropped where the panel has them."""
    p = F.col("price_gbp")
    ok = panel.where("status = 'ok'") if "status" in panel.columns else panel
    counts = [F.avg(c).alias(c) for c in ("n_quotes", "n_considered", "n_dropped_rate_basis") if c in panel.columns]
    return ok.groupBy(*keys).agg(F.count("*").alias("n_ok"), F.countDistinct("property_token").alias("n_properties"), F.avg(p).alias("mean"), F.try_divide(F.max(p), F.min(p)).alias("spread"), *counts)


def worst_routes(panel: DataFrame, top: int = 10) -> DataFrame:
    """Routes with the most rows that are not ok; a null status counts nowhere."""
    bad = F.count_if(F.col("status") != "ok")
    return panel.groupBy("route", "months_ahead").agg(bad.alias("not_ok"), F.count("*").alias("n")).where("not_ok > 0").orderBy(F.desc("not_ok"), "route", "months_ahead").limit(top)


def problem_cells(panel: DataFrame, keys: list[str], message: Column, top: int = 15) -> DataFrame:
    return panel.where("status <> 'ok'").groupBy(*keys).agg(F.min(message).alias("message")).where("message is not null").orderBy(*keys).limit(top)


def concerns(*rules: tuple[str, DataFrame, str, Column, Column]) -> DataFrame:
    """One table of (rule, subject, value): each rule is a table, its subject column, a value and when it is a concern."""
    parts = [t.where(when).select(F.lit(name).alias("rule"), F.col(subject).cast("string").alias("subject"), value.cast("double").alias("value")) for name, t, subject, value, when in rules]
    return reduce(DataFrame.unionByName, parts)


def fare_concerns(health: DataFrame, series: DataFrame, subject: str = "subject", days: int = 10) -> DataFrame:
    """Concerns of a fare panel from its ``collection_health`` and its ``by_series`` rows: error rate over 5 %, fewer than ``days`` days or none, a mean excess over the cheapest above 200 %, minutes off target above 180."""
    total = F.col("n_ok") + F.col("n_no_data") + F.col("n_error")
    whole = health.withColumn("_panel", F.lit("panel"))
    return concerns(
        ("error_rate", whole, "_panel", F.try_divide("n_error", total), F.col("n_error") > 0.05 * total), ("few_days", whole, "_panel", F.col("n_days"), F.col("n_days") < days), ("nothing_collected", whole, "_panel", total, total == 0),
        ("pct_above_cheapest", series, subject, F.col("pct_above_cheapest"), F.col("pct_above_cheapest") > 200), ("minutes_off", series, subject, F.col("minutes_off"), F.col("minutes_off") > 180),
    )


def stay_concerns(regions: DataFrame, published: DataFrame, subject: str = "subject", least: int = 3) -> DataFrame:
    """Concerns of a stay panel from its ``by_region`` rows and of a published series (subject, index_month): a spread above 4, fewer than ``least`` properties, more dropped for their rate than considered, months missing inside a series, nothing published."""
    dropped = [("more_dropped_than_kept", regions, subject, F.col("n_dropped_rate_basis"), F.col("n_dropped_rate_basis") > F.col("n_considered"))] if "n_dropped_rate_basis" in regions.columns else []
    span = F.months_between(F.max("index_month"), F.min("index_month")) + 1
    gaps = published.groupBy(subject).agg((span - F.countDistinct("index_month")).alias("gap"))
    loaded = published.agg(F.count("*").alias("n")).withColumn("_panel", F.lit("published"))
    return concerns(
        ("spread", regions, subject, F.col("spread"), F.col("spread") > 4), ("few_properties", regions, subject, F.col("n_properties"), F.col("n_properties") < least), *dropped,
        ("published_gap", gaps, subject, F.col("gap"), F.col("gap") >= 1), ("nothing_published", loaded, "_panel", F.col("n"), F.col("n") == 0),
    )


def priced_cells(panel: DataFrame, cell: list[str], *counts: Column) -> DataFrame:
    """``counts`` of each cell beside its mean, exact median (an element: the lower of two) and geometric mean."""
    own = [f"_c{i}" for i in range(len(cell))]
    stats = cell_stats(panel, cell, "price_gbp", lower=True).drop("n").withColumnsRenamed(dict(zip(cell, own, strict=True)))
    return panel.groupBy(*cell).agg(*counts).join(stats, same(cell, own)).drop(*own)


def daily_by_series(panel: DataFrame, keys: list[str], date: str = "scrape_date") -> DataFrame:
    """Statuses and price statistics of each day and series."""
    out = priced_cells(panel, [date, *keys], *statuses(), F.avg("price_cheapest_gbp").alias("mean_cheapest"))
    return out.select(*[c for c in out.columns if c != "mean_cheapest"], "mean_cheapest")


def daily_by_region(panel: DataFrame, keys: list[str], date: str = "scrape_date", item: str = "property_token") -> DataFrame:
    """Rows, distinct items and price statistics of each day and cell; rows without a tier are a cell of their own."""
    return priced_cells(panel, [date, *keys], F.count("*").alias("n"), F.countDistinct(item).alias("n_properties"))


def daily_totals(panel: DataFrame, series: list[str], gap: Column) -> DataFrame:
    """One row: statuses, the excess of the mean over the mean of the cheapest in per cent, queries without a direct flight, the series furthest off target, routes with no data where ``gap`` holds."""
    worst = by_series(panel, series).agg(F.max_by(F.concat_ws("/", *series), "minutes_off").alias("worst_series"))
    nothing = F.array_join(F.array_sort(F.collect_set(F.when((F.col("status") == "no_data") & gap, F.col("route")))), ",")
    basis = [F.count_if(F.startswith(F.col("candidate_basis"), F.lit("no_direct_available"))).alias("n_no_direct")] if "candidate_basis" in panel.columns else []
    p, c = F.avg("price_gbp"), F.avg("price_cheapest_gbp")
    return panel.agg(*statuses(), *basis, (100 * (p - c) / c).alias("pct_above_cheapest"), nothing.alias("routes_without_data")).crossJoin(worst)


def published_coverage(published: DataFrame, keys: list[str], vintage: str = "fetched_ts") -> DataFrame:
    """Values, months, first and last month and vintages of each published series."""
    return published.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct("index_month").alias("n_months"), F.min("index_month").alias("first_month"), F.max("index_month").alias("last_month"), F.array_join(F.array_sort(F.collect_set(F.col(vintage).cast("string"))), ", ").alias("vintages"))


def latest_snapshot(panel: DataFrame, date: str = "scrape_date") -> DataFrame:
    """All rows of the newest date."""
    return panel.join(F.broadcast(panel.agg(F.max(date).alias(date))), date, "left_semi")


def coverage_row(panel: DataFrame, published: DataFrame) -> DataFrame:
    """One row of scalars over two tables: aggregates, joined."""
    a = panel.agg(F.count("*").alias("n_rows"), F.countDistinct("scrape_date").alias("n_days"), F.min("scrape_date").alias("first_day"))
    b = published.agg(F.count("*").alias("n_published"), F.max("index_month").alias("last_month"))
    return a.crossJoin(b)


def run_summary(panel: DataFrame) -> DataFrame:
    """Per run: rows, statuses, rows not failed, and distinct routes or properties and priced pinned rows where the panel has them."""
    routes = [F.countDistinct(c).alias(name) for c, name in (("route", "n_routes"), ("property_token", "n_properties")) if c in panel.columns]
    pinned = [F.count_if(F.col("is_panel_property") & F.col("price_gbp").isNotNull()).alias("n_pinned_priced")] if "is_panel_property" in panel.columns else []
    status = statuses() if "status" in panel.columns else []
    return panel.groupBy("scrape_date", "run_id").agg(F.count("*").alias("n_rows"), *status, *routes, *pinned)


def reconciliation_summary(rows: DataFrame, recon: DataFrame, item: str = "property_token") -> DataFrame:
    """One row: panel rows read, rows written, distinct items."""
    return rows.agg(F.count("*").alias("panel_rows"), F.countDistinct(item).alias("n_items")).crossJoin(recon.agg(F.count("*").alias("reconstruction_rows")))


def failure_rate(panel: DataFrame, call: list[str]) -> DataFrame:
    """Failed calls over calls, a call counted once; no calls is a rate of 1, and over 0.34 is unreliable."""
    calls = panel.groupBy(*call).agg(F.bool_and(F.col("status") == "error").alias("_failed"))
    rate = F.coalesce(F.try_divide(F.count_if("_failed"), F.count("*")), F.lit(1.0))
    return calls.agg(rate.alias("failure_rate")).withColumn("unreliable", F.col("failure_rate") > 0.34)
