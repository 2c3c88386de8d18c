"""Vintages: which run counts for a date, latest rows per key, nearest dates, weights as of a year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.operators.months import first_number, item_months, last_number, month_of_number


def current_vintage(panel: DataFrame, date: str = "scrape_date", run: str = "run_id", ts: str = "scrape_ts") -> DataFrame:
    """All rows of the newest run of each date. Rows without a run drop out; a tie of times goes to the greater run id.

    Runs are reduced to one row per date first, so the panel itself is never sorted.
    """
    newest = panel.where(F.col(run).isNotNull()).groupBy(date, run).agg(F.max(ts).alias("_ts"))
    newest = newest.groupBy(date).agg(F.max_by(run, F.struct("_ts", run)).alias(run))
    return panel.join(newest, [date, run])


def panel_for_dates(panel: DataFrame, dates: DataFrame | None = None, price: str = "price_gbp") -> DataFrame:
    """Usable rows: the newest run over all statuses first, then ok rows with a price; some dates or all.

    Where ``dates`` has an index_day too, only the rows of that index day are taken from each of its dates: the run is still
    the newest of all the date's, and two index days of one month do not mix.
    """
    rows = panel if dates is None else panel.join(dates.select("scrape_date").distinct(), "scrape_date", "left_semi")
    used = current_vintage(rows).where((F.col("status") == "ok") & F.col(price).isNotNull())
    return used if dates is None or "index_day" not in dates.columns else used.join(dates.select("scrape_date", "index_day").distinct(), ["scrape_date", "index_day"], "left_semi")


def within_days(left: DataFrame, left_day: str, right: DataFrame, right_day: str, days: int) -> DataFrame:
    """Pairs of rows whose days are at most ``days`` apart: a join on equal buckets of that many days, the left side in its own and both neighbours.

    A row on the right has one bucket, so that a pair meets once. Neither side is compared with all of the other.
    """
    bucket = lambda c: F.floor(F.unix_date(F.col(c)) / max(days, 1))
    near = left.withColumn("_bucket", F.explode(F.sequence(bucket(left_day) - 1, bucket(left_day) + 1)))
    return near.join(right.withColumn("_bucket", bucket(right_day)), "_bucket").where(F.abs(F.datediff(right_day, left_day)) <= days).drop("_bucket")


def nearest_scrape_date(panel: DataFrame, days: DataFrame, window: int = 7) -> DataFrame:
    """For each index day the date with ok rows nearest to it, the earlier of two; offset in days, signed."""
    held = panel.where("status = 'ok'").select("scrape_date").distinct()
    offset = F.datediff("scrape_date", "index_day")
    near = within_days(days, "index_day", held, "scrape_date", window)
    best = near.groupBy("index_day").agg(F.min(F.struct(F.abs(offset).alias("far"), "scrape_date", offset.alias("offset_days"))).alias("b"))
    return best.select("index_day", "b.scrape_date", "b.offset_days")


def resolve_collection_dates(implied: DataFrame, held: DataFrame, tolerance: int = 3) -> DataFrame:
    """For each index month: if an implied date is held, only such dates, offset 0; else each one's nearest held date, and the worst offset."""
    near = within_days(implied, "implied_date", held, "scrape_date", tolerance)
    off = F.datediff("scrape_date", "implied_date")
    each = near.groupBy("index_month", "implied_date").agg(F.min(F.struct(F.abs(off).alias("far"), "scrape_date")).alias("b"))
    exact = F.max((F.col("b.far") == 0).cast("int")).over(Window.partitionBy("index_month")) == 1
    used = each.withColumn("_exact", exact).where(~F.col("_exact") | (F.col("b.far") == 0))
    return used.groupBy("index_month").agg(F.concat_ws(",", F.array_sort(F.collect_set(F.col("b.scrape_date").cast("string")))).alias("dates"), F.max("b.far").alias("worst_offset"))


def collection_start(panel: DataFrame) -> DataFrame:
    return panel.agg(F.min(F.when(F.col("status") == "ok", F.col("scrape_date"))).alias("first_day"))


def reconstructable(months: DataFrame, covered: DataFrame, start: DataFrame, slack: int = 7) -> DataFrame:
    """Months as covered, predating the panel, or a gap in it; ``months`` carries last_day, the last day that could serve."""
    seen = covered.select("index_month").distinct().withColumn("_seen", F.lit(True))
    verdict = F.when(F.col("_seen"), "covered").when(F.col("first_day") > F.date_add("last_day", slack), "predates_panel").otherwise("gap")
    return months.join(seen, "index_month", "left").crossJoin(F.broadcast(start)).select("index_month", verdict.alias("coverage"))


def latest_per_key(rows: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """The newest row of each key among those with a value (partial aggregation, no sort)."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(ts, value)).alias("_r"))
    return best.select(*keys, "_r.*")


def weights_as_of(weights: DataFrame, targets: DataFrame, year: str = "year", allow_placeholder: bool = False) -> DataFrame:
    """Weights of the latest year not after each target year, else of the earliest one.

    Where ``weights`` has is_placeholder, a year of which any row is one is a placeholder year: its flag travels as
    weights_are_placeholder, and reading its weights fails unless ``allow_placeholder``.
    """
    years = weights.select(F.col(year).alias("_y")).distinct()
    pick = targets.crossJoin(F.broadcast(years)).groupBy(*targets.columns).agg(F.coalesce(F.max(F.when(F.col("_y") <= F.col("target_year"), F.col("_y"))), F.min("_y")).alias(year))
    if "is_placeholder" not in weights.columns:
        return pick.join(weights, year)
    flags = weights.groupBy(year).agg(F.bool_or(F.coalesce("is_placeholder", F.lit(False))).alias("weights_are_placeholder"))
    out = pick.join(weights.drop("is_placeholder"), year).join(F.broadcast(flags), year)
    if allow_placeholder:
        return out
    refused = F.raise_error(F.concat(F.lit("weights for "), F.col("target_year").cast("string"), F.lit(" are placeholders; allow_placeholder takes them")))
    return out.withColumn("weight", F.when(F.col("weights_are_placeholder"), refused.cast("double")).otherwise(F.col("weight")))


def normalise_weights(weights: DataFrame, by: str = "year", weight: str = "weight") -> DataFrame:
    """Share of each weight in its year; reading a year that sums to nothing fails."""
    total = F.sum(weight).over(Window.partitionBy(by))
    refused = F.raise_error(F.concat(F.lit(f"weights of {by} "), F.col(by).cast("string"), F.lit(" sum to nothing"))).cast("double")
    return weights.withColumn("_t", total).withColumn("share", F.when(F.coalesce(F.col("_t") > 0, F.lit(False)), F.col(weight) / F.col("_t")).otherwise(refused)).drop("_t")


def group_total(weights: DataFrame, keys: list[str], weight: str = "weight") -> DataFrame:
    """Total weight of each group, as of a haul over its windows."""
    return weights.groupBy(*keys).agg(F.sum(weight).alias("total"))


def missing_days(expected: DataFrame, held: DataFrame, day: str = "scrape_date") -> DataFrame:
    return expected.join(held.select(day).distinct(), day, "left_anti")


def add_months_clamped(day: Column, months: Column | int) -> Column:
    """The same day some months on, the last of the month where it has no such day."""
    return F.add_months(day, months)


def months_between_first(a: Column, b: Column) -> Column:
    """Whole months from b to a, both first days of months."""
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)


def property_churn(panel: DataFrame, keys: list[str], item: str = "property_token", month: str = "index_month_collection", counted: bool = True) -> DataFrame:
    """Per cell and item: first and last month, months seen, rows (if ``counted``), months absent since, status and presence rate.

    The panel is aggregated once, to month bitmaps; months are first days, and rows without one count in n_rows alone.
    """
    months = item_months(panel.where(F.col(item).isNotNull()), [*keys, item], month)
    return churn_of_months(months if counted else months.drop("n_rows"), [*keys, item])


def churn_of_months(months: DataFrame, keys: list[str]) -> DataFrame:
    """The churn of month bitmaps by ``keys``, of one panel or merged from several; bitmaps without n_rows give none."""
    own = F.shiftright("bits", 1)  # without the month before the word
    last = F.when(own > 0, last_number("word", own))
    rows = [c for c in months.columns if c == "n_rows"]
    per = months.groupBy(*keys).agg(F.min(F.when(own > 0, first_number("word", own))).alias("_a"), F.max(last).alias("_z"), F.sum(F.bit_count(own)).alias("months_seen"), *[F.sum(c).alias(c) for c in rows])
    # One row. It takes n_rows along, so that both sides shuffle the same columns and the planner shuffles them once; who does
    # not use n_rows leaves it out of the bitmaps, else it is dropped on the other side only and the panel is shuffled twice.
    latest = months.agg(F.max(F.struct(last.alias("_z"), *rows)).getField("_z").alias("_latest"))
    out = per.crossJoin(F.broadcast(latest))
    absent = (F.col("_latest") - F.col("_z")).cast("int")
    span = F.col("_z") - F.col("_a") + 1
    return out.select(*keys, month_of_number("_a").alias("first_month"), month_of_number("_z").alias("last_month"), "months_seen", *rows, absent.alias("months_absent"), F.when(absent == 0, "present").otherwise("left").alias("churn_status"), F.try_divide("months_seen", span).alias("presence_rate"))


def churn_summary(churn: DataFrame) -> DataFrame:
    """How many items are present or left, and their mean presence."""
    return churn.groupBy("churn_status").agg(F.count("*").alias("n_items"), F.avg("presence_rate").alias("mean_presence"))


def churned_tokens(churn: DataFrame) -> DataFrame:
    """The items that left."""
    return churn.where("churn_status = 'left'")


def churned_panel(churn: DataFrame, pinned: DataFrame, keys: list[str], item: str = "property_token", top: int = 10) -> DataFrame:
    """Of the pinned items that left the ones absent longest."""
    pins = pinned.where(F.col("location").isNotNull()).select(F.col("location").alias("_location"), F.col(item).alias("_item")).distinct()
    # Null-safe, though no location of a pin is null: an equality keeps null locations from the churn on this side only, and the panel is shuffled twice.
    gone = churned_tokens(churn).join(pins, F.col("location").eqNullSafe(F.col("_location")) & (F.col(item) == F.col("_item")), "left_semi")
    return gone.orderBy(F.desc("months_absent"), *keys, item).limit(top)
