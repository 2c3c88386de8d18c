"""Index numbers: matched pairs, relatives, chains, rebasing, bases and month-on-month changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.operators.months import WORD, item_months, month_of_number

#: First months of the collection regimes (fixed values), with the name that holds from then on.
ERAS = (("1900-01-01", "pre_2025_one_day_ahead"), ("2025-01-01", "2025_split_weight"), ("2026-02-01", "2026_six_weeks_two_nights"))


def month_number(c):
    return F.year(c) * 12 + F.month(c)


def methodology_era(month, eras=ERAS):
    """The regime of a month: the last boundary not after it."""
    out = F.lit(eras[0][1])
    for start, name in eras[1:]:
        out = F.when(month >= F.lit(start).cast("date"), name).otherwise(out)
    return out


def spans_methodology_break(earlier, later, eras=ERAS):
    """Would a relative between these months compare two regimes?"""
    return methodology_era(earlier, eras) != methodology_era(later, eras)


def observed_months(prices: DataFrame, keys: list[str]) -> DataFrame:
    """The months of each cell with a price above zero, and their numbers in order."""
    months = prices.where("price > 0").select(*keys, "month").distinct()
    return months.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy("month")))


def matched_pairs(prices: DataFrame, keys: list[str], adjacent: str = "calendar") -> DataFrame:
    """Per item its price in a month and the one before; one window over items, no self join.

    The one before is that of the ``calendar``, or the cell's ``observed`` month before, however long ago.
    """
    w = Window.partitionBy(*keys, "item").orderBy("month")
    priced = prices.where("price > 0")
    priced = priced.withColumn("_at", month_number("month")) if adjacent == "calendar" else priced.join(observed_months(prices, keys), [*keys, "month"])
    seen = priced.withColumns({"_pa": F.lag("_at").over(w), "_pp": F.lag("price").over(w), "_na": F.lead("_at").over(w)})
    return seen.withColumns({"base": F.when(F.col("_pa") == F.col("_at") - 1, F.col("_pp")), "_next": F.coalesce(F.col("_na") == F.col("_at") + 1, F.lit(False))}).drop("_at", "_pa", "_pp", "_na")


def match_counts(prices: DataFrame, keys: list[str]) -> DataFrame:
    """Matched items of each month with the month before, and items in one of the two only; months without an item are left out.

    Prices become month bitmaps; items of a cell with equal bits are counted together, and only their patterns are read bit by bit.
    """
    patterns = item_months(prices.where("price > 0"), [*keys, "item"]).groupBy(*keys, "word", "bits").agg(F.count("*").alias("_items"))
    bit = F.explode(F.sequence(F.lit(1), F.lit(WORD))).alias("_bit")
    held = patterns.select(*keys, "word", "_items", "bits", bit).withColumns({"_here": F.expr("getbit(bits, _bit)") == 1, "_before": F.expr("getbit(bits, _bit - 1)") == 1})
    some = lambda test: F.coalesce(F.sum(F.when(test, F.col("_items"))), F.lit(0))
    here, before = F.col("_here"), F.col("_before")
    counts = held.where(here | before).groupBy(*keys, (F.col("word") * WORD + F.col("_bit") - 1).alias("_at")).agg(some(here & before).alias("n_matched"), some(here != before).alias("n_unmatched"), F.bool_or(here).alias("_any"))
    return counts.where("_any").select(*keys, month_of_number("_at").alias("month"), "n_matched", "n_unmatched")


def price_relative(prices: DataFrame, keys: list[str], min_matched: int = 3, formula: str = "jevons", adjacent: str = "calendar") -> DataFrame:
    """Jevons, Dutot and Carli relatives of each month on the one before; refused under ``min_matched`` items.

    pct_change is that of ``formula``; with ``calendar`` months n_unmatched and match_rate say how many items are in one of the two only.
    """
    pairs = matched_pairs(prices, keys, adjacent)
    out = pairs.where("base is not null").groupBy(*keys, "month").agg(
        F.count("*").alias("n_matched"), F.exp(F.avg(F.log(F.col("price") / F.col("base")))).alias("jevons"), (F.avg("price") / F.avg("base")).alias("dutot"), F.avg(F.col("price") / F.col("base")).alias("carli")
    )
    out = out.where(F.col("n_matched") >= min_matched).withColumn("pct_change", (F.col(formula) - 1) * 100)
    if adjacent != "calendar":
        return out
    counts = match_counts(prices, keys).drop("n_matched")
    return out.join(counts, [*keys, "month"]).withColumn("match_rate", F.col("n_matched") / (F.col("n_matched") + F.col("n_unmatched")))


def splice_nowcast(published: DataFrame, relatives: DataFrame, keys: list[str], formula: str = "jevons") -> DataFrame:
    """Published level of the month before times the relative; no level, no nowcast, and reading one on a level of zero or less fails."""
    level = published.select(*keys, F.add_months("month", 1).alias("month"), F.col("level").alias("_level"))
    refused = F.raise_error(F.concat(F.lit("cannot splice on a level of "), F.col("_level").cast("string"))).cast("double")
    return relatives.join(level, [*keys, "month"]).select(*keys, "month", F.when(F.col("_level") > 0, F.col("_level") * F.col(formula)).when(F.col("_level") <= 0, refused).alias("nowcast"))


def consecutive_pairs(months: DataFrame, keys: list[str], eras=ERAS) -> DataFrame:
    """Months whose month before is there and of the same regime."""
    w = Window.partitionBy(*keys).orderBy("month")
    out = months.withColumn("prev_month", F.lag("month").over(w))
    return out.where((month_number("month") - month_number("prev_month") == 1) & ~spans_methodology_break(F.col("prev_month"), F.col("month"), eras))


def chained_index(prices: DataFrame, keys: list[str], formula: str = "jevons", min_matched: int = 3, base: float = 100.0, adjacent: str = "calendar", eras=ERAS) -> DataFrame:
    """Base 100 at a cell's first month, times each month's relative, up to the first one that is refused.

    With ``calendar`` months a gap and a change of regime end the chain too; with ``observed`` months each is chained to
    the cell's month before, and neither does.
    """
    months = observed_months(prices, keys)
    rel = price_relative(prices, keys, min_matched, formula, adjacent).select(*keys, "month", F.col(formula).alias("_r"))
    w = Window.partitionBy(*keys).orderBy("month")
    rows = months.join(rel, [*keys, "month"], "left").withColumns({"_first": F.col("_at") == 1, "_pm": F.lag("month").over(w)})
    bad = F.col("_r").isNull() if adjacent != "calendar" else F.col("_r").isNull() | spans_methodology_break(F.col("_pm"), F.col("month"), eras)
    rows = rows.withColumn("_broken", F.max(F.when(~F.col("_first") & bad, 1).otherwise(0)).over(w)).where("_broken = 0")
    return rows.select(*keys, "month", (base * F.exp(F.sum(F.when(F.col("_first"), F.lit(0.0)).otherwise(F.log("_r"))).over(w))).alias("level"))


def rebase_january(points: DataFrame, keys: list[str]) -> DataFrame:
    """Level over that of its own year's January, times 100; years without one are dropped."""
    january = F.max(F.when(F.month("month") == 1, F.col("level"))).over(Window.partitionBy(*keys, F.year("month")))
    return points.withColumn("_j", january).where("_j > 0").withColumn("level", F.col("level") / F.col("_j") * 100).drop("_j")


def detect_basis(points: DataFrame, keys: list[str], tolerance: float = 0.5, otherwise: str = "chained") -> DataFrame:
    """Two Januaries at least: all near 100, or not; else unknown."""
    jan = F.month("month") == 1
    out = points.groupBy(*keys).agg(F.count_if(jan).alias("_n"), F.bool_and(F.when(jan, F.abs(F.col("level") - 100) <= tolerance)).alias("_near"))
    return out.select(*keys, F.when(F.col("_n") < 2, "unknown").when(F.col("_near"), "annual_january_100").otherwise(otherwise).alias("basis"))


def month_on_month(points: DataFrame, keys: list[str], eras=None) -> DataFrame:
    """Percentage change on the month before, where there is one with a level above zero; with ``eras`` (stays) not across a change of regime."""
    w = Window.partitionBy(*keys).orderBy("month")
    out = points.withColumns({"_pm": F.lag("month").over(w), "_pl": F.lag("level").over(w)})
    if eras is not None:
        out = out.where(~spans_methodology_break(F.col("_pm"), F.col("month"), eras))
    return out.where((month_number("month") - month_number("_pm") == 1) & (F.col("_pl") > 0)).select(*keys, "month", ((F.col("level") / F.col("_pl") - 1) * 100).alias("pct_change"))
