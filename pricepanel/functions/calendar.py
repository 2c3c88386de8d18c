"""Calendar scalars: index days, collection dates, legs and nights, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Departure windows in months by haul, weeks until the return leg, nominal days out by window (fixed values).
WINDOWS = {"domestic": (1,), "european": (1, 3), "long_haul": (1, 3, 6)}
RETURN_WEEKS = {"domestic": 1, "european": 2, "long_haul": 3}
NOMINAL_DAYS = {1: 30, 3: 90, 6: 180}
DEFAULT_TIME = "09:00"


def lookup(table: dict, key: Column) -> Column:
    out = F.lit(None)
    for k, v in table.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def nth_weekday(day: Column, weekday: str, n: int, missing: str = "refuse") -> Column:
    """The n-th weekday of the month of ``day``; where the month has none reading it fails, or with ``missing`` 'null' it is null."""
    if n < 1 and missing == "refuse":
        raise ValueError(f"no weekday has the number {n}")
    first = F.trunc(day, "MM")
    found = F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))
    there = F.lit(n >= 1) & (F.month(found) == F.month(first)) & (F.year(found) == F.year(first))
    if missing == "null":
        return F.when(there, found)
    return F.when(there | day.isNull(), found).otherwise(_refused(F.concat(F.lit(f"no {weekday} number {n} in "), F.date_format(first, "yyyy-MM"))))


def _refused(said: Column) -> Column:
    return F.raise_error(said).cast("date")


def candidate_index_days(day: Column) -> tuple[Column, Column]:
    return nth_weekday(day, "TU", 2), nth_weekday(day, "TU", 3)


def index_day_ordinal(day: Column) -> Column:
    """Which Tuesday of its month a day is; null for other days."""
    return F.when(F.weekday(day) == 1, (F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("int"))


def choose_ordinal(day: Column) -> Column:
    """2 or 3: exact on a candidate day, else the nearer candidate, the second of equals."""
    second, third = candidate_index_days(day)
    return F.when(F.abs(F.datediff(day, third)) < F.abs(F.datediff(day, second)), 3).otherwise(2)


def target_departure_date(day: Column, months: Column | int, ordinal: Column | None = None) -> Column:
    """The Tuesday of the same ordinal some months on, one week earlier where that month has none.

    Without an ordinal the day is a Tuesday, and reading the date of another day fails; a null day gives null.
    """
    n = F.coalesce(ordinal, index_day_ordinal(day)) if ordinal is not None else index_day_ordinal(day)
    month = F.add_months(F.trunc(day, "MM"), months)
    wanted = F.date_add(F.next_day(F.date_sub(month, 1), "TU"), 7 * (n - 1))
    there = F.when(F.month(wanted) == F.month(month), wanted).otherwise(F.date_sub(wanted, 7))
    return F.when(n.isNull() & day.isNotNull(), _refused(F.concat(F.lit("no Tuesday and no ordinal: "), day.cast("string")))).otherwise(there)


def target_time(haul: Column, times: dict[str, str] | None = None, override: str | None = None) -> Column:
    return F.coalesce(F.lit(override), lookup(times or {}, haul).cast("string"), F.lit(DEFAULT_TIME))


def collection_date_for(night: Column, index_day: Column, alignment: Column, advance: int = 42) -> Column:
    return F.when(alignment == "per_night", F.date_sub(night, advance)).when(alignment == "single_day", F.date_sub(index_day, advance))


def in_month_window(day: Column, first: int = 8, last: int = 21) -> Column:
    return F.dayofmonth(day).between(first, last)


def attribution_months(day: Column) -> Column:
    return F.trunc(day, "MM")


def expand_legs(days: DataFrame, routes: DataFrame) -> DataFrame:
    """Routes x windows of their haul x days: departure, return, nominal and actual days out."""
    windows = F.when(F.lit(False), F.array(F.lit(0)))
    for haul, months in WINDOWS.items():
        windows = F.when(F.col("haul_category") == haul, F.array(*map(F.lit, months))).otherwise(windows)
    legs = routes.withColumn("months_ahead", F.explode(windows)).crossJoin(days)
    leave = target_departure_date(F.col("day"), F.col("months_ahead"), choose_ordinal(F.col("day")))
    legs = legs.withColumn("departure_date", leave)
    return legs.withColumns({
        "return_date": F.date_add("departure_date", lookup(RETURN_WEEKS, F.col("haul_category")) * 7),
        "nominal_days": lookup(NOMINAL_DAYS, F.col("months_ahead")),
        "days_out": F.datediff("departure_date", "day"),
    })


def expected_calls(legs: DataFrame, keys: list[str]) -> DataFrame:
    """Calls of a run: its legs, counted."""
    return legs.groupBy(*keys).agg(F.count("*").alias("n_calls"))


def expected_stay_calls(nights: DataFrame, locations: DataFrame, day: str = "day") -> DataFrame:
    """Calls of each collection day: its stay nights, each at every location."""
    n = locations.agg(F.countDistinct("location").alias("_n"))
    return nights.groupBy(day).agg(F.count("*").alias("n_nights")).crossJoin(F.broadcast(n)).select(day, (F.col("n_nights") * F.col("_n")).alias("n_calls"))


def expand_stay_nights(days: DataFrame) -> DataFrame:
    """An index day's Tuesday night and the Thursday nine days on; reading the nights of a day that is no Tuesday fails."""
    nights = F.array(F.struct(F.lit("index_week").alias("kind"), F.col("index_day").alias("check_in")), F.struct(F.lit("thursday_after").alias("kind"), F.date_add("index_day", 9).alias("check_in")))
    tuesday = F.when((F.weekday("index_day") == 1) | F.col("index_day").isNull(), F.col("index_day")).otherwise(_refused(F.concat(F.lit("no Tuesday: "), F.col("index_day").cast("string"))))
    return days.withColumn("index_day", tuesday).withColumn("_n", F.explode(nights)).select("index_day", F.col("_n.kind").alias("stay_night_kind"), F.col("_n.check_in").alias("check_in"))


def collection_calendar(months: DataFrame, advance: int = 42) -> DataFrame:
    """Due dates of each index month: two candidate days x two nights x two alignments, each once."""
    second, third = candidate_index_days(F.col("index_month"))
    days = months.select("index_month", F.explode(F.array(second, third)).alias("index_day"))
    nights = days.join(expand_stay_nights(days.select("index_day").distinct()), "index_day")
    both = nights.withColumn("collection_alignment", F.explode(F.array(F.lit("per_night"), F.lit("single_day"))))
    return both.withColumn("due_date", collection_date_for(F.col("check_in"), F.col("index_day"), F.col("collection_alignment"), advance)).select("index_month", "index_day", "stay_night_kind", "check_in", "collection_alignment", "due_date")


def stays_due(days: DataFrame, tolerance: int = 1, advance: int = 42) -> DataFrame:
    """Stays a collection day prices: index months one to three ahead, due within ``tolerance`` days; each (day, check-in, alignment) once."""
    months = days.select("day", F.explode(F.array(*[F.add_months(F.trunc("day", "MM"), i) for i in (1, 2, 3)])).alias("index_month"))
    near = months.join(collection_calendar(months.select("index_month").distinct(), advance), "index_month").where(F.abs(F.datediff("due_date", "day")) <= tolerance)
    w = Window.partitionBy("day", "check_in", "collection_alignment").orderBy("index_day", "stay_night_kind")
    return near.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("day", "index_day", "stay_night_kind", "check_in", "collection_alignment", "due_date")
