"""Queries of the calendar functions over the days on which orders were placed, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.functions import calendar as cal
from pricepanel.operators.vintages import add_months_clamped as add_months

Q: dict = {}
O: dict[str, str] = {}

DAYS = "days as (select distinct cast(o_orderdate as date) as day from orders)"
NTH = "(case when month({0} + {1}) = month({0}) then cast({0} + {1} as date) end)"


def tuesday(first: str, n: int | str) -> str:
    """DuckDB: the n-th Tuesday counted from the first of a month (may fall in the next month)."""
    return f"cast({first} + cast((2 - isodow({first}) + 7) % 7 + 7 * ({n} - 1) as int) as date)"


FIRST = "cast(date_trunc('month', day) as date)"
ORDINAL = f"case when abs(datediff('day', {tuesday(FIRST, 3)}, day)) < abs(datediff('day', {tuesday(FIRST, 2)}, day)) then 3 else 2 end"


def query(sql: str, with_days: str = DAYS):
    def register(f):
        def run(spark, sf_dir):
            orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
            return f(orders.select(F.to_date("o_orderdate").alias("day")).distinct())

        Q[f.__name__] = run
        O[f.__name__] = f"with {with_days} {sql}"
        return f

    return register


@query(f"select day, {tuesday(FIRST, 1)} as d1, case when month({tuesday(FIRST, 5)}) = month(day) then {tuesday(FIRST, 5)} end as d5 from days")
def nth_weekday(days):
    return days.select("day", cal.nth_weekday(F.col("day"), "TU", 1).alias("d1"), cal.nth_weekday(F.col("day"), "TU", 5, missing="null").alias("d5"))


@query(f"select day, {tuesday(FIRST, 2)} as second, {tuesday(FIRST, 3)} as third from days")
def candidate_index_days(days):
    a, b = cal.candidate_index_days(F.col("day"))
    return days.select("day", a.alias("second"), b.alias("third"))


@query("select day, case when isodow(day) = 2 then cast((day(day) - 1) // 7 + 1 as int) end as ordinal from days")
def index_day_ordinal(days):
    return days.select("day", cal.index_day_ordinal(F.col("day")).alias("ordinal"))


@query("select day, cast(day + interval 1 month as date) as next, cast(day - interval 3 month as date) as before from days")
def add_months_clamped(days):
    return days.select("day", add_months(F.col("day"), 1).alias("next"), add_months(F.col("day"), -3).alias("before"))


@query(f"select day, cast({ORDINAL} as int) as ordinal from days")
def choose_ordinal(days):
    return days.select("day", cal.choose_ordinal(F.col("day")).alias("ordinal"))


def departure(months: str, ordinal: str) -> str:
    month = f"cast({FIRST} + to_months({months}) as date)"
    wanted = tuesday(month, ordinal)
    return f"case when month({wanted}) = month({month}) then {wanted} else {wanted} - 7 end"


@query(f"select day, {departure('3', '((day(day) - 1) // 7 + 1)')} as departure_date from days where isodow(day) = 2")
def target_departure_date(days):
    return days.where("weekday(day) = 1").select("day", cal.target_departure_date(F.col("day"), 3).alias("departure_date"))


ROUTES = "routes as (select distinct concat('R', cast(c_nationkey as varchar)) as route, case c_nationkey % 3 when 0 then 'domestic' when 1 then 'european' else 'long_haul' end as haul_category from customer)"
LEGS = f"legs as (select route, haul_category, cast(m as int) as months_ahead, day from routes, (select unnest([1, 3, 6]) m) w, days where m = 1 or (m = 3 and haul_category <> 'domestic') or (m = 6 and haul_category = 'long_haul')), dep as (select *, cast({departure('months_ahead', ORDINAL)} as date) as departure_date from legs)"


def routes_of(spark, sf_dir):
    key = F.col("c_nationkey")
    haul = F.when(key % 3 == 0, "domestic").when(key % 3 == 1, "european").otherwise("long_haul")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("R"), key.cast("string")).alias("route"), haul.alias("haul_category")).distinct()


def _expand_legs(spark, sf_dir):
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("day")).distinct()
    return cal.expand_legs(days, routes_of(spark, sf_dir))


Q["expand_legs"] = _expand_legs
O["expand_legs"] = f"with {DAYS}, {ROUTES}, {LEGS} select route, haul_category, months_ahead, day, departure_date, departure_date + 7 * case haul_category when 'domestic' then 1 when 'european' then 2 else 3 end as return_date, cast(months_ahead * 30 as int) as nominal_days, cast(departure_date - day as int) as days_out from dep"


def _expected_calls(spark, sf_dir):
    """Of each day: its legs, and its stay nights at every location."""
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("day")).distinct()
    fares = cal.expected_calls(cal.expand_legs(days, routes_of(spark, sf_dir)), ["day", "haul_category"]).withColumnRenamed("haul_category", "part")
    places = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("location"))
    return fares.unionByName(cal.expected_stay_calls(cal.stays_due(days), places).withColumn("part", F.lit("stays")))


Q["expected_calls"] = _expected_calls


def _target_time(spark, sf_dir):
    return routes_of(spark, sf_dir).select("route", cal.target_time(F.col("haul_category"), {"long_haul": "11:30"}).alias("target"), cal.target_time(F.col("haul_category"), {}, "06:00").alias("overridden"))


Q["target_time"] = _target_time
O["target_time"] = f"with {ROUTES} select route, case when haul_category = 'long_haul' then '11:30' else '09:00' end as target, '06:00' as overridden from routes"


@query("select day as index_day, kind as stay_night_kind, cast(day + x as date) as check_in from days, (values ('index_week', 0), ('thursday_after', 9)) v(kind, x) where isodow(day) = 2")
def expand_stay_nights(days):
    return cal.expand_stay_nights(days.where("weekday(day) = 1").withColumnRenamed("day", "index_day"))


MONTHS = f"months as (select distinct {FIRST} as index_month from days)"
CALENDAR = f"calendar as (select index_month, index_day, kind as stay_night_kind, cast(index_day + x as date) as check_in, a as collection_alignment, case a when 'per_night' then cast(index_day + x - 42 as date) else cast(index_day - 42 as date) end as due_date from (select index_month, unnest([{tuesday('index_month', 2)}, {tuesday('index_month', 3)}]) as index_day from months) d, (values ('index_week', 0), ('thursday_after', 9)) v(kind, x), (values ('per_night'), ('single_day')) u(a))"


@query("select * from calendar", f"{DAYS}, {MONTHS}, {CALENDAR}")
def collection_calendar(days):
    return cal.collection_calendar(days.select(F.trunc("day", "MM").alias("index_month")).distinct())


@query("select index_day, stay_night_kind, collection_alignment, due_date from calendar", f"{DAYS}, {MONTHS}, {CALENDAR}")
def collection_date_for(days):
    return cal.collection_calendar(days.select(F.trunc("day", "MM").alias("index_month")).distinct()).select("index_day", "stay_night_kind", "collection_alignment", "due_date")


@query("select day, index_day, stay_night_kind, check_in, collection_alignment, due_date from (select *, row_number() over (partition by day, check_in, collection_alignment order by index_day, stay_night_kind) k from ahead join calendar using (index_month) where abs(datediff('day', day, due_date)) <= 1) where k = 1", f"{DAYS}, ahead as (select day, cast({FIRST} + to_months(cast(i as int)) as date) as index_month from days, range(1, 4) r(i)), months as (select distinct index_month from ahead), {CALENDAR}")
def stays_due(days):
    return cal.stays_due(days)


@query("select day, day(day) between 8 and 21 as inside from days")
def in_month_window(days):
    return days.select("day", cal.in_month_window(F.col("day")).alias("inside"))


@query(f"select day, {FIRST} as index_month_collection, cast(date_trunc('month', day + 42) as date) as index_month_stay from days")
def attribution_months(days):
    return days.select("day", cal.attribution_months(F.col("day")).alias("index_month_collection"), cal.attribution_months(F.date_add("day", 42)).alias("index_month_stay"))


_DUE = O["stays_due"].split(" select day, index_day, stay_night_kind", 1)
O["expected_calls"] = f"{_DUE[0]}, {ROUTES}, due as (select day, index_day, stay_night_kind{_DUE[1]}) select day, haul_category as part, n * case haul_category when 'domestic' then 1 when 'european' then 2 else 3 end as n_calls from days, (select haul_category, count(*) n from routes group by 1) r union all select day, 'stays', count(*) * (select count(distinct n_name) from nation) from due group by 1"
