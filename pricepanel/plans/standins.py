"""Panels projected from the driver's tables, as SQL that Spark and DuckDB both read."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

STANDINS: dict[str, tuple[tuple[str, ...], str]] = {
    "fare_obs": (
        ("events",),
        """select event_id query_id, ts scrape_ts, cast(ts as date) scrape_date,
  concat('run-', cast(cast(floor(hour(ts) / 6) as int) as string)) run_id,
  concat('R', cast(user_id as string)) route,
  case user_id % 3 when 0 then 'domestic' when 1 then 'european' else 'long_haul' end haul_category,
  case when user_id % 3 = 0 then 1
       when user_id % 3 = 1 then case when event_id % 2 = 0 then 1 else 3 end
       else case event_id % 3 when 0 then 1 when 1 then 3 else 6 end end months_ahead,
  case event_type when 'error' then 'error' when 'signup' then 'no_data' else 'ok' end status,
  case when event_type in ('error', 'signup') then null else value end price_gbp,
  case when event_type in ('error', 'signup') then null else value * (0.5 + (event_id % 6) / 10.0) end price_cheapest_gbp,
  cast((event_id * 37) % 1440 as int) dep_minutes
from events""",
    ),
    "stay_obs": (
        ("lineitem", "orders", "supplier", "nation", "region", "part"),
        """select cast(o_orderdate as date) scrape_date, concat('o', cast(o_orderkey as string)) run_id,
  r_name location, concat('P', cast(l_partkey as string)) property_token,
  case when p_size <= 20 then 'midscale' when p_size <= 40 then 'upscale' else null end property_tier,
  case l_linestatus when 'O' then 'index_week' else 'thursday_after' end stay_night_kind,
  case when l_returnflag = 'N' then 'single_day' else 'per_night' end collection_alignment,
  cast(date_trunc('month', l_shipdate) as date) index_month_stay,
  cast(date_trunc('month', o_orderdate) as date) index_month_collection,
  l_partkey % 3 = 0 is_panel_property, l_extendedprice / l_quantity price_gbp
from lineitem
join orders on l_orderkey = o_orderkey
join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
join part on l_partkey = p_partkey""",
    ),
    "published": (
        ("orders", "customer", "nation", "region"),
        """select a.index_month, a.location, a.fetched_ts, a.lvl / j.lvl * 100 index_value
from (select cast(date_trunc('month', o_orderdate) as date) index_month, r_name location, cast(o_orderkey % 2 as int) fetched_ts, avg(o_totalprice) lvl
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2, 3) a
join (select cast(date_trunc('month', o_orderdate) as date) index_month, r_name location, cast(o_orderkey % 2 as int) fetched_ts, avg(o_totalprice) lvl
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2, 3) j
on a.location = j.location and a.fetched_ts = j.fetched_ts and year(a.index_month) = year(j.index_month) and month(j.index_month) = 1""",
    ),
    "weights": (
        ("supplier", "nation", "region"),
        """select y.yr as year, r_name region, cast(count(*) * (1 + y.yr % 2) as double) weight
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
cross join (select 1996 as yr union all select 1999 as yr) y
group by y.yr, r_name""",
    ),
    "quotes": (
        ("lineitem", "part"),
        """select l_orderkey query_id, cast(l_linenumber as int) pos, l_extendedprice / l_quantity price,
  case l_partkey % 4 when 0 then null when 1 then 1 else 0 end transfers,
  case when l_suppkey % 7 = 0 then null else cast((l_partkey * 37 + l_linenumber * 11) % 1440 as int) end dep_minutes,
  concat('P', cast(l_partkey as string)) property_token,
  case l_suppkey % 5 when 0 then null when 1 then 'Hotel' when 2 then ' inn ' when 3 then 'vacation rental' else '' end property_type,
  case when p_size <= 10 then null when p_size <= 20 then 3.0 when p_size <= 30 then 3.5 when p_size <= 40 then 4.5 else 2.0 end hotel_class,
  case l_returnflag when 'R' then true when 'A' then false else null end free_cancellation,
  case when l_discount > 0.05 then null else l_extendedprice / l_quantity * 0.8 end price_before_taxes
from lineitem join part on l_partkey = p_partkey""",
    ),
    "monthly": (
        ("lineitem", "orders", "supplier", "nation", "region", "part"),
        "",
    ),
}
STANDINS["monthly"] = (
    STANDINS["stay_obs"][0],
    f"select location cell, property_token item, index_month_collection as month, avg(price_gbp) price from ({STANDINS['stay_obs'][1]}) s group by 1, 2, 3",
)

#: What Spark reads in place of a text above: the same rows, with each level made once, so that a January is exactly 100.
#: Two averages of the same rows may differ in their last place by the order of their sums.
ONCE = {
    "published": """select index_month, location, fetched_ts, lvl / j * 100 index_value
from (select *, max(case when month(index_month) = 1 then lvl end) over (partition by location, fetched_ts, year(index_month)) j
  from (select cast(date_trunc('month', o_orderdate) as date) index_month, r_name location, cast(o_orderkey % 2 as int) fetched_ts, avg(o_totalprice) lvl
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    where o_orderdate is not null group by 1, 2, 3) levels) years
where j is not null""",
}


#: Line items of a task where they meet their orders: the memory of its two sorts grows with them, so more rows are more tasks.
ROWS_OF_A_TASK = 500_000


def tasks_for(df: DataFrame) -> int:
    """How many tasks hold ``ROWS_OF_A_TASK`` of the rows each. On tables of files this reads their footers only."""
    return -(-df.count() // ROWS_OF_A_TASK)


def own_tasks(df: DataFrame) -> int | None:
    """``tasks_for`` where those are more than cores; else none, which leaves it to the planner."""
    n = tasks_for(df)
    return n if n > df.sparkSession.sparkContext.defaultParallelism else None


def dealt(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """``df`` by hash of ``keys`` in n parts, which are not joined again; as it is where there are no more parts than cores, as each core gets one anyway."""
    return df.repartition(n, *keys) if n > df.sparkSession.sparkContext.defaultParallelism else df


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, text = STANDINS[name]
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    if {"lineitem", "orders"} <= set(tables):
        n = tasks_for(read["lineitem"])
        read |= {t: dealt(read[t], n, key) for t, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"))}
    for t, df in read.items():
        df.createOrReplaceTempView(t)
    return spark.sql(ONCE.get(name, text))


def scratch(spark) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    return f"{folder.rstrip('/')}/pricepanel-io/{uuid.uuid4().hex}"


def written(df):
    """``df`` as rows on the shared folder: what follows reads it many times over, not the tables that it was made from."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_standins(names: tuple[str, ...], query: str) -> str:
    """Oracle SQL: the stand-ins as common tables in front of a query."""
    parts = [f"{n} as ({STANDINS[n][1]})" for n in names]
    query = query.strip()
    if query.startswith("with "):
        return "with " + ", ".join([*parts, query[5:]])
    return "with " + ", ".join(parts) + " " + query
