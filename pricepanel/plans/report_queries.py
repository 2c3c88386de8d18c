"""Queries of scoring, monitoring, export and seasonal operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.operators import monitoring as mo
from pricepanel.operators import reconcile as rc
from pricepanel.operators import scoring as sc
from pricepanel.operators import seasonal as se
from pricepanel.operators import vintages as vt
from pricepanel.plans import panel_queries as pq
from pricepanel.plans.panel_queries import CURRENT, ERA, STAND_IN_ERAS, rounded
from pricepanel.plans.standins import standin, with_standins

Q: dict = {}
O: dict[str, str] = {}


def query(*names: str, sql: str | None = None):
    def register(f):
        Q[f.__name__] = lambda spark, sf_dir: f(*[standin(spark, sf_dir, n) for n in names])
        if sql:
            O[f.__name__] = with_standins(names, sql)
        return f

    return register


SCORE = f"with {pq.LATEST_PUB}, rc as (select index_month_collection index_month, location, stay_night_kind variant, avg(price_gbp) r from stay_obs group by 1, 2, 3), sj as (select rc.index_month, rc.location, rc.variant, r reconstructed, index_value published from rc join lp on rc.index_month = lp.index_month and rc.location = lp.location), pr0 as (select *, lag(index_month) over w pm, lag(reconstructed) over w rr, lag(published) over w pp from sj window w as (partition by location, variant order by index_month)), pairs as (select *, (reconstructed / rr - 1) * 100 - (published / pp - 1) * 100 error, (published / pp - 1) * 100 published_change, abs(pp * reconstructed / rr - published) nowcast_error from pr0 where pm is not null and rr <> 0 and pp <> 0 and datediff('month', pm, index_month) = 1 and {ERA.format('index_month')} = {ERA.format('pm')}), score as (select location, variant, count(*) n_pairs, avg(abs(error)) mae, avg(error) bias, avg(nowcast_error) nowcast_mae, avg(case when published_change <> 0 then abs(error / published_change) * 100 end) mape from pairs group by 1, 2)"


def joined(stays, published):
    r = stays.groupBy(F.col("index_month_collection").alias("index_month"), "location", F.col("stay_night_kind").alias("variant")).agg(F.avg("price_gbp").alias("reconstructed"))
    p = vt.latest_per_key(published, ["index_month", "location"], "fetched_ts", "index_value").select("index_month", "location", F.col("index_value").alias("published"))
    return sc.score_join(r, p, ["index_month", "location"])


def pairs(stays, published):
    return sc.scored_pairs(joined(stays, published), ["location", "variant"], eras=STAND_IN_ERAS)


@query("stay_obs", "published", sql=SCORE + " select index_month, location, variant, round(reconstructed, 4) reconstructed, round(published, 4) published from sj")
def score_join(stays, published):
    return rounded(joined(stays, published), "reconstructed", "published")


@query("stay_obs", "published", sql=SCORE + " select location, variant, n_pairs, round(mae, 4) mae, round(bias, 4) bias, round(nowcast_mae, 4) nowcast_mae, round(mape, 2) mape from score")
def score_variant(stays, published):
    out = rounded(sc.score_variant(pairs(stays, published), ["location", "variant"]), "mae", "bias", "nowcast_mae")
    return rounded(out, "mape", places=2)


@query("stay_obs", "published", sql=SCORE + ", m as (select location, variant, avg(abs(error)) over (partition by location, variant order by index_month rows unbounded preceding) a, lead(index_month) over (partition by location, variant order by index_month) nx from pairs) select location, variant, round(avg(case when nx is not null then a end), 4) rolling_mae from m group by 1, 2")
def rolling_mae(stays, published):
    return rounded(sc.rolling_mae(pairs(stays, published), ["location", "variant"]), "rolling_mae")


RUNS = f"mm as (select distinct location, index_month, {ERA.format('index_month')} era from sj), ii as (select *, year(index_month) * 12 + month(index_month) - row_number() over (partition by location, era order by index_month) i from mm), lr as (select location, max(n) longest_run from (select location, era, i, count(*) n from ii group by 1, 2, 3) group by 1)"


@query("stay_obs", "published", sql=SCORE + f", {RUNS} select * from lr")
def longest_run(stays, published):
    return sc.longest_run(joined(stays, published), ["location"], eras=STAND_IN_ERAS)


BLOCK = f"bl as (select count(*) filter (index_month < date '1997-01-01') a, count(*) filter (variant = 'index_week') b, count(*) filter (not (month(index_month) % 2 = 0)) c, count(*) filter (location = 'none') d, count(*) filter (not (location <> 'ASIA')) e, greatest(count(distinct {ERA.format('index_month')}) - 1, 0) f, cast(coalesce(sum(month(index_month)), 0) as bigint) g from sj), bs as (select * from (select unnest(['placeholder_weights', 'cached_source', 'inexact_index_day', 'any_rate_basis', 'unknown_board', 'several_eras', 'churned_items']) blocker, unnest([a, b, c, d, e, f, g]) n from bl) where n > 0)"


def blockers(rows):
    from pricepanel.operators.index_numbers import methodology_era

    flagged = rows.withColumns({"weights_are_placeholder": F.col("index_month") < F.lit("1997-01-01").cast("date"), "source_is_cached": F.col("variant") == "index_week", "index_day_exact": F.month("index_month") % 2 == 0, "rate_basis": F.when(F.col("location") == "none", "any").otherwise("refundable"), "board_basis_known": F.col("location") != "ASIA", "era": methodology_era(F.col("index_month"), STAND_IN_ERAS), "n_churned": F.month("index_month")})
    return sc.provenance_blockers(flagged)


@query("stay_obs", "published", sql=SCORE + f", {BLOCK} select blocker, n from bs")
def provenance_blockers(stays, published):
    return blockers(joined(stays, published))


@query("stay_obs", "published", sql=SCORE + f", {RUNS}, {BLOCK}, o as (select 'stays' rule, coalesce(max(longest_run), 0) m from lr union all select 'fares', count(distinct index_month) from sj union all select 'two fares', count(distinct index_month) from sj where month(index_month) = 5 and year(index_month) < 1994) select rule, m overlap_months, (select count(*) from bs) n_blockers, case when m < 3 then 'INSUFFICIENT_DATA' when (select count(*) from bs) > 0 then 'PROVISIONAL' else 'SCORED' end verdict from o")
def verdict(stays, published):
    """Stays need months in a row, fares any months; two Mays are too few for either."""
    rows = joined(stays, published)
    mays = rows.where("month(index_month) = 5 and year(index_month) < 1994")
    said = {"stays": sc.longest_run(rows, ["location"], eras=STAND_IN_ERAS), "fares": sc.distinct_months(rows), "two fares": sc.distinct_months(mays)}
    out = [sc.verdict(overlap, blockers(rows)).withColumn("rule", F.lit(name)) for name, overlap in said.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("stay_obs", "published", sql=SCORE + ", k as (select *, row_number() over (partition by location order by mae, variant) k, count(*) over (partition by location) n_compared from score) select location, variant, n_compared, round(mae, 4) mae from k where k = 1")
def best_variant(stays, published):
    return rounded(sc.best_variant(sc.score_variant(pairs(stays, published), ["location", "variant"]), ["location"]).select("location", "variant", "n_compared", "mae"), "mae")


STATUS = "count(*) filter (status = 'ok') n_ok, count(*) filter (status = 'no_data') n_no_data, count(*) filter (status = 'error') n_error"


@query("fare_obs", sql=f"select count(distinct scrape_date) n_days, count(distinct concat(scrape_date, run_id)) n_runs, {STATUS}, min(scrape_date) first_day, max(scrape_date) last_day from fare_obs")
def collection_health(fares):
    return mo.collection_health(fares)


def off_target(fares):
    d = F.abs(F.col("dep_minutes") - 540)
    return fares.withColumn("minutes_off", F.when(F.col("status") == "ok", F.least(d, 1440 - d)))


MINUTES = "case when status = 'ok' then least(abs(dep_minutes - 540), 1440 - abs(dep_minutes - 540)) end"
SERIES = f"select haul_category, months_ahead, {STATUS}, avg(price_gbp) mean, avg(price_cheapest_gbp) mean_cheapest, 100 * avg((price_gbp - price_cheapest_gbp) / nullif(price_cheapest_gbp, 0)) pct, avg({MINUTES}) mins from fare_obs group by 1, 2"


@query("fare_obs", sql=f"with s as ({SERIES}) select haul_category, months_ahead, n_ok, n_no_data, n_error, round(mean, 4) mean, round(mean_cheapest, 4) mean_cheapest, round(pct, 4) pct_above_cheapest, round(mins, 4) minutes_off from s")
def by_series(fares):
    return rounded(mo.by_series(off_target(fares), ["haul_category", "months_ahead"]), "mean", "mean_cheapest", "pct_above_cheapest", "minutes_off")


REGIONS = "select location, property_tier, count(*) n_ok, count(distinct property_token) n_properties, avg(price_gbp) mean, max(price_gbp) / min(price_gbp) spread, avg(year(scrape_date) % 10) n_considered, avg(month(scrape_date)) n_dropped_rate_basis from stay_obs where stay_night_kind = 'index_week' group by 1, 2"


def regions_of(stays):
    """Rows of the other night stand for calls that are not ok."""
    rows = stays.withColumns({"status": F.when(F.col("stay_night_kind") == "index_week", "ok").otherwise("no_data"), "n_considered": F.year("scrape_date") % 10, "n_dropped_rate_basis": F.month("scrape_date")})
    return mo.by_region(rows, ["location", "property_tier"])


@query("stay_obs", sql=f"with r as ({REGIONS}) select location, property_tier, n_ok, n_properties, round(mean, 4) mean, round(spread, 4) spread, round(n_considered, 4) n_considered, round(n_dropped_rate_basis, 4) n_dropped_rate_basis from r")
def by_region(stays):
    return rounded(regions_of(stays), "mean", "spread", "n_considered", "n_dropped_rate_basis")


@query("fare_obs", sql="select route, months_ahead, count(*) filter (status <> 'ok') not_ok, count(*) n from fare_obs group by 1, 2 having not_ok > 0 order by not_ok desc, route, months_ahead limit 10")
def worst_routes(fares):
    return mo.worst_routes(fares)


@query("fare_obs", sql="select route, months_ahead, min(concat(status, ' ', run_id)) message from fare_obs where status <> 'ok' group by 1, 2 order by 1, 2 limit 15")
def problem_cells(fares):
    return mo.problem_cells(fares, ["route", "months_ahead"], F.concat_ws(" ", "status", "run_id"))


@query("stay_obs", sql="select index_month_collection index_month, location, round(avg(price_gbp), 4) as value from stay_obs where is_panel_property and stay_night_kind = 'index_week' group by 1, 2 order by 1 desc, 2 limit 24")
def headline_recon(stays):
    return rounded(rc.headline_recon(stays, ["location"]), "value")


@query("published", sql="select location, count(*) n, count(distinct index_month) n_months, min(index_month) first_month, max(index_month) last_month, string_agg(distinct cast(fetched_ts as varchar), ', ' order by cast(fetched_ts as varchar)) vintages from published group by 1")
def published_coverage(published):
    return mo.published_coverage(published, ["location"])


CONCERNS = f"with s as ({SERIES}), c as (select concat(haul_category, '/', cast(months_ahead as varchar)) subject, * from s), h as (select count(distinct scrape_date) d, count(*) filter (status = 'error') n_error, count(*) filter (status in ('ok', 'no_data', 'error')) n from fare_obs), r as (select concat_ws('/', location, property_tier) subject, * from ({REGIONS})), g as (select location, datediff('month', min(index_month), max(index_month)) + 1 - count(distinct index_month) gap from published group by 1)"


@query("fare_obs", "stay_obs", "published", sql=CONCERNS + " select 'error_rate' as rule, 'panel' as subject, round(n_error / n, 4) as value from h where n_error > 0.05 * n union all select 'few_days', 'panel', cast(d as double) from h where d < 40 union all select 'nothing_collected', 'panel', cast(n as double) from h where n = 0 union all select 'pct_above_cheapest', subject, round(pct, 4) from c where pct > 200 union all select 'minutes_off', subject, round(mins, 4) from c where mins > 180 union all select 'spread', subject, round(spread, 4) from r where spread > 4 union all select 'few_properties', subject, n_properties from r where n_properties < 200 union all select 'more_dropped_than_kept', subject, round(n_dropped_rate_basis, 4) from r where n_dropped_rate_basis > n_considered union all select 'published_gap', location, gap from g where gap >= 1 union all select 'nothing_published', 'published', 0 where (select count(*) from published) = 0")
def concerns(fares, stays, published):
    series = mo.by_series(off_target(fares), ["haul_category", "months_ahead"]).withColumn("subject", F.concat_ws("/", "haul_category", "months_ahead"))
    regions = regions_of(stays).withColumn("subject", F.concat_ws("/", "location", "property_tier"))
    of_fares = mo.fare_concerns(mo.collection_health(fares), series, days=40)
    return rounded(of_fares.unionByName(mo.stay_concerns(regions, published.withColumnRenamed("location", "subject"), least=200)), "value")


@query("published", sql=f"with {pq.LATEST_PUB} select location, index_month, round(index_value, 4) index_value from lp")
def published_series(published):
    return rounded(vt.latest_per_key(published, ["index_month", "location"], "fetched_ts", "index_value").select("location", "index_month", "index_value"), "index_value")


@query("stay_obs", sql=f"select scrape_date, stay_night_kind, location, property_tier, count(*) n, count(distinct property_token) n_properties, round(avg(price_gbp), 8) mean, round(quantile_disc(price_gbp, 0.5), 8) median, round({pq.GEO.format('price_gbp')}, 8) geomean from stay_obs group by 1, 2, 3, 4")
def daily_by_region(stays):
    return rounded(mo.daily_by_region(stays, ["stay_night_kind", "location", "property_tier"]), "mean", "median", "geomean", places=8)


@query("fare_obs", sql="select query_id, scrape_date, route, status from fare_obs where scrape_date = (select max(scrape_date) from fare_obs)")
def latest_snapshot(fares):
    return mo.latest_snapshot(fares).select("query_id", "scrape_date", "route", "status")


@query("fare_obs", sql=pq.FARE_CELLS + " select attribution, index_month, haul_category, months_ahead, selection_rule, method, n_observations, cast(round(value, 4) as double) as value from recon where value is not null")
def export_recon(fares):
    return rc.export_recon(rc.reconstruct_fares(pq.fare_rows(fares)), ["attribution", "index_month", "haul_category", "months_ahead", "selection_rule"])


@query("fare_obs", "published", sql="select a.*, b.* from (select count(*) n_rows, count(distinct scrape_date) n_days, min(scrape_date) first_day from fare_obs) a, (select count(*) n_published, max(index_month) last_month from published) b")
def coverage_row(fares, published):
    return mo.coverage_row(fares, published)


@query("fare_obs", "stay_obs", sql=f"select 'fares' panel, scrape_date, run_id, count(*) n_rows, count(*) filter (status = 'error') n_error, count(distinct route) n_items, null::bigint n_pinned_priced from fare_obs group by 2, 3 union all select 'stays', scrape_date, run_id, count(*), null, count(distinct property_token), count(*) filter (is_panel_property and price_gbp is not null) from stay_obs group by 2, 3")
def run_summary(fares, stays):
    one = mo.run_summary(fares).selectExpr("'fares' as panel", "scrape_date", "run_id", "n_rows", "n_error", "n_routes as n_items", "cast(null as bigint) as n_pinned_priced")
    return one.union(mo.run_summary(stays).selectExpr("'stays'", "scrape_date", "run_id", "n_rows", "cast(null as bigint)", "n_properties", "n_pinned_priced"))


@query("fare_obs", sql="with c as (select scrape_date, route, bool_and(status = 'error') f from fare_obs group by 1, 2) select round(count(*) filter (f) / count(*), 6) failure_rate, count(*) filter (f) / count(*) > 0.34 unreliable from c")
def failure_rate(fares):
    return rounded(mo.failure_rate(fares, ["scrape_date", "route"]), "failure_rate", places=6)


POINTS = "with pt as (select location, index_month as month, arg_max(index_value, fetched_ts) as value from published where index_value is not null group by 1, 2), pf as (select location, month(month) calendar_month, median(value) med, min(value) mn, max(value) mx, count(distinct year(month)) n_years from pt group by 1, 2)"


def points(published):
    """Each month's value in the latest vintage that has it."""
    latest = vt.latest_per_key(published, ["location", "index_month"], "fetched_ts", "index_value")
    return latest.select("location", F.col("index_month").alias("month"), F.col("index_value").alias("value"))


@query("published", sql=POINTS + " select location, cast(calendar_month as int) calendar_month, round(med, 4) median, round(mn, 4) as min, round(mx, 4) as max, n_years from pf")
def seasonal_profile(published):
    return rounded(se.seasonal_profile(points(published), ["location"]), "median", "min", "max")


@query("published", sql=POINTS + ", k as (select *, row_number() over (partition by location order by med desc, calendar_month) k from pf) select location, cast(max(case when k = 1 then calendar_month end) as int) peak_month, round(max(med), 4) peak_median, round(max(mx), 4) all_time_max, round(min(mn), 4) all_time_min from k group by 1")
def seasonal_peak(published):
    return rounded(se.seasonal_peak(points(published), ["location"]), "peak_median", "all_time_max", "all_time_min")


#: A year's months in steps of two: so each series has holes, and months without a neighbour.
GAPS = "with pt as (select location, cast(date_trunc('month', index_month) + to_months(cast(case when month(index_month) > 6 then 12 else 0 end as int)) as date) as month, avg(index_value) as value from published group by 1, 2)"


def spread_out(published):
    """All values, those of the later half of a year one year on."""
    month = F.when(F.month("index_month") > 6, F.add_months("index_month", 12)).otherwise(F.col("index_month"))
    return published.groupBy("location", month.alias("month")).agg(F.avg("index_value").alias("value"))


@query("published", sql=GAPS + ", q as (select * from pt), s as (select location, cast(unnest(generate_series(a, z, interval 1 month)) as date) as month from (select location, min(month) a, max(month) z from q group by 1)) select s.location, s.month from s anti join q on s.location = q.location and s.month = q.month")
def missing_months(published):
    return se.missing_months(spread_out(published), ["location"])


@query("published", sql=GAPS + ", r as (select distinct location, year(month) y, month(month) m from pt), i as (select *, m - row_number() over (partition by location, y order by m) i from r) select location, cast(y as int) as year, cast(min(m) as int) from_month, cast(max(m) as int) to_month, count(*) n from i group by location, y, i having count(*) > 1")
def contiguous_segments(published):
    return se.contiguous_segments(spread_out(published), ["location"])


@query("published", sql=POINTS + ", l as (select location, max(month) l from pt group by 1) select pt.location, max(l) as month, round(max(case when month = l then value end) - median(case when month <> l then value end), 4) difference from pt join l on pt.location = l.location where month(month) = month(l) group by 1")
def latest_vs_typical(published):
    return rounded(se.latest_vs_typical(points(published), ["location"]), "difference")


@query("fare_obs", sql=f"with s as ({SERIES}), w as (select arg_max(concat(haul_category, '/', cast(months_ahead as varchar)), mins) worst from s), n as (select string_agg(distinct route, ',' order by route) r from fare_obs where status = 'no_data' and months_ahead = 6) select {STATUS}, round(100 * (avg(price_gbp) - avg(price_cheapest_gbp)) / avg(price_cheapest_gbp), 4) pct_above_cheapest, max(worst) worst_series, max(r) routes_without_data, count(*) filter (query_id % 7 = 0) n_no_direct from fare_obs, w, n")
def daily_totals(fares):
    rows = off_target(fares).withColumn("candidate_basis", F.when(F.col("query_id") % 7 == 0, "no_direct_available+outlier_capped").otherwise("direct_only"))
    return rounded(mo.daily_totals(rows, ["haul_category", "months_ahead"], F.col("months_ahead") == 6), "pct_above_cheapest")
