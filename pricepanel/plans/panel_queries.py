"""Queries of the vintage, reconstruction and index operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.operators import index_numbers as ix
from pricepanel.operators import monitoring as mo
from pricepanel.operators import reconcile as rc
from pricepanel.operators import vintages as vt
from pricepanel.plans.standins import own_tasks, standin, with_standins, written

Q: dict = {}
O: dict[str, str] = {}


def query(*names: str, sql: str | None = None):
    """Register a query over stand-ins; it gets them as DataFrames."""

    def register(f):
        Q[f.__name__] = lambda spark, sf_dir: f(*[standin(spark, sf_dir, n) for n in names])
        if sql:
            O[f.__name__] = with_standins(names, sql)
        return f

    return register


def rounded(df, *columns: str, places: int = 4):
    return df.withColumns({c: F.round(c, places) for c in columns})


def rounded_means(df, *columns: str, places: int = 4):
    """Rounded to six more places first: a mean that is a tie is a tie, whatever order its prices were summed in."""
    return rounded(rounded(df, *columns, places=places + 6), *columns, places=places)


CURRENT = "with nr as (select scrape_date, run_id, max(scrape_ts) ts from fare_obs where run_id is not null group by 1, 2), cur as (select f.* from fare_obs f join (select scrape_date, run_id from (select *, row_number() over (partition by scrape_date order by ts desc, run_id desc) k from nr) where k = 1) n on f.scrape_date = n.scrape_date and f.run_id = n.run_id)"
DAYS = "select distinct cast(date_trunc('month', scrape_date) as date) + 10 index_day from fare_obs"
MONTHLY_ROWS = "select haul_category, months_ahead, route, cast(date_trunc('month', scrape_date) as date) index_month_collection, cast(date_trunc('month', scrape_date + 30 * months_ahead) as date) index_month_departure, price_gbp, price_cheapest_gbp from cur where status = 'ok'"


def fare_rows(fares):
    rows = vt.current_vintage(fares).where("status = 'ok'")
    return rows.selectExpr("haul_category", "months_ahead", "route", "cast(date_trunc('month', scrape_date) as date) index_month_collection", "cast(date_trunc('month', date_add(scrape_date, 30 * months_ahead)) as date) index_month_departure", "price_gbp", "price_cheapest_gbp")


def index_days(fares):
    return fares.select(F.date_add(F.trunc("scrape_date", "MM"), 10).alias("index_day")).distinct()


@query("fare_obs", sql=CURRENT + " select query_id, scrape_date, run_id, route, status from cur")
def current_vintage(fares):
    return vt.current_vintage(fares).select("query_id", "scrape_date", "run_id", "route", "status")


@query("fare_obs", sql=CURRENT + " select query_id, scrape_date, route, round(price_gbp, 4) price_gbp from cur where status = 'ok' and price_gbp is not null and scrape_date = (select max(scrape_date) from fare_obs)")
def panel_for_date(fares):
    last = fares.agg(F.max("scrape_date").alias("scrape_date"))
    return rounded(vt.panel_for_dates(fares, last).select("query_id", "scrape_date", "route", "price_gbp"), "price_gbp")


@query("fare_obs", sql=CURRENT + " select query_id, scrape_date, route, 'all' of from cur where status = 'ok' and price_gbp is not null and day(scrape_date) % 3 = 0 union all select query_id, scrape_date, route, 'second Tuesday' from cur where status = 'ok' and price_gbp is not null and day(scrape_date) % 3 = 0 and query_id % 2 = 0")
def panel_for_dates(fares):
    """All rows of some dates, and those of one index day of each of them."""
    rows = fares.withColumn("index_day", F.date_add("scrape_date", F.when(F.col("query_id") % 2 == 0, 7).otherwise(14)))
    dates = fares.where("day(scrape_date) % 3 = 0").select("scrape_date")
    one = dates.withColumn("index_day", F.date_add("scrape_date", 7))
    of = lambda d, name: vt.panel_for_dates(rows, d).select("query_id", "scrape_date", "route", F.lit(name).alias("of"))
    return of(dates, "all").unionByName(of(one, "second Tuesday"))


@query("fare_obs", sql=f"with d as ({DAYS}), h as (select distinct scrape_date from fare_obs where status = 'ok'), j as (select index_day, scrape_date, datediff('day', index_day, scrape_date) o from d join h on scrape_date between index_day - 7 and index_day + 7), k as (select *, row_number() over (partition by index_day order by abs(o), scrape_date) n from j) select index_day, scrape_date, cast(o as int) offset_days from k where n = 1")
def nearest_scrape_date(fares):
    return vt.nearest_scrape_date(fares, index_days(fares))


IMPLIED = "select distinct cast(date_trunc('month', scrape_date) as date) index_month, cast(date_trunc('month', scrape_date) as date) + x implied_date from fare_obs, (values (9), (16), (40)) v(x)"


@query("fare_obs", sql=f"with i as ({IMPLIED}), h as (select distinct scrape_date from fare_obs where status = 'ok'), j as (select index_month, implied_date, scrape_date, abs(datediff('day', implied_date, scrape_date)) far from i join h on scrape_date between implied_date - 3 and implied_date + 3), k as (select *, row_number() over (partition by index_month, implied_date order by far, scrape_date) n from j), b as (select *, bool_or(far = 0) over (partition by index_month) ex from k where n = 1) select index_month, string_agg(distinct cast(scrape_date as varchar), ',' order by cast(scrape_date as varchar)) dates, cast(max(far) as int) worst_offset from b where not ex or far = 0 group by 1")
def resolve_collection_dates(fares):
    implied = fares.select(F.trunc("scrape_date", "MM").alias("index_month")).distinct().withColumn("x", F.explode(F.array(F.lit(9), F.lit(16), F.lit(40)))).select("index_month", F.date_add("index_month", F.col("x")).alias("implied_date"))
    return vt.resolve_collection_dates(implied, fares.where("status = 'ok'").select("scrape_date").distinct())


@query("fare_obs", sql="select min(case when status = 'ok' then scrape_date end) first_day from fare_obs")
def collection_start(fares):
    return vt.collection_start(fares)


@query("fare_obs", sql="with m as (select cast(date_trunc('month', min(scrape_date)) as date) a from fare_obs), s as (select cast(a + to_months(cast(i as int)) as date) index_month from m, range(-2, 3) r(i)), c as (select distinct cast(date_trunc('month', scrape_date) as date) index_month from fare_obs where status = 'ok'), f as (select min(scrape_date) first_day from fare_obs where status = 'ok') select s.index_month, case when c.index_month is not null then 'covered' when first_day > s.index_month + 27 then 'predates_panel' else 'gap' end coverage from s left join c on s.index_month = c.index_month, f")
def reconstructable(fares):
    first = fares.agg(F.trunc(F.min("scrape_date"), "MM").alias("a"))
    months = first.select(F.explode(F.sequence(F.add_months("a", -2), F.add_months("a", 2), F.expr("interval 1 month"))).alias("index_month")).withColumn("last_day", F.date_add("index_month", 20))
    return vt.reconstructable(months, fares.where("status = 'ok'").select(F.trunc("scrape_date", "MM").alias("index_month")), vt.collection_start(fares))


LATEST_PUB = "lp as (select index_month, location, fetched_ts, index_value from (select *, row_number() over (partition by index_month, location order by fetched_ts desc) k from published where index_value is not null) where k = 1)"


@query("published", sql=f"with {LATEST_PUB} select index_month, location, fetched_ts, round(index_value, 4) index_value from lp")
def latest_published(published):
    return rounded(vt.latest_per_key(published, ["index_month", "location"], "fetched_ts", "index_value"), "index_value")


@query("stay_obs", sql="with r as (select index_month_collection index_month, location, property_tier, extract('year' from scrape_date) computed_ts, avg(price_gbp) v from stay_obs where property_tier is not null group by 1, 2, 3, 4) select index_month, location, property_tier, cast(max(computed_ts) as int) computed_ts, round(arg_max(v, computed_ts), 4) reconstructed_value from r group by 1, 2, 3")
def latest_recon(stays):
    r = stays.where("property_tier is not null").groupBy(F.col("index_month_collection").alias("index_month"), "location", "property_tier", F.year("scrape_date").alias("computed_ts")).agg(F.avg("price_gbp").alias("reconstructed_value"))
    return rounded(vt.latest_per_key(r, ["index_month", "location", "property_tier"], "computed_ts", "reconstructed_value"), "reconstructed_value")


#: Boundaries in the years of the stand-in panels, so that some months are in each regime.
STAND_IN_ERAS = (("1900-01-01", "a"), ("1994-01-01", "b"), ("1997-01-01", "c"))


@query("weights", "published", sql="with t as (select distinct year(index_month) target_year from published), p as (select target_year, coalesce(max(case when w.year <= target_year then w.year end), min(w.year)) y from t, (select distinct year from weights) w group by 1) select cast(target_year as int) target_year, p.y as year, region, weight, p.y = 1999 weights_are_placeholder from p join weights w on w.year = p.y")
def weights_as_of(weights, published):
    marked = weights.withColumn("is_placeholder", (F.col("year") == 1999) & (F.col("region") == "ASIA"))
    return vt.weights_as_of(marked, published.select(F.year("index_month").alias("target_year")).distinct(), allow_placeholder=True).select("target_year", "year", "region", "weight", "weights_are_placeholder")


@query("weights", sql="select year, region, round(weight / sum(weight) over (partition by year), 6) share, sum(weight) over (partition by region) as total from weights")
def normalise_weights(weights):
    totals = vt.group_total(weights, ["region"])
    return rounded(vt.normalise_weights(weights).join(totals, "region").select("year", "region", "share", "total"), "share", places=6)


@query("stay_obs", sql="with b as (select min(scrape_date) a, max(scrape_date) z from stay_obs), d as (select cast(unnest(generate_series(a, z, interval 1 day)) as date) scrape_date from b) select scrape_date from d anti join stay_obs s on d.scrape_date = s.scrape_date")
def expected_collection_days(stays):
    span = stays.agg(F.min("scrape_date").alias("a"), F.max("scrape_date").alias("z")).select(F.explode(F.sequence("a", "z")).alias("scrape_date"))
    return vt.missing_days(span, stays)


CHURN = "with m as (select location, property_tier, property_token, index_month_collection mo, count(*) n from stay_obs where property_token is not null group by 1, 2, 3, 4), p as (select location, property_tier, property_token, min(mo) first_month, max(mo) last_month, count(*) months_seen, cast(sum(n) as bigint) n_rows from m group by 1, 2, 3), l as (select max(index_month_collection) lm from stay_obs), c as (select p.*, cast(datediff('month', last_month, lm) as int) months_absent, case when datediff('month', last_month, lm) = 0 then 'present' else 'left' end churn_status, months_seen / (datediff('month', first_month, last_month) + 1.0) pr from p, l)"


def churn(stays, counted=False):
    return vt.property_churn(stays, ["location", "property_tier"], counted=counted)


@query("stay_obs", sql=CHURN + " select location, property_tier, property_token, first_month, last_month, months_seen, n_rows, months_absent, churn_status, round(pr, 4) presence_rate from c")
def property_churn(stays):
    return rounded(churn(stays, counted=True), "presence_rate")


@query("stay_obs", sql=CHURN + " select churn_status, count(*) n_items, round(avg(pr), 4) mean_presence from c group by 1")
def churn_summary(stays):
    return rounded(vt.churn_summary(churn(stays)), "mean_presence")


@query("stay_obs", sql=CHURN + " select location, property_tier, property_token, months_absent from c where churn_status = 'left'")
def churned_tokens(stays):
    return vt.churned_tokens(churn(stays)).select("location", "property_tier", "property_token", "months_absent")


@query("stay_obs", sql=CHURN + " select c.location, c.property_tier, c.property_token, months_absent from c join (select distinct location, property_token from stay_obs where is_panel_property) s on c.location = s.location and c.property_token = s.property_token where churn_status = 'left' order by months_absent desc, c.location, c.property_tier nulls first, c.property_token limit 10")
def churned_panel(stays):
    return vt.churned_panel(churn(stays), stays.where("is_panel_property"), ["location", "property_tier"]).select("location", "property_tier", "property_token", "months_absent")


@query("stay_obs", sql=CHURN + " select location, property_tier, property_token, churn_status, round(pr, 3) presence_rate from c")
def export_churn(stays):
    return rounded(churn(stays).select("location", "property_tier", "property_token", "churn_status", "presence_rate"), "presence_rate", places=3)


GEO = "exp(avg(case when {0} > 0 then ln({0}) end))"
STATS = "count({0}) n, round(avg({0}), 4) mean, round(median({0}), 4) median, round(" + GEO + ", 4) geomean"


@query("fare_obs", sql=CURRENT + f" select haul_category, months_ahead, {STATS.format('price_gbp')} from cur where status = 'ok' group by 1, 2")
def elementary_stats(fares):
    return rounded(rc.elementary_stats(vt.current_vintage(fares).where("status = 'ok'"), ["haul_category", "months_ahead"]), "mean", "median", "geomean")


@query("fare_obs", sql="select query_id, cast(round(cast(price_gbp as decimal(18,6)) * 3, 4) as double) v, cast(round(cast(query_id as decimal(18,5)) + 0.00005, 4) as double) tie from fare_obs")
def quantise4(fares):
    exact, tie = F.col("price_gbp").cast("decimal(18,6)") * 3, F.col("query_id").cast("decimal(18,5)") + F.lit("0.00005").cast("decimal(6,5)")
    return fares.select("query_id", rc.quantised(exact).cast("double").alias("v"), rc.quantised(tie).cast("double").alias("tie"))


FARE_CELLS = CURRENT + f", fr as ({MONTHLY_ROWS}), long as (select 'departure' attribution, index_month_departure index_month, 'nearest' selection_rule, price_gbp price, haul_category, months_ahead, route from fr union all select 'departure', index_month_departure, 'cheapest', price_cheapest_gbp, haul_category, months_ahead, route from fr union all select 'collection', index_month_collection, 'nearest', price_gbp, haul_category, months_ahead, route from fr union all select 'collection', index_month_collection, 'cheapest', price_cheapest_gbp, haul_category, months_ahead, route from fr), cell as (select attribution, index_month, haul_category, months_ahead, selection_rule, count(distinct route) n_routes, count(price) n_observations, avg(price) mean, median(price) median, {GEO.format('price')} geomean from long where months_ahead > 0 group by 1, 2, 3, 4, 5), recon as (select attribution, index_month, haul_category, months_ahead, selection_rule, n_routes, n_observations, method, value from cell unpivot (value for method in (mean, median, geomean)))"


@query("fare_obs", sql=FARE_CELLS + " select * exclude value, round(value, 4) as value from recon")
def reconstruct_fares(fares):
    return rounded(rc.reconstruct_fares(fare_rows(fares)), "value")


@query("fare_obs", sql=FARE_CELLS + " select r.attribution, r.index_month, r.haul_category, r.months_ahead, r.selection_rule, r.method, r.n_routes, e.n n_routes_expected from recon r left join (select haul_category, count(distinct route) n from fare_obs group by 1) e on r.haul_category = e.haul_category")
def expected_routes(fares):
    out = rc.expected_routes(rc.reconstruct_fares(fare_rows(fares)), fares.select("haul_category", "route").distinct())
    return out.select("attribution", "index_month", "haul_category", "months_ahead", "selection_rule", "method", "n_routes", "n_routes_expected")


STAY_CELLS = f"with l0 as (select s.*, 'matched_census' sample_rule from stay_obs s union all select s.*, 'pinned' from stay_obs s where is_panel_property), l1 as (select 'stay' attribution, index_month_stay index_month, collection_alignment, sample_rule, location, coalesce(property_tier, 'unknown') property_tier, stay_night_kind, property_token, price_gbp from l0 union all select 'collection', index_month_collection, collection_alignment, sample_rule, location, coalesce(property_tier, 'unknown'), stay_night_kind, property_token, price_gbp from l0), cell as (select attribution, index_month, collection_alignment, sample_rule, location, case when grouping(property_tier) = 1 then 'all' else property_tier end property_tier, case when grouping(stay_night_kind) = 1 then 'both' else stay_night_kind end stay_night_kind, count(price_gbp) n_observations, count(distinct property_token) n_properties, avg(price_gbp) mean, median(price_gbp) median, {GEO.format('price_gbp')} geomean from l1 group by grouping sets ((attribution, index_month, collection_alignment, sample_rule, location, property_tier, stay_night_kind), (attribution, index_month, collection_alignment, sample_rule, location, property_tier), (attribution, index_month, collection_alignment, sample_rule, location, stay_night_kind), (attribution, index_month, collection_alignment, sample_rule, location))), recon as (select * from cell unpivot (value for method in (mean, median, geomean)))"


@query("stay_obs", sql=STAY_CELLS + " select attribution, index_month, collection_alignment, sample_rule, location, property_tier, stay_night_kind, n_observations, n_properties, method, round(value, 6) as value from recon")
def reconstruct_stays(stays):
    panel = written(stays.select(*rc.STAY_ROW))
    return rounded(rc.reconstruct_stays(panel, own_tasks(panel), written), "value", places=6)


@query("stay_obs", sql=STAY_CELLS + ", pp as (select distinct location, property_tier, property_token from stay_obs where is_panel_property and property_tier is not null), ex as (select location, property_tier, count(distinct property_token) n from pp group by 1, 2 union all select location, 'all', count(distinct property_token) from pp group by 1) select r.attribution, r.index_month, r.collection_alignment, r.location, r.property_tier, r.stay_night_kind, coalesce(n, n_properties) n_properties_expected, greatest(coalesce(n, n_properties) - n_properties, 0) n_properties_churned from recon r left join ex on r.location = ex.location and r.property_tier = ex.property_tier where method = 'mean' and sample_rule = 'pinned'")
def expected_churned(stays):
    panel = written(stays.where("is_panel_property").select(*rc.STAY_ROW))
    pinned = panel.where("property_tier is not null").select("location", "property_tier", "property_token").distinct()
    cells = rc.properties_seen(panel, own_tasks(panel)).where("sample_rule = 'pinned'")
    return rc.expected_churned(cells, pinned).select("attribution", "index_month", "collection_alignment", "location", "property_tier", "stay_night_kind", "n_properties_expected", "n_properties_churned")


@query("fare_obs", sql="select haul_category, months_ahead, bool_and(day(scrape_date) % 2 = 0) index_day_exact, bool_or(query_id % 97 = 0) source_is_cached, bool_and(query_id % 5 > 0) board_basis_known, bool_or(year(scrape_date) < 1900 or query_id % 1000 = 0) weights_are_placeholder, string_agg(distinct cast(scrape_date as varchar), ',' order by cast(scrape_date as varchar)) scrape_dates_used from fare_obs group by 1, 2")
def provenance_flags(fares):
    rows = fares.withColumns({"weights_are_placeholder": F.col("query_id") % 1000 == 0, "offset_days": F.day("scrape_date") % 2, "is_cached_source": F.col("query_id") % 97 == 0, "board_known": F.col("query_id") % 5 > 0})
    return rc.provenance_flags(rows, ["haul_category", "months_ahead"])


WEIGHTED = "with c as (select index_month_collection index_month, year(index_month_collection) yr, stay_night_kind, location, avg(price_gbp) v, count(*) n, bool_or(is_panel_property) pin, count(distinct property_token) np from stay_obs group by 1, 2, 3, 4), w as (select case year when 1996 then 1995 else 1996 end yr, region, weight from weights)"


@query("stay_obs", "weights", sql=WEIGHTED + ", a as (select index_month, c.yr, stay_night_kind, sum(round(v, 4) * weight) / sum(weight) v, cast(sum(n) as bigint) n_observations, bool_or(pin) pinned, bool_and(np > 20) broad, arg_max(np, location) n_last, count(distinct location) k from c join w on location = region and c.yr = w.yr group by 1, 2, 3), p as (select index_month, c.yr, stay_night_kind, sum(round(v, 4) * weight) / sum(weight) v, cast(sum(n) as bigint) n_observations, bool_or(pin) pinned, bool_and(np > 20) broad, max(case when location = 'ASIA' then np end) n_last, count(distinct location) k from c join w on location = region and c.yr = w.yr where location in ('ASIA', 'EUROPE') group by 1, 2, 3) select 'all' as location, index_month, cast(yr as int) yr, stay_night_kind, round(v, 6) as value, n_observations, pinned, broad, n_last, 'every' rule from a where k = (select count(distinct region) from w) union all select 'all', index_month, cast(yr as int), stay_night_kind, round(v, 6), n_observations, pinned, broad, n_last, 'named' from p where k = 2")
def weighted_aggregate(stays, weights):
    cells = stays.groupBy(F.col("index_month_collection").alias("index_month"), F.year("index_month_collection").alias("yr"), "stay_night_kind", "location").agg(F.avg("price_gbp").alias("value"), F.count("*").alias("n_observations"), F.bool_or("is_panel_property").alias("pinned"), F.countDistinct("property_token").alias("n_last"))
    cells = cells.withColumn("broad", F.col("n_last") > 20)
    w = weights.select(F.when(F.col("year") == 1996, 1995).otherwise(1996).alias("yr"), F.col("region").alias("location"), "weight")
    made = {"variant": ["index_month", "yr", "stay_night_kind"], "part": "location", "on": ("yr",), "any_of": ("pinned",), "all_of": ("broad",), "carried": ("n_last",)}
    every = rc.weighted_aggregate(cells, w, **made).withColumn("rule", F.lit("every"))
    named = rc.weighted_aggregate(cells, w, **made, parts=("ASIA", "EUROPE"), carry_from="ASIA").withColumn("rule", F.lit("named"))
    return rounded(every.unionByName(named), "value", places=6)


PAIRS = "with p as (select m.cell, m.item, m.month, m.price, b.price base from monthly m left join monthly b on b.cell = m.cell and b.item = m.item and b.month = m.month - interval 1 month and b.price > 0 where m.price > 0)"
COUNTED = ", n as (select cell, month, count(base) n_matched, count(*) - count(base) nw from p group by 1, 2), g as (select m.cell, cast(m.month + interval 1 month as date) as month, count(*) gone from monthly m anti join monthly x on x.cell = m.cell and x.item = m.item and x.month = m.month + interval 1 month group by 1, 2), nm as (select n.cell, n.month, n_matched, nw + coalesce(gone, 0) n_unmatched from n left join g on n.cell = g.cell and n.month = g.month)"
REL = PAIRS + ", rel as (select cell, month, count(*) n_matched, exp(avg(ln(price / base))) jevons, avg(price) / avg(base) dutot, avg(price / base) carli from p where base is not null group by 1, 2 having count(*) >= 3)"


@query("monthly", sql=PAIRS + COUNTED + " select * from nm")
def matched_pairs(prices):
    return ix.match_counts(prices, ["cell"])


@query("monthly", sql=REL + COUNTED + " select r.cell, r.month, r.n_matched, n_unmatched, round(jevons, 6) jevons, round(dutot, 6) dutot, round(carli, 6) carli, round((jevons - 1) * 100, 4) pct_change, round(r.n_matched / (r.n_matched + n_unmatched), 6) match_rate from rel r join nm on r.cell = nm.cell and r.month = nm.month")
def price_relative(prices):
    return rounded(rounded(ix.price_relative(prices, ["cell"]), "jevons", "dutot", "carli", "match_rate", places=6), "pct_change")


@query("monthly", "published", sql=REL.replace("with p as", "with lp as (select location, index_month, arg_max(index_value, fetched_ts) v from published group by 1, 2), p as") + " select r.cell, r.month, round(case when v > 0 then v * jevons end, 4) nowcast from rel r join lp on lp.location = r.cell and r.month = lp.index_month + interval 1 month")
def splice_nowcast(prices, published):
    level = vt.latest_per_key(published, ["index_month", "location"], "fetched_ts", "index_value").select(F.col("location").alias("cell"), F.col("index_month").alias("month"), F.col("index_value").alias("level"))
    return rounded(ix.splice_nowcast(level, ix.price_relative(prices, ["cell"]), ["cell"]), "nowcast")


ERA = "case when {0} >= date '1997-01-01' then 'c' when {0} >= date '1994-01-01' then 'b' else 'a' end"


@query("stay_obs", sql=f"select distinct index_month_collection as month, {ERA.format('index_month_collection')} era, case when index_month_collection >= date '1996-02-01' then '2026_six_weeks_two_nights' when index_month_collection >= date '1995-01-01' then '2025_split_weight' else 'pre_2025_one_day_ahead' end published_era, index_month_collection in (date '1994-01-01', date '1997-01-01') spans from stay_obs")
def methodology_era(stays):
    return stays.select(F.col("index_month_collection").alias("month")).distinct().withColumns({"era": ix.methodology_era(F.col("month"), STAND_IN_ERAS), "published_era": ix.methodology_era(F.add_months("month", 360)), "spans": ix.spans_methodology_break(F.add_months("month", -1), F.col("month"), STAND_IN_ERAS)})


@query("monthly", sql=f"with m as (select distinct cell, month from monthly), l as (select *, lag(month) over (partition by cell order by month) prev_month from m) select cell, month, prev_month from l where datediff('month', prev_month, month) = 1 and {ERA.format('month')} = {ERA.format('prev_month')}")
def consecutive_pairs(prices):
    return ix.consecutive_pairs(prices.select("cell", "month").distinct(), ["cell"], STAND_IN_ERAS)


CHAIN = REL + f", ms as (select distinct cell, month from monthly where price > 0), o0 as (select ms.cell, ms.month, jevons r, row_number() over (partition by ms.cell order by ms.month) k, lag(ms.month) over (partition by ms.cell order by ms.month) pm from ms left join rel on ms.cell = rel.cell and ms.month = rel.month), o as (select *, r is null or {ERA.format('pm')} <> {ERA.format('month')} bad from o0), b as (select *, max(case when k > 1 and bad then 1 else 0 end) over (partition by cell order by month) br from o), chain as (select cell, month, 100 * exp(sum(case when k = 1 then 0 else ln(r) end) over (partition by cell order by month)) lvl from b where br = 0)"
#: Each item on the cell's observed month before; the stand-in's Mays are taken out, so that months are missing.
OBSERVED = ", t as (select * from monthly where price > 0 and month(month) <> 5), tm as (select *, row_number() over (partition by cell order by month) pos from (select distinct cell, month from t)), ti as (select t.cell, t.item, t.price, t.month, pos from t join tm on t.cell = tm.cell and t.month = tm.month), tr as (select x.cell, x.month, exp(avg(ln(x.price / y.price))) r from ti x join ti y on x.cell = y.cell and x.item = y.item and x.pos = y.pos + 1 group by 1, 2 having count(*) >= 3), tb as (select tm.cell, tm.month, pos, r, max(case when pos > 1 and r is null then 1 else 0 end) over (partition by tm.cell order by tm.month) br from tm left join tr on tm.cell = tr.cell and tm.month = tr.month), ob as (select cell, month, 100 * exp(sum(case when pos = 1 then 0 else ln(r) end) over (partition by cell order by month)) lvl from tb where br = 0)"


@query("monthly", sql=CHAIN + OBSERVED + " select cell, month, round(lvl, 4) as level, 'calendar' rule from chain union all select cell, month, round(lvl, 4), 'observed' from ob")
def chained_index(prices):
    prices = written(prices)  # both chains read them several times
    calendar = ix.chained_index(prices, ["cell"], eras=STAND_IN_ERAS).withColumn("rule", F.lit("calendar"))
    observed = ix.chained_index(prices.where("month(month) <> 5"), ["cell"], adjacent="observed").withColumn("rule", F.lit("observed"))
    return rounded(calendar.unionByName(observed), "level")


POINTS = "with pt as (select cell, month, avg(price) lvl from monthly group by 1, 2)"


def points(prices):
    return prices.groupBy("cell", "month").agg(F.avg("price").alias("level"))


REBASED = POINTS + ", rb as (select p.cell, p.month, p.lvl / j.lvl * 100 lvl from pt p join pt j on p.cell = j.cell and year(p.month) = year(j.month) and month(j.month) = 1)"


@query("monthly", sql=REBASED + " select cell, month, round(lvl, 4) as level from rb")
def rebase_january(prices):
    return rounded(ix.rebase_january(points(prices), ["cell"]), "level")


@query("monthly", sql=REBASED + ", a as (select cell as series, month, lvl from rb union all select concat(cell, ' raw'), month, lvl from pt), b as (select series, count(*) filter (month(month) = 1) n, bool_and(abs(lvl - 100) <= 0.5) filter (month(month) = 1) near from a group by 1) select series, case when n < 2 then 'unknown' when near then 'annual_january_100' else 'chained' end basis from b")
def detect_basis(prices):
    raw = points(prices)
    both = ix.rebase_january(raw, ["cell"]).unionByName(raw.withColumn("cell", F.concat("cell", F.lit(" raw")))).withColumnRenamed("cell", "series")
    return ix.detect_basis(both, ["series"])


@query("monthly", sql=POINTS + ", l as (select *, lag(month) over (partition by cell order by month) pm, lag(lvl) over (partition by cell order by month) pl from pt) select cell, month, round((lvl / pl - 1) * 100, 4) pct_change, r as rule from l, (values ('fares'), ('stays')) v(r) where datediff('month', pm, month) = 1 and pl > 0 and (r = 'fares' or " + f"{ERA.format('pm')} = {ERA.format('month')})")
def month_on_month(prices):
    """As fares, and as stays, which do not pair across a change of regime."""
    of = lambda name, eras: ix.month_on_month(points(prices), ["cell"], eras).withColumn("rule", F.lit(name))
    return rounded(of("fares", None).unionByName(of("stays", STAND_IN_ERAS)), "pct_change")


DAILY = f" select scrape_date, haul_category, months_ahead, count(*) filter (status = 'ok') n_ok, count(*) filter (status = 'no_data') n_no_data, count(*) filter (status = 'error') n_error, round(avg(price_gbp), 4) mean, round(quantile_disc(price_gbp, 0.5), 4) median, round({GEO.format('price_gbp')}, 4) geomean, round(avg(price_cheapest_gbp), 4) mean_cheapest from cur group by 1, 2, 3"


@query("fare_obs", sql=CURRENT + DAILY)
def daily_by_series(fares):
    return rounded_means(mo.daily_by_series(vt.current_vintage(fares), ["haul_category", "months_ahead"]), "mean", "median", "geomean", "mean_cheapest")
