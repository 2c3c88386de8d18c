"""Queries of selection and panel building over line items read as quotes, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.operators import selection as se
from pricepanel.plans.standins import dealt, standin, tasks_for, with_standins

Q: dict = {}
O: dict[str, str] = {}


def query(*names: str, sql: str | None = None):
    def register(f):
        Q[f.__name__] = lambda spark, sf_dir: f(*[standin(spark, sf_dir, n) for n in names])
        if sql:
            O[f.__name__] = with_standins(names, sql)
        return f

    return register


POOL = "with a as (select *, max(case when transfers = 0 then 1 else 0 end) over (partition by query_id) d from quotes), p as (select * from a where d = 0 or coalesce(transfers = 0, false)), m as (select *, min(price) over (partition by query_id) lo from p), c as (select *, price <= lo * 5 inn, bool_and(price <= lo * 5) over (partition by query_id) whole from m), comp as (select query_id, pos, price, dep_minutes, concat(case when d = 1 then 'direct_only' else 'no_direct_available' end, case when whole then '' else '+outlier_capped' end) basis, least(abs(dep_minutes - 540), 1440 - abs(dep_minutes - 540)) delta from c where inn), r as (select *, row_number() over (partition by query_id order by coalesce(delta, 10000), price, pos) k, row_number() over (partition by query_id order by delta nulls last) t, min(price) over (partition by query_id) low, count(*) over (partition by query_id) n from comp), sel as (select query_id, max(case when k = 1 then price end) price, max(case when k = 1 then delta end) minutes_off, max(case when k = 1 then pos end) pos, max(low) price_cheapest, max(n) n_considered, max(basis) basis, max(case when t = 2 then delta end) - max(case when t = 1 then delta end) margin from r group by 1)"


@query("quotes", sql=POOL + " select query_id, pos, basis, round(price, 6) price from comp")
def comparable_fares(quotes):
    return se.comparable_fares(quotes).select("query_id", "pos", "basis", F.round("price", 6).alias("price"))


@query("quotes", sql="select query_id, pos, least(abs(dep_minutes - 1300), 1440 - abs(dep_minutes - 1300)) delta from quotes")
def minutes_from_target(quotes):
    return quotes.select("query_id", "pos", se.minutes_from_target(F.col("dep_minutes"), 1300).alias("delta"))


@query("quotes", sql=POOL + ", q as (select query_id, count(*) n_quotes from quotes group by 1) select sel.query_id, round(price, 6) price, minutes_off, pos, round(price_cheapest, 6) price_cheapest, n_quotes, n_considered, basis from sel join q on sel.query_id = q.query_id")
def select_fare(quotes):
    return se.select_fare(quotes).select("query_id", F.round("price", 6).alias("price"), "minutes_off", "pos", F.round("price_cheapest", 6).alias("price_cheapest"), "n_quotes", "n_considered", "basis")


@query("quotes", sql=POOL + " select query_id, margin selection_margin from sel")
def selection_margin(quotes):
    return se.select_fare(quotes).select("query_id", "selection_margin")


@query("quotes", sql=POOL + " select query_id, round(price - price_cheapest, 6) selection_spread from sel")
def selection_spread(quotes):
    return se.select_fare(quotes).select("query_id", F.round("selection_spread", 6).alias("selection_spread"))


STAGED = "with s0 as (select *, case when hotel_class between 3 and 3.5 then 'midscale' when hotel_class between 4 and 4.5 then 'upscale' end tier, coalesce(lower(trim(property_type)), '') kind from quotes), s1 as (select *, case when kind <> '' and kind not in ('hotel', 'motel', 'inn', 'aparthotel') then 'type' when tier is null then 'other_tier' when free_cancellation is null or not free_cancellation then 'rate' end st from s0), md as (select query_id, tier, median(price) m from s1 where st is null group by 1, 2), staged as (select s1.*, coalesce(st, case when price not between m / 5 and m * 5 then 'outlier' end, 'considered') stage from s1 left join md on s1.query_id = md.query_id and s1.tier = md.tier)"


@query("quotes", sql=STAGED + " select query_id, pos, tier from staged where stage = 'considered'")
def comparable_stays(quotes):
    return se.comparable_stays(quotes).select("query_id", "pos", "tier")


@query("quotes", sql=STAGED + " select query_id, pos, tier from staged")
def tier_for_class(quotes):
    return quotes.select("query_id", "pos", se.tier_for_class(F.col("hotel_class")).alias("tier"))


@query("quotes", sql="select query_id, pos, coalesce(free_cancellation, false) refundable, coalesce(not free_cancellation, false) fixed, true as anything from quotes")
def matches_rate_basis(quotes):
    f = F.col("free_cancellation")
    return quotes.select("query_id", "pos", se.matches_rate_basis(f, "refundable").alias("refundable"), se.matches_rate_basis(f, "non_refundable").alias("fixed"), se.matches_rate_basis(f, "any").alias("anything"))


ACCOUNT = STAGED + ", g as (select query_id, t tier, count(*) returned, count(*) filter (stage = 'type') dropped_type, count(*) filter (stage = 'considered' and tier = t) considered, count(*) filter (stage = 'rate' and tier = t) dropped_rate, count(*) filter (stage = 'outlier' and tier = t) dropped_outlier, count(*) filter (stage <> 'type' and (tier is null or tier <> t)) other_tier from staged, (values ('midscale'), ('upscale')) v(t) group by 1, 2)"


@query("quotes", sql=ACCOUNT + " select * from g")
def filter_accounting(quotes):
    return se.filter_accounting(quotes)


@query("quotes", sql=ACCOUNT + " select query_id, tier, concat('tier=', tier, '+rate=refundable+board=unknown+room=unknown', case when dropped_type > 0 then '+non_hotel_excluded' else '' end, case when dropped_outlier > 0 then '+outlier_capped' else '' end) comparability_basis from g")
def comparability_basis(quotes):
    return se.comparability_basis(se.filter_accounting(quotes)).select("query_id", "tier", "comparability_basis")


@query("quotes", sql="select query_id, hotel_class, round(min(price), 6) cheapest, round(case when count(price) >= 2 and min(price) > 0 then max(price) / min(price) end, 6) spread_ratio from quotes group by 1, 2")
def cell_cheapest_spread(quotes):
    return se.cell_cheapest_spread(quotes, ["query_id", "hotel_class"]).withColumns({"cheapest": F.round("cheapest", 6), "spread_ratio": F.round("spread_ratio", 6)})


@query("quotes", sql="select query_id, pos, round(price, 6) advertised, round(coalesce(price_before_taxes, price), 6) before_taxes from quotes")
def headline_price(quotes):
    p, b = F.col("price"), F.col("price_before_taxes")
    return quotes.select("query_id", "pos", F.round(se.headline_price(p, b, "advertised"), 6).alias("advertised"), F.round(se.headline_price(p, b, "before_taxes"), 6).alias("before_taxes"))


SAMPLE = "with t as (select distinct location, property_tier, property_token from stay_obs), pick as (select *, row_number() over (partition by location, property_tier order by property_token) k from t)"


@query("stay_obs", sql=SAMPLE + " select location, property_tier, property_token from pick where k <= 3")
def pick_sample(stays):
    return se.pick_sample(stays, ["location", "property_tier"])


@query("stay_obs", sql=SAMPLE + " select s.run_id, s.property_token, s.location, p.property_token is not null is_panel_property from stay_obs s left join (select distinct property_token from pick where k <= 3) p on s.property_token = p.property_token")
def flag_panel_items(stays):
    pinned = se.pick_sample(stays, ["location", "property_tier"])
    return se.flag_panel_items(stays.drop("is_panel_property"), pinned).select("run_id", "property_token", "location", "is_panel_property")


@query("stay_obs", sql=SAMPLE + ", g as (select distinct location, coalesce(property_tier, 'unknown') tier from stay_obs), n as (select location, coalesce(property_tier, 'unknown') tier, count(*) n from pick where property_token like 'P%99' group by 1, 2) select g.location, g.tier, coalesce(n, 0) n_pinned from g left join n on g.location = n.location and g.tier = n.tier where coalesce(n, 0) < 9")
def thin_cells(stays):
    rows = stays.withColumn("tier", F.coalesce("property_tier", F.lit("unknown")))
    return se.thin_cells(rows.select("location", "tier").distinct(), rows.where("property_token like 'P%99'"), ["location", "tier"], 9)


TOPUP = "with t as (select distinct location, coalesce(property_tier, 'unknown') tier, property_token from stay_obs), pick as (select *, row_number() over (partition by location, tier order by property_token) k from t), retired as (select location, tier, property_token from pick where k = 2 and location <> 'ASIA'), kept as (select p.location, p.tier, p.property_token from pick p anti join retired r on p.location = r.location and p.tier = r.tier and p.property_token = r.property_token where k <= 3), h as (select location, tier, count(*) have from kept group by 1, 2), gone as (select location, tier, string_agg(property_token, ',' order by property_token) g from retired group by 1, 2), fresh as (select p.*, row_number() over (partition by p.location, p.tier order by p.property_token) j from pick p anti join retired r on p.location = r.location and p.tier = r.tier and p.property_token = r.property_token anti join kept x on p.location = x.location and p.tier = x.tier and p.property_token = x.property_token where k <= 15)"


@query("stay_obs", sql=TOPUP.replace("stay_obs)", "stay_obs where location <> 'AFRICA')", 1) + ", old as (select location, tier, property_token, row_number() over (partition by location, tier order by property_token) k from (select distinct location, coalesce(property_tier, 'unknown') tier, property_token from stay_obs where location = 'AFRICA')) select location, tier, property_token, 'pinned' selection_basis from old where k <= 3 union all select location, tier, property_token, 'pinned' selection_basis from kept union all select f.location, f.tier, f.property_token, coalesce('substitute_for:' || g, 'discovered') from fresh f left join h on f.location = h.location and f.tier = h.tier left join gone on f.location = gone.location and f.tier = gone.tier where j <= 5 - coalesce(have, 0)")
def top_up_sample(stays):
    from pyspark.sql import Window

    cell = ["location", "tier"]
    rows = stays.select("location", F.coalesce("property_tier", F.lit("unknown")).alias("tier"), "property_token").distinct()
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(*cell).orderBy("property_token")))
    failed = rows.where("location = 'AFRICA'").select("location")
    return se.top_up_sample(ranked.where("_k <= 3").drop("_k"), ranked.where("_k = 2 and location <> 'ASIA'").drop("_k"), rows, cell, failed=failed)


LEGS = ", legs as (select distinct query_id, concat('run-', cast(query_id % 3 as varchar)) run_id, query_id % 11 = 0 as failed from (select query_id from quotes union select query_id + 1 from quotes) q)"


def legs_of(quotes):
    """Every query and one after each, with a run; those of each eleventh failed."""
    legs = quotes.select("query_id").union(quotes.select(F.col("query_id") + 1)).distinct().withColumn("run_id", F.concat(F.lit("run-"), (F.col("query_id") % 3).cast("string")))
    return legs, legs.where("query_id % 11 = 0").select("query_id", F.concat(F.lit("quota exceeded "), F.repeat(F.lit("x"), F.lit(2000))).alias("message"))


@query("quotes", sql=POOL + LEGS + " select l.query_id, run_id, case when not failed then round(price, 6) end price, case when failed then 0 else coalesce(n_considered, 0) end n_considered, case when not failed then coalesce(basis, 'empty') end basis, case when failed then 'error' when price is null then 'no_data' else 'ok' end status, case when failed then concat('quota exceeded ', repeat('x', 985)) end error_message from legs l left join sel on l.query_id = sel.query_id")
def build_fare_rows(quotes):
    legs, failed = legs_of(quotes)
    return se.build_fare_rows(legs, se.select_fare(quotes), failed=failed).select("query_id", "run_id", F.round("price", 6).alias("price"), "n_considered", "basis", "status", "error_message")


@query("quotes", sql=STAGED + LEGS + ", n as (select query_id, count(*) n from quotes group by 1), ok as (select *, row_number() over (partition by query_id order by tier, pos, property_token) k, min(price) over (partition by query_id, tier) low from staged where stage = 'considered') select c.query_id, run_id, case when failed then 0 else coalesce(n, 0) end n_quotes, case when not failed then property_token end property_token, case when not failed then tier end tier, case when not failed then round(low, 6) end price_cheapest, case when failed then 'error' when price is null then 'no_data' else 'ok' end status, case when failed then concat('quota exceeded ', repeat('x', 985)) when price is null and n > 0 then concat(n, ' properties returned, none comparable (rate_basis=refundable)') end error_message, case when not failed and (k = 1 or price is null) and n > 0 then concat('raw ', c.query_id) end raw_response, not failed and coalesce(property_token like '%7', false) is_panel_property from legs c left join ok on c.query_id = ok.query_id left join n on c.query_id = n.query_id where not failed or k is null or k = 1")
def build_stay_rows(quotes):
    legs, failed = legs_of(quotes)
    legs = dealt(legs, tasks_for(quotes.sparkSession.table("lineitem")), "query_id")
    payloads = quotes.select("query_id").distinct().select("query_id", F.concat(F.lit("raw "), F.col("query_id").cast("string")).alias("raw_response"))
    pinned = quotes.where("property_token like '%7'").select("property_token")
    rows = se.build_stay_rows(legs, quotes, failed=failed, payloads=payloads, pinned=pinned)
    return rows.select("query_id", "run_id", "n_quotes", "property_token", "tier", F.round("price_cheapest", 6).alias("price_cheapest"), "status", "error_message", "raw_response", "is_panel_property")
