"""Queries of sources, payloads and labels: texts and files are made from the tables, then read by the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.functions.calendar import nth_weekday
from pricepanel.operators import payload as pl
from pricepanel.operators import published as pub
from pricepanel.operators import selection as se
from pricepanel.operators import vintages as vt
from pricepanel.plans.panel_queries import ERA, STAND_IN_ERAS, rounded
from pricepanel.plans.standins import scratch, standin, with_standins, written
from pricepanel.sources import panels
from pricepanel.streaming.ingest import compact_batches
from pricepanel.streaming.ingest import ingest_stream as ingest

Q: dict = {}
O: dict[str, str] = {}


def query(*names: str, sql: str | None = None):
    def register(f):
        Q[f.__name__] = lambda spark, sf_dir: f(*[standin(spark, sf_dir, n) for n in names])
        if sql:
            O[f.__name__] = with_standins(names, sql)
        return f

    return register


def on(name: str, sql: str | None = None):
    """A query over one of the given tables as it is."""

    def register(f):
        Q[f.__name__] = lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            O[f.__name__] = sql
        return f

    return register


FARE = "select query_id, scrape_date, route, status, round(price_gbp, 4) price_gbp from fare_obs"


def fare_columns(df):
    return rounded(df.select("query_id", "scrape_date", "route", "status", "price_gbp"), "price_gbp")


@query("fare_obs", sql=FARE + " where scrape_date between date '2024-01-05' and date '2024-01-12'")
def read_panel(fares):
    spark, path = fares.sparkSession, scratch(fares.sparkSession)
    panels.append_vintage(fares, path, panels.FARE_OBS)
    return fare_columns(panels.read_panel(spark, path, panels.FARE_OBS, "2024-01-05", "2024-01-12"))


@query("fare_obs", sql=FARE.replace("select ", "select (select count(*) from fare_obs) appended, ", 1) + " where haul_category = 'long_haul'")
def append_vintage(fares):
    """Three appends, of which one has no rows; read by a column that files and row groups are sorted by."""
    path = scratch(fares.sparkSession)
    n = sum(panels.append_vintage(part, path, panels.FARE_OBS) for part in (fares.where("query_id % 2 = 0"), fares.where("query_id % 2 = 1"), fares.limit(0)))
    return fare_columns(panels.read_panel(fares.sparkSession, path, panels.FARE_OBS).where("haul_category = 'long_haul'")).withColumn("appended", F.lit(n).cast("long"))


@query("fare_obs", sql=FARE)
def read_ndjson(fares):
    path = scratch(fares.sparkSession)
    panels.write_ndjson(fares, path)
    return fare_columns(panels.read_ndjson(fares.sparkSession, path, panels.FARE_OBS))


@query("fare_obs", sql="select query_id, cast(round(price_gbp, 2) as varchar) is null as no_price, status from fare_obs")
def write_ndjson(fares):
    """Decimals come out as strings: read as text."""
    path = scratch(fares.sparkSession)
    panels.write_ndjson(fares.select("query_id", "status", F.col("price_gbp").cast("decimal(38,9)").alias("price_gbp")), path)
    return fares.sparkSession.read.schema("query_id long, status string, price_gbp string").json(path).select("query_id", F.col("price_gbp").isNull().alias("no_price"), "status")


@query("weights", sql="select year, region, weight, false is_placeholder from weights")
def read_weights_csv(weights):
    path = scratch(weights.sparkSession)
    panels.write_weights_csv(weights, path)
    return panels.read_weights_csv(weights.sparkSession, path)


@query("weights", sql="select year, region, weight from weights")
def write_weights_csv(weights):
    path = scratch(weights.sparkSession)
    panels.write_weights_csv(weights, path)
    return panels.read_weights_csv(weights.sparkSession, path).select("year", "region", "weight")


SAMPLE_SQL = "select distinct location, coalesce(property_tier, 'unknown') tier, property_token, 'discovered' selection_basis from stay_obs where is_panel_property"


def _sample(stays):
    return stays.where("is_panel_property").select("location", F.coalesce("property_tier", F.lit("unknown")).alias("tier"), "property_token", F.col("property_token").alias("property_name"), F.lit("1995-01-01").alias("first_seen"), F.lit(None).cast("string").alias("selection_basis")).distinct()


@query("stay_obs", sql=SAMPLE_SQL)
def read_item_panel(stays):
    path = scratch(stays.sparkSession)
    panels.write_item_panel(_sample(stays), path)
    return panels.read_item_panel(stays.sparkSession, path).select("location", "tier", "property_token", "selection_basis")


@query("stay_obs", sql="select location, tier, count(*) n from (" + SAMPLE_SQL + ") group by 1, 2")
def write_item_panel(stays):
    path = scratch(stays.sparkSession)
    panels.write_item_panel(_sample(stays), path)
    return panels.read_item_panel(stays.sparkSession, path).groupBy("location", "tier").agg(F.count("*").alias("n"))


@query("fare_obs", sql="select query_id, case when query_id % 2 = 0 then months_ahead end months_ahead, case when query_id % 2 = 0 then null else dep_minutes end dep_minutes from fare_obs")
def evolve_schema(fares):
    """A folder with files of two shapes, read once."""
    spark, path = fares.sparkSession, scratch(fares.sparkSession)
    fares.where("query_id % 2 = 0").select("query_id", "months_ahead").write.parquet(path)
    fares.where("query_id % 2 = 1").select("query_id", "dep_minutes").write.mode("append").parquet(path)
    return panels.evolve_schema(spark, path).select("query_id", "months_ahead", "dep_minutes")


ID = "concat(location, ' ', cast(fetched_ts as varchar))"


def _series_payload(published):
    """A payload for each location and vintage, with its months and years."""
    each = published.select(F.concat_ws(" ", "location", "fetched_ts").alias("id"), F.struct(F.upper(F.date_format("index_month", "yyyy MMM")).alias("date"), F.round("index_value", 4).cast("string").alias("value")).alias("m"), F.struct(F.concat((F.year("index_month") + 20).cast("string")).alias("date"), F.lit("7.5").alias("value")).alias("y"))
    return each.groupBy("id").agg(F.collect_list("m").alias("months"), F.collect_set("y").alias("years")).select("id", F.to_json(F.struct(F.struct(F.concat(F.lit("Prices "), F.col("id")).alias("title")).alias("description"), "months", "years")).alias("payload"))


@query("published", sql=f"select {ID} as id, concat('Prices ', {ID}) series_name, index_month, round(index_value, 4) index_value, '2015_100' basis from published")
def parse_series_json(published):
    return panels.parse_series_json(_series_payload(published), "id").select("id", "series_name", "index_month", "index_value", "basis")


@query("published", sql=f"select distinct {ID} as id, cast(year(index_month) + 20 as int) as year, 7.5::double weight from published")
def parse_class_weight(published):
    return panels.parse_class_weight(_series_payload(published), "id")


def _cells(rows, sheet, row, col, value):
    return rows.select(sheet.cast("string").alias("sheet"), row.cast("int").alias("row"), col.cast("int").alias("col"), value.cast("string").alias("value"))


#: Each location of the stand-in as a series of the grids: category and window.
SERIES_OF = "(values ('AFRICA', 'domestic', 'Domestic', 1), ('AMERICA', 'european', 'Europe', 1), ('ASIA', 'european', 'Europe', 3), ('EUROPE', 'long_haul', 'Long-haul', 3), ('MIDDLE EAST', 'long_haul', 'Long-haul', 6)) v(location, haul_category, label, w)"


def _series_of(published):
    table = published.sparkSession.sql(f"select * from {SERIES_OF}")
    return published.join(F.broadcast(table), "location")


@query("published", sql=f"select cast(index_month + to_years(cast(15 * (fetched_ts + 1) as int)) as date) index_month, haul_category, cast(w as int) months_ahead, round(index_value, 4) index_value from published join {SERIES_OF} on published.location = v.location where year(index_month) + 15 * (fetched_ts + 1) between 2005 and 2035")
def tidy_series_grid(published):
    """A sheet for each year: months across, a row for each series under its label; the other vintage's years come later."""
    own = _series_of(published).withColumn("sheet", F.year("index_month") + 15 * (F.col("fetched_ts") + 1))
    row = F.lit(3) + F.array_position(F.lit(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]), F.col("location")) * 2
    sheet = F.col("sheet")
    values = _cells(own, sheet, row, F.month("index_month") + 1, F.round("index_value", 4))
    heads = own.select("sheet").distinct().withColumn("m", F.explode(F.sequence(F.lit(1), F.lit(12))))
    heads = _cells(heads, sheet, F.lit(1), F.col("m") + 1, F.element_at(F.array(*map(F.lit, pl.MONTHS)), F.col("m")))
    lines = own.select("sheet", "location", "label", "w").distinct()
    labels = _cells(lines, sheet, row - 1, F.lit(0), F.col("label")).union(_cells(lines, sheet, row, F.lit(1), F.concat(F.col("w").cast("string"), F.lit("-month"))))
    return panels.tidy_series_grid(values.union(heads).union(labels))


@query("published", sql=f"select cast(year(index_month) + 15 as int) as year, haul_category, cast(w as int) months_ahead, round(avg(index_value), 4) weight from published join {SERIES_OF} on published.location = v.location group by 1, 2, 3")
def tidy_weights_grid(published):
    own = _series_of(published).groupBy((F.year("index_month") + 15).alias("y"), "location", "label", "w").agg(F.round(F.avg("index_value"), 4).alias("value"))
    row = F.array_position(F.lit(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]), F.col("location"))
    one = F.lit("w")
    cells = _cells(own, one, row, F.col("y"), F.col("value")).union(_cells(own.select("y").distinct(), one, F.lit(0), F.col("y"), F.col("y")))
    lines = own.select("location", "label", "w").distinct()
    return panels.tidy_weights_grid(cells.union(_cells(lines, one, row, F.lit(0), F.col("label"))).union(_cells(lines, one, row, F.lit(1), F.concat(F.col("w").cast("string"), F.lit(" month")))))


REGION_NAMES = ["africa", "america", "asia", "europe", "middle east"]


@query("published", sql="select cast(fetched_ts as varchar) sheet, index_month, lower(location) as location, round(index_value, 4) index_value from published where index_value between 10 and 500")
def tidy_region_grid(published):
    """A sheet for each vintage, the second one transposed, each under a title that names two regions where no values are."""
    published = written(published)
    at = F.array_position(F.lit(REGION_NAMES), F.lower("location")) + 3
    down = (F.year("index_month") - 1990) * 12 + F.month("index_month")
    sheet = F.col("fetched_ts")
    values = _cells(published, sheet, down, at, F.round("index_value", 4))
    heads = _cells(published.select("location", "fetched_ts").distinct(), sheet, F.lit(0), at, F.col("location"))
    months = _cells(published.select("index_month", "fetched_ts").distinct(), sheet, down, F.lit(0), F.date_format("index_month", "yyyy MMM"))
    title = F.array(F.struct(F.lit(20).alias("at"), F.lit("Asia").alias("name")), F.struct(F.lit(21).alias("at"), F.lit("Europe").alias("name")))
    titles = published.select("fetched_ts").distinct().select("fetched_ts", F.inline(title))
    cells = values.union(heads).union(months).withColumn("row", F.col("row") + 1).union(_cells(titles, sheet, F.lit(0), F.col("at"), F.col("name")))
    return panels.tidy_region_grid(cells.where("sheet = '0'").union(panels.transposed(cells.where("sheet = '1'")).select("sheet", "row", "col", "value")), REGION_NAMES)


@query("weights", sql="select cast(year + 15 as int) as year, lower(region) region, round(weight / sum(weight) over (partition by year), 6) weight from weights")
def tidy_region_weights(weights):
    w = rounded(vt.normalise_weights(weights), "share", places=6)
    at = F.array_position(F.lit(REGION_NAMES), F.lower("region")) + 3
    cells = _cells(w, F.lit("s"), F.col("year"), at, F.col("share")).union(_cells(w.select("region").distinct(), F.lit("s"), F.lit(0), at, F.col("region"))).union(_cells(w.select("year").distinct(), F.lit("s"), F.col("year"), F.lit(0), F.col("year") + 15))
    return panels.tidy_region_weights(cells, REGION_NAMES)


@query("fare_obs", sql="select status, count(*) n from fare_obs group by 1")
def export_sections(fares):
    """Two sections, of which one fails and is written without rows."""
    spark, path, schema = fares.sparkSession, scratch(fares.sparkSession), "n long, status string"
    panels.export_sections(spark, {"status": (lambda: fares.groupBy("status").agg(F.count("*").alias("n")), schema), "broken": (lambda: fares.select("no such column"), schema)}, path)
    return panels.read_section(spark, path, "status", schema).unionByName(panels.read_section(spark, path, "broken", schema)).select("status", "n")


def _fare_payload(quotes):
    flights = F.when(F.col("transfers").isNull(), F.array().cast("array<struct<departure_airport:struct<time:string>,airline:string>>")).otherwise(F.transform(F.sequence(F.lit(0), F.col("transfers")), lambda i: F.struct(F.struct(F.format_string("2026-05-12 %02d:%02d", (F.col("dep_minutes") / 60).cast("int"), F.col("dep_minutes") % 60).alias("time")).alias("departure_airport"), F.lit("X").alias("airline"))))
    one = F.struct(flights.alias("flights"), F.when(F.col("pos") % 7 == 6, "n/a").otherwise(F.col("price").cast("string")).alias("price"), F.col("pos"))
    return quotes.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("pos", one.alias("q")))).alias("a")).select("query_id", F.to_json(F.struct(F.transform("a", lambda x: x["q"]).alias("other_flights"))).alias("payload"))


@query("quotes", sql="select query_id, round(price, 6) price, transfers, case when transfers is not null and dep_minutes is not null then dep_minutes end as minutes from quotes where pos % 7 <> 6")
def flatten_fare_payload(quotes):
    out = pl.flatten_fare_payload(_fare_payload(quotes), "query_id")
    return out.select("query_id", F.round("price", 6).alias("price"), "transfers", (F.hour("departure_at") * 60 + F.minute("departure_at")).alias("minutes"))


@query("quotes", sql="select query_id, 'GBP' currency, round(price, 6) price, transfers from quotes")
def flatten_cached_fare_payload(quotes):
    rows = quotes.groupBy("query_id").agg(F.collect_list(F.struct(F.col("price").cast("string").alias("price"), "transfers", F.lit("2026-05-12T08:00:00Z").alias("departure_at"))).alias("data"))
    out = pl.flatten_cached_fare_payload(rows.select("query_id", F.to_json(F.struct(F.lit("gbp").alias("currency"), "data")).alias("payload")), "query_id")
    return out.select("query_id", "currency", F.round("price", 6).alias("price"), "transfers")


def _stay_payload(quotes):
    q = F.struct(F.col("property_type").alias("type"), F.when(F.col("pos") % 6 != 5, F.col("property_token")).alias("property_token"), F.when(F.col("pos") % 2 == 0, F.col("hotel_class")).alias("extracted_hotel_class"), F.when(F.col("hotel_class").isNotNull(), F.concat(F.col("hotel_class").cast("string"), F.lit("-star hotel"))).alias("hotel_class"), "free_cancellation", F.struct(F.when(F.col("pos") % 3 != 0, F.col("price")).alias("extracted_lowest")).alias("rate_per_night"), F.struct(F.when(F.col("pos") % 3 == 0, F.col("price")).alias("extracted_lowest")).alias("total_rate"))
    return quotes.groupBy("query_id").agg(F.collect_list(q).alias("properties")).select("query_id", F.to_json(F.struct("properties")).alias("payload"))


@query("quotes", sql="select query_id, property_token, round(price, 6) price, property_type, hotel_class, free_cancellation from quotes where pos % 6 <> 5")
def flatten_stay_payload(quotes):
    return pl.flatten_stay_payload(_stay_payload(quotes), "query_id").select("query_id", "property_token", F.round("price", 6).alias("price"), "property_type", "hotel_class", "free_cancellation")


FARE_SETTINGS = [("nine", 540, 5.0), ("evening", 1080, 5.0), ("tight", 540, 1.2), ("night", 0, 2.0)]
STAY_SETTINGS = [("refundable", "refundable", 5.0), ("any", "any", 5.0), ("fixed", "non_refundable", 5.0), ("tight", "refundable", 1.3)]
_EMPTY = "query_id % 13 = 0"
RESELECTED = f"""with ids as (select distinct query_id from quotes), fs as (select * from (values {', '.join(f"('{n}', {t}, {r}::double)" for n, t, r in FARE_SETTINGS)}) v(setting, target, ratio)),
fq as (select query_id, pos, price, transfers, case when transfers is not null then dep_minutes end as m from quotes where pos % 7 <> 6 and not {_EMPTY}),
a as (select fq.*, fs.*, max(case when transfers = 0 then 1 else 0 end) over (partition by query_id, setting) d, count(*) over (partition by query_id, setting) nq from fq, fs),
p as (select *, min(price) over (partition by query_id, setting) lo, count(*) over (partition by query_id, setting) np from a where d = 0 or coalesce(transfers = 0, false)),
c as (select *, least(abs(m - target), 1440 - abs(m - target)) delta from p where price <= lo * ratio),
r as (select *, row_number() over (partition by query_id, setting order by coalesce(delta, 10000), price, pos) k, count(*) over (partition by query_id, setting) n from c),
f as (select query_id, setting, max(nq) nq, max(n) n, concat(case when max(d) = 1 then 'direct_only' else 'no_direct_available' end, case when max(n) < max(np) then '+outlier_capped' else '' end) basis, max(case when k = 1 then price end) price, max(case when k = 1 then delta end) off, max(case when k = 2 then delta end) - max(case when k = 1 then delta end) margin, max(lo) low from r group by 1, 2),
ss as (select * from (values {', '.join(f"('{n}', '{b}', {r}::double)" for n, b, r in STAY_SETTINGS)}) v(setting, rate, ratio)), t as (select * from (values ('midscale'), ('upscale')) v(tier)),
sq as (select query_id, price, coalesce(lower(trim(property_type)), '') kind, free_cancellation fc, case when hotel_class between 3 and 3.5 then 'midscale' when hotel_class between 4 and 4.5 then 'upscale' end as own from quotes where pos % 6 <> 5 and not {_EMPTY}),
sg as (select sq.*, setting, rate, ratio, kind in ('', 'hotel', 'motel', 'inn', 'aparthotel') typed, rate = 'any' or coalesce(fc = (rate = 'refundable'), false) rated from sq, ss),
sm as (select query_id, setting, own, median(price) m from sg where typed and rated group by 1, 2, 3),
st as (select sg.*, price between m / ratio and m * ratio fits from sg left join sm on sg.query_id = sm.query_id and sg.setting = sm.setting and sg.own = sm.own),
sa as (select query_id, setting, rate, tier, count(*) nq, count(*) filter (typed and rated and own = tier and fits) n, count(*) filter (not typed) nt, count(*) filter (typed and rated and own = tier and not fits) no, count(*) filter (typed and own = tier and not rated) nr, min(price) filter (typed and rated and own = tier and fits) low, max(price) filter (typed and rated and own = tier and fits) high from st, t group by 1, 2, 3, 4)
select 'fares' kind, ids.query_id, fs.setting, cast(null as varchar) tier, coalesce(nq, 0) n_quotes, coalesce(n, 0) n_considered, coalesce(basis, 'empty') basis, round(price, 6) price, round(low, 6) cheapest, off minutes_off, margin, cast(null as bigint) dropped_rate, cast(null as double) spread from ids cross join fs left join f on ids.query_id = f.query_id and fs.setting = f.setting
union all select 'stays', ids.query_id, ss.setting, t.tier, coalesce(nq, 0), coalesce(n, 0), concat('tier=', t.tier, '+rate=', ss.rate, '+board=unknown+room=unknown', case when nt > 0 then '+non_hotel_excluded' else '' end, case when no > 0 then '+outlier_capped' else '' end), null, round(low, 6), null, null, coalesce(nr, 0), round(case when n > 1 then high / low end, 6) from ids cross join ss cross join t left join sa on ids.query_id = sa.query_id and ss.setting = sa.setting and t.tier = sa.tier"""


@query("quotes", sql=RESELECTED)
def reselect_from_payload(quotes):
    """Fares and stays under four settings each, from raw payloads, some without quotes."""
    emptied = lambda rows: rows.withColumn("payload", F.when(F.expr(_EMPTY), F.when(F.col("query_id") % 2 == 0, '{"error":"no results found"}')).otherwise(F.col("payload")))
    fares = se.reselect_from_payload(emptied(_fare_payload(quotes)), FARE_SETTINGS)
    stays = se.reselect_from_payload(emptied(_stay_payload(quotes)), STAY_SETTINGS, kind="stays")
    one = fares.select(F.lit("fares").alias("kind"), "query_id", "setting", F.lit(None).cast("string").alias("tier"), "n_quotes", "n_considered", "basis", F.round("price", 6).alias("price"), F.round("price_cheapest", 6).alias("cheapest"), "minutes_off", F.col("selection_margin").alias("margin"), F.lit(None).cast("long").alias("dropped_rate"), F.lit(None).cast("double").alias("spread"))
    other = stays.select(F.lit("stays").alias("kind"), "query_id", "setting", "tier", F.col("returned").alias("n_quotes"), F.col("considered").alias("n_considered"), F.col("comparability_basis").alias("basis"), F.lit(None).cast("double").alias("price"), F.round("cheapest", 6).alias("cheapest"), F.lit(None).cast("int").alias("minutes_off"), F.lit(None).cast("int").alias("margin"), "dropped_rate", F.round("spread_ratio", 6).alias("spread"))
    return one.unionByName(other)


@query("quotes", sql="select query_id, pos, hotel_class stars from quotes")
def parse_star_class(quotes):
    text = F.concat(F.col("hotel_class").cast("string"), F.lit("-star hotel"))
    return quotes.select("query_id", "pos", pl.parse_star_class(F.when(F.col("pos") % 2 == 0, F.col("hotel_class").cast("string")).otherwise("true"), text).alias("stars"))


@query("quotes", sql="select query_id, pos, case when pos % 3 = 0 then free_cancellation when pos % 3 = 1 then true else free_cancellation end free_cancellation from quotes")
def parse_free_cancellation(quotes):
    text = F.col("free_cancellation").cast("string")
    prices = F.array(F.struct(F.lit(None).cast("string").alias("free_cancellation")), F.struct(F.when(F.col("pos") % 3 == 2, text).alias("free_cancellation")))
    return quotes.select("query_id", "pos", pl.parse_free_cancellation(F.when(F.col("pos") % 3 == 0, text), F.when(F.col("pos") % 3 == 1, "2026-05-01"), prices).alias("free_cancellation"))


@on("events", sql="select event_id, case when event_id % 7 < 6 then ts::date end as day, case when event_id % 7 < 6 then cast(hour(ts) * 60 + minute(ts) as int) end as minutes from events")
def parse_timestamps(events):
    forms = ["yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+01:00'", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-0530'", "yyyy-MM-dd'T'HH:mm'+02'", "yyyy-MM-dd HH:mm 'o''clock'"]
    text = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        text = F.when(F.col("event_id") % len(forms) == i, F.date_format("ts", form)).otherwise(text)
    t = pl.parse_timestamps(text)
    return events.select("event_id", F.to_date(t).alias("day"), (F.hour(t) * 60 + F.minute(t)).alias("minutes"))


@on("events", sql="select event_id, case when event_type = 'error' then 'error' when event_type = 'signup' then 'no_data' when user_id % 5 = 0 then 'no_data' else 'ok' end status, case when event_type = 'error' then concat('quota exceeded ', repeat('x', 985)) end message from events")
def classify_response(events):
    error = F.when(F.col("event_type") == "error", F.concat(F.lit("quota exceeded "), F.repeat(F.lit("x"), F.lit(2000)))).when(F.col("event_type") == "signup", "Google hasn't returned any results for this query.")
    said = F.col("user_id") % 5, error, F.lit(True)
    return events.select("event_id", pl.classify_response(*said).alias("status"), pl.response_error(*said).alias("message"))


@on("events", sql="select event_id, '{\"api_key\":\"<redacted>\",\"n\":' || user_id || ',\"in\":{\"secret_key\":\"<redacted>\",\"token\":' || user_id || ',\"url\":\"x?k=<redacted>\"}}' payload from events")
def redact_payload(events):
    """A third of the payloads has an object, a third an array under the inner key."""
    inner = F.when(F.col("event_id") % 3 == 0, '{"v":["S1",{"w":"S2"}]}').when(F.col("event_id") % 3 == 1, '["T1"]').otherwise("7")
    text = F.format_string('{"api_key":"s%d","n":%d,"in":{"secret_key":%s,"token":%d,"url":"x?k=hush"}}', "event_id", "user_id", inner, "user_id")
    return events.select("event_id", pl.redact_payload(text, "hush").alias("payload"))


_KEYS = {"type": "property_type is not null", "property_token": "pos % 6 <> 5", "extracted_hotel_class": "pos % 2 = 0 and hotel_class is not null", "hotel_class": "hotel_class is not null", "free_cancellation": "free_cancellation is not null", "rate_per_night": "true", "rate_per_night.extracted_lowest": "pos % 3 <> 0", "total_rate": "true", "total_rate.extracted_lowest": "pos % 3 = 0"}


@query("quotes", sql="with k as (" + " union all ".join(f"select 'raw_keys' field, '{k}' as value, count(*) filter ({c}) n from quotes" for k, c in _KEYS.items()) + "), v as (select 'class' field, cast(hotel_class as varchar) as value, count(*) n from quotes group by 2 union all select 'type', property_type, count(*) from quotes group by 2 union all select 'token', property_token, count(*) from quotes group by 2), t as (select *, row_number() over (partition by field order by n desc, value nulls last) k from v) select field, value, n from k where n > 0 union all select field, value, n from t where k <= 12")
def key_census(quotes):
    """Keys of each raw property, nested ones by path, beside the values of three fields."""
    keys = pl.key_census(_stay_payload(quotes), "payload").select(F.lit("raw_keys").alias("field"), F.col("key").alias("value"), "n")
    return keys.unionByName(pl.value_census(quotes, {"class": F.col("hotel_class"), "type": F.col("property_type"), "token": F.col("property_token")}))


@on("region", sql="select r_regionkey, case r_name when 'ASIA' then 'as' when 'EUROPE' then 'eu' when 'MIDDLE EAST' then 'me' end code from region")
def normalise_region(region):
    label = F.concat(F.lit("  "), F.replace("r_name", F.lit(" "), F.lit("   ")), F.lit(" (note 1)"))
    return region.select("r_regionkey", pl.normalise_region(label, {"asia": "as", "europe": "eu", "middle east": "me"}).alias("code"))


@on("orders", sql="select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month from orders")
def parse_month_label(orders):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.upper(F.date_format("o_orderdate", "yyyy MMM"))).when(k == 1, F.date_format("o_orderdate", "MMMM yyyy")).when(k == 2, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyy/MM"))
    return orders.select("o_orderkey", pl.parse_month_label(text).alias("month"))


@on("orders", sql="select o_orderkey, cast(year(o_orderdate) + 20 as int) as year, round(o_totalprice, 2) number, case when o_orderkey % 3 = 0 then null else true end is not null as known from orders")
def parse_year(orders):
    text = F.concat(F.lit("Weights for "), (F.year("o_orderdate") + 20).cast("string"))
    amount = F.concat(F.lit("£ "), F.format_number("o_totalprice", 2))
    return orders.select("o_orderkey", pl.parse_year(text).alias("year"), F.round(pl.parse_number(amount), 2).alias("number"), pl.parse_number(F.when(F.col("o_orderkey") % 3 == 0, "true").otherwise("1 %")).isNotNull().alias("known"))


@on("orders", sql="select o_orderkey, round(o_totalprice, 2) number from orders")
def parse_number(orders):
    amount = F.concat(F.lit(" £"), F.format_number("o_totalprice", 2), F.lit(" %"))
    return orders.select("o_orderkey", F.round(pl.parse_number(amount), 2).alias("number"))


@on("orders", sql="select o_orderkey, case o_orderkey % 4 when 0 then 'domestic' when 1 then 'european' when 2 then 'long_haul' end category, case o_orderkey % 5 when 1 then 1 when 3 then 3 end as win from orders")
def parse_category_window(orders):
    label = F.element_at(F.array(F.lit(" Domestic"), F.lit("European"), F.lit("Long-haul"), F.lit("Space")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return orders.select("o_orderkey", pl.parse_category(label).alias("category"), pl.parse_window(F.concat((F.col("o_orderkey") % 5).cast("string"), F.lit("-month"))).alias("win"))


@on("orders", sql="select o_custkey, strftime(max(date_trunc('month', o_orderdate)), '%B%Y') newest from orders group by 1")
def rank_releases(orders):
    url = F.concat((F.col("o_orderkey") % 977).cast("string"), F.lit("indicesto"), F.lower(F.date_format("o_orderdate", "MMMMyyyy")))
    best = pl.rank_releases(orders.select("o_custkey", url.alias("url")), ["o_custkey"])
    return best.select("o_custkey", F.initcap(F.regexp_extract("url", "to([a-z]+[0-9]{4})$", 1)).alias("newest"))


@on("pages", sql=r"select page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html || ' it&#39;s &quot;x&quot; a&amp;#39;b &lt;b&gt; <> 1 <p>', '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&#39;', ''''), '&quot;', chr(34)), '\s+', ' ', 'g')) as text from pages")
def strip_html(pages):
    return pages.select("page_id", pl.strip_html(F.concat("html", F.lit(" it&#39;s &quot;x&quot; a&amp;#39;b &lt;b&gt; <> 1 <p>"))).alias("text"))


_TUESDAY = "cast(f + cast((2 - isodow(f) + 7) % 7 + 7 as int) as date)"
_SAID = "'Figures on this index day (4 March 2020) are for index day of 5 May 2021. The data used in this release were collected on or around '"


@on("orders", sql=f"with o as (select o_orderkey, cast(date_trunc('month', o_orderdate) as date) f from orders), t as (select *, {_TUESDAY} d from o), s as (select *, concat({_SAID}, strftime(d, '%-d %B %Y'), '.') said, strftime(d, 'collected on or around %-d %B %Y') hit from t) select o_orderkey, case when o_orderkey % 3 > 0 then d end as index_day, case when o_orderkey % 3 > 0 then 2 end ordinal, case when o_orderkey % 3 > 0 then trim(substr(said, instr(said, hit) - 100, 100 + length(hit) + 100)) end evidence, concat(year(f), '-05-05,', case when o_orderkey % 3 = 0 then '2020-03-04,' else '' end, '2021-05-05') rejected from s")
def extract_index_days(orders):
    """Two thirds of the pages name the second Tuesday, after a date that is none."""
    second = nth_weekday(F.col("o_orderdate"), "TU", 2)
    first = F.lit(_SAID.strip("'"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(first, F.lit("never."))).otherwise(F.concat(first, F.date_format(second, "d MMMM yyyy"), F.lit(".")))
    out = pl.extract_index_days(orders.select("o_orderkey", text.alias("t"), F.trunc("o_orderdate", "MM").alias("m")), "o_orderkey", "t", "m")
    return out.select("o_orderkey", "index_day", "ordinal", "evidence", "rejected")


BASIS_SQL = "with p0 as (select concat(location, ' ', cast(fetched_ts as varchar)) series, * from published), j as (select series, count(*) filter (month(index_month) = 1) n, bool_and(abs(index_value - 100) <= 0.5) filter (month(index_month) = 1) near from p0 group by 1), pb as (select p0.*, case when n < 2 then 'unknown' when near then 'annual_january_100' else 'chained' end basis from p0 join j on p0.series = j.series)"


def _rows(published):
    named = published.withColumn("series", F.concat_ws(" ", "location", "fetched_ts"))
    return pub.published_rows(named, ["series"], STAND_IN_ERAS)


@query("published", sql=BASIS_SQL + f" select series, location, index_month, cast(fetched_ts as int) fetched_ts, round(index_value, 4) index_value, basis, {ERA.format('index_month')} methodology_era, true is_current from pb")
def published_rows(published):
    return _rows(published).select("series", "location", "index_month", "fetched_ts", F.col("index_value").cast("double").alias("index_value"), "basis", "methodology_era", "is_current")


@query("published", sql=BASIS_SQL + f" select cast(fetched_ts as int) as source, count(*) n_values, count(distinct index_month) n_months, min(index_month) first_month, max(index_month) last_month, cast(datediff('month', min(index_month), max(index_month)) + 1 as int) span_months, datediff('month', min(index_month), max(index_month)) + 1 - count(distinct index_month) n_holes, string_agg(distinct location, ',' order by location) locations, string_agg(distinct {ERA.format('index_month')}, ',' order by {ERA.format('index_month')}) eras, string_agg(distinct basis, ',' order by basis) bases from pb group by 1")
def coverage_report(published):
    return pub.coverage_report(_rows(published).withColumn("source", F.col("fetched_ts")), "source", STAND_IN_ERAS)


@query("published", sql="select location, index_month, fetched_ts, round(index_value * 5, 4) index_value from published where index_value * 5 between 10 and 500")
def plausible_values(published):
    return rounded(pub.plausible_values(published.withColumn("index_value", F.col("index_value") * 5)).select("location", "index_month", "fetched_ts", "index_value"), "index_value")


@query("fare_obs", sql="select scrape_date, count(*) n from fare_obs where query_id % 50 > 0 group by 1")
def ingest_stream(fares):
    """Run files written from the panel, some rows without a run, read as a stream to the end; then some delivered again under other names, before and after the batches are compacted."""
    spark, path = fares.sparkSession, scratch(fares.sparkSession)
    rows = fares.withColumn("run_id", F.when(F.col("query_id") % 50 > 0, F.col("run_id")))
    take = lambda: ingest(spark, f"{path}/in", f"{path}/panel", f"{path}/rejects", f"{path}/state", panels.FARE_OBS).awaitTermination()
    panels.write_ndjson(rows.where("query_id % 5 > 0"), f"{path}/in")
    take()
    take()  # finds nothing new
    panels.write_ndjson(rows.where("query_id % 5 < 3"), f"{path}/in")  # two fifths of these were there
    take()
    panels.write_ndjson(rows.where("query_id % 5 = 4"), f"{path}/in")  # all of these were there
    take()
    compact_batches(spark, f"{path}/panel", panels.FARE_OBS)
    panels.write_ndjson(rows.where("query_id % 5 = 0"), f"{path}/in")
    take()
    return spark.read.schema(panels.FARE_OBS).parquet(f"{path}/panel").groupBy("scrape_date").agg(F.count("*").alias("n"))
