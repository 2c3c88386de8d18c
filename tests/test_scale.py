"""What is right on small tables and was not, or not affordable, on large ones."""

import datetime as dt

from pyspark.sql import functions as F

from pricepanel.operators import monitoring as mo
from pricepanel.operators import payload as pl
from pricepanel.operators import reconcile as rc
from pricepanel.operators import selection as se
from pricepanel.operators import vintages as vt
from pricepanel.plans import registry, standins
from pricepanel.plans.panel_queries import rounded_means
from pricepanel.plans.standins import standin

FOLDER = "/root/testdata/sf0.001"
day = dt.date.fromisoformat


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_daily_medians_of_many_prices_are_exact(spark):
    """Of an even number the lower one; 60,000 distinct prices in 40 parts, which a sketch of 10,000 merges inexactly."""
    n = 60_000
    rows = spark.range(0, n, 1, 40).select(F.lit(day("2026-01-01")).alias("scrape_date"), F.lit(None).cast("string").alias("k"), F.lit("ok").alias("status"), F.expr(f"cast((id * 7919) % {n} + 1 as double)").alias("price_gbp"), F.lit(1.0).alias("price_cheapest_gbp"))
    got = mo.daily_by_series(rows, ["k"]).collect()
    assert [(r["n_ok"], r["median"], r["mean"], r["mean_cheapest"]) for r in got] == [(n, n / 2, (n + 1) / 2, 1.0)]
    regions = mo.daily_by_region(rows.withColumn("property_token", F.col("price_gbp").cast("string")), ["k"]).collect()
    assert [(r["n"], r["n_properties"], r["median"]) for r in regions] == [(n, n, n / 2)]


def test_daily_means_on_a_tie_do_not_hang_on_the_order_of_sums(spark):
    """The mean is 48.78325: a sum that comes out an ulp below it is no lower mean."""
    below = spark.createDataFrame([(48.78324999999998, 48.78325000000002, 48.78325, 48.7832)], "a double, b double, c double, d double")
    assert tuple(rounded_means(below, "a", "b", "c", "d").first()) == (48.7833, 48.7833, 48.7833, 48.7832)


def test_published_levels_are_made_once(spark):
    """Two averages of the same rows may differ in the last place, and a January is then not 100."""
    published = standin(spark, FOLDER, "published")
    assert plan_of(published).count("Aggregate") == 1
    assert {r[0] for r in published.where("month(index_month) = 1").select("index_value").collect()} == {100.0}


def test_grid_cells_are_read_as_written(spark):
    assert "o_orderdate" not in plan_of(registry.queries()["tidy_region_grid"](spark, FOLDER))


def test_chains_read_the_monthly_prices_as_written(spark):
    assert "o_orderdate" not in plan_of(registry.queries()["chained_index"](spark, FOLDER))


def test_keys_are_counted_in_one_pass(spark):
    """Nested keys, keys with a dot, repeated ones in arrays, depth and texts that are no JSON; the payloads are read once."""
    texts = ['{"properties":[{"a":1,"b":{"c":[{"d":1},{"d":2},3,null],"e.f":null}},[1,{"x":2}],5,null]}', "nonsense", '{"a":1,"a":2}', '{"properties":{"a":1}}', None]
    census = pl.key_census(spark.createDataFrame([(t,) for t in texts], "payload string").repartition(2), "payload", None)
    assert {r["key"]: r["n"] for r in census.collect()} == {"a": 1, "b": 1, "b.c": 1, "b.c[].d": 1, "b.e.f": 1, "[].x": 1}
    assert plan_of(census).count("Repartition") == 1


def test_properties_are_counted_by_their_sets_of_atoms(spark):
    m = day("2026-01-01")
    seen = [("A", "mid", "wed", True), ("A", "mid", "thu", False), ("B", None, "wed", None), ("B", "up", "wed", False), ("C", "mid", "wed", False), ("C", "mid", "wed", False), (None, "mid", "wed", True), (None, "low", "wed", False)]
    rows = spark.createDataFrame([(m, m, "per_night", "x", t, tier, night, pinned, 1.0) for t, tier, night, pinned in seen], "index_month_stay date, index_month_collection date, collection_alignment string, location string, property_token string, property_tier string, stay_night_kind string, is_panel_property boolean, price_gbp double")
    counted = rc.properties_seen(rows)
    assert not any("property_token" in line and "sample_rule" in line for line in plan_of(counted).splitlines() if "Aggregate" in line)
    got = {(r["sample_rule"], r["property_tier"], r["stay_night_kind"]): r["n_properties"] for r in counted.where("attribution = 'stay'").collect()}
    assert got == {
        ("matched_census", "mid", "wed"): 2, ("matched_census", "mid", "thu"): 1, ("matched_census", "up", "wed"): 1, ("matched_census", "unknown", "wed"): 1, ("matched_census", "low", "wed"): 0, ("matched_census", "low", "both"): 0, ("matched_census", "all", "wed"): 3, ("matched_census", "all", "thu"): 1,
        ("matched_census", "mid", "both"): 2, ("matched_census", "up", "both"): 1, ("matched_census", "unknown", "both"): 1, ("matched_census", "all", "both"): 3,
        ("pinned", "mid", "wed"): 1, ("pinned", "all", "wed"): 1, ("pinned", "mid", "both"): 1, ("pinned", "all", "both"): 1,
    }


def test_properties_are_counted_by_more_kinds_than_a_word_has_bits(spark):
    m = day("2026-01-01")
    seen = [("A", f"t{i:02}", night) for i in range(70) for night in ("wed", None)] + [("B", "t00", "wed"), ("C", "t69", None), ("C", "t03", "wed")]
    rows = spark.createDataFrame([(m, None, "per_night", None, t, tier, night, False, 1.0) for t, tier, night in seen], "index_month_stay date, index_month_collection date, collection_alignment string, location string, property_token string, property_tier string, stay_night_kind string, is_panel_property boolean, price_gbp double")
    found = rc.properties_seen(rows, 3).collect()
    got = {(r["property_tier"], r["stay_night_kind"]): r["n_properties"] for r in found if r["attribution"] == "stay"}
    assert len(found) == 2 * len(got) == 2 * 71 * 3 and all(got[f"t{i:02}", "both"] == (2 if i in (0, 3, 69) else 1) for i in range(70))
    assert (got["all", "both"], got["all", "wed"], got["all", None], got["t69", None], got["t69", "wed"]) == (3, 3, 2, 2, 1)


def test_stay_rows_are_read_as_written_and_only_middle_prices_are_shuffled(spark):
    for name in ("reconstruct_stays", "expected_churned"):
        assert "o_orderdate" not in plan_of(registry.queries()[name](spark, FOLDER)), name
    plan = plan_of(rc.reconstruct_stays(standin(spark, FOLDER, "stay_obs"))).splitlines()
    by_price = [line for line in plan if "Aggregate [" in line and "_p#" in line.split("Aggregate [")[1].split("]")[0]]
    assert by_price and all("_mb#" in line for line in by_price)


def test_line_items_meet_their_orders_in_tasks_of_bounded_size(spark, monkeypatch):
    """More rows are more tasks, on both sides alike; small tables are left to the planner."""
    few = standin(spark, FOLDER, "stay_obs")
    assert "Repartition" not in plan_of(few)
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    monkeypatch.setattr(standins, "ROWS_OF_A_TASK", 100)
    many = standin(spark, FOLDER, "stay_obs")
    assert sum("RepartitionByExpression [" in line and line.endswith(f"], {-(-rows // 100)}") for line in plan_of(many).splitlines()) == 2
    assert few.exceptAll(many).count() == many.exceptAll(few).count() == 0


def test_churn_queries_shuffle_the_panel_once(spark):
    """The latest month is told from the shuffle of the items themselves; the pinned properties are a reading of their own."""
    for name, readings in (("property_churn", 1), ("churned_tokens", 1), ("export_churn", 1), ("churn_summary", 1), ("churned_panel", 2)):
        df = registry.queries()[name](spark, FOLDER)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert sum("FileScan parquet [l_orderkey" in line for line in plan.splitlines()) == readings, name


def test_pins_without_a_location_fit_no_item(spark):
    seen = [("x", "a", "2000-01-01"), (None, "a", "2000-01-01"), (None, "b", "2000-02-01"), ("x", "c", "2000-03-01"), ("y", "a", "2000-02-01")]
    rows = spark.createDataFrame([(c, i, day(m)) for c, i, m in seen], "location string, property_token string, month date")
    pins = spark.createDataFrame([(None, "a"), (None, "b"), ("x", "a"), ("x", "c"), ("y", None)], "location string, property_token string")
    got = vt.churned_panel(vt.property_churn(rows, ["location"], month="month", counted=False), pins, ["location"])
    assert [(r["location"], r["property_token"], r["months_absent"]) for r in got.collect()] == [("x", "a", 2)] and "n_rows" not in got.columns


def test_messages_and_payloads_are_not_sorted_with_the_rows_of_a_query(spark):
    """The rows of a query are numbered before its message is there, and only properties meet the pinned tokens."""
    quotes = spark.createDataFrame([(q, pos, p, "hotel", 3.0, True, f"T{pos}") for q in (1, 2) for pos, p in ((0, 100.0), (1, 110.0), (2, 900.0))], "query_id long, pos int, price double, property_type string, hotel_class double, free_cancellation boolean, property_token string")
    queries, failed = spark.createDataFrame([(1,), (2,), (3,)], "query_id long"), spark.createDataFrame([(2, "x" * 2000)], "query_id long, message string")
    payloads = spark.createDataFrame([(1, "raw 1"), (2, "raw 2")], "query_id long, raw_response string")
    rows = se.build_stay_rows(queries, quotes, failed=failed, payloads=payloads, pinned=quotes.where("pos = 1"))
    sorts = [line for line in rows._jdf.queryExecution().sparkPlan().toString().splitlines() if "Window [row_number" in line]
    assert len(sorts) == 1 and "_failed" not in sorts[0]
    plan = plan_of(rows).splitlines()
    assert next(i for i, line in enumerate(plan) if "_failed" in line and "Join" not in line and "Aggregate" in line) > next(i for i, line in enumerate(plan) if "Window [row_number" in line)
    got = [(r["query_id"], r["property_token"], r["status"], r["is_panel_property"], r["raw_response"], len(r["error_message"] or "")) for r in rows.orderBy("query_id", "property_token").collect()]
    assert got == [(1, "T0", "ok", False, "raw 1", 0), (1, "T1", "ok", True, None, 0), (2, None, "error", False, None, 1000), (3, None, "no_data", False, None, 0)]


def test_star_classes_that_are_no_numbers_are_not_cast(spark):
    texts = ["4", " 4.5 ", "1e1", "4d", "-3", "+2.5f", ".5", "Infinity", "-inf", "NaN", "0x1p3", "4-star hotel", "4.0-star hotel", "four", "true", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    by_cast = F.coalesce(t.try_cast("double"), F.regexp_extract(t, r"(\d+(?:\.\d+)?)", 1).try_cast("double"))
    made = rows.select(pl.parse_star_class(F.lit(None).cast("string"), t).alias("a"), by_cast.alias("b"), (t.try_cast("double").isNull() | t.rlike(pl.MAYBE_NUMERIC)).alias("fits"), t.rlike(pl.MAYBE_NUMERIC).alias("tried"), "t").collect()
    assert [str(r["a"]) for r in made] == [str(r["b"]) for r in made]
    assert all(r["fits"] for r in made if r["t"] is not None)
    assert not any(r["tried"] for r in made if r["t"] and ("star" in r["t"] or r["t"] in ("four", "true")))
