"""Operators of the price panel on hand values, and every registered oracle at the smallest scale."""

import datetime as dt
import decimal
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from pricepanel.functions import calendar as cal
from pricepanel.operators import index_numbers as ix
from pricepanel.operators import payload as pl
from pricepanel.operators import reconcile as rc
from pricepanel.operators import scoring as sc
from pricepanel.operators import selection as se
from pricepanel.operators import vintages as vt
from pricepanel.plans import registry
from pricepanel.sources import panels

FOLDER = "/root/testdata/sf0.001"
day = dt.date.fromisoformat


def test_nearest_to_target_among_plausible_direct_fares(spark):
    quotes = spark.createDataFrame([(1, 0, 72.0, 0, 430), (1, 1, 115.0, 0, 580), (1, 2, 4841.0, 1, 565), (2, 0, 10.0, None, None), (2, 1, 60.0, None, 540)], "query_id long, pos int, price double, transfers int, dep_minutes int")
    got = {r["query_id"]: r for r in se.select_fare(quotes).collect()}
    assert (got[1]["price"], got[1]["basis"], got[1]["n_quotes"], got[1]["n_considered"], got[1]["price_cheapest"]) == (115, "direct_only", 3, 2, 72)
    assert (got[2]["price"], got[2]["basis"], got[2]["minutes_off"], got[2]["selection_margin"]) == (10, "no_direct_available+outlier_capped", None, None)


def test_cap_on_both_sides_of_the_median(spark):
    rows = [(1, i, float(p), "Hotel", 4.0, True) for i, p in enumerate((1, 130, 150, 170))]
    quotes = spark.createDataFrame(rows, "query_id long, pos int, price double, property_type string, hotel_class double, free_cancellation boolean")
    assert sorted(r["price"] for r in se.comparable_stays(quotes).collect()) == [130, 150, 170]
    account = {r["tier"]: r for r in se.filter_accounting(quotes).collect()}
    assert set(account) == {"midscale", "upscale"} and account["upscale"]["dropped_outlier"] == 1
    for r in account.values():
        assert r["returned"] == r["considered"] + r["dropped_type"] + r["dropped_rate"] + r["dropped_outlier"] + r["other_tier"]


def test_unknown_rate_is_no_match(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "f boolean")
    assert [r[0] for r in df.select(se.matches_rate_basis(F.col("f"), "refundable")).collect()] == [False, True, False]


def test_matched_pairs_and_relatives(spark):
    a, b = day("2026-03-01"), day("2026-04-01")
    rows = [("x", i, a, p) for i, p in (("A", 100.0), ("B", 200.0), ("C", 300.0))] + [("x", i, b, p) for i, p in (("A", 110.0), ("B", 220.0), ("D", 400.0))]
    prices = spark.createDataFrame(rows, "cell string, item string, month date, price double")
    april = ix.match_counts(prices, ["cell"]).where(F.col("month") == b).first()
    assert (april["n_matched"], april["n_unmatched"]) == (2, 2)
    assert ix.price_relative(prices, ["cell"]).count() == 0
    r = ix.price_relative(prices, ["cell"], 2).first()
    assert r["jevons"] == pytest.approx(1.1) and r["dutot"] == pytest.approx(1.1) and r["carli"] == pytest.approx(1.1)


def test_chain_stops_at_a_gap(spark):
    months = [day(x) for x in ("2026-01-01", "2026-02-01", "2026-04-01")]
    rows = [("x", i, m, 10.0 * (k + 1)) for k, m in enumerate(months) for i in "ABC"]
    prices = spark.createDataFrame(rows, "cell string, item string, month date, price double")
    levels = lambda **kw: [r["level"] for r in ix.chained_index(prices, ["cell"], **kw).orderBy("month").collect()]
    one = (("1900-01-01", "one"),)
    assert levels(eras=one) == pytest.approx([100, 200])
    assert levels() == pytest.approx([100])  # a regime begins in February 2026
    assert levels(adjacent="observed") == pytest.approx([100, 200, 300])


def test_regimes(spark):
    df = spark.createDataFrame([(day(x),) for x in ("2024-12-01", "2025-01-01", "2026-01-01", "2026-02-01")], "m date")
    assert [r[0][:4] for r in df.select(ix.methodology_era(F.col("m"))).collect()] == ["pre_", "2025", "2025", "2026"]


def test_redaction_at_any_depth(spark):
    payload = '{"api_key":{"v":"SECRET"},"list":[{"secret_key":["T1",{"a":2}]}],"serpapi_api_key" : 7,"token":"kept","url":"https://x/?k=hush&q=1"}'
    df = spark.createDataFrame([(payload,), ('{"api_key":"a\\"b","n":1}',), ("not json",), (None,), ('{"secret_key":[broken',)], "p string")
    got = [r[0] for r in df.select(pl.redact_payload(F.col("p"), "hush")).collect()]
    assert got[0] == '{"api_key":"<redacted>","list":[{"secret_key":"<redacted>"}],"serpapi_api_key":"<redacted>","token":"kept","url":"https://x/?k=<redacted>&q=1"}'
    assert got[1:4] == ['{"api_key":"<redacted>","n":1}', "not json", None]
    assert "broken" not in got[4]
    assert df.select(pl.redact_payload(F.col("p"), keys=("token",))).first()[0].count("<redacted>") == 1


def test_failed_calls_are_rows(spark):
    legs = spark.createDataFrame([(1, "r"), (2, "r"), (3, "r")], "query_id long, run_id string")
    quotes = spark.createDataFrame([(1, 0, 72.0, 0, 430), (2, 0, 80.0, 0, 500)], "query_id long, pos int, price double, transfers int, dep_minutes int")
    failed = spark.createDataFrame([(2, "x" * 3000), (2, "later")], "query_id long, message string")
    got = {r["query_id"]: r for r in se.build_fare_rows(legs, se.select_fare(quotes), failed=failed).collect()}
    assert [got[i]["status"] for i in (1, 2, 3)] == ["ok", "error", "no_data"] and got[2]["price"] is None and got[1]["run_id"] == "r"
    assert [got[i]["n_quotes"] for i in (1, 2, 3)] == [1, 0, 0] and len(se.build_fare_rows(legs, se.select_fare(quotes), failed=failed.limit(1)).where("query_id = 2").first()["error_message"]) == 1000
    stays = spark.createDataFrame([(1, 0, 90.0, "A", "Hotel", 4.0, True), (1, 1, 95.0, "B", "Hotel", 3.0, True), (3, 0, 5.0, "C", "Hotel", 4.0, None)], "query_id long, pos int, price double, property_token string, property_type string, hotel_class double, free_cancellation boolean")
    raw = spark.createDataFrame([(1, "p1"), (3, "p3")], "query_id long, raw_response string")
    rows = se.build_stay_rows(legs, stays, failed=failed, payloads=raw, pinned=stays.where("property_token = 'B'")).orderBy("query_id", "tier").collect()
    assert [(r["query_id"], r["status"], r["property_token"], r["raw_response"], r["is_panel_property"]) for r in rows] == [(1, "ok", "B", "p1", True), (1, "ok", "A", None, False), (2, "error", None, None, False), (3, "no_data", None, "p3", False)]
    assert rows[3]["error_message"] == "1 properties returned, none comparable (rate_basis=refundable)"


def test_placeholder_weights_are_refused(spark):
    weights = spark.createDataFrame([(2020, "a", 1.0, False), (2021, "a", 2.0, True)], "year int, region string, weight double, is_placeholder boolean")
    years = spark.createDataFrame([(2020,), (2025,)], "target_year int")
    got = {r["target_year"]: r["weights_are_placeholder"] for r in vt.weights_as_of(weights, years, allow_placeholder=True).collect()}
    assert got == {2020: False, 2025: True}
    with pytest.raises(Exception, match="placeholders"):
        vt.weights_as_of(weights, years).collect()
    with pytest.raises(Exception, match="sum to nothing"):
        vt.normalise_weights(weights.withColumn("weight", F.lit(0.0))).collect()


def test_failed_sections_have_the_right_type(spark, tmp_path):
    sections = {"good": (lambda: spark.range(2).withColumnRenamed("id", "n"), "n long"), "bad": (lambda: spark.range(1).select("nothing"), "a long, b string")}
    assert panels.export_sections(spark, sections, str(tmp_path)) == {"good": "written", "bad": "failed: AnalysisException"}
    bad = panels.read_section(spark, str(tmp_path), "bad", "a long, b string")
    assert bad.count() == 0 and dict(bad.dtypes) == {"a": "bigint", "b": "string"}


def test_locations_that_failed_keep_their_sample(spark):
    cell, kinds = ["location", "tier"], "location string, tier string, property_token string"
    panel = spark.createDataFrame([("x", "t", "a"), ("y", "t", "a")], kinds)
    retired, seen = panel, spark.createDataFrame([("x", "t", "b"), ("y", "t", "b")], kinds)
    got = sorted(tuple(r) for r in se.top_up_sample(panel, retired, seen, cell, failed=panel.where("location = 'y'")).collect())
    assert got == [("x", "t", "b", "substitute_for:a"), ("y", "t", "a", "pinned")]


def test_exact_medians_of_any_prices(spark):
    import random
    import statistics

    rng = random.Random(6)
    cells = {k: [rng.choice([0.0, -3.0, 1e-9, 5.0, 5.0, rng.uniform(-9, 9), rng.uniform(0, 1e6)]) for _ in range(n)] for k, n in (("a", 1), ("b", 2), ("c", 75), ("d", 400), (None, 31))}
    df = spark.createDataFrame([(k, p) for k, ps in cells.items() for p in [*ps, None]], "k string, price double").repartition(5)
    got = {r["k"]: r for r in rc.cell_stats(df, ["k"], "price").collect()}
    assert {k: (r["n"], r["median"]) for k, r in got.items()} == {k: (len(v), statistics.median(v)) for k, v in cells.items()}


def test_elementary_stats(spark):
    rows = spark.createDataFrame([("d", 100.0), ("d", 200.0), ("e", None)], "k string, price_gbp double")
    got = {r["k"]: r for r in rc.elementary_stats(rows, ["k"]).collect()}
    assert (got["d"]["n"], got["d"]["mean"], got["d"]["median"]) == (2, 150, 150) and got["d"]["geomean"] == pytest.approx(math.sqrt(20_000))
    assert got["e"]["n"] == 0 and got["e"]["geomean"] is None


def test_later_partial_run_supersedes(spark):
    rows = [("2026-01-01", "a", 1), ("2026-01-01", "a", 1), ("2026-01-01", "b", 2), ("2026-01-01", None, 9)]
    got = vt.current_vintage(spark.createDataFrame(rows, "scrape_date string, run_id string, scrape_ts int")).collect()
    assert [r["run_id"] for r in got] == ["b"]


def test_index_days(spark):
    df = spark.createDataFrame([(day("2026-08-20"),)], "d date")
    second, third = cal.candidate_index_days(F.col("d"))
    assert df.select(second, third, cal.nth_weekday(F.col("d"), "TU", 5, missing="null")).first()[:] == (day("2026-08-11"), day("2026-08-18"), None)


def test_index_day_is_the_first_tuesday_that_can_be_one(spark):
    text = "Published 19 August 2026. Prices were collected on Tuesday 11 August 2026."
    pages = spark.createDataFrame([(1, text, day("2026-08-01")), (2, "on 4 August or 25 August 2026", day("2026-08-01")), (3, None, day("2026-08-01"))], "id long, t string, month date")
    got = {r["id"]: r for r in pl.extract_index_days(pages, "id", "t", "month").collect()}
    assert [(got[i]["index_day"], got[i]["ordinal"]) for i in (1, 2, 3)] == [(day("2026-08-11"), 2), (None, None), (None, None)]
    assert got[1]["evidence"].endswith("collected on Tuesday 11 August 2026.") and got[1]["rejected"] == ""
    stays = spark.createDataFrame([(1, "The index day was 4 August 2026. Index week commencing Monday 18th was not it; index week beginning 18 August 2026.", day("2026-08-01"))], "id long, t string, month date")
    row = pl.extract_index_days(stays, "id", "t", "month", pl.STAY_DAY_RULES).first()
    assert (row["index_day"], row["ordinal"], row["rejected"]) == (day("2026-08-18"), 3, "2026-08-04")


def test_labels(spark):
    df = spark.createDataFrame([("2026 JAN",), ("January 2020",), ("2017/01",), ("2020 Q1",), (None,)], "t string")
    assert [r[0] for r in df.select(pl.parse_month_label(F.col("t"))).collect()] == [day("2026-01-01"), day("2020-01-01"), day("2017-01-01"), None, None]


def test_newest_coverage_wins(spark):
    urls = spark.createDataFrame([("s", "2716tofebruary2025"), ("s", "14287tojanuary2022"), ("s", "999")], "k string, url string")
    assert pl.rank_releases(urls, ["k"]).first()["url"] == "2716tofebruary2025"


def test_scoring_runs(spark):
    rows = [("v", day(f"2026-0{m}-01"), float(r), float(p)) for m, r, p in ((3, 100, 100), (4, 110, 108), (5, 121, 118))]
    df = spark.createDataFrame(rows, "variant string, index_month date, reconstructed double, published double")
    assert sc.longest_run(df, ["variant"]).first()["longest_run"] == 3
    s = sc.score_variant(sc.scored_pairs(df, ["variant"]), ["variant"]).first()
    assert s["n_pairs"] == 2 and s["bias"] == pytest.approx((2 + 10 - 1000 / 108) / 2)


def test_appending_refuses_unknown_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="surprise"):
        panels.append_vintage(spark.createDataFrame([(1, 2)], "query_id long, surprise int"), str(tmp_path / "p"), panels.FARE_OBS)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_oracle_at_the_smallest_scale(spark, duck, name):
    got, cursor = registry.queries()[name](spark, FOLDER), duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    number = lambda v: isinstance(v, int | float | decimal.Decimal) and not isinstance(v, bool)
    plain = lambda rows: sorted(repr([round(float(v), 4) if number(v) else v for v in r]) for r in rows)
    assert plain(got.select(*names).collect()) == plain(cursor.fetchall())
