"""Selection anew from stored payloads, and the texts and times inside them."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricepanel.operators import payload as pl
from pricepanel.operators import selection as se


def itinerary(price, time=None, stops=0):
    leg = {"departure_airport": {"time": time}, "airline": "X"}
    return {"price": price, "flights": [leg] * (stops + 1) if time or stops else []}


@pytest.fixture(scope="module")
def fares(spark, tmp_path_factory):
    day = "2026-05-12 "
    payloads = [
        {"best_flights": [itinerary(72, day + "07:10"), itinerary(115, day + "09:40")], "other_flights": [itinerary(4841, day + "09:25", 1), itinerary("n/a", day + "09:00")]},
        {"other_flights": [itinerary(10), itinerary(60, "2026-05-12T23:50:00+01:00", 1)]},
        {"error": "No results found"},
    ]
    rows = [(i, json.dumps(p)) for i, p in enumerate(payloads)] + [(3, "not json"), (4, None), (5, json.dumps({"best_flights": [itinerary(50, day + "08:00"), itinerary(40, day + "10:00"), itinerary(45, day + "10:00")]}))]
    path = str(tmp_path_factory.mktemp("fares") / "p")
    spark.createDataFrame(rows, "query_id long, payload string").write.parquet(path)
    return spark.read.parquet(path)


def test_fares_under_several_settings_without_a_shuffle(fares):
    out = se.reselect_from_payload(fares, [("nine", 540, 5.0), ("midnight", 5, 5.0), ("tight", 540, 1.1)])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["query_id"], r["setting"]): r for r in out.collect()}
    assert len(got) == 18
    r = got[0, "nine"]
    assert (r["price"], r["minutes_off"], r["basis"], r["n_quotes"], r["n_considered"], r["price_cheapest"], r["selection_margin"], r["selection_spread"]) == (115, 40, "direct_only", 3, 2, 72, 70, 43)
    assert (got[0, "tight"]["price"], got[0, "tight"]["basis"], got[0, "tight"]["selection_margin"]) == (72, "direct_only+outlier_capped", None)
    assert (got[1, "nine"]["basis"], got[1, "nine"]["price"], got[1, "nine"]["minutes_off"]) == ("no_direct_available+outlier_capped", 10, None)
    for i in (2, 3, 4):
        assert (got[i, "nine"]["basis"], got[i, "nine"]["price"], got[i, "nine"]["n_quotes"], got[i, "nine"]["pos"]) == ("empty", None, 0, None)
    assert (got[5, "nine"]["price"], got[5, "nine"]["pos"], got[5, "nine"]["selection_margin"]) == (40, 1, 0)  # nearest, then cheaper, then first


def test_settings_of_each_row(fares):
    own = F.when(F.col("query_id") == 0, F.array(F.struct(F.lit("own"), F.lit(430), F.lit(5.0))))
    got = se.reselect_from_payload(fares, own).collect()
    assert [(r["query_id"], r["setting"], r["price"]) for r in got] == [(0, "own", 72)]
    with pytest.raises(ValueError, match="boats"):
        se.reselect_from_payload(fares, [], kind="boats")


def test_stays_under_several_rate_bases_without_a_shuffle(spark, tmp_path):
    stay = lambda token, price, stars=4.0, kind="Hotel", free=None: {"property_token": token, "rate_per_night": {"extracted_lowest": price}, "extracted_hotel_class": stars, "type": kind, "free_cancellation": free}
    some = [stay("A", 1, free=True), stay("B", 130, free=True), stay("C", 150), stay("D", 170, free=True), stay("E", 90, 3.0, free=False), stay("F", 10, kind="hostel"), stay("G", 99, 5.0), stay(None, 7)]
    spark.createDataFrame([(1, json.dumps({"properties": some})), (2, json.dumps({"error": "x"}))], "query_id long, payload string").write.parquet(f"{tmp_path}/p")
    out = se.reselect_from_payload(spark.read.parquet(f"{tmp_path}/p"), [("free", "refundable", 5.0), ("any", "any", 5.0), ("wide", "any", 1000.0)], kind="stays")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["query_id"], r["setting"], r["tier"]): r for r in out.collect()}
    assert len(got) == 12
    free, wide, mid = got[1, "free", "upscale"], got[1, "wide", "upscale"], got[1, "any", "midscale"]
    assert (free["considered"], free["dropped_outlier"], free["dropped_rate"], free["cheapest"], free["comparability_basis"]) == (2, 1, 1, 130, "tier=upscale+rate=refundable+board=unknown+room=unknown+non_hotel_excluded+outlier_capped")
    assert [p["property_token"] for p in wide["properties"]] == ["A", "B", "C", "D"] and wide["spread_ratio"] == 170
    assert (mid["considered"], mid["cheapest"], mid["spread_ratio"]) == (1, 90, None)
    for r in got.values():
        assert r["returned"] == r["considered"] + r["dropped_type"] + r["dropped_rate"] + r["dropped_outlier"] + r["other_tier"]
    assert got[2, "any", "upscale"]["returned"] == 0 and got[2, "any", "upscale"]["cheapest"] is None


def test_in_row_and_over_rows_agree(spark):
    quotes = spark.createDataFrame([(1, i, p, t, m) for i, (p, t, m) in enumerate([(9.0, 0, 500), (8.0, 0, 580), (None, 0, 540), (7.0, None, 540), (70.0, 0, None)])], "query_id long, pos int, price double, transfers int, dep_minutes int")
    r = se.select_fare(quotes).first()
    assert (r["price"], r["minutes_off"], r["n_quotes"], r["n_considered"], r["basis"], r["selection_margin"]) == (8, 40, 5, 2, "direct_only+outlier_capped", 0)


def test_times_keep_the_clock(spark):
    texts = ["2026-05-12 08:00", "2026-05-12T08:00:00+01:00", "2026-05-12T08:00:00.500", "2026-05-12T08:00:00.500Z", " 2026-05-12 08:00:30 ", "2026-05-12T08:00+0100", "2026-05-12", "12 May 2026", "2026-13-12 08:00", "2026-05-12 08:00 x", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(pl.parse_timestamps(F.col("t"))).collect()]
    at = dt.datetime(2026, 5, 12, 8)
    half = at + dt.timedelta(milliseconds=500)
    assert got == [at, at, half, half, at + dt.timedelta(seconds=30), at, dt.datetime(2026, 5, 12), None, None, None, None, None]


def test_entities_of_bulletins(spark):
    df = spark.createDataFrame([("<p>it&#39;s&nbsp;&quot;x&quot; A&amp;B &amp;quot; &lt;b&gt;</p><script>no</script>",)], "t string")
    assert df.select(pl.strip_html(F.col("t"))).first()[0] == 'it\'s "x" A&B " &lt;b&gt;'


def test_legs_without_quotes_have_the_empty_basis(spark):
    legs = spark.createDataFrame([(1,), (2,)], "query_id long")
    quotes = spark.createDataFrame([(1, 0, 72.0, 0, 430)], "query_id long, pos int, price double, transfers int, dep_minutes int")
    got = {r["query_id"]: r["basis"] for r in se.build_fare_rows(legs, se.select_fare(quotes)).collect()}
    assert got == {1: "direct_only", 2: "empty"}
