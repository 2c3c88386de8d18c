"""Panels as files, raw payloads, ingest, and the rules of vintages, months and refusals."""

import datetime as dt
import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pricepanel.functions import calendar as cal
from pricepanel.operators import index_numbers as ix
from pricepanel.operators import payload as pl
from pricepanel.operators import scoring as sc
from pricepanel.operators import vintages as vt
from pricepanel.sources import panels
from pricepanel.streaming import ingest
from pricepanel.streaming.ingest import ingest_stream

day = dt.date.fromisoformat


def fare(i, date="2026-08-11", haul="domestic", run="r1"):
    return (i, None, day(date), run, f"R{i % 7}", haul, 1, "ok", float(i), float(i), 540)


def test_appends_are_counted_and_lie_by_cluster(spark, tmp_path):
    path = str(tmp_path / "panel")
    rows = spark.createDataFrame([fare(i, f"2026-08-1{i % 2}", ("domestic", "european", "long_haul")[i % 3]) for i in range(3000)], panels.FARE_OBS).repartition(4)
    assert panels.append_vintage(rows.limit(0), path, panels.FARE_OBS) == 0 and not glob.glob(f"{path}/*/*.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more data: a date has several files
    assert panels.append_vintage(rows, path, panels.FARE_OBS) == 3000
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert panels.append_vintage(rows.where("query_id < 10"), path, panels.FARE_OBS) == 10
    assert panels.read_panel(spark, path, panels.FARE_OBS).count() == 3010
    groups = [f.metadata.row_group(g).column(f.schema_arrow.names.index("haul_category")).statistics for f in map(pq.ParquetFile, glob.glob(f"{path}/*/*.parquet")) for g in range(f.num_row_groups)]
    could = [s for s in groups if s.min <= "long_haul" <= s.max]
    assert 0 < len(could) < len(groups)  # a filter passes over the others
    plan = panels.read_panel(spark, path, panels.FARE_OBS).where("haul_category = 'long_haul'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(haul_category,long_haul)" in plan


def test_two_shapes_in_one_read(spark, tmp_path):
    path = str(tmp_path / "shapes")
    spark.createDataFrame([(1, "a")], "id long, old string").write.parquet(path)
    spark.createDataFrame([(2, 3)], "id long, new int").write.mode("append").parquet(path)
    assert sorted(tuple(r) for r in panels.evolve_schema(spark, path).select("id", "old", "new").collect()) == [(1, "a", None), (2, None, 3)]
    spark.createDataFrame([(3, 1.5)], "id long, old double").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="(?i)merge"):
        panels.evolve_schema(spark, path)


def test_keys_of_each_raw_property(spark):
    some = [{"name": "A", "prices": [{"rate": 1}, {"rate": 2, "source": {"id": 7}}], "gps": {"lat": 1.5}}, {"name": None, "gps": {}}, "text", {}]
    payloads = [json.dumps({"properties": some, "other": {"name": 1}}), json.dumps({"properties": [{"name": "B"}]}), json.dumps({"error": "x"}), "not json", None]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    got = {r["key"]: r["n"] for r in pl.key_census(df, "p", top=None).collect()}
    assert got == {"name": 3, "gps": 2, "prices": 1, "gps.lat": 1, "prices[].rate": 1, "prices[].source": 1, "prices[].source.id": 1}
    assert [r["key"] for r in pl.key_census(df, "p", top=2).collect()] == ["name", "gps"]
    assert {r["key"]: r["n"] for r in pl.key_census(df, "p", top=None, items="$", deepest=1).collect()} == {"properties": 2, "other": 1, "error": 1}


def test_region_sheet_under_a_title(spark):
    cells = [("s", 0, 5, "Wales"), ("s", 0, 6, "London"), ("s", 2, 3, "London"), ("s", 2, 4, "Wales"), ("s", 3, 0, "2026 JAN"), ("s", 3, 3, "101"), ("s", 3, 4, "99")]
    got = panels.tidy_region_grid(spark.createDataFrame(cells, "sheet string, row int, col int, value string"), ["london", "wales"]).collect()
    assert sorted((r["location"], r["index_value"]) for r in got) == [("london", 101), ("wales", 99)]


def take(spark, folder):
    ingest_stream(spark, f"{folder}/in", f"{folder}/panel", f"{folder}/rejects", f"{folder}/state", panels.FARE_OBS).awaitTermination()
    return sorted(r["query_id"] for r in spark.read.schema(panels.FARE_OBS).parquet(f"{folder}/panel").collect())


def test_runs_delivered_twice_come_once(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def deliver(name, rows):
        keys = panels.FARE_OBS.names
        (tmp_path / "in" / name).write_text("".join(json.dumps({k: v if not isinstance(v, dt.date) else v.isoformat() for k, v in zip(keys, r, strict=True)}) + "\n" for r in rows))

    deliver("a.json", [fare(1), fare(2), fare(2)])  # a row that a file has twice is there twice
    deliver("b.json", [fare(1), fare(2), fare(3)])
    assert take(spark, tmp_path) == [1, 2, 2, 3]
    deliver("c.json", [fare(1), fare(2), fare(2)])
    assert take(spark, tmp_path) == [1, 2, 2, 3]
    deliver("d.json", [fare(3), fare(4), fare(5, run="r2"), fare(6, "2026-08-12")])
    assert take(spark, tmp_path) == [1, 2, 2, 3, 4, 5, 6]
    # A batch that was not committed is tried again and changes nothing.
    for f in glob.glob(f"{tmp_path}/state/commits/*"):
        if f.rsplit("/", 1)[-1] == "2":
            (tmp_path / "state" / "commits" / "2").unlink()
    for f in glob.glob(f"{tmp_path}/state/commits/.2*"):
        (tmp_path / "state" / "commits" / f.rsplit("/", 1)[-1]).unlink()
    assert take(spark, tmp_path) == [1, 2, 2, 3, 4, 5, 6]


def test_batches_are_compacted_by_month(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    days = ("2026-08-03", "2026-08-04", "2026-09-01", "2026-10-01")

    def deliver(name, rows):
        (tmp_path / "in" / name).write_text("".join(json.dumps({k: v if not isinstance(v, dt.date) else v.isoformat() for k, v in zip(panels.FARE_OBS.names, r, strict=True)}) + "\n" for r in rows))
        return take(spark, tmp_path)

    def held(batch):
        return {p.rsplit("=", 1)[-1] for p in glob.glob(f"{tmp_path}/panel/batch={batch}/scrape_date=*")}

    assert ingest.compact_batches(spark, f"{tmp_path}/panel", panels.FARE_OBS) == 0  # no panel yet
    deliver("a.json", [fare(1, days[0]), fare(2, days[0]), fare(2, days[0]), fare(9, days[3])])
    deliver("b.json", [fare(3, days[0]), fare(4, days[1])])
    deliver("c.json", [fare(5, days[2]), fare(6, days[1])])
    all_rows = deliver("d.json", [fare(7, days[0])])
    assert all_rows == [1, 2, 2, 3, 4, 5, 6, 7, 9]
    # The driver stops after some dates were deleted: nothing is lost, and the next ingest puts them in place.
    with monkeypatch.context() as cut:
        cut.setattr(ingest, "settle_compaction", lambda *a: 0)
        ingest.compact_batches(spark, f"{tmp_path}/panel", panels.FARE_OBS)
    assert take(spark, tmp_path) == all_rows and not (tmp_path / "panel" / "_compacted").exists()
    # August lay in three settled batches; September and October in one each; the newest batch stays.
    assert (held(0), held(1), held(2), held(3)) == ({days[3]}, set(), set(days[:3]), {days[0]})
    assert len(glob.glob(f"{tmp_path}/panel/batch=2/scrape_date={days[0]}/*.parquet")) == 1
    assert ingest.compact_batches(spark, f"{tmp_path}/panel", panels.FARE_OBS) == 0  # nothing is left to do
    # Half-written files are thrown away; a run delivered again after the compaction adds nothing.
    (tmp_path / "panel" / "_compacted" / "batch=2" / f"scrape_date={days[0]}").mkdir(parents=True)
    assert deliver("e.json", [fare(2, days[0]), fare(2, days[0]), fare(3, days[0]), fare(8, days[2])]) == sorted([*all_rows, 8])
    assert ingest.compact_batches(spark, f"{tmp_path}/panel", panels.FARE_OBS) == 2 and take(spark, tmp_path) == sorted([*all_rows, 8])


def test_a_cut_between_delete_and_move(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({n: v if not isinstance(v, dt.date) else v.isoformat() for n, v in zip(panels.FARE_OBS.names, fare(k), strict=True)}) + "\n")
        take(spark, tmp_path)
    real, ingest.settle_compaction = ingest.settle_compaction, lambda *a: 0
    try:
        ingest.compact_batches(spark, f"{tmp_path}/panel", panels.FARE_OBS)
    finally:
        ingest.settle_compaction = real
    for f in glob.glob(f"{tmp_path}/panel/batch=[01]/*/*"):
        os.unlink(f)
    assert take(spark, tmp_path) == [0, 1, 2]


def test_days_meet_within_a_window_without_a_nested_loop(spark):
    held = [day("2026-01-01") + dt.timedelta(d) for d in (0, 3, 9, 30, 31, 90)]
    days = [day("2025-12-25") + dt.timedelta(d) for d in range(0, 110, 4)]
    a = spark.createDataFrame([(d,) for d in days], "index_day date")
    b = spark.createDataFrame([(d, "ok") for d in held], "scrape_date date, status string")
    for window in (0, 1, 7, 40):
        got = {(r["index_day"], r["scrape_date"], r["offset_days"]) for r in vt.nearest_scrape_date(b, a, window).collect()}
        want = set()
        for d in days:
            near = min(((abs((h - d).days), h) for h in held if abs((h - d).days) <= window), default=None)
            want |= {(d, near[1], (near[1] - d).days)} if near else set()
        assert got == want
    for out in (vt.nearest_scrape_date(b, a), vt.resolve_collection_dates(a.select(F.trunc("index_day", "MM").alias("index_month"), F.col("index_day").alias("implied_date")), b)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_index_days_of_one_month_do_not_mix(spark):
    rows = [(day("2026-08-11"), "b", 2, "ok", 1.0, day("2026-09-08")), (day("2026-08-11"), "b", 2, "ok", 2.0, day("2026-09-15")), (day("2026-08-11"), "a", 1, "ok", 3.0, day("2026-09-08"))]
    panel = spark.createDataFrame(rows, "scrape_date date, run_id string, scrape_ts int, status string, price_gbp double, index_day date")
    dates = spark.createDataFrame([(day("2026-08-11"), day("2026-09-08"))], "scrape_date date, index_day date")
    assert [r["price_gbp"] for r in vt.panel_for_dates(panel, dates).collect()] == [1]
    assert sorted(r["price_gbp"] for r in vt.panel_for_dates(panel, dates.drop("index_day")).collect()) == [1, 2]


def test_changes_stop_at_a_new_regime_for_stays(spark):
    points = spark.createDataFrame([("x", day(m), v) for m, v in (("2024-12-01", 100.0), ("2025-01-01", 110.0), ("2025-02-01", 121.0))], "cell string, month date, level double")
    assert [round(r["pct_change"]) for r in ix.month_on_month(points, ["cell"]).orderBy("month").collect()] == [10, 10]
    assert [r["month"] for r in ix.month_on_month(points, ["cell"], ix.ERAS).collect()] == [day("2025-02-01")]


def test_overlap_of_fares_has_gaps(spark):
    rows = spark.createDataFrame([("v", day(f"2026-{m}-01")) for m in ("03", "05", "09")], "variant string, index_month date")
    none = spark.createDataFrame([], "blocker string, n long")
    assert sc.verdict(sc.distinct_months(rows), none).first()["verdict"] == "SCORED"
    assert sc.verdict(sc.longest_run(rows, ["variant"]), none).first()["verdict"] == "INSUFFICIENT_DATA"


def test_refusals(spark):
    df = spark.createDataFrame([(day("2026-08-20"),)], "d date")
    for bad in (cal.nth_weekday(F.col("d"), "TU", 5), cal.target_departure_date(F.col("d"), 3)):
        with pytest.raises(Exception, match="(?i)no tu"):
            df.select(bad).collect()
    with pytest.raises(ValueError):
        cal.nth_weekday(F.col("d"), "TU", 0)
    with pytest.raises(Exception, match="no Tuesday"):
        cal.expand_stay_nights(df.withColumnRenamed("d", "index_day")).collect()
    none = spark.createDataFrame([(None,)], "d date").select(cal.nth_weekday(F.col("d"), "TU", 2), cal.target_departure_date(F.col("d"), 1))
    assert none.first()[:] == (None, None)
    level = spark.createDataFrame([("x", day("2026-01-01"), 0.0)], "cell string, month date, level double")
    relatives = spark.createDataFrame([("x", day("2026-02-01"), 1.1)], "cell string, month date, jevons double")
    with pytest.raises(Exception, match="cannot splice"):
        ix.splice_nowcast(level, relatives, ["cell"]).collect()
    assert ix.splice_nowcast(level.withColumn("level", F.lit(100.0)), relatives, ["cell"]).first()["nowcast"] == pytest.approx(110)
