"""Month bitmaps against counting by hand: word ends, merges, gaps, repeated rows, nulls and no rows."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pricepanel.operators import index_numbers as ix
from pricepanel.operators import months as mo
from pricepanel.operators import vintages as vt


def first_day(number):
    return dt.date(number // 12, number % 12 + 1, 1)


@pytest.fixture(scope="module")
def seen():
    """(cell, item, month number) over some 17 years, so that several words and their ends are met; some rows twice."""
    deal = random.Random(7)
    start = 1995 * 12
    out = [(c, f"i{k}", start + m) for c in ("x", "y", None) for k in range(12) for m in range(200) if deal.random() < (0.9 if k < 6 else 0.05)]
    return out + out[::5]


def frame(spark, rows):
    return spark.createDataFrame([(c, i, first_day(m)) for c, i, m in rows], "cell string, item string, month date")


def test_match_counts_over_word_ends(spark, seen):
    held = defaultdict(set)
    for c, i, m in seen:
        held[c, m].add(i)
    want = {(c, first_day(m)): (len(items & held.get((c, m - 1), set())), len(items ^ held.get((c, m - 1), set()))) for (c, m), items in list(held.items())}
    got = ix.match_counts(frame(spark, seen).withColumn("price", F.lit(1.0)), ["cell"]).collect()
    assert {(r["cell"], r["month"]): (r["n_matched"], r["n_unmatched"]) for r in got} == want and len(got) == len(want)


def test_churn_and_merged_vintages(spark, seen):
    months, rows = defaultdict(set), defaultdict(int)
    for c, i, m in seen:
        months[c, i].add(m)
        rows[c, i] += 1
    latest = max(m for _, _, m in seen)
    want = {k: (first_day(min(v)), first_day(max(v)), len(v), rows[k], latest - max(v), "present" if max(v) == latest else "left", len(v) / (max(v) - min(v) + 1)) for k, v in months.items()}
    keyed = lambda df: {(r[0], r[1]): tuple(r[2:]) for r in df.collect()}
    assert keyed(vt.property_churn(frame(spark, seen), ["cell"], "item", "month")) == want
    parts = [mo.item_months(frame(spark, seen[k::3]), ["cell", "item"]) for k in range(3)]
    merged = mo.merge_months(["cell", "item"], parts[2], mo.merge_months(["cell", "item"], *parts[:2]))
    assert keyed(vt.churn_of_months(merged, ["cell", "item"])) == want


def test_items_without_a_month_and_no_rows(spark):
    rows = [("x", "a", None), ("x", "a", dt.date(1999, 12, 1)), ("x", "b", None), ("x", None, dt.date(2000, 1, 1))]
    df = spark.createDataFrame(rows, "cell string, item string, month date")
    got = {r["item"]: r for r in vt.property_churn(df, ["cell"], "item", "month").collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["months_seen"], got["a"]["n_rows"], got["a"]["presence_rate"]) == (1, 2, 1.0)
    assert (got["b"]["months_seen"], got["b"]["n_rows"], got["b"]["first_month"]) == (0, 1, None)
    assert vt.property_churn(df.limit(0), ["cell"], "item", "month").count() == 0


def test_the_panel_is_read_once(spark, seen, tmp_path):
    frame(spark, seen).write.parquet(f"{tmp_path}/p")
    churn = vt.property_churn(spark.read.parquet(f"{tmp_path}/p"), ["cell"], "item", "month")
    churn.collect()
    plan = churn._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1, plan
