"""Selection within a query's quotes: comparable sets, picks by time, margins, samples and filter accounts.

A query's quotes stay together as one array from parse to pick, so the pick needs one shuffle at most, and none where
a payload holds them: then any number of settings is tried in one pass over the payloads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.operators.payload import fare_quotes, stay_quotes

#: Property types that count as hotels (fixed values); null and blank count too.
HOTEL_TYPES = ("hotel", "motel", "inn", "aparthotel")
TIERS = ("midscale", "upscale")


def comparable_fares(quotes: DataFrame, key: str = "query_id", max_ratio: float = 5.0) -> DataFrame:
    """Direct quotes if there are any, else all; of these at most ``max_ratio`` times the cheapest. Unknown transfers are not direct."""
    w = Window.partitionBy(key)
    direct = F.coalesce(F.col("transfers") == 0, F.lit(False))
    pool = quotes.withColumn("_any", F.max(direct.cast("int")).over(w)).where((F.col("_any") == 0) | direct)
    out = pool.withColumn("_min", F.min("price").over(w)).withColumn("_in", F.col("price") <= F.col("_min") * max_ratio)
    capped = F.min(F.col("_in").cast("int")).over(w) == 0
    basis = F.concat(F.when(F.col("_any") == 1, "direct_only").otherwise("no_direct_available"), F.when(capped, "+outlier_capped").otherwise(""))
    return out.withColumn("basis", basis).where("_in").drop("_any", "_min", "_in")


def minutes_from_target(minutes: Column, target: Column | int) -> Column:
    """Circular distance over midnight."""
    d = F.abs(minutes - target)
    return F.least(d, 1440 - d)


def select_in_row(rows: DataFrame, quotes: str, target: Column, max_ratio: Column) -> DataFrame:
    """``rows`` with the selection among the quotes (price, transfers, dep_minutes, pos) in their array column, which goes.

    Columns are those of ``select_fare``; an array without quotes, or none, has the basis 'empty' and no price. No row leaves its place.
    """
    q = F.filter(F.col(quotes), lambda x: x["price"].isNotNull())
    direct = lambda x: F.coalesce(x["transfers"] == 0, F.lit(False))
    own = rows.withColumns({"_q": F.coalesce(q, F.filter(q, lambda x: F.lit(False))), "_target": target, "_ratio": max_ratio.cast("double")}).drop(quotes)
    own = own.withColumn("_any", F.exists("_q", direct)).withColumn("_pool", F.when(F.col("_any"), F.filter("_q", direct)).otherwise(F.col("_q")))
    own = own.withColumn("_low", F.array_min(F.transform("_pool", lambda x: x["price"])))
    ranked = lambda x: F.struct(F.coalesce(minutes_from_target(x["dep_minutes"], F.col("_target")), F.lit(UNTIMED)).alias("d"), x["price"].alias("p"), x["pos"].alias("o"))
    own = own.withColumn("_in", F.array_sort(F.transform(F.filter("_pool", lambda x: x["price"] <= F.col("_low") * F.col("_ratio")), ranked)))
    own = own.withColumns({"_1": F.get("_in", F.lit(0)), "_2": F.get("_in", F.lit(1))})
    timed = lambda c: F.when(F.col(c)["d"] < UNTIMED, F.col(c)["d"])
    basis = F.concat(F.when(F.col("_any"), "direct_only").otherwise("no_direct_available"), F.when(F.size("_in") < F.size("_pool"), "+outlier_capped").otherwise(""))
    made = {
        "price": F.col("_1.p"), "minutes_off": timed("_1"), "pos": F.col("_1.o"), "price_cheapest": F.col("_low"), "n_quotes": F.size("_q").cast("long"), "n_considered": F.size("_in").cast("long"),
        "basis": F.when(F.size("_q") > 0, basis).otherwise("empty"), "selection_margin": timed("_2") - timed("_1"), "selection_spread": F.col("_1.p") - F.col("_low"),
    }
    return own.withColumns(made).drop("_q", "_target", "_ratio", "_any", "_pool", "_low", "_in", "_1", "_2")


#: Rank of a quote without a time, after all times of a day.
UNTIMED = 10_000


def select_fare(quotes: DataFrame, key: str = "query_id", target: int = 540, max_ratio: float = 5.0) -> DataFrame:
    """Per query: the quote nearest the target (then cheaper, then first), the cheapest, counts, basis, margin and spread.

    Without a timed quote the cheapest is picked and its distance is null. One shuffle brings a query's quotes together.
    """
    arrays = quotes.groupBy(key).agg(F.collect_list(F.struct("price", "transfers", "dep_minutes", "pos")).alias("_quotes"), F.count("*").alias("_n"))
    return select_in_row(arrays, "_quotes", F.lit(target), F.lit(max_ratio)).withColumn("n_quotes", F.col("_n")).drop("_n")


def tier_for_class(stars: Column) -> Column:
    return F.when(stars.between(3, 3.5), "midscale").when(stars.between(4, 4.5), "upscale")


def matches_rate_basis(free_cancellation: Column, basis: str) -> Column:
    """'any' takes all; else an unknown rate is no match."""
    return F.lit(True) if basis == "any" else F.coalesce(free_cancellation == (basis == "refundable"), F.lit(False))


def hotel_like(kind: Column) -> Column:
    k = F.lower(F.trim(F.coalesce(kind, F.lit(""))))
    return (k == "") | k.isin(*HOTEL_TYPES)


def _staged(quotes: DataFrame, basis: str) -> DataFrame:
    """Each quote with its tier, and in _stage the stage before the cap that drops it."""
    tier = tier_for_class(F.col("hotel_class"))
    stage = F.when(~hotel_like(F.col("property_type")), "type").when(tier.isNull(), "other_tier").when(~matches_rate_basis(F.col("free_cancellation"), basis), "rate")
    return quotes.withColumns({"tier": tier, "_stage": stage})


def _outlier(max_ratio: float) -> Column:
    return ~F.col("price").between(F.col("_m") / max_ratio, F.col("_m") * max_ratio)


def staged_stays(quotes: DataFrame, key: str = "query_id", basis: str = "refundable", max_ratio: float = 5.0) -> DataFrame:
    """Each quote with the stage that drops it, or 'considered': type, other_tier, rate, then a cap on both sides of the tier's median."""
    rows = _staged(quotes, basis)
    medians = rows.where("_stage is null").groupBy(key, "tier").agg(F.median("price").alias("_m"))
    rows = rows.join(medians, [key, "tier"], "left")
    return rows.withColumn("stage", F.coalesce("_stage", F.when(_outlier(max_ratio), "outlier"), F.lit("considered"))).drop("_stage", "_m")


def comparable_stays(quotes: DataFrame, key: str = "query_id", basis: str = "refundable", max_ratio: float = 5.0) -> DataFrame:
    """The considered ones of ``staged_stays``; what drops earlier is not shuffled. Rows without a key have no median, and no cap."""
    median = F.median("price").over(Window.partitionBy(key, "tier"))
    rows = _staged(quotes, basis).where("_stage is null").withColumn("_m", F.when(F.col(key).isNotNull(), median))
    return rows.where(~F.coalesce(_outlier(max_ratio), F.lit(False))).drop("_stage", "_m")


def filter_accounting(quotes: DataFrame, key: str = "query_id", basis: str = "refundable") -> DataFrame:
    """Per query and tier, empty tiers too: returned, considered, and dropped by type, other tier, rate and cap; they add up."""
    staged = staged_stays(quotes, key, basis)
    whole = staged.groupBy(key).agg(F.count("*").alias("returned"), F.count_if(F.col("stage") == "type").alias("dropped_type"), F.count_if((F.col("stage") != "type") & F.col("tier").isNotNull()).alias("_tiered"), F.count_if((F.col("stage") != "type")).alias("_typed"))
    grid = whole.withColumn("tier", F.explode(F.array(*map(F.lit, TIERS))))
    count = lambda s: F.count_if(F.col("stage") == s)
    per = staged.where("stage <> 'type' and tier is not null").groupBy(key, "tier").agg(count("considered").alias("considered"), count("rate").alias("dropped_rate"), count("outlier").alias("dropped_outlier"), F.count("*").alias("_own"))
    out = grid.join(per, [key, "tier"], "left").fillna(0, ["considered", "dropped_rate", "dropped_outlier", "_own"])
    return out.select(key, "tier", "returned", "considered", "dropped_type", "dropped_rate", "dropped_outlier", (F.col("_typed") - F.col("_own")).alias("other_tier"))


def comparability_basis(account: DataFrame, basis: str | Column = "refundable") -> DataFrame:
    rate = F.concat(F.lit("rate="), F.lit(basis))
    said = F.concat_ws("+", F.concat(F.lit("tier="), F.col("tier")), rate, F.lit("board=unknown"), F.lit("room=unknown"), F.when(F.col("dropped_type") > 0, "non_hotel_excluded"), F.when(F.col("dropped_outlier") > 0, "outlier_capped"))
    return account.withColumn("comparability_basis", said)


def cell_cheapest_spread(quotes: DataFrame, cell: list[str]) -> DataFrame:
    """Cheapest of each cell and greatest over least price, null under two prices or a least of none."""
    low, high = F.min("price"), F.max("price")
    return quotes.groupBy(*cell).agg(low.alias("cheapest"), F.when((F.count("price") >= 2) & (low > 0), high / low).alias("spread_ratio"))


def headline_price(price: Column, before_taxes: Column, tax_basis: str) -> Column:
    return price if tax_basis == "advertised" else F.coalesce(before_taxes, price)


def pick_sample(quotes: DataFrame, cell: list[str], n: int = 3) -> DataFrame:
    """The first n items of each cell by token, blind to price."""
    tokens = quotes.select(*cell, "property_token").distinct()
    return tokens.withColumn("_k", F.row_number().over(Window.partitionBy(*cell).orderBy("property_token"))).where(F.col("_k") <= n).drop("_k")


def flag_panel_items(rows: DataFrame, panel: DataFrame) -> DataFrame:
    """Is the item pinned, by token alone?"""
    pinned = panel.select("property_token").distinct().withColumn("_pinned", F.lit(True))
    return rows.join(pinned, "property_token", "left").withColumn("is_panel_property", F.coalesce("_pinned", F.lit(False))).drop("_pinned")


def thin_cells(grid: DataFrame, panel: DataFrame, cell: list[str], least: int = 3) -> DataFrame:
    """Cells with fewer than ``least`` pinned items, empty ones too."""
    counts = panel.groupBy(*cell).agg(F.countDistinct("property_token").alias("n_pinned"))
    return grid.join(counts, cell, "left").fillna(0, ["n_pinned"]).where(F.col("n_pinned") < least)


def top_up_sample(panel: DataFrame, retired: DataFrame, candidates: DataFrame, cell: list[str], per_cell: int = 5, failed: DataFrame | None = None) -> DataFrame:
    """Pinned items less the retired, filled up to ``per_cell`` from the first candidates by token that are neither.

    Locations of ``failed`` calls keep all their old entries, the retired too, and get no new ones.
    """
    old = panel.select(*cell, "property_token").distinct()
    if failed is not None:
        left_out = failed.select("location").distinct()
        untouched = old.join(left_out, "location", "left_semi").select(*cell, "property_token", F.lit("pinned").alias("selection_basis"))
        old, retired, candidates = (x.join(left_out, "location", "left_anti") for x in (old, retired, candidates))
    kept = old.join(retired, [*cell, "property_token"], "left_anti").withColumn("selection_basis", F.lit("pinned"))
    have = kept.groupBy(*cell).agg(F.count("*").alias("_have"))
    gone = retired.groupBy(*cell).agg(F.concat_ws(",", F.array_sort(F.collect_set("property_token"))).alias("_gone"))
    first = pick_sample(candidates, cell, 3 * per_cell)
    fresh = first.join(kept.drop("selection_basis"), [*cell, "property_token"], "left_anti").join(retired, [*cell, "property_token"], "left_anti")
    w = Window.partitionBy(*cell).orderBy("property_token")
    fresh = fresh.withColumn("_k", F.row_number().over(w)).join(have, cell, "left").join(gone, cell, "left").where(F.col("_k") <= per_cell - F.coalesce("_have", F.lit(0)))
    basis = F.coalesce(F.concat(F.lit("substitute_for:"), F.col("_gone")), F.lit("discovered"))
    out = kept.select(*cell, "property_token", "selection_basis").unionByName(fresh.select(*cell, "property_token", basis.alias("selection_basis")))
    return out if failed is None else out.unionByName(untouched)


FARE_SETTINGS, STAY_SETTINGS = "array<struct<setting: string, target: int, max_ratio: double>>", "array<struct<setting: string, rate_basis: string, max_ratio: double>>"


def reselect_from_payload(stored: DataFrame, settings: Column | list[tuple], key: str = "query_id", payload: str = "payload", kind: str = "fares") -> DataFrame:
    """Selection anew from stored raw payloads under several settings: a row for each payload and setting (and, for stays, tier).

    ``settings`` are (name, target minutes, cap) for fares and (name, rate basis, cap) for stays, as a list or as an array
    column, so that each row may have its own. Each payload is parsed once, and no row is moved between tasks. A payload
    without quotes, or that is none, gives rows too: without a price, fares with the basis 'empty'.
    """
    if kind not in ("fares", "stays"):
        raise ValueError(f"no payloads of {kind}")
    shape = FARE_SETTINGS if kind == "fares" else STAY_SETTINGS
    if not isinstance(settings, Column):
        settings = F.array(*[F.struct(*map(F.lit, s)) for s in settings])
    parsed = (fare_quotes if kind == "fares" else stay_quotes)(F.col(payload))
    each = stored.select(key, parsed.alias("_quotes"), settings.cast(shape).alias("_settings")).select(key, "_quotes", F.inline("_settings"))
    if kind == "fares":
        timed = lambda q: F.struct(q["price"].alias("price"), q["transfers"].alias("transfers"), (F.hour(q["departure_at"]) * 60 + F.minute(q["departure_at"])).alias("dep_minutes"), q["pos"].alias("pos"))
        return select_in_row(each.withColumn("_quotes", F.transform("_quotes", timed)), "_quotes", F.col("target"), F.col("max_ratio"))
    return account_in_row(each.withColumn("tier", F.explode(F.array(*map(F.lit, TIERS)))), "_quotes")


def account_in_row(rows: DataFrame, quotes: str) -> DataFrame:
    """``rows`` (with tier, rate_basis and max_ratio) with the account of the stays in their array column, which goes: counts, basis, cheapest, spread and the properties by token."""
    with_tier = lambda q: F.coalesce(tier_for_class(q["hotel_class"]) == F.col("tier"), F.lit(False))
    own = rows.withColumn("_typed", F.filter(quotes, lambda q: hotel_like(q["property_type"]))).withColumn("_pool", F.filter("_typed", with_tier))
    wanted = lambda q: (F.col("rate_basis") == "any") | F.coalesce(q["free_cancellation"] == (F.col("rate_basis") == "refundable"), F.lit(False))
    own = own.withColumn("_rated", F.filter("_pool", wanted)).withColumn("_p", F.sort_array(F.transform("_rated", lambda q: q["price"])))
    n = F.size("_p")
    own = own.withColumn("_m", (F.get("_p", F.floor((n - 1) / 2).cast("int")) + F.get("_p", F.floor(n / 2).cast("int"))) / 2)
    inside = lambda q: q["price"].between(F.col("_m") / F.col("max_ratio"), F.col("_m") * F.col("max_ratio"))
    named = lambda q: F.struct(q["property_token"].alias("property_token"), q["price"].alias("price"), q["pos"].alias("pos"))
    own = own.withColumn("properties", F.array_sort(F.transform(F.filter("_rated", inside), named)))
    prices = F.transform("properties", lambda q: q["price"])
    size = lambda c: F.size(c).cast("long")
    counts = {
        "returned": size(quotes), "considered": size("properties"), "dropped_type": size(quotes) - size("_typed"), "dropped_rate": size("_pool") - size("_rated"), "dropped_outlier": size("_rated") - size("properties"),
        "other_tier": size("_typed") - size("_pool"), "cheapest": F.array_min(prices), "spread_ratio": F.when((F.size("properties") > 1) & (F.array_min(prices) > 0), F.array_max(prices) / F.array_min(prices)),
    }
    return comparability_basis(own.withColumns(counts), F.col("rate_basis")).drop(quotes, "_typed", "_pool", "_rated", "_p", "_m")


def with_failures(rows: DataFrame, failed: DataFrame | None, key: str) -> DataFrame:
    """Adds _failed, the text of a failed call (columns key and message of ``failed``), cut to 1000 characters; null otherwise."""
    if failed is None:
        return rows.withColumn("_failed", F.lit(None).cast("string"))
    said = failed.groupBy(key).agg(F.substring(F.coalesce(F.min("message"), F.lit("unknown error")), 1, 1000).alias("_failed"))
    return rows.join(said, key, "left")


def build_fare_rows(legs: DataFrame, picked: DataFrame, key: str = "query_id", failed: DataFrame | None = None) -> DataFrame:
    """One row per leg with all its own columns, such as calendar and provenance; legs without a pick stay as no_data, failed calls as error.

    A failed call has no price whatever ``picked`` says; counts are 0 and the basis is 'empty' where there was nothing to select from.
    """
    chosen = [c for c in picked.columns if c != key]
    rows = with_failures(legs.join(picked, key, "left"), failed, key)
    ok = F.col("_failed").isNull()
    rows = rows.withColumns({c: F.when(ok, F.coalesce(c, F.lit(0))) if c.startswith("n_") else F.when(ok, F.col(c)) for c in chosen})
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in chosen if c.startswith("n_")})
    status = F.when(~ok, "error").when(F.col("price").isNotNull(), "ok").otherwise("no_data")
    if "basis" in chosen:
        rows = rows.withColumn("basis", F.when(ok, F.coalesce("basis", F.lit("empty"))))
    return rows.withColumns({"status": status, "error_message": F.col("_failed")}).drop("_failed")


def build_stay_rows(queries: DataFrame, quotes: DataFrame, key: str = "query_id", basis: str = "refundable", failed: DataFrame | None = None, payloads: DataFrame | None = None, pinned: DataFrame | None = None) -> DataFrame:
    """One row per property that survives, with all columns of its query; failed calls are one error row.

    A query of which no property survives is one no_data row that says how many were returned. The payload (columns key
    and raw_response of ``payloads``) is on the first row of a query only; ``pinned`` tells is_panel_property.
    """
    returned = quotes.groupBy(key).agg(F.count("*").alias("n_quotes"))
    kept = comparable_stays(quotes, key, basis)
    cheapest = F.min("price").over(Window.partitionBy(key, "tier"))
    kept = kept.select(key, "property_token", "tier", "pos", "price", cheapest.alias("price_cheapest"))
    if pinned is not None:  # on the properties alone: rows without one would all meet under a null token
        kept, queries = flag_panel_items(kept, pinned), queries.drop("is_panel_property")
    rows = queries.join(kept, key, "left").join(returned, key, "left").fillna(0, ["n_quotes"])
    first = F.row_number().over(Window.partitionBy(key).orderBy("tier", "pos", "property_token")) == 1
    # Messages and payloads come after the sort, so that none is sorted with every property.
    rows = with_failures(rows.withColumn("_first", first), failed, key).where(F.col("_failed").isNull() | F.col("_first"))
    ok, none = F.col("_failed").isNull(), F.col("price").isNull()
    rows = rows.withColumns({c: F.when(ok, F.col(c)) for c in ("property_token", "tier", "pos", "price", "price_cheapest", "n_quotes")})
    nothing = F.when(F.col("n_quotes") > 0, F.concat(F.col("n_quotes").cast("string"), F.lit(f" properties returned, none comparable (rate_basis={basis})")))
    rows = rows.withColumns({"status": F.when(~ok, "error").when(none, "no_data").otherwise("ok"), "error_message": F.coalesce("_failed", F.when(none, nothing))}).fillna(0, ["n_quotes"])
    if payloads is not None:
        rows = rows.join(payloads.select(key, F.col("raw_response").alias("_raw")), key, "left").withColumn("raw_response", F.when(F.col("_first") & ok, F.col("_raw"))).drop("_raw")
    if pinned is not None:
        rows = rows.withColumn("is_panel_property", ok & F.coalesce("is_panel_property", F.lit(False)))
    return rows.drop("_first", "_failed", "pos")
