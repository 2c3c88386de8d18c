"""Monthly reconstructions: elementary statistics under every variant, scopes, weights, provenance."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def geometric_mean(price: Column) -> Column:
    """Over prices above zero; null if there are none."""
    return F.exp(F.avg(F.when(price > 0, F.log(price))))


def quantised(value: Column) -> Column:
    return F.round(value, 4).cast("decimal(38,9)")


def price_bucket(price: Column) -> Column:
    """Buckets in the order of prices, each some 5 per cent wide; zero and less are below."""
    step = lambda p: F.floor(F.log(p) * 20)
    return F.when(price > 0, step(price)).when(price == 0, F.lit(-1_000_000)).otherwise(F.lit(-2_000_000) - step(-price))


def same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def cell_stats(rows: DataFrame, keys: list[str], price: str, *, lower: bool = False) -> DataFrame:
    """Count, mean, exact median and geometric mean of each cell's prices; the rows are read and aggregated once.

    First the rows of each cell are counted by price, with partial sums; all else is made from these counts, which grow with
    the distinct prices. The sums of their buckets make all but the median, and tell in which bucket or two the middle
    prices of a cell are. Then only the prices of these buckets are ranked. So no task ever holds a cell's prices, however
    many there are. With ``lower`` the median of an even number of prices is the lower of the middle two, not their mean.
    """
    p, times = F.col("_p"), F.col("_t")
    # A null price has a null bucket. Both uses of these counts are alike down to their filters, so that one shuffle serves them.
    counts = rows.select(*keys, F.col(price).alias("_p")).groupBy(*keys, "_p").agg(F.count("*").alias("_t")).withColumn("_b", price_bucket(p))
    buckets = counts.groupBy(*keys, "_b").agg(F.sum(F.when(p.isNotNull(), times).otherwise(0)).alias("_n"), F.sum(p * times).alias("_sum"), F.sum(F.when(p > 0, F.log(p) * times)).alias("_log"), F.sum(F.when(p > 0, times).otherwise(0)).alias("_above"))
    middle = middle_buckets(buckets, keys)
    prices = counts.join(middle, same([*keys, "_b"], [*own(keys), "_mb"])).groupBy(*own(keys), "_mb", "_p").agg(F.sum("_t").alias("_n"), *[F.first(c).alias(c) for c in RANKS])
    return totals(buckets, keys).join(medians(prices, keys, lower=lower), same(keys, own(keys)), "left").select(*keys, "n", "mean", "median", "geomean")


RANKS = ["_before", "_low", "_high"]


def own(keys: list[str]) -> list[str]:
    """Names of a cell's keys where those of the rows are there too."""
    return [f"_k{i}" for i in range(len(keys))]


def totals(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """Count, mean and geometric mean of each cell from the sums of its buckets."""
    return buckets.groupBy(*keys).agg(F.sum("_n").alias("n"), (F.sum("_sum") / F.sum("_n")).alias("mean"), F.exp(F.sum("_log") / F.sum("_above")).alias("geomean"))


def middle_buckets(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """The bucket or two of each cell with its middle prices, how many prices are below, and the ranks of the middle."""
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ranked = buckets.where("_n > 0").withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_all": F.sum("_n").over(Window.partitionBy(*keys))})
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return ranked.where((F.col("_before") < high) & (F.col("_before") + F.col("_n") >= low)).select(*[F.col(c).alias(k) for c, k in zip(keys, own(keys), strict=True)], F.col("_b").alias("_mb"), "_before", low.alias("_low"), high.alias("_high"))


def medians(prices: DataFrame, keys: list[str], *, lower: bool = False) -> DataFrame:
    """Median of each cell from the counted prices of its middle buckets."""
    p, inside = F.col("_p"), Window.partitionBy(*own(keys), "_mb").orderBy("_p")
    ranked = prices.withColumn("_to", F.col("_before") + F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_from", F.col("_to") - F.col("_n"))
    at = lambda rank: F.max(F.when((F.col("_from") < F.col(rank)) & (F.col("_to") >= F.col(rank)), p))
    return ranked.groupBy(*own(keys)).agg((at("_low") if lower else (at("_low") + at("_high")) / 2).alias("median"))


def elementary_stats(rows: DataFrame, keys: list[str], price: str = "price_gbp") -> DataFrame:
    """Count, mean, exact median and geometric mean of each cell's prices."""
    return cell_stats(rows, keys, price)


METHODS = "stack(3, 'mean', mean, 'median', median, 'geomean', geomean) as (method, value)"


def reconstruct_fares(rows: DataFrame) -> DataFrame:
    """attribution x month x haul x window x selection rule x method.

    n_routes counts the cell's routes whether or not they have the chosen price; n_observations counts prices.
    """
    long = rows.where("months_ahead > 0").selectExpr(
        "haul_category", "months_ahead", "route",
        "stack(4, 'departure', index_month_departure, 'nearest', price_gbp, 'departure', index_month_departure, 'cheapest', price_cheapest_gbp, 'collection', index_month_collection, 'nearest', price_gbp, 'collection', index_month_collection, 'cheapest', price_cheapest_gbp) as (attribution, index_month, selection_rule, price)",
    )
    cell = ["attribution", "index_month", "haul_category", "months_ahead", "selection_rule"]
    routes = long.select(*cell, "route").distinct().groupBy(*cell).agg(F.count("route").alias("n_routes"))
    cells = cell_stats(long, cell, "price").withColumnRenamed("n", "n_observations").join(routes, cell)
    return cells.selectExpr(*cell, "n_routes", "n_observations", METHODS).where("value is not null")


def expected_routes(recon: DataFrame, routes: DataFrame) -> DataFrame:
    """Attach how many routes the panel has of each haul."""
    return recon.join(routes.groupBy("haul_category").agg(F.countDistinct("route").alias("n_routes_expected")), "haul_category", "left")


STAY_CELL = ["attribution", "index_month", "collection_alignment", "sample_rule", "location", "property_tier", "stay_night_kind"]
STAY_KIND = ["collection_alignment", "location", "is_panel_property", "property_tier", "stay_night_kind"]
STAY_ROW = ["index_month_stay", "index_month_collection", *STAY_KIND, "property_token", "price_gbp"]
#: A cell with its other keys as a number, so that little is shuffled of a row.
NUMBERED_CELL = ["_a", "index_month", "_cell"]
MONTHS = "stack(2, 0, index_month_stay, 1, index_month_collection) as (_a, index_month)"
#: Kinds of a word of bits.
WORD = 60


def stay_rows(rows: DataFrame) -> DataFrame:
    """What a reconstruction reads; tier and sample are never null."""
    known = rows.withColumns({"is_panel_property": F.coalesce("is_panel_property", F.lit(False)), "property_tier": F.coalesce("property_tier", F.lit("unknown"))})
    return known.select(*STAY_ROW)


def stay_kinds(rows: DataFrame) -> DataFrame:
    """The kinds of rows there are, numbered, also within their place (alignment and location). Few, however many the rows."""
    kinds, place = stay_rows(rows).select(*STAY_KIND).distinct(), STAY_KIND[:2]
    number = {"_kind": F.row_number().over(Window.orderBy(*STAY_KIND)), "_place": F.dense_rank().over(Window.orderBy(*place)), "_bit": F.row_number().over(Window.partitionBy(*place).orderBy(*STAY_KIND)) - 1}
    return kinds.withColumns(number)


def stay_scopes(kinds: DataFrame) -> DataFrame:
    """Each kind in each of its cells: its samples, its own tier and all, its own night and both. Cells are numbered."""
    samples = F.when(F.col("is_panel_property"), F.array(F.lit("pinned"), F.lit("matched_census"))).otherwise(F.array(F.lit("matched_census")))
    scope = lambda c, every: F.explode(F.array(F.struct(F.col(c), F.lit(False).alias("every")), F.struct(F.lit(every).alias(c), F.lit(True).alias("every"))))
    out = kinds.withColumn("sample_rule", F.explode(samples)).withColumn("_tier", scope("property_tier", "all")).withColumn("_night", scope("stay_night_kind", "both"))
    out = out.withColumn("_cell", F.dense_rank().over(Window.orderBy("_place", "sample_rule", "_tier", "_night")))
    return out.select("_kind", "_place", "_bit", "_cell", "collection_alignment", "sample_rule", "location", "_tier.property_tier", "_night.stay_night_kind")


def of_kind(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """Rows with the numbers of their kind in place of its columns."""
    named = kinds.select(*[F.col(c).alias(k) for c, k in zip(STAY_KIND, own(STAY_KIND), strict=True)], "_kind", "_place", "_bit")
    return stay_rows(rows).join(F.broadcast(named), same(STAY_KIND, own(STAY_KIND))).select("index_month_stay", "index_month_collection", "_kind", "_place", "_bit", "property_token", "price_gbp")


def as_cells(numbered: DataFrame, scopes: DataFrame, *values: str) -> DataFrame:
    """The names of numbered cells."""
    names = scopes.select("_cell", *STAY_CELL[2:]).distinct()
    return numbered.join(F.broadcast(names), "_cell").withColumn("attribution", F.when(F.col("_a") == 0, "stay").otherwise("collection")).select(*STAY_CELL, *values)


def _seen(rows: DataFrame, kinds: DataFrame, scopes: DataFrame, tasks: int | None) -> DataFrame:
    """Distinct properties of each numbered cell."""
    words = [f"_w{i}" for i in range((kinds.agg(F.max("_bit")).first()[0] or 0) // WORD + 1)]
    in_word = lambda i, bit: F.when(F.floor(F.col("_bit") / WORD) == i, bit)
    bit = F.expr(f"shiftleft(1L, cast(_bit % {WORD} as int))")
    short = of_kind(rows, kinds).select("property_token", "_place", "_bit", "index_month_stay", "index_month_collection")
    dealt = short.repartition(*([tasks] if tasks else []), "property_token", "_place")
    sets = dealt.selectExpr("property_token", "_place", "_bit", MONTHS).groupBy("property_token", "_place", "_a", "index_month").agg(*[F.coalesce(F.bit_or(in_word(i, bit)), F.lit(0).cast("long")).alias(w) for i, w in enumerate(words)])
    alike = sets.groupBy("_a", "index_month", "_place", *words).agg(F.count("property_token").alias("_items"))
    held = F.coalesce(*[in_word(i, F.col(w).bitwiseAND(bit) != 0) for i, w in enumerate(words)])
    cells = alike.join(F.broadcast(scopes.select("_place", "_bit", "_cell")), "_place").where(held).select(*NUMBERED_CELL, *words, "_items").distinct()
    return cells.groupBy(*NUMBERED_CELL).agg(F.sum("_items").alias("n_properties"))


def properties_seen(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct properties of each cell.

    Rows are dealt by property and place once, in so many ``tasks``. There the kinds of a property in a month become bits;
    properties with equal bits are counted together, and only these sets, of which there are few, are put into cells. Rows
    without a property make a cell of none. The rows are read for their kinds first.
    """
    kinds = stay_kinds(rows)
    scopes = stay_scopes(kinds)
    return as_cells(_seen(rows, kinds, scopes, tasks), scopes, "n_properties")


def reconstruct_stays(rows: DataFrame, tasks: int | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """attribution x alignment x sample x scopes (tier or all, night or both) x method.

    Pinned rows are counted in both samples; the census is all rows, unmatched. Tier and night are never null in a cell.
    The rows are read four times, so they are best read from files. Only those of the middle buckets are shuffled by price:
    first rows are summed by bucket where they are read, then the prices of the buckets with the medians are picked. The
    tables that are broadcast grow with the cells, not with the rows. ``keep`` stores a small table that is read again.
    """
    kinds = keep(stay_kinds(rows))
    scopes = keep(stay_scopes(kinds))
    keys = NUMBERED_CELL
    priced = of_kind(rows, kinds).select("index_month_stay", "index_month_collection", "_kind", F.col("price_gbp").alias("_p"), price_bucket(F.col("price_gbp")).alias("_b"), F.when(F.col("price_gbp") > 0, F.log("price_gbp")).alias("_l"))
    atoms = priced.selectExpr(MONTHS, "_kind", "_p", "_b", "_l").groupBy("_a", "index_month", "_kind", "_b").agg(F.count("_p").alias("_n"), F.sum("_p").alias("_sum"), F.sum("_l").alias("_log"), F.count("_l").alias("_above"))
    buckets = keep(atoms.join(F.broadcast(scopes.select("_kind", "_cell")), "_kind").groupBy(*keys, "_b").agg(*[F.sum(c).alias(c) for c in ("_n", "_sum", "_log", "_above")]))
    middle = keep(middle_buckets(buckets, keys))
    asked = middle.join(F.broadcast(scopes.select("_kind", F.col("_cell").alias("_k2"))), "_k2").select(*own(keys), "_kind", "_mb").withColumnRenamed("_kind", "_mk")
    met = priced.selectExpr(MONTHS, "_kind", "_p", "_b").join(F.broadcast(asked), same(["_a", "index_month", "_kind", "_b"], ["_k0", "_k1", "_mk", "_mb"]))
    prices = met.groupBy(*own(keys), "_mb", "_p").agg(F.count("*").alias("_n")).alias("c").join(F.broadcast(middle.alias("m")), reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in (*own(keys), "_mb")])).select("c.*", *[f"m.{c}" for c in RANKS])
    cells = totals(buckets, keys).join(medians(prices, keys), same(keys, own(keys)), "left").drop(*own(keys))
    counts = _seen(rows, kinds, scopes, tasks).withColumnsRenamed(dict(zip(keys, own(keys), strict=True)))
    known = as_cells(cells.join(counts, same(keys, own(keys))).withColumnRenamed("n", "n_observations"), scopes, "n_observations", "n_properties", "mean", "median", "geomean")
    return known.selectExpr(*STAY_CELL, "n_observations", "n_properties", METHODS).where("value is not null")


def expected_churned(cells: DataFrame, panel: DataFrame) -> DataFrame:
    """Pinned properties expected per location and tier ('all' sums tiers; missing: those seen) and how many of them went."""
    counts = panel.rollup("location", "property_tier").agg(F.countDistinct("property_token").alias("n_expected"), F.grouping("property_tier").alias("_all"), F.grouping("location").alias("_top")).where("_top = 0")
    counts = counts.select("location", F.when(F.col("_all") == 1, "all").otherwise(F.col("property_tier")).alias("property_tier"), "n_expected")
    out = cells.join(counts, ["location", "property_tier"], "left")
    expected = F.coalesce("n_expected", "n_properties")
    return out.withColumns({"n_properties_expected": expected, "n_properties_churned": F.greatest(expected - F.col("n_properties"), F.lit(0))}).drop("n_expected")


def provenance_flags(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Exact if no offset, cached if any row is, board known if all rows' is, placeholder weights if any row's are, and the dates used."""
    weights = [F.bool_or("weights_are_placeholder").alias("weights_are_placeholder")] if "weights_are_placeholder" in rows.columns else []
    return rows.groupBy(*keys).agg(
        F.bool_and(F.col("offset_days") == 0).alias("index_day_exact"), F.bool_or("is_cached_source").alias("source_is_cached"), F.bool_and("board_known").alias("board_basis_known"), *weights,
        F.concat_ws(",", F.array_sort(F.collect_set(F.col("scrape_date").cast("string")))).alias("scrape_dates_used"),
    )


def weighted_aggregate(cells: DataFrame, weights: DataFrame, variant: list[str], part: str, *, on: tuple[str, ...] = (), parts: tuple[str, ...] | None = None, counts: tuple[str, ...] = ("n_observations",), any_of: tuple[str, ...] = (), all_of: tuple[str, ...] = (), carried: tuple[str, ...] = (), carry_from: str | None = None) -> DataFrame:
    """The 'all' row of each variant: weighted mean of 4-place values, weights made to sum to one over the parts at hand.

    Weights are by ``part`` and the columns ``on`` (of ``variant``, such as the window or the year). A row comes only where
    every part is there: all weighted ones, or just the ``parts`` named, each with a weight. ``counts`` are summed, flags are
    true for any or all parts, and ``carried`` columns are those of ``carry_from``, else of the lexically last part.
    """
    own = cells.where(F.col("value").isNotNull() & (F.col(part) != "all"))
    if parts is not None:
        own = own.where(F.col(part).isin(*parts))
    joined = own.join(weights.select(part, *on, F.col("weight").alias("_w")), [part, *on], "left")
    w, v = F.col("_w"), F.round("value", 4)
    order = F.when(F.col(part) == carry_from, F.col(part)) if carry_from else F.col(part)
    out = joined.groupBy(*variant).agg(
        F.count_distinct(F.when(w.isNotNull(), F.col(part))).alias("_n"), (F.sum(v * w) / F.sum(w)).alias("value"), *[F.sum(c).alias(c) for c in counts],
        *[F.bool_or(c).alias(c) for c in any_of], *[F.bool_and(c).alias(c) for c in all_of], *[F.max_by(c, order).alias(c) for c in carried],
    )
    if parts is not None:
        whole = out.where(F.col("_n") == len(set(parts)))
    elif on:
        whole = out.join(weights.groupBy(*on).agg(F.count_distinct(part).alias("_parts")), list(on)).where("_n = _parts").drop("_parts")
    else:
        whole = out.crossJoin(F.broadcast(weights.agg(F.count_distinct(part).alias("_parts")))).where("_n = _parts").drop("_parts")
    return whole.where("value is not null").drop("_n").withColumn(part, F.lit("all"))


def export_recon(recon: DataFrame, keys: list[str], places: int = 4) -> DataFrame:
    """Keys, counts and rounded values of a reconstruction, as exported."""
    return recon.select(*keys, "method", "n_observations", F.round("value", places).alias("value")).where("value is not null")


def headline_recon(rows: DataFrame, keys: list[str], top: int = 24) -> DataFrame:
    """The newest months of the headline cell: mean price of the pinned sample on index-week nights."""
    own = rows.where("is_panel_property and stay_night_kind = 'index_week'").groupBy(F.col("index_month_collection").alias("index_month"), *keys)
    return own.agg(F.avg("price_gbp").alias("value")).orderBy(F.desc("index_month"), *keys).limit(top)
