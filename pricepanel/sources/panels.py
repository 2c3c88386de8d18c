"""Reading and writing panels, weights, samples and grids; schemas are fixed and written by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel.operators.payload import MONTHS, month_of_name, parse_category, parse_month_label, parse_number, parse_window, parse_year

_KINDS = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def schema_of(text: str) -> T.StructType:
    """A flat schema from 'name kind, ...'; needs no session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (x.split() for x in text.split(","))])


FARE_OBS = schema_of("query_id long, scrape_ts timestamp, scrape_date date, run_id string, route string, haul_category string, months_ahead int, status string, price_gbp double, price_cheapest_gbp double, dep_minutes int")
WEIGHTS = schema_of("year int, region string, weight double, is_placeholder string")
SAMPLE = schema_of("location string, tier string, property_token string, property_name string, first_seen string, selection_basis string")
SERIES = "description struct<title: string>, months array<struct<date: string, value: string>>, years array<struct<date: string, value: string>>, quarters array<struct<date: string, value: string>>"


def read_panel(spark: SparkSession, path: str, schema: T.StructType, first=None, last=None, dates: list | None = None) -> DataFrame:
    """A date range or list of a panel; the filter prunes partitions."""
    rows = spark.read.schema(schema).parquet(path)
    if dates is not None:
        return rows.where(F.col("scrape_date").isin(dates))
    return rows.where(F.col("scrape_date").between(first, last)) if first is not None else rows


def conformed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a schema in its order, missing nullable ones null; unknown columns are refused."""
    unknown = sorted(set(rows.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns not in the schema: {', '.join(unknown)}")
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


#: What the rows of a date lie sorted by, where a schema has it (fixed values).
CLUSTER = ("haul_category", "location", "route", "stay_night_kind")


def append_vintage(rows: DataFrame, path: str, schema: T.StructType, by: str = "scrape_date", cluster: tuple[str, ...] | None = None) -> int:
    """Append under a fixed schema; nothing is ever rewritten. Returns the number of rows, counted while they are written; none write no files.

    Rows are dealt by ranges of date and ``cluster`` columns and sorted by them, so that a date has as many files as it needs,
    each with a narrow range of them, and a filter on one passes over files and row groups by their statistics.
    """
    order = [by, *(cluster if cluster is not None else [c for c in CLUSTER if c in schema.names])]
    dealt = conformed(rows, schema).repartitionByRange(*order).sortWithinPartitions(*order)
    seen = Observation()
    dealt.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(by).parquet(path)
    return seen.get["n"]


def write_ndjson(rows: DataFrame, path: str) -> None:
    """Newline-delimited JSON: decimals as strings, dates in ISO form."""
    decimals = [f.name for f in rows.schema if isinstance(f.dataType, T.DecimalType)]
    rows.withColumns({c: F.col(c).cast("string") for c in decimals}).write.mode("append").json(path)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_weights_csv(spark: SparkSession, path: str) -> DataFrame:
    """# lines are comments; rows without a year are skipped; 1, true and yes mark a placeholder."""
    rows = spark.read.option("comment", "#").option("header", True).schema(WEIGHTS).csv(path)
    return rows.where("year is not null").withColumn("is_placeholder", F.coalesce(F.lower(F.trim("is_placeholder")).isin("1", "true", "yes"), F.lit(False)))


def write_weights_csv(weights: DataFrame, path: str) -> None:
    """Sorted by key over all files, no row a placeholder; a small table comes out as few files."""
    weights.withColumn("is_placeholder", F.lit("false")).orderBy("year", "region").write.option("header", True).csv(path)


def read_item_panel(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("comment", "#").option("header", True).schema(SAMPLE).csv(path)
    return rows.where(F.length(F.trim("property_token")) > 0).fillna("discovered", ["selection_basis"])


def write_item_panel(panel: DataFrame, path: str) -> None:
    """Sorted over all files, which are as many as the data need."""
    panel.orderBy("location", "tier", "property_name", "property_token").write.option("header", True).csv(path)


def evolve_schema(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of older and newer shapes in one read: the columns of all of them, null where a file lacks one.

    The footers are merged by Spark; a column that has two types that do not widen into one another is refused.
    """
    return spark.read.option("mergeSchema", True).parquet(*paths)


def parse_series_json(rows: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    """Monthly values above zero of a series; years and quarters would count twice and stay out."""
    p = F.from_json(payload, SERIES)
    each = rows.select(key, F.coalesce(p["description"]["title"], F.col(key).cast("string")).alias("series_name"), F.explode(p["months"]).alias("m"))
    out = each.select(key, "series_name", parse_month_label(F.col("m.date")).alias("index_month"), F.col("m.value").try_cast("double").alias("index_value"))
    return out.where("index_month is not null and index_value > 0").withColumns({"basis": F.lit("2015_100"), "location": F.lit("uk")})


def parse_class_weight(rows: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    each = rows.select(key, F.explode(F.from_json(payload, SERIES)["years"]).alias("y"))
    out = each.select(key, parse_year(F.col("y.date"), 2015).alias("year"), F.col("y.value").try_cast("double").alias("weight"))
    return out.where("year is not null and weight > 0")


def _headers(cells: DataFrame, parsed: Column, least: int) -> DataFrame:
    """The first row of each sheet with ``least`` parsed cells at least: sheet, header_row, col, head."""
    rows = _candidates(cells, parsed, least)
    return rows.join(rows.groupBy("sheet").agg(F.min("header_row").alias("header_row")), ["sheet", "header_row"])


def _candidates(cells: DataFrame, parsed: Column, least: int) -> DataFrame:
    """Every row with ``least`` parsed cells at least: sheet, header_row, col, head."""
    heads = cells.withColumn("head", parsed).where("head is not null").select("sheet", F.col("row").alias("header_row"), "col", "head")
    return heads.withColumn("_n", F.count("*").over(Window.partitionBy("sheet", "header_row"))).where(F.col("_n") >= least).drop("_n")


def _enough(rows: DataFrame, least: int) -> DataFrame:
    """The rows, if they are ``least`` at least; their number is one row, joined."""
    return rows.crossJoin(F.broadcast(rows.agg(F.count("*").alias("_n")))).where(F.col("_n") >= least).drop("_n")


def tidy_series_grid(cells: DataFrame, least_months: int = 6, least_values: int = 12) -> DataFrame:
    """Year sheets to long series: months across, category labels filled down, windows in a column; the first value wins."""
    month = F.when(F.lower(F.trim("value")).isin(*MONTHS, *[m[:3] for m in MONTHS]), month_of_name(F.trim("value")))
    heads = _headers(cells, month, least_months)
    down = Window.partitionBy("sheet").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    labels = cells.groupBy("sheet", "row").agg(F.min_by(parse_category(F.col("value")), F.when(parse_category(F.col("value")).isNotNull(), F.col("col"))).alias("c"), F.max(parse_window(F.col("value"))).alias("months_ahead"))
    labels = labels.withColumn("haul_category", F.last("c", ignorenulls=True).over(down)).drop("c")
    values = cells.join(heads, ["sheet", "col"]).where("row > header_row").join(labels, ["sheet", "row"])
    year = F.when(F.col("sheet").try_cast("int").between(2005, 2035), F.col("sheet").try_cast("int"))
    out = values.select(F.make_date(year, "head", F.lit(1)).alias("index_month"), "haul_category", "months_ahead", parse_number(F.col("value")).alias("index_value"), "row", "col").where("index_month is not null and haul_category is not null and months_ahead is not null and index_value > 0")
    first = out.groupBy("index_month", "haul_category", "months_ahead").agg(F.min_by("index_value", F.struct("row", "col")).alias("index_value"))
    return _enough(first, least_values)


def tidy_weights_grid(cells: DataFrame, least_years: int = 3, least_values: int = 6) -> DataFrame:
    """Years across, category labels filled down, windows in a column, to long weights."""
    heads = _headers(cells, parse_year(F.col("value")), least_years)
    down = Window.partitionBy("sheet").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    labels = cells.groupBy("sheet", "row").agg(F.max(parse_category(F.col("value"))).alias("c"), F.max(parse_window(F.col("value"))).alias("months_ahead"))
    labels = labels.withColumn("haul_category", F.last("c", ignorenulls=True).over(down)).drop("c")
    values = cells.join(heads, ["sheet", "col"]).where("row > header_row").join(labels, ["sheet", "row"])
    out = values.select(F.col("head").alias("year"), "haul_category", "months_ahead", parse_number(F.col("value")).alias("weight")).where("haul_category is not null and months_ahead is not null and weight is not null")
    return _enough(out, least_values)


def transposed(cells: DataFrame) -> DataFrame:
    return cells.select("sheet", F.col("col").alias("row"), F.col("row").alias("col"), "value")


def tidy_region_grid(cells: DataFrame, regions: list[str], first_rows: int = 25) -> DataFrame:
    """Months down, regions across, values from 10 to 500; a sheet without such values is tried transposed.

    All of the first rows that name two regions are taken for headers at once; the first that yields values is kept.
    """

    def long(c: DataFrame) -> DataFrame:
        name = F.when(F.lower(F.trim("value")).isin(*regions), F.lower(F.trim("value")))
        heads = _candidates(c.where(F.col("row") < first_rows), name, 2)
        months = c.where("col < 3").select("sheet", "row", parse_month_label(F.col("value")).alias("index_month")).where("index_month is not null").groupBy("sheet", "row").agg(F.max("index_month").alias("index_month"))
        found = c.join(heads, ["sheet", "col"]).where("row > header_row").join(months, ["sheet", "row"]).select("sheet", "header_row", "index_month", F.col("head").alias("location"), parse_number(F.col("value")).alias("index_value")).where("index_value between 10 and 500")
        return found.withColumn("_h", F.min("header_row").over(Window.partitionBy("sheet"))).where("header_row = _h").drop("header_row", "_h")

    straight = long(cells)
    return straight.unionByName(long(transposed(cells)).join(straight.select("sheet").distinct(), "sheet", "left_anti"))


def tidy_region_weights(cells: DataFrame, regions: list[str]) -> DataFrame:
    """Year rows of four regions at least, all weights above zero, that sum to about 1 or 100."""
    name = F.when(F.lower(F.trim("value")).isin(*regions), F.lower(F.trim("value")))
    heads = _headers(cells, name, 4)
    years = cells.where("col < 3").select("sheet", "row", parse_year(F.col("value")).alias("year")).where("year is not null").groupBy("sheet", "row").agg(F.max("year").alias("year"))
    rows = cells.join(heads, ["sheet", "col"]).join(years, ["sheet", "row"]).select("year", F.col("head").alias("region"), parse_number(F.col("value")).alias("weight"))
    good = rows.groupBy("year").agg(F.count("weight").alias("n"), F.min("weight").alias("lo"), F.sum("weight").alias("s")).where("n >= 4 and lo > 0 and (s between 0.9 and 1.1 or s between 90 and 110)").select("year")
    return rows.join(good, "year", "left_semi")


def export_sections(spark: SparkSession, sections: dict[str, tuple], folder: str) -> dict[str, str]:
    """Write each section as JSON with its columns in order: name -> (function that makes it, its schema as text).

    A section that fails is written without rows, in the type that its schema gives, and named with its error; the others go on.
    """
    said = {}
    for name, (make, schema) in sorted(sections.items()):
        empty = spark.createDataFrame([], schema)
        try:
            df = make()
            df.select(*sorted(empty.columns)).write.mode("overwrite").json(f"{folder}/{name}")
            said[name] = "written"
        except Exception as e:  # noqa: BLE001  each section stands alone
            empty.select(*sorted(empty.columns)).write.mode("overwrite").json(f"{folder}/{name}")
            said[name] = f"failed: {type(e).__name__}"
    return said


def read_section(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A section as written, empty ones too."""
    return spark.read.schema(schema).json(f"{folder}/{name}")
