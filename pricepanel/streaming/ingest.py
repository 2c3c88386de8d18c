"""Incremental ingest: new run files to the panel, each exactly once, bad rows to a reject path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricepanel.sources.panels import CLUSTER


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


#: Where compacted files wait under a panel (a name that readers pass over), and the mark that all of them are there.
_STAGED, _READY = "_compacted", "_ready"


def _numbered(files, folder, prefix: str) -> dict:
    """Folders ``prefix=value`` under one, by value."""
    return {f.getPath().getName().split("=", 1)[1]: f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith(f"{prefix}=")} if files.exists(folder) else {}


def settle_compaction(spark: SparkSession, panel: str) -> int:
    """Put staged files in the place of the ones they replace; the number of dates so moved.

    Files that were not all written are thrown away. Each date is deleted, then moved: a driver that stops in between leaves
    the date staged, and the next call does the rest. Dates already moved are staged no more.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(panel)
    files, staged, moved = root.getFileSystem(spark._jsc.hadoopConfiguration()), path(root, _STAGED), 0
    if not files.exists(staged):
        return 0
    if files.exists(path(staged, _READY)):
        for target, folder in _numbered(files, staged, "batch").items():
            old = {n: b for n, b in _numbered(files, root, "batch").items() if int(n) <= int(target)}
            place = path(root, folder.getName())
            files.mkdirs(place)
            for date in _numbered(files, folder, "scrape_date").values():
                for batch in old.values():
                    files.delete(path(batch, date.getName()), True)
                if not files.rename(date, path(place, date.getName())):
                    raise OSError(f"cannot move {date} into {place}")
                moved += 1
            for n, batch in old.items():
                if n != target and not _numbered(files, batch, "scrape_date"):
                    files.delete(batch, True)
    files.delete(staged, True)
    return moved


def compact_batches(spark: SparkSession, panel: str, schema: T.StructType) -> int:
    """Rewrite the months that lie in several settled batches as one batch, the greatest of these; the number of dates rewritten.

    The newest batch may be tried again by the stream and stays as it is, so that it still replaces its own files only. Rows
    are kept as often as they are there, in files by ranges of date and cluster columns. Readers of the panel need no change;
    while dates are moved they may miss some, never see one twice, so run this while no ingest or reader runs.
    """
    settle_compaction(spark, panel)
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(panel)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    settled = sorted(int(n) for n in _numbered(files, root, "batch"))[:-1]
    if len(settled) < 2:
        return 0
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(panel).where(F.col("batch") <= settled[-1])
    month = F.trunc("scrape_date", "month")
    # Partition columns alone; the driver gets the months of a calendar.
    several = [r["m"] for r in rows.groupBy(month.alias("m")).agg(F.min("batch").alias("a"), F.max("batch").alias("z")).where("a < z and m is not null").collect()]
    if not several:
        return 0
    order = ["scrape_date", *(c for c in CLUSTER if c in schema.names)]
    one = rows.where(month.isin(several)).withColumn("batch", F.lit(settled[-1])).repartitionByRange(*order).sortWithinPartitions(*order)
    one.write.mode("overwrite").partitionBy("batch", "scrape_date").parquet(f"{panel}/{_STAGED}")
    files.create(path(path(root, _STAGED), _READY)).close()
    return settle_compaction(spark, panel)


def undelivered(batch: DataFrame, held: DataFrame | None, columns: list[str], run: list[str]) -> DataFrame:
    """Rows of a batch (``columns`` and _file) that neither another file of it nor ``held`` brings.

    A row stays as often as one file has it, less the times it is held. What is held is read for the runs of the batch alone,
    and all of it is counting by the whole row: no run is dropped as known, so files that complete a run add what is new.
    """
    each = batch.groupBy(*columns, "_file").agg(F.count("*").alias("_n")).groupBy(*columns).agg(F.max("_n").alias("_n"))
    if held is not None:
        # Dates prune the partitions that are read; then the runs are compared.
        known = held.join(batch.select(*run).distinct(), run, "left_semi").groupBy(*columns).agg((-F.count("*")).alias("_n"))
        each = each.unionByName(known).groupBy(*columns).agg(F.sum("_n").alias("_n"))
    return each.where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*columns)


def ingest_stream(spark: SparkSession, source: str, panel: str, rejects: str, checkpoint: str, schema: T.StructType, required: tuple[str, ...] = ("scrape_date", "run_id", "status")) -> StreamingQuery:
    """Read what is new under ``source`` (newline-delimited JSON) and append it; ends when all is read.

    A row that is no JSON of the schema, or lacks a required column, goes to ``rejects`` as text. A batch is written under its
    number, so one that is tried again replaces its own files only. A run that is delivered again under another file name, in
    the same batch or a later one, adds no row that it brought before. A compaction that was cut short is finished first.
    """
    settle_compaction(spark, panel)
    shape = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = spark.readStream.option("columnNameOfCorruptRecord", "_bad").schema(shape).json(source).select("*", F.col("_metadata.file_path").alias("_file"))

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        whole = F.col("_bad").isNull()
        for c in required:
            whole = whole & F.col(c).isNotNull()
        held = batch.sparkSession.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(panel).where(F.col("batch") != number) if _exists(spark, panel) else None
        new = undelivered(batch.where(whole), held, schema.names, ["scrape_date", "run_id"])
        new.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "scrape_date").parquet(panel)
        batch.where(~whole).select(F.coalesce("_bad", F.to_json(F.struct(*schema.names))).alias("value"), F.lit(number).alias("batch")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").text(rejects)
        batch.unpersist()

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
