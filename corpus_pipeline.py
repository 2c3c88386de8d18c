"""A corpus, stage by stage: each stage's rows are written as Parquet and read again as the next one's documents.

Every stage takes nulls in any column, repeated ids and rows, empty and very long texts, and tables without rows; all
but the last return the columns of ``documents`` and no others. This module is a part of the corpus operators and
needs ``pricepanel.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.llm import decontaminate, ngram_join, packing, substring_dedup, toxicity
from pricepanel.llm.common import discard, place_of, scratch, stored, table, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most toxic passage scores below 0.5; null, empty and wordless texts stay, repeated rows are judged alike.

    Without labels, or with labels of class 0 only, all rows stay.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity(docs, model, keep=COLUMNS)
    return scored.where("score < 0.5").select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with _row, a key of each row in the order of doc_id: the id itself where ids are unique, else a number.

    Rows without an id come last; rows of one id follow each other in the order of the hash of their columns.
    """
    n, ids = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if n == ids:
        return docs.withColumn("_row", F.col("doc_id").cast("long"))
    ranked = docs.withColumns({"_hash": F.xxhash64(*COLUMNS), "_spread": F.monotonically_increasing_id()})
    ranked = ranked.orderBy(F.col("doc_id").asc_nulls_last(), "_hash", "_spread").drop("_hash", "_spread")
    return stored(ranked.withColumn("_row", F.monotonically_increasing_id()), "rows")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: that of the least id, a row without an id only where no row has one.

    Rows are judged one by one, whether they share an id or have none. Rows without words link with nothing and stay.
    """
    rows = keyed(docs)
    first = ngram_join.jaccard_components(rows, id_col="_row").where("component_id = _row").select("_row")
    return rows.join(first, "_row", "left_semi").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that start earlier; a text that loses none stays as it is, white space included.

    Earlier is by row: of rows that share an id one comes before the other, and rows without an id come last.
    """
    out = substring_dedup.substring_dedup(keyed(docs), id_col="_row", keep=COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark: rows are judged by their own text, whether they share an id or have none.

    Null and empty texts stay; without benchmark items all rows stay.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens; a row without text is its end id alone, and rows that share an id are packed each."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_leaks),
    ("packing", packed),
]

#: No SQL: the first stage is a trained model and the last encodes with a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    written = None
    for name, stage in STAGES:
        with scratch(spark) as keep:  # what the stage's operators stored goes when its rows are written
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
            keep.add(place_of(docs))
        if written is not None:
            discard(written)
        written = docs
    return docs
