"""Month bitmaps: in which months an item was there, as words of bits that merge by OR."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Months of a word. Bit 0 repeats the last month of the word before, so pairs of months never reach over two words.
WORD = 60


def month_of_number(number: Column | str) -> Column:
    """The first day of a month counted from the year 0."""
    number = F.col(number) if isinstance(number, str) else number
    return F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)).cast("int") + 1, F.lit(1))


def first_number(word: str, own: Column) -> Column:
    """Number of the first month in a word's own bits (not none): the ones below its lowest bit."""
    return F.col(word) * WORD + F.bit_count(own.bitwiseAND(-own) - 1)


def last_number(word: str, own: Column) -> Column:
    """Number of the last month in a word's own bits (not none): the places of its binary form."""
    return F.col(word) * WORD + F.length(F.bin(own)) - 1


def item_months(rows: DataFrame, keys: list[str], month: str = "month") -> DataFrame:
    """Per key and word of 60 months the bits of the months with a row, and the rows of these months.

    One aggregation with partial sums: what is shuffled has a row per key and word, not per key and month. A row in the last
    month of a word sets bit 0 of the next word too, where it counts no rows. Rows without a month keep their key under
    a null word without bits.
    """
    number = F.year(month) * 12 + F.month(month) - 1
    at = rows.select(*keys, number.alias("_m"))
    bit = F.pmod("_m", F.lit(WORD))
    word = F.floor(F.col("_m") / WORD).cast("int")
    own = F.struct(word.alias("word"), F.coalesce(F.expr(f"shiftleft(1L, cast(pmod(_m, {WORD}) as int) + 1)"), F.lit(0).cast("long")).alias("bits"), F.lit(1).alias("n"))
    carried = F.struct((word + 1).alias("word"), F.lit(1).cast("long").alias("bits"), F.lit(0).alias("n"))
    places = F.when(bit == WORD - 1, F.array(own, carried)).otherwise(F.array(own))
    each = at.select(*keys, F.explode(places).alias("_p"))
    return each.groupBy(*keys, F.col("_p.word").alias("word")).agg(F.bit_or("_p.bits").alias("bits"), F.sum("_p.n").alias("n_rows"))


def merge_months(keys: list[str], *tables: DataFrame) -> DataFrame:
    """Bitmaps of several vintages as one: bits by OR, rows added. The order and grouping of merges make no difference."""
    rows = reduce(DataFrame.unionByName, tables)
    return rows.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"), F.sum("n_rows").alias("n_rows"))
