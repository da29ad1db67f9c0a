"""Index universes, membership logs and change tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from posledger.functions.dates import month_day_year
from posledger.schemas import MEMBERSHIP_SCHEMA, RECONSTITUTION_SCHEMA, conform


def read_universe_csv(spark: SparkSession, path: str, index_name: str, ticker_column: str = "Ticker",
                      header: bool = True) -> DataFrame:
    """Tickers of one index from CSV: no blanks or dashes, share classes with a dash."""
    raw = spark.read.option("header", header).csv(path)
    ticker = F.trim(F.col(ticker_column))
    return raw.where(ticker.isNotNull() & ~ticker.isin("", "-")).select(
        F.translate(ticker, ".", "-").alias("ticker"), F.lit(index_name).alias("index_name"))


def append_snapshot(members: DataFrame, day=None) -> DataFrame:
    """Membership list stamped with its day, ready to append to the snapshot log."""
    date = F.current_date() if day is None else F.lit(day).cast("date")
    return conform(members.withColumn("snapshot_date", date), MEMBERSHIP_SCHEMA)


def membership_sides(wide: DataFrame) -> DataFrame:
    """Unpivot a change table with one added and one removed side per row."""
    keep = [c for c in wide.columns if c not in (
        "date", "added_ticker", "added_security", "removed_ticker", "removed_security")]
    sides = F.inline(F.array(
        F.struct(F.lit("added").alias("side"), F.col("added_ticker").alias("ticker"),
                 F.col("added_security").alias("company")),
        F.struct(F.lit("removed").alias("side"), F.col("removed_ticker").alias("ticker"),
                 F.col("removed_security").alias("company"))))
    rows = wide.select(month_day_year("date").alias("reconstitution_date"), *keep, sides)
    text = F.trim("ticker")
    return rows.where(text.isNotNull() & (text != "") & F.col("reconstitution_date").isNotNull()).withColumn(
        "ticker", text)


def membership_changes(wide: DataFrame, other: DataFrame, side: str, wide_index: str = "sp600",
                       other_index: str = "russell2000") -> DataFrame:
    """One side (``added`` or ``removed``) of two index sources in one frame."""
    mine = membership_sides(wide).where(F.col("side") == side).withColumn("source_index", F.lit(wide_index))
    rest = other.withColumn("source_index", F.lit(other_index))
    return conform(rest, RECONSTITUTION_SCHEMA).unionByName(conform(mine, RECONSTITUTION_SCHEMA))
