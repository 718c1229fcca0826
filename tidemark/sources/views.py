"""Market views over the star-schema tables: weekly bars of suppliers, a grid of weeks, typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(security_id, date, open, high, low, close, volume, vwap, n_bars) by supplier and week; one shuffle, combined map-side."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    tick = F.struct("l_shipdate", "l_orderkey", "l_linenumber", price.alias("p"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("security_id"), F.date_trunc("week", "l_shipdate").cast("date").alias("date"))
        .agg(
            F.min(tick)["p"].alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max(tick)["p"].alias("close"),
            F.sum("l_quantity").alias("volume"), (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.sum("l_quantity")).alias("vwap"), F.count("*").alias("n_bars"),
        )
    )


def on_grid(df: DataFrame, step_days: int = 7) -> DataFrame:
    """df on every date between a security's first and last one; dates without a row have nulls.

    Each row is followed by the dates before the next one: one pass, no join, and the exchange by
    security is the one that windows over it need. Rows are one for each security and date.
    """
    after = F.lead("date").over(Window.partitionBy("security_id").orderBy("date"))
    until = F.coalesce(F.date_sub("_next", step_days), F.col("date"))
    days = df.withColumn("_next", after).withColumn("_day", F.explode(F.sequence("date", until, F.expr(f"interval {step_days} days"))))
    own = F.col("_day") == F.col("date")
    return days.select("security_id", F.col("_day").alias("date"), *[F.when(own, F.col(c)).alias(c) for c in df.columns if c not in ("security_id", "date")])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the JSON of props parsed."""
    return table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k long")["k"])
