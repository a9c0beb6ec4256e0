"""Arrivals, frames and catalogs derived from the relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHANNELS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_arrivals(spark: SparkSession, sf_dir: str, *, drop: bool = True, alter: bool = False) -> DataFrame:
    """Records out of the events table, out of order, with repeats and, if `drop`, holes.

    A channel is event_id mod 8, arrival the order of event_id, and the native
    sequence an order that lags by the user. Every 97th event is lost, every
    101st arrives again 400 arrivals later, or 40 if none are lost; if `alter`, every 303rd then has
    another payload.
    """
    events = table(spark, sf_dir, "events")
    order = Window.partitionBy("channel").orderBy(F.col("event_id") + 8 * (F.col("user_id") % 16), "event_id")
    x = events.select((F.col("event_id") % CHANNELS).alias("channel"), "event_id", "user_id", F.floor(F.col("value") * 100).cast("bigint").alias("cents"))
    x = x.withColumn("native_sequence", F.row_number().over(order).cast("bigint"))
    if drop:
        x = x.where("event_id % 97 != 0")
    again = x.where("event_id % 101 = 0")
    changed = F.when(F.col("event_id") % 303 == 0, F.col("cents") + 1).otherwise(F.col("cents")) if alter else F.col("cents")
    both = x.select("*", F.col("event_id").alias("arrival"), F.lit(0).alias("copy")).unionByName(again.withColumn("cents", changed).select("*", (F.col("event_id") + (400 if drop else 40)).alias("arrival"), F.lit(1).alias("copy")))
    ingress = F.col("arrival") * 2 + F.col("copy")
    return both.select(F.lit("SH").alias("market"), "channel", ingress.alias("ingress_sequence"), (ingress * 1000).alias("receive_monotonic_ns"), "native_sequence", F.col("cents").cast("string").alias("payload"), (F.col("user_id") % 5 != 0).alias("catalog_match"))


def supplier_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog definitions out of the suppliers: odd keys in Shanghai, even ones in Shenzhen."""
    key = F.col("s_suppkey")
    order = Window.orderBy("s_suppkey")
    sh = key % 2 == 1
    return table(spark, sf_dir, "supplier").select((F.row_number().over(order) - 1).cast("bigint").alias("ordinal"), key.alias("instrument_id"), F.when(sh, "SH").otherwise("SZ").alias("market"), F.when(sh, "").otherwise("102").alias("security_id_source"), security(key).alias("security_id"))


def security(key: Column) -> Column:
    return F.concat(F.lit("S"), key.cast("string"))
