"""Synthetic arrivals: ordered, or reversed within blocks, over several channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.functions.fixed import SH_TICK
from tickline.sources.encode import frames, sh_tick_body


def arrivals(spark: SparkSession, count: int, channels: int, window: int = 1) -> DataFrame:
    """ingress_sequence (from 1), channel (from 1) and native_sequence.

    Blocks of `window` consecutive arrivals belong to one channel, and come in
    reverse order; a window of 1 is the ordered load. count should be a multiple
    of channels x window.
    """
    n = F.col("id")
    block = F.expr(f"id div {window}")
    return spark.range(count).select(
        (n + 1).alias("ingress_sequence"), (block % channels + 1).alias("channel"), (F.expr(f"(id div {window}) div {channels}") * window + window - n % window).alias("native_sequence")
    )


def load(spark: SparkSession, count: int, channels: int = 16, window: int = 1, instruments: int = 16, step_ns: int = 1000) -> DataFrame:
    """Frames of Shanghai trades in the order of `arrivals`, one every step_ns."""
    x = arrivals(spark, count, channels, window)
    security = F.concat(F.lit("6000"), F.lpad((F.col("channel") % instruments).cast("string"), 2, "0"))
    content = sh_tick_body(
        sequence=F.col("native_sequence"), channel=F.col("channel"), security=security, type_=F.lit("T"), mark=F.lit("B"), price=F.lit(12345), quantity=F.lit(100), money=F.lit(1234500), buy=F.lit(101), sell=F.lit(202), time=F.lit(93_000_123)
    )
    return frames(x, SH_TICK, content, ingress=F.col("ingress_sequence"), receive_ns=F.col("ingress_sequence") * step_ns)
