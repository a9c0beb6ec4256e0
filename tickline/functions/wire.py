"""Rules for single wire values, as Column expressions: times, fixed-point numbers, quantities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickline.functions.fixed import NULL_I32, NULL_I64, NULL_TIME


def time_ns(raw: Column) -> Column:
    """Nanoseconds from midnight of a time hhmmssmmm; null if it is none."""
    h, m, s, ms = (F.floor(raw / 10_000_000), F.floor(raw / 100_000) % 100, F.floor(raw / 1000) % 100, raw % 1000)
    good = (raw != NULL_TIME) & (h < 24) & (m < 60) & (s < 60)
    return F.when(good, (((h * 60 + m) * 60 + s) * 1000 + ms) * 1_000_000).cast("bigint")


def time_flags(raw: Column, null_source: int, bad_time: int) -> Column:
    return F.when(raw == NULL_TIME, null_source | bad_time).when(time_ns(raw).isNull(), bad_time).otherwise(0).cast("bigint")


def p6(raw: Column, scale: int) -> Column:
    """raw x 10^(6 - scale); null where that leaves 64 bits."""
    return F.try_multiply(raw.cast("bigint"), F.lit(10 ** (6 - scale)).cast("bigint"))


def null_of(bits: int) -> int:
    return NULL_I32 if bits == 32 else NULL_I64


def decimal(raw: Column, scale: int, bits: int, normal: Column) -> Column:
    """Fixed decimal struct; p6 is there where the value is, `normal` holds and it fits."""
    valid = raw != null_of(bits)
    value = F.when(valid & normal, p6(raw, scale))
    return F.struct(raw.cast("bigint").alias("raw"), F.coalesce(value, F.lit(0).cast("bigint")).alias("p6"), F.lit(scale).cast("tinyint").alias("source_scale"), valid.alias("raw_valid"), value.isNotNull().alias("p6_valid"))


def overflows(raw: Column, scale: int, bits: int, normal: Column) -> Column:
    return F.coalesce((raw != null_of(bits)) & normal & p6(raw, scale).isNull(), F.lit(False))


def quantity(raw: Column, scale: int, nullable: bool, published: Column | None = None) -> Column:
    good = raw >= 0
    if published is not None:
        good = good & published
    return F.struct(raw.alias("raw"), F.lit(scale).cast("tinyint").alias("scale"), good.alias("valid"))
