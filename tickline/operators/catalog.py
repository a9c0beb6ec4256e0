"""The instrument catalog: validation, and the match of records with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.functions.fixed import MAX_TEXT_BYTES, QUALITY

KEYS = ["market", "security_id_source", "security_id"]
#: Instruments up to which the catalog is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
_PRINTABLE = f"^[ -~]{{1,{MAX_TEXT_BYTES}}}$"


def problems(definitions: DataFrame) -> DataFrame:
    """(problem, instruments) for each rule that definitions break; no rows for a valid catalog.

    definitions: ordinal, instrument_id, market, security_id_source, security_id.
    """
    bad = {
        "instrument_id must be positive": F.col("instrument_id").isNull() | (F.col("instrument_id") <= 0) | (F.col("instrument_id") >= 1 << 32),
        "market must be SH or SZ": ~F.coalesce(F.col("market"), F.lit("")).isin("SH", "SZ"),
        "security_id must be 1 to 32 printable bytes": ~F.coalesce(F.col("security_id"), F.lit("")).rlike(_PRINTABLE),
        "security_id_source must be empty for SH": (F.col("market") == "SH") & (F.col("security_id_source") != ""),
        "security_id_source must be 1 to 32 printable bytes for SZ": (F.col("market") == "SZ") & ~F.coalesce(F.col("security_id_source"), F.lit("")).rlike(_PRINTABLE),
    }
    rows = definitions.select(F.explode(F.array_compact(F.array(*(F.when(c, name) for name, c in bad.items())))).alias("problem")).groupBy("problem").agg(F.count("*").alias("instruments"))
    twice = lambda keys, name: definitions.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").agg(F.lit(name).alias("problem"), F.sum("n").alias("instruments")).where("instruments is not null")
    return rows.unionByName(twice(["instrument_id"], "instrument_id must be unique")).unionByName(twice(KEYS, "identity must be unique"))


def build_catalog(definitions: DataFrame) -> DataFrame:
    """The definitions, if they make a valid catalog; ValueError with the problems otherwise."""
    found = [f"{r['problem']} ({r['instruments']})" for r in problems(definitions).orderBy("problem").collect()]
    if definitions.isEmpty():
        found.append("the catalog is empty")
    if found:
        raise ValueError("; ".join(found))
    return definitions.select("instrument_id", F.col("ordinal").cast("bigint").alias("instrument_ordinal"), *KEYS)


def match(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds instrument_id, instrument_ordinal and catalog_match. Records without an instrument stay, flagged in `quality` if there is one."""
    small = catalog.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    out = records.join(F.broadcast(catalog) if small else catalog, KEYS, "left").withColumn("catalog_match", F.col("instrument_id").isNotNull())
    if "quality" in records.columns:
        out = out.withColumn("quality", F.col("quality").bitwiseOR(F.when(F.col("catalog_match"), 0).otherwise(QUALITY["not_in_catalog"]).cast("bigint")))
    return out


def matched_snapshots(snapshots: DataFrame, catalog: DataFrame) -> DataFrame:
    """Decoded snapshots whose instrument the catalog has; the others are only counted (see `stats`)."""
    return match(snapshots.where("decode_error is null"), catalog).where("catalog_match")
