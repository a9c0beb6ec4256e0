"""The catalog file: a CSV whose lines are taken as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators.catalog import build_catalog

# Fixed value: the header line.
HEADER = "instrument_id,market,security_id_source,security_id"


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Definitions of the file with their 0-based order; ValueError for a line that is none.

    Fields are not quoted and not trimmed; a carriage return at the end of a
    line is dropped; a blank line is an error. Catalogs are small files, read
    whole, so that the order of lines is certain.
    """
    text = F.col("value")
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split(F.regexp_replace(text, "\r?\n$", ""), "\n")).alias("line", "raw")).select("line", F.regexp_replace("raw", "\r$", "").alias("raw"))
    fields = lines.select("line", "raw", F.split("raw", ",", -1).alias("f"))
    number = F.expr("try_cast(f[0] as bigint)")
    good = F.when(F.col("line") == 0, F.col("raw") == HEADER).otherwise((F.size("f") == 4) & F.col("f")[0].rlike("^[0-9]+$") & number.isNotNull())
    bad = fields.where(~F.coalesce(good, F.lit(False))).orderBy("line").first()
    if bad is not None:
        raise ValueError(f"line {bad['line'] + 1} of {path} is not as it should be: {bad['raw']!r}")
    return fields.where("line > 0").select((F.col("line") - 1).alias("ordinal"), number.alias("instrument_id"), F.col("f")[1].alias("market"), F.col("f")[2].alias("security_id_source"), F.col("f")[3].alias("security_id"))


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    return build_catalog(read_definitions(spark, path))
