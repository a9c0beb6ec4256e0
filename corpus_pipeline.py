"""The corpus pipeline: quality, near duplicates, repeated passages, test items, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it
as Parquet and hands it to the next one. All but the last return the columns of
documents. Near duplicates are texts whose sets of five-word shingles have a
Jaccard similarity of 0.8 or more.

What an operator decides holds for the rows with that id and that text: a hash of
both is the key by which it comes back. So rows without an id are judged like all
others, and rows with one id and different texts each for itself.

Extra columns of documents, whatever their names, travel along in one struct and
come out of each stage as they went in. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickline.llm.decontaminate import find_leaks
from tickline.llm.jaccard_join import jaccard_components
from tickline.llm.mixing import mix_sources
from tickline.llm.quality import score_quality
from tickline.llm.shared import cut, new_folder
from tickline.llm.substring_dedup import dedup_substrings


KEY = "row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """Key, id, text, and the whole row apart from them, so that no column of docs can clash."""
    return docs.select(F.xxhash64("doc_id", "text").alias(KEY), "doc_id", "text", F.struct("*").alias("row"))


def _without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """docs without the rows whose key was `decided`."""
    return _keyed(docs).join(decided.select(KEY).distinct().hint("shuffle_hash"), KEY, "left_anti").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rule ensemble predicts to be of low quality, with an id or without."""
    scored = score_quality(_keyed(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"), key_col=KEY)
    return _without(docs, scored.where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of near duplicates: the one with the smallest id.

    Rows without an id come last, rows with one id in the order of their keys, and
    of equal rows one is kept. Rows without words have no duplicates and all stay.
    """
    linked = jaccard_components(_keyed(docs), id_col=KEY, size=5, percent=80)
    members = linked.groupBy(KEY, "component_id").agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n"))
    ids = _keyed(docs).groupBy(KEY).agg(F.first("doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", KEY, ((F.col("copies") > 1) & (F.col("n") > 0)).alias("repeated")))
    kept = cut(members.join(ids, KEY).groupBy("component_id").agg(first.alias("first")).select(f"first.{KEY}", "first.repeated"))
    rows = _keyed(docs).join(kept.hint("shuffle_hash"), KEY)
    if not kept.where("repeated").isEmpty():
        rows = rows.withColumn("turn", F.row_number().over(Window.partitionBy(KEY).orderBy("row"))).where("not repeated or turn = 1")
    return rows.select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of passages of 35 words that start anywhere else; a document keeps its row, with an id or without."""
    changed = dedup_substrings(_keyed(docs), id_col=KEY, window=35).where("n_removed > 0").select(KEY, F.coalesce("kept_text", F.lit("")).alias("kept"))
    joined = _keyed(docs).join(changed.dropDuplicates([KEY]).hint("shuffle_hash"), KEY, "left")
    left = {"text": F.coalesce("kept", "text"), "n_chars": F.coalesce(F.length("kept").cast("bigint"), "row.n_chars")}
    return joined.select(*(left.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a copy of a test item, with an id or without."""
    return _without(docs, find_leaks(_keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=KEY))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, with its first training position."""
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "position")


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages), ("benchmark decontamination", decontamination), ("mixing sources", mixing)]

#: SQL cannot express the fitted classifier; the other stages are tested against brute force, and the classifier by its statistics and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
