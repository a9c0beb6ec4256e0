"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target of words. Its documents lie one after another, in the
order of a hash of their ids, on an axis of the source's size; the mix takes the
first `target` words of that axis, walked round again where the target exceeds
the size. A word's place on the walk is its source's cumulative demand; the
source's weight schedule, integrated over training time and inverted, turns that
demand into a training position. Documents come back range-sorted by position.

All of it is DataFrame expressions. Running sums are kept in two levels, within
and across hash buckets, so a source with most of the documents is no single
group; only sums per source, and per source and bucket, meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickline.llm.repeats import partitions
from tickline.llm.shared import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Weights that sources get in the order of their names, and again from the first.
WEIGHTS = (1, 2, 3)
#: Times that a source's words may be repeated.
MOST_REPEATS = 3
#: A weight schedule is a list of knots (training time, relative weight), linear between them.
Schedule = Sequence[tuple[float, float]]
#: Dealt out like the weights: steady, early and late sources.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)))
#: Leading hex digits of the hash that make a bucket.
BUCKET_DIGITS = 3


def training_time(share: Column, schedule: Schedule) -> Column:
    """Time at which a source with this schedule has had the given share of its demand."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:], strict=False)]
    whole, below = sum(areas), 0.0
    demand = share * F.lit(whole)
    out = F.lit(float(schedule[-1][0]))
    pieces = []
    for (t0, w0), (t1, w1), area in zip(schedule, schedule[1:], areas, strict=False):
        rest = demand - F.lit(below)
        slope = (w1 - w0) / (t1 - t0)
        root = F.lit(w0) + F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        pieces.append((demand < F.lit(below + area), F.lit(t0) + F.when(root > 0, 2 * rest / root).otherwise(0.0)))
        below += area
    for test, value in reversed(pieces):
        out = F.when(test, value).otherwise(out)
    return out


def targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """source, source_size, rank and target from source, source_size.

    Weights share the sum of sizes; a target stops at `most` times its source's
    size, and the excess is shared again until no target is above.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(1))
    ranked = sizes.withColumn("rank", F.row_number().over(every) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    x = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * most, "total": F.sum("source_size").over(whole)})
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    x = x.withColumn("full", F.col("cap") / F.col("weight") <= level)
    free = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(rest / free * F.col("weight"))
    return x.select("source", "source_size", "rank", target.alias("target"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """The mix of all rows of `docs`, one row for each of them, in order of training position.

    Returns the id, source, size (words; 0 for a null text), source_size,
    target, taken (words that the mix takes of it, repeats counted; only the
    last document of a source's walk is taken in part), position (training time
    of the first copy; null if none is taken) and copies (training times of all
    copies). Null sources are one source, the last. Rows with equal ids stand
    together; equal rows are interchangeable. A mix of no words takes nothing.
    Other columns of `docs` are not read.
    """
    mark = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), mark.alias("mark")).withColumn("bucket", F.substring("mark", 1, BUCKET_DIGITS)))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    starts = starts.alias("s").join(goals.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select("s.source", "s.bucket", "start", "source_size", "rank", "target")
    within = Window.partitionBy("source", "bucket").orderBy("mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0)))
    x = placed.alias("p").join(starts.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.bucket") == F.col("s.bucket"))).select("id", "p.source", "size", (F.col("at") + F.col("start")).alias("at"), "source_size", "rank", "target")
    wanted = F.round("target").cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0).cast("bigint")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("wanted") - F.col("rounds") * F.col("source_size") - F.col("at")))
    x = x.withColumns({"wanted": wanted, "rounds": rounds}).withColumn("part", part)
    x = x.withColumns({"taken": F.col("rounds") * F.col("size") + F.col("part"), "n": F.when(F.col("size") > 0, F.col("rounds") + F.when(F.col("part") > 0, 1).otherwise(0)).otherwise(0).cast("int")})

    def time_of(copy: Column) -> Column:
        share = (F.col("at") + copy * F.col("source_size")).cast("double") / F.col("wanted")
        out = training_time(share, schedules[-1])
        for i, s in reversed(list(enumerate(schedules[:-1]))):
            out = F.when(F.col("rank") % len(schedules) == i, training_time(share, s)).otherwise(out)
        return out

    copies = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), F.col("n") - 1), time_of)).otherwise(F.array().cast("array<double>"))
    x = x.withColumn("copies", copies).withColumn("position", F.when(F.col("n") > 0, F.element_at("copies", 1)))
    out = x.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken", "position", "copies")
    return out.repartitionByRange(partitions(docs.sparkSession), F.col("position").asc_nulls_last(), F.col(id_col)).sortWithinPartitions(F.col("position").asc_nulls_last(), id_col)
