"""Depth as runs of bases, union lengths, valleys and terminal walks, without a row for each base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import running, same


def depth_runs(intervals: DataFrame, *key: str) -> DataFrame:
    """key, start, end, depth of maximal stretches with one depth over 0, from +1 and -1 steps and their running sum.

    Steps are added up by place before anything is sorted, and summed in blocks of places with a carried sum, so a
    chromosome or a hot place is never one task's. Intervals that end before they start count nothing.
    """
    keys = list(key)
    steps = intervals.where(F.col("end") >= F.col("start")).select(*keys, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct((F.col("end") + 1).alias("at"), F.lit(-1).alias("d")))).alias("x"))
    net = steps.groupBy(*keys, F.col("x.at").alias("start")).agg(F.sum("x.d").alias("d")).where("d <> 0")
    deep = running(net, keys, "start", {"depth": (F.col("d"), "sum")})
    ended = running(deep, keys, "start", {"_next": (F.col("start"), "min")}, backward=True, inclusive=False)
    return ended.where("depth > 0").select(*keys, "start", (F.col("_next") - 1).alias("end"), "depth")


def union_length(intervals: DataFrame, *key: str) -> DataFrame:
    """key and bases covered by at least one interval; a key whose intervals cover none has 0."""
    covered = depth_runs(intervals, *key).groupBy(*key).agg(F.sum(F.col("end") - F.col("start") + 1).alias("_n"))
    named = covered.withColumnsRenamed({c: f"k_{c}" for c in key})
    keys = intervals.select(*key).distinct()
    return keys.join(named, same(keys, named, list(key)), "left").select(*key, F.coalesce("_n", F.lit(0)).alias("union_length"))


def reach(intervals: DataFrame, *key: str) -> DataFrame:
    """key, start and reach of each different start: the largest end of the intervals that start there or before."""
    tops = intervals.groupBy(*key, "start").agg(F.max("end").alias("_top"))
    return running(tops, list(key), "start", {"reach": (F.col("_top"), "max")}).drop("_top")


def window_starts(start: Column, end: Column, size: int, step: int) -> Column:
    """Starts of full windows of size, each step bases; empty if none fits."""
    return F.when(end - start + 1 >= size, F.sequence(start, end - size + 1, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def walk_end(runs: DataFrame, key: str, gap: int, limit: int) -> DataFrame:
    """key and how far a walk from place 0 gets over covered runs [a, b] of steps 1, 2, ...: up to the first hole of more than gap steps, at most limit.

    No run within reach: 0.
    """
    clipped = runs.where((F.col("b") >= 1) & (F.col("a") <= limit)).select(key, F.greatest("a", F.lit(1)).alias("a"), F.least("b", F.lit(limit)).alias("b"))
    w = Window.partitionBy(key).orderBy("a", "b")
    before = F.coalesce(F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    holes = clipped.withColumn("_hole", (F.col("a") - before - 1 > gap).cast("int"))
    open_ = holes.withColumn("_holes", F.sum("_hole").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return open_.groupBy(key).agg(F.max(F.when(F.col("_holes") == 0, F.col("b")).otherwise(0)).cast("long").alias("reach"))
