"""The ordered gates with their audit trail, differential status and Benjamini-Hochberg."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .harvest import global_rank


def cascade(df: DataFrame, gates: list[tuple]) -> DataFrame:
    """df with gates_passed (names up to the first failure) and failed_gate; a null verdict fails.

    A gate is (name, verdict) or (name, verdict, shown), where ``shown`` tells whether a pass goes into the trail.
    """
    passed, open_, failed = [], F.lit(True), F.lit(None).cast("string")
    for name, ok, *shown in gates:
        # a branch, so that a verdict that raises isn't asked once an earlier gate has failed
        here = F.when(open_, F.coalesce(ok, F.lit(False))).otherwise(False)
        passed.append(F.when(here & shown[0] if shown else here, F.lit(name)))
        failed = F.when(open_ & ~here, name).otherwise(failed)
        open_ = here
    return df.withColumns({"gates_passed": F.array_join(F.array_compact(F.array(*passed)), ","), "failed_gate": failed})


def de_status(lfc: Column, pvalue: Column, padj: Column, cut: float = 0.05, least: float = 0.5) -> Column:
    up = F.coalesce(lfc >= least, F.lit(False))
    return F.when(up & (padj < cut), "wald").when(up & padj.isNull() & pvalue.isNotNull(), "low_count").otherwise("")


def benjamini_hochberg(df: DataFrame, key: str, p: str = "pvalue") -> DataFrame:
    """df with bh, the adjusted p of each row (null where p is), from a global rank over sorted ranges.

    The running minimum from the largest p down is the minimum of what later ranges hold and a window within blocks of ranks.
    """
    known = global_rank(df.where(F.col(p).isNotNull()).select(key, p), [F.col(p), F.col(key)], "_rank")
    n = known.count()
    raw = known.select(key, (F.col(p) * n / F.col("_rank")).alias("_raw"), "_rank", F.floor(F.col("_rank") / F.lit(4096)).alias("_block"))
    from pyspark.sql import Window

    within = Window.partitionBy("_block").orderBy(F.col("_rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    later = raw.groupBy("_block").agg(F.min("_raw").alias("_m")).withColumn("_later", F.min("_m").over(Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1))).drop("_m")
    out = raw.withColumn("_here", F.min("_raw").over(within)).join(F.broadcast(later), "_block")
    return df.join(out.select(key, F.least(F.lit(1.0), "_here", "_later").alias("bh")), key, "left")
