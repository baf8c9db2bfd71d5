"""Reading, labels and small helpers that the operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import pickle
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a label sample.
SAMPLE_ROWS = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it. Where it is unset: one for tests on a local master, else an error."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or "/tmp/checkpoints")
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it from there: a later loss of an executor repeats no work before this."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: What a Python worker keeps from task to task.
_kept: dict = {}


def keep(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a Python worker and kept from task to task, until another key or ``let_go`` takes its place."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Frees what an earlier stage's tasks have kept in this Python worker, so that the stages' stores never stand side by side."""
    if _kept:
        _kept.clear()
        gc.collect()
    give_back()


def give_back() -> None:
    """Returns to the system what this process has freed: Arrow's pool keeps it, and so does the C heap, where small arrays and strings lie scattered."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None  # of the GNU C library alone
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function, after whose last batch the Python worker, which outlives the task, gives back what is free."""

    @functools.wraps(run)
    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def each(column: pa.Array) -> Iterator:
    """A column's values one by one, so that a batch of texts isn't held twice."""
    return (x.as_py() for x in column)


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's text mod 3 is 1. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def label_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """_id, _text, _y of at most ``rows`` labelled documents that aren't held out, half of them of either label where there are as many.

    Labels are sampled by a hash of the id before they meet the texts, so the join broadcasts at most ``rows`` rows
    and reads documents once without a shuffle. Ids with both labels count as 1. Null ids and null labels are left out.
    """
    usable = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id"))
    each = usable.groupBy("_id").agg(F.max("_y").alias("_y"))
    order = F.xxhash64("_id")
    some = each.where("_y = 1").orderBy(order, "_id").limit(rows // 2).unionAll(each.where("_y = 0").orderBy(order, "_id").limit(rows // 2))
    return docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text")).where(F.col("_text").isNotNull()).join(F.broadcast(some), "_id").select("_id", "_text", "_y")


def trained(sample: DataFrame, train: Callable[[list[tuple[str, int]]], object]) -> object:
    """The model that ``train`` makes of the sample's (text, label), in one task: the sample is bounded, and the driver gets the model alone.

    Rows are ordered by a hash of id and text, repeated ones dropped, so the model doesn't depend on partitioning.
    """

    @tidy
    def run(batches):
        let_go()
        rows = {(i, t): y for b in batches for i, t, y in zip(*(b.column(c).to_pylist() for c in ("_id", "_text", "_y")))}
        ordered = sorted(rows.items(), key=lambda x: (zlib.crc32(str(x[0][0]).encode()), x[0][1]))
        model = pickle.dumps(train([(t, y) for (_, t), y in ordered]))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else train([])


def ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """df with _rank, a row's place from 0 within its group by ``order`` (nulls first), and _total, the rows of its group.

    Rows are sorted over ranges of (group, order), so a group of any size is dealt over many tasks; a row's place within
    its range is counted there, and a range's first place comes from one row for each range and group. The sorted rows
    are cut in the shared folder first: places hold when executors are lost. Group columns must not be null. Rows that
    tie in all of ``order`` get places in no fixed order.
    """
    by = [F.col(c) for c in (*group, *order)]
    placed = cut(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    skip = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*group, "_part", (skip - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("_total"))
    return placed.join(runs, [*group, "_part"]).withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store through Spark's file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
