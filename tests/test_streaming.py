from collections import Counter

import pytest
from pyspark.sql import functions as F

from spliceframe.operators import harvest
from spliceframe.plans.bridge import view
from spliceframe.streaming.census import stream_junctions

SF = "/root/testdata/sf0.001"
BASE = 1_700_000_000
COLUMNS = ["sample_id", "grp", "chrom", "strand", "start", "end"]


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(str(folder))


def at(df, seconds):
    return df.withColumn("at", F.timestamp_seconds(F.lit(BASE + seconds)))


def streamed(spark, folder, out, state):
    schema = spark.read.parquet(str(folder)).schema
    aln = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    query = stream_junctions(aln, "at").writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).outputMode("append").trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(120), "the stream did not end"
    finally:
        query.stop()
    return query


@pytest.fixture()
def closing(spark):
    """A mate that passes but stays alone: it moves the watermark and counts for nothing."""
    row = ("q-last", "s0", "control", "rf", "chr1", 1, 60, 3 + 64, 1, "10M")
    return spark.createDataFrame([row], "qname string, sample_id string, grp string, library string, chrom string, pos long, mapq int, flag int, nh int, cigar string")


def test_mates_in_different_files_count_as_in_the_batch(spark, tmp_path, closing):
    aln = view(spark, SF, "aln").select(*closing.columns, "read_id")
    part = F.pmod(F.xxhash64("read_id"), F.lit(3))
    for k in range(3):
        land(at(aln.where(part == k).drop("read_id"), 60 * k), tmp_path / "in")
    land(at(closing, 86_400), tmp_path / "in")
    query = streamed(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    got = spark.read.parquet(str(tmp_path / "out"))
    want = harvest.junction_reads(aln)
    counted = lambda df: Counter(tuple(r) for r in df.select(*COLUMNS).collect())
    assert counted(got) == counted(want) and want.count() > 100
    # mates did come apart, and no session is left but the closing one
    split = aln.where("flag & 1 <> 0").withColumn("part", part).groupBy("sample_id", "qname").agg(F.count_distinct("part").alias("n")).where("n > 1").count()
    assert split > 100
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    assert counted(harvest.census(got).drop("n")) == counted(harvest.census(want).drop("n"))


def test_third_records_and_late_mates_give_nothing(spark, tmp_path, closing):
    def mates(*rows):
        return spark.createDataFrame([(q, "s1", "treat", "rf", "chr1", pos, 60, flag, 1, "10M50N10M") for q, pos, flag in rows], closing.schema)

    first, second = 3 + 64, 3 + 128 + 16
    land(at(mates(("pair", 100, first), ("three", 300, first), ("three", 300, second), ("late", 500, first)), 0), tmp_path / "in")
    land(at(mates(("pair", 100, second), ("three", 900, second)), 60), tmp_path / "in")
    land(at(closing, 7_200), tmp_path / "in")
    land(at(mates(("late", 500, second)), 7_201), tmp_path / "in")
    land(at(closing, 86_400), tmp_path / "in")
    streamed(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    got = [(r["start"], r["end"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [(110, 159)]
