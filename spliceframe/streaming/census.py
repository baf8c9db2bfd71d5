"""Junction census over alignments that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reads as R


def stream_census(spark: SparkSession, folder: str, schema: str, min_mapq: int = 10) -> DataFrame:
    """Running counts of each junction in each sample over Parquet files that land in a folder, for unpaired records.

    The state is one row a junction and sample. Write it with output mode update or complete. For paired records see
    ``stream_junctions``.
    """
    aln = spark.readStream.schema(schema).parquet(folder)
    kept = aln.where(R.passes(F.col("flag"), F.col("mapq"), min_mapq) & ~R.has(F.col("flag"), R.PAIRED))
    strand = F.coalesce(R.inferred_strand(F.col("flag"), F.col("library")), F.lit("."))
    each = kept.select("sample_id", "grp", "chrom", strand.alias("strand"), F.explode(R.introns(F.col("pos"), F.col("cigar"))).alias("i"))
    return each.groupBy("sample_id", "grp", "chrom", F.col("i.s").alias("start"), F.col("i.e").alias("end"), "strand").agg(F.count(F.lit(1)).alias("n"))


def stream_junctions(aln: DataFrame, time: str, apart: str = "10 minutes", late: str = "10 minutes", min_mapq: int = 10, unique_only: bool = False) -> DataFrame:
    """A row for each distinct junction of each fragment that counts, as ``harvest.junction_reads`` gives them, from a stream of records.

    ``time`` is the records' event time, say the time their file arrived. Unpaired records give their junctions at once.
    Records of a fragment (sample_id, qname) are one session, which closes when none of them came for ``apart`` and the
    watermark, ``late`` behind the latest paired record that passes, has gone by; it gives its junctions, each once, if it holds exactly two
    records that pass. A mate that comes after that is alone in a session of its own and gives nothing. The state of an
    open session is a count and two lists, so state is bounded by the fragments of the last ``apart`` and ``late``.
    Paired records without a time give nothing. Write it in append mode; ``harvest.census`` of what is
    written gives the counts.
    """
    paired = R.has(F.col("flag"), R.PAIRED)
    ok = R.passes(F.col("flag"), F.col("mapq"), min_mapq) & (~paired | R.has(F.col("flag"), R.PROPER))
    if unique_only:
        ok = ok & (F.coalesce("nh", F.lit(0)) == 1)
    strand = F.coalesce(R.inferred_strand(F.col("flag"), F.col("library")), F.lit("."))
    found = F.transform(R.introns(F.col("pos"), F.col("cigar")), lambda i: F.struct("grp", "chrom", strand.alias("strand"), i["s"].alias("start"), i["e"].alias("end")))
    kept = aln.where(ok).select("sample_id", "qname", time, paired.alias("_paired"), found.alias("_found"))
    alone = kept.where("NOT _paired").select("sample_id", F.explode("_found").alias("i"))
    # the paired branch alone has a watermark: with one in each, a branch without records would hold back the other's
    # of two records the lesser and the greater list are both there are
    sessions = kept.where("_paired").withWatermark(time, late).groupBy("sample_id", "qname", F.session_window(time, apart)).agg(F.count(F.lit(1)).alias("_n"), F.min("_found").alias("_a"), F.max("_found").alias("_b"))
    mates = sessions.where("_n = 2").select("sample_id", F.explode(F.array_distinct(F.concat("_a", "_b"))).alias("i"))
    return alone.unionByName(mates).select("sample_id", "i.*")
