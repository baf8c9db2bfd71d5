"""Fragments to counts: exon hits, unique genes, isoform shares, zero-filled matrices and TPM."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import overlap_join


def exon_hits(blocks: DataFrame, exons: DataFrame) -> DataFrame:
    """Distinct (sample_id, fragment, gene_id, transcript_id) of aligned blocks on compatible exons; blocks without a strand fit any."""
    p = overlap_join(blocks, exons)
    ok = F.col("strand").isNull() | (F.col("strand") == F.col("r_strand")) | (F.col("r_strand") == ".")
    return p.where(ok).select("sample_id", "fragment", F.col("r_gene_id").alias("gene_id"), F.col("r_transcript_id").alias("transcript_id")).distinct()


def unique_gene(hits: DataFrame) -> DataFrame:
    """Hits of fragments that hit one gene alone, with ``share`` of each compatible transcript."""
    one = hits.groupBy("sample_id", "fragment").agg(F.min("gene_id").alias("_a"), F.max("gene_id").alias("_b"), F.collect_set("transcript_id").alias("t")).where("_a = _b")
    return one.select("sample_id", "fragment", F.col("_a").alias("gene_id"), F.explode("t").alias("transcript_id"), (F.lit(1.0) / F.size("t")).alias("share"))


def gene_counts(unique: DataFrame) -> DataFrame:
    return unique.groupBy("sample_id", "gene_id").agg(F.count_distinct("fragment").alias("n"))


def zero_filled(counts: DataFrame, genes: DataFrame, samples: DataFrame) -> DataFrame:
    """A count for every gene and sample. samples is a sheet of few rows, the one side of a product that is broadcast."""
    return genes.select("gene_id").distinct().join(F.broadcast(samples.select("sample_id").distinct())).join(counts, ["sample_id", "gene_id"], "left").select("gene_id", "sample_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def tpm(matrix: DataFrame) -> DataFrame:
    """matrix (gene_id, sample_id, n, length) with tpm over the whole table of each sample, rounded to 6 places.

    The denominators are a partial aggregation to one row a sample, broadcast back, so no window gathers a sample.
    """
    rate = matrix.withColumn("rate", F.col("n") / F.col("length"))
    total = rate.groupBy("sample_id").agg(F.sum("rate").alias("total"))
    return rate.join(F.broadcast(total), "sample_id").withColumn("tpm", F.round(F.when(F.col("total") > 0, F.col("rate") / F.col("total") * 1e6).otherwise(0.0), 6)).drop("rate", "total")


def size_factors(matrix: DataFrame) -> DataFrame:
    """Median of ratios to the geometric mean, over genes counted in every sample."""
    logs = matrix.groupBy("gene_id").agg(F.avg(F.when(F.col("n") > 0, F.log("n"))).alias("_g"), F.min("n").alias("_m")).where("_m > 0")
    ratio = matrix.join(logs, "gene_id").select("sample_id", (F.log("n") - F.col("_g")).alias("r"))
    return ratio.groupBy("sample_id").agg(F.round(F.exp(F.median("r")), 6).alias("size_factor"))
