"""Gene models from GTF text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def attribute(attributes: Column, name: str) -> Column:
    """Value of the first attribute by a name, with or without quotes; null if absent."""
    found = F.regexp_extract(attributes, rf'(?:^|;)\s*{name}\s+(?:"([^"]*)"|([^";\s]+))', 0)
    value = F.regexp_replace(found, rf'^;?\s*{name}\s+', "")
    return F.when(found != "", F.replace(value, F.lit('"'), F.lit("")))


def read_gtf(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """chrom, feature, start, end, strand, gene_id, transcript_id, gene_name, biotype, cov of each row.

    Comments and blank lines go. strict: a row without nine fields or whole-number places is an error; else it goes too.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    p = F.split("value", "\t")
    start, end = F.get(p, F.lit(3)).try_cast("long"), F.get(p, F.lit(4)).try_cast("long")
    good = (F.size(p) >= 9) & start.isNotNull() & end.isNotNull() & (start <= end)
    rows = lines.withColumn("_ok", F.when(good, True).otherwise(F.raise_error(F.concat(F.lit("bad GTF row: "), "value")).cast("boolean")) if strict else F.coalesce(good, F.lit(False))).where("_ok")
    attributes = F.get(p, F.lit(8))
    strand = F.get(p, F.lit(6))
    return rows.select(
        F.get(p, F.lit(0)).alias("chrom"),
        F.get(p, F.lit(2)).alias("feature"),
        start.alias("start"),
        end.alias("end"),
        F.when(strand.isin("+", "-"), strand).otherwise(".").alias("strand"),
        *[attribute(attributes, a).alias(n) for a, n in (("gene_id", "gene_id"), ("transcript_id", "transcript_id"), ("gene_name", "gene_name"))],
        F.coalesce(attribute(attributes, "gene_biotype"), attribute(attributes, "gene_type")).alias("biotype"),
        attribute(attributes, "cov").try_cast("double").alias("cov"),
    )


def write_gtf(transcripts: DataFrame, path: str, source: str = "residual") -> None:
    """One exon row for each element of exons (array<struct<start, end>>), as text files under path."""
    rows = transcripts.select("chrom", "strand", "gene_id", "transcript_id", F.explode("exons").alias("x"))
    tail = F.concat(F.lit('gene_id "'), F.col("gene_id"), F.lit('"; transcript_id "'), F.col("transcript_id"), F.lit('";'))
    rows.select(F.concat_ws("\t", "chrom", F.lit(source), F.lit("exon"), F.col("x.start").cast("string"), F.col("x.end").cast("string"), F.lit("."), "strand", F.lit("."), tail).alias("value")).write.mode("overwrite").text(path)
