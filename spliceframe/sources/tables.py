"""BED intervals, sample sheets and FASTA as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bases of a genome row.
CHUNK = 1 << 16


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end (1-based, closed) and name of BED rows (0-based, half-open); comments and track lines go."""
    p = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").rlike("^(#|track|browser|\\s*$)"))
    return lines.select(p[0].alias("chrom"), (p[1].cast("long") + 1).alias("start"), p[2].cast("long").alias("end"), F.get(p, F.lit(3)).alias("name"))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, bam, grp, strandedness and replicate of a tab-separated sheet; missing replicates are numbered within the group.

    A missing or repeated sample id, or an unknown group or strandedness, is an error.
    """
    from ..operators.models import replicate_ordinals

    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    has = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    rows = raw.select("sample_id", "bam", has("group").alias("grp"), F.coalesce(has("strandedness"), F.lit("unstranded")).alias("strandedness"), has("replicate").cast("int").alias("replicate"), F.monotonically_increasing_id().alias("row"))
    bad = F.col("sample_id").isNull() | ~F.coalesce("grp", F.lit("control")).isin("control", "treat") | ~F.col("strandedness").isin("unstranded", "fr", "rf")
    checked = rows.withColumn("sample_id", F.when(bad, F.raise_error(F.concat(F.lit("bad sheet row: "), F.concat_ws(" ", "sample_id", "grp", "strandedness")))).otherwise(F.col("sample_id")))
    twice = checked.groupBy("sample_id").count().where("count > 1").first()
    if twice:
        raise ValueError(f"repeated sample id: {twice['sample_id']}")
    return replicate_ordinals(checked).drop("row")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """chrom, chunk and seq (upper case, CHUNK bases a row but the last) of a FASTA file.

    Records are split at their header mark, so one record is read by one task, as one contig.
    """
    records = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    name = F.regexp_extract("value", r"^(\S+)", 1)
    seq = F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", ""))
    whole = records.select(name.alias("chrom"), seq.alias("seq"))
    chunks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("seq") - 1) / F.lit(CHUNK)).cast("int")))
    return whole.withColumn("chunk", F.explode(chunks)).select("chrom", "chunk", F.substring("seq", F.col("chunk") * CHUNK + 1, F.lit(CHUNK)).alias("seq"))


def fetch(genome: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """key and bases of each span (chrom, start, end): its chunks by an equality join, cut and put in order."""
    of = lambda c: F.floor((c - 1) / F.lit(CHUNK)).cast("int")
    need = spans.select(key, "chrom", "start", "end").withColumn("chunk", F.explode(F.sequence(of(F.col("start")), of(F.col("end")))))
    base = F.col("chunk").cast("long") * CHUNK
    a = F.greatest(F.col("start") - base, F.lit(1)).cast("int")
    part = F.substring("seq", a, (F.least(F.col("end") - base, F.lit(CHUNK)) - a + 1).cast("int"))
    joined = need.join(genome, ["chrom", "chunk"]).select(key, "chunk", part.alias("part"))
    return joined.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))), lambda x: x["part"]), "").alias("bases"))


def species_key(name: Column) -> Column:
    """Common names and assemblies of the two species to one key; others as they are, in lower case."""
    low = F.lower(F.trim(name))
    return F.when(low.isin("human", "homo sapiens", "hg38", "grch38"), "human").when(low.isin("mouse", "mus musculus", "mm10", "mm39", "grcm38", "grcm39"), "mouse").otherwise(low)


def read_contig_lengths(spark: SparkSession, path: str) -> DataFrame:
    """chrom and length of each contig of a FASTA index, under its own name and under its ``chrom_key``.

    Where both name one contig and the lengths differ, that of its own name holds, of several the greatest. Lines of one
    field go; a length that is no whole number is an error.
    """
    from ..functions.sequences import chrom_key

    p = F.split("value", "\t")
    lines = spark.read.text(path).where(F.size(p) >= 2).select(p[0].alias("name"), p[1].cast("long").alias("length"))
    names = lines.select("length", F.explode(F.array(F.struct(F.col("name").alias("chrom"), F.lit(1).alias("own")), F.struct(chrom_key(F.col("name")).alias("chrom"), F.lit(0).alias("own")))).alias("n"))
    return names.groupBy("n.chrom").agg(F.max(F.struct("n.own", "length"))["length"].alias("length"))


def browser_genome(assembly: Column) -> Column:
    """The genome browsers' name of an assembly; null for others."""
    name = F.trim(assembly)
    return F.when(name.isin("GRCm39", "mm39"), "mm39").when(name.isin("GRCh38", "hg38"), "hg38")
