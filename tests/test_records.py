"""Nearest-gene records, unstranded classes, assemblies by sample, contig lengths and genome names on small rows."""

import pytest
from pyspark.sql import functions as F

from spliceframe.operators import evidence, models
from spliceframe.operators.intervals import clip
from spliceframe.sources.tables import browser_genome, read_contig_lengths


def test_nearest_genes_flag_ties_and_nulls(spark):
    bodies = spark.createDataFrame(
        [("c", "+", 100, 200, "b", "B", False), ("c", "+", 300, 400, "a", "A", True), ("c", "-", 240, 260, "m", "M", False), ("d", "-", 5, 9, "z", "Z", False)],
        "chrom string, strand string, start long, end long, gene_id string, gene_name string, derived boolean",
    )
    loci = spark.createDataFrame([("tie", "c", "+", 250, 250), ("free", "c", ".", 250, 250), ("other", "d", "+", 1, 2), ("gone", "e", "+", 1, 2), ("null", None, "+", 1, 2), ("tie", "c", "+", 250, 250)], "gene_id string, chrom string, strand string, start long, end long")
    told = lambda df: sorted((r["gene_id"], r["overlaps_gene"], r["nearest_id"], r["nearest_name"], r["distance"], r["nearest_strand"], r["body_start"], r["body_end"]) for r in df.collect())
    none = (None,) * 6
    at = ("m", "M", 0, "-", 240, 260)
    # on "+" both are 49 bases away: the one with a gene row comes before the derived one, though its id is greater
    tie = ("tie", True, "b", "B", 49, "+", 100, 200)
    assert told(models.nearest_genes(loci, bodies)) == sorted([tie, tie, ("free", True, *at), ("other", False, *none), ("gone", False, *none), ("null", False, *none)])
    loose = {r[0]: r for r in told(models.nearest_genes(loci, bodies, unstranded=True))}
    assert loose["tie"] == ("tie", True, *at) and loose["other"] == ("other", False, "z", "Z", 2, "-", 5, 9)
    assert models.nearest_genes(loci.where("false"), bodies).count() == 0 and models.nearest_genes(loci, bodies.where("false")).where("nearest_id IS NULL").count() == 6


def test_class_of_an_unstranded_library(spark):
    exon = "chrom string, strand string, start long, end long"
    query = spark.createDataFrame([("c", "-", 10, 20, "t", 10, 20), ("c", "-", 60, 70, "u", 60, 70), ("c", "-", 41, 44, "v", 41, 44)], exon + ", transcript_id string, tx_start long, tx_end long")
    ref = spark.createDataFrame([("c", "+", 12, 30, "r", 12, 30)], exon + ", ref_id string, ref_start long, ref_end long")
    bodies = spark.createDataFrame([("c", "+", 12, 45)], exon)
    told = lambda unstranded: {r["transcript_id"]: r["class"] for r in models.class_codes(query, ref, bodies, unstranded).collect()}
    assert told(False) == {"t": "x", "u": "u", "v": "x"}
    assert told(True) == {"t": "extension", "u": "u", "v": "i"}


def test_assemblies_by_sample(spark):
    loci = spark.createDataFrame([("L1", "c", "+", 100, 200), ("L2", "c", None, 500, 600), ("L3", "d", "+", 1, 2)], "locus_id string, chrom string, strand string, start long, end long")
    made = spark.createDataFrame([("b", "c", "+", 90, 120, 2.0), ("b", "c", ".", 150, 230, None), ("b", "c", "-", 100, 900, 9.0), ("a", "c", "-", 600, 700, None)], "sample_id string, chrom string, strand string, start long, end long, cov double")
    sheet = spark.createDataFrame([("b", "treat", 0), ("a", "control", 1)], "sample_id string, grp string, row int")
    found = evidence.assemblies(loci, made)
    assert sorted(tuple(r) for r in found.collect()) == [("L1", "b", 2, 2.0, 90, 230, 30), ("L2", "a", 1, None, 600, 700, 100), ("L2", "b", 1, 9.0, 100, 900, 400)]
    assert sorted(tuple(r) for r in evidence.assembly_summary(loci, found, sheet).collect()) == [("L1", "b", 0, 1, 30), ("L2", "b,a", 1, 1, 400), ("L3", "", 0, 0, None)]
    assert evidence.assemblies(loci, made, unstranded=True).where("locus_id = 'L1'").first()["n_isoforms"] == 3


def test_contig_lengths_and_genome_names(spark, tmp_path):
    at = tmp_path / "g.fa.fai"
    at.write_text("chr1\t50\t6\t60\t61\n2\t70\t6\t60\t61\nchr2\t80\n\nlone\n")
    lengths = read_contig_lengths(spark, str(at))
    assert {r["chrom"]: r["length"] for r in lengths.collect()} == {"chr1": 50, "1": 50, "2": 70, "chr2": 80}
    span = spark.createDataFrame([("1", -4, 99), ("x", -4, 99)], "chrom string, start long, end long")
    assert sorted(tuple(r) for r in clip(span, lengths).collect()) == [("1", 1, 50), ("x", 1, 99)]
    at.write_text("chr1\tmany\n")
    with pytest.raises(Exception, match="many"):
        read_contig_lengths(spark, str(at)).collect()
    names = spark.createDataFrame([(" GRCm39",), ("hg38",), ("hg19",), (None,)], "a string").select(browser_genome(F.col("a")).alias("g"))
    assert [r["g"] for r in names.collect()] == ["mm39", "hg38", None, None]
