"""Gene models: bodies, universes, class codes, representatives and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import chrom_key
from .intervals import nearest, nearest_stranded, overlap_join

#: Worst class first. Fixed values.
CLASS_RANK = {"overlap": 4, "extension": 3, "x": 2, "i": 1, "u": 0}


def gene_bodies(features: DataFrame) -> DataFrame:
    """One body for each (chrom, gene): its gene row, else the span of its exons, with ``derived`` telling which."""
    gene, exon = F.col("feature") == "gene", F.col("feature") == "exon"
    pick = lambda f, c: F.coalesce(f(F.when(gene, F.col(c))), f(F.when(exon, F.col(c))))
    out = features.groupBy("chrom", "gene_id").agg(pick(F.min, "start").alias("start"), pick(F.max, "end").alias("end"), F.first("strand").alias("strand"), (F.count_if(gene) == 0).alias("derived"))
    return out.where("start IS NOT NULL")


def universe(models: DataFrame, residuals: DataFrame, prefix: str = "RSDL.") -> DataFrame:
    """All models and residuals; a model that already bears the residual prefix is an error."""
    clash = F.when(F.col("gene_id").startswith(prefix), F.raise_error(F.concat(F.lit("residual id in models: "), F.col("gene_id")))).otherwise(F.col("gene_id"))
    return models.withColumn("gene_id", clash).unionByName(residuals, allowMissingColumns=True)


def _same(q: Column, r: Column, unstranded: bool = False) -> Column:
    return F.lit(True) if unstranded else (q == ".") | (r == ".") | (q == r)


def class_codes(exons: DataFrame, ref_exons: DataFrame, bodies: DataFrame, unstranded: bool = False) -> DataFrame:
    """Class of each query transcript against reference exons and gene bodies; of an unstranded library every strand is its own.

    exons: transcript_id, chrom, strand, start, end, tx_start, tx_end. ref_exons: ref_id, chrom, strand, start, end,
    ref_start, ref_end. bodies: chrom, strand, start, end. The best reference has most shared bases, of equal ones the
    least id. u: touches no exon and no body; else by same-strand exons, opposite exons, same-strand body, opposite body.
    """
    e = overlap_join(exons, ref_exons)
    same = _same(F.col("strand"), F.col("r_strand"), unstranded)
    per = e.groupBy("transcript_id", F.col("r_ref_id").alias("ref_id")).agg(F.sum(F.when(same, F.least("end", "r_end") - F.greatest("start", "r_start") + 1)).alias("bases"), F.first("r_ref_start").alias("rs"), F.first("r_ref_end").alias("re"), F.bool_or(same).alias("same"))
    of_exons = per.groupBy("transcript_id").agg(F.bool_or("same").alias("same_exon"), F.min(F.when(F.col("same"), F.struct((-F.col("bases")).alias("b"), "ref_id", "rs", "re"))).alias("best"))
    b = overlap_join(exons.select("transcript_id", "chrom", "strand", "start", "end"), bodies)
    of_bodies = b.groupBy("transcript_id").agg(F.bool_or(_same(F.col("strand"), F.col("r_strand"), unstranded)).alias("same_body"))
    tx = exons.groupBy("transcript_id").agg(F.min("tx_start").alias("tx_start"), F.max("tx_end").alias("tx_end"))
    j = tx.join(of_exons, "transcript_id", "left").join(of_bodies, "transcript_id", "left")
    sticks_out = (F.col("tx_start") < F.col("best.rs")) | (F.col("tx_end") > F.col("best.re"))
    code = (
        F.when(F.col("same_exon").isNull() & F.col("same_body").isNull(), "u")
        .when(F.col("same_exon"), F.when(sticks_out, "extension").otherwise("overlap"))
        .when(F.col("same_exon").isNotNull(), "x")
        .when(F.col("same_body"), "i")
        .otherwise("x")
    )
    return j.select("transcript_id", code.alias("class"))


def locus_classes(classes: DataFrame) -> DataFrame:
    """Worst class, isoforms and whether all are u, by locus."""
    rank = F.create_map(*[x for k, v in CLASS_RANK.items() for x in (F.lit(k), F.lit(v))])
    known = F.coalesce(rank[F.col("class")], F.raise_error(F.concat(F.lit("unknown class "), F.coalesce("class", F.lit("null")))).cast("int"))
    return classes.withColumn("_r", known).groupBy("locus_id").agg(F.max_by("class", "_r").alias("locus_class"), F.count(F.lit(1)).alias("n_isoforms"), F.bool_and(F.col("class") == "u").alias("all_u"))


def representatives(classes: DataFrame) -> DataFrame:
    """The longest isoform, of equal ones the least id, of loci that are u throughout."""
    best = F.min(F.struct((-F.col("length_nt")).alias("n"), "transcript_id"))
    return classes.groupBy("locus_id").agg(F.bool_and(F.col("class") == "u").alias("_u"), best.alias("b")).where("_u").select("locus_id", F.col("b.transcript_id").alias("transcript_id"))


def nearest_genes(loci: DataFrame, bodies: DataFrame, unstranded: bool = False) -> DataFrame:
    """loci with overlaps_gene (a body on either strand touches it) and its nearest gene: nearest_id, nearest_name, distance, nearest_strand, body_start, body_end.

    The nearest is on the locus's own strand, or on any if it has none or the library is unstranded. Of bodies at one
    distance those of gene rows come before derived ones, then the least gene_id. Loci on contigs without such bodies,
    or with a null place, get nulls. bodies: chrom, strand, start, end, gene_id, gene_name, derived; one a contig and id.
    """
    keyed = bodies.withColumn("_key", F.concat(F.when(F.coalesce("derived", F.lit(False)), "1").otherwise("0"), "gene_id"))
    sided = keyed.select("chrom", "strand", "start", "end", F.col("_key").alias("gene_id"))
    own = loci.withColumns({"_locus": F.struct("chrom", "start", "end"), "_given": F.struct(*loci.columns)}).select("chrom", "start", "end", "strand", "_locus", "_given")
    near = nearest(own, sided) if unstranded else nearest_stranded(own, sided)
    about = keyed.select(F.col("chrom").alias("_chrom"), "_key", F.struct(F.col("gene_id").alias("id"), F.col("gene_name").alias("name"), "strand", "start", "end").alias("_gene"))
    touched = overlap_join(loci.select("chrom", "start", "end").distinct(), sided, how="semi").select(F.struct("chrom", "start", "end").alias("_locus"), F.lit(True).alias("_touched"))
    out = near.join(about, (F.col("chrom") == F.col("_chrom")) & (F.col("nearest_id") == F.col("_key")), "left").join(touched, "_locus", "left")
    told = {"nearest_id": "id", "nearest_name": "name", "nearest_strand": "strand", "body_start": "start", "body_end": "end"}
    gene = {a: F.col(f"_gene.{b}").alias(a) for a, b in told.items()}
    return out.select("_given.*", F.coalesce("_touched", F.lit(False)).alias("overlaps_gene"), gene["nearest_id"], gene["nearest_name"], "distance", gene["nearest_strand"], gene["body_start"], gene["body_end"])


def name_loci(loci: DataFrame, bodies: DataFrame) -> DataFrame:
    """locus_id, named_overlap and gene_id: a same-strand coding gene, else any on the strand, else any, by (start, id).

    Contigs are compared by ``chrom_key``, so chr1 and 1 are one.
    """
    keyed = lambda df, *more: df.select(chrom_key(F.col("chrom")).alias("chrom"), "strand", "start", "end", *more)
    p = overlap_join(keyed(loci, "locus_id"), keyed(bodies, "gene_id", "biotype"))
    same = F.col("strand") == F.col("r_strand")
    rank = F.when(same & (F.col("r_biotype") == "protein_coding"), 0).when(same, 1).otherwise(2)
    best = p.groupBy("locus_id").agg(F.min(F.struct(rank.alias("k"), F.col("r_start").alias("s"), F.col("r_gene_id").alias("g"))).alias("b"))
    label = F.when(F.col("b").isNull(), "none").when(F.col("b.k") == 0, "protein_coding").otherwise("annotated")
    return loci.select("locus_id").join(best, "locus_id", "left").select("locus_id", label.alias("named_overlap"), F.col("b.g").alias("gene_id"))


def first_wins(parts: list[DataFrame], key: str) -> DataFrame:
    """Rows of all parts, each key once, from the earliest part that has it (least row by its columns within one)."""
    whole = None
    for k, p in enumerate(parts):
        p = p.withColumn("_source", F.lit(k))
        whole = p if whole is None else whole.unionByName(p)
    columns = [c for c in whole.columns if c not in (key, "_source")]
    best = whole.groupBy(key).agg(F.min(F.struct("_source", *columns)).alias("b"))
    return best.select(key, *[F.col(f"b.{c}").alias(c) for c in columns])


def replicate_ordinals(sheet: DataFrame) -> DataFrame:
    """Sheet rows with replicate filled by order within the group where it is missing."""
    w = Window.partitionBy("grp").orderBy("row")
    return sheet.withColumn("replicate", F.coalesce("replicate", F.row_number().over(w)))


def open_gaps(loci: DataFrame, bodies: DataFrame) -> DataFrame:
    """locus_id, chrom, nearest_id, before (whether the locus ends before the body) and gap_start, gap_end: the bases between a locus and its nearest body, null where they touch or overlap."""
    spans = bodies.select(F.col("gene_id").alias("nearest_id"), F.col("start").alias("_gs"), F.col("end").alias("_ge"))
    near = nearest(loci, bodies).join(spans, "nearest_id")
    right, left = F.col("_gs") > F.col("end") + 1, F.col("_ge") < F.col("start") - 1
    return near.select("locus_id", "chrom", "nearest_id", F.when(right, True).when(left, False).alias("before"), F.when(right, F.col("end") + 1).when(left, F.col("_ge") + 1).alias("gap_start"), F.when(right, F.col("_gs") - 1).when(left, F.col("start") - 1).alias("gap_end"))


def bridge_support(gaps: DataFrame, introns: DataFrame, exons: DataFrame) -> DataFrame:
    """locus_id and bridges: distinct fragments with an intron that joins the locus's edge of its gap to an exon edge of the nearest gene.

    gaps as of ``open_gaps``; introns: chrom, start, end, fragment; exons: gene_id, start, end. A locus before its gene
    needs an intron from the gap's first base to the base before an exon; one after it, from the base after an exon to
    the gap's last. Loci without a gap or bridge have 0.
    """
    x = exons.select(F.col("gene_id").alias("nearest_id"), F.col("start").alias("_xs"), F.col("end").alias("_xe"))
    edges = gaps.where("before IS NOT NULL").join(x, "nearest_id").select("locus_id", "chrom", F.when(F.col("before"), F.col("gap_start")).otherwise(F.col("_xe") + 1).alias("start"), F.when(F.col("before"), F.col("_xs") - 1).otherwise(F.col("gap_end")).alias("end")).distinct()
    counted = edges.join(introns, ["chrom", "start", "end"]).groupBy("locus_id").agg(F.count_distinct("fragment").alias("bridges"))
    return gaps.select("locus_id").join(counted, "locus_id", "left").select("locus_id", F.coalesce("bridges", F.lit(0).cast("long")).alias("bridges"))
