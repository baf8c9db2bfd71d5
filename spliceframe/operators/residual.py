"""Junctions to residual loci: clusters, chains, the knife off genes, terminal walks, clips and numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exons as X
from ..functions.sequences import chrom_key
from .coverage import walk_end
from .harvest import MAX_EXON, MIN_EXON, MIN_INTRON, components, global_rank, greedy_chain, select_junctions, shared_sites
from .intervals import nearest, overlap_join
from .storage import cut

#: Least and most bases of a terminal exon, uncovered bases a walk passes over, and how near a gene's strand or a small RNA may be. Fixed values.
TERMINAL, WALK, HOLE, CLOSE = 30, 2000, 20, 200
SMALL_RNA = "snRNA snoRNA rRNA tRNA scRNA sRNA Mt_rRNA Mt_tRNA vault_RNA ribozyme".split()
#: What a residual has, in order; text "none" or 0 where its junctions don't say. Fixed values.
COLUMNS = "residual_id chrom start end strand n_junctions n_exons length_nt exon_structure intron_structure nearest_id nearest_distance control_max control_n_detected cohort treat_sum treat_n_detected n_shared_site status".split()


def defaults(junctions: DataFrame) -> DataFrame:
    """junctions with support_sum, n_detected, control_max and control_n_detected, where missing or null 0; control_n_detected is 1 at least where control_max is above 0."""
    have = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)) if c in junctions.columns else F.lit(0).cast("long")
    filled = junctions.withColumns({c: have(c) for c in ("support_sum", "n_detected", "control_max", "control_n_detected")})
    return filled.withColumn("control_n_detected", F.when(F.col("control_max") > 0, F.greatest("control_n_detected", F.lit(1))).otherwise(F.col("control_n_detected")))


def clip_terminals(loci: DataFrame, bodies: DataFrame) -> DataFrame:
    """loci with left and right moved off gene bodies of either strand that the terminals reach: past the last end, before the first start.

    loci: locus_id, chrom, left, right, first (the first intron's start), last (the last intron's end). One join of
    each side's terminal with bodies, and an extremum of what it meets, whatever order bodies come in.
    """
    slim = bodies.select("chrom", "start", "end")
    left = overlap_join(loci.select("locus_id", "chrom", F.col("left").alias("start"), (F.col("first") - 1).alias("end")).where("start <= end"), slim).groupBy("locus_id").agg((F.max("r_end") + 1).alias("_left"))
    right = overlap_join(loci.select("locus_id", "chrom", (F.col("last") + 1).alias("start"), F.col("right").alias("end")).where("start <= end"), slim).groupBy("locus_id").agg((F.min("r_start") - 1).alias("_right"))
    moved = loci.join(left, "locus_id", "left").join(right, "locus_id", "left")
    return moved.withColumns({"left": F.coalesce(F.greatest("left", "_left"), "left"), "right": F.coalesce(F.least("right", "_right"), "right")}).drop("_left", "_right")


def rebuilt(loci: DataFrame) -> DataFrame:
    """loci with exons from left through the chain to right, start, end, n_exons and length_nt; a terminal without room goes."""
    first = F.when(F.col("left") > F.col("first") - 1, F.col("first")).otherwise(F.col("left"))
    last = F.when(F.col("right") < F.col("last") + 1, F.col("last")).otherwise(F.col("right"))
    whole = loci.withColumn("exons", X.rebuild(F.col("chain"), F.greatest(F.lit(1).cast("long"), first), last))
    size = F.aggregate("exons", F.lit(0).cast("long"), lambda n, e: n + e["end"] - e["start"] + 1)
    return whole.withColumns({"start": F.array_min("exons")["start"], "end": F.element_at("exons", -1)["end"], "n_exons": F.size("exons"), "length_nt": size})


def walked(loci: DataFrame, blocks: DataFrame) -> DataFrame:
    """locus_id, left and right: how far aligned blocks of compatible reads cover each side outward from the chain; null without any.

    blocks: chrom, start, end and strand (null fits any locus), pooled over all samples.
    """
    compatible = F.col("r_strand").isNull() | (F.col("r_strand") == F.col("strand")) | (F.col("strand") == ".")
    slim = blocks.select("chrom", "start", "end", "strand")

    def side(start: Column, end: Column, a: Column, b: Column, name: str) -> DataFrame:
        met = overlap_join(loci.select("locus_id", "chrom", "strand", "first", "last", start.alias("start"), end.alias("end")), slim).where(compatible)
        return walk_end(met.select("locus_id", a.alias("a"), b.alias("b")), "locus_id", HOLE, WALK).withColumnRenamed("reach", name)

    left = side(F.col("first") - WALK, F.col("first") - 1, F.col("first") - F.col("r_end"), F.col("first") - F.col("r_start"), "_l")
    right = side(F.col("last") + 1, F.col("last") + WALK, F.col("r_start") - F.col("last"), F.col("r_end") - F.col("last"), "_r")
    both = loci.select("locus_id", "first", "last").join(left, "locus_id", "left").join(right, "locus_id", "left")
    return both.select("locus_id", F.when(F.col("_l") > 0, F.col("first") - F.col("_l")).alias("left"), F.when(F.col("_r") > 0, F.col("last") + F.col("_r")).alias("right"))


def _distances(loci: DataFrame, bodies: DataFrame, sided: bool = True) -> DataFrame:
    """nearest_id and nearest_distance on the locus's own strand; of either strand for a locus without one, if so asked, else of bodies without one."""
    known = F.coalesce(F.col("strand"), F.lit(".")).isin("+", "-")
    if not sided:
        return nearest(loci, bodies, ("chrom", "strand")).withColumnRenamed("distance", "nearest_distance")
    return nearest(loci.where(known), bodies, ("chrom", "strand")).unionByName(nearest(loci.where(~known), bodies)).withColumnRenamed("distance", "nearest_distance")


def _off_genes(loci: DataFrame, bodies: DataFrame) -> DataFrame:
    """loci whose chain touches no body, isn't near one on its own strand nor near a small RNA's on either."""
    span = loci.select("locus_id", "chrom", "strand", F.col("first").alias("start"), F.col("last").alias("end"))
    free = overlap_join(span, bodies.select("chrom", "start", "end"), how="anti")
    apart = _distances(free, bodies, sided=False).where(F.col("nearest_distance").isNull() | (F.col("nearest_distance") >= CLOSE)).drop("nearest_id", "nearest_distance")
    # fewer than CLOSE bases between is at most CLOSE - 1, so intervals meet when padded by CLOSE
    kept = overlap_join(apart, bodies.where(F.col("biotype").isin(SMALL_RNA)).select("chrom", "start", "end"), pad=CLOSE, how="anti")
    return loci.join(kept.select("locus_id"), "locus_id", "left_semi")


def chains(junctions: DataFrame, bodies: DataFrame, min_exon: int = MIN_EXON, max_exon: int = MAX_EXON) -> DataFrame:
    """Clusters of junctions (node, chrom, strand, start, end and their counts) with what a residual tells of them, and their chain of introns."""
    clustered = cut(components(junctions, bodies, min_exon, max_exon))
    told = clustered.groupBy("component").agg(
        F.first("chrom").alias("chrom"),
        F.first("strand").alias("strand"),
        F.count(F.lit(1)).alias("n_junctions"),
        F.sum("support_sum").alias("treat_sum"),
        F.max("n_detected").alias("treat_n_detected"),
        F.max("control_max").alias("control_max"),
        F.max("control_n_detected").alias("control_n_detected"),
        greedy_chain(F.collect_list(F.struct("start", "end", F.col("support_sum").alias("support")))).alias("chain"),
    )
    sited = told.join(shared_sites(clustered), "component", "left").fillna(0, ["n_shared_site"])
    return sited.withColumnRenamed("component", "locus_id").withColumns({"first": F.get("chain", F.lit(0))["start"], "last": F.element_at("chain", -1)["end"], "cohort": F.when(F.col("control_max") > 0, "shared").otherwise("silent")})


def build(junctions: DataFrame, bodies: DataFrame, lengths: DataFrame, blocks: DataFrame | None = None, min_exon: int = MIN_EXON, max_exon: int = MAX_EXON, min_intron: int = MIN_INTRON) -> DataFrame:
    """Residual loci of recurrent unannotated junctions (node, chrom, strand, start, end and, if known, their counts).

    bodies: chrom, strand, start, end, gene_id, biotype; lengths: chrom, length. Contigs are compared by ``chrom_key``.
    Junctions that are short or touch a body go; the rest cluster. A cluster whose chain is on or near a gene goes.
    Terminals are stubs of TERMINAL bases, or as far as ``blocks`` cover them, never over a gene or the contig's end.
    What is left with fewer than two exons is degenerate and goes. Without bodies no locus is held against genes.
    Numbers go by junctions, support and samples, then place; stubs decide who gets one, walks come after.
    """
    named = lambda df: df.withColumn("chrom", chrom_key(F.col("chrom")))
    genes, ends = cut(named(bodies.select("chrom", "strand", "start", "end", "gene_id", "biotype"))), named(lengths.select("chrom", "length")).groupBy("chrom").agg(F.max("length").alias("length"))
    own = defaults(junctions).withColumns({"_chrom": F.col("chrom"), "chrom": chrom_key(F.col("chrom")), "strand": F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(".")})
    spelled = own.groupBy("chrom").agg(F.min("_chrom").alias("_chrom"))
    chosen = select_junctions(own.drop("_chrom"), genes.select("chrom", "start", "end"), min_intron)
    loci = cut(_off_genes(cut(chains(cut(chosen), genes, min_exon, max_exon)), genes).join(ends, "chrom", "left"))
    to_end = lambda c: F.coalesce(F.least(c, F.col("length")), c)
    stub = loci.withColumns({"left": F.greatest(F.lit(1).cast("long"), F.col("first") - TERMINAL), "right": to_end(F.col("last") + TERMINAL)})
    kept = rebuilt(clip_terminals(stub, genes)).where("n_exons >= 2")
    order = [F.col("n_junctions").desc(), F.col("treat_sum").desc(), F.col("treat_n_detected").desc(), F.col("chrom"), F.col("start"), F.col("end"), F.col("strand"), F.col("locus_id")]
    kept = cut(global_rank(kept, order, "rank").withColumn("residual_id", F.concat(F.lit("RSDL."), F.col("rank").cast("string"))))
    if blocks is not None:
        reach = walked(kept, named(blocks)).withColumnsRenamed({"left": "_l", "right": "_r"})
        wide = kept.join(reach, "locus_id").withColumns({"left": F.least(F.greatest(F.lit(1).cast("long"), F.col("first") - TERMINAL), F.coalesce("_l", F.col("first"))), "right": F.greatest(to_end(F.col("last") + TERMINAL), to_end(F.coalesce("_r", F.col("last"))))})
        kept = cut(rebuilt(clip_terminals(cut(wide.drop("_l", "_r")), genes)).where("n_exons >= 2"))
    told = _distances(kept, genes).join(spelled, "chrom").withColumn("chrom", F.col("_chrom"))
    return told.withColumns({"exon_structure": X.encode(F.col("exons")), "intron_structure": X.encode(F.col("chain")), "status": F.lit("unassembled")}).select(*COLUMNS)
