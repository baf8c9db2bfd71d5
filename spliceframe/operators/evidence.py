"""Evidence for loci from outside: hits as JSON, structures as fixed-column text, which loci to fold, and what to tell of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import overlap_join

#: Limits of family and structure hits, hits kept, longest peptide that is folded anew. Fixed values.
FAMILY_EVALUE, STRUCTURE_EVALUE, STRUCTURE_PROB, TOP, FOLD_AA = 0.01, 1e-3, 0.5, 5, 400
_HIT = "struct<acc:string,name:string,desc:string,description:string,evalue:string,eval:string,prob:string,target:string>"


def hits(answers: DataFrame) -> DataFrame:
    """locus_id, acc, name, description, evalue and prob of every hit in answers (locus_id, body: JSON text).

    Hits may stand in a list by itself, or under hits, results or alignments, within each result too; numbers may be
    text. Bodies that aren't JSON, and hits without a number for e-value, give no rows.
    """
    nested = f"struct<hits:array<{_HIT}>,alignments:array<{_HIT}>>"
    parsed = answers.select(
        "locus_id",
        F.from_json("body", f"struct<hits:array<{_HIT}>,alignments:array<{_HIT}>,results:array<{nested}>>").alias("o"),
        F.from_json(F.when(F.trim("body").startswith("["), F.col("body")), f"array<{_HIT}>").alias("l"),
    )
    none = F.array().cast(f"array<{_HIT}>")
    inner = F.flatten(F.transform(F.coalesce("o.results", F.array().cast(f"array<{nested}>")), lambda r: F.concat(F.coalesce(r["hits"], none), F.coalesce(r["alignments"], none))))
    every = F.concat(F.coalesce("o.hits", none), F.coalesce("o.alignments", none), F.coalesce(inner, none), F.coalesce("l", none))
    h = parsed.select("locus_id", F.explode(F.filter(every, lambda x: x.isNotNull())).alias("h"))
    acc = F.regexp_replace(F.coalesce("h.acc", "h.target"), r"\.[0-9]+$", "")
    out = h.select("locus_id", acc.alias("acc"), F.coalesce("h.name", "h.target", "h.acc").alias("name"), F.coalesce("h.desc", "h.description").alias("description"), F.coalesce("h.evalue", "h.eval").try_cast("double").alias("evalue"), F.col("h.prob").try_cast("double").alias("prob"))
    return out.where(F.col("evalue").isNotNull() & ~F.isnan("evalue"))


def best_hits(found: DataFrame, evalue: float = FAMILY_EVALUE, prob: float | None = None, top: int = TOP) -> DataFrame:
    """Each locus's top hits with rank: e-value at most the limit, probability (of 1, or of 100) at least it; by e-value, then probability, accession and name."""
    share = F.when(F.col("prob") > 1, F.col("prob") / 100).otherwise(F.col("prob"))
    ok = F.col("evalue") <= evalue if prob is None else (F.col("evalue") <= evalue) & (share >= prob)
    w = Window.partitionBy("locus_id").orderBy("evalue", F.col("prob").desc_nulls_last(), "acc", "name")
    return found.where(ok).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def mean_plddt(atoms: DataFrame) -> DataFrame:
    """locus_id, n_ca and plddt: the mean temperature factor of its CA atoms, times 100 where none is over 1; null without any.

    atoms: locus_id, value: lines of a structure's text in fixed columns.
    """
    line = F.col("value")
    ca = line.startswith("ATOM") & (F.trim(F.substring(line, 13, 4)) == "CA")
    b = F.when(ca, F.trim(F.substring(line, 61, 6)).try_cast("double"))
    told = atoms.groupBy("locus_id").agg(F.count(b).alias("n_ca"), F.avg(b).alias("m"), F.max(b).alias("top"))
    return told.select("locus_id", "n_ca", F.when(F.col("top") <= 1, F.col("m") * 100).otherwise(F.col("m")).alias("plddt"))


def fold_route(named: Column, gene: Column, aa: Column, protein: Column) -> Column:
    """Where a locus's structure comes from: a known protein's model, a fold of its peptide, skipped if that is too long; null for other named loci."""
    fold = F.when(aa <= FOLD_AA, "fold").otherwise("skipped")
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return F.when((named == "protein_coding") & has(gene), F.when(has(protein), "model").otherwise(fold)).when(F.coalesce(named, F.lit("none")) == "none", fold)


def fold_plan(peptides: DataFrame, loci: DataFrame, listed: DataFrame, min_aa: int = 50) -> DataFrame:
    """locus_id, aa and route of listed loci whose peptide is long enough; peptides: locus_id, sequence; loci: locus_id, named_overlap, gene_id, protein_id.

    The longest peptide of a locus counts, of equal ones the least.
    """
    best = peptides.groupBy("locus_id").agg(F.min(F.struct((-F.length("sequence")).alias("n"), "sequence")).alias("b")).select("locus_id", F.length("b.sequence").alias("aa"))
    held = best.where(F.col("aa") >= min_aa).join(listed.select("locus_id").distinct(), "locus_id", "left_semi").join(loci, "locus_id")
    return held.select("locus_id", "aa", fold_route(F.col("named_overlap"), F.col("gene_id"), F.col("aa"), F.col("protein_id")).alias("route")).where("route IS NOT NULL")


def orphans(parts: list[DataFrame], ranked: DataFrame, top: int = 30, min_aa: int = 50) -> DataFrame:
    """Loci without a named overlap that are among the first ``top`` ranks and have a long enough reading frame; of parts the earliest that has a locus counts."""
    from .models import first_wins

    some = [p.select("locus_id", "named_overlap", "longest_orf_aa") for p in parts]
    told = first_wins(some, "locus_id")
    best = ranked.where(F.col("rank") <= top).select("locus_id").distinct()
    return told.where((F.coalesce(F.lower("named_overlap"), F.lit("none")).isin("none", "", "na", "nan")) & (F.col("longest_orf_aa") >= min_aa)).join(best, "locus_id", "left_semi")


def function_table(loci: DataFrame, curated: DataFrame, structures: DataFrame) -> DataFrame:
    """loci with curated text by gene and the first structure hit by locus; null where there is none. Repeated curated genes: the least text."""
    text = curated.groupBy("gene_id").agg(F.min("text").alias("curated"))
    first = best_hits(structures, STRUCTURE_EVALUE, STRUCTURE_PROB, 1).select("locus_id", F.col("name").alias("structure_hit"), F.col("description").alias("structure_description"))
    return loci.join(text, "gene_id", "left").join(first, "locus_id", "left")


def assemblies(loci: DataFrame, transcripts: DataFrame, unstranded: bool = False) -> DataFrame:
    """locus_id, sample_id, n_isoforms, max_cov, span_start, span_end and delta (the span's furthest edge from the locus's own) of each sample whose assembly touches a locus.

    loci: locus_id, chrom, strand, start, end; transcripts: sample_id, chrom, strand, start, end, cov. Strands must agree
    unless one of them is unknown or the library is unstranded. Null coverage counts as an isoform without one.
    """
    own = F.coalesce("strand", F.lit("."))
    hit = overlap_join(loci.select("locus_id", "chrom", own.alias("strand"), "start", "end"), transcripts.select("sample_id", "chrom", own.alias("strand"), "start", "end", "cov"))
    if not unstranded:
        hit = hit.where(F.col("strand").isin(".", "") | (F.col("r_strand") == ".") | (F.col("strand") == F.col("r_strand")))
    each = hit.groupBy("locus_id", F.col("r_sample_id").alias("sample_id")).agg(F.count(F.lit(1)).alias("n_isoforms"), F.max("r_cov").alias("max_cov"), F.min("r_start").alias("span_start"), F.max("r_end").alias("span_end"), F.first("start").alias("_s"), F.first("end").alias("_e"))
    return each.withColumn("delta", F.greatest(F.abs(F.col("span_start") - F.col("_s")), F.abs(F.col("span_end") - F.col("_e")))).drop("_s", "_e")


def assembly_summary(loci: DataFrame, found: DataFrame, sheet: DataFrame) -> DataFrame:
    """locus_id, assembled_in (samples in the sheet's order, comma-joined), n_control, n_treat and max_delta of every locus, of what ``assemblies`` found.

    sheet: sample_id, grp and row (its order). A locus that no sample assembled has an empty list, zeros and a null.
    """
    met = found.join(sheet.select("sample_id", "grp", "row"), "sample_id")
    each = met.groupBy("locus_id").agg(F.array_sort(F.collect_list(F.struct("row", "sample_id"))).alias("_in"), F.count_if(F.col("grp") == "control").alias("n_control"), F.count_if(F.col("grp") == "treat").alias("n_treat"), F.max("delta").alias("max_delta"))
    none = F.lit(0).cast("long")
    return loci.select("locus_id").join(each, "locus_id", "left").select("locus_id", F.coalesce(F.array_join(F.col("_in.sample_id"), ","), F.lit("")).alias("assembled_in"), F.coalesce("n_control", none).alias("n_control"), F.coalesce("n_treat", none).alias("n_treat"), "max_delta")
