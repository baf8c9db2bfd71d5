"""The structural and abundance gates over loci and their samples, and the table of candidates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gates import cascade


@dataclass(frozen=True)
class Thresholds:
    """Defaults are fixed values; ``valley_samples`` None asks for all detecting samples."""

    min_exons: int = 1
    min_length: int = 100
    canonical_splice: bool = True
    noncanonical_share: float = 0.0
    min_distance: int = 1000
    discontinuity: bool = True
    valley_mean: float = 1.0
    valley_ratio: float = 0.1
    valley_samples: int | None = 1
    reject_bridges: bool = True
    bridge_reads: int = 2
    control_tpm: float = 0.5
    detect_tpm: float = 0.1
    detecting_samples: int = 3
    median_tpm: float = 0.5
    repeat_share: float = 0.1


#: Columns of a candidate that come before those of each sample; padded where a stage didn't run. Fixed values.
COLUMNS = "locus_id transcript_id chrom start end strand n_exons length_nt splice_fraction nearest_distance valley_median gap_median control_max treat_median n_detected junction_support bridge_total gates_passed".split()
PADDED = {"lfc": "NA", "pvalue": "NA", "padj": "NA", "de_status": "NA", "orf_aa": "NA", "coding_label": "NA", "named_overlap": "none"}
PER_SAMPLE = ("junction_support", "bridge_read_count", "tpm", "count")


def median(values: Column) -> Column:
    """The mean of an array's middle values; null if it is empty."""
    v, n = F.array_sort(values), F.size(values)
    at = lambda k: F.get(v, k.cast("int"))
    return F.when(n > 0, (at(F.floor((n - 1) / F.lit(2))) + at(F.floor(n / F.lit(2)))) / 2)


def sample_states(loci: DataFrame, features: DataFrame, abundance: DataFrame, sheet: list[tuple[str, str]]) -> DataFrame:
    """locus_id, described, measured and s: one struct a sheet row, in the sheet's order, with what is known of the locus there.

    features: locus_id, sample_id, valley_possible, valley_mean, gap_mean_depth, locus_mean_depth, bridge_read_count,
    junction_support (array<long>). abundance: locus_id, sample_id, tpm, count. The first row of a sample counts where
    one repeats (least by values). A locus's array is as long as the sheet; means and tpm are rounded to 6 places.
    """
    ids = loci.select("locus_id").distinct()
    r = lambda c: F.round(F.col(c).cast("double"), 6).alias(c)
    told = F.struct("valley_possible", r("valley_mean"), r("gap_mean_depth"), r("locus_mean_depth"), F.col("bridge_read_count").cast("long").alias("bridge_read_count"), "junction_support")
    a = features.groupBy("locus_id", "sample_id").agg(F.min(told).alias("f"))
    b = abundance.groupBy("locus_id", "sample_id").agg(F.min(F.struct(r("tpm"), F.col("count").cast("double").alias("count"))).alias("t"))
    both = a.join(b, ["locus_id", "sample_id"], "full").join(ids, "locus_id", "left_semi")
    held = both.groupBy("locus_id").agg(F.map_from_entries(F.collect_list(F.struct("sample_id", F.struct("f", "t")))).alias("m"), F.count("f").alias("_f"), F.count("t").alias("_t"))
    one = lambda s, g: F.struct(F.lit(s).alias("sample_id"), F.lit(g).alias("grp"), F.coalesce(F.col("m")[s]["t"]["tpm"], F.lit(0.0)).alias("tpm"), F.col("m")[s]["t"]["count"].alias("count"), F.col("m")[s]["f"].alias("f"))
    return ids.join(held, "locus_id", "left").select("locus_id", (F.coalesce("_f", F.lit(0)) > 0).alias("described"), (F.coalesce("_t", F.lit(0)) > 0).alias("measured"), F.array(*[one(s, g) for s, g in sheet]).alias("s"))


def added(vectors: Column) -> Column:
    """Sums of an array of arrays by place, null if there are none; vectors of unlike length are an error."""

    def add(total: Column, v: Column) -> Column:
        unlike = F.size(total) != F.size(v)
        whole = F.zip_with(total, v, lambda x, y: x + y)
        return F.when(unlike, F.raise_error(F.lit("junction support of unlike length across samples")).cast("array<bigint>")).otherwise(whole)

    rest = F.slice(vectors, F.lit(2), F.greatest(F.size(vectors), F.lit(1)))
    return F.when(F.size(vectors) > 0, F.aggregate(rest, F.get(vectors, F.lit(0)).cast("array<bigint>"), lambda t, v: add(t, v.cast("array<bigint>"))))


def gate_loci(loci: DataFrame, features: DataFrame, abundance: DataFrame, sheet: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """loci with their measures over samples, gates_passed, failed_gate and outcome: candidate, unnamed or dropped.

    loci: one row a locus with n_exons, length_nt, n_introns, splice_fraction, has_nearest, nearest_distance (on either
    strand in unstranded libraries) and, if they apply, structure_error and repeat_share. Detecting samples are treated
    ones (all, without a contrast of control and treat) of enough TPM. Discontinuity: enough detecting samples whose
    valley and gap are both under the lesser of a mean and a share of the locus's depth. A locus seen in controls is
    unnamed before replicates, median and repeats are asked. A locus without a TPM row, with a nearest gene but no
    distance, or with supports of unlike length is an error once its gate is reached. The sheet is a handful of rows.
    """
    rows = [(r["sample_id"], r["grp"] or "") for r in sheet.select("sample_id", "grp").orderBy("sample_id").collect()]
    contrast = {"control", "treat"} <= {g for _, g in rows}
    has = lambda c, other: F.col(c) if c in loci.columns else other
    x = loci.join(sample_states(loci, features, abundance, rows), "locus_id")
    s = F.col("s")
    counted = F.filter(s, lambda v: v["grp"] == "treat") if contrast else s
    x = x.withColumn("_detecting", F.filter(counted, lambda v: v["tpm"] >= limits.detect_tpm))
    detecting = F.col("_detecting")
    x = x.withColumn("_valleys", F.filter(detecting, lambda v: F.coalesce(v["f"]["valley_possible"], F.lit(False)) & v["f"]["valley_mean"].isNotNull() & v["f"]["gap_mean_depth"].isNotNull() & v["f"]["locus_mean_depth"].isNotNull()))
    limit = lambda v: F.least(F.lit(limits.valley_mean), limits.valley_ratio * v["f"]["locus_mean_depth"])
    empty = F.size(F.filter("_valleys", lambda v: (v["f"]["valley_mean"] <= limit(v)) & (v["f"]["gap_mean_depth"] <= limit(v))))
    near = F.coalesce(F.col("has_nearest"), F.lit(False))
    x = x.withColumns(
        {
            "valley_median": median(F.transform("_valleys", lambda v: v["f"]["valley_mean"])),
            "gap_median": median(F.transform("_valleys", lambda v: v["f"]["gap_mean_depth"])),
            "bridge_total": F.aggregate(detecting, F.lit(0).cast("long"), lambda n, v: n + F.coalesce(v["f"]["bridge_read_count"], F.lit(0))),
            "junction_support": added(F.filter(F.transform(detecting, lambda v: v["f"]["junction_support"]), lambda j: F.coalesce(F.size(j) > 0, F.lit(False)))),
            "control_max": F.coalesce(F.array_max(F.transform(F.filter(s, lambda v: v["grp"] == "control"), lambda v: v["tpm"])), F.lit(0.0)),
            "treat_median": median(F.transform(counted, lambda v: v["tpm"])),
            "n_detected": F.size(detecting),
            "_empty": empty,
        }
    )
    need = F.size(detecting) if limits.valley_samples is None else F.lit(limits.valley_samples)
    apart = F.col("described") & (F.size(detecting) > 0) & (F.col("_empty") >= need) if limits.discontinuity else F.lit(True)
    known = F.when(F.col("nearest_distance").isNull(), F.raise_error(F.concat(F.lit("no distance to the nearest gene of "), "locus_id")).cast("boolean")).otherwise(F.col("nearest_distance") >= limits.min_distance)
    measured = F.when(F.col("measured"), True).otherwise(F.raise_error(F.concat(F.lit("no TPM of "), "locus_id")).cast("boolean"))
    spliced = F.coalesce(F.col("splice_fraction"), F.lit(0.0)) >= 1 - limits.noncanonical_share
    introns = F.col("n_introns") > 0
    never = F.lit(False)
    tests = [
        ("structure", measured & (F.trim(F.coalesce(has("structure_error", F.lit("")), F.lit(""))) == ""), never),
        ("class", F.lit(True)),
        ("min_exons", F.col("n_exons") >= limits.min_exons),
        ("transcript_min_nt", F.col("length_nt") >= limits.min_length),
        ("canonical_splice", ~introns | spliced if limits.canonical_splice else F.lit(True), introns),
        ("distance", F.when(near, known).otherwise(True)),
        ("discontinuity", ~near | apart),
        ("no_bridge", ~(near & (F.size(detecting) > 0) & (F.col("bridge_total") >= limits.bridge_reads)) if limits.reject_bridges else F.lit(True), F.lit(limits.reject_bridges)),
    ]
    if contrast:
        tests += [("control", F.col("control_max") < limits.control_tpm, never), ("replicates", F.col("n_detected") >= limits.detecting_samples, never), ("treat_median", F.col("treat_median") >= limits.median_tpm, never)]
    if "repeat_share" in loci.columns:
        tests.append(("rmsk", F.col("repeat_share") < limits.repeat_share))
    tests.append(("detect", F.lit(True)))
    out = cascade(x, tests)
    outcome = F.when(F.col("failed_gate").isNull(), "candidate").when(F.col("failed_gate") == "control", "unnamed").otherwise("dropped")
    return out.withColumn("outcome", outcome).drop("_detecting", "_valleys", "_empty", "described", "measured")


def candidate_table(gated: DataFrame, sheet: DataFrame) -> DataFrame:
    """A row a locus for a sink: the fixed columns, four of each sample, padding where a stage left none, then what else there is.

    Lists become comma-joined text. What is null stays null; a writer tells it as NA.
    """
    names = [r["sample_id"] for r in sheet.select("sample_id").distinct().orderBy("sample_id").collect()]
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")
    of = lambda n, f: F.element_at(F.filter("s", lambda v: v["sample_id"] == n), 1)[f] if f in ("tpm", "count") else F.element_at(F.filter("s", lambda v: v["sample_id"] == n), 1)["f"][f]
    fixed = [(text(F.col(c)) if c == "junction_support" else F.col(c) if c in gated.columns else F.lit(None).cast("string")).alias(c) for c in COLUMNS]
    padded = [(F.col(c) if c in gated.columns else F.lit(v)).alias(c) for c, v in PADDED.items()]
    wide = [(text(of(n, f)) if f == "junction_support" else of(n, f)).alias(f"{n}_{f}") for n in names for f in PER_SAMPLE]
    made = {*COLUMNS, *PADDED, *[f"{n}_{f}" for n in names for f in PER_SAMPLE], "s", "failed_gate", "outcome"}
    return gated.withColumn("s", F.filter("s", lambda v: v["sample_id"].isNotNull())).select(*fixed, *padded, *wide, *[c for c in gated.columns if c not in made])
