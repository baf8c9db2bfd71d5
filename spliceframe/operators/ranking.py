"""The two-stage gene score and evidence filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of chromosome classes and of repeat and processed families. Fixed values.
PRIMARY = r"(?i)^chr([1-9]|1[0-9]|2[0-2]|[XY])$"
UNPLACED = r"(?i)^(GL|JH|KB|KQ|KI|MU|chrUn|Un_|NW_|NT_)"
TRANSPOSON = r"(?i)gag|pol\b|rve|rnase[_ ]?h|mlvin|integrase|rvt|ltr|erv\b|transpos|dde_tnp|retrovir|tlv_|capsid|\bcoat\b"
PROCESSED = r"(?i)atp.?synt|mt_atp|cox[1-3]?\b|cytochrom|nadh_dehydro|ef-hand|aif-1|globin|histone|ubiquitin|gapdh|actin"


def chrom_class(chrom: Column) -> Column:
    """primary, chrY (a bare y), unplaced (by its prefix, or any other name without chr) or other."""
    bare = (chrom != "") & ~F.lower(chrom).startswith("chr")
    return F.when(chrom.rlike(PRIMARY), "primary").when(F.lower(chrom) == "y", "chrY").when(chrom.rlike(UNPLACED) | bare, "unplaced").otherwise("other")


def junction_min(text: Column) -> Column:
    """Least whole number of a list with commas or semicolons; junk is skipped, none is null."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[,;]"), lambda x: F.trim(x)), lambda x: x.rlike("^-?[0-9]+$"))
    return F.array_min(F.transform(parts, lambda x: x.try_cast("long")))


def stage_one(df: DataFrame) -> DataFrame:
    """df with score and gene_flags from chrom, n_exons, junction_support, length_nt, start, end, longest_orf_aa,
    orf_complete, coding_label, coding_score, nearest_distance_bp, nearest_any_distance_bp and treat_n_detected.

    Missing exons count as one; other missing values earn nothing.
    """
    c = lambda n: F.col(n)
    exons, support = F.coalesce(c("n_exons"), F.lit(1)), junction_min(c("junction_support"))
    kind = chrom_class(c("chrom"))
    span = F.when(c("end") < c("start"), c("length_nt")).otherwise(c("end") - c("start") + 1)
    orf = F.coalesce(c("longest_orf_aa"), F.lit(0))
    mega, wide = (span > 100_000) & (exons < 5), (span > 50_000) & (exons <= 2)
    rules: list[tuple[Column, Column | float, str | None]] = [
        (kind == "primary", 20.0, None),
        (kind == "chrY", 5.0, "chrY"),
        (~kind.isin("primary", "chrY"), -40.0, "unplaced"),
        (exons >= 3, 25.0, None),
        (exons == 2, 12.0, None),
        (exons < 2, 0.0, "monoexon"),
        ((exons >= 2) & support.isNull(), -8.0, "splice_unknown"),
        ((exons >= 2) & (support >= 2), 15.0, None),
        ((exons >= 2) & (support == 1), 5.0, "weak_splice"),
        ((exons >= 2) & (support < 1), -25.0, "no_splice"),
        (c("length_nt").between(200, 4000), 8.0, None),
        (c("length_nt") > 8000, -8.0, "long_rna"),
        (mega, -20.0, "mega_span"),
        (~mega & wide, -10.0, "wide_span"),
        (orf >= 50, F.least(F.lit(20.0), orf / 20.0) + F.when(c("orf_complete"), 4.0).otherwise(0.0), None),
        (orf < 50, 0.0, "no_orf"),
        ((c("coding_label") == "coding") & (c("coding_score") > 0), 15.0, None),
        (~((c("coding_label") == "coding") & (c("coding_score") > 0)) & (c("coding_score") > 0), 8.0, None),
        (c("coding_score") < -0.3, -5.0, None),
        (c("nearest_distance_bp") >= 5000, F.least(F.lit(10.0), F.log10(c("nearest_distance_bp") + 1.0)), None),
        ((c("nearest_any_distance_bp") > 0) & (c("nearest_any_distance_bp") < 200), -8.0, "close_any"),
        (c("treat_n_detected") >= 5, 5.0, None),
    ]
    score, flags = F.lit(0.0), []
    for test, points, flag in rules:
        score = score + F.when(test, points).otherwise(0.0)
        if flag:
            flags.append(F.when(test, F.lit(flag)))
    return df.withColumns({"score": F.round(score, 6), "gene_flags": F.array_join(F.array_compact(F.array(*flags)), ",")})


def stage_two(df: DataFrame) -> DataFrame:
    """df (score, n_exons, pfam, phylop, and pfam_desc if there) with score2 and flag2: transposons and processed copies lose.

    Missing exons count as one.
    """
    words = F.concat_ws(" ", "pfam", *[c for c in df.columns if c == "pfam_desc"])
    te, single = words.rlike(TRANSPOSON), F.coalesce("n_exons", F.lit(1)) == 1
    processed = ~te & single & words.rlike(PROCESSED)
    like = ~te & ~processed & single & F.coalesce((F.col("phylop") >= 1.5) & (F.col("pfam") != ""), F.lit(False))
    loss = F.when(te, -50.0).when(processed, F.when(F.col("phylop") >= 0.8, -38.0).otherwise(-30.0)).when(like, -12.0).otherwise(0.0)
    flag = F.when(te, "te").when(processed, "processed").when(like, "processed_like").otherwise("")
    return df.withColumns({"score2": F.round(F.col("score") + loss, 6), "flag2": flag})


def top_hits(hits: DataFrame, key: str, max_evalue: float = 0.01, n: int = 5) -> DataFrame:
    """Each key's n best hits by evalue, then accession (its version dropped), as an array.

    Kept by a bounded heap of n in partial aggregation, not by a window over all of a key's hits.
    """
    good = hits.where(F.col("evalue") <= max_evalue).select(key, F.struct("evalue", F.regexp_replace("accession", r"\.[0-9]+$", "").alias("accession")).alias("h"))
    salted = good.withColumn("_salt", F.pmod(F.xxhash64("h"), F.lit(16)))
    some = salted.groupBy(key, "_salt").agg(F.slice(F.array_sort(F.collect_set("h")), 1, n).alias("h"))
    return some.groupBy(key).agg(F.slice(F.array_sort(F.flatten(F.collect_list("h"))), 1, n).alias("hits"))
