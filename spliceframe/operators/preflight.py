"""Checks before a run, each a query for its offenders: rank, check, sample_id, detail. No rows: nothing is wrong."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import reads as R
from ..functions.headers import aligner_family

#: Share of primary mapped reads from which a kind counts as there. A fixed value.
MIXED = 0.01
GROUPS, LIBRARIES, LAYOUTS = ("control", "treat"), ("unstranded", "fr", "rf"), ("auto", "paired", "single")


def _offence(df: DataFrame, rank: int, check: str, detail: Column, sample: Column | None = None) -> DataFrame:
    return df.select(F.lit(rank).alias("rank"), F.lit(check).alias("check"), (F.lit(None).cast("string") if sample is None else sample.cast("string")).alias("sample_id"), detail.cast("string").alias("detail"))


def sheet_checks(sheet: DataFrame, differential: bool = True) -> DataFrame:
    """An empty sheet, empty or repeated ids, unknown groups or libraries, fewer than two samples, several libraries, too few replicates."""
    sid, group = F.col("sample_id"), F.coalesce(F.col("grp"), F.lit(""))
    whole = sheet.agg(F.count(F.lit(1)).alias("n"), F.count_if(group == "control").alias("c"), F.count_if(group == "treat").alias("t"), F.array_join(F.array_sort(F.collect_set("strandedness")), ",").alias("libraries"), F.count_distinct("strandedness").alias("k"))
    found = [
        _offence(whole.where("n = 0"), 1, "sheet_empty", F.lit("sample sheet is empty")),
        _offence(sheet.where(F.coalesce(F.trim(sid), F.lit("")) == ""), 2, "sample_id", F.lit("sample_id is empty")),
        _offence(sheet.where(sid.isNotNull()).groupBy("sample_id").count().where("count > 1"), 3, "sample_repeated", F.concat(F.col("count").cast("string"), F.lit(" rows")), sid),
        _offence(sheet.where(~group.isin("", *GROUPS)), 4, "group", group, sid),
        _offence(sheet.where(~F.coalesce(F.col("strandedness").isin(*LIBRARIES), F.lit(False))), 5, "strandedness", F.coalesce("strandedness", F.lit("")), sid),
        _offence(whole.where("n = 1"), 6, "samples", F.lit("2 samples are needed")),
        _offence(whole.where("k > 1"), 7, "strandedness_mixed", F.col("libraries")),
    ]
    if differential:
        found.append(_offence(whole.where("n > 0 AND (c < 2 OR t < 2)"), 8, "replicates", F.concat(F.lit("control="), F.col("c").cast("string"), F.lit(" treat="), F.col("t").cast("string"))))
    return reduce(DataFrame.unionAll, found)


def file_checks(probe: DataFrame) -> DataFrame:
    """Files that aren't there, don't begin or end as blocked gzip, or lack an index (of ``bam_probe``)."""
    sid, path = F.col("sample_id"), F.col("path")
    tests = [(10, "missing", ~F.col("found")), (11, "not_blocked_gzip", F.col("found") & ~F.col("head")), (12, "truncated", F.col("found") & F.col("head") & ~F.col("tail")), (13, "no_index", F.col("found") & ~F.col("indexed"))]
    return reduce(DataFrame.unionAll, [_offence(probe.where(bad), rank, check, path, sid) for rank, check, bad in tests])


def _references(header: DataFrame) -> DataFrame:
    return header.where("kind = 'SQ'").select("sample_id", F.col("tags")["SN"].alias("chrom"), F.col("tags")["LN"].try_cast("long").alias("length"))


def contig_checks(header: DataFrame, lengths: DataFrame) -> DataFrame:
    """Samples without references, references the genome (chrom, length) lacks or has at another length, samples unlike most others."""
    held, sid = _references(header), F.col("sample_id")
    none = header.select("sample_id").distinct().join(held.select("sample_id").distinct(), "sample_id", "left_anti")
    met = held.join(lengths.select("chrom", F.col("length").alias("own"), F.lit(True).alias("known")), "chrom", "left")
    lists = held.groupBy("sample_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "chrom", F.col("length").cast("string")))), ","), 256).alias("digest"))
    usual = lists.groupBy("digest").count().orderBy(F.col("count").desc(), "digest").limit(1).select(F.col("digest").alias("usual"))
    return reduce(
        DataFrame.unionAll,
        [
            _offence(none, 20, "no_references", F.lit("no @SQ"), sid),
            _offence(met.where("known IS NULL"), 21, "contig_unknown", F.col("chrom"), sid),
            _offence(met.where("known AND NOT (length <=> own)"), 22, "contig_length", F.concat_ws(" ", F.col("chrom"), F.concat(F.lit("LN="), F.col("length").cast("string")), F.concat(F.lit("genome="), F.col("own").cast("string"))), sid),
            _offence(lists.join(F.broadcast(usual)).where("digest <> usual"), 23, "references_differ", F.col("digest"), sid),
        ],
    )


def order_breaks(reads: DataFrame) -> DataFrame:
    """sample_id and split of each place where records go back: within a split, or from one split's last record to the next one's first.

    reads: split, row, tid, pos and ordered as the source gives them. A split is one row of a partial aggregation, so
    the borders are compared over a row a split.
    """
    key = F.struct(F.when(F.col("tid") < 0, F.lit(1 << 31)).otherwise(F.col("tid")).cast("long").alias("t"), F.col("pos").alias("p"))
    splits = reads.groupBy("sample_id", "split").agg(F.count_if(~F.col("ordered")).alias("inside"), F.min_by(key, "row").alias("first"), F.max_by(key, "row").alias("last"))
    before = splits.withColumn("ahead", F.lag("last").over(Window.partitionBy("sample_id").orderBy("split")))
    return before.where("inside > 0 OR first < ahead").select("sample_id", "split", "inside", F.coalesce(F.col("first") < F.col("ahead"), F.lit(False)).alias("border"))


def order_checks(header: DataFrame, reads: DataFrame) -> DataFrame:
    """Samples neither declared nor found sorted by coordinate."""
    declared = header.where("kind = 'HD'").where(F.col("tags")["SO"] == "coordinate").select("sample_id").distinct()
    broken = order_breaks(reads).groupBy("sample_id").agg(F.sum(F.col("inside") + F.col("border").cast("long")).alias("n")).join(declared, "sample_id", "left_anti")
    return _offence(broken, 30, "unsorted", F.concat(F.col("n").cast("string"), F.lit(" records go back")), F.col("sample_id"))


def sample_families(header: DataFrame) -> DataFrame:
    """sample_id, families: those of its program lines that aren't tools."""
    lines = header.where("kind = 'PG'").select("sample_id", aligner_family(F.concat_ws(" ", F.col("tags")["ID"], F.col("tags")["PN"])).alias("family"))
    return header.select("sample_id").distinct().join(lines, "sample_id", "left").groupBy("sample_id").agg(F.array_sort(F.collect_set("family")).alias("families"))


def aligner_checks(header: DataFrame) -> DataFrame:
    """Samples without an aligner, with a forbidden one, or whose families aren't one accepted one; and a mix over samples."""
    each, sid = sample_families(header), F.col("sample_id")
    accepted = F.filter("families", lambda f: f.isin("STAR", "HISAT2"))
    forbidden = F.array_contains("families", "forbidden")
    named = F.array_join("families", ",")
    mixed = each.select(F.explode(accepted).alias("f")).agg(F.array_join(F.array_sort(F.collect_set("f")), ",").alias("all"), F.count_distinct("f").alias("n")).where("n > 1")
    return reduce(
        DataFrame.unionAll,
        [
            _offence(each.where(forbidden), 31, "aligner_forbidden", named, sid),
            _offence(each.where(~forbidden & (F.size(accepted) != 1)), 32, "aligner", F.when(named == "", "no aligner").otherwise(named), sid),
            _offence(mixed, 40, "aligners_mixed", F.col("all")),
        ],
    )


def layouts(reads: DataFrame) -> DataFrame:
    """Of each sample's primary mapped reads how many are paired and single, whether both are over MIXED, and whether one is marked duplicate."""
    primary = reads.where(~R.has(F.col("flag"), R.UNMAPPED | R.SECONDARY | R.SUPPLEMENTARY))
    paired = R.has(F.col("flag"), R.PAIRED)
    counted = primary.groupBy("sample_id").agg(F.count_if(paired).alias("n_paired"), F.count_if(~paired).alias("n_single"), (F.count_if(R.has(F.col("flag"), R.DUPLICATE)) > 0).alias("duplicates_seen"))
    n = F.col("n_paired") + F.col("n_single")
    return counted.withColumns({"mixed": (F.col("n_paired") > MIXED * n) & (F.col("n_single") > MIXED * n), "layout": F.when(F.col("n_paired") >= F.col("n_single"), "paired").otherwise("single")})


def layout_checks(reads: DataFrame, layout: str = "auto") -> DataFrame:
    """Samples that mix layouts or aren't of the one asked for, and a mix over samples."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    each, sid = layouts(reads), F.col("sample_id")
    found = [
        _offence(each.where("mixed"), 33, "layout_mixed", F.concat_ws(" ", F.concat(F.lit("paired="), F.col("n_paired").cast("string")), F.concat(F.lit("single="), F.col("n_single").cast("string"))), sid),
        _offence(each.agg(F.count_distinct("layout").alias("n")).where("n > 1"), 41, "layouts_differ", F.lit("paired,single")),
    ]
    if layout != "auto":
        found.append(_offence(each.where(F.col("layout") != layout), 34, "layout", F.col("layout"), sid))
    return reduce(DataFrame.unionAll, found)


def annotation_checks(models: DataFrame, header: DataFrame) -> DataFrame:
    """Contigs of the models that no sample has; where none is shared but for a chr prefix, that alone."""
    names = models.select("chrom").where("chrom IS NOT NULL").distinct()
    held = _references(header).select("chrom").distinct()
    bare = lambda df: df.select(F.regexp_replace("chrom", "^chr", "").alias("bare")).distinct()
    counts = names.agg(F.count(F.lit(1)).alias("n"))
    shared = names.join(held, "chrom", "left_semi").agg(F.count(F.lit(1)).alias("shared"))
    alike = bare(names).join(bare(held), "bare", "left_semi").agg(F.count(F.lit(1)).alias("alike"))
    verdict = counts.join(F.broadcast(shared)).join(F.broadcast(alike))
    prefix = verdict.where("shared = 0 AND alike > 0")
    extra = names.join(held, "chrom", "left_anti").join(F.broadcast(prefix.select(F.lit(1).alias("p"))), F.lit(True), "left_anti")
    return _offence(prefix, 50, "chr_prefix", F.lit("contigs differ by a chr prefix")).unionAll(_offence(extra, 51, "contig_without_reads", F.col("chrom"))).unionAll(_offence(counts.where("n = 0"), 52, "annotation_empty", F.lit("no contig in the annotation")))


def preflight(sheet: DataFrame, probe: DataFrame, header: DataFrame, reads: DataFrame, lengths: DataFrame, models: DataFrame, layout: str = "auto", differential: bool = True) -> DataFrame:
    """Every offender of every check in one table."""
    parts = [sheet_checks(sheet, differential), file_checks(probe), contig_checks(header, lengths), order_checks(header, reads), aligner_checks(header), layout_checks(reads, layout), annotation_checks(models, header)]
    return reduce(DataFrame.unionAll, parts)


def first_failure(offenders: DataFrame) -> str | None:
    """The offender that counts: least rank, then sample; None if all is well."""
    row = offenders.orderBy("rank", "sample_id", "detail").limit(1).collect()
    return ": ".join(x for x in (row[0]["sample_id"], row[0]["check"], row[0]["detail"]) if x) if row else None


def require(offenders: DataFrame) -> None:
    failure = first_failure(offenders)
    if failure is not None:
        raise ValueError(failure)


def duplicate_policy(reads: DataFrame, policy: str = "auto") -> DataFrame:
    """reads with skip_duplicates: always, never, or auto, where the sample has marked ones (a row a sample, broadcast)."""
    if policy not in ("always", "never", "auto"):
        raise ValueError(f"skip_duplicate must be always, never or auto, not {policy!r}")
    if policy != "auto":
        return reads.withColumn("skip_duplicates", F.lit(policy == "always"))
    return reads.join(F.broadcast(layouts(reads).select("sample_id", F.col("duplicates_seen").alias("skip_duplicates"))), "sample_id", "left").fillna(False, ["skip_duplicates"])
