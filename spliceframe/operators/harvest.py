"""From alignments to residual loci: junction census, recurrence, selection, clustering, chains and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import reads as R
from .intervals import overlap_join
from .scans import joined, running, same
from .storage import cut

MIN_INTRON, MIN_EXON, MAX_EXON = 50, 30, 20000


def junction_reads(aln: DataFrame, min_mapq: int = 10, unique_only: bool = False) -> DataFrame:
    """A row for each distinct junction of each fragment that counts.

    Paired records count when both mates pass and are proper, once a fragment; unpaired ones each by itself.
    """
    ok = R.passes(F.col("flag"), F.col("mapq"), min_mapq)
    if unique_only:
        ok = ok & (F.coalesce("nh", F.lit(0)) == 1)
    paired = R.has(F.col("flag"), R.PAIRED)
    kept = aln.where(ok & (~paired | R.has(F.col("flag"), R.PROPER)))
    strand = F.coalesce(R.inferred_strand(F.col("flag"), F.col("library")), F.lit("."))
    # outer, as an inner explode filters by its array first and so computes it twice
    each = kept.where(F.col("cigar").contains("N")).select("sample_id", "grp", "qname", "chrom", strand.alias("strand"), paired.alias("_paired"), F.explode_outer(R.introns(F.col("pos"), F.col("cigar"))).alias("i")).where("i IS NOT NULL")
    each = each.select("sample_id", "grp", "qname", "chrom", "strand", F.col("i.s").alias("start"), F.col("i.e").alias("end"), "_paired")
    whole = kept.where(paired).groupBy("sample_id", "qname").agg(F.count(F.lit(1)).alias("_n")).where("_n = 2").select("sample_id", "qname")
    both = each.where("_paired").distinct().join(whole, ["sample_id", "qname"], "left_semi")
    return each.where("NOT _paired").unionByName(both).drop("qname", "_paired")


def census(junctions: DataFrame) -> DataFrame:
    """Reads of each junction in each sample."""
    return junctions.groupBy("sample_id", "grp", "chrom", "start", "end", "strand").agg(F.count(F.lit(1)).alias("n"))


def recurrence(counts: DataFrame, min_samples: int = 2, min_support: int = 2, max_control: int = 0, has_controls: bool = True) -> DataFrame:
    """Cohort sums of each junction that recurs, and its label: cohort if the sample sheet has no controls, else silent or shared."""
    control, treat = F.col("grp") == "control", F.col("grp") == "treat"
    out = counts.groupBy("chrom", "start", "end", "strand").agg(
        F.sum("n").alias("support_sum"),
        F.count(F.lit(1)).alias("n_detected"),
        F.coalesce(F.max(F.when(control, F.col("n"))), F.lit(0)).alias("control_max"),
        F.count_if(control).alias("control_n"),
        F.coalesce(F.sum(F.when(treat, F.col("n"))), F.lit(0)).alias("treat_sum"),
        F.count_if(treat).alias("treat_n"),
    )
    label = F.when(F.col("control_max") <= max_control, "silent").otherwise("shared") if has_controls else F.lit("cohort")
    return out.where((F.col("n_detected") >= min_samples) & (F.col("support_sum") >= min_support)).withColumn("cohort", label)


def without_known(junctions: DataFrame, known: DataFrame) -> DataFrame:
    """Junctions that are no annotated intron: on their own strand, or on either if theirs is unknown."""
    k = known.select(F.col("chrom").alias("k_chrom"), F.col("start").alias("k_start"), F.col("end").alias("k_end"), F.col("strand").alias("k_strand")).distinct()
    same = (F.col("chrom") == F.col("k_chrom")) & (F.col("start") == F.col("k_start")) & (F.col("end") == F.col("k_end"))
    return junctions.join(k, same & ((F.col("strand") == F.col("k_strand")) | (F.col("strand") == ".")), "left_anti")


def select_junctions(junctions: DataFrame, bodies: DataFrame, min_intron: int = MIN_INTRON) -> DataFrame:
    """Junctions long enough that touch no gene body on either strand."""
    return overlap_join(junctions.where(F.col("end") - F.col("start") + 1 >= min_intron), bodies, how="anti")


def components(nodes: DataFrame, bodies: DataFrame | None = None, min_exon: int = MIN_EXON, max_exon: int = MAX_EXON) -> DataFrame:
    """nodes with component, the least node of its locus on its chrom and strand.

    Two junctions belong together if they share a start or an end, overlap, or leave an exon of allowed length between
    them that no gene body blocks. Overlapping ones form islands. For a start the ends that leave it an exon are those
    in one range (up to min_exon before it; back to max_exon before it or the last body), so it is linked to the nearest
    of them alone, and neighbouring ends are one group where some start has both in its range. Ranges move along with
    the start, so the furthest start an end reaches decides. Islands and end groups, each at its place, are the labels
    that ``joined`` unites. Every step folds along the coordinate in blocks, over different places alone.
    """
    key = ["chrom", "strand"]
    none = F.lit(None).cast("long")
    starts = nodes.groupBy(*key, "start").agg(F.max("end").alias("top"))
    ends = nodes.select(*key, "end").distinct()
    own = nodes.select(*key).distinct()
    walls = None if bodies is None else own.join(bodies.select("chrom", F.col("start").alias("ws"), F.col("end").alias("we")), "chrom")

    def event(df: DataFrame, at: Column, **values: Column) -> DataFrame:
        return df.select(*key, at.cast("long").alias("at"), *[values.get(c, none).cast("long").alias(c) for c in ("start", "end", "top", "wall")])

    # forward: what reaches a start, the nearest end an exon away, the last body end before it
    seen = event(starts, F.col("start"), start=F.col("start")).unionByName(event(starts, F.col("start") + 1, top=F.col("top"))).unionByName(event(ends, F.col("end") + 1 + min_exon, end=F.col("end")))
    if walls is not None:
        seen = seen.unionByName(event(walls, F.col("ws") + 1, wall=F.col("we")))
    at_start = running(seen, key, "at", {"_reach": (F.col("top"), "max"), "_near": (F.col("end"), "max"), "_wall": (F.col("wall"), "max")}).where("start IS NOT NULL")
    lowest = F.greatest(F.col("start") - 1 - max_exon, F.coalesce(F.col("_wall"), F.col("start") - 1 - max_exon))
    fresh = F.when(F.coalesce(F.col("_reach") < F.col("start"), F.lit(True)), F.col("start"))
    linked = at_start.select(*key, "start", F.when(F.col("_near") >= lowest, F.col("_near")).alias("near"), fresh.alias("_fresh"))
    islands = cut(running(linked, key, "start", {"island": (F.col("_fresh"), "max")}).drop("_fresh"))

    # backward: the next end, and the first body that ends beyond an end
    seen = event(ends, F.col("end"), end=F.col("end"))
    if walls is not None:
        seen = seen.unionByName(event(walls, F.col("we"), wall=F.col("ws")))
    at_end = cut(running(seen, key, "at", {"_next": (F.col("end"), "min"), "_wall": (F.col("wall"), "min")}, backward=True, inclusive=False).where("end IS NOT NULL"))
    furthest = F.least(F.col("end") + 1 + max_exon, F.col("_wall"))
    asked = at_end.select(*key, furthest.alias("at"), "end", F.col("_next").alias("top"), none.alias("start"))
    answered = running(asked.unionByName(starts.select(*key, F.col("start").alias("at"), none.alias("end"), none.alias("top"), "start")), key, "at", {"_start": (F.col("start"), "max")}).where("end IS NOT NULL")
    last = F.when(~F.coalesce(F.col("_start") >= F.col("top") + 1 + min_exon, F.lit(False)), F.col("end"))
    groups = cut(running(answered.select(*key, "end", last.alias("_last")), key, "end", {"group": (F.col("_last"), "min")}, backward=True).drop("_last"))

    def named(df: DataFrame, by: str, at: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"k_{c}") for c in key], F.col(by).alias(f"k_{at}"), *[c for c in df.columns if c in ("island", "group")])

    def meet(df: DataFrame, other: DataFrame, at: str) -> DataFrame:
        return df.join(other, same(df, other, [*key, at])).drop(*[f"k_{c}" for c in (*key, at)])

    label = {"island": F.col("island") * 2, "group": F.col("group") * 2 + 1}
    placed = meet(meet(nodes.select(*key, "start", "end").distinct(), named(islands, "start", "start"), "start"), named(groups, "end", "end"), "end")
    over = meet(islands.where("near IS NOT NULL"), named(groups, "end", "near"), "near")
    edges = placed.select(*key, label["island"].alias("u"), label["group"].alias("v")).unionByName(over.select(*key, label["group"].alias("u"), label["island"].alias("v"))).distinct()
    united = joined(cut(edges), key)
    at = nodes.select("node", *key, "start")
    rooted = meet(at, named(islands, "start", "start"), "start").withColumn("label", F.col("island") * 2)
    roots = united.select(*[F.col(c).alias(f"k_{c}") for c in (*key, "label")], "component")
    rooted = rooted.join(roots, same(rooted, roots, [*key, "label"])).select("node", *key, F.col("component").alias("_root"))
    least = rooted.groupBy(*key, "_root").agg(F.min("node").alias("component")).withColumnsRenamed({c: f"k_{c}" for c in (*key, "_root")})
    return nodes.join(rooted.join(least, same(rooted, least, [*key, "_root"])).select("node", "component"), "node")


def greedy_chain(members: Column) -> Column:
    """The introns of a locus that fit side by side, best support first (ties by start and end), in order of place.

    members: array<struct<start, end, support>>.
    """
    ranked = F.array_sort(F.transform(members, lambda x: F.struct((-x["support"]).alias("o"), x["start"].alias("start"), x["end"].alias("end"))))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc, x):
        free = ~F.exists(acc, lambda y: (x["start"] <= y["end"]) & (y["start"] <= x["end"]))
        return F.when(free, F.concat(acc, F.array(F.struct(x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"))))).otherwise(acc)

    return F.array_sort(F.aggregate(ranked, empty, step))


def cluster_record(nodes: DataFrame) -> DataFrame:
    """Counts, span, sums and cohort of each component."""
    return nodes.groupBy("component").agg(
        F.first("chrom").alias("chrom"),
        F.first("strand").alias("strand"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.count(F.lit(1)).alias("n_junctions"),
        F.sum("support").alias("support_sum"),
        F.max("n_detected").cast("long").alias("n_detected"),
        F.max("control_max").alias("control_max"),
        F.when(F.max("control_max") > 0, "shared").otherwise("silent").alias("cohort"),
    )


def shared_sites(nodes: DataFrame) -> DataFrame:
    """How many junction starts and ends of a component are used more than once."""
    sites = nodes.select("component", F.explode(F.array(F.struct(F.lit("s").alias("side"), F.col("start").alias("at")), F.struct(F.lit("e").alias("side"), F.col("end").alias("at")))).alias("x"))
    return sites.groupBy("component", "x.side", "x.at").agg(F.count(F.lit(1)).alias("n")).groupBy("component").agg(F.count_if(F.col("n") > 1).alias("n_shared_site"))


def number_residuals(records: DataFrame) -> DataFrame:
    """residual_id RSDL.1, 2, ... by junctions, support and samples, then place.

    The ranks come from sorted ranges: a row's number within its range and the rows of the ranges before, so no task sorts all.
    """
    order = [F.col("n_junctions").desc(), F.col("support_sum").desc(), F.col("n_detected").desc(), F.col("chrom"), F.col("start"), F.col("end"), F.col("strand"), F.col("component")]
    return global_rank(records, order, "rank").withColumn("residual_id", F.concat(F.lit("RSDL."), F.col("rank").cast("string")))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with a row number by a total order, from range partitions; only a count for each range is gathered."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    ranged = cut(ranged.withColumn("_in", F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33) + 1))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_in")).drop("_part", "_at", "_in", "_before")
