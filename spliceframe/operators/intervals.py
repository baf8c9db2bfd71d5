"""Joins of closed intervals by equality of bins, and nearest features by windows over bounded blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bases of a bin; near the length of the shorter side's features.
BIN = 1024
#: Bases of a block of the nearest-feature windows: a group holds one block's features, never a chromosome's.
BLOCK = 1 << 18


def gap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Bases strictly between two intervals; 0 if they overlap or touch."""
    return F.greatest(F.lit(0).cast("long"), b_start - a_end - 1, a_start - b_end - 1)


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start <= b_end) & (b_start <= a_end)


def clip(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every row of df with start and end clipped to 1 and its own chrom's length; where that is unknown, to 1 alone.

    ``lengths`` has one row (chrom, length) a contig.
    """
    known = df.join(F.broadcast(lengths.select("chrom", F.col("length").alias("_length"))), "chrom", "left")
    one = lambda c: F.least(F.greatest(F.lit(1).cast("long"), F.col(c)), F.col("_length")).alias(c)
    return known.select(*[one(c) if c in ("start", "end") else c for c in df.columns])


def _binned(df: DataFrame, start: Column, end: Column, width: int) -> DataFrame:
    of = lambda c: F.floor(c / F.lit(width)).cast("long")
    return df.withColumns({"_s": start, "_e": end}).withColumn("_bin", F.explode(F.sequence(of(F.col("_s")), of(F.col("_e")))))


def overlap_join(left: DataFrame, right: DataFrame, width: int = BIN, pad: int = 0, how: str = "inner") -> DataFrame:
    """Pairs of rows on one chrom whose [start, end] overlap, right columns prefixed ``r_``; pad > 0 lets up to pad bases lie between.

    Both sides go to every bin they touch and meet by (chrom, bin); a pair is kept in its first common bin alone. Hot
    bins are split by adaptive execution. how: inner, or semi or anti for left rows with or without a partner.
    """
    a = _binned(left, F.col("start") - pad, F.col("end") + pad, width)
    b = _binned(right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]), F.col("r_start"), F.col("r_end"), width).withColumnsRenamed({"_s": "_rs", "_e": "_re", "_bin": "_rbin"})
    on = (F.col("chrom") == F.col("r_chrom")) & (F.col("_bin") == F.col("_rbin")) & (F.col("_s") <= F.col("_re")) & (F.col("_rs") <= F.col("_e"))
    if how == "inner":
        first = F.col("_bin") == F.floor(F.greatest("_s", "_rs") / F.lit(width))
        return a.join(b, on & first).drop("_s", "_e", "_bin", "_rs", "_re", "_rbin")
    # whether a row has a partner hangs on its place alone, so places are met once and rows follow theirs
    place = F.struct("chrom", "start", "end")
    places = left.select("chrom", "start", "end", place.alias("_row")).distinct()
    hit = _binned(places, F.col("start") - pad, F.col("end") + pad, width).join(b, on, "left_semi").select("_row").distinct()
    return left.withColumn("_row", place).join(hit, "_row", f"left_{how}").drop("_row")


def _toward(loci: DataFrame, bodies: DataFrame, key: list[str], side: str) -> DataFrame:
    """locus row id and the nearest body that ends before it (left) or starts after it (right).

    Loci and bodies are merged by place within (key, block); a locus takes the last body before it in its block, or
    what the block inherits: the last body of the earlier blocks, by a window over one row a block.
    """
    sign = 1 if side == "left" else -1
    body = F.struct(F.col("end" if side == "left" else "start").alias("at"), F.col("gene_id"), F.col("start"), F.col("end"))
    place = (F.col("end") if side == "left" else -F.col("start")).cast("long")
    b = bodies.select(*key, place.alias("_p"), F.lit(0).alias("_kind"), F.lit(None).cast(loci.schema["_row"].dataType).alias("_row"), body.alias("_body"), F.struct(place.alias("p"), F.col("gene_id").alias("g")).alias("_order"))
    here = (F.col("start") - 1 if sign > 0 else -(F.col("end") + 1)).cast("long")
    a = loci.select(*key, here.alias("_p"), F.lit(1).alias("_kind"), "_row", F.lit(None).cast(b.schema["_body"].dataType).alias("_body"), F.struct(here.alias("p"), F.lit("").alias("g")).alias("_order"))
    both = a.unionByName(b).withColumn("_block", F.floor(F.col("_p") / F.lit(BLOCK)))
    # of bodies at one place the least id is nearest, so it comes last
    within = Window.partitionBy(*key, "_block").orderBy("_p", "_kind", F.col("_order.g").desc())
    near = both.withColumn("_near", F.last("_body", ignorenulls=True).over(within))
    ends = b.withColumn("_block", F.floor(F.col("_p") / F.lit(BLOCK))).groupBy(*key, "_block").agg(F.max("_p").alias("_top"))
    best = b.withColumn("_block", F.floor(F.col("_p") / F.lit(BLOCK))).join(ends, [*key, "_block"]).where("_p = _top").groupBy(*key, "_block").agg(F.min_by("_body", "_order.g").alias("_last"))
    blocks = both.select(*key, "_block").distinct().join(best, [*key, "_block"], "left")
    carried = blocks.withColumn("_carry", F.last("_last", ignorenulls=True).over(Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))).drop("_last")
    return near.where("_kind = 1").join(carried, [*key, "_block"], "left").select("_row", F.coalesce("_near", "_carry").alias("_body"))


def _nearest(places: DataFrame, bodies: DataFrame, keys: list[str], width: int) -> DataFrame:
    """_row and n (distance, gene_id) of the nearest body of each place; a place may stand on several keys.

    places: the keys and _row, a struct with start and end among its fields. bodies: the keys, start, end, gene_id.
    """
    loci = places.select("_row", *keys, F.col("_row.start").alias("start"), F.col("_row.end").alias("end"))
    hit = overlap_join(loci, bodies, width)
    for k in keys[1:]:
        hit = hit.where(F.col(k) == F.col(f"r_{k}"))
    found = hit.select("_row", F.struct(F.lit(0).cast("long").alias("distance"), F.col("r_gene_id").alias("gene_id")).alias("n"))
    for side in ("left", "right"):
        d = gap(F.col("_row.start"), F.col("_row.end"), F.col("_body.start"), F.col("_body.end"))
        found = found.unionAll(_toward(loci, bodies, keys, side).where("_body IS NOT NULL").select("_row", F.struct(d.alias("distance"), F.col("_body.gene_id").alias("gene_id")).alias("n")))
    return found.groupBy("_row").agg(F.min("n").alias("n"))


def nearest(loci: DataFrame, bodies: DataFrame, key: tuple[str, ...] = ("chrom",), width: int = BIN) -> DataFrame:
    """loci with nearest_id and distance: the body on the same key that overlaps (0) or has the fewest bases between; ties to the least gene_id.

    loci and bodies have start and end; key columns are compared for equality, chrom first. Loci of one place are looked
    up once and keep their rows; loci on keys without bodies, or with a null there or in their place, get nulls.
    """
    keys = list(key)
    place = F.struct(*keys, "start", "end")
    best = _nearest(loci.select(*keys, place.alias("_row")).distinct(), bodies.select(*keys, "start", "end", "gene_id"), keys, width)
    return loci.withColumn("_row", place).join(best, "_row", "left").select(*loci.columns, F.col("n.gene_id").alias("nearest_id"), F.col("n.distance").alias("distance"))


def nearest_stranded(loci: DataFrame, bodies: DataFrame, wild_bodies: bool = False, width: int = BIN) -> DataFrame:
    """As ``nearest``, on the locus's own strand; a locus without one (".", null) takes any, and with wild_bodies so does a body.

    A place is looked up on each strand it may take, all in one run.
    """
    strand = F.coalesce(F.col("strand"), F.lit("."))
    both = F.array(F.lit("+"), F.lit("-"))
    place = F.struct("chrom", "start", "end", "strand")
    places = loci.select("chrom", strand.alias("strand"), place.alias("_row")).distinct().select("chrom", "_row", F.explode(F.when(strand == ".", F.concat(both, F.array(F.lit(".")))).otherwise(F.array(strand))).alias("_strand"))
    taken = F.explode(F.when(strand == ".", both).otherwise(F.array(strand))) if wild_bodies else strand
    sided = bodies.select("chrom", taken.alias("_strand"), "start", "end", "gene_id")
    best = _nearest(places, sided, ["chrom", "_strand"], width)
    return loci.withColumn("_row", place).join(best, "_row", "left").select(*loci.columns, F.col("n.gene_id").alias("nearest_id"), F.col("n.distance").alias("distance"))
