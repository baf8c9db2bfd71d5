"""Expressions over alignment records: filters, strands and CIGAR folds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNMAPPED, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 0x4, 0x100, 0x200, 0x400, 0x800
PAIRED, PROPER, REVERSE, READ1, READ2 = 0x1, 0x2, 0x10, 0x40, 0x80


def has(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def passes(flag: Column, mapq: Column, min_mapq: int = 10, skip_duplicates: Column | bool = True) -> Column:
    """Mapped primary records of enough quality, without duplicates if asked for."""
    skip = skip_duplicates if isinstance(skip_duplicates, Column) else F.lit(skip_duplicates)
    return ~has(flag, UNMAPPED | SECONDARY | QC_FAIL | SUPPLEMENTARY) & ~(skip & has(flag, DUPLICATE)) & (mapq >= min_mapq)


def inferred_strand(flag: Column, library: Column) -> Column:
    """The transcript's strand by library kind (rf, fr); null for other kinds."""
    forward = ~has(flag, REVERSE)
    second = has(flag, PAIRED) & has(flag, READ2)
    first_or_single = ~has(flag, PAIRED) | has(flag, READ1)
    plus = F.when(library == "rf", F.when(second, forward).otherwise(~forward)).when(library == "fr", F.when(first_or_single, forward).otherwise(~forward))
    return F.when(plus, "+").when(~plus, "-")


def strand_compatible(read: Column, locus: Column) -> Column:
    return read.isNull() | (read == locus) | (locus == ".")


def placed_ops(pos: Column, cigar: Column) -> Column:
    """array<struct<op, s, e>> of the operations that consume reference, in 1-based closed places."""
    ops = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDNSHPX=])"), F.lit(1)), lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.regexp_extract(x, "^[0-9]+", 0).cast("long").alias("n")))
    start = F.struct(pos.cast("long").alias("at"), F.array().cast("array<struct<op:string,s:bigint,e:bigint>>").alias("out"))

    def step(acc, x):
        moves = x["op"].isin("M", "=", "X", "D", "N")
        piece = F.array(F.struct(x["op"].alias("op"), acc["at"].alias("s"), (acc["at"] + x["n"] - 1).alias("e")))
        return F.struct(F.when(moves, acc["at"] + x["n"]).otherwise(acc["at"]).alias("at"), F.when(moves, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(ops, start, step, lambda acc: acc["out"])


def aligned_blocks(pos: Column, cigar: Column) -> Column:
    """array<struct<s, e>> of matched stretches, each operation its own."""
    return F.transform(F.filter(placed_ops(pos, cigar), lambda x: x["op"].isin("M", "=", "X")), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def introns(pos: Column, cigar: Column) -> Column:
    """Distinct array<struct<s, e>> of skipped stretches; one step for each, over the reference bases of what stands before it."""
    skips = F.regexp_extract_all(cigar, F.lit("([0-9]+)N"), F.lit(1))
    bases = lambda piece: F.aggregate(F.regexp_extract_all(piece, F.lit("([0-9]+)[MDX=]"), F.lit(1)), F.lit(0).cast("long"), lambda n, x: n + x.cast("long"))
    steps = F.zip_with(F.slice(F.split(cigar, "[0-9]+N", -1), F.lit(1), F.size(skips)), skips, lambda piece, n: F.struct(bases(piece).alias("b"), n.cast("long").alias("n")))
    start = F.struct(pos.cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("out"))

    def step(acc, x):
        s = acc["at"] + x["b"]
        return F.struct((s + x["n"]).alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), (s + x["n"] - 1).alias("e")))).alias("out"))

    found = F.array_distinct(F.filter(F.aggregate(steps, start, step, lambda acc: acc["out"]), lambda x: x["e"] >= x["s"]))
    return F.when(cigar.contains("N"), found).otherwise(F.array().cast("array<struct<s:bigint,e:bigint>>"))
