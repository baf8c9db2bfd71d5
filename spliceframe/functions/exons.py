"""Exon lists as arrays and as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(text: Column) -> Column:
    """array<struct<start, end>> of "a-b,c-d" in the order given, bounds put in order; junk and bounds beyond 64 bits are skipped."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda x: x.rlike(r"^\s*[0-9]+\s*-\s*[0-9]+\s*$"))
    ends = F.transform(parts, lambda x: F.split(x, "-"))
    a = lambda x, k: F.trim(x[k]).try_cast("long")
    whole = F.filter(ends, lambda x: a(x, 0).isNotNull() & a(x, 1).isNotNull())
    return F.transform(whole, lambda x: F.struct(F.least(a(x, 0), a(x, 1)).alias("start"), F.greatest(a(x, 0), a(x, 1)).alias("end")))


def encode(exons: Column) -> Column:
    return F.array_join(F.transform(exons, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")


def rebuild(chain: Column, first: Column, last: Column) -> Column:
    """Exons around a chain of introns, from first to last; empty ones go."""
    starts = F.concat(F.array(first), F.transform(chain, lambda x: x["end"] + 1))
    ends = F.concat(F.transform(chain, lambda x: x["start"] - 1), F.array(last))
    return F.filter(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end"))), lambda x: x["end"] >= x["start"])
