"""Expressions over nucleotide sequences."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Standard genetic code in TCAG order of the three bases. Fixed values.
BASES, AMINO = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
STOPS = ("TAA", "TAG", "TGA")
#: Fickett's position and content tables: cuts, scores by base, weights. Fixed values.
POSITION_CUTS = (1.9, 1.8, 1.7, 1.6, 1.5, 1.4, 1.3, 1.2, 1.1, 0.0)
POSITION = {"A": (0.94, 0.68, 0.84, 0.93, 0.58, 0.68, 0.45, 0.34, 0.20, 0.22), "C": (0.80, 0.70, 0.70, 0.81, 0.66, 0.48, 0.51, 0.33, 0.30, 0.23), "G": (0.90, 0.88, 0.74, 0.64, 0.53, 0.48, 0.27, 0.16, 0.08, 0.08), "T": (0.97, 0.97, 0.91, 0.68, 0.69, 0.44, 0.54, 0.20, 0.09, 0.09)}
POSITION_WEIGHT = {"A": 0.26, "C": 0.18, "G": 0.31, "T": 0.33}
CONTENT_CUTS = (0.33, 0.31, 0.29, 0.27, 0.25, 0.23, 0.21, 0.19, 0.17, 0.0)
CONTENT = {"A": (0.28, 0.49, 0.44, 0.55, 0.62, 0.49, 0.67, 0.65, 0.81, 0.21), "C": (0.82, 0.73, 0.43, 0.59, 0.59, 0.32, 0.69, 0.33, 0.30, 0.23), "G": (0.40, 0.54, 0.47, 0.64, 0.64, 0.73, 0.41, 0.41, 0.33, 0.29), "T": (0.28, 0.24, 0.39, 0.40, 0.55, 0.75, 0.56, 0.69, 0.51, 0.58)}
CONTENT_WEIGHT = {"A": 0.11, "C": 0.12, "G": 0.15, "T": 0.14}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), "ACGTU", "TGCAA"))


def codons(seq: Column, frame: int = 0) -> Column:
    """Whole triplets from an offset on, in one pass: a substring by place would count from the start for each."""
    rest = F.substring(seq, frame + 1, 2**31 - 1)
    return F.coalesce(F.regexp_extract_all(rest, F.lit("(?s).{3}"), F.lit(0)), F.array().cast("array<string>"))


def translate(seq: Column) -> Column:
    """Amino acids of the codons: X for unknown ones, stops removed."""
    at = lambda b: F.instr(F.lit(BASES), b) - 1

    def one(c: Column) -> Column:
        a, b, d = (at(F.substring(c, k, 1)) for k in (1, 2, 3))
        return F.when(c.rlike("^[TCAG]{3}$"), F.substring(F.lit(AMINO), a * 16 + b * 4 + d + 1, F.lit(1))).otherwise("X")

    return F.translate(F.array_join(F.transform(codons(seq), one), ""), "*", "")


#: Code of a base by its byte; what is no base makes any triplet it is in 64 or more.
_BASE = np.full(256, 64, np.int32)
_BASE[list(b"ACGT")] = range(4)
_ATG, _STOPS = 14, np.isin(np.arange(65), (48, 50, 56))


def triplets(seq: str) -> np.ndarray:
    """Codes 0 to 63 of the three bases from each place on; 64 or more where one is none of ACGT."""
    c = _BASE[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)]
    return c[:-2] * 16 + c[1:-1] * 4 + c[2:]


def in_frame_hexamers(seq: str) -> np.ndarray:
    """Codes 0 to 4095 of the hexamers at every third place from the first, those of ACGT alone."""
    t = triplets(seq)[::3]
    a, b = t[:-1], t[1:]
    return (a * 64 + b)[(a < 64) & (b < 64)]


def _best_frame(seq: str) -> tuple[int, int, int, bool, str] | None:
    """aa, frame, start, complete and bases of the longest frame; None without an ATG."""
    t, best = triplets(seq), None
    for frame in range(3):
        codes = t[frame::3]
        starts = np.flatnonzero(codes == _ATG)
        if not len(starts):
            continue
        stops = np.append(np.flatnonzero(_STOPS[np.minimum(codes, 64)]), len(codes))
        at = np.searchsorted(stops, starts)
        aa = stops[at] - starts
        k = int(aa.argmax())
        if best is None or aa[k] > best[0]:
            best = int(aa[k]), frame, int(starts[k]) * 3 + frame, bool(at[k] < len(stops) - 1)
    return best and (*best, seq[best[2] : best[2] + 3 * best[0]])


def by_text(one: Callable[[str], tuple | None], kind: str) -> Callable[[Column], Column]:
    """A column function over texts: the struct that ``one`` gives of a text, null where that is None or the text null."""

    def run(texts: pa.Array) -> pa.Array:
        out = [None if x is None else one(x) for x in (x.as_py() for x in texts)]
        return pa.array([x and dict(zip(names, x)) for x in out], pa.struct(fields))

    types = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [(name, types[t]) for name, t in (f.split() for f in kind.split(", "))]
    names = [name for name, _ in fields]
    # not deterministic to Spark, so that each use of a field or a filter doesn't compute it once more
    return F.arrow_udf(run, kind).asNondeterministic()


def longest_orf(seq: Column) -> Column:
    """A struct of aa, frame, start, complete and nt (the frame's bases without its stop), as in ``longest_orfs``; null without an ATG.

    A column function over texts, as expressions make a string of each codon; the README has the figures.
    """
    return by_text(_best_frame, "aa int, frame int, start int, complete boolean, nt string")(F.upper(seq))


def longest_orfs(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """key, aa, frame, start and complete: ATG to a stop or the end; the longest, then the least frame, then the first.

    In the row, no shuffle. Sequences without an ATG have no row.
    """
    return df.select(key, longest_orf(F.col(seq)).alias("_o")).where("_o IS NOT NULL").select(key, "_o.aa", "_o.frame", "_o.start", "_o.complete")


def _ladder(value: Column, cuts: tuple, scores: tuple) -> Column:
    out = F.when(value >= cuts[0], scores[0])
    for c, s in zip(cuts[1:], scores[1:]):
        out = out.when(value >= c, s)
    return out.otherwise(scores[-1])


def fickett_scores(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """key and fickett, the TESTCODE score from base position and content; 0 for sequences of under two bases.

    Every third base is taken by one expression for each place in the codon and counted by length: no rows, no shuffle.
    """
    whole = F.translate(F.upper(F.coalesce(F.col(seq), F.lit(""))), "U", "T")
    third = [F.regexp_replace(F.substring("_seq", k + 1, 2**31 - 1), "(?s)(.).{0,2}", "$1").alias(f"_third{k}") for k in range(3)]
    # an outer explode of one value keeps it from being computed anew for each use
    once = df.select(key, F.explode_outer(F.array(whole)).alias("_seq"))
    rows = once.select(key, F.explode_outer(F.array(F.struct(F.length("_seq").alias("_length"), *third))).alias("_x")).select(key, "_x.*")
    counts = [(F.length(f"_third{k}") - F.length(F.replace(F.col(f"_third{k}"), F.lit(b), F.lit("")))).alias(f"_{b}{k}") for b in "ACGT" for k in range(3)]
    c = rows.select(key, "_length", *counts)
    total = F.lit(0.0)
    for b in "ACGT":
        n = [F.col(f"_{b}{k}") for k in range(3)]
        total = total + _ladder(F.greatest(*n) / (F.least(*n) + 1), POSITION_CUTS, POSITION[b]) * POSITION_WEIGHT[b] + _ladder((n[0] + n[1] + n[2]) / F.col("_length"), CONTENT_CUTS, CONTENT[b]) * CONTENT_WEIGHT[b]
    return c.select(key, F.when(F.col("_length") >= 2, total).otherwise(0.0).alias("fickett"))


def canonical_splice(seq: Column, start: Column, end: Column, strand: Column) -> Column:
    """Whether an intron of seq (1-based closed) has GT-AG or GC-AG ends on its strand; under 4 bases not."""
    left, right = F.substring(seq, start, F.lit(2)), F.substring(seq, end - 1, F.lit(2))
    minus = strand == "-"
    donor, acceptor = F.when(minus, reverse_complement(right)).otherwise(left), F.when(minus, reverse_complement(left)).otherwise(right)
    return (end >= start + 3) & donor.isin("GT", "GC") & (acceptor == "AG")


def coding_label(score: Column, low: float = 0.0, high: float = 0.0) -> Column:
    """coding above high, noncoding below low, else ambiguous; missing and non-finite scores are noncoding."""
    lost = score.isNull() | F.isnan(score) | score.isin(float("inf"), float("-inf"))
    return F.when(lost, "noncoding").when(score > high, "coding").when(score < low, "noncoding").otherwise("ambiguous")


def chrom_key(chrom: Column) -> Column:
    """The name without a lower-case chr; M and MT are one."""
    bare = F.regexp_replace(chrom, "^chr", "")
    return F.when(F.upper(bare).isin("M", "MT"), "MT").otherwise(bare)
