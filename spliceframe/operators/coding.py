"""Coding potential of transcripts: the longest reading frame, its hexamers and base positions, and its peptide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequences as S
from .storage import cut

#: What is added to both frequencies of a hexamer. A fixed value.
PSEUDO = 1e-8
_BASES = "ACGT"


def read_hexamers(spark: SparkSession, path: str) -> DataFrame:
    """hexamer, coding and noncoding frequencies of a tab-separated table; a header is passed over, any other bad row is an error."""
    p = F.split("value", "\t")
    lines = spark.read.text(path).where((F.col("value") != "") & (F.lower(p[0]) != "hexamer"))
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (c >= 0) & (c < float("inf"))
    coding, other = F.get(p, F.lit(1)).try_cast("double"), F.get(p, F.lit(2)).try_cast("double")
    ok = p[0].rlike("^[ACGTacgt]{6}$") & good(coding) & good(other)
    name = F.when(F.coalesce(ok, F.lit(False)), F.upper(p[0])).otherwise(F.raise_error(F.concat(F.lit("bad hexamer row: "), "value")))
    return lines.select(name.alias("hexamer"), coding.alias("coding"), other.alias("noncoding"))


def _counts(seqs: DataFrame) -> DataFrame:
    """code and n: how often each in-frame hexamer stands in a task's sequences (column seq)."""

    def run(batches):
        total = np.zeros(4096, np.int64)
        for b in batches:
            for x in b.column("seq"):
                total += np.bincount(S.in_frame_hexamers(x.as_py() or ""), minlength=4096)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["code", "n"])

    return seqs.select(F.upper("seq").alias("seq")).mapInArrow(run, "code int, n long")


def hexamer(code: Column) -> Column:
    """The six bases of a code from 0 to 4095."""
    return F.concat(*[F.substring(F.lit(_BASES), F.shiftright(code, 10 - 2 * k).bitwiseAND(3) + 1, F.lit(1)) for k in range(6)])


def count_hexamers(coding: DataFrame, noncoding: DataFrame) -> DataFrame:
    """hexamer and its share of all in-frame hexamers of coding and of noncoding sequences (column seq); one that either lacks has 0 there.

    Each task counts its own, so what is shuffled is at most 4096 rows a task, and the sums are of at most 4096 rows.
    """
    each = _counts(coding).select("code", F.col("n").alias("c"), F.lit(0).alias("n")).unionAll(_counts(noncoding).select("code", F.lit(0), "n"))
    counts = each.groupBy("code").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    whole = Window.partitionBy(F.lit(0))
    share = lambda a: F.when(F.sum(a).over(whole) > 0, F.col(a) / F.sum(a).over(whole)).otherwise(0.0)
    return counts.select(hexamer(F.col("code")).alias("hexamer"), share("c").alias("coding"), share("n").alias("noncoding"))


def _code(triplet: Column) -> Column:
    """0 to 63 by the bases' places; null for others."""
    at = [F.instr(F.lit(_BASES), F.substring(triplet, k, 1)) - 1 for k in (1, 2, 3)]
    return F.when((at[0] >= 0) & (at[1] >= 0) & (at[2] >= 0), at[0] * 16 + at[1] * 4 + at[2])


def ratios(table: DataFrame) -> np.ndarray:
    """log2 ratio of each of 4096 hexamers by code, NaN where the table has none: read once, at most 4096 rows.

    A hexamer that stands twice counts by its last ratio in order; an empty table is an error.
    """
    llr = F.log2((F.col("coding") + PSEUDO) / (F.col("noncoding") + PSEUDO))
    code = _code(F.substring("hexamer", 1, 3)) * 64 + _code(F.substring("hexamer", 4, 3))
    rows = table.groupBy(code.alias("code")).agg(F.max(llr).alias("llr")).where("code IS NOT NULL").collect()
    if not rows:
        raise ValueError("the hexamer table has no rows")
    out = np.full(4096, np.nan)
    out[[r["code"] for r in rows]] = [np.nan if r["llr"] is None else r["llr"] for r in rows]
    return out


def hexamer_sums(seq: Column, table: DataFrame) -> Column:
    """A struct of total and n: the ratios of a sequence's in-frame hexamers that the table has, added up, and how many."""
    at = ratios(table)

    def one(text: str) -> tuple[float, int]:
        found = at[S.in_frame_hexamers(text)]
        found = found[~np.isnan(found)]
        return float(found.sum()), len(found)

    return S.by_text(one, "total double, n int")(F.upper(seq))


def hexamer_scores(df: DataFrame, key: str, seq: str, table: DataFrame) -> DataFrame:
    """key and coding_score: the mean ratio of a sequence's in-frame hexamers that the table has; null if it has none.

    Everything happens in the row, from an array of 4096 ratios.
    """
    found = df.select(key, hexamer_sums(F.col(seq), table).alias("_s"))
    return found.select(key, F.when(F.col("_s.n") > 0, F.col("_s.total") / F.col("_s.n")).alias("coding_score"))


def reading_frames(transcripts: DataFrame) -> DataFrame:
    """locus_id, transcript_id, aa, complete and nt of each transcript's longest reading frame, the last three null without one or without transcript_id."""
    frame = S.longest_orf(F.when(F.col("transcript_id").isNotNull(), F.col("seq")))
    return transcripts.select("locus_id", "transcript_id", frame.alias("_o")).select("locus_id", "transcript_id", "_o.aa", "_o.complete", "_o.nt")


def score_frames(frames: DataFrame, table: DataFrame, low: float = 0.0, high: float = 0.0) -> DataFrame:
    """frames, as ``reading_frames`` gives them, with coding_score and coding_label."""
    told = frames.withColumn("_s", hexamer_sums(F.col("nt"), table)).withColumn("coding_score", F.when(F.col("_s.n") > 0, F.col("_s.total") / F.col("_s.n"))).drop("_s")
    return told.withColumn("coding_label", F.when(F.col("aa").isNull(), "noncoding").otherwise(S.coding_label(F.col("coding_score"), low, high)))


def coding_table(transcripts: DataFrame, table: DataFrame, low: float = 0.0, high: float = 0.0) -> DataFrame:
    """locus_id, transcript_id, longest_orf_aa, complete, coding_score, fickett, coding_label and peptide of each transcript (with seq).

    Both scores are of the reading frame's bases without its stop. A transcript without a start has 0, false, nulls,
    noncoding and an empty peptide. transcript_id is a row's key.
    """
    told = cut(score_frames(reading_frames(transcripts), table, low, high))
    told = told.join(S.fickett_scores(told.where("nt IS NOT NULL"), "transcript_id", "nt"), "transcript_id", "left")
    return told.select("locus_id", "transcript_id", F.coalesce("aa", F.lit(0)).alias("longest_orf_aa"), F.coalesce("complete", F.lit(False)).alias("complete"), "coding_score", "fickett", "coding_label", S.translate(F.col("nt")).alias("peptide"))


def peptide_records(coded: DataFrame, least: int = 1) -> DataFrame:
    """id (locus|transcript|length) and sequence of peptides of at least ``least`` letters, for the FASTA writer."""
    return coded.where(F.length("peptide") >= least).select(F.concat_ws("|", "locus_id", "transcript_id", F.length("peptide").cast("string")).alias("id"), F.col("peptide").alias("sequence"))
