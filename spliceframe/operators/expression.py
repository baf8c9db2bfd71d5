"""Differential expression: the fits of each gene in its batch, what all genes share by aggregates of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import negative_binomial as nb
from .gates import benjamini_hochberg, de_status
from .harvest import global_rank
from .quantify import size_factors
from .scans import running
from .storage import cut

#: Cuts of the mean that independent filtering tries, rows of a task's batch, accuracy of medians and quantiles (relative rank).
CUTS, BATCH, ACCURACY = 50, 2000, 100_000
#: Rounds of the trend's fit, of the reweighting within one, and where a ratio to the trend counts as outlying. Fixed values.
ROUNDS, STEPS, RATIOS = 10, 50, (1e-4, 15.0)


def design(matrix: DataFrame, sheet: DataFrame, control: str = "control", treat: str = "treat") -> tuple[nb.Design, list[str]]:
    """Size factors and groups in order of sample_id. The sheet is a handful of rows, the driver's to hold.

    Other groups, a blank one among them, are levels of their own. A sheet without either side of the contrast is an
    error, and so are samples without a size factor (no gene is counted in all samples).
    """
    rows = sorted((r["sample_id"], r["grp"] or "") for r in sheet.select("sample_id", "grp").distinct().collect())
    names = sorted({g for _, g in rows})
    if control not in names or treat not in names:
        raise ValueError(f"the sheet needs samples of {control} and {treat}")
    whole = matrix.where("n > 0").groupBy("gene_id").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") == len(rows))
    factors = {r["sample_id"]: r["size_factor"] for r in size_factors(matrix.join(whole, "gene_id", "left_semi")).collect()}
    missing = [s for s, _ in rows if not factors.get(s)]
    if missing:
        raise ValueError(f"no size factor for {missing}: no gene is counted in every sample")
    return nb.Design(np.array([factors[s] for s, _ in rows]), np.array([names.index(g) for _, g in rows]), names.index(control), names.index(treat)), [s for s, _ in rows]


def gene_rows(matrix: DataFrame, samples: list[str]) -> DataFrame:
    """gene_id and its counts in the samples' order, missing ones 0; a gene's row is as wide as the sheet."""
    at = F.create_map(*[x for k, s in enumerate(samples) for x in (F.lit(s), F.lit(k))])
    counted = matrix.groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct(at[F.col("sample_id")].alias("k"), F.col("n").cast("double").alias("n")))).alias("m"))
    return counted.select("gene_id", F.transform(F.sequence(F.lit(0), F.lit(len(samples) - 1)), lambda k: F.coalesce(F.col("m")[k], F.lit(0.0))).alias("counts"))


def _counts(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("counts").to_pylist(), float).reshape(batch.num_rows, -1)


def rowwise(genes: DataFrame, d: nb.Design) -> DataFrame:
    """genes with mean and own, the dispersion each row has by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, BATCH) for k in range(0, batch.num_rows, BATCH)):
                counts = _counts(part)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array((counts / d.factors).mean(1)), pa.array(nb.dispersions(counts, nb.group_means(counts, d), d))], [*part.schema.names, "mean", "own"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in genes.schema)
    return genes.mapInArrow(run, f"{kinds}, mean double, own double")


def trend(rows: DataFrame, d: nb.Design) -> nb.Trend:
    """slope / mean + base through the rows' own dispersions, by a gamma regression; each step is one sum over all rows.

    Rows far off the last trend are left out of the next one. Without a positive fit the mean dispersion is the base.
    The spread is the squared median deviation of the logarithms, less what so few samples scatter.
    """
    used = rows.where((F.col("own") >= 100 * nb.LEAST_DISPERSION) & (F.col("mean") > 0)).select(F.col("own").alias("y"), (1 / F.col("mean")).alias("x"))
    mean = used.agg(F.avg("y").alias("y")).first()["y"]
    if mean is None:
        return nb.Trend(0.0, nb.LEAST_DISPERSION, nb.LEAST_PRIOR, nb.LEAST_PRIOR)
    slope, base, fitted = 1.0, 0.1, True
    for _ in range(ROUNDS):
        start = (slope, base)
        line = lambda: F.lit(slope) * F.col("x") + F.lit(base)
        kept = used.where((F.col("y") / line()).between(*RATIOS))
        for _ in range(STEPS):
            w = 1 / line() ** 2
            s = kept.agg(*[F.sum(w * c).alias(n) for n, c in (("n", F.lit(1.0)), ("x", F.col("x")), ("xx", F.col("x") ** 2), ("y", F.col("y")), ("xy", F.col("x") * F.col("y")))]).first()
            det = (s["n"] or 0) * (s["xx"] or 0) - (s["x"] or 0) ** 2
            if det <= 0:
                fitted = False
                break
            new = ((s["n"] * s["xy"] - s["x"] * s["y"]) / det, (s["xx"] * s["y"] - s["x"] * s["xy"]) / det)
            if min(new) <= 0:
                fitted = False
                break
            moved = abs(log(new[0] / slope)) + abs(log(new[1] / base))
            slope, base = new
            if moved < 1e-8:
                break
        if not fitted or log(slope / start[0]) ** 2 + log(base / start[1]) ** 2 < 1e-6:
            break
    if not fitted:
        slope, base = 0.0, mean
    off = used.select((F.log("y") - F.log(F.lit(slope) * F.col("x") + F.lit(base))).alias("r"))
    middle = off.agg(F.percentile_approx("r", 0.5, ACCURACY).alias("m")).first()["m"]
    far = off.agg(F.percentile_approx(F.abs(F.col("r") - middle), 0.5, ACCURACY).alias("m")).first()["m"]
    spread = (far * 1.4826) ** 2
    free = len(d.factors) - d.columns
    return nb.Trend(slope, base, spread, max(spread - (nb.trigamma(free / 2) if free > 0 else 0.0), nb.LEAST_PRIOR))


def _filter_cut(tested: DataFrame, alpha: float) -> float:
    """The mean below which rows aren't worth testing: of CUTS quantiles, the first at which about as many pass as at the best.

    Rows are ranked by p once; for every cut a running count along the ranks tells how many pass by the step-up rule.
    """
    some = tested.agg(F.avg((F.col("mean") == 0).cast("double")).alias("zero"), F.count("pvalue").alias("n")).first()
    if not some["n"]:
        return 0.0
    low = some["zero"]
    theta = np.linspace(low, 0.95 if low < 0.95 else 1.0, CUTS)
    cuts = tested.agg(F.percentile_approx("mean", [float(t) for t in theta], ACCURACY).alias("c")).first()["c"]
    known = tested.where("pvalue IS NOT NULL").select("gene_id", "mean", "pvalue")
    held = known.agg(*[F.count_if(F.col("mean") >= c).alias(f"m{k}") for k, c in enumerate(cuts)]).first()
    ranks = cut(global_rank(known.where(F.col("pvalue") <= alpha), [F.col("pvalue"), F.col("gene_id")], "_rank").select("_rank", "mean", "pvalue"))
    counts = running(ranks, [], "_rank", {f"n{k}": ((F.col("mean") >= c).cast("long"), "sum") for k, c in enumerate(cuts)})
    passed = counts.agg(*[F.max(F.when(F.col("pvalue") <= F.lit(alpha) * F.col(f"n{k}") / max(held[f"m{k}"], 1), F.col(f"n{k}"))).alias(f"r{k}") for k in range(CUTS)]).first()
    rejected = np.array([passed[f"r{k}"] or 0 for k in range(CUTS)], float)
    if rejected.max() <= 10:
        return cuts[0]
    smooth = nb.lowess(theta, rejected)
    off = (rejected - smooth)[rejected > 0]
    enough = np.flatnonzero(rejected > smooth.max() - sqrt((off**2).mean()))
    return cuts[int(enough[0])] if len(enough) else cuts[0]


def differential_expression(matrix: DataFrame, sheet: DataFrame, alpha: float = 0.05, least_lfc: float = 0.5) -> DataFrame:
    """gene_id, base_mean, lfc, lfc_se, stat, pvalue, padj and de_status of every gene of matrix (gene_id, sample_id, n).

    Genes without a count have nulls alone. A gene with an outlying count has no p; one below the filter's mean has a p
    but no padj. Every gene is fitted in a batch of rows of its own task; the driver holds the sheet, size factors, the
    trend and CUTS counts. Repeated counts of a gene and sample are added up, missing ones are 0.
    """
    summed = matrix.groupBy("gene_id", "sample_id").agg(F.sum("n").alias("n")).join(F.broadcast(sheet.select("sample_id").distinct()), "sample_id")
    d, samples = design(summed, sheet)
    genes = gene_rows(summed, samples)
    seen = cut(rowwise(genes.where(F.exists("counts", lambda c: c > 0)), d))
    shape = trend(seen, d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, BATCH) for k in range(0, batch.num_rows, BATCH)):
                found = nb.fit(_counts(part), d, shape)
                values = [pa.array(found[n], from_pandas=True) for n in ("dispersion", "lfc", "lfc_se", "stat", "pvalue")]
                yield pa.RecordBatch.from_arrays([part.column("gene_id"), part.column("mean"), *values], ["gene_id", "mean", "dispersion", "lfc", "lfc_se", "stat", "pvalue"])

    kind = matrix.schema["gene_id"].dataType.simpleString()
    tested = cut(seen.select("gene_id", "counts", "mean").mapInArrow(run, f"gene_id {kind}, mean double, dispersion double, lfc double, lfc_se double, stat double, pvalue double"))
    least = _filter_cut(tested, alpha)
    adjusted = benjamini_hochberg(tested.where(F.col("mean") >= least), "gene_id").select("gene_id", F.col("bh").alias("padj"))
    all_ = genes.select("gene_id").join(tested, "gene_id", "left").join(adjusted, "gene_id", "left")
    return all_.select("gene_id", F.col("mean").alias("base_mean"), "dispersion", "lfc", "lfc_se", "stat", "pvalue", "padj", de_status(F.col("lfc"), F.col("pvalue"), F.col("padj"), alpha, least_lfc).alias("de_status"))
