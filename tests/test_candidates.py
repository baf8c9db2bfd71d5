"""The gates over samples, case by case and against plain loops, and the candidate table."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from spliceframe.operators import candidates
from spliceframe.operators.candidates import Thresholds

SHEET = [("c1", "control"), ("c2", "control"), ("t1", "treat"), ("t2", "treat"), ("t3", "treat"), ("t4", "treat")]
LOCI = "locus_id string, n_exons int, length_nt long, n_introns int, splice_fraction double, has_nearest boolean, nearest_distance long, structure_error string, repeat_share double"
FEATURES = "locus_id string, sample_id string, valley_possible boolean, valley_mean double, gap_mean_depth double, locus_mean_depth double, bridge_read_count int, junction_support array<int>"
ABUNDANCE = "locus_id string, sample_id string, tpm double, count double"


def plain(locus, features, abundance, sheet, f):
    """Trail, first failure and outcome by the rules in order."""
    contrast = {"control", "treat"} <= {g for _, g in sheet}
    counted = [s for s, g in sheet if g == "treat" or not contrast]
    tpm = {s: round(abundance.get(s, 0.0), 6) for s, _ in sheet}
    if (locus[7] or "").strip():
        return "", "structure", "dropped"
    trail = ["class"]

    def done(name, outcome="dropped"):
        return ",".join(trail), name, outcome

    if locus[1] < f.min_exons:
        return done("min_exons")
    trail.append("min_exons")
    if locus[2] < f.min_length:
        return done("transcript_min_nt")
    trail.append("transcript_min_nt")
    if locus[3] > 0:
        if f.canonical_splice and (locus[4] or 0.0) < 1 - f.noncanonical_share:
            return done("canonical_splice")
        trail.append("canonical_splice")
    if locus[5] and locus[6] < f.min_distance:
        return done("distance")
    trail.append("distance")
    detecting = [s for s in counted if tpm[s] >= f.detect_tpm]
    if locus[5] and f.discontinuity:
        good = 0
        for s in detecting:
            v = features.get(s)
            if v and v[0] and None not in v[1:4]:
                good += max(v[1], v[2]) <= min(f.valley_mean, f.valley_ratio * v[3])
        need = len(detecting) if f.valley_samples is None else f.valley_samples
        if not features or not detecting or good < need:
            return done("discontinuity")
    trail.append("discontinuity")
    bridges = sum((features[s][4] or 0) for s in detecting if s in features)
    if f.reject_bridges:
        if locus[5] and detecting and bridges >= f.bridge_reads:
            return done("no_bridge")
        trail.append("no_bridge")
    if contrast:
        if max(tpm[s] for s, g in sheet if g == "control") >= f.control_tpm:
            return done("control", "unnamed")
        if len(detecting) < f.detecting_samples:
            return done("replicates")
        if median(tpm[s] for s in counted) < f.median_tpm:
            return done("treat_median")
    if locus[8] >= f.repeat_share:
        return done("rmsk")
    return ",".join([*trail, "rmsk", "detect"]), None, "candidate"


def made(seed, n=260):
    r = random.Random(seed)
    loci = [(f"L{k}", r.choice([0, 1, 2, 3]), r.choice([90, 100, 500, 900]), i := r.choice([0, 1, 2]), None if i == 0 else r.choice([None, 1.0, 1.0, 1.0, 0.5]), r.random() < 0.6, r.choice([999, 1000, 5000, 9000]), r.choice([None, None, "", " ", None, "bad introns"]), r.choice([0.0, 0.05, 0.0999, 0.1])) for k in range(n)]
    low = lambda *x: None if r.random() < 0.04 else r.choice(x)
    features = [(lid, s, low(True, True, True, False), low(0.0, 0.1, 0.5, 1.0), low(0.0, 0.2, 0.9), low(1.0, 5.0, 20.0), low(0, 0, 0, 1, 2), [r.randint(0, 3), 1]) for lid, *_ in loci for s, _ in SHEET if r.random() < 0.9]
    quiet = {lid: r.random() < 0.7 for lid, *_ in loci}
    abundance = [(lid, s, r.choice([0.0, 0.1] if g == "control" and quiet[lid] else [0.0999996, 0.0999994, 0.4, 0.5, 0.9, 3.0]), 4.0) for lid, *_ in loci for s, g in SHEET if s == "t1" or r.random() < 0.95]
    return loci, features, abundance


def gated(spark, loci, features, abundance, sheet=SHEET, limits=Thresholds()):
    d = lambda rows, kind: spark.createDataFrame(rows, kind)
    return candidates.gate_loci(d(loci, LOCI), d(features, FEATURES), d(abundance, ABUNDANCE), d(sheet, "sample_id string, grp string"), limits)


@pytest.mark.parametrize(
    "sheet,limits",
    [
        (SHEET, Thresholds()),
        (SHEET, Thresholds(valley_samples=None, detecting_samples=1, bridge_reads=1)),
        ([(s, "treat") for s, _ in SHEET], Thresholds(canonical_splice=False, reject_bridges=False)),
        ([(s, None if s == "c1" else g) for s, g in SHEET], Thresholds(discontinuity=False, noncanonical_share=0.5)),
    ],
)
def test_gates_against_plain_loops(spark, sheet, limits):
    loci, features, abundance = made(5)
    got = {r["locus_id"]: (r["gates_passed"], r["failed_gate"], r["outcome"]) for r in gated(spark, loci, features, abundance, sheet, limits).collect()}
    by = lambda rows, of: {lid: {x[1]: of(x) for x in rows if x[0] == lid} for lid, *_ in loci}
    f, a = by(features, lambda x: x[2:]), by(abundance, lambda x: x[2])
    want = {x[0]: plain(x, f[x[0]], a[x[0]], [(s, g or "") for s, g in sheet], limits) for x in loci}
    assert got == want
    assert {w[1] for w in want.values()} >= {None, "structure", "min_exons", "transcript_min_nt", "distance"}


ONE = ("L", 2, 500, 1, 1.0, True, 5000, None, 0.0)
HIGH = [("L", s, 2.0 if g == "treat" else 0.0, 9.0) for s, g in SHEET]


def features_of(**more):
    base = {"valley_possible": True, "valley_mean": 0.0, "gap_mean_depth": 0.0, "locus_mean_depth": 10.0, "bridge_read_count": 0, "junction_support": [1, 2]}
    return [("L", s, *(base | {k: v.get(s, base[k]) if isinstance(v, dict) else v for k, v in more.items()}).values()) for s, _ in SHEET]


@pytest.mark.parametrize(
    "features,want",
    [
        ({}, None),
        ({"valley_mean": {"t1": 9.0, "t2": 9.0, "t3": 9.0}}, None),  # one detecting sample is enough
        ({"valley_mean": 1.01}, "discontinuity"),
        ({"gap_mean_depth": 1.01}, "discontinuity"),  # an empty window in a covered gap isn't a gap
        ({"valley_mean": 0.6, "locus_mean_depth": 5.0}, "discontinuity"),
        ({"valley_possible": False}, "discontinuity"),
        ({"valley_mean": {s: 9.0 for s, g in SHEET if g == "treat"}}, "discontinuity"),  # empty in controls alone
        ({"bridge_read_count": {"t1": 1, "t4": 1}}, "no_bridge"),
        ({"bridge_read_count": {"c1": 9, "t4": 1}}, None),
    ],
)
def test_one_locus(spark, features, want):
    (row,) = gated(spark, [ONE], features_of(**features), HIGH).collect()
    assert row["failed_gate"] == want


def test_measures_and_errors(spark):
    (row,) = gated(spark, [ONE], features_of(valley_mean={"t1": 0.1, "t2": 0.2, "t3": 0.4, "t4": 0.8}, junction_support={"t2": [], "c1": [50, 50]}), HIGH).collect()
    assert (row["valley_median"], row["junction_support"], row["control_max"], row["treat_median"], row["n_detected"]) == (pytest.approx(0.3), [3, 6], 0.0, 2.0, 4)
    for loci, features, abundance, said in [([ONE[:6] + (None,) + ONE[7:]], features_of(), HIGH, "no distance"), ([ONE], features_of(junction_support={"t1": [1]}), HIGH, "unlike length"), ([ONE], features_of(), [], "no TPM of L")]:
        with pytest.raises(Exception, match=said):
            gated(spark, loci, features, abundance).collect()
    # neither is reached by a locus that failed before
    assert gated(spark, [("L", 0, 500, 1, 1.0, True, None, None, 0.0)], features_of(), HIGH).collect()[0]["failed_gate"] == "min_exons"
    assert gated(spark, [ONE], [], HIGH).collect()[0]["failed_gate"] == "discontinuity"
    assert gated(spark, [], features_of(), HIGH).count() == 0


def test_table(spark):
    out = gated(spark, [ONE], features_of(), HIGH).withColumns({"named_overlap": F.lit("annotated"), "more": F.lit(1)})
    sheet = spark.createDataFrame(SHEET, "sample_id string, grp string")
    table = candidates.candidate_table(out, sheet)
    assert table.columns[: len(candidates.COLUMNS)] == candidates.COLUMNS and table.columns[-1] == "more"
    (row,) = table.collect()
    assert (row["named_overlap"], row["padj"], row["junction_support"], row["t1_junction_support"], row["t1_tpm"], row["c1_tpm"], row["t2_bridge_read_count"], row["chrom"]) == ("annotated", "NA", "4,8", "1,2", 2.0, 0.0, 0, None)
    assert [c for c in table.columns if c.startswith("c1_")] == ["c1_junction_support", "c1_bridge_read_count", "c1_tpm", "c1_count"]
