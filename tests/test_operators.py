import random

from pyspark.sql import functions as F

from spliceframe.functions import exons, reads, sequences
from spliceframe.operators import coverage, harvest, intervals, ranking
from spliceframe.operators.gates import cascade
from spliceframe.operators.ranking import junction_min


def test_overlap_join_against_all_pairs(spark):
    r = random.Random(5)
    make = lambda n, longest: [(f"c{r.randint(0, 2)}", s := r.randint(1, 3000), s + r.randint(0, longest), k) for k in range(n)]
    a, b = make(150, 900), make(120, 60)
    left, right = spark.createDataFrame(a, "chrom string, start long, end long, k long"), spark.createDataFrame(b, "chrom string, start long, end long, k long")
    for pad in (0, 25):
        got = sorted((x["k"], x["r_k"]) for x in intervals.overlap_join(left, right, width=64, pad=pad).collect())
        want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] - pad <= y[2] and y[1] <= x[2] + pad)
        assert got == want
        semi = sorted(x["k"] for x in intervals.overlap_join(left, right, width=64, pad=pad, how="semi").collect())
        assert semi == sorted({k for k, _ in want})


def test_nearest_crosses_blocks_and_breaks_ties(spark):
    r = random.Random(6)
    places = [1, 5_000, 300_000, 2_000_000, 9_000_000]
    genes = [("c", p := r.choice(places) + r.randint(0, 400), p + 50, f"g{k}") for k in range(30)]
    loci = [("c", p := r.randint(1, 10_000_000), p + 30, k) for k in range(60)] + [("d", 1, 5, 99)]
    got = {x["k"]: (x["nearest_id"], x["distance"]) for x in intervals.nearest(spark.createDataFrame(loci, "chrom string, start long, end long, k long"), spark.createDataFrame(genes, "chrom string, start long, end long, gene_id string")).collect()}
    for c, s, e, k in loci:
        near = sorted((max(0, gs - e - 1, s - ge - 1), g) for gc, gs, ge, g in genes if gc == c)
        assert got[k] == ((near[0][1], near[0][0]) if near else (None, None))


def test_components_match_closure(spark):
    r = random.Random(7)
    nodes = [("c", "+", s := r.randint(1, 4000), s + r.randint(50, 120), k) for k in range(120)]
    walls = [("c", s := r.randint(1, 4000), s + 20) for _ in range(8)]
    root = {n[4]: n[4] for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a[4] < b[4]:
                lo, hi = sorted([a, b], key=lambda n: n[2])
                hole = hi[2] - lo[3] - 1
                free = not any(s <= hi[2] - 1 and lo[3] + 1 <= e for _, s, e in walls)
                if a[2] == b[2] or a[3] == b[3] or hole < 0 or (30 <= hole <= 60 and free):
                    x, y = find(a[4]), find(b[4])
                    root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(nodes, "chrom string, strand string, start long, end long, node long")
    got = {x["node"]: x["component"] for x in harvest.components(df, spark.createDataFrame(walls, "chrom string, start long, end long"), 30, 60).collect()}
    assert got == {n: find(n) for n in root}


def test_greedy_chain_prefers_support(spark):
    df = spark.sql("SELECT array(named_struct('start', 10L, 'end', 20L, 'support', 1L), named_struct('start', 15L, 'end', 40L, 'support', 9L), named_struct('start', 50L, 'end', 60L, 'support', 2L)) AS m")
    assert [(x["start"], x["end"]) for x in df.select(harvest.greedy_chain(F.col("m")).alias("c")).first()["c"]] == [(15, 40), (50, 60)]


def test_cigar(spark):
    row = spark.sql("SELECT 100L AS pos, '5S10M2I5N3D4=1X' AS cigar").select(reads.aligned_blocks(F.col("pos"), F.col("cigar")).alias("b"), reads.introns(F.col("pos"), F.col("cigar")).alias("i")).first()
    assert [tuple(x) for x in row["b"]] == [(100, 109), (118, 121), (122, 122)]
    assert [tuple(x) for x in row["i"]] == [(110, 114)]


def test_union_length_and_depth(spark):
    df = spark.createDataFrame([("c", 1, 10), ("c", 5, 12), ("c", 13, 14), ("c", 20, 20)], "chrom string, start long, end long")
    assert coverage.union_length(df, "chrom").first()["union_length"] == 15
    assert sorted((x["start"], x["end"], x["depth"]) for x in coverage.depth_runs(df, "chrom").collect()) == [(1, 4, 1), (5, 10, 2), (11, 14, 1), (20, 20, 1)]


def test_terminal_walk_stops_at_a_wide_hole(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 31, 40), ("a", 62, 70), ("b", 40, 50)], "k string, a long, b long")
    assert {x["k"]: x["reach"] for x in coverage.walk_end(df, "k", 20, 2000).collect()} == {"a": 40, "b": 0}


def test_cascade_stops_at_the_first_failure(spark):
    df = cascade(spark.createDataFrame([(1, None), (5, 2)], "a int, b int"), [("x", F.col("a") > 0), ("y", F.col("b") > 1), ("z", F.col("a") > 1)])
    assert [(r["gates_passed"], r["failed_gate"]) for r in df.orderBy("a").collect()] == [("x", "y"), ("x,y,z", None)]


def test_longest_orf_by_scan(spark):
    r = random.Random(8)
    seqs = ["".join(r.choice("ACGT") for _ in range(r.randint(0, 90))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(seqs)), "k int, seq string")
    got = {r["k"]: (-r["aa"], r["frame"], r["start"], r["complete"]) for r in sequences.longest_orfs(df, "k").collect()}
    for number, s in enumerate(seqs):
        best = None
        for f in range(3):
            c = [s[i : i + 3] for i in range(f, len(s) - 2, 3)]
            for k, x in enumerate(c):
                if x == "ATG":
                    stop = next((j for j in range(k, len(c)) if c[j] in sequences.STOPS), None)
                    cand = (-((stop if stop is not None else len(c)) - k), f, 3 * k + f, stop is not None)
                    best = min(best, cand) if best else cand
        assert got.get(number) == best


def test_exon_text_and_junctions(spark):
    row = spark.sql("SELECT '30-20, x,5-9' AS t, '3, 1,zz' AS j, CAST(NULL AS STRING) AS n").select(exons.encode(exons.decode(F.col("t"))).alias("t"), junction_min(F.col("j")).alias("j"), junction_min(F.col("n")).alias("n")).first()
    assert (row["t"], row["j"], row["n"]) == ("20-30,5-9", 1, None)


def test_rules_at_their_edges(spark):
    row = spark.sql("SELECT '2;3' AS semi, '+4,-1' AS sign, '.' AS dot, 'chr23' AS c23, 'y' AS y, 'GL456.1' AS gl, 'Chr1' AS cap, 'chrMT' AS mt, double('NaN') AS nan, CAST(NULL AS DOUBLE) AS none, '99999999999999999999-3,4-2' AS big").select(
        junction_min(F.col("semi")).alias("semi"), junction_min(F.col("sign")).alias("sign"), junction_min(F.col("dot")).alias("dot"),
        *[ranking.chrom_class(F.col(c)).alias(f"k_{c}") for c in ("c23", "y", "gl", "cap")], *[sequences.chrom_key(F.col(c)).alias(f"n_{c}") for c in ("cap", "mt")],
        *[sequences.coding_label(F.col(c)).alias(f"l_{c}") for c in ("nan", "none")], exons.encode(exons.decode(F.col("big"))).alias("big"),
    ).first()
    assert row.asDict() == {"semi": 2, "sign": -1, "dot": None, "k_c23": "other", "k_y": "chrY", "k_gl": "unplaced", "k_cap": "primary", "n_cap": "Chr1", "n_mt": "MT", "l_nan": "noncoding", "l_none": "noncoding", "big": "2-4"}


def test_second_stage_patterns(spark):
    df = spark.createDataFrame([("RVT_1", None, 1.0), ("Globin", None, 0.9), ("Globin", 2, 0.9), ("GAPDH", 1, None), ("Keratin", 1, 1.6), ("", 1, 2.0), (None, 1, 2.0)], "pfam string, n_exons int, phylop double")
    assert [(r["score2"], r["flag2"]) for r in ranking.stage_two(df.withColumn("score", F.lit(100.0))).collect()] == [(50.0, "te"), (62.0, "processed"), (100.0, ""), (70.0, "processed"), (88.0, "processed_like"), (100.0, ""), (100.0, "")]


def test_cohort_and_strands(spark):
    counts = spark.createDataFrame([("s1", "treat", "c", 1, 9, "+", 2), ("s2", "treat", "c", 1, 9, "+", 3)], "sample_id string, grp string, chrom string, start long, end long, strand string, n long")
    assert harvest.recurrence(counts).first()["cohort"] == "silent"
    assert harvest.recurrence(counts, has_controls=False).first()["cohort"] == "cohort"
    loci = spark.createDataFrame([("a", "c", 100, 110, "."), ("b", "c", 100, 110, "-"), ("b", "c", 100, 110, "-")], "locus_id string, chrom string, start long, end long, strand string")
    bodies = spark.createDataFrame([("g", "c", 200, 210, "+"), ("h", "c", 300, 310, "."), ("i", "c", 900, 910, "-")], "gene_id string, chrom string, start long, end long, strand string")
    of = lambda wild: sorted((r["locus_id"], r["nearest_id"], r["distance"]) for r in intervals.nearest_stranded(loci, bodies, wild).collect())
    assert of(False) == [("a", "g", 89), ("b", "i", 789), ("b", "i", 789)]
    assert of(True) == [("a", "g", 89), ("b", "h", 189), ("b", "h", 189)]


def test_bridges(spark):
    loci = spark.createDataFrame([("l", "c", 100, 150, "+"), ("r", "c", 500, 550, "+"), ("o", "c", 310, 320, "+")], "locus_id string, chrom string, start long, end long, strand string")
    bodies = spark.createDataFrame([("g", "c", 300, 400)], "gene_id string, chrom string, start long, end long")
    exons_ = spark.createDataFrame([("g", 300, 330), ("g", 360, 400)], "gene_id string, start long, end long")
    introns = spark.createDataFrame([("c", 151, 299, "q1"), ("c", 151, 299, "q1"), ("c", 151, 359, "q2"), ("c", 152, 299, "q3"), ("c", 331, 499, "q4"), ("c", 401, 498, "q5")], "chrom string, start long, end long, fragment string")
    from spliceframe.operators import models

    got = {r["locus_id"]: r["bridges"] for r in models.bridge_support(models.open_gaps(loci, bodies), introns, exons_).collect()}
    assert got == {"l": 2, "r": 1, "o": 0}
