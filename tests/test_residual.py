"""The residual build against plain loops over lists, and the rules of its clip, knife and walk one by one."""

import random

import pytest

from spliceframe.operators import residual

BODIES = "chrom string, strand string, start long, end long, gene_id string, biotype string"
JUNCTIONS = "node long, chrom string, strand string, start long, end long, support_sum long, n_detected long, control_max long"
TYPES = ["protein_coding", "lncRNA", "snRNA"]


def key(chrom):
    return {"M": "MT"}.get(chrom.removeprefix("chr"), chrom.removeprefix("chr"))


def plain(junctions, bodies, lengths, blocks, min_exon, max_exon):
    """id -> (chrom, start, end, strand, exons, introns, nearest, distance, members, shared sites)."""
    genes = [(key(c), s, a, b, g, t) for c, s, a, b, g, t in bodies]
    size = {key(c): n for c, n in lengths}
    between = lambda a, b, c, d: max(0, c - b - 1, a - d - 1)
    on = lambda c: [g for g in genes if g[0] == key(c)]
    chosen = [j for j in junctions if j[4] - j[3] + 1 >= 50 and not any(g[2] <= j[4] and j[3] <= g[3] for g in on(j[1]))]
    root = {j[0]: j[0] for j in chosen}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in chosen:
        for b in chosen:
            if (key(a[1]), a[2]) == (key(b[1]), b[2]) and (a[3], a[4], a[0]) < (b[3], b[4], b[0]):
                hole = b[3] - a[4] - 1
                free = not any(g[2] <= b[3] - 1 and a[4] + 1 <= g[3] for g in on(a[1]))
                if a[3] == b[3] or a[4] == b[4] or b[3] <= a[4] or (min_exon <= hole <= max_exon and free):
                    x, y = find(a[0]), find(b[0])
                    root[max(x, y)] = min(x, y)
    out = []
    for c in sorted({find(j[0]) for j in chosen}):
        members = [j for j in chosen if find(j[0]) == c]
        chain = []
        for j in sorted(members, key=lambda j: (-j[5], j[3], j[4])):
            if all(j[3] > e or s > j[4] for s, e in chain):
                chain.append((j[3], j[4]))
        chain.sort()
        chrom, strand, first, last = members[0][1], members[0][2], chain[0][0], chain[-1][1]
        near = lambda a, b, some: min(((between(a, b, g[2], g[3]), g[4]) for g in some), default=(None, None))
        if any(g[2] <= last and first <= g[3] for g in on(chrom)):
            continue
        d = near(first, last, [g for g in on(chrom) if g[1] == strand])[0]
        if (d is not None and d < 200) or any(g[5] in ("snRNA",) and between(first, last, g[2], g[3]) < 200 for g in on(chrom)):
            continue

        def exons(left, right):
            touched = [g for g in on(chrom) if left <= g[3] and g[2] <= first - 1]
            left = max([left] + [g[3] + 1 for g in touched])
            touched = [g for g in on(chrom) if last + 1 <= g[3] and g[2] <= right]
            right = min([right] + [g[2] - 1 for g in touched])
            left, right = (first if left > first - 1 else left), (last if right < last + 1 else right)
            starts, ends = [left] + [e + 1 for _, e in chain], [s - 1 for s, _ in chain] + [right]
            return [(s, e) for s, e in zip(starts, ends) if e >= s]

        stub = exons(max(1, first - 30), min(size[key(chrom)], last + 30))
        if len(stub) < 2:
            continue
        out.append([members, chrom, strand, chain, first, last, exons, stub])
    out.sort(key=lambda r: (-len(r[0]), -sum(j[5] for j in r[0]), -max(j[6] for j in r[0]), key(r[1]), r[7][0][0], r[7][-1][1], r[2], min(j[0] for j in r[0])))
    found = {}
    for n, (members, chrom, strand, chain, first, last, exons, whole) in enumerate(out, 1):
        if blocks is not None:
            mine = [b for b in blocks if key(b[0]) == key(chrom) and (b[3] is None or strand == "." or b[3] == strand)]

            def walk(at, step):
                reach, hole = 0, 0
                for k in range(1, 2001):
                    if any(b[1] <= at + step * k <= b[2] for b in mine):
                        reach, hole = k, 0
                    else:
                        hole += 1
                        if hole > 20:
                            break
                return reach

            left = min(max(1, first - 30), first - walk(first, -1))
            right = max(min(size[key(chrom)], last + 30), min(size[key(chrom)], last + walk(last, 1)))
            whole = exons(left, right)
            if len(whole) < 2:
                continue
        start, end = whole[0][0], whole[-1][1]
        some = [g for g in on(chrom) if strand == "." or g[1] == strand]
        nearest = min(((between(start, end, g[2], g[3]), g[4]) for g in some), default=(None, None))
        sites = [[j[k] for j in members] for k in (3, 4)]
        shared = sum(1 for side in sites for v in set(side) if side.count(v) > 1)
        text = lambda x: ",".join(f"{a}-{b}" for a, b in x)
        found[f"RSDL.{n}"] = (chrom, start, end, strand, len(members), len(whole), sum(e - s + 1 for s, e in whole), text(whole), text(chain), nearest[1], nearest[0], sum(j[5] for j in members), shared)
    return found


def case(seed):
    r = random.Random(seed)
    chroms = [("chr1", 60_000), ("chrM", 9_000)]
    bodies = [(c if r.random() < 0.7 else key(c), r.choice("+-."), a := r.randint(1, n), a + r.randint(5, 250), f"g{k}", r.choice(TYPES)) for k, (c, n) in enumerate(r.choice(chroms) for _ in range(28))]
    junctions = []
    for k in range(150):
        c, n = r.choice(chroms)
        s = r.choice([r.randint(31, n - 400), *[j[3] for j in junctions[-3:] if j[1] == c]])
        junctions.append((k, c, r.choice("+-."), s, s + r.randint(30, 260), r.randint(2, 9), r.randint(1, 4), r.choice([0, 0, 3])))
    junctions.append((999, "chrM", "+", 8_700, 8_990, 5, 2, 0))
    blocks = [(c, a := r.randint(1, n), a + r.randint(10, 90), r.choice(["+", "-", None])) for c, n in (r.choice(chroms) for _ in range(900))]
    return junctions, bodies, chroms, blocks


@pytest.mark.parametrize("seed,walk", [(1, True), (2, False), (3, True)])
def test_build_against_plain_loops(spark, seed, walk):
    junctions, bodies, lengths, blocks = case(seed)
    d = lambda rows, kind: spark.createDataFrame(rows, kind)
    covered = d(blocks, "chrom string, start long, end long, strand string") if walk else None
    got = residual.build(d(junctions, JUNCTIONS), d(bodies, BODIES), d(lengths, "chrom string, length long"), covered, 30, 600)
    assert got.columns == residual.COLUMNS
    rows = got.collect()
    want = plain(junctions, bodies, lengths, blocks if walk else None, 30, 600)
    told = {r["residual_id"]: tuple(r[c] for c in ("chrom", "start", "end", "strand", "n_junctions", "n_exons", "length_nt", "exon_structure", "intron_structure", "nearest_id", "nearest_distance", "treat_sum", "n_shared_site")) for r in rows}
    assert told == want and len(want) > 5
    assert all(r["status"] == "unassembled" and (r["cohort"] == "shared") == (r["control_max"] > 0) and (r["control_n_detected"] > 0) == (r["control_max"] > 0) for r in rows)


def test_clip_takes_the_nearest_body_of_each_side_in_any_order(spark):
    loci = spark.createDataFrame([("a", "1", 100, 900, 200, 800), ("b", "1", 150, 950, 160, 940), ("c", "2", 1, 50, 20, 30)], "locus_id string, chrom string, left long, right long, first long, last long")
    rows = [("1", 90, 120), ("1", 130, 140), ("1", 105, 110), ("1", 860, 870), ("1", 840, 2000), ("1", 300, 400), ("2", 15, 25)]
    for order in (rows, rows[::-1]):
        bodies = spark.createDataFrame(order, "chrom string, start long, end long")
        got = {r["locus_id"]: (r["left"], r["right"]) for r in residual.clip_terminals(loci, bodies).collect()}
        assert got == {"a": (141, 839), "b": (150, 839), "c": (26, 50)}
    assert residual.clip_terminals(loci, bodies.where("false")).where("left = 100 AND right = 900").count() == 1


def test_walk_of_each_side(spark):
    loci = spark.createDataFrame([("a", "1", "+", 5000, 6000), ("b", "1", ".", 5000, 6000), ("c", "1", "-", 50, 60)], "locus_id string, chrom string, strand string, first long, last long")
    blocks = [("1", 4990, 4999, "+"), ("1", 4960, 4969, "+"), ("1", 4930, 4938, None), ("1", 6005, 6100, "-"), ("1", 6110, 9000, None)]
    got = {r["locus_id"]: (r["left"], r["right"]) for r in residual.walked(loci, spark.createDataFrame(blocks, "chrom string, start long, end long, strand string")).collect()}
    assert got == {"a": (4960, None), "b": (4960, 8000), "c": (None, None)}


def test_counts_that_are_not_told(spark):
    j = spark.createDataFrame([(1, 3, None), (2, 0, 0), (3, None, None)], "node long, control_max long, control_n_detected long")
    got = {r["node"]: (r["control_max"], r["control_n_detected"], r["support_sum"]) for r in residual.defaults(j).collect()}
    assert got == {1: (3, 1, 0), 2: (0, 0, 0), 3: (0, 0, 0)}
    assert residual.defaults(j.select("node")).where("n_detected = 0").count() == 3


def test_no_genes_and_no_junctions(spark):
    junctions, bodies, lengths, _ = case(4)
    d = lambda rows, kind: spark.createDataFrame(rows, kind)
    got = residual.build(d(junctions, JUNCTIONS), d([], BODIES), d(lengths, "chrom string, length long"), None, 30, 600).collect()
    want = plain(junctions, [], lengths, None, 30, 600)
    assert {r["residual_id"]: r["exon_structure"] for r in got} == {k: v[7] for k, v in want.items()} and all(r["nearest_id"] is None for r in got)
    assert residual.build(d([], JUNCTIONS), d(bodies, BODIES), d(lengths, "chrom string, length long")).count() == 0


def test_cut_computes_once_and_keeps_no_second_copy(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from spliceframe.operators.storage import cut

    def refuse(*args, **kwargs):
        raise AssertionError("a second copy")

    monkeypatch.setattr(DataFrame, "persist", refuse)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    held = cut(spark.range(1000).repartition(3).mapInArrow(count, "id long"))
    assert held.count() == 1000 and held.agg({"id": "sum"}).first()[0] == 499500 and seen.value == 1000
