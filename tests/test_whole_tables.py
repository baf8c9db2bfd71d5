"""Queries against brute force over whole texts and all rows."""

import math
import random

import pytest

from spliceframe.functions import sequences as S
from spliceframe.operators import intervals
from spliceframe.plans.bridge import view
from spliceframe.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def complement(s):
    return s[::-1].translate(str.maketrans("ACGTU", "TGCAA"))


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    r = random.Random(4)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    # letters after 600 other characters; an open frame past 400 bases; 30,000 bases
    raw = ["1 " * 300 + dna(500), "T" * 402 + "ATG" + "GCA" * 200 + "TAA" + dna(90), dna(30_001), dna(399), "", None]
    folder = str(tmp_path_factory.mktemp("documents"))
    spark.createDataFrame(list(enumerate(raw)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    table = str.maketrans("BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGACGTCGTACGT")
    return folder, {k: "".join(c for c in t or "" if c.isalpha()).upper().translate(table) for k, t in enumerate(raw)}


def orf(s):
    best = []
    for f in range(3):
        c, stop = [s[i : i + 3] for i in range(f, len(s) - 2, 3)], None
        for k in range(len(c) - 1, -1, -1):
            if c[k] == "ATG":
                best.append((k - (len(c) if stop is None else stop), f, 3 * k + f, stop is not None))
            stop = k if c[k] in S.STOPS else stop
    return min(best, default=None)


def fickett(s):
    step = lambda v, cuts, scores: next((x for c, x in zip(cuts, scores) if v >= c), scores[-1])
    total = 0.0
    for b in "ACGT":
        n = [s[k::3].count(b) for k in range(3)]
        total += step(max(n) / (min(n) + 1), S.POSITION_CUTS, S.POSITION[b]) * S.POSITION_WEIGHT[b] + step(sum(n) / len(s), S.CONTENT_CUTS, S.CONTENT[b]) * S.CONTENT_WEIGHT[b]
    return total


def hexamers(s):
    share = lambda x, b: (6 - x.count(b) + 1) / 7 + 1e-8
    found = [math.log2(share(x, "G") / share(x, "A")) for x in (s[k : k + 6] for k in range(0, len(s) - 5, 3)) if "CC" not in x]
    return sum(found) / len(found)


def splices(k, s):
    good = 0
    for j in range(8):
        a, e = j * 13 + 1, j * 13 + 1 + (k + j) % 12
        left, right = s[a - 1 : a + 1], s[e - 2 : e]
        don, acc = (complement(right), complement(left)) if k % 2 else (left, right)
        good += e >= a + 3 and don in ("GT", "GC") and acc == "AG"
    return good / 8


def test_sequences_are_read_whole(spark, texts):
    folder, seqs = texts
    amino = {a + b + c: S.AMINO[16 * i + 4 * j + k] for i, a in enumerate(S.BASES) for j, b in enumerate(S.BASES) for k, c in enumerate(S.BASES)}
    got = lambda name: {r[0]: r[1] if len(r) == 2 else tuple(r[1:]) for r in QUERIES[name](spark, folder).collect()}
    long = lambda n: {k: s for k, s in seqs.items() if len(s) >= n}
    part = {k: s[:20] + s[40:60] for k, s in seqs.items()}
    assert got("reverse_complement") == {k: complement(s) for k, s in seqs.items()}
    assert got("seq_fetch_substring") == {k: s[10 + k % 50 :][:30] for k, s in long(100).items()}
    assert got("spliced_sequence") == {k: complement(s) if k % 2 else s for k, s in part.items()}
    assert got("translate_codons") == {k: "".join(amino[s[i : i + 3]] for i in range(0, len(s) - 2, 3)).replace("*", "") for k, s in long(3).items()}
    assert {k: (-v[0], *v[1:]) for k, v in got("longest_orf").items()} == {k: orf(s) for k, s in seqs.items() if orf(s)}
    assert got("fickett_score") == pytest.approx({k: fickett(s) if len(s) > 1 else 0.0 for k, s in seqs.items()}, abs=2e-6)
    assert got("hexamer_llr") == pytest.approx({k: hexamers(s) for k, s in long(6).items()}, abs=2e-6)
    assert got("splice_fraction") == pytest.approx({k: splices(k, s) for k, s in long(130).items()}, abs=2e-6)


def test_validate_arrays_covers_all_orders(spark):
    keys = [r[0] for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey").collect()]
    got = QUERIES["validate_arrays"](spark, SF).collect()
    assert sorted(r["obs_id"] for r in got) == sorted(keys) and all(r["good"] for r in got)


def test_clip_intervals_keeps_every_locus(spark):
    loci = view(spark, SF, "loci").collect()
    top = {}
    for x in loci:
        top[x["chrom"]] = max(top.get(x["chrom"], 0), x["end"])
    want = sorted((x["locus_id"], max(1, x["start"] - 300), min(x["end"] + 300, top[x["chrom"]])) for x in loci)
    assert sorted(map(tuple, QUERIES["clip_intervals"](spark, SF).collect())) == want


def test_clip_leaves_unknown_contigs_alone(spark):
    rows = [(1, "a", -5, 70), (2, "a", 90, 95), (3, "b", -5, 1 << 40), (4, None, 7, 9)]
    df, lengths = spark.createDataFrame(rows, "k int, chrom string, start long, end long"), spark.createDataFrame([("a", 60)], "chrom string, length long")
    assert sorted(tuple(x) for x in intervals.clip(df, lengths).select("k", "start", "end").collect()) == [(1, 1, 60), (2, 60, 60), (3, 1, 1 << 40), (4, 7, 9)]
