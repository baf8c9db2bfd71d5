"""Hexamer tables and the coding table against plain loops."""

import random
from collections import Counter
from math import log2

import pytest

from spliceframe.functions import sequences as S
from spliceframe.operators import coding
from spliceframe.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def orf(seq):
    best = None
    for f in range(3):
        cs = [seq[k : k + 3] for k in range(f, len(seq) - 2, 3)]
        for i, c in enumerate(cs):
            if c == "ATG":
                stop = next((j for j in range(i, len(cs)) if cs[j] in S.STOPS), None)
                n = (len(cs) if stop is None else stop) - i
                if best is None or n > best[0]:
                    best = (n, f + 3 * i, stop is not None)
    return best


def hexamers(seq):
    return [h for k in range(0, len(seq) - 5, 3) if set(h := seq[k : k + 6]) <= set("ACGT")]


def test_table_file(spark, tmp_path):
    p = tmp_path / "h.tsv"
    p.write_text("Hexamer\tcoding\tnoncoding\nacgtac\t0.5\t0\n\nTTTTTT\t0\t0.25\n")
    rows = coding.read_hexamers(spark, str(p)).orderBy("hexamer").collect()
    assert [tuple(r) for r in rows] == [("ACGTAC", 0.5, 0.0), ("TTTTTT", 0.0, 0.25)]
    for bad in ("ACGTA\t1\t1", "ACGTAN\t1\t1", "ACGTAC\t1", "ACGTAC\tx\t1", "ACGTAC\t-1\t1", "ACGTAC\tnan\t1", "ACGTAC\tinf\t1"):
        p.write_text(f"hexamer\tc\tn\n{bad}\n")
        with pytest.raises(Exception, match="bad hexamer row"):
            coding.read_hexamers(spark, str(p)).collect()


def test_coding_table(spark):
    r = random.Random(2)
    seqs = ["".join(r.choice("ACGT" * 6 + "N") for _ in range(r.randint(0, 400))) for _ in range(120)] + ["", "ATG", "ATGTAA", "CCCATGAAATTT", "atgaaacccgggtttaaataa", None, "TTT"]
    kept = {k: (s or "").upper() for k, s in enumerate(seqs)}
    df = spark.createDataFrame([(f"L{k}", f"t{k:03d}", s) for k, s in enumerate(seqs)], "locus_id string, transcript_id string, seq string")
    orfs = {k: orf(s) for k, s in kept.items()}
    nt = {k: kept[k][o[1] : o[1] + 3 * o[0]] for k, o in orfs.items() if o}
    both = [Counter(h for s in group for h in hexamers(s)) for group in (nt.values(), kept.values())]
    llr = {h: log2((both[0][h] / sum(both[0].values()) + 1e-8) / (both[1][h] / sum(both[1].values()) + 1e-8)) for h in {*both[0], *both[1]}}
    table = coding.count_hexamers(spark.createDataFrame([(s,) for s in nt.values()], "seq string"), df)
    assert {x["hexamer"]: (x["coding"], x["noncoding"]) for x in table.collect()} == {h: (pytest.approx(both[0][h] / sum(both[0].values())), pytest.approx(both[1][h] / sum(both[1].values()))) for h in llr}
    part = table.where("hexamer NOT LIKE '%CC%'")
    got = {x["transcript_id"]: x for x in coding.coding_table(df, part, -0.1, 0.1).collect()}
    assert len(got) == len(seqs)
    for k, o in orfs.items():
        x = got[f"t{k:03d}"]
        if o is None:
            assert (x["longest_orf_aa"], x["complete"], x["coding_score"], x["fickett"], x["coding_label"], x["peptide"]) == (0, False, None, None, "noncoding", "")
            continue
        held = [llr[h] for h in hexamers(nt[k]) if "CC" not in h]
        want = sum(held) / len(held) if held else None
        assert (x["longest_orf_aa"], x["complete"]) == (o[0], o[2]) and x["coding_score"] == (pytest.approx(want) if held else None)
        assert x["coding_label"] == ("noncoding" if want is None or want < -0.1 else "coding" if want > 0.1 else "ambiguous")
        assert len(x["peptide"]) == o[0] and x["peptide"][0] == "M"
    records = coding.peptide_records(spark.createDataFrame(list(got.values())), 3).collect()
    assert len(records) == sum(bool(o) and o[0] >= 3 for o in orfs.values()) and ("L124|t124|6", "MKPGFK") in map(tuple, records)
    with pytest.raises(Exception, match="no rows"):
        coding.coding_table(df, table.where("false")).collect()


def test_frames_and_sums_in_one_pass(spark):
    r = random.Random(3)
    seqs = ["".join(r.choice("ACGT" * 9 + "NU\u00df\U0001d4d0") for _ in range(r.randint(0, 3000))) for _ in range(60)] + ["", "A", "AT", "ATG", "ATGTAA", None]
    df = spark.createDataFrame(list(enumerate(seqs)), "k int, seq string").repartition(3)
    want = {k: orf((s or "").upper()) for k, s in enumerate(seqs)}
    assert {x["k"]: (x["aa"], x["start"], x["complete"]) for x in S.longest_orfs(df, "k").collect()} == {k: o for k, o in want.items() if o}
    table = spark.createDataFrame([("ACGTAC", 0.5, 0.25), ("TTTTTT", 0.0, 1.0)], "hexamer string, coding double, noncoding double")
    llr = {x["hexamer"]: log2((x["coding"] + 1e-8) / (x["noncoding"] + 1e-8)) for x in table.collect()}
    got = {x["k"]: x["coding_score"] for x in coding.hexamer_scores(df, "k", "seq", table).collect()}
    for k, s in enumerate(seqs):
        held = [llr[h] for h in hexamers((s or "").upper()) if h in llr]
        assert got[k] == (pytest.approx(sum(held) / len(held)) if held else None)
    # a row without a key has no frame but counts among all sequences
    unnamed = spark.createDataFrame([("L", None, "ATGAAA"), ("L", "t", "ATGAAA")], "locus_id string, transcript_id string, seq string")
    assert sorted(map(tuple, coding.reading_frames(unnamed).collect()), key=str) == [("L", "t", 2, False, "ATGAAA"), ("L", None, None, None, None)]


def test_orf_coding_reads_frames_without_joins(spark):
    plan = QUERIES["orf_coding"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "regexp_replace" not in plan


def test_hexamer_llr_makes_no_row_of_a_hexamer(spark, tmp_path):
    plan = QUERIES["hexamer_llr"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    # rows that share an id are averaged together; one whose hexamers all hold CC has no row
    rows = [(1, "AAAAAAAGC"), (1, "GGGGGG"), (2, "CCCCCCCCC"), (3, "AAAAA"), (None, "AAAAAA"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    share = lambda x, b: (len(x.replace(b, "")) + 1) / 7 + 1e-8
    llr = lambda x: log2(share(x, "G") / share(x, "A"))
    want = {1: sum(map(llr, ("AAAAAA", "AAAAGC", "GGGGGG"))) / 3, None: llr("AAAAAA")}
    assert {r[0]: r[1] for r in QUERIES["hexamer_llr"](spark, str(tmp_path)).collect()} == pytest.approx(want, abs=1e-6)
