"""Writers and readers of text, hits from JSON, structures and routes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from spliceframe.operators import evidence
from spliceframe.sources.text import TextTableSink, read_peptides, read_table


@pytest.fixture(scope="module", autouse=True)
def sink(spark):
    spark.dataSource.register(TextTableSink)


def test_table_round_trip(spark, tmp_path):
    at = str(tmp_path / "out")
    rows = [(1, "a\tb\nc", 1.5, True), (2, None, None, None), (3, "NA", float("nan"), False), (4, "", 2.0, True)]
    df = spark.createDataFrame(rows, "id int, name string, x double, ok boolean").repartition(3)
    df.write.format("text_table").mode("overwrite").save(at)
    assert sorted(f for f in os.listdir(at) if not f.startswith("part")) == ["_SUCCESS"]
    back = read_table(spark, at, "id int, name string, x double, ok boolean, more string").orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a b c", 1.5, True, None), (2, None, None, None, None), (3, None, None, False, None), (4, None, 2.0, True, None)]
    assert [tuple(r) for r in read_table(spark, at).orderBy("id").collect()][1] == ("2", None, None, None)
    df.where("id = 1").write.format("text_table").mode("overwrite").option("na", "-").save(at)
    assert read_table(spark, at).count() == 1
    with pytest.raises(Exception, match="there is a result"):
        df.write.format("text_table").mode("append").save(at)
    assert read_table(spark, at).count() == 1 and not [f for f in os.listdir(at) if f.startswith("_staged")]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    at = str(tmp_path / "out")
    good = spark.range(4).withColumn("x", F.lit("old"))
    good.write.format("text_table").mode("overwrite").save(at)
    before = sorted(os.listdir(at))
    bad = spark.range(400).repartition(8).select("id", F.when(F.col("id") == 399, F.raise_error(F.lit("broken row"))).otherwise("new").alias("x"))
    with pytest.raises(Exception, match="broken row"):
        bad.write.format("text_table").mode("overwrite").save(at)
    assert sorted(f for f in os.listdir(at) if not f.startswith("_staged")) == before and {r["x"] for r in read_table(spark, at).collect()} == {"old"}


def test_peptides(spark, tmp_path):
    at = str(tmp_path / "pep")
    rows = [("L1|L1.1|130", "M" * 130), ("L2|L2.1|60", "K" * 60), ("L3|t|0", ""), ("L4|t|9", None)]
    spark.createDataFrame(rows, "id string, sequence string").write.format("text_table").option("kind", "fasta").mode("overwrite").save(at)
    text = "".join(open(f"{at}/{f}").read() for f in sorted(os.listdir(at)) if f.endswith(".fa"))
    assert max(map(len, text.splitlines())) == 60 and text.count(">") == 3
    got = {r["locus_id"]: (r["transcript_id"], r["aa"], r["sequence"]) for r in read_peptides(spark, f"{at}/*.fa").collect()}
    assert got == {"L1": ("L1.1", 130, "M" * 130), "L2": ("L2.1", 60, "K" * 60), "L3": ("t", 0, "")}
    with pytest.raises(Exception, match="id and sequence"):
        spark.range(2).write.format("text_table").option("kind", "fasta").mode("overwrite").save(str(tmp_path / "x"))


def test_hits(spark):
    bodies = [
        ("a", json.dumps({"results": [{"hits": [{"acc": "PF00001.12", "name": "x", "desc": "d", "evalue": 1e-9}, {"acc": "PF2", "evalue": "0.5"}], "more": {"deep": [1]}}, {"hits": None}]})),
        ("b", json.dumps([{"target": "t1", "eval": "1e-5", "prob": 0.9, "description": "q"}, {"target": "t2", "eval": 1e-6, "prob": "0.4"}, {"target": "t3", "eval": "1e-5", "prob": 95}, {"target": "t4"}])),
        ("c", "not json {"),
        ("d", None),
        ("e", "[]"),
        ("f", json.dumps({"alignments": [{"acc": f"X{k}", "evalue": 10.0**-k} for k in range(9)] + [None]})),
    ]
    found = evidence.hits(spark.createDataFrame(bodies, "locus_id string, body string")).cache()
    got = {(r["locus_id"], r["acc"], r["evalue"]) for r in found.collect()}
    assert got >= {("a", "PF00001", 1e-9), ("a", "PF2", 0.5), ("b", "t1", 1e-5), ("b", "t3", 1e-5)} and {x[0] for x in got} == {"a", "b", "f"} and len(got) == 14
    families = [(r["locus_id"], r["rank"], r["acc"]) for r in evidence.best_hits(found).orderBy("locus_id", "rank").collect()]
    assert [x for x in families if x[0] != "b"] == [("a", 1, "PF00001"), *[("f", k, f"X{9 - k}") for k in range(1, 6)]]
    strict = evidence.best_hits(found, evidence.STRUCTURE_EVALUE, evidence.STRUCTURE_PROB)
    assert [(r["locus_id"], r["acc"], r["prob"]) for r in strict.orderBy("rank").collect()] == [("b", "t3", 95.0), ("b", "t1", 0.9)]
    loci = spark.createDataFrame([("a", "g"), ("b", None)], "locus_id string, gene_id string")
    told = evidence.function_table(loci, spark.createDataFrame([("g", "known"), ("g", "also")], "gene_id string, text string"), found).orderBy("locus_id").collect()
    assert [(r["curated"], r["structure_hit"]) for r in told] == [("also", None), (None, "t3")]


def atom(name, b, kind="ATOM  "):
    return f"{kind}{1:5d} {name:^4s} ALA A{1:4d}    {0:8.3f}{0:8.3f}{0:8.3f}{1:6.2f}{b:6.2f}"


def test_plddt(spark):
    lines = [("hundred", atom("CA", b)) for b in (90, 70.5)] + [("hundred", atom("CB", 1)), ("hundred", atom("CA", 3, "HETATM"))]
    lines += [("one", atom("CA", b)) for b in (0.9, 0.5)] + [("none", atom("N", 50)), ("none", "TER"), ("none", None), ("bad", atom("CA", 5)[:60] + "  x.yz")]
    got = {r["locus_id"]: (r["n_ca"], r["plddt"]) for r in evidence.mean_plddt(spark.createDataFrame(lines, "locus_id string, value string")).collect()}
    assert got == {"hundred": (2, 80.25), "one": (2, pytest.approx(70.0)), "none": (0, None), "bad": (0, None)}


def test_routes(spark):
    loci = [("a", "protein_coding", "G", "P1"), ("b", "protein_coding", "G", None), ("c", "protein_coding", "", "P1"), ("d", "annotated", "G", "P1"), ("e", "none", None, None), ("f", "none", None, None), ("g", "none", None, None)]
    peptides = [(x[0], "M" * 100) for x in loci[:5]] + [("e", "M" * 60), ("f", "M" * 401), ("g", "M" * 49), ("h", "M" * 90)]
    d = spark.createDataFrame
    plan = evidence.fold_plan(d(peptides, "locus_id string, sequence string"), d(loci, "locus_id string, named_overlap string, gene_id string, protein_id string"), d([(x,) for x in "abcdefg"], "locus_id string"))
    assert {r["locus_id"]: (r["aa"], r["route"]) for r in plan.collect()} == {"a": (100, "model"), "b": (100, "fold"), "e": (100, "fold"), "f": (401, "skipped")}


def test_orphans(spark):
    d = lambda rows: spark.createDataFrame(rows, "locus_id string, named_overlap string, longest_orf_aa int")
    parts = [d([("a", "none", 80), ("b", "none", 20), ("c", "annotated", 90)]), d([("b", "none", 99), ("c", "none", 99), ("d", None, 60), ("e", "none", 60)])]
    ranked = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 30), ("e", 31)], "locus_id string, rank int")
    assert sorted(r["locus_id"] for r in evidence.orphans(parts, ranked).collect()) == ["a", "d"]
