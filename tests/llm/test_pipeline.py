import pytest
from pyspark.sql import functions as F

import corpus_pipeline


def test_pipeline_keeps_columns_and_packs_what_is_left(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"] for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        ids = [r["doc_id"] for r in docs.collect()]
        assert set(ids) <= seen and len(ids) == len(set(ids))
        seen = set(ids)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == seen
    assert corpus_pipeline.run(spark, sf_dir).where("start = 0").count() == len(seen)


CLASHING = ["_id", "_row", "_key", "id", "score", "held_out", "predicted", "keys", "_back", "_at", "text_id", "_gone", "_doc", "spans", "found", "contaminated", "n_hit"]
AWKWARD = [None, "", " \n", "one", "again and again here it stands", "again and again here it stands", "y" * 300_000, "漢字 " * 20_000, "password: hunter22hunter\xa0x"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, "en", None, None) for k, t in enumerate(AWKWARD)] + [(None, "no id of its own", None, "s", 3), (4, AWKWARD[4], "en", "s", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_odd_rows_and_foreign_columns(spark, odd, name, stage):
    got = stage(spark, odd, "/root/testdata/sf0.001")
    assert got.columns == odd.columns
    rows = got.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in rows)
    assert ids == ([-1, 0, 1, 2, 3, 4, 6, 7, 8] if name == "near_duplicates" else [-1, 0, 1, 2, 3, 4, 4, 5, 6, 7, 8])
    empty = stage(spark, odd.where("false"), "/root/testdata/sf0.001")
    assert empty.columns == odd.columns and empty.count() == 0


def test_packing_of_odd_and_no_rows(spark, odd):
    pack = corpus_pipeline.STAGES[-1][1]
    assert pack(spark, odd, "").where("start = 0").count() == odd.count()
    assert pack(spark, odd.where("false"), "").count() == 0
