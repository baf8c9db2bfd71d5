"""From raw documents to packed training sequences, as five stages that each keep what the one before has kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceframe.llm import decontaminate, near_duplicates, packing, secrets, toxicity
from spliceframe.llm.common import shared_dir, table
from spliceframe.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays under the threshold.

    Null and empty texts stay (an empty bag isn't toxic); repeated rows are judged alike; without labels nothing goes;
    an empty table stays empty. The result
    has the columns of docs, those by the operator's own names (score, held_out, predicted) as they were.
    """
    aside = {c: f"_kept_{c}" for c in docs.columns if c in ("score", "held_out", "predicted")}
    scored = toxicity.score(docs.withColumnsRenamed(aside), toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.where("predicted = 0").drop("score", "held_out", "predicted").withColumnsRenamed({b: a for a, b in aside.items()}).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the least doc_id.

    Null and empty texts all stay, each a class of its own; of rows that repeat doc_id and text one stays; ties go to
    the lesser text id; an empty table stays empty.
    """
    return near_duplicates.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in benchmark windows.

    Null and empty texts have no words and stay; repeated rows are judged alike; an empty benchmark drops nothing.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and n_chars counted anew; null texts stay null and empty ones empty, rows repeat as before."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences: a null or empty text is its end id alone, repeated rows are packed each, no documents give no rows."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_copies), ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("packing", pack)]

#: Models, sketches and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
