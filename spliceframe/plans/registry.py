"""All queries of the library by name, and the DuckDB SQL each is held against."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from . import queries_core, queries_models, queries_scores
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship", "queries_core", "queries_models", "queries_scores"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recurrent junctions of the cohort with their nearest gene."""
    return QUERIES["nearest_same_strand"](spark, sf_dir)


