"""All registered queries of the library and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidentia.plans import catalogs, checks, derived, han, ingest, modes, relational, reports, retrieval

PARTS = (retrieval, relational, derived, ingest, catalogs, modes, checks, han, reports)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for part in PARTS for k, v in part.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: v for part in PARTS for k, v in part.ORACLE_SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k best documents for each question by BM25."""
    return QUERIES["tk2_sparse_topk"](spark, sf_dir)
