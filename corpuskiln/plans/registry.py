"""All core queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuskiln.plans import catalog_queries, graph_queries, references_queries, retrieval_queries, store_queries

MODULES = [references_queries, retrieval_queries, store_queries, graph_queries, catalog_queries]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["bm25_display"](spark, sf_dir)
