"""Queries of problem 5, references to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.keys import canonical_key, instant, utc_month
from corpuskiln.operators.references import orphan_references, orphan_report


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, row_key, kind, ref_month) of every reference whose target is absent, deleted or younger."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    documents, content = read("documents"), read("content").select(canonical_key(F.col("hash")).alias("key"), instant(F.col("created_at")).alias("since"))
    removed = read("removed_content").select(canonical_key(F.col("hash")).alias("key"))
    body_refs = [
        documents.select(F.lit("documents").alias("tbl"), F.col("doc_id").cast("string").alias("row_key"), canonical_key(F.col("hash")).alias("ref"), instant(F.col("created_at")).alias("at")),
        read("content_vectors").select(F.lit("content_vectors").alias("tbl"), canonical_key(F.col("hash")).alias("ref"), F.col("seq"), instant(F.col("embedded_at")).alias("at")).select(
            "tbl", F.concat(F.col("ref"), F.lit("_"), F.coalesce(F.col("seq").cast("string"), F.lit(""))).alias("row_key"), "ref", "at"),
    ]
    to_content = orphan_references(body_refs[0].unionByName(body_refs[1]), content, [("ref", "key")], ref_time="at", target_time="since", removed=removed, removed_keys=["key"])
    to_documents = orphan_references(
        read("qmd_graph_capabilities").select(F.lit("qmd_graph_capabilities").alias("tbl"), F.col("capability_id").alias("row_key"), canonical_key(F.col("document_id")).alias("ref"), instant(F.col("created_at")).alias("at")),
        documents.select(canonical_key(F.col("document_id")).alias("key"), "active", instant(F.col("created_at")).alias("since")),
        [("ref", "key")], ref_time="at", target_time="since", alive=F.col("active"),
    )
    both = to_content.unionByName(to_documents)
    return both.select("tbl", "row_key", "kind", utc_month(F.col("at")).alias("ref_month")).distinct()


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, kind and month."""
    return orphan_report(p5_found(spark, sf_dir), ["tbl", "kind", "ref_month"])


def _composite(spark: SparkSession, sf_dir: str, match: str) -> DataFrame:
    caps = spark.read.parquet(f"{sf_dir}/qmd_graph_capabilities.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    refs = caps.select("capability_id", canonical_key(F.col("document_id")).alias("d"), canonical_key(F.col("content_hash")).alias("h"))
    own = docs.select(canonical_key(F.col("document_id")).alias("kd"), canonical_key(F.col("hash")).alias("kh"))
    orphans = orphan_references(refs, own, [("d", "kd"), ("h", "kh")], match=match)
    return orphans.withColumn("mask", F.concat(F.col("d").isNotNull().cast("int").cast("string"), F.col("h").isNotNull().cast("int").cast("string")))


def p5_partial_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every orphan of the composite reference (document_id, content_hash) to documents under MATCH PARTIAL, with its null mask."""
    return _composite(spark, sf_dir, "partial").select("capability_id", F.coalesce("d", F.lit("")).alias("d"), F.coalesce("h", F.lit("")).alias("h"), "kind", "mask")


def p5_full_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under MATCH FULL, where a partly null reference is an orphan: number per kind and mask."""
    return orphan_report(_composite(spark, sf_dir, "full"), ["kind", "mask"])


def p5_partial_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans under MATCH PARTIAL: number per kind and mask."""
    return orphan_report(_composite(spark, sf_dir, "partial"), ["kind", "mask"])


QUERIES = {"p5_found": p5_found, "p5_report": p5_report, "p5_partial_pairs": p5_partial_pairs, "p5_partial_orphans": p5_partial_orphans, "p5_full_pairs": p5_full_pairs}

_KEY = "nullif(trim(regexp_replace(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13))), '^sha256:', '')), '')"
_FOUND = f"""
WITH c AS (SELECT {_KEY.format(c='hash')} AS k, min(created_at::TIMESTAMPTZ) AS since FROM content GROUP BY 1),
r AS (SELECT DISTINCT {_KEY.format(c='hash')} AS k FROM removed_content),
d AS (SELECT {_KEY.format(c='document_id')} AS k, bool_or(coalesce(active, false)) AS alive, min(created_at::TIMESTAMPTZ) AS since FROM documents GROUP BY 1),
refs AS (
  SELECT 'documents' AS tbl, doc_id::VARCHAR AS row_key, {_KEY.format(c='hash')} AS k, created_at::TIMESTAMPTZ AS t FROM documents
  UNION ALL
  SELECT 'content_vectors', {_KEY.format(c='hash')} || '_' || seq::VARCHAR, {_KEY.format(c='hash')}, embedded_at::TIMESTAMPTZ FROM content_vectors),
b AS (
  SELECT tbl, row_key, t, CASE WHEN c.k IS NULL AND r.k IS NOT NULL THEN 'deleted' WHEN c.k IS NULL THEN 'missing' WHEN c.since > t THEN 'late' END AS kind
  FROM refs LEFT JOIN c ON c.k = refs.k LEFT JOIN r ON r.k = refs.k WHERE refs.k IS NOT NULL
  UNION ALL
  SELECT 'qmd_graph_capabilities', capability_id, q.created_at::TIMESTAMPTZ AS t, CASE WHEN d.k IS NULL THEN 'missing' WHEN NOT d.alive THEN 'deleted' WHEN d.since > q.created_at::TIMESTAMPTZ THEN 'late' END
  FROM qmd_graph_capabilities q LEFT JOIN d ON d.k = {_KEY.format(c='q.document_id')} WHERE {_KEY.format(c='q.document_id')} IS NOT NULL),
f AS (SELECT DISTINCT tbl, row_key, kind, strftime(make_timestamp((epoch(t) * 1000000)::BIGINT), '%Y-%m') AS ref_month FROM b WHERE kind IS NOT NULL)
"""
_PAIRS = f"""
WITH q0 AS (SELECT capability_id, {_KEY.format(c='document_id')} AS d, {_KEY.format(c='content_hash')} AS h FROM qmd_graph_capabilities),
q AS (SELECT *, (d IS NOT NULL)::INT::VARCHAR || (h IS NOT NULL)::INT::VARCHAR AS mask FROM q0),
t AS (SELECT {_KEY.format(c='document_id')} AS d, {_KEY.format(c='hash')} AS h FROM documents)
"""
_LOOSE = """((q.d IS NOT NULL AND q.h IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.d = q.d AND t.h = q.h))
   OR (q.d IS NOT NULL AND q.h IS NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.d = q.d))
   OR (q.d IS NULL AND q.h IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.h = q.h)))"""
SQL = {
    "p5_found": _FOUND + "SELECT tbl, row_key, kind, ref_month FROM f",
    "p5_report": _FOUND + "SELECT tbl, kind, ref_month, count(*)::BIGINT AS n_orphans FROM f GROUP BY 1, 2, 3",
    "p5_partial_pairs": _PAIRS + f"SELECT 'missing' AS kind, mask, count(*)::BIGINT AS n_orphans FROM q WHERE {_LOOSE} GROUP BY 1, 2",
    "p5_partial_orphans": _PAIRS + f"SELECT capability_id, coalesce(d, '') AS d, coalesce(h, '') AS h, 'missing' AS kind, mask FROM q WHERE {_LOOSE}",
    "p5_full_pairs": _PAIRS + f"SELECT CASE WHEN mask = '11' THEN 'missing' ELSE 'mixed' END AS kind, mask, count(*)::BIGINT AS n_orphans FROM q WHERE mask IN ('01', '10') OR (mask = '11' AND {_LOOSE}) GROUP BY 1, 2",
}
