"""Queries of the training-data problems and the SQL that some of them are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.keys import canonical_key
from corpuskiln.llm import format_dedup, mixing, near_dups, packing, pair_defects, spam_pages, splitting
from corpuskiln.session import stage_table


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, defect) of every broken pair: its likeliest retained label."""
    return pair_defects.main_defect(p1_labels(spark, sf_dir), "record_id")


def p1_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, defect, posterior) of every retained label; a pair may have several."""
    return pair_defects.label_pairs(_read(spark, sf_dir, "qmd_expansion_sports"), "record_id", "query", "output")


def p1_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutoff of each defect, with precision and recall on the labelled pairs on which it was not chosen."""
    return pair_defects.cutoff_report(_read(spark, sf_dir, "qmd_expansion_sports"), "record_id", "query", "output")


def _p2_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    whole = None
    for table in ("qmd_expansion_personal_entities", "qmd_expansion_locations"):
        part = _read(spark, sf_dir, table).select(F.lit(table).alias("tbl"), "record_id", "query")
        whole = part if whole is None else whole.unionByName(part)
    form = F.concat(F.col("tbl"), F.lit("\x1e"), format_dedup.canonical_query(F.col("query")))
    return format_dedup.collapse_copies(whole, form, F.struct("tbl", "record_id"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per surplus record: (tbl, keep_id, copy_id)."""
    _, surplus = _p2_copies(spark, sf_dir)
    return surplus.select("copy.tbl", F.col("keep.record_id").alias("keep_id"), F.col("copy.record_id").alias("copy_id"))


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct query of each table: (tbl, keep_id, n_copies)."""
    records, _ = _p2_copies(spark, sf_dir)
    return records.select("keep.tbl", F.col("keep.record_id").alias("keep_id"), "n_copies")


def _p3(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return near_dups.similar_classes(_read(spark, sf_dir, "content"), canonical_key(F.col("hash")), F.col("doc"), width=3, threshold=0.7)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair (hash_a, hash_b) of bodies whose word triples overlap by 0.7 or more."""
    return near_dups.similar_pairs(*_p3(spark, sf_dir)).select(F.col("key_a").alias("hash_a"), F.col("key_b").alias("hash_b"))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per body with the group of near-duplicates that it belongs to and its class's number of links."""
    return near_dups.similar_groups(*_p3(spark, sf_dir)).withColumnRenamed("key", "hash")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(hash, kind) of every body above the limit; kind is hard where it holds a run without boundary above the limit."""
    content = _read(spark, sf_dir, "content").select(canonical_key(F.col("hash")).alias("hash"), "doc").where("hash is not null")
    plans = splitting.cut_plan(content, "doc", ["hash"])
    return plans.groupBy("hash").agg(F.min("kind").alias("kind"))


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every body above the limit, numbered and placed like content_vectors' seq and pos."""
    pieces = splitting.split_oversized(_read(spark, sf_dir, "content"), canonical_key(F.col("hash")), "doc", F.col("created_at"))
    return pieces.withColumnRenamed("key", "hash")


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every token of every document's text lies: (container, slot, doc_id, part, first_token, n_tokens)."""
    sized = packing.measure(_read(spark, sf_dir, "documents"), "doc_id", "text", ["source"])
    return packing.fill_containers(sized, "doc_id", "n_tokens", "source", "cluster")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens, the share of room used, what the rules on sources and copies cost, and how often they are broken (never)."""
    sized = stage_table(packing.measure(_read(spark, sf_dir, "documents"), "doc_id", "text", ["source"]), "measured")
    return packing.fill_report(packing.fill_containers(sized, "doc_id", "n_tokens", "source", "cluster"), sized, "doc_id", "source", "cluster")


def _p7(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sized = packing.measure(_read(spark, sf_dir, "documents"), "doc_id", "text", ["source"])
    return mixing.mix_sources(sized, _read(spark, sf_dir, "source_targets"), "doc_id", "source", "n_tokens", "cluster")


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the mixture and how often each is used."""
    return _p7(spark, sf_dir)[0]


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    return _p7(spark, sf_dir)[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id of every page made of keywords, links or tags instead of sentences."""
    return spam_pages.score_pages(_read(spark, sf_dir, "documents"), "doc_id", "text").where("spam").select("doc_id")


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's surprisal under the prose model, share of abnormal blocks and verdict."""
    return spam_pages.score_pages(_read(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {"p1_found": p1_found, "p1_labels": p1_labels, "p1_cutoffs": p1_cutoffs, "p2_found": p2_found, "p2_records": p2_records, "p3_found": p3_found, "p3_groups": p3_groups, "p4_found": p4_found, "p4_pieces": p4_pieces, "p6_containers": p6_containers, "p6_report": p6_report, "p7_mixture": p7_mixture, "p7_report": p7_report, "p8_found": p8_found, "p8_scores": p8_scores}

_P2 = r"""
WITH q AS (
  SELECT 'qmd_expansion_personal_entities' AS tbl, record_id, query FROM qmd_expansion_personal_entities WHERE query IS NOT NULL
  UNION ALL SELECT 'qmd_expansion_locations', record_id, query FROM qmd_expansion_locations WHERE query IS NOT NULL),
f AS (SELECT *, list_filter(regexp_split_to_array(query, '[;|\n\r]'), lambda x: regexp_matches(x, '[^\s\p{Z}]')) AS fields FROM q),
c AS (SELECT tbl, record_id, CASE WHEN len(fields) >= 2 AND len(list_filter(fields, lambda x: NOT regexp_matches(x, '^[\s\p{Z}]*[A-Za-z]+[\s\p{Z}]*:'))) = 0
    THEN 'L' || array_to_string(list_sort(list_transform(fields, lambda x: trim(regexp_replace(regexp_replace(lower(x), '[''’]', '', 'g'), '[^\p{L}\p{N}+#]+', ' ', 'g')))), chr(31))
    ELSE 'P' || trim(regexp_replace(regexp_replace(lower(query), '[''’]', '', 'g'), '[^\p{L}\p{N}+#]+', ' ', 'g')) END AS form FROM f)
"""
_KEY = "nullif(trim(regexp_replace(lower(trim(hash, ' ' || chr(9) || chr(10) || chr(13))), '^sha256:', '')), '')"
_P3 = f"""
WITH c AS (SELECT DISTINCT {_KEY} AS hash, doc FROM content WHERE doc IS NOT NULL AND {_KEY} IS NOT NULL),
w AS (SELECT row_number() OVER () AS id, hash, regexp_extract_all(lower(doc), '[\\p{{L}}\\p{{N}}]+') AS w FROM c),
t AS (SELECT id, hash, list_distinct(list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) AS s FROM w WHERE len(w) >= 3),
u AS (SELECT id, hash, len(s) AS n, unnest(s) AS x FROM t),
p AS (SELECT a.id AS i, b.id AS j, any_value(a.hash) AS hash_a, any_value(b.hash) AS hash_b, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS similarity FROM u a JOIN u b ON a.x = b.x AND a.hash < b.hash GROUP BY 1, 2)
"""
SQL = {
    "p3_found": _P3 + "SELECT DISTINCT hash_a, hash_b FROM p WHERE similarity >= 0.7",
    "p4_found": f"SELECT {_KEY} AS hash, min(CASE WHEN regexp_matches(regexp_replace(doc, '[^\\s\\p{{Z}}\\x1c-\\x1f\\x85。！？]', 'x', 'g'), 'x{{1000}}x{{1000}}x{{1000}}x{{601}}') THEN 'hard' ELSE 'soft' END) AS kind FROM content WHERE length(doc) > 3600 AND {_KEY} IS NOT NULL GROUP BY 1",
    "p2_found": _P2 + ", k AS (SELECT *, min(record_id) OVER (PARTITION BY tbl, form) AS keep_id FROM c) SELECT tbl, keep_id, record_id AS copy_id FROM k WHERE keep_id <> record_id",
    "p2_records": _P2 + "SELECT tbl, min(record_id) AS keep_id, count(*)::BIGINT AS n_copies FROM c GROUP BY tbl, form",
}
