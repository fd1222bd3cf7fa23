"""Queries of catalog reductions, samples, lineage ids and level checks, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.functions.keys import canonical_key, instant
from corpuskiln.operators import catalog, evaluation, graph
from corpuskiln.plans import graph_queries as G
from corpuskiln.plans.retrieval_queries import _distance
from corpuskiln.sources import sinks


def _read(spark: SparkSession, d: str, t: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{t}.parquet")


def _artifacts(spark, d) -> DataFrame:
    c = _read(spark, d, "qmd_graph_capabilities")
    return c.select("book_id", F.coalesce("ready", F.lit(False)).alias("ready"), F.explode_outer(graph.id_array(F.col("artifact_ids"))).alias("artifact"))


def artifact_subset(spark, d):
    """Whether all artifacts of a book's unready capabilities are among those of its ready ones."""
    a = _artifacts(spark, d)
    return catalog.subset_by_group(a.where("not ready"), a.where("ready"), "book_id", "artifact")


def stale_catalogs(spark, d):
    """Books whose ready capabilities do not name exactly the documents that all of them name."""
    c = _read(spark, d, "qmd_graph_capabilities").select("book_id", canonical_key(F.col("document_id")).alias("document"), "ready")
    return catalog.stale_sets(c.where("ready"), c, "book_id", "document")


def _models(spark, d) -> DataFrame:
    e = _read(spark, d, "events")
    return e.groupBy(F.concat(F.lit("model-"), F.col("user_id").cast("string")).alias("model")).agg(F.count(F.lit(1)).alias("attempts"), F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("tokens"))


def model_metrics_cap(spark, d):
    """The 32 models with most attempts, then most tokens."""
    return catalog.top_metrics(_models(spark, d), "attempts", "tokens", "model")


def model_totals(spark, d):
    """Number of models, attempts and tokens over all of them."""
    return catalog.metric_totals(_models(spark, d), "model", ["attempts", "tokens"])


def recovery_summary(spark, d):
    """State of each user's events with what waits for them."""
    e = _read(spark, d, "events").select(F.col("user_id").alias("item"), "event_type", (F.col("event_type") == "error").alias("retryable"), F.col("event_id").alias("retry_at"), F.get_json_object("props", "$.k").cast("bigint").alias("wait"))
    r = catalog.recovery_summary(e, e.where("event_type = 'click'"), "item", "event_type", "retryable", "retry_at", "wait", "retry_at")
    return r.select("item", "status", "retryable", F.coalesce("next_retry_at", F.lit(-1)).alias("next_retry_at"), "slots", F.coalesce("longest_wait", F.lit(-1)).alias("longest_wait"), F.coalesce("generation", F.lit(-1)).alias("generation"))


def recovery_totals(spark, d):
    """Events by type, retryable ones and the first of these."""
    e = _read(spark, d, "events").select("event_type", (F.col("event_type") == "error").alias("retryable"), F.col("event_id").alias("retry_at"))
    return catalog.recovery_totals(e, "event_type", "retryable", "retry_at").select("event_type", "n", "retryable", F.coalesce("next_retry_at", F.lit(-1)).alias("next_retry_at"))


def rating_histogram(spark, d):
    """Events by the rating of their value."""
    return catalog.rating_histogram(_read(spark, d, "events"), "value")


def throughput(spark, d):
    """Median duration and events a second by type, values taken as milliseconds."""
    t = catalog.throughput(_read(spark, d, "events"), "event_type", "value", F.lit(1))
    return t.select("event_type", "runs", F.round("median_ms", 4).alias("median_ms"), F.round("documents_per_second", 4).alias("documents_per_second"))


def vector_sample(spark, d):
    """A seeded sample of a hundred vectors for an audit."""
    return catalog.seeded_sample(_read(spark, d, "embeddings").select("vec_id", "label"), "vec_id", 100)


def adopted_fingerprints(spark, d):
    """Vectors by fingerprint after those without one were adopted, as the sample embeds as before."""
    v = _read(spark, d, "embeddings").select("vec_id", "embedding", F.when(F.col("label") > 4, "a41c07").otherwise("").alias("embed_fingerprint"))
    sample = v.where("embed_fingerprint = ''").orderBy("vec_id").limit(1).first()
    after = catalog.adopt_fingerprint(v, "vec_id", "embedding", "embed_fingerprint", sample["vec_id"], list(sample["embedding"]), "f00d42")[0]
    return after.groupBy("embed_fingerprint").agg(F.count(F.lit(1)).alias("n"))


def lineage_ids(spark, d):
    """Lineage id of every document and identity of its text as one piece."""
    h = canonical_key(F.col("hash"))
    piece = catalog.chunk_identity(F.col("document_id"), h, F.lit(0), F.lit(0), F.coalesce(F.length("text"), F.lit(0)))
    return _read(spark, d, "documents").select("doc_id", F.when(h.isNotNull(), catalog.document_lineage_id(h, F.col("source"))).alias("lineage"), piece.alias("piece"))


def output_scores(spark, d):
    """Simple score of every sports expansion."""
    s = _read(spark, d, "qmd_expansion_sports").where("output is not null")
    return s.select("record_id", catalog.output_score(evaluation.expansion_text(F.filter("output", lambda x: x["text"].isNotNull()))).alias("score"))


def sensitive_fields(spark, d):
    """Sensitive values by column, and columns with a forbidden name."""
    t = _read(spark, d, "documents").select("path", "title", "text", F.col("lang").alias("rawPrompt"))
    return graph.sensitive_columns(t)


def _shelf_reports(spark, d) -> DataFrame:
    return G._reports(spark, d).withColumn("member", F.upper(F.left("member", F.lit(1))))


def library_rollup(spark, d):
    """Communities and overview of the level above shelves (collections by their first letter)."""
    level = graph.library_level(_shelf_reports(spark, d), "shelf-1", "gen-1")
    per = level["communities"].select("member", "n_units", F.round("rank", 3).alias("rank"), F.left("summary", F.lit(80)).alias("summary"))
    return per.unionByName(level["overview"].select(F.lit("overview").alias("member"), "n_units", F.round("rank", 3).alias("rank"), F.left("summary", F.lit(80)).alias("summary")))


def level_problems(spark, d):
    """What is wrong with capabilities as edges and references as evidence of the documents as units."""
    key = canonical_key(F.col("document_id"))
    units = _read(spark, d, "documents").select(key.alias("unit_id"), "source", F.col("source").alias("member"), F.when(F.col("active"), "g1").otherwise("g0").alias("generation"))
    caps = _read(spark, d, "qmd_graph_capabilities").select(key.alias("l"), "kind", "capability_id").where("l is not null")
    edges = caps.where("kind = 'graph_query'").select(F.col("l").alias("left"), F.col("l").alias("right"))
    return catalog.level_problems(units, edges, caps.select(F.col("l").alias("unit_id")), _read(spark, d, "source_targets").select(F.col("source").alias("member")), "g1", 100, 10**9)


def text_unit_identity(spark, d):
    """The document of every vector row: by id, else by the base name of a title."""
    docs = _read(spark, d, "documents").select(canonical_key(F.col("document_id")).alias("document_id"), "path")
    caps = _read(spark, d, "qmd_graph_capabilities").select(F.col("capability_id").alias("unit_id"), canonical_key(F.col("document_id")).alias("document_id"), F.concat(F.lit("x/"), F.right("capability_id", F.lit(3)), F.lit(".md")).alias("title")).distinct()
    return catalog.text_unit_identity(caps, docs).groupBy(F.coalesce("how", F.lit("none")).alias("how")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("document_id").alias("documents"))


def portable_paths(spark, d):
    """Paths in five spellings as portable ones; null where they are not."""
    path = F.col("path")
    spelled = F.element_at(F.array(path, F.concat(F.lit("/"), path), F.concat(F.lit("a/../"), path), F.concat(F.lit("./"), F.replace(path, F.lit("/"), F.lit("//"))), F.replace(path, F.lit("/"), F.lit("\\"))), (F.col("doc_id") % 5 + 1).cast("int"))
    return _read(spark, d, "documents").select("doc_id", T.portable_path(spelled).alias("portable"))


def transient_texts(spark, d):
    """Texts that speak of passing failures."""
    return _read(spark, d, "documents").where("text is not null").select("doc_id", T.is_transient(F.col("text")).alias("passing"))


def relative_ages(spark, d):
    """Age of every document at a fixed time, in words."""
    age = F.lit(1798761600) - F.floor(F.unix_millis(instant(F.col("modified_at"))) / 1000)
    return _read(spark, d, "documents").where("modified_at is not null").select("doc_id", T.relative_time(age).alias("age"))


def document_formats(spark, d):
    """All fetched documents as csv, files and md, long ones skipped."""
    docs = _read(spark, d, "documents").where("active and text is not null").select(F.col("doc_id").alias("ord"), F.col("path").alias("file"), "title", F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("context"), F.col("text").alias("body"), F.when(F.length("text") > 2048, F.lit("File too large")).alias("skip_reason"))
    whole = None
    for kind in ("csv", "files", "md"):
        part = sinks.format_documents(docs, kind).select(F.lit(kind).alias("format"), "ord", "line")
        whole = part if whole is None else whole.unionByName(part)
    return whole


QUERIES = {f.__name__: f for f in (artifact_subset, stale_catalogs, model_metrics_cap, model_totals, recovery_summary, recovery_totals, rating_histogram, throughput, vector_sample, adopted_fingerprints, lineage_ids, output_scores, sensitive_fields, library_rollup, level_problems, text_unit_identity, portable_paths, transient_texts, relative_ages, document_formats)}

_K = G._K
_A = "a AS (SELECT book_id, coalesce(ready, false) AS ready, unnest(CASE WHEN starts_with(trim(artifact_ids), '[') THEN from_json(artifact_ids, '[\"VARCHAR\"]') WHEN artifact_ids IS NULL THEN [NULL] ELSE [regexp_replace(trim(artifact_ids), '^\"|\"$', '', 'g')] END) AS x FROM qmd_graph_capabilities), b AS (SELECT DISTINCT book_id FROM qmd_graph_capabilities WHERE NOT coalesce(ready, false)), i AS (SELECT DISTINCT book_id, ready, x FROM a WHERE trim(coalesce(x, '')) <> '')"
_M = "m AS (SELECT 'model-' || user_id AS model, count(*)::BIGINT AS attempts, sum((props->>'k')::BIGINT)::BIGINT AS tokens FROM events GROUP BY 1)"
_QUOTE = "to_json({})::VARCHAR"


def _sensitive_sql(column: str, name: str) -> str:
    from corpuskiln.functions.text import SENSITIVE
    from corpuskiln.plans.store_queries import _first

    return f"SELECT '{name}' AS \"column\", {_first(column, SENSITIVE)} AS reason FROM documents"


def _lineage_sql() -> str:
    h = _K.format(c="hash")
    lineage = f"'doc:' || left(sha256('{{\"contentHash\":' || {_QUOTE.format('h')} || ',\"normalizationPolicyVersion\":\"1\",\"sourceId\":' || CASE WHEN source IS NULL THEN 'null' ELSE {_QUOTE.format('source')} END || '}}'), 24)"
    piece = f"'chunk-' || left(sha256('{{\"chunkStrategy\":\"default-v1\",\"contentHash\":' || CASE WHEN h IS NULL THEN 'null' ELSE {_QUOTE.format('h')} END || ',\"documentId\":' || {_QUOTE.format('document_id')} || ',\"length\":' || coalesce(length(text), 0) || ',\"pos\":0,\"seq\":0}}'), 12)"
    return f"WITH d AS (SELECT *, {h} AS h FROM documents) SELECT doc_id, CASE WHEN h IS NOT NULL THEN {lineage} END AS lineage, {piece} AS piece FROM d"


def _csv(column: str) -> str:
    """SQL of a field of a CSV line."""
    return f"CASE WHEN regexp_matches(coalesce({column}, ''), '[,\"' || chr(10) || ']') THEN '\"' || replace({column}, '\"', '\"\"') || '\"' ELSE coalesce({column}, '') END"


_EVENTS = "e AS (SELECT user_id AS item, event_type, event_type = 'error' AS retryable, event_id AS retry_at, (props->>'k')::BIGINT AS wait FROM events)"
SQL = {
    "artifact_subset": f"WITH {_A}, u AS (SELECT book_id, count(*) AS n FROM i WHERE NOT ready AND NOT EXISTS (SELECT 1 FROM i j WHERE j.ready AND j.book_id = i.book_id AND j.x = i.x) GROUP BY 1) SELECT b.book_id, coalesce(n, 0) = 0 AS subset FROM b LEFT JOIN u USING (book_id)",
    "stale_catalogs": f"WITH c AS (SELECT DISTINCT book_id, {_K.format(c='document_id')} AS x, ready FROM qmd_graph_capabilities WHERE {_K.format(c='document_id')} IS NOT NULL), g AS (SELECT book_id, count(DISTINCT x) AS n, count(DISTINCT x) FILTER (ready) AS r FROM c GROUP BY 1) SELECT book_id, r > 0 AS present, r <> n AS stale FROM g",
    "model_metrics_cap": f"WITH {_M} SELECT model, attempts, tokens FROM m ORDER BY attempts DESC, tokens DESC, model LIMIT 32",
    "model_totals": f"WITH {_M} SELECT count(*)::BIGINT AS models, sum(attempts)::BIGINT AS attempts, sum(tokens)::BIGINT AS tokens FROM m",
    "recovery_summary": f"WITH {_EVENTS}, s AS (SELECT item, arg_max(event_type, retry_at) AS status, bool_or(retryable) AS retryable, min(retry_at) FILTER (retryable) AS next_retry_at FROM e GROUP BY 1), a AS (SELECT item, count(*)::BIGINT AS slots, max(wait) AS longest_wait, max(retry_at) AS generation FROM e WHERE event_type = 'click' GROUP BY 1) SELECT item, status, retryable, coalesce(next_retry_at, -1) AS next_retry_at, coalesce(slots, 0)::BIGINT AS slots, coalesce(longest_wait, -1) AS longest_wait, coalesce(generation, -1) AS generation FROM s LEFT JOIN a USING (item)",
    "recovery_totals": f"WITH {_EVENTS} SELECT event_type, count(*)::BIGINT AS n, count(*) FILTER (retryable)::BIGINT AS retryable, coalesce(min(retry_at) FILTER (retryable), -1) AS next_retry_at FROM e GROUP BY 1",
    "rating_histogram": "SELECT CASE " + " ".join(f"WHEN value >= {least} THEN '{name}'" for least, name in evaluation.BANDS) + " ELSE 'Failed' END AS rating, count(*)::BIGINT AS n FROM events WHERE value IS NOT NULL GROUP BY 1",
    "throughput": "SELECT event_type, count(*)::BIGINT AS runs, round(median(value), 4) AS median_ms, round(count(*) * 1000 / sum(value), 4) AS documents_per_second FROM events GROUP BY 1",
    "vector_sample": "SELECT vec_id, label FROM embeddings ORDER BY md5('42:' || vec_id), vec_id LIMIT 100",
    "adopted_fingerprints": "SELECT CASE WHEN label > 4 THEN 'a41c07' ELSE 'f00d42' END AS embed_fingerprint, count(*)::BIGINT AS n FROM embeddings WHERE (WITH s AS (SELECT vec_id, embedding FROM embeddings WHERE label <= 4 ORDER BY vec_id LIMIT 1) SELECT arg_min(v.vec_id, " + _distance("v.embedding", "s.embedding") + ") = any_value(s.vec_id) FROM embeddings v, s) GROUP BY 1",
    "lineage_ids": _lineage_sql(),
    "output_scores": rf"WITH t AS (SELECT record_id, list_filter(string_split(array_to_string(list_transform(list_filter(output, lambda x: x.text IS NOT NULL), lambda x: x.type || ': ' || x.text), chr(10)), chr(10)), lambda l: true) AS l FROM qmd_expansion_sports WHERE output IS NOT NULL), s AS (SELECT record_id, list_transform(l, lambda x: trim(x)) AS l FROM t), h AS (SELECT record_id, l, trim(substr(coalesce(list_filter(l, lambda x: starts_with(x, 'hyde:'))[-1], ''), 6)) AS hyde FROM s) SELECT record_id, (len(list_filter(l, lambda x: starts_with(x, 'lex:'))) + len(list_filter(l, lambda x: starts_with(x, 'vec:'))) + 2 * len(list_filter(l, lambda x: starts_with(x, 'hyde:'))) + CASE WHEN length(hyde) BETWEEN 80 AND 200 THEN 2 WHEN length(hyde) BETWEEN 50 AND 250 THEN 1 ELSE 0 END - " + " - ".join(f"contains(lower(hyde), '{p}')::INT" for p in catalog.GENERIC) + ")::INT AS score FROM h",
    "sensitive_fields": "WITH u AS (" + " UNION ALL ".join(_sensitive_sql(c, c) for c in ("path", "title", "text")) + " UNION ALL SELECT 'rawPrompt', 'field_name' FROM documents) SELECT \"column\", reason, count(*)::BIGINT AS n FROM u WHERE reason IS NOT NULL GROUP BY 1, 2",
    "library_rollup": G.SQL["communities_rollup"].replace("SELECT source AS member", "SELECT upper(left(source, 1)) AS member"),
    "level_problems": f"WITH u AS (SELECT {_K.format(c='document_id')} AS id, source AS member, CASE WHEN active THEN 'g1' ELSE 'g0' END AS generation FROM documents), c AS (SELECT {_K.format(c='document_id')} AS id, kind FROM qmd_graph_capabilities WHERE {_K.format(c='document_id')} IS NOT NULL), p AS (SELECT 'edge_without_unit' AS problem, 2 * count(*)::BIGINT AS n FROM c WHERE kind = 'graph_query' AND id NOT IN (SELECT id FROM u) UNION ALL SELECT 'evidence_without_unit', count(*) FROM c WHERE id NOT IN (SELECT id FROM u) UNION ALL SELECT 'unit_without_evidence', count(DISTINCT id) FROM u WHERE id NOT IN (SELECT id FROM c) UNION ALL SELECT 'unit_of_unknown_member', count(*) FROM u WHERE member IS NULL OR member NOT IN (SELECT source FROM source_targets) UNION ALL SELECT 'stale_unit', count(*) FROM u WHERE generation <> 'g1' UNION ALL SELECT 'too_many_units', count(*) FROM u HAVING count(*) > 100) SELECT problem, n FROM p WHERE n > 0",
    "text_unit_identity": rf"WITH d AS (SELECT {_K.format(c='document_id')} AS id, lower(regexp_extract(path, '([^/]*)$', 1)) AS name FROM documents), n AS (SELECT name, min(id) AS named FROM d WHERE name <> '' GROUP BY 1 HAVING count(DISTINCT id) = 1), c AS (SELECT DISTINCT capability_id, {_K.format(c='document_id')} AS id, lower(right(capability_id, 3) || '.md') AS name FROM qmd_graph_capabilities), j AS (SELECT c.*, c.id IN (SELECT id FROM d) AS there, named FROM c LEFT JOIN n USING (name)) SELECT CASE WHEN coalesce(there, false) THEN 'id' WHEN named IS NOT NULL THEN 'name' ELSE 'none' END AS how, count(*)::BIGINT AS n, count(DISTINCT CASE WHEN coalesce(there, false) THEN id ELSE named END)::BIGINT AS documents FROM j GROUP BY 1",
    "portable_paths": "SELECT doc_id, CASE WHEN doc_id % 5 IN (0, 3, 4) THEN path END AS portable FROM documents",
    "transient_texts": "SELECT doc_id, " + " OR ".join([*(f"contains(lower(text), '{t}')" for t in T.TRANSIENT), *(f"regexp_matches(text, '{p}')" for p in T.TRANSIENT_PATTERNS)]) + " AS passing FROM documents WHERE text IS NOT NULL",
    "relative_ages": "WITH a AS (SELECT doc_id, 1798761600 - floor(epoch_ms(modified_at::TIMESTAMPTZ) / 1000)::BIGINT AS s FROM documents WHERE modified_at IS NOT NULL) SELECT doc_id, CASE WHEN s < 60 THEN s || 's ago' WHEN s < 3600 THEN s // 60 || 'm ago' WHEN s < 86400 THEN s // 3600 || 'h ago' ELSE s // 86400 || 'd ago' END AS age FROM a",
    "document_formats": f"WITH d AS (SELECT doc_id AS ord, path AS file, title, CASE WHEN doc_id % 3 = 0 THEN coalesce(source, '') ELSE '' END AS ctx, CASE WHEN length(text) > 2048 THEN 'File too large' ELSE text END AS shown, length(text) > 2048 AS skipped FROM documents WHERE active AND text IS NOT NULL) SELECT 'csv' AS format, ord, {_csv('file')} || ',' || {_csv('title')} || ',' || {_csv('ctx')} || ',' || CASE WHEN skipped THEN 'true' ELSE 'false' END || ',' || {_csv('shown')} AS line FROM d UNION ALL SELECT 'files', ord, file || CASE WHEN ctx <> '' THEN ',\"' || replace(ctx, '\"', '\"\"') || '\"' ELSE '' END || CASE WHEN skipped THEN ',[SKIPPED]' ELSE '' END FROM d UNION ALL SELECT 'md', ord, '## ' || file || chr(10) || chr(10) || CASE WHEN coalesce(title, '') <> '' AND title <> file THEN '**Title:** ' || title || chr(10) || chr(10) ELSE '' END || CASE WHEN ctx <> '' THEN '**Context:** ' || ctx || chr(10) || chr(10) ELSE '' END || CASE WHEN skipped THEN '> ' || shown || chr(10) ELSE '```' || chr(10) || shown || chr(10) || '```' || chr(10) END FROM d",
}
