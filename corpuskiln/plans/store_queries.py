"""Queries of the corpus store, lookups and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.functions.keys import canonical_key, instant
from corpuskiln.operators import lexical, lookup, store
from corpuskiln.plans.retrieval_queries import _bm25_sql


def _read(spark: SparkSession, d: str, t: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{t}.parquet")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents")
    return docs.withColumns({"collection": F.coalesce("source", F.lit("")), "hash": canonical_key(F.col("hash")), "modified_at": instant(F.col("modified_at")), "created_at": instant(F.col("created_at"))})


def _content(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "content").withColumns({"hash": canonical_key(F.col("hash")), "created_at": instant(F.col("created_at"))})


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "content_vectors").withColumn("hash", canonical_key(F.col("hash")))


def _scan(docs: DataFrame) -> DataFrame:
    """The documents' texts as a fresh scan: title and hash taken anew from each text."""
    return docs.where("text is not null").select("collection", "path", T.title_of(F.col("text"), F.col("path")).alias("title"), F.sha2("text", 256).alias("hash"))


def reindex_classify(spark, d):
    """Change classes of a fresh scan of all texts against the stored rows."""
    docs = _documents(spark, d)
    return store.classify_changes(_scan(docs), docs)


def reindex_counts(spark, d):
    """Number of documents in each change class."""
    return reindex_classify(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def document_upsert(spark, d):
    """Documents after the scan is written: kept creation time, new hash and title, active."""
    docs = _documents(spark, d)
    after = store.upsert_documents(docs.select("collection", "path", "title", "hash", "created_at", "modified_at", "active"), _scan(docs), F.lit("2026-01-01").cast("timestamp"))
    return after.select("collection", "path", "title", "hash", F.unix_millis("created_at").alias("created_ms"), F.unix_millis("modified_at").alias("modified_ms"), "active")


def content_insert(spark, d):
    """Bodies of the scan that are not stored yet."""
    docs = _documents(spark, d).where("text is not null").select(F.sha2("text", 256).alias("hash"), F.col("text").alias("doc"), "created_at")
    return store.insert_content(_content(spark, d), docs).select("hash", F.length("doc").cast("bigint").alias("chars"), F.unix_millis("created_at").alias("created_ms"))


def soft_delete(spark, d):
    """Active flags after paths that the scan lacks are deactivated."""
    docs = _documents(spark, d)
    return store.deactivate_missing(docs, _scan(docs)).select("doc_id", "active")


def orphan_content(spark, d):
    """Stored bodies that no document names."""
    return store.orphan_content(_content(spark, d), _documents(spark, d)).select("hash").distinct()


def remove_collection(spark, d):
    """Documents and bodies left after a collection is removed, with the cascade."""
    docs, content = store.remove_collection(_documents(spark, d), _content(spark, d), "web-clips")
    return docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("key")).unionByName(content.select(F.lit("content").alias("kind"), F.col("hash").alias("key")).distinct())


def orphan_vectors(spark, d):
    """Pieces of bodies without an active document."""
    return store.orphan_vectors(_vectors(spark, d), _documents(spark, d)).select("hash", "seq", "model")


def inactive_documents(spark, d):
    """Rows that a clean-up deletes."""
    return _documents(spark, d).where("not active").select("doc_id", "path")


def embedding_upsert(spark, d):
    """The row of each (hash, seq) that was written last."""
    v = _vectors(spark, d).where("hash is not null")
    return store.upsert_embeddings(v, instant(F.col("embedded_at"))).select("hash", "seq", "model", "embed_fingerprint", "pos")


def incomplete_embeddings(spark, d):
    """Bodies with too few or too many pieces under a model."""
    return store.incomplete_embeddings(_vectors(spark, d), "jade-embed-small").select("hash", "n", "expected")


def pending_embeddings(spark, d):
    """Bodies still to be embedded for a model and fingerprint."""
    return store.pending_embeddings(_documents(spark, d), _content(spark, d), _vectors(spark, d), "jade-embed-small", "a41c07")


def scoped_clear_hashes(spark, d):
    """Hashes that only one collection uses."""
    return store.scoped_hashes(_documents(spark, d), "web-clips")


def case_twins(spark, d):
    """Paths equal but for case, with the row they migrate to."""
    docs = _documents(spark, d)
    twice = docs.unionByName(docs.withColumns({"doc_id": F.col("doc_id") + 1000000000, "path": F.upper("path")}))
    return store.case_twins(twice)


def cache_trim(spark, d):
    """The thousand newest bodies, as a result cache keeps them."""
    return store.trim_cache(_content(spark, d).groupBy("hash").agg(F.max("created_at").alias("at")), "hash", "at").select("hash")


def collection_status(spark, d):
    """Totals, active counts and last change of every collection; registered but empty ones included."""
    docs = _documents(spark, d)
    names = docs.select("collection").distinct().union(spark.createDataFrame([("never-used",)], "collection string"))
    return store.collection_status(docs, names).select("collection", "total", "active_count", F.coalesce(F.unix_millis("last_modified"), F.lit(0)).alias("last_ms"))


def embedding_coverage(spark, d):
    """Bodies and pieces by model and fingerprint."""
    return store.embedding_coverage(_vectors(spark, d))


def chunk_counts(spark, d):
    """Pieces and announced pieces per body, model and fingerprint."""
    return _vectors(spark, d).where("hash is not null").groupBy("hash", "model", "embed_fingerprint").agg(F.count(F.lit(1)).alias("pieces"), F.max("total_chunks").alias("announced"))


def needs_embedding_count(spark, d):
    """How many bodies are pending."""
    return pending_embeddings(spark, d).agg(F.countDistinct("hash").alias("pending"))


def index_staleness(spark, d):
    """Whole days since the last change of each collection, at a fixed day."""
    docs = _documents(spark, d).where("active").groupBy("collection").agg(F.max("modified_at").alias("last"))
    return docs.select("collection", T.staleness_days(F.to_timestamp(F.lit("2027-01-01T00:00:00Z")), F.col("last")).alias("days"))


def dedupe_content_hash(spark, d):
    """How many active documents share each stored body."""
    return store.distinct_content(_documents(spark, d), _content(spark, d))


def content_first_path(spark, d):
    """Smallest path and collection and the byte length of each body."""
    docs = _documents(spark, d).where("active and hash is not null").groupBy("hash").agg(F.min("path").alias("path"), F.min("collection").alias("collection"))
    return docs.join(_content(spark, d).groupBy("hash").agg(F.max(F.octet_length("doc")).cast("bigint").alias("bytes")), "hash")


def first_vectors(spark, d):
    """First piece of each active document's body."""
    return store.first_vectors(_documents(spark, d), _vectors(spark, d)).withColumn("seq", F.coalesce("seq", F.lit(-1)))


def documents_with_content(spark, d):
    """Documents joined with their bodies: characters by three measures."""
    c = _content(spark, d).groupBy("hash").agg(F.max("doc").alias("doc"))
    return _documents(spark, d).where("active").join(c, "hash").select("doc_id", F.length("doc").cast("bigint").alias("chars"), F.octet_length("doc").cast("bigint").alias("bytes"))


def prefix_listing(spark, d):
    """Active documents below a path prefix."""
    return lookup.by_prefix(_read(spark, d, "documents").where("active"), "ES/").select("doc_id", "path")


def suffix_match(spark, d):
    """First document with a path suffix."""
    return lookup.by_suffix(_read(spark, d, "documents"), "7.md").select("doc_id", "path")


def docid_lookup(spark, d):
    """Documents by the short ids of all their hashes: those whose id is unique."""
    docs = _documents(spark, d).where("active and hash is not null").select("doc_id", T.docid(F.col("hash")).alias("docid"))
    return docs.groupBy("docid").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))


def glob_match(spark, d):
    """Documents that match a glob with alternatives."""
    return lookup.by_glob(_read(spark, d, "documents"), "**/{es,fr}/*1?.md").select("doc_id", "path")


def multi_get(spark, d):
    """Several documents at once, large ones skipped with a reason."""
    r = lookup.multi_get(_read(spark, d, "documents"), ["en/8.md", "/9.md", "2.md", "en/nothing.md"], 2048)
    return r.select("name", "doc_id", F.coalesce(F.length("body"), F.lit(-1)).alias("chars"), F.coalesce("skip_reason", F.lit("")).alias("skip_reason"))


def lookup_cascade(spark, d):
    """A document asked for by suffix."""
    return lookup.find_document(_read(spark, d, "documents"), "00.md")


def similar_files(spark, d):
    """Suggestions for a mistyped path."""
    return lookup.similar_files(_read(spark, d, "documents"), "en/1O0.md").select("doc_id", "path", "distance")


def collection_filter(spark, d):
    """Active documents of three collections, by collection."""
    return lookup.in_collections(_read(spark, d, "documents"), ["essays", "letters", "inbox"]).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def bm25_with_context(spark, d):
    """The best documents of a search with the contexts of their paths."""
    docs = _read(spark, d, "documents")
    top = lexical.search(docs, "harbour telescope", limit=10, stem=False).select("doc_id", "rank")
    found = docs.select("doc_id", "source", "path").join(F.broadcast(top), "doc_id")  # ten rows
    return lookup.with_contexts(found, _contexts(spark), "Knowledge base").select("doc_id", "rank", "context")


_CONTEXTS = [("web-clips", "/", "Clipped pages"), ("web-clips", "/es", "Spanish pages"), ("essays", "/en", "English essays"), ("essays", "/", "Essays")]


def _contexts(spark):
    return spark.createDataFrame(_CONTEXTS, "collection string, prefix string, context string")


def context_inheritance(spark, d):
    """Every document's contexts, general ones first."""
    return lookup.with_contexts(_read(spark, d, "documents"), _contexts(spark), "Knowledge base").select("doc_id", "context")


def folders_without_context(spark, d):
    """Folders for which no context is set."""
    return lookup.folders_without_context(_read(spark, d, "documents"), _contexts(spark))


def path_to_collection(spark, d):
    """Longest matching root of each absolute path and the path below it."""
    roots = spark.createDataFrame([("kb", "/data/kb"), ("kb-es", "/data/kb/es"), ("kb-e", "/data/kb/e")], "name string, root string")
    paths = _read(spark, d, "documents").select("doc_id", F.concat(F.lit("/data/kb/"), F.col("path")).alias("file"))
    return lookup.longest_prefix(paths, "file", roots, "root", "name").select("doc_id", "name", "relative")


def line_slice(spark, d):
    """Lines 2 to 4 of every text."""
    return _read(spark, d, "documents").where("text is not null").select("doc_id", lookup.line_slice(F.col("text"), 2, 3).alias("lines"))


def line_numbers(spark, d):
    """Titles and paths as numbered lines."""
    return _read(spark, d, "documents").select("doc_id", lookup.numbered_lines(F.concat_ws("\n", "title", "path"), 5).alias("lines"))


def snippet_basic(spark, d):
    """Best lines of every text for a query."""
    s = lookup.snippet(F.col("text"), "harbour glossary")
    return _read(spark, d, "documents").where("text is not null").select("doc_id", s.alias("s")).select("doc_id", F.col("s.line").alias("line"), F.col("s.snippet").alias("snippet"))


def title_extract(spark, d):
    """Title of every text."""
    return _read(spark, d, "documents").select("doc_id", T.title_of(F.coalesce("text", F.lit("")), F.col("path")).alias("title"))


def path_slug(spark, d):
    """Slugs of all titles as file names."""
    return _read(spark, d, "documents").where("title is not null").select("doc_id", T.path_slug(F.concat(F.lit("notes___2025/"), F.col("title"), F.lit(".md"))).alias("slug"))


def virtual_path_parse(spark, d):
    """Virtual paths taken apart again."""
    v = T.virtual_path(F.coalesce("source", F.lit("none")), F.col("path"))
    return _read(spark, d, "documents").select("doc_id", v.alias("v")).select("doc_id", T.virtual_collection(F.col("v")).alias("collection"), T.virtual_rest(F.col("v")).alias("rest"))


def content_hashes(spark, d):
    """Hashes of the texts in the three serializations."""
    t = F.coalesce("text", F.lit(""))
    return _read(spark, d, "documents").select("doc_id", F.sha2(t, 256).alias("plain"), T.content_hash(t).alias("wrapped"), T.spaced_json_hash([("text", t), ("path", F.col("path"))]).alias("spaced"))


def sensitive_scan(spark, d):
    """Reason for which a document's title, else its text, is sensitive; null if neither is."""
    return _read(spark, d, "documents").select("doc_id", F.coalesce(T.sensitive_reason(F.col("title")), T.sensitive_reason(F.col("text"))).alias("reason"))


def failure_class(spark, d):
    """Failure class of every text, read as a message."""
    kind = T.failure_class(F.col("text"))
    return _read(spark, d, "documents").where("text is not null").select("doc_id", kind.alias("kind"), T.is_retryable(kind).alias("retryable"))


def intent_terms(spark, d):
    """Terms of the intents of all expansions."""
    return _read(spark, d, "qmd_expansion_sports").where("intent is not null").select("record_id", F.array_join(T.intent_terms(F.col("intent")), " ").alias("terms"))


def redacted(spark, d):
    """Texts without links: characters left after redaction."""
    return _read(spark, d, "documents").where("text is not null").select("doc_id", F.length(F.regexp_replace(T.redact(F.col("text")), r"\s+", "")).alias("chars"))


def case_migration(spark, d):
    """Paths after every path was asked for in capitals."""
    docs = _read(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("collection"), "path")
    return store.migrate_case_paths(docs, docs.select("collection", F.upper("path").alias("path"))).select("doc_id", "path")


def path_to_first_root(spark, d):
    """First matching root, in table order, of each absolute path and the path below it."""
    roots = spark.createDataFrame([("kb", "/data/kb", 2), ("kb-es", "/data/kb/es", 1), ("kb-en", "/data/kb/en", 3)], "name string, root string, pos int")
    paths = _read(spark, d, "documents").select("doc_id", F.concat(F.lit("/data/kb/"), F.col("path")).alias("file"))
    return lookup.longest_prefix(paths, "file", roots, "root", "name", "pos").select("doc_id", "name", "relative")


QUERIES = {f.__name__: f for f in (bm25_with_context, case_migration, path_to_first_root, reindex_classify, reindex_counts, document_upsert, content_insert, soft_delete, orphan_content, remove_collection, orphan_vectors, inactive_documents, embedding_upsert, incomplete_embeddings, pending_embeddings, scoped_clear_hashes, case_twins, cache_trim, collection_status, embedding_coverage, chunk_counts, needs_embedding_count, index_staleness, dedupe_content_hash, content_first_path, first_vectors, documents_with_content, prefix_listing, suffix_match, docid_lookup, glob_match, multi_get, lookup_cascade, similar_files, collection_filter, context_inheritance, folders_without_context, path_to_collection, line_slice, line_numbers, snippet_basic, title_extract, path_slug, virtual_path_parse, content_hashes, sensitive_scan, failure_class, intent_terms, redacted)}

_K = "nullif(trim(regexp_replace(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13))), '^sha256:', '')), '')"
_MS = "epoch_ms({c}::TIMESTAMPTZ)"
_D = f"d AS (SELECT * REPLACE ({_K.format(c='hash')} AS hash), coalesce(source, '') AS collection FROM documents)"
_C = f"c AS (SELECT {_K.format(c='hash')} AS hash, doc, created_at FROM content)"
_V = f"v AS (SELECT * REPLACE ({_K.format(c='hash')} AS hash) FROM content_vectors)"
_TRIM = r"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_STEM = r"regexp_extract(regexp_replace(path, '\.[^.]+$', ''), '([^/]*)$', 1)"


def _title(body: str) -> str:
    head = _TRIM.format(x=rf"regexp_extract({body}, '(?m)^##?\s+(.+)$', 1)")
    second = _TRIM.format(x=rf"regexp_extract({body}, '(?m)^##\s+(.+)$', 1)")
    md = f"CASE WHEN {head} IN ('Notes', '📝 Notes') AND {second} <> '' THEN {second} ELSE {head} END"
    return f"coalesce(nullif({md}, ''), {_STEM})"


_S = f"s AS (SELECT collection, path, {_title('text')} AS title, sha256(text) AS hash FROM d WHERE text IS NOT NULL)"
_PENDING = f"WITH {_D}, {_C}, {_V}, b AS (SELECT hash, min(path) AS path, min(collection) AS collection FROM d WHERE active AND hash IS NOT NULL GROUP BY 1), h AS (SELECT hash, count(DISTINCT seq) AS n, max(total_chunks) AS e FROM v WHERE model = 'jade-embed-small' AND embed_fingerprint = 'a41c07' GROUP BY 1), z AS (SELECT hash, max(strlen(doc))::BIGINT AS bytes FROM c GROUP BY 1), p AS (SELECT b.hash, path, collection, bytes FROM b JOIN z USING (hash) LEFT JOIN h USING (hash) WHERE n IS NULL OR n < e)"
_CLASSIFY = f"WITH {_D}, {_S}, o AS (SELECT * FROM d WHERE active), r AS (SELECT coalesce(s.collection, o.collection) AS collection, coalesce(s.path, o.path) AS path, CASE WHEN o.path IS NULL THEN 'indexed' WHEN s.path IS NULL THEN 'removed' WHEN s.hash IS DISTINCT FROM o.hash THEN 'updated' WHEN s.title IS DISTINCT FROM o.title THEN 'retitled' ELSE 'unchanged' END AS status FROM s FULL JOIN o ON s.collection = o.collection AND s.path = o.path)"
_SLUG = lambda x: rf"regexp_replace(regexp_replace({x}, '[^\p{{L}}\p{{N}}$]+', '-', 'g'), '^-+|-+$', '', 'g')"
_VALUES = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _CONTEXTS)



def _first(column: str, signs: list[tuple[str, str]]) -> str:
    """SQL of the name of the first sign whose pattern is in the column, else null."""
    return "CASE " + " ".join("WHEN regexp_matches({}, '{}') THEN '{}'".format(column, pattern.replace("'", "''"), name) for name, pattern in signs) + " END"


def _redacted(column: str) -> str:
    """SQL of the text with secrets, links and local paths replaced; what looks behind in a pattern is put back instead."""
    for pattern, put in T.REDACTIONS:
        pattern, put = pattern.replace("'", "''"), put.replace("$1", "\\1")
        if pattern.startswith("(?<!["):
            inside, rest = pattern[len("(?<!["):].split("])", 1)
            pattern, put = f"(^|[^{inside}]){rest}", f"\\1{put}"
        column = f"regexp_replace({column}, '{pattern}', '{put}', 'g')"
    return column


SQL = {
    "bm25_with_context": f"WITH {_bm25_sql('harbour telescope')}, top AS (SELECT doc_id, row_number() OVER (ORDER BY raw DESC, doc_id)::INT AS rank FROM (SELECT * FROM s ORDER BY raw DESC, doc_id LIMIT 10)), x(collection, prefix, context) AS (VALUES {_VALUES}), h AS (SELECT doc_id, string_agg(context, chr(10) || chr(10) ORDER BY length(prefix), prefix) AS c FROM documents JOIN x ON x.collection = source AND starts_with('/' || path, prefix) GROUP BY 1) SELECT top.doc_id, rank, 'Knowledge base' || coalesce(chr(10) || chr(10) || h.c, '') AS context FROM top LEFT JOIN h USING (doc_id)",
    "case_migration": "WITH d AS (SELECT doc_id, coalesce(source, '') AS c, path FROM documents), f AS (SELECT c, lower(path) AS low, min(doc_id) AS doc_id FROM d GROUP BY 1, 2), u AS (SELECT c, lower(path) AS low, min(upper(path)) AS up FROM d WHERE NOT EXISTS (SELECT 1 FROM d e WHERE e.c = d.c AND e.path = upper(d.path)) GROUP BY 1, 2) SELECT d.doc_id, coalesce(up, path) AS path FROM d LEFT JOIN f ON f.doc_id = d.doc_id LEFT JOIN u ON u.c = f.c AND u.low = f.low",
    "path_to_first_root": "SELECT doc_id, CASE WHEN starts_with(path, 'es/') THEN 'kb-es' ELSE 'kb' END AS name, CASE WHEN starts_with(path, 'es/') THEN substr(path, 4) ELSE path END AS relative FROM documents",
    "reindex_classify": _CLASSIFY + " SELECT * FROM r",
    "reindex_counts": _CLASSIFY + " SELECT status, count(*)::BIGINT AS n FROM r GROUP BY 1",
    "document_upsert": f"WITH {_D}, {_S} SELECT d.collection, d.path, CASE WHEN s.path IS NOT NULL THEN s.title ELSE d.title END AS title, CASE WHEN s.path IS NOT NULL THEN s.hash ELSE d.hash END AS hash, {_MS.format(c='d.created_at')} AS created_ms, CASE WHEN s.path IS NOT NULL THEN 1767225600000 ELSE {_MS.format(c='d.modified_at')} END AS modified_ms, (s.path IS NOT NULL OR coalesce(d.active, false)) AS active FROM d LEFT JOIN s ON s.collection = d.collection AND s.path = d.path",
    "content_insert": f"WITH {_C}, n AS (SELECT sha256(text) AS hash, length(text)::BIGINT AS chars, min({_MS.format(c='created_at')}) AS created_ms FROM documents WHERE text IS NOT NULL GROUP BY 1, 2) SELECT * FROM n WHERE hash NOT IN (SELECT hash FROM c)",
    "soft_delete": f"WITH {_D}, {_S} SELECT doc_id, (active AND s.path IS NOT NULL) AS active FROM d LEFT JOIN s ON s.collection = d.collection AND s.path = d.path",
    "orphan_content": f"WITH {_D}, {_C} SELECT DISTINCT hash FROM c WHERE hash NOT IN (SELECT hash FROM d WHERE hash IS NOT NULL)",
    "remove_collection": f"WITH {_D}, {_C}, l AS (SELECT * FROM d WHERE collection <> 'web-clips'), live AS (SELECT DISTINCT hash FROM l WHERE active AND hash IS NOT NULL) SELECT 'document' AS kind, doc_id::VARCHAR AS key FROM l WHERE hash IS NULL OR hash IN (SELECT hash FROM live) OR hash NOT IN (SELECT hash FROM c) UNION ALL SELECT DISTINCT 'content', hash FROM c WHERE hash IN (SELECT hash FROM live)",
    "orphan_vectors": f"WITH {_D}, {_V} SELECT hash, seq, model FROM v WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.active AND d.hash = v.hash)",
    "inactive_documents": "SELECT doc_id, path FROM documents WHERE NOT active",
    "embedding_upsert": f"WITH {_V} SELECT hash, seq, model, embed_fingerprint, pos FROM v WHERE hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY hash, seq ORDER BY embedded_at::TIMESTAMPTZ DESC, model, embed_fingerprint, total_chunks) = 1",
    "incomplete_embeddings": f"WITH {_V} SELECT hash, count(DISTINCT seq)::BIGINT AS n, max(total_chunks) AS expected FROM v WHERE model = 'jade-embed-small' AND hash IS NOT NULL GROUP BY 1 HAVING count(DISTINCT seq) <> max(total_chunks)",
    "pending_embeddings": _PENDING + " SELECT * FROM p",
    "scoped_clear_hashes": f"WITH {_D} SELECT hash FROM d WHERE hash IS NOT NULL GROUP BY 1 HAVING bool_and(collection = 'web-clips')",
    "case_twins": "WITH u AS (SELECT doc_id, coalesce(source, '') AS collection, path FROM documents UNION ALL SELECT doc_id + 1000000000, coalesce(source, ''), upper(path) FROM documents), g AS (SELECT collection, lower(path) AS low, arg_min(path, doc_id) AS keep FROM u GROUP BY 1, 2 HAVING count(*) > 1) SELECT u.collection, u.path, keep FROM u JOIN g ON g.collection = u.collection AND g.low = lower(u.path)",
    "cache_trim": f"WITH {_C} SELECT hash FROM c GROUP BY 1 ORDER BY max(created_at::TIMESTAMPTZ) DESC, hash LIMIT 1000",
    "collection_status": f"WITH {_D} SELECT collection, count(*)::BIGINT AS total, count(*) FILTER (active)::BIGINT AS active_count, coalesce(max({_MS.format(c='modified_at')}), 0) AS last_ms FROM d GROUP BY 1 UNION ALL SELECT 'never-used', 0, 0, 0",
    "embedding_coverage": f"WITH {_V} SELECT model, embed_fingerprint, count(DISTINCT hash)::BIGINT AS hashes, count(*)::BIGINT AS pieces FROM v GROUP BY 1, 2",
    "chunk_counts": f"WITH {_V} SELECT hash, model, embed_fingerprint, count(*)::BIGINT AS pieces, max(total_chunks) AS announced FROM v WHERE hash IS NOT NULL GROUP BY 1, 2, 3",
    "needs_embedding_count": _PENDING + " SELECT count(DISTINCT hash)::BIGINT AS pending FROM p",
    "index_staleness": f"WITH {_D} SELECT collection, floor((1798761600 - floor(max({_MS.format(c='modified_at')}) / 1000)) / 86400)::BIGINT AS days FROM d WHERE active GROUP BY 1",
    "dedupe_content_hash": f"WITH {_D}, {_C} SELECT hash, count(*)::BIGINT AS n_documents, min(doc_id) AS first_document FROM d WHERE active AND hash IN (SELECT hash FROM c) GROUP BY 1",
    "content_first_path": f"WITH {_D}, {_C}, z AS (SELECT hash, max(strlen(doc))::BIGINT AS bytes FROM c GROUP BY 1) SELECT hash, min(path) AS path, min(collection) AS collection, any_value(bytes) AS bytes FROM d JOIN z USING (hash) WHERE active GROUP BY 1",
    "first_vectors": f"WITH {_D}, {_V}, f AS (SELECT hash, min(seq) AS seq FROM v WHERE pos = 0 AND hash IS NOT NULL GROUP BY 1) SELECT doc_id, coalesce(seq, -1) AS seq FROM d LEFT JOIN f USING (hash) WHERE active AND d.hash IS NOT NULL",
    "documents_with_content": f"WITH {_D}, {_C}, m AS (SELECT hash, max(doc) AS doc FROM c GROUP BY 1) SELECT doc_id, length(doc)::BIGINT AS chars, strlen(doc)::BIGINT AS bytes FROM d JOIN m USING (hash) WHERE active",
    "prefix_listing": "SELECT doc_id, path FROM documents WHERE active AND lower(path) LIKE 'es/%'",
    "suffix_match": "SELECT doc_id, path FROM documents WHERE path ILIKE '%7.md' ORDER BY doc_id LIMIT 1",
    "docid_lookup": f"WITH {_D} SELECT left(hash, 6) AS docid, min(doc_id) AS doc_id, count(*)::BIGINT AS n FROM d WHERE active AND hash IS NOT NULL GROUP BY 1",
    "glob_match": "SELECT doc_id, path FROM documents WHERE regexp_matches(path, '^(?:.*/)?(?:es|fr)/[^/]*1[^/]\\.md$')",
    "multi_get": "WITH n(ord, name) AS (VALUES (0, 'en/8.md'), (1, '/9.md'), (2, '2.md'), (3, 'en/nothing.md')), h AS (SELECT ord, name, doc_id, text FROM n JOIN documents ON active AND (path = name OR suffix(path, name)) QUALIFY row_number() OVER (PARTITION BY ord ORDER BY (path <> name)::INT, doc_id) = 1) SELECT name, doc_id, coalesce(CASE WHEN coalesce(length(text) > 2048, false) THEN NULL ELSE length(text) END, -1)::INT AS chars, CASE WHEN length(text) > 2048 THEN 'File too large (' || round(length(text) / 1024.0)::INT || 'KB > 2KB)' ELSE '' END AS skip_reason FROM h",
    "lookup_cascade": "SELECT 3 AS stage, doc_id, path FROM documents WHERE active AND path LIKE '%00.md' ORDER BY doc_id LIMIT 1",
    "similar_files": "SELECT doc_id, path, levenshtein(lower(path), 'en/1o0.md')::INT AS distance FROM documents WHERE active AND levenshtein(lower(path), 'en/1o0.md') <= 3 ORDER BY distance, doc_id LIMIT 5",
    "collection_filter": "SELECT source, count(*)::BIGINT AS n FROM documents WHERE active AND source IN ('essays', 'letters', 'inbox') GROUP BY 1",
    "context_inheritance": f"WITH x(collection, prefix, context) AS (VALUES {_VALUES}), g AS (SELECT doc_id, string_agg(context, chr(10) || chr(10) ORDER BY length(prefix), prefix) AS c FROM documents JOIN x ON x.collection = source AND starts_with('/' || path, prefix) GROUP BY 1) SELECT doc_id, 'Knowledge base' || coalesce(chr(10) || chr(10) || c, '') AS context FROM documents LEFT JOIN g USING (doc_id)",
    "folders_without_context": f"WITH x(collection, prefix, context) AS (VALUES {_VALUES}) SELECT DISTINCT source, regexp_extract(path, '^([^/]+)/', 1) AS folder FROM documents WHERE active AND source IS NOT NULL AND regexp_extract(path, '^([^/]+)/', 1) <> '' AND NOT EXISTS (SELECT 1 FROM x WHERE x.collection = source AND regexp_extract(prefix, '^/?([^/]+)', 1) = regexp_extract(path, '^([^/]+)/', 1))",
    "path_to_collection": "SELECT doc_id, CASE WHEN starts_with(path, 'es/') THEN 'kb-es' ELSE 'kb' END AS name, CASE WHEN starts_with(path, 'es/') THEN substr(path, 4) ELSE path END AS relative FROM documents",
    "line_slice": "SELECT doc_id, array_to_string(string_split(text, chr(10))[2:4], chr(10)) AS lines FROM documents WHERE text IS NOT NULL",
    "line_numbers": "WITH s AS (SELECT doc_id, string_split(concat_ws(chr(10), title, path), chr(10)) AS l FROM documents) SELECT doc_id, array_to_string(list_transform(l, lambda x, i: (i + 4)::VARCHAR || ': ' || x), chr(10)) AS lines FROM s",
    "snippet_basic": "WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), b AS (SELECT doc_id, l, list_transform(l, lambda x: contains(lower(x), 'harbour')::INT + contains(lower(x), 'glossary')::INT) AS sc FROM s), p AS (SELECT doc_id, l, len(l) AS n, list_position(sc, list_max(sc)) - 1 AS best FROM b), q AS (SELECT *, greatest(best - 1, 0) AS st, least(n, best + 3) - greatest(best - 1, 0) AS k FROM p), r AS (SELECT *, array_to_string(l[st + 1:st + k], chr(10)) AS t FROM q) SELECT doc_id, (best + 1)::INT AS line, '@@ -' || (st + 1) || ',' || k || ' @@ (' || st || ' before, ' || (n - st - k) || ' after)' || chr(10) || CASE WHEN length(t) > 500 THEN left(t, 497) || '...' ELSE t END AS snippet FROM r",
    "title_extract": f"SELECT doc_id, {_title(chr(39).join(['coalesce(text, ', '', ')']))} AS title FROM documents",
    "path_slug": f"WITH s AS (SELECT doc_id, string_split('notes/2025/' || title, '/') AS p FROM documents WHERE title IS NOT NULL), x AS (SELECT doc_id, p, list_filter(list_transform(p[:-2], lambda x: {_SLUG('x')}), lambda x: x <> '') AS f, {_SLUG('p[-1]')} || '.md' AS l FROM s) SELECT doc_id, CASE WHEN regexp_matches(p[-1], '[\\p{{L}}\\p{{N}}$]') THEN array_to_string(list_append(f, l), '/') END AS slug FROM x",
    "virtual_path_parse": "SELECT doc_id, coalesce(source, 'none') AS collection, path AS rest FROM documents",
    "content_hashes": "WITH t AS (SELECT doc_id, path, coalesce(text, '') AS t FROM documents) SELECT doc_id, sha256(t) AS plain, sha256('{\"content\":' || to_json(t)::VARCHAR || ',\"normalizationPolicyVersion\":\"1\"}') AS wrapped, sha256('{\"path\": ' || to_json(path)::VARCHAR || ', \"text\": ' || to_json(t)::VARCHAR || '}') AS spaced FROM t",
    "sensitive_scan": f"SELECT doc_id, coalesce({_first('title', T.SENSITIVE)}, {_first('text', T.SENSITIVE)}) AS reason FROM documents",
    "failure_class": f"WITH c AS (SELECT doc_id, coalesce({_first('text', T.FAILURES)}, 'unknown') AS kind FROM documents WHERE text IS NOT NULL) SELECT doc_id, kind, kind IN ('rate_limit', 'timeout', 'network', 'server') AS retryable FROM c",
    "redacted": f"SELECT doc_id, length(regexp_replace({_redacted('text')}, '\\s+', '', 'g'))::INT AS chars FROM documents WHERE text IS NOT NULL",
    "intent_terms": rf"SELECT record_id, array_to_string(list_filter(list_transform(regexp_split_to_array(lower(intent), '\s+'), lambda x: regexp_replace(x, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')), lambda x: length(x) > 1 AND x NOT IN ({', '.join(repr(w) for w in T.INTENT_STOP_WORDS)})), ' ') AS terms FROM qmd_expansion_sports WHERE intent IS NOT NULL",
}
