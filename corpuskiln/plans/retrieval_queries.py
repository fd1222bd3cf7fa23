"""Queries of lexical, vector and fused retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import ACCENTED, PLAIN, docid, token_string, token_total, virtual_path
from corpuskiln.operators import fusion, lexical, postings, vectors
from corpuskiln.operators.ranking import gap_to_runner_up, with_rank
from corpuskiln.session import spread, stage_table


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/embeddings.parquet")


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "rank", F.round("score", 6).alias("score"))


# query name -> (query text, options)
SEARCHES = {
    "bm25_topk": ("harbour telescope", {}),
    "bm25_prefix": ("calib notebook", {}),
    "bm25_phrase": ('"nothing about"', {"limit": 50}),
    "bm25_negation": ("harbour -telescope -\"old harbour\"", {}),
    "bm25_hyphen": ("follow-up", {}),
    "bm25_accents": ("reunion", {}),
    "bm25_cjk": ("桥", {}),
    "bm25_collection_overfetch": ("harbour", {"collection": "web-clips"}),
    "bm25_collection_exact": ("harbour", {"collection": "web-clips", "exact_filter": True}),
    "bm25_min_score": ("harbour telescope", {"min_score": 0.8}),
}


#: Searches that are also run from an inverted index.
INDEXED = ["bm25_topk", "bm25_prefix", "bm25_phrase", "bm25_negation", "bm25_collection_overfetch"]


def _search_query(name: str):
    text, options = SEARCHES[name]

    def run(spark: SparkSession, d: str) -> DataFrame:
        return _ranked(lexical.search(documents(spark, d), text, stem=False, **options))

    run.__doc__ = f"BM25 search for {text!r} over path, title and body of active documents."
    return run


def bm25_display(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: BM25 top rows with display columns."""
    docs = documents(spark, d)
    top = lexical.search(docs, "harbour telescope", limit=10, stem=False)
    shown = docs.select("doc_id", virtual_path(F.coalesce("source", F.lit("none")), F.col("path")).alias("file"), docid(F.coalesce("hash", F.lit(""))).alias("docid"), "title")
    return shown.join(F.broadcast(top.select("doc_id", "rank", "score")), "doc_id").select("doc_id", "file", "docid", "title", "rank", F.round("score", 6).alias("score"))  # ten rows


def bm25_stemmed(spark: SparkSession, d: str) -> DataFrame:
    """BM25 with Porter stems (checked against an FTS index in the tests)."""
    return _ranked(lexical.search(documents(spark, d), "calibrating translated notebooks", stem=True))


def document_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Documents and occurrences of each term of all texts."""
    return lexical.document_frequency(spread(documents(spark, d)), "text")


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    """Token length of each document by field."""
    return spread(documents(spark, d)).select("doc_id", token_total(token_string(F.col("title"))).alias("title_tokens"), token_total(token_string(F.col("text"))).alias("body_tokens"))


def knn_multi_query(spark: SparkSession, d: str) -> DataFrame:
    """Five nearest neighbours of every vector whose id is divisible by 50, against all vectors."""
    v = embeddings(spark, d)
    q = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors.nearest(v, "vec_id", "embedding", q, "query_id", "embedding", 5).withColumn("distance", F.round("distance", 4) + 0.0)


def _query_vector(spark: SparkSession, d: str, vec_id: int = 7) -> list[float]:
    return list(embeddings(spark, d).where(F.col("vec_id") == vec_id).first()["embedding"])


def knn_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """Nearest rows of one vector by cosine distance."""
    r = vectors.search(embeddings(spark, d), _query_vector(spark, d), limit=30, overfetch=1)
    return r.select("vec_id", "rank", (F.round("distance", 4) + 0.0).alias("distance"), F.round("score", 4).alias("score"))


def knn_overfetch_filter(spark: SparkSession, d: str) -> DataFrame:
    """Nearest rows of one label, taken before the filter: fewer than the limit may come back."""
    r = vectors.search(embeddings(spark, d), _query_vector(spark, d), limit=20, collection=2, collection_col="label")
    return r.select("vec_id", "rank", (F.round("distance", 4) + 0.0).alias("distance"))


def knn_best_per_file(spark: SparkSession, d: str) -> DataFrame:
    """Best vector of each label among the nearest (files are labels here)."""
    r = vectors.search(embeddings(spark, d), _query_vector(spark, d), limit=20, file_col="label")
    return r.select("file", "vec_id", "rank", (F.round("distance", 4) + 0.0).alias("distance"))


def vector_min_score(spark: SparkSession, d: str) -> DataFrame:
    """Semantic-only search with the default least score 0.3."""
    r = vectors.search(embeddings(spark, d), _query_vector(spark, d), limit=50, min_score=0.3)
    return r.select("vec_id", "rank", F.round("score", 4).alias("score"))


def hash_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic vectors of all documents' texts, as text."""
    v = vectors.hash_vector(F.coalesce("text", F.lit("")))
    return documents(spark, d).select("doc_id", F.array_join(F.transform(v, lambda x: F.format_number(x, 6)), " ").alias("vector"))


_LISTS = [("harbour telescope", 2.0), ("harbour", 1.0), ("telescope", 1.0)]


def _stacked(spark: SparkSession, d: str) -> DataFrame:
    docs = lexical.index(documents(spark, d), stem=False)
    return fusion.stack_lists([lexical.search(docs, q, stem=False) for q, _ in _LISTS], "doc_id", [w for _, w in _LISTS], ["fts"] * 3)


def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    """Three ranked lists fused by reciprocal rank with the bonuses of the best rank."""
    r = with_rank(fusion.fuse(_stacked(spark, d)), fusion.fused_order())
    return r.select(F.col("file").alias("doc_id"), "rank", F.round("rrf", 6).alias("rrf"), "best_rank", "first_list")


def rrf_trace(spark: SparkSession, d: str) -> DataFrame:
    """What each list contributes to each document's fused score."""
    t = fusion.trace(_stacked(spark, d)).select("file", F.explode("contributions").alias("c"))
    return t.select(F.col("file").alias("doc_id"), F.col("c.list_idx").alias("list_idx"), F.col("c.rank").alias("rank"), F.round("c.contribution", 6).alias("contribution"))


def position_blend(spark: SparkSession, d: str) -> DataFrame:
    """Fused rank blended with the default reranker over the texts."""
    docs = documents(spark, d)
    ranked = with_rank(fusion.fuse(_stacked(spark, d)), fusion.fused_order())
    scored = fusion.lexical_rerank(docs.select(F.col("doc_id").alias("file"), "text").join(F.broadcast(ranked), "file"), "text", "harbour telescope")  # sixty rows at most
    return fusion.blend(scored, "rank", "rerank_score").select(F.col("file").alias("doc_id"), "rank", F.round("rerank_score", 6).alias("rerank_score"), F.round("blended", 6).alias("blended"))


def _backends(spark: SparkSession, d: str):
    """The two search functions of the hybrid pipeline over active documents: BM25, and nearest deterministic vectors of the texts."""
    docs = documents(spark, d)
    index = lexical.index(docs, stem=False)
    embedded = stage_table(docs.where("active").select("doc_id", vectors.hash_vector(F.coalesce("text", F.lit(""))).alias("v")), "embedded")

    def semantic(query: str) -> DataFrame:
        asked = spark.range(1).select(vectors.hash_vector(F.lit(query)).alias("v")).first()["v"]
        return vectors.search(embedded, list(asked), limit=20, id_col="doc_id", embedding="v")

    return (lambda q: lexical.search(index, q, stem=False)), semantic


_EXPANDED = [fusion.Search("lex", "harbour"), fusion.Search("vec", "an old telescope"), fusion.Search("hyde", "The glossary says what a harbour is.")]


def hybrid_skip_rerank(spark: SparkSession, d: str) -> DataFrame:
    """The hybrid pipeline (BM25 and vector lists, expansions in their backends) without reranking: score is 1 / rank."""
    r = fusion.hybrid(*_backends(spark, d), "harbour telescope", _EXPANDED, skip_rerank=True, limit=20)
    return r.select("doc_id", "rank", F.round("score", 6).alias("score"), F.round("rrf", 6).alias("rrf"))


def hybrid_rerank(spark: SparkSession, d: str) -> DataFrame:
    """The hybrid pipeline with the best candidates reranked on their whole texts and blended by position."""
    docs = documents(spark, d).select("doc_id", "text")
    r = fusion.hybrid(*_backends(spark, d), "harbour telescope", _EXPANDED, docs, limit=20, whole_texts=True)
    return r.select("doc_id", "rank", F.round("score", 6).alias("score"), F.round("rrf", 6).alias("rrf"), F.round("rerank_score", 6).alias("rerank_score"))


def hybrid_best_chunk(spark: SparkSession, d: str) -> DataFrame:
    """The hybrid pipeline with each candidate reranked on its best chunk (tested on fixtures: SQL has no chunker)."""
    docs = documents(spark, d).select("doc_id", "text")
    r = fusion.hybrid(*_backends(spark, d), "harbour telescope", _EXPANDED, docs, limit=20)
    return r.select("doc_id", "rank", F.round("score", 6).alias("score"), "chunk", F.round("rerank_score", 6).alias("rerank_score"))


def structured_first_list_boost(spark: SparkSession, d: str) -> DataFrame:
    """Typed searches in their own backends: the first non-empty list counts double."""
    r = fusion.structured(*_backends(spark, d), [fusion.Search("lex", "zzzznothing"), fusion.Search("lex", "telescope"), fusion.Search("vec", "harbour")], skip_rerank=True, limit=20)
    return r.select("doc_id", "rank", F.round("score", 6).alias("score"), F.round("rrf", 6).alias("rrf"))


def structured_collections(spark: SparkSession, d: str) -> DataFrame:
    """Typed searches over two collections: a list per search and collection."""
    docs = documents(spark, d)
    finders = {c: lambda q, part=lexical.index(docs.where(F.col("source") == c), stem=False): lexical.search(part, q, stem=False) for c in ("web-clips", "essays")}
    r = fusion.structured_over(finders, {}, [fusion.Search("lex", "telescope"), fusion.Search("lex", "harbour")], skip_rerank=True, limit=20)
    return r.select("doc_id", "rank", F.round("rrf", 6).alias("rrf"))


def _postings_query(name: str):
    text, options = SEARCHES[name]

    def run(spark: SparkSession, d: str) -> DataFrame:
        return _ranked(postings.search(postings.build(documents(spark, d), stem=False), text, **options))

    run.__doc__ = f"The rows of {name} from an inverted index."
    return run


def strong_signal(spark: SparkSession, d: str) -> DataFrame:
    """Best lexical score and its lead over the second."""
    r = gap_to_runner_up(lexical.search(documents(spark, d), "harbour telescope", stem=False), "score")
    return r.select(F.round("top", 6).alias("top"), F.round("lead", 6).alias("lead"), ((F.col("top") >= fusion.STRONG_SCORE) & (F.col("lead") >= fusion.STRONG_LEAD)).alias("strong"))


QUERIES = {name: _search_query(name) for name in SEARCHES} | {
    f.__name__: f for f in (bm25_display, bm25_stemmed, document_frequency, token_counts, knn_multi_query, knn_cosine_topk, knn_overfetch_filter, knn_best_per_file, vector_min_score, hash_vectors, rrf_fusion, rrf_trace, position_blend, hybrid_skip_rerank, hybrid_rerank, hybrid_best_chunk, structured_first_list_boost, structured_collections, strong_signal)
} | {name.replace("bm25", "postings"): _postings_query(name) for name in INDEXED}


def _tokens_sql(column: str) -> str:
    folded = f"translate(lower(coalesce({column}, '')), '{ACCENTED}', '{PLAIN}')"
    spaced = rf"regexp_replace({folded}, '([\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Hangul}}])', ' \1 ', 'g')"
    return rf"' ' || trim(regexp_replace({spaced}, '[^\p{{L}}\p{{N}}]+', '  ', 'g')) || ' '"


def _total_sql(t: str) -> str:
    return f"(CASE WHEN trim({t}) = '' THEN 0 ELSE (length({t}) - length(replace({t}, '  ', ''))) // 2 + 1 END)"


def _bm25_sql(text: str, where: str = "active") -> str:
    """A common table ``s`` (doc_id, source, raw, score) for a query."""
    phrases = lexical.parse_query(text)
    hit = lambda p, f: f"(length({f}) - length(replace({f}, '{p.needle()}', ''))) // {len(p.needle())}"
    positive, negative = [p for p in phrases if not p.negated], [p for p in phrases if p.negated]
    fs = ", ".join(f"1.5 * ({hit(p, 'a')}) + 4.0 * ({hit(p, 'b')}) + 1.0 * ({hit(p, 'c')}) AS f{i}" for i, p in enumerate(positive))
    no = " OR ".join(f"({hit(p, f)}) > 0" for p in negative for f in "abc") or "false"
    idf = lambda i: f"CASE WHEN ln((n - n{i} + 0.5) / (n{i} + 0.5)) > 0 THEN ln((n - n{i} + 0.5) / (n{i} + 0.5)) ELSE 1e-6 END"
    raw = " + ".join(f"({idf(i)}) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * d / mean))" for i in range(len(positive)))
    every = " AND ".join(f"f{i} > 0" for i in range(len(positive)))
    return f"""t AS (SELECT doc_id, source, {_tokens_sql('path')} AS a, {_tokens_sql('title')} AS b, {_tokens_sql('text')} AS c FROM documents WHERE {where}),
c AS (SELECT doc_id, source, ({_total_sql('a')} + {_total_sql('b')} + {_total_sql('c')})::DOUBLE AS d, {fs}, ({no}) AS no FROM t),
g AS (SELECT count(*) AS n, avg(d) AS mean, {', '.join(f'count(*) FILTER (f{i} > 0) AS n{i}' for i in range(len(positive)))} FROM c),
s AS (SELECT doc_id, source, raw, raw / (1 + raw) AS score FROM (SELECT doc_id, source, {raw} AS raw FROM c, g WHERE {every} AND NOT no))"""


def _top_sql(limit: int = 20, source: str = "s", where: str = "true") -> str:
    return f"SELECT doc_id, row_number() OVER (ORDER BY raw DESC, doc_id)::INT AS rank, round(score, 6) AS score FROM (SELECT * FROM {source} WHERE {where} ORDER BY raw DESC, doc_id LIMIT {limit})"


def _search_sql(name: str) -> str:
    text, o = SEARCHES[name]
    limit, collection = o.get("limit", 20), o.get("collection")
    if collection and o.get("exact_filter"):
        return f"WITH {_bm25_sql(text, f'active AND source = {collection!r}')} {_top_sql(limit)}"
    source = f"(SELECT * FROM s ORDER BY raw DESC, doc_id LIMIT {10 * limit})" if collection else "s"
    where = f"source = '{collection}'" if collection else f"score >= {o.get('min_score', 0)}"
    return f"WITH {_bm25_sql(text)} {_top_sql(limit, source, where)}"


def _lists_sql() -> str:
    parts = []
    for i, (q, w) in enumerate(_LISTS):
        parts.append(f"l{i} AS (WITH {_bm25_sql(q)} SELECT {i} AS list_idx, doc_id, row_number() OVER (ORDER BY raw DESC, doc_id)::INT AS rank, score, {w} AS weight FROM (SELECT * FROM s ORDER BY raw DESC, doc_id LIMIT 20))")
    return "WITH " + ", ".join(parts) + ", st AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2)"


_FUSE = ", fu AS (SELECT doc_id, sum(weight / (60 + rank)) + CASE WHEN min(rank) = 1 THEN 0.05 WHEN min(rank) <= 3 THEN 0.02 ELSE 0 END AS rrf, min(rank) AS best_rank, min(list_idx) AS first_list, min(list_idx * 1000 + rank) AS first FROM st GROUP BY doc_id), ra AS (SELECT *, row_number() OVER (ORDER BY rrf DESC, first, doc_id)::INT AS rank FROM fu)"


def _distance(a: str, b: str) -> str:
    return f"(1 - list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[]))))"


_NEAR = f"WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7), v AS (SELECT vec_id, label, {_distance('embedding', 'e')} AS x FROM embeddings, q)"


def _list_sql(i: int, kind: str, query: str, weight: float, where: str = "active") -> str:
    """A common table of a ranked list: of BM25, or of the vectors of active documents' texts."""
    if kind == "lex":
        return f"l{i} AS (WITH {_bm25_sql(query, where)} SELECT {i} AS list_idx, doc_id, row_number() OVER (ORDER BY raw DESC, doc_id)::INT AS rank, {weight} AS weight FROM (SELECT * FROM s ORDER BY raw DESC, doc_id LIMIT 20))"
    vector = lambda text: f"list_transform(range(16), lambda i: round(('0x' || substr(sha256({text}), (2 * i + 1)::INT, 2))::INT / 255.0, 6)::DOUBLE)"
    asked = query.replace("'", "''")
    return f"l{i} AS (WITH v AS (SELECT doc_id, {vector(_TEXT)} AS e, {vector(chr(39) + asked + chr(39))} AS q FROM documents WHERE active), n AS (SELECT doc_id, {_distance('e', 'q')} AS x FROM v) SELECT {i} AS list_idx, doc_id, row_number() OVER (ORDER BY x, doc_id)::INT AS rank, {weight} AS weight FROM (SELECT * FROM n ORDER BY x, doc_id LIMIT 20))"


def _fused_sql(lists: list[tuple[str, str, float]], where: list[str] | None = None) -> str:
    return "WITH " + ", ".join(_list_sql(i, *x, *([where[i]] if where else [])) for i, x in enumerate(lists)) + ", st AS (" + " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(len(lists))) + ")" + _FUSE


_TEXT = "coalesce(text, '')"
_FOUND = " SELECT doc_id, rank, round(1.0 / rank, 6) AS score, round(rrf, 6) AS rrf FROM ra WHERE rank <= 20"
_HYBRID_LISTS = [("lex", "harbour telescope", 2.0), ("vec", "harbour telescope", 2.0), *(("lex" if x.type == "lex" else "vec", x.query, 1.0) for x in _EXPANDED)]

SQL = {name: _search_sql(name) for name in SEARCHES} | {
    "bm25_display": f"WITH {_bm25_sql('harbour telescope')}, top AS (SELECT doc_id, row_number() OVER (ORDER BY raw DESC, doc_id)::INT AS rank, round(score, 6) AS score FROM s ORDER BY raw DESC, doc_id LIMIT 10) SELECT doc_id, 'store://' || coalesce(d.source, 'none') || '/' || path AS file, left(coalesce(hash, ''), 6) AS docid, title, rank, score FROM documents d JOIN top USING (doc_id)",
    "document_frequency": f"WITH t AS (SELECT doc_id, unnest(string_split(trim({_tokens_sql('text')}), '  ')) AS term FROM documents), u AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term <> '' GROUP BY 1, 2) SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS cf FROM u GROUP BY 1",
    "token_counts": f"WITH t AS (SELECT doc_id, {_tokens_sql('title')} AS a, {_tokens_sql('text')} AS b FROM documents) SELECT doc_id, {_total_sql('a')}::BIGINT AS title_tokens, {_total_sql('b')}::BIGINT AS body_tokens FROM t",
    "knn_multi_query": f"WITH p AS (SELECT q.vec_id AS query_id, v.vec_id, {_distance('v.embedding', 'q.embedding')} AS x FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY x, vec_id)::INT AS rank FROM p) SELECT query_id, vec_id, round(x, 4) + 0.0 AS distance, rank FROM r WHERE rank <= 5",
    "knn_cosine_topk": _NEAR + " SELECT vec_id, row_number() OVER (ORDER BY x, vec_id)::INT AS rank, round(x, 4) + 0.0 AS distance, round(1 - x, 4) AS score FROM (SELECT * FROM v ORDER BY x, vec_id LIMIT 30)",
    "knn_overfetch_filter": _NEAR + " SELECT vec_id, row_number() OVER (ORDER BY x, vec_id)::INT AS rank, round(x, 4) + 0.0 AS distance FROM (SELECT * FROM (SELECT * FROM v ORDER BY x, vec_id LIMIT 60) WHERE label = 2 ORDER BY x, vec_id LIMIT 20)",
    "knn_best_per_file": _NEAR + ", n AS (SELECT * FROM v ORDER BY x, vec_id LIMIT 60), b AS (SELECT label, arg_min(vec_id, x) AS vec_id, min(x) AS x FROM n GROUP BY label) SELECT label AS file, vec_id, row_number() OVER (ORDER BY x, vec_id)::INT AS rank, round(x, 4) + 0.0 AS distance FROM b ORDER BY x, vec_id LIMIT 20",
    "vector_min_score": _NEAR + " SELECT vec_id, row_number() OVER (ORDER BY x, vec_id)::INT AS rank, round(1 - x, 4) AS score FROM (SELECT * FROM (SELECT * FROM v ORDER BY x, vec_id LIMIT 150) WHERE 1 - x >= 0.3 ORDER BY x, vec_id LIMIT 50)",
    "hash_vectors": "SELECT doc_id, array_to_string(list_transform(range(16), lambda i: printf('%.6f', round(('0x' || substr(sha256(coalesce(text, '')), (2 * i + 1)::INT, 2))::INT / 255.0, 6))), ' ') AS vector FROM documents",
    "rrf_fusion": _lists_sql() + _FUSE + " SELECT doc_id, rank, round(rrf, 6) AS rrf, best_rank, first_list FROM ra",
    "rrf_trace": _lists_sql() + " SELECT doc_id, list_idx, rank, round(weight / (60 + rank), 6) AS contribution FROM st",
    "position_blend": _lists_sql() + _FUSE + ", sc AS (SELECT ra.doc_id, rank, ((contains(lower(text), 'harbour'))::INT + (contains(lower(text), 'telescope'))::INT) / 2.0 AS r, CASE WHEN rank <= 3 THEN 0.75 WHEN rank <= 10 THEN 0.6 ELSE 0.4 END AS w FROM ra JOIN documents d ON d.doc_id = ra.doc_id) SELECT doc_id, rank, round(coalesce(r, 0), 6) AS rerank_score, round(w / rank + (1 - w) * coalesce(r, 0), 6) AS blended FROM sc",
    "hybrid_skip_rerank": _fused_sql(_HYBRID_LISTS) + _FOUND,
    "hybrid_rerank": _fused_sql(_HYBRID_LISTS) + ", sc AS (SELECT ra.doc_id, rank, rrf, (contains(lower(coalesce(text, '')), 'harbour')::INT + contains(lower(coalesce(text, '')), 'telescope')::INT) / 2.0 AS r, CASE WHEN rank <= 3 THEN 0.75 WHEN rank <= 10 THEN 0.6 ELSE 0.4 END AS w FROM ra JOIN documents d ON d.doc_id = ra.doc_id WHERE rank <= 40), bl AS (SELECT *, w / rank + (1 - w) * r AS blended FROM sc) SELECT doc_id, row_number() OVER (ORDER BY blended DESC, rank)::INT AS rank, round(blended, 6) AS score, round(rrf, 6) AS rrf, round(r, 6) AS rerank_score FROM (SELECT * FROM bl ORDER BY blended DESC, rank LIMIT 20)",
    "structured_first_list_boost": _fused_sql([("lex", "telescope", 2.0), ("vec", "harbour", 1.0)]) + _FOUND,
    "structured_collections": _fused_sql([("lex", q, 2.0 if not i else 1.0) for i, (q, _) in enumerate((q, c) for q in ("telescope", "harbour") for c in ("web-clips", "essays"))], [f"active AND source = '{c}'" for _ in range(2) for c in ("web-clips", "essays")]) + " SELECT doc_id, rank, round(rrf, 6) AS rrf FROM ra WHERE rank <= 20",
    "strong_signal": f"WITH {_bm25_sql('harbour telescope')}, tt AS (SELECT score, row_number() OVER (ORDER BY raw DESC) AS r FROM s), x AS (SELECT coalesce(max(score) FILTER (r = 1), 0) AS top, coalesce(max(score) FILTER (r = 1), 0) - coalesce(max(score) FILTER (r = 2), 0) AS lead FROM tt) SELECT round(top, 6) AS top, round(lead, 6) AS lead, (top >= 0.85 AND lead >= 0.15) AS strong FROM x",
}
SQL |= {name.replace("bm25", "postings"): SQL[name] for name in INDEXED}
