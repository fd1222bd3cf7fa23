"""Queries of the graph plane, routing, chunking, evaluation and state reductions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskiln.functions.keys import canonical_key, instant
from corpuskiln.functions.text import TOPIC_STOP_WORDS, topic_tokens
from corpuskiln.functions.udfs import book_slug
from corpuskiln.operators import chunking, evaluation, graph, lexical, ranking, routing, state
from corpuskiln.plans.retrieval_queries import _bm25_sql, _distance
from corpuskiln.session import stage_table
from corpuskiln.sources import readers, sinks


def _read(spark: SparkSession, d: str, t: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{t}.parquet")


def _reports(spark, d) -> DataFrame:
    """Active documents as reports of their source: rank is the length in thousands of characters."""
    return _read(spark, d, "documents").where("active and source is not null").select(F.col("source").alias("member"), F.col("document_id").alias("report_id"), "title", F.coalesce("text", F.lit("")).alias("summary"), (F.coalesce("n_chars", F.lit(0)) / 1000).alias("rank"), F.col("doc_id").alias("pos"))


def _units(spark, d) -> DataFrame:
    return graph.limit_units(graph.semantic_units(_reports(spark, d), "shelf-1", "gen-1"), 32)


def topk_per_group(spark, d):
    """The eight best reports of each source."""
    return graph.selected_reports(_reports(spark, d), "member").select("member", "report_id", "place")


def semantic_units(spark, d):
    """Units of an upper level with stable ids."""
    u = graph.semantic_units(_reports(spark, d), "shelf-1", "gen-1")
    return u.select("member", "report_id", "unit_id", "evidence_id", "title", "token_estimate", F.round("rank", 3).alias("rank"))


def edges_token_overlap(spark, d):
    """Edges between units: same source or two shared topic tokens."""
    return graph.edges(_units(spark, d)).select("left", "right", "relation", F.round("weight", 2).alias("weight"), F.array_join("shared", " ").alias("shared"))


def communities_rollup(spark, d):
    """A community per source and the overview of all."""
    u = _units(spark, d)
    per = graph.communities(u).select("member", "n_units", F.round("rank", 3).alias("rank"), F.left("summary", F.lit(80)).alias("summary"))
    return per.unionByName(graph.overview(u).select(F.lit("overview").alias("member"), "n_units", F.round("rank", 3).alias("rank"), F.left("summary", F.lit(80)).alias("summary")))


def report_search(spark, d):
    """Reports that answer a question best."""
    r = graph.search_reports(_reports(spark, d), "Which harbour telescope did the glossary describe?", 10, ("title", "summary"))
    return r.select("report_id", "place", F.round("score", 6).alias("score"))


def report_evidence(spark, d):
    """Evidence of each report by its own list, else by reverse reference."""
    caps = _read(spark, d, "qmd_graph_capabilities").select("capability_id", "book_id", "document_id", F.col("created_at").alias("at")).distinct()
    evidence = caps.select(F.col("capability_id").alias("evidence_id"), F.col("book_id").alias("upper_id"), F.col("capability_id").alias("pos"))
    named = caps.where("document_id is not null").groupBy("book_id").agg(F.min("capability_id").alias("a"), F.max("capability_id").alias("b"), F.count_if(F.col("document_id").startswith("0")).alias("n"))
    reports = named.select(F.col("book_id").alias("report_id"), F.when(F.col("n") > 0, F.array("b", "a", F.lit("no-such"))).otherwise(F.array().cast("array<string>")).alias("evidence_ids"))
    return graph.report_evidence(reports, evidence)


def scope_semijoin_chain(spark, d):
    """Rows of each graph frame left within the documents of one source."""
    docs = _read(spark, d, "documents").select(canonical_key(F.col("document_id")).alias("id"), "source", canonical_key(F.col("hash")).alias("hash"))
    v = _read(spark, d, "content_vectors").select(canonical_key(F.col("hash")).alias("hash"), "seq").where("hash is not null").distinct()
    v = stage_table(v, "pieces")  # five frames are made of it
    unit = F.concat_ws("_", "hash", "seq")
    units = v.join(docs, "hash").select(unit.alias("id"), F.col("id").alias("document_id"))
    per = v.groupBy("hash").agg(F.array_sort(F.collect_list(unit)).alias("text_unit_ids"))  # pieces of one body
    entities = per.select(F.concat(F.lit("ent-"), "hash").alias("id"), "text_unit_ids")
    relationships = v.where("seq > 0").select(F.concat(F.lit("rel-"), unit).alias("id"), F.array(unit, F.concat_ws("_", "hash", F.col("seq") - 1)).alias("text_unit_ids"))
    community = v.select(F.left("hash", F.lit(6)).alias("community"), unit.alias("u")).groupBy("community").agg(F.array_sort(F.collect_list("u")).alias("text_unit_ids"))
    reports = community.select(F.concat(F.lit("rep-"), "community").alias("id"), "community")
    kept = graph.scope_frames(docs, units, entities, relationships, community, reports, docs.where("source = 'essays'").select("id"))
    whole = None
    for name, df in kept.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("frame"), "n")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def _candidates(spark, d) -> DataFrame:
    docs = _read(spark, d, "documents").where("active")
    key = canonical_key(F.col("document_id"))
    return docs.select(F.col("doc_id").alias("candidate_id"), key.alias("document_id"), F.concat(F.lit("src-"), F.left(key, F.lit(10))).alias("source_id"), canonical_key(F.col("hash")).alias("content_hash"), "source")


def _capabilities(spark, d) -> DataFrame:
    return _read(spark, d, "qmd_graph_capabilities").select("capability_id", "book_id", "kind", "method", F.coalesce("ready", F.lit(False)).alias("ready"), canonical_key(F.col("document_id")).alias("document_id"), "source_id", canonical_key(F.col("content_hash")).alias("content_hash"), "artifact_ids")


def capability_or_join(spark, d):
    """Ready capabilities of each candidate, by document, source or unique content hash."""
    m = graph.match_capabilities(_candidates(spark, d), _capabilities(spark, d))
    return m.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("n"), F.min("capability_id").alias("first"))


def coverage_rate(spark, d):
    """Share of each source's candidates that a graph can answer."""
    c, m = _candidates(spark, d), graph.match_capabilities(_candidates(spark, d), _capabilities(spark, d)).select("candidate_id").distinct().withColumn("r", F.lit(1))
    return c.join(m, "candidate_id", "left").groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("total"), F.count("r").alias("ready"), F.round(F.count("r") / F.count(F.lit(1)), 6).alias("coverage"))


def route_decision(spark, d):
    """Route of every sports query under varying policies."""
    q = _read(spark, d, "qmd_expansion_sports").where("query is not null")
    r = q.select("record_id", "query", F.element_at(F.array(F.lit("auto"), F.lit("graph"), F.lit("retrieval")), (F.col("record_id") % 3 + 1).cast("int")).alias("requested"), F.when(F.col("record_id") % 5 == 0, "low").alias("max_cost"), (F.col("record_id") % 7 != 0).alias("allow_upgrade"), F.lit(10).alias("total"), (F.col("record_id") % 11).cast("int").alias("ready"))
    return routing.decide(r).select("record_id", "intent", "route", "status", "reasons")


def capability_union(spark, d):
    """Derived capabilities of every book, completed by explicit ones that are new."""
    caps = _capabilities(spark, d).where("ready and method is not null").select("capability_id", "book_id", "method").distinct()
    books = caps.select("book_id").distinct()
    derived = graph.derive_capabilities(books, "book_id", ["local", "global"]).select("capability_id", "book_id", "method")
    return graph.merge_capabilities(derived, caps, ["book_id", "method"]).groupBy("method").agg(F.count(F.lit(1)).alias("n"))


def artifact_lineage(spark, d):
    """Artifact ids of each book, from lists in any spelling."""
    c = _capabilities(spark, d).select("book_id", graph.id_array(F.col("artifact_ids")).alias("a"), "method")
    n = state.unite_arrays(c, "book_id", "a").groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))
    return state.merge_scalars(c, "book_id", ["method"]).join(n, "book_id", "left").select("book_id", F.coalesce("method", F.lit("")).alias("method"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_artifacts"))


def lineage_gaps(spark, d):
    """Evidence fields that are null, blank or unknown."""
    c = _read(spark, d, "qmd_graph_capabilities")
    e = c.select(F.col("book_id").alias("targetBookId"), F.col("source_id").alias("targetSourceId"), F.col("document_id").alias("targetDocumentId"), F.col("content_hash").alias("targetContentHash"), F.col("capability_id").alias("targetCommunityReportId"), F.col("method").alias("targetTextUnitId"), F.col("artifact_ids").alias("targetArtifactDigest"), F.col("capability_id").alias("pos"))
    return graph.lineage_gaps(e)


def generation_hash(spark, d):
    """Hash of the sorted members of a shelf."""
    return graph.generation_hash(_read(spark, d, "source_targets"), "source").select("generation", "n")


def prompt_packing(spark, d):
    """Reports that fit a prompt of 4000 tokens."""
    r = graph.search_reports(_reports(spark, d), "harbour telescope glossary", 20, ("title", "summary"))
    return graph.pack_prompt(r, [F.col("place")], "summary", 4000).select("report_id", "place", "tokens")


def topic_token_sets(spark, d):
    """Topic tokens of every title."""
    return _read(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(topic_tokens(F.col("title"))), " ").alias("tokens"))


def book_slugs(spark, d):
    """ASCII slugs of all titles."""
    return _read(spark, d, "documents").select("doc_id", book_slug(F.col("title")).alias("slug"))


def partition_plan(spark, d):
    """Books in parts of a hundred."""
    b = _read(spark, d, "qmd_graph_capabilities").select("book_id").distinct()
    return ranking.partition_plan(b, "book_id", 100)


def chunk_documents(spark, d):
    """Every document's chunks."""
    return chunking.chunk_documents(_read(spark, d, "documents"), "doc_id", "text", "path").select("doc_id", "seq", "pos", F.length("text").alias("chars"))


def best_chunk_terms(spark, d):
    """The paragraph of each text that holds most query terms."""
    t = _read(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n\n", -1)).alias("seq", "text"))
    return chunking.best_chunk(t, "doc_id", "harbour glossary telescope", ["kettle"])


def embedding_batches(spark, d):
    """Greedy batches of texts by count and bytes, per source."""
    t = _read(spark, d, "documents").where("text is not null").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.octet_length("text").alias("bytes"))
    return chunking.pack_batches(t, "doc_id", "bytes", 64, 200000, "source").select("doc_id", "source", "batch")


def html_to_text(spark, d):
    """Plain Markdown of all texts that hold HTML."""
    t = _read(spark, d, "documents").where(F.col("text").rlike("<[a-z]+[ >]"))
    return t.select("doc_id", readers.html_to_text(F.col("text")).alias("text")).select("doc_id", F.length("text").alias("chars"))


_WORDS = ["harbour", "telescope", "glossary", "kettle", "notebook"]


def _judged(spark, d):
    docs = _read(spark, d, "documents")
    searchable = lexical.index(docs, stem=False)
    results = expected = None
    for w in _WORDS:
        r = lexical.search(searchable, w, limit=10, stem=False).join(docs.select("doc_id", "path"), "doc_id").select(F.lit(w).alias("query_id"), "rank", F.col("path").alias("file"))
        e = docs.where(F.col("active") & F.lower("title").contains(w)).select(F.lit(w).alias("query_id"), F.upper(F.concat(F.lit("/"), "path")).alias("file"))
        results, expected = (r, e) if results is None else (results.unionByName(r), expected.unionByName(e))
    return results, expected


def precision_recall_mrr(spark, d):
    """Metrics of five one-word queries against documents named by the word."""
    m = evaluation.score_results(*_judged(spark, d), k=10)
    return m.select("query_id", "hits_at_k", *(F.round(c, 6).alias(c) for c in ("precision_at_k", "recall", "recall_at_1", "recall_at_3", "recall_at_5", "mrr", "f1")))


def unmatched_files(spark, d):
    """Expected documents that were not found."""
    return evaluation.unmatched(*_judged(spark, d))


def label_hit_rate(spark, d):
    """Share of vectors whose nearest neighbours share their label, by label."""
    from corpuskiln.operators import vectors

    v = _read(spark, d, "embeddings")
    near = vectors.nearest(v, "vec_id", "embedding", v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), "query_id", "embedding", 6).where("query_id <> vec_id")
    hit = near.join(v.select("vec_id", F.col("label").alias("l")), "vec_id").join(v.select(F.col("vec_id").alias("query_id"), "label"), "query_id").groupBy("query_id", "label").agg(F.min(F.when(F.col("l") == F.col("label"), F.col("rank") - 1)).alias("r"))
    return evaluation.hit_rates(hit, "label", "r").select("label", "n", *(F.round(f"hit_at_{k}", 6).alias(f"hit_at_{k}") for k in (1, 3, 5)))


def jaccard_match(spark, d):
    """Best token overlap between each record's query and its lex lines."""
    s = _read(spark, d, "qmd_expansion_locations").where("query is not null and output is not null")
    lex = F.transform(F.filter("output", lambda x: (x["type"] == "lex") & x["text"].isNotNull()), lambda x: x["text"])
    return s.select("record_id", F.coalesce(F.round(evaluation.best_match(lex, F.col("query"))["similarity"], 6), F.lit(-1.0)).alias("similarity"))


def dataset_stats(spark, d):
    """Counts over the personal expansions."""
    return evaluation.dataset_stats(_read(spark, d, "qmd_expansion_personal_entities"))


def query_categories(spark, d):
    """Queries by category."""
    q = _read(spark, d, "qmd_expansion_sports").where("query is not null")
    return q.groupBy(evaluation.query_category(F.col("query")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def normalized_output(spark, d):
    """Expansion lines as text in the order hyde, lex, vec."""
    s = _read(spark, d, "qmd_expansion_locations")
    return s.select("record_id", evaluation.expansion_text(evaluation.normalize_output(F.col("output"))).alias("text"))


def expansion_parse(spark, d):
    """Lines by type after expansions are written as text and parsed again."""
    s = _read(spark, d, "qmd_expansion_locations").where("output is not null")
    lines = s.select(F.explode(evaluation.parse_expansion(evaluation.expansion_text(F.col("output")))).alias("x"))
    return lines.groupBy(F.col("x.type").alias("type")).agg(F.count(F.lit(1)).alias("n"))


def example_dedupe(spark, d):
    """One example per query, that of the smallest id."""
    return evaluation.deduplicate(_read(spark, d, "qmd_expansion_personal_entities"), "record_id").select("record_id")


def split_sizes(spark, d):
    """Hash split of the examples."""
    return evaluation.split(_read(spark, d, "qmd_expansion_sports"), "record_id").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def micro_f1(spark, d):
    """Lines of locations against those of the record before it, by type."""
    s = _read(spark, d, "qmd_expansion_locations").select("record_id", F.explode("output").alias("x")).select("record_id", "x.type", "x.text")
    r = evaluation.micro_f1(s.withColumn("record_id", F.col("record_id") + 1), s, "record_id")
    return r.select("type", "p", "t", "hit", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


def reward_score(spark, d):
    """Reward of every sports expansion."""
    s = _read(spark, d, "qmd_expansion_sports")
    text = evaluation.expansion_text(F.filter(F.coalesce("output", F.array().cast("array<struct<type:string,text:string>>")), lambda x: x["text"].isNotNull()))
    return s.select("record_id", evaluation.score_expansions(F.col("query"), text).alias("r")).select("record_id", "r.total", "r.percentage", "r.rating")


def score_summary(spark, d):
    """Summary of all event values."""
    s = evaluation.score_summary(_read(spark, d, "events"), "value")
    return s.select("n", *(F.round(c, 4).alias(c) for c in ("mean", "median", "least", "greatest", "good")))


def batch_rollup(spark, d):
    """Events by user and type."""
    return state.status_rollup(_read(spark, d, "events"), "event_type", ["user_id"], ["view", "error", "signup"])


def event_resequence(spark, d):
    """Sequence numbers per user and repeated ids."""
    e = _read(spark, d, "events").select("event_id", "user_id", "ts", F.to_json(F.struct("props")).alias("k"))
    return ranking.resequence(e, "user_id", ["ts", "event_id"], "k").select("event_id", "sequence", "duplicate")


def weighted_model_metrics(spark, d):
    """Sums and weighted rates by event type."""
    e = _read(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("attempts"), F.col("value"), (F.col("value") / 1000).alias("rate"))
    return state.weighted_metrics(e, "event_type", ["attempts"], "rate", "attempts").select("event_type", "attempts", F.round("rate", 6).alias("rate"))


def running_token_budget(spark, d):
    """Documents of each source, in order, until 20000 characters are used."""
    t = _read(spark, d, "documents").where("text is not null and source is not null").select("doc_id", "source", F.length("text").cast("bigint").alias("chars"))
    return ranking.running_budget(t, "source", ["doc_id"], "chars", 20000)


def latest_capability(spark, d):
    """The newest capability of each book and method."""
    c = _read(spark, d, "qmd_graph_capabilities").where("method is not null").select("book_id", "method", "capability_id", instant(F.col("created_at")).alias("at")).distinct()
    return ranking.latest_per_key(c, ["book_id", "method"], "at", "capability_id").select("book_id", "method", "capability_id")


def missing_kinds(spark, d):
    """Capability kinds that each book lacks."""
    c = _read(spark, d, "qmd_graph_capabilities").where("ready")
    return state.missing_kinds(c, "book_id", "kind", ["global_search", "graph_query", "drift_search", "local_search"]).select("book_id", F.array_join("missing", " ").alias("missing"))


def resume_next_stage(spark, d):
    """First event type of a fixed order that a user lacks, and later ones that are there."""
    e = _read(spark, d, "events").select("user_id", "event_type", F.lit("succeeded").alias("status"))
    return state.next_stage(e, "user_id", "event_type", "status", ["view", "click", "purchase", "signup", "error"]).select("user_id", F.coalesce("next_stage", F.lit("")).alias("next_stage"), F.greatest("stale", F.lit(0)).alias("stale"))


def package_closure(spark, d):
    """Bodies named by documents against stored ones, as a manifest against files."""
    one = lambda df, h, t: df.where(f"{h} is not null and {t} is not null").groupBy(canonical_key(F.col(h)).alias("path")).agg(F.min(F.struct(F.octet_length(t).alias("bytes"), F.sha2(t, 256).alias("digest"))).alias("x")).select("path", "x.*")
    return state.closure(one(_read(spark, d, "documents"), "hash", "text"), one(_read(spark, d, "content"), "hash", "doc")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def log_tail(spark, d):
    """Sequence of readable events before the first broken line, per whole log."""
    e = _read(spark, d, "events").select("event_id", F.when(F.col("event_id") == 4321, F.lit("{broken")).otherwise(F.col("props")).alias("line"))
    return readers.intact_events(e, "event_id", "line").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


def result_formats(spark, d):
    """Search results as csv and files lines."""
    docs = _read(spark, d, "documents")
    top = lexical.search(docs, "harbour telescope", limit=10, stem=False).join(docs.select("doc_id", "hash", "path", "title"), "doc_id")
    r = top.select("rank", "score", F.left("hash", F.lit(6)).alias("docid"), F.col("path").alias("file"), F.concat("title", F.lit(', "x"')).alias("title"), F.lit("").alias("context"), F.lit("a\nb").alias("snippet"))
    return sinks.format_rows(r, "csv").unionByName(sinks.format_rows(r, "files"))


def windowed_event_counts(spark, d):
    """Events per day and type."""
    from corpuskiln.streaming.reindex import windowed_counts

    e = _read(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return windowed_counts(e, "ts", "event_type", "1 day").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


QUERIES = {f.__name__: f for f in (topk_per_group, semantic_units, edges_token_overlap, communities_rollup, report_search, report_evidence, scope_semijoin_chain, capability_or_join, coverage_rate, route_decision, capability_union, artifact_lineage, lineage_gaps, generation_hash, prompt_packing, topic_token_sets, book_slugs, partition_plan, chunk_documents, best_chunk_terms, embedding_batches, html_to_text, precision_recall_mrr, unmatched_files, label_hit_rate, jaccard_match, dataset_stats, query_categories, normalized_output, expansion_parse, example_dedupe, split_sizes, micro_f1, reward_score, score_summary, batch_rollup, event_resequence, weighted_model_metrics, running_token_budget, latest_capability, missing_kinds, resume_next_stage, package_closure, log_tail, result_formats, windowed_event_counts)}

_K = "nullif(trim(regexp_replace(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13))), '^sha256:', '')), '')"
_R = "r AS (SELECT source AS member, document_id AS report_id, title, coalesce(text, '') AS summary, coalesce(n_chars, 0) / 1000.0 AS rank, doc_id AS pos FROM documents WHERE active AND source IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY member ORDER BY rank DESC, pos)::INT AS place FROM r QUALIFY place <= 8)"


def _clean(text: str, fallback: str, limit: int) -> str:
    bare = rf"trim(regexp_replace(coalesce({text}, {fallback}), '\s+', ' ', 'g'))"
    return f"left(CASE WHEN {bare} <> '' THEN {bare} ELSE {fallback} END, {limit})"


def _json(**pairs: str) -> str:
    """SQL of the 32 digits of a spaced JSON object's hash; values are SQL texts."""
    body = " || ', ' || ".join(f"'\"{k}\": ' || to_json({v})::VARCHAR" for k, v in sorted(pairs.items()))
    return "left(sha256('{' || " + body + " || '}'), 32)"


def _stop(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words))


def _topic(text: str) -> str:
    return rf"list_filter(list_distinct(regexp_extract_all(lower({text}), '[a-z][a-z0-9_-]{{3,}}')), lambda t: t NOT IN ({_stop(TOPIC_STOP_WORDS)}))"


_U = f"""WITH {_R}, t AS (SELECT member, report_id, rank, {_clean('title', "member || ' community'", 240)} AS title, summary FROM k),
u AS (SELECT member, report_id, rank, title, {_clean("nullif(summary, '')", 'title', 1800)} AS summary, 'bsu-' || {_json(bookshelfId="'shelf-1'", generation="'gen-1'", bookId='member', reportId='report_id')} AS unit_id FROM t)"""
_L = _U + f", b AS (SELECT * FROM u ORDER BY rank DESC, member, title, unit_id LIMIT 32), l AS (SELECT *, row_number() OVER (ORDER BY member, rank DESC, title, unit_id) - 1 AS position, {_topic(chr(39).join(['concat_ws(', ' ', ', title, summary)']))} AS tokens FROM b)"


def _search(query_tokens: list[str], limit: int) -> str:
    asked = ", ".join(f"'{t}'" for t in query_tokens)
    return f"WITH {_R}, s AS (SELECT *, len(list_intersect({_topic(chr(39).join(['concat_ws(', ' ', ', title, summary)']))}, [{asked}])) / {len(query_tokens)}.0 + least(greatest(rank, 0), 10) / 100 AS score FROM r), f AS (SELECT *, row_number() OVER (ORDER BY score DESC, rank DESC, pos)::INT AS place FROM s QUALIFY place <= {limit})"


_CAND = f"c AS (SELECT doc_id AS candidate_id, {_K.format(c='document_id')} AS document_id, 'src-' || left({_K.format(c='document_id')}, 10) AS source_id, {_K.format(c='hash')} AS content_hash, source FROM documents WHERE active)"
_CAPS = f"p AS (SELECT capability_id, source_id, {_K.format(c='document_id')} AS document_id, {_K.format(c='content_hash')} AS content_hash FROM qmd_graph_capabilities WHERE ready), o AS (SELECT content_hash FROM p WHERE content_hash IS NOT NULL GROUP BY 1 HAVING min(document_id) IS NOT DISTINCT FROM max(document_id)), m AS (SELECT candidate_id, capability_id FROM c JOIN p ON p.document_id = c.document_id UNION SELECT candidate_id, capability_id FROM c JOIN p ON p.source_id = c.source_id UNION SELECT candidate_id, capability_id FROM c JOIN p ON p.content_hash = c.content_hash WHERE p.content_hash IN (SELECT content_hash FROM o))"


def _judged_sql() -> str:
    lists = ", ".join(f"l{i} AS (WITH {_bm25_sql(w)} SELECT '{w}' AS query_id, row_number() OVER (ORDER BY raw DESC, doc_id)::INT AS rank, doc_id FROM (SELECT * FROM s ORDER BY raw DESC, doc_id LIMIT 10))" for i, w in enumerate(_WORDS))
    res = " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(len(_WORDS)))
    exp = " UNION ALL ".join(f"(SELECT '{w}' AS query_id, upper('/' || path) AS file FROM documents WHERE active AND contains(lower(title), '{w}'))" for w in _WORDS)
    return f"WITH {lists}, res AS (SELECT query_id, rank, path AS f FROM ({res}) JOIN documents USING (doc_id)), ex AS ({exp}), pr AS (SELECT ex.query_id, file, min(rank) AS rk FROM ex JOIN res ON res.query_id = ex.query_id AND (suffix(lower(f), lower(ltrim(file, '/'))) OR suffix(lower(ltrim(file, '/')), lower(f))) GROUP BY 1, 2)"


def _words(text: str) -> str:
    return rf"list_distinct(list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+'), lambda w: length(w) > 1 AND w NOT IN ({_stop(evaluation.PLAIN_STOP_WORDS)})))"


_QW = r"list_filter(regexp_split_to_array(trim(coalesce(query, '')), '\s+'), lambda w: w <> '')"
_ANY = lambda ws: "(" + " OR ".join(f"contains(lower(query), '{w}')" for w in ws) + ")"
_NORM = "list_filter(coalesce(output, []), lambda x: trim(coalesce(x.text, '')) <> '')"

SQL: dict[str, str] = {
    "topk_per_group": f"WITH {_R} SELECT member, report_id, place FROM k",
    "semantic_units": _U + rf" SELECT member, report_id, unit_id, 'ev-' || {_json(unitId='unit_id', reportId='report_id')} AS evidence_id, title, greatest(len(list_filter(regexp_split_to_array(title || ' ' || summary, '\s+'), lambda w: w <> '')), 1)::INT AS token_estimate, round(rank, 3) AS rank FROM u",
    "edges_token_overlap": _L + ", e AS (SELECT a.unit_id AS \"left\", b.unit_id AS \"right\", a.position AS p, b.position AS q, a.member = b.member AS same, list_sort(list_intersect(a.tokens, b.tokens))[1:8] AS shared FROM l a JOIN l b ON a.position < b.position) SELECT \"left\", \"right\", CASE WHEN same THEN 'bookshelf_membership' ELSE 'co_clustered_topic' END AS relation, round(0.5 + least(len(shared), 6) / 10.0, 2) AS weight, array_to_string(shared, ' ') AS shared FROM e WHERE same OR len(shared) >= 2 ORDER BY p, q LIMIT 96",
    "communities_rollup": _L + f", g AS (SELECT member, count(*)::BIGINT AS n_units, max(rank) AS rank, list(summary ORDER BY position) AS s FROM l GROUP BY 1), w AS (SELECT count(*)::BIGINT AS n_units, max(rank) AS rank, list(summary ORDER BY position) AS s FROM l) SELECT member, n_units, round(rank, 3) AS rank, left({_clean(chr(39).join(['array_to_string(s[1:3], ', ' ', ')']), chr(39) * 2, 2200)}, 80) AS summary FROM g UNION ALL SELECT 'overview', n_units, round(rank, 3), left({_clean(chr(39).join(['array_to_string(s[1:6], ', ' ', ')']), chr(39) * 2, 2400)}, 80) FROM w WHERE n_units > 1",
    "report_search": _search(["which", "harbour", "telescope", "glossary", "describe"], 10) + " SELECT report_id, place, round(score, 6) AS score FROM f",
    "report_evidence": "WITH c AS (SELECT DISTINCT capability_id, book_id, document_id FROM qmd_graph_capabilities), n AS (SELECT book_id, min(capability_id) AS a, max(capability_id) AS b, count(*) FILTER (starts_with(document_id, '0')) AS n FROM (SELECT DISTINCT capability_id, book_id, document_id, created_at FROM qmd_graph_capabilities) WHERE document_id IS NOT NULL GROUP BY 1), f AS (SELECT book_id, min(capability_id) AS x FROM c GROUP BY 1) SELECT book_id AS report_id, 0 AS ord, b AS evidence_id FROM n WHERE n > 0 UNION ALL SELECT book_id, 1, a FROM n WHERE n > 0 UNION ALL SELECT n.book_id, 0, x FROM n JOIN f USING (book_id) WHERE n = 0",
    "scope_semijoin_chain": f"WITH d AS (SELECT {_K.format(c='document_id')} AS id, source, {_K.format(c='hash')} AS hash FROM documents), v AS (SELECT DISTINCT {_K.format(c='hash')} AS hash, seq FROM content_vectors WHERE {_K.format(c='hash')} IS NOT NULL), k AS (SELECT * FROM d WHERE source = 'essays'), u AS (SELECT v.hash, seq, k.id FROM v JOIN k USING (hash)), h AS (SELECT DISTINCT hash, seq FROM u), e AS (SELECT DISTINCT hash FROM h), rel AS (SELECT v.hash, v.seq FROM v WHERE seq > 0 AND (EXISTS (SELECT 1 FROM h WHERE h.hash = v.hash AND h.seq = v.seq) OR EXISTS (SELECT 1 FROM h WHERE h.hash = v.hash AND h.seq = v.seq - 1))), c AS (SELECT DISTINCT left(hash, 6) AS g FROM h) SELECT 'documents' AS frame, (SELECT count(*) FROM k)::BIGINT AS n UNION ALL SELECT 'text_units', (SELECT count(*) FROM u) UNION ALL SELECT 'entities', (SELECT count(*) FROM e) UNION ALL SELECT 'relationships', (SELECT count(*) FROM rel) UNION ALL SELECT 'communities', (SELECT count(*) FROM c) UNION ALL SELECT 'community_reports', (SELECT count(*) FROM c)",
    "capability_or_join": f"WITH {_CAND}, {_CAPS} SELECT candidate_id, count(*)::BIGINT AS n, min(capability_id) AS first FROM m GROUP BY 1",
    "coverage_rate": f"WITH {_CAND}, {_CAPS}, x AS (SELECT DISTINCT candidate_id FROM m) SELECT coalesce(source, '') AS source, count(*)::BIGINT AS total, count(x.candidate_id)::BIGINT AS ready, round(count(x.candidate_id) / count(*), 6) AS coverage FROM c LEFT JOIN x USING (candidate_id) GROUP BY 1",
    "route_decision": r"WITH q AS (SELECT record_id, query, ['auto', 'graph', 'retrieval'][(record_id % 3 + 1)::INT] AS requested, CASE WHEN record_id % 5 = 0 THEN 1 ELSE 2 END AS max_cost, record_id % 7 <> 0 AS allow, record_id % 11 AS ready FROM qmd_expansion_sports WHERE query IS NOT NULL), i AS (SELECT *, CASE WHEN regexp_matches(query, '关系|关联|联系|为什么|原因|综合|总结|全书|跨章节') THEN 'graph_synthesis' WHEN regexp_matches(query, '(?i)\b(relationship|relate|why|synthesize|summari[sz]e|across)\b') THEN 'graph_synthesis' WHEN regexp_matches(query, '多跳|推理|因果') THEN 'multi_hop_reasoning' WHEN regexp_matches(query, '(?i)\b(multi-hop|reason|causal|tradeoff)\b') THEN 'multi_hop_reasoning' WHEN regexp_matches(query, '定位|原文|文件|章节') THEN 'source_location' WHEN regexp_matches(query, '(?i)\b(file|source|where|locate|chapter)\b') THEN 'source_location' ELSE 'lookup' END AS intent FROM q), r AS (SELECT *, array_to_string(list_filter([CASE WHEN ready = 0 THEN 'no_graph_ready_candidate' END, CASE WHEN ready / 10.0 < 0.7 THEN 'coverage_below_threshold' END, CASE WHEN intent NOT IN ('graph_synthesis', 'multi_hop_reasoning') THEN 'intent_not_graph_synthesis' END, CASE WHEN (CASE WHEN intent = 'multi_hop_reasoning' THEN 3 ELSE 2 END) > max_cost THEN 'cost_policy_exceeded' END, CASE WHEN NOT allow THEN 'graph_upgrade_disabled' END], lambda x: x IS NOT NULL), '|') AS reasons FROM i) SELECT record_id, intent, CASE WHEN requested <> 'auto' THEN requested WHEN reasons = '' THEN 'graph' ELSE 'retrieval' END AS route, CASE WHEN requested = 'graph' AND ready = 0 THEN 'refused' ELSE 'selected' END AS status, reasons FROM r",
    "capability_union": "WITH c AS (SELECT DISTINCT capability_id, book_id, method FROM qmd_graph_capabilities WHERE ready AND method IS NOT NULL), b AS (SELECT DISTINCT book_id FROM c), w AS (SELECT 'local' AS method FROM b UNION ALL SELECT 'global' FROM b UNION ALL SELECT method FROM c WHERE method NOT IN ('local', 'global')) SELECT method, count(*)::BIGINT AS n FROM w GROUP BY 1",
    "artifact_lineage": "WITH a AS (SELECT book_id, method, CASE WHEN starts_with(trim(artifact_ids), '[') THEN from_json(artifact_ids, '[\"VARCHAR\"]') WHEN artifact_ids IS NULL THEN [] ELSE [regexp_replace(trim(artifact_ids), '^\"|\"$', '', 'g')] END AS l FROM qmd_graph_capabilities), n AS (SELECT book_id, count(DISTINCT x)::BIGINT AS n FROM (SELECT book_id, unnest(l) AS x FROM a) WHERE trim(coalesce(x, '')) <> '' GROUP BY 1), s AS (SELECT book_id, CASE WHEN count(method) = count(*) AND min(method) = max(method) THEN max(method) ELSE '' END AS method FROM a GROUP BY 1) SELECT book_id, method, coalesce(n, 0)::BIGINT AS n_artifacts FROM s LEFT JOIN n USING (book_id)",
    "lineage_gaps": "WITH u AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {c} AS v, capability_id AS pos FROM qmd_graph_capabilities" for f, c in zip(graph.LINEAGE, "book_id source_id document_id content_hash capability_id method artifact_ids".split())) + ") SELECT field, count(*)::BIGINT AS n, min(pos) AS first_pos FROM u WHERE regexp_matches(trim(coalesce(v, '')), '^$|^unknown-') GROUP BY 1",
    "generation_hash": "SELECT sha256(string_agg(source, chr(10) ORDER BY source)) AS generation, count(*)::INT AS n FROM source_targets",
    "prompt_packing": _search(["harbour", "telescope", "glossary"], 20) + ", g AS (SELECT *, ceil(length(summary) / 4.0)::BIGINT AS tokens, sum(ceil(length(summary) / 4.0)) OVER (ORDER BY place) AS running FROM f) SELECT report_id, place, tokens FROM g WHERE running <= 4000",
    "topic_token_sets": f"SELECT doc_id, array_to_string(list_sort({_topic(chr(39) .join(['coalesce(title, ', '', ')']))}), ' ') AS tokens FROM documents",
    "partition_plan": "WITH b AS (SELECT DISTINCT book_id FROM qmd_graph_capabilities) SELECT book_id, ((row_number() OVER (ORDER BY book_id) - 1) // 100 + 1)::INT AS part FROM b",
    "best_chunk_terms": "WITH t AS (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS l FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS seq FROM t), s AS (SELECT doc_id, seq, contains(lower(x), 'harbour')::INT + contains(lower(x), 'glossary')::INT + contains(lower(x), 'telescope')::INT + 0.5 * contains(lower(x), 'kettle')::INT AS score FROM c) SELECT doc_id, seq::INT AS seq, score::DOUBLE AS score FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, seq) = 1",
    "precision_recall_mrr": _judged_sql() + ", n AS (SELECT query_id, count(*) AS n FROM ex GROUP BY 1), a AS (SELECT query_id, count(*) AS found, min(rk) AS first, count(*) FILTER (rk <= 1) AS h1, count(*) FILTER (rk <= 3) AS h3, count(*) FILTER (rk <= 5) AS h5, count(*) FILTER (rk <= 10) AS h10 FROM pr GROUP BY 1), z AS (SELECT query_id, coalesce(h10, 0) / least(n, 10) AS p, coalesce(found, 0) / n AS r, coalesce(h1, 0) / n AS r1, coalesce(h3, 0) / n AS r3, coalesce(h5, 0) / n AS r5, coalesce(1.0 / first, 0) AS m, coalesce(h10, 0)::BIGINT AS hits FROM n LEFT JOIN a USING (query_id)) SELECT query_id, hits AS hits_at_k, round(p, 6) AS precision_at_k, round(r, 6) AS recall, round(r1, 6) AS recall_at_1, round(r3, 6) AS recall_at_3, round(r5, 6) AS recall_at_5, round(m, 6) AS mrr, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM z",
    "unmatched_files": _judged_sql() + " SELECT query_id, file FROM ex WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.query_id = ex.query_id AND pr.file = ex.file)",
    "label_hit_rate": f"WITH x AS (SELECT q.vec_id AS query_id, q.label, v.vec_id, v.label AS l, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_distance('v.embedding', 'q.embedding')}, v.vec_id) - 1 AS r FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0), h AS (SELECT query_id, label, min(r) FILTER (l = label) AS r FROM x WHERE vec_id <> query_id AND r <= 5 GROUP BY 1, 2) SELECT label, count(*)::BIGINT AS n, round(avg(coalesce(r <= 1, false)::INT), 6) AS hit_at_1, round(avg(coalesce(r <= 3, false)::INT), 6) AS hit_at_3, round(avg(coalesce(r <= 5, false)::INT), 6) AS hit_at_5 FROM h GROUP BY 1",
    "jaccard_match": f"WITH s AS (SELECT record_id, {_words('query')} AS q, list_transform(list_filter(output, lambda x: x.type = 'lex' AND x.text IS NOT NULL), lambda x: {_words('x.text')}) AS l FROM qmd_expansion_locations WHERE query IS NOT NULL AND output IS NOT NULL), j AS (SELECT record_id, list_max(list_transform(l, lambda x: CASE WHEN len(x) + len(q) = 0 THEN 0 ELSE len(list_intersect(x, q)) / (len(x) + len(q) - len(list_intersect(x, q))) END)) AS v FROM s) SELECT record_id, coalesce(round(v, 6), -1) AS similarity FROM j",
    "dataset_stats": f"WITH e AS (SELECT *, len({_QW}) AS n, {_QW} AS w, coalesce(output, []) AS o FROM qmd_expansion_personal_entities) SELECT count(*)::BIGINT AS total, count(*) FILTER (n <= 2)::BIGINT AS short_queries, count(*) FILTER (n BETWEEN 3 AND 5)::BIGINT AS medium_queries, count(*) FILTER (n > 5)::BIGINT AS long_queries, " + ", ".join(f"count(*) FILTER (list_contains(list_transform(o, lambda x: x.type), '{t}'))::BIGINT AS has_{t}" for t in evaluation.TYPES) + rf", sum(len(list_filter(o, lambda x: x.type = 'hyde' AND length(x.text) > 200)))::BIGINT AS long_hyde, (count(*) - count(DISTINCT lower(coalesce(query, ''))))::BIGINT AS duplicate_queries, count(*) FILTER (len(list_filter(w, lambda x: length(x) > 1 AND lower(x) NOT IN ({_stop(evaluation.ENTITY_STOP_WORDS)}) AND regexp_matches(x, '^\p{{Lu}}|[.+\-0-9]'))) > 0)::BIGINT AS named_entities FROM e",
    "query_categories": rf"WITH c AS (SELECT CASE WHEN len({_QW}) <= 2 THEN 'short_keyword' WHEN len(list_filter({_QW}, lambda w: regexp_matches(w, '^\p{{Lu}}'))) > 0 THEN 'named_entity' WHEN {_ANY(evaluation.TEMPORAL)} THEN 'temporal' WHEN starts_with(lower(query), 'how ') THEN 'how_to' WHEN starts_with(lower(query), 'what ') THEN 'what_is' WHEN {_ANY(evaluation.COMPARISON)} THEN 'comparison' WHEN {_ANY(evaluation.PERSONAL)} THEN 'personal' ELSE 'other' END AS category FROM qmd_expansion_sports WHERE query IS NOT NULL) SELECT category, count(*)::BIGINT AS n FROM c GROUP BY 1",
    "normalized_output": "SELECT record_id, array_to_string(" + " || ".join(f"list_transform(list_filter({_NORM}, lambda x: x.type {t}), lambda x: x.type || ': ' || trim(x.text))" for t in ("= 'hyde'", "= 'lex'", "NOT IN ('hyde', 'lex')")) + ", chr(10)) AS text FROM qmd_expansion_locations",
    "expansion_parse": r"WITH t AS (SELECT array_to_string(list_transform(list_filter(output, lambda x: x.text IS NOT NULL), lambda x: x.type || ': ' || x.text), chr(10)) AS t FROM qmd_expansion_locations WHERE output IS NOT NULL), l AS (SELECT unnest(string_split(t, chr(10))) AS x FROM t) SELECT regexp_extract(trim(x), '^(lex|vec|hyde):', 1) AS type, count(*)::BIGINT AS n FROM l WHERE regexp_matches(trim(x), '^(lex|vec|hyde):') GROUP BY 1",
    "example_dedupe": "SELECT min(record_id) AS record_id FROM qmd_expansion_personal_entities WHERE query IS NOT NULL GROUP BY lower(trim(query))",
    "embedding_batches": "WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS source, strlen(text) AS bytes, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL), r AS (SELECT doc_id, source, rn, 0 AS batch, 1 AS items, bytes AS room FROM t WHERE rn = 1 UNION ALL SELECT t.doc_id, t.source, t.rn, CASE WHEN items >= 64 OR room + bytes > 200000 THEN batch + 1 ELSE batch END, CASE WHEN items >= 64 OR room + bytes > 200000 THEN 1 ELSE items + 1 END, CASE WHEN items >= 64 OR room + bytes > 200000 THEN bytes ELSE room + bytes END FROM r JOIN t ON t.source = r.source AND t.rn = r.rn + 1) SELECT doc_id, source, batch::INT AS batch FROM r",
    "split_sizes": "SELECT CASE WHEN ('0x' || left(md5('42:' || record_id), 8))::BIGINT % 10000 < 1000 THEN 'eval' ELSE 'train' END AS split, count(*)::BIGINT AS n FROM qmd_expansion_sports GROUP BY 1",
    "book_slugs": r"SELECT doc_id, CASE WHEN title IS NOT NULL THEN coalesce(nullif(trim(regexp_replace(regexp_replace(lower(strip_accents(regexp_replace(translate(title, '：，？！…', ':,?!.'), '\p{Z}', ' ', 'g'))), '[^\x00-\x7f]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'book') END AS slug FROM documents",
    "micro_f1": "WITH s AS (SELECT record_id, unnest(output) AS x FROM qmd_expansion_locations), t AS (SELECT DISTINCT record_id, x.type AS type, lower(trim(x.text)) AS text FROM s WHERE x.text IS NOT NULL), g AS (SELECT coalesce(p.type, t.type) AS type, count(p.text) AS p, count(t.text) AS t, count(CASE WHEN p.text IS NOT NULL AND t.text IS NOT NULL THEN 1 END) AS hit FROM (SELECT record_id + 1 AS record_id, type, text FROM t) p FULL JOIN t ON t.record_id = p.record_id AND t.type = p.type AND t.text = p.text GROUP BY 1), w AS (SELECT * FROM g UNION ALL SELECT 'all', sum(p), sum(t), sum(hit) FROM g) SELECT type, p::BIGINT AS p, t::BIGINT AS t, hit::BIGINT AS hit, round(hit / p, 6) AS precision, round(hit / t, 6) AS recall, round(2 * hit / (p + t), 6) AS f1 FROM w",
    "score_summary": "SELECT count(value)::BIGINT AS n, round(avg(value), 4) AS mean, round(median(value), 4) AS median, round(min(value), 4) AS least, round(max(value), 4) AS greatest, round(avg((value >= 70)::INT), 4) AS good FROM events",
    "batch_rollup": "SELECT user_id, count(*)::BIGINT AS total, count(*) FILTER (event_type = 'view')::BIGINT AS view, count(*) FILTER (event_type = 'error')::BIGINT AS error, count(*) FILTER (event_type = 'signup')::BIGINT AS signup FROM events GROUP BY 1",
    "event_resequence": "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS sequence, row_number() OVER (PARTITION BY props ORDER BY ts, event_id) > 1 AS duplicate FROM events",
    "weighted_model_metrics": "WITH e AS (SELECT event_type, (props->>'k')::BIGINT AS k, value / 1000 AS r FROM events) SELECT event_type, sum(k)::BIGINT AS attempts, round(sum(r * k) / sum(k), 6) AS rate FROM e GROUP BY 1",
    "running_token_budget": "WITH t AS (SELECT doc_id, source, length(text)::BIGINT AS chars, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS running FROM documents WHERE text IS NOT NULL AND source IS NOT NULL) SELECT * FROM t WHERE running <= 20000",
    "latest_capability": "SELECT book_id, method, capability_id FROM (SELECT DISTINCT book_id, method, capability_id, created_at::TIMESTAMPTZ AS t FROM qmd_graph_capabilities WHERE method IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY book_id, method ORDER BY t DESC, capability_id) = 1",
    "missing_kinds": "WITH k AS (SELECT book_id, list(DISTINCT kind) AS ks FROM qmd_graph_capabilities WHERE ready GROUP BY 1) SELECT book_id, array_to_string(list_sort(list_filter(['global_search', 'graph_query', 'drift_search', 'local_search'], lambda x: NOT list_contains(ks, x))), ' ') AS missing FROM k",
    "resume_next_stage": "WITH o AS (SELECT ['view', 'click', 'purchase', 'signup', 'error'] AS s), u AS (SELECT user_id, list(DISTINCT event_type) AS h FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup', 'error') GROUP BY 1), m AS (SELECT user_id, h, s, list_filter(range(1, 6), lambda i: NOT list_contains(h, s[i]))[1] AS i FROM u, o) SELECT user_id, coalesce(s[i], '') AS next_stage, coalesce(len(list_filter(range(1, 6), lambda j: j > i AND list_contains(h, s[j]))), 0)::INT AS stale FROM m",
    "package_closure": f"WITH m AS (SELECT {_K.format(c='hash')} AS path, min((strlen(text), sha256(text))) AS d FROM documents WHERE hash IS NOT NULL AND text IS NOT NULL GROUP BY 1), f AS (SELECT {_K.format(c='hash')} AS path, min((strlen(doc), sha256(doc))) AS d FROM content GROUP BY 1), j AS (SELECT CASE WHEN f.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'undeclared' WHEN m.d[1] <> f.d[1] THEN 'bytes' WHEN m.d[2] <> f.d[2] THEN 'digest' END AS problem FROM m FULL JOIN f ON f.path = m.path) SELECT problem, count(*)::BIGINT AS n FROM j WHERE problem IS NOT NULL GROUP BY 1",
    "log_tail": "SELECT count(*)::BIGINT AS n, max(event_id) AS last FROM events WHERE event_id < 4321",
    "result_formats": f"WITH {_bm25_sql('harbour telescope')}, x AS (SELECT doc_id, score, row_number() OVER (ORDER BY raw DESC, doc_id)::INT AS rank FROM (SELECT * FROM s ORDER BY raw DESC, doc_id LIMIT 10)), y AS (SELECT rank, score, left(hash, 6) AS docid, path, title FROM x JOIN documents USING (doc_id)) SELECT rank, '#' || docid || ',' || printf('%.4f', floor(score * 10000 + 0.5) / 10000) || ',' || path || ',\"' || replace(title || ', \"x\"', '\"', '\"\"') || '\",,\"a' || chr(10) || 'b\"' AS line FROM y UNION ALL SELECT rank, '#' || docid || ',' || printf('%.2f', floor(score * 100 + 0.5) / 100) || ',' || path FROM y",
    "windowed_event_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2",
}


def snippet_in_chunk(spark, d):
    """Snippets within each body's second stored piece, with an intent."""
    from corpuskiln.operators.snippets import snippets

    c = _read(spark, d, "content").groupBy(canonical_key(F.col("hash")).alias("hash")).agg(F.max("doc").alias("doc"))
    v = _read(spark, d, "content_vectors").where("seq = 1").groupBy(canonical_key(F.col("hash")).alias("hash")).agg(F.min("pos").alias("pos"))
    s = snippets(F.col("doc"), F.lit("harbour glossary"), F.col("pos"), F.lit(None).cast("int"), F.lit("notes about the telescope"))
    return c.join(v, "hash").select("hash", s.alias("s")).select("hash", "s.line", "s.snippet")


QUERIES["snippet_in_chunk"] = snippet_in_chunk
