"""Reciprocal rank fusion of ranked lists, its trace, rerank blending and the hybrid and structured pipelines."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.operators.ranking import with_rank
from corpuskiln.session import stage_table

# The fusion constant, the bonuses for a best rank of 1 and of 3 or better, candidates that are reranked.
RRF_K, FIRST_BONUS, TOP_BONUS, CANDIDATES = 60, 0.05, 0.02, 40
# A lexical result this good and this far ahead needs no expansion.
STRONG_SCORE, STRONG_LEAD = 0.85, 0.15


def stack_lists(lists: list[DataFrame], file: str, weights: list[float], sources: list[str] | None = None) -> DataFrame:
    """Ranked lists (each with ``file``, ``rank``, ``score``) as one frame (list_idx, source, file, rank, score, weight)."""
    parts = [df.select(F.lit(i).alias("list_idx"), F.lit(sources[i] if sources else "").alias("source"), F.col(file).alias("file"), F.col("rank").cast("int").alias("rank"), F.col("score").cast("double").alias("score"), F.lit(float(w)).alias("weight")) for i, (df, w) in enumerate(zip(lists, weights))]
    return reduce(DataFrame.unionByName, parts)


def hybrid_weight(query_type: Column) -> Column:
    """Lists of the original query count double."""
    return F.when(query_type == "original", 2.0).otherwise(1.0)


def first_list_weight(list_idx: Column) -> Column:
    """The first non-empty list counts double."""
    return F.when(list_idx == 0, 2.0).otherwise(1.0)


def fuse(stacked: DataFrame, k: int = RRF_K) -> DataFrame:
    """(file, rrf, best_rank, first_list, first_score): sum of weight / (k + rank) plus the bonus of the best rank.

    The payload (score) is that of the first list which holds the file; a file twice in one list counts twice. One shuffle, on
    the file, with partial sums. Order by rrf descending, then (first_list, first_rank).
    """
    fused = stacked.groupBy("file").agg(
        F.sum(F.col("weight") / (k + F.col("rank"))).alias("sum"), F.min("rank").alias("best_rank"),
        F.min_by("score", F.struct("list_idx", "rank")).alias("first_score"), F.min(F.struct("list_idx", "rank")).alias("first"),
    )
    bonus = F.when(F.col("best_rank") == 1, FIRST_BONUS).when(F.col("best_rank") <= 3, TOP_BONUS).otherwise(0.0)
    return fused.select("file", (F.col("sum") + bonus).alias("rrf"), bonus.alias("bonus"), "best_rank", F.col("first.list_idx").alias("first_list"), F.col("first.rank").alias("first_rank"), "first_score")


def fused_order() -> list[Column]:
    return [F.col("rrf").desc(), F.col("first_list"), F.col("first_rank"), F.col("file")]


def trace(stacked: DataFrame, k: int = RRF_K) -> DataFrame:
    """(file, contributions): what each list adds, in list order."""
    each = F.struct("list_idx", "rank", "source", "score", "weight", (F.col("weight") / (k + F.col("rank"))).alias("contribution"))
    return stacked.groupBy("file").agg(F.sort_array(F.collect_list(each)).alias("contributions"))


def blend_weight(rank: Column) -> Column:
    """How much the fused rank counts against the reranker."""
    return F.when(rank <= 3, 0.75).when(rank <= 10, 0.60).otherwise(0.40)


def blend(ranked: DataFrame, rank: str, rerank_score: str) -> DataFrame:
    """``blended`` = w / rank + (1 - w) * rerank score; a missing rerank score is 0."""
    w = blend_weight(F.col(rank))
    return ranked.withColumn("blended", w / F.col(rank) + (1 - w) * F.coalesce(F.col(rerank_score), F.lit(0.0)))


def is_strong(results: DataFrame, intent: str | None = None) -> bool:
    """Whether the best two rows of a lexical result make expansion needless."""
    top = [r["score"] for r in results.orderBy(F.col("score").desc()).limit(2).select("score").collect()]
    return not intent and bool(top) and top[0] >= STRONG_SCORE and top[0] - (top[1] if len(top) > 1 else 0.0) >= STRONG_LEAD


def lexical_rerank(candidates: DataFrame, text: str, query: str, out: str = "rerank_score") -> DataFrame:
    """Deterministic default reranker: the share of query terms that the text contains."""
    terms = [t for t in dict.fromkeys(query.lower().split()) if t]
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    hit = reduce(lambda a, b: a + b, (F.when(F.contains(low, F.lit(t)), 1.0).otherwise(0.0) for t in terms), F.lit(0.0))
    return candidates.withColumn(out, hit / max(1, len(terms)))


#: Characters of a text that a scorer sees: rerankers have a bounded context (about 2048 tokens of four characters, less the query).
SCORED_CHARS = 6000


class RerankCache:
    """Scores by query, text and model, kept between reranks as a table (key, score) that ``stage_table`` writes anew."""

    def __init__(self, model: str = "default"):
        self.model, self.rows = model, None

    def key(self, query: str, text: Column) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(self.model), F.lit(query), text), 256)


def rerank(candidates: DataFrame, text: str, query: str, scorer=None, out: str = "rerank_score", cache: RerankCache | None = None, most_chars: int = SCORED_CHARS) -> DataFrame:
    """Scores of the candidates' texts; a missing text or score is 0.

    ``scorer(query, texts)`` runs in Arrow batches on texts cut to ``most_chars``; equal cut texts are scored once, and texts
    whose score a ``cache`` holds are not scored again. Without a scorer the deterministic default sees whole texts.
    """
    if scorer is None:
        return lexical_rerank(candidates, text, query, out)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([float(x) for x in scorer(query, list(texts))])

    cut, key = F.left(F.col(text), F.lit(most_chars)), (cache or RerankCache()).key(query, F.col("__cut"))
    asked = candidates.select(cut.alias("__cut")).where("__cut is not null").distinct().withColumn("__key", key)
    known = cache.rows if cache else None
    new = asked if known is None else asked.join(known.select("__key"), "__key", "left_anti")
    new = stage_table(new.select("__key", run("__cut").alias(out)), "scores")
    scored = new if known is None else known.unionByName(new)
    if cache is not None:
        cache.rows = scored
    keyed = candidates.withColumn("__cut", cut).withColumn("__key", key)
    return keyed.join(scored, "__key", "left").withColumn(out, F.coalesce(out, F.lit(0.0))).drop("__cut", "__key")


@dataclass(frozen=True)
class Search:
    """One typed search: ``lex`` runs BM25, ``vec`` and ``hyde`` run nearest neighbours."""

    type: str
    query: str


def hybrid(lexical, semantic, query: str, expansions: list[Search], texts: DataFrame | None = None, *, limit: int = 10, candidates: int = CANDIDATES, min_score: float = 0.0, intent: str | None = None, skip_rerank: bool = False, scorer=None, cache: RerankCache | None = None, whole_texts: bool = False, file: str = "doc_id") -> DataFrame:
    """(file, rank, score, rrf, rrf_rank, chunk, rerank_score): the whole pipeline over two search functions.

    ``lexical(text)`` and ``semantic(text)`` return ranked frames (file, rank, score). The original query runs in both; unless
    the lexical result is strong each expansion runs in its backend. Lists are fused, the best ``candidates`` reranked on
    the chunk of their ``texts`` (file, text) that suits query and intent best (``whole_texts``: on the texts), and blended by
    position; with ``skip_rerank`` the score is 1 / rank.
    """
    probe = lexical(query)
    lists, weights, names = [probe, semantic(query)], [2.0, 2.0], ["fts", "vec"]
    if not is_strong(probe, intent):
        for s in expansions:
            lists.append(lexical(s.query) if s.type == "lex" else semantic(s.query))
            weights.append(1.0)
            names.append("fts" if s.type == "lex" else "vec")
    return _finish(stack_lists(lists, file, weights, names), texts, query, limit, candidates, min_score, skip_rerank, scorer, cache, whole_texts, intent, file)


def structured(lexical, semantic, searches: list[Search], texts: DataFrame | None = None, **options) -> DataFrame:
    """Like ``hybrid`` for typed searches as given; each is a list of its own and the first non-empty one counts double."""
    return structured_over({"": lexical}, {"": semantic}, searches, texts, **options)


def structured_over(lexical: dict, semantic: dict, searches: list[Search], texts: DataFrame | None = None, *, limit: int = 10, candidates: int = CANDIDATES, min_score: float = 0.0, intent: str | None = None, skip_rerank: bool = False, scorer=None, cache: RerankCache | None = None, whole_texts: bool = False, file: str = "doc_id") -> DataFrame:
    """``structured`` over collections: ``lexical`` and ``semantic`` map a collection to its search function, and each search
    gives a list per collection, in their order."""
    lists = [(find(s.query), s) for s in searches for find in (lexical if s.type == "lex" else semantic).values()]
    kept = [(df, s) for df, s in lists if not df.isEmpty()]
    weights = [2.0 if i == 0 else 1.0 for i in range(len(kept))]
    stacked = stack_lists([df for df, _ in kept or lists[:1]], file, weights or [2.0], ["fts" if s.type == "lex" else "vec" for _, s in kept] or [""])
    query = next((s.query for s in searches if s.type in ("lex", "vec")), searches[0].query if searches else "")
    return _finish(stacked, texts, query, limit, candidates, min_score, skip_rerank, scorer, cache, whole_texts, intent, file)


def _finish(stacked, texts, query, limit, candidates, min_score, skip_rerank, scorer, cache, whole_texts, intent, file):
    from corpuskiln.functions.text import plain_intent_terms
    from corpuskiln.operators import chunking

    ranked = with_rank(fuse(stacked).orderBy(*fused_order()).limit(candidates), fused_order(), "rrf_rank")
    if skip_rerank or texts is None:
        scored = ranked.withColumn("rerank_score", F.lit(None).cast("double")).withColumn("chunk", F.lit(None).cast("int")).withColumn("blended", 1 / F.col("rrf_rank"))
    else:
        # at most ``candidates`` rows: a bounded broadcast that keeps the texts where they are
        with_text = texts.select(F.col(file).alias("file"), "text").join(F.broadcast(ranked), "file").withColumn("chunk", F.lit(None).cast("int"))
        if not whole_texts:
            with_text = stage_table(with_text.drop("chunk"), "candidates")
            pieces = stage_table(chunking.chunk_documents(with_text.select("file", "text"), "file", "text"), "pieces")
            best = chunking.best_chunk(pieces, "file", query, plain_intent_terms(intent or ""))
            chosen = pieces.join(best.select("file", "seq"), ["file", "seq"]).select("file", F.col("seq").alias("chunk"), "text")
            with_text = with_text.drop("text").join(chosen, "file", "left")
        scored = blend(rerank(with_text, "text", query, scorer, cache=cache).drop("text"), "rrf_rank", "rerank_score")
    order = [F.col("blended").desc(), F.col("rrf_rank")]
    final = with_rank(scored.where(F.col("blended") >= min_score).orderBy(*order).limit(limit), order)
    return final.select(F.col("file").alias(file), "rank", F.col("blended").alias("score"), "rrf", "rrf_rank", "chunk", "rerank_score")


def explain(ranked: DataFrame, stacked: DataFrame) -> DataFrame:
    """Results with the scores per backend and the trace of their fusion."""
    per = stacked.groupBy("file").agg(F.sort_array(F.collect_list(F.when(F.col("source") == "fts", F.col("score"))), False).alias("fts_scores"), F.sort_array(F.collect_list(F.when(F.col("source") == "vec", F.col("score"))), False).alias("vec_scores"))
    return ranked.join(per, "file", "left").join(trace(stacked), "file", "left")
