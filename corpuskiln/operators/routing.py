"""Choosing between retrieval and graph answering for a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signs of what a query wants, first match wins, and the default coverage threshold.
INTENTS = [
    ("graph_synthesis", r"关系|关联|联系|为什么|原因|综合|总结|全书|跨章节"),
    ("graph_synthesis", r"(?i)\b(relationship|relate|why|synthesize|summari[sz]e|across)\b"),
    ("multi_hop_reasoning", r"多跳|推理|因果"),
    ("multi_hop_reasoning", r"(?i)\b(multi-hop|reason|causal|tradeoff)\b"),
    ("source_location", r"定位|原文|文件|章节"),
    ("source_location", r"(?i)\b(file|source|where|locate|chapter)\b"),
]
COVERAGE = 0.7
COSTS = {"low": 1, "medium": 2, "high": 3}


def query_intent(query: Column) -> Column:
    return F.coalesce(*(F.when(query.rlike(p), F.lit(k)) for k, p in INTENTS), F.lit("lookup"))


def decide(requests: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """Route of each request (query, requested, max_cost, allow_upgrade, total, ready).

    Adds intent, cost, coverage, refusal reasons in their fixed order (joined by ``|``), route and status. A graph request
    without any ready candidate is refused; an automatic one goes to the graph only if nothing speaks against it.
    """
    costs = F.create_map(*(F.lit(x) for kv in COSTS.items() for x in kv))
    intent = query_intent(F.col("query"))
    cost = F.when(intent == "multi_hop_reasoning", "high").otherwise("medium")
    r = requests.withColumns({"intent": intent, "cost": cost, "coverage": F.when(F.col("total") > 0, F.col("ready") / F.col("total")).otherwise(0.0)})
    reasons = F.array_compact(F.array(
        F.when(F.col("ready") == 0, "no_graph_ready_candidate"), F.when(F.col("coverage") < threshold, "coverage_below_threshold"),
        F.when(~F.col("intent").isin("graph_synthesis", "multi_hop_reasoning"), "intent_not_graph_synthesis"),
        F.when(costs[F.col("cost")] > costs[F.coalesce("max_cost", F.lit("medium"))], "cost_policy_exceeded"), F.when(F.col("allow_upgrade") == F.lit(False), "graph_upgrade_disabled"),
    ))
    r = r.withColumn("reasons", F.array_join(reasons, "|"))
    route = F.when(F.col("requested").isin("graph", "retrieval"), F.col("requested")).when(F.col("reasons") == "", "graph").otherwise("retrieval")
    return r.withColumn("route", route).withColumn("status", F.when((F.col("requested") == "graph") & (F.col("ready") == 0), "refused").otherwise("selected"))


def in_scope(book: Column, document: Column, source: Column, books: list[str], documents: list[str], sources: list[str]) -> Column:
    """Whether a row belongs to a scope of books, documents and sources; an empty scope holds everything."""
    if not (books or documents or sources):
        return F.lit(True)
    return F.coalesce(book.isin(books), F.lit(False)) | F.coalesce(document.isin(documents), F.lit(False)) | F.coalesce(source.isin(sources), F.lit(False))
