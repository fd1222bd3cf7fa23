"""Running labelled queries over several search backends."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.operators.evaluation import average, score_results


def run(spark: SparkSession, queries: list[tuple[str, str, list[str], int]], backends: dict[str, Callable[[str, int], DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(per query, per backend) metrics of labelled queries (id, text, expected files, k).

    A backend maps (text, limit) to ranked rows (file, rank); at least ten are asked for. One that fails on a query scores zero
    there. Latency is the time until the result is fetched. The query list is a user's benchmark, so the driver loops over it.
    """
    rows, asked, times = [], [], []
    for name, search in backends.items():
        for qid, text, expected, k in queries:
            began = time.time()
            try:
                got = [(r["file"], r["rank"]) for r in search(text, max(k, 10)).select("file", "rank").collect()]
            except Exception:  # noqa: BLE001 - a failing backend is a result
                got = []
            times.append((f"{name}\x1f{qid}", (time.time() - began) * 1000))
            rows += [(f"{name}\x1f{qid}", int(rank), file) for file, rank in got]
            asked += [(f"{name}\x1f{qid}", file) for file in expected]
    results = spark.createDataFrame(rows, "query_id string, rank int, file string")
    expected = spark.createDataFrame(asked, "query_id string, file string")
    ks = {k for *_, k in queries} or {10}
    whole = None
    for k in sorted(ks):
        ids = [f"{name}\x1f{q}" for name in backends for q, _, _, own in queries if own == k]
        part = score_results(results, expected.where(F.col("query_id").isin(ids)), k)
        part = part.select("query_id", "precision_at_k", "recall", "recall_at_1", "recall_at_3", "recall_at_5", "mrr", "f1", "hits_at_k")
        whole = part if whole is None else whole.unionByName(part)
    latency = spark.createDataFrame(times, "query_id string, latency_ms double")
    each = whole.join(latency, "query_id").withColumn("backend", F.substring_index("query_id", "\x1f", 1)).withColumn("query_id", F.substring_index("query_id", "\x1f", -1))
    return each, average(each.drop("query_id"), "backend")
