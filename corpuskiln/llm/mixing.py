"""Mixing sources to target shares of the tokens, with capped repetition, when texts belong to several sources.

Method. Rows with one text are one document whose *membership pattern* is the set of its sources; where sources hold a text
several times, their second rows are a second document, and so on, which ranks as a repetition of the first. Tokens are summed by pattern
(few rows, whatever the corpus holds), and a min-cost flow routes each pattern's tokens to its sources: the quotas are the
target shares of the largest total that the caps allow, and the k-th repetition of a pattern costs k, so fresh text is used
before any is repeated. A pattern's flow is laid out on the line of its documents' tokens, wrapping around: each source takes a
consecutive stretch, so a document is used by a source at most ``ceil(flow / tokens)`` times, which the caps bound. Documents
lie on the line in a seeded random order; their offsets are prefix sums over hash buckets, without any global sort.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.operators.ranking import running_total
from corpuskiln.session import stage_table

#: Documents of a hash bucket (expected): bounds the window that one task sorts.
BUCKET_ROWS = 100_000
#: From this copy of a text in a source on, further ones count as that many.
LEVELS = 4


def min_cost_flow(nodes: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each (from, to, capacity, cost) arc of a cheapest maximum flow, by successive shortest paths."""
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to, room, price = [], [], []
    for a, b, capacity, cost in arcs:
        graph[a].append(len(to)); to.append(b); room.append(capacity); price.append(cost)  # noqa: E702
        graph[b].append(len(to)); to.append(a); room.append(0); price.append(-cost)  # noqa: E702
    while True:
        far, by, queue = [None] * nodes, [-1] * nodes, deque([source])
        far[source], queued = 0, [False] * nodes
        while queue:
            u = queue.popleft()
            queued[u] = False
            for e in graph[u]:
                v = to[e]
                if room[e] > 0 and (far[v] is None or far[u] + price[e] < far[v]):
                    far[v], by[v] = far[u] + price[e], e
                    if not queued[v]:
                        queued[v] = True
                        queue.append(v)
        if far[sink] is None:
            return [room[2 * i + 1] for i in range(len(arcs))]
        push, v = None, sink
        while v != source:
            push = room[by[v]] if push is None else min(push, room[by[v]])
            v = to[by[v] ^ 1]
        v = sink
        while v != source:
            room[by[v]] -= push
            room[by[v] ^ 1] += push
            v = to[by[v] ^ 1]


def _by_name(pattern: tuple) -> tuple[str, ...]:
    return tuple(map(str, pattern))


def route(patterns: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]], total: int | None = None) -> tuple[dict[tuple[tuple[str, ...], str], int], int]:
    """(tokens of each (pattern, source), total): the largest total at which every source gets its share, or ``total`` if less.

    A target source without any text can get nothing; the others then share the total in proportion. Non-positive shares and
    caps count as no target. A pattern may end in a number n: its documents are the n-th copies of their texts.
    """
    capacity = {s: cap * sum(w for p, w in patterns.items() if s in p) for s, (share, cap) in targets.items() if share > 0 and cap > 0}
    used = {s: targets[s][0] for s, c in capacity.items() if c > 0}
    if not used:
        return {}, 0
    scale = sum(used.values())
    most = min(int(capacity[s] * scale / share) for s, share in used.items())
    total = most if total is None else min(total, most)
    names, keys = sorted(used), sorted(patterns, key=_by_name)
    start, end = 0, 1 + len(keys) + len(names)
    arcs = []
    for i, p in enumerate(keys):
        reach = sum(targets[s][1] for s in p if s in used)
        copy = p[-1] - 1 if isinstance(p[-1], int) else 0
        arcs += [(start, 1 + i, patterns[p], k + copy) for k in range(reach)]
    first = len(arcs)
    links = [(i, s) for i, p in enumerate(keys) for s in p if s in used]
    arcs += [(1 + i, 1 + len(keys) + names.index(s), patterns[keys[i]] * targets[s][1], 0) for i, s in links]
    arcs += [(1 + len(keys) + j, end, int(total * used[s] / scale), 0) for j, s in enumerate(names)]
    flow = min_cost_flow(end + 1, arcs, start, end)
    return {(keys[i], s): flow[first + n] for n, (i, s) in enumerate(links) if flow[first + n] > 0}, total


def _pattern(text: str) -> tuple:
    sources, _, copy = text.partition("\x1e")
    return (*sources.split("\x1f"), *([int(copy)] if copy else []))


def mix_sources(sized: DataFrame, targets: DataFrame, key: str, source: str, size: str, cluster: str, *, total: int | None = None, seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(chosen, report). ``chosen`` is (key, source, n_tokens, uses); ``report`` a row per target source with the share reached.

    ``targets`` (source, target_share, max_repeats) is small by nature. Rows equal in ``cluster`` and
    tokens are one document, the n-th such rows of the sources (by key) a document each, so every row of a source may be used
    as often as its cap allows and no row more. Rows
    without tokens or source take no part; a row without cluster is a document of its own. A source's tokens miss its quota by at
    most one document, as long as the caps allow: a document counts to the stretch that holds its middle, and what a source's
    other patterns miss by is added to the stretch of its largest one. Same seed, same choice. The driver holds a number per
    pattern, that is at most ``LEVELS * 2**sources``: meant for tens of sources.
    """
    spark = sized.sparkSession
    wanted = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.select("source", "target_share", "max_repeats").collect() if r["source"] is not None}
    rows = sized.where((F.col(size) > 0) & F.col(source).isin(list(wanted))).select(F.col(key).alias("k"), F.col(source).alias("s"), F.col(size).cast("bigint").alias("n"), F.coalesce(F.col(cluster).cast("string"), F.concat(F.lit("row "), F.col(key).cast("string"))).alias("c"))
    rows = rows.withColumn("c", F.concat_ws("\x1f", "n", "c")).withColumn("g", F.concat_ws("\x1f", "s", "c"))
    rows = running_total(stage_table(rows, "mix_rows"), "g", ["k"], F.lit(1), "copy")  # a hot text is numbered by many tasks
    documents = rows.groupBy("c", "copy").agg(F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("s", "k"))).alias("members"))  # equal n; at most one member per target source
    level = F.least("copy", F.lit(LEVELS))
    documents = stage_table(documents.withColumn("pattern", F.concat(F.array_join(F.transform("members", lambda m: m["s"]), "\x1f"), F.when(level > 1, F.concat(F.lit("\x1e"), level)).otherwise(""))), "mix")
    summed = documents.groupBy("pattern").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("d")).collect()  # at most LEVELS * 2**sources rows
    patterns = {_pattern(r["pattern"]): r["w"] for r in summed}
    names = {_pattern(r["pattern"]): r["pattern"] for r in summed}
    flows, reached = route(patterns, wanted, total)

    spans, at = [], {}
    for (p, s), tokens in sorted(flows.items(), key=lambda f: (_by_name(f[0][0]), f[0][1])):
        begin = at.get(p, 0)
        at[p] = begin + tokens
        spans.append((names[p], s, begin, tokens, patterns[p]))
    buckets = max(1, -(-max([r["d"] for r in summed], default=1) // bucket_rows))
    laid = documents.withColumn("h", F.xxhash64("c", "copy", F.lit(seed))).withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    before = laid.groupBy("pattern", "bucket").agg(F.sum("n").alias("b")).withColumn("before", F.sum("b").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.sum("n").over(Window.partitionBy("pattern", "bucket").orderBy("h", "c", "copy").rowsBetween(Window.unboundedPreceding, -1))
    placed = laid.withColumn("inside", F.coalesce(inside, F.lit(0))).join(before.select("pattern", "bucket", F.coalesce("before", F.lit(0)).alias("before")), ["pattern", "bucket"])
    placed = stage_table(placed.select("pattern", "n", (F.col("before") + F.col("inside") + F.col("n") / 2).alias("middle"), F.explode("members").alias("m")), "placed")

    def taken(spans: list[tuple]) -> DataFrame:
        plan = spark.createDataFrame(spans, "pattern string, s string, begin bigint, tokens bigint, w bigint")
        return placed.join(F.broadcast(plan), (placed["pattern"] == plan["pattern"]) & (placed["m.s"] == plan["s"])).select(  # the plan has at most LEVELS * sources * 2**sources rows
            plan["pattern"], F.col("m.k").alias("k"), plan["s"].alias("s"), "n",
            (F.ceil((F.col("begin") + F.col("tokens") - F.col("middle")) / F.col("w")) - F.greatest(F.ceil((F.col("begin") - F.col("middle")) / F.col("w")), F.lit(0))).cast("int").alias("uses"),
        ).where("uses > 0")

    got = {(r["pattern"], r["s"]): r["t"] for r in taken(spans).groupBy("pattern", "s").agg(F.sum(F.col("n") * F.col("uses")).alias("t")).collect()}  # a row per span
    for s in {x[1] for x in spans}:
        mine = [i for i, x in enumerate(spans) if x[1] == s]
        main = max(mine, key=lambda i: spans[i][3])
        missed = sum(spans[i][3] - got.get(spans[i][:2], 0) for i in mine if i != main)
        name, _, begin, tokens, w = spans[main]
        spans[main] = (name, s, begin, min(max(0, tokens + missed), wanted[s][1] * w), w)
    used = taken(spans)
    chosen = stage_table(used.select(F.col("k").alias(key), F.col("s").alias("source"), F.col("n").alias("n_tokens"), "uses"), "chosen")
    sums = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.count(F.lit(1)).alias("rows"), F.max("uses").alias("most_uses"))
    whole = chosen.agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("all")).first()["all"] or 0
    report = targets.select("source", "target_share", "max_repeats").join(F.broadcast(sums), "source", "left").select(
        "source", "target_share", "max_repeats", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("tokens", "rows", "most_uses")), F.round(F.coalesce("tokens", F.lit(0)) / F.lit(max(whole, 1)), 6).alias("share"), F.lit(reached).cast("bigint").alias("planned_total"))
    return chosen, report
