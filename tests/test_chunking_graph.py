import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskiln.operators import chunking, evaluation, graph, ranking, routing, state, store


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab# \n`-*1.😀", max_size=400), st.integers(5, 60))
def test_chunks_cover_the_text(text, size):
    overlap = size // 4
    pieces = chunking.chunk(text, size, overlap, size // 2)
    at = 0
    for pos, piece in pieces:
        assert len(piece) <= size and text[pos:pos + len(piece)] == piece and pos <= at
        at = pos + len(piece)
    assert at == len(text)


def test_break_scores_and_fences():
    text = "a\n# h\n\n## h2\n```\n# no\n```\n- x\n1. y\n---\nz"
    kinds = {p: k for p, _, k in chunking.break_points(text)}
    assert kinds[1] == "h1" and "codeblock" in kinds.values() and "hr" in kinds.values()
    assert len(chunking.code_fences(text)) == 1 and chunking.code_fences("a\n```\nb") == [(1, 7)]
    assert chunking.best_cut([(90, 1, "newline"), (60, 100, "h1")], 100, 50) == 60
    assert chunking.best_cut([(60, 100, "h1")], 100, 50, fences=[(50, 70)]) == 100
    assert chunking.merge_breaks([(1, 5, "a")], [(1, 9, "b"), (0, 1, "c")]) == [(0, 1, "c"), (1, 9, "b")]
    assert [k for _, _, k in chunking.python_breaks("import a\n\n@d\ndef f():\n  pass\n")] == ["import", "function"]
    assert chunking.python_breaks("def (") == [] and chunking.syntax_breaks("export class A {}\n", "x.ts")


def test_token_chunks_respect_the_limit():
    text = "word " * 3000
    pieces = chunking.chunk_by_tokens(text, lambda t: len(t), size=500)
    assert all(n <= 500 for _, _, n in pieces) and pieces[-1][0] + len(pieces[-1][1]) == len(text)
    assert chunking.chunk_by_tokens("abc") == [(0, "abc", 1)]


def test_chunk_frames(spark):
    df = spark.createDataFrame([(1, "x" * 5000), (2, None), (3, "")], "id int, t string")
    got = chunking.chunk_documents(df, "id", "t").collect()
    assert sorted((r["id"], r["seq"], r["pos"], len(r["text"])) for r in got) == [(1, 0, 0, 3600), (1, 1, 3060, 1940), (3, 0, 0, 0)]
    b = chunking.pack_batches(spark.createDataFrame([(i, 10) for i in range(5)] + [(9, 100)], "i int, n int"), "i", "n", 2, 50)
    assert [r["batch"] for r in b.orderBy("i").collect()] == [0, 0, 1, 1, 2, 3]


def reports(spark):
    rows = [("b1", "r1", "Harbour telescope glossary", "s1", 3.0, 1), ("b1", "r2", "Kettle", None, float("nan"), 2), ("b2", "r3", "Telescope harbour", "", 9.0, 3), ("b2", "r4", None, "other things", 1.0, 4)]
    return spark.createDataFrame(rows, "member string, report_id string, title string, summary string, rank double, pos int")


def test_units_edges_communities(spark):
    u = graph.limit_units(graph.semantic_units(reports(spark), "o", "g"))
    assert u.count() == 4
    e = {(r["relation"], tuple(r["shared"])) for r in graph.edges(u).collect()}
    assert ("co_clustered_topic", ("harbour", "telescope")) in e and sum(r == "bookshelf_membership" for r, _ in e) >= 1
    brute = 0
    rows = u.select("unit_id", "member", F.concat_ws(" ", "title", "summary").alias("t")).collect()
    import re

    tok = lambda t: set(re.findall(r"[a-z][a-z0-9_-]{3,}", t.lower())) - set("about after also and book books from into that the their this through with".split())
    for i in range(4):
        for j in range(i):
            brute += rows[i]["member"] == rows[j]["member"] or len(tok(rows[i]["t"]) & tok(rows[j]["t"])) >= 2
    assert graph.edges(u, None).count() == brute
    assert graph.communities(u).count() == 2 and graph.overview(u).first()["n_units"] == 4
    assert graph.overview(u.limit(1)).count() == 0 and graph.edges(u.limit(0)).count() == 0
    best = graph.search_reports(reports(spark), "harbour telescope", 2, ("title", "summary")).orderBy("place").collect()
    assert [r["report_id"] for r in best] == ["r1", "r3"] or [r["report_id"] for r in best] == ["r3", "r1"]
    assert graph.search_reports(reports(spark), "of", 2, ("title", "summary")).count() == 2


def test_inspection(spark):
    found = graph.inspect({"communities": spark.createDataFrame([(1,)], "id int").limit(0)})
    assert "missing_relation:semantic_units" in found and "missing_column:communities:title" in found and "empty_relation:communities" in found
    df = spark.createDataFrame([("Bearer abcdefgh99", ["ok", "sk-abcdefgh11"])], "a string, b array<string>")
    assert {(r["column"], r["reason"]) for r in graph.sensitive_columns(df).collect()} == {("a", "bearer_token"), ("b", "api_token")}
    assert graph.budget(40, 32, 20480) == (20480, True)


def test_id_arrays(spark):
    df = spark.createDataFrame([('["a","b"]',), ("x",), ('"q"',), ("[]",), (None,), (" ",), ("[broken",)], "a string")
    assert [r[0] for r in df.select(graph.id_array(F.col("a"))).collect()] == [["a", "b"], ["x"], ["q"], [], [], [], []]


def test_routes(spark):
    rows = [("why is it so", "auto", None, True, 10, 8), ("plain", "auto", None, True, 10, 8), ("why", "graph", None, True, 10, 0), ("causal", "auto", "medium", True, 0, 0), ("why", "auto", None, False, 10, 10)]
    got = routing.decide(spark.createDataFrame(rows, "query string, requested string, max_cost string, allow_upgrade boolean, total int, ready int")).collect()
    assert [r["route"] for r in got] == ["graph", "retrieval", "graph", "retrieval", "retrieval"] and got[2]["status"] == "refused"
    assert got[3]["reasons"] == "no_graph_ready_candidate|coverage_below_threshold|cost_policy_exceeded"


def test_store_snapshots(spark):
    stored = spark.createDataFrame([("c", "a", "A", "h1", True), ("c", "b", "B", "h2", True), ("c", "x", "X", "h3", False), ("d", "a", "A", "h3", True), ("c", "r", "R", "h9", True)], "collection string, path string, title string, hash string, active boolean")
    scan = spark.createDataFrame([("c", "a", "A", "h1"), ("c", "b", "B2", "h2"), ("c", "x", "X", "h3"), ("d", "a", "A", "new")], "collection string, path string, title string, hash string")
    got = {(r["collection"], r["path"]): r["status"] for r in store.classify_changes(scan, stored).collect()}
    assert got == {("c", "a"): "unchanged", ("c", "b"): "retitled", ("c", "x"): "indexed", ("d", "a"): "updated", ("c", "r"): "removed"}
    content = spark.createDataFrame([("h1",), ("h3",), ("h7",)], "hash string")
    assert [r[0] for r in store.orphan_content(content, stored).collect()] == ["h7"]
    docs, left = store.remove_collection(stored, content, "c")
    assert [r["collection"] for r in docs.collect()] == ["d"] and [r[0] for r in left.collect()] == ["h3"]
    docs, left = store.remove_collection(stored, content, "d")  # h3 loses its only active document: the inactive row goes too
    assert ("c", "x") not in {(r["collection"], r["path"]) for r in docs.collect()} and [r[0] for r in left.collect()] == ["h1"]
    assert sorted(r[0] for r in store.scoped_hashes(stored, "c").collect()) == ["h1", "h2", "h9"]


def test_ranking(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 3, 0), ("b", None, 5), ("a", 1, 9)], "k string, t int, id int")
    assert sorted((r["k"], r["id"]) for r in ranking.latest_per_key(df, ["k"], "t", "id").collect()) == [("a", 0), ("b", 5)]
    assert ranking.running_budget(spark.createDataFrame([(1, 5), (2, 6), (3, 1)], "o int, n int").withColumn("g", F.lit(1)), "g", ["o"], "n", 10).count() == 1
    assert ranking.gap_to_runner_up(spark.createDataFrame([], "s double"), "s").first()["top"] == 0.0


@pytest.mark.parametrize("share", [1, 3])
def test_running_totals_of_large_groups(spark, share):
    rows = [("hot" if i % share == 0 else None if i % 7 == 0 else f"g{i}", (i * 7919) % 1000, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, id int").withColumn("__part", F.lit(0)).repartition(6)
    got = {r["id"]: r["t"] for r in ranking.running_total(df, "g", ["o", "id"], F.col("o"), "t").collect()}
    sums, want = {}, {}
    for g, o, i in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        sums[g] = want[i] = sums.get(g, 0) + o
    assert got == want
    r = ranking.resequence(df, "g", ["o", "id"], "o").where("g = 'hot'").agg(F.max("sequence").alias("m"), F.count_if("duplicate").alias("d")).first()
    assert r["m"] == sum(g == "hot" for g, *_ in rows) and r["d"] > 0


def test_state(spark):
    rows = spark.createDataFrame([("u", "a", "succeeded"), ("u", "c", "succeeded"), ("v", "a", "failed")], "i string, s string, st string")
    got = {r["i"]: (r["next_stage"], r["stale"]) for r in state.next_stage(rows, "i", "s", "st", ["a", "b", "c"]).collect()}
    assert got == {"u": ("b", 1), "v": ("a", 0)}
    m = spark.createDataFrame([("p", 1, "d"), ("q", 1, "d"), ("r", 1, "d")], "path string, bytes int, digest string")
    f = spark.createDataFrame([("p", 1, "e"), ("q", 2, "d"), ("s", 1, "d")], "path string, bytes int, digest string")
    assert {(r["path"], r["problem"]) for r in state.closure(m, f).collect()} == {("p", "digest"), ("q", "bytes"), ("r", "missing"), ("s", "undeclared")}
    assert [r["reason"] for r in state.validate(m, [("big", F.col("bytes") > 5)]).collect()] == ["big"] * 3
    health = state.log_health(spark.createDataFrame([(1, "ERROR timeout"), (2, "info error timeout"), (3, "WARN skipped file")], "n int, l string"), "l", "n")
    assert [r["kind"] for r in health.orderBy("n").collect()] == ["transient", "partial"]


def test_metrics(spark):
    results = spark.createDataFrame([("q", 1, "store://c/x/a.md"), ("q", 2, "b.md"), ("p", 1, "zzz")], "query_id string, rank int, file string")
    expected = spark.createDataFrame([("q", "B.md"), ("q", "A.md"), ("q", "none.md"), ("p", "y"), ("o", "w")], "query_id string, file string")
    got = {r["query_id"]: r for r in evaluation.score_results(results, expected, 2).collect()}
    assert abs(got["q"]["recall"] - 2 / 3) < 1e-9 and got["q"]["precision_at_k"] == 1.0 and got["q"]["mrr"] == 1.0 and got["o"]["f1"] == 0.0
    assert evaluation.unmatched(results, expected).count() == 3


def test_reward():
    good = evaluation.reward("TDS motorsports wheels", "lex: TDS motorsports alloy\nlex: \"TDS motorsports\" rims\nvec: which wheels does TDS motorsports recommend for racing\nhyde: TDS motorsports offers forged wheels in several sizes for track and street use.")
    assert good["rating"] == "Excellent" and good["max_possible"] == 140
    assert evaluation.reward("x", "plain line")["rating"] == "Failed" and evaluation.reward("x", "lex: a<|im_start|>")["total"] == 0
    assert evaluation.reward("best trail shoes", "lex: best trail shoes\nvec: which shoes are best for trails")["percentage"] <= 50.0
    only = evaluation.reward("trail shoes /only:lex", "lex: trail shoes grip\nlex: light trail footwear")
    assert only["max_possible"] == 120 and only["total"] > 60
    assert evaluation.reward("a /only:vec", "lex: b")["rating"] == "Failed"
    assert evaluation.entities("Bob asked about node.js deploy") == {"bob", "node.js", "deploy"} and evaluation.entities("configure it") == set()


def test_expansion_columns(spark):
    df = spark.createDataFrame([("<think>x</think>lex: a\nbad\nhyde: b c",), (None,)], "t string").select(evaluation.parse_expansion(F.col("t")).alias("o"))
    assert [[tuple(x) for x in r["o"]] for r in df.collect()] == [[("lex", "a"), ("hyde", "b c")], []]
    assert [[x["type"] for x in r[0]] for r in df.select(evaluation.normalize_output(F.col("o"))).collect()] == [["hyde", "lex"], []]
    rewards = spark.createDataFrame([(None, None)], "q string, t string").select(evaluation.score_expansions(F.col("q"), F.col("t")).alias("r")).first()["r"]
    assert rewards["max_possible"] == 120


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_split_is_stable(spark, share):
    df = spark.range(200)
    a = evaluation.split(df, "id", share).where("split = 'eval'").count()
    assert abs(a / 200 - share) < 0.12 and a == evaluation.split(df.repartition(7), "id", share).where("split = 'eval'").count()
