import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import fusion, lexical, postings, vectors
from corpuskiln.plans.retrieval_queries import SEARCHES
from corpuskiln.session import stage_table


def docs(spark):
    rows = [(1, "c", "a/one.md", "Running shoes", "The runner runs fast. old harbour", True), (2, "c", "b/two.md", "Harbour", "nothing about the old harbour here", True), (3, "d", "c/three.md", None, None, True), (4, "d", "harbour.md", "x", "harbour", False), (5, "d", "d/cjk.md", "木桥", "旧的木桥", True), (6, "c", "e/six.md", "Follow-up", "follow up on multi-agent work, e\u0301t\u00e9", True)]
    return spark.createDataFrame(rows, "doc_id int, source string, path string, title string, text string, active boolean")


def ids(df):
    return [r["doc_id"] for r in df.orderBy("rank").collect()]


def test_query_parser():
    p = lexical.parse_query('foo "a b" -bar -"c d" multi-agent 木桥 foo_bar')
    assert [(x.tokens, x.prefix, x.negated) for x in p] == [(("foo",), True, False), (("a", "b"), False, False), (("bar",), True, True), (("c", "d"), False, True), (("multi", "agent"), False, False), (("木", "桥"), False, False), (("foo", "bar"), True, False)] or p[6].tokens == ("foobar",)
    assert lexical.parse_query("-only -negative") == [] and lexical.parse_query('  "" ') == []


def test_validation():
    for bad in ("a\nb", 'a "b'):
        with pytest.raises(lexical.QueryError):
            lexical.validate_lexical(bad)
    with pytest.raises(lexical.QueryError):
        lexical.validate_semantic("a -b")
    lexical.validate_semantic("well-known")


def test_search_kinds(spark):
    d = docs(spark)
    assert ids(lexical.search(d, "harb")) == [2, 1]
    assert ids(lexical.search(d, '"old harbour"')) in ([2, 1], [1, 2])
    assert ids(lexical.search(d, "harbour -nothing")) == [1]
    assert ids(lexical.search(d, "木桥")) == [5]
    assert ids(lexical.search(d, "follow-up")) == [6]
    assert ids(lexical.search(d, "running", stem=True)) == [1] and ids(lexical.search(d, "running")) == [1]
    assert ids(lexical.search(d, "zzz")) == [] and ids(lexical.search(d, "-x")) == []
    assert ids(lexical.search(d, "harbour", collection="c")) == [2, 1] and ids(lexical.search(d, "harbour", collection="d")) == []


def test_scores_follow_the_formula(spark):
    r = lexical.bm25(docs(spark).where("active"), "runner", ["doc_id"], {"body": "text"}, weights={"body": 1.0}).first()
    lengths = [6, 6, 0, 0, 4, 7]
    n, mean = 5, None
    tokens = docs(spark).where("active").select(lexical.token_total(lexical.token_string(F.col("text"))).alias("t")).collect()
    mean = np.mean([t["t"] for t in tokens])
    idf = math.log((n - 1 + 0.5) / 1.5)
    want = idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * tokens[0]["t"] / mean))
    assert abs(r["raw"] - want) < 1e-9 and abs(r["score"] - want / (1 + want)) < 1e-9 and lengths


def test_empty_table(spark):
    assert lexical.search(docs(spark).limit(0), "harbour").count() == 0
    assert lexical.document_frequency(docs(spark).limit(0), "text").count() == 0


def test_postings(spark):
    p = {(r["term"], r["doc_id"]): (r["title"], r["body"], r["length"]) for r in postings.build(docs(spark), stem=False).terms.collect()}
    assert p[("harbour", 2)][1] == [4]


@pytest.mark.parametrize("name", sorted(n for n, (_, o) in SEARCHES.items() if not o.get("exact_filter")))
@pytest.mark.parametrize("stem", [False, True])
def test_postings_find_what_a_scan_finds(spark, data, name, stem):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    text, options = SEARCHES[name]
    rows = lambda df: [(r["doc_id"], r["rank"], round(r["score"], 9)) for r in df.orderBy("rank").collect()]
    assert rows(postings.search(_index(spark, data, stem), text, **options)) == rows(lexical.search(documents, text, stem=stem, **options))


_INDEXES = {}


def _index(spark, data, stem):
    if stem not in _INDEXES:
        made = postings.build(spark.read.parquet(f"{data}/documents.parquet"), stem=stem)
        _INDEXES[stem] = postings.Index(stage_table(made.terms, "terms"), made.documents, made.mean, stem)
    return _INDEXES[stem]


def test_postings_of_odd_queries(spark):
    rows = [(1, "s", "p", None, "a a a b"), (2, None, "p", "", None), (3, "s", None, "a b", "b a a a a")]
    d = spark.createDataFrame(rows, "doc_id bigint, source string, path string, title string, text string")
    i = postings.build(d, stem=False)
    for q in ('"a a"', '"a a b"', "-a", "", "b -\"a b\"", "zzz", "a"):
        assert [tuple(r) for r in postings.search(i, q).orderBy("rank").collect()] == [tuple(r) for r in lexical.search(d, q, stem=False).orderBy("rank").collect()], q
    none = postings.build(d.limit(0))
    assert none.documents == 0 and postings.search(none, "a").count() == 0


def test_postings_scan_reads_its_terms_only(spark, tmp_path, data):
    made = _index(spark, data, False)
    made.terms.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id").write.parquet(str(tmp_path / "i"))
    stored = postings.Index(spark.read.schema(postings.SCHEMA).parquet(str(tmp_path / "i")), made.documents, made.mean, False)
    plan = postings._hits(stored, lexical.parse_query("harbour")[0], lexical.WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(term,harbour)" in plan


def test_nearest_against_numpy(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(100, None), (101, [0.0] * 8), (102, [1.0])]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    q = spark.createDataFrame(rows[:5] + [(7, None), (8, [0.0] * 8)], "query_id bigint, embedding array<double>")
    for chunk in (1 << 20, 64):
        got = {}
        for r in vectors.nearest(v, "vec_id", "embedding", q, "query_id", "embedding", 4, block_bytes=chunk).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
        u = m / np.linalg.norm(m, axis=1, keepdims=True)
        for i in range(5):
            assert [got[i][k] for k in (1, 2, 3, 4)] == list(np.argsort(1 - u @ u[i], kind="stable")[:4])
        assert set(got) == set(range(5))


def test_vector_search_filters_after_limit(spark):
    rows = [(i, [1.0, i / 10], i % 2) for i in range(20)]
    v = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int")
    assert vectors.search(v, [1.0, 0.0], limit=2, collection=1, collection_col="label").count() == 2
    assert vectors.search(v, [1.0, 0.0], limit=2, collection=1, collection_col="label", overfetch=1).count() == 1
    assert vectors.search(v, [1.0, 0.0], limit=2, collection=1, collection_col="label", overfetch=1, exact_filter=True).count() == 2
    with pytest.raises(Exception, match="dimension"):
        vectors.check_dimension(v, "embedding", 3).collect()
    assert vectors.audit(v, v, "vec_id", "embedding").where("mismatch").count() == 0
    assert len(vectors.embed(spark.createDataFrame([("a",)], "t string"), "t", "e").first()["e"]) == 16
    assert vectors.embed(spark.createDataFrame([("ab",)], "t string"), "t", "e", lambda ts: [[len(t)] for t in ts]).first()["e"] == [2.0]


def lists(spark):
    a = spark.createDataFrame([("x", 1, 0.9), ("y", 2, 0.5)], "f string, rank int, score double")
    b = spark.createDataFrame([("y", 1, 0.8), ("z", 2, 0.1)], "f string, rank int, score double")
    return a, b


def test_fusion_values_and_trace(spark):
    stacked = fusion.stack_lists(list(lists(spark)), "f", [2.0, 1.0])
    got = {r["file"]: r for r in fusion.fuse(stacked).collect()}
    assert abs(got["x"]["rrf"] - (2 / 61 + 0.05)) < 1e-12 and abs(got["y"]["rrf"] - (2 / 62 + 1 / 61 + 0.05)) < 1e-12
    assert got["y"]["first_score"] == 0.5 and abs(got["z"]["rrf"] - (1 / 62 + 0.02)) < 1e-12
    for r in fusion.trace(stacked).collect():
        assert abs(sum(c["contribution"] for c in r["contributions"]) + got[r["file"]]["bonus"] - got[r["file"]]["rrf"]) < 1e-12


def test_pipelines(spark):
    d = docs(spark)
    find = lambda q: lexical.search(d, q)
    r = fusion.hybrid(find, find, "harbour", [fusion.Search("lex", "old"), fusion.Search("vec", "runner")], d, limit=5).collect()
    assert {x["doc_id"] for x in r} == {1, 2} and [x["rank"] for x in sorted(r, key=lambda x: x["rank"])] == [1, 2]
    s = fusion.structured(find, find, [fusion.Search("lex", "zzz"), fusion.Search("lex", "harbour")], skip_rerank=True)
    assert [x["score"] for x in s.orderBy("rank").collect()] == [1.0, 0.5]
    assert fusion.structured(find, find, [fusion.Search("lex", "zzz")], skip_rerank=True).count() == 0
    scored = fusion.rerank(d.select("doc_id", "text"), "text", "q", lambda q, ts: [len(t) for t in ts])
    assert scored.where("doc_id = 3").first()["rerank_score"] == 0.0 and scored.count() == 6
    assert fusion.explain(fusion.fuse(fusion.stack_lists([find("harbour")], "doc_id", [1.0], ["fts"])), fusion.stack_lists([find("harbour")], "doc_id", [1.0], ["fts"])).count() == 2


def test_rerank_cache_and_cut(spark):
    d = spark.createDataFrame([(1, "aa" * 10), (2, "aa" * 10), (3, "aa" * 10 + "b"), (4, None), (5, "c")], "doc_id int, text string")
    cache = fusion.RerankCache()
    first = fusion.rerank(d, "text", "q", lambda q, ts: [len(t) for t in ts], cache=cache, most_chars=20)
    assert {r["doc_id"]: r["rerank_score"] for r in first.collect()} == {1: 20, 2: 20, 3: 20, 4: 0, 5: 1} and cache.rows.count() == 2
    again = fusion.rerank(d, "text", "q", lambda q, ts: [99.0 for _ in ts], cache=cache, most_chars=20)
    assert {r["doc_id"]: r["rerank_score"] for r in again.collect()} == {1: 20, 2: 20, 3: 20, 4: 0, 5: 1}
    other = fusion.rerank(d, "text", "other", lambda q, ts: [99.0 for _ in ts], cache=cache, most_chars=20)
    assert other.where("doc_id = 5").first()["rerank_score"] == 99 and cache.rows.count() == 4


def test_hybrid_reranks_the_best_chunk(spark):
    long = "plain words here. " * 400 + "\n\n# Harbour\n" + "the telescope of the harbour. " * 30
    d = spark.createDataFrame([(1, long), (2, "harbour")], "doc_id bigint, text string")
    lists = spark.createDataFrame([(1, 1, 0.5), (2, 2, 0.4)], "doc_id bigint, rank int, score double")
    got = {r["doc_id"]: r for r in fusion.hybrid(lambda q: lists, lambda q: lists, "harbour telescope", [], d).collect()}
    assert got[1]["chunk"] > 0 and got[2]["chunk"] == 0 and got[1]["rerank_score"] == 1.0 and got[2]["rerank_score"] == 0.5
    whole = fusion.hybrid(lambda q: lists, lambda q: lists, "harbour telescope", [], d, whole_texts=True)
    assert {r["chunk"] for r in whole.collect()} == {None}


def test_a_list_per_collection(spark):
    row = lambda *ids: spark.createDataFrame([(i, n + 1, 1.0) for n, i in enumerate(ids)], "doc_id bigint, rank int, score double")
    empty = row(1).limit(0)
    got = fusion.structured_over({"a": lambda q: empty, "b": lambda q: row(5, 6)}, {"a": lambda q: row(7), "b": lambda q: row(6)}, [fusion.Search("lex", "x"), fusion.Search("vec", "y")], skip_rerank=True)
    rrf = {r["doc_id"]: r["rrf"] for r in got.collect()}
    assert rrf[5] == pytest.approx(2 / 61 + 0.05) and rrf[6] == pytest.approx(2 / 62 + 1 / 61 + 0.05) and rrf[7] == pytest.approx(1 / 61 + 0.05)
