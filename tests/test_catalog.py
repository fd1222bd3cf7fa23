import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpuskiln.operators import catalog, graph, ranking, state, vectors


def test_sets(spark):
    a = spark.createDataFrame([("g", "x"), ("g", "y"), ("h", None), ("i", "z")], "g string, x string")
    b = spark.createDataFrame([("g", "x"), ("g", "y"), ("g", "w"), ("i", "y")], "g string, x string")
    assert {r["g"]: r["subset"] for r in catalog.subset_by_group(a, b, "g", "x").collect()} == {"g": True, "h": True, "i": False}
    assert {r["g"]: (r["present"], r["stale"]) for r in catalog.stale_sets(a, b, "g", "x").collect()} == {"g": (True, True), "i": (True, True)}
    assert not catalog.stale_sets(b, b, "g", "x").where("stale").count() and catalog.stale_sets(a.limit(0), b, "g", "x").where("present").count() == 0
    assert [tuple(r) for r in spark.range(1).select(catalog.is_subset(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))), catalog.is_subset(F.array().cast("array<int>"), F.array(F.lit(1)))).collect()] == [(True, True)]


def test_metrics(spark):
    m = spark.createDataFrame([("a", 1, 5), ("b", 3, 1), ("c", 3, 2), (None, 3, 2)], "model string, n int, t int")
    assert [r["model"] for r in catalog.top_metrics(m, "n", "t", "model", 3).collect()] == [None, "c", "b"]
    assert tuple(catalog.metric_totals(m, "model", ["n", "t"]).first()) == (3, 10, 10) and tuple(catalog.metric_totals(m.limit(0), "model", ["n"]).first()) == (0, 0)
    e = spark.createDataFrame([("a", 100.0), ("a", 300.0), ("b", 0.0)], "k string, ms double")
    assert {r["k"]: (r["median_ms"], r["documents_per_second"]) for r in catalog.throughput(e, "k", "ms", F.lit(2)).collect()} == {"a": (200.0, 10.0), "b": (0.0, None)}
    assert {r["rating"]: r["n"] for r in catalog.rating_histogram(spark.createDataFrame([(81.0,), (20.0,), (3.0,), (None,)], "s double"), "s").collect()} == {"Excellent": 1, "Poor": 1, "Failed": 1}


def test_recovery(spark):
    items = spark.createDataFrame([("a", "failed", True, 5), ("a", "open", False, 9), ("b", "done", False, 1)], "i string, s string, r boolean, at int")
    slots = spark.createDataFrame([("a", 7, 1), ("a", 3, 4), (None, 1, 1)], "i string, w int, g int")
    got = {x["i"]: tuple(x)[1:] for x in catalog.recovery_summary(items, slots, "i", "s", "r", "at", "w", "g").collect()}
    assert got == {"a": ("open", True, 5, 2, 7, 4), "b": ("done", False, None, 0, None, None)}


def test_sample_and_adoption(spark):
    v = spark.createDataFrame([(i, [1.0, float(i)], "" if i < 3 else "new") for i in range(6)] + [(9, None, None)], "k int, v array<double>, f string")
    assert catalog.seeded_sample(v, "k", 3).collect() == catalog.seeded_sample(v.repartition(3), "k", 3).collect() and catalog.seeded_sample(v, "k", 3, 1).collect() != catalog.seeded_sample(v, "k", 3).collect()
    after, why = catalog.adopt_fingerprint(v, "k", "v", "f", 1, [1.0, 1.0], "now")
    assert after.where("f = 'now'").count() == 4 and "matches" in why
    after, why = catalog.adopt_fingerprint(v, "k", "v", "f", 1, [1.0, 2.0], "now")
    assert after.where("f = 'now'").count() == 0 and "differs" in why
    assert catalog.adopt_fingerprint(v.where("f = 'new'"), "k", "v", "f", 1, [1.0, 2.0], "now")[1].startswith("no vectors")


def test_output_score(spark):
    rows = ["lex: a\nvec: b\nhyde: " + "x" * 90, "lex: a\nlex: b", "hyde: comprehensive guide " + "y" * 40, "", None]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    assert [r[0] for r in df.select(catalog.output_score(F.col("t"))).collect()] == [6, 2, 2, 0, None]


def test_levels(spark):
    units = spark.createDataFrame([("u1", "m", "g1"), ("u2", "gone", "g0")], "unit_id string, member string, generation string")
    edges = spark.createDataFrame([("u1", "u9")], "left string, right string")
    evidence = spark.createDataFrame([("u1",), (None,)], "unit_id string")
    members = spark.createDataFrame([("m",)], "member string")
    got = {r["problem"]: r["n"] for r in catalog.level_problems(units, edges, evidence, members, "g1", 1, 5).collect()}
    assert got == {"edge_without_unit": 1, "evidence_without_unit": 1, "unit_without_evidence": 1, "unit_of_unknown_member": 1, "stale_unit": 1, "too_many_units": 2}
    assert catalog.level_problems(*(x.limit(0) for x in (units, edges, evidence, members)), "g1", 1, 5).count() == 0
    reports = spark.createDataFrame([("s1", "r1", "Old harbour", "telescope glossary notes", 2.0, 1), ("s2", "r2", "Harbour", "telescope glossary", 1.0, 2)], "member string, report_id string, title string, summary string, rank double, pos int")
    whole = spark.createDataFrame([("b",) * 7], ", ".join(f"{c} string" for c in graph.LINEAGE))
    level = graph.library_level(reports, "lib", "g1", evidence=whole)
    assert level["units"].count() == 2 and level["edges"].count() == 1 and level["communities"].count() == 2 and level["overview"].first()["n_units"] == 2
    with pytest.raises(PySparkException, match="incomplete lineage"):
        graph.library_level(reports, "lib", "g1", evidence=whole.withColumn(graph.LINEAGE[3], F.lit("unknown-x")))


def test_identity_of_text_units(spark):
    docs = spark.createDataFrame([("d1", "a/one.md"), ("d2", "b/two.md"), ("d3", "c/two.md")], "document_id string, path string")
    units = spark.createDataFrame([("u1", "d1", None), ("u2", "zz", "x/ONE.md"), ("u3", None, "two.md"), ("u4", None, None)], "unit_id string, document_id string, title string")
    assert {r["unit_id"]: (r["document_id"], r["how"]) for r in catalog.text_unit_identity(units, docs).collect()} == {"u1": ("d1", "id"), "u2": ("d1", "name"), "u3": (None, None), "u4": (None, None)}
    assert {r["how"] for r in catalog.text_unit_identity(units.where("unit_id = 'u4'"), docs.limit(1)).collect()} == {"only"}


def test_sensitive_names(spark):
    df = spark.createDataFrame([("plain", "Bearer abcdefgh123", ["sk-abcdefgh12"])], "APIKEY string, t string, a array<string>")
    assert {(r["column"], r["reason"], r["n"]) for r in graph.sensitive_columns(df).collect()} == {("APIKEY", "field_name", 1), ("t", "bearer_token", 1), ("a", "api_token", 1)}


def test_parts_of_many_ids(spark):
    ids = spark.createDataFrame([(f"{i:04d}",) for i in range(1000)], "id string").repartition(5)
    assert {r["part"]: r["count"] for r in ranking.partition_plan(ids, "id", 300).groupBy("part").count().collect()} == {1: 300, 2: 300, 3: 300, 4: 100}
    assert ranking.partition_plan(ids, "id", 300).where("id = '0300'").first()["part"] == 2 and ranking.partition_plan(ids.limit(0), "id", 3).count() == 0


def test_states(spark):
    rows = spark.createDataFrame([("a", "failed", True), ("a", "open", False), ("b", "done", False), (None, None, None)], "i string, s string, r boolean")
    rule = state.first_true([("retry", F.bool_or(F.col("r"))), ("done", F.bool_and(F.col("s") == "done"))], "open")
    assert {x["i"]: x["state"] for x in rows.groupBy("i").agg(rule.alias("state")).collect()} == {"a": "retry", "b": "done", None: "open"}
    assert rows.groupBy("i").agg(state.first_true([], "none").alias("state")).select("state").distinct().first()[0] == "none"
    stored = spark.createDataFrame([("k1", 1, "x"), ("k2", 5, "y")], "k string, at int, v string")
    after = state.upsert_artifacts(stored, spark.createDataFrame([("k1", 2, "z"), ("k2", 3, "w"), ("k3", 1, "n")], "k string, at int, v string"), ["k"], "at", "v")
    assert {r["k"]: r["v"] for r in after.collect()} == {"k1": "z", "k2": "y", "k3": "n"}
    costs = spark.createDataFrame([("m1", 2), ("m1", 5), ("m2", 7)], "m string, at int")
    assert {r["m"]: r["requests"] for r in state.cost_groups(costs, ["m"], "at").collect()} == {"m1": 1, "m2": 0}


def test_nearest_of_nothing(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0])], "vec_id bigint, embedding array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.1]), (8, [2.0]), (9, None), (10, [])], "query_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in vectors.nearest(v, "vec_id", "embedding", q, "query_id", "embedding", 2).collect()}
    assert got == {(7, 1): 1, (7, 2): 2, (8, 1): 3}
    assert vectors.nearest(v.limit(0), "vec_id", "embedding", q, "query_id", "embedding", 2).count() == vectors.nearest(v, "vec_id", "embedding", q.limit(0), "query_id", "embedding", 2).count() == 0
