import pytest
from pyspark.sql import functions as F

from corpuskiln.operators.references import orphan_references
from corpuskiln.operators.skew import hot_keys, salted_left_join


def refs(spark):
    return spark.createDataFrame([(1, "a", "x", 5), (2, "a", None, 5), (3, None, "x", 5), (4, None, None, 5), (5, "b", "x", 5), (6, "gone", "x", 5), (7, "a", "x", 1), (1, "a", "x", 5)], "id int, k1 string, k2 string, t int")


def targets(spark):
    return spark.createDataFrame([("a", "x", 3, True), ("a", "x", 4, True), ("b", "x", 1, False)], "t1 string, t2 string, since int, alive boolean")


def removed(spark):
    return spark.createDataFrame([("gone", "x")], "t1 string, t2 string")


def kinds(df):
    return sorted((r["id"], r["kind"]) for r in df.collect())


KEYS = [("k1", "t1"), ("k2", "t2")]


def test_simple_ignores_partial_nulls(spark):
    got = orphan_references(refs(spark), targets(spark), KEYS, ref_time="t", target_time="since", alive=F.col("alive"), removed=removed(spark), removed_keys=["t1", "t2"])
    assert kinds(got) == [(5, "deleted"), (6, "deleted"), (7, "late")]


def test_full_reports_mixed_keys(spark):
    got = orphan_references(refs(spark), targets(spark), KEYS, match="full")
    assert kinds(got) == [(2, "mixed"), (3, "mixed"), (6, "missing")]


def test_partial_compares_non_null_columns(spark):
    t = spark.createDataFrame([("q", "y")], "t1 string, t2 string")
    got = orphan_references(refs(spark), t, KEYS, match="partial")
    assert kinds(got) == [(1, "missing"), (1, "missing"), (2, "missing"), (3, "missing"), (5, "missing"), (6, "missing"), (7, "missing")]


def test_empty_tables_and_clashing_names(spark):
    r = refs(spark).withColumns({"__key": F.lit(1), "__there": F.lit(2), "__salt": F.lit(3)})
    got = orphan_references(r, targets(spark).limit(0), KEYS)
    assert len(got.collect()) == 4 + 1 and {"__key", "__there", "__salt"} <= set(got.columns)
    assert orphan_references(refs(spark).limit(0), targets(spark), KEYS).count() == 0
    with pytest.raises(ValueError):
        orphan_references(refs(spark), targets(spark), KEYS, match="other")
    with pytest.raises(ValueError):
        orphan_references(refs(spark).withColumn("kind", F.lit(1)), targets(spark), KEYS)


def test_hot_key_is_salted_and_whole(spark):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    assert hot_keys(many, "k") == ["hot"]
    one = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    got = salted_left_join(many, one, "k")
    assert got.count() == 3000 and got.where("v = 1").count() == 1000 and got.where("v = 2").count() == 1
    assert salted_left_join(many, one, "k", how="left_anti").count() == 1999


def test_p5_queries_run(spark, data):
    from corpuskiln.plans.references_queries import p5_found, p5_report

    found = p5_found(spark, data)
    assert found.columns == ["tbl", "row_key", "kind", "ref_month"]
    assert found.count() == found.distinct().count() == (p5_report(spark, data).agg(F.sum("n_orphans")).first()[0] or 0)
