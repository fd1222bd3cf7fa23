from pyspark.sql import functions as F

from corpuskiln.operators import benchmark
from corpuskiln.operators.snippets import intent_terms, snippet, snippets

BODY = "\n".join(["head", "apple line", "x", "y", "pear apple", "z"] + ["fill"] * 50 + ["tail word", "end"])


def test_whole_body():
    s = snippet(BODY, "apple pear")
    assert s.line == 5 and s.snippet.startswith("@@ -4,4 @@ (3 before, ") and s.lines_before + s.snippet_lines + s.lines_after == 58


def test_intent_breaks_ties():
    assert snippet("apple\napple store\napple", "apple", intent="the store").line == 2 and intent_terms("What is the (API) of it?") == ["api"]


def test_chunks():
    at = BODY.index("tail")
    assert snippet(BODY, "word", chunk_pos=at, chunk_len=10).line == 57
    assert snippet(BODY, "nothing", chunk_pos=at, chunk_len=10).line == 57  # shown from the chunk's start
    assert snippet(BODY, "tail", chunk_pos=0, chunk_len=5).line == 57  # the chunk holds no match: whole body
    assert snippet("\n" * 500 + "apple", "apple", chunk_pos=200, chunk_len=10).line == 501  # blank window
    assert snippet("", "x").snippet == "@@ -1,1 @@ (0 before, 0 after)\n" and len(snippet("a" * 900, "a").snippet.split("\n")[1]) == 500


def test_frames(spark):
    df = spark.createDataFrame([(1, "a\nb apple", "apple", None), (2, None, None, 5)], "i int, b string, q string, p int")
    got = df.select("i", snippets(F.col("b"), F.col("q"), F.col("p"), F.lit(None).cast("int"), F.lit(None).cast("string")).alias("s")).orderBy("i").collect()
    assert got[0]["s"]["line"] == 2 and got[1]["s"]["lines_after"] == 0


def test_benchmark(spark):
    files = spark.createDataFrame([("a.md", 1), ("b.md", 2)], "file string, rank int")

    def broken(text, limit):
        raise RuntimeError

    each, per = benchmark.run(spark, [("q1", "x", ["B.md"], 1), ("q2", "y", ["a.md"], 2)], {"good": lambda t, n: files, "bad": broken})
    got = {(r["backend"], r["query_id"]): r for r in each.collect()}
    assert got["good", "q1"]["precision_at_k"] == 0.0 and got["good", "q1"]["mrr"] == 0.5 and got["good", "q2"]["f1"] == 1.0 and got["bad", "q2"]["recall"] == 0.0
    assert {r["backend"]: round(r["mrr"], 2) for r in per.collect()} == {"good": 0.75, "bad": 0.0}
