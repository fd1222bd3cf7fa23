"""Paths, messages, ages, metadata, document formats, record logs and failing embedders."""

import json

import pytest
from pyspark.sql import functions as F

from corpuskiln.corpus import Corpus
from corpuskiln.functions import text as T
from corpuskiln.functions.udfs import safe_metadata
from corpuskiln.operators import vectors
from corpuskiln.sources import sinks
from corpuskiln.sources.storage import Folder


def values(spark, rows, make):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("t"))).collect()]


def test_portable_paths(spark):
    assert values(spark, ["a/b.md", "a\\b\\.\\c", "./a//b", "", "/a", "C:\\x", "c:x", "http://x", "~/x", "~me", "a/../b", ".", None], T.portable_path) == ["a/b.md", "a/b/c", "a/b", *[None] * 10]


def test_transient_messages(spark):
    assert values(spark, ["Rate Limit hit", "status code 503", "HTTP error 502", "(500)", "code 404", "schema mismatch", "", None], T.is_transient) == [True, True, True, True, False, False, False, None]


def test_ages(spark):
    df = spark.createDataFrame([(5,), (59,), (60,), (7199,), (86399,), (172800,)], "s int")
    assert [r[0] for r in df.select(T.relative_time(F.col("s"))).collect()] == ["5s ago", "59s ago", "1m ago", "1h ago", "23h ago", "2d ago"]


def test_metadata(spark):
    given = {"model": "m", "apiKey": "x", "deep": {"rawRequest": 1, "n": 1, "path": "/home/me", "list": ["ok", "sk-abc", "C:/x"]}, "monkey": "kept", "n": None}
    assert json.loads(values(spark, [json.dumps(given)], safe_metadata)[0]) == {"model": "m", "deep": {"n": 1, "list": ["ok"]}, "monkey": "kept", "n": None}
    assert values(spark, ['{"token": 1}', "[1]", "{broken", None], safe_metadata) == [None] * 4


def test_document_formats(spark):
    rows = [(0, "a.md", "A", 'say "x"', "one, two", None), (1, "b.md", "b.md", None, None, "File too large")]
    df = spark.createDataFrame(rows, "ord int, file string, title string, context string, body string, skip_reason string")
    of = lambda kind: [r["line"] for r in sinks.format_documents(df, kind).orderBy("ord").collect()]
    assert of("csv") == ['a.md,A,"say ""x""",false,"one, two"', "b.md,b.md,,true,File too large"]
    assert of("files") == ['a.md,"say ""x"""', "b.md,[SKIPPED]"]
    assert [json.loads(x) for x in of("json")] == [{"file": "a.md", "title": "A", "context": 'say "x"', "body": "one, two"}, {"file": "b.md", "title": "b.md", "skipped": True, "reason": "File too large"}]
    assert of("md") == ['## a.md\n\n**Title:** A\n\n**Context:** say "x"\n\n```\none, two\n```\n', "## b.md\n\n> File too large\n"]
    assert "<skipped>true</skipped>" in of("xml")[1] and "<context>say &quot;x&quot;</context>" in of("xml")[0]
    with pytest.raises(ValueError):
        sinks.format_documents(df, "pdf")


def test_record_log(spark, tmp_path):
    cost = lambda *ns: spark.createDataFrame([(f"m{n}", n) for n in ns], "model string, tokens int")
    root = str(tmp_path / "log")
    assert sinks.read_records(spark, root, "cost").count() == 0
    assert sinks.append_records(cost(1, 2), root, "cost") == 2 and sinks.append_records(cost(3), root, "cost") == 3
    folder = Folder(spark, root)
    broken = sinks.read_records(spark, root, "cost").unionByName(spark.createDataFrame([(4, "{half"), (5, '{"a": 1}')], "line bigint, value string"))
    name = folder.write_table(broken, "cost")
    folder.write_json("cost.json", {"table": name, "lines": 5})
    assert sinks.append_records(cost(9), root, "cost") == 4
    assert [json.loads(r["value"])["tokens"] for r in sinks.read_records(spark, root, "cost").orderBy("line").collect()] == [1, 2, 3, 9]
    assert any("corrupt" in n for n in folder.names()) and name in folder.names()


def _flaky(seen):
    def embed(texts):
        if len(texts) > 1 and any("bad" in t for t in texts):
            raise RuntimeError("call failed")
        out = []
        for t in texts:
            seen[t] = seen.get(t, 0) + 1
            out.append(None if "never" in t or ("bad" in t and seen[t] < 3) else [float(len(t)), 1.0])
        return out

    return embed


def test_failing_embedders(spark, tmp_path):
    df = spark.createDataFrame([(1, "good"), (2, "bad one"), (3, "never"), (4, None)], "id int, t string").coalesce(1)
    got = {r["id"]: (r["v"], r["why"]) for r in vectors.embed_with_retries(df, "t", "v", "why", _flaky({})).collect()}
    assert got == {1: ([4.0, 1.0], None), 2: ([7.0, 1.0], None), 3: (None, "no vector"), 4: (None, None)}
    many = spark.range(200).select(F.concat(F.lit("never "), F.col("id").cast("string")).alias("t")).coalesce(1)
    why = {r["why"]: r["count"] for r in vectors.embed_with_retries(many, "t", "v", "why", _flaky({})).groupBy("why").count().collect()}
    assert why == {"no vector": 32, "given up because too many failed": 168}
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.md").write_text("good text")
    (tmp_path / "src" / "b.md").write_text("never text")
    c = Corpus(spark, str(tmp_path / "store"), embedder=_flaky({}))
    c.add_collection("notes", str(tmp_path / "src"))
    c.update()
    assert c.embed() == 1 and c.status()["pending"] == 1 and c.vectors().count() == 1
