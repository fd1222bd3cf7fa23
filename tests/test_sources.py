import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpuskiln.sources import readers, sinks
from corpuskiln.streaming import reindex


def test_collection_scan(spark, tmp_path):
    for path, body in (("a.md", "# A"), ("sub/b.md", "x"), (".hidden/c.md", "x"), ("node_modules/d.md", "x"), ("blank.md", " \n\u00a0"), ("skip/e.md", "x"), ("f.txt", "x")):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(body)
    got = readers.read_collection(spark, str(tmp_path), ignore=["skip/**"]).select("path").collect()
    assert sorted(r[0] for r in got) == ["a.md", "sub/b.md"]


def test_examples(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text(json.dumps({"query": "q", "output": [["lex", "a"], ["hyde", "b"]]}) + "\n\n")
    bad.write_text(json.dumps({"query": "q", "output": [["other", "a"]]}) + "\nno json\n")
    r = readers.read_examples(spark, str(good)).first()
    assert r["output"][1]["text"] == "b" and r["is_short"] is False
    with pytest.raises(Exception, match="invalid example"):
        readers.read_examples(spark, str(bad)).collect()
    assert [(r["total"], r["valid"]) for r in readers.validate_examples(spark, str(bad)).collect()] == [(2, 0)]


def test_golden(spark, tmp_path):
    p = tmp_path / "g.jsonl"
    p.write_text(json.dumps({"query": "a", "output": [["lex", "x"]]}) + "\n" + json.dumps({"messages": [{"role": "user", "content": "Expand this search query: b"}, {"role": "assistant", "content": "lex: y"}]}))
    assert sorted(tuple(r) for r in readers.read_golden(spark, str(p)).collect()) == [("a", "lex: x"), ("b", "lex: y")]


def test_event_logs(spark):
    lines = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":2}'), (3, '{"a"'), (4, '{"a":4}')], "n int, l string")
    assert [r["n"] for r in readers.intact_events(lines, "n", "l").orderBy("n").collect()] == [1, 2]
    assert readers.intact_events(lines.limit(0), "n", "l").count() == 0
    logs = spark.createDataFrame([("x METRICS: {\"m\": 3}",), ("other",)], "l string")
    assert [r["m"] for r in readers.log_payloads(logs, "l", "METRICS: ", "m int").collect()] == [3]


def test_html_and_epub(spark, tmp_path):
    html = "<html><head><style>x</style></head><body><h2>T</h2><p>a &amp; b</p><ul><li>one</li></ul><script>y</script></body></html>"
    assert readers.markdown_of(html) == "## T\n\na & b\n\n- one"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></container>')
        z.writestr("O/p.opf", '<package><manifest><item id="a" href="t/1.html"/></manifest><spine><itemref idref="a"/></spine></package>')
        z.writestr("O/t/1.html", html)
    (tmp_path / "b.epub").write_bytes(buffer.getvalue())
    (tmp_path / "c.epub").write_bytes(b"no zip")
    assert sorted(r["body"] for r in readers.read_epubs(spark, str(tmp_path)).collect()) == ["", "## T\n\na & b\n\n- one"]


def test_relations_and_publishing(spark, tmp_path):
    sinks.write_relation(spark.range(3).withColumn("x", F.lit(1)), f"file://{tmp_path}/r", ["x", "id"])
    assert readers.read_relation(spark, f"file://{tmp_path}/r", ["id"]).count() == 3
    with pytest.raises(readers.RelationError):
        readers.read_relation(spark, f"file://{tmp_path}/r", ["id", "y"])
    sinks.publish({"r": spark.range(2)}, str(tmp_path), "1")
    sinks.publish({"r": spark.range(4)}, str(tmp_path), "2")
    assert sinks.read_published(spark, str(tmp_path), "r").count() == 4


def test_formats(spark):
    r = spark.createDataFrame([(1, 0.126, "abc123", "p/f.md", 'T "q", x', "", "a<b\nc")], "rank int, score double, docid string, file string, title string, context string, snippet string")
    line = {k: sinks.format_rows(r, k).first()["line"] for k in sinks.FORMATS}
    assert line["csv"] == '#abc123,0.1260,p/f.md,"T ""q"", x",,"a<b\nc"' and line["files"] == "#abc123,0.13,p/f.md"
    assert "a&lt;b" in line["xml"] and json.loads(line["json"])["score"] == 0.13 and line["md"].startswith("---\n# T")
    with pytest.raises(ValueError):
        sinks.format_rows(r, "pdf")


def test_streaming_reindex(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    row = lambda path, body, at: json.dumps({"collection": "c", "path": path, "body": body, "modified_at": at}) + "\n"
    (src / "1.json").write_text(row("a.md", "# One", "2024-01-01T00:00:00Z") + row("b.md", " ", "2024-01-01T00:00:00Z"))
    for _ in range(2):
        reindex.follow(spark, str(src), str(tmp_path / "index"), str(tmp_path / "cp")).awaitTermination()
        (src / "2.json").write_text(row("a.md", "# Two", "2024-01-02T00:00:00Z"))
    assert [(r["path"], r["title"]) for r in reindex.current(spark, str(tmp_path / "index")).collect()] == [("a.md", "Two")]
