import pytest
from pyspark.sql import functions as F

from corpuskiln.corpus import Corpus
from corpuskiln.operators import graph, query_document
from corpuskiln.operators.fusion import Search
from corpuskiln.operators.lexical import QueryError


def test_query_documents():
    q = query_document.parse("lex: a -b\nVEC: what is a\nintent: learn\n\n")
    assert q.searches == [Search("lex", "a -b"), Search("vec", "what is a")] and q.intent == "learn"
    assert query_document.parse("plain") is None and query_document.parse("expand: x") is None and query_document.parse(" \n") is None
    for bad in ("lex: a\nplain", "lex:", "intent: x", "intent: x\nintent: y\nlex: a", "expand:", "expand: a\nlex: b", 'lex: "a', "vec: a -b"):
        with pytest.raises(QueryError):
            query_document.parse(bad)


def test_policy_expansions(spark):
    policy = spark.createDataFrame([("Trail  Shoes", [("lex", "shoes"), ("vec", "trail shoes"), ("hyde", None)])], "query string, output array<struct<type:string,text:string>>")
    assert query_document.expansions(policy, "trail shoes ") == [Search("lex", "shoes")] and query_document.expansions(policy, "x") == []
    assert [s.type for s in query_document.fallback_expansions("x")] == ["hyde", "lex", "vec"]


def test_corpus_life(spark, tmp_path):
    src = tmp_path / "src"
    (src / "sub").mkdir(parents=True)
    (src / "a.md").write_text("# Harbour\nThe old harbour and the boats.")
    (src / "sub" / "b.md").write_text("# Telescope\nA telescope near the harbour.\nline three")
    c = Corpus(spark, str(tmp_path / "corpus"))
    c.add_collection("notes", str(src))
    assert c.update() == {"indexed": 2} and c.update() == {"unchanged": 2}
    (src / "a.md").write_text("# Harbour\nChanged text about boats.")
    (src / "sub" / "b.md").unlink()
    (src / "c.md").write_text("# New\nNothing here but the harbour.")
    assert c.update() == {"updated": 1, "removed": 1, "indexed": 1}
    assert c.status()["active"] == 2 and c.status()["pending"] == 2
    assert c.embed() == 2 and c.embed() == 0 and c.status()["pending"] == 0
    paths = {r["doc_id"]: r["path"] for r in c.documents().collect()}
    assert {paths[r["doc_id"]] for r in c.search_lex("harbour").collect()} == {"a.md", "c.md"}
    assert c.search_vector("# Harbour\nChanged text about boats.").orderBy("rank").first()["score"] > 0.99
    assert c.search("harbour").count() == 2 and c.search("lex: boats", skip_rerank=True).count() == 1
    assert c.body("a.md", 2, 1) == "Changed text about boats." and c.body("zzz") is None
    assert c.multi_get("*.md").count() == 2 and c.multi_get("a.md, zzz.md").count() == 1
    assert c.add_context("notes", "/", "Notes") and not c.add_context("x", "/", "y")
    c.set_global_context("All")
    assert {r["context"] for r in c.contexts_of().collect()} == {"All\n\nNotes"} and c.list_contexts() == [("notes", "/", "Notes")]
    c.cleanup()
    assert c.documents().count() == c.content().count() == 2
    again = Corpus(spark, str(tmp_path / "corpus"))
    assert again.rename_collection("notes", "texts") and not again.rename_collection("gone", "x") and again.default_collections() == ["texts"]
    with pytest.raises(ValueError):
        again.rename_collection("texts", "texts")
    assert again.list_collections().first()["active_count"] == 2 and again.remove_context("texts", "/")
    assert again.remove_collection("texts") and again.documents().count() == 0 and not again.remove_collection("texts")


def test_evidence_and_contexts(spark):
    scope = spark.createDataFrame([("b1", "d1", ["u1", "u2"]), ("b2", "d2", ["u3"])], "book_id string, document_id string, unit_ids array<string>")
    caps = spark.createDataFrame([("b1", "c1"), ("b1", "c0"), ("b2", "c2")], "book_id string, capability_id string")
    units = spark.createDataFrame([("u1", " text "), ("u3", " ")], "id string, text string")
    context = spark.createDataFrame([("u2",)], "unit_id string")
    got = sorted((r["evidence_id"], r["quote"]) for r in graph.evidence_rows(scope, caps, units, context).collect())
    assert got == [("c0:u2", None), ("c2:u3", None)]
    assert sorted((r["evidence_id"], r["quote"]) for r in graph.evidence_rows(scope, caps, units).collect())[0] == ("c0:u1", "text")
    m = spark.createDataFrame([(1, ["u1", "u9"])], "community int, text_unit_ids array<string>")
    details = spark.createDataFrame([(1, "u1", 4)], "community int, id string, degree int")
    assert sorted((r["unit_id"], r["degree"], r["missing"]) for r in graph.community_context(m, details, units).collect()) == [("u1", 4, False), ("u9", 0, True)]


def test_identities_and_targets(spark):
    ids = spark.createDataFrame([("h1", "d1"), ("h2", "d2"), ("h2", "d3")], "content_hash string, document_id string")
    r = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, None)], "id int, content_hash string")
    assert {x["id"]: x["document_id"] for x in graph.unique_identity(r, ids).collect()} == {1: "d1", 2: None, 3: None}
    rows = spark.createDataFrame([("k", None, 1), ("k", "x", 2), ("k", "y", 3)], "k string, v string, pos int")
    assert graph.merge_identities(rows, ["k"], ["v"], "pos").first()["v"] == "x"
    e = spark.createDataFrame([("b", "r1", 3), ("a", "r2", 1), ("b", "r0", 0), (None, "r", 0)], "t string, r string, pos int")
    assert [(x["t"], x["reports"]) for x in graph.deepening_targets(e, "t", "r", "pos", 1).collect()] == [("b", ["r0", "r1"])]
    f = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, content string")
    assert graph.directory_digest(f).first() == graph.directory_digest(f.orderBy(F.desc("path"))).first()


def test_store_writes_what_changed(spark, tmp_path):
    """Tables lie below any URI; an unchanged collection is not written, and folders that no state names go."""
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.md").write_text(f"# {name}\nThe harbour of {name}.")
    c = Corpus(spark, f"file://{tmp_path}/store")
    for name in ("one", "two"):
        c.add_collection(name, str(tmp_path / name))
    c.update()
    before = dict(c.state["tables"]["documents"])
    (tmp_path / "two" / "b.md").write_text("# B\nAnother harbour.")
    assert c.update() == {"unchanged": 2, "indexed": 1}
    after = c.state["tables"]["documents"]
    assert after["one"] == before["one"] and after["two"] != before["two"] and len(c.state["tables"]["content"]) == 3
    assert c.search_lex("harbour").count() == 3 and c.search_lex("another").count() == 1
    first = c.state["index"]["tables"]["index"]
    assert c.index().documents == 3 and c.state["index"]["tables"]["index"] == first
    c.cleanup()
    c.cleanup()
    kept = {n for n in c.folder.names() if "-" in n and not n.startswith(".")}
    assert kept == {*c._used(), *c.state["before"]} and c.content().count() == 3 and len(c.state["tables"]["content"]) == 1
    assert Corpus(spark, f"{tmp_path}/store").documents().count() == 3


def test_a_local_folder_is_refused_on_a_cluster(spark, tmp_path, monkeypatch):
    from corpuskiln.session import shared_dir
    from corpuskiln.sources.storage import Folder

    shared = shared_dir(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError):
        Folder(spark, str(tmp_path / "mine"))
    assert Folder(spark, f"{shared}/mine").names() == []


def test_configuration_and_expansions(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.md").write_text("# A\nThe old harbour.")
    asked = []

    def expander(query):
        asked.append(query)
        return [Search("lex", "harbour"), Search("vec", " Old  Boats")]

    c = Corpus(spark, str(tmp_path / "store"), expander=expander)
    config = {"notes": {"path": str(tmp_path / "src"), "contexts": {"/": "Notes"}}}
    assert c.configure(config) and not c.configure(config) and c.list_contexts() == [("notes", "/", "Notes")]
    assert c.configure({**config, "more": {"path": str(tmp_path / "src"), "default": False}}) and c.default_collections() == ["notes"]
    c.update(["notes"])
    for _ in range(2):
        assert c.search("old boats", skip_rerank=True).count() == 1
    assert asked == ["old boats"]
    assert query_document.expand("old boats", expander) == [Search("lex", "harbour")]
    c.state["index"]["version"] = 0
    before = c.state["index"]["tables"]["index"]
    assert c.index().documents == 1 and c.state["index"]["tables"]["index"] != before


def test_an_empty_scope_fails(spark):
    full, none = spark.range(1), spark.range(0)
    assert graph.checked_scope({"documents": full}) == {"documents": full}
    with pytest.raises(graph.ScopeError, match="no text units") as error:
        graph.checked_scope({"documents": full, "text_units": none, "entities": none})
    assert error.value.stage == "text_units"


def test_late_events_drop_out_of_a_stream(spark, tmp_path):
    """Counts come once the watermark has passed a window; rows older than the watermark are not counted any more."""
    from corpuskiln.streaming.reindex import windowed_counts

    def run(name, *rows):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(f'{{"ts": "2026-01-01T{t}:00Z", "kind": "{k}"}}' for t, k in rows))
        events = spark.readStream.schema("ts timestamp, kind string").json(str(tmp_path / "in"))
        counts = windowed_counts(events, "ts", "kind", "1 hour", "10 minutes").select(F.date_format("start", "HH").alias("hour"), "kind", "n")
        query = counts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
        assert query.awaitTermination(120)
        return {(r["hour"], r["kind"]): r["n"] for r in spark.read.schema("hour string, kind string, n bigint").parquet(str(tmp_path / "out")).collect()}

    run("a", ("08:10", "x"), ("08:50", "x"), ("09:05", "y"))
    got = run("b", ("10:30", "x"), ("08:55", "x"))
    got = run("c", ("08:20", "x"), ("12:00", "z"))
    assert got[("08", "x")] in (2, 3) and got[("09", "y")] == 1 and ("12", "z") not in got
    assert run("d", ("08:20", "x"), ("08:21", "x"))[("08", "x")] == got[("08", "x")]
