"""Queries that once stopped at a part of their input: the whole of it counts."""

import pytest

from corpuskiln.corpus import Corpus
from corpuskiln.operators import lexical
from corpuskiln.plans import graph_queries, store_queries

DOCUMENT = "doc_id bigint, document_id string, source string, path string, title string, text string, hash string, n_chars bigint, active boolean"


@pytest.fixture
def documents(spark, tmp_path):
    """Writes documents given as (doc_id, title, text) and returns their folder."""

    def write(*rows):
        full = [(i, f"d{i}", "s", f"s/{i}.md", title, text, f"h{i}", len(text), True) for i, title, text in rows]
        spark.createDataFrame(full, DOCUMENT).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return write


def test_a_late_word_is_found(spark, documents):
    d = documents((1, "A", "filler " * 400 + "harbour telescope glossary"), (2, "B", "filler harbour " * 300), (3, "C", "glossary"))
    scores = {r["report_id"]: r["score"] for r in graph_queries.report_search(spark, d).collect()}
    assert scores["d1"] == pytest.approx(3 / 5 + 2.826 / 100, abs=1e-3) and scores["d1"] > scores["d2"]
    tokens = {r["report_id"]: r["tokens"] for r in graph_queries.prompt_packing(spark, d).collect()}
    assert tokens == {"d1": 707, "d2": 1125, "d3": 2}


def test_more_than_four_are_expected(spark, documents):
    d = documents(*((i, "Kettle", "kettle") for i in range(12)), (20, "Other", "lamp"))
    assert graph_queries.unmatched_files(spark, d).count() == 2  # ten are found
    m = graph_queries.precision_recall_mrr(spark, d).first()
    assert (m["hits_at_k"], m["precision_at_k"], m["recall"]) == (10, 1.0, round(10 / 12, 6))


def test_inflected_words_are_found(spark, documents, tmp_path):
    d = documents((1, "A", "one notebook"), (2, "B", "two notebooks"), (3, "C", "calibration"), (4, "D", "kettle"))
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for searched, plain in ((docs, docs), (lexical.index(docs), lexical.index(docs, stem=False))):
        found = lambda q, **o: {r["doc_id"] for r in lexical.search(plain if o else searched, q, **o).collect()}
        assert found("notebooks") == {1, 2} and found("calibrating") == {3} and found("notebooks", stem=False) == {2}
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.md").write_text("# A\nA telescope.")
    for stem in (True, False):
        c = Corpus(spark, str(tmp_path / f"corpus{stem}"), stem=stem)
        c.add_collection("notes", str(tmp_path / "src"))
        c.update()
        assert c.search_lex("telescopes").count() == c.search("lex: telescopes", skip_rerank=True).count() == int(stem)


def test_secrets_in_texts_are_found(spark, documents):
    d = documents((1, "A", "filler " * 900 + "apiKey = 1"), (2, "Bearer abcdefgh12", "plain"), (3, "C", "at /Users/me/x"), (4, "D", "plain"), (9, "E", "plain"))
    got = {r["doc_id"]: r["reason"] for r in store_queries.sensitive_scan(spark, d).collect()}
    assert got == {1: "credential", 2: "bearer_token", 3: "absolute_path", 4: None, 9: None}
