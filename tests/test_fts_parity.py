import sqlite3

import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import lexical

QUERIES = [("harbour telescope", '"harbour"* AND "telescope"*'), ("calibrating notebooks", '"calibrating"* AND "notebooks"*'), ('"nothing about"', '"nothing about"'), ("harbour -telescope", '"harbour"* NOT "telescope"*'), ('translat -"the old harbour"', '"translat"* NOT "the old harbour"'), ("follow-up", '"follow up"')]


@pytest.mark.parametrize("stem", [False, True])
def test_scores_equal_a_full_text_index(spark, data, stem):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("active and lang = 'en'").where(~F.coalesce("text", F.lit("")).rlike(r"\p{IsHan}"))
    rows = [(r["doc_id"], r["path"] or "", r["title"] or "", r["text"] or "") for r in docs.collect()]
    db = sqlite3.connect(":memory:")
    db.execute(f"create virtual table t using fts5(path, title, body, tokenize='{'porter ' if stem else ''}unicode61')")
    db.executemany("insert into t(rowid, path, title, body) values (?, ?, ?, ?)", rows)
    found = 0
    for query, match in QUERIES:
        want = {i: -s for i, s in db.execute("select rowid, bm25(t, 1.5, 4.0, 1.0) from t where t match ?", (match,))}
        got = {r["doc_id"]: r["raw"] for r in lexical.bm25(docs, query, ["doc_id"], lexical.FIELDS, stem=stem).collect()}
        assert set(got) == set(want), query
        assert all(abs(got[i] - want[i]) < 1e-9 for i in got), query
        found += len(got)
    assert found > 20
