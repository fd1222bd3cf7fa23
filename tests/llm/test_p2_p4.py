import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskiln.llm import format_dedup as fd
from corpuskiln.llm import splitting


def forms(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, q string")
    return [r[0] for r in df.select(fd.canonical_query(F.col("q")).alias("f")).collect()]


def test_canonical_forms(spark):
    a = forms(spark, ["Lunch with Jo's dog!", "lunch  WITH jos_dog", "“lunch with Jo’s dog”", "lunch with jo dog", "résumé", "resume", "C++ F#", "c++,f#", None, "", "?!"])
    assert a[0] == a[1] == a[2] != a[3] and a[4] != a[5] and a[6] == a[7] and a[8] is None and a[9] == a[10]
    b = forms(spark, ["who: Jo; topic: C++", "TOPIC:c++ |who : jo.", "topic: c++\nwho: jo\n\n", "who jo topic c++", "who: jo", "who: jo; c++", "who: jo; who: jo", "who: jo; 1: x"])
    assert b[0] == b[1] == b[2] and b[0] != b[3] and b[4].startswith("P") and b[5].startswith("P") and b[6].startswith("L") and b[7].startswith("P")


def test_reordered_records(spark):
    df = spark.createDataFrame([("a b", None, "C"), ("c", "A-B", None), ("c", "a", "b")], "x string, y string, z string")
    r = [x[0] for x in df.select(fd.canonical_record([F.col("x"), F.col("y"), F.col("z")])).collect()]
    assert r[0] == r[1] != r[2]


@pytest.mark.parametrize("bits", [1 << 15, 1 << 20])
def test_copies_against_brute_force(spark, bits):
    rng = random.Random(5)
    rows = [(i, None if rng.random() < 0.02 else "hot query" if rng.random() < 0.33 else f"q {rng.randrange(3000)}") for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, q string").withColumns({"form": F.lit(1), "keep": F.lit(2), "h": F.lit(3)}).repartition(7)
    records, surplus = fd.collapse_copies(df, fd.words_of(F.col("q")), F.col("id"), bits)
    groups = {}
    for i, q in rows:
        if q is not None:
            groups.setdefault(q, []).append(i)
    assert {(r["keep"], r["n_copies"]) for r in records.collect()} == {(min(g), len(g)) for g in groups.values()}
    assert {(r["keep"], r["copy"]) for r in surplus.collect()} == {(min(g), i) for g in groups.values() for i in g if i != min(g)}


def test_copies_in_hash_ranges(spark):
    """Filters by hash range give what one filter gives, for orders that are structs too."""
    rows = [(i, f"q {i % 700}" if i % 3 else "hot") for i in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, q string").repartition(4)
    want = fd.collapse_copies(df, F.col("q"), F.col("id"))
    got = fd.collapse_copies(df, F.col("q"), F.struct(F.lit("t").alias("tbl"), "id"), most_bits=16000)
    assert {(r["keep"]["id"], r["n_copies"]) for r in got[0].collect()} == {(r["keep"], r["n_copies"]) for r in want[0].collect()}
    assert {(r["keep"]["id"], r["copy"]["id"]) for r in got[1].collect()} == {(r["keep"], r["copy"]) for r in want[1].collect()} and want[1].count() > 3000


def test_forms_that_share_a_hash(spark, monkeypatch):
    """Where two forms have one hash, the text decides."""
    monkeypatch.setattr(fd.F, "xxhash64", lambda c: F.length(c).cast("bigint"))
    df = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "aa"), (4, "bb"), (5, "ccc"), (6, "ccc"), (7, "d")], "id bigint, q string")
    records, surplus = fd.collapse_copies(df, F.col("q"), F.col("id"))
    assert {(r["canonical"], r["keep"], r["n_copies"]) for r in records.collect()} == {("aa", 1, 2), ("bb", 2, 2), ("ccc", 5, 2), ("d", 7, 1)}
    assert {(r["keep"], r["copy"]) for r in surplus.collect()} == {(1, 3), (2, 4), (5, 6)}


def test_copies_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, q string")
    records, surplus = fd.collapse_copies(df, F.col("q"), F.col("id"))
    assert records.count() == surplus.count() == 0


TEXT = st.text(alphabet="ab .\n。é😀　!", max_size=300) | st.text(alphabet="x", min_size=0, max_size=300)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(2, 60), st.floats(0, 0.9))
def test_pieces(text, limit, share):
    overlap = int(share * (limit - 1))
    kind, pieces = splitting.cut(text, limit, overlap)
    assert "".join(text[a if not i else pieces[i - 1][2]:b] for i, a, b, _ in pieces) == text
    for i, a, b, why in pieces:
        assert b - a <= limit and (not i or a == max(pieces[i - 1][2] - overlap, 0))
        window = text[(pieces[i - 1][2] if i else 0):a + limit]
        if why == "hard":
            assert not re.search(r"[\s。！？]", window)
        elif why != "end":
            assert re.match(r"[\s。！？]", text[b - 1])
    if len(text) > limit:
        assert kind == ("hard" if re.search(r"[^\s。！？]{%d,}" % (limit + 1), text) else "soft")


def test_paragraphs_and_sentences_come_first():
    text = "a" * 60 + ".\n\n" + "b " * 30 + "c. d" + " e" * 40
    assert splitting.cut(text, 100, 10)[1][0][3] == "paragraph" and splitting.cut(text, 62, 0)[1][0][3] in ("word", "blank", "hard")


def test_split_frames(spark):
    rows = [("h1", "x" * 5000, 1), ("h1", "x" * 5000, 2), ("h2", "word " * 2000, 1), ("h3", None, 1), (None, "y" * 9000, 1), ("h4", "", 1), ("h5", "z" * 3600, 1), ("h6", "w" * 300000, 1)]
    df = spark.createDataFrame(rows, "hash string, doc string, at int").withColumn("body", F.lit(0))
    pieces = splitting.split_oversized(df, F.col("hash"), "doc", F.col("at")).collect()
    assert {p["key"] for p in pieces} == {"h1", "h2", "h6"} and all(len(p["text"]) == p["n_chars"] <= 3600 for p in pieces)
    by = sorted((p for p in pieces if p["key"] == "h2"), key=lambda p: p["seq"])
    assert [p["seq"] for p in by] == list(range(by[0]["total_chunks"])) and all(b["text"][:540] == a["text"][-540:] for a, b in zip(by, by[1:]))
    assert {p["kind"] for p in pieces if p["key"] == "h1"} == {"hard"} and {p["kind"] for p in by} == {"soft"}
    assert splitting.split_oversized(df.limit(0), F.col("hash"), "doc", F.col("at")).count() == 0
