import sqlite3

from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.functions.keys import canonical_key, fresh_name, instant, utc_month
from corpuskiln.functions.porter import stem
from corpuskiln.functions.udfs import book_slug, stable_json_hash, symbols_to_hex
from corpuskiln.operators import lookup


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).cast("string").alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("r")).first()["r"]


def test_canonical_key(spark):
    rows = [(" SHA256:AbC\t", "abc"), ("\u00a0abc\u200b", "abc"), ("", None), ("  ", None), ("sha256:", None), (None, None), ("sha256: x", "x")]
    got = spark.createDataFrame(rows, "a string, b string").select(canonical_key(F.col("a")).alias("g"), "b").collect()
    assert all(r["g"] == r["b"] for r in got)


def test_instants_and_months(spark):
    df = spark.createDataFrame([("2024-03-01T01:30:00.500+02:00",), ("2024-03-01T00:00:00Z",), ("no date",), (None,)], "t string")
    assert [r[0] for r in df.select(utc_month(instant(F.col("t")))).collect()] == ["2024-02", "2024-03", None, None]


def test_fresh_name_ignores_case(spark):
    assert fresh_name(spark.range(1).withColumn("__KEY", F.lit(1)), "key") == "__key_1"


def test_stems_equal_an_fts_index():
    words = "relational conditional valenci digitizer conformabli radicalli differentli vileli analogousli vietnamization predication operator feudalism decisiveness hopefulness callousness formaliti sensitiviti sensibiliti triplicate formative formalize electriciti electrical hopeful goodness revival allowance inference airliner adjustable defensible irritant replacement adjustment dependent adoption homologou communism activate angulariti homologous effective bowdlerize probate rate cease controll roll caresses ponies ties cats agreed plastered bled motoring sing conflated troubled sized hopping tanned falling hissing fizzed failing filing happy sky running runner performance notebooks calibrating a at oed y dying".split()
    db = sqlite3.connect(":memory:")
    db.execute("create virtual table t using fts5(x, tokenize='porter unicode61')")
    db.execute("create virtual table v using fts5vocab(t, 'instance')")
    db.executemany("insert into t(rowid, x) values (?, ?)", list(enumerate(words, 1)))
    assert {words[d - 1]: t for t, d in db.execute("select term, doc from v")} == {w: stem(w) for w in words}


def test_titles(spark):
    cases = [("# A b \nx", "n/f.md", "A b"), ("# Notes\n## Real\n", "f.md", "Real"), ("no heading", "a/b.c.md", "b.c"), ("#+TITLE: Org\n", "o.org", "Org"), ("* Star\n", "o.org", "Star"), ("# x", "f.txt", "f"), ("", ".md", ".md"), ("### deep", "g.md", "g")]
    got = spark.createDataFrame(cases, "b string, p string, w string").select(T.title_of(F.col("b"), F.col("p")).alias("g"), "w").collect()
    assert [r["g"] for r in got] == [r["w"] for r in got]


def test_slugs(spark):
    cases = [("a b/C d.md", "a-b/C-d.md"), ("x___y.md", "x/y.md"), ("---.md", None), ("", None), ("🐘.md", "1f418.md"), ("über größe!.md", "über-größe.md"), ("$id.md", "$id.md"), (None, None), ("a.b.c.md", "a-b-c.md")]
    got = spark.createDataFrame(cases, "p string, w string").select(T.path_slug(F.col("p")).alias("g"), "w").collect()
    assert [(r["g"]) for r in got] == [w for _, w in cases]


def test_virtual_paths_and_docids(spark):
    df = spark.createDataFrame([("store://c/a/b.md", "c", "a/b.md"), ("//c/x", "c", "x"), ("store:////c", "c", ""), ("c/x", None, None)], "v string, c string, r string")
    for r in df.select(T.virtual_collection(F.col("v")).alias("a"), "c", T.virtual_rest(F.col("v")).alias("b"), "r").collect():
        assert (r["a"], r["b"]) == (r["c"], r["r"])
    ids = spark.createDataFrame([("'#AB12cd'", "ab12cd"), ("#xyz", None), ("12", None)], "d string, w string")
    assert all(r[0] == r[1] for r in ids.select(T.normalized_docid(F.col("d")), "w").collect())


def test_paths(spark):
    df = spark.createDataFrame([("/a/b/c", "/a/b/", "c"), ("C:\\x\\y", "C:/x", "y"), ("/ab", "/a", None), ("/a", "/a", "")], "p string, r string, w string")
    assert all(r[0] == r[1] for r in df.select(T.relative_to(F.col("p"), F.col("r")), "w").collect())
    absolute = spark.createDataFrame([("/x", True), ("C:/x", True), ("x/y", False)], "p string, w boolean")
    assert all(r[0] == r[1] for r in absolute.select(T.is_absolute_path(F.col("p")), "w").collect())


def test_hashes(spark):
    assert one(spark, stable_json_hash(F.lit('{"b": 1, "a": [1, 2]}'))) == one(spark, stable_json_hash(F.lit('{"a":[1,2],"b":1}')))
    assert one(spark, stable_json_hash(F.lit("{"))) is None
    assert one(spark, book_slug(F.lit("Ça va, Ω?"))) == "ca-va" and one(spark, symbols_to_hex(F.lit("a☀b"))) == "a2600b"


def test_redaction_and_sensitive_text(spark):
    text = "Bearer abcdefgh1234 at https://x.y/z and /Users/me/a.txt sk-abcdefgh12"
    assert one(spark, T.redact(F.lit(text))) == "[redacted-token] at [redacted-url] and [redacted-path] [redacted-key]"
    assert one(spark, T.sensitive_reason(F.lit("plain"))) is None
    assert one(spark, T.failure_class(F.lit(None).cast("string"))) is None


def test_rounding_is_binary(spark):
    assert one(spark, T.rounded(F.lit(1.005), 2)) == 1.0 and one(spark, T.retry_delay_ms(F.lit(3))) == 4000


def test_globs_and_like():
    import re

    assert re.match(lookup.glob_pattern("**/{a,b}/*.m?"), "x/y/a/f.md") and not re.match(lookup.glob_pattern("*.md"), "a/b.md")
    assert re.match(lookup.glob_pattern("[!a]*"), "b") and re.match(lookup.like_pattern("A_%"), "axyz") and not re.match(lookup.like_pattern("Ä%"), "ä")


def test_snippets_and_lines(spark):
    body = "zero\nOne apple\ntwo\napple pear\nfour\nfive\nsix"
    s = one(spark, lookup.snippet(F.lit(body), "apple pear"))
    assert s["line"] == 4 and s["snippet"] == "@@ -3,4 @@ (2 before, 1 after)\ntwo\napple pear\nfour\nfive"
    assert one(spark, lookup.line_slice(F.lit(body), 2, 2)) == "One apple\ntwo" and one(spark, lookup.line_slice(F.lit(""), 5)) == ""
    assert one(spark, lookup.numbered_lines(F.lit("a\nb"), 7)) == "7: a\n8: b"
    assert one(spark, lookup.highlight(F.lit("An Apple"), "apple of")) == "An **Apple**"
