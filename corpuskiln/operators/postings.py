"""Lexical search from an inverted index: a search reads the rows of its own terms and no text.

The index has a row per term and document with the document's length and the term's positions by field, so a search needs no
join. Written sorted by term (``Corpus.index`` does), a scan for a few terms or a prefix skips all other row groups.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.porter import stem as stem_word
from corpuskiln.functions.text import token_total
from corpuskiln.operators import lexical
from corpuskiln.operators.ranking import with_rank
from corpuskiln.session import spread, stage_table

#: Version of the analysis of texts; an index made by another one has to be built anew.
VERSION = 1
SCHEMA = "term string, doc_id bigint, source string, length double, path array<int>, title array<int>, body array<int>"


@dataclass(frozen=True)
class Index:
    """``terms`` (of ``SCHEMA``), the number of documents (also those without any token), their mean length, and whether terms are stems."""

    terms: DataFrame
    documents: int
    mean: float
    stem: bool


def _placed(field: str) -> Column:
    """Tokens of an analysed field with their places."""
    tokens = F.filter(F.split(F.trim(F.col(f"__{field}")), "  "), lambda t: t != "")
    return F.transform(tokens, lambda t, i: F.struct(t.alias("term"), i.alias("at"), F.lit(field).alias("field")))


def build(docs: DataFrame, stem: bool = True, fields: dict[str, str] = lexical.FIELDS) -> Index:
    """The index of the active documents (doc_id, source and the fields' columns). Null fields are empty, an empty table has an
    empty index. Tokens are counted per document before they are shuffled."""
    active = docs.where("active") if "active" in docs.columns else docs
    read = lexical.analyse(spread(active.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), *dict.fromkeys(fields.values()))), fields, stem)
    length = sum((token_total(F.col(f"__{f}")) for f in fields), F.lit(0)).cast("double")
    read = stage_table(read.select("doc_id", "source", length.alias("length"), *(f"__{f}" for f in fields)), "analysed")
    facts = read.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    tokens = F.concat(*map(_placed, fields))
    each = read.select("doc_id", "source", "length", F.explode(tokens).alias("t")).select("doc_id", "source", "length", "t.*")
    terms = each.groupBy("term", "doc_id", "source", "length").agg(*(F.sort_array(F.collect_list(F.when(F.col("field") == f, F.col("at")))).alias(f) for f in fields))
    return Index(terms, facts["n"], facts["mean"] or 1.0, stem)


def _starts(places: list[Column]) -> Column:
    """Starts of a phrase from its tokens' places: where every token stands at its distance from the first."""
    return F.filter(places[0], lambda x: reduce(lambda a, b: a & b, (F.array_contains(p, x + i) for i, p in enumerate(places[1:], 1)), F.lit(True)))


def _apart(starts: Column, size: int) -> Column:
    """How many of the sorted starts can be taken without two phrases overlapping."""
    step = lambda s, x: F.when(x >= s["free"], F.struct((s["n"] + 1).alias("n"), (x + size).alias("free"))).otherwise(s)
    return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("free")), step)["n"]


def _hits(index: Index, phrase: lexical.Phrase, weights: dict[str, float]) -> DataFrame:
    """(doc_id, source, length, f): weighted occurrences of a phrase in each document that holds it."""
    words = [stem_word(t) if index.stem else t for t in phrase.tokens]
    key = ["doc_id", "source", "length"]
    if len(words) == 1:
        term = F.col("term")
        found = index.terms.where(term.startswith(words[0]) if phrase.prefix else term == words[0])
        f = sum((F.lit(float(w)) * F.size(field) for field, w in weights.items()), F.lit(0.0))
        return found.groupBy(*key).agg(F.sum(f).alias("f"))
    found = index.terms.where(F.col("term").isin(*dict.fromkeys(words)))
    place = lambda field, w: F.coalesce(F.max(F.when(F.col("term") == w, F.col(field))), F.array().cast("array<int>"))
    wide = found.groupBy(*key).agg(*(place(field, w).alias(f"{field}_{i}") for field in weights for i, w in enumerate(words)))
    f = sum((F.lit(float(weight)) * _apart(_starts([F.col(f"{field}_{i}") for i in range(len(words))]), len(words)) for field, weight in weights.items()), F.lit(0.0))
    return wide.select(*key, f.alias("f")).where("f > 0")


def search(index: Index, query: str, *, limit: int = 20, collection: str | None = None, overfetch: int = 10, min_score: float = 0.0, weights: dict[str, float] | None = None) -> DataFrame:
    """Top rows (doc_id, source, raw, score, rank): what ``lexical.search`` gives over the same documents.

    With a collection, ``limit * overfetch`` best rows are taken first and filtered then. A query without searchable terms gives no rows.
    """
    weights = weights or lexical.WEIGHTS
    phrases = lexical.parse_query(query)
    positive, negative = ([p for p in phrases if p.negated == no] for no in (False, True))
    best = [F.col("raw").desc(), F.col("doc_id")]
    if not positive:
        nothing = index.terms.where("false").select("doc_id", "source", F.lit(0.0).alias("raw"), F.lit(0.0).alias("score"))
        return with_rank(nothing, best)
    hits = reduce(DataFrame.unionByName, (_hits(index, p, weights).withColumn("i", F.lit(i)) for i, p in enumerate([*positive, *negative])))
    hits = stage_table(hits, "hits")
    holding = {r["i"]: r["count"] for r in hits.groupBy("i").count().collect()}  # a row per phrase
    wide = hits.groupBy("doc_id", "source", "length").agg(*(F.max(F.when(F.col("i") == i, F.col("f"))).alias(f"f{i}") for i in range(len(phrases))))
    raw, every = F.lit(0.0), F.lit(True)
    for i in range(len(positive)):
        idf = math.log((index.documents - holding.get(i, 0) + 0.5) / (holding.get(i, 0) + 0.5))
        f = F.col(f"f{i}")
        raw = raw + F.lit(idf if idf > 0 else lexical.LEAST_IDF) * f * (lexical.K1 + 1) / (f + lexical.K1 * (1 - lexical.B + lexical.B * F.col("length") / F.lit(index.mean)))
        every = every & f.isNotNull()
    for i in range(len(positive), len(phrases)):
        every = every & F.col(f"f{i}").isNull()
    found = wide.where(every).select("doc_id", "source", raw.alias("raw")).withColumn("score", F.col("raw") / (1 + F.col("raw")))
    if collection is not None:
        found = found.orderBy(*best).limit(limit * overfetch).where(F.col("source") == collection)
    return with_rank(found.where(F.col("score") >= min_score).orderBy(*best).limit(limit), best)
