"""Lexical search: query parser, fielded BM25 over whole texts (``postings`` searches an inverted index instead).

One search reads the analysed texts once and keeps a narrow row per document that holds any query phrase; document frequency,
document count and mean length come from one aggregation over the same rows, so no shuffle carries text.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.porter import stem as stem_word
from corpuskiln.functions.text import ACCENTED, PLAIN, occurrences, token_string, token_total
from corpuskiln.session import spread, stage_table

# Saturation and length constants of BM25, and the smallest inverse document frequency.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
#: Weights of the searched fields.
WEIGHTS = {"path": 1.5, "title": 4.0, "body": 1.0}
#: Column of each searched field.
FIELDS = {"path": "path", "title": "title", "body": "text"}
_CJK = re.compile(r"[一-鿿㐀-䶿豈-﫿぀-ヿ가-힯]")


class QueryError(ValueError):
    """A search text that cannot be run; the message is for the user."""


@dataclass(frozen=True)
class Phrase:
    """Adjacent tokens; ``prefix`` lets the (only) token stand for all that begin with it."""

    tokens: tuple[str, ...]
    prefix: bool
    negated: bool

    def needle(self, stem: bool = False) -> str:
        words = [stem_word(t) if stem else t for t in self.tokens]
        return f" {words[0]}" if self.prefix and len(words) == 1 else " " + "  ".join(words) + ("" if self.prefix else " ")


def query_tokens(text: str) -> tuple[str, ...]:
    """Tokens of a query part, by the rules of ``token_string``."""
    folded = text.lower().translate(str.maketrans(ACCENTED, PLAIN))
    return tuple(re.findall(r"[^\W_]+", _CJK.sub(lambda m: f" {m.group()} ", folded)))


def parse_query(query: str) -> list[Phrase]:
    """Phrases of a lexical query; empty if nothing can be searched.

    Blanks separate terms; a term matches as prefix. ``"..."`` is an exact phrase, ``-`` before a term or phrase excludes it.
    A hyphenated term is a phrase of its parts, a term with CJK characters one of its characters. Texts with exclusions only
    cannot be searched.
    """
    found = []
    for minus, quoted, term in re.findall(r'(-?)(?:"([^"]*)"?|([^\s"]+))', query.strip()):
        if term and not quoted:
            if not minus and term.startswith("-"):
                minus, term = "-", term[1:]
            kept = re.sub(r"[^\w']", "", term) if not re.fullmatch(r"\w[\w']*(?:-\w[\w']*)+", term) else term
            tokens = query_tokens(kept)
            exact = kept is term and "-" in term or bool(_CJK.search(term))
        else:
            tokens, exact = query_tokens(quoted), True
        if tokens:
            found.append(Phrase(tokens, not exact, bool(minus)))
    return found if any(not p.negated for p in found) else []


def validate_lexical(query: str) -> None:
    """A lexical query is one line with closed quotes."""
    if "\n" in query or "\r" in query:
        raise QueryError("A lexical query must be a single line.")
    if query.count('"') % 2:
        raise QueryError("A lexical query has an unmatched double quote.")


def validate_semantic(query: str) -> None:
    """Exclusions have no meaning in semantic search."""
    if re.search(r'(^|\s)-[\w"]', query):
        raise QueryError("Exclusion (-term) is not supported in semantic queries.")


def analyse(docs: DataFrame, fields: dict[str, str], stem: bool = False) -> DataFrame:
    """``docs`` with a token string ``__<field>`` per field (field -> column)."""
    from corpuskiln.functions.udfs import stemmed

    strings = {f"__{f}": (stemmed(token_string(F.col(c))) if stem else token_string(F.col(c))) for f, c in fields.items()}
    return docs.withColumns(strings)


def bm25(docs: DataFrame, query: str, keep: list[str], fields: dict[str, str], *, weights: dict[str, float] | None = None, stem: bool = True, staged: bool = True) -> DataFrame:
    """Matching rows with ``raw`` (the BM25 sum, higher is better) and ``score`` = raw / (1 + raw).

    Every positive phrase must occur in some field, no negated one in any. A phrase's document frequency counts rows that hold
    it; the length of a row is its tokens over all fields. A query without searchable terms gives no rows. Null fields are
    empty. Ties are left to the caller's order.
    """
    weights = weights or WEIGHTS
    phrases = parse_query(query)
    positive = [p for p in phrases if not p.negated]
    names = [f"__{f}" for f in fields]
    read = docs if set(names) <= set(docs.columns) else analyse(spread(docs), fields, stem)

    def hits(p: Phrase) -> list[Column]:
        return [occurrences(F.col(n), p.needle(stem)) for n in names]

    zero = F.lit(0.0)
    counted = read.select(
        *keep,
        sum((token_total(F.col(n)) for n in names), F.lit(0)).cast("double").alias("__d"),
        *(sum((F.lit(float(weights[f])) * h for f, h in zip(fields, hits(p))), zero).alias(f"__f{i}") for i, p in enumerate(positive)),
        _any([h > 0 for p in phrases if p.negated for h in hits(p)]).alias("__no"),
    )
    if not positive:
        return counted.limit(0).select(*keep, zero.alias("raw"), zero.alias("score"))
    if staged:
        counted = stage_table(counted, "bm25")
    facts = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("__d").alias("mean"), *(F.count_if(F.col(f"__f{i}") > 0).alias(f"n{i}") for i in range(len(positive)))).first()
    mean = facts["mean"] or 1.0
    raw = zero
    for i in range(len(positive)):
        idf = math.log((facts["n"] - facts[f"n{i}"] + 0.5) / (facts[f"n{i}"] + 0.5))
        f = F.col(f"__f{i}")
        raw = raw + F.lit(idf if idf > 0 else LEAST_IDF) * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("__d") / F.lit(mean)))
    every = F.lit(True)
    for i in range(len(positive)):
        every = every & (F.col(f"__f{i}") > 0)
    return counted.where(every & ~F.col("__no")).select(*keep, raw.alias("raw")).withColumn("score", F.col("raw") / (1 + F.col("raw")))


def index(docs: DataFrame, keep: list[str] = ["doc_id", "source"], fields: dict[str, str] = FIELDS, stem: bool = True) -> DataFrame:
    """The active documents' token strings as a staged table: analysed once, it serves any number of searches with its ``stem``."""
    active = docs.where("active") if "active" in docs.columns else docs
    read = analyse(spread(active.select(*dict.fromkeys([*keep, *fields.values()]))), fields, stem)
    return stage_table(read.select(*keep, *(f"__{f}" for f in fields)), "index")


def search(docs: DataFrame, query: str, *, limit: int = 20, collection: str | None = None, overfetch: int = 10, exact_filter: bool = False, min_score: float = 0.0, stem: bool = True, id_col: str = "doc_id", collection_col: str = "source") -> DataFrame:
    """Top rows of active documents, or of an ``index`` of them: (id, collection, raw, score, rank).

    With a collection, ``limit * overfetch`` best rows are taken first and filtered then, so fewer than ``limit`` may come back;
    ``exact_filter`` filters first. Equal scores are ordered by id. Texts and query terms, prefixes too, are stemmed unless
    ``stem`` is False; an index must have been made with the same ``stem``.
    """
    keep = [id_col, collection_col]
    active = docs.where("active") if "active" in docs.columns else docs
    if exact_filter and collection is not None:
        active = active.where(F.col(collection_col) == collection)
    best = [F.col("raw").desc(), F.col(id_col)]
    found = bm25(active, query, keep, FIELDS, stem=stem)
    if collection is not None and not exact_filter:
        found = found.orderBy(*best).limit(limit * overfetch).where(F.col(collection_col) == collection)
    from corpuskiln.operators.ranking import with_rank

    return with_rank(found.where(F.col("score") >= min_score).orderBy(*best).limit(limit), best)


def document_frequency(docs: DataFrame, text: str) -> DataFrame:
    """(term, df, cf): documents and occurrences of each term. A document's terms are sorted within its row, where the first of equal
    ones counts for the document, so there is one shuffle, on the term, after map-side counts."""
    terms = F.sort_array(F.filter(F.split(F.trim(token_string(F.col(text))), "  "), lambda t: t != ""))
    marked = docs.select(terms.alias("t")).select(F.explode(F.arrays_zip(F.col("t").alias("term"), F.concat(F.array(F.lit(None).cast("string")), F.col("t")).alias("before"))).alias("x"))
    rows = marked.select("x.term", "x.before").where("term is not null")
    return rows.groupBy("term").agg(F.count_if(~F.col("term").eqNullSafe(F.col("before"))).alias("df"), F.count(F.lit(1)).alias("cf"))


def _any(conditions: list[Column]) -> Column:
    whole = F.lit(False)
    for c in conditions:
        whole = whole | c
    return whole
