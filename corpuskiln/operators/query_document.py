"""Query documents: typed search lines, an intent, or one plain text to be expanded."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.keys import trim_blanks
from corpuskiln.operators.fusion import Search
from corpuskiln.operators.lexical import QueryError, validate_lexical, validate_semantic


@dataclass(frozen=True)
class QueryDocument:
    searches: list[Search] = field(default_factory=list)
    intent: str | None = None


def parse(text: str) -> QueryDocument | None:
    """The document's searches and intent; None for an empty text and for one that is to be expanded (a single plain line, or
    one ``expand:`` line)."""
    lines = [(n, line.strip()) for n, line in enumerate(text.split("\n"), 1) if line.strip()]
    searches, intent = [], None
    for n, line in lines:
        m = re.match(r"(lex|vec|hyde|intent|expand):\s*(.*)$", line, re.I | re.S)
        kind, rest = (m.group(1).lower(), m.group(2).strip()) if m else ("", line)
        if kind == "expand":
            if len(lines) > 1:
                raise QueryError(f"Line {n}: expand: must be the only line of a query document.")
            if not rest:
                raise QueryError("expand: must include text.")
            return None
        if not kind:
            if len(lines) == 1:
                return None
            raise QueryError(f"Line {n} has no lex:, vec:, hyde: or intent: prefix.")
        if not rest:
            raise QueryError(f"Line {n}: {kind}: must include text.")
        if kind == "intent":
            if intent is not None:
                raise QueryError(f"Line {n}: only one intent: line is allowed.")
            intent = rest
            continue
        (validate_lexical if kind == "lex" else validate_semantic)(rest)
        searches.append(Search(kind, rest))
    if intent and not searches:
        raise QueryError("intent: needs at least one lex:, vec: or hyde: line.")
    return QueryDocument(searches, intent) if searches else None


def expansions(policy: DataFrame, query: str, most: int = 6) -> list[Search]:
    """Expansion lines that a policy table (query, output) holds for a query, compared without case and spacing; variants equal
    to the query drop out. A single row is fetched."""
    norm = lambda c: F.lower(F.regexp_replace(trim_blanks(c), r"\s+", " "))
    row = policy.where(norm(F.col("query")) == norm(F.lit(query))).orderBy("query").limit(1).select("output").first()
    found = [Search(x["type"], x["text"]) for x in (row["output"] or [] if row else []) if x["text"] and x["text"].strip().lower() != query.strip().lower()]
    return found[:most]


def fallback_expansions(query: str) -> list[Search]:
    """What is searched where no expansion is at hand."""
    return [Search("hyde", f"Information about {query}"), Search("lex", query), Search("vec", query)]


def expand(query: str, expander, folder=None, model: str = "default") -> list[Search]:
    """The expander's searches for a query, without those that only repeat it; kept in ``folder`` and taken from there next time."""
    from hashlib import sha256

    name = f"expansion-{sha256(f'{model}\x1f{query}'.encode()).hexdigest()}.json"
    found = folder.read_json(name) if folder is not None else None
    if found is None:
        found = [[s.type, s.query] for s in expander(query) if " ".join(s.query.lower().split()) != " ".join(query.lower().split())]
        if folder is not None:
            folder.write_json(name, found)
    return [Search(*x) for x in found]
