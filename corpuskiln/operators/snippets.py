"""Snippets within a chosen chunk, with intent terms and the fallbacks for chunks that match nothing."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions.text import INTENT_STOP_WORDS

# Weight of an intent term, characters shown around a chunk, length of a chunk of unknown size.
INTENT_WEIGHT, MARGIN, CHUNK = 0.3, 100, 3600
TYPE = "line int, snippet string, lines_before int, lines_after int, snippet_lines int"


@dataclass(frozen=True)
class Snippet:
    line: int
    snippet: str
    lines_before: int
    lines_after: int
    snippet_lines: int


def intent_terms(intent: str) -> list[str]:
    """Terms of an intent: edge punctuation stripped, longer than one character, no stop words."""
    bare = (re.sub(r"^[\W_]+|[\W_]+$", "", t) for t in intent.lower().split())
    return [t for t in bare if len(t) > 1 and t not in INTENT_STOP_WORDS]


def snippet(body: str, query: str, most: int = 500, chunk_pos: int | None = None, chunk_len: int | None = None, intent: str | None = None) -> Snippet:
    """The best line with one line before and two after it, under a diff-style header.

    A query term counts 1 where a line contains it, an intent term 0.3; the first of equal lines wins. With a chunk only its
    lines (and 100 characters around) are searched. Where none matches, a chunk at 0 gives way to the whole body and a later one
    is shown from its start; a blank window gives way to the whole body as well.
    """
    in_chunk = chunk_pos is not None and chunk_pos >= 0
    begin = max(0, chunk_pos - MARGIN) if in_chunk else 0
    part = body[begin:chunk_pos + (chunk_len or CHUNK) + MARGIN] if in_chunk else body
    lines = part.split("\n")
    skipped = body.count("\n", 0, begin)
    wanted = [(t, 1.0) for t in query.lower().split()] + [(t, INTENT_WEIGHT) for t in intent_terms(intent or "")]
    scores = [sum(w for t, w in wanted if t in line.lower()) for line in lines]
    best = max(range(len(lines)), key=lambda i: (scores[i], -i))
    if in_chunk and scores[best] <= 0:
        if chunk_pos == 0:
            return snippet(body, query, most, intent=intent)
        best = part.count("\n", 0, chunk_pos - begin)
    start = max(0, best - 1)
    shown = lines[start:best + 3]
    text = "\n".join(shown)
    if in_chunk and chunk_pos > 0 and not text.strip():
        return snippet(body, query, most, intent=intent)
    text = text if len(text) <= most else text[:most - 3] + "..."
    first = skipped + start + 1
    after = body.count("\n") + 1 - (first + len(shown) - 1)
    return Snippet(skipped + best + 1, f"@@ -{first},{len(shown)} @@ ({first - 1} before, {after} after)\n{text}", first - 1, after, len(shown))


def snippets(body: Column, query: Column, chunk_pos: Column, chunk_len: Column, intent: Column, most: int = 500) -> Column:
    """``snippet`` of every row as a struct, in Arrow batches; null bodies and queries count as empty, a null chunk as none."""

    @F.pandas_udf(TYPE)
    def run(bodies: pd.Series, queries: pd.Series, positions: pd.Series, lengths: pd.Series, intents: pd.Series) -> pd.DataFrame:
        number = lambda x: None if pd.isna(x) else int(x)
        rows = [snippet(b or "", q or "", most, number(p), number(n), i) for b, q, p, n, i in zip(bodies, queries, positions, lengths, intents)]
        return pd.DataFrame([asdict(r) for r in rows], columns=[c.split()[0] for c in TYPE.split(", ")])

    return run(body, query, chunk_pos, chunk_len, intent)
