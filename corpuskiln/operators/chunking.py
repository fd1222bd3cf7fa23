"""Markdown-aware chunking by scored break points, and the choice of the best chunk.

The cut of a piece depends on where the piece before ended, so a document is cut by one vectorised Python call; documents are
independent, hence no shuffle. Positions count code points.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions.keys import fresh_name
from corpuskiln.session import ship_package

# Size, overlap and search window of a chunk in characters and in tokens, and the weight of distance.
SIZE, OVERLAP, WINDOW, DECAY = 3600, 540, 800, 0.7
TOKEN_SIZE, TOKEN_OVERLAP, TOKEN_WINDOW, CHARS_PER_TOKEN = 900, 135, 200, 3
# What a break looks like, how good it is and its name; of equal positions the better one counts.
BREAKS = [
    (r"\n#(?!#)", 100, "h1"), (r"\n##(?!#)", 90, "h2"), (r"\n###(?!#)", 80, "h3"), (r"\n####(?!#)", 70, "h4"), (r"\n#####(?!#)", 60, "h5"), (r"\n######(?!#)", 50, "h6"),
    (r"\n```", 80, "codeblock"), (r"\n(?:---|\*\*\*|___)\s*\n", 60, "hr"), (r"\n\n+", 20, "blank"), (r"\n[-*]\s", 5, "list"), (r"\n\d+\.\s", 5, "numlist"), (r"\n", 1, "newline"),
]
_BREAKS = [(re.compile(p), s, n) for p, s, n in BREAKS]
# Scores of syntax boundaries in source code.
SYNTAX = {"class": 100, "function": 90, "method": 90, "decorated": 90, "export": 90, "import": 60}

Break = tuple[int, int, str]


def break_points(text: str) -> list[Break]:
    """(position, score, kind) of every break, in order; the best kind at a position, the first listed of equal ones."""
    best: dict[int, tuple[int, str]] = {}
    for pattern, score, kind in _BREAKS:
        for m in pattern.finditer(text):
            if m.start() not in best or score > best[m.start()][0]:
                best[m.start()] = (score, kind)
    return [(p, *best[p]) for p in sorted(best)]


def code_fences(text: str) -> list[tuple[int, int]]:
    """(start, end) of fenced code; an unclosed fence runs to the end, one at the very start of the text is not seen."""
    marks = [m.start() for m in re.finditer(r"\n```", text)]
    return [(a, marks[i + 1] + 4 if i + 1 < len(marks) else len(text)) for i, a in enumerate(marks) if i % 2 == 0]


def merge_breaks(*lists: list[Break]) -> list[Break]:
    """All breaks, the better one at a position (the earlier list's of equal ones)."""
    best: dict[int, Break] = {}
    for b in (b for each in lists for b in each):
        if b[0] not in best or b[1] > best[b[0]][1]:
            best[b[0]] = b
    return [best[p] for p in sorted(best)]


def best_cut(breaks: list[Break], target: int, window: int = WINDOW, decay: float = DECAY, fences: list[tuple[int, int]] = ()) -> int:
    """Break with the best score after distance decay within the window before ``target``; ``target`` itself if none. Breaks
    within fenced code do not count."""
    usable = [(s * (1 - ((target - p) / window) ** 2 * decay), -p) for p, s, _ in breaks if target - window <= p <= target and not any(a < p < b for a, b in fences)]
    top = max(usable, default=(-1.0, 0))
    return -top[1] if top[0] > -1 else target


def chunk(text: str, size: int = SIZE, overlap: int = OVERLAP, window: int = WINDOW, breaks: list[Break] | None = None) -> list[tuple[int, str]]:
    """(position, piece) of a text: one piece up to ``size``, else pieces that end at the best break and repeat ``overlap``."""
    if len(text) <= size:
        return [(0, text)]
    breaks = break_points(text) if breaks is None else breaks
    fences = code_fences(text)
    out, start = [], 0
    while True:
        end = min(start + size, len(text))
        if end < len(text):
            at = best_cut(breaks, end, window, DECAY, fences)
            end = at if start < at <= end else end
        out.append((start, text[start:end]))
        if end >= len(text):
            return out
        start = end - overlap if end - overlap > start else end


def python_breaks(text: str) -> list[Break]:
    """Syntax breaks of Python source; none where it cannot be parsed."""
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError):
        return []
    starts, at = [0], 0
    for line in text.split("\n"):
        at += len(line) + 1
        starts.append(at)
    out = []
    for node in ast.walk(tree):
        kind = {ast.ClassDef: "class", ast.FunctionDef: "function", ast.AsyncFunctionDef: "function", ast.Import: "import", ast.ImportFrom: "import"}.get(type(node))
        if kind:
            line = min([node.lineno, *(d.lineno for d in getattr(node, "decorator_list", []))])
            out.append((max(starts[line - 1] - 1, 0), SYNTAX[kind], kind))
    return sorted(out)


# Line starts of definitions in other languages.
_LINE_SYNTAX = [(re.compile(r"(?m)^(?:export\s+)?(?:abstract\s+)?(?:class|interface|struct|enum|trait|impl)\s"), "class"), (re.compile(r"(?m)^(?:export\s+)?(?:async\s+)?(?:function|func|fn|pub fn)\s"), "function"), (re.compile(r"(?m)^export\s"), "export"), (re.compile(r"(?m)^(?:import|use|from)\s"), "import")]


def syntax_breaks(text: str, path: str) -> list[Break]:
    """Syntax breaks by file extension; none for other files."""
    if path.endswith(".py"):
        return python_breaks(text)
    if re.search(r"\.(ts|tsx|js|jsx|mjs|go|rs)$", path):
        return merge_breaks(*[[(max(m.start() - 1, 0), SYNTAX[kind], kind) for m in p.finditer(text)] for p, kind in _LINE_SYNTAX])
    return []


def chunk_by_tokens(text: str, count: Callable[[str], int] | None = None, size: int = TOKEN_SIZE, overlap: int = TOKEN_OVERLAP, window: int = TOKEN_WINDOW) -> list[tuple[int, str, int]]:
    """(position, piece, tokens): a first cut at three characters a token; pieces that still hold too many tokens are cut
    again, smaller by their excess. Without a tokenizer a token is three characters."""
    count = count or (lambda t: -(-len(t) // CHARS_PER_TOKEN))
    out = []

    def add(at: int, piece: str, chars: int) -> None:
        n = count(piece)
        if n <= size or len(piece) < 2:
            out.append((at, piece, n))
            return
        smaller = max(1, min(int(len(piece) * size / n * 0.95), len(piece) // 2 + 1, chars - 1))
        for p, t in chunk(piece, smaller, min(overlap * CHARS_PER_TOKEN, smaller // 4), min(window * CHARS_PER_TOKEN, smaller)):
            add(at + p, t, smaller)

    chars = size * CHARS_PER_TOKEN
    for p, t in chunk(text, chars, overlap * CHARS_PER_TOKEN, window * CHARS_PER_TOKEN):
        add(p, t, chars)
    return out


def chunk_documents(df: DataFrame, key: str, text: str, path: str | None = None, size: int = SIZE, overlap: int = OVERLAP, window: int = WINDOW) -> DataFrame:
    """(key, seq, pos, text) of every document; ``path`` adds syntax breaks by extension. Null texts have no chunk, an empty
    one a single empty chunk."""
    ship_package(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    source = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), (F.col(path) if path else F.lit("")).alias("p"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t, p in zip(batch["k"], batch["t"], batch["p"]):
                extra = syntax_breaks(t, p or "")
                pieces = chunk(t, size, overlap, window, merge_breaks(break_points(t), extra) if extra else None)
                rows += [(k, i, at, piece) for i, (at, piece) in enumerate(pieces)]
            yield pd.DataFrame(rows, columns=["k", "seq", "pos", "text"])

    return source.mapInPandas(cut, f"k {kind}, seq int, pos int, text string").withColumnRenamed("k", key)


def best_chunk(chunks: DataFrame, key: str, query: str, intent_terms: list[str] | None = None) -> DataFrame:
    """(key, seq, score) of each document's best chunk: query terms of three or more characters that it contains, plus half a
    point per intent term; the first of equal ones. A partial aggregation, no window."""
    terms = [t for t in query.lower().split() if len(t) > 2]
    low = F.lower("text")
    score = sum((F.contains(low, F.lit(t)).cast("double") for t in terms), F.lit(0.0)) + sum((F.contains(low, F.lit(t)).cast("double") * 0.5 for t in intent_terms or []), F.lit(0.0))
    return chunks.select(key, "seq", score.alias("score")).groupBy(key).agg(F.min_by(F.struct("seq", "score"), F.struct(-F.col("score"), F.col("seq"))).alias("b")).select(key, "b.seq", "b.score")


def chunk_id(hash_: Column, seq: Column) -> Column:
    return F.concat(F.lit("chunk:"), hash_, F.lit(":"), seq.cast("string"))


def pack_batches(sizes: DataFrame, order: str, size: str, most_items: int = 64, most_bytes: int = 64 << 20, group: str | None = None) -> DataFrame:
    """``batch`` number of each row when rows are taken in order into batches of bounded items and bytes.

    A greedy fold is sequential, so rows are folded per ``group`` (such as a shard), null being a group too. Rows stream past in order: a task
    holds one Arrow batch, whatever the size of a group. A row above the byte bound is alone; a null size counts nothing.
    """
    ship_package(sizes.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sizes.schema) + ", batch int"
    key, first = fresh_name(sizes, "key"), fresh_name(sizes, "first")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = items = room = 0
        for frame in frames:
            numbers = []
            for begins, n in zip(frame[first], frame[size].fillna(0)):
                if begins:
                    batch = items = room = 0
                elif items and (items >= most_items or room + n > most_bytes):
                    batch, items, room = batch + 1, 0, 0
                items, room = items + 1, room + n
                numbers.append(batch)
            yield frame.drop(columns=[first]).assign(batch=numbers)

    keyed = sizes.withColumn(key, F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit("")) if group else F.lit(""))
    before = F.lag(F.lit(False), 1, True).over(Window.partitionBy(key).orderBy(order))
    return keyed.withColumn(first, before).drop(key).mapInPandas(fold, fields)
