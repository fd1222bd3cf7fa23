"""Splitting oversized texts at natural boundaries, with an exact overlap.

Method. The text's code points become an array; prefix sums over it give every token's offset, and the places where a
token ends become sorted boundary arrays, one for each strength (paragraph, line or sentence, word, any blank). For each
piece a binary search finds the last boundary under the limit; the next piece starts ``overlap`` code points before that
end. Where a window holds no boundary at all, the piece is cut hard at the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.session import ship_package

#: Limit and overlap of a piece in code points.
LIMIT, OVERLAP = 3600, 540

# Marks that end a sentence before a blank, closing marks that may follow them, and the marks that end a
# sentence without any blank.
ENDERS, CLOSERS, WIDE_ENDERS = ".!?…:;", "\"')]}»”’", "。！？"

_SPACE = np.array([chr(i).isspace() for i in range(0x3002)])
_CUTS = "kind string, cuts array<struct<seq:int,pos:int,end:int,boundary:string>>"


def _in(codes: np.ndarray, marks: str) -> np.ndarray:
    return np.isin(codes, [ord(x) for x in marks])


def boundaries(text: str) -> tuple[dict[str, np.ndarray], int]:
    """Sorted cut offsets of each strength, strongest first, and the longest run without any boundary mark."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    space = np.zeros(n + 1, bool)
    space[:n] = _SPACE[np.minimum(codes, 0x3001)] & (codes < 0x3001)
    wide = np.append(_in(codes, WIDE_ENDERS), False)
    breaks = np.flatnonzero(space | wide)
    longest = int(np.diff(np.concatenate(([-1], breaks, [n]))).max()) - 1
    any_cut = breaks + 1
    done = any_cut[~space[np.minimum(any_cut, n)]]  # not inside a run of blanks
    ends = _in(codes, ENDERS)
    closed = _in(codes, CLOSERS)
    ends[1:] |= closed[1:] & ends[:-1]
    first = np.maximum.accumulate(np.where(space[:n], 0, np.arange(1, n + 1))) if n else np.zeros(0, int)  # end of the token before
    newlines = np.concatenate(([0], np.cumsum(codes == 10)))
    token_end = first[done - 1] if n else done
    lines = newlines[done] - newlines[token_end]
    sentence = wide[done - 1] | (np.append(ends, False)[np.maximum(token_end - 1, 0)] & (token_end > 0)) | (np.append(wide, False)[np.maximum(token_end - 1, 0)])
    return {"paragraph": done[lines >= 2], "sentence": done[(lines >= 1) | sentence], "word": done, "blank": any_cut}, longest


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[str, list[tuple[int, int, int, str]]]:
    """(kind, [(seq, pos, end, boundary)]) of a text; ``boundary`` says what the piece ends at.

    ``kind`` is ``fits`` for a text within the limit (one piece; none for an empty text), ``hard`` if the text holds a run
    longer than the limit without any boundary mark, else ``soft``. A paragraph or sentence end is preferred if it lies in
    the later half of the window, otherwise the last boundary of any strength is taken.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than the limit")
    n = len(text)
    if n <= limit:
        return "fits", [(0, 0, n, "end")] if n else []
    by_strength, longest = boundaries(text)
    pieces, start, before = [], 0, 0
    while n - start > limit:
        least, most = before, start + limit  # the end lies in (least, most]
        for strength, at in by_strength.items():
            i = int(np.searchsorted(at, most, side="right")) - 1
            weak = strength in ("word", "blank")
            if i >= 0 and at[i] > (least if weak else max(least, start + limit // 2)):
                end, why = int(at[i]), strength
                break
        else:
            end, why = most, "hard"
        pieces.append((len(pieces), start, end, why))
        before, start = end, max(end - overlap, 0)
    pieces.append((len(pieces), start, n, "end"))
    return "hard" if longest > limit else "soft", pieces


def cut_plan(df: DataFrame, text: str, keep: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns, ``kind`` and ``cuts`` of every row whose text exceeds the limit (null and shorter texts drop out).

    The filter runs in the scan's stage; one Arrow pass over the oversized texts follows, without any shuffle.
    """
    ship_package(df.sparkSession)
    over = df.where(F.length(F.col(text)) > limit).select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in over.drop("__text").schema) + ", " + _CUTS

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [cut(t, limit, overlap) for t in batch["__text"]]
            yield batch.drop(columns="__text").assign(kind=[k for k, _ in got], cuts=[[dict(zip(("seq", "pos", "end", "boundary"), p)) for p in ps] for _, ps in got])

    return over.mapInPandas(plan, schema)


def split_oversized(df: DataFrame, key: Column, text: str, order: Column, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of every oversized text: (key, seq, pos, n_chars, boundary, kind, total_chunks, text).

    Rows with one key are one body: the text of the smallest ``order`` is cut. Rows with a null key drop out. Every piece is
    within the limit; each but the first begins with the last ``overlap`` code points of the piece before.
    """
    bodies = df.where(F.length(F.col(text)) > limit).select(key.alias("key"), order.alias("o"), F.col(text).alias("t")).where("key is not null")
    bodies = bodies.groupBy("key").agg(F.min_by("t", F.struct("o", "t")).alias("t"))
    plans = cut_plan(bodies.withColumn("body", F.col("t")), "t", ["key", "body"], limit, overlap)
    pieces = plans.select("key", "body", "kind", F.size("cuts").alias("total_chunks"), F.explode("cuts").alias("c"))
    return pieces.select("key", "c.seq", "c.pos", (F.col("c.end") - F.col("c.pos")).alias("n_chars"), "c.boundary", "kind", "total_chunks", F.substr("body", F.col("c.pos") + 1, F.col("c.end") - F.col("c.pos")).alias("text"))
