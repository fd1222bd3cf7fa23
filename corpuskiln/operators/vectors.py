"""Exact cosine nearest neighbours over chunk vectors: one query in one pass, many queries by a blocked join."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.operators.ranking import first_per_key, top_per_group, with_rank
from corpuskiln.session import ship_package

#: Bytes of the vectors that a task holds at once, and the queries that it compares with them at once.
BLOCK_BYTES, QUERIES = 64 << 20, 64


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine in double; infinite for a zero norm or different sizes, null for null."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(a.isNull() | b.isNull(), None).when((F.size(a) != F.size(b)) | (norms == 0), F.lit(float("inf"))).otherwise(1 - dot(a, b) / norms)


def check_dimension(df: DataFrame, embedding: str, n: int) -> DataFrame:
    """The frame, failing on a vector whose size is not ``n``."""
    message = F.concat(F.lit(f"embedding dimension mismatch: expected {n}, got "), F.size(embedding).cast("string"))
    return df.withColumn(embedding, F.when(F.size(embedding) == n, F.col(embedding)).otherwise(F.raise_error(message).cast(df.schema[embedding].dataType)))


def nearest(vectors: DataFrame, id_col: str, embedding: str, queries: DataFrame, query_id: str, query_vector: str, k: int, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, id, distance, rank) of the ``k`` nearest vectors of each query; ties by id.

    Vectors are dealt into blocks by a hash of their id; every query goes to every block. A task holds one block and streams the
    queries past it, so nothing passes through the driver and memory is bounded whatever the numbers of vectors and queries.
    Each block keeps its ``k`` best per query, so what is shuffled after that is ``queries * blocks * k`` narrow rows. Null vectors, zero norms
    and other sizes are at infinite distance and never come back. Ids are integers.
    """
    ship_package(vectors.sparkSession)
    size = F.size(F.col(embedding))
    known = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(size > 0, size)), F.lit(0)).alias("numbers")).first()
    blocks = max(1, -(-known["numbers"] * 8 // block_bytes), min(vectors.sparkSession.sparkContext.defaultParallelism, known["n"] // 1000))
    stored = vectors.select(F.pmod(F.xxhash64(F.col(id_col).cast("bigint")), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asked"), F.col(id_col).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asked"), F.col(query_id).cast("bigint").alias("id"), F.col(query_vector).cast("array<double>").alias("v"))
    dealt = stored.unionByName(asked).where("v is not null").repartition(blocks, "block").sortWithinPartitions("block", "asked")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready = None, [], {}
        for batch in batches:
            number, is_query, ids = (np.array(batch.column(i)) for i in range(3))
            starts = np.flatnonzero(np.concatenate(([True], (number[1:] != number[:-1]) | (is_query[1:] != is_query[:-1])))) if len(number) else []
            for first, last in zip(starts, [*starts[1:], len(number)]):
                if number[first] != block:
                    block, held, ready = number[first], [], {}
                part = _by_size(ids[first:last], batch.column(3).slice(first, last - first))
                if not is_query[first]:
                    held.append(part)
                    continue
                for width, (q_ids, q) in part.items():
                    if width not in ready:
                        own = [h[width] for h in held if width in h]
                        ready[width] = (np.concatenate([i for i, _ in own]), np.concatenate([m for _, m in own])) if own else None
                    if ready[width] is not None:
                        for at in range(0, len(q_ids), QUERIES):
                            yield _nearest_rows(q_ids[at:at + QUERIES], q[at:at + QUERIES], *ready[width], k)

    part = dealt.mapInArrow(best, "q bigint, v bigint, distance double")
    return top_per_group(part, ["q"], [F.col("distance"), F.col("v")], k).select(F.col("q").alias(query_id), F.col("v").alias(id_col), "distance", "rank")


def _by_size(ids: np.ndarray, lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors by vector size; empty and zero vectors drop out."""
    sizes = np.diff(np.array(lists.offsets))
    out = {}
    for width in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == width)
        m = np.array(lists.take(pa.array(at)).flatten(), np.float64).reshape(-1, width)
        norm = np.sqrt((m * m).sum(axis=1))
        ok = np.isfinite(norm) & (norm > 0)
        out[width] = (ids[at[ok]], m[ok] / norm[ok, None])
    return out


def _nearest_rows(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, stored: np.ndarray, k: int) -> pa.RecordBatch:
    take = min(k, len(ids))
    found_q, found_v, found_d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    distances = 1 - q @ stored.T if take else np.zeros((0, 0))
    for i, d in enumerate(distances):
        near = np.flatnonzero(d <= np.partition(d, take - 1)[take - 1])
        near = near[np.lexsort((ids[near], d[near]))][:take]
        found_q.append(np.full(len(near), q_ids[i]))
        found_v.append(ids[near])
        found_d.append(d[near])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found_q, found_v, found_d)], ["q", "v", "distance"])


def search(vectors: DataFrame, query: list[float], *, limit: int = 20, collection: object = None, overfetch: int = 3, exact_filter: bool = False, min_score: float = 0.0, id_col: str = "vec_id", embedding: str = "embedding", file_col: str | None = None, collection_col: str | None = None) -> DataFrame:
    """Top rows of one query: (id, file, distance, score, rank), best chunk of each file only, score = 1 - distance.

    ``limit * overfetch`` nearest chunks are taken before any filter, so fewer than ``limit`` may come back;
    ``exact_filter`` filters first.
    """
    q = F.array(*(F.lit(float(x)) for x in query))
    kept = vectors if not (exact_filter and collection is not None) else vectors.where(F.col(collection_col) == collection)
    near = kept.withColumn("distance", cosine_distance(F.col(embedding), q)).where(F.col("distance") < float("inf"))
    near = near.orderBy("distance", id_col).limit(limit * overfetch)
    if collection is not None and not exact_filter:
        near = near.where(F.col(collection_col) == collection)
    near = near.select(F.col(id_col), (F.col(file_col) if file_col else F.col(id_col)).alias("file"), "distance")
    near = first_per_key(near, ["file"], [F.col("distance"), F.col(id_col)]).withColumn("score", 1 - F.col("distance"))
    order = [F.col("distance"), F.col(id_col)]
    return with_rank(near.where(F.col("score") >= min_score).orderBy(*order).limit(limit), order)


def hash_vector(text: Column, size: int = 16) -> Column:
    """A deterministic vector of a text: the first bytes of its SHA-256, each over 255, rounded to six places."""
    digest = F.sha2(text, 256)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.round(F.conv(F.substr(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 255, 6))


def query_template(text: Column, model: str = "default") -> Column:
    """Text as embedded for a query of a model family."""
    return {"default": F.concat(F.lit("task: search result | query: "), text), "qwen": F.concat(F.lit("Instruct: Retrieve relevant documents for the given query\nQuery: "), text), "plain": text}[model]


def document_template(text: Column, title: Column, model: str = "default") -> Column:
    """Text as embedded for a document of a model family."""
    return {"default": F.concat(F.lit("title: "), F.coalesce(title, F.lit("none")), F.lit(" | text: "), text), "qwen": F.when(title.isNotNull(), F.concat(title, F.lit("\n"), text)).otherwise(text), "plain": text}[model]


def embedding_fingerprint(model: str, probes: list[str], chunk: dict[str, int]) -> str:
    """Six hexadecimal digits that change with the model, the probe texts or the chunk constants."""
    return hashlib.sha256(json.dumps({"chunk": chunk, "model": model, "probes": probes}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:6]


def audit(vectors: DataFrame, again: DataFrame, id_col: str, embedding: str, tolerance: float = 1e-4) -> DataFrame:
    """(id, distance, mismatch) of vectors embedded a second time."""
    b = again.select(id_col, F.col(embedding).alias("__again"))
    return vectors.join(b, id_col).select(id_col, cosine_distance(F.col(embedding), F.col("__again")).alias("distance")).withColumn("mismatch", F.col("distance") > tolerance)


def embed(df: DataFrame, text: str, out: str, embedder=None) -> DataFrame:
    """``df`` with a vector column. ``embedder`` maps a list of texts to a list of vectors and runs in Arrow batches; without
    one the deterministic hash vector is used."""
    if embedder is None:
        return df.withColumn(out, hash_vector(F.col(text)))

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([list(map(float, v)) for v in embedder(list(texts))])

    return df.withColumn(out, run(text))


#: Texts of one call of an embedder, tries per text, and the share of failures from which a task gives up.
CALL, ATTEMPTS, MOST_FAILED = 32, 3, 0.8


def embed_with_retries(df: DataFrame, text: str, out: str, failure: str, embedder, *, call: int = CALL, attempts: int = ATTEMPTS, most_failed: float = MOST_FAILED) -> DataFrame:
    """``df`` with a vector and, where there is none, the reason (``failure``).

    ``embedder`` gets ``call`` texts at once. If a call fails its texts are tried one by one; texts without vector are tried again
    at the end of the batch, ``attempts`` times in all. A task that has lost more than ``most_failed`` of at least ``call`` texts gives up the
    rest, whose reason says so. Null texts are not embedded and have no failure.
    """
    ship_package(df.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` array<double>, `{failure}` string"

    def alone(t: str) -> tuple[list[float] | None, str | None]:
        try:
            v = embedder([t])[0]
            return (None, "no vector") if v is None else (list(map(float, v)), None)
        except Exception as error:  # noqa: BLE001 - an embedder may fail in any way
            return None, str(error)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = lost = 0
        for batch in batches:
            texts = list(batch[text])
            result: list[tuple[list[float] | None, str | None]] = [(None, None)] * len(texts)
            asked = [i for i, t in enumerate(texts) if t is not None]
            for first in range(0, len(asked), call):
                some = asked[first:first + call]
                if done + lost >= call and lost > most_failed * (done + lost):
                    for i in asked[first:]:
                        result[i] = (None, "given up because too many failed")
                    break
                tries = dict.fromkeys(some, 1)
                try:
                    for i, v in zip(some, embedder([texts[i] for i in some])):
                        result[i] = (None, "no vector") if v is None else (list(map(float, v)), None)
                except Exception:  # noqa: BLE001
                    for i in some:
                        result[i] = alone(texts[i])
                while left := [i for i in some if result[i][0] is None and tries[i] < attempts]:
                    for i in left:
                        tries[i] += 1
                        result[i] = alone(texts[i])
                done += sum(result[i][0] is not None for i in some)
                lost += sum(result[i][0] is None for i in some)
            yield batch.assign(**{out: [v for v, _ in result], failure: [why for _, why in result]})

    return df.mapInPandas(run, fields)
