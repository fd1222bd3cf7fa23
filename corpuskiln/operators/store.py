"""The corpus store as snapshot functions: each takes the stored frames and returns the rows after (or the rows concerned by)
a mutation. Documents are keyed by (collection, path), bodies by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.operators.ranking import first_per_key

KEY = ["collection", "path"]


def classify_changes(scan: DataFrame, stored: DataFrame) -> DataFrame:
    """(collection, path, status) of a fresh scan against stored documents, both with title and hash.

    ``indexed``: no active row; ``updated``: other hash; ``retitled``: same hash, other title; ``unchanged``; ``removed``: active
    row not in the scan. One shuffle per side on the document key. Keys must not be null and occur once a side.
    """
    new = scan.select(*KEY, F.col("title").alias("t1"), F.col("hash").alias("h1"), F.lit(True).alias("new"))
    old = stored.where("active").select(*KEY, F.col("title").alias("t0"), F.col("hash").alias("h0"), F.lit(True).alias("old"))
    status = (
        F.when(F.col("old").isNull(), "indexed").when(F.col("new").isNull(), "removed")
        .when(~F.col("h1").eqNullSafe(F.col("h0")), "updated").when(~F.col("t1").eqNullSafe(F.col("t0")), "retitled").otherwise("unchanged")
    )
    return new.join(old, KEY, "full_outer").select(*KEY, status.alias("status"))


def upsert_documents(stored: DataFrame, scan: DataFrame, now: Column) -> DataFrame:
    """Documents after an upsert: title, hash and modified_at replaced and active again, created_at kept; others as they are."""
    new = scan.select(*KEY, F.col("title").alias("t1"), F.col("hash").alias("h1"), F.lit(True).alias("new"))
    hit = F.col("new").isNotNull()
    return stored.join(new, KEY, "full_outer").select(
        *KEY, F.when(hit, F.col("t1")).otherwise(F.col("title")).alias("title"), F.when(hit, F.col("h1")).otherwise(F.col("hash")).alias("hash"),
        F.coalesce("created_at", now).alias("created_at"), F.when(hit, now).otherwise(F.col("modified_at")).alias("modified_at"), (hit | F.coalesce("active", F.lit(False))).alias("active"),
    )


def insert_content(content: DataFrame, new: DataFrame) -> DataFrame:
    """Bodies to append: rows of ``new`` whose hash is not stored, one per hash (the earliest, then the smallest body)."""
    fresh = new.where("hash is not null").join(content.select("hash"), "hash", "left_anti")
    return first_per_key(fresh, ["hash"], [F.col("created_at"), F.col("doc")])


def deactivate_missing(stored: DataFrame, scan: DataFrame) -> DataFrame:
    """Documents with active cleared where the scan has no such path."""
    seen = scan.select(*KEY).distinct().withColumn("seen", F.lit(True))
    return stored.join(seen, KEY, "left").withColumn("active", F.col("active") & F.col("seen").isNotNull()).drop("seen")


def orphan_content(content: DataFrame, documents: DataFrame) -> DataFrame:
    """Bodies that no document names, active or not."""
    return content.join(documents.where("hash is not null").select("hash").distinct(), "hash", "left_anti")


def remove_collection(documents: DataFrame, content: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(documents, content) after a collection's removal: its rows go, bodies without an *active* document go, and with a body
    every remaining (inactive) document that named it."""
    left = documents.where(~F.col("collection").eqNullSafe(F.lit(name)))
    live = left.where("active and hash is not null").select("hash").distinct()
    kept = content.join(live, "hash", "left_semi")
    had = content.select("hash").distinct().join(live, "hash", "left_anti")
    return left.join(had, "hash", "left_anti"), kept


def orphan_vectors(vectors: DataFrame, documents: DataFrame) -> DataFrame:
    """Vector rows whose hash no active document has."""
    return vectors.join(documents.where("active and hash is not null").select("hash").distinct(), "hash", "left_anti")


def upsert_embeddings(vectors: DataFrame, at: Column) -> DataFrame:
    """One row per (hash, seq): the one embedded last; of equal ones the smallest model and fingerprint."""
    return first_per_key(vectors, ["hash", "seq"], [-F.unix_micros(at), F.col("model"), F.col("embed_fingerprint"), F.col("total_chunks")])


def incomplete_embeddings(vectors: DataFrame, model: str) -> DataFrame:
    """(hash, n, expected) of bodies whose rows under a model are not as many as their pieces."""
    mine = vectors.where(F.col("model") == model).groupBy("hash").agg(F.countDistinct("seq").alias("n"), F.max("total_chunks").alias("expected"))
    return mine.where("hash is not null and n <> expected")


def pending_embeddings(documents: DataFrame, content: DataFrame, vectors: DataFrame, model: str, fingerprint: str) -> DataFrame:
    """(hash, path, collection, bytes) of active bodies without a full set of pieces under a model and fingerprint.

    Each body counts once, however many documents share it; the smallest path and collection stand for it.
    """
    bodies = documents.where("active and hash is not null").groupBy("hash").agg(F.min("path").alias("path"), F.min("collection").alias("collection"))
    have = vectors.where((F.col("model") == model) & (F.col("embed_fingerprint") == fingerprint)).groupBy("hash").agg(F.countDistinct("seq").alias("n"), F.max("total_chunks").alias("expected"))
    sizes = content.groupBy("hash").agg(F.max(F.octet_length("doc")).cast("bigint").alias("bytes"))
    return bodies.join(sizes, "hash").join(have, "hash", "left").where("n is null or n < expected").select("hash", "path", "collection", "bytes")


def scoped_hashes(documents: DataFrame, name: str) -> DataFrame:
    """Hashes used by a collection and by no other. Flags per hash, no set is collected."""
    per = documents.where("hash is not null").groupBy("hash").agg(F.bool_or(F.col("collection") == name).alias("mine"), F.bool_or(F.coalesce(F.col("collection") != name, F.lit(True))).alias("others"))
    return per.where("mine and not others").select("hash")


def case_twins(documents: DataFrame) -> DataFrame:
    """(collection, path, keep): documents whose path equals another's but for ASCII case, with the first row's path."""
    low = F.translate("path", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = documents.groupBy("collection", low.alias("low")).agg(F.count(F.lit(1)).alias("n"), F.min_by("path", "doc_id").alias("keep")).where("n > 1")
    return documents.withColumn("low", low).join(groups, ["collection", "low"]).select("collection", "path", "keep")


def migrate_case_paths(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """Documents after asked paths (collection, path) took over rows that differ from them in ASCII case only.

    Where no row has the asked path exactly, the row with the smallest ``doc_id`` that has it but for case is renamed to it; of several
    spellings asked the smallest counts. Other rows stay as they are.
    """
    fold = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    new = asked.select(*KEY).distinct().join(documents.select(*KEY), KEY, "left_anti").groupBy("collection", fold("path").alias("low")).agg(F.min("path").alias("renamed"))
    first = documents.groupBy("collection", fold("path").alias("low")).agg(F.min("doc_id").alias("doc_id"))
    moved = first.join(new, ["collection", "low"]).select("doc_id", "renamed")
    return documents.join(moved, "doc_id", "left").withColumn("path", F.coalesce("renamed", "path")).select(*documents.columns)


def trim_cache(cache: DataFrame, key: str, at: str, keep: int = 1000) -> DataFrame:
    """The newest rows of a result cache."""
    return cache.orderBy(F.col(at).desc(), key).limit(keep)


def collection_status(documents: DataFrame, collections: DataFrame) -> DataFrame:
    """(collection, total, active_count, last_modified) of every registered collection, empty ones with zeros."""
    per = documents.groupBy("collection").agg(F.count(F.lit(1)).alias("total"), F.count_if("active").alias("active_count"), F.max("modified_at").alias("last_modified"))
    return collections.join(per, "collection", "left").select("collection", F.coalesce("total", F.lit(0)).cast("bigint").alias("total"), F.coalesce("active_count", F.lit(0)).cast("bigint").alias("active_count"), "last_modified")


def embedding_coverage(vectors: DataFrame) -> DataFrame:
    """Bodies and pieces by (model, fingerprint)."""
    return vectors.groupBy("model", "embed_fingerprint").agg(F.countDistinct("hash").alias("hashes"), F.count(F.lit(1)).alias("pieces"))


def distinct_content(documents: DataFrame, content: DataFrame) -> DataFrame:
    """(hash, n_documents, first_document): how many active documents share each stored body."""
    per = documents.where("active and hash is not null").groupBy("hash").agg(F.count(F.lit(1)).alias("n_documents"), F.min("doc_id").alias("first_document"))
    return per.join(content.select("hash").distinct(), "hash", "left_semi")


def first_vectors(documents: DataFrame, vectors: DataFrame) -> DataFrame:
    """(doc_id, seq): active documents with the smallest piece at position 0 of their body, if any."""
    first = vectors.where("pos = 0 and hash is not null").groupBy("hash").agg(F.min("seq").alias("seq"))
    return documents.where("active and hash is not null").join(first, "hash", "left").select("doc_id", "seq")


def orphan_content_kept(content: DataFrame, documents: DataFrame) -> DataFrame:
    """Bodies that some document names."""
    return content.join(documents.where("hash is not null").select("hash").distinct(), "hash", "left_semi")
