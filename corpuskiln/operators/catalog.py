"""Reductions over catalogs, metrics and samples: set tests, caps, totals, recovery summaries, adoption of older vectors, ids of
pieces, checks of an upper level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.text import json_text
from corpuskiln.operators.evaluation import BANDS
from corpuskiln.operators.skew import salted_left_join


def is_subset(values: Column, allowed: Column) -> Column:
    """Whether every element of an array is in the other; null for null arrays, true for an empty one."""
    return F.size(F.array_except(values, allowed)) == 0


def subset_by_group(values: DataFrame, allowed: DataFrame, group: str, item: str) -> DataFrame:
    """(group, subset): whether all items of a group of ``values`` are among the same group's items in ``allowed``.

    Items are rows, not arrays, so a group may be of any size. Null items are ignored; a group without items has a subset.
    """
    own = values.select(F.col(group).alias("g"), F.col(item).alias("x"))
    known = allowed.where(F.col(item).isNotNull()).select(F.col(group).alias("g"), F.col(item).alias("x"), F.lit(True).alias("known")).distinct()
    told = own.distinct().join(known, ["g", "x"], "left")
    return told.groupBy(F.col("g").alias(group)).agg((F.count_if(F.col("x").isNotNull() & F.col("known").isNull()) == 0).alias("subset"))


def stale_sets(observed: DataFrame, expected: DataFrame, group: str, item: str) -> DataFrame:
    """(group, present, stale): a group's observed set of items is stale unless it is exactly the expected one; ``present`` is
    whether anything was observed. Null items are ignored."""
    side = lambda df, name: df.where(F.col(item).isNotNull()).select(F.col(group).alias("g"), F.col(item).alias("x"), F.lit(True).alias(name)).distinct()
    both = side(observed, "seen").join(side(expected, "wanted"), ["g", "x"], "full_outer")
    return both.groupBy(F.col("g").alias(group)).agg((F.count("seen") > 0).alias("present"), F.bool_or(F.col("seen").isNull() | F.col("wanted").isNull()).alias("stale"))


def top_metrics(metrics: DataFrame, attempts: str, tokens: str, model: str, most: int = 32) -> DataFrame:
    """The ``most`` models with most attempts, then most tokens, then by name: a top-k, not a sort."""
    return metrics.orderBy(F.desc(attempts), F.desc(tokens), model).limit(most)


def metric_totals(metrics: DataFrame, model: str, sums: list[str]) -> DataFrame:
    """One row: the number of models and the sums over all of them, 0 for none."""
    return metrics.agg(F.count_distinct(model).alias("models"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums))


def recovery_summary(items: DataFrame, slots: DataFrame, item: str, status: str, retryable: str, retry_at: str, wait: str, generation: str) -> DataFrame:
    """(item, status, retryable, next_retry_at, slots, longest_wait, generation): the state of each item with its active slots.

    ``items`` has a row per item and state; of several the retryable one with the earliest retry counts. Items without slot have 0.
    """
    state = items.groupBy(item).agg(F.max_by(status, F.col(retry_at)).alias("status"), F.bool_or(retryable).alias("retryable"), F.min(F.when(F.col(retryable), F.col(retry_at))).alias("next_retry_at"))
    active = slots.where(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("slots"), F.max(wait).alias("longest_wait"), F.max(generation).alias("generation"))
    return state.join(active, item, "left").withColumn("slots", F.coalesce("slots", F.lit(0)).cast("bigint"))


def recovery_totals(items: DataFrame, status: str, retryable: str, retry_at: str) -> DataFrame:
    """(status, n, retryable, next_retry_at) over all items."""
    return items.groupBy(status).agg(F.count(F.lit(1)).alias("n"), F.count_if(retryable).alias("retryable"), F.min(F.when(F.col(retryable), F.col(retry_at))).alias("next_retry_at"))


def rating_histogram(scores: DataFrame, score: str) -> DataFrame:
    """(rating, n) of percentages, by the bands of the reward; null scores take no part."""
    rating = F.coalesce(*(F.when(F.col(score) >= least, F.lit(name)) for least, name in BANDS), F.lit("Failed"))
    return scores.where(F.col(score).isNotNull()).groupBy(rating.alias("rating")).agg(F.count(F.lit(1)).alias("n"))


def throughput(runs: DataFrame, by: str, milliseconds: str, documents: Column) -> DataFrame:
    """(by, runs, median_ms, documents_per_second) of timed runs; no rate where no time passed."""
    return runs.groupBy(by).agg(F.count(F.lit(1)).alias("runs"), F.median(milliseconds).alias("median_ms"), F.try_divide(F.sum(documents) * 1000, F.sum(milliseconds)).alias("documents_per_second"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their key: a uniform sample that is the same wherever it runs."""
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("__mark", mark).orderBy("__mark", key).limit(n).drop("__mark")


def adopt_fingerprint(vectors: DataFrame, key: str, embedding: str, fingerprint: str, sample_key: object, again: list[float], current: str, tolerance: float = 1e-4) -> tuple[DataFrame, str]:
    """Vectors with a blank fingerprint taken over as current ones, and why or why not.

    One of them, ``sample_key``, was embedded anew as ``again``. Only if the nearest stored vector is that very one, within
    ``tolerance``, is the blank fingerprint set to ``current`` everywhere.
    """
    from corpuskiln.operators.vectors import cosine_distance

    blank = F.coalesce(F.col(fingerprint), F.lit("")) == ""
    if vectors.where(blank).isEmpty():
        return vectors, "no vectors with a blank fingerprint"
    distance = cosine_distance(F.col(embedding), F.array(*(F.lit(float(x)) for x in again)))
    nearest = vectors.select(key, distance.alias("d")).where("d is not null").orderBy("d", key).limit(1).first()
    if nearest is None:
        return vectors, "no stored vector can be compared"
    if nearest[key] != sample_key or nearest["d"] > tolerance:
        return vectors, f"the sample differs: nearest is {nearest[key]} at {nearest['d']:.6f}"
    return vectors.withColumn(fingerprint, F.when(blank, F.lit(current)).otherwise(F.col(fingerprint))), f"the sample matches at {nearest['d']:.6f}"


def _json(pairs: list[tuple[str, Column]]) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{k}":'), v) for k, v in pairs)), F.lit("}"))


def document_lineage_id(content_hash: Column, source_id: Column, version: str = "1", prefix: str = "doc:") -> Column:
    """Id of a document's content from a source: 24 hexadecimal digits over compact JSON; a null source counts as null."""
    pairs = [("contentHash", json_text(content_hash)), ("normalizationPolicyVersion", F.lit(f'"{version}"')), ("sourceId", F.when(source_id.isNull(), "null").otherwise(json_text(source_id)))]
    return F.concat(F.lit(prefix), F.left(F.sha2(_json(pairs), 256), F.lit(24)))


def chunk_identity(document_id: Column, content_hash: Column, seq: Column, pos: Column, length: Column, strategy: str = "default-v1") -> Column:
    """Id of a piece for jobs: 12 hexadecimal digits over JSON with sorted keys."""
    text = lambda c: F.when(c.isNull(), "null").otherwise(json_text(c))
    pairs = [("chunkStrategy", F.lit(f'"{strategy}"')), ("contentHash", text(content_hash)), ("documentId", text(document_id)), ("length", length.cast("string")), ("pos", pos.cast("string")), ("seq", seq.cast("string"))]
    return F.concat(F.lit("chunk-"), F.left(F.sha2(_json(pairs), 256), F.lit(12)))


# Phrases of template answers, each of which costs a point.
GENERIC = ["comprehensive guide", "everything you need to know", "beginners and advanced users"]


def output_score(text: Column) -> Column:
    """Points of an expansion: 1 a lex and vec line, 2 a hyde line, up to 2 for a last hyde of 80 to 200 characters, less 1 a generic phrase in it.
    Null for null."""
    lines = F.transform(F.split(F.trim(text), "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    of = lambda kind: F.filter(lines, lambda x: x.startswith(f"{kind}:"))
    hyde = F.coalesce(F.regexp_replace(F.substr(F.try_element_at(of("hyde"), F.lit(-1)), F.lit(6)), r"^\s+|\s+$", ""), F.lit(""))
    size = F.length(hyde)
    bonus = F.when(size.between(80, 200), 2).when(size.between(50, 250), 1).otherwise(0)
    generic = sum((F.contains(F.lower(hyde), F.lit(p)).cast("int") for p in GENERIC), F.lit(0))
    return F.when(text.isNotNull(), F.size(of("lex")) + F.size(of("vec")) + 2 * F.size(of("hyde")) + bonus - generic)


def level_problems(units: DataFrame, edges: DataFrame, evidence: DataFrame, members: DataFrame, generation: str, most_units: int, most_edges: int) -> DataFrame:
    """(problem, n) of an upper level: edges and evidence that name no unit, units of members that are gone or whose generation
    is another, units without evidence, and row budgets exceeded. No rows mean a sound level.

    ``units`` (unit_id, member, generation), ``edges`` (left, right), ``evidence`` (unit_id), ``members`` (member). Null ids name nothing.
    """
    known = units.select(F.col("unit_id").alias("id")).where("id is not null").distinct()
    loose = lambda df, c: df.select(F.col(c).alias("id")).join(known, "id", "left_anti")
    held = evidence.select(F.col("unit_id").alias("id")).distinct()
    parts = {
        "edge_without_unit": loose(edges, "left").unionByName(loose(edges, "right")),
        "evidence_without_unit": loose(evidence, "unit_id"),
        "unit_without_evidence": known.join(held, "id", "left_anti"),
        "unit_of_unknown_member": units.select("member", F.col("unit_id").alias("id")).join(members.select("member").distinct(), "member", "left_anti").select("id"),
        "stale_unit": units.where(~F.col("generation").eqNullSafe(F.lit(generation))).select(F.col("unit_id").alias("id")),
    }
    found = None
    for name, rows in parts.items():
        part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("problem"), "n")
        found = part if found is None else found.unionByName(part)
    for name, rows, most in (("too_many_units", units, most_units), ("too_many_edges", edges, most_edges)):
        found = found.unionByName(rows.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(F.lit(name).alias("problem"), "n"))
    return found.where("n > 0")


def text_unit_identity(units: DataFrame, documents: DataFrame) -> DataFrame:
    """(unit_id, document_id, how): the document of each text unit, by its id, else by the base name of its title where one
    document has it, else the only document there is. ``units`` (unit_id, document_id, title), ``documents`` (document_id, path).
    Units that none of these names have null."""
    base = lambda c: F.lower(F.regexp_extract(F.coalesce(F.col(c), F.lit("")), r"([^/]*)$", 1))
    by_id = documents.where("document_id is not null").select(F.col("document_id").alias("known")).distinct()
    by_name = documents.select(base("path").alias("name"), "document_id").where("name <> ''").groupBy("name").agg(F.min("document_id").alias("named"), F.count_distinct("document_id").alias("n")).where("n = 1").select("name", "named")
    only = documents.agg(F.when(F.count_distinct("document_id") == 1, F.min("document_id")).alias("only"))
    told = salted_left_join(units.withColumn("known", F.col("document_id")), by_id.withColumn("there", F.lit(True)), "known")
    told = salted_left_join(told.withColumn("name", base("title")), by_name, "name").join(F.broadcast(only))  # one row
    found = F.coalesce(F.when(F.col("there"), F.col("known")), F.col("named"), F.col("only"))
    how = F.when(F.col("there"), "id").when(F.col("named").isNotNull(), "name").when(F.col("only").isNotNull(), "only")
    return told.select("unit_id", found.alias("document_id"), how.alias("how"))
