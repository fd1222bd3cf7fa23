"""Table-shaped reductions over run states, artifacts and metrics: latest per key, coverage of required kinds, rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.operators.ranking import latest_per_key


def status_rollup(rows: DataFrame, status: str, by: list[str], values: list[str]) -> DataFrame:
    """Rows per group in each of the given states, and in all."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col(status) == v).alias(v) for v in values))


def first_true(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """Name of the first aggregate condition that holds (conditions are existence tests such as ``bool_or``)."""
    whole = None
    for name, condition in rules:
        whole = F.when(condition, name) if whole is None else whole.when(condition, name)
    return F.lit(otherwise) if whole is None else whole.otherwise(otherwise)


def next_stage(states: DataFrame, item: str, stage: str, status: str, order: list[str]) -> DataFrame:
    """(item, next_stage, stale): first stage in a fixed order that has not succeeded (null if none) and how many later ones
    have and are stale by it. A stage without row has not succeeded."""
    n = len(order)
    position = F.array_position(F.array(*(F.lit(s) for s in order)), F.col(stage)) - 1
    done = states.where(F.col(stage).isin(order)).groupBy(item).agg(F.collect_set(F.when(F.col(status) == "succeeded", position.cast("int"))).alias("ok"))  # at most len(order) numbers
    missing = F.array_min(F.array_except(F.sequence(F.lit(0), F.lit(n - 1)), F.col("ok")))
    return done.withColumn("m", missing).select(item, F.when(F.col("m").isNotNull(), F.element_at(F.array(*(F.lit(s) for s in order)), F.col("m") + 1)).alias("next_stage"), F.size(F.filter("ok", lambda x: x > F.col("m"))).alias("stale"))


def upsert_artifacts(stored: DataFrame, new: DataFrame, key: list[str], at: str, tie: str) -> DataFrame:
    """Artifacts after an upsert: one row per logical key, the latest."""
    return latest_per_key(stored.unionByName(new), key, at, tie)


def validate(rows: DataFrame, checks: list[tuple[str, Column]], out: str = "reason") -> DataFrame:
    """``out``: name of the first check that a row fails, null if none. A null check fails."""
    return rows.withColumn(out, F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks)))


def missing_kinds(valid: DataFrame, owner: str, kind: str, required: list[str]) -> DataFrame:
    """(owner, missing): required kinds without a valid row. Kinds are few and fixed."""
    return valid.groupBy(owner).agg(F.array_sort(F.array_except(F.array(*(F.lit(k) for k in required)), F.collect_set(kind))).alias("missing"))


def weighted_metrics(rows: DataFrame, by: str, sums: list[str], rate: str, weight: str) -> DataFrame:
    """Sums by group and the weighted mean of a rate; null where no weight."""
    r = F.sum(F.col(rate) * F.col(weight))
    return rows.groupBy(by).agg(*(F.sum(c).alias(c) for c in sums), F.try_divide(r, F.sum(weight)).alias(rate))


def merge_scalars(rows: DataFrame, by: str, scalars: list[str]) -> DataFrame:
    """Per group, each scalar only if the group holds exactly one distinct value and no null."""
    return rows.groupBy(by).agg(*(F.when(F.min(c).eqNullSafe(F.max(c)) & (F.count(c) == F.count(F.lit(1))), F.max(c)).alias(c) for c in scalars))


def unite_arrays(rows: DataFrame, by: str, array: str, out: str = "value") -> DataFrame:
    """(by, value): the distinct elements of a group's arrays, a row each. They are not gathered into one array, since a group
    may hold a large part of all rows."""
    return rows.select(by, F.explode(array).alias(out)).where(F.col(out).isNotNull()).distinct()


def closure(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """(path, problem) of a package: files of the manifest (path, bytes, digest) that are missing or differ, and files that it
    does not name."""
    m = manifest.select("path", F.col("bytes").alias("mb"), F.col("digest").alias("md"), F.lit(True).alias("m"))
    f = listing.select("path", F.col("bytes").alias("fb"), F.col("digest").alias("fd"), F.lit(True).alias("f"))
    problem = F.when(F.col("f").isNull(), "missing").when(F.col("m").isNull(), "undeclared").when(F.col("mb") != F.col("fb"), "bytes").when(F.col("md") != F.col("fd"), "digest")
    return m.join(f, "path", "full_outer").select("path", problem.alias("problem")).where("problem is not null")


def cost_groups(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Distinct groups with ``requests`` 1 on the first group (by its smallest ``order``) and 0 on others."""
    groups = rows.groupBy(*keys).agg(F.min(order).alias("__first"))
    least = rows.agg(F.min(order).alias("__least"))
    return groups.join(F.broadcast(least)).withColumn("requests", (F.col("__first") == F.col("__least")).cast("int")).drop("__first", "__least")  # one row


# Levels of a log line that count and that do not, and signs of partial results.
_LEVEL, _QUIET = r"(?i)\b(error|warn(ing)?|fatal)\b", r"(?i)\b(debug|info)\b"
_TRANSIENT, _PARTIAL = r"(?i)rate.?limit|timeout|timed out|connection|429|503", r"(?i)partial|skipp(ed|ing)|incomplete|missing"


def log_health(lines: DataFrame, text: str, order: str, most: int = 20) -> DataFrame:
    """(kind, line): the first actionable lines that speak of transient or partial failure; transient beats partial."""
    t = F.col(text)
    kind = F.when(t.rlike(_TRANSIENT), "transient").when(t.rlike(_PARTIAL), "partial")
    return lines.where(t.rlike(_LEVEL) & ~t.rlike(_QUIET)).select(order, kind.alias("kind"), t.alias("line")).where("kind is not null").orderBy(order).limit(most)
