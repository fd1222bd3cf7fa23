"""Ranks, ordered de-duplication, running budgets: the computations that need an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions.keys import fresh_name
from corpuskiln.operators.skew import hot_keys
from corpuskiln.session import stage_table


def with_rank(few: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """1-based position of each row of a small result (a limit must bound it: one task orders it)."""
    return few.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)).cast("int"))


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group. Spark keeps only ``k`` rows a group map-side (window group limit)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("int")).where(F.col(name) <= k)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``, by a partial aggregation (no window, no sort; safe for hot keys)."""
    rest = [c for c in df.columns if c not in keys]
    ranked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return ranked.select(*keys, *(F.col("__row")[c].alias(c) for c in rest))


def latest_per_key(df: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """One row per key, the latest; of equally late ones the smallest ``tie``. Null times come last.

    ``at`` is a timestamp, date or number, so that one partial aggregation does (no window, no join; safe for hot keys).
    """
    kind = df.schema[at].dataType.simpleString()
    number = F.unix_micros(at) if kind == "timestamp" else F.unix_date(at) if kind == "date" else F.col(at)
    return first_per_key(df, keys, [F.col(at).isNull(), -number, F.col(tie)]).select(*df.columns)


#: A group above this share of the rows is not left to one task.
LARGE_GROUP = 0.05


def running_total(df: DataFrame, group: str, order: list[str], value: Column, out: str) -> DataFrame:
    """``out``: sum of ``value`` over a row and all before it in its group, in a total order.

    Where no group is large this is a window. Otherwise rows are range-partitioned by group and order, summed within each range
    and shifted by the totals of the ranges before, so that a group with a third of all rows is spread over many tasks.
    """
    if not hot_keys(df.select(F.col(group).cast("string").alias("g")), "g", LARGE_GROUP):
        w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    part, total, before = fresh_name(df, "part"), fresh_name(df, "total"), fresh_name(df, "before")
    ranged = stage_table(df.repartitionByRange(group, *order).withColumn(part, F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(group, part).agg(F.sum(value).alias(total))  # a row per group and range that holds it
    ahead = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(F.col(group).alias("__g"), F.col(part).alias("__p"), F.coalesce(F.sum(total).over(ahead), F.lit(0)).alias(before))
    w = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn(out, F.sum(value).over(w)).join(shift, F.col(group).eqNullSafe(F.col("__g")) & (F.col(part) == F.col("__p")))
    return summed.withColumn(out, F.col(out) + F.col(before)).drop(part, "__g", "__p", before)


def running_budget(df: DataFrame, group: str, order: list[str], size: str, budget: int) -> DataFrame:
    """Rows of each group, in order, up to the first that would exceed the budget (nothing follows it); adds ``running``."""
    return running_total(df, group, order, F.col(size), "running").where(F.col("running") <= budget)


def resequence(events: DataFrame, stream: str, order: list[str], event_id: str) -> DataFrame:
    """``sequence`` 1..n within each stream and whether the event's id occurred before (``duplicate``). ``order`` is total."""
    numbered = running_total(events, stream, order, F.lit(1), "sequence").withColumn("sequence", F.col("sequence").cast("int"))
    return running_total(numbered, event_id, order, F.lit(1), "duplicate").withColumn("duplicate", F.col("duplicate") > 1)


def partition_plan(ids: DataFrame, id_col: str, limit: int) -> DataFrame:
    """``part`` (1-based) of each id in sorted order, ``limit`` ids a part. Ids are numbered by many tasks."""
    whole, number = fresh_name(ids, "whole"), fresh_name(ids, "number")
    numbered = running_total(ids.withColumn(whole, F.lit("all")), whole, [id_col], F.lit(1), number)
    return numbered.withColumn("part", F.floor((F.col(number) - 1) / limit).cast("int") + 1).drop(whole, number)


def gap_to_runner_up(scores: DataFrame, score: str) -> DataFrame:
    """One row: best score, lead over the second, by the two largest values only."""
    two = scores.select(F.col(score).alias("s")).orderBy(F.col("s").desc()).limit(2).agg(F.sort_array(F.collect_list("s"), False).alias("t"))
    top, second = F.try_element_at("t", F.lit(1)), F.try_element_at("t", F.lit(2))
    return two.select(F.coalesce(top, F.lit(0.0)).alias("top"), (F.coalesce(top, F.lit(0.0)) - F.coalesce(second, F.lit(0.0))).alias("lead"))
