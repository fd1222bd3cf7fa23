"""Duplicates hidden by formatting: merged Bloom filters pick the possible repeats, only those are shuffled and grouped.

Method. Every record gets a canonical form and its 64-bit hash. Each input partition fills two Bloom filters, of hashes
seen once and of hashes seen again, and the partitions' filters are merged block by block:

    repeated = repeated_a | repeated_b | (once_a & once_b)        once = once_a | once_b

A hash that occurs twice anywhere has all its bits in the merged ``repeated`` filter, so a record whose hash is not in it
is certainly alone and is emitted without any shuffle. The others (true repeats and a few false positives) are grouped
exactly by their canonical text. The filter costs recall nothing; its size only decides how many lone records are
shuffled in vain.

A filter has at most ``MOST_BITS``. Where the records need more, they are staged in folders by hash range, one filter a range:
filters stay small and as dense as ever, for any number of records, and no record is shuffled to its range.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.keys import trim_blanks
from corpuskiln.llm.bloom import BLOCK_BYTES, holds, merged_filters
from corpuskiln.operators.skew import salted_left_join
from corpuskiln.session import ship_package, stage_table

#: Bits of the filter for each row, and the most bits a filter may have (64 MB): a fixed bound on what is broadcast.
BITS_PER_ROW = 12
MOST_BITS = 1 << 29

# The field separators and the label pattern of TESTDATA.md.
FIELD_SEPARATOR = r"[;|\n\r]"
LABEL = r"^[\s\p{Z}]*[A-Za-z]+[\s\p{Z}]*:"


def words_of(c: Column) -> Column:
    """Words of a text joined by one blank: lower case, apostrophes deleted, everything but letters, digits, + and # separates."""
    bare = F.regexp_replace(F.lower(c), "['’]", "")
    return F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}+#]+", " "))


def canonical_query(c: Column) -> Column:
    """Canonical form of a query; equal forms mean that two queries differ only in formatting.

    A labelled query (two or more non-blank fields, each beginning with a label) becomes ``L`` and its sorted fields, any
    other text ``P`` and its words. Null stays null. A text without any word has the form ``P`` alone.
    """
    fields = F.filter(F.split(c, FIELD_SEPARATOR, -1), lambda x: trim_blanks(x) != "")
    labelled = (F.size(fields) >= 2) & F.forall(fields, lambda x: x.rlike(LABEL))
    return F.when(labelled, F.concat(F.lit("L\x1f"), F.array_join(F.array_sort(F.transform(fields, words_of)), "\x1f"))).otherwise(F.concat(F.lit("P\x1f"), words_of(c)))


def canonical_record(columns: list[Column]) -> Column:
    """Canonical form of a whole record whose fields may be reordered: the sorted words of its non-null fields."""
    return F.array_join(F.array_sort(F.filter(F.transform(F.array(*columns), lambda x: words_of(x.cast("string"))), lambda x: x.isNotNull())), "\x1f")


def _bits_for(rows: int) -> int:
    bits = 8 * BLOCK_BYTES
    while bits < rows * BITS_PER_ROW:
        bits *= 2
    return bits


def _told(rows: DataFrame, bits: int) -> DataFrame:
    """The rows with ``maybe``: whether their hash ``h`` may occur more than once among them."""
    packed = rows.sparkSession.sparkContext.broadcast(merged_filters(rows.select("h"), bits)[1].tobytes())

    @F.pandas_udf("boolean")
    def maybe_repeated(h: pd.Series) -> pd.Series:
        return pd.Series(holds(np.frombuffer(packed.value, np.uint8), h.to_numpy(np.int64)))

    return stage_table(rows.withColumn("maybe", maybe_repeated("h")), "told")


def collapse_copies(df: DataFrame, canonical: Column, order: Column, bits: int | None = None, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """Collapse rows with one canonical form. Returns (records, surplus).

    ``records`` has one row per distinct form, ``canonical``, ``keep`` (the smallest ``order`` value) and ``n_copies``;
    ``surplus`` has one row per further copy, ``keep`` and ``copy`` (its ``order`` value). Rows whose form is null take
    no part. Ties in ``order`` count as copies but yield one surplus row only. An empty frame gives two empty results.

    ``order`` should tell the rows of one form apart; it may be a struct. Columns that are not named are ignored, whatever they
    are called. Hot forms are pre-aggregated map-side; copies are told their record by hash, salted, without their text, but for
    hashes that two forms share, where the text decides. So a form that holds a third of all rows is no task's burden.
    """
    ship_package(df.sparkSession)
    most = 0 if bits else df.count()
    ranges = max(1, math.ceil(most * BITS_PER_ROW / most_bits))
    bits = bits or _bits_for(-(-most // ranges))
    rows = df.select(canonical.alias("form"), order.alias("ord")).where(F.col("form").isNotNull()).withColumn("h", F.xxhash64("form"))
    if ranges == 1:
        told = _told(stage_table(rows, "forms"), bits)
    else:  # a job per range over its own folder, which bounds the filter; high bits, as the filter's places are low ones
        staged = stage_table(rows.withColumn("range", F.pmod(F.shiftright("h", 44), F.lit(ranges)).cast("int")), "forms", by=["range"])
        told = reduce(DataFrame.unionByName, (_told(staged.where(F.col("range") == r).drop("range"), bits) for r in range(ranges)))
    maybe = told.where("maybe")
    groups = stage_table(maybe.groupBy("h", "form").agg(F.min("ord").alias("keep"), F.count(F.lit(1)).alias("n_copies")), "groups")
    records = told.where("not maybe").select("form", F.col("ord").alias("keep"), F.lit(1).cast("bigint").alias("n_copies")).unionByName(groups.drop("h"))

    shared = groups.groupBy("h").agg(F.count(F.lit(1)).alias("forms"), F.first("keep").alias("keep"), F.first("n_copies").alias("n"))
    joined = salted_left_join(maybe.select("h", "ord"), shared.where("forms = 1 and n > 1").select("h", "keep"), "h", how="inner").select("keep", "ord")
    clash = shared.where("forms > 1").select("h")
    if not clash.isEmpty():
        told_apart = groups.join(clash, "h", "left_semi").where("n_copies > 1").select("h", "form", "keep")
        joined = joined.unionByName(maybe.select("h", "form", "ord").join(told_apart, ["h", "form"]).select("keep", "ord"))
    surplus = joined.where("ord <> keep").select("keep", F.col("ord").alias("copy")).distinct()
    return records.withColumnRenamed("form", "canonical"), surplus
