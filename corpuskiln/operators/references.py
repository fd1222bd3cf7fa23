"""Orphan references: rows that point at keys another table lacks, has deleted or has only later."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.keys import fresh_name
from corpuskiln.operators.skew import salted_left_join

MATCHES = ("simple", "full", "partial")


def orphan_references(
    refs: DataFrame,
    targets: DataFrame,
    keys: list[tuple[str, str]],
    *,
    match: str = "simple",
    ref_time: str | None = None,
    target_time: str | None = None,
    alive: Column | None = None,
    removed: DataFrame | None = None,
    removed_keys: list[str] | None = None,
    out: str = "kind",
) -> DataFrame:
    """Rows of ``refs`` whose (composite) key has no live row in ``targets`` in time; ``out`` says why.

    ``keys`` pairs each referring column with the target column it names. References are grouped by their *null mask*
    (which key columns are null); each mask is one distributed join on exactly its non-null columns, so no mask ever
    needs an OR condition or a nested loop. ``match`` declares what a null means, as in the SQL standard:

    * ``simple``: a reference with any null key column refers to nothing and is never an orphan.
    * ``full``: all null refers to nothing; some null and some not is an orphan of kind ``mixed``.
    * ``partial``: all null refers to nothing; otherwise some target must agree on the non-null columns.

    Kinds, first that holds: ``missing`` (no such target row and not among ``removed``), ``deleted`` (no such row but in
    ``removed``; or, given ``alive``, rows exist and none is alive), ``late`` (the earliest target row is later than
    ``ref_time``). A null time on either side is never late. ``alive`` is a condition over ``targets``; null counts as
    not alive. Repeated reference rows come back as often as they occur; an empty ``targets`` makes every non-null
    reference missing; all other columns of ``refs`` are kept, whatever they are called.

    Targets are pre-aggregated to one row per key, so a hot key costs the target side one row; hot keys of the
    referring side are salted.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}, not {match!r}")
    if out in refs.columns:
        raise ValueError(f"{out!r} is already a column of the references")
    mine, theirs = [a for a, _ in keys], [b for _, b in keys]
    parts = []
    for mask in product((False, True), repeat=len(keys)):  # True: the column is null
        group = refs.where(_all(F.col(_q(k)).isNull() if null else F.col(_q(k)).isNotNull() for k, null in zip(mine, mask)))
        used = [i for i, null in enumerate(mask) if not null]
        if not used or (match == "simple" and any(mask)):
            continue
        if match == "full" and any(mask):
            parts.append(group.withColumn(out, F.lit("mixed")))
            continue
        parts.append(_orphans_of_mask(group, targets, [mine[i] for i in used], [theirs[i] for i in used], ref_time, target_time, alive, removed, [removed_keys[i] for i in used] if removed_keys else None, out))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _orphans_of_mask(group, targets, mine, theirs, ref_time, target_time, alive, removed, removed_keys, out):
    k = fresh_name(group, "key", targets)
    joined = lambda names: F.concat_ws("\x1f", *(F.col(_q(n)).cast("string") for n in names))
    own = targets.where(_all(F.col(_q(n)).isNotNull() for n in theirs)).select(
        joined(theirs).alias(k),
        (F.coalesce(alive, F.lit(False)) if alive is not None else F.lit(True)).alias("__alive"),
        (F.col(_q(target_time)) if target_time else F.lit(None).cast("timestamp")).alias("__since"),
    )
    own = own.groupBy(k).agg(F.lit(True).alias("__there"), F.max("__alive").alias("__alive"), F.min("__since").alias("__since"))
    if removed is not None:
        gone = removed.where(_all(F.col(_q(n)).isNotNull() for n in removed_keys)).select(joined(removed_keys).alias(k)).distinct().withColumn("__gone", F.lit(True))
        own = own.join(gone, k, "full_outer")
    else:
        own = own.withColumn("__gone", F.lit(False))
    names = {c: fresh_name(group, c.strip("_"), targets) for c in ("__there", "__alive", "__since", "__gone")}
    own = own.select(k, *(F.col(c).alias(n) for c, n in names.items()))
    there, is_alive, since, gone = (F.col(names[c]) for c in ("__there", "__alive", "__since", "__gone"))
    late = (since > F.col(_q(ref_time))) if ref_time and target_time else F.lit(False)
    kind = (
        F.when(there.isNull() & F.coalesce(gone, F.lit(False)), "deleted")
        .when(there.isNull(), "missing")
        .when(~is_alive, "deleted")
        .when(late, "late")
    )
    found = salted_left_join(group.withColumn(k, joined(mine)), own, k)
    return found.withColumn(out, kind).where(F.col(out).isNotNull()).drop(k, *names.values())


def orphan_report(orphans: DataFrame, by: list[str]) -> DataFrame:
    """Number of orphans per group (such as table, kind and period): partial counts before the shuffle."""
    return orphans.groupBy(*by).agg(F.count(F.lit(1)).alias("n_orphans"))


def _all(conditions) -> Column:
    whole = F.lit(True)
    for c in conditions:
        whole = whole & c
    return whole


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
