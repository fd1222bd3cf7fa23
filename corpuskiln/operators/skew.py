"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.keys import fresh_name

#: A key with more than this share of the rows is salted. At most ``1 / HOT_SHARE`` keys can exceed it, which bounds
#: the list of hot keys that is sent to every task.
HOT_SHARE = 1 / 200
#: Tracked items of the frequent-items sketch; its error is below ``HOT_SHARE`` of the rows.
TRACKED = 4096


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that (by a mergeable frequent-items sketch) hold more than ``share`` of the non-null rows.

    One map-side pass whose result is a few kilobytes; no shuffle by key. The sketch only steers balance, so its error
    never changes a result. At most ``1 / share`` keys come back.
    """
    most = int(1 / share)
    row = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k({_quoted(key)}, {most}, {TRACKED})").alias("top"),
    ).first()
    return [] if row is None or not row["n"] else [x[0] for x in row["top"] if x[1] > share * row["n"]]


def salted_left_join(many: DataFrame, one: DataFrame, key: str, salts: int = 64, hot: list | None = None, how: str = "left") -> DataFrame:
    """Join ``many`` with ``one`` (one row per key, or few) on the string column ``key``.

    Hot keys of ``many`` are spread over ``salts`` tasks; the rows of each hot key in ``one`` are repeated as often,
    which adds at most ``salts / HOT_SHARE`` rows where keys are unique. Null keys match nothing and are spread as well. ``how`` is ``left``,
    ``inner``, ``left_semi`` or ``left_anti``. Other columns of ``one`` must not clash with ``many``.
    """
    hot = hot_keys(many, key) if hot is None else hot
    s = fresh_name(many, "salt", one)
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    left = many.withColumn(s, F.when(F.col(key).isNull() | is_hot, spread).otherwise(F.lit(0)))
    right = one.withColumn(s, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, s], how).drop(s)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
