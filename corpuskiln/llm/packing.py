"""Filling containers of fixed capacity: conflict-constrained best-fit decreasing.

Method. Texts above the capacity give full containers of their own and a rest; everything else is one item. Items are dealt
by hash into shards of bounded size and each shard is packed by itself: bins are ordered by the room left (a bitmap over the
possible residuals gives the successor in constant time) and carry bitmaps of their sources and of the duplicate clusters they
hold. The search goes from the tightest bin that fits upwards until a compatible one is found, else a bin is opened.

No container holds two rows of one source or two copies of one text. To leave little room under these rules, items are placed in
three orders, of which the one with the fewest bins counts: by size, by size times a weight of the source's frequency, and by
source, frequent ones first, among the large and then among the small items: rare ones then still find a bin of other sources. Bins
below ``good`` are emptied and packed once more. What the rules cost is reported (``fill_report``). Where a source or a text has
so many rows that it must waste room, ``relax`` packs the items of bins below ``good`` again without the rule on sources and
then without that on copies; it is off.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.tokens import VOCABULARY, encoder
from corpuskiln.session import ship_package, spread, stage_table

CAPACITY = 2048
#: Items of a shard (expected): bounds one task's memory. A shard leaves about one container's room unused.
SHARD_ITEMS = 50_000
#: A container at least this full is left as it is.
GOOD = 0.99
#: How much a source's share of the rows adds to an item's size in the weighted order.
ORDER_WEIGHT = 20


class _Bins:
    """Bins by residual; bins with equal residual and bitmaps are interchangeable and kept in one list."""

    def __init__(self, capacity: int):
        self.capacity, self.held, self.at, self.mask = capacity, [], {}, 0

    def place(self, item: int, size: int, source: int, cluster: int) -> None:
        found = self._tightest(size, source, cluster)
        if found:
            residual, key = found
            same = self.at[residual][key]
            number = same.pop()
            if not same:
                del self.at[residual][key]
                if not self.at[residual]:
                    del self.at[residual]
                    self.mask &= ~(1 << residual)
        else:
            residual, key, number = self.capacity, (0, 0), len(self.held)
            self.held.append([])
        self.held[number].append(item)
        left = residual - size
        self.at.setdefault(left, {}).setdefault((key[0] | source, key[1] | cluster), []).append(number)
        self.mask |= 1 << left

    def _tightest(self, size: int, source: int, cluster: int) -> tuple[int, tuple[int, int]] | None:
        residual, rest = size, self.mask >> size
        while rest:
            step = (rest & -rest).bit_length() - 1
            residual += step
            for key in self.at[residual]:
                if not key[0] & source and not key[1] & cluster:
                    return residual, key
            rest >>= step + 1
            residual += 1
        return None


def pack(sizes: np.ndarray, sources: list, clusters: list, capacity: int = CAPACITY, good: float = GOOD, relax: bool = False) -> list[list[int]]:
    """Bins (lists of item numbers) for items of 1 to ``capacity``. Ties are broken by position, so equal input packs equally.

    ``None`` as source or cluster conflicts with nothing. Items of one source or one cluster are never in one bin, unless
    ``relax`` lets room win over the rules.
    """
    sizes = np.asarray(sizes, np.int64)
    rows = Counter(s for s in sources if s is not None)
    source_bit = {s: 1 << i for i, s in enumerate(sorted(rows))}
    often = Counter(c for c in clusters if c is not None)
    cluster_bit = {c: 1 << i for i, c in enumerate(sorted(c for c, n in often.items() if n > 1))}
    frequency = np.array([rows[s] if s is not None else 0 for s in sources], np.int64)

    def placed(items: np.ndarray, by_source: bool, by_cluster: bool) -> _Bins:
        n, f = sizes[items], frequency[items]
        by_size = np.lexsort((items, -n))
        orders = [np.lexsort((items, -n, -f, n <= capacity // 2)), np.lexsort((items, -n * (1 + ORDER_WEIGHT * f / max(1, len(sizes))))), by_size] if by_source else [by_size]
        best = None
        for order in orders:
            bins = _Bins(capacity)
            for i in items[order].tolist():
                bins.place(i, int(sizes[i]), source_bit.get(sources[i], 0) if by_source else 0, cluster_bit.get(clusters[i], 0) if by_cluster else 0)
            if best is None or len(bins.held) < len(best.held):
                best = bins
        return best

    bins = placed(np.arange(len(sizes)), True, True)
    full, loose = _sorted_out(bins, sizes, good * capacity)
    again = placed(loose, True, True)
    if len(full) + len(again.held) > len(bins.held):
        full, again = [], bins
    for by_cluster in (True, False) if relax else ():
        done, loose = _sorted_out(again, sizes, good * capacity)
        full += done
        again = placed(loose, False, by_cluster)
    return full + again.held


def _sorted_out(bins: _Bins, sizes: np.ndarray, least: float) -> tuple[list[list[int]], np.ndarray]:
    """Bins that hold ``least`` or more, and the items of the others."""
    room = [sum(int(sizes[i]) for i in b) for b in bins.held]
    return [b for b, r in zip(bins.held, room) if r >= least], np.array(sorted(i for b, r in zip(bins.held, room) if r < least for i in b), np.int64)


def measure(df: DataFrame, key: str, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, keep..., n_tokens, cluster): whole texts' tokens and the hash of the text without regard to case and spacing.

    Null texts drop out; an empty text has no tokens. ``keep`` must not name ``n_tokens`` or ``cluster``.
    """
    import xxhash

    ship_package(df.sparkSession)
    source = df.where(F.col(text).isNotNull()).select(key, *keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("__text").schema) + ", n_tokens bigint, cluster bigint"

    def count(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            sizes = [len(enc.encode_ordinary(t)) for t in batch["__text"]]
            hashes = [xxhash.xxh3_64_intdigest(" ".join(t.lower().split()).encode("utf-8", "surrogatepass")) for t in batch["__text"]]
            yield batch.drop(columns="__text").assign(n_tokens=sizes, cluster=np.array(hashes, np.uint64).view(np.int64))

    return spread(source).mapInPandas(count, schema)


def fill_containers(sized: DataFrame, key: str, size: str, source: str, cluster: str, *, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, relax: bool = False) -> DataFrame:
    """(container, slot, key, part, first_token, n_tokens): every token of every row once, containers within the capacity.

    Only rows above the capacity are split, into full containers and at most one rest, which keeps the row's source and cluster. Rows of size null or 0 take no room and
    drop out, as do rows with a null key. ``key`` must be unique; other columns are ignored, whatever they are called. An empty table gives no containers. Containers are numbered ``shard-number``; a full
    part of an oversized row is a container of its own, ``full-key-part``.
    """
    ship_package(sized.sparkSession)
    sized = stage_table(sized.select(F.col(key).alias("k"), F.col(size).cast("bigint").alias("n"), F.col(source).cast("string").alias("s"), F.col(cluster).cast("bigint").alias("c")).where("n > 0 and k is not null"), "sized")
    count = sized.count()
    shards = max(1, math.ceil(count / shard_items))
    key_type = sized.schema["k"].dataType.simpleString()
    whole = F.floor(F.col("n") / capacity).cast("int")
    alone = sized.where(F.col("n") >= capacity).select("k", F.explode(F.sequence(F.lit(0), whole - 1)).alias("part"))
    alone = alone.select(F.concat(F.lit("full-"), F.col("k").cast("string"), F.lit("-"), F.col("part").cast("string")).alias("container"), F.lit(0).alias("slot"), "k", "part", (F.col("part").cast("bigint") * capacity).alias("first_token"), F.lit(capacity).cast("bigint").alias("n_tokens"))
    rest = sized.where(F.col("n") % capacity > 0).select("k", whole.alias("part"), (F.col("n") % capacity).alias("n"), "s", "c", F.pmod(F.xxhash64("k"), F.lit(shards)).cast("int").alias("shard"))

    def pack_shard(number: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("k", kind="stable").reset_index(drop=True)
        sources = [None if pd.isna(s) else s for s in items["s"]]
        clusters = [None if pd.isna(c) else c for c in items["c"]]
        bins = pack(items["n"].to_numpy(), sources, clusters, capacity, relax=relax)
        at = [(f"{number[0]}-{b}", slot, i) for b, held in enumerate(bins) for slot, i in enumerate(held)]
        taken = items.iloc[[i for _, _, i in at]]
        return pd.DataFrame({"container": [c for c, _, _ in at], "slot": [s for _, s, _ in at], "k": taken["k"].to_numpy(), "part": taken["part"].to_numpy(), "first_token": taken["part"].to_numpy().astype(np.int64) * capacity, "n_tokens": taken["n"].to_numpy()})

    # a string, as pandas would make a nullable hash a float
    rest = rest.withColumn("c", F.col("c").cast("string"))
    packed = rest.groupBy("shard").applyInPandas(pack_shard, f"container string, slot int, k {key_type}, part int, first_token bigint, n_tokens bigint")
    return alone.unionByName(packed).withColumnRenamed("k", key)


def fill_report(containers: DataFrame, sized: DataFrame, key: str, source: str, cluster: str, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, the fewest containers possible, the price of the rules (containers above the fewest), share of
    room used, the fullest container, and the containers that hold two rows of one source or two copies of one text."""
    of = sized.select(F.col(key).alias("k"), F.col(source).cast("string").alias("s"), F.col(cluster).alias("c")).where("k is not null")
    joined = containers.select("container", F.col(key).alias("k"), "n_tokens").join(of, "k")
    twice = lambda c: F.count(c) > F.size(F.collect_set(c))  # noqa: E731 - of one container's items
    each = joined.groupBy("container").agg(F.sum("n_tokens").alias("t"), twice("s").alias("same_source"), twice("c").alias("copies"))
    fewest = F.coalesce(F.ceil(F.sum("t") / capacity), F.lit(0)).cast("bigint")
    return each.agg(
        F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"), fewest.alias("fewest"), (F.count(F.lit(1)) - fewest).alias("price"),
        F.round(F.sum("t") / (F.count(F.lit(1)) * capacity), 6).alias("fill"), F.coalesce(F.max("t"), F.lit(0)).alias("fullest"), F.count_if("same_source").alias("same_source"), F.count_if("copies").alias("copies"),
    )
