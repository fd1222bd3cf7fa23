"""Near-duplicates by min-max hashing: every pair above a similarity, without pairwise comparison.

Method. A body's word shingles are hashed once and permuted ``rows / 2 * bands`` times; both the minimum and the maximum
under each permutation are kept, so half as many evaluations give a signature of ``rows * bands`` unbiased values. Half of the
bands are cut from the minima, half from the maxima, so no band holds both values of one permutation, which depend on each
other in small sets. Bodies that agree in a band are candidates, and each candidate pair is compared exactly.

What keeps it whole and balanced:

* bodies with one shingle set are one class; only its representative is banded, members are joined back at the end;
* a band value shared by more than ``most`` representatives is crowded. Its bodies are dealt into blocks, each pair of blocks
  is one task's cell, and a pair is made only in the first band on which its bodies agree, so no pair is made twice and no
  task gets the whole family. Nothing is capped;
* band values that hold a large part of all rows are found by a sketch and go to blocks without being shuffled first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.shingles import jaccard, mix, shingles
from corpuskiln.operators.skew import hot_keys, salted_left_join
from corpuskiln.session import ship_package, spread, stage_table

#: Values in a band and bands. A pair of similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS: 0.99998 at 0.7,
#: whatever the size of the sets.
ROWS, BANDS = 5, 60
#: Most representatives of one band value from which pairs are made in one go, and the expected bodies of a block beyond that.
MOST, BLOCK = 64, 256
_SEED = 20240229


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of ``count`` permutations of 32-bit values."""
    rng = np.random.default_rng(_SEED)
    return rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, count, dtype=np.uint32)


def min_max_signature(hashes: np.ndarray, factors: np.ndarray, summands: np.ndarray) -> np.ndarray:
    """(permutations, 2) minima and maxima of a non-empty set of hashes."""
    low, high = np.full(len(factors), 2**32 - 1, np.uint32), np.zeros(len(factors), np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 2048):  # keeps the block in the processor's cache
        block = np.multiply.outer(factors, short[i:i + 2048])
        block += summands[:, None]
        np.minimum(low, block.min(axis=1), out=low)
        np.maximum(high, block.max(axis=1), out=high)
    return np.stack([low, high], axis=1)


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key for each band, of minima or of maxima only; the band's number is part of the key."""
    values = signature.T.reshape(bands, rows).astype(np.uint64)
    key = mix(np.arange(1, bands + 1, dtype=np.uint64))
    for j in range(rows):
        key = mix(key ^ values[:, j])
    return key


def _signed(df: DataFrame, width: int, rows: int, bands: int) -> DataFrame:
    """(key, text_hash, class, keys) of (key, text, text_hash) rows: ``class`` is the 64-bit hash of the shingle set, ``keys`` its band
    keys. Sets without shingles drop out."""
    import xxhash

    factors, summands = permutations(rows * bands // 2)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, classes, keys = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                s = shingles(text, width)
                if len(s):
                    kept.append(i)
                    classes.append(xxhash.xxh3_64_intdigest(s.tobytes()))
                    keys.append(band_keys(min_max_signature(s, factors, summands), rows, bands))
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), pa.array(flat))
            kept = pa.array(kept, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("key").take(kept), batch.column("text_hash").take(kept), pa.array(np.array(classes, np.uint64).view(np.int64)), lists], ["key", "text_hash", "class", "keys"])

    return df.mapInArrow(sign, "key string, text_hash bigint, class bigint, keys array<bigint>")


def _pairs_of_keys(banded: DataFrame, most: int) -> DataFrame:
    """From (band, class) rows: pairs (a, b) of every band value with at most ``most`` classes; a larger one gives (class, band, alone)."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held = None, np.zeros(0, np.int64)  # the value that may go on in the next batch, at most ``most`` + 1 classes of it
        for batch in batches:
            if not len(batch):
                continue
            k, c = batch["band"].to_numpy(np.int64), batch["class"].to_numpy(np.int64)
            if held_key is not None:
                k, c = np.concatenate((np.full(len(held), held_key), k)), np.concatenate((held, c))
            starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            sizes = np.diff(np.append(starts, len(k)))
            out_a, out_b, over = [], [], []
            last = len(starts) - 1
            two = starts[:last][sizes[:last] == 2]
            out_a.append(np.minimum(c[two], c[two + 1]))
            out_b.append(np.maximum(c[two], c[two + 1]))
            for g in np.flatnonzero(sizes[:last] > 2):
                _group(k[starts[g]], c[starts[g]:starts[g] + sizes[g]], out_a, out_b, over)
            tail = c[starts[last]:]
            if len(tail) > most:  # all but the first ones are told off now; the rest keeps the value known as too large
                over.append((tail[most + 1:], k[-1]))
                tail = tail[:most + 1]
            held_key, held = k[-1], tail
            yield _frame(out_a, out_b, over)
        out_a, out_b, over = [], [], []
        if len(held) > 1:
            _group(held_key, held, out_a, out_b, over)
        yield _frame(out_a, out_b, over)

    def _group(band: int, c: np.ndarray, out_a: list, out_b: list, over: list) -> None:
        if len(c) > most:
            over.append((c, band))
            return
        i, j = np.triu_indices(len(c), 1)
        out_a.append(np.minimum(c[i], c[j]))
        out_b.append(np.maximum(c[i], c[j]))

    def _frame(out_a: list, out_b: list, over: list) -> pd.DataFrame:
        a, b, o, o_band = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (out_a, out_b, [c for c, _ in over], [np.full(len(c), band) for c, band in over]))
        return pd.DataFrame({"a": np.concatenate((a, o)), "b": np.concatenate((b, o_band)), "alone": np.concatenate((np.zeros(len(a), bool), np.ones(len(o), bool)))}).drop_duplicates()

    return banded.repartition("band").sortWithinPartitions("band").mapInPandas(walk, "a bigint, b bigint, alone boolean")


def _cells(crowded: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b), each once, of the (class, band) rows, with the cell (band, lo, hi) that made them."""
    sizes = crowded.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = salted_left_join(crowded, sizes, "band", how="inner").join(reps, "class")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "class", "block", "keys")

    def pair_up(cell: pd.DataFrame) -> pd.DataFrame:
        band, lo, hi = (int(cell[c].iloc[0]) for c in ("band", "lo", "hi"))
        keys, classes, block = np.stack(cell["keys"].to_numpy()), cell["class"].to_numpy(np.int64), cell["block"].to_numpy()
        here = int(np.flatnonzero(keys[0] == band)[0])
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        out_a, out_b = [], []
        for i in left:
            first = (keys[i] == keys[right]).argmax(axis=1) == here  # no band before this one agrees
            j = right[first & (classes[right] > classes[i] if lo == hi else True)]
            out_a.append(np.minimum(classes[i], classes[j]))
            out_b.append(np.maximum(classes[i], classes[j]))
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (out_a, out_b))
        return pd.DataFrame({"band": np.full(len(a), band), "lo": np.full(len(a), lo, np.int32), "hi": np.full(len(a), hi, np.int32), "a": a, "b": b})

    return rows.groupBy("band", "lo", "hi").applyInPandas(pair_up, "band bigint, lo int, hi int, a bigint, b bigint")


def _compare_cells(cells: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """(a, b, similarity) of the cells' similar pairs; each text travels once per cell that needs it."""
    cell, there = ["band", "lo", "hi"], [F.col("band").alias("in_band"), F.col("lo").alias("in_lo"), F.col("hi").alias("in_hi")]
    wanted = cells.select(*there, F.explode(F.array("a", "b")).alias("class")).distinct().join(texts, "class")

    def compare(pairs: pd.DataFrame, bodies: pd.DataFrame) -> pd.DataFrame:
        sets = {c: shingles(t, width) for c, t in zip(bodies["class"], bodies["text"])}
        got = np.array([jaccard(sets[a], sets[b]) for a, b in zip(pairs["a"], pairs["b"])], float)
        return pairs[["a", "b"]].assign(similarity=got)[got >= threshold]

    return cells.groupBy(*cell).cogroup(wanted.groupBy("in_band", "in_lo", "in_hi")).applyInPandas(compare, "a bigint, b bigint, similarity double")


def similar_classes(df: DataFrame, key: Column, text: Column, *, width: int = 5, threshold: float = 0.8, rows: int = ROWS, bands: int = BANDS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): ``members`` has (key, class) of each distinct key; ``pairs`` (a, b, similarity) of classes, a < b.

    Two keys are similar if they have one class or their classes are a pair. Null keys, null texts and texts of fewer than
    ``width`` words take no part. Rows with one key count once; if their texts differ, the key is in several classes. Classes
    are told apart by 64 bits of the shingle set. An empty table gives two empty frames; other columns are ignored, whatever
    they are called.
    """
    ship_package(df.sparkSession)
    source = df.select(key.alias("key"), text.alias("text"), F.xxhash64(text).alias("text_hash")).where("key is not null and text is not null")
    signed = stage_table(_signed(spread(source), width, rows, bands), "signed")
    members = signed.select("key", "class").distinct()
    reps = signed.groupBy("class").agg(F.first("keys").alias("keys"))
    banded = reps.select("class", F.explode("keys").alias("band"))
    banded = stage_table(banded, "banded")
    hot = hot_keys(banded, "band", 1 / 2000)
    cold, warm = (banded.where(~F.col("band").isin(hot)), banded.where(F.col("band").isin(hot))) if hot else (banded, banded.limit(0))
    walked = stage_table(_pairs_of_keys(cold, most).distinct(), "walked")
    crowded = walked.where("alone").select(F.col("a").alias("class"), F.col("b").alias("band")).union(warm.select("class", "band"))
    candidates = walked.where("not alone").select("a", "b")

    rep_of = signed.groupBy("class").agg(F.min(F.struct("key", "text_hash")).alias("body")).select("class", "body.*")
    texts_of = lambda classes: source.join(rep_of.join(classes, "class", "left_semi"), ["key", "text_hash"]).groupBy("class").agg(F.min("text").alias("text"))
    candidates = stage_table(candidates, "candidates")
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("class")).union(crowded.select("class")).distinct()
    texts = stage_table(texts_of(wanted), "texts")
    both = candidates.join(texts.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            got = []
            for a, b, ta, tb in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                for c, t in ((a, ta), (b, tb)):
                    if c not in sets:
                        sets[c] = shingles(t, width)
                got.append(jaccard(sets[a], sets[b]))
            yield batch[["a", "b"]].assign(similarity=got)

    pairs = both.mapInPandas(compare, "a bigint, b bigint, similarity double").where(F.col("similarity") >= threshold)
    if not crowded.isEmpty():
        cells = stage_table(_cells(crowded, reps), "cells")
        pairs = pairs.unionByName(_compare_cells(cells, texts, width, threshold)).distinct()  # a pair may agree in a crowded and in another band
    return members, stage_table(pairs, "pairs")


def similar_pairs(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """All pairs of different keys (key_a < key_b) whose classes are equal or a pair, with their similarity.

    This expands classes; ``similar_groups`` gives a row per key with its class's links instead. The members of a class are
    dealt over as many tasks as it has blocks of keys, and joins on a hub are salted.
    """
    left, right = members.select(F.col("key").alias("x"), F.col("class").alias("a")), members.select(F.col("key").alias("y"), F.col("class").alias("b"))
    crossed = salted_left_join(salted_left_join(pairs, left, "a", how="inner"), right, "b", hot=hot_keys(pairs, "b"), how="inner").select("x", "y", "similarity")
    several = members.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    inner = salted_left_join(members, several, "class", how="inner")
    one = inner.select(F.col("key").alias("x"), "class", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"))
    other = inner.select(F.col("key").alias("y"), "class", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    within = one.join(other, ["class", "block"]).where("x < y").select("x", "y", F.lit(1.0).alias("similarity"))
    whole = crossed.unionByName(within).where("x <> y")
    return whole.groupBy(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).agg(F.max("similarity").alias("similarity"))


def similar_groups(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, group, n_links): connected groups of similar keys; ``group`` is the smallest class reached, links are of the class.

    Labels sink along the links and then along themselves (pointer jumping), so a chain of length n takes about log n rounds;
    each round is staged. Classes without links are their own group.
    """
    nodes = members.select("class").distinct()
    edges = stage_table(pairs.select("a", "b").union(pairs.select("b", "a")), "edges")
    label = stage_table(nodes.select("class", F.col("class").alias("label")), "label")
    while True:
        near = edges.join(label, edges["b"] == label["class"]).groupBy(F.col("a").alias("class")).agg(F.min("label").alias("best"))
        sunk = stage_table(label.join(near, "class", "left").select("class", F.least("label", F.coalesce("best", "label")).alias("label"), (F.col("best") < F.col("label")).alias("moved")), "label")
        if sunk.where("moved").isEmpty():
            break
        up = sunk.select(F.col("class").alias("label"), F.col("label").alias("up"))
        label = stage_table(sunk.select("class", "label").join(up, "label", "left").select("class", F.least("label", F.coalesce("up", "label")).alias("label")), "label")
    links = edges.groupBy(F.col("a").alias("class")).agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(label, "class").join(links, "class", "left").select("key", F.col("label").alias("group"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
