import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import near_dups as nd
from corpuskiln.llm.shingles import jaccard, shingles


def words(text, n):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def corpus(seed=1, families=25):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 150))]
        for v in range(rng.randrange(1, 5)):
            edited = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            out.append((f"f{f}v{v}", " ".join(edited)))
    boiler = " ".join(rng.choice(vocabulary) for _ in range(60))
    out += [(f"b{i}", boiler + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(10, 90)))) for i in range(20)]
    return out + [("copy1", out[0][1].upper()), ("copy2", out[0][1] + "!"), ("short", "one two"), ("empty", ""), ("null", None), (None, "some text without key at all here")]


def test_shingles():
    assert len(shingles("A b_c", 3)) == 1 and len(shingles("a b", 3)) == len(shingles(None, 3)) == 0
    a, b = "x y z u v w", "x y z u q r"
    assert jaccard(shingles(a, 3), shingles(b, 3)) == len(words(a, 3) & words(b, 3)) / len(words(a, 3) | words(b, 3))
    assert len(shingles("word " * 300000, 3)) == 1


def test_signature_is_unbiased():
    rng = np.random.default_rng(0)
    factors, summands = nd.permutations(400)
    errors = []
    for s in (0.3, 0.7, 0.9):
        both = rng.integers(0, 2**63, 400, dtype=np.uint64)
        rest = [rng.integers(0, 2**63, int(400 * (1 - s) / s / 2), dtype=np.uint64) for _ in range(2)]
        a, b = (nd.min_max_signature(np.concatenate((both, r)), factors, summands) for r in rest)
        errors.append(abs(float((a == b).mean()) - s))
    assert max(errors) < 0.06


@pytest.mark.parametrize("most", [64, 1])
@pytest.mark.parametrize("width,threshold", [(3, 0.7), (5, 0.8)])
def test_pairs_against_brute_force(spark, most, width, threshold):
    rows = corpus()
    df = spark.createDataFrame([*rows, rows[0]], "hash string, doc string").withColumns({"class": F.lit(1), "band": F.lit(2)}).repartition(5)
    members, pairs = nd.similar_classes(df, F.col("hash"), F.col("doc"), width=width, threshold=threshold, most=most)
    got = {(r["key_a"], r["key_b"]) for r in nd.similar_pairs(members, pairs).collect()}
    sets = {k: words(t, width) for k, t in rows if k and t and words(t, width)}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}
    assert got == want and len(want) > 5


@pytest.mark.parametrize("size", [3, 10, 20, 50, 300])
def test_recall_at_the_threshold_by_set_size(size):
    """Pairs just at 0.7 share a band in 999 of 1000 cases, small sets too."""
    rng = np.random.default_rng(size)
    factors, summands = nd.permutations(nd.ROWS * nd.BANDS // 2)
    common, found, tries = int(np.ceil(0.7 * size - 1e-9)), 0, 3000
    for _ in range(tries):
        whole = rng.integers(0, 2**64, size, dtype=np.uint64)
        cut = int(rng.integers(0, size - common + 1))
        keys = [nd.band_keys(nd.min_max_signature(x, factors, summands), nd.ROWS, nd.BANDS) for x in (whole[:common + cut], np.concatenate((whole[:common], whole[common + cut:])))]
        found += (keys[0] == keys[1]).any()
    assert found / tries >= 0.999


def test_one_key_with_several_texts(spark):
    a, b = "a b c d e f g h i j", "q r s t u v w x y z"
    df = spark.createDataFrame([("k1", a), ("k1", b), ("k2", b + " zz"), ("k3", a + " zz")], "hash string, doc string")
    got = {(r["key_a"], r["key_b"]) for r in nd.similar_pairs(*nd.similar_classes(df, F.col("hash"), F.col("doc"), width=3, threshold=0.7)).collect()}
    assert got == {("k1", "k2"), ("k1", "k3")}


def test_groups(spark):
    rows = corpus(2, 6)
    df = spark.createDataFrame(rows, "hash string, doc string")
    members, pairs = nd.similar_classes(df, F.col("hash"), F.col("doc"), width=3, threshold=0.7)
    groups = {r["key"]: (r["group"], r["n_links"]) for r in nd.similar_groups(members, pairs).collect()}
    assert len(groups) == members.select("key").distinct().count()
    for r in nd.similar_pairs(members, pairs).collect():
        assert groups[r["key_a"]][0] == groups[r["key_b"]][0]
    assert groups["copy1"] == groups["copy2"]


def test_long_chain_is_one_group(spark):
    members = spark.createDataFrame([(f"k{i}", i) for i in range(40)], "key string, class bigint")
    pairs = spark.createDataFrame([(i, i + 1, 0.9) for i in range(39)], "a bigint, b bigint, similarity double")
    got = nd.similar_groups(members, pairs).collect()
    assert {r["group"] for r in got} == {0} and sorted(r["n_links"] for r in got)[:2] == [1, 1]


def test_a_family_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 50)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        t = list(base)
        for _ in range(3):
            t[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        rows.append((f"h{i:03d}", " ".join(t)))
    df = spark.createDataFrame(rows, "hash string, doc string")
    got = {(r[0], r[1]) for r in nd.similar_pairs(*nd.similar_classes(df, F.col("hash"), F.col("doc"), width=3, threshold=0.7)).select("key_a", "key_b").collect()}
    sets = {k: words(t, 3) for k, t in rows}
    keys = sorted(sets)
    assert got == {(a, b) for i, a in enumerate(keys) for b in keys[i + 1:] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}


def test_nothing(spark):
    df = spark.createDataFrame([], "hash string, doc string")
    members, pairs = nd.similar_classes(df, F.col("hash"), F.col("doc"))
    assert members.count() == pairs.count() == nd.similar_pairs(members, pairs).count() == nd.similar_groups(members, pairs).count() == 0
