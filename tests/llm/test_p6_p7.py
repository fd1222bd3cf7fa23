import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import mixing, packing
from corpuskiln.llm.tokens import VOCABULARY, encoder, token_count

needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")


def test_bins_respect_capacity_and_conflicts():
    rng = random.Random(1)
    n = 3000
    sizes = np.array([rng.randrange(1, 2049) if rng.random() < 0.2 else rng.randrange(30, 900) for _ in range(n)])
    sources = [None if rng.random() < 0.1 else "hot" if rng.random() < 0.33 else f"s{rng.randrange(12)}" for _ in range(n)]
    clusters = [None if rng.random() < 0.1 else 0 if rng.random() < 0.1 else rng.randrange(1, 2000) for _ in range(n)]
    bins = packing.pack(sizes, sources, clusters)
    assert sorted(i for b in bins for i in b) == list(range(n))
    for b in bins:
        assert sum(sizes[i] for i in b) <= 2048
        for marks in (sources, clusters):
            held = [marks[i] for i in b if marks[i] is not None]
            assert len(held) == len(set(held))
    assert packing.pack(sizes, sources, clusters) == bins


def test_rules_cost_little_where_no_source_is_hot():
    rng = random.Random(4)
    n = 8000
    sizes = np.array([rng.randrange(1, 2049) if rng.random() < 0.15 else rng.randrange(30, 700) for _ in range(n)])
    sources = [f"s{int(rng.random() ** 1.3 * 24)}" for _ in range(n)]
    bins = packing.pack(sizes, sources, list(range(n)))
    assert sizes.sum() / 2048 / len(bins) > 0.98


def test_room_wins_where_rules_are_relaxed():
    rng = random.Random(2)
    n = 3000
    sizes = np.array([40 if i % 3 == 0 else rng.randrange(30, 900) for i in range(n)])
    clusters = [0 if i % 3 == 0 else i for i in range(n)]  # a third of all rows is one text
    apart, tight = (packing.pack(sizes, [None] * n, clusters, relax=k) for k in (False, True))
    assert sorted(i for b in tight for i in b) == list(range(n)) and max(sizes[b].sum() for b in tight) <= 2048
    assert sizes.sum() / 2048 / len(tight) > 0.99 > 0.5 > sizes.sum() / 2048 / len(apart)
    assert packing.pack(np.zeros(0, int), [], []) == []


def test_tightest_bin_is_found():
    bins = packing._Bins(10)
    for size in (7, 5, 4):
        bins.place(size, size, 0, 0)
    assert bins.held == [[7], [5, 4]]
    bins.place(1, 1, 0, 0)
    assert bins.held == [[7], [5, 4, 1]]  # residual 1 is tighter than residual 3
    a = packing._Bins(10)
    a.place(0, 6, 1, 0)
    a.place(1, 5, 2, 0)
    a.place(2, 4, 1, 0)
    assert a.held == [[0], [1, 2]]  # the tightest one holds the source already


def test_containers(spark):
    rows = [(i, 100 + i % 700, f"s{i % 5}", i % 90) for i in range(2000)] + [(5000, 5000, None, None), (5001, 4096, "s1", 7), (5002, 0, "s1", 8), (5003, None, "s1", 8), (None, 10, "s1", 1)]
    df = spark.createDataFrame(rows, "id bigint, n bigint, src string, c bigint").withColumns({"k": F.lit(1), "shard": F.lit(2)})
    got = packing.fill_containers(df, "id", "n", "src", "c", shard_items=500).collect()
    room, per = {}, {}
    for r in got:
        room[r["container"]] = room.get(r["container"], 0) + r["n_tokens"]
        per.setdefault(r["id"], []).append((r["first_token"], r["n_tokens"]))
    assert max(room.values()) <= 2048 and set(per) == {r[0] for r in rows if r[0] is not None and r[1]}
    for i, n, _, _ in rows:
        if i is not None and n:
            at = 0
            for first, size in sorted(per[i]):
                assert first == at
                at += size
            assert at == n and (len(per[i]) == 1 or n > 2048)
    for relax in (False, True):
        report = packing.fill_report(packing.fill_containers(df, "id", "n", "src", "c", relax=relax), df, "id", "src", "c").first()
        assert report["containers"] - report["price"] == report["fewest"] and (report["same_source"], report["copies"]) == (0, 0) or relax
    report = packing.fill_report(packing.fill_containers(df.limit(0), "id", "n", "src", "c"), df.limit(0), "id", "src", "c").first()
    assert report["containers"] == 0 and report["tokens"] == 0 and report["price"] == 0


@needs_vocabulary
def test_tokens(spark):
    texts = ["plain text", "", None, "<|endoftext|>", "x" * 20000, "木桥 émigré 😀"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = [r[0] for r in df.select(token_count(F.col("t")).alias("n")).collect()]
    assert got == [None if t is None else len(encoder().encode_ordinary(t)) for t in texts] and got[1] == 0
    m = {r["id"]: r for r in packing.measure(df, "id", "t", []).collect()}
    assert set(m) == {0, 1, 3, 4, 5} and m[5]["n_tokens"] == got[5]


def test_cheapest_flow():
    # source 0 -> 1 (cheap, 3), source -> 2 (dear, 5); both reach the sink 3
    assert mixing.min_cost_flow(4, [(0, 1, 3, 0), (0, 2, 5, 2), (1, 3, 9, 0), (2, 3, 2, 0)], 0, 3) == [3, 2, 3, 2]


def test_overlapping_sources_use_fresh_text_first():
    flows, total = mixing.route({("a",): 100, ("a", "b"): 100, ("b",): 50}, {"a": (0.5, 1), "b": (0.5, 2)}, 200)
    assert total == 200 and sum(v for (_, s), v in flows.items() if s == "a") == 100
    shared = sum(v for (p, _), v in flows.items() if p == ("a", "b"))
    assert shared <= 100  # nothing is repeated while fresh text is left
    flows, total = mixing.route({("a",): 10}, {"a": (0.5, 3), "gone": (0.5, 1)})
    assert total == 30 and mixing.route({}, {"a": (1.0, 1)}) == ({}, 0)


@pytest.mark.parametrize("bucket_rows", [100_000, 40])
def test_mixture(spark, bucket_rows):
    rng = random.Random(2)
    rows = [(i, rng.choice(["big", "big", "big", "mid", "small"]) if rng.random() < 0.95 else None, rng.randrange(20, 300), i if rng.random() < 0.6 else rng.randrange(200)) for i in range(3000)]
    size = {}
    rows = [(i, s, size.setdefault(c, n), c) for i, s, n, c in rows] + [(9000, "big", 0, 9000), (9001, "big", None, 9001), (9002, "mid", 50, None), (9003, "other", 50, 1)]
    targets = [("big", 0.3, 1), ("mid", 0.3, 2), ("small", 0.3, 3), ("gone", 0.1, 2)]
    df = spark.createDataFrame(rows, "id bigint, src string, n bigint, c bigint").withColumn("s", F.lit("x"))
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    chosen, report = mixing.mix_sources(df, t, "id", "src", "n", "c", bucket_rows=bucket_rows)
    by = {r["source"]: r for r in report.collect()}
    of = {i: (s, n) for i, s, n, _ in rows}
    for r in chosen.collect():
        s, n = of[r["id"]]
        assert r["source"] == s and r["n_tokens"] == n and 1 <= r["uses"] <= {a: c for a, _, c in targets}[s]
    assert chosen.count() == chosen.select("id").distinct().count()
    for s in ("big", "mid", "small"):
        assert abs(by[s]["share"] - 1 / 3) < 0.01
    assert by["gone"]["tokens"] == 0 and by["small"]["most_uses"] > 1
    again = mixing.mix_sources(df.repartition(5), t, "id", "src", "n", "c", bucket_rows=bucket_rows)[0]
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in chosen.collect()}


def test_shares_miss_by_one_document(spark):
    """Few large documents, in several sources at once: each source gets its quota up to one document."""
    rng = random.Random(8)
    rows = [(i, rng.choice("abc"), 0, i if rng.random() < 0.5 else 10000 + rng.randrange(40)) for i in range(300)]
    size = {c: rng.randrange(50, 4000) for _, _, _, c in rows}
    rows = [(i, s, size[c], c) for i, s, _, c in rows]
    df = spark.createDataFrame(rows, "id bigint, src string, n bigint, c bigint")
    targets = {"a": 0.5, "b": 0.3, "c": 0.2}
    t = spark.createDataFrame([(s, x, 2) for s, x in targets.items()], "source string, target_share double, max_repeats int")
    chosen, report = mixing.mix_sources(df, t, "id", "src", "n", "c")
    own = {i: n for i, _, n, _ in rows}
    for r in report.collect():
        recount = sum(own[x["id"]] * x["uses"] for x in chosen.where(F.col("source") == r["source"]).collect())
        assert recount == r["tokens"] and abs(recount - r["planned_total"] * targets[r["source"]]) <= max(own.values())


def test_no_mixture(spark):
    df = spark.createDataFrame([], "id bigint, src string, n bigint, c bigint")
    t = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    chosen, report = mixing.mix_sources(df, t, "id", "src", "n", "c")
    assert chosen.count() == 0 and report.first()["tokens"] == 0


def test_every_row_of_a_text_is_used(spark):
    rows = [(i, "a", 10, 1) for i in range(30)] + [(100 + i, "a", 10, 100 + i) for i in range(60)] + [(1000 + i, "b", 10, 1000 + i) for i in range(500)] + [(2000, "a", 12, 1), (2001, "b", 10, 1)]
    df = spark.createDataFrame(rows, "id bigint, src string, n bigint, c bigint")
    t = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    chosen, report = mixing.mix_sources(df, t, "id", "src", "n", "c")
    by, own = {r["source"]: r for r in report.collect()}, {i: n for i, _, n, _ in rows}
    assert by["a"]["planned_total"] == 2 * 2 * (90 * 10 + 12)
    used = chosen.where("source = 'a'").collect()
    assert len(used) == 91 and all(r["uses"] == 2 and r["n_tokens"] == own[r["id"]] for r in used)
    assert abs(by["b"]["share"] - 0.5) < 0.01
