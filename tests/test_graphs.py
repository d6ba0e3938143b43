"""Components in logarithmic rounds, their growth by further links, multihits run by run, and staged tables' ends."""

import math
import os
import random

import pytest

from scissile.operators import alignments, graphs, staging


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in list(parent)}


def shapes():
    rng = random.Random(5)
    shuffled = rng.sample(range(64), 64)
    comb = [(i, i + 1) for i in range(0, 60, 2)] + [(i, i + 2) for i in range(0, 60, 2)]
    return {
        "ascending chain": [(i, i + 1) for i in range(100)],
        "descending chain": [(i + 1, i) for i in range(100)],
        "shuffled chain": list(zip(shuffled, shuffled[1:])),
        "zigzag chain": [(i // 2 if i % 2 else 99 - i // 2, (i + 1) // 2 if (i + 1) % 2 else 99 - (i + 1) // 2) for i in range(98)],
        "star of a large hub": [(999, i) for i in range(60)],
        "star of a small hub": [(0, i) for i in range(1, 60)],
        "comb": comb,
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(70)],
        "pairs and loops": [(i, i) for i in range(9)] + [(20 + 2 * i, 21 + 2 * i) for i in range(9)],
    }


@pytest.mark.parametrize("name", shapes())
def test_rounds_are_logarithmic(spark, name):
    links = shapes()[name]
    rounds = []
    got = graphs.connected_components(spark.createDataFrame(links, "a long, b long").repartition(3), task_links=0, rounds=rounds)
    assert {r["node"]: r["component"] for r in got.collect()} == roots(links)
    assert len(rounds) <= math.log2(len(roots(links)))
    staging.release(spark)


def test_a_link_with_one_end(spark):
    got = graphs.connected_components(spark.createDataFrame([("a", None), (None, "b"), (None, None), ("b", "c")], "a string, b string"), task_links=0)
    assert {r["node"]: r["component"] for r in got.collect()} == {"a": "a", "b": "b", "c": "b"}


@pytest.mark.parametrize("task_links", [0, 1 << 20])
def test_further_links_equal_all_at_once(spark, task_links):
    rng = random.Random(task_links)
    links = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(45)]
    table = lambda part: spark.createDataFrame(part, "a string, b string")
    known = graphs.connected_components(table(links[:25]), task_links)
    got = graphs.extend_components(known, table(links[25:]), task_links).collect()
    assert {r["node"]: r["component"] for r in got} == roots(links) and len(got) == len(roots(links))
    none = graphs.extend_components(known, table([]), task_links).collect()
    assert {r["node"]: r["component"] for r in none} == roots(links[:25])


@pytest.mark.parametrize("task_links", [0, 1 << 20])
def test_runs_combined_equal_all_at_once(spark, task_links):
    rng = random.Random(3)
    hits = [(f"p{r}{rng.randrange(12):02d}", "c", p, p + rng.randrange(10, 40), "+") for r in range(3) for _ in range(22) for p in [rng.randrange(0, 900, 3)]]
    table = lambda part: spark.createDataFrame(part, "read_pair string, seqnames string, start long, end long, strand string")
    whole = alignments.multihit_clusters(table(hits))["alignments"].select("read_pair", "cluster").distinct().collect()
    first = alignments.multihit_clusters(table([h for h in hits if h[0][1] == "0"]))
    cluster = {r["read_pair"]: r["cluster"] for r in first["alignments"].collect()}
    points = alignments.multihit_points(first)
    for k in "12":
        more = alignments.combine_multihits(points, table([h for h in hits if h[0][1] == k]), task_links=task_links)
        renamed = {r["cluster"]: r["combined"] for r in more["renamed"].collect()}
        assert set(renamed) <= set(cluster.values())
        cluster = {p: renamed.get(c, c) for p, c in cluster.items()} | {r["read_pair"]: r["cluster"] for r in more["pairs"].collect()}
        points = more["points"]
    assert cluster == {r["read_pair"]: r["cluster"] for r in whole} and len(set(cluster.values())) > 1
    assert {tuple(r) for r in points.collect()} == {(cluster[p], c, s, start) for p, c, start, _, s in hits}


def test_scopes_delete_what_was_staged(spark):
    folder = staging.shared_folder(spark).removeprefix("file://")
    staging.release(spark)
    before = set(os.listdir(folder))
    with staging.scope(spark):
        got = graphs.connected_components(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long"), task_links=0)
        assert got.count() == 10 and len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) == before
    kept = graphs.connected_components(spark.createDataFrame([(1, 2)], "a long, b long"))
    assert kept.count() == 2 and len(set(os.listdir(folder)) - before) == 1
    staging.release(spark)
    assert set(os.listdir(folder)) == before
