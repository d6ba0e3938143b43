"""Steps whose work must grow no faster than their input, and that give what the plain forms give."""

import random
import re

import pytest

from scissile.operators import alignments, graphs, intervals, staging
from scissile.plans import run_stats
from tests.conftest import rows_of
from tests.test_graphs import roots


@pytest.mark.parametrize("low,high", [(30, 100), (1, 7), (-40, 20)])
def test_hits_of_a_read_meet_their_neighbours(spark, low, high):
    rng = random.Random(high)
    hits = [(rng.choice("xy"), rng.choice(["anchor", "adrift"]), "c", rng.choice("+-"), rng.randrange(-200, 900), rng.randrange(1, 40)) for _ in range(300)]
    got = alignments.pair_sam(spark.createDataFrame(hits, "qname string, end string, rname string, strand string, pos long, span long"), low, high)
    five = lambda h: h[4] + h[5] - 1 if h[3] == "-" else h[4]
    want = set()
    for a in (h for h in hits if h[1] == "anchor"):
        for b in (h for h in hits if h[1] == "adrift" and h[0] == a[0] and h[3] != a[3]):
            p, q = five(a), five(b)
            if low <= (q - p if a[3] == "+" else p - q) + 1 <= high:
                want.add((a[0], "c", a[3], min(p, q), max(p, q)))
    assert rows_of(got) == sorted(want, key=lambda r: tuple((True, str(x)) for x in r)) and want
    # The ends of a read are joined by place as well, not by the read alone.
    assert "__bucket" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("block", [7, 40, 1 << 20])
def test_origins_need_no_further_exchange(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice(["c", None]), p, p + rng.choice([0, 3, 60]), rng.choice("+-")) for p in (rng.randrange(-90, 700) for _ in range(220))]
    got = intervals.pileup_clusters(spark.createDataFrame(rows, "seqnames string, start long, end long, strand string"), [], 1, block)
    want = []
    for key in {(r[0], r[3]) for r in rows}:
        held = []
        for r in sorted(((r[1], r[2]) for r in rows if (r[0], r[3]) == key)) + [(10**6, 10**6)]:
            if held and r[0] > max(e for _, e in held) + 1:
                points = [e if key[1] == "-" else s for s, e in held]
                origin = max(set(points), key=lambda p: (points.count(p), p if key[1] == "-" else -p))
                want += [(key[0], key[1], s, e, held[0][0], ":".join(x for x in (key[0], key[1], str(origin)) if x)) for s, e in held]
                held = []
            held.append(r)
    assert rows_of(got.select("seqnames", "strand", "start", "end", "island", "clus_ori")) == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    # The last join exchanges the rows and the named ranges; origins of islands within a block aren't exchanged before it.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2


def test_stars_of_a_stretch(spark):
    links = [(rng.randrange(40), rng.randrange(40)) for rng in [random.Random(2)] for _ in range(60)] + [(77, 77)]
    rounds = []
    got = graphs.connected_components(spark.createDataFrame(links, "a long, b long").coalesce(1), task_links=100, rounds=rounds)
    assert {r["node"]: r["component"] for r in got.collect()} == roots(links)
    # 61 links either way are more than a task may hold, their stars are not: no round over all nodes.
    assert rounds == []


def test_only_pairs_link_pileups(spark, monkeypatch):
    seen = []
    plain = graphs.connected_components
    monkeypatch.setattr(graphs, "connected_components", lambda links, *more: (seen.append(links.count()), plain(links, *more))[1])
    rows = [("c", 100 * k, 100 * k + 9, "+") for k in range(50)] + [("c", 185, 205, "-")]
    got = {r["start"]: r["locus"] for r in graphs.assign_loci(spark.createDataFrame(rows, "seqnames string, start long, end long, strand string")).collect()}
    assert seen[0] == 4 and got[100] == "c:+:100|100" and got[185] == got[200] == got[300] == got[400] != got[500]


def test_a_locus_links_its_read_pairs_alone(spark, monkeypatch):
    seen = []
    plain = graphs.connected_components
    monkeypatch.setattr(alignments, "connected_components", lambda links, *more, **named: (seen.append(links.selectExpr("min(a) <= min(b)", "max(length(b))").first()), plain(links, *more, **named))[1])
    hits = [("p2", "c", 1, 30, "+"), ("p1", "c", 4, 30, "+"), ("p3", "d", 4, 31, "+"), ("p3", "d", 90, 121, "+"), (None, "d", 4, 31, "+")]
    got = alignments.multihit_clusters(spark.createDataFrame(hits, "read_pair string, seqnames string, start long, end long, strand string"))["alignments"]
    assert {(r["read_pair"], r["cluster"], r["width"]) for r in got.collect()} == {("p1", "p1", 27), ("p2", "p1", 30), ("p3", "p3", 30)}
    # Names of read pairs are all that is linked: no node for a locus.
    assert tuple(seen[0]) == (True, 2)


def test_tables_wait_for_no_counts_that_they_do_not_show(spark):
    core = spark.createDataFrame([("a", "demulti.reads", 5), ("a", "align.chimera.reads", 2), ("unassigned", "demulti.reads", 3)], "sampleName string, metric string, count long")
    evaluated = spark.createDataFrame([("b", "eval.total.algns", 4), ("a", "eval.paired.algns", 1)], "sampleName string, metric string, count long")
    reads = spark.createDataFrame([("c", 1, "x", 1, 9, "+", "uniq"), ("d", 1, "x", 1, 9, "+", "multi")], "sampleName string, ID int, seqnames string, start long, end long, strand string, type string")
    asked = []
    got = lambda name: run_stats.run_stats(core, lambda: asked.append(name) or evaluated, reads, names=evaluated.select("sampleName"), tables=[name])[name]
    whole = run_stats.run_stats(core, evaluated, reads)
    for name in whole:
        assert [tuple(r) for r in got(name).collect()] == [tuple(r) for r in whole[name].collect()]
    assert asked == ["incorporation"]


def test_recovered_multihits_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(staging, "TASK_ROWS", 50)
    rng = random.Random(8)
    kind = "sampleName string, ID int, seqnames string, start long, end long, strand string"
    some = lambda n: [(rng.choice("ab"), rng.randrange(60), rng.choice("cd"), s := rng.randrange(3 << 20), s + rng.randrange(40_000), rng.choice("+-")) for _ in range(n)]
    unique, multi = some(150), some(850)
    got = alignments.recover_multihits(spark.createDataFrame(unique, kind), spark.createDataFrame(multi, kind))
    kept = []
    for key in {(r[0], r[2], r[5]) for r in unique}:
        held, reach = [], 0
        own = [(r, t) for rows, t in ((unique, "uniq"), (multi, "multi")) for r in rows if (r[0], r[2], r[5]) == key]
        for r, t in [*sorted(own, key=lambda x: x[0][3:5]), (("", 0, "", 1 << 40, 0, ""), "uniq")]:
            if r[3] > reach:
                kept += held if any(x[1] == "uniq" for x in held) else []
                held = []
            held, reach = [*held, (r, t)], max(reach, r[4])
    left = [(r[0], r[1]) for r, t in kept if t == "multi"]
    assert 0 < len(left) < len(multi)
    assert rows_of(got.select(*(c.split()[0] for c in kind.split(", ")), "type", "contrib")) == sorted(((*r, t, 1.0 if t == "uniq" else 1 / left.count((r[0], r[1]))) for r, t in kept), key=lambda r: tuple((x is not None, str(x)) for x in r))
    # 1000 rows go to 20 tasks, though the session has 4 partitions; unique rows aren't exchanged once they are placed.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "20), REPARTITION_BY_NUM" in plan and "type" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_points_are_dealt_by_their_number(spark, monkeypatch, block):
    plans, plain = [], intervals.staged
    monkeypatch.setattr(intervals, "staged", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), plain(df))[1])
    monkeypatch.setattr(staging, "TASK_ROWS", 25)
    rng = random.Random(block)
    genes = [(rng.choice("ab"), s := rng.randrange(400_000), s + rng.choice([0, 90, 150_000]), f"G{i}") for i in range(30)]
    points = [(rng.choice("abc"), rng.randrange(420_000)) for _ in range(300)] + [("a", g[1]) for g in genes] + [(None, 5)]
    if block == 60:
        genes, points = [(c, s // 1000, e // 1000, n) for c, s, e, n in genes], [(c, p // 1000) for c, p in points]
    got = intervals.nearest_ranges(spark.createDataFrame(points, "seqnames string, pos long"), spark.createDataFrame(genes, "seqnames string, start long, end long, symbol string"), "pos", block)
    want = {}
    for c, p in {x for x in points if x[0]}:
        own = [g for g in genes if g[0] == c]
        held = [g[3] for g in own if g[1] <= p <= g[2]]
        before, after = max((g[2] for g in own if g[2] <= p), default=None), min((g[1] for g in own if g[1] >= p), default=None)
        first = after is None or before is not None and p - before <= after - p
        near = [g[3] for g in own if (g[2] == before if first else g[1] == after)]
        want[c, p] = (min(held), True) if held else (min(near, default=None), False)
    rows = got.collect()
    assert {(r["seqnames"], r["pos"]): (r["symbol"], r["inside"]) for r in rows} == want and len(rows) == len(want)
    # 331 points go to 14 tasks, though the session has 4 partitions, and aren't joined to the ranges that hold them a second time.
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
    assert "14), REPARTITION_BY_NUM" in plan and not re.search(r"hashpartitioning\(seqnames#\d+, pos#", plan)
