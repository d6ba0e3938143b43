"""Registered queries over whole tables against brute force on a small folder."""

import hashlib
import random
from collections import Counter, defaultdict
from statistics import median

import pytest

from scissile.plans import contract


def make_lines():
    rng = random.Random(3)
    return [(k, n, rng.randint(1, 400), rng.randint(1, 60), float(rng.randint(1, 50)), rng.choice("OF"), rng.choice("ANR")) for k in range(1, 301) for n in range(1, rng.randint(2, 4))]


LINES = make_lines()
ORDERS = [(k, k * 7 % 61 + 1) for k in range(1, 301)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("lines"))
    kind = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_linestatus string, l_returnflag string"
    spark.createDataFrame(LINES, kind).repartition(3).write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame(ORDERS, "o_orderkey long, o_custkey long").repartition(3).write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(c,) for c in range(1, 40)], "c_custkey long").write.parquet(f"{d}/customer.parquet")
    return d


def components(links):
    """node -> a name of its component."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b), near[b].add(a)
    out = {}
    for x in near:
        queue = [x] if x not in out else []
        while queue:
            y = queue.pop()
            if y not in out:
                out[y] = x
                queue += near[y]
    return out


def test_clusters_of_every_key(spark, folder):
    named = components((("k", k), ("v", v)) for k, _, v, *_ in LINES)
    least = {}
    for k, *_ in sorted(LINES):
        least.setdefault(named["k", k], k)
    got = [tuple(r) for r in contract.queries()["cluster_kv"](spark, folder).select("k", "cluster").collect()]
    assert sorted(got) == sorted({(k, least[named["k", k]]) for k, *_ in LINES})


def fragments():
    """(orderkey, linenumber, partkey, chromosome, strand, start, end, 5' end, sample) of LINES."""
    out = []
    for k, n, v, sup, q, status, flag in LINES:
        s, plus = 5 * k + n, status == "O"
        out.append((k, n, v, f"chr{sup % 5}", "+" if plus else "-", s, s + int(q), s if plus else s + int(q), f"{flag}-{n}"))
    return out


def test_multihit_clusters_of_every_fragment(spark, folder):
    hits = {(str(v), c, strand, s, e, p) for _, _, v, c, strand, s, e, p, _ in fragments()}
    points, locus, last = sorted({(c, strand, p) for _, c, strand, _, _, p in hits}), {}, None
    for x in points:  # points within 5 of the one before share its locus
        locus[x] = locus[last] if last and last[:2] == x[:2] and x[2] - last[2] <= 5 else x
        last = x
    named = components((("pair", v), locus[c, strand, p]) for v, c, strand, _, _, p in hits)
    least, widths = {}, defaultdict(list)
    for v, _, _, s, e, _ in sorted(hits):
        least.setdefault(named["pair", v], v)
        widths[v].append(e - s + 1)
    want = {(v, least[named["pair", v]], c, strand, p, s, e, round(median(widths[v]))) for v, c, strand, s, e, p in hits}
    got = [tuple(r) for r in contract.queries()["multihit_clusters"](spark, folder).collect()]
    assert len(got) == len(want) and set(got) == want


def test_sam_pairs_of_every_fragment(spark, folder):
    by, want = defaultdict(list), set()
    for k, n, _, c, strand, _, _, p, _ in fragments():
        by[k % 300, c].append((n % 2, strand, p))
    for (k, c), ends in by.items():
        for side, strand, p in ends:
            for other, facing, q in ends:
                if side == 1 and other == 0 and strand != facing and 30 <= (q - p if strand == "+" else p - q) + 1 <= 2500:
                    want.add((k, c, strand, min(p, q), max(p, q)))
    got = [tuple(r) for r in contract.queries()["sam_pair_expansion"](spark, folder).collect()]
    assert want and len(got) == len(want) and set(got) == want
    n = Counter(x[0] for x in want)
    split = [tuple(r) for r in contract.queries()["sam_unique_multihit"](spark, folder).collect()]
    assert sorted(split) == sorted((k, s, e, c, strand, "unique" if n[k] == 1 else "multihit") for k, c, strand, s, e in want)


def test_statistics_of_every_fragment(spark, folder):
    n = Counter((f[-1], f"m{f[2] % 3}") for f in fragments())
    want = {(sample, m, n[sample, m]) for sample in {f[-1] for f in fragments()} for m in ("m0", "m1", "m2", "m3")}
    assert {tuple(r) for r in contract.queries()["eval_stats_complete"](spark, folder).select("sample", "metric", "count").collect()} == want


def test_default_keys_of_all_orders(spark, folder):
    got = sorted(tuple(r) for r in contract.queries()["default_keys"](spark, folder).collect())
    assert got == sorted({(str(c), str(c)) for _, c in ORDERS if c < 40})


def test_site_sequences_on_whole_contigs(spark, folder):
    bases, turned = str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT"), str.maketrans("ACGT", "TGCA")
    contig = defaultdict(str)
    for k, _ in ORDERS:
        contig[f"chr{k % 5}"] += hashlib.md5(str(k).encode()).hexdigest().translate(bases)
    want = set()
    for k, cust in ORDERS:
        name, pos, minus = f"chr{k % 5}", k % 700 + 1, cust % 2 == 1
        low = pos - (8 if minus else 20)
        piece = contig[name][max(low, 1) - 1 : low + 28]
        want.add((name, pos, "-" if minus else "+", piece[::-1].translate(turned) if minus else piece))
    got = [tuple(r) for r in contract.queries()["site_sequences"](spark, folder).select("seqnames", "pos", "strand", "site_seq").collect()]
    assert len(got) == len(want) and set(got) == want
