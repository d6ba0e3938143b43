"""SimHash near-duplicates by multi-index hashing.

Words are what lies between ASCII white space, A-Z lowered; shingles are `width`
words in a row, repeats included (fewer words: the whole sequence); a fingerprint
bit is set if it is set in over half of the shingles' XXH64 values.

Equal fingerprints collapse first.  Distinct ones are entered in a table for each
segment of the fingerprint, and looked up there with every value in a small
Hamming ball around their own: with distance r over m segments, two fingerprints
within r differ by at most floor(r / m) bits in one of the first r mod m + 1
segments, or by less in one of the rest.  A ball of radius 2 is met half way: both
sides go through their balls of radius 1, so that a segment costs bits + 1 rows
and not their square.  Complete distances verify each match.  Segments are as
many as keep a table's expected matches near one a value, 64 / log2(fingerprints),
as is usual for this index: 20, 45 and 66 rows a fingerprint for 4, 3 and 2.
A task reduces its links to a spanning forest before sending them, so a dense
group costs no more links than members; components follow from min-label rounds
with pointer jumping over tables in the shared folder, whose joins deal a large
group's rows over SALTS.

Defined results: null and empty texts have fingerprint zero and link like any
other; texts of any length are read whole; a null doc_id gets a fingerprint and
its component but is never the smallest; repeated rows are kept; other columns
are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, in_pieces, min_labels, ranges, utf8
from .storage import forget, fresh_name, settled, ship, staged, staged_at

SEED, WIDTH, DISTANCE = 42, 4, 4
SALTS, HOT = 16, 10_000
#: Rows of complete keys that are matched at a time, and pairs that are compared at a time.
HELD_ROWS, AT_ONCE = 100_000, 1 << 18


def fingerprint_all(data: bytes, off: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The fingerprint of each text data[off[i]:off[i+1]]."""
    hashes, counts = [], []
    take = xxhash.xxh64_intdigest
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        parts = data[a:b].lower().split()
        if not parts:
            counts.append(0)
            continue
        joined = b" ".join(parts)
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lens + 1) - 1
        begins = ends - lens
        ends = (ends[width - 1 :] if len(ends) >= width else ends[-1:]).tolist()
        hashes.append(np.array([take(joined[i:j], SEED) for i, j in zip(begins.tolist(), ends)], U))
        counts.append(len(ends))
    counts = np.array(counts, np.int64)
    out = np.zeros(len(counts), U)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    own = counts[some]
    bits = np.unpackbits(np.concatenate(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(U)  # 8 lanes of bytes
    blocks = -(-own // 255)  # a lane holds 255 at most
    first = np.cumsum(own) - own
    starts = np.repeat(first, blocks) + 255 * ranges(np.zeros(len(own), np.int64), blocks)
    sums = np.add.reduceat(bits, starts, axis=0).view(np.uint8)
    ones = np.add.reduceat(sums, np.cumsum(blocks) - blocks, axis=0, dtype=np.int64)
    out[some] = np.packbits(2 * ones > own[:, None], axis=1, bitorder="little").view(U).ravel()
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp): fp as a signed long."""

    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column(1))
            fp = fingerprint_all(data.tobytes(), off, width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(in_pieces(run), "doc_id long, fp long")


def segment_plan(n: int, distance: int = DISTANCE) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each segment for n fingerprints."""
    m = min(distance + 1, max(2, round(64 / math.log2(max(n, 4)))))
    cuts = [64 * i // m for i in range(m + 1)]
    whole, rest = divmod(distance, m)
    plan = [(a, b - a, whole if i <= rest else whole - 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return [x for x in plan if x[2] >= 0]


def ball(bits: int, radius: int) -> np.ndarray:
    """Every difference of up to `radius` of `bits` bits, zero first."""
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in itertools.combinations(range(bits), r)], U)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, a number or a row of numbers each."""
    d = np.bitwise_count(a ^ b)
    return d if d.ndim == 1 else d.sum(1, dtype=np.int64)


def match_groups(key: np.ndarray, entry: np.ndarray, fp: np.ndarray, distance: int, node: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that span what the table matches connect: entries against all rows of their key.

    Rows are sorted by key, entries first; nodes are the fingerprints, unless given.
    """
    node, at = np.unique(fp if node is None else node, return_inverse=True)
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(start, len(key)))
    entries = np.add.reduceat(entry.astype(np.int64), start)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = (entries <= 64) & (entries > 0) & (size > 1)
    for t in range(int(entries[small].max(initial=0))):
        g = small & (entries > t) & (size > t + 1)
        if not g.any():
            break
        many = size[g] - t - 1
        left, right = np.repeat(start[g] + t, many), ranges(start[g] + t + 1, many)
        for i in range(0, len(left), AT_ONCE):
            x, y = left[i : i + AT_ONCE], right[i : i + AT_ONCE]
            near = distances(fp[x], fp[y]) <= distance
            a.append(at[x[near]]), b.append(at[y[near]])
    for s, n, e in zip(start[entries > 64], size[entries > 64], entries[entries > 64]):
        # A crowded value: every row that is reached leaves the rows still to be compared.
        own, table = fp[s : s + n], np.arange(e)
        left = np.ones(n, bool)
        for i in range(n):
            if not left[i]:
                continue
            queue = [i]
            left[i] = False
            while queue:
                x = queue.pop()
                pool = np.flatnonzero(left) if x < e else table[left[:e]]
                if not len(pool):
                    continue
                hit = pool[distances(own[pool], own[x]) <= distance]
                left[hit] = False
                queue += hit.tolist()
                a.append(np.full(len(hit), at[s + x])), b.append(at[s + hit])
    a, b = np.concatenate(a), np.concatenate(b)
    root = min_labels(a, b, len(node))
    moved = np.flatnonzero(root != np.arange(len(node)))
    return node[moved], node[root[moved]]


def links(distinct: DataFrame, n: int, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links within `distance` that connect just what all links would connect."""
    # (segment, first bit, mask, differences, how many of them are entries)
    shapes = []
    for i, (first, bits, radius) in enumerate(segment_plan(n, distance)):
        flips = ball(bits, 1 if radius == 2 else radius)
        shapes.append((i, first, (1 << bits) - 1, flips, len(flips) if radius == 2 else 1))

    def enter(batches):
        for batch in batches:
            fp = np.array(batch.column(0)).view(U)
            for i, first, mask, flips, told in shapes:
                value = (fp >> U(first)) & U(mask)
                for k in range(0, len(flips), 64):
                    part = flips[k : k + 64]
                    key = (value[:, None] ^ part[None, :]).ravel()
                    probe = np.tile(np.arange(k, k + len(part)) >= told, len(fp))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), i, np.int8)), pa.array(key.view(np.int64)), pa.array(probe), pa.array(np.repeat(fp, len(part)).view(np.int64))], names=["segment", "value", "probe", "fp"])

    def match(batches):
        held, size, last = [], 0, None

        def close():
            key, entry, fp = (np.concatenate(x) for x in zip(*held))
            x, y = match_groups(np.cumsum(key), entry, fp, distance)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

        for batch in batches:
            segment, value = np.array(batch.column(0)), np.array(batch.column(1))
            if not len(segment):
                continue
            new = np.append(last != (segment[0], value[0]), (segment[1:] != segment[:-1]) | (value[1:] != value[:-1]))
            last = segment[-1], value[-1]
            rows = new, ~np.array(batch.column(2)), np.array(batch.column(3)).view(U)
            cut = int(np.flatnonzero(new)[-1]) if size + len(new) >= HELD_ROWS and new.any() else -1
            if cut >= 0:  # the keys before the batch's last one are complete
                held.append(tuple(x[:cut] for x in rows))
                if size + cut:
                    yield close()
                held, size, rows = [], 0, tuple(x[cut:] for x in rows)
            held.append(rows)
            size += len(rows[0])
        if size:
            yield close()

    probes = distinct.select("fp").mapInArrow(enter, "segment byte, value long, probe boolean, fp long")
    parts = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = probes.repartition(parts, "segment", "value").sortWithinPartitions("segment", "value", "probe")
    return dealt.mapInArrow(match, "a long, b long")


def spread_join(big: DataFrame, small: DataFrame, on: str, by: str, how: str = "inner") -> DataFrame:
    """big joined with small, which has a row a value of `on`; big's rows of one value are dealt over SALTS by column `by`."""
    shown = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = big.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return dealt.join(shown, [on, "__salt"], how).drop("__salt")


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, root) of every node of the links (a, b); nodes are longs, the root is the smallest.

    Each round takes the smallest root among a node's neighbours and then its root's root; rounds end when nothing changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    spark = edges.sparkSession
    both, links_at = staged_at(both, f"{tag}-links")
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root"))
    label, label_at = staged_at(label, tag)
    while True:
        told = spread_join(both, label.select(F.col("node").alias("b"), F.col("root").alias("seen")), "b", "a")
        best = told.groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        hooked = label.join(best, "node", "left").select("node", "root", F.least("root", F.coalesce("seen", "root")).alias("hook"))
        # A root that learns of a smaller one takes its whole tree along.
        moved = hooked.groupBy("root").agg(F.min("hook").alias("lead")).where("lead < root")
        hooked = spread_join(hooked, moved, "root", "node", "left").select("node", "root", F.least("hook", F.coalesce("lead", "hook")).alias("hook"))
        up = hooked.select("hook").distinct().join(label.select(F.col("node").alias("hook"), F.col("root").alias("top")), "hook")
        low = F.least("hook", F.coalesce("top", "hook"))
        after, after_at = staged_at(spread_join(hooked, up, "hook", "node", "left").select("node", low.alias("root"), (low != F.col("root")).alias("changed")), tag)
        changed = after.where("changed").limit(1).count()
        forget(spark, label_at)
        label, label_at = after.select("node", "root"), after_at
        if not changed:
            forget(spark, links_at)
            return label


def near_duplicates(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs."""
    fps = staged(fingerprints(docs, width), "fingerprints")
    return name_groups(fps, lambda distinct, n: components(links(distinct, n, distance), "near"))


def name_groups(fps: DataFrame, roots_of, *extra) -> DataFrame:
    """(doc_id, fp, component_id) of every row of fps; roots_of gives (node, root) of linked ones of its distinct fingerprints, `extra` are more columns it sees."""
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), *extra), "distinct-fingerprints")
    sizes = distinct.agg(F.count("*").alias("fps"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).head()
    roots = roots_of(distinct, sizes["fps"])
    linked = staged(roots.join(distinct, roots["node"] == distinct["fp"]).select("node", "root", "least"), "linked")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    named = spread_join(linked, smallest, "root", "node").select("node", "smallest")
    by_fp = distinct.join(named, distinct["fp"] == named["node"], "left").select("fp", F.coalesce("smallest", "least").alias("component_id"))
    by_fp = staged(by_fp, "fingerprint-components")
    # Fingerprints with more than 1 / HOT of all rows, of which there are HOT at most, meet their rows by broadcast.
    hot = distinct.where(F.col("n") * HOT > sizes["rows"]).where(F.col("n") > 1).select("fp")
    hot = by_fp.join(F.broadcast(hot), "fp", "left_semi").withColumn("hot", F.lit(True))
    marked = fps.join(F.broadcast(hot), "fp", "left")
    rest = marked.where("hot IS NULL").select("doc_id", "fp").join(by_fp, "fp")
    return marked.where("hot").select("doc_id", "fp", "component_id").unionByName(rest.select("doc_id", "fp", "component_id"))


def keep_first(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """docs with one document of each group: that of the smallest doc_id, and of equal rows one.

    Groups in which no row has a doc_id keep a row for each fingerprint.
    """
    return keep_named(docs, settled(lambda: near_duplicates(docs, width, distance), "near"), lambda data, off: fingerprint_all(data.tobytes(), off, width))


def keep_named(docs: DataFrame, near: DataFrame, prints) -> DataFrame:
    """docs with one document of each group of the staged table `near`, (doc_id, fp, component_id); prints gives the fp of texts."""
    own, fp, other = (fresh_name(docs, x) for x in ("id", "fp", "own"))
    winners = near.where("doc_id = component_id").groupBy(F.col("doc_id").alias(own)).agg(F.count("*").alias("n"))
    mine = docs["doc_id"].cast("long") == F.col(own)
    once = docs.join(winners.where("n = 1").select(own), mine, "left_semi")
    again = docs.join(winners.where("n > 1").select(own), mine, "left_semi").dropDuplicates(["doc_id", "text"])
    nameless = docs.where("doc_id IS NULL").dropDuplicates(["text"])
    alone = near.where("component_id IS NULL").select(F.col("fp").alias(other)).distinct()
    column = nameless.columns.index("text")

    def mark(batches):
        for batch in batches:
            data, off = utf8(batch.column(column))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints(data, off).view(np.int64))], names=[*batch.schema.names, fp])

    marked = nameless.mapInArrow(in_pieces(mark), nameless.select("*").schema.add(fp, "long"))
    rest = marked.join(alone, F.col(fp) == F.col(other), "left_semi").dropDuplicates([fp]).select(*docs.columns)
    return once.unionByName(again).unionByName(rest)


def hex_of(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
