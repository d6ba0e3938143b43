"""Near copies by SimHash and multi-index hashing, verified by exact similarity.

Words are what lies between ASCII white space, A-Z lowered; a text's shingles are
the set of WIDTH words in a row (fewer words: the whole sequence), held as 64-bit
hashes.  Two texts are linked if their sets' Jaccard similarity is LEAST or more;
groups are what links connect.

Texts of equal sets collapse first.  Each set has a fingerprint of BITS bits, a bit
being 1 if it is set in over half of the shingles' hashes.  Sets of similarity 0.8
differ in 0.15 of the bits (their angle is at most acos(0.889)), unrelated ones in
half.  So few differences over the whole don't leave an equal segment by the
pigeonhole principle at any useful length; instead the fingerprint has as many
segments as make it likely.  A segment has log2(sets) bits, both sides go through
the Hamming ball of radius 1 around their segment, and so meet if they differ in 2
bits of it at most; of `segment_plan`'s segments all fail with probability MISS at
similarity 0.8, and far less above: (0.85: 2e-4, 0.9: 5e-6 at 2^18 sets).  Complete
distances of up to DISTANCE verify a match.

A task gets the fingerprints that can meet in one range of a segment's values, which
its leading bits name: those of the range itself and of ranges that lack one of its
bits.  They come as a blob for each batch that sent some and are gone through CHUNK
at a time.  Of a crowd (a component of over CROWD) one member then stands for those
of the same segment value that differ from it by HELD bits at most: it meets the very
keys that they would meet, and later rows within DISTANCE + HELD of it, which by the
triangle inequality is every row within DISTANCE of one of them.  So no link is lost,
what more comes of it falls in the exact comparison, and a crowd's rows in a range
don't outgrow the range's values unless they differ by more than HELD.

Candidates that matches connect are compared exactly: families of up to
FAMILY_BYTES in one task, where every text that is reached leaves those still to be
compared.  Members of a larger one are dealt over all tasks: first compared with the
family's smallest, then those that this one doesn't reach, in blocks of BLOCK_BYTES
that are broadcast one after another, with every member of their families.

Defined results: texts without a word are copies of each other; texts of any length
are read whole; a null doc_id, repeated rows, clashing columns and empty tables are
treated as in simhash.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .arrays import BASE, LOWER, MIX_B, U, in_pieces, min_labels, mix, ranges, span_hashes, utf8, words
from .storage import settled, ship, staged

WIDTH, LEAST = 5, (4, 5)
BITS, DISTANCE = 256, 72
MISS = 2e-3
#: Share of the bits in which sets of similarity 0.8 differ.
APART = math.acos(0.8 / 0.9) / math.pi
CHUNK, CROWD = 400_000, 64
#: Bits by which a row may differ from the one that stands for it (unrelated sets differ in 128, give or take 8).
HELD = 24
#: Members of a crowd that are tried for each segment value.
STAND_INS = 16
#: Entries of a table that are matched at a time.
KEYS = 200_000
#: Fingerprints that a range of values is made for.
RANGE_ROWS = 1 << 18
FAMILY_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
INSIDE = np.ones(256, bool)
INSIDE[list(b" \t\n\r\v\f")] = False
#: Shingle hashes that are compared at a time.
AT_ONCE = 1 << 20


def _constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(BASE) + U(seed))


FACTORS = _constants(WIDTH, 1) | U(1)
LANES = _constants(BITS // 64, 2)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): each text's distinct shingles in rising order, and how many they are."""
    n = len(off) - 1
    low = LOWER[data]
    start, end, row = words(low, off, INSIDE)
    many = np.bincount(row, minlength=n)
    first = np.cumsum(many) - many
    own = span_hashes(low, start, end) if len(start) else np.zeros(0, U)
    rows, hashes = [], []
    for length in range(1, WIDTH + 1):
        some = np.flatnonzero(many == length if length < WIDTH else many >= WIDTH)
        count = many[some] - length + 1
        at = ranges(first[some], count)
        total = np.full(len(at), length, U)
        for j in range(length):
            total += own[at + j] * FACTORS[j]
        rows.append(np.repeat(some, count)), hashes.append(mix(total))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(rows[new], minlength=n)


def set_prints(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each set; zero for empty ones."""
    out = np.zeros(len(counts), U)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = mix(np.add.reduceat(mix(hashes ^ U(MIX_B)), (np.cumsum(counts) - counts)[some]) + counts[some].astype(U))
    return out


def prints(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    return set_prints(*shingle_sets(data, off))


def simhashes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(sets, lanes of 64 bits): the fingerprint of each set; zero for empty ones."""
    out = np.zeros((len(counts), len(LANES)), U)
    some = np.flatnonzero(counts)
    own = counts[some]
    blocks = -(-own // 255)  # a lane of a byte holds 255 at most
    first = np.cumsum(own) - own
    starts = np.repeat(first, blocks) + 255 * ranges(np.zeros(len(own), np.int64), blocks)
    for k, flip in enumerate(LANES if len(some) else ()):
        bits = np.unpackbits(mix(hashes ^ flip).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(U)
        sums = np.add.reduceat(bits, starts, axis=0).view(np.uint8)
        ones = np.add.reduceat(sums, np.cumsum(blocks) - blocks, axis=0, dtype=np.int64)
        out[some, k] = np.packbits(2 * ones > own[:, None], axis=1, bitorder="little").view(U).ravel()
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, bits): fp stands for the set of shingles, bits are its fingerprint's bytes."""

    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column(1))
            hashes, counts = shingle_sets(data, off)
            bits = simhashes(hashes, counts)
            told = [row.tobytes() if c else None for row, c in zip(bits, counts.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(set_prints(hashes, counts).view(np.int64)), pa.array(told, pa.binary())], names=["doc_id", "fp", "bits"])

    return ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(in_pieces(run), "doc_id long, fp long, bits binary")


def segment_plan(n: int) -> tuple[list[np.ndarray], int]:
    """(the bits (their places) of each segment for n sets, how many leading bits of a segment name a range)."""
    size = min(max(math.ceil(math.log2(max(n, 2))), 16), 40)
    high = max(1, math.ceil(math.log2(max(n, 2) / RANGE_ROWS)) + 1)
    meet = sum(math.comb(size, r) * APART**r * (1 - APART) ** (size - r) for r in range(3))
    meet -= math.comb(high, 2) / 2 * APART**2 * (1 - APART) ** (size - 2)  # one has both bits that the other lacks, and both are leading
    many = math.ceil(math.log(MISS) / math.log(1 - meet))
    rng = np.random.default_rng(3)
    # Every bit is used before any is used again, in another order.
    places = np.concatenate([rng.permutation(BITS) for _ in range(-(-many * size // BITS))])
    return list(places[: many * size].reshape(many, size)), high


def values(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The segment's value of each fingerprint."""
    out = np.zeros(len(bits), U)
    for i, p in enumerate(places.tolist()):
        out |= (bits[:, p >> 6] >> U(p & 63) & U(1)) << U(i)
    return out


def loose_links(key: np.ndarray, bits: np.ndarray, loose: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for others (`loose`) and the rows of their key, of another root, within DISTANCE + HELD of them; rows are sorted by key."""
    of = np.flatnonzero(loose)
    start = np.searchsorted(key, key[of])
    size = np.searchsorted(key, key[of], "right") - start
    ends = np.cumsum(size)
    a, b, i = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while i < len(of):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - size[i] + AT_ONCE)))
        x, y = np.repeat(of[i:j], size[i:j]), ranges(start[i:j], size[i:j])
        other = root[x] != root[y]
        x, y = x[other], y[other]
        near = simhash.distances(bits[x], bits[y]) <= DISTANCE + HELD
        a.append(x[near]), b.append(y[near])
        i = j
    return np.concatenate(a), np.concatenate(b)


def stand_ins(value: np.ndarray, bits: np.ndarray, root: np.ndarray, loose: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows to hold on to, which of them stand for others) of the members of crowds: of one root and value, what others stand for goes."""
    left = np.lexsort((~loose, value, root))  # those that stand for others already come first, and stay
    kept, wide = [], loose.copy()
    for _ in range(STAND_INS):
        if not len(left):
            break
        new = np.append(True, (root[left[1:]] != root[left[:-1]]) | (value[left[1:]] != value[left[:-1]]))
        head = left[new][np.cumsum(new) - 1]
        gone = ~new & ~loose[left] & (simhash.distances(bits[left], bits[head]) <= HELD)
        wide[head[gone]] = True
        kept.append(left[new])
        left = left[~new & ~gone]
    kept = np.concatenate([*kept, left])  # what none of so many stands for stays itself
    return kept, wide[kept]


def meet(value: np.ndarray, low_bits: int, group: int, bits: np.ndarray, node: np.ndarray, loose: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, root, rows to hold on to, which of them stand for others) of the fingerprints whose balls around `value` meet within `group`, a range of values.

    `loose` rows stand for others.  The range is gone through in slices of some KEYS entries.
    """
    loose = np.zeros(len(node), bool) if loose is None else loose
    own = (value >> U(low_bits)) == U(group)
    low = value & U((1 << low_bits) - 1)
    entries = int(own.sum()) * (low_bits + 1) + int((~own).sum())
    cut = min(low_bits, max(0, math.ceil(math.log2(max(entries, 1) / KEYS))))
    rest = low_bits - cut
    part, low = (low >> U(rest)).astype(np.int64), low & U((1 << rest) - 1)
    flips = np.append(U(0), U(1) << np.arange(rest, dtype=U))
    names, first, at = np.unique(node, return_index=True, return_inverse=True)
    a, b = [np.zeros(0, U)], [np.zeros(0, U)]
    for s in range(1 << cut):
        # Of a slice's own values the ball's part in the remaining bits; of values that enter it by a bit above them the one that lies in it.
        apart = np.bitwise_count(part ^ s)
        core, near = np.flatnonzero(own & (apart == 0)), np.flatnonzero((own & (apart == 1)) | (~own & (apart == 0)))
        key = np.concatenate([(low[core, None] ^ flips[None, :]).ravel(), low[near]])
        row = np.concatenate([np.repeat(core, len(flips)), near])
        if not len(key):
            continue
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        x, y = simhash.match_groups(key, np.ones(len(key), bool), bits[row], DISTANCE, node[row])
        a.append(x), b.append(y)
        if loose[row].any():
            root = min_labels(np.searchsorted(names, x), np.searchsorted(names, y), len(names))
            x, y = loose_links(key, bits[row], loose[row], root[at[row]])
            a.append(node[row[x]]), b.append(node[row[y]])
    a, b = (np.searchsorted(names, np.concatenate(x)) for x in (a, b))
    root = min_labels(a, b, len(names))
    moved = np.flatnonzero(root != np.arange(len(names)))
    crowd = np.bincount(root, minlength=len(names))[root] > CROWD
    # Copies of a fingerprint that stands for others do so as well.
    told = np.zeros(len(names), bool)
    told[at[loose]] = True
    some = np.flatnonzero(crowd)
    kept, wide = stand_ins(value[first[some]], bits[first[some]], root[some], told[some])
    keep = np.concatenate([first[~crowd], first[some[kept]]])
    return names[moved], names[root[moved]], keep, np.concatenate([told[~crowd], wide])


def candidates(distinct: DataFrame, n: int) -> DataFrame:
    """(a, b): links that connect what the segments' tables match; distinct: (fp, bits)."""
    plan, high = segment_plan(n)
    low = len(plan[0]) - high

    def deal(batches):
        for batch in batches:
            node = np.array(batch.column(0)).view(U)
            bits = np.frombuffer(b"".join(batch.column(1).to_pylist()), U).reshape(-1, len(LANES))
            told = np.concatenate([node[:, None], bits], axis=1)
            for k, places in enumerate(plan):
                home = (values(bits, places) >> U(low)).astype(np.int64)
                lacks = [np.flatnonzero(home >> i & 1 == 0) for i in range(high)]
                to = np.concatenate([home, *(home[x] | 1 << i for i, x in enumerate(lacks))])
                row = np.concatenate([np.arange(len(node)), *lacks])
                order = np.argsort(to, kind="stable")
                to, row = to[order], row[order]
                start = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
                blobs = [told[row[i:j]].tobytes() for i, j in zip(start, np.append(start[1:], len(to)))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(start), k, np.int32)), pa.array(to[start]), pa.array(blobs, pa.binary())], names=["segment", "span", "rows"])

    def match(batches):
        held, loose, size, limit, now = [], [], 0, CHUNK, None

        def close():
            """(what must be held on to, which of it stands for others, the links) of what is held."""
            rows = np.concatenate(held)
            a, b, keep, wide = meet(values(rows[:, 1:], plan[now[0]]), low, now[1], rows[:, 1:], rows[:, 0], np.concatenate(loose))
            return [rows[keep]], [wide], pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            for segment, span, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if (segment, span) != now:
                    if size:
                        yield close()[2]
                    held, loose, size, limit, now = [], [], 0, CHUNK, (segment, span)
                rows = np.frombuffer(blob, U).reshape(-1, 1 + len(LANES))
                held.append(rows), loose.append(np.zeros(len(rows), bool))
                size += len(rows)
                if size >= limit:
                    held, loose, out = close()
                    # What isn't crowded stays and meets as many rows more.
                    size = len(held[0])
                    limit = max(CHUNK, 2 * size)
                    yield out
        if held:
            yield close()[2]

    parts = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(plan) << min(high, 10))
    dealt = distinct.where("bits IS NOT NULL").select("fp", "bits").mapInArrow(in_pieces(deal), "segment int, span long, rows binary")
    return dealt.repartition(parts, "segment", "span").sortWithinPartitions("segment", "span").mapInArrow(match, "a long, b long")


def overlaps(own: np.ndarray, seen: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many of the sets `seen` (one after another, `counts` long, none empty) share with the sorted set `own`."""
    equal = own[np.minimum(np.searchsorted(own, seen), len(own) - 1)] == seen
    return np.add.reduceat(equal.astype(np.int64), np.cumsum(counts) - counts)


def similar(own: np.ndarray, hashes: np.ndarray, start: np.ndarray, counts: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """Those of `pool` whose sets are similar to the set `own`."""
    up, down = LEAST
    pool = pool[down * np.minimum(counts[pool], len(own)) >= up * np.maximum(counts[pool], len(own))]
    step, found = max(1, AT_ONCE // max(1, len(own))), [np.zeros(0, np.int64)]
    for k in range(0, len(pool), step):
        part = pool[k : k + step]
        both = overlaps(own, hashes[ranges(start[part], counts[part])], counts[part])
        found.append(part[down * both >= up * (len(own) + counts[part] - both)])
    return np.concatenate(found)


def connect(nodes: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the sets that exact similarity links to others."""
    start = np.cumsum(counts) - counts
    root = np.arange(len(nodes))
    left = np.ones(len(nodes), bool)
    for i in range(len(nodes)):
        if not left[i]:
            continue
        left[i], queue = False, [i]
        while queue:
            x = queue.pop()
            hit = similar(hashes[start[x] : start[x] + counts[x]], hashes, start, counts, np.flatnonzero(left))
            left[hit], root[hit] = False, i
            queue += hit.tolist()
    linked = np.bincount(root, minlength=len(nodes))[root] > 1
    return nodes[linked], nodes[root[linked]]


SETS = "near long, node long, set binary"
PAIRS = "node long, root long"


def _sets(docs: DataFrame, named: DataFrame) -> DataFrame:
    """(near, node, set) of each of `named`, (node, near, least): the shingle set of a text that has the fingerprint."""

    def gather(batches):
        """Sets of the texts that have the fingerprint `node`; a null node is any."""
        for batch in batches:
            hashes, counts = shingle_sets(*utf8(batch.column(2)))
            own, ends = set_prints(hashes, counts).view(np.int64), np.cumsum(counts)
            want = batch.column(1).to_pylist()
            keep = [i for i, w in enumerate(want) if w is None or w == own[i]]
            sets = [hashes[ends[i] - counts[i] : ends[i]].tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(own[keep]), pa.array(sets, pa.binary())], names=["near", "node", "set"])

    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), "text")
    with_id = rows.join(named, rows["__id"] == named["least"]).select("near", "node", "text").mapInArrow(in_pieces(gather), SETS)
    bare = rows.where("__id IS NULL").select("text").dropDuplicates(["text"]).select(F.lit(None).cast("long").alias("near"), F.lit(None).cast("long").alias("node"), "text")
    bare = bare.mapInArrow(in_pieces(gather), SETS).drop("near").join(named.where("least IS NULL").select("node", "near"), "node").select("near", "node", "set")
    return with_id.unionByName(bare)


def _compare(batches):
    """Links within the families of rows (near, node, set), sorted by near."""
    held, now = {}, None

    def close():
        if len(held) < 2:
            return None
        counts = np.array([len(s) // 8 for s in held.values()], np.int64)
        node, root = connect(np.array(list(held), np.int64), np.frombuffer(b"".join(held.values()), U), counts)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "root"]) if len(node) else None

    for batch in batches:
        for near, node, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if near != now:
                out = close()
                if out is not None:
                    yield out
                held, now = {}, near
            held[node] = own
    out = close()
    if out is not None:
        yield out


def _against(shared):
    """Links of rows (near, node, set) with the sets of their family in a broadcast block, as a forest a batch."""

    def run(batches):
        block = {}
        for near, node, own in shared.value:
            block.setdefault(near, []).append((node, np.frombuffer(own, U)))
        for batch in batches:
            near, node = np.array(batch.column(0)), np.array(batch.column(1))
            sets = batch.column(2).to_pylist()
            counts = np.array([len(s) // 8 for s in sets], np.int64)
            hashes, start = np.frombuffer(b"".join(sets), U), np.cumsum(counts) - counts
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for family in set(near.tolist()) & block.keys():
                pool = np.flatnonzero(near == family)
                for name, own in block[family]:
                    hit = similar(own, hashes, start, counts, pool)
                    a.append(np.full(len(hit), name)), b.append(node[hit])
            names, at = np.unique(np.concatenate(a + b), return_inverse=True)
            half = len(at) // 2
            root = min_labels(at[:half], at[half:], len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[root])], names=["node", "root"])

    return run


def _compared(sets: DataFrame, large: DataFrame, tag: str) -> list[DataFrame]:
    """Tables of the links (node, root) that `sets` have with their families in `large`.

    Sets are broadcast in blocks of about BLOCK_BYTES, one at a time: whole families by the hash of their name, which
    only meet their own rows, and of a family that is more than a block its parts.
    """
    spark, out = sets.sparkSession, []
    size = F.sum(F.octet_length("set") + 64)
    many = -(-(sets.agg(size).head()[0] or 0) // BLOCK_BYTES)
    for k in range(many):
        mine = F.pmod(F.xxhash64("near"), F.lit(many)) == k
        part, own = sets.where(mine), large.where(mine)
        pieces = -(-(part.agg(size).head()[0] or 0) // (2 * BLOCK_BYTES))
        for i in range(pieces):
            rows = part if pieces == 1 else part.where(F.pmod(F.xxhash64("node"), F.lit(pieces)) == i)
            shared = spark.sparkContext.broadcast([tuple(r) for r in rows.collect()])  # one block, of BLOCK_BYTES or so
            out.append(staged(own.mapInArrow(in_pieces(_against(shared)), PAIRS), tag))
            shared.destroy()
    return out


def _large_families(large: DataFrame) -> DataFrame:
    """(a, b): links that connect what similarity connects within families that no task may hold."""
    smallest = large.join(large.groupBy("near").agg(F.min("node").alias("node")), ["near", "node"], "left_semi").select("near", "node", "set")
    stars = functools.reduce(DataFrame.unionByName, _compared(smallest, large, "stars"))
    rest = staged(large.join(stars.select("node").distinct(), "node", "left_anti").select("near", "node", "set"), "unreached")
    every = functools.reduce(DataFrame.unionByName, _compared(rest, large, "more-links"), stars)
    return every.select(F.col("node").alias("a"), F.col("root").alias("b"))


def links(docs: DataFrame, distinct: DataFrame, n: int) -> DataFrame:
    """(node, root) of each distinct fingerprint whose text is similar to another's."""
    groups = simhash.components(candidates(distinct, n), "candidates")
    named = staged(groups.join(distinct, groups["node"] == distinct["fp"]).select("node", F.col("root").alias("near"), "least"), "candidate-texts")
    sets = staged(_sets(docs, named), "candidate-sets")
    sizes = sets.groupBy("near").agg(F.sum(F.octet_length("set") + 64).alias("size"))
    # As many as FAMILY_BYTES go into the sets' bytes, at most; still joined by their size as it turns out.
    crowded = staged(sizes.where(F.col("size") > FAMILY_BYTES).select("near"), "large-families")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    small = sets.join(crowded, "near", "left_anti").select("near", "node", "set")
    found = staged(small.repartition(parts, "near").sortWithinPartitions("near").mapInArrow(_compare, PAIRS), "similar")
    if crowded.limit(1).count():
        large = staged(sets.join(F.broadcast(crowded), "near", "left_semi").select("near", "node", "set"), "large-sets")
        found = found.unionByName(simhash.components(_large_families(large), "large"))
    return found


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs."""
    fps = staged(fingerprints(docs), "shingle-sets")
    return simhash.name_groups(fps, lambda distinct, n: links(docs, distinct, n), F.first("bits", ignorenulls=True).alias("bits"))


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with one document of each group, chosen as simhash.keep_first does."""
    return simhash.keep_named(docs, settled(lambda: near_copies(docs), "near"), prints)
