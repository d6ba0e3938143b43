"""Phrase collocations: exact counts by minimal perfect hashing, scored at their weakest cut.

Texts become arrays of word slots, one level of phrase length after another:

* a candidate of k words is an occurrence whose first and last k - 1 words are
  both frequent, so its key is the pair of their slots in one 64-bit number;
  at two words, where that rules out little, mappers first bincount hashed keys
  into saturating arrays, and keys in a bucket below the threshold are left out;
* candidates whose occurrences add up to the threshold go into blocks of
  `BLOCK_KEYS`; a task builds each block's minimal perfect hash and writes it to
  the shared folder with its keys in slot order;
* mappers look keys up (a slot counts only if the key stored there is the same),
  bincount slots in numpy arrays, and hand on the array of slots for the next
  level; the arrays are summed as a tree of bounded fan-in, in slices.

Phrases read the counts of their cuts by slot: a phrase of k words has those of
its first and of its last k - 1 words, whose own cuts are known.

A mapper holds one block at a time, however many there are; further blocks take
further passes.  Nothing is dropped: the filters are upper bounds of the counts.

Defined results: null and wordless texts give nothing; a null language is `und`
and joins rows that say so; repeated rows and doc_ids count as often as they
occur; texts of any length are read whole; other columns are left out, whatever
their names; an empty table gives no rows.  Words are compared as bytes.
"""

from __future__ import annotations

import functools
import io
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import LOWER, U, in_pieces, mix, once, span_hashes, utf8
from .storage import get_file, put_file, ship, staged, workdir

LEAST = 100
LONGEST = 5
TOP = 2000
#: Keys of a block: 16 MB of keys and 16 MB of counts in a mapper.
BLOCK_KEYS = 1 << 21
#: Buckets of hashed pairs, a byte each in a mapper.
BUCKETS = 1 << 24
#: Counters of a slice, and slices that one task of the tree sums.
SLICE, FAN_IN = 1 << 16, 64
#: Keys that one task adds up, some 25 MB of them.
SLICE_KEYS = 1 << 21
#: Distinct words or keys that a mapper gathers before it sends them on.
GATHERED = 1 << 19

_INSIDE = np.ones(256, bool)
_INSIDE[[9, 32, *b".,;:!?", 10, 11, 12, 13]] = False
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True


def word_arrays(texts) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """(words in order, whether each begins a piece): A-Z lowered; pieces end at .,;:!?, line ends and texts."""
    data, off = utf8(texts)
    data = LOWER[data]
    inside = _INSIDE[data]
    start = np.zeros(len(data) + 1, bool)
    start[off] = True
    start[1:-1] |= ~inside[:-1]
    first = np.flatnonzero(start[:-1] & inside)
    kept = np.cumsum(inside) - inside
    cuts = np.append(kept[first], np.count_nonzero(inside)).astype(np.int64)
    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    # A word begins a piece if a break or a text's start lies between it and the word before.
    edges = np.cumsum(_BREAK[data])
    piece = (edges[first] if len(first) else np.zeros(0, np.int64)) + np.searchsorted(off, first, "right")
    return held, np.append(True, piece[1:] != piece[:-1])[: len(first)]


def by_language(batch):
    """(language, its texts) of a batch (text, lang)."""
    langs = batch.column(1).dictionary_encode()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, batch.column(0).filter(pc.equal(langs.indices, k))


# ---- minimal perfect hashing -----------------------------------------------------------------------


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1: in each round, keys that are alone at their hashed bit stay there; ranks number the bits."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.ranks = np.concatenate(([0], np.cumsum(_ONES[bits], dtype=np.int64)))

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, parts = np.asarray(keys, np.uint64), [], []
        while len(left):
            size = -(-2 * len(left) // 8) * 8
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate([*parts, np.zeros(0, np.uint8)]))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of keys that were not there, any slot or -1."""
        out, base = np.full(len(keys), -1, np.int64), 0
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = base + _place(keys[left], level, size)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            here = self.bits[byte]
            found = (here >> bit) & 1 == 1
            below = here[found] & ((np.uint8(1) << bit[found]) - np.uint8(1))
            out[left[found]] = self.ranks[byte[found]] + _ONES[below]
            left, base = left[~found], base + size
        return out


_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys + U(0x9E3779B97F4A7C15) * U(level + 1)) % U(size)).astype(np.int64)


def _saved(**arrays) -> bytes:
    held = io.BytesIO()
    np.savez(held, **arrays)
    return held.getvalue()


@functools.lru_cache(maxsize=1)
def _loaded(uri: str):
    """A block's file: one at a time is held by a worker."""
    data = get_file(uri)
    if data is None:
        raise FileNotFoundError(uri)
    with np.load(io.BytesIO(data)) as f:
        held = {k: f[k] for k in f.files}
    return PerfectHash(held["sizes"].tolist(), held["bits"]), held


def key_slots(uri: str, keys: np.ndarray) -> np.ndarray:
    """The slot in a block of each key, -1 unless the key stored there is the same."""
    table, held = _loaded(uri)
    slot = table.slots(keys)
    good = slot >= 0
    good[good] = held["keys"][slot[good]] == keys[good]
    return np.where(good, slot, -1)


def word_slots(uri: str, lang: str, words: pa.LargeBinaryArray) -> np.ndarray:
    """The same for distinct words of a language, whose bytes are compared."""
    table, held = _loaded(uri)
    slot = table.slots(_word_keys(lang, words))
    stored = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(held["cuts"]) - 1, [None, pa.py_buffer(held["cuts"]), pa.py_buffer(held["bytes"])])
    good = np.flatnonzero(slot >= 0)
    same = pc.equal(stored.take(pa.array(slot[good])), _tagged(lang, words.take(pa.array(good)))).to_numpy(zero_copy_only=False)
    out = np.full(len(words), -1, np.int64)
    out[good[same]] = slot[good[same]]
    return out


def _tagged(lang: str, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
    """Language, tab, word: words have no tab, so it splits at the last one."""
    return pc.binary_join_element_wise(pa.scalar(lang.encode(), pa.large_binary()), words, pa.scalar(b"\t", pa.large_binary())).cast(pa.large_binary())


def _word_keys(lang: str, words: pa.LargeBinaryArray) -> np.ndarray:
    data, off = utf8(_tagged(lang, words))
    return span_hashes(data, off[:-1], off[1:]) if len(off) > 1 else np.zeros(0, np.uint64)


# ---- counting --------------------------------------------------------------------------------------


def _part() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, word, f) of every word, added up in mappers first."""

    def run(batches):
        held: dict = {}

        def out():
            for lang, got in held.items():
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(got), pa.string()), "word": pa.array(got.keys(), pa.binary()).cast(pa.string()), "f": pa.array(got.values(), pa.int64())})

        for batch in batches:
            for lang, rows in by_language(batch):
                counts = pc.value_counts(word_arrays(rows)[0])
                got = held.setdefault(lang, {})
                for w, n in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()):
                    got[w] = got.get(w, 0) + n
            if sum(map(len, held.values())) > GATHERED:
                yield from out()
                held = {}
        yield from out()

    return ship(texts).mapInArrow(in_pieces(run), "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def tree_sum(parts: DataFrame, capped: bool = False) -> DataFrame:
    """Adds up the counts of rows (block, slice, part, counts) part by part, FAN_IN at a time; one row a block and slice is left."""

    def run(table):
        kind = np.uint8 if capped else np.int64
        total = np.zeros(0, np.int64)
        for x in table.column("counts"):
            more = np.frombuffer(x.as_buffer(), kind)
            if len(more) > len(total):
                total = np.pad(total, (0, len(more) - len(total)))
            total[: len(more)] += more
        total = np.minimum(total, 255) if capped else total
        first = lambda name: table.column(name)[:1].combine_chunks()
        return pa.table({"block": first("block"), "slice": first("slice"), "part": pc.divide(first("part"), FAN_IN).cast(pa.int32()), "counts": pa.array([total.astype(kind).tobytes()], pa.binary())})

    most = parts.agg(F.max("part")).first()[0]
    while most:
        parts = parts.groupBy("block", "slice", F.floor(F.col("part") / FAN_IN).alias("upper")).applyInArrow(once(run), PARTS)
        most //= FAN_IN
    return parts


PARTS = "block int, slice int, part int, counts binary"


def _slices(block: int, counts: np.ndarray, size: int = SLICE):
    """A row for each slice of a mapper's counters that has any."""
    rows = [(k, counts[i : i + size]) for k, i in enumerate(range(0, len(counts), size))]
    for k, x in rows:
        if x.any():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "slice": pa.array([k], pa.int32()), "part": pa.array([_part()], pa.int32()), "counts": pa.array([x.tobytes()], pa.binary())})


def _pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of neighbouring frequent slots."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    return at, (ids[at].astype(np.uint64) << U(32)) | ids[at + 1].astype(np.uint64)


def _arrays(batch, name: str = "ids"):
    for x in batch.column(batch.schema.get_field_index(name)):
        yield np.frombuffer(x.as_buffer(), np.int32)


def heavy_buckets(seqs: DataFrame, least: int) -> str:
    """Where the bitmap of buckets stands in which hashed pairs of neighbours come up `least` times or more; counts saturate at 255."""

    def run(batches):
        counts = np.zeros(BUCKETS, np.uint8)
        held, size = [], 0

        def add():
            at, n = np.unique(np.concatenate(held), return_counts=True)
            counts[at] = np.minimum(counts[at] + n, 255)

        for batch in batches:
            for ids in _arrays(batch):
                held.append((mix(_pairs(ids)[1]) % U(BUCKETS)).astype(np.int32))
                size += len(held[-1])
                if size > GATHERED:
                    add()
                    held, size = [], 0
        if held:
            add()
        yield from _slices(0, counts, 16 * SLICE)

    uri = f"{workdir(seqs.sparkSession, 'buckets')}.npy"
    bits = np.zeros(BUCKETS // 8, np.uint8)
    sums = tree_sum(staged(seqs.mapInArrow(run, PARTS), "bucket-parts"), capped=True)
    for row in sums.select("slice", "counts").collect():  # BUCKETS bytes in all, whatever the corpus
        heavy = np.packbits(np.frombuffer(row["counts"], np.uint8) >= min(least, 255))
        bits[row["slice"] * 2 * SLICE : row["slice"] * 2 * SLICE + len(heavy)] = heavy
    put_file(uri, [bits.tobytes()])
    return uri


@functools.lru_cache(maxsize=1)
def _bitmap(uri: str) -> np.ndarray:
    return np.frombuffer(get_file(uri), np.uint8)


def candidates(seqs: DataFrame, least: int, heavy: str | None, positions: int) -> DataFrame:
    """(key) of neighbours that may come up `least` times: an upper bound of each is added up.

    Mappers hand on arrays of distinct keys and bounds, cut by hash into slices that one task each adds up; there are as
    many slices as the positions of the corpus ask for, so that a slice has some SLICE_KEYS keys whatever comes.
    """
    slices = max(1, -(-positions // SLICE_KEYS))

    def run(batches):
        held, size = [], 0

        def out():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            at = (mix(keys + U(1)) % U(slices)).astype(np.int32)
            order = np.argsort(at, kind="stable")
            which, first = np.unique(at[order], return_index=True)
            cut = lambda x, kind: pa.array([y.astype(kind).tobytes() for y in np.split(x[order], first[1:])], pa.binary())
            return pa.RecordBatch.from_pydict({"slice": pa.array(which, pa.int32()), "keys": cut(keys, np.uint64), "bounds": cut(n, np.uint32)})

        for batch in batches:
            for ids in _arrays(batch):
                keys = _pairs(ids)[1]
                if heavy:
                    at = (mix(keys) % U(BUCKETS)).astype(np.int64)
                    keys = keys[(_bitmap(heavy)[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
                held.append(keys)
                size += len(keys)
                if size > 4 * GATHERED:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    def add(table):
        read = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])
        keys, which = np.unique(read("keys", np.uint64), return_inverse=True)
        bound = np.bincount(which, read("bounds", np.uint32))
        return pa.table({"key": keys[bound >= least].view(np.int64)})

    return seqs.mapInArrow(run, "slice int, keys binary, bounds binary").groupBy("slice").applyInArrow(once(add), "key long")


def _dealt(rows: DataFrame, by: list[str], block_keys: int) -> DataFrame:
    """rows with a block each: blocks have some block_keys / 2 to block_keys rows by their hash."""
    n = rows.count()
    if n >= 1 << 31:
        raise ValueError(f"{n} candidates of one length: slots have 31 bits")
    return rows.withColumn("block", F.pmod(F.xxhash64(*by, F.lit(7)), F.lit(max(1, -(-4 * n // (3 * block_keys)) if n > block_keys else 1))).cast("int"))


def _bases(built: DataFrame) -> list[tuple[int, str, int, int]]:
    """(block, file, first slot, keys) of every block: a row a block."""
    out, base = [], 0
    for r in built.select("block", "uri", "size").where("uri is not null").orderBy("block").collect():
        out.append((r["block"], r["uri"], base, r["size"]))
        base += r["size"]
    return out


def key_blocks(keys: DataFrame, block_keys: int) -> list[tuple[int, str, int, int]]:
    folder = workdir(keys.sparkSession, "keys")

    def build(table):
        keys = np.sort(table.column("key").to_numpy().view(np.uint64))
        table_of = PerfectHash.of(keys)
        ordered = np.empty_like(keys)
        ordered[table_of.slots(keys)] = keys
        block, uri = table.column("block")[0].as_py(), f"{folder}/{uuid.uuid4().hex}.npz"
        put_file(uri, [_saved(sizes=np.array(table_of.sizes, np.int64), bits=table_of.bits, keys=ordered)])
        return pa.table({"block": pa.array([block], pa.int32()), "uri": [uri], "size": [len(keys)]})

    keys = staged(keys.select("key"), "phrase-keys")
    return _bases(staged(_dealt(keys, ["key"], block_keys).groupBy("block").applyInArrow(once(build), "block int, uri string, size long"), "phrase-blocks"))


def word_blocks(words: DataFrame, block_keys: int) -> tuple[list[tuple[int, str, int, int]], DataFrame]:
    """Blocks of the frequent words (lang, word, f), and the words with their slots."""
    folder = workdir(words.sparkSession, "words")

    def build(table):
        table = table.combine_chunks()
        keys = np.zeros(len(table), np.uint64)
        langs = table.column("lang").combine_chunks().dictionary_encode()
        tagged = [None] * len(table)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            at = np.flatnonzero(langs.indices.to_numpy() == k)
            own = table.column("word").combine_chunks().take(pa.array(at)).cast(pa.large_binary())
            keys[at] = _word_keys(lang, own)
            for i, x in zip(at.tolist(), _tagged(lang, own).to_pylist()):
                tagged[i] = x
        # Words of one 64-bit hash can't share a perfect hash: those after the first go to further files of this block.
        rows, left, nth = [], np.arange(len(keys)), 0
        while len(left):
            _, first = np.unique(keys[left], return_index=True)
            own = left[first]
            table_of = PerfectHash.of(keys[own])
            slot = table_of.slots(keys[own])
            own = own[np.argsort(slot)]
            cuts = np.concatenate(([0], np.cumsum([len(tagged[i]) for i in own]))).astype(np.int64)
            uri = f"{folder}/{uuid.uuid4().hex}.npz"
            put_file(uri, [_saved(sizes=np.array(table_of.sizes, np.int64), bits=table_of.bits, cuts=cuts, bytes=np.frombuffer(b"".join(tagged[i] for i in own), np.uint8))])
            part = table.take(pa.array(own))
            block = part.column("block")[0].as_py()
            rows.append(pa.table({"block": pa.array([block] * len(own), pa.int32()), "nth": pa.array([nth] * len(own), pa.int32()), "uri": pa.array([uri] + [None] * (len(own) - 1), pa.string()), "size": [len(own)] * len(own), "at": np.arange(len(own)), "lang": part.column("lang"), "word": part.column("word"), "f": part.column("f")}))
            left, nth = np.setdiff1d(left, own), nth + 1
        return pa.concat_tables(rows)

    built = staged(_dealt(words, ["lang", "word"], block_keys).groupBy("block").applyInArrow(once(build), "block int, nth int, uri string, size long, at long, lang string, word string, f long"), "word-blocks")
    numbered = built.withColumn("block", F.col("nth") * (1 << 20) + F.col("block"))
    blocks = _bases(numbered)
    bases = built.sparkSession.createDataFrame([(b, base) for b, _, base, _ in blocks], "block int, base long")
    return blocks, numbered.join(F.broadcast(bases), "block").select((F.col("base") + F.col("at")).alias("slot"), "lang", "word", "f")


WORDS = "lang string, words array<binary>, codes binary, slots binary, ids binary"


def word_sequences(texts: DataFrame, blocks) -> DataFrame:
    """Rows (ids) of (text, lang): slots of words, -1 for rare words and between pieces.  A pass a block."""

    def read(batch):
        for lang, rows in by_language(batch):
            held, starts = word_arrays(rows)
            coded = held.dictionary_encode()
            # A -1 goes in front of each piece: code -1 takes the last slot, which is always -1.
            codes = np.full(len(held) + int(starts.sum()), -1, np.int32)
            codes[np.arange(len(held)) + np.cumsum(starts)] = coded.indices.to_numpy()
            yield lang, coded.dictionary, codes, np.full(len(coded.dictionary) + 1, -1, np.int32)

    def reread(batch):
        for lang, words, codes, slots in zip(*(batch.column(k) for k in range(4))):
            yield lang.as_py(), words.values.cast(pa.large_binary()), np.frombuffer(codes.as_buffer(), np.int32), np.frombuffer(slots.as_buffer(), np.int32)

    def fill(uri, base, first, last):
        def run(batches):
            for batch in batches:
                for lang, words, codes, slots in (read if first else reread)(batch):
                    found = word_slots(uri, lang, words)
                    slots = np.append(np.where(found >= 0, found + base, slots[:-1]), -1).astype(np.int32)
                    row = [None, None, None, None, slots[codes].tobytes()] if last else [lang, words.to_pylist(), codes.tobytes(), slots.tobytes(), None]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.list_(pa.binary()), pa.binary(), pa.binary(), pa.binary()))], names=["lang", "words", "codes", "slots", "ids"])

        return in_pieces(run) if first else run

    for k, (_, uri, base, _) in enumerate(blocks):
        texts = staged(ship(texts).mapInArrow(fill(uri, base, k == 0, k == len(blocks) - 1), WORDS), "word-slots")
    return texts.select("ids")


STEP = f"ids binary, nxt binary, {PARTS}"


def advance(seqs: DataFrame, blocks) -> tuple[DataFrame, DataFrame]:
    """(rows of the slots of the phrases one word longer, sums of their counts by block and slice).  A pass a block."""

    def fill(block, uri, base, size, last):
        def run(batches):
            counts = np.zeros(size, np.int64)
            for batch in batches:
                known = _arrays(batch, "nxt") if "nxt" in batch.schema.names else None
                for ids in _arrays(batch):
                    nxt = next(known) if known else np.full(len(ids), -1, np.int32)
                    at, keys = _pairs(ids)
                    slot = key_slots(uri, keys)
                    at, slot = at[slot >= 0], slot[slot >= 0]
                    np.add(counts, np.bincount(slot, minlength=size), out=counts)
                    nxt = nxt.copy()
                    nxt[at] = slot + base
                    if last:  # of several -1 in a row one does
                        gap = nxt < 0
                        nxt = nxt[~(gap & np.append(False, gap[:-1]))]
                    yield _step(None if last else ids.tobytes(), nxt.tobytes())
            for row in _slices(block, counts):
                yield _step(None, None, *row.columns)

        return run

    sums = []
    for k, (block, uri, base, size) in enumerate(blocks):
        out = staged(seqs.mapInArrow(fill(block, uri, base, size, k == len(blocks) - 1), STEP), "phrase-slots")
        sums.append(out.where("counts is not null").select(*PARTS.replace(",", "").split()[::2]))
        seqs = out.where("counts is null").select("ids", "nxt")
    return seqs.select(F.col("nxt").alias("ids")), tree_sum(functools.reduce(DataFrame.union, sums))


def _step(ids, nxt, *counts):
    counts = counts or [pa.array([None], t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([ids], pa.binary()), pa.array([nxt], pa.binary()), *counts], names=["ids", "nxt", "block", "slice", "part", "counts"])


def counted(blocks, sums: DataFrame, least: int) -> DataFrame:
    """(slot, head, tail, f) of the keys that come up `least` times: head and tail are the slots of their parts."""
    where = {block: (uri, base, size) for block, uri, base, size in blocks}

    def run(table):
        uri, base, size = where[table.column("block")[0].as_py()]
        counts, keys = np.zeros(size, np.int64), _loaded(uri)[1]["keys"]
        for k, x in zip(table.column("slice").to_pylist(), table.column("counts")):
            part = np.frombuffer(x.as_buffer(), np.int64)
            counts[k * SLICE : k * SLICE + len(part)] = part
        at = np.flatnonzero(counts >= least)
        return pa.table({"slot": at + base, "head": (keys[at] >> U(32)).astype(np.int64), "tail": (keys[at] & U(0xFFFFFFFF)).astype(np.int64), "f": counts[at]})

    return sums.groupBy("block").applyInArrow(once(run), "slot long, head long, tail long, f long")


# ---- phrases ---------------------------------------------------------------------------------------


def score(a, n, left, right):
    """floor(1000 * a * n / (left * right)), exactly: numerators may have 38 digits."""
    d = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", d(a) * d(n) * F.lit(1000).cast("decimal(4,0)"), d(left) * d(right))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best `top` phrases of 2 to `longest` words."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).where("text is not null")
    words = staged(count_words(texts), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    blocks, slots = word_blocks(words.where(F.col("f") >= least), block_keys)
    none = F.array().cast("array<long>")
    level = staged(slots.join(totals, "lang").select("slot", "lang", "n", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("heads"), none.alias("tails")), "phrases-1")
    levels = []
    if blocks:
        positions = totals.agg(F.sum("n")).first()[0]
        seqs = word_sequences(texts, blocks)
        for k in range(2, longest + 1):
            blocks = key_blocks(candidates(seqs, least, heavy_buckets(seqs, least) if k == 2 else None, positions), block_keys)
            if not blocks:
                break
            seqs, sums = advance(seqs, blocks)
            h, t = level.alias("h"), level.alias("t")
            found = counted(blocks, sums, least).alias("g").join(h, F.col("g.head") == F.col("h.slot")).join(t, F.col("g.tail") == F.col("t.slot"))
            more = lambda side: F.concat(f"{side}.{'heads' if side == 'h' else 'tails'}", F.array(f"{side}.f"))
            level = staged(found.select("g.slot", "h.lang", "h.n", F.concat_ws(" ", "h.phrase", "t.last").alias("phrase"), "t.last", "g.f", more("h").alias("heads"), more("t").alias("tails"), "g.head", "g.tail"), f"phrases-{k}")
            levels.append(level)
    if not levels:
        return docs.sparkSession.createDataFrame([], OUT)
    return _best(levels, top)


OUT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def _best(levels: list[DataFrame], top: int) -> DataFrame:
    """Each language's first phrases of those that no longer candidate of the same count contains.

    A longer one has as many occurrences only if some phrase one word longer has, so the next level decides.
    """
    kept = []
    for level, longer in zip(levels, [*levels[1:], None]):
        if longer is not None:
            inside = longer.select(F.col("head").alias("slot"), "f").union(longer.select(F.col("tail").alias("slot"), "f"))
            level = level.join(inside, ["slot", "f"], "left_anti")
        kept.append(level.select("lang", "n", "phrase", "f", "heads", "tails"))
    rows = functools.reduce(DataFrame.union, kept)
    size = F.size("heads")
    cuts = F.transform(F.sequence(F.lit(1), size), lambda k: F.struct(score(F.col("f"), F.col("n"), F.get("heads", k - 1), F.get("tails", size - k)).alias("score"), k.alias("k"), F.get("heads", k - 1).alias("l"), F.get("tails", size - k).alias("r")))
    rows = rows.withColumn("cut", F.array_min(cuts)).select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    rows = staged(rows, "phrases")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part of a language first: what one task ranks at last is a small part of all phrases.
    parts = max(1, rows.count() >> 17)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
