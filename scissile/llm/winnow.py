"""Benchmark decontamination by winnowing.

Words are runs of digits, letters and non-ASCII characters, A-Z lowered.  Of
every `window - gram + 1` neighbouring k-grams the one with the smallest hash is
a fingerprint, so each span of `window` words that a document shares with an item
holds a fingerprint of both.  Fingerprints are joined with the items'; each match
is extended along its diagonal in both directions, and runs of `window` equal
words or more are hits.  Items of fewer words are one window: their first gram is
looked up at every place instead.

The items' index is broadcast in blocks of at most `block_bytes` of benchmark
text; a larger benchmark takes several passes over the documents, one block after
another, whose hits are staged and united.  Documents are known by doc_id and the
128-bit MD5 of the text there.

Defined results: null and wordless texts have no words; texts of any length are
searched whole; items without words or with a null item_id are left out; rows of
one item_id are one item; repeated documents are kept; a column named
like the result is replaced, all others stay; an empty benchmark hits nothing; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .arrays import LOWER, U, in_pieces, mix, ranges, row_chunks, span_hashes, utf8, words
from .storage import fresh_name, ship, staged

WINDOW, GRAM = 13, 5
BLOCK_BYTES = 16 << 20
CHUNK_BYTES = 1 << 19
#: Equal grams that are followed up at a time.
MATCHES = 1 << 19

#: The word characters of the decontamination rule, as bytes of UTF-8 after lowering.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def word_hashes(data: np.ndarray, off: np.ndarray):
    """(hash of each word, offsets of each row's words)."""
    low = LOWER[data]
    start, end, row = words(low, off, WORD)
    return span_hashes(low, start, end), np.searchsorted(row, np.arange(len(off)))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n words in a row, also across rows."""
    many = max(0, len(hashes) - n + 1)
    h = np.zeros(many, U)
    for k in range(n):
        h *= U(0xD6E8FEB86659FD93)
        h += hashes[k : k + many]
        h ^= h >> U(32)
    return mix(h)


def winnowed(grams: np.ndarray, off: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Places of the fingerprints: for every window of words within a row, its rightmost smallest gram."""
    width = window - gram + 1
    first, n = off[:-1], np.diff(off) - window + 1
    if (n <= 0).all():
        return np.zeros(0, np.int64)
    at = ranges(first[n > 0], n[n > 0])
    best = at.copy()
    for k in range(1, width):
        best = np.where(grams[at + k] <= grams[best], at + k, best)
    return best[np.append(True, best[1:] != best[:-1])]


class Index:
    """Fingerprints of some items, sorted, with the words to extend into."""

    def __init__(self, item_ids: list[str], texts: pa.Array, window: int = WINDOW, gram: int = GRAM):
        data, off = utf8(texts)
        self.window, self.gram, self.ids = window, gram, item_ids
        self.hashes, self.off = word_hashes(data, off)
        size = np.diff(self.off)
        grams = gram_hashes(self.hashes, gram)
        place = winnowed(grams, self.off, gram, window)
        self.long = _table(grams[place], place)
        self.short = {}
        for n in np.unique(np.minimum(size[(size > 0) & (size < window)], gram)).tolist():
            first = self.off[:-1][(size > 0) & (size < window) & (np.minimum(size, gram) == n)]
            self.short[n] = _table(gram_hashes(self.hashes, n)[first], first)
        self.item = np.repeat(np.arange(len(size)), size)

    def search(self, data: np.ndarray, off: np.ndarray):
        """(words a row, hit words a row, [(row, item)] as two arrays, (row, first word, words) of the hit spans)."""
        hashes, woff = word_hashes(data, off)
        grams = gram_hashes(hashes, self.gram)
        n_words = np.diff(woff)
        hit = np.zeros(len(hashes) + 1, np.int64)
        rows, items = [], []
        tables = []
        if len(self.long[0]):
            at = winnowed(grams, woff, self.gram, self.window)
            tables.append((grams[at], at, self.long))
        for n, table in self.short.items():
            g = grams if n == self.gram else gram_hashes(hashes, n)
            tables.append((g, np.arange(len(g)), table))
        for place, match in (x for t in tables for x in _look_up(*t)):
            item = self.item[match]
            row = np.searchsorted(woff, place, "right") - 1
            # A diagonal: where the item's first word would stand in the text.
            key = np.unique(np.stack([row, item, place - (match - self.off[item])]), axis=1)
            for i in range(0, key.shape[1], 20_000):
                self._extend(hashes, woff, *key[:, i : i + 20_000], hit, rows, items)
        covered = np.cumsum(hit[:-1]) > 0
        inside = np.append(0, np.cumsum(covered))
        n_hit = inside[woff[1:]] - inside[woff[:-1]]
        pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(items)]), axis=1) if rows else np.zeros((2, 0), np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]]).astype(np.int8)))
        return n_words, n_hit, pairs, (edge[::2], edge[1::2], woff)

    def _extend(self, hashes, woff, row, item, base, hit, rows, items):
        size = np.diff(self.off)[item]
        lo = np.maximum(base, woff[row])
        hi = np.minimum(base + size, woff[row + 1])
        n = np.maximum(hi - lo, 0)
        at = ranges(lo, n)
        equal = hashes[at] == self.hashes[ranges(self.off[item] + lo - base, n)]
        of = np.repeat(np.arange(len(n)), n)
        if not len(of):
            return
        new = np.append(True, of[1:] != of[:-1])
        begin = np.flatnonzero(equal & (new | np.append(True, ~equal[:-1])))
        end = np.flatnonzero(equal & (np.append(new[1:], True) | np.append(~equal[1:], True))) + 1
        good = end - begin >= np.minimum(self.window, size[of[begin]])
        begin, end = begin[good], end[good]
        np.add.at(hit, at[begin], 1)
        np.add.at(hit, at[end - 1] + 1, -1)
        found = np.unique(np.stack([row[of[begin]], item[of[begin]]]), axis=1)
        rows.append(found[0]), items.append(found[1])


def _table(grams: np.ndarray, place: np.ndarray):
    """Sorted grams with their places, and a bit map of 2^20 bits that rules most grams out."""
    order = np.argsort(grams, kind="stable")
    seen = np.zeros(1 << 20, bool)
    seen[(grams & U((1 << 20) - 1)).astype(np.int64)] = True
    return grams[order], place[order], seen


def _look_up(grams, at, table):
    """(places, places in the items) of equal grams, at most MATCHES at a time but for a single place."""
    keys, place, seen = table
    maybe = np.flatnonzero(seen[(grams & U((1 << 20) - 1)).astype(np.int64)])
    g = grams[maybe]
    a, n = np.searchsorted(keys, g, "left"), np.searchsorted(keys, g, "right")
    n -= a
    maybe, a, n = maybe[n > 0], a[n > 0], n[n > 0]
    for i, j in row_chunks(np.append(0, np.cumsum(n)), MATCHES):
        yield np.repeat(at[maybe[i:j]], n[i:j]), place[ranges(a[i:j], n[i:j])]


SPANS = "array<struct<start:long,length:long>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, name: str = "__bench") -> DataFrame:
    """docs with a column `name`: struct(n_words, n_hit, item_ids sorted as strings, spans of hit words)."""
    spark = ship(docs).sparkSession
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text") + 32)).head()[0] or 0
    blocks = max(1, -(-total // block_bytes))

    docs = docs.drop(name)

    def block(k: int):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        table = part.orderBy("item_id", "text").toArrow()  # one block, of block_bytes or so
        return spark.sparkContext.broadcast(Index(table.column("item_id").to_pylist(), table.column("text").combine_chunks(), window, gram))

    if blocks == 1:
        return _search(docs, block(0), name)
    key = fresh_name(docs, "row")
    docs = docs.withColumn(key, F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    keyed = docs.select(F.col(key).alias("__row"), "text").dropDuplicates(["__row"])
    united = None
    for k in range(blocks):  # one block's index is held at a time, and of all but the first only hits are kept
        index = block(k)
        part = _search(keyed, index).select("__row", "__bench")
        part = staged(part.where("__bench.n_hit > 0") if k else part, "benchmark-hits")
        index.destroy()
        united = part if united is None else united.unionByName(part)

    def unite(spans):
        return F.aggregate(F.sort_array(F.flatten(spans)), F.array().cast(SPANS), lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1).start + F.element_at(done, -1).length >= x.start), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(F.element_at(done, -1).start.alias("start"), (F.greatest(F.element_at(done, -1).start + F.element_at(done, -1).length, x.start + x.length) - F.element_at(done, -1).start).alias("length"))))).otherwise(F.concat(done, F.array(x))))

    united = united.groupBy("__row").agg(F.max("__bench.n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("__bench.item_ids")))).alias("item_ids"), unite(F.collect_list("__bench.spans")).alias("spans"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x.length)
    bench = united.select("__row", F.struct("n_words", n_hit.alias("n_hit"), "item_ids", "spans").alias("__bench"))
    return docs.join(bench.withColumnsRenamed({"__row": key, "__bench": name}), key).drop(key)


def _search(docs: DataFrame, index, name: str = "__bench") -> DataFrame:
    schema = docs.select("*").schema.add(name, DataType.fromDDL(f"struct<n_words:long,n_hit:long,item_ids:array<string>,spans:{SPANS}>"))
    column = docs.columns.index("text")
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))])

    def run(batches):
        own = index.value
        for batch in batches:
            data, off = utf8(batch.column(column))
            found = []
            for i, j in row_chunks(off, CHUNK_BYTES):
                n_words, n_hit, (rows, items), (begin, end, woff) = own.search(data[off[i] : off[j]], off[i : j + 1] - off[i])
                names: dict[int, set] = {}
                for r, x in zip(rows.tolist(), items.tolist()):
                    names.setdefault(r, set()).add(own.ids[x])
                spans: dict[int, list] = {}
                for a, b in zip(begin.tolist(), end.tolist()):  # a span of neighbouring rows' hits is cut at the row
                    while a < b:
                        r = int(np.searchsorted(woff, a, "right")) - 1
                        stop = min(b, int(woff[r + 1]))
                        spans.setdefault(r, []).append({"start": a - int(woff[r]), "length": stop - a})
                        a = stop
                found += [{"n_words": w, "n_hit": h, "item_ids": sorted(names.get(r, ())), "spans": spans.get(r, [])} for r, (w, h) in enumerate(zip(n_words.tolist(), n_hit.tolist()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, name])

    return docs.mapInArrow(in_pieces(run), schema)


def is_contaminated(bench):
    """The rule: at least one hit word, and hits in a twentieth of the words or more."""
    return (bench.n_hit > 0) & (bench.n_hit * 20 >= bench.n_words)


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
