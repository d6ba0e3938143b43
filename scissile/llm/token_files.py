"""Token ids as binary files: one array of ids a file, document boundaries in Elias-Fano code.

Documents are dealt by ranges of doc_id, encoded where they land, and written in
ascending order as files of some `FILE_IDS` ids.  A file holds the ids of its
documents one after another (16 bits each where the vocabulary allows it) and two
monotone sequences in Elias-Fano code: the boundaries of the documents and their
doc_ids.  A value costs 2 bits and the logarithm of the mean gap; every
`SAMPLE`-th set bit's place is kept, so that `EliasFano.select` finds value i by
looking at a few bytes, and no table of 64-bit offsets is needed.  What files
there are, and how many documents and ids each has, is a small table (`write`),
which is also what makes them count: a retried task writes files of other names.

Encoding is done a distinct stretch between white space at a time: the tokenizer
drops white space and no token crosses it, so a text's ids are those of its
stretches in a row (tested against the tokenizer on whole texts).

Defined results: null text is empty and gives the end id alone; null doc_ids come
before all others; rows of one doc_id stand in the order of their texts' hashes,
and repeated rows are written as often as they occur; texts of any length are one
document; other columns are left out, whatever their names; an empty table gives
no file and no rows.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import in_pieces, ranges, utf8
from .storage import filesystem, put_file, ship, staged, workdir

END_ID = 2
#: A file is closed after the batch of documents that brings it to so many ids.
FILE_IDS = 1 << 24
#: Set bits between two whose places are kept.
SAMPLE = 256
MAGIC = b"EFTOKEN1"
#: magic; documents, those of null doc_id, ids; bytes an id; least doc_id; bytes of the two sequences; crc32 of the fields before.
HEADER = struct.Struct("<8sQQQQqQQI")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


class EliasFano:
    """A monotone sequence of whole numbers from 0: low bits packed, high bits in unary, places of some ones."""

    FIELDS = struct.Struct("<QQQ")

    def __init__(self, count: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.width, self.low, self.high, self.samples = count, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        width = max(0, int(int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        ones = np.zeros(int(places[-1]) + 1 if n else 0, bool)
        ones[places] = True
        return cls(n, width, np.packbits(bits.astype(bool).ravel(), bitorder="little"), np.packbits(ones, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return self.FIELDS.pack(self.count, self.width, len(self.high)) + self.samples.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, width, high = cls.FIELDS.unpack_from(data)
        at = cls.FIELDS.size
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at)
        at += samples.nbytes
        low = np.frombuffer(data, np.uint8, -(-n * width // 8), at)
        return cls(n, width, low, np.frombuffer(data, np.uint8, high, at + low.nbytes), samples)

    def select(self, i: int) -> int:
        """Value i, from the sampled place before it and the bytes between."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place, wanted = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, before = place // 8, int(_BITS[self.high[place // 8] & ((1 << place % 8) - 1)])
        wanted += before
        while (here := int(_BITS[self.high[byte]])) <= wanted:
            wanted -= here
            byte += 1
        bit = int(np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))[wanted])
        value, at = 8 * byte + bit - i, i * self.width
        held = int.from_bytes(self.low[at // 8 : (at + self.width + 7) // 8].tobytes(), "little")
        return value << self.width | (held >> at % 8) & ((1 << self.width) - 1)

    def values(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - np.arange(self.count)
        out = high.astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bits = np.unpackbits(self.low, count=self.count * self.width, bitorder="little").reshape(self.count, self.width)
            for b in range(self.width):
                out |= bits[:, b].astype(np.uint64) << np.uint64(b)
        return out

    def first_at_least(self, value: int) -> int:
        """The first index whose value is at least so much, by halving."""
        a, b = 0, self.count
        while a < b:
            mid = (a + b) // 2
            a, b = (mid + 1, b) if self.select(mid) < value else (a, mid)
        return a


def pack_file(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The chunks of a file; doc_ids ascend, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    base = int(known[0]) if len(known) else 0
    keys = EliasFano.of(known.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)).to_bytes()
    ends = EliasFano.of(np.concatenate(([0], np.cumsum(lengths)))).to_bytes()
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    fields = struct.pack("<8sQQQQqQQ", MAGIC, len(doc_ids), nulls, len(ids), width, base, len(keys), len(ends))
    return [fields, struct.pack("<I", zlib.crc32(fields)), keys, ends, ids.astype(f"<u{width}").tobytes()]


class TokenFile:
    """A file of documents for reading by place or by doc_id; only the bytes asked for are read."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        head = self._bytes(0, HEADER.size)
        magic, self.n_docs, self.nulls, self.n_ids, self.width, self.base, keys, ends, crc = HEADER.unpack(head)
        if magic != MAGIC or crc != zlib.crc32(head[:-4]):
            raise ValueError(f"{uri} is no token file, or damaged")
        self.keys = EliasFano.from_bytes(self._bytes(HEADER.size, keys))
        self.ends = EliasFano.from_bytes(self._bytes(HEADER.size + keys, ends))
        self.ids_at = HEADER.size + keys + ends

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def _bytes(self, at: int, n: int) -> bytes:
        got = self.file.read_at(n, at)
        if len(got) != n:
            raise ValueError("a token file is cut short")
        return got

    def doc_ids(self) -> list:
        return [None] * self.nulls + (self.keys.values() + np.uint64(self.base & (1 << 64) - 1)).astype(np.int64).tolist()

    def find(self, doc_id: int) -> range:
        """The places of a doc_id's documents."""
        first, last = (self.keys.first_at_least(max(0, d - self.base)) for d in (doc_id, doc_id + 1))
        return range(self.nulls + first, self.nulls + last)

    def ids(self, first: int, last: int | None = None) -> np.ndarray:
        """The ids of documents first to last (without it), or of one."""
        a, b = self.ends.select(first), self.ends.select(first + 1 if last is None else last)
        return np.frombuffer(self._bytes(self.ids_at + a * self.width, (b - a) * self.width), f"<u{self.width}")


#: Bytes at which stretches are cut apart; everything else between them goes to the tokenizer as it is.
_STRETCH = np.ones(256, bool)
_STRETCH[[9, 10, 13, 32]] = False
#: Between a plain letter (ASCII or Latin-1) and one of these, either way round, no token and no composed character goes on.
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?*&%$#@+/_-()[]{}\"")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _plain_letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte begins, and ends, a plain letter."""
    wide = np.zeros(len(data), bool)
    wide[:-1] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    one = _LETTER[data]
    ends = one.copy()
    ends[1:] |= wide[:-1]
    return one | wide, ends


#: Distinct stretches that a task remembers.
REMEMBERED = 1 << 19


def stretches(data: np.ndarray, off: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """(stretches, the row of each): what stands between white space, with marks cut from the words beside them."""
    inside = _STRETCH[data]
    start = np.zeros(len(data) + 1, bool)
    start[off] = True
    begins, ends = _plain_letters(data)
    stop = _STOP[data]
    start[1:-1] |= ~inside[:-1] | (stop[1:] & ends[:-1]) | (begins[1:] & stop[:-1])
    first = np.flatnonzero(start[:-1] & inside)
    kept = np.cumsum(inside) - inside
    cuts = np.append(kept[first], np.count_nonzero(inside)).astype(np.int64)
    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    return held, np.searchsorted(off, first, "right") - 1


#: Words that the tokenizer's normaliser only lower-cases and its pattern takes whole: letters of ASCII and Latin-1.
_PLAIN = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+").fullmatch
#: Byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512)))


class Encoder:
    """Texts to ids by a tokenizer file that drops white space; distinct stretches are encoded once, plain words by the model alone."""

    def __init__(self, json_path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(json_path)
        self.model = self.own.model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _plain(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode().lower().encode().decode("latin-1").translate(_ALPHABET))]

    def _other(self, stretches: list[bytes]) -> list[list[int]]:
        """Encodes stretches in a row; a token belongs to the stretch in which it starts."""
        texts = [x.decode() for x in stretches]
        got = self.own.encode(" ".join(texts), add_special_tokens=False)
        ids, at = got.ids, np.array([a for a, _ in got.offsets], np.int64)
        cuts = [0, *np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts])).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])] if texts else []

    def _learn(self, fresh: list[bytes]) -> None:
        plain, other = [x for x in fresh if _PLAIN(x)], [x for x in fresh if not _PLAIN(x)]
        ids = [self._plain(x) for x in plain] + self._other(other)
        self.known.update(zip(plain + other, range(len(self.known), len(self.known) + len(fresh))))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum([len(x) for x in ids])))
        self.flat = np.concatenate((self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.uint32)))

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each text has)."""
        data, off = utf8(column)
        held, row = stretches(data, off)
        coded = held.dictionary_encode()
        values = coded.dictionary.to_pylist()
        fresh = [v for v in values if v not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self._forget()
            fresh = values
        if fresh:
            self._learn(fresh)
        place = np.fromiter(map(self.known.__getitem__, values), np.int64, len(values))[coded.indices.to_numpy()]
        many = self.starts[place + 1] - self.starts[place]
        return self.flat[ranges(self.starts[place], many)], np.bincount(row, many, len(off) - 1).astype(np.int64)


@functools.lru_cache(maxsize=1)
def encoder_of(json_path: str) -> Encoder:
    """A worker's encoder lives on between its tasks."""
    return Encoder(json_path)


FILES = "part int, nth int, uri string, n_docs long, n_ids long"


def write(docs: DataFrame, json_path: str, end_id: int = END_ID, file_ids: int | None = None) -> DataFrame:
    """Encodes and writes all documents; a row a file with `before`, the ids of all files before it."""
    folder = workdir(docs.sparkSession, "tokens")
    file_ids = file_ids or FILE_IDS

    def run(batches):
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        encoder, doc_ids, lengths, held, size = encoder_of(json_path), [], [], [], 0

        def close():
            uri = f"{folder}/{part:06d}-{nth:06d}-{uuid.uuid4().hex}.tok"
            ids = np.concatenate(held)
            put_file(uri, pack_file(doc_ids, np.concatenate(lengths), ids))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "nth": pa.array([nth], pa.int32()), "uri": [uri], "n_docs": [len(doc_ids)], "n_ids": [len(ids)]})

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, many = encoder.encode(batch.column(1))
            with_end = np.full(len(ids) + len(many), end_id, np.uint32)
            with_end[np.arange(len(ids)) + np.repeat(np.arange(len(many)), many)] = ids
            doc_ids += batch.column(0).to_pylist()
            lengths.append(many + 1)
            held.append(with_end)
            size += len(with_end)
            if size >= file_ids:
                yield close()
                nth, doc_ids, lengths, held, size = nth + 1, [], [], [], 0
        if doc_ids:
            yield close()

    rows = ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The hash and the running number only deal and order rows of one doc_id: a doc_id may hold any share of all rows.
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "tie", "at").sortWithinPartitions("doc_id", "tie", "at").select("doc_id", "text")
    files = staged(rows.mapInArrow(in_pieces(run), FILES), "token-files")
    # A row a file, thousands of times fewer than documents.
    return files.withColumn("before", F.coalesce(F.sum("n_ids").over(W.orderBy("part", "nth").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Ids that a reader holds at a time, but for a longer document.
READ_IDS = 1 << 20


def read(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and crc32 of the ids as 32-bit numbers, of every document."""

    def run(batches):
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with TokenFile(uri) as f:
                    ends, keys = f.ends.values().astype(np.int64), f.doc_ids()
                    i = 0
                    while i < f.n_docs:
                        j = max(i + 1, int(np.searchsorted(ends, ends[i] + READ_IDS, "right")) - 1)
                        ids, cut = f.ids(i, j).astype("<u4"), ends[i : j + 1] - ends[i]
                        crcs = [zlib.crc32(ids[a:b]) for a, b in zip(cut, cut[1:])]
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys[i:j], pa.int64()), "start": ends[i:j] + before, "n_tokens": np.diff(cut), "ids_crc32": pa.array(crcs, pa.int64())})
                        i = j

    return ship(files).select("uri", "before").repartition(F.col("uri")).mapInArrow(run, READ)


def fetch(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the doc_ids in `wanted`: each file is asked by doc_id and only their ids are read.

    Each file's first and last doc_id prune the join; `wanted` may be of any size.
    """

    def ends_of(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with TokenFile(uri) as f:
                    if f.keys.count:
                        yield pa.RecordBatch.from_pydict({"uri": [uri], "low": [f.base], "high": [f.base + f.keys.select(f.keys.count - 1)]})

    def run(table):
        found = []
        with TokenFile(table.column("uri")[0].as_py()) as f:
            for d in pc.unique(table.column("doc_id")).to_pylist():
                found += [(d, f.ids(i).astype(np.int64).tolist()) for i in f.find(d)]
        return pa.Table.from_pydict({"doc_id": pa.array([d for d, _ in found], pa.int64()), "ids": pa.array([x for _, x in found], pa.list_(pa.int64()))})

    spans = staged(ship(files).select("uri").mapInArrow(ends_of, "uri string, low long, high long"), "token-spans")
    near = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(spans), F.col("doc_id").between(F.col("low"), F.col("high")))
    return near.select("uri", "doc_id").groupBy("uri").applyInArrow(run, "doc_id long, ids array<long>")
