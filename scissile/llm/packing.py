"""Best-fit decreasing packing of token sequences.

Lengths are at most the capacity, so a histogram of lengths says all that the
packer must know: it is collected (one entry a length), and best-fit decreasing
runs on it with a segment tree over remaining capacities that finds the tightest
open bin in logarithmic time.  Bins of equal remaining capacity are kept as
ranges of bin numbers, so runs of equal documents are placed together and the
plan has a few thousand rows whatever the corpus size.  Each piece then finds
its bin by its rank among the pieces of its length.

Defined results: null text is empty and gives the end token alone; texts of any
length are encoded whole and cut; documents of one length take places in no
defined order among each other; repeated rows are packed as often as they occur;
other columns are left out, whatever their names; an empty table gives an empty
table.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import in_pieces
from .storage import ship, staged

CAPACITY = 2048
END_ID = 0
#: Lead bytes up to here encode characters below U+0500, on whose classes both libraries agree.
PLAIN_LEAD = 0xD3


def load_encoder(json_path: str, ranks_path: str | None):
    """texts -> lists of ids, as tokenizers gives them for the file json_path without special tokens added.

    The same vocabulary as ranks, if given, serves texts of old, settled alphabets with a quarter of the CPU
    time; all other texts, and those with an added token's string, go through the tokenizer file itself.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(json_path)
    if not ranks_path:
        return lambda texts: [x.ids for x in own.encode_batch(texts, add_special_tokens=False)]
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [x.content for x in own.get_added_tokens_decoder().values()]

    def plain(text: str) -> bool:
        return max(text.encode(), default=0) <= PLAIN_LEAD and not any(x in text for x in added)

    def encode(texts):
        easy = [plain(t) for t in texts]
        rest = iter(own.encode_batch([t for t, e in zip(texts, easy) if not e], add_special_tokens=False))
        return [fast.encode_ordinary(t) if e else next(rest).ids for t, e in zip(texts, easy)]

    return encode


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part long, nth long"


def cut_pieces(docs: DataFrame, json_path: str, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: only documents over capacity are cut, and then only the first piece is short.

    part and nth (place among the task's pieces of one length) let pieces be ranked by length without a global sort.
    """

    def cut(batches):
        encode, seen = load_encoder(json_path, ranks_path), np.zeros(capacity + 1, np.int64)
        part = int.from_bytes(np.random.default_rng().bytes(7), "little")
        for batch in batches:
            rows = []
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), (y for i in range(0, len(texts), 256) for y in encode(texts[i : i + 256]))):
                ids = np.asarray([*ids, END_ID], "<u4")
                cuts = [0, *range(len(ids) % capacity or min(capacity, len(ids)), len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, int(seen[b - a])))
                    seen[b - a] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    return ship(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(in_pieces(cut), PIECES)


class OpenBins:
    """Segment tree over remaining capacities: which of them have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _set(self, r: int) -> None:
        i, self.any[self.size + r] = (self.size + r) // 2, bool(self.bins[r])
        while i:
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]
            i //= 2

    def put(self, r: int, first: int, count: int) -> None:
        if count:
            self.bins[r].append((first, count))
            self._set(r)

    def take(self, r: int) -> tuple[int, int]:
        got = self.bins[r].pop()
        self._set(r)
        return got

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least `need` that has an open bin."""
        i = self.size + need
        if self.any[i]:
            return need
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Best-fit decreasing over a histogram of lengths.

    Rows (length, first rank, pieces, first bin, pieces a bin, offset in the bin): piece `rank` of a length goes to
    bin first_bin + (rank - first) // a_bin at offset + (rank - first) % a_bin * length.  Also the number of bins.
    """
    bins, plan, used = OpenBins(capacity), [], 0
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                each = room // length
                first, n = used, -(-left // each)
                used += n
            else:
                first, n = bins.take(room)
                each = room // length
            whole = min(n, left // each)
            if whole:
                plan.append((length, rank, whole * each, first, each, capacity - room))
                bins.put(room - each * length, first, whole)
                rank, left, first, n = rank + whole * each, left - whole * each, first + whole, n - whole
            if n and left:  # fewer pieces are left than one more bin takes
                plan.append((length, rank, left, first, left, capacity - room))
                bins.put(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            bins.put(room, first, n)
    return plan, used


PLAN = "length int, first_rank long, pieces long, first_bin long, each long, offset long"


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    pieces = staged(cut_pieces(docs, json_path, ranks_path, capacity), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    by_part = staged(by_part.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row a length
    plan, _ = best_fit_decreasing(counts, capacity)
    table = spark.createDataFrame(plan, PLAN)
    # A row a task and length: it grows with the corpus, so it is never broadcast.
    ranked = pieces.join(by_part.select("length", "part", F.coalesce("before", F.lit(0)).alias("before")).hint("merge"), ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth")).drop("before", "part", "nth")
    # The plan has a few rows a length at most: its size is bounded by the capacity, not by the corpus.
    at = ranked.join(F.broadcast(table), (ranked["length"] == table["length"]) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("pieces"))).drop(table["length"])
    k = F.col("rank") - F.col("first_rank")
    bin_of = (F.col("first_bin") + F.floor(k / F.col("each"))).cast("long")
    return at.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", bin_of.alias("sequence_id"), (F.col("offset") + (k % F.col("each")) * F.col("length")).cast("long").alias("offset"))
