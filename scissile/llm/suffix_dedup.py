"""Removal of repeated passages by a distributed, blockwise suffix array.

A byte goes if a string of `span` bytes covers it that also starts in a document
with a smaller doc_id.  Equal windows (strings of `span` bytes) are brought
together by content, and suffixes are sorted in blocks:

1. Marks.  A window's mark is the smallest hash among the `gram`-byte strings
   inside it, so equal windows have equal marks.  Documents are read in chunks;
   each chunk sends every distinct mark once, as a few bytes, to the mark's
   bucket.  Marks that come up twice are told back to the chunks as bit masks.
2. Runs.  Neighbouring windows with one mark form a run, stored as one string.
   Runs whose mark came up once can't repeat and stay where they are.  Those of
   marks that came up in CROWD chunks or more, a common phrase in changing
   surroundings, are split by the bytes beside the mark's string and take a mark
   from them, so that the phrase doesn't fill one bucket.  The others and the
   split ones go to their bucket; within a chunk, of equal runs only the first
   document's is sent, as the later ones are repeats already.
3. Suffix sort, bucket by bucket (`repeated_windows`).  Equal runs collapse
   first.  The suffixes at window starts are then sorted one block of leading
   bytes at a time, by their first 16 bytes; longer ties are resolved by ranks
   of a difference-cover sample that were computed once for the bucket's text
   (Kaerkkaeinen's blockwise scheme).  Windows that are equal for `span` bytes
   stand next to each other; those of later documents are repeats.
4. Repeats return to their documents as runs of window starts, packed by
   document bucket, and the documents are cut.

A chunk is known by a hash of what it holds.  If a later pass deals documents
into other chunks, no mask is found and all their runs are sent, as they are and
split: slower, with the same result.

Defined results: null text is empty; a null doc_id neither removes nor loses
anything; rows that share a doc_id don't remove each other's text; texts shorter
than `span` stay, longer ones are cut whole, in overlapping parts; columns named
like the results are replaced, all others are kept; an empty table gives an empty
table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, in_pieces, mix, once, once_of_two, ranges, row_chunks, utf8
from .storage import delete, fresh_name, get_file, put_file, ship, staged, workdir

SPAN, GRAM = 50, 20
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: Parts of a bucket, by ranges of marks, that its task sorts one after another.
PARTS = 32
DOC_BUCKET_BYTES = 8 << 20
#: Bytes of runs that a task gathers before it sends them, so that rows to the buckets are few and long.
HELD_BYTES = 16 << 20
MAX_RUN = 4096
MAX_TASKS = 10_000
#: A difference cover modulo 13 (every difference modulo 13 occurs between two of its members).
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Chunks that make a mark a crowded one.
CROWD = 64
#: Windows sorted at a time.
BLOCK = 1 << 20


# ---- runs of windows with one mark -------------------------------------------------------------


#: A random number for each byte.
BYTES = mix(np.arange(1, 257, dtype=U) * U(0xA24BAED4963EE407))
#: Bytes hashed at a time, so that the arrays stay in the processor's cache.
HASH_BYTES = 1 << 16


def _grow(a: np.ndarray, shift: int) -> np.ndarray:
    """Hashes of longer strings: a's string, then the one `shift` bytes on."""
    n = max(0, len(a) - shift)
    h = a[:n] * U(0xD6E8FEB86659FD93)
    h += a[shift:]
    h ^= h >> U(32)
    return h


def _slide(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    have = 1
    while have * 2 <= width:
        h, have = np.minimum(h[:-have], h[have:]), have * 2
    rest = width - have
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def cut_runs(data: np.ndarray, off: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """(start, windows, mark, content hash, row) of the runs in texts data[off[i]:off[i+1]]."""
    parts = []
    for i, j in row_chunks(off, HASH_BYTES):
        start, count, mark, content, row = _cut_runs(data[off[i] : off[j]], off[i : j + 1] - off[i], span, gram)
        parts.append((start + off[i], count, mark, content, row + i))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U), none.astype(U), none
    return tuple(np.concatenate(x) for x in zip(*parts))


def _cut_runs(data, off, span, gram):
    none = np.zeros(0, np.int64)
    last = off[1:] - span
    have = last >= off[:-1]
    if not have.any():
        return none, none, none.astype(U), none.astype(U), none
    h16 = _h16(data)
    # gram and span are covered by overlapping strings of 16 bytes
    marks = _slide(mix(_grow(h16, gram - 16)), span - gram + 1)
    first, end = off[:-1][have], last[have] + 1
    fresh = np.zeros(len(marks) + 1, bool)
    fresh[1:-1] = marks[1:] != marks[:-1]
    fresh[first] = True
    fresh[end] = True
    inside = np.zeros(len(marks) + 1, np.int8)
    np.add.at(inside, first, 1)
    np.add.at(inside, end, -1)
    inside = np.cumsum(inside, dtype=np.int8).astype(bool)
    start = np.flatnonzero(fresh)
    stop = np.append(start[1:], len(marks))
    keep = inside[start]
    start, count = start[keep], (stop - start)[keep]
    if count.max(initial=0) > MAX_RUN:
        parts = -(-count // MAX_RUN)
        nth = ranges(np.zeros(len(count), np.int64), parts)
        start, count = np.repeat(start, parts) + nth * MAX_RUN, np.minimum(np.repeat(count, parts) - nth * MAX_RUN, MAX_RUN)

    # Minima crowd near zero; mixed again they spread over the buckets.
    return start, count, mix(marks[start] + U(1)), run_contents(data, h16, start, count, span), np.searchsorted(off, start, "right") - 1


def _h16(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on."""
    h = BYTES[data]
    for shift in (1, 2, 4, 8):
        h = _grow(h, shift)
    return h


def run_contents(data: np.ndarray, h16: np.ndarray, start: np.ndarray, count: np.ndarray, span: int) -> np.ndarray:
    """A hash of each run's text."""

    def window(p):
        h = np.zeros(len(p), U)
        for k in (*range(0, span - 16, 16), span - 16):
            h = mix(h * U(0xD6E8FEB86659FD93) + h16[p + k])
        return h

    # The first and last window cover a run of up to span + 1 windows; longer runs are hashed as a whole.
    content = mix(window(start) * U(0xA24BAED4963EE407) + window(start + count - 1)) + count.astype(U)
    for i in np.flatnonzero(count > span + 1).tolist():
        content[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + count[i] + span - 1].tobytes())
    return content


def split_runs(data: np.ndarray, start: np.ndarray, count: np.ndarray, mark: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """(run, first window in it, windows, mark, content hash): runs of crowded marks, cut by the 16 bytes that stand beside the mark's string.

    A window holds 16 bytes after that string or before it (else its own first 16 count); they are the same in equal
    windows, so these meet under the new mark as they did under the old one, and others part.
    """
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U), none.astype(U)
    text = data[ranges(start, count + span - 1)]
    base = np.cumsum(count + span - 1) - (count + span - 1)
    h16 = _h16(text)
    grams = mix(mix(_grow(h16, gram - 16)) + U(1))
    at, run = ranges(base, count), np.repeat(np.arange(len(start)), count)
    own = mark[run]
    deep = np.full(len(at), -1, np.int64)  # where in the window the mark's string begins first
    for k in range(span - gram + 1):
        deep[(deep < 0) & (grams[at + k] == own)] = k
    after, before = span - gram - deep >= 16, deep >= 16
    beside = np.where(after, at + deep + gram, np.where(before, at + deep - 16, at))
    side = np.where(after, 1, np.where(before, 2, 3)).astype(U)
    fine = mix(own ^ mix(h16[beside] + side * U(0xA24BAED4963EE407)))
    first = np.flatnonzero(np.append(True, (fine[1:] != fine[:-1]) | (run[1:] != run[:-1])))
    many = np.diff(np.append(first, len(at)))
    return run[first], at[first] - base[run[first]], many, fine[first], run_contents(text, h16, at[first], many, span)


def bucket_of(mark: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the mark."""
    return ((mark >> U(32)) * U(buckets)) >> U(32)


def present(bucket: np.ndarray):
    """(bucket, begin, end) of each bucket that occurs in ascending ones."""
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    return zip(bucket[start].tolist(), start.tolist(), [*start[1:].tolist(), len(bucket)])


def text_tag(data: bytes) -> int:
    """Tells rows of one doc_id apart."""
    return xxhash.xxh32_intdigest(data)


class Chunk:
    """Some documents of a task: their ids, tags and texts in one array; texts over the limit come in overlapping parts."""

    def __init__(self, ids, tags, lead, data, off):
        self.ids, self.tags, self.lead, self.data, self.off = ids, tags, lead, data, off
        self.name = xxhash.xxh3_128_hexdigest(data.tobytes() + off.tobytes() + ids.tobytes())


def chunks(batches, span: int = SPAN, limit: int = CHUNK_BYTES):
    """Chunks of (doc_id, text) batches, cut by size alone, so that equal input gives equal chunks."""
    ids, tags, lead, texts, size = [], [], [], [], 0

    def close():
        lens = np.array([len(x) for x in texts], np.int64)
        return Chunk(np.array(ids, np.int64), np.array(tags, np.uint32), np.array(lead, np.int64), np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum(lens)))

    for batch in batches:
        data, off = utf8(batch.column(1))
        raw = data.tobytes()
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            a, b = int(off[i]), int(off[i + 1])
            if doc_id is None or b - a < span:
                continue
            text = raw[a:b]
            tag = text_tag(text)
            for at in range(0, max(1, len(text) - span + 1), limit):
                part = text[at : at + limit + span - 1]
                if size and size + len(part) > limit:
                    yield close()
                    ids, tags, lead, texts, size = [], [], [], [], 0
                ids.append(doc_id), tags.append(tag), lead.append(at), texts.append(part)
                size += len(part)
    if texts:
        yield close()


# ---- suffix sort -------------------------------------------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as big-endian numbers; zeros after the end."""
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    out = np.empty(len(text) + 8, U)
    for r in range(8):
        n = len(range(r, len(out), 8))
        out[r::8] = np.frombuffer(padded[r : r + 8 * n].tobytes() if r + 8 * n <= len(padded) else np.concatenate([padded[r:], np.zeros(8, np.uint8)]).tobytes()[: 8 * n], ">u8")
    return out


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, dense rank of each item) by keys, the first counting most."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), np.int64)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def _cover_table() -> np.ndarray:
    """For each set of places modulo PERIOD (a bit each): the least shift that brings all into the cover, or -1."""
    members = np.arange(1 << PERIOD)
    table = np.full(1 << PERIOD, -1, np.int64)
    cover = sum(1 << c for c in COVER)
    for shift in reversed(range(PERIOD)):
        fit = sum(1 << r for r in range(PERIOD) if cover >> ((r + shift) % PERIOD) & 1)
        table[(members & ~fit) == 0] = shift
    return table


SHIFT = _cover_table()


def cover_ranks(words: np.ndarray, ends: np.ndarray, off: np.ndarray, span: int) -> np.ndarray:
    """Rank of the suffix at each sample place (place mod PERIOD in the cover), to the end of its string or at least
    `span` bytes; -1 elsewhere.  Names of PERIOD bytes are doubled until they reach far enough."""
    n = int(off[-1])
    in_cover = np.zeros(PERIOD, bool)
    in_cover[list(COVER)] = True
    place = np.flatnonzero(in_cover[np.arange(n) % PERIOD])
    left = ends[place] - place
    full = np.uint64(0xFFFFFFFFFFFFFFFF)

    def masked(w, have):
        keep = np.clip(have, 0, 8).astype(U) * U(8)
        return np.where(keep == 0, U(0), w & (full << (U(64) - np.maximum(keep, U(8)))))

    second = masked(words[np.minimum(place + 8, n)], np.minimum(left, PERIOD) - 8)
    length = np.minimum(left, PERIOD)
    _, rank = _dense(masked(words[place], length), second, length)
    known = np.zeros(n + 1, np.int64)  # rank plus one; 0: past the string's end
    reach = PERIOD
    while reach < span:
        known[place] = rank + 1
        after = np.where(left > reach, known[np.minimum(place + reach, n)], 0)
        _, rank = _dense((rank.astype(U) << U(32)) | after.astype(U))
        reach *= 2
    out = np.full(n + 1, -1, np.int64)
    out[place] = rank
    return out


def sorted_windows(text: np.ndarray, off: np.ndarray, at: np.ndarray, span: int = SPAN, block: int = BLOCK):
    """Blocks (places, class) of the windows at places `at`, in suffix order; equal windows, and only those, share a class.

    text holds strings text[off[i]:off[i+1]]; a window lies within one of them.
    """
    words = _words(text)
    ends = np.repeat(off[1:], np.diff(off))
    ranks = cover_ranks(words, ends, off, span)
    lead = (words[at] >> U(48)).astype(np.int64)
    sizes = np.bincount(lead, minlength=1 << 16)
    upto = np.cumsum(sizes)
    bound, classes = 0, 0
    while bound < 1 << 16:  # one block of leading bytes after another
        done = int(upto[bound - 1]) if bound else 0
        top = max(bound + 1, int(np.searchsorted(upto, done + block, "right")))
        if upto[top - 1] > done:
            place = at[(lead >= bound) & (lead < top)]
            order, group = _sort_block(words, ranks, place, span)
            yield place[order], group + classes
            classes += int(group[-1]) + 1
        bound = top


def _sort_block(words, ranks, place, span):
    """(order, class in order) of the windows at `place`."""
    n = len(place)
    order, rank = _dense(words[place], words[place + 8])
    group = rank[order]  # a class for each in order
    depth = 16
    while True:
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(start, n))
        tied = np.repeat(size > 1, size)
        if not tied.any() or depth >= span:
            break
        where = np.bitwise_or.reduceat(1 << (place[order] % PERIOD), start)
        shift = np.repeat(SHIFT[where], size)
        by_cover = tied & (shift >= 0)  # all of the tie reach the cover by one shift, within the equal bytes
        more = tied & (shift < 0)
        key, key2 = np.zeros(n, U), np.zeros(n, U)
        p = place[order]
        key[by_cover] = ranks[p[by_cover] + shift[by_cover]].astype(U)
        w = p[more]
        rest = span - depth
        cut = U(0xFFFFFFFFFFFFFFFF) << U(max(0, 64 - 8 * rest)) if rest < 8 else U(0xFFFFFFFFFFFFFFFF)
        key[more] = words[w + depth] & cut
        if rest > 8:
            key2[more] = words[w + depth + 8] & (U(0xFFFFFFFFFFFFFFFF) << U(max(0, 64 - 8 * (rest - 8))) if rest < 16 else U(0xFFFFFFFFFFFFFFFF))
        again, fine = _dense(group, key, key2)
        final = by_cover[again]
        order, group = order[again], fine[again]
        if final.any():
            # Ranks go to the string's end; windows that differ only after `span` bytes are one class.
            p = place[order]
            differs = np.append(True, group[1:] != group[:-1])
            check = np.flatnonzero(differs[1:] & final[1:] & final[:-1]) + 1
            same = np.ones(len(check), bool)
            for d in range(0, span, 8):
                keep = U(0xFFFFFFFFFFFFFFFF) << U(max(0, 8 * (d + 8 - span)))
                same &= (words[p[check] + d] & keep) == (words[p[check - 1] + d] & keep)
            differs[check[same]] = False
            group = np.cumsum(differs) - 1
        if not more.any():
            break
        depth += 16
    return order, np.cumsum(np.append(0, group[1:] != group[:-1]))


def repeated_windows(doc: np.ndarray, count: np.ndarray, text: np.ndarray, off: np.ndarray, content: np.ndarray, span: int = SPAN, block: int = BLOCK):
    """(run, first window, windows) of the windows of each run that also occur in a run of a smaller document."""
    _, kind = _dense(content)
    owner = np.full(int(kind.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(owner, kind, doc)
    later = doc > owner[kind]
    shown = np.zeros(len(owner), np.int64)
    shown[kind[::-1]] = np.arange(len(kind))[::-1]  # the run that stands for each content
    length = np.diff(off)
    pick = ranges(off[:-1][shown], length[shown])
    base = np.append(0, np.cumsum(length[shown]))
    own, windows = text[pick], count[shown]
    at = ranges(base[:-1], windows)
    of = np.repeat(np.arange(len(shown)), windows)
    back = np.zeros(len(own) + 1, np.int64)
    back[at] = of
    hit = np.zeros(len(own) + 1, bool)
    for place, group in sorted_windows(own, base, at, span, block):
        local = group - group[0]
        least = np.full(int(local[-1]) + 1, np.iinfo(np.int64).max)
        who = owner[back[place]]
        np.minimum.at(least, local, who)
        hit[place] = who > least[local]
    runs, first, many = [np.flatnonzero(later)], [np.zeros(int(later.sum()), np.int64)], [count[later]]
    mine = np.flatnonzero(~later & np.isin(kind, np.unique(of[hit[at]])))
    if len(mine):
        flat = np.concatenate([[False], hit])[ranges(base[:-1][kind[mine]], count[mine]) + 1]
        run = np.repeat(np.arange(len(mine)), count[mine])
        step = ranges(np.zeros(len(mine), np.int64), count[mine])
        head = flat & np.append(True, ~flat[:-1] | (run[1:] != run[:-1]))
        tail = flat & np.append(~flat[1:] | (run[1:] != run[:-1]), True)
        a, b = np.flatnonzero(head), np.flatnonzero(tail)
        runs.append(mine[run[a]]), first.append(step[a]), many.append(b - a + 1)
    return np.concatenate(runs), np.concatenate(first), np.concatenate(many)


# ---- packing for the shuffle -------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x.nbytes for x in arrays)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(x.tobytes() for x in arrays))


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds), 8)
    at, out = 8 * (len(kinds) + 1), []
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += int(size)
    return out


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names = [x.split() for x in schema.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], kinds[k]) for i, (n, k) in enumerate(names)})


MARKS = "bucket int, chunk string, marks binary"
MASKS = "bucket int, chunk string, mask binary"
RUNS = "bucket int, runs binary"
FLAGS = "doc_bucket int, flags binary"


def _send_marks(span, gram, buckets):
    def send(batches):
        for chunk in chunks(batches, span):
            _, _, mark, _, row = cut_runs(chunk.data, chunk.off, span, gram)
            own, n = np.unique(mark, return_counts=True)
            many = (n > 1).astype(np.uint8)
            low = own.astype(np.uint32)
            rows = [(b, chunk.name, low[i:j].tobytes() + np.packbits(many[i:j]).tobytes()) for b, i, j in present(bucket_of(own, buckets))]
            yield from _rows(MARKS, rows).to_batches()

    return send


def _count_marks(table: pa.Table) -> pa.Table:
    """Which marks of one bucket came up twice, and which in a crowd of chunks, told to each chunk as two bits a mark."""
    marks, many, sizes = [], [], []
    for blob in table.column("marks").to_pylist():
        n = len(blob) * 8 // 33
        while n * 4 + (n + 7) // 8 < len(blob):
            n += 1
        sizes.append(n)
        marks.append(np.frombuffer(blob, np.uint32, n))
        many.append(np.unpackbits(np.frombuffer(blob, np.uint8, -1, 4 * n), count=n))
    marks, many = np.concatenate(marks), np.concatenate(many)
    _, kind = _dense(marks)
    seen = np.bincount(kind, weights=1 + many)[kind]
    twice, crowded = seen > 1, seen >= CROWD
    cuts = np.append(0, np.cumsum(sizes))
    masks = [np.packbits(twice[a:b]).tobytes() + np.packbits(crowded[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table({"bucket": table.column("bucket").cast(pa.int32()), "chunk": table.column("chunk").cast(pa.string()), "mask": pa.array(masks, pa.binary())})


def _write_masks(folder):
    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        name = table.column("chunk")[0].as_py()
        blob = _pack(np.array(table.column("bucket").to_pylist(), np.int64), np.array([len(x) for x in table.column("mask").to_pylist()], np.int64), np.frombuffer(b"".join(table.column("mask").to_pylist()), np.uint8))
        put_file(f"{folder}/{name}", [blob])
        return pa.table({"chunk": [name]})

    return write


def _kept_runs(chunk, span, gram, buckets, folder):
    """The runs of a chunk that its mask doesn't rule out, those of crowded marks split: doc, tag, place in the document, windows, mark, content, text."""
    start, count, mark, content, row = cut_runs(chunk.data, chunk.off, span, gram)
    blob = get_file(f"{folder}/{chunk.name}") if len(start) else None
    whole = split = np.ones(len(start), bool)  # without a mask runs go both as they are and split
    if blob is not None:
        own = np.unique(mark)
        told = np.zeros((2, len(own)), bool)
        which, sizes, bits = _unpack(blob, np.int64, np.int64, np.uint8)
        ends = np.cumsum(sizes)
        at = bucket_of(own, buckets)
        for i, j, a, z in zip(np.searchsorted(at, which.astype(U)), np.searchsorted(at, which.astype(U), "right"), ends - sizes, ends):
            half = a + (z - a) // 2
            told[0, i:j], told[1, i:j] = np.unpackbits(bits[a:half], count=j - i), np.unpackbits(bits[half:z], count=j - i)
        twice, crowded = told[:, np.searchsorted(own, mark)]
        whole, split = twice & ~crowded, twice & crowded
    run, first, many, fine, inner = split_runs(chunk.data, start[split], count[split], mark[split], span, gram)
    row = np.concatenate([row[whole], row[split][run]])
    start = np.concatenate([start[whole], start[split][run] + first])
    count, mark, content = np.concatenate([count[whole], many]), np.concatenate([mark[whole], fine]), np.concatenate([content[whole], inner])
    where = chunk.lead[row] + start - chunk.off[row]
    return chunk.ids[row], chunk.tags[row], where, count, mark, content, chunk.data[ranges(start, count + span - 1)]


def _send_runs(span, gram, buckets, doc_buckets, folder):
    def close(held):
        doc, tag, where, count, mark, content, text = (np.concatenate(x) for x in zip(*held))
        off = np.cumsum(count + span - 1) - (count + span - 1)
        # Of equal runs held here only the smallest document's are sent.
        _, kind = _dense(content)
        owner = np.full(int(kind.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(owner, kind, doc)
        later = doc > owner[kind]
        yield from _flag_rows(doc[later], tag[later], where[later], count[later], doc_buckets, RUNS, -1)
        order = np.argsort(mark, kind="stable")
        order = order[~later[order]]
        at = bucket_of(mark[order], buckets * PARTS).astype(np.int64)
        rows = []
        for b, i, j in present(at // PARTS):
            o = order[i:j]
            part = text[ranges(off[o], count[o] + span - 1)]
            rows.append((b, _pack(np.bincount(at[i:j] - b * PARTS, minlength=PARTS).astype(np.uint32), doc[o], tag[o], where[o], count[o].astype(np.uint16), content[o], part)))
        yield from _rows(RUNS, rows).to_batches()

    def send(batches):
        held, size = [], 0
        for chunk in chunks(batches, span):
            held.append(_kept_runs(chunk, span, gram, buckets, folder))
            size += len(held[-1][-1])
            if size >= HELD_BYTES:
                yield from close(held)
                held, size = [], 0
        if held:
            yield from close(held)

    return send


def _flag_rows(doc, tag, where, count, doc_buckets, schema, bucket=None):
    """Flagged window runs by document bucket; with `bucket`, in the shape of rows that pass through the suffix sort."""
    order = np.lexsort((where, doc, doc % doc_buckets))
    of = (doc % doc_buckets)[order]
    cut = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
    rows = []
    for i, j in zip(cut, [*cut[1:], len(of)]):
        o = order[i:j]
        blob = _pack(doc[o], tag[o], where[o].astype(np.int64), count[o].astype(np.uint32))
        rows.append((int(of[i]), blob) if bucket is None else (bucket - int(of[i]), blob))
    return _rows(schema, rows).to_batches()


def _sort_runs(span, doc_buckets):
    def sort(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blobs = table.column("runs").to_pylist()
        if bucket < 0:
            return _rows(FLAGS, [(-1 - bucket, x) for x in blobs])
        blobs = [_unpack(x, np.uint32, np.int64, np.uint32, np.int64, np.uint16, U, np.uint8) for x in blobs]
        # Where each part's runs and bytes begin in each blob.
        edges = [np.append(0, np.cumsum(x[0].astype(np.int64))) for x in blobs]
        bytes_to = [np.append(0, np.cumsum(x[4].astype(np.int64) + span - 1)) for x in blobs]
        out = []
        for k in range(PARTS):
            cuts = [(x, e[k], e[k + 1], t) for x, e, t in zip(blobs, edges, bytes_to) if e[k + 1] > e[k]]
            if not cuts:
                continue
            doc, tag, where, count, content = (np.concatenate([x[c][i:j] for x, i, j, _ in cuts]) for c in range(1, 6))
            text = np.concatenate([x[6][t[i] : t[j]] for x, i, j, t in cuts])
            count = count.astype(np.int64)
            run, first, many = repeated_windows(doc, count, text, np.append(0, np.cumsum(count + span - 1)), content, span)
            out.append((doc[run], tag[run], where[run] + first, many))
        rows = list(_flag_rows(*(np.concatenate(x) for x in zip(*out)), doc_buckets, FLAGS)) if out else []
        return pa.Table.from_batches(rows) if rows else _rows(FLAGS, [])

    return sort


def cut_text(text: bytes, starts: np.ndarray, counts: np.ndarray, span: int) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs)."""
    if not len(starts):
        return text, 0, 0
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], (starts + counts)[order] + span - 1
    reach = np.maximum.accumulate(b)
    new = np.append(True, a[1:] > reach[:-1])
    begin, end = a[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]
    edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(text)]
    return b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])), int((end - begin).sum()), len(begin)


def _apply(span, text_column, names, bucket):
    def cut(docs: pa.Table, flags: pa.Table) -> pa.Table:
        parts = [_unpack(x, np.int64, np.uint32, np.int64, np.uint32) for x in flags.column("flags").to_pylist()]
        doc, tag, where, count = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
        order = np.lexsort((tag, doc))
        doc, tag, where, count = doc[order], tag[order], where[order], count[order].astype(np.int64)
        kept, removed, spans = [], [], []
        data, off = utf8(docs.column(text_column))
        raw = data.tobytes()
        for i, doc_id in enumerate(docs.column("doc_id").to_pylist()):
            text = raw[off[i] : off[i + 1]]
            a, b = (0, 0) if doc_id is None else (int(np.searchsorted(doc, doc_id)), int(np.searchsorted(doc, doc_id, "right")))
            mine = slice(a, b)
            if b > a and (tag[a] != tag[b - 1] or tag[a] != text_tag(text)):
                mine = a + np.flatnonzero(tag[a:b] == text_tag(text))
            left, r, s = cut_text(text, where[mine], count[mine], span)
            kept.append(left), removed.append(r), spans.append(s)
        out = docs.select([x for x in docs.column_names if x != bucket])
        for name, column in zip(names, (pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()))):
            out = out.append_column(name, column)
        return out

    return cut


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, names: tuple[str, str, str] = ("kept", "n_removed", "n_spans")) -> DataFrame:
    """docs with what is left (binary), bytes removed and removed runs in columns `names`; columns of docs by these names are replaced."""
    spark = ship(docs).sparkSession
    docs = docs.drop(*names).withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = docs.select("doc_id", "text")
    total = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(64, -(-total // BUCKET_BYTES))
    doc_buckets = next(n for n in range(max(17, total // DOC_BUCKET_BYTES), 1 << 31) if all(n % d for d in range(2, int(n**0.5) + 1)))
    folder = workdir(spark, "masks")
    marks = texts.mapInArrow(in_pieces(_send_marks(span, gram, buckets)), MARKS)
    # A task for every bucket, up to a few thousand, so that what a task reads doesn't grow with the corpus.
    tasks, doc_tasks = min(buckets, MAX_TASKS), min(doc_buckets, MAX_TASKS)
    masks = marks.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(once(_count_marks), MASKS)
    staged(masks.groupBy("chunk").applyInArrow(_write_masks(folder), "chunk string"), "mask-list")
    runs = texts.mapInArrow(in_pieces(_send_runs(span, gram, buckets, doc_buckets, folder)), RUNS)
    flags = staged(runs.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(once(_sort_runs(span, doc_buckets)), FLAGS), "flags")
    delete(spark, folder)
    schema = docs.select("*").schema.add(names[0], "binary").add(names[1], "long").add(names[2], "long")
    bucket = fresh_name(docs, "doc_bucket")
    left = docs.withColumn(bucket, F.coalesce(F.pmod("doc_id", F.lit(doc_buckets)), F.pmod(F.xxhash64("text"), F.lit(doc_buckets))).cast("int"))
    left, flags = left.repartition(doc_tasks, bucket), flags.repartition(doc_tasks, "doc_bucket")
    return left.groupBy(bucket).cogroup(flags.groupBy("doc_bucket")).applyInArrow(once_of_two(_apply(span, "text", names, bucket)), schema)

