"""Spelling variants: words one edit apart, found by Aho-Corasick over halves of words.

Of two words that differ by one inserted, deleted or replaced code point, one's
half stands unchanged in the other, at the start or at the end.  The half with
the edit is the pair's window: it holds the first place at which the words part,
so that each pair is found in one window only.

* every word is a holder with two windows (either half) and a scanner with two
  for each length that a partner may have; both are dealt by what is left of the
  holder without its window, so partners meet;
* windows in which more than `CROWD` rows meet are halved, again and again, until
  none is crowded or a window is one code point wide (it then has as many holders
  as there are code points, and so is as small as the alphabet);
* each shard builds an automaton of its holders' fixed segments, scans its words,
  takes matches at the segment's own offset and of fitting length, and verifies
  the distance.

What goes out is a row a word and shard: how many near words, and the commonest.

Words are runs of letters A-Z, a-z and U+00C0 to U+00FF (0xC3 and a byte in
UTF-8); a typing error is dealt to one occurrence in `SLIPS` by the crc32 of its
document and run, put together from the crc32 of both by a table a length.

Defined results: null and wordless texts give nothing; a null doc_id is an empty
string in the hash; repeated rows count as often as they occur; texts and words
of any length are handled whole; of near words with the same count the smallest
in code-point order is the form; other columns are left out, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, in_pieces, once, utf8
from .storage import ship, staged

SLIPS = 31
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A word's form comes up at least so many times as often.
FACTOR = 10
#: Rows that meet in a window before it is halved.
CROWD = 64
#: Rows of a shard.
SHARD_ROWS = 1 << 16
#: Distinct words that a mapper counts before it sends them on.
GATHERED = 1 << 19

_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


# ---- words -----------------------------------------------------------------------------------------


def runs(texts) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """(maximal runs of letters, the row of each), A-Z lowered."""
    data, off = utf8(texts)
    lead = data == 0xC3
    inside = _ASCII[data] | lead
    inside[1:] |= lead[:-1]
    start = np.zeros(len(data) + 1, bool)
    start[off] = True
    start[1:-1] |= ~inside[:-1]
    first = np.flatnonzero(start[:-1] & inside)
    kept = np.cumsum(inside) - inside
    cuts = np.append(kept[first], np.count_nonzero(inside)).astype(np.int64)
    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(cuts), pa.py_buffer(LOWER[data[inside]])])
    return held, np.searchsorted(off, first, "right") - 1


@functools.lru_cache(maxsize=4096)
def _shift(length: int) -> np.ndarray:
    """Tables by byte: crc32(a + b) is the crc32 of a sent through them, by the length of b, and of b, XORed."""
    zeros = b"\0" * length
    still = zlib.crc32(zeros, 0)
    unit = [zlib.crc32(zeros, 1 << k) ^ still for k in range(32)]
    table = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            table[byte, 1 << bit : 2 << bit] = table[byte, : 1 << bit] ^ np.uint32(unit[8 * byte + bit])
    return table


def joined_crc(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of strings put together, from those of their parts and the lengths of the right ones."""
    sizes, which = np.unique(length, return_inverse=True)
    out = np.empty(len(left), np.uint32)
    order = np.argsort(which, kind="stable")
    for n, at in zip(sizes, np.split(order, np.cumsum(np.bincount(which))[:-1])):
        table, c = _shift(int(n)), left[at]
        out[at] = table[0, c & 255] ^ table[1, (c >> 8) & 255] ^ table[2, (c >> 16) & 255] ^ table[3, c >> 24]
    return out ^ right


def slipped(doc_ids, texts):
    """(word, count) of all occurrences of a batch after typing errors, long enough words only."""
    held, row = runs(texts)
    if not len(held):
        return
    coded = held.dictionary_encode()
    words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    own = np.array([zlib.crc32(w) for w in words], np.uint32)
    size = np.array([len(w) for w in words], np.int64)
    points = size - np.array([w.count(b"\xc3") for w in words])
    front = np.array([zlib.crc32(b":" if d is None else b"%d:" % d) for d in doc_ids], np.uint32)
    h = joined_crc(front[row], own[code], size[code])
    slip = h % SLIPS == 0
    whole = np.bincount(code[~slip], minlength=len(words))
    for k in np.flatnonzero((whole > 0) & (points >= LEAST_LENGTH)).tolist():
        yield words[k].decode(), int(whole[k])
    code, place = code[slip], h[slip] % points[code[slip]]
    long = points[code] > LEAST_LENGTH
    cut, n = np.unique(np.stack((code[long], place[long].astype(np.int64))), axis=1, return_counts=True)
    for k, p, m in zip(*cut.tolist(), n.tolist()):
        word = words[k].decode()
        yield word[:p] + word[p + 1 :], m


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of LEAST_LENGTH code points and more that come up LEAST_COUNT times or more."""

    def run(batches):
        held: dict[str, int] = {}
        out = lambda: pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
        for batch in batches:
            for word, n in slipped(batch.column(0).to_pylist(), batch.column(1)):
                held[word] = held.get(word, 0) + n
            if len(held) > GATHERED:
                yield out()
                held = {}
        yield out()

    rows = ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    return rows.mapInArrow(in_pieces(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---- near words ------------------------------------------------------------------------------------


def _halves(lo: Column, hi: Column) -> tuple[Column, Column, Column]:
    mid = lo + F.floor((hi - lo) / 2).cast("int")
    return lo, mid, hi


def halved(rows: DataFrame) -> DataFrame:
    """Each window [lo, hi) of the holder as its two halves."""
    lo, mid, hi = _halves(F.col("lo"), F.col("hi"))
    window = F.explode(F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi"))))
    rows = rows.withColumn("window", window)
    # A key is all of the holder but the window; a scanner's end of the window lies `shift` further.
    left = F.substr("word", F.lit(1), F.col("window.lo"))
    right = F.substr("word", F.col("window.hi") + F.col("shift") + 1, F.length("word"))
    key = F.xxhash64(F.length("word") - F.col("shift"), F.col("window.lo"), left, right)
    return rows.select("word", "n", "shift", "holder", F.col("window.lo").alias("lo"), F.col("window.hi").alias("hi"), key.alias("key"))


def windows(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Holders and scanners by the windows in which they may meet; crowded windows halved."""
    length = F.length("word")
    whole = lambda shift, holder: words.select("word", "n", F.lit(shift).alias("shift"), F.lit(holder).alias("holder"), F.lit(0).alias("lo"), (length - shift).cast("int").alias("hi"))
    rows = staged(halved(whole(0, True).union(whole(0, False)).union(whole(1, False)).union(whole(-1, False))), "windows")
    done = []
    while True:
        # Windows without a holder and a scanner other than itself are of no use.
        met = rows.groupBy("key").agg(F.count("*").alias("many"), F.count_if("holder").alias("holders"), F.max(F.col("hi") - F.col("lo")).alias("wide")).where("holders > 0 and many > 2")
        rows = staged(rows.join(met.select("key", ((F.col("many") > crowd) & (F.col("wide") > 1)).alias("crowded")), "key"), "windows-met")
        done.append(rows.where("not crowded").drop("crowded"))
        more = rows.where("crowded").drop("crowded")
        if more.isEmpty():
            return functools.reduce(DataFrame.unionByName, done)
        rows = halved(more)


def _parting(held: str, seen: str, lo: int, hi: int) -> bool:
    """Whether the words are one edit apart and part within the window [lo, hi) of the first; they agree outside of it."""
    most = min(len(held), len(seen))
    p = lo
    while p < most and held[p] == seen[p]:
        p += 1
    if not (p < hi or p == hi == len(held)):
        return False
    if len(held) == len(seen):
        return p < most and held[p + 1 :] == seen[p + 1 :]
    return held[p + 1 :] == seen[p:] if len(held) > len(seen) else held[p:] == seen[p + 1 :]


def search(rows: list[tuple[str, int, int, bool, int, int]]) -> dict[str, list]:
    """Of a shard's rows (word, n, shift, holder, lo, hi): of each scanned word how many holders are near it, and the commonest."""
    import ahocorasick

    # A holder's segment is the longer of the fixed parts beside its window: at the word's start, or at its end.
    segments: dict[str, dict] = {}
    scanned: dict[str, set] = {}
    for word, n, shift, holder, lo, hi in rows:
        if holder:
            front, segment = (True, word[:lo]) if lo >= len(word) - hi else (False, word[hi:])
            rest = word[hi:] if front else word[:lo]
            segments.setdefault(segment, {}).setdefault((front, len(word), lo, hi, rest), []).append((word, n))
        else:
            scanned.setdefault(word, set()).add((len(word) - shift, lo, hi))
    automaton = ahocorasick.Automaton()
    for segment in segments:
        automaton.add_word(segment, segment)
    if not segments:
        return {}
    automaton.make_automaton()
    out: dict[str, list] = {}
    for word, wanted in scanned.items():
        size = len(word)
        for end, segment in automaton.iter(word):
            at_front, at_end = end + 1 == len(segment), end + 1 == size
            if not (at_front or at_end):
                continue
            held = segments[segment]
            for length, lo, hi in wanted:
                shift = size - length
                for front in (True, False):
                    if front and not (at_front and lo == len(segment)) or not front and not (at_end and length - hi == len(segment)):
                        continue
                    for other, n in held.get((front, length, lo, hi, word[hi + shift :] if front else word[:lo]), ()):
                        if other != word and _parting(other, word, lo, hi):
                            best = out.setdefault(word, [0, 0, ""])
                            best[0] += 1
                            if n > best[1] or n == best[1] and other < best[2]:
                                best[1:] = [n, other]
    return out


NEAR = "word string, n_near long, near_n long, near string"


def near_words(words: DataFrame, crowd: int = CROWD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(word, n_near, near_n, near): how many words are one edit away, and the commonest of them, of words that have any."""

    def run(table):
        names = ("word", "n", "shift", "holder", "lo", "hi")
        found = search(list(zip(*(table.column(c).to_pylist() for c in names))))
        columns = zip(*((w, *x) for w, x in found.items())) if found else ([], [], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "near_n", "near"])

    rows = staged(windows(words, crowd), "windows-all")
    shards = max(1, rows.count() // shard_rows)
    parts = ship(rows).withColumn("shard", F.pmod("key", F.lit(shards))).groupBy("shard").applyInArrow(once(run), NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.near").alias("near"))


def variants(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = staged(count_words(docs), "spelling-words")
    found = words.join(near_words(words, crowd), "word", "left")
    common = F.col("near_n") >= FACTOR * F.col("n")
    found = staged(found.select("word", F.when(common, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(common, F.col("near_n")).alias("form_n")), "spelling-forms")
    # Forms grow at least FACTOR-fold, so a chain has no more links than n has digits: doubling ends in five rounds.
    links = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        links = staged(links.join(ahead, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "spelling-roots")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return found.join(links.drop("moved"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
