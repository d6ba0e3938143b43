"""Toxicity by FTRL-proximal logistic regression.

Features are hashed word unigrams, bigrams and skip-grams (one word left out),
present or absent in the text.  Each coordinate has its own learning rate, and an
L1 term keeps most weights at zero, so the broadcast model is the short list of
the others.  A fit reads at most `max_rows` labelled rows, of each text the
stretches that sampling.STRETCHES and STRETCH allow, and weights either label as
half of the rows, in `updates` steps: a score means the same whatever the size
of the table and the share of toxic rows in it.

Defined results: null and wordless texts score as the intercept says; texts of
any length are scored whole, a piece of CHUNK_BYTES after another, and cut
between rows only; without labels of both kinds every text scores 0; repeated
rows are kept; a column named like the score is replaced, all others stay; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import U, mix, row_chunks, utf8
from .sampling import class_counts, labelled
from .winnow import word_hashes

MAX_ROWS, BITS, CHUNK_BYTES = 12_000, 20, 1 << 19
ALPHA, BETA, L1, L2, UPDATES = 3.0, 1.0, 20.0, 0.0, 48_000


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS):
    """(row, feature) of every n-gram and skip-gram, repeats included."""
    hashes, woff = word_hashes(data, off)
    row = np.repeat(np.arange(len(woff) - 1), np.diff(woff))
    down = U(64 - bits)
    rows, found = [row], [mix(hashes) >> down]
    for gap, salt in ((1, 0x9FB21C651E98DF25), (2, 0xD1342543DE82EF95)):
        if len(hashes) > gap:
            same = row[:-gap] == row[gap:]
            rows.append(row[:-gap][same])
            found.append(mix(hashes[:-gap][same] * U(salt) + hashes[gap:][same]) >> down)
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


class Model:
    def __init__(self, table: pa.Table, bits: int = BITS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2, updates=UPDATES):
        self.bits = bits
        y = np.array(table.column("label").to_pylist(), np.float64)
        self.known = bool(len(y) and 0 < y.mean() < 1)
        self.index, self.weight, self.bias = np.zeros(0, np.int64), np.zeros(0), 0.0
        if not self.known:
            return
        data, off = utf8(table.column("text"))
        own = []
        for i, j in row_chunks(off, CHUNK_BYTES):
            row, feature = features(data[off[i] : off[j]], off[i : j + 1] - off[i], bits)
            key = np.unique(row << bits | feature)
            cut = np.searchsorted(key >> bits, np.arange(j - i + 1))
            own += [key[a:b] & ((1 << bits) - 1) for a, b in zip(cut, cut[1:])]
        z, n = np.zeros(1 << bits), np.zeros(1 << bits)
        heavy = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        bias, bias_n = 0.0, 0.0

        def weights(k):
            zk = z[k]
            return np.where(np.abs(zk) <= l1, 0.0, -(zk - np.sign(zk) * l1) / ((beta + np.sqrt(n[k])) / alpha + l2))

        for _ in range(max(1, round(updates / len(y)))):
            for k, label, much in zip(own, y, heavy):
                w = weights(k)
                p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
                g = much * (p - label)
                sigma = (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / alpha
                z[k] += g - sigma * w
                n[k] += g * g
                bias_n += g * g
                bias -= 0.1 * g / (1 + np.sqrt(bias_n))
        every = weights(np.arange(1 << bits))
        self.index = np.flatnonzero(every)
        self.weight, self.bias = every[self.index], bias

    def scores(self, data: bytes, off: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.zeros(len(off) - 1)
        if not hasattr(self, "_table"):
            self._table = np.zeros(1 << self.bits, bool)
            self._table[self.index] = True
        raw, total = np.frombuffer(data, np.uint8), np.full(len(off) - 1, self.bias)
        for i, j in row_chunks(off, CHUNK_BYTES):
            row, feature = features(raw[off[i] : off[j]], off[i : j + 1] - off[i], self.bits)
            some = self._table[feature]
            key = np.unique(row[some] << self.bits | feature[some])
            np.add.at(total, i + (key >> self.bits), self.weight[np.searchsorted(self.index, key & ((1 << self.bits) - 1))])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    return Model(labelled(docs, labels, "toxic", class_counts(labels, "toxic"), max_rows))
