"""A quality classifier by compression.

One zstandard dictionary is built from good labelled texts and one from bad.  A
text is compressed in pieces of `piece` bytes with either; the difference of the
summed sizes, over the text's length, is calibrated by logistic regression on
labelled texts that the dictionaries haven't seen.  A fit reads at most
`max_rows` labelled rows, of each text the stretches that sampling.STRETCHES and
STRETCH allow.

Defined results: null and empty texts score as the prior share of good labels;
texts of any length are compressed whole, piece by piece; without labels of both
kinds every text scores 0.5; repeated rows are kept; a column named like the
score is replaced, all others stay; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import in_pieces, utf8
from .sampling import class_counts, labelled
from .storage import ship

MAX_ROWS, PIECE, DICT_BYTES, LEVEL = 6000, 1024, 112 << 10, 3


class Sizes:
    """Compressed sizes of texts with either dictionary."""

    def __init__(self, good: bytes, bad: bytes, piece: int = PIECE):
        self.piece, self.packers = piece, []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT)
            d.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def differences(self, data: bytes, off: np.ndarray) -> np.ndarray:
        """Of each text: bytes that it takes more with the bad dictionary than with the good one, over its own; 0 for empty ones."""
        good, bad = (p.compress for p in self.packers)
        out = np.zeros(len(off) - 1)
        for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
            more = 0
            for i in range(a, b, self.piece):
                part = data[i : min(i + self.piece, b)]
                more += len(bad(part)) - len(good(part))
            if b > a:
                out[k] = more / (b - a)
        return out


def _design(x: np.ndarray, centre: float, spread: float) -> np.ndarray:
    return np.stack([np.ones(len(x)), (x - centre) / spread], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton's method."""
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + keep * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, table: pa.Table, counts: dict[int, int], piece: int = PIECE, dict_bytes: int = DICT_BYTES):
        y = np.array(table.column("label").to_pylist(), np.int64)
        texts = [x.encode() for x in table.column("text").to_pylist()]
        total = sum(counts.values())
        self.prior = counts[1] / total if total else 0.5
        self.good = self.bad = None
        folds = np.arange(len(y)) % 2
        if min((np.bincount(y[folds == k], minlength=2).min() if (folds == k).any() else 0) for k in (0, 1)) < 8:
            return

        def dictionary(k):
            parts = [t[i : i + 512] for t, own, fold in zip(texts, y, folds) if own == k and fold == 0 for i in range(0, len(t), 512)]
            raw = b"".join(parts)
            try:
                return zstandard.train_dictionary(min(dict_bytes, max(1024, len(raw) // 8)), parts).as_bytes()
            except zstandard.ZstdError:
                return None

        good, bad = dictionary(1), dictionary(0)
        if not good or not bad:
            return
        self.piece, self.good, self.bad = piece, good, bad
        mine = np.flatnonzero(folds == 1)
        off = np.append(0, np.cumsum([len(texts[i]) for i in mine]))
        x = Sizes(good, bad, piece).differences(b"".join(texts[i] for i in mine), off)
        # The sample holds both labels alike; weights restore their shares.
        share = np.bincount(y[mine], minlength=2) / len(mine)
        weight = np.where(y[mine] == 1, self.prior / share[1], (1 - self.prior) / share[0])
        self.centre, self.spread = float(x.mean()), float(x.std()) + 1e-9
        self.weights = fit_logistic(_design(x, self.centre, self.spread), y[mine].astype(float), weight)

    def scores(self, data: bytes, off: np.ndarray) -> np.ndarray:
        out = np.full(len(off) - 1, self.prior if self.good else 0.5)
        some = np.diff(off) > 0
        if self.good and some.any():
            if not hasattr(self, "_sizes"):
                self._sizes = Sizes(self.good, self.bad, self.piece)
            x = self._sizes.differences(data, off)
            out[some] = (1 / (1 + np.exp(-np.clip(_design(x, self.centre, self.spread) @ self.weights, -30, 30))))[some]
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_sizes"}


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    counts = class_counts(labels, "quality")
    return Model(labelled(docs, labels, "quality", counts, max_rows), counts)


def score_column(docs: DataFrame, model, name: str = "score") -> DataFrame:
    """docs with a double column of the model's scores; model: anything with scores(bytes, offsets)."""
    docs = ship(docs).drop(name)
    column = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size, whatever the corpus

    def run(batches):
        own = shared.value
        for batch in batches:
            data, off = utf8(batch.column(column))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.scores(data.tobytes(), off), pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(in_pieces(run), docs.select("*").schema.add(name, "double"))
