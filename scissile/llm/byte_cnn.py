"""Language identification by a byte-level convolutional network, trained in numpy.

Bytes (A-Z lowered; those that the sample lacks share one class) are embedded;
filters of several widths slide over windows of `length` bytes, the largest
response of each is kept, and a softmax layer reads them.  A text is cut into such
windows from end to end; their mean log-probabilities decide.  In use, embedding
and filters are multiplied out into lookup tables over pairs of bytes, so a filter
costs half as many gathers as it has bytes.

A fit reads at most `max_rows` rows, dealt equally over the languages, of each
text the stretches that sampling.STRETCHES and STRETCH allow, and of those
FIT_WINDOWS windows dealt over all of them; windows of under LEAST_LETTERS letters aren't learned from, unless
there are no others.  The MAX_LANGUAGES most frequent languages are learned.

Defined results: null texts and texts without a letter are `und` with score 0;
texts of any length are read whole; if no language can be learned all are `und`;
equal scores go to the language that sorts first; repeated rows are kept; columns
named like the results are replaced, all others stay; an empty table gives an
empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import LOWER, in_pieces, ranges, utf8
from .sampling import residue, share_of, stretches
from .storage import ship

MAX_ROWS, MAX_LANGUAGES, FIT_WINDOWS, LEAST_LETTERS = 2000, 512, 8, 20
LENGTH, WIDTHS, FILTERS, DIM = 256, (2, 4), 16, 8
STEPS, BATCH, RATE = 500, 128, 0.01
#: Letters and numerals; which of them are letters str.isalpha tells.
LETTER = re.compile(r"[^\W\d_]")
#: Classes of the filler after a text's end and of bytes that the sample lacks.
FILLER, OTHER, FIRST = 0, 1, 2
#: Bytes that belong to letters, mostly.
LETTERS = np.zeros(256, bool)
LETTERS[97:123] = LETTERS[128:] = True


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in LETTER.finditer(text))


class Net:
    def __init__(self, kinds: int, classes: int, seed: int = 7):
        """A network over `kinds` classes of bytes."""
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"e": draw(kinds, DIM, scale=0.5), "v": draw(len(WIDTHS) * FILTERS, classes, scale=0.1), "c": np.zeros(classes, np.float32), "b": np.zeros((len(WIDTHS), FILTERS), np.float32)}
        self.p |= {f"w{i}": draw(w, DIM, FILTERS, scale=1 / np.sqrt(w * DIM)) for i, w in enumerate(WIDTHS)}

    def forward(self, x: np.ndarray):
        """x: (windows, length) classes.  (log-probabilities, pooled, places of the largest responses)."""
        pooled, places = [], []
        for i, w in enumerate(WIDTHS):
            t = np.einsum("cd,kdf->kcf", self.p["e"], self.p[f"w{i}"])
            n = x.shape[1] - w + 1
            z = sum(t[k][x[:, k : k + n]] for k in range(w))
            at = z.argmax(1)
            places.append(at)
            pooled.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0] + self.p["b"][i])
        h = np.maximum(np.concatenate(pooled, 1), 0)
        logit = h @ self.p["v"] + self.p["c"]
        logit -= logit.max(1, keepdims=True)
        return logit - np.log(np.exp(logit).sum(1, keepdims=True)), h, places

    def gradients(self, x: np.ndarray, y: np.ndarray):
        logp, h, places = self.forward(x)
        d = np.exp(logp)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"v": h.T @ d, "c": d.sum(0), "e": np.zeros_like(self.p["e"]), "b": np.zeros_like(self.p["b"])}
        dh = (d @ self.p["v"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            own = dh[:, i * FILTERS : (i + 1) * FILTERS]
            g["b"][i] = own.sum(0)
            g[f"w{i}"] = np.zeros_like(self.p[f"w{i}"])
            for k in range(w):
                t = np.zeros((len(self.p["e"]), FILTERS), np.float32)
                seen = np.take_along_axis(x, places[i] + k, 1)
                np.add.at(t, (seen, np.arange(FILTERS)[None, :]), own)
                g[f"w{i}"][k] = self.p["e"].T @ t
                g["e"] += t @ self.p[f"w{i}"][k].T
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 11):
        """Adam over random batches."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(x), min(batch, 4 * len(x)))
            for k, g in self.gradients(x[pick], y[pick]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                self.p[k] -= (rate * (1 - 0.9 * t / steps) * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def windows(data: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """((windows, length) lowered bytes, which of them are text, windows a row): each text from end to end; short texts stand once."""
    many = np.maximum(1, -(-np.diff(off) // length))
    first = np.cumsum(many) - many
    x, text = np.zeros(int(many.sum()) * length, np.uint8), np.zeros(int(many.sum()) * length, bool)
    at = ranges(first * length, np.diff(off))
    x[at], text[at] = LOWER[data], True
    return x.reshape(-1, length), text.reshape(-1, length), many


class Model:
    def __init__(self, table: pa.Table, steps: int = STEPS):
        self.names = sorted(set(table.column("lang").to_pylist()))
        self.net = None
        if not self.names:
            return
        data, off = utf8(table.column("text"))
        seen = np.unique(LOWER[data])
        self.kind = np.full(256, OTHER, np.uint8)
        self.kind[seen[: 256 - FIRST]] = FIRST + np.arange(min(len(seen), 256 - FIRST))
        x, text, many = windows(data, off)
        y = np.repeat([self.names.index(v) for v in table.column("lang").to_pylist()], many)
        nth, of = ranges(np.zeros(len(many), np.int64), many), np.repeat(many, many)
        keep = (nth * FIT_WINDOWS) % of < FIT_WINDOWS  # that many, evenly dealt, or all of fewer
        good = keep & ((LETTERS[x] & text).sum(1) >= LEAST_LETTERS)
        keep = good if good.any() else keep
        self.net = Net(FIRST + len(seen), len(self.names))
        self.net.p["e"][:FIRST] = 0
        if len(self.names) > 1:
            self.net.train(self.classes(x, text)[keep].astype(np.int64), y[keep], steps)

    def classes(self, x: np.ndarray, text: np.ndarray) -> np.ndarray:
        return np.where(text, self.kind[x], np.uint8(FILLER))

    def _tables(self):
        """Per width and pair of places: responses to each pair of classes."""
        if not hasattr(self, "_pairs"):
            p = self.net.p
            self._pairs = []
            for i, w in enumerate(WIDTHS):
                t = np.einsum("cd,kdf->kcf", p["e"], p[f"w{i}"])
                pairs = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(-1, FILTERS) for k in range(0, w - 1, 2)]
                self._pairs.append(([np.ascontiguousarray(q, np.float32) for q in pairs], t[w - 1] if w % 2 else None))
        return self._pairs

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        p, pooled = self.net.p, []
        pair = x[:, :-1].astype(np.int32) * len(p["e"]) + x[:, 1:]
        for i, (w, (pairs, odd)) in enumerate(zip(WIDTHS, self._tables())):
            n = x.shape[1] - w + 1
            z = pairs[0].take(pair[:, :n], axis=0)
            for k, q in enumerate(pairs[1:], 1):
                z += q.take(pair[:, 2 * k : 2 * k + n], axis=0)
            if odd is not None:
                z += odd.take(x[:, w - 1 : w - 1 + n], axis=0)
            pooled.append(z.max(1) + p["b"][i])
        logit = np.maximum(np.concatenate(pooled, 1), 0) @ p["v"] + p["c"]
        logit -= logit.max(1, keepdims=True)
        return logit - np.log(np.exp(logit).sum(1, keepdims=True))

    def predict(self, data: np.ndarray, off: np.ndarray, batch: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """(place in names, probability) of each text."""
        raw, text, many = windows(data, off)
        x = self.classes(raw, text)
        logp = np.concatenate([self.log_probabilities(x[i : i + batch]) for i in range(0, len(x), batch)])
        # Windows count by the letters they hold.
        weight = (LETTERS[raw] & text).sum(1).astype(np.float64) + 1e-3
        first = np.cumsum(many) - many
        mean = np.add.reduceat(logp * weight[:, None], first) / np.add.reduceat(weight, first)[:, None]
        e = np.exp(mean - mean.max(1, keepdims=True))
        e /= e.sum(1, keepdims=True)
        return e.argmax(1), e.max(1)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pairs"}


def fit(docs: DataFrame, max_rows: int = MAX_ROWS, modulus: int = 5, held_out: int = 0) -> Model:
    """Learns from the least hashed rows of each language outside the held-out fold.

    Only ids and languages are ranked, and of those only the share by hash that the bound can reach; the
    texts of the chosen rows are fetched by a join whose small side has max_rows rows at most.
    """
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (residue("doc_id", modulus) != held_out))
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return Model(pa.table({"text": pa.array([], pa.string()), "lang": pa.array([], pa.string())}))
    each = max(1, max_rows // len(sizes))
    shares = docs.sparkSession.createDataFrame([(r["lang"], 2.0 * each / r["count"]) for r in sizes], "lang string, share double")
    own = known.select("doc_id", "lang", share_of(F.col("doc_id")).alias("place")).join(F.broadcast(shares), "lang").where("place <= share")
    nth = F.row_number().over(W.partitionBy("lang").orderBy("place", "doc_id"))
    chosen = own.distinct().withColumn("nth", nth).where(F.col("nth") <= each).select("doc_id", "lang", "place")
    rows = known.select("doc_id", "lang", stretches(F.col("text")).alias("text")).join(F.broadcast(chosen), ["doc_id", "lang"])
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"), F.min("place").alias("place"))
    return Model(rows.orderBy("place", "doc_id", "lang").select("text", "lang").toArrow())


def identify(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """docs with the predicted language and its score in columns `names`; columns of docs by these names are replaced."""
    docs = ship(docs).drop(*names)
    column = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 100 kB, whatever the corpus

    def run(batches):
        own = shared.value
        for batch in batches:
            texts = batch.column(column)
            letters = np.array([has_letter(t) for t in texts.to_pylist()], bool)
            found, score = ["und"] * len(letters), np.zeros(len(letters))
            if own.net is not None and letters.any():
                data, off = utf8(texts)
                which, p = own.predict(data, off)
                found = [own.names[k] if ok else "und" for k, ok in zip(which, letters)]
                score = np.where(letters, p, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(score, pa.float64())], names=[*batch.schema.names, *names])

    return docs.mapInArrow(in_pieces(run), docs.select("*").schema.add(names[0], "string").add(names[1], "double"))
