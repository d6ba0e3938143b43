"""Media columns: bytes as 8-bit audio, and audio features as fixed-shape tensors.

`encode` stores a text's bytes as an 8-bit mono WAV file in a binary column;
`features` reads the file back, resamples it by 2/3 with a polyphase filter, takes
log-mel energies of overlapped frames and cuts the signal into loud segments by
energy with hysteresis.  Features come as blocks of FRAMES x MELS half floats,
the last one filled with zeros, each with its time span; `tensor_table` hands them
to Arrow as a fixed-shape tensor column.  Each text is computed by itself, so equal
texts have equal features whatever stands beside them.

Defined results: null text is empty, which is one unit of padding; texts of any
length are whole; repeated rows are kept; other columns of documents are left out,
those of a media table stay unless they are named like a result; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrays import in_pieces
from .storage import ship

UNIT, FILL, RATE = 576, 255, 8000
UP, DOWN, TAPS = 2, 3, 16
FRAME, HOP, MELS, FRAMES = 256, 128, 20, 32
OUT_RATE = RATE * UP / DOWN
#: Loud begins above the median energy by so many decibels and ends below it by so many.
ENTER_DB, LEAVE_DB = 1.0, -1.0


def pad(data: bytes) -> bytes:
    return data + bytes([FILL]) * (-len(data) % UNIT if data else UNIT)


def to_wav(samples: bytes) -> bytes:
    """8-bit unsigned mono PCM in a RIFF file; samples are an even number of bytes."""
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(fmt) + 8 + len(samples), b"WAVE") + fmt + struct.pack("<4sI", b"data", len(samples)) + samples


def from_wav(media: bytes) -> tuple[int, bytes]:
    """(sample rate, samples)."""
    kind, size, form = struct.unpack_from("<4sI4s", media)
    if kind != b"RIFF" or form != b"WAVE" or size + 8 != len(media):
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        kind, size = struct.unpack_from("<4sI", media, at)
        if kind == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (code, channels, bits) != (1, 1, 8):
                raise ValueError("8-bit mono PCM is read here")
        elif kind == b"data":
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAV file without data")


def _polyphase() -> np.ndarray:
    """(TAPS, UP): the filter's phases, for inputs from TAPS / 2 - 1 before the output's place on."""
    out = np.zeros((TAPS, UP))
    for phase in range(UP):
        t = np.arange(TAPS) - (TAPS // 2 - 1) - phase * DOWN / UP
        h = np.sinc(t * UP / DOWN) * np.cos(np.clip(t / (TAPS / 2), -1, 1) * np.pi / 2) ** 2
        out[:, phase] = h / h.sum()
    return out.astype(np.float32)


def _mel_bank() -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(40), mel(OUT_RATE / 2), MELS + 2) / 2595) - 1)
    f = np.arange(FRAME // 2 + 1) * OUT_RATE / FRAME
    rise, fall = (f[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


PHASES, BANK, HANN = _polyphase(), _mel_bank(), np.hanning(FRAME).astype(np.float32)


def resample(samples: bytes) -> np.ndarray:
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    x = np.concatenate([np.zeros(TAPS // 2 - 1, np.float32), x, np.zeros(TAPS, np.float32)])
    n = len(samples) // DOWN
    return (np.lib.stride_tricks.as_strided(x, (n, TAPS), (x.strides[0] * DOWN, x.strides[0])) @ PHASES).ravel()


def log_mel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames x MELS log energies, decibels a frame)."""
    n = (len(y) - FRAME) // HOP + 1
    mel, loud = np.empty((n, MELS), np.float32), np.empty(n, np.float32)
    for i in range(0, n, 4096):
        k = min(4096, n - i)
        frames = np.lib.stride_tricks.as_strided(y[i * HOP :], (k, FRAME), (y.strides[0] * HOP, y.strides[0]))
        power = np.abs(np.fft.rfft(frames * HANN, axis=1)) ** 2
        mel[i : i + k] = np.log(power.astype(np.float32) @ BANK + 1e-6)
        loud[i : i + k] = 10 * np.log10((frames * frames).mean(1) + 1e-9)
    return mel, loud


def segments(loud: np.ndarray) -> list[tuple[int, int]]:
    """Frame ranges that begin above the upper threshold and end below the lower one."""
    middle = float(np.median(loud))
    mark = np.where(loud > middle + ENTER_DB, 1, np.where(loud < middle + LEAVE_DB, -1, 0))
    last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
    on = np.where(last < 0, False, mark[np.maximum(last, 0)] > 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def encode(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) of each document."""

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            media = pa.array([to_wav(pad(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), media], names=["doc_id", "n_bytes", "media"])

    return ship(docs).select("doc_id", "text").mapInArrow(in_pieces(run), docs.select("doc_id").schema.add("n_bytes", "long").add("media", "binary"))


TENSOR = pa.struct([("start_s", pa.float64()), ("end_s", pa.float64()), ("values", pa.binary())])
SPAN = pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())])
ADDED = "payload_bytes long, payload_sha256 string, tail_crc32 long, tensors array<struct<start_s:double,end_s:double,values:binary>>, segments array<struct<start_s:double,end_s:double>>"


def features(media: DataFrame) -> DataFrame:
    """A media column's rows with what was read from each file: the payload's digests, feature tensors and loud segments; columns by these names are replaced."""
    media = media.drop(*(f.name for f in StructType.fromDDL(ADDED).fields))
    at = media.columns.index("media")
    schema = StructType([*media.schema.fields, *StructType.fromDDL(ADDED).fields])

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(5)]
            for file in batch.column(at).to_pylist():
                _, samples = from_wav(file)
                mel, loud = log_mel(resample(samples))
                blocks = np.zeros((-(-len(mel) // FRAMES) * FRAMES, MELS), np.float16)
                blocks[: len(mel)] = mel
                second = HOP / OUT_RATE
                cols[0].append(len(samples))
                cols[1].append(hashlib.sha256(samples).hexdigest())
                cols[2].append(zlib.crc32(samples[-32:]))
                cols[3].append([{"start_s": k * second, "end_s": (min(k + FRAMES, len(mel)) - 1) * second + FRAME / OUT_RATE, "values": blocks[k : k + FRAMES].tobytes()} for k in range(0, len(mel), FRAMES)])
                cols[4].append([{"start_s": a * second, "end_s": (b - 1) * second + FRAME / OUT_RATE} for a, b in segments(loud)])
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(TENSOR), pa.list_(SPAN)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(cols, kinds))], names=schema.names)

    return media.mapInArrow(in_pieces(run), schema)


def feature_digest(tensors, spans):
    """Blocks, their shape, loud segments and a digest of the feature values, as one string column."""
    values = F.sha2(F.concat_ws("", F.transform(tensors, lambda t: F.hex(t["values"]))), 256)
    return F.concat_ws(":", F.size(tensors).cast("string"), F.lit(f"{FRAMES}x{MELS}"), F.size(spans).cast("string"), values)


def tensor_table(rows: pa.Table) -> pa.Table:
    """Collected `tensors` as an Arrow table with a fixed-shape tensor column: (row, start_s, end_s, values)."""
    flat = [(i, t["start_s"], t["end_s"], t["values"]) for i, ts in enumerate(rows.column("tensors").to_pylist()) for t in ts]
    values = np.frombuffer(b"".join(x[3] for x in flat), np.float16).reshape(-1, FRAMES, MELS)
    own = pa.FixedShapeTensorArray.from_numpy_ndarray(values) if len(flat) else pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(pa.float16(), [FRAMES, MELS]), pa.array([], pa.list_(pa.float16(), FRAMES * MELS)))
    return pa.table({"row": pa.array([x[0] for x in flat], pa.int64()), "start_s": pa.array([x[1] for x in flat], pa.float64()), "end_s": pa.array([x[2] for x in flat], pa.float64()), "values": own})
