"""Operator 1, audio features: 8-bit media columns, polyphase resampling, log-mel filterbanks, energy segmentation.

A media value is a mono 8-bit PCM WAV. Its features are fixed-shape Arrow tensors of log-mel frames, each with its time
span, serialised as an Arrow record batch of TENSOR_SCHEMA, and the time spans of the loud segments.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import chunks, claim
from corpusloom.shipping import ship

RATE = 16_000
#: Resampling by UP / DOWN: 16 kHz to 6.4 kHz.
UP, DOWN, TAPS = 2, 5, 40
#: 25 ms windows every 10 ms at the new rate.
FRAME, HOP, FFT, MELS = 160, 64, 256, 32
#: Frames of one stored tensor.
TENSOR = 64
UNIT = 192
#: Loud begins RISE dB above the median energy and lasts until it is under FALL dB above it.
RISE, FALL = 3.0, 1.0
TENSOR_SCHEMA = pa.schema(
    [("start_s", pa.float64()), ("end_s", pa.float64()), ("log_mel", pa.fixed_shape_tensor(pa.float16(), [TENSOR, MELS]))]
)
_SCHEMA = (
    "doc_id long, n_bytes long, media binary, payload_bytes long, payload_sha256 string, tail_crc32 long,"
    " n_frames long, tensors binary, segments array<struct<start_s:double,end_s:double>>"
)


def pack_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A canonical WAV with `payload` as unsigned 8-bit samples."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload


def unpack_wav(media: bytes) -> bytes:
    """The samples of an 8-bit WAV, from its data chunk."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV")
    at = 12
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAV without data")


@lru_cache
def _phases() -> np.ndarray:
    """The low-pass filter's polyphase branches, UP rows of TAPS / UP taps."""
    at = np.arange(TAPS) - (TAPS - 1) / 2
    cut = 1.0 / max(UP, DOWN)
    taps = np.sinc(at * cut) * cut * UP * np.hamming(TAPS)
    taps *= UP / taps.sum()
    return taps.reshape(-1, UP).T[:, ::-1].astype(np.float32)


def resample(samples: np.ndarray) -> np.ndarray:
    """Polyphase resampling by UP / DOWN: each output sample takes only the branch of its phase."""
    branches, n = _phases(), -(-len(samples) * UP // DOWN)
    width = branches.shape[1]
    padded = np.concatenate([np.zeros(width - 1, np.float32), samples, np.zeros(DOWN + width, np.float32)])
    out = np.zeros(n, np.float32)
    for first in range(UP):
        count = -(-(n - first) // UP)
        start, taps = first * DOWN // UP, branches[first * DOWN % UP]
        part = np.zeros(count, np.float32)
        for k in range(width):
            part += taps[k] * padded[start + k : start + k + DOWN * count : DOWN][:count]
        out[first::UP] = part
    return out


@lru_cache
def _mel_bank() -> np.ndarray:
    """Triangular filters, evenly spaced in mel, FFT bins by MELS."""
    top = RATE * UP / DOWN / 2
    mel = np.linspace(0, 2595 * np.log10(1 + top / 700), MELS + 2)
    edges = 700 * (10 ** (mel / 2595) - 1)
    hz = np.linspace(0, top, FFT // 2 + 1)[:, None]
    up = (hz - edges[:-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[2:] - hz) / (edges[2:] - edges[1:-1])
    return np.clip(np.minimum(up, down), 0, None).astype(np.float32)


def log_mel(signal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapped log-mel frames (n, MELS) and each frame's energy in dB; the signal is padded so that the last
    frame covers its end."""
    missing = FRAME - len(signal) if len(signal) < FRAME else -(len(signal) - FRAME) % HOP
    signal = np.concatenate([signal, np.zeros(missing, np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP]
    window, mels, energies = np.hanning(FRAME).astype(np.float32), [], []
    for start in range(0, len(frames), 2048):
        block = frames[start : start + 2048] * window
        spectrum = np.fft.rfft(block, FFT, axis=1)
        power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
        mels.append(np.log10(power @ _mel_bank() + 1e-6))
        energies.append(10 * np.log10((block * block).sum(axis=1) + 1e-9))
    return np.concatenate(mels), np.concatenate(energies)


def loud_segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frame spans [start, end) found with hysteresis: between the thresholds, a frame keeps the state before it."""
    middle = float(np.median(energy))
    sure = np.where(energy >= middle + RISE, 1, np.where(energy < middle + FALL, 0, -1))
    last = np.maximum.accumulate(np.where(sure >= 0, np.arange(len(sure)), -1))
    state = np.where(last >= 0, sure[np.maximum(last, 0)], 0)
    steps = np.flatnonzero(np.diff(np.concatenate([[0], state, [0]])))
    return [(int(a), int(b)) for a, b in zip(steps[::2], steps[1::2], strict=True)]


def features(payload: bytes) -> tuple[int, bytes, list[dict]]:
    """Number of frames, the tensors as a serialised record batch of TENSOR_SCHEMA, and the loud segments in seconds."""
    samples = (np.frombuffer(payload, np.uint8).astype(np.float32) - 128) / 128
    mel, energy = log_mel(resample(samples))
    count, step, frame = -(-len(mel) // TENSOR), HOP * DOWN / UP / RATE, FRAME * DOWN / UP / RATE
    padded = np.full((count * TENSOR, MELS), -6, np.float16)
    padded[: len(mel)] = mel
    ends = [min((k + 1) * TENSOR, len(mel)) for k in range(count)]
    batch = pa.record_batch(
        [
            pa.array([k * TENSOR * step for k in range(count)], pa.float64()),
            pa.array([(e - 1) * step + frame for e in ends], pa.float64()),
            pa.ExtensionArray.from_storage(TENSOR_SCHEMA.field("log_mel").type, pa.FixedSizeListArray.from_arrays(pa.array(padded.ravel()), TENSOR * MELS)),
        ],
        schema=TENSOR_SCHEMA,
    )
    spans = [{"start_s": a * step, "end_s": (b - 1) * step + frame} for a, b in loud_segments(energy)]
    return len(mel), batch.serialize().to_pybytes(), spans


def read_tensors(serialised: bytes) -> pa.RecordBatch:
    """The tensors and time spans of one media value."""
    return pa.ipc.read_record_batch(pa.py_buffer(serialised), TENSOR_SCHEMA)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("media")
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    for batch in chunks(batches, "text", 4_000_000):
        columns: dict[str, list] = {n: [] for n in ("n_bytes", "media", "payload_bytes", "payload_sha256", "tail_crc32", "n_frames", "tensors", "segments")}
        for text in batch.column("text"):
            data = (text.as_py() or "").encode()
            media = pack_wav(data.ljust(max(UNIT, -(-len(data) // UNIT) * UNIT), b" "))
            payload = unpack_wav(media)
            frames, tensors, segments = features(payload)
            row = (len(data), media, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), frames, tensors, segments)
            for values, value in zip(columns.values(), row, strict=True):
                values.append(value)
        kinds = {"media": pa.binary(), "tensors": pa.binary(), "payload_sha256": pa.string(), "segments": pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))}
        arrays = [batch.column("doc_id").cast(pa.int64()), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items())]
        yield pa.record_batch(arrays, names=["doc_id", *columns]).select(names)


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, the media value, what was read back from it, its tensors and loud segments.

    A null or empty text gives one unit of 192 blanks; a text of any length is taken whole, a document at a time. Repeated
    rows give repeated rows with equal values, an empty table an empty one; other columns of docs are not read.
    """
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_rows, _SCHEMA)
