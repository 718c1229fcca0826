"""Audio columns: 8-bit samples stored as WAV, and log-mel features of their active spans.

A recording is resampled by a polyphase filter, cut into overlapping frames, and turned into log-mel
energies; spans in which the energy rises over one threshold and has not yet fallen below a lower one
are kept, and stored as fixed-shape Arrow tensors with their start and end times.
"""

from __future__ import annotations

import io
import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, new_path

RATE, TARGET = 8000, 6000  # samples a second as stored, and after resampling
TAPS = 16  # filter taps of one phase
FRAME, HOP, FFT = 150, 60, 256  # samples: 25 ms every 10 ms
MELS, CLIP = 32, 96  # bands, and frames of a tensor
STEP_DB, FLOOR_DB = 0.5, -80.0  # one unit of a stored value, and the value of 0
SLAB = 1 << 14  # frames that are in memory at once
_WAV = struct.Struct("<4sI4s4sIHHIIHH4sI")


def wav(samples: bytes, rate: int = RATE) -> bytes:
    """Unsigned 8-bit mono samples, unchanged, behind the header of a WAV file."""
    pad = b"\0" * (len(samples) % 2)
    head = _WAV.pack(b"RIFF", 36 + len(samples) + len(pad), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples))
    return head + samples + pad


def samples_of(media: bytes) -> tuple[bytes, int]:
    """The samples and their rate, read from the chunks of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("8-bit mono PCM is read only")
        if name == b"data":
            return media[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def resample(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """x at up / down of its rate: each output sample is one phase of a windowed sinc over TAPS inputs."""
    if up == down or not len(x):
        return x
    taps = np.arange(-TAPS * up // 2, TAPS * up // 2)
    band = 1 / max(up, down)
    prototype = (np.sinc(taps * band) * np.hanning(len(taps) + 1)[:-1] * band * up).astype(np.float32)
    phases = prototype.reshape(TAPS, up).T[:, ::-1]
    phases = phases / phases.sum(1, keepdims=True)
    n = -(-len(x) * up // down)
    padded = np.concatenate([np.repeat(x[:1], TAPS // 2 - 1), x, np.repeat(x[-1:], TAPS)])
    seen = np.lib.stride_tricks.sliding_window_view(padded, TAPS)
    out = np.empty(n, np.float32)
    for k in range(up):  # outputs k, k + up, ... share a phase; their inputs lie down samples apart
        first = k * down
        count = len(out[k::up])
        out[k::up] = seen[first // up :: down][:count] @ phases[first % up]
    return out


def _filterbank(rate: int) -> np.ndarray:
    """(FFT // 2 + 1, MELS) triangles, evenly spaced in mel."""
    top = 2595 * math.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, MELS + 2) / 2595) - 1)
    f = np.arange(FFT // 2 + 1)[:, None] * rate / FFT
    low, mid, high = edges[:-2], edges[1:-1], edges[2:]
    return np.maximum(0, np.minimum((f - low) / (mid - low), (high - f) / (high - mid))).astype(np.float32)


_BANK = _filterbank(TARGET)
_WINDOW = np.hanning(FRAME).astype(np.float32)


def log_mel(x: np.ndarray) -> np.ndarray:
    """(frames, MELS) in dB; the end is filled up with silence, so that every sample is in a frame."""
    x = np.pad(x, (0, FRAME - len(x) if len(x) < FRAME else -(len(x) - FRAME) % HOP))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    out = []
    for i in range(0, len(frames), SLAB):
        power = np.abs(np.fft.rfft(frames[i : i + SLAB] * _WINDOW, FFT)) ** 2
        out.append(10 * np.log10(np.maximum(power.astype(np.float32) @ _BANK, 1e-8)))
    return np.concatenate(out)


def spans(energy: np.ndarray, high: float = 0.6, low: float = 0.3) -> list[tuple[int, int]]:
    """(first, end) frames of the active spans: on from the quantile high, off at the quantile low. Even energy has none."""
    on, off = np.quantile(energy, high), np.quantile(energy, low)
    if on <= off:
        return []
    event = np.where(energy >= on, 1, np.where(energy <= off, -1, 0))
    last = np.maximum.accumulate(np.where(event != 0, np.arange(len(event)), -1))
    active = (last >= 0) & (event[last] == 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], active.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_TENSOR = pa.fixed_shape_tensor(pa.uint8(), [CLIP, MELS])
_CLIPS = pa.schema([("start_ms", pa.int64()), ("end_ms", pa.int64()), ("log_mel", _TENSOR)])


def features(media: bytes) -> tuple[list[int], list[int], bytes]:
    """Start and end milliseconds of the clips, and an Arrow stream of (start_ms, end_ms, log_mel).

    Each active span is cut into clips of CLIP frames; the last one is filled up with zeros. A recording
    without samples has no clips.
    """
    raw, rate = samples_of(media)
    starts, ends, tensors = [], [], []
    if raw:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
        g = math.gcd(TARGET, rate)
        mel = log_mel(resample(x, TARGET // g, rate // g))
        units = np.clip(np.rint((mel - FLOOR_DB) / STEP_DB), 0, 255).astype(np.uint8)
        for first, end in spans(mel.mean(1)):
            for i in range(first, end, CLIP):
                clip = units[i : min(i + CLIP, end)]
                starts.append(i * HOP * 1000 // TARGET)
                ends.append(((i + len(clip) - 1) * HOP + FRAME) * 1000 // TARGET)
                tensors.append(np.pad(clip, ((0, CLIP - len(clip)), (0, 0))))
    flat = np.concatenate(tensors).reshape(-1) if tensors else np.empty(0, np.uint8)
    column = pa.ExtensionArray.from_storage(_TENSOR, pa.FixedSizeListArray.from_arrays(pa.array(flat), CLIP * MELS))
    out = io.BytesIO()
    with pa.ipc.new_stream(out, _CLIPS) as w:
        w.write_batch(pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), column], schema=_CLIPS))
    return starts, ends, out.getvalue()


def tensors(clips: bytes) -> pa.Table:
    """(start_ms, end_ms, log_mel) of one recording, log_mel a fixed-shape tensor."""
    with pa.ipc.open_stream(clips) as r:
        return r.read_all()


def store(payloads: DataFrame, payload_col: str = "payload", media_col: str = "media", path: str | None = None) -> DataFrame:
    """payloads with media_col in place of payload_col, the samples as a WAV file, written and read back.

    A null payload is stored as a recording without samples. A column named media_col is replaced; an
    empty table stays empty.
    """
    spark = payloads.sparkSession
    bounded_batches(spark)
    path = path or new_path(spark, "media")

    @F.arrow_udf("binary")
    def as_wav(payload: pa.Array) -> pa.Array:
        return pa.array((wav(p or b"") for p in payload.to_pylist()), pa.binary())

    kept = [payloads[c] for c in payloads.columns if c not in (payload_col, media_col)]
    made = payloads.select(*kept, as_wav(payloads[payload_col]).alias(media_col))
    made.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return spark.read.schema(made.schema).parquet(path)


FEATURES = "struct<payload:binary,starts:array<long>,ends:array<long>,clips:binary>"


def with_features(stored_media: DataFrame, media_col: str = "media", features_col: str = "features") -> DataFrame:
    """stored_media with features_col: the samples as read, clip times, and the clips as Arrow tensors.

    Equal recordings have equal features; a null recording has null ones. A column named features_col
    is replaced.
    """
    bounded_batches(stored_media.sparkSession)

    @F.arrow_udf(FEATURES)
    def of(media: pa.Array) -> pa.Array:
        rows = []
        for m in media.to_pylist():
            if m is None:
                rows.append(None)
                continue
            starts, ends, clips = features(m)
            rows.append({"payload": samples_of(m)[0], "starts": starts, "ends": ends, "clips": clips})
        return pa.array(rows, pa.struct([("payload", pa.binary()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("clips", pa.binary())]))

    return stored_media.withColumn(features_col, of(stored_media[media_col]))
