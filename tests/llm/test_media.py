"""Audio: exact round trips, and features against plain loops."""

import hashlib
import zlib

import numpy as np

from tests.llm.conftest import SF
from tidemark.llm import audio, queries


def test_wav_round_trip():
    for raw in (b"", b"\x00", bytes(range(256))):
        assert audio.samples_of(audio.wav(raw)) == (raw, audio.RATE)


def test_resampling_keeps_a_tone():
    t = np.arange(8000) / 8000
    y = audio.resample(np.sin(2 * np.pi * 440 * t).astype(np.float32), 3, 4)
    want = np.sin(2 * np.pi * 440 * np.arange(6000) / 6000)
    assert len(y) == 6000 and np.abs(y - want)[50:-50].max() < 0.02


def test_spans_need_the_lower_threshold_to_end():
    e = np.array([0, 0, 5, 9, 5, 5, 0, 5, 9, 0], float)
    assert audio.spans(e, 0.8, 0.3) == [(3, 6), (8, 9)]


def test_even_energy_has_no_span():
    assert audio.spans(np.full(50, 3.0)) == [] and audio.features(audio.wav(b"\x80" * 80000))[0] == []


def plain_features(raw):
    """Start times and tensors by loops over output samples, frames and bands."""
    x = [(b - 128) / 128 for b in raw]
    up, down, half = 3, 4, audio.TAPS // 2
    taps = np.arange(-audio.TAPS * up // 2, audio.TAPS * up // 2)
    h = np.sinc(taps / down) * np.hanning(len(taps) + 1)[:-1]
    y = []
    for k in range(-(-len(x) * up // down)):
        phase, first = k * down % up, k * down // up
        w = [h[(audio.TAPS - 1 - i) * up + phase] for i in range(audio.TAPS)]
        seen = [x[min(max(first + i - (half - 1), 0), len(x) - 1)] for i in range(audio.TAPS)]
        y.append(sum(a * b for a, b in zip(w, seen)) / sum(w))
    count = 1 + max(0, -(-(len(y) - audio.FRAME) // audio.HOP))
    y += [0] * (audio.FRAME + (count - 1) * audio.HOP - len(y))
    mel = []
    for i in range(count):
        frame = np.array(y[i * audio.HOP : i * audio.HOP + audio.FRAME]) * np.hanning(audio.FRAME)
        power = [abs(sum(v * np.exp(-2j * np.pi * f * n / audio.FFT) for n, v in enumerate(frame))) ** 2 for f in range(audio.FFT // 2 + 1)]
        mel.append([10 * np.log10(max(sum(p * b for p, b in zip(power, audio._BANK[:, m])), 1e-8)) for m in range(audio.MELS)])
    return np.array(mel)


def test_features_by_loops():
    rng = np.random.default_rng(9)
    raw = rng.integers(100, 156, 2000).astype(np.uint8).tobytes()
    want = plain_features(raw)
    x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    got = audio.log_mel(audio.resample(x, 3, 4))
    assert got.shape == want.shape and np.abs(got - want).max() < 0.05
    starts, ends, clips = audio.features(audio.wav(raw))
    spans = audio.spans(want.mean(1))
    assert starts == [a * 10 for a, _ in spans] and ends == [((b - 1) * audio.HOP + audio.FRAME) * 1000 // audio.TARGET for _, b in spans]
    for (a, b), t in zip(spans, audio.tensors(clips)["log_mel"].combine_chunks().to_numpy_ndarray()):
        units = np.clip((want[a:b] - audio.FLOOR_DB) / audio.STEP_DB, 0, 255)
        assert np.abs(t[: b - a] - units).max() <= 0.61 and not t[b - a :].any()


def test_tensors_have_one_shape():
    rng = np.random.default_rng(2)
    media = audio.wav(np.repeat(rng.integers(0, 256, 40), 2000).astype(np.uint8).tobytes() + rng.integers(0, 256, 50000).astype(np.uint8).tobytes())
    starts, ends, clips = audio.features(media)
    t = audio.tensors(clips)
    assert starts and t.num_rows == len(starts) and t["start_ms"].to_pylist() == starts and t["end_ms"].to_pylist() == ends
    assert t.schema.field("log_mel").type.shape == [audio.CLIP, audio.MELS]
    assert all(a < b for a, b in zip(starts, ends))
    assert audio.features(audio.wav(b""))[:2] == ([], [])


def test_long_recordings_are_the_same_in_slabs(monkeypatch):
    x = np.random.default_rng(4).standard_normal(30000).astype(np.float32)
    whole = audio.log_mel(x)
    monkeypatch.setattr(audio, "SLAB", 7)
    assert np.allclose(audio.log_mel(x), whole, atol=1e-3)


def test_audio_query(spark, documents):
    got = {r.doc_id: r for r in queries.op3_audio(spark, SF).collect()}
    features = {}
    for doc_id, text in documents.select("doc_id", "text").collect():
        raw, r = (text or "").encode(), got.pop(doc_id)
        payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        media = audio.wav(payload)
        assert (r.n_bytes, r.payload_bytes, r.media_bytes) == (len(raw), len(payload), len(media))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.media_sha256 == hashlib.sha256(media).hexdigest()
        assert r.tail_crc32 == zlib.crc32(payload[-16:])
        assert features.setdefault(text, r.feature) == r.feature
    assert not got


def test_null_and_empty_recordings(spark):
    df = spark.createDataFrame([(1, None, "m"), (2, bytearray(), "m"), (2, bytearray(), "m")], "id int, payload binary, media string")
    got = audio.with_features(audio.store(df)).select("id", "features.starts", "features.payload").collect()
    assert sorted(r.id for r in got) == [1, 2, 2] and all(r.starts == [] and r.payload == b"" for r in got)
    assert audio.with_features(audio.store(df.where("false"))).count() == 0
