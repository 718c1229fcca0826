"""Document quality by a byte-level convolutional network in numpy.

Bytes are embedded, convolved by learned filters, and max-pooled inside overlapping chunks that cover
the whole document; a hidden layer turns each chunk into features, whose maximum and mean over all
chunks a logistic unit combines into one probability.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, held_out, texts

WIDTH, STRIDE, BLOCK = 8, 2, 64  # bytes of a filter, bytes between positions, positions of half a chunk
SPAN = STRIDE * (2 * BLOCK - 1) + WIDTH  # bytes that one chunk sees
PAD = 256  # the symbol after the end of a short text
DIM, FILTERS, HIDDEN = 6, 24, 16


def _padded(text: bytes) -> np.ndarray:
    x = np.frombuffer(text, np.uint8)
    n = max(len(x), SPAN)
    out = np.full(n + (n - WIDTH) % STRIDE, PAD, np.int16)
    out[: len(x)] = x
    return out


def _starts(n: int) -> list[int]:
    """The first positions of the chunks among n positions; the last chunk ends with the text."""
    blocks = n // BLOCK
    return [BLOCK * j for j in range(blocks - 1)] + ([n - 2 * BLOCK] if n % BLOCK else [])


def _windows(embedded: np.ndarray) -> np.ndarray:
    """(chunks, positions, WIDTH * DIM) of (chunks, bytes, DIM)."""
    c, n, d = embedded.shape
    s = embedded.strides
    return np.lib.stride_tricks.as_strided(embedded, (c, (n - WIDTH) // STRIDE + 1, WIDTH * d), (s[0], STRIDE * s[1], s[2]))


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def of(*shape: int, fan: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(fan)).astype(np.float32)

    return {
        "E": of(257, DIM, fan=1),
        "W": of(WIDTH * DIM, FILTERS, fan=WIDTH * DIM), "b": np.zeros(FILTERS, np.float32),
        "U": of(FILTERS, HIDDEN, fan=FILTERS), "c": np.full(HIDDEN, 0.1, np.float32),
        "v": of(2 * HIDDEN, fan=2 * HIDDEN), "a": np.zeros(1, np.float32),
    }


def _combine(m: dict[str, np.ndarray], pooled: np.ndarray) -> float:
    hidden = np.maximum(pooled @ m["U"] + m["c"], 0)
    z = float(np.concatenate([hidden.max(0), hidden.mean(0)]) @ m["v"] + m["a"][0])
    return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def score(m: dict[str, np.ndarray], text: bytes) -> float:
    """The probability of label 1 for one whole text; memory is bounded by slabs of 64 KB of text."""
    x = _padded(text)
    n = (len(x) - WIDTH) // STRIDE + 1

    def activations(first: int, last: int) -> np.ndarray:
        part = m["E"][x[STRIDE * first : STRIDE * (last - 1) + WIDTH]]
        return _windows(part[None])[0] @ m["W"]

    blocks, slab = [], BLOCK * 512
    for i in range(0, n // BLOCK * BLOCK, slab):
        a = activations(i, min(i + slab, n // BLOCK * BLOCK))
        blocks.append(a.reshape(-1, BLOCK, FILTERS).max(1))
    tops = np.concatenate(blocks)
    pooled = np.maximum(tops[:-1], tops[1:])
    if n % BLOCK:
        pooled = np.concatenate([pooled, activations(n - 2 * BLOCK, n).max(0)[None]])
    return _combine(m, np.maximum(pooled + m["b"], 0))


def train(texts: list[bytes], labels: list[int], epochs: int = 14, batch: int = 32, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on the logistic loss. One class only, or no rows: the constant probability of what was seen (0.5 for none)."""
    rng = np.random.default_rng(seed)
    m = initial(rng)
    y_all = np.asarray(labels, np.float32)
    if len(set(labels)) < 2:
        m["v"][:] = 0
        m["a"][0] = 0 if not len(y_all) else 8 * (2 * y_all[0] - 1)
        return m
    weight = np.where(y_all == 1, 0.5 / max(y_all.mean(), 1e-6), 0.5 / max(1 - y_all.mean(), 1e-6)).astype(np.float32)
    padded = [_padded(t) for t in texts]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(padded))
        for at in range(0, len(order), batch):
            ids = order[at : at + batch]
            starts = [_starts((len(padded[i]) - WIDTH) // STRIDE + 1) for i in ids]
            chunks = np.stack([padded[i][STRIDE * s : STRIDE * s + SPAN] for i, ss in zip(ids, starts) for s in ss])
            sizes = np.array([len(s) for s in starts])
            first, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(ids)), sizes)
            # forward
            a = _windows(m["E"][chunks]) @ m["W"]
            best = a.argmax(1)
            pooled = np.take_along_axis(a, best[:, None], 1)[:, 0] + m["b"]
            p = np.maximum(pooled, 0)
            hidden = np.maximum(p @ m["U"] + m["c"], 0)
            top, mean = np.maximum.reduceat(hidden, first), np.add.reduceat(hidden, first) / sizes[:, None]
            both = np.concatenate([top, mean], 1)
            out = 1 / (1 + np.exp(-np.clip(both @ m["v"] + m["a"], -60, 60)))
            # backward
            dz = (out - y_all[ids]) * weight[ids] / len(ids)
            g = {"v": both.T @ dz + 1e-4 * m["v"], "a": np.array([dz.sum()], np.float32)}
            dboth = dz[:, None] * m["v"]
            dh = (dboth[:, HIDDEN:] / sizes[:, None])[owner]
            is_top = hidden == top[owner]
            is_top &= np.cumsum(is_top, 0) - (np.cumsum(is_top, 0) - is_top)[first][owner] == 1  # the first maximum of a text only
            dh = (dh + is_top * dboth[:, :HIDDEN][owner]) * (hidden > 0)
            g["U"], g["c"] = p.T @ dh, dh.sum(0)
            dp = (dh @ m["U"].T) * (pooled > 0)
            g["b"] = dp.sum(0)
            seen = chunks[np.arange(len(chunks))[:, None, None], STRIDE * best[:, :, None] + np.arange(WIDTH)]  # chunk, filter, byte
            g["W"] = np.einsum("cf,cfk->kf", dp, m["E"][seen].reshape(len(chunks), FILTERS, -1))
            de = (dp[:, :, None] * m["W"].T).reshape(-1, DIM)
            flat = seen.reshape(-1)
            g["E"] = np.stack([np.bincount(flat, de[:, d], 257) for d in range(DIM)], 1).astype(np.float32)
            step += 1
            for k in m:
                m1, m2 = moments[k]
                m1 += 0.1 * (g[k] - m1)
                m2 += 0.001 * (g[k] ** 2 - m2)
                m[k] -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return m


def dumps(m: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **m)
    return out.getvalue()


def loads(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as z:
        return {k: z[k] for k in z.files}


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r["doc_id"], r["y"], r["text"].encode()) for b in batches for r in b.to_pylist())
    yield pa.RecordBatch.from_pydict({"model": [dumps(train([r[2] for r in rows], [r[1] for r in rows]))]})


def sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, max_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y): at most per_class labelled rows of either class outside the held-out fold.

    Which rows: the least by a hash of doc_id, so the choice is the same on every run. Rows without an
    id or label, and ids with contradicting labels, are left out; of repeated ids the text with the least hash is taken. The
    bound is per_class rows of at most max_bytes bytes each; longer rows are scored, but not learned from.
    """
    y = labels.where(labels[id_col].isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).cast("int").alias("y"), F.max(label_col).alias("most")).where("y in (0, 1) and y = most")
    y = y.where(~held_out(F.col("doc_id"))).select("doc_id", "y")
    fits = texts(docs, id_col, text_col).where(F.octet_length("text") <= max_bytes)
    ids = fits.select("doc_id").join(y, "doc_id").distinct()
    drawn = [ids.where(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    # at most 2 * per_class ids: small enough to broadcast by that bound
    return fits.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = 900, max_bytes: int = 12_000, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A model learned from the bounded sample, in one task; only the model comes to the driver."""
    bounded_batches(docs.sparkSession)
    rows = sample(docs, labels, label_col, per_class, max_bytes, id_col, text_col)
    fitted = rows.coalesce(1).mapInArrow(_fit, "model binary").first()
    return bytes(fitted["model"]) if fitted else dumps(train([], []))


def scored(docs: DataFrame, model: bytes, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with score_col, the probability of label 1 of every whole text; null texts score as empty ones.

    A column named score_col is replaced. Repeated rows get equal scores, an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    loaded: dict[str, np.ndarray] = {}

    @F.arrow_udf("double")
    def of(text: pa.Array) -> pa.Array:
        loaded or loaded.update(loads(model))
        return pa.array((score(loaded, t or b"") for t in text.cast(pa.binary()).to_pylist()), pa.float64())

    return docs.withColumn(score_col, of(docs[text_col]))
