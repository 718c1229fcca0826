"""Toxicity by a classifier chain over hashed word features.

Each category has a linear model. Categories are predicted one after the other, and the probabilities
of the earlier ones are features of the later ones; in training those are out-of-fold predictions, so
a later model sees earlier probabilities as they will be on unseen rows.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, held_out, texts

BUCKETS = 1 << 22  # hashed features
KEPT = 3000  # features of a category's model
CACHED = 300_000  # words whose features a worker remembers
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of one lower-case token: its core, the core's beginnings, and the token's end."""
    core = word.strip(EDGES)
    named = {"w" + core, "p4" + core[:4], "p5" + core[:5], "s2" + word[-2:]} if core else {"t" + word[:4]}
    return tuple(zlib.crc32(f.encode()) % BUCKETS for f in named)


def _features(text: str) -> set[int]:
    return {f for w in set(text.lower().split()) for f in word_features(w)}


def _logistic(x: list[np.ndarray], dense: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Weights of n sparse 0/1 features, of the dense ones and of the constant 1, by full-batch Adam with L2."""
    rows = np.repeat(np.arange(len(x)), [len(r) for r in x])
    cols = np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64)
    k = dense.shape[1]
    w, m1, m2 = np.zeros(n + k + 1), np.zeros(n + k + 1), np.zeros(n + k + 1)
    each = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)) / len(y)
    for step in range(1, 201):
        z = np.bincount(rows, w[cols], len(x)) + dense @ w[n : n + k] + w[-1]
        d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * each
        g = np.concatenate([np.bincount(cols, d[rows], n), dense.T @ d, [d.sum()]])
        g[:-1] += 1e-4 * w[:-1]
        m1 += 0.1 * (g - m1)
        m2 += 0.01 * (g * g - m2)
        w -= 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)
    return w


def _fit_one(x: list[set[int]], dense: np.ndarray, y: np.ndarray) -> dict:
    """A category's model: features that tell the classes apart by a two-proportion z, then their weights."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return {"features": {}, "dense": [0.0] * dense.shape[1], "bias": 0.0 if not len(y) else (-8.0 if n0 else 8.0)}
    c1, c0 = Counter(f for r, t in zip(x, y) if t for f in r), Counter(f for r, t in zip(x, y) if not t for f in r)
    z = {}
    for f in c1.keys() | c0.keys():
        a, b = c1[f], c0[f]
        p = (a + b) / (n1 + n0)
        if a + b >= 3 and p < 1 and abs(s := (a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))) > 3:
            z[f] = abs(s)
    kept = sorted(z, key=lambda f: (-z[f], f))[:KEPT]
    at = {f: i for i, f in enumerate(kept)}
    w = _logistic([np.array([at[f] for f in r if f in at], np.int64) for r in x], dense, y, len(kept))
    return {"features": dict(zip(kept, w[: len(kept)])), "dense": list(w[len(kept) : -1]), "bias": float(w[-1])}


def _logit(model: dict, features: set[int], dense: Sequence[float]) -> float:
    w = model["features"]
    return float(np.clip(sum(w[f] for f in features if f in w) + float(np.dot(model["dense"], dense)) + model["bias"], -30, 30))


def _probability(logit: float) -> float:
    return float(1 / (1 + np.exp(-logit)))


def train(docs: list[str], labels: np.ndarray, folds: int = 5) -> list[dict]:
    """One model for each column of labels, in order. labels: 0 or 1; no rows give models that answer 0.5."""
    x = [_features(t) for t in docs]
    fold = np.arange(len(x)) % folds
    dense, chain = np.zeros((len(x), 0)), []
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        chain.append(_fit_one(x, dense, y))
        if k + 1 < labels.shape[1]:
            out = np.zeros(len(x))
            for j in range(folds):
                use = np.flatnonzero(fold != j)
                part = _fit_one([x[i] for i in use], dense[use], y[use])
                for i in np.flatnonzero(fold == j):
                    out[i] = _probability(_logit(part, x[i], dense[i]))
            dense = np.column_stack([dense, out])
    return chain


class Scorer:
    """Scores texts; remembers which kept features a word has, for a bounded number of words."""

    def __init__(self, chain: list[dict]):
        self.chain = [m | {"features": {int(f): w for f, w in m["features"].items()}} for m in chain]
        self.used = set().union(*(m["features"] for m in self.chain))
        self.words: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            found = tuple(f for f in word_features(word) if f in self.used)
            if len(self.words) < CACHED:
                self.words[word] = found
        return found

    def __call__(self, text: str) -> list[float]:
        features: set[int] = set()
        for found in map(self._of, set(text.lower().split())):
            if found:
                features.update(found)
        dense: list[float] = []
        for m in self.chain:
            dense.append(_probability(_logit(m, features, dense)))
        return dense


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("low_quality", "toxic"), max_rows: int = 2500, max_bytes: int = 40_000, id_col: str = "doc_id", text_col: str = "text") -> str:
    """A chain learned from a bounded sample: at most max_rows rows for each combination of the categories.

    labels has a 0/1 column for each category, in the order of the chain. Held-out documents, rows
    without id or with a null label, and texts of over max_bytes bytes are not learned from; of an id's
    repeated labels the largest counts, and of its texts the one with the least hash. The sample is chosen by a hash of doc_id and meets in one task.
    """
    bounded_batches(docs.sparkSession)
    cats = list(categories)
    whole = labels.dropna(subset=[id_col, *cats]).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(*(F.max(c).cast("int").alias(f"y{i}") for i, c in enumerate(cats)))
    fits = texts(docs, id_col, text_col).where(F.octet_length("text") <= max_bytes)
    ys = [f"y{i}" for i in range(len(cats))]
    ids = fits.select("doc_id").join(whole.where(~held_out(F.col("doc_id"))), "doc_id").distinct()
    drawn = None
    for code in range(1 << len(cats)):
        want = ids.where(" and ".join(f"{y} = {code >> i & 1}" for i, y in enumerate(ys)))
        part = want.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        drawn = part if drawn is None else drawn.union(part)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((zlib.crc32(b"%d" % r["doc_id"]), r["text"], [r[y] for y in ys]) for b in batches for r in b.to_pylist())
        chain = train([r[1] for r in rows], np.array([r[2] for r in rows]).reshape(len(rows), len(ys)))
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(chain)]})

    # the drawn ids are bounded by max_rows for each combination, and so small enough to broadcast
    rows = fits.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", *ys).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    fitted = rows.coalesce(1).mapInArrow(learn, "model string").first()
    return fitted["model"] if fitted else json.dumps(train([], np.zeros((0, len(cats)))))


def scored(docs: DataFrame, model: str, text_col: str = "text", scores_col: str = "scores") -> DataFrame:
    """docs with scores_col, an array of the chain's probabilities for every whole text.

    Null texts score as empty ones, repeated rows alike. A column named scores_col is replaced; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    made: list[Scorer] = []

    @F.arrow_udf("array<double>")
    def of(text: pa.Array) -> pa.Array:
        made or made.append(Scorer(json.loads(model)))
        return pa.array((made[0](t or "") for t in text.to_pylist()), pa.list_(pa.float64()))

    return docs.withColumn(scores_col, of(docs[text_col]))
