"""Classifiers: held-out accuracy, scores by plain loops, and defined answers for odd tables."""

import zlib

import numpy as np

from tests.llm.conftest import SF
from tidemark.llm import quality_cnn, queries, toxicity_chain

LABELS = "/root/testdata/sf0.01/labels.parquet"


def f1(pairs, label):
    tp = sum(p == label and y == label for p, y in pairs)
    return 2 * tp / max(1, sum(p == label for p, _ in pairs) + sum(y == label for _, y in pairs))


def held(spark, df, column, labels=LABELS):
    labels = spark.read.parquet(labels)
    return [(r.predicted, r[column]) for r in df.where("held_out").join(labels, "doc_id").collect()]


def test_quality_on_held_out_documents(spark):
    out = queries.op6_quality_cnn(spark, "/root/testdata/sf0.01")
    rows = out.collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    pairs = held(spark, out, "quality")
    assert f1(pairs, 0) > 0.8 and f1(pairs, 1) > 0.95


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    pairs = held(spark, queries.op9_toxicity_chain(spark, sf), "toxic", f"{sf}/labels.parquet")
    caught = sum(p and y for p, y in pairs)
    assert sum(y for _, y in pairs) > 50 and caught >= 0.88 * sum(y for _, y in pairs) and caught >= 0.95 * sum(p for p, _ in pairs)


def test_scores_of_odd_tables(spark, odd, documents, no_documents):
    labels = spark.read.parquet(LABELS)
    q = quality_cnn.scored(odd, quality_cnn.fit(documents, labels))
    assert q.columns == [c for c in odd.columns] and all(0 <= r.score <= 1 for r in q.collect())
    t = toxicity_chain.scored(odd, toxicity_chain.fit(documents, labels, ("quality", "toxic")))
    assert t.columns == [*odd.columns, "scores"] and all(len(r.scores) == 2 for r in t.collect())
    nothing = quality_cnn.fit(no_documents, labels)
    assert quality_cnn.score(quality_cnn.loads(nothing), b"x") == 0.5
    assert quality_cnn.scored(no_documents, nothing).count() == 0
    assert all(r.scores == [0.5, 0.5] for r in toxicity_chain.scored(odd, toxicity_chain.fit(no_documents, labels, ("quality", "toxic"))).collect())


def test_every_byte_counts():
    rng = np.random.default_rng(0)
    m = quality_cnn.initial(rng)
    text = rng.integers(97, 123, 5001).astype(np.uint8)
    base = quality_cnn.score(m, text.tobytes())
    m["W"] *= 3
    changed = 0
    for at in (0, 2500, 5000):
        other = text.copy()
        other[max(0, at - 40) : at + 40] = 255
        changed += quality_cnn.score(m, other.tobytes()) != quality_cnn.score(m, text.tobytes())
    assert 0 <= base <= 1 and changed == 3


def plain_quality(m, text):
    """The network by loops over positions, filters and chunks."""
    x = list(text) + [quality_cnn.PAD] * max(0, quality_cnn.SPAN - len(text))
    x += [quality_cnn.PAD] * ((len(x) - quality_cnn.WIDTH) % quality_cnn.STRIDE)
    n = (len(x) - quality_cnn.WIDTH) // quality_cnn.STRIDE + 1
    at = lambda p: np.concatenate([m["E"][x[quality_cnn.STRIDE * p + j]] for j in range(quality_cnn.WIDTH)]) @ m["W"] + m["b"]
    chunks = []
    for first in quality_cnn._starts(n):
        pooled = np.max([at(p) for p in range(first, first + 2 * quality_cnn.BLOCK)], 0)
        chunks.append(np.maximum(np.maximum(pooled, 0) @ m["U"] + m["c"], 0))
    z = np.concatenate([np.max(chunks, 0), np.mean(chunks, 0)]) @ m["v"] + m["a"][0]
    return 1 / (1 + np.exp(-z))


def test_quality_by_loops():
    rng = np.random.default_rng(5)
    m = quality_cnn.initial(rng)
    for n in (0, 1, 200, quality_cnn.SPAN, 700, 1501):
        text = rng.integers(0, 256, n).astype(np.uint8).tobytes()
        assert abs(quality_cnn.score(m, text) - plain_quality(m, text)) < 1e-5


def test_training_goes_down_the_gradient():
    """A model fits rows that a byte pattern tells apart."""
    rng = np.random.default_rng(6)
    rows = [(bytes(rng.integers(97, 123, 300).astype(np.uint8)), i % 2) for i in range(80)]
    rows = [(t[:100] + b"=#=#=#=#=#" + t[100:] if y else t, y) for t, y in rows]
    m = quality_cnn.train([t for t, _ in rows], [y for _, y in rows])
    assert all((quality_cnn.score(m, t) >= 0.5) == y for t, y in rows)


def test_chain_by_loops():
    """Later categories see the probabilities of earlier ones."""
    texts = [f"good words {i}" if i % 3 else f"bad bad! words {i} " + ("awful" if i % 2 else "") for i in range(60)]
    labels = np.array([[i % 3 == 0, i % 6 == 3] for i in range(60)], int)
    chain = toxicity_chain.train(texts, labels)
    for t in [*texts, "", "Bad, awful"]:
        found, earlier = set(), []
        for w in t.lower().split():
            found |= set(toxicity_chain.word_features(w))
        for m in chain:
            z = sum(m["features"].get(f, 0) for f in found) + sum(a * b for a, b in zip(m["dense"], earlier)) + m["bias"]
            earlier.append(1 / (1 + np.exp(-z)))
        assert np.allclose(toxicity_chain.Scorer(chain)(t), earlier)
    assert chain[1]["dense"] and chain[1]["dense"][0] != 0


def test_repeated_ids_are_learned_alike(spark, documents):
    labels = spark.read.parquet(LABELS)
    doubled = documents.unionByName(documents.withColumn("text", __import__("pyspark.sql.functions", fromlist=["reverse"]).reverse("text")))
    first, again = (quality_cnn.sample(d, labels, "quality", 50, 12_000).collect() for d in (doubled, doubled.repartition(5)))
    assert sorted(first) == sorted(again) and len({r.doc_id for r in first}) == len(first)
