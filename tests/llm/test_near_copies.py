"""Near copies against the Jaccard similarity of all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_search import groups
from tidemark.llm import near_copies

SF = "/root/testdata/sf0.01"


def shingle_set(text, words=5):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def near(a, b, similarity=0.8):
    return len(a & b) >= similarity * len(a | b)


def first_ids(rows):
    """The least id of each group, by brute force over (id, text) with distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    linked = [(a, b) for a, b in combinations(sorted(sets), 2) if near(sets[a], sets[b])]
    return sorted(set(groups(sorted(sets), linked).values()))


def test_stage_keeps_one_of_all_near_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = first_ids(docs.select("doc_id", "text").collect())
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    kept = sorted(r.doc_id for r in got.select("doc_id").collect())
    assert kept == want and not {56, 255, 770, 875, 944} & set(kept)


@pytest.mark.parametrize("block", [7, 256])
def test_large_families(spark, monkeypatch, block):
    """Copies with a few words replaced, so that some pairs reach the similarity and others just miss it."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng, rows = random.Random(block), []
    for _ in range(3):
        base = [f"w{rng.randrange(3000)}" for _ in range(150)]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(150)] = f"x{rng.randrange(3000)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    got = near_copies.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(r.doc_id for r in got.collect()) == first_ids(rows)


def test_similarities_are_exact(monkeypatch):
    monkeypatch.setattr(near_copies, "SLAB", 5)
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(60)] + ["a b c d e f g h i", "a b c d e f g h"]
    got = near_copies.similar([near_copies.shingles(t, 5) for t in texts], 0.8)
    sets = [shingle_set(t) for t in texts]
    assert (got == np.array([[near(a, b) for b in sets] for a in sets])).all() and got[-1, -2]


def test_keep_first_of_odd_tables(spark, odd, no_documents):
    kept = near_copies.keep_first(odd)
    assert kept.columns == odd.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(i for i, _ in got if i is not None) == [1, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11]
    assert {t for i, t in got if i == 5} == {"same text here", "another text"} and sum(i is None for i, _ in got) == 2
    assert near_copies.keep_first(no_documents).count() == 0
