"""Exact search and near duplicates against brute force."""

import math
import random
from itertools import combinations

import duckdb
import pytest
import xxhash

from tests.llm.conftest import SF
from tidemark.llm import components, queries, simhash, top_k


def test_top_k_query(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{SF}/embeddings.parquet'")
    want = sorted(con.sql(queries.OP7_SQL).fetchall())
    assert sorted(tuple(r) for r in queries.op7_top_k(spark, SF).collect()) == want


def brute(vectors, k):
    out = []
    for q, a in vectors.items():
        if q % 100 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors.items() if i != q))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_top_k_with_ties(spark, n):
    rng = random.Random(n)
    v = {i * 10: [rng.randint(-3, 3) for _ in range(6)] for i in range(n)}
    df = spark.createDataFrame(list(v.items()), "vec_id long, v array<long>").repartition(5)
    assert sorted(tuple(r) for r in top_k.top_k(df, df.where("vec_id % 100 = 0"), 4).collect()) == brute(v, 4)


def test_large_products_and_many_slices(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SLICE_BYTES", 120)
    rng = random.Random(1)
    v = {i * 20: [rng.randint(-(10**8), 10**8) for _ in range(5)] for i in range(120)}
    df = spark.createDataFrame(list(v.items()), "vec_id long, v array<long>")
    assert sorted(tuple(r) for r in top_k.top_k(df, df.where("vec_id % 100 = 0"), 7).collect()) == brute(v, 7)


def test_products_of_any_size(spark):
    """Components whose products leave 64 bits, beside small ones; exact in order and, where it fits, in value."""
    rng = random.Random(3)
    v = {i * 10: [rng.choice([0, 1, -1, 1e17, -1e17, 3e5, 0.001 * rng.random()]) for _ in range(4)] for i in range(60)}
    v |= {1000: [1e17, 1.0, 0.0, 0.0], 1001: [0.0, 5.0, 1e30, 0.0], 1003: [-1e300, 1e300, 0.0, 2.0]}
    df = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in v.items()], "vec_id long, embedding array<double>")
    whole = {i: [math.floor(int(c) * 1024 if abs(c) > 1e15 else 1024 * c) for c in x] for i, x in v.items()}
    made = top_k.quantised(df)
    got = [tuple(r) for r in top_k.top_k(made, made.where("vec_id % 100 = 0"), 5).collect()]
    most = 10**38 - 1
    want = []
    for q, a in whole.items():
        if q % 100 == 0:
            scores = sorted((-max(-most, min(most, sum(x * y for x, y in zip(a, b)))), i) for i, b in whole.items() if i != q)
            want += [(q, r + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, i) in enumerate(scores[:5])]
    assert sorted(got) == sorted(want)


def test_few_entries_reach_the_third_phase(spark):
    """Clustered vectors: what is sent stays near queries times k, not near all pairs."""
    rng = random.Random(11)
    centres = [[rng.gauss(0, 300) for _ in range(16)] for _ in range(40)]
    v = {i: [round(c + rng.gauss(0, 60)) for c in centres[i % 40]] for i in range(4000)}
    df = spark.createDataFrame(list(v.items()), "vec_id long, v array<long>")
    asked = df.where("vec_id % 100 = 0")
    assert sorted(tuple(r) for r in top_k.top_k(df, asked, 5).collect()) == brute(v, 5)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [0.0001, -0.0001]), (6, [0.0001, -0.0001])]
    got = top_k.quantised(spark.createDataFrame(rows, "vec_id int, embedding array<float>"))
    assert sorted((r.vec_id, r.v) for r in got.collect()) == [(1, [512, -512]), (6, [0, -1])]


def fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_duplicates(rows):
    prints = [(i, fingerprint(t)) for i, t in rows if i is not None]
    by = {}
    for i, f in prints:
        by.setdefault(f, []).append(i)
    of = groups(by, [(a, b) for a, b in combinations(by, 2) if (a ^ b).bit_count() <= 2])
    least = {}
    for f, ids in by.items():
        least[of[f]] = min(least.get(of[f], min(ids)), *ids)
    return sorted((i, f"{f:016x}", least[of[f]]) for i, f in prints)


def test_near_duplicates_query(spark, documents):
    assert sorted(tuple(r) for r in queries.op10_simhash(spark, SF).collect()) == brute_duplicates(documents.select("doc_id", "text").collect())


def test_near_duplicates_of_odd_tables(spark, odd, no_documents):
    got = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute_duplicates(odd.select("doc_id", "text").collect())
    assert all(r[2] is None for r in got if r[0] is None) and len(got) == odd.count()
    assert simhash.near_duplicates(no_documents).count() == 0


@pytest.mark.parametrize("most", [3, 32])
def test_links_keep_groups_whole(spark, monkeypatch, most):
    """Dense families around a few centres, so that signatures are crowded."""
    monkeypatch.setattr(simhash, "PAIRWISE", most)
    rng = random.Random(most)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(90):
            prints.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = [tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links)
    want = groups(sorted(signed), [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2])
    assert groups(sorted(signed), links) == want


def test_links_broadcast_no_members(spark, monkeypatch):
    """Members of crowded signatures explode into hundreds of rows each, which Spark takes for as small as their file."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    monkeypatch.setattr(simhash, "PAIRWISE", 3)
    rng = random.Random(9)
    centre = rng.getrandbits(63)
    prints = sorted({centre ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(60)})
    spark.conf.set(limit, "10m")
    try:
        links = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
        assert links.collect()
        plan = links._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.set(limit, before)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7), (None, 3), (2000, None)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = groups({x for e in real for x in e}, real)
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
