"""Exact top-k inner products by a three-phase uniform threshold.

The components are dealt into lists, and a row of a list holds a vector's components there and the length
of the rest of it; a vector's score is the sum of its partial scores in all lists. Phase 1 gathers, list
by list, each query's k highest partial scores and its lowest one. The whole scores of what was gathered
give a safe cutoff: the k-th highest of them. Phase 2 broadcasts it. Counted from the lowest of its list, a
partial score of any vector that reaches the cutoff is in one list, at least, an equal share of what the
cutoff is above the sum of the lowest ones; of these entries, those are sent whose partial score and the
longest possible rest reach the cutoff. Phase 3 adds up what was sent and computes the exact scores of
all that can still reach the cutoff.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, stored

#: Lists into which the components are dealt.
LISTS = 2
#: Bytes of the vectors of one slice of queries on average; a slice is sent to all tasks, so this bounds what is broadcast.
SLICE_BYTES = 4 << 20
#: Queries, and vectors, whose partial scores a task holds at once.
QUERIES, ROWS = 512, 4096
#: Relative error that sums of products in doubles stay far below.
SLACK = 1e-10
_MOST = 10**38 - 1
_LONG = (1 << 63) - 1


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, scale a power of two, as whole doubles of any size.

    Vectors that are null, or hold null or non-finite components, and rows without id are left out; of
    rows with one id the least vector stays.
    """
    x = df[vec_col]
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    y = lambda c: F.lit(float(scale)) * c.cast("double")
    # from 2**52 on a double is whole; below, its floor fits in 64 bits
    v = F.transform(x, lambda c: F.when(F.abs(y(c)) < float(1 << 52), F.floor(F.when(F.abs(y(c)) < float(1 << 52), y(c)).otherwise(0.0)).cast("double")).otherwise(y(c)))
    return df.where(fine & df[id_col].isNotNull()).select(df[id_col].cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(v: pa.Array, dims: int) -> np.ndarray:
    """Rows of dims components; shorter vectors end in zeros."""
    sizes, flat = v.value_lengths().to_numpy(zero_copy_only=False), v.flatten().to_numpy()
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _length(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((x * x).sum(1))


def _lists(vectors: DataFrame, dims: int) -> DataFrame:
    """(list, vec_id, x, rest): the components i, i + LISTS, ... of every vector, and the length of its others."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch["v"], dims)
            for j in range(LISTS):
                part = m[:, j::LISTS]
                rest = _length(np.delete(m, np.s_[j::LISTS], axis=1))
                x = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * part.shape[1], pa.int32()), pa.array(part.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), j)), batch["vec_id"], x, pa.array(rest)], names=["list", "vec_id", "x", "rest"])

    rows = vectors.mapInArrow(deal, "list long, vec_id long, x array<double>, rest double")
    return stored(rows.repartitionByRange("list", "vec_id"), "lists")


class Slice:
    """Some queries, the components of their vectors by list, and what is known of their scores."""

    def __init__(self, ids: list[int], v: list[list[float]], dims: int):
        self.ids = np.array(ids, np.int64)
        m = _matrix(pa.array(v, pa.list_(pa.float64())), dims)
        self.q = [m[:, j::LISTS] for j in range(LISTS)]
        self.own = [_length(q) for q in self.q]
        self.rest = [_length(np.delete(m, np.s_[j::LISTS], axis=1)) for j in range(LISTS)]
        self.low = np.full((LISTS, len(ids)), np.inf)
        self.cutoff = np.full(len(ids), -np.inf)

    def tiles(self, batches: Iterator[pa.RecordBatch]):
        """(list, first query, end, vec_ids, partial scores, where a query meets itself, lengths of x, lengths of rests)."""
        for batch in batches:
            for j in np.unique(batch["list"].to_numpy()):
                rows = batch.filter(pc.equal(batch["list"], int(j)))
                for i in range(0, rows.num_rows, ROWS):
                    part = rows.slice(i, ROWS)
                    ids, x, rest = part["vec_id"].to_numpy(), _matrix(part["x"], self.q[j].shape[1]), part["rest"].to_numpy()
                    for a in range(0, len(self.ids), QUERIES):
                        b = min(a + QUERIES, len(self.ids))
                        with np.errstate(over="ignore", invalid="ignore"):
                            yield int(j), a, b, ids, self.q[j][a:b] @ x.T, self.ids[a:b, None] == ids[None], _length(x), rest


def _first_phase(batches: Iterator[pa.RecordBatch], s: Slice, k: int) -> Iterator[pa.RecordBatch]:
    n = len(s.ids)
    top = [[np.full((n, k), -np.inf), np.full((n, k), -1)] for _ in range(LISTS)]  # partial scores, vec_ids
    low = np.full((LISTS, n), np.inf)
    for j, a, b, ids, p, own, _, _ in s.tiles(batches):
        p = np.nan_to_num(p, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        low[j, a:b] = np.minimum(low[j, a:b], np.where(own, np.inf, p).min(1))
        p = np.where(own, -np.inf, p)
        scores, names = np.concatenate([top[j][0][a:b], p], 1), np.concatenate([top[j][1][a:b], np.where(own, -1, ids[None])], 1)
        best = np.argpartition(-scores, k - 1, 1)[:, :k]
        top[j][0][a:b], top[j][1][a:b] = np.take_along_axis(scores, best, 1), np.take_along_axis(names, best, 1)
    for j in range(LISTS):
        q, at = np.nonzero(top[j][0] > -np.inf)
        yield pa.RecordBatch.from_pydict({"q": q, "list": np.full(len(q), j), "vec_id": top[j][1][q, at], "p": top[j][0][q, at]})
        q = np.flatnonzero(low[j] < np.inf)
        yield pa.RecordBatch.from_pydict({"q": q, "list": np.full(len(q), j), "vec_id": pa.nulls(len(q), pa.int64()), "p": low[j][q]})


def _second_phase(batches: Iterator[pa.RecordBatch], s: Slice) -> Iterator[pa.RecordBatch]:
    """(q, vec_id, p, most) of the entries that can belong to a score at the cutoff or over it: p and most are from above, of the list and of the score."""
    lowest = s.low.sum(0)
    for j, a, b, ids, p, own, length, rest in s.tiles(batches):
        with np.errstate(invalid="ignore", over="ignore"):
            cutoff = s.cutoff[a:b, None]
            error = SLACK * (s.own[j][a:b, None] * length[None] + s.rest[j][a:b, None] * rest[None] + np.abs(cutoff) + np.abs(s.low[:, a:b]).sum(0)[:, None])
            most = p + s.rest[j][a:b, None] * rest[None] + error
            below = (most < cutoff) | (LISTS * (p - s.low[j, a:b, None]) + LISTS * error < cutoff - lowest[a:b, None])
        q, at = np.nonzero(~(below | own))
        yield pa.RecordBatch.from_pydict({"q": q + a, "vec_id": ids[at], "p": (p + error)[q, at], "most": most[q, at]})


def _product(v: Column, w: Column) -> Column:
    """Exact inner products of whole doubles as decimals; beyond 38 digits the nearest one with 38."""

    @F.arrow_udf("decimal(38,0)")
    def of(v: pa.Array, w: pa.Array) -> pa.Array:
        dims = max([0, *v.value_lengths().to_pylist(), *w.value_lengths().to_pylist()])
        a, b = _matrix(v, dims), _matrix(w, dims)
        with np.errstate(over="ignore", invalid="ignore"):
            safe, sums = np.abs(a * b).sum(1) < float(1 << 53), (a * b).sum(1)
        exact = [int(x) if fits else sum(int(p) * int(q) for p, q in zip(r, t)) for fits, x, r, t in zip(safe.tolist(), sums.tolist(), a, b)]
        return pa.array([Decimal(max(-_MOST, min(_MOST, x))) for x in exact], pa.decimal128(38, 0))

    return of(v, w)


def _ranked(df: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """The k highest of every key, ties to the smaller vec_id, with their rank."""
    w = Window.partitionBy(key).orderBy(F.desc(score), "vec_id")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _slice_top(vectors: DataFrame, lists: DataFrame, asked: DataFrame, s: Slice, k: int) -> DataFrame:
    """asked: (q, query_id, qv), the slice's queries."""
    context = vectors.sparkSession.sparkContext

    def exact(found: DataFrame) -> DataFrame:
        return found.join(vectors, "vec_id").join(F.broadcast(asked), "q").select("q", "query_id", "vec_id", _product(F.col("v"), F.col("qv")).alias("score"))

    asking = context.broadcast(s)
    gathered = stored(lists.mapInArrow(lambda b: _first_phase(b, asking.value, k), "q long, list long, vec_id long, p double"), "gathered")
    for q, j, p in gathered.where("vec_id is null").groupBy("q", "list").agg(F.min("p")).collect():  # LISTS rows for each query of the slice
        s.low[j, q] = p
    tops = _ranked(gathered.where("vec_id is not null").withColumn("key", F.struct("q", "list")), "key", "p", k)
    bound = _ranked(exact(tops.select("q", "vec_id").distinct()), "q", "score", k).where(F.col("rank") == k)
    for q, kth in bound.select("q", F.col("score").cast("double")).collect():  # a row for each query of the slice
        s.cutoff[q] = kth
    informed = context.broadcast(s)
    sent = stored(lists.mapInArrow(lambda b: _second_phase(b, informed.value), "q long, vec_id long, p double, most double"), "entries")
    cutoffs = asked.sparkSession.createDataFrame(list(enumerate(s.cutoff.tolist())), "q long, cutoff double")
    # what all lists have sent adds up to the score; a list that is missing leaves the bound of the others
    met = sent.groupBy("q", "vec_id").agg(F.count("*").alias("n"), F.sum("p").alias("p"), F.min("most").alias("most"))
    bound = F.when(F.col("n") == LISTS, F.least("p", "most")).otherwise(F.col("most"))
    open_ = met.join(F.broadcast(cutoffs), "q").where(~(bound < F.col("cutoff"))).select("q", "vec_id")
    whole = _ranked(exact(open_), "query_id", "score", k)
    return whole.select("query_id", "rank", "vec_id", F.greatest(F.lit(-_LONG - 1), F.least(F.lit(_LONG), "score")).cast("long").alias("score"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query, all if there are fewer.

    vectors and queries have (vec_id, v), whole numbers as quantised() makes them. A query doesn't meet the
    vector with its own id; ties go to the smaller vec_id. A shorter vector counts as ending in zeros.
    Scores are exact to 38 digits and ranked so; one beyond 64 bits is given as the nearest that has 64.
    No queries or no vectors give no rows.
    """
    bounded_batches(vectors.sparkSession)
    held, asked = (stored(df.select("vec_id", F.col("v").cast("array<double>").alias("v")), name) for df, name in ((vectors, "vectors"), (queries, "queries")))
    dims, asked_dims = (df.agg(F.max(F.size("v"))).first()[0] or 0 for df in (held, asked))
    dims = max(dims, asked_dims, 1)
    lists = _lists(held, dims)
    slices = 1 + asked.count() * dims * 8 // SLICE_BYTES
    out = None
    for i in range(slices):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(slices)) == i).orderBy("vec_id").collect()  # SLICE_BYTES on average
        if not rows and out is not None:
            continue
        own = asked.sparkSession.createDataFrame([(n, r["vec_id"], r["v"]) for n, r in enumerate(rows)], "q long, query_id long, qv array<double>")
        part = stored(_slice_top(held, lists, own, Slice([r["vec_id"] for r in rows], [r["v"] for r in rows], dims), k), "top-k")
        out = part if out is None else out.union(part)
    return out
