"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Units are ids of a byte-level BPE, so the vocabulary is closed and an n-gram of up to four ids is one
exact 64-bit key. Texts are encoded once, in blocks of whole documents. The distinct n-grams of a block
are dealt to parts by the hash of their context; a block and a part have one row, which holds the sorted
n-grams as packed differences, and their counts. A part adds up its rows of all blocks and answers each
with the corpus' counts alone, in the order of the row's n-grams, so that n-grams travel once. A block
puts the answers of all parts together and sums the scores of its documents. A document's own n-grams
are taken off the counts before it is scored.

Parts grow with blocks, so that a part holds some millions of n-grams at most; rows are short then, and
half the square of the blocks in number (at 30 GB some 6,000 blocks, and 3,000 rows for each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, stored, texts
from tidemark.llm.token_units import in_chunks, word_bpe

#: Ids after which a block is closed, between documents.
BLOCK_IDS = 3 << 20
BACKOFF = 0.4
_DIGIT = 1 << 16  # ids are below this; an n-gram is a number with digits id + 1, so no two of them are equal
#: Parts into which the followers of a short context are dealt: single ids and bigrams follow few contexts very often.
SPREAD = 64
#: Parts that n-grams are dealt to at least; with more than twice as many blocks, there is a part for every two.
PARTS = 512
#: Ids whose scores are computed at once, in whole documents.
TOGETHER = 1 << 18
#: Words that a worker remembers, and bytes of text that it encodes at once; blocks and counts need the rest of its memory.
REMEMBERED, CHUNK = 150_000, 1 << 20


def _grouped(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values up to most, how often each comes, and the place of each value among them."""
    bits = len(values).bit_length()
    if int(most).bit_length() + bits > 63:
        found, at, times = np.unique(values, return_inverse=True, return_counts=True)
        return found, times, at
    x = np.sort(values << bits | np.arange(len(values)))  # far quicker than to sort places by values
    found = x >> bits
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(x) else np.empty(0, np.int64)
    times = np.diff(np.r_[first, len(x)])
    at = np.empty(len(x), np.int64)
    at[x & (1 << bits) - 1] = np.repeat(np.arange(len(first)), times)
    return found[first], times, at


def indexed(ids: np.ndarray, lengths: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For k from 1 to order: sorted keys of the k-grams inside documents of these lengths, their counts, and at every id the place of the k-gram that ends there, or -1."""
    place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    digits, out = ids.astype(np.int64) + 1, []
    for k in range(1, order + 1):
        ends = np.flatnonzero(place >= k - 1)
        before, shorter = (out[-1][2][ends - 1], out[-1][0]) if k > 1 else (np.zeros(len(ends), np.int64), np.zeros(1, np.uint64))
        found, times, of = _grouped(before * _DIGIT + digits[ends], len(shorter) * _DIGIT)
        at = np.full(len(ids), -1)
        at[ends] = of
        out.append((shorter[found // _DIGIT] * np.uint64(_DIGIT) + (found % _DIGIT).astype(np.uint64), times, at))
    return out


def scores(lengths: np.ndarray, places: list[np.ndarray], counts: list[np.ndarray], total: int) -> list[float]:
    """The sum of log10 scores of each document. places: by order, as indexed gives them; counts: of the corpus, the document's own included.

    An id after fewer than order - 1 others starts at the order that it has. An id that no other text
    has scores as if it stood once among all other ids.
    """
    n, order = int(lengths.sum()), len(places)
    starts = np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(len(lengths)), lengths)
    reach = np.minimum(np.arange(n) - np.repeat(starts, lengths) + 1, order)
    rest: list[np.ndarray] = []  # by order: counts without the id's document, at every id
    for at, every in zip(places, counts):
        there = np.flatnonzero(at >= 0)
        _, times, own = _grouped(doc[there] * len(every) + at[there], len(lengths) * len(every))
        left = np.zeros(n, np.int64)
        left[there] = every[at[there]] - times[own]
        rest.append(left)
    others = total - np.repeat(lengths, lengths)
    out, done = np.zeros(n), np.zeros(n, bool)
    for k in range(order, 0, -1):
        now = np.flatnonzero(~done & (rest[k - 1] > 0))
        base = rest[k - 2][now - 1] if k > 1 else others[now]
        out[now] = np.log10(rest[k - 1][now] / base) + (reach[now] - k) * np.log10(BACKOFF)
        done[now] = True
    out[~done] = reach[~done] * np.log10(BACKOFF) - np.log10(others[~done] + 1)
    return [float(out[a : a + m].sum()) for a, m in zip(starts.tolist(), lengths.tolist())]


def _dealt(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of all n-grams of a block by part, and how many each part has."""
    mixed = []
    for k, (keys, _, _) in enumerate(found, 1):
        context, follower = keys // np.uint64(_DIGIT), keys % np.uint64(_DIGIT)
        spread = follower // np.uint64(_DIGIT // SPREAD) if k < 3 else np.uint64(0)
        mixed.append((context * np.uint64(SPREAD) + spread) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33))
    part = (np.concatenate(mixed) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    return np.argsort(part, kind="stable"), np.bincount(part, minlength=parts)


_BLOCKS = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("ids", pa.binary())])
_DEALT = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _packed(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, compressed: the lowest bytes of all, then the next ones."""
    return pa.compress(np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _numbers(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()


def _unpacked(lengths: np.ndarray, blob: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, int(lengths.sum()) * 2, "zstd", asbytes=True), np.uint16)


def _blocks(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row for each block: its documents, their lengths, and their ids one after the other."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, names, parts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def closed() -> pa.RecordBatch:
            blob = pa.Codec("zstd", 3).compress(np.concatenate(parts).tobytes(), asbytes=True)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((block, names, [len(p) for p in parts], blob), _BLOCKS)], schema=_BLOCKS)

        for rows in in_chunks(batches, CHUNK):
            for name, ids in zip(rows["doc_id"].to_pylist(), word_bpe(vocabulary, REMEMBERED)(rows["text"].combine_chunks())):
                if len(ids) and int(ids.max()) > _DIGIT - 2:
                    raise ValueError(f"ids must be below {_DIGIT - 1}")
                names.append(name)
                parts.append(ids.astype(np.uint16))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield closed()
                    block, names, parts, size = block + 1, [], [], 0
            pa.default_memory_pool().release_unused()
        if names:
            yield closed()

    return docs.mapInArrow(encode, "block long, doc_ids array<long>, lengths array<int>, ids binary")


def _by_part(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """(part, block, size, keys, counts): the n-grams of a block that a part has, sorted, as differences, and their counts."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                found = indexed(_unpacked(lengths, row["ids"]), lengths, order)
                by, sizes = _dealt(found, parts)
                keys, counts = (np.concatenate([f[i] for f in found])[by] for i in (0, 1))
                ends = np.cumsum(sizes)
                there = np.flatnonzero(sizes)
                cuts = [(e - n, e) for e, n in zip(ends[there].tolist(), sizes[there].tolist())]
                blobs = [[_packed(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in cuts], [_packed(counts[a:b]) for a, b in cuts]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((there, np.full(len(there), row["block"]), sizes[there], *blobs), _DEALT)], schema=_DEALT)

    return blocks.select("block", "lengths", "ids").mapInArrow(deal, "part long, block long, size long, keys binary, counts binary")


def _totals(rows: pa.Table) -> pa.Table:
    """(block, part, totals): the counts over all blocks of every row's n-grams."""
    sizes = rows["size"].to_pylist()
    keys = np.concatenate([np.cumsum(_numbers(k, n), dtype=np.uint64) for k, n in zip(rows["keys"].to_pylist(), sizes)])
    counts = np.concatenate([_numbers(c, n) for c, n in zip(rows["counts"].to_pylist(), sizes)])
    _, at = np.unique(keys, return_inverse=True)
    totals = np.bincount(at, weights=counts)[at]
    return pa.table({"block": rows["block"], "part": rows["part"], "totals": pa.array([_packed(t) for t in np.split(totals, np.cumsum(sizes)[:-1])], pa.binary())})


def scored(docs: DataFrame, vocabulary: str, order: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log10_score, log10_mean), one row per row of docs.

    order is 1 to 4. Null and empty texts have no tokens, score 0 and a null mean. Repeated rows are
    documents of their own and count as often as they come; rows with a null id count and score as
    others do. A vocabulary of over 65,535 ids is refused. An empty table gives no rows.
    """
    if not 1 <= order <= 4:
        raise ValueError("order must be 1 to 4")
    bounded_batches(docs.sparkSession)
    blocks = stored(_blocks(texts(docs, id_col, text_col), vocabulary), "ids")
    size = blocks.agg(F.count("*").alias("blocks"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids")).first()
    total, parts = size.ids or 0, max(PARTS, size.blocks // 2)
    totals = _by_part(blocks, order, parts).groupBy("part").applyInArrow(_totals, "block long, part long, totals binary")

    def summed(key, block: pa.Table, totals: pa.Table) -> pa.Table:
        names, lengths, sums = [], [], []
        blobs = dict(zip(totals["part"].to_pylist(), totals["totals"].to_pylist()))
        for row in block.to_pylist():
            sizes = np.array(row["lengths"], np.int64)
            found = indexed(_unpacked(sizes, row["ids"]), sizes, order)
            by, of_part = _dealt(found, parts)
            counts = np.empty(len(by), np.int64)
            counts[by] = np.concatenate([np.empty(0, np.uint64), *(_numbers(blobs[p], of_part[p]) for p in np.flatnonzero(of_part).tolist())])
            by_order = np.split(counts, np.cumsum([len(keys) for keys, _, _ in found])[:-1])
            ends = np.cumsum(sizes)
            cuts = np.flatnonzero(np.diff(ends // TOGETHER, prepend=0))
            for d in np.split(np.arange(len(sizes)), cuts):
                a, b = (int(ends[d[0]] - sizes[d[0]]), int(ends[d[-1]])) if len(d) else (0, 0)
                sums += scores(sizes[d], [at[a:b] for _, _, at in found], by_order, total)
            names, lengths = names + row["doc_ids"], lengths + row["lengths"]
        return pa.table({"doc_id": pa.array(names, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()), "log10_score": pa.array(sums, pa.float64())})

    out = blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(summed, "doc_id long, n_tokens long, log10_score double")
    return out.withColumn("log10_mean", F.when(F.col("n_tokens") > 0, F.col("log10_score") / F.col("n_tokens")))
