"""Best-fit packing into bins of several permitted capacities.

Items go in descending length into the open bin that they fill best. Where none has room a bin is
opened; which sizes may be opened is a policy, and all policies are tried for a shard: every bin is at
last made as small as its contents allow, and the policy with the least total cost is kept. Shards are
packed independently, so a task holds the lengths of one shard only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, stored, texts
from tidemark.llm.token_units import in_chunks, word_bpe

CAPACITIES = (2048, 4096, 8192)
#: Pieces that a shard holds on average.
SHARD = 100_000
#: The length at which the quadratic part of a bin's cost equals the linear part.
BALANCE = 32_768


def cost(capacity: int) -> float:
    """Relative cost of a training sequence: linear work and attention."""
    return capacity * (1 + capacity / BALANCE)


def best_fit(lengths: Sequence[int], opened: Sequence[int]) -> tuple[list[int], list[int]]:
    """(bin of each item, contents of each bin) for lengths in descending order; opened: ascending capacities.

    A new bin has the least-cost capacity among opened that holds the item.
    """
    waiting: dict[int, list[int]] = {}  # free room -> bins, the last one is taken first
    rooms = 0  # bit r is set where a bin with room r waits
    bins, used, room_of = [], [], []
    for n in lengths:
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(used), opened[bisect_left(opened, n)]
            used.append(0)
        used[b] += n
        bins.append(b)
        left = room - n
        waiting.setdefault(left, []).append(b)
        if left:
            rooms |= 1 << left
    return bins, used


def pack_shard(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES) -> tuple[list[int], list[int]]:
    """(bin of each item, final capacity of each bin); items in descending order, none over the largest capacity.

    Policies: from each permitted capacity upwards. All hold every item, since the largest is in all.
    """
    sizes = sorted(set(capacities))
    best = None
    for i in range(len(sizes)):
        bins, used = best_fit(lengths, sizes[i:])
        final = [sizes[bisect_left(sizes, u)] for u in used]
        total = sum(map(cost, final))
        if best is None or total < best[0]:
            best = total, bins, final
    return best[1], best[2]


def token_lengths(docs: DataFrame, vocabulary: str, ends: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, length): ids of every whole text and ends more for its end. Null texts are empty ones."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_chunks(batches):
            n = [len(x) + ends for x in word_bpe(vocabulary)(rows["text"].combine_chunks())]
            yield from rows.select(["doc_id"]).append_column("length", pa.array(n, pa.int64())).to_batches()

    return texts(docs, id_col, text_col).mapInArrow(count, "doc_id long, length long")


_OUT = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("shard", pa.int64()), ("bin", pa.int32()), ("position", pa.int32()), ("capacity", pa.int32())])


def packed(lengths: DataFrame, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """(doc_id, piece, start, length, shard, bin, position, capacity) for lengths(doc_id, length).

    A document longer than the largest capacity is cut into pieces of that length and a rest, all of
    which are packed. (shard, bin) names a bin, position is where the piece begins in it. Equal lengths
    go in the order of doc_id. Null and zero lengths give no piece; null ids are packed as others;
    repeated rows are packed as often as they come. All are spread evenly over the shards. An empty table gives no rows.
    """
    largest = max(capacities)
    held = stored(lengths.where("length > 0").select("doc_id", "length"), "lengths")
    pieces = held.agg(F.sum(F.ceil(F.col("length") / largest))).first()[0] or 0
    # the place in the stored table goes into the hash, so that rows with one id are spread as well
    sharded = held.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(1 + pieces // SHARD)))

    def of(table: pa.Table) -> pa.Table:
        ids, n = pc.fill_null(table["doc_id"], -1).to_numpy(), table["length"].to_numpy()
        cuts = -(-n // largest)
        owner = np.repeat(np.arange(len(n)), cuts)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        size = np.minimum(largest, n[owner] - piece * largest)
        order = np.lexsort((piece, ids[owner], -size))
        owner, piece, size = owner[order], piece[order], size[order]
        bins, final = pack_shard(size.tolist(), capacities)
        bins = np.array(bins, np.int32)
        by = np.argsort(bins, kind="stable")
        run = np.cumsum(size[by]) - size[by]
        first = np.r_[True, bins[by][1:] != bins[by][:-1]]
        position = np.empty(len(bins), np.int64)
        position[by] = run - run[first][np.cumsum(first) - 1]
        columns = [table["doc_id"].combine_chunks().take(pa.array(owner)), piece, piece * largest, size, np.full(len(owner), table["shard"][0].as_py()), bins, position, np.array(final)[bins]]
        return pa.table([pa.array(c).cast(f.type) for c, f in zip(columns, _OUT)], schema=_OUT)

    schema = "doc_id long, piece int, start long, length int, shard long, bin int, position int, capacity int"
    return sharded.groupBy("shard").applyInArrow(of, schema)
