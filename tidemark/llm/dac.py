"""Token ids in directly addressable codes.

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every id, and level k the
next chunk of those ids that have one; a bitmap for each level says which ids go on, and a directory
of ranks, one for every 512 bits, says how many went on before. Any id is found by its position:
its chunk, its continuation bit and the rank of that bit, level by level, with no block to decode.

On disk a corpus is a Parquet table of segments. Each row holds whole documents in ascending order of
doc_id: their ids and lengths, the codes, and the position of the first token in its shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, new_path, texts
from tidemark.llm.token_units import in_chunks, word_bpe

RANK = 512  # bits between two entries of a rank directory
SEGMENT = 1 << 19  # tokens after which a segment is closed, between documents
_HEAD = struct.Struct("<4sII")
_LEVEL = struct.Struct("<Q")
_MAGIC = b"DAC8"


def pack(ids: np.ndarray) -> bytes:
    """The codes of unsigned ids below 2**32; no ids are one empty level."""
    rest, levels = np.ascontiguousarray(ids, np.uint32), []
    while True:
        on = rest > 0xFF
        bits = np.packbits(on, bitorder="little")
        sums = np.add.reduceat(on, np.arange(0, len(on), RANK), dtype=np.uint32) if len(on) else np.empty(0, np.uint32)
        ranks = np.concatenate([[0], np.cumsum(sums)]).astype("<u4")
        levels.append(_LEVEL.pack(len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[on] >> np.uint32(8)
        if not len(rest):
            return b"".join([_HEAD.pack(_MAGIC, len(ids), len(levels)), *levels])


class Codes:
    """Reads packed ids in place."""

    def __init__(self, blob: bytes):
        magic, self.n, count = _HEAD.unpack_from(blob)
        if magic != _MAGIC:
            raise ValueError("not a table of directly addressable codes")
        self.levels, at = [], _HEAD.size
        for _ in range(count):
            (n,) = _LEVEL.unpack_from(blob, at)
            at += _LEVEL.size
            chunks = np.frombuffer(blob, np.uint8, n, at)
            bits = np.frombuffer(blob, np.uint8, (n + 7) // 8, at := at + n)
            ranks = np.frombuffer(blob, "<u4", (n + RANK - 1) // RANK + 1, at := at + len(bits))
            at += ranks.nbytes
            self.levels.append((chunks, bits, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Set bits before position i of a level: one entry of the directory and at most 512 bits."""
        _, bits, ranks = self.levels[level]
        block = i // RANK
        part = np.unpackbits(bits[block * RANK // 8 : (i + 7) // 8], bitorder="little")[: i - block * RANK]
        return int(ranks[block]) + int(part.sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            i = self._rank(level, i)
        return value

    def run(self, i: int, n: int) -> np.ndarray:
        """The n ids from position i."""
        out, where = np.zeros(n, np.uint32), np.arange(n)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[where] |= chunks[i : i + n].astype(np.uint32) << np.uint32(8 * level)
            on = np.unpackbits(bits[i >> 3 : (i + n + 7) >> 3], bitorder="little")[i & 7 : (i & 7) + n].astype(bool)
            where = where[on]
            if not len(where):
                break
            i, n = self._rank(level, i), len(where)
        return out


_COLUMNS = "shard int, segment int, first long, n_tokens long, doc_ids array<long>, lengths array<long>, codes binary"
_SCHEMA = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary())])


def write(docs: DataFrame, vocabulary: str, end_id: int | None, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encodes every whole text, ends each with end_id, and writes the segments; returns their folder.

    Documents lie in ascending order of doc_id, null ids first; equal ids in the order of a hash of
    their texts. Null texts are empty ones. Repeated rows are written as often as they come, an empty
    table writes no segment. Ranges of doc_id are dealt out to tasks, each writes its own shard.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or new_path(spark, "token-codes")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = word_bpe(vocabulary), TaskContext.get().partitionId()
        end = np.array([] if end_id is None else [end_id], np.uint32)
        segment, first, names, parts, size = 0, 0, [], [], 0

        def closed() -> pa.RecordBatch:
            row = [[shard], [segment], [first], [size], [names], [[len(p) for p in parts]], [pack(np.concatenate(parts))]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _SCHEMA)], schema=_SCHEMA)

        for rows in in_chunks(batches):
            for doc_id, ids in zip(rows["doc_id"].to_pylist(), encode(rows["text"].combine_chunks())):
                names.append(doc_id)
                parts.append(np.concatenate([ids, end]))
                size += len(parts[-1])
                if size >= SEGMENT:
                    yield closed()
                    segment, first, names, parts, size = segment + 1, first + size, [], [], 0
        if names:
            yield closed()

    rows = texts(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(segments, _COLUMNS).write.option("parquet.block.size", 16 << 20).option("compression", "zstd").parquet(path)
    return path


def read(spark, path: str) -> DataFrame:
    """(shard, segment, first, n_tokens, doc_ids, lengths, codes, start): start is the global position of the first token.

    Only one total for each shard, and there are as many as tasks that wrote, comes to the driver.
    """
    bounded_batches(spark)
    table = spark.read.schema(_COLUMNS).parquet(path)
    totals = table.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    bases, base = [], 0
    for shard, n in totals:
        bases.append((shard, base))
        base += n
    of = F.broadcast(spark.createDataFrame(bases, "shard int, base long"))
    return table.join(of, "shard").select(*table.columns, (F.col("base") + F.col("first")).alias("start"))


def digests(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in segments, from random access to its run of ids."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, at, out = Codes(row["codes"]), 0, []
                for doc_id, n in zip(row["doc_ids"], row["lengths"]):
                    ids = codes.run(at, n)
                    out.append((doc_id, row["start"] + at, n, zlib.crc32(ids.astype("<u4").tobytes())))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("doc_ids", "lengths", "codes", "start").mapInArrow(of, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_at(segments: DataFrame, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """(position, id) for global positions of tokens, by random access into the codes of their segments.

    Positions meet segments by spans of SEGMENT tokens, so no side is broadcast, and each segment that
    is asked for is read once. Repeated positions come as often as they are asked for; null ones and
    those beyond the corpus are left out. No segments or no positions give no rows.
    """
    bounded_batches(segments.sparkSession)
    p = positions.select(F.col(position_col).cast("long").alias("position")).where("position >= 0").withColumn("span", F.floor(F.col("position") / SEGMENT))
    last = F.col("start") + F.col("n_tokens") - 1
    bounds = segments.where("n_tokens > 0").select("shard", "segment", "start", "n_tokens", F.explode(F.sequence(F.floor(F.col("start") / SEGMENT), F.floor(last / SEGMENT))).alias("span"))
    asked = p.join(bounds, "span").where((F.col("position") >= F.col("start")) & (F.col("position") <= last))
    # a piece of a segment's positions stays with one span, so what is gathered is bounded unless positions repeat
    grouped = asked.groupBy("shard", "segment", "span").agg(F.collect_list(F.col("position") - F.col("start")).alias("at"))

    @F.arrow_udf("array<long>")
    def read_ids(codes: pa.Array, at: pa.Array) -> pa.Array:
        found = []
        for blob, places in zip(codes, at):
            c = Codes(blob.as_py())
            found.append([c[i] for i in places.as_py()])
        return pa.array(found, pa.list_(pa.int64()))

    rows = grouped.join(segments.select("shard", "segment", "start", "codes"), ["shard", "segment"])
    pairs = rows.select("start", F.arrays_zip("at", read_ids("codes", "at").alias("id")).alias("r"))
    return pairs.select("start", F.inline("r").alias("at", "id")).select((F.col("start") + F.col("at")).alias("position"), "id")
