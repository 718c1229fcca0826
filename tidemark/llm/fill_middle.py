"""Fill-in-the-middle forms of documents, cut at token boundaries of an index of distinct texts.

Identical texts make one group, compared by their whole content, and a group's boundaries are found once and kept as an
Elias-Fano list. The group carries the ids of its documents, so each of them meets the list in the row that has it: the
texts travel once, and a seeded cut is a selection from the list. Texts with very many copies make several groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, texts

MARKERS = ("<P>", "<S>", "<M>")
#: Rows of one group at least, before a text's copies are dealt to several, and how many texts may have several at most.
COPIES, HOT_TEXTS = 1024, 100_000
#: Bytes of the bitmap between two entries of the directory.
_STEP = 64


def token_ends(text: str) -> np.ndarray:
    """Where tokens end, in code points: white space belongs to what follows it, at the end of a text it is a token."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blank = (c == 32) | ((c >= 9) & (c <= 13))
    last = ~blank
    last[:-1] &= blank[1:]
    if len(c):
        last[-1] = True
    return np.flatnonzero(last) + 1


class EliasFano:
    """An ascending list of numbers: low bits packed, high bits in unary, and a directory of ones for selection."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        ones = np.add.reduceat(np.bitwise_count(self.high), np.arange(0, len(high), _STEP), dtype=np.int64) if len(high) else np.empty(0, np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"")
        bits = max(0, int(values[-1] // n).bit_length() - 1)
        low = np.packbits((values[:, None] >> np.arange(bits) & 1).astype(np.uint8), bitorder="little")
        at = (values >> bits) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1, np.uint8)
        high[at] = 1
        return cls(n, bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes())

    def __getitem__(self, k: int) -> int:
        block = int(np.searchsorted(self.before, k, "right")) - 1
        ones = np.flatnonzero(np.unpackbits(self.high[block * _STEP : (block + 1) * _STEP], bitorder="little"))
        high = block * _STEP * 8 + int(ones[k - self.before[block]]) - k
        first, end = k * self.low_bits, (k + 1) * self.low_bits
        low = int.from_bytes(self.low[first // 8 : -(-end // 8)].tobytes(), "little") >> first % 8 & (1 << self.low_bits) - 1
        return high << self.low_bits | low


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, ids, n, low_bits, low, high): a row for each distinct text, with its documents and the list of its token ends.

    Null texts are empty ones. Repeated rows repeat their id in ids, null ids are kept. A text with over COPIES rows, or
    over the HOT_TEXTSth part of all rows if that is more, has several rows, among which its documents are dealt by the
    hash of their id. So at most HOT_TEXTS texts have several, and only their hashes and numbers are broadcast.
    """
    bounded_batches(docs.sparkSession)
    named = texts(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    most = max(COPIES, docs.count() // HOT_TEXTS)
    hot = named.groupBy("hash").count().where(F.col("count") > most).select("hash", F.ceil(F.col("count") / most).alias("parts"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.coalesce("parts", F.lit(1)))
    dealt = named.join(F.broadcast(hot), "hash", "left").select("text", "doc_id", part.alias("part"))
    # collect_list leaves nulls out, so ids travel in structs
    groups = dealt.groupBy("text", "part").agg(F.collect_list(F.struct("doc_id")).alias("ids")).select("text", F.col("ids.doc_id").alias("ids"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [EliasFano.of(token_ends(t)) for t in batch["text"].to_pylist()]
            more = [
                pa.array([e.n for e in found], pa.int64()),
                pa.array([e.low_bits for e in found], pa.int32()),
                pa.array([e.low.tobytes() for e in found], pa.binary()),
                pa.array([e.high.tobytes() for e in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch["text"], batch["ids"], *more], ["text", "ids", "n", "low_bits", "low", "high"])

    return groups.mapInArrow(listed, "text string, ids array<long>, n long, low_bits int, low binary, high binary")


def _numbers(seed: int, doc_id: int | None) -> list[int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of docs, extra columns left behind.

    rate of 100 documents are transformed, and of these spm_rate in 100 have their suffix first. Empty texts, null texts
    (which are empty ones) and texts that hold a marker are plain: their output is the text, their two lengths are null. A
    null id is seeded as an empty one. Repeated rows have equal results. An empty table gives no rows.
    """
    p, s, m = MARKERS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text, ends = row["text"], EliasFano(row["n"], row["low_bits"], row["low"], row["high"])
                never = not text or any(x in text for x in MARKERS)
                for first in range(0, len(row["ids"]), per := max(1, (1 << 20) // (len(text) + 1))):
                    ids, made = row["ids"][first : first + per], []
                    for doc_id in ids:
                        h = _numbers(seed, doc_id)
                        if never or h[2] % 100 >= rate:
                            made.append(("plain", None, None, text))
                            continue
                        a, b = sorted((h[0] % (ends.n + 1), h[1] % (ends.n + 1)))
                        a, b = (ends[k - 1] if k else 0 for k in (a, b))
                        form = "spm" if h[3] % 100 < spm_rate else "psm"
                        head = f"{s}{text[b:]}{p}{text[:a]}" if form == "spm" else f"{p}{text[:a]}{s}{text[b:]}"
                        made.append((form, a, b - a, f"{head}{m}{text[a:b]}"))
                    form, prefix, middle, output = zip(*made)
                    columns = [pa.array(ids, pa.int64()), pa.array([ends.n] * len(ids), pa.int64()), pa.array(form, pa.string())]
                    columns += [pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return index(docs, id_col, text_col).mapInArrow(cut, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that output was made of. Each marker stands once in it, since no part of a text makes one with a marker."""
    p, s, m = map(F.lit, MARKERS)

    def between(a: Column, b: Column) -> Column:
        return F.split_part(F.split_part(output, a, F.lit(2)), b, F.lit(1))

    middle = F.split_part(output, m, F.lit(2))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "spm", spm).when(form == "psm", F.concat(between(p, s), middle, between(s, m))).otherwise(output)
