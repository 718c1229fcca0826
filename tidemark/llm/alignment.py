"""Alignment of two tokenizers over a corpus: groups of tokens with common ends, links in them, and how common each link is.

Ids of the first vocabulary are dealt into stripes. A stripe's pairs of ids are counted in a dense matrix, its rows the
ids of the stripe and its columns the second vocabulary; row maxima say which partner is an id's best. Links are kept in
chunks of documents, by stripe, and meet the matrix of their stripe where they are partitioned as it was counted. A stripe
with very many links is several partitions. Only sums for each document leave it.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, stored, texts
from tidemark.llm.token_units import _CUT, _UNSAFE, WordBpe, in_chunks

#: Stripes of the first vocabulary.
STRIPES = 512
#: Links of one stripe, summed up by document, that one partition counts or scores.
LINKS = 4 << 20
#: Bytes of text and rows in one chunk.
CHUNK, ROWS = 2 << 20, 20_000
#: Words that a worker remembers, and characters of the longest.
REMEMBERED, LONGEST = 350_000, 64
#: A pair of ids is a number: the first id times this and the second.
_PAIR = 1 << 16
SPACE = "▁"


def byte_table(tok) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary, in which printable characters stand for themselves and others for the rest."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    out = []
    for i in range(tok.get_vocab_size()):
        entry = tok.id_to_token(i) or ""
        out.append(bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode())
    return out


def piece_table(model) -> list[bytes]:
    """The bytes of each piece of a sentencepiece model."""
    pieces = ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in pieces]


class Unit(NamedTuple):
    """A piece of text that both tokenizers treat alone: its groups as text, its numbers of tokens and groups, its links."""

    groups: str
    n: tuple[int, int, int]
    pairs: bytes
    times: bytes


#: The most links that the units of one batch are expanded to at once; a unit with more is taken by itself.
AT_ONCE = 1 << 20


class Aligner:
    """Groups and links of texts; one object for each worker process."""

    def __init__(self, first: str, second: str, remembered: int = REMEMBERED):
        from sentencepiece import SentencePieceProcessor

        self.words, self.b = WordBpe(first, 0), SentencePieceProcessor(model_file=second)
        self.words.tok.encode_special_tokens = True
        self.bytes_a, self.bytes_b = byte_table(self.words.tok), piece_table(self.b)
        if max(len(self.bytes_a), len(self.bytes_b)) > _PAIR:
            raise ValueError(f"ids must be below {_PAIR}")
        if any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(self.b.get_piece_size())):
            raise ValueError(f"{second} has pieces that hold a space after other characters")
        self.size_a, self.size_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.bytes_a, self.bytes_b))
        #: Each id as it is written inside a side of a group, and at its end.
        self.said_a, self.said_b = (np.array([[f"{i},", f"{i}{end}"] for i in range(len(t))], object) for t, end in ((self.bytes_a, "|"), (self.bytes_b, ";")))
        self.known: dict[str, Unit | None] = {}
        self.remembered = remembered

    def _gives_back(self, text: str, a: np.ndarray, b: list[int]) -> bool:
        whole = b" " + text.encode()
        return b"".join([self.bytes_a[i] for i in a.tolist()]) == whole and b"".join([self.bytes_b[i] for i in b]) == whole

    def aligned(self, texts: list[str]) -> list[Unit | None]:
        """The units of spaces and texts, or nothing where the tokens of either side don't give these bytes back.

        Texts stand one after the other: as both sides of each are equally long, ends of tokens that are equal all through
        are the ends of groups.
        """
        a = [np.frombuffer(x, np.uint32) for x in self.words._learn(texts)]
        b = self.b.encode(texts, num_threads=1)
        out: list[Unit | None] = [None] * len(texts)
        whole = b"".join([b" " + t.encode() for t in texts])
        flat_a, flat_b = np.concatenate(a).astype(np.int64), np.fromiter(chain.from_iterable(b), np.int64)
        here = range(len(texts))
        if b"".join(map(self.bytes_a.__getitem__, flat_a.tolist())) != whole or b"".join(map(self.bytes_b.__getitem__, flat_b.tolist())) != whole or len(b) != sum(map(bool, b)):
            here = [i for i in here if self._gives_back(texts[i], a[i], b[i])]
        batch, links = [], 0
        for i in here:
            n = len(a[i]) * len(b[i])
            if batch and links + n > AT_ONCE:
                self._fill(out, batch, a, b)
                batch, links = [], 0
            batch.append(i)
            links += n
        if batch:
            self._fill(out, batch, a, b)
        return out

    def _fill(self, out: list[Unit | None], batch: list[int], a: list[np.ndarray], b: list[list[int]]) -> None:
        n_a, n_b = (np.array([len(x[i]) for i in batch]) for x in (a, b))
        ids_a, ids_b = np.concatenate([a[i] for i in batch]).astype(np.int64), np.fromiter(chain.from_iterable(b[i] for i in batch), np.int64)
        _, i, j = np.intersect1d(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]), assume_unique=True, return_indices=True)
        end_a, end_b = i + 1, j + 1  # tokens of either side up to the end of each group
        size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        group_a, group_b = (np.repeat(np.arange(len(size)), size) for size in (size_a, size_b))
        # as text: the tokens of both sides in the order of their groups
        said = np.empty(len(ids_a) + len(ids_b), object)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[i], last_b[j] = 1, 1
        said[np.arange(len(ids_a)) + (end_b - size_b)[group_a]] = self.said_a[ids_a, last_a]
        said[np.arange(len(ids_b)) + end_a[group_b]] = self.said_b[ids_b, last_b]
        ends = np.cumsum(n_a)
        unit_of = np.searchsorted(ends, end_a)  # the unit of each group
        n_groups = np.bincount(unit_of, minlength=len(batch))
        if len(batch) == 1 and int((size_a * size_b).sum()) > AT_ONCE:
            pair, times = self._counted(ids_a, ids_b, end_a, end_b)
            size = np.array([len(pair)])
        else:
            n = size_b[group_a]
            stop = np.cumsum(n)
            right = ids_b[np.arange(stop[-1]) - np.repeat(stop - n - (end_b - size_b)[group_a], n)]
            key = np.repeat(unit_of[group_a], n) << 32 | np.repeat(ids_a, n) * _PAIR + right
            key, times = np.unique(key, return_counts=True)
            pair, size = key & 0xFFFFFFFF, np.bincount(key >> 32, minlength=len(batch))
        pairs, times = pair.astype(np.uint32).tobytes(), times.astype(np.int32).tobytes()
        words, stop = said.tolist(), np.cumsum(n_a + n_b).tolist()
        at = at_pair = 0
        for k, x, y, g, end, m in zip(batch, n_a.tolist(), n_b.tolist(), n_groups.tolist(), stop, size.tolist()):
            out[k] = Unit("".join(words[at:end])[:-1], (x, y, g), pairs[4 * at_pair : 4 * (at_pair + m)], times[4 * at_pair : 4 * (at_pair + m)])
            at, at_pair = end, at_pair + m

    def _counted(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and links of one unit with large groups, by the distinct ids of each group."""
        links: Counter = Counter()
        for i, x, j, y in zip([0, *end_a[:-1].tolist()], end_a.tolist(), [0, *end_b[:-1].tolist()], end_b.tolist()):
            right = Counter(b[j:y].tolist())
            for u, n in Counter(a[i:x].tolist()).items():
                for v, m in right.items():
                    links[u * _PAIR + v] += n * m
        pair = np.array(sorted(links), np.int64)
        return pair, np.array([links[p] for p in pair.tolist()], np.int64)

    def units(self, parts: list[str]) -> list[Unit | None]:
        """Units of parts that each follow a space, from memory where they are known."""
        if len(self.known) > self.remembered:
            self.known.clear()
        out = [self.known.get(p, 0) for p in parts]
        new = [i for i, u in enumerate(out) if u == 0]
        for k in range(0, len(new), 8192):
            some = new[k : k + 8192]
            for i, u in zip(some, self.aligned([parts[i] for i in some])):
                out[i] = u
                if len(parts[i]) <= LONGEST:
                    self.known[parts[i]] = u
        return out


def _split(rows: pa.Array) -> tuple[list[str], list[list[int]]]:
    """(parts, for each text which of them): texts cut before single spaces between other characters; empty texts have none."""
    lists = pc.split_pattern(rows, " ")
    flat = lists.flatten().dictionary_encode()
    parts, of = flat.dictionary.to_pylist(), flat.indices.to_pylist()
    ends = np.cumsum(lists.value_lengths().to_numpy()).tolist()
    out = [of[i:j] for i, j in zip([0, *ends[:-1]], ends)]
    unsafe = pc.match_substring_regex(rows, _UNSAFE).to_numpy(zero_copy_only=False)
    more: dict[str, int] = {}
    for i in np.flatnonzero(unsafe):
        out[i] = [more.setdefault(p, len(parts) + len(more)) for p in _CUT.split(rows[int(i)].as_py())]
    for i in np.flatnonzero(pc.equal(rows, "").to_numpy(zero_copy_only=False)):
        out[i] = []
    return [*parts, *more], out


def _used(of: list[list[int]], n: int) -> np.ndarray:
    used = np.zeros(n, bool)
    for x in of:
        used[x] = True
    return used


_NAMES = ("n_a", "n_b", "n_groups", "n_links")
_DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_SCHEMA = f"chunk long, stripe int, n long, pairs binary, docs_of binary, docs binary, times binary, digests array<struct<{_DIGEST.replace(' ', ': ').replace(',:', ',')}>>"


def _links(units: list[Unit | None], of: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, document, links), sorted by stripe, pair and document."""
    doc = np.repeat(np.arange(len(of)), [len(x) for x in of])
    unit = np.fromiter((u for x in of for u in x), np.int64, len(doc))
    seen, times = np.unique(doc * len(units) + unit, return_counts=True)
    doc, unit = seen // max(1, len(units)), seen % max(1, len(units))
    size = np.array([len(u.pairs) // 4 if u else 0 for u in units], np.int64)
    flat = np.frombuffer(b"".join([u.pairs for u in units if u]), np.uint32)
    links = np.frombuffer(b"".join([u.times for u in units if u]), np.int32).astype(np.int64)
    n = size[unit]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat((np.cumsum(size) - size)[unit] - (ends - n), n)
    pair, doc, links = flat[at].astype(np.int64), np.repeat(doc, n), links[at] * np.repeat(times, n)
    # one number sorts by stripe, pair and document
    key = ((pair // _PAIR % STRIPES) << 48 | pair << 16) + 0
    order = np.lexsort((doc, key))
    pair, doc, links = pair[order], doc[order], links[order]
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])]) if len(pair) else np.empty(0, np.int64)
    return pair[first], doc[first], np.add.reduceat(links, first) if len(first) else links


def _chunks(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Rows of chunks: one with the digests of its documents (stripe -1), and one for each stripe with its links.

    pairs has the stripe's distinct pairs of ids, docs_of how many documents of the chunk hold each, docs which, and times
    how many links each of these has.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        schema = pa.schema([("chunk", pa.int64()), ("stripe", pa.int32()), ("n", pa.int64()), *((c, pa.binary()) for c in ("pairs", "docs_of", "docs", "times")), ("digests", digest)])
        for whole in in_chunks(batches, CHUNK):
            for k in range(0, len(whole), ROWS):
                rows = whole.slice(k, ROWS).combine_chunks()
                aligner = _aligner(first, second)
                parts, of = _split(rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string()))
                used = _used(of, len(parts))
                units: list[Unit | None] = [None] * len(parts)
                wanted = np.flatnonzero(used).tolist()
                for i, u in zip(wanted, aligner.units([parts[i] for i in wanted])):
                    units[i] = u
                of = [[] if any(units[u] is None for u in x) else x for x in of]
                pair, doc, times = _links(units, of)
                n_links = np.bincount(doc, times, len(of)).astype(np.int64)
                digests = []
                sizes = np.array([u.n if u else (0, 0, 0) for u in units] or np.zeros((0, 3)), np.int64)
                for name, x, links in zip(rows["doc_id"].to_pylist(), of, n_links.tolist()):
                    n = sizes[x].sum(axis=0).tolist() if x else [0, 0, 0]
                    said = hashlib.sha256(";".join([units[u].groups for u in x]).encode()).hexdigest() if x else ""
                    digests.append({"doc_id": name, "n_a": n[0], "n_b": n[1], "n_groups": n[2], "n_links": links, "groups_sha256": said})
                made = [(chunk, -1, len(of), None, None, None, None, digests)]
                stripe = pair // _PAIR % STRIPES
                cut = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1], True]) if len(pair) else np.zeros(1, np.int64)
                for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    p, size = np.unique(pair[i:j], return_counts=True)
                    blobs = (x.tobytes() for x in (p.astype("<u4"), size.astype("<u4"), doc[i:j].astype("<u2"), times[i:j].astype("<u2" if times[i:j].max() < _PAIR else "<i8")))
                    made.append((chunk, int(stripe[i]), j - i, *blobs, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)
                chunk += 1
            pa.default_memory_pool().release_unused()

    digest = pa.list_(pa.struct([("doc_id", pa.int64()), *((c, pa.int64()) for c in _NAMES), ("groups_sha256", pa.string())]))
    return docs.mapInArrow(encode, _SCHEMA)


_loaded: dict[tuple[str, str], Aligner] = {}


def _aligner(first: str, second: str) -> Aligner:
    if (first, second) not in _loaded:
        _loaded[first, second] = Aligner(first, second)
    return _loaded[first, second]


class Block:
    """The dense matrix of a stripe: documents with each pair, an id's row being its place among those of the stripe."""

    def __init__(self, n_first: int, n_second: int):
        self.counts = np.zeros((-(-n_first // STRIPES), n_second), np.int64)
        self.used = np.zeros(len(self.counts), bool)

    def add(self, pairs: pa.RecordBatch | pa.Table) -> None:
        for p, n in zip(pairs["pairs"].to_pylist(), pairs["docs_of"].to_pylist()):
            p = np.frombuffer(p, "<u4").astype(np.int64)
            row = p // _PAIR // STRIPES
            np.add.at(self.counts, (row, p % _PAIR), np.frombuffer(n, "<u4" if len(n) == 4 * len(p) else "<i8").astype(np.int64))
            self.used[row] = True

    def pairs(self, stripe: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that any document has, and in how many."""
        rows = np.flatnonzero(self.used)
        counts = self.counts[rows]
        row, column = np.nonzero(counts)
        return (rows[row] * STRIPES + stripe) * _PAIR + column, counts[row, column]

    def best(self) -> np.ndarray:
        """The largest count of each row."""
        out, rows = np.zeros(len(self.counts), np.int64), np.flatnonzero(self.used)
        out[rows] = self.counts[rows].max(axis=1)
        return out


def pair_counts(links: DataFrame, n_first: int, n_second: int) -> DataFrame:
    """(stripe, pairs, docs_of): the documents with each pair of ids that any has, counted by partition, then by stripe."""

    def counted(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(n_first, n_second)
        for batch in batches:
            block.add(batch)
        pairs, n = block.pairs(key[0].as_py())
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (pairs.astype("<u4"), n.astype("<i8"))]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *blobs], ["stripe", "pairs", "docs_of"])

    schema = "stripe int, pairs binary, docs_of binary"
    parts = links.select("stripe", "part", "pairs", "docs_of").groupBy("stripe", "part").applyInArrow(counted, schema)
    return parts.groupBy("stripe").applyInArrow(counted, schema)


def aligned(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of docs.

    first is a byte-level vocabulary that encodes a space and the text, second a sentencepiece model that puts the space there
    itself. Null and empty texts, and those that either side doesn't give back byte for byte, have no tokens: zeros and an
    empty string. Repeated rows count as documents of their own, null ids as others; extra columns are left behind. Equal
    counts of one id are all its highest. An empty table gives no rows.
    """
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    bounded_batches(spark)
    sizes = Tokenizer.from_file(first).get_vocab_size(), SentencePieceProcessor(model_file=second).get_piece_size()
    table = stored(_chunks(texts(docs, id_col, text_col), first, second), "links")
    links = table.where("stripe >= 0").drop("digests")
    parts = links.groupBy("stripe").agg(F.ceil(F.sum("n") / LINKS).cast("int").alias("parts"))  # a row for each stripe at most
    links = links.join(F.broadcast(parts), "stripe").withColumn("part", F.pmod(F.xxhash64("chunk"), "parts").cast("int")).drop("parts")
    counts = pair_counts(links, *sizes).join(F.broadcast(parts), "stripe").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def scored(key: tuple[pa.Scalar, ...], links: pa.Table, counts: pa.Table) -> pa.Table:
        block = Block(*sizes)
        block.add(counts)
        best, out = block.best(), []
        for row in links.select(["chunk", "pairs", "docs_of", "docs", "times"]).to_pylist():
            p, of = np.frombuffer(row["pairs"], "<u4").astype(np.int64), np.frombuffer(row["docs_of"], "<u4")
            doc = np.frombuffer(row["docs"], "<u2")
            times = np.frombuffer(row["times"], "<u2" if len(row["times"]) == len(row["docs"]) else "<i8").astype(np.int64)
            line = p // _PAIR // STRIPES
            count = block.counts[line, p % _PAIR]
            named, at = np.unique(doc, return_inverse=True)
            sums = np.zeros((2, len(named)), np.int64)
            np.add.at(sums[0], at, times * np.repeat(count == best[line], of))
            np.add.at(sums[1], at, times * np.repeat(count, of))
            out.append((row["chunk"], named.astype("<u2").tobytes(), sums.tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else ((), (), ()), (pa.int64(), pa.binary(), pa.binary()))], ["chunk", "docs", "sums"])

    left = links.groupBy("stripe", "part")
    sums = left.cogroup(counts.groupBy("stripe", "part")).applyInArrow(scored, "chunk long, docs binary, sums binary")

    def summed(digests: pa.Table, sums: pa.Table) -> pa.Table:
        if not len(digests):
            return result.empty_table()
        rows = digests["digests"].combine_chunks().flatten()
        total = np.zeros((2, len(rows)), np.int64)
        for docs, values in zip(sums["docs"].to_pylist(), sums["sums"].to_pylist()):
            docs = np.frombuffer(docs, "<u2")
            total[:, docs] += np.frombuffer(values, np.int64).reshape(2, len(docs))
        columns = dict(zip(rows.type.names, rows.flatten())) | {"n_best": pa.array(total[0]), "count_sum": pa.array(total[1])}
        return pa.table([columns[c] for c in result.names], result)

    result = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (*_NAMES, "n_best", "count_sum")), ("groups_sha256", pa.string())])
    digests = table.where("stripe < 0").select("chunk", "digests")
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return digests.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(summed, out)
