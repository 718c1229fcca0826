"""Token counts of every prefix of a text under a sentencepiece BPE model, stored to be asked later.

A token sequence is what the model gives if and only if every two neighbours are what it gives for the text of the two.
So the tokens of a prefix are those of a shorter prefix and one more, and the one that fits is found from the ends of
shorter prefixes: a dynamic program over positions, one count for each. No token of the model continues from another
character into a space, so the program begins anew at every such space, and words that repeat are looked up.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, stored, texts
from tidemark.llm.token_units import in_chunks

#: The model's character for a space.
SPACE = "▁"
#: Words, and pairs of pieces, remembered by one worker; when they are more, it forgets all and starts again.
REMEMBERED, PAIRS = 600_000, 600_000
#: Characters of the longest word that is remembered.
LONGEST = 64
#: Code points between two absolute counts of a stored text.
STEP = 1024

_UNITS = re.compile(f"(?<=[^{SPACE}])(?={SPACE})")
#: Texts in which spaces meet, or begin the text, or are written as the model's own character.
_UNSAFE = f"  |^ |{SPACE}"


class PrefixCounts:
    """Counts for one model; one object for each worker process."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        plain = spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
        own = {kinds.USER_DEFINED, kinds.UNUSED} & {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or not plain or own or any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError(f"{path} is not a plain BPE model with bytes for unknown characters")
        #: Every end of a piece, and whether it is a piece.
        self.tails = {p[i:]: False for p in self.score for i in range(len(p))} | dict.fromkeys(self.score, True)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.remembered = remembered

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by the model's rule: the best pair first, the leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, a: str, b: str) -> bool:
        """Whether the model gives the pieces a and b for the text of the two; a may be empty."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        found = self.pairs[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return found

    def changes(self, units: list[str]) -> Iterator[array]:
        """For each unit how the number of tokens changes at each of its characters.

        Units begin where no token reaches over. Positions that a unit shares with the one before it are kept, so sorted ones
        take the fewest steps.
        """
        tails, pairs, fits, before = self.tails, self.pairs, self.fits, ""
        last, n, steps = [""], [0], array("i")  # the last token of each prefix, its count, and the differences of counts
        for unit in units:
            same = 0
            for x, y in zip(unit, before):
                if x != y:
                    break
                same += 1
            del last[same + 1 :], n[same + 1 :], steps[same:]
            for end in range(same + 1, len(unit) + 1):
                for start in range(end - 2, -1, -1):
                    piece = unit[start:end]
                    known = tails.get(piece)
                    if known is None:  # no piece ends so
                        start = -1
                        break
                    if known and (fit := pairs.get((last[start], piece))) is not False and (fit or fits(last[start], piece)):
                        break
                else:
                    start = -1
                if start < 0:
                    start, piece = end - 1, unit[end - 1]
                last.append(piece)
                n.append(n[start] + (1 if tails.get(piece) else len(piece.encode())))
                steps.append(n[end] - n[end - 1])
            before = unit
            yield steps

    def _of(self, words: list[str]) -> list[bytes]:
        """Changes of the count at every character of words that follow a space, the space included."""
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        out = list(map(known.get, words))
        new = sorted((w, i) for i, (w, found) in enumerate(zip(words, out)) if found is None)
        for (w, i), steps in zip(new, self.changes([SPACE + w for w, _ in new])):
            out[i] = found = steps.tobytes()
            if len(w) <= LONGEST:
                known[w] = found
        return out

    def __call__(self, rows: pa.Array | list[str]) -> list[np.ndarray]:
        """For each text the change of the count at each of its code points; the sum of the first k is the count of that prefix."""
        rows = pc.fill_null(rows if isinstance(rows, pa.Array) else pa.array(rows, pa.string()), "")
        if not len(rows):
            return []
        lists = pc.split_pattern(rows, " ")
        flat = lists.flatten().dictionary_encode()
        blobs = self._of(flat.dictionary.to_pylist())
        of = flat.indices.to_numpy()
        table = np.frombuffer(b"".join(blobs), np.int32)
        lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        n, begins = lengths[of], (np.cumsum(lengths) - lengths)[of]
        ends = np.cumsum(n)
        every = table[np.arange(ends[-1]) + np.repeat(begins - (ends - n), n)]
        out = np.split(every, ends[np.cumsum(lists.value_lengths().to_numpy())[:-1] - 1])
        for i in np.flatnonzero(pc.match_substring_regex(rows, _UNSAFE).to_numpy(zero_copy_only=False)):
            units = _UNITS.split(SPACE + rows[int(i)].as_py().replace(" ", SPACE))
            out[i] = np.concatenate([np.array(x, np.int32) for x in self.changes(units)])
        for i, x in enumerate(out):
            out[i] = x[1:]  # the space before the text is not its own, but counts from its first character on
            if len(x) > 1:
                out[i] = np.r_[x[0] + x[1], x[2:]]
        return out


_loaded: dict[str, PrefixCounts] = {}


def prefix_counts(path: str) -> PrefixCounts:
    """This process's counter for the model at path."""
    if path not in _loaded:
        _loaded[path] = PrefixCounts(path)
    return _loaded[path]


def _packed(x: np.ndarray) -> bytes:
    """One byte for each change, or four where one is too large."""
    return x.astype(np.int8 if not len(x) or -128 <= x.min() <= x.max() < 128 else "<i4").tobytes()


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, np.int8 if len(blob) == n else "<i4")


def count_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_chars, marks, changes), one row per row of docs, stored in the shared folder.

    changes has how the count changes at each code point, marks the count at every STEPth one. Null texts are empty ones, with
    no marks; repeated rows and null ids are kept; an empty table gives no rows. Extra columns are left behind.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chars", pa.int64()), ("marks", pa.list_(pa.int64())), ("changes", pa.binary())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_chunks(batches, 2 << 20):
            found = prefix_counts(path)(rows["text"].combine_chunks())
            marks = [np.cumsum(x, dtype=np.int64)[STEP - 1 :: STEP] for x in found]
            lengths = pc.cast(pc.binary_length(rows["text"]), pa.int64()).combine_chunks()
            columns = [rows["doc_id"].combine_chunks(), lengths, pa.array(map(len, found), pa.int64()), pa.array(marks, pa.list_(pa.int64())), pa.array(map(_packed, found), pa.binary())]
            yield from pa.Table.from_arrays(columns, schema=schema).to_batches(256)

    return stored(texts(docs, id_col, text_col).mapInArrow(counted, "doc_id long, n_bytes long, n_chars long, marks array<long>, changes binary"), "counts")


def count_at(marks: list[int], changes: bytes, n_chars: int, position: int) -> int:
    """The tokens of the first position code points: an absolute count before it, and fewer than STEP changes."""
    position = min(max(position, 0), n_chars)
    k = position // STEP
    width = 1 if len(changes) == n_chars else 4
    rest = changes[k * STEP * width : position * width]
    return (int(marks[k - 1]) if k else 0) + int(_unpacked(rest, position - k * STEP).sum())


def longest_within(changes: bytes, n_chars: int, budget: int) -> int:
    """Code points of the longest prefix of at most budget tokens; a longer prefix can have fewer tokens than a shorter one."""
    fits = np.flatnonzero(np.cumsum(_unpacked(changes, n_chars), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def counts_at(table: DataFrame, positions: DataFrame) -> DataFrame:
    """(doc_id, position, n_tokens) for rows of positions(doc_id, position), from the stored table alone.

    Positions below zero count as zero, those past the end as the end; null ids or positions, and ids not there, give none.
    """

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            n = [count_at(r["marks"], r["changes"], r["n_chars"], r["position"]) for r in rows]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["position"], pa.array(n, pa.int64())], ["doc_id", "position", "n_tokens"])

    asks = positions.where("position is not null").select(F.col("doc_id").cast("long"), F.col("position").cast("long"))
    return table.join(asks, "doc_id").select("doc_id", "position", "n_chars", "marks", "changes").mapInArrow(asked, "doc_id long, position long, n_tokens long")


def answers(table: DataFrame, budget: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, chars_within): whole counts, and the longest prefix within a budget of tokens."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            n = [count_at(r["marks"], r["changes"], r["n_chars"], r["n_chars"]) for r in rows]
            within = [longest_within(r["changes"], r["n_chars"], budget) for r in rows]
            columns = [batch["doc_id"], batch["n_bytes"], pa.array(n, pa.int64()), pa.array([x > budget for x in n], pa.bool_()), pa.array(within, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit", "chars_within"])

    return table.mapInArrow(asked, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_within long")
