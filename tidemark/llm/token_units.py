"""Byte-level BPE of whole texts by the tokenizers library, with a bounded memory of words.

The vocabulary's pattern never lets a token hold a space after other characters, so a text can be cut
before every single space that stands between two characters that are not white space, and its ids are
those of the parts one after the other. Parts repeat, and their ids are remembered.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts remembered by one worker, some 100 MB; when they are more, it forgets all and starts again.
REMEMBERED = 500_000
#: Characters of the longest part that is remembered.
LONGEST = 64

#: New parts that are encoded as one string.
TOGETHER = 200

_BLANK = {"", *filter(str.isspace, map(chr, range(0x3001)))}
_first, _last = itemgetter(slice(0, 1)), itemgetter(slice(-1, None))
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"
#: A single space next to white space or an end, in RE2: such texts are cut by _CUT.
_UNSAFE = rf"(?:^|{_SPACE}) | (?:{_SPACE}|$)"


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def together(of: np.ndarray, blobs: list[bytes], first: np.ndarray) -> list[np.ndarray]:
    """The ids of each text, from the blob of each of its parts; first: where in of the parts of a text begin."""
    table = np.frombuffer(b"".join(blobs), np.uint32)
    lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    n = lengths[of]
    begins = (np.cumsum(lengths) - lengths)[of]
    ends = np.cumsum(n)
    ids = table[np.arange(ends[-1]) + np.repeat(begins - (ends - n), n)]
    return np.split(ids, ends[first[1:] - 1])


class WordBpe:
    """ids of whole texts; one for each worker process."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.known: dict[str, bytes] = {}
        self.remembered = remembered
        words = (self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size()))
        self.opens = np.array([w.startswith("\u0120") for w in words])  # tokens that begin with a space

    def _encode(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(parts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of parts that follow a space, TOGETHER of them in one string, since a space opens the first token of each."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        out: list[bytes] = []
        for group, e in zip(groups, self.tok.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(group) and not (set(map(_first, group)) | set(map(_last, group))) & _BLANK:
                blob, at = ids.tobytes(), (4 * at).tolist()
                out += [blob[a:b] for a, b in zip(at, [*at[1:], len(blob)])]
            else:
                out += self._encode([" " + w for w in group])
        return out

    def _of(self, words: list[str]) -> list[bytes]:
        """Ids of parts that follow a space, from memory where they are known."""
        if len(self.known) > self.remembered:
            self.known.clear()
        out = list(map(self.known.get, words))
        new = [i for i, b in enumerate(out) if b is None]
        for i, b in zip(new, self._learn([words[i] for i in new])):
            out[i] = b
            if len(words[i]) <= LONGEST:
                self.known[words[i]] = b
        return out

    def _plain(self, text: str) -> np.ndarray:
        parts = _CUT.split(text)
        return np.frombuffer(b"".join(self._encode(parts[:1]) + self._of(parts[1:])), np.uint32)

    def __call__(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """One array of unsigned 32-bit ids for each text; null and empty texts have none."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return []
        lists = pc.split_pattern(texts, " ")
        flat = lists.flatten().dictionary_encode()
        sizes = lists.value_lengths().to_numpy()
        first = np.cumsum(sizes) - sizes
        heads = pc.take(flat.dictionary, flat.indices.take(pa.array(first))).to_pylist()
        blobs = self._of(flat.dictionary.to_pylist()) + self._encode(heads)
        of = flat.indices.to_numpy().copy()
        of[first] = len(flat.dictionary) + np.arange(len(heads))
        out = together(of, blobs, first)
        for i in np.flatnonzero(pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)):
            out[i] = self._plain(texts[int(i)].as_py())
        return out


def in_chunks(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.Table]:
    """The rows of batches in tables that end once their text column has so many bytes: many words repeat in one."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += pc.sum(pc.binary_length(batch["text"])).as_py() or 0
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


_loaded: dict[tuple[str, int], WordBpe] = {}


def word_bpe(path: str, remembered: int = REMEMBERED) -> WordBpe:
    """This process's encoder for the vocabulary at path."""
    if (path, remembered) not in _loaded:
        _loaded[path, remembered] = WordBpe(path, remembered)
    return _loaded[path, remembered]
