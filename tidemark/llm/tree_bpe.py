"""BPE by tree concatenation: texts are halved, the halves are encoded on their own, and joined exactly.

A text is halved until its leaves are short, wherever the halves fall, and the tokenizers library
encodes every leaf (words that it has encoded before are remembered). Neighbours are then joined level by level. Around a join a window of the text is
encoded again. Where white space is near on either side, the window is the word between, and its tokens
take the place of those that both sides have there. Elsewhere the window grows until one token left of the join and one right of it, each clear of the join
by a margin, have the same id and the same characters as in the two sides. What lies outside these two
tokens is taken from the sides, what lies between them from the window.

Why that is exact: white space parts words, so the tokens of a text are those of its words one after the
other, in the sides, in the window and in the whole. For windows that grow, a sequence of tokens is the encoding of its text if every pair of neighbours is the
encoding of theirs, and each pair stands in the left side, in the window or in the right side. From a
token on which two encodings agree, the search for words goes on alike in both, since it looks only
ahead; the margin is longer than any special token. No side or window begins with a character that
normalisation could combine with the one before it.

Rows hold at most SEGMENT characters. A longer text comes as several rows, which any tasks encode, each
as a tree, and which meet by text for the last joins; the same join makes the whole.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import bounded_batches, free, stored
from tidemark.llm.token_units import LONGEST, TOGETHER, WordBpe, in_chunks, together

#: Characters of a leaf at most, but for characters that can't be parted.
LEAF = 1024
#: Characters of a row.
SEGMENT = 1 << 16
#: Characters on either side of a join in its first window.
REACH = 48
#: Words whose ids one worker remembers, and words whose tokens' places it remembers as well.
REMEMBERED, PLACED = 500_000, 60_000


def parts_well(c: str) -> bool:
    """Whether a text can be cut in front of c: normalisation never combines c with what is before it."""
    return c < "̀" or not ("ᄀ" <= c <= "ᇿ" or unicodedata.category(c)[0] == "M")


def char_ends(word: str) -> dict[int, int] | None:
    """Where the characters of word end, by where they end in the bytes of its normal form; None if the two don't go one for one."""
    low = word.lower()
    if len(low) != len(word) or not unicodedata.is_normalized("NFC", word):
        return None
    return dict(zip(accumulate((len(c.encode()) for c in low), initial=0), range(len(low) + 1)))


class Piece:
    """Encoded characters: ids, and where in the text each of them stands."""

    def __init__(self, ids, starts, ends):
        self.ids, self.starts, self.ends = ids, starts, ends

    def span(self, i: int) -> tuple[int, int]:
        return int(self.starts[i]), int(self.ends[i])

    def since(self, a: int, b: int, at: int) -> list[tuple[int, int, int]]:
        """Tokens (start, end, id) of [a, b) from the last one that starts before at on, or from a."""
        i = b
        while i > a and (i == b or self.starts[i] >= at):
            i -= 1
        return [(*self.span(j), int(self.ids[j])) for j in range(i, b)]

    def until(self, a: int, b: int, at: int) -> list[tuple[int, int, int]]:
        """Tokens of [a, b) up to the first one that ends after at, or to b."""
        i = a
        while i < b and (i == a or self.ends[i - 1] <= at):
            i += 1
        return [(*self.span(j), int(self.ids[j])) for j in range(a, i)]


class Leaf:
    """Encoded characters text[start:end], whose first and last tokens are placed in the text when asked for.

    White space parts words for the vocabulary, so the words at an end have the ids that they have alone.
    """

    def __init__(self, bpe: TreeBpe, text: str, start: int, end: int, ids: np.ndarray):
        self.bpe, self.text, self.ids, self.start, self.end = bpe, text, ids, start, end
        self.head: list[tuple[int, int, int]] = []
        self.tail: list[tuple[int, int, int]] = []
        self.head_end, self.tail_start = start, end

    def _grow_head(self) -> None:
        at = self.text.find(" ", self.head_end + REACH, self.end)
        at = at if at >= 0 else self.end
        self.head += self.bpe.placed(self.text, self.head_end, at)
        self.head_end = min(at + 1, self.end)

    def _grow_tail(self) -> None:
        at = self.text.rfind(" ", self.start, max(self.start, self.tail_start - REACH)) + 1 or self.start
        self.tail = self.bpe.placed(self.text, at, self.tail_start) + self.tail
        self.tail_start = max(at - 1, self.start)

    def span(self, i: int) -> tuple[int, int]:
        n = len(self.ids)
        while i >= len(self.head) and n - i > len(self.tail):
            self._grow_head() if 2 * i < n else self._grow_tail()
        return (self.head[i] if i < len(self.head) else self.tail[i - n])[:2]

    def since(self, a: int, b: int, at: int) -> list[tuple[int, int, int]]:
        n = len(self.ids)
        while len(self.tail) < n - a and (len(self.tail) <= n - b or self.tail[0][0] >= at):
            self._grow_tail()
        found = self.tail[max(0, len(self.tail) - (n - a)) : len(self.tail) - (n - b)]
        return found[max(0, bisect_left(found, (at,)) - 1) :]

    def until(self, a: int, b: int, at: int) -> list[tuple[int, int, int]]:
        while len(self.head) < b and (len(self.head) <= a or self.head[-1][1] <= at):
            self._grow_head()
        found = self.head[a:b]
        return found[: next((k for k, t in enumerate(found) if t[1] > at), len(found)) + 1]


class Node:
    """The encoding of text[start:end] alone, as runs (piece, first, end) of tokens."""

    __slots__ = ("start", "end", "runs")

    def __init__(self, start: int, end: int, runs: list):
        self.start, self.end, self.runs = start, end, [r for r in runs if r[1] < r[2]]

    def last(self, at: int) -> tuple[list, bool]:
        """Tokens (start, end, id, run, i) that start at or after at, in order, and whether they are all."""
        found = []
        for k in range(len(self.runs) - 1, -1, -1):
            piece, a, b = self.runs[k]
            tokens = piece.since(a, b, at)
            found[:0] = [(*t, k, i) for i, t in enumerate(tokens, b - len(tokens)) if t[0] >= at]
            if tokens[0][0] < at:
                return found, False
        return found, True

    def first(self, at: int) -> tuple[list, bool]:
        """Tokens that end at or before at, and whether they are all."""
        found = []
        for k, (piece, a, b) in enumerate(self.runs):
            tokens = piece.until(a, b, at)
            found += [(*t, k, i) for i, t in enumerate(tokens, a) if t[1] <= at]
            if tokens[-1][1] > at:
                return found, False
        return found, True

    def without_last(self, n: int) -> list:
        """The runs but for the last n tokens."""
        runs = list(self.runs)
        while n:
            piece, a, b = runs.pop()
            if b - a > n:
                runs.append((piece, a, b - n))
            n -= min(n, b - a)
        return runs

    def without_first(self, n: int) -> list:
        """The runs but for the first n tokens."""
        k = 0
        while n and n >= self.runs[k][2] - self.runs[k][1]:
            n -= self.runs[k][2] - self.runs[k][1]
            k += 1
        if not n:
            return self.runs[k:]
        piece, a, b = self.runs[k]
        return [(piece, a + n, b), *self.runs[k + 1 :]]

    def ids(self) -> np.ndarray:
        return np.concatenate([np.empty(0, np.int32), *(np.asarray(p.ids[a:b], np.int32) for p, a, b in self.runs)])

    def piece(self) -> Piece:
        spans = np.array([p.span(i) for p, a, b in self.runs for i in range(a, b)], np.int64).reshape(-1, 2)
        return Piece(self.ids(), spans[:, 0], spans[:, 1])


def _unclear(tokens: list) -> set[int]:
    """Where characters start that are several tokens; such tokens are no proof of agreement."""
    starts = [t[0] for t in tokens]
    return set() if len(set(starts)) == len(starts) else {s for s, n in Counter(starts).items() if n > 1}


class TreeBpe(WordBpe):
    """Encodes whole texts as the library does with the vocabulary at path; one for each worker process."""

    def __init__(self, path: str):
        super().__init__(path, REMEMBERED)
        specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        if any(c in t for t in specials for c in " \n"):
            raise ValueError("special tokens with spaces are not supported")
        self.mark = specials[0] if specials else None
        self.margin = max([16, *map(len, specials)])
        self.leaves = self.joins = 0  # encoded and made so far
        self.older: dict[str, bytes] = {}  # words known before the last half of them
        self.spans: dict[str, list[tuple[int, int, int]]] = {}
        suffix = getattr(self.tok.model, "end_of_word_suffix", None) or ""
        words = (self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size()))
        self.sizes = [len(w.removesuffix(suffix)) for w in words]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of new words, TOGETHER of them in one string, with a special token between any two."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        if self.mark is None:
            return self._encode(words)
        mark, out = self.tok.token_to_id(self.mark), []
        for group, e in zip(groups, self.tok.encode_batch_fast([self.mark.join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            at = np.flatnonzero(ids == mark)
            if len(at) + 1 == len(group):
                blob, at = ids.tobytes(), (4 * at).tolist()
                out += [blob[a:b] for a, b in zip([0, *(a + 4 for a in at)], [*at, len(blob)])]
            else:
                out += self._encode(group)
        return out

    def __call__(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """As in WordBpe; since white space parts words wherever it stands, every word is learned once, at ends as well, and a line's end is a space."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return []
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        sizes = lists.value_lengths().to_numpy()
        return together(words.indices.to_numpy(), self._of(words.dictionary.to_pylist()), np.cumsum(sizes) - sizes)

    def _of(self, words: list[str]) -> list[bytes]:
        """As in WordBpe; half of what is remembered is forgotten at a time, and words that came again since are kept."""
        if len(self.known) > self.remembered // 2:
            self.older, self.known = self.known, {}
        out = list(map(self.known.get, words))
        missing = [i for i, b in enumerate(out) if b is None]
        new = []
        for i in missing:
            b = out[i] = self.older.get(words[i])
            if b is None:
                new.append(i)
            else:
                self.known[words[i]] = b
        for i, b in zip(new, self._learn([words[i] for i in new])):
            out[i] = b
            if len(words[i]) <= LONGEST:
                self.known[words[i]] = b
        return out

    def _spans(self, word: str) -> list[tuple[int, int, int]]:
        e = self.tok.encode(word, add_special_tokens=False)
        return [(a, b, i) for (a, b), i in zip(e.offsets, e.ids)]

    def _plain_spans(self, word: str) -> list[tuple[int, int, int]]:
        """As _spans, of a known word whose characters stand one for one in its tokens, each whole in one of them."""
        ids = self.known.get(word) or self.older.get(word)
        if ids is None:
            return self._spans(word)
        found, at, sizes = [], 0, self.sizes
        for i in memoryview(ids).cast("I"):
            found.append((at, at := at + sizes[i], i))
        if word.isascii():
            return found if at == len(word) else self._spans(word)
        ends = char_ends(word)
        if ends is None or at not in ends or ends[at] != len(word) or any(e not in ends for _, e, _ in found):
            return self._spans(word)
        return [(ends[a], ends[b], i) for a, b, i in found]

    def placed(self, text: str, first: int, end: int) -> list[tuple[int, int, int]]:
        """(start, end, id) of the tokens of text[first:end] alone."""
        out, at = [], first
        for word in text[first:end].replace("\n", " ").split(" "):
            found = self.spans.get(word)
            if found is None:
                found = self._plain_spans(word)
                if len(word) <= LONGEST:
                    if len(self.spans) >= PLACED:
                        self.spans.clear()
                    self.spans[word] = found
            out += [(at + a, at + b, i) for a, b, i in found]
            at += len(word) + 1
        return out

    @cached_property
    def strings(self) -> list[str]:
        """What each token decodes to on its own."""
        return [self.tok.decode([i], skip_special_tokens=False) for i in range(self.tok.get_vocab_size())]

    def decode(self, ids: list[int]) -> str:
        if self.tok.decoder is None:  # then a text is its tokens' strings with spaces between
            return " ".join(map(self.strings.__getitem__, ids))
        return self.tok.decode(ids, skip_special_tokens=False)

    def trees(self, texts: list[str], leaf: int = LEAF) -> list[Node]:
        """The encoding of every text, from its leaves up; one level of all texts at a time."""
        cuts = [halves(t, leaf) for t in texts]
        flat = [(t, a, b) for t, c in zip(texts, cuts) for a, b in zip(c, c[1:])]
        encoded = iter([Leaf(self, t, a, b, ids) for (t, a, b), ids in zip(flat, self([t[a:b] for t, a, b in flat]))])
        self.leaves += len(flat)
        levels = [[Node(a, b, [(x := next(encoded), 0, len(x.ids))]) for a, b in zip(c, c[1:])] for c in cuts]
        return self.joined(texts, levels)

    def joined(self, texts: list[str], levels: list[list[Node]]) -> list[Node]:
        """One node for each text, from neighbouring nodes that cover it; one level of all texts at a time."""
        while pairs := [(t, a, b) for t, nodes in zip(texts, levels) for a, b in zip(nodes[::2], nodes[1::2])]:
            made = iter(self.join(pairs))
            levels = [[*islice(made, len(nodes) // 2), *(nodes[-1:] if len(nodes) % 2 else [])] for nodes in levels]
        return [nodes[0] if nodes else Node(0, 0, []) for nodes in levels]

    def join(self, pairs: list[tuple[str, Node, Node]]) -> list[Node]:
        """The encodings of pairs (text, node, its neighbour) together."""
        self.joins += len(pairs)
        words = [word_at(t, a, b) for t, a, b in pairs]
        cut = [w and (t[w[0] : a.end], t[b.start : w[1]], t[slice(*w)]) for (t, a, b), w in zip(pairs, words)]
        asked = list({x: None for three in cut if three for x in three})
        known = dict(zip(asked, self._of(asked)))
        return [self._at_word(*p, w, *map(known.get, three)) if w else self._at_window(*p) for p, w, three in zip(pairs, words, cut)]

    def _at_word(self, text: str, a: Node, b: Node, word: tuple[int, int], left: bytes | None, right: bytes | None, whole: bytes) -> Node:
        """a and b joined with the ids of the word that they meet in, in the place of its parts'."""
        if left is None or right is None:  # the join stands at white space
            return Node(a.start, b.end, [*a.runs, *b.runs])
        ids = np.frombuffer(whole, np.uint32)
        made = Leaf(self, text, *word, ids)
        return Node(a.start, b.end, [*a.without_last(len(left) // 4), (made, 0, len(ids)), *b.without_first(len(right) // 4)])

    def _at_window(self, text: str, a: Node, b: Node) -> Node:
        """a and b joined where their tokens and those of a window agree."""
        made, reach = None, REACH
        while made is None:
            window = self._window(text, a, b, reach)
            made = window and self._agreed(a, b, window, self.placed(text, *window[:2]))
            reach *= 2
        return made

    def _window(self, text: str, a: Node, b: Node, reach: int):
        """(first character, end, tokens of a in it, all of a?, tokens of b in it, all of b?), or None if it has no good ends."""
        left, all_left = a.last(a.end - reach)
        right, all_right = b.first(b.start + reach)
        first, end = a.start, b.end
        if not all_left:
            left = left[next((k for k, t in enumerate(left) if parts_well(text[t[0]])), len(left)) :]
            first = left[0][0] if left else -1
        if not all_right:
            n = next((k for k in range(len(right), 0, -1) if right[k - 1][1] == len(text) or parts_well(text[right[k - 1][1]])), 0)
            right = right[:n]
            end = right[-1][1] if right else -1
        return None if first < 0 or end < 0 else (first, end, left, all_left, right, all_right)

    def _agreed(self, a: Node, b: Node, window, new: list[tuple[int, int, int]]) -> Node | None:
        _, _, left, all_left, right, all_right = window
        unclear = _unclear(new) | _unclear(left) | _unclear(right)
        at = dict(zip(new, range(len(new))))
        runs_a, runs_b, i, j = [], [], -1, len(new) - 1
        if not all_left:
            t = next((t for t in left if t[1] <= a.end - self.margin and t[0] not in unclear and t[:3] in at), None)
            if t is None:
                return None
            i = at[t[:3]]
            piece, x, _ = a.runs[t[3]]
            runs_a = [*a.runs[: t[3]], (piece, x, t[4] + 1)]
        if not all_right:
            t = next((t for t in right if t[0] >= b.start + self.margin and t[0] not in unclear and t[:3] in at), None)
            if t is None:
                return None
            j = at[t[:3]]
            piece, _, y = b.runs[t[3]]
            runs_b = [(piece, t[4] + 1, y), *b.runs[t[3] + 1 :]]
        kept = new[i + 1 : j + 1]
        starts, ends, ids = zip(*kept) if kept else ((), (), ())
        return Node(a.start, b.end, [*runs_a, (Piece(ids, starts, ends), 0, len(ids)), *runs_b])


def word_at(text: str, a: Node, b: Node) -> tuple[int, int] | None:
    """Where the word that a and b meet in begins and ends, or None if white space is farther than REACH."""
    low, high = max(a.start, a.end - REACH), min(b.end, b.start + REACH)
    first = max(text.rfind(" ", low, a.end), text.rfind("\n", low, a.end)) + 1
    end = min((x for x in (text.find(" ", b.start, high), text.find("\n", b.start, high)) if x >= 0), default=-1)
    if not first and low > a.start or end < 0 and high < b.end:
        return None
    return first or a.start, end if end >= 0 else b.end


def halves(text: str, leaf: int) -> list[int]:
    """Where the leaves of text begin, and its end: halves of halves until none is longer than leaf."""
    if not text:
        return [0]
    count = 1
    while count * leaf < len(text):
        count *= 2
    cuts = [0]
    for k in range(1, count):
        at = len(text) * k // count
        while at < len(text) and not parts_well(text[at]):
            at += 1
        if cuts[-1] < at < len(text):
            cuts.append(at)
    return [*cuts, len(text)]


_made: dict[str, TreeBpe] = {}


def tree_bpe(path: str) -> TreeBpe:
    if path not in _made:
        _made[path] = TreeBpe(path)
    return _made[path]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, np.int32)]).astype(np.int32)))


_ENCODED = "struct<ids:array<int>,back:string>"


def _result(bpe: TreeBpe, nodes: list[Node], decode: bool) -> pa.StructArray:
    ids = [n.ids() for n in nodes]
    back = pa.array([bpe.decode(x.tolist()) if decode else None for x in ids], pa.string())
    return pa.StructArray.from_arrays([_lists(ids), back], ["ids", "back"])


def _from_segments(rows: DataFrame, vocabulary: str, decode: bool) -> DataFrame:
    """(key, made) of texts that come in segments rows(key, i, s): encoded wherever a segment is, then joined by key."""

    @F.arrow_udf("struct<ids:array<int>,starts:array<int>,ends:array<int>>")
    def trees(s: pa.Array) -> pa.Array:
        pieces = [n.piece() for n in tree_bpe(vocabulary).trees(s.to_pylist())]
        return pa.StructArray.from_arrays([_lists([getattr(p, c) for p in pieces]) for c in ("ids", "starts", "ends")], ["ids", "starts", "ends"])

    def whole(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        bpe, parts, at, nodes = tree_bpe(vocabulary), table["s"].to_pylist(), 0, []
        for k, s in enumerate(parts):
            e = table["e"][k]
            ids, starts, ends = (e[c].values.to_numpy() for c in ("ids", "starts", "ends"))
            nodes.append(Node(at, at + len(s), [(Piece(ids, starts.astype(np.int64) + at, ends.astype(np.int64) + at), 0, len(ids))]))
            at += len(s)
        made = _result(bpe, bpe.joined(["".join(parts)], [nodes]), decode)
        return pa.table({"key": table["key"][:1], "made": made})

    return rows.repartition("key", "i").select("key", "i", "s", trees("s").alias("e")).groupBy("key").applyInArrow(whole, f"key string, made {_ENCODED}")


def encoded(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """docs with ids_col, the ids of every whole text as the tokenizers library gives them.

    decoded_col, if given, is what these ids decode to. Null and empty texts have no ids and decode to
    an empty text. Repeated rows have equal ids. Columns of these two names are replaced, others stay,
    whatever their names. Texts of more than one segment are joined by text, equal ones once. An empty
    table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    decode = decoded_col is not None

    @F.arrow_udf(_ENCODED)
    def single(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tree_bpe(vocabulary)
        for rows in in_chunks((pa.RecordBatch.from_arrays([t.cast(pa.string())], ["text"]) for t in texts)):
            yield _result(bpe, bpe.trees([t or "" for t in rows["text"].to_pylist()]), decode)
            pa.default_memory_pool().release_unused()

    text, size = F.coalesce(docs[text_col], F.lit("")), SEGMENT
    several = F.length(text) > size
    others = [c for c in docs.columns if c not in (ids_col, decoded_col)]
    key, made = free("key", docs.columns), free("made", docs.columns)

    def result(found: Column) -> list[Column]:
        return [found["ids"].alias(ids_col), *([found["back"].alias(decoded_col)] if decode else [])]

    @F.arrow_udf("array<string>")
    def segments(texts: pa.Array) -> pa.Array:
        return pa.array(([t[a:b] for c in (halves(t, size),) for a, b in zip(c, c[1:])] for t in texts.to_pylist()), pa.list_(pa.string()))

    short = docs.where(~several).withColumn(made, single(docs[text_col]))
    short = short.select(*[short[c] for c in others], *result(F.col(made)))
    held = docs.where(several).select(F.sha2(text, 256).alias("key"), text.alias("text")).dropDuplicates(["key"])
    rows = held.select("key", F.posexplode(segments("text")).alias("i", "s"))
    found = stored(_from_segments(rows, vocabulary, decode), "joined").select(F.col("key").alias(key), F.col("made").alias(made))
    long = docs.where(several).withColumn(key, F.sha2(text, 256)).join(found, key)
    return short.unionByName(long.select(*[long[c] for c in others], *result(F.col(made))))


def decoded(ids: Column, vocabulary: str) -> Column:
    """The text of ids as the library decodes them, special tokens included; null ids give an empty text."""

    @F.arrow_udf("string")
    def of(ids: pa.Array) -> pa.Array:
        bpe = tree_bpe(vocabulary)
        return pa.array([bpe.decode(x or []) for x in ids.to_pylist()], pa.string())

    return of(ids)
