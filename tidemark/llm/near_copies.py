"""SimHash near-dedup by the Jaccard similarity of word shingles, verified exactly.

Texts with equal sets of shingles are one class. Each class has a SimHash of its shingles; classes that
meet under its deletion-variant signatures are candidates. But two texts at a similarity of 0.8 differ in
some ten of 64 bits, where no few segments are left with at most one, so every class has BANDS keys of
ROWS minima of the same hashes as well, and classes that share a key are candidates too. Candidates
connect to families. Within a family every pair is compared
by its whole sets, so bands decide only who meets: a pair at similarity s shares no key with
probability (1 - s ** ROWS) ** BANDS, below 5e-7 at 0.8 and less above.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.scratch import bounded_batches, first_rows, row_hash, stored
from tidemark.llm.simhash import linked, majority

BANDS, ROWS = 48, 6
#: Members of a family that are compared in one task; larger ones are compared block by block.
BLOCK = 256
#: Word hashes remembered by one worker.
REMEMBERED = 200_000
#: Shingles in memory at once: of a text for its minima, and of a block for its overlaps.
SLAB = 2048

_RNG = np.random.default_rng(42)
_TIMES = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)
_MORE = np.uint64(0x9E3779B97F4A7C15)
_words: dict[str, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    for times in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(times)
    return x ^ (x >> np.uint64(33))


def _word(w: str) -> int:
    found = _words.get(w)
    if found is None:
        found = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 42)
        if len(_words) < REMEMBERED:
            _words[w] = found
    return found


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of so many lower-case words; a shorter text is one run, one without words has none."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word, parts), np.uint64, len(parts))
    out = np.zeros(max(1, len(h) - words + 1), np.uint64)
    for j in range(min(words, len(h))):
        out = out * _MORE + h[j : j + len(out)]
    return np.unique(_mixed(out))


def band_keys(found: np.ndarray) -> np.ndarray:
    """BANDS keys of a set of shingles; an empty set has none."""
    if not len(found):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), SLAB):
        least = np.minimum(least, (found[i : i + SLAB] * _TIMES + _PLUS).min(1))
    rows, key = least.reshape(BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = _mixed(key * _MORE + rows[:, j])
    return key.view(np.int64)


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Whether the Jaccard similarity of any two nonempty sets reaches similarity."""
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    _, col, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    at = np.cumsum(shared) - 1
    use = shared[col]
    owner, col = owner[use], at[col[use]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for i in range(0, int(shared.sum()), SLAB):
        a, b = np.searchsorted(col, (i, i + SLAB))
        has = np.zeros((len(sets), min(SLAB, int(shared.sum()) - i)), np.float32)
        has[owner[a:b], col[a:b] - i] = 1
        both += has @ has.T
    np.fill_diagonal(both, n)
    return both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9


def _links(nodes: list[int], near: np.ndarray) -> list[tuple[int, int]]:
    """One link for each merge that connects the near nodes."""
    root, out = list(range(len(nodes))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(np.triu(near, 1)))):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((nodes[i], nodes[j]))
    return out


def _families(classes: DataFrame) -> DataFrame:
    """(node, family) of the classes(node, fp, keys) that meet another one."""
    index = classes.select(F.explode("keys").alias("key"), "node")
    shared = stored(index.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "bands")
    met = index.join(shared.hint("merge"), "key").where("node <> a").select("a", F.col("node").alias("b"))
    return components(met.union(linked(classes.select("node", "fp")))).select("node", F.col("component").alias("family"))


def keep_first(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, that with the smallest id, of each group of rows that links connect, all columns.

    Two texts are linked if the Jaccard similarity of their sets of word shingles reaches similarity.
    Texts without words are alike. Of rows with the same id, the one with the least hash comes first.
    Rows with a null id stay and link nothing. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("struct<node:long,fp:long,keys:array<long>>")
    def sketch(text: pa.Array) -> pa.Array:
        rows = []
        for t in text.to_pylist():
            found = shingles(t or "", words)
            rows.append({"node": xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63), "fp": majority(found) if len(found) else 0, "keys": band_keys(found)})
        return pa.array(rows, pa.struct([("node", pa.int64()), ("fp", pa.int64()), ("keys", pa.list_(pa.int64()))]))

    @F.arrow_udf("binary")
    def whole(text: pa.Array) -> pa.Array:
        return pa.array((shingles(t or "", words).tobytes() for t in text.to_pylist()), pa.binary())

    def compared(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_pylist()
        near = similar([np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()], similarity)
        a, b = zip(*links) if (links := _links(nodes, near)) else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ident: Column = docs[id_col].cast("long")
    rows = docs.select(ident.alias("doc_id"), row_hash(docs, text_col).alias("row"), docs[text_col].alias("text"))
    made = rows.where("doc_id is not null").select("doc_id", "row", sketch("text").alias("s"))
    prints = stored(made.select("doc_id", "row", "s.node", "s.fp", "s.keys"), "sketches")
    classes = stored(prints.groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "classes")
    families = stored(_families(classes.select("node", "fp", "keys")), "families")
    sizes = families.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = families.join(sizes, "family").join(classes.select("node", "first.doc_id", "first.row"), "node")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    sets = members.join(rows, ["doc_id", "row"]).dropDuplicates(["node"]).select("node", "family", "blocks", "block", whole("text").alias("shingles"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = stored(sets, "shingles").withColumn("other", other).select("node", "family", "shingles", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    links = stored(dealt.groupBy("family", "i", "j").applyInArrow(compared, "a long, b long"), "links")
    groups = components(links).withColumnRenamed("component", "group")
    of = classes.select("node", "first").join(groups, "node", "left").select(F.coalesce("group", "node").alias("group"), "first")
    return first_rows(docs, of.groupBy("group").agg(F.min("first").alias("first")).select("first.doc_id", "first.row"), id_col, text_col)
