"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint has 64 bits, and two documents are linked if theirs differ in at most two. Cut into
two segments of 32 bits, at least one segment then differs in at most one bit. Each fingerprint is
indexed under every segment with every one of its bits deleted (64 signatures), so a linked pair
meets under an equal signature; the full distance is verified after the equality join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.components import components
from tidemark.llm.scratch import bounded_batches, stored, texts

#: Members of a signature up to which they are compared in pairs; larger ones are split by further deletions.
PAIRWISE = 32


def simhash64(text: bytes) -> int:
    """The signed 64-bit fingerprint of one UTF-8 text: word trigrams, XXH64 with seed 42, bits in over half of them."""
    words = text.lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 3 else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(g, 42) for g in grams), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of some hashes, as a signed integer."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


@F.arrow_udf(LongType())
def fingerprint(text: pa.Array) -> pa.Array:
    return pa.array((simhash64(t) for t in text.cast(pa.binary()).to_pylist()), pa.int64())


def _segment(fp: Column, segment: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * segment).bitwiseAND(F.lit(0xFFFFFFFF))


def _without(value: Column, bit: Column) -> Column:
    return value.bitwiseAND(F.bitwise_not(F.pow(F.lit(2), bit).cast("long")))


def signatures(fps: DataFrame) -> DataFrame:
    """(key, fp): per fingerprint the 64 pairs of a segment and a deleted bit; segment, bit and rest are in the key."""

    def of(segment: int) -> Column:
        rest = _segment(F.col("fp"), segment)
        return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda bit: (F.lit(32 * segment) + bit).cast("long") * F.lit(1 << 32) + _without(rest, bit))

    return fps.select(F.explode(F.concat(of(0), of(1))).alias("key"), "fp")


def _crowded(members: DataFrame) -> DataFrame:
    """Links inside signatures with many members, by further deletions in the other segment.

    Members of one signature differ in one bit of its segment at most. Deleting one bit of the other
    segment, or two where the signature's own segment is equal, leaves keys under which all members
    are within two bits of each other: they are linked to the least of them, and no pairs arise.
    """
    own, bit = F.shiftright("key", 37), F.shiftright("key", 32).bitwiseAND(F.lit(31))
    other = F.when(own == 0, _segment(F.col("fp"), 1)).otherwise(_segment(F.col("fp"), 0))
    full = F.when(own == 0, _segment(F.col("fp"), 0)).otherwise(_segment(F.col("fp"), 1))
    bits = F.sequence(F.lit(0), F.lit(31))
    one = F.transform(bits, lambda i: F.struct(F.lit(-1).cast("long").alias("x"), i.alias("i"), F.lit(-1).alias("j"), _without(other, i).alias("rest")))
    two = F.flatten(F.transform(bits, lambda i: F.transform(F.sequence(i, F.lit(31)), lambda j: F.struct(full.alias("x"), i.alias("i"), j.alias("j"), _without(_without(other, i), j).alias("rest")))))
    sub = members.select("key", "fp", F.explode(F.when(bit == 0, F.concat(one, two)).otherwise(one)).alias("s")).select("key", "s", "fp")
    least = sub.groupBy("key", "s").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    # by sorting: Spark takes exploded rows for as small as the file of the members, and a broadcast of them would fill the driver
    return sub.join(least.hint("merge"), ["key", "s"]).where("fp <> a").select("a", F.col("fp").alias("b"))


def links(fps: DataFrame) -> DataFrame:
    """(a, b) between distinct fingerprints fps(fp): enough links to connect all that differ in at most two bits."""
    index = signatures(fps)
    shared = stored(index.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "signatures")
    near = "bit_count(a ^ b) <= 2"
    pairs = shared.where("n = 2").where(near).select("a", "b")
    # joined by sorting at every size: the shared signatures grow with the data, and this way skewed ones can be split
    members = stored(index.join(shared.where("n > 2").select("key", "n").hint("merge"), "key"), "members")
    few = members.where(F.col("n") <= PAIRWISE)
    some = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")).hint("merge"), "key").where("a < b").where(near).select("a", "b")
    return pairs.union(some).union(_crowded(members.where(F.col("n") > PAIRWISE))).distinct()


def linked(classes: DataFrame) -> DataFrame:
    """(a, b) for classes(node, fp): links that connect all nodes whose fingerprints differ in at most two bits."""
    least = stored(classes.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    of = lambda c: least.select(F.col("fp").alias(c), F.col("node").alias(f"node_{c}"))
    between = links(least.select("fp")).join(of("a"), "a").join(of("b"), "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return between.union(classes.join(least.withColumnRenamed("node", "a"), "fp").where("node <> a").select("a", F.col("node").alias("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of docs.

    component_id is the smallest doc_id that links reach, the row's own included. A null or empty
    text has fingerprint zero and links like any other. A row with a null id has a fingerprint, links
    nothing and has a null component. Repeated rows and equal texts share a fingerprint, so they are
    one class; only classes take part in the search. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    prints = stored(texts(docs, id_col, text_col).select("doc_id", fingerprint("text").alias("fp")), "fingerprints")
    classes = stored(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    groups = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    least = classes.join(groups, "fp").groupBy("component").agg(F.min("first_id").alias("component_id"))
    of = groups.join(least, "component").select("fp", "component_id")
    named = stored(classes.join(of, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "named")
    out = prints.join(named.hint("merge"), "fp", "left")
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
