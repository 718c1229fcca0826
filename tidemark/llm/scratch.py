"""Shared places for tables that cut lineage, and small helpers of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch that goes to a Python worker; a single longer row is a batch of its own.
BATCH_BYTES = 1 << 20

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a folder of our own in local mode, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return found or _own.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="spark-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the bytes of Arrow batches, so that long texts fit in a worker's memory; set once for the session."""
    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b"
    if spark.conf.get(name) != most:
        spark.conf.set(name, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, taken: Iterable[str]) -> str:
    """name, or name with underscores in front of it, so that no column has it in any case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text), null texts as empty ones; other columns, whatever their names, are left behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def row_hash(docs: DataFrame, text_col: str = "text") -> Column:
    """A hash of the text and then of all columns, by which rows with the same id have an order."""
    return F.xxhash64(docs[text_col], *(docs[c] for c in docs.columns))


def first_rows(docs: DataFrame, first: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs in first(doc_id, row), row their row_hash; equal ones once, and those with a null id as well."""
    ident, row = free("id", docs.columns), free("row", docs.columns)
    marked = docs.withColumn(ident, docs[id_col].cast("long")).withColumn(row, row_hash(docs, text_col))
    named = first.select(F.col("doc_id").alias(ident), F.col("row").alias(row))
    kept = marked.join(named, [ident, row], "left_semi").dropDuplicates([ident, row])
    return kept.select(docs.columns).unionByName(docs.where(docs[id_col].cast("long").isNull()))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold of documents from which no label may be learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))
