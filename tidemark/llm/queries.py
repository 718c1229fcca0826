"""The queries of this subpackage: every operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, audio, dac, fill_middle, ngram_lm, packing, pii, prefix_counts, quality_cnn, simhash, top_k, toxicity_chain, tree_bpe
from tidemark.llm.scratch import held_out, stored, table, texts
from tidemark.llm.token_units import default_path

QUALITY_THRESHOLD = 0.3
TOXIC_THRESHOLD = 0.6
TOKEN_LIMIT = 4096


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dac.write(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), end_id=2)
    return dac.digests(dac.read(spark, path))


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scored(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), order=3)


def op3_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = texts(table(spark, sf_dir, "documents"))
    raw = F.encode("text", "UTF-8")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / 192)).cast("int") * 192
    payloads = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.rpad(raw, n, F.lit(b" ")).alias("payload"))
    f = audio.with_features(audio.store(payloads))
    payload = f["features"]["payload"]
    made = f.select(
        "doc_id",
        "n_bytes",
        F.length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -16, 16)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        f["features"]["starts"].alias("starts"),
        f["features"]["ends"].alias("ends"),
        f["features"]["clips"].alias("clips"),
    )
    clips = stored(made, "clips")  # the tensors with their time spans, as they would be used
    spans = F.array_join(F.zip_with("starts", "ends", lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string"))), ",")
    feature = F.concat_ws(":", F.sha2("clips", 256), F.sha2(spans, 256)).alias("feature")
    return clips.select(*[c for c in clips.columns if c not in ("starts", "ends", "clips")], feature, F.size("starts").alias("n_clips"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.token_lengths(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json")))


def op5_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_path("word_bpe_49k.json")
    e = tree_bpe.encoded(texts(table(spark, sf_dir, "documents")), path, decoded_col="decoded")
    return e.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(e["ids"].cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_cnn.fit(docs, table(spark, sf_dir, "labels"))
    out = quality_cnn.scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = top_k.quantised(table(spark, sf_dir, "embeddings"))
    return top_k.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(texts(table(spark, sf_dir, "documents")))
    counts = [F.size(pii.of_kinds(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    base = pii.of_kinds(F.col("spans"), *pii.BASE)
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"), pii.scores(F.col("spans")).alias("scores"))


def _toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> str:
    labels = table(spark, sf_dir, "labels").withColumn("low_quality", 1 - F.col("quality"))
    return toxicity_chain.fit(docs, labels, ("low_quality", "toxic"))


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity_chain.scored(docs.select("doc_id", "text"), _toxicity_model(spark, sf_dir, docs))
    low, toxic = F.get("scores", F.lit(0)), F.get("scores", F.lit(1))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), low.alias("low_quality"), toxic.alias("score"), (toxic >= TOXIC_THRESHOLD).cast("int").alias("predicted"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_counts.count_table(table(spark, sf_dir, "documents"), default_path("piece_bpe_32k.model"))
    return prefix_counts.answers(counts, TOKEN_LIMIT)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transformed(table(spark, sf_dir, "documents"), seed=42, rate=50, spm_rate=80)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.withColumns({"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(back, 256)}).drop("output")


def queries() -> dict:
    found = (
        op1_token_codes, op2_ngram_lm, op3_audio, op4_packing, op5_tree_bpe, op6_quality_cnn, op7_top_k,
        op8_pii, op9_toxicity_chain, op10_simhash, op11_prefix_counts, op12_alignment, op13_fill_middle,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op7_top_k": OP7_SQL}


OP7_SQL = """
WITH x AS (
  SELECT vec_id, min([floor(1024 * c::DOUBLE)::BIGINT for c in embedding]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0
  GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]), 0)::BIGINT AS score
  FROM x q JOIN x c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
