"""The pipeline's stages against plain versions, on odd rows, and as a whole."""

import json

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_near_copies import first_ids
from tests.llm.test_pii import redacted
from tests.llm.test_tokens import check_bins
from tidemark.llm import packing, pii, quality_cnn, toxicity_chain
from tidemark.llm.queries import QUALITY_THRESHOLD, TOXIC_THRESHOLD, _toxicity_model
from tidemark.llm.token_units import default_path


@pytest.fixture(scope="module")
def docs(spark, odd, documents):
    """Odd rows beside ordinary ones, with columns that have the names operators would like to use."""
    rows = documents.select("doc_id", "text", "lang", "source", "n_chars").limit(60).collect()
    rows += [(None if r.doc_id is None else 10_000 + r.doc_id, r.text, None, None, None) for r in odd.collect()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, scores string, spans string, row long, id int"
    return spark.createDataFrame([(*r, 0.5, "s", "p", 7, 8) for r in rows], schema)


def texts(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "") for r in df.collect())


def test_classifier_stages_keep_what_scores_say(spark, docs):
    model = quality_cnn.loads(quality_cnn.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    kept = corpus_pipeline.quality(spark, docs, SF)
    want = [r for r in docs.collect() if quality_cnn.score(model, (r.text or "").encode()) >= QUALITY_THRESHOLD]
    assert kept.columns == docs.columns and texts(kept) == texts(spark.createDataFrame(want, docs.schema))
    scorer = toxicity_chain.Scorer(json.loads(_toxicity_model(spark, SF, docs)))
    kept = corpus_pipeline.toxicity(spark, docs, SF)
    want = [r for r in docs.collect() if scorer(r.text or "")[1] < TOXIC_THRESHOLD]
    assert kept.columns == docs.columns and texts(kept) == texts(spark.createDataFrame(want, docs.schema))
    assert {r.score for r in kept.collect()} == {0.5}


def test_personal_data_is_replaced(docs, spark):
    out = corpus_pipeline.personal_data(spark, docs, SF)
    assert out.columns == docs.columns and {r.spans for r in out.collect()} == {"p"}
    found = [(r.doc_id, r.text and redacted(r.text, r.spans)) for r in pii.find(docs).collect()]
    assert sorted(found, key=repr) == sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


def test_packing_takes_every_row(docs, spark):
    tok = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    lengths = [(r.doc_id, len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in docs.collect()]
    check_bins(corpus_pipeline.pack(spark, docs, SF).collect(), lengths, packing.CAPACITIES)


def test_no_documents(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0, name


def test_run(spark, documents):
    """The rows of the whole are those of its stages, one after the other, by plain versions where there are any."""
    kept = corpus_pipeline.toxicity(spark, corpus_pipeline.quality(spark, documents, SF), SF)
    ids = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(ids) == first_ids(kept.select("doc_id", "text").collect())
    assert len(ids) > 0.4 * documents.count()
