import re

import pytest
import sentencepiece

import corpus_pipeline
from test_near_dedup import brute as near_brute
from txnlens.llm.common import fold, prepare
from txnlens.llm.mixing import DOCUMENT_LEVELS, mixture
from txnlens.llm.pieces import MODEL
from txnlens.llm.toxicity import toxicity_scores

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it gave, written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Repeated rows, null text and null id go through all stages.
    extra = [(docs.first().doc_id, docs.first().text, "en", "s", 1), (90_001, None, None, None, 0), (None, "no id", "en", "x", 5)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    found = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        found.append((name, docs, spark.read.parquet(path)))
        docs = found[-1][2]
    return found


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [name for name, _, _ in stages] and len(stages) == 5
    for _, _, given in stages[:-1]:
        assert given.columns == COLUMNS


def test_toxic_documents_go_and_all_others_stay(spark, stages):
    _, docs, left = stages[0]
    scores = toxicity_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold("doc_id", 3) != 1).collect()
    bad = {r.doc_id for r in scores if r.score >= 0.7}
    want = [r.doc_id for r in docs.collect() if r.doc_id not in bad]
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(want, key=repr)


def test_one_row_of_equal_texts_stays(stages):
    _, docs, left = stages[1]
    first = {}
    for r in docs.collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        first[key] = min(first.get(key, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect())
    assert got == sorted(first.values())


def test_one_document_of_each_component_stays(stages):
    _, docs, left = stages[2]
    rows = [(r.doc_id if r.doc_id is not None else 10**9, r.text) for r in docs.collect()]
    want = sorted({c for _, _, c in near_brute(rows, 5)})
    assert sorted(r.doc_id if r.doc_id is not None else 10**9 for r in left.collect()) == want


def test_the_mix_is_that_of_its_budgets(stages):
    _, docs, left = stages[3]
    copies = mixture(docs, DOCUMENT_LEVELS, None, corpus_pipeline.MIX_SHARE, epochs=1).collect()
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((r.doc_id for r in copies if r.copies), key=repr)
    taken = sum(r.tokens for r in copies if r.copies)
    assert 0.7 * 0.9 <= taken / sum(r.tokens for r in copies) <= 0.9


def test_ids_are_those_of_the_texts(stages):
    _, docs, found = stages[4]
    original = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted(((r.doc_id, original.encode(r.text or "")) for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in found.collect()), key=repr) == want


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "n_tokens", "ids", "round_trip", "parity"]
    rows = found.collect()
    assert 50 < len(rows) < 200 and all(r.round_trip and r.parity for r in rows)


def test_empty_table(spark, make_docs):
    prepare(spark)
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
