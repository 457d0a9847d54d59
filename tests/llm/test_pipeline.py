import public_tokenizers
import pytest
from compare import connect, mismatch
from llm_rows import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tierwise.llm import decontaminate, pii, simhash
from tierwise.llm.common import documents, written
from tierwise.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def stages(spark):
    docs = documents(spark, SF)
    made = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        made[name] = docs
    return made


def test_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_stages_do_their_whole_job(spark, stages):
    before = {r.doc_id: r.text for r in stages["documents"].collect()}
    for name in ("quality_classifier", "near_duplicates", "decontamination"):
        after = {r.doc_id: r.text for r in stages[name].collect()}
        assert after.items() <= before.items() and 0 < len(after) < len(before)
        before = after
    links = simhash.near_duplicates(stages["quality_classifier"]).filter("doc_id = component_id")
    assert {r.doc_id for r in links.collect()} == {r.doc_id for r in stages["near_duplicates"].collect()}
    hits = decontaminate.contamination(stages["near_duplicates"], documents(spark, SF, "benchmark"))
    assert {r.doc_id for r in hits.filter("NOT contaminated").collect()} == set(before)
    for r in stages["personal_data"].collect():
        text = before[r.doc_id] or ""
        assert r.text == pii.masked(text, pii.all_spans(text, pii.trained())) and r.n_chars == len(r.text)


def test_clean_documents_stay(spark, stages):
    labels = documents(spark, SF, "labels")
    good = labels.filter("quality = 1 AND toxic = 0").select("doc_id")
    assert stages["quality_classifier"].join(good, "doc_id").count() >= 0.97 * good.count()
    bad = labels.filter("quality = 0").select("doc_id")
    assert stages["quality_classifier"].join(bad, "doc_id").count() <= 0.1 * bad.count()


def test_run_gives_the_ids(spark, stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids for r in stages["personal_data"].collect()}
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()} == expected


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), name)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == given.columns
        assert docs.select(F.count("*")).first()[0] <= given.count()


def test_names():
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert mismatch(spark, connect(SF), name, QUERIES[name], ORACLE[name], SF) is None
