import corpus_pipeline
import pytest
from clickspark.llm import langid
from clickspark.session import scratch_path
from test_quality import brute as quality_brute
from test_simhash import brute as simhash_brute
from llm_data import SF_SMALL, docs, none, odd  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the documents."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_acts_on_its_predecessor(stages):
    (_, d0, quality_out), (_, d1, lang_out), (_, d2, dedup_out), (_, d3, packed) = stages
    judged = quality_brute([(r.doc_id, r.text, r.source) for r in d0.collect()])
    assert ids(quality_out) == sorted(r[0] for r in judged if r[-1])
    model = langid.fit(d1.where(~langid.held_out(d1.doc_id)))
    want = {r.doc_id for r in langid.predict(d1, model).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_SCORE}
    assert set(ids(lang_out)) == want
    assert ids(dedup_out) == sorted({c for _, _, c in simhash_brute([(r.doc_id, r.text) for r in d2.collect()])})
    assert len(ids(dedup_out)) < len(ids(d2))
    assert set(ids(packed)) == set(ids(d3))
    for _, before, after in stages[:-1]:
        assert before.columns == after.columns
        assert after.exceptAll(before).count() == 0


def test_run_equals_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF_SMALL).exceptAll(stages[-1][2]).count() == 0


def test_odd_and_empty_documents(spark, docs, odd, none):
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none.select(*cols), SF_SMALL).count() == 0
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF_SMALL)
        assert out.columns == odd.columns, name
    once = corpus_pipeline.simhash_dedup(spark, odd.select(*cols), SF_SMALL)
    assert sorted(str(r.doc_id) for r in once.collect()) == ["-8", "1", "4", "6", "7", "7"]
