"""The pipeline: each stage on what its predecessor kept, against the operators and by hand."""

import pytest

import corpus_pipeline
from hazardmarts.llm import queries
from tests.llm.test_quality import plain

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_in_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "ngram_jaccard", "benchmark_decontamination", "mix_sources"]


def test_all_but_the_last_return_documents(stages):
    assert all(s.columns == COLUMNS for s in stages[:-1])
    assert set(COLUMNS) < set(stages[-1].columns)
    counts = [s.count() for s in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def test_quality_stage_drops_what_the_base_rules_reject(stages):
    kept = {r.doc_id for r in stages[1].collect()}
    for r in stages[0].collect():
        words, _, _, _, repeated, _ = plain(r.text)
        if words < 50 or 100 * repeated > 50 * words:
            assert r.doc_id not in kept


def test_toxicity_stage_follows_the_scores(spark, stages):
    bad = {r.doc_id for r in queries.op2_toxicity_svm(spark, SF).where("predicted = 1").collect()}
    before, after = ({r.doc_id for r in s.collect()} for s in stages[1:3])
    assert before - after == before & bad


def test_one_of_each_class_stays(spark, stages):
    from hazardmarts.llm import jaccard

    classes = {r.doc_id: r.class_id for r in jaccard.link_classes(stages[2]).collect()}
    assert {r.doc_id for r in stages[3].collect()} == set(classes.values())


def test_no_benchmark_item_is_left(spark, stages):
    from hazardmarts.llm import decontam

    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {r.doc_id for r in decontam.contaminated(stages[3], items).collect()}
    before, after = ({r.doc_id for r in s.collect()} for s in stages[3:5])
    assert before - after == found


def test_the_mixture_holds_whole_documents(stages):
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    copies = stages[5].collect()
    assert copies and all(texts[r.doc_id] == r.text for r in copies)


def test_run_equals_the_stages(spark, stages):
    key = lambda df: sorted((r.doc_id, r["copy"]) for r in df.select("doc_id", "copy").collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[5])


def test_odd_rows_pass_all_stages(spark):
    rows = [(None, None, None, None, None, "x"), (1, "", "en", "a", 0, "x"), (2, "word " * 100_000, "en", "src0", 1, "x"),
            (3, " ".join(f"w{i}" for i in range(80)), None, "src0", 5, "x"), (3, " ".join(f"w{i}" for i in range(80)), None, "src0", 5, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, toxicity string"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = spark.createDataFrame(out.collect(), out.schema) if out.columns == docs.columns else out
    assert {r.doc_id for r in docs.collect()} <= {3}
