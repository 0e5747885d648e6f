import inspect

import corpus_pipeline
import pytest
from tickloom.llm import decontaminate, quality, secrets, simhash
from tickloom.llm.common import written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and made, by its name."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, SF), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "mix"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)


def test_columns_stay(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.schema == before.schema, name


def test_quality_rejects_bad_and_keeps_good(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in after.collect()}
    known = before.join(labels, "doc_id").collect()
    assert sum((r.doc_id in kept) != bool(r.quality) for r in known) <= 0.02 * len(known)


def test_one_of_each_near_duplicate_group(stages):
    before, after = stages["near_dedup"]
    classes = {r.component for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(classes)


def test_contaminated_go_and_clean_stay(spark, stages):
    before, after = stages["decontaminate"]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    hits = {r.doc_id: r.h.n_hit for r in decontaminate.hits(before, benchmark, "h").collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, n in hits.items() if not n} != set(hits)


def test_secrets_are_gone(stages):
    before, after = stages["secrets"]
    texts = {r.doc_id: r for r in after.collect()}
    changed = 0
    for r in before.collect():
        spans = secrets.spans_of(r.text)
        changed += bool(spans)
        assert (texts[r.doc_id].text != r.text) == bool(spans)
        assert texts[r.doc_id].n_chars == len(texts[r.doc_id].text)
        assert not secrets.base(texts[r.doc_id].text)
    assert changed and len(texts) == before.count()


def test_mix(stages):
    before, after = stages["mix"]
    words = sum(len(r.text.split()) for r in before.collect())
    rows = after.collect()
    assert abs(sum(r.n_words for r in rows) - 1.5 * words) < 0.02 * words
    texts = {r.doc_id: " ".join(r.text.split()) for r in before.collect()}
    assert all(r.text in texts[r.doc_id] for r in rows[:500])


def test_run_registered(spark):
    from __spark_entry__ import oracle_sql, queries

    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(None, 1), (6, 1), (4, 0), (5, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, "one"), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = written(stage(spark, docs, str(tmp_path)), name)
            assert name == "mix" or made.columns == docs.columns
            docs = made
    assert quality.CUT == 0.3
