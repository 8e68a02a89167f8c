"""The stages one by one, each on its own input."""

from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from fareloom.llm import decontaminate, language, near, quality
from fareloom.llm.common import shared_path, table, written
from likeness import expected_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output of each stage by name."""
    docs, found = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, sf_dir), f"test-{name}")
        found[name] = (docs, result)
        docs = result
    return found


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    for _, result in list(stages.values())[:-1]:
        assert result.columns == COLUMNS
    before, after = stages["tokenize"]
    assert before.count() == after.count()


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_language_stage(stages):
    before, after = stages["language_id"]
    model = language.train(before)
    rows = language.predict(before, model).collect()
    kept = sorted(
        r["doc_id"] for r in rows
        if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.SURE
    )
    assert ids(after) == kept


def test_quality_stage_keeps_good_documents(stages, spark, sf_dir):
    before, after = stages["quality_filter"]
    labels = table(spark, sf_dir, "labels")
    kept = after.select("doc_id", F.lit(1).alias("kept"))
    judged = before.join(labels, "doc_id").join(kept, "doc_id", "left")
    good, bad = judged.where("quality = 1"), judged.where("quality = 0")
    assert good.where("kept = 1").count() >= 0.98 * good.count()
    assert bad.where("kept = 1").count() <= 0.1 * bad.count()
    rows = quality.predict(before, quality.train(before, labels)).where("predicted = 1")
    assert ids(rows) == ids(after)


def test_near_duplicates_stage(stages):
    """The stage's own input against the likeness of all pairs."""
    before, after = stages["near_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
    rows.sort()
    assert ids(after) == sorted(set(expected_ids(rows)))
    assert len(rows) - after.count() > 50


def test_stages_keep_all_without_anything_to_learn(stages, spark, sf_dir, tmp_path):
    docs, _ = stages["language_id"]
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert ids(corpus_pipeline.language_id(spark, unknown, sf_dir)) == ids(docs)
    labels = table(spark, sf_dir, "labels").withColumn("quality", F.lit(None).cast("int"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert ids(corpus_pipeline.quality_filter(spark, docs, str(tmp_path))) == ids(docs)


def test_a_run_leaves_its_result_only(spark, small_dir, tmp_path):
    before = set(folders(spark))
    result = corpus_pipeline.run(spark, small_dir)
    left = set(folders(spark)) - before
    assert result.count() > 0 and len(left) == 1 and "pipeline-tokenize" in left.pop()


def folders(spark):
    root = Path(shared_path(spark, "x").removeprefix("file:")).parent
    return [p.name for p in root.iterdir()] if root.exists() else []


def test_benchmark_stage(stages, spark, sf_dir):
    before, after = stages["benchmark_filter"]
    bench = table(spark, sf_dir, "benchmark")
    found = {r["doc_id"] for r in decontaminate.contained_items(before, bench).collect()}
    assert found and ids(after) == sorted(set(ids(before)) - found)


def test_stages_with_odd_rows(odd, nothing, spark, small_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, small_dir).count() == 0
        assert stage(spark, odd, small_dir).count() <= odd.count()
    kept = corpus_pipeline.near_dedup(spark, odd, small_dir)
    assert kept.columns == odd.columns
    groups = near.near_groups(odd).select("component").distinct()
    assert kept.count() == groups.count()  # one row of each group, also with odd ids


def test_run_is_the_stages(stages, spark, sf_dir):
    _, last = stages["tokenize"]
    assert ids(corpus_pipeline.run(spark, sf_dir)) == ids(last)
