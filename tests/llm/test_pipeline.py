"""The corpus pipeline: stage names and order, whole rows, decisions that take effect, edge tables."""
import pytest
from edge import edge_documents, edge_labels, empty_documents

import corpus_pipeline


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    edge_labels(spark).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "an item that is nowhere in the texts at all"), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "mixing"]


def test_run_on_the_test_tables(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = corpus_pipeline.run(spark, sf_dir).cache()
    assert out.columns == [*docs.columns, "size", "source_size", "target", "taken", "pieces"]
    assert out.select(*docs.columns).exceptAll(docs).count() == 0 and out.where("taken <= 0").count() == 0
    left = out.join(labels, "doc_id")
    assert left.where("quality = 0").count() <= 0.1 * labels.where("quality = 0").count()
    assert left.where("toxic = 1").count() <= 0.35 * labels.where("toxic = 1").count()
    assert left.where("quality = 1 AND toxic = 0").count() >= 0.6 * labels.where("quality = 1 AND toxic = 0").count()
    assert out.groupBy("text").count().where("count > 1").count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
@pytest.mark.parametrize("clashing", [False, True])
def test_every_stage_takes_odd_rows(spark, tables, name, stage, clashing):
    docs = edge_documents(spark, clashing)
    out = stage(spark, docs, tables)
    assert out.columns[:len(docs.columns)] == docs.columns and (name == "mixing") == (len(out.columns) > len(docs.columns))
    assert out.select(*docs.columns).exceptAll(docs).count() == 0
    assert stage(spark, empty_documents(spark), tables).count() == 0
