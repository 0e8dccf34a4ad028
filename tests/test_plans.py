"""Plan shape: exchanges of the fold, pruning at the scan, no Python on the row path."""
import os
import tempfile

import pytest

import __spark_entry__ as E
from panelscore.plans.oracle import ORACLE
from panelscore.operators.fold import FoldSpec, fold_history
from plan_inspect import count_nodes, plan_text, python_nodes


@pytest.fixture(scope="module")
def history(spark):
    rows = [(k, r, (k * r) % 7, (k + r) % 3) for k in range(200) for r in range(1, 1 + k % 9 + 1)]
    path = os.path.join(tempfile.mkdtemp(prefix="plans-"), "history")
    spark.createDataFrame(rows, "id long, rn int, a int, b int").write.parquet(path)
    return spark.read.parquet(path)


SPEC = FoldSpec(trend=("a",), recent=("a", "b"))


def test_single_plan_has_one_exchange_one_sort_one_window(spark, history):
    df = fold_history(history, SPEC, "single")
    assert count_nodes(df, r"Exchange hashpartitioning") == 1
    assert count_nodes(df, r"\bSort \[") == 1
    assert count_nodes(df, r"\bWindow \[") == 1


def test_segmented_plan_shuffles_rows_by_key_and_segment_then_summaries_by_key(spark, history):
    text = plan_text(fold_history(history, SPEC, "segmented"), "simple")
    assert "hashpartitioning(id#" in text and "_seg#" in text
    assert text.count("Exchange hashpartitioning") == 2
    assert "SinglePartition" not in text


def test_auto_picks_single_when_keys_are_small(spark, history):
    assert count_nodes(fold_history(history, SPEC), r"Exchange hashpartitioning") == 1


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan_text(E.queries()["history_length"](spark, sf_dir))
    read = [line for line in text.splitlines() if "ReadSchema" in line]
    assert read and all("l_orderkey" in r and "l_partkey" not in r for r in read)


def test_filters_reach_the_scan(spark, sf_dir):
    from pyspark.sql import functions as F
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").where(F.col("o_orderpriority") == "1-URGENT")
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in plan_text(df)


#: boosting adds up histograms and walks trees with numpy, in Arrow batches
BOOSTED = {"gbt_scores", "gbt2_scores", "gbt_trees", "gbt_history", "feature_importance", "score_test", "boosted_comparison", "gbt_early_stop"}


@pytest.mark.parametrize("key", sorted(k for k in ORACLE if not k.startswith(("ingest", "mart_mat",
                                                                                        "compact", "submission",
                                                                                        "predictions")) and k not in BOOSTED))
def test_no_python_on_the_row_path(spark, sf_dir, key):
    assert python_nodes(E.queries()[key](spark, sf_dir)) == []


def test_bucketed_layer_folds_without_an_exchange(spark, history, tmp_path):
    from panelscore.sources import io
    layer = io.write_bucketed(history, str(tmp_path / "layer"), "id", ["id", "rn"], 4)
    folded = fold_history(layer, SPEC, "single")
    assert count_nodes(folded, r"Exchange") == 0
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, fold_history(history, SPEC, "single").collect()))
    joined = folded.join(io.write_bucketed(history.select("id").distinct(), str(tmp_path / "ids"), "id", ["id"], 4), "id")
    assert count_nodes(joined.hint("merge"), r"Exchange hashpartitioning") == 0


def test_a_writes_rows_are_counted_from_footers(spark, tmp_path):
    from panelscore.sources import io
    assert io.write_counted(spark.range(1000).repartition(3), str(tmp_path / "t")) == 1000
    text = plan_text(spark.read.parquet(str(tmp_path / "t")).groupBy().count())
    assert "ReadSchema: struct<>" in text


def test_class_size_filter_reaches_the_scan(spark):
    from panelscore.operators import split
    path = os.path.join(tempfile.mkdtemp(prefix="flags-"), "t")
    spark.createDataFrame([(1, 0), (2, 1)], "id long, flag int").write.parquet(path)
    text = plan_text(split.with_class_weights(spark.read.parquet(path)))
    assert "EqualTo(flag,1)" in text
