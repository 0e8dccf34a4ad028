"""Submission gates on FIXTURES §3 defects."""
import os
import tempfile

import pytest

from panelscore.operators import gates
from panelscore.sources import io

TARGET = [(i,) for i in range(1, 11)]


def _sub(spark, rows):
    return spark.createDataFrame(rows, "id long, score double")


def _report(spark, rows, valid=True, shift=1.0):
    target = spark.createDataFrame(TARGET, "id long")
    v = spark.createDataFrame([(i, 0, (0.1 * i - 0.05) / shift) for i in range(1, 11)],
                              "id long, y_true int, y_score double")
    return gates.gate_report(_sub(spark, rows), target, v if valid else None).collect()[0].asDict()


GOOD = [(i, 0.1 * i - 0.05) for i in range(1, 11)]


def test_good_submission_passes(spark):
    r = _report(spark, GOOD)
    assert r["passed"] and r["errors"] == [] and r["warnings"] == []


@pytest.mark.parametrize("rows,error", [
    (GOOD[:-1], "row_count"),
    (GOOD + [GOOD[0]], "duplicate_ids"),
    (GOOD[:-1] + [(99, 0.5)], "extra_ids"),
])
def test_each_defect_has_its_error(spark, rows, error):
    r = _report(spark, rows)
    assert error in r["errors"] and not r["passed"]


def test_further_column_is_an_error_of_the_report(spark):
    target = spark.createDataFrame(TARGET, "id long")
    sub = spark.createDataFrame([(i, s, "x") for i, s in GOOD], "id long, score double, extra string")
    r = gates.gate_report(sub, target).first()
    assert r["errors"] == ["columns"] and not r["passed"]
    with pytest.raises(gates.GateError):
        gates.assert_gates(gates.gate_report(sub, target))


def test_empty_submission_has_no_duplicates(spark):
    r = _report(spark, [])
    assert (r["duplicates"], r["rows"], r["missing_ids"], r["unique_ratio"]) == (0, 0, 10, 0.0)
    assert gates.duplicate_count(_sub(spark, [])).first()["duplicates"] == 0


def test_missing_id_value_is_an_extra_id(spark):
    r = _report(spark, GOOD[:-1] + [(None, 0.5)])
    assert r["extra_ids"] == 1 and "extra_ids" in r["errors"]
    assert gates.extra_ids(_sub(spark, [(None, 0.5), (None, 0.4), (1, 0.1)]), spark.createDataFrame(TARGET, "id long")).count() == 1


def test_missing_id_also_fails_row_count(spark):
    r = _report(spark, GOOD[:-1])
    assert {"row_count", "missing_ids"} <= set(r["errors"])


def test_nan_empty_and_out_of_range_from_csv(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="gates-"), "sub.csv")
    with open(path, "w") as f:
        f.write("id,score\n1,0.1\n2,NaN\n3,\n4,-0.1\n5,1.1\n6,0.6\n")
    sub = io.read_submission_csv(spark, path)
    r = gates.score_values(sub).collect()[0]
    assert (r["nan"], r["out_of_range"]) == (2, 2)
    assert gates.format_check(sub).collect()[0]["format_ok"]


def test_constant_score_is_degenerate(spark):
    r = _report(spark, [(i, 0.5) for i in range(1, 11)])
    assert "degenerate_scores" in r["errors"]


def test_shifted_scores_warn_but_pass(spark):
    r = _report(spark, GOOD, shift=1.3)
    assert r["warnings"] == ["mean_drift"] and r["passed"]


def test_no_validation_scores_warns(spark):
    r = _report(spark, GOOD, valid=False)
    assert r["warnings"] == ["no_validation_scores"] and r["mean_drift"] is None and r["passed"]


def test_assert_gates_raises(spark):
    target = spark.createDataFrame(TARGET, "id long")
    with pytest.raises(gates.GateError):
        gates.assert_gates(gates.gate_report(_sub(spark, GOOD[:-1]), target))


def test_wrong_columns_fail_format(spark):
    assert not gates.format_check(spark.createDataFrame([(0.5, 1)], "score double, id long").select("score", "id")) \
        .collect()[0]["format_ok"]


@pytest.mark.parametrize("content", ["flag,id\n0,1\n", "id,flag\nx,1\n"])
def test_target_csv_rejects_swapped_header_and_bad_id(spark, content):
    path = os.path.join(tempfile.mkdtemp(prefix="target-"), "t.csv")
    with open(path, "w") as f:
        f.write(content)
    with pytest.raises(Exception):
        io.read_target_csv(spark, path, io.target_schema()).collect()


def test_unique_ratio_counts_nan_as_one_value(spark):
    sub = _sub(spark, [(1, float("nan")), (2, float("nan")), (3, None), (4, 0.5)])
    assert gates.unique_ratio(sub).collect()[0]["unique_ratio"] == 0.5
