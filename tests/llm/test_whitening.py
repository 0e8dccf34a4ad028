"""Embedding whitening (operator 11) against numpy on the whole fit list."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscore.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>"


def expected(rows, scale=256, components=4):
    kept = [(k, [math.floor(scale * c) for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(len(x) for _, x in kept)
    kept = [(k, x + [0] * (dims - len(x))) for k, x in kept]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for k, x in kept:
        deviation = sum((n * c - int(s)) ** 2 for c, s in zip(x, sums))
        for i in range(min(components, dims)):
            out.append((k, i + 1, n, deviation, abs((np.array(x) - sums / n) @ vectors[:, i]) / math.sqrt(values[i]), values[i] / values.sum()))
    return out


def check(df, rows, **kw):
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in df.collect()), key=lambda r: (r[0] is None, r))
    want = sorted(expected(rows, **kw), key=lambda r: (r[0] is None, r))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([abs(g[4]) for g in got], [w[4] for w in want], atol=1e-10)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)
    assert {g[6] for g in got} == {got[0][6]} and got[0][6] < 1e-10
    return got


def vectors(n, dims, seed=0):
    base = np.random.default_rng(seed).normal(size=(n, dims)) * np.arange(1, dims + 1)
    return [(i, [float(c) for c in v]) for i, v in enumerate(base)]


@pytest.mark.parametrize("block_rows,hot", [(4096, 100_000), (7, 1), (1, 2)])
def test_equals_numpy_with_copies_nulls_and_ragged_rows(spark, block_rows, hot):
    rows = vectors(120, 5) + [(1000 + i, vectors(120, 5)[3][1]) for i in range(40)]  # a vector held by a quarter of the rows
    rows += [(None, [1.0, 2.0, 3.0, 4.0, 5.0]), (3, [0.5] * 5), (3, [0.25] * 5), (900, None), (901, [1.0, math.nan, 0.0, 0.0, 0.0]), (902, [1.0, None, 0.0, 0.0, 0.0]),
             (903, [math.inf] * 5), (904, [0.5, -0.25]), (905, [])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = check(wh.whitened(spark, df, block_rows=block_rows, hot=hot), rows)
    signs = {}
    for g in got:
        signs.setdefault((g[1], g[3], round(abs(g[4]), 9)), set()).add(np.sign(g[4]))
    assert all(len(s) == 1 for s in signs.values())  # copies have equal values


def test_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(wh.query(spark, sf_dir), rows)


def test_few_dimensions_and_other_arguments(spark):
    rows = vectors(30, 2)
    check(wh.whitened(spark, spark.createDataFrame(rows, SCHEMA), components=2, scale=1000), rows, scale=1000)
    renamed = spark.createDataFrame(rows, "k long, x array<double>").select("*", *[F.lit(0).alias(c) for c in ("v", "z", "n", "copies", "component", "deviation")])
    check(wh.whitened(spark, renamed, key="k", vector="x"), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [math.nan])]])
def test_nothing_to_whiten(spark, rows):
    df = wh.whitened(spark, spark.createDataFrame(rows, SCHEMA))
    assert df.count() == 0 and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_no_variance_and_values_out_of_range(spark):
    one = [tuple(r) for r in wh.whitened(spark, spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()]
    assert sorted(one) == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = {(r["vec_id"], r["component"]): r for r in wh.whitened(spark, spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], SCHEMA)).collect()}
    assert abs(line[1, 1]["whitened"]) == 1.0 and line[1, 2]["whitened"] is None and line[1, 1]["deviation"] == 2 * 256 ** 2 * 2
    huge = wh.whitened(spark, spark.createDataFrame([(1, [1e300]), (2, [-1e300])], SCHEMA)).collect()
    assert all(r["deviation"] is None and abs(r["whitened"]) > 0.99 for r in huge)


def test_deviations_are_exact_up_to_a_longs_limit():
    x = np.array([[2 ** 31, -5], [2 ** 31 - 1, 7], [3, 4]])
    sums = [int(s) for s in x.sum(axis=0)]
    want = [sum((3 * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert wh.deviations(x, 3, sums) == [w if w < 2 ** 63 else None for w in want]


def test_equal_eigenvalues_share_one_basis(spark):
    rows = [(i, [math.cos(i * math.pi / 2), math.sin(i * math.pi / 2)]) for i in range(4)]
    got = wh.whitened(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(abs(r["explained"] - 0.5) < 0.01 and r["identity_error"] < 1e-12 for r in got)
