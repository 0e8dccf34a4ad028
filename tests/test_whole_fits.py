"""Fits to the models' own limits of rounds and patience: in one task or by passes the same, and asked for by the queries."""
import datetime as dt
import random
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelscore.operators import boosting as bo
from panelscore.plans import queries
from test_boosting import FEATURES, LEAF, SCHEMA, SYMMETRIC, _rows, _same

MANY = 1 << 18


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(_rows(600, 1), SCHEMA).repartition(5).cache(), spark.createDataFrame(_rows(300, 2), SCHEMA).cache()


@pytest.mark.parametrize("settings", [replace(LEAF, rate=1.0, rounds=500, patience=4), replace(SYMMETRIC, rounds=13)])
def test_rows_in_one_task_give_the_same_fit(data, monkeypatch, settings):
    monkeypatch.setattr(bo, "STRETCH", 20)
    train, valid = data
    passes, here = bo.fit(FEATURES, train, valid, settings=settings), bo.fit(FEATURES, train, valid, settings=settings, alone=MANY)
    assert _same(passes.trees, here.trees) and replace(passes, trees=()) == replace(here, trees=())


def test_a_fit_in_one_task_goes_on_from_its_last_write(spark, data, monkeypatch, tmp_path):
    monkeypatch.setattr(bo, "STRETCH", 10)
    train, valid = data
    settings = replace(LEAF, rounds=34, patience=100)
    whole = bo.fit(FEATURES, train, valid, settings=settings, alone=MANY)
    state = str(tmp_path / "state")
    bo.fit(FEATURES, train, valid, settings=settings, rounds=20, alone=MANY, state=state)
    assert [spark.read.parquet(f"{state}/trees-{k}").agg(F.min("tree"), F.max("tree")).first()[:] for k in (1, 2)] == [(0, 9), (10, 19)]  # a write holds its own trees
    resumed = bo.fit(FEATURES, train, valid, settings=settings, alone=MANY, state=state)
    assert whole.trained == 34 and _same(whole.trees, resumed.trees) and whole.history == resumed.history


@pytest.mark.parametrize("settings", [LEAF, SYMMETRIC])
def test_one_task_and_degenerate_tables(spark, settings):
    empty, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(_rows(60, 3), SCHEMA)
    assert bo.fit(FEATURES, empty, empty, settings=settings, alone=MANY).rounds == 0
    assert bo.fit(FEATURES, some, empty, settings=settings, rounds=2, alone=MANY).rounds == 2
    constant = bo.fit(["a"], some.withColumn("a", F.lit(1.0)), some, settings=settings, rounds=2, alone=MANY)
    assert constant.trained == 2 and all(len(t.feature) == 1 for t in constant.trees)
    with pytest.raises(Exception, match="a row without a label"):
        bo.fit(FEATURES, some.withColumn("flag", F.when(F.col("id") > 10, F.col("flag"))), some, settings=settings, rounds=2, alone=MANY)
    with pytest.raises(ValueError, match="metric"):
        bo.fit(FEATURES, some, some, settings=settings, rounds=2, alone=MANY, metric="none")


@pytest.fixture(scope="module")
def orders(tmp_path_factory):
    """A folder with the lines of 1,000 orders; two in three were placed before the scoring date."""
    rng, at = random.Random(5), tmp_path_factory.mktemp("orders")
    lines, heads = [], []
    for order in range(1000):
        heads.append((order, dt.datetime(1999 if order % 3 == 0 else 1997, 5, 1), "1-URGENT"))
        for number in range(rng.randint(1, 6)):
            lines.append((order, rng.randint(1, 99), rng.randint(1, 9), number, float(rng.randint(1, 50)), rng.randint(100, 90000) / 4, rng.randint(0, 10) / 100, rng.randint(0, 8) / 100,
                          rng.choice("ANR"), rng.choice("FO"), dt.datetime(1997, 6, 1) + dt.timedelta(days=rng.randint(0, 300))))
    stamp = pa.timestamp("us")
    for name, rows, kinds in (("lineitem", lines, {"l_orderkey": pa.int64(), "l_partkey": pa.int64(), "l_suppkey": pa.int64(), "l_linenumber": pa.int32(), "l_quantity": pa.float64(),
                                                   "l_extendedprice": pa.float64(), "l_discount": pa.float64(), "l_tax": pa.float64(), "l_returnflag": pa.string(), "l_linestatus": pa.string(),
                                                   "l_shipdate": stamp}),
                              ("orders", heads, {"o_orderkey": pa.int64(), "o_orderdate": stamp, "o_orderpriority": pa.string()})):
        pq.write_table(pa.table([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds.values())], list(kinds)), at / f"{name}.parquet")
    return str(at)


@pytest.mark.parametrize("name, models", [("feature_importance", 1), ("gbt_scores", 1), ("model_comparison", 2), ("score_test", 1)])
def test_a_query_boosts_until_patience_is_spent(spark, orders, monkeypatch, name, models):
    """It made ten rounds and kept the best of them. (What it returns is held against the SQL in ``test_oracles``.)"""
    fits, fit = [], bo.fit
    monkeypatch.setattr(bo, "fit", lambda *a, **k: fits.append(fit(*a, **k)) or fits[-1])
    assert queries.REGISTRY[name](spark, orders).count() and len(fits) == models
    for model in fits:
        own = bo.COMPARISON if model.settings.symmetric else bo.PRIMARY
        assert model.settings == own and model.trained > queries.ML_ROUNDS
        assert model.trained == own.rounds or model.trained - model.rounds >= own.patience
