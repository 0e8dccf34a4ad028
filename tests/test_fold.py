"""History fold: FIXTURES §3 edge cases and agreement with a brute-force fold at every segment size."""
import math
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelscore.operators.fold import FoldSpec, duplicate_sequences, fold_history, with_steps

SPEC = FoldSpec(key="id", seq="rn", trend=("c",), recent=("c",), recent_n=3)


def _hist(spark, rows):
    return spark.createDataFrame(rows, "id long, rn long, c int")


def _one(spark, rows, spec=SPEC):
    return fold_history(_hist(spark, rows), spec).collect()[0].asDict()


def test_single_product(spark):
    r = _one(spark, [(1, 1, 5)])
    assert (r["c_mean"], r["c_max"], r["c_last"], r["c_recent3"], r["c_trend"], r["rn_cnt"]) == (5.0, 5, 5, 5.0, 0.0, 1)


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4], [4, 2, 0, 3, 1]])
def test_ordered_and_shuffled_history(spark, order):
    rows = [(1, i + 1, v) for i, v in enumerate([1, 2, 4, 4, 9])]
    r = _one(spark, [rows[i] for i in order])
    assert r["c_last"] == 9 and r["c_trend"] == 2.0 and math.isclose(r["c_recent3"], 17 / 3)


def test_gap_in_sequence(spark):
    assert _one(spark, [(1, 1, 1), (1, 2, 2), (1, 9, 3)])["c_recent3"] == 3.0


def test_null_code(spark):
    r = _one(spark, [(1, 1, 4), (1, 2, None)])
    assert r["c_mean"] == 4.0 and r["c_last"] is None and r["c_trend"] == 0.0


def test_duplicate_sequence_is_reported(spark):
    dups = duplicate_sequences(_hist(spark, [(1, 1, 1), (1, 1, 2), (1, 2, 3)])).collect()
    assert [(r["id"], r["rn"], r["n_rows"]) for r in dups] == [(1, 1, 2)]


def _brute(rows, n=3):
    """The reference's definition, row by row in pandas."""
    df = pd.DataFrame(rows, columns=["id", "rn", "c"]).sort_values(["id", "rn"])
    out = {}
    for k, g in df.groupby("id"):
        c = g["c"].astype("float")
        steps = (c - c.shift(1)).dropna()
        m = g["rn"].max()
        recent = c[g["rn"] > m - n].dropna()
        last = g["c"].iloc[-1]
        out[k] = dict(c_mean=c.mean() if c.notna().any() else None, c_max=c.max() if c.notna().any() else None,
                      c_last=None if pd.isna(last) else last, rn_cnt=len(g),
                      c_trend=steps.mean() if len(steps) else 0.0,
                      c_recent3=recent.mean() if len(recent) else None)
    return out


def _random_history(seed, keys=6, hot=400):
    rnd = random.Random(seed)
    rows = []
    for k in range(keys):
        size = hot if k == 0 else rnd.randint(1, 12)
        seqs = rnd.sample(range(1, size * 3 + 5), size)  # unique, with gaps
        for s in seqs:
            rows.append((k, s, None if rnd.random() < 0.15 else rnd.randint(0, 9)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment,strategy", [(3, "segmented"), (4, "segmented"), (7, "segmented"),
                                              (64, "segmented"), (1 << 16, "segmented"), (1 << 16, "single"),
                                              (4, "auto"), (1 << 16, "auto")])
def test_fold_equals_brute_force(spark, segment, strategy):
    rows = _random_history(segment)
    spec = FoldSpec(key="id", seq="rn", trend=("c",), recent=("c",), recent_n=3, segment=segment)
    got = {r["id"]: r.asDict() for r in fold_history(_hist(spark, rows), spec, strategy).collect()}
    want = _brute(rows)
    assert set(got) == set(want)
    for k, w in want.items():
        for col, v in w.items():
            g = got[k][col]
            if v is None or g is None:
                assert v is None and g is None, (k, col, g, v)
            else:
                assert math.isclose(g, v, rel_tol=1e-12, abs_tol=1e-12), (k, col, g, v)


@pytest.mark.parametrize("kind,values", [("int", list(range(-5, 6))), ("bigint", [6 * 10 ** 18, 6 * 10 ** 18 - 4, 3]), ("double", [0.5, -2.25, 8.0]),
                                         ("decimal(10,2)", [Decimal("1.10"), Decimal("-7.35"), Decimal("99999.99")])])
def test_both_plans_agree_in_rows_types_and_values(spark, kind, values):
    """NULL keys, one NULL sequence number per key, NULL codes: every row is kept, whatever the plan."""
    rnd = random.Random(kind)
    rows = []
    for key, n in ((None, 41), (1, 30), (2, 1), (3, 7)):
        for i in [None, *range(1, n)]:
            rows.append((key, i, None if rnd.random() < 0.1 else rnd.choice(values)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, f"id long, rn long, c {kind}")
    spec = FoldSpec(key="id", seq="rn", trend=("c",), recent=("c",), recent_n=3, segment=4)
    a, b = fold_history(df, spec, "single"), fold_history(df, spec, "segmented")
    assert [(f.name, f.dataType) for f in a.schema.fields] == [(f.name, f.dataType) for f in b.schema.fields]
    flat = lambda d: sorted(([str(v if not isinstance(v, float) else float(f"{v:.12g}")) for v in r] for r in d.collect()))
    assert flat(a) == flat(b) and len(flat(a)) == 4
    a, b = with_steps(df, spec, "single"), with_steps(df, spec, "segmented")
    assert a.schema == b.schema and flat(a) == flat(b) and len(flat(b)) == len(rows)


def test_no_measuring_job_without_a_window(spark):
    spec = FoldSpec(trend=(), recent=(), segment=1)
    broken = _hist(spark, [(1, 1, 1)]).withColumn("id", F.raise_error(F.lit("ran")).cast("long"))
    fold_history(broken, spec)  # a plan only: nothing runs


def test_hot_key_groups_stay_bounded(spark):
    """A key with most of the rows is cut into segments: no (key, segment) group exceeds the width."""
    rows = [(1, i, i % 7) for i in range(1, 5001)] + [(2, 1, 3)]
    spec = FoldSpec(key="id", seq="rn", trend=("c",), recent=("c",), recent_n=3, segment=256)
    from panelscore.operators.fold import _segmented
    sizes = _segmented(_hist(spark, rows), spec, carry=2).groupBy("id", "_seg").count()
    assert sizes.agg({"count": "max"}).collect()[0][0] <= 256 + 2
    r = {x["id"]: x for x in fold_history(_hist(spark, rows), spec).collect()}
    assert r[1]["rn_cnt"] == 5000 and r[1]["c_last"] == 5000 % 7
    assert math.isclose(r[1]["c_trend"], (5000 % 7 - 1) / 4999)


@pytest.mark.parametrize("segment,strategy", [(2, "segmented"), (5, "segmented"), (1 << 16, "segmented"),
                                              (1 << 16, "single")])
def test_steps_equal_lag(spark, segment, strategy):
    rows = _random_history(11, hot=50)
    spec = FoldSpec(key="id", seq="rn", trend=("c",), recent=(), segment=segment)
    got = {(r["id"], r["rn"]): (r["rn_max"], r["c_step"])
           for r in with_steps(_hist(spark, rows), spec, strategy).collect()}
    df = pd.DataFrame(rows, columns=["id", "rn", "c"]).sort_values(["id", "rn"])
    df["step"] = df["c"].astype("float") - df.groupby("id")["c"].shift(1).astype("float")
    df["mx"] = df.groupby("id")["rn"].transform("max")
    for r in df.itertuples():
        mx, step = got[(r.id, r.rn)]
        assert mx == r.mx
        assert (step is None and pd.isna(r.step)) or step == r.step


def test_labelled_mart_is_inner(spark):
    from panelscore.plans.queries import label_mart
    mart = fold_history(_hist(spark, [(1, 1, 1), (2, 1, 1)]), SPEC)
    target = spark.createDataFrame([(1, 0), (3, 1)], "id long, flag int")
    assert [r["id"] for r in label_mart(mart, target).collect()] == [1]


def test_auto_strategy_follows_the_largest_key(spark):
    from panelscore.operators.fold import choose_strategy
    rows = [(1, i, 0) for i in range(1, 11)] + [(2, 1, 0)]
    assert choose_strategy(_hist(spark, rows), FoldSpec(trend=(), recent=(), segment=10)) == "single"
    assert choose_strategy(_hist(spark, rows), FoldSpec(trend=(), recent=(), segment=9)) == "segmented"
