"""LM scoring: counts and base score against the definition, normalised probabilities, and better scores on held-out texts."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import edge_documents, empty_documents
from panelscore.llm import lbl
from panelscore.llm.common import in_fold
from pyspark.sql import functions as F


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w] + [None]


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def check_base(rows, docs):
    count = Counter(t for i, text in docs if not held(i) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    want = []
    for i, text in docs:
        ts = tokens(text)
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        want.append((str(i), held(i), len(ts), sum(count[t] > 0 for t in ts), n, round(base, 6)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows]
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-5)
    assert len(got) == len(want)


@pytest.mark.parametrize("local", [1 << 17, 300])
def test_query_on_the_test_tables(spark, sf_dir, monkeypatch, local):
    monkeypatch.setattr(lbl, "LOCAL", local)
    rows = lbl.query(spark, sf_dir).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check_base(rows, docs)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_class_tables_are_normalised():
    rng = np.random.default_rng(0)
    p = {k: rng.normal(0, 0.5, (lbl.CLASSES, lbl.DIM)).astype(np.float32) for k in ("q1", "q2", "r")} | {"bias": rng.normal(-5, 1, lbl.CLASSES).astype(np.float32)}
    a1, a2, z = lbl.log_tables(p)
    for a, b in ((0, 0), (3, 2000), (1500, 7)):
        logs = a1[a].astype(np.float64) + a2[b] - z[a, b]
        assert (10 ** logs).sum() == pytest.approx(1, abs=1e-4)
        direct = (p["q1"][a] + p["q2"][b]) @ p["r"].T + p["bias"]
        assert logs == pytest.approx((direct - np.log(np.exp(direct).sum())) / math.log(10), abs=1e-3)


def test_tokens_of_a_class_share_its_probability():
    top = [(b"the", 50), (lbl.END, 20), (b"walking", 5), (b"talking", 3)]
    totals = Counter()
    types = Counter()
    for t, n in [*top, (b"stalking", 2)]:
        totals[lbl.shared_class(t)] += n
        types[lbl.shared_class(t)] += 1
    old, lbl.OWN = lbl.OWN, lbl.OWN
    v = lbl.vocabulary_of(top, {c: (totals[c], types[c]) for c in totals}, 80, 5)
    # all five have classes of their own or share that of b"ing"
    c = lbl.shared_class(b"stalking")
    known = [10 ** (math.log10(2.1) - v.smooth[c])]
    assert sum(known) + 10 ** (math.log10(0.1) - v.smooth[c]) == pytest.approx(1)
    assert v.noise.sum() == pytest.approx(1)


def test_training_learns_what_follows_what(spark):
    texts = ["a b c d " * 60, "d c b a " * 60] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lbl.scored(spark, docs, F.lit(True)).collect()
    assert all(r["score"] > r["base_score"] * 0.75 for r in rows)


def test_edges(spark):
    docs = edge_documents(spark, clashing=True)
    rows = lbl.scored(spark, docs.withColumnRenamed("text", "t"), ~in_fold(F.col("doc_id"), 10, 0), text="t").withColumn("held_out", ~F.col("learn")).collect()
    check_base(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert len({r["score"] for r in rows if r["n_tokens"] == 1}) == 1
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1


def test_nothing_to_learn_from(spark):
    docs = edge_documents(spark)
    rows = lbl.scored(spark, docs, F.lit(False)).collect()
    assert len(rows) == docs.count() and all(r["base_score"] == pytest.approx(0, abs=1e-9) and r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert lbl.scored(spark, empty_documents(spark), F.lit(True)).count() == 0


def test_the_end_token_counts_whatever_the_vocabulary(spark, monkeypatch):
    """A level of equally frequent tokens that does not fit is cut, and END is kept."""
    monkeypatch.setattr(lbl, "LOCAL", 100)
    i = next(i for i in range(100) if not held(i))
    docs = [(i, " ".join(f"w{j}" for j in range(1500))), (i + 1000 * 10, "w1"), (None, "w1 w2 unknown")]
    docs = [docs[0], *[d for d in docs[1:]]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = lbl.scored(spark, df, ~in_fold(F.col("doc_id"), 10, 0)).withColumn("held_out", ~F.col("learn")).collect()
    check_base(rows, docs)
    counts = lbl.token_counts(df.limit(1).select(F.col("text").cast("binary").alias("t")))
    top = lbl.most_frequent(counts, 100)
    assert 20 <= len(top) <= 101 and lbl.END in [t for t, _ in top]
    assert lbl.most_frequent(counts, 100, most_bytes=60)
