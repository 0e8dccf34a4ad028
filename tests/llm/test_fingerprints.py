"""Consistent weighted sampling: the contract's texts, equal texts, and the collision rate against the generalised Jaccard similarity."""
import hashlib
import random
from collections import Counter

import pytest
from edge import edge_documents, empty_documents
from panelscore.llm import cws
from pyspark.sql import functions as F


def python_free(df) -> bool:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return not any(x in buf.getvalue() for x in ("Python", "Pandas", "Arrow", "MapPartitions"))


def query_of(spark, docs, monkeypatch):
    monkeypatch.setattr(cws, "table", lambda *_: docs)
    return cws.query(spark, "")


def expected(rows):
    """(doc_id, n_chars, sha256 of the edited text, text) with the next row in descending doc_id; ids must be distinct."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = {}
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        out[i] = (len(t), t[:len(t) - half] + nxt[:half], nxt)
    return out


def jaccard(a, b):
    a, b = (Counter(t.lower().split()) for t in (a, b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_query_on_the_test_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(docs)
    rows = cws.query(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    text = dict(docs)
    by_text, error = {}, []
    for r in rows:
        n, edited, nxt = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        error += [r["near_edited"] - jaccard(text[r["doc_id"]], edited), r["near_next"] - jaccard(text[r["doc_id"]], nxt)]
    # the estimate of each pair has a standard error under 0.09 with 32 samples; its mean must vanish
    assert abs(sum(error) / len(error)) < 0.02 and (sum(e * e for e in error) / len(error)) ** 0.5 < 0.09


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    rnd = random.Random(3)
    pairs = []
    for shared, own in ((30, 0), (20, 10), (10, 30), (0, 20)):
        words = [f"w{i}" for i in range(shared)]
        a = [w for w in words for _ in range(rnd.randint(1, 9))] + [f"a{i}" for i in range(own) for _ in range(rnd.randint(1, 4))]
        b = [w for w in words for _ in range(rnd.randint(1, 9))] + [f"b{i}" for i in range(own) for _ in range(rnd.randint(1, 4))]
        pairs.append((len(pairs), " ".join(a) or " ", " ".join(b)))
    df = spark.createDataFrame(pairs, "i long, a string, b string")
    got = cws.fingerprints(df, ["i"], ["a", "b"], samples=1000).select("i", cws.likeness(F.col("a"), F.col("b"))).collect()
    for i, rate in got:
        assert rate == pytest.approx(jaccard(pairs[i][1], pairs[i][2]), abs=0.05)


def test_term_frequencies(spark):
    df = spark.createDataFrame([("b A b\ta  B c",), ("",), ("  ",), ("x",)], "t string").select(cws.terms(F.col("t")).alias("x"))
    got = [sorted(x["tf"] for x in r["x"]) for r in df.collect()]
    assert got == [[1, 2, 3], [], [], [1]]


def test_edges(spark, monkeypatch):
    docs = edge_documents(spark, clashing=True)
    rows = query_of(spark, docs, monkeypatch).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    zero = "0" * 8 * cws.SAMPLES
    assert all((r["fingerprint"] == zero) == (r["n_chars"] in (0, 6) and r["doc_id"] in (100, 101, 102, None)) for r in rows)
    assert [r["near_edited"] for r in rows if r["doc_id"] == 101] == [1.0]
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (0, 105)}) == 1


def test_one_row_and_no_row(spark, monkeypatch):
    one = spark.createDataFrame([(5, "abcd ef")], "doc_id long, text string")
    r = query_of(spark, one, monkeypatch).first()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdabc").hexdigest() and r["near_next"] == 1.0
    assert query_of(spark, empty_documents(spark), monkeypatch).count() == 0


def test_sparse_and_negative_keys(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 30)))) for i in rnd.sample(range(-10 ** 6, 10 ** 6), 60) + list(range(2 * 10 ** 6, 2 * 10 ** 6 + 150))]
    got = query_of(spark, spark.createDataFrame(rows, "doc_id long, text string"), monkeypatch).collect()
    want = expected(rows)
    assert {r["doc_id"]: r["edited_sha256"] for r in got} == {i: hashlib.sha256(e.encode()).hexdigest() for i, (_, e, _) in want.items()}


def test_main_path_is_native(spark, sf_dir):
    assert python_free(cws.query(spark, sf_dir))
