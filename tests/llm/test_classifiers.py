"""Toxicity, quality and language: held-out accuracy on the test tables, the models' formulas, the edge cases."""
import math
import random

import numpy as np
import pytest
from edge import edge_documents, edge_labels, empty_documents
from panelscore.llm import centroids, ordinal, subwords
from panelscore.llm.common import in_fold
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def larger(sf_dir):
    """The classifiers need some labelled rows to learn from."""
    return sf_dir.replace("sf0.001", "sf0.01")


def test_quality_on_the_held_out_fold(spark, larger):
    rows = subwords.query(spark, larger)
    assert rows.count() == spark.read.parquet(f"{larger}/documents.parquet").count()
    assert rows.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.7 AS INT)").count() == 0
    held = rows.join(spark.read.parquet(f"{larger}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (held["predicted"] == held["quality"]).mean() >= 0.95


def test_toxicity_on_the_held_out_fold(spark, larger):
    rows = ordinal.query(spark, larger)
    assert rows.count() == spark.read.parquet(f"{larger}/documents.parquet").count()
    assert rows.where("expected_severity < p_any OR expected_severity > 2 * p_any").count() == 0
    held = rows.join(spark.read.parquet(f"{larger}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (held["toxic_predicted"] == held["toxic"]).mean() >= 0.93
    assert held[held["toxic"] == 1]["p_any"].mean() > 10 * held[held["toxic"] == 0]["p_any"].mean()


def test_toxicity_with_more_labels(spark, sf_dir):
    d = sf_dir.rsplit("/", 1)[0] + "/sf0.1"
    held = ordinal.query(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (held["toxic_predicted"] == held["toxic"]).mean() >= 0.98
    assert held[held["toxic"] == 0]["toxic_predicted"].mean() <= 0.005


def test_language_on_the_held_out_fold(spark, larger):
    rows = centroids.query(spark, larger)
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    assert rows.count() == docs.count()
    held = rows.join(docs, "doc_id").where("held_out").toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.99 and held["score"].between(0, 1).all()


def test_folds_are_those_of_crc32(spark):
    import zlib
    df = spark.range(500).select("id", in_fold(F.col("id"), 4, 2).alias("held"))
    assert all(r["held"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in df.collect())
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(in_fold(F.col("id"), 4, 2)).first()[0] is True


def test_ordinal_model_recovers_ordered_grades_with_shared_weights():
    rnd = np.random.default_rng(1)
    ids, grade = [], []
    for _ in range(2000):
        marks = rnd.integers(0, 5)
        ids.append(np.concatenate([rnd.choice(50, marks, replace=False), 1000 + rnd.choice(400, 20, replace=False)]))
        grade.append(0 if marks == 0 else 1 if marks < 3 else 2)
    w, theta = ordinal.fit_numpy(ids, np.array(grade), 3)
    assert theta[0] < theta[1] and w[:50].min() > 0.2 and np.abs(w[1000:1400]).mean() < 0.1 * w[:50].mean()
    s = np.array([w[i].sum() for i in ids])
    assert (((s > theta[0]).astype(int) + (s > theta[1])) == grade).mean() > 0.95


def test_ordinal_gradient_is_that_of_the_likelihood():
    """P(grade = k) = F_k - F_(k+1): its derivative by the score is 1 - F_k - F_(k+1), times P."""
    sig = lambda x: 1 / (1 + math.exp(-x))
    for s, a, b in ((0.3, -1, 0.5), (2.0, 0.1, 0.2)):
        p = lambda s: sig(s - a) - sig(s - b)
        assert (math.log(p(s + 1e-6)) - math.log(p(s - 1e-6))) / 2e-6 == pytest.approx(1 - sig(s - a) - sig(s - b), abs=1e-6)


def test_word_features_do_not_depend_on_the_other_words():
    words = [b"a", b"toxic", b"caf\xc3\xa9", b"x" * 200, b"<>"]
    ids, n = subwords.features(words)
    at = np.cumsum(n) - n
    for i, w in enumerate(words):
        alone, m = subwords.features([w])
        assert m[0] == n[i] and (alone == ids[at[i]:at[i] + n[i]]).all()


def test_folded_layer_equals_averaged_vectors(spark):
    rng = np.random.default_rng(2)
    vectors, layer = rng.normal(size=(subwords.BUCKETS, subwords.DIM)), rng.normal(size=subwords.DIM)
    text = "one two two three THREE"
    words = [w.encode() for w in text.split()] + [subwords.REPEATED]
    want = sum(vectors[subwords.features([w])[0]].mean(0) for w in words) / (len(words) + subwords.NEUTRAL) @ layer + 0.25
    df = spark.createDataFrame([(text,)], "t string").select(subwords.probability(spark, ((vectors @ layer).astype(np.float64), 0.25))(F.col("t")))
    assert df.first()[0] == pytest.approx(1 / (1 + math.exp(-want)), rel=1e-9)


@pytest.mark.parametrize("clashing", [False, True])
def test_scoring_keeps_rows_and_columns(spark, clashing):
    docs, labels = edge_documents(spark, clashing), edge_labels(spark)
    a = subwords.scored(spark, docs, labels, "q").cache()
    b = ordinal.graded(spark, docs, labels, "t").cache()
    assert a.columns == docs.columns + ["q"] and b.columns == docs.columns + ["t"]
    assert a.drop("q").exceptAll(docs).count() == 0 and a.count() == docs.count() == b.count()
    for df, c in ((a, "q"), (b, "t.p_any")):
        assert df.where(f"{c} IS NULL OR {c} < 0 OR {c} > 1").count() == 0
        assert df.where("text IS NULL OR text = ''").select(c).distinct().count() == 1  # no features: one score
        assert df.where("doc_id = 1").select(c).distinct().count() == 1


def test_nothing_to_learn_from(spark):
    docs, labels = edge_documents(spark), edge_labels(spark)
    assert {r["q"] for r in subwords.scored(spark, docs, labels.limit(0), "q").collect()} == {0.5}
    assert all(r["t"]["p_any"] < 1e-6 for r in ordinal.graded(spark, docs, labels.limit(0), "t").collect())
    assert subwords.scored(spark, empty_documents(spark), labels, "q").count() == 0
    assert ordinal.graded(spark, empty_documents(spark), labels, "t").count() == 0
    one = subwords.scored(spark, docs, labels.where("quality = 1"), "q").select("q").distinct().collect()
    assert all(0.5 < r["q"] <= 1 for r in one)


def test_language_edges(spark):
    rnd = random.Random(1)
    def text(words, n=40): return " ".join(rnd.choice(words) for _ in range(n))  # noqa: E704
    en, de = ["the", "and", "house", "with", "this", "thing"], ["der", "und", "haus", "mit", "dieses", "straße", "größe"]
    rows = [(i, text(en if i % 2 else de), "en" if i % 2 else "de") for i in range(80)]
    odd = [(200, None, "en"), (201, "", "en"), (202, "123 ... !!", "en"), (203, "THE HOUSE AND THE THING!!", None), (None, "der haus und dieses", None), (0, rows[0][1], "de"),
           (204, "the house " * 20_000, None), (205, "漢字漢字漢字漢字", None), (206, "é", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = centroids.fit(docs, ~in_fold(F.col("doc_id"), 5, 0))
    got = {r["doc_id"]: r["m"] for r in docs.select("doc_id", centroids.identify(spark, model)(F.col("text")).alias("m")).collect()}
    assert all(got[i]["lang"] == "und" and got[i]["score"] == 0 for i in (200, 201, 202))
    assert got[203]["lang"] == got[204]["lang"] == "en" and got[None]["lang"] == "de"
    assert got[205]["rejected"] and got[205]["lang"] in ("en", "de") and not got[1]["rejected"]
    assert centroids.fit(docs.where("lang IS NULL"), F.lit(True)) is None
    none = docs.select(centroids.identify(spark, None)(F.col("text")).alias("m")).select("m.lang").distinct().collect()
    assert [r[0] for r in none] == ["und"]
    assert docs.limit(0).select(centroids.identify(spark, model)(F.col("text"))).count() == 0


def test_document_frequencies_are_counted_over_all_rows(spark):
    texts = [b"abc abd", b"abc", b"", b"xyz" * 50]
    df, n = centroids.document_frequencies(spark.createDataFrame([(t,) for t in texts], "t binary").repartition(3))
    assert n == 4 and (df == sum((centroids.counts(t) > 0).astype(int) for t in texts)).all()


def test_all_of_a_long_word_counts(monkeypatch):
    rnd = random.Random(3)
    words = [b"short", bytes(rnd.choices(b"abcdefgh", k=5000)), "漢字仮名交じり文".encode() * 30, b"x" * 63, b"<>", bytes(rnd.choices(b"abc", k=700))]
    ids, n = subwords.features(words)
    assert n.tolist() == [1 + sum(len(w) + 3 - k for k in range(3, 6)) for w in words] == subwords.counted_features(words).tolist()
    share = np.random.default_rng(1).normal(size=subwords.BUCKETS)
    want = subwords.word_shares(words, share)
    at = np.cumsum(n) - n
    assert want == pytest.approx(np.add.reduceat(share[ids], at) / n, rel=1e-9)
    tail = subwords.word_shares([words[1][:64] + b"z" * 4936], share)[0]
    assert tail != want[1]  # the same first 64 bytes
    doc = subwords._document_features(subwords.pa.array([b" ".join(words)]))
    monkeypatch.setattr(subwords, "PART_BYTES", 100)
    assert subwords.word_shares(words, share) == pytest.approx(want, rel=1e-9)
    small, m = subwords.features(words)
    assert (m == n).all() and all(sorted(small[a:a + k]) == sorted(ids[a:a + k]) for a, k in zip(at, n))
    again = subwords._document_features(subwords.pa.array([b" ".join(words)]))
    assert again[0]["ids"] == doc[0]["ids"]
    assert np.frombuffer(again[0]["weights"].as_py(), np.float32) == pytest.approx(np.frombuffer(doc[0]["weights"].as_py(), np.float32), rel=1e-4)


def test_no_language_is_lost_to_copies(spark):
    """Eight languages of much-copied texts: each has centroids, and a text's copies reach the driver once."""
    names = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh"]
    letters = {l: "".join(chr(0x100 + 24 * i + j) for j in range(12)) for i, l in enumerate(names)}
    text = lambda l, n: " ".join("".join(random.Random(f"{l}{n}{w}").choices(letters[l], k=6)) for w in range(30))
    rows = [(text(l, n % 2), l) for l in names for n in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = centroids.fit(docs, F.lit(True), train_rows=16)
    assert sorted(set(model["names"])) == names and len(model["names"]) <= 16
    told = docs.distinct().select("lang", centroids.identify(spark, model)(F.col("text")).alias("m")).collect()
    assert all(r["lang"] == r["m"]["lang"] for r in told)


def test_language_is_the_nearest_centroids(spark, larger):
    """The query's answers against a cosine for every text and centroid, from the definition."""
    docs = spark.read.parquet(f"{larger}/documents.parquet").orderBy("doc_id").limit(300)
    model = centroids.fit(docs, F.lit(True))
    got = docs.select("doc_id", "text", centroids.identify(spark, model)(F.col("text")).alias("m")).collect()
    for r in got:
        if r["text"] is None or not any(map(str.isalpha, r["text"])):
            assert (r["m"]["lang"], r["m"]["score"]) == ("und", 0.0)
            continue
        v = np.log1p(centroids.counts(r["text"].encode())) * model["idf"]
        cosines = [float(v @ c) / max(1e-12, math.sqrt(float(v @ v))) for c in model["centers"]]
        assert r["m"]["lang"] == model["names"][int(np.argmax(cosines))] or max(cosines) - cosines[list(model["names"]).index(r["m"]["lang"])] < 1e-5
        assert abs(r["m"]["score"] - min(1.0, max(0.0, max(cosines)))) < 1e-4


@pytest.mark.parametrize("fit", [ordinal.fit, subwords.fit])
def test_a_key_on_many_rows_is_one_row_of_the_sample(spark, fit, monkeypatch):
    from panelscore.llm import common
    docs = spark.createDataFrame([(7, f"copy number {i}") for i in range(500)] + [(i, f"text {i} of words") for i in range(8, 20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(5000)], "doc_id long, quality int, toxic int")
    seen = []
    real = common.labelled_sample
    module = ordinal if fit is ordinal.fit else subwords
    monkeypatch.setattr(module, "labelled_sample", lambda *a: seen.append(real(*a)) or seen[-1])
    fit(docs, labels, F.lit(True), train_rows=10_000)
    # labels of rows that are not there don't thin the sample, and the repeated key is one row
    assert sorted(r["_k"] for r in seen[0].collect()) == [7, *range(8, 20)]


def test_the_fit_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(subwords, "FIT_BYTES", 1)
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    share, bias = subwords.fit(docs, labels, F.lit(True))  # one row is left
    assert np.isfinite(share).all() and math.isfinite(bias)
