"""SimHash: fingerprints against the definition, links and components against all pairs, one row kept of each group."""
import random

import numpy as np
import pytest
import xxhash
from edge import counted, edge_documents, edge_rows, empty_documents
from panelscore.llm import simhash
from pyspark.sql import functions as F


def by_definition(text, k=3):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words)] if len(words) < k else [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


TEXTS = ["", None, "one", "two words", "A b C", "a B\u00a0c d é Ü", "x y z " * 50, "tab\tnew\nline \x0b vt", "the cat sat on the mat and the dog sat on the cat"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_the_definition(text):
    assert simhash.fingerprint(text and text.encode()) == by_definition(text)


def test_sparks_xxhash64_agrees_on_one_shingle(spark):
    df = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t"), simhash.fingerprint_column(F.col("t")))
    assert df.first()[0] == df.first()[1]


def brute_components(values, radius=2):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def planted(seed, n=600):
    """Random values, chains of values two bits apart, a dense cloud around one value."""
    rnd = random.Random(seed)
    out = [rnd.getrandbits(64) for _ in range(n)]
    for _ in range(30):
        x = rnd.choice(out)
        for _ in range(rnd.randint(1, 6)):
            x ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
            out.append(x)
    x = rnd.getrandbits(64)
    out += [x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(300)] + [0, 1, 3, 7, 2 ** 64 - 1, 2 ** 64 - 2]
    return sorted(set(out))


@pytest.mark.parametrize("seed,tile", [(1, 1024), (2, 16)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    values = planted(seed)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = simhash.links(nodes)
    assert links.count() <= 60 * len(values)
    got = {r["node"]: r["root"] for r in simhash.components(spark, links).collect()}
    groups = {}
    for v, c in zip(signed, brute_components(values)):
        groups.setdefault(c, set()).add(v)
    mine = {}
    for v in signed:
        mine.setdefault(got.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_query_on_the_test_tables_equals_all_pairs(spark, sf_dir):
    rows = simhash.query(spark, sf_dir).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    ids = sorted(docs)
    values = [by_definition(docs[i]) for i in ids]
    root = brute_components(values)
    least = {}
    for i, c in zip(ids, root):
        least[c] = min(least.get(c, i), i)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows}
    assert got == {i: (f"{v:016x}", least[c]) for i, v, c in zip(ids, values, root)}


@pytest.mark.parametrize("clashing", [False, True])
def test_one_row_of_each_group_stays(spark, clashing):
    docs = edge_documents(spark, clashing)
    kept = simhash.deduplicated(spark, docs)
    assert kept.columns == docs.columns
    rows = edge_rows()
    values = [by_definition(r[1]) for r in rows]
    groups = {}
    for r, c in zip(rows, brute_components(values)):
        groups.setdefault(c, []).append(r[0])
    want = sorted(str(min((i for i in g if i is not None), default=None)) for g in groups.values())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert set(counted(kept)) <= set(counted(docs)) and max(counted(kept).values()) == 1


def test_empty_table(spark):
    docs = empty_documents(spark)
    assert simhash.deduplicated(spark, docs).count() == 0
