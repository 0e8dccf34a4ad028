"""Benchmark decontamination: exact edit distances, recall against brute force, clean documents left alone."""
import random

import numpy as np
import pytest
from edge import edge_documents, empty_documents
from panelscore.llm import cgk


def least_by_table(item, text):
    """Sellers' table: least edits between the item and any stretch of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != w), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_least_edits_is_the_table():
    rnd = random.Random(1)
    for _ in range(300):
        item = [rnd.randrange(4) for _ in range(rnd.randint(1, 70))]
        text = [rnd.randrange(5) for _ in range(rnd.randint(0, 90))]
        if rnd.random() < 0.5:
            text[10:10] = item[:rnd.randint(0, len(item))]
        want = least_by_table(item, text)
        for limit in (0, want, want + 2):
            got = cgk.least_edits(np.array(item), np.array(text, int), limit)
            assert got[0] == min(want, limit + 1) and (got[1] >= 0) == (want <= limit)


def edited(rnd, words, share):
    words = list(words)
    for _ in range(int(len(words) * share)):
        q = rnd.randrange(len(words))
        what = rnd.randrange(3)
        if what == 0:
            words[q] = f"new{rnd.randrange(10 ** 6)}"
        elif what == 1:
            del words[q]
        else:
            words.insert(q, f"ins{rnd.randrange(10 ** 6)}")
    return words


def corpus(seed, n_items=60, n_docs=400):
    rnd = random.Random(seed)
    lexicon = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(4000)]
    pick = lambda n: [rnd.choice(lexicon) for _ in range(n)]
    items = [(i, " ".join(pick(rnd.choice([1, 2, 3, 5, 8, 14, 20, 35, 60, 150])))) for i in range(n_items)]
    docs = []
    for d in range(n_docs):
        words = pick(rnd.randint(0, 400))
        if d % 2:
            at = rnd.randint(0, len(words))
            words[at:at] = edited(rnd, items[rnd.randrange(n_items)][1].split(), rnd.choice([0, 0, 0.05, 0.1, 0.2]))
        docs.append((d, " ".join(words)))
    return items, docs


@pytest.mark.parametrize("seed", [1, 2])
def test_recall_against_brute_force(seed):
    items, docs = corpus(seed)
    index = cgk.Index([(i, t.encode()) for i, t in items])
    found = index.matches([cgk.symbols(t.encode()) for _, t in docs])
    truth = got = 0
    for (d, text), matches in zip(docs, found):
        s = cgk.symbols(text.encode()).tolist()
        have = {m["item_id"]: m for m in matches}
        for number, (i, _) in enumerate(items):
            item = index.items[number].tolist()
            want = least_by_table(item, s) if set(item) & set(s) else len(item)
            if want <= index.limit(number):
                truth += 1
                if i in have:
                    got += 1
                    m = have[i]
                    assert want <= m["edits"] <= index.limit(number)
                    assert least_by_table(item, s[m["first_word"]:m["end_word"]]) <= m["edits"]
                elif want == 0:
                    raise AssertionError(f"unchanged item {i} was missed in {d}")
            else:
                assert i not in have
    assert truth > 200 and got / truth >= 0.95


def test_query_on_the_test_tables(spark, sf_dir):
    """Whole documents against brute force on the items' words, at the same limits."""
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in cgk.query(spark, sf_dir).collect()}
    want = set()
    for d, text in docs.items():
        s = cgk.symbols(text.encode()).tolist()
        for i, t in items.items():
            item = cgk.symbols(t.encode()).tolist()
            if sum(x in set(item) for x in s) >= 0.8 * len(item) and least_by_table(item, s) <= int(0.2 * len(item) + 1e-9):
                want.add((d, i))
    assert got <= want and len(got) >= 0.95 * len(want) and want


def test_first_word_of_a_document_and_cut_items():
    index = cgk.Index([(7, b"a b c d e f g h i j k l m n o p")])
    spans = lambda t: [(m["edits"], m["first_word"], m["end_word"]) for m in index.matches([cgk.symbols(t)])[0]]
    assert spans(b"a b c d e f g h i j k l m n o p") == [(0, 0, 16)]
    assert spans(b"A, B; c d e f g h i j k l m n o p!") == [(0, 0, 16)]
    assert spans(b"c d e f g h i j k l m n o p") == [(2, 0, 14)]
    assert spans(b"x y a b c d e f g h i j k l m n o p z") == [(0, 2, 18)]
    assert spans(b"e f g h i j k l") == []


def test_edges(spark):
    docs = edge_documents(spark, clashing=True)
    bench = spark.createDataFrame([(1, "fox jumps over the lazy dog and runs away"), (2, None), (3, ""), (4, "... !!"), (None, "some words"), (1, "fox jumps over the lazy dog and runs away")],
                                  "item_id long, text string")
    kept = cgk.decontaminated(spark, docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["100", "101", "102", "103", "104", "2", "None"])
    m = {r["doc_id"]: r["m"] for r in cgk.matched(spark, docs, bench, out="m").where("doc_id IN (5, 103)").collect()}
    assert [x["item_id"] for x in m[5]] == [1, 1] and m[103] == []
    assert cgk.decontaminated(spark, docs, bench.limit(0)).count() == docs.count()
    assert cgk.decontaminated(spark, empty_documents(spark), bench).count() == 0


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items, docs = corpus(4, n_items=30, n_docs=60)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    flat = lambda df: sorted((r["doc_id"], sorted(x["item_id"] for x in r["matches"])) for r in df.collect())
    one = flat(cgk.matched(spark, d, b))
    monkeypatch.setattr(cgk, "BLOCK_ITEMS", 14)
    assert flat(cgk.matched(spark, d, b)) == one


def in_runs(rnd, words, where, count):
    """``count`` edits of one kind that stand together: at the head, in the middle, at the tail, or in two runs."""
    n = len(words)
    begins = {"head": [(0, count)], "middle": [((n - count) // 2, count)], "probed": [(max(0, 3 * cgk.window_length(n) // 4 - count // 2), count)],
              "tail": [(n - count, count)], "two": [(n // 4, count // 2), (3 * n // 4, count - count // 2)]}[where]
    out = list(words)
    what = rnd.randrange(3)
    for at, k in reversed(begins):
        fresh = [f"new{rnd.randrange(10 ** 9)}" for _ in range(k)]
        out[at:at + (0 if what == 2 else k)] = [] if what == 1 else fresh
    return out


def lsh_recall(n, changed, items=60):
    """The share of copies that are found, of unlike words around and in the items; nothing else may be found."""
    rnd = random.Random(n)
    items = [(i, [f"i{i}w{j}" for j in range(n)]) for i in range(items)]
    index = cgk.Index([(i, " ".join(w).encode()) for i, w in items])
    docs = [[f"x{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(40))] + changed(rnd, w, index.limit(0)) + [f"y{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(40))]
            for _, w in items]
    found = index.matches([cgk.symbols(" ".join(d).encode()) for d in docs])
    assert all(m["item_id"] == i for (i, _), f in zip(items, found) for m in f)
    return sum(map(len, found)) / len(items)


@pytest.mark.parametrize("where", ["head", "middle", "probed", "tail", "two"])
@pytest.mark.parametrize("n", [5, 10, 15, 23, 46, 59, 94, 150])
def test_recall_of_edits_that_stand_together(n, where):
    assert lsh_recall(n, lambda rnd, w, k: in_runs(rnd, w, where, k)) >= 0.9


@pytest.mark.parametrize("n", [5, 10, 15, 23, 46, 59, 94, 150])
def test_recall_of_edits_spread_and_at_random(n):
    def spread(rnd, w, k):
        w = list(w)
        for e in range(k):
            w[(e + 1) * n // (k + 1)] = f"new{rnd.randrange(10 ** 9)}"
        return w

    assert lsh_recall(n, spread) >= 0.9
    assert lsh_recall(n, lambda rnd, w, k: edited(rnd, w, k / n + 1e-9)) >= 0.9


def test_item_ids_that_are_no_numbers(spark):
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    bench = spark.createDataFrame([("a7", "one two three four five"), ("8", "two three four five six"), (None, "three four five six")], "item_id string, text string")
    assert [m["item_id"] for m in cgk.matched(spark, docs, bench).first()["matches"]] == [-1, -1, 8]


def test_a_word_said_again_and_again(monkeypatch):
    monkeypatch.setattr(cgk, "HITS", 50)
    index = cgk.Index([(1, b"a " * 30), (2, b"a " * 20 + b"b " * 20)])
    found = index.matches([cgk.symbols(b"a " * 3000), cgk.symbols(b"a " * 10 + b"b " * 10), cgk.symbols(b"a " * 16 + b"b " * 18)])
    assert [[m["item_id"] for m in f] for f in found] == [[1], [], [2]]
