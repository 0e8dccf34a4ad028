"""Mixing: targets by repeated resharing, seats one by one, and the words taken against the source's target."""
import heapq
import random
from collections import defaultdict

import pytest
from edge import edge_documents, empty_documents
from panelscore.llm import mixing


def reshared(sizes, weights, share=1.5, repeat=2):
    """By the contract's words: what is above a source's limit is shared again by weight until none is above."""
    total, out, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        rest = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if rest * weights[i] / w > repeat * sizes[i]}
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / w
            break
        for i in over:
            out[i] = repeat * sizes[i]
        open_ -= over
    return out


def test_targets_are_reshared():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randint(1, 12)
        sizes = [rnd.choice([0, 1, 10, rnd.randint(0, 10 ** 6)]) for _ in range(n)]
        weights = [mixing.WEIGHTS[i % 3] for i in range(n)]
        assert mixing.targets(sizes, weights) == pytest.approx(reshared(sizes, weights), rel=1e-9, abs=1e-6)
    assert mixing.targets([], []) == []


def test_seats_are_those_of_the_highest_quotients():
    rnd = random.Random(2)
    for _ in range(200):
        n = rnd.randint(1, 9)
        shares = [rnd.choice([0.0, 1.0, rnd.random() * 100]) for _ in range(n)]
        limits = [rnd.choice([0, 3, 10 ** 6]) for _ in range(n)]
        houses = sorted(rnd.randint(0, 300) for _ in range(4))
        seats, want, given = [0] * n, [], 0
        for h in houses:
            queue = [(-x / (2 * s + 1), i) for i, (x, s, m) in enumerate(zip(shares, seats, limits)) if s < m and x > 0]
            heapq.heapify(queue)
            while given < h and queue:
                _, i = heapq.heappop(queue)
                seats[i] += 1
                given += 1
                if seats[i] < limits[i]:
                    heapq.heappush(queue, (-shares[i] / (2 * seats[i] + 1), i))
            want.append(list(seats))
        assert mixing.apportion(shares, limits, houses) == want


def check(rows, docs):
    words = lambda t: len((t or "").translate(str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})).replace(" ", "\x00").split("\x00")) - (t or "").translate(str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})).replace(" ", "\x00").split("\x00").count("")
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += words(t)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, reshared([size[s] for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))])))
    taken = defaultdict(int)
    assert sorted(str((r[0], r[1], r[2])) for r in rows) == sorted(str((i, s, words(t))) for i, t, s in docs)
    for r in rows:
        _, s, n, total, want, got, pieces = r
        assert total == size[s] and want == pytest.approx(target[s], rel=1e-9) and 0 <= got <= 2 * n
        assert got == sum(p["words"] for p in pieces) and all(0 <= p["first"] and p["first"] + p["words"] <= n and p["words"] > 0 for p in pieces)
        at = [0] * n if n < 5000 else None
        if at is not None:
            for p in pieces:
                for k in range(p["first"], p["first"] + p["words"]):
                    at[k] += 1
            assert max(at, default=0) <= 2
        taken[s] += got
    return target, taken


def run(spark, df, **args):
    return [tuple(r) for r in mixing.mixed(spark, df, **args).select("doc_id", "source", *mixing.mix_columns(df.columns)).collect()]


@pytest.mark.parametrize("seats", [1 << 18, 500])
def test_words_taken_come_near_the_targets(spark, sf_dir, seats):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    rows = run(spark, df, seats=seats)
    target, taken = check(rows, docs)
    block = max(1, int(sum(target.values())) // seats)
    for s in target:
        assert abs(taken[s] - target[s]) <= 3 * block + 1
    # the same rows in other partitions give the same mix
    again = run(spark, df.repartition(7), seats=seats)
    assert sorted((r[0], r[5]) for r in rows) == sorted((r[0], r[5]) for r in again)
    # every shard has its share of the seats
    shards = defaultdict(int)
    for r in rows:
        for p in r[6]:
            shards[p["shard"]] += p["words"]
    assert sorted(shards) == list(range(mixing.SHARDS))
    assert max(shards.values()) - min(shards.values()) <= 0.1 * max(shards.values()) + 25 * block


def test_query_columns(spark, sf_dir):
    rows = mixing.query(spark, sf_dir)
    assert rows.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


@pytest.mark.parametrize("clashing", [False, True])
def test_edges(spark, clashing):
    df = edge_documents(spark, clashing)
    docs = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    target, taken = check(run(spark, df), docs)
    for s in target:
        assert abs(taken[s] - target[s]) <= 2
    out = mixing.mixed(spark, df)
    assert out.columns[:len(df.columns)] == df.columns and len(set(c.lower() for c in out.columns)) == len(out.columns)


def test_hot_source_and_empty_tables(spark):
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 11}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target, taken = check(run(spark, df), [(i, t, s) for i, t, s in rows])
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)
    assert mixing.mixed(spark, empty_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mixed(spark, blank).collect()] == [0, 0]


def test_small_sources_come_near_their_targets_beside_large_ones():
    sizes = {"a": (3_000_000_000, 3_000_000), "b": (2_000_000_000, 10 ** 6), "c": (3_000, 3), "d": (6_000, 3), "e": (15_000, 3), "f": (0, 2), "g": (7, 1), "h": (28_611, 4), None: (1, 1)}
    plan = {p["source"]: p for p in mixing.quotas(sizes)}
    for s, (n, _) in sizes.items():
        p = plan[s]
        assert p["words"] * p["blocks"] + p["more"] == n
        taken = sum(p["words"] + (k < p["more"]) for k in range(p["blocks"]) for r in range(2) if (k * p["stride"] + p["start"]) % p["blocks"] + r * p["blocks"] < p["ends"][-1])
        assert abs(taken - p["target"]) <= 0.01 * p["target"], (s, taken, p["target"])
        assert p["ends"] == sorted(p["ends"]) and p["ends"][-1] <= 2 * p["blocks"]
    assert max(p["blocks"] for p in plan.values()) <= 2 * mixing.SEATS


@pytest.mark.parametrize("seats", [1 << 18, 200])
def test_small_sources_keep_their_documents(spark, seats):
    rows = [(i, "w " * 2000, "large") for i in range(150)] + [(1000 + i, "w " * (3 + i % 5), f"s{i % 9}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target, taken = check(run(spark, df, seats=seats), rows)
    assert all(abs(taken[s] - target[s]) <= max(2, 0.01 * target[s]) for s in target)
