"""Cross-tokenizer alignment (operator 12) against a definition that compares every token pair of a group."""
import functools
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import CLASHING, edge_documents, edge_rows, empty_documents
from pyspark.sql import functions as F

from panelscore.llm import alignment as al


@pytest.fixture(scope="module")
def pair():
    return al.pair_of(al.A, al.B)


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text, from whole encodings."""
    a_of, b_of = al.byte_bpe(al.A, True), al.sentences(al.B)
    bytes_a, bytes_b = al.byte_bpe_entries(al.A), al.sentence_pieces(al.B)
    docs, count = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        a, b = (a_of.encode(" " + t, add_special_tokens=False).ids, b_of.encode(t)) if t else ([], [])
        if not t or b"".join(bytes_a[i] for i in a) != raw or b"".join(bytes_b[i] for i in b) != raw:
            docs.append(None)
            continue
        spans = []
        for ids, entries in ((a, bytes_a), (b, bytes_b)):
            at, row = 0, []
            for i in ids:
                row.append((at, at + len(entries[i]), i))
                at += len(entries[i])
            spans.append(row)
        groups, links, begin = [], [], 0
        for end in sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}):
            ga, gb = ([x for x in row if begin <= x[0] and x[1] <= end] for row in spans)
            groups.append(",".join(str(i) for *_, i in ga) + "|" + ",".join(str(i) for *_, i in gb))
            links += [(i, j) for s, e, i in ga for p, q, j in gb if s < q and p < e]
            begin = end
        count.update(links)
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(0,) * 6 + ("",) if d is None else (*d[:3], len(d[3]), sum(count[x] == best[x[1]] for x in d[3]), sum(count[x] for x in d[3]), d[4]) for d in docs]


PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "é", "中", "1", "!", " ", "　", "\x1c", "▁", "\r", "<|endoftext|>", "😀", "<s>", "word", "ing"]


def random_texts(n, most=30, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def result(df):
    return [tuple(r)[1:] for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("args", [{}, {"chunk": 16, "reach": 64, "fan": 2, "head": 10}, {"chunk": 40, "reach": 30, "fan": 3, "head": 0}])
def test_equals_brute_force_whole_and_in_chunks(spark, args):
    texts = [*random_texts(600), None, "", "▁", " ", "word " * 300, "nospaceatall" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(al.alignment(spark, docs, **args)) == brute(texts)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    want = brute([r["text"] for r in docs])
    assert result(al.query(spark, sf_dir)) == want and sum(w[0] for w in want) > 0


def test_edge_rows_repeats_and_clashing_names(spark):
    extra = [*CLASHING, "n_a", "n_best", "keys", "counts", "pair", "c", "raw", "start", "no"]
    docs = edge_documents(spark).select("*", *[F.lit(1).alias(c) for c in dict.fromkeys(x.lower() for x in extra)])
    got = sorted(map(tuple, al.alignment(spark, docs, chunk=1000).collect()), key=repr)
    rows = edge_rows()
    assert got == sorted(((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]))), key=repr)


def test_empty_table(spark):
    df = al.alignment(spark, empty_documents(spark))
    assert df.count() == 0 and df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _equal(x, y):
    same = lambda u, v: np.array_equal(u, v) if isinstance(u, np.ndarray) else u == v
    return all(same(u, v) if not isinstance(u, al.Groups) else all(map(same, u, v)) for u, v in zip(x, y))


def test_fragments_are_a_monoid(pair):
    """Any cut of a text into ranges, composed in any order, is the fragment of the whole; an empty range changes nothing."""
    rng = random.Random(7)
    for text in random_texts(150, 60, seed=8):
        raw = (" " + text).encode()
        parts = pair.cut([" " + text])[0]
        rows = pair.token_rows(" " + text, parts, 0)
        if rows is None:
            continue
        whole = al.fragment(pair, *rows)
        borders = sorted({0, len(raw), *(rng.randrange(len(raw) + 1) for _ in range(6))})
        pieces = [al.fragment(pair, *(r[:, (r[1] > s) & (r[1] <= e)] for r in rows)) for s, e in zip(borders, borders[1:])]
        join = functools.partial(al.compose, pair)
        assert _equal(functools.reduce(join, pieces), whole)
        while len(pieces) > 1:
            i = rng.randrange(len(pieces) - 1)
            pieces[i:i + 2] = [join(pieces[i], pieces[i + 1])]
        assert _equal(pieces[0], whole)
        none = al.fragment(pair, al._NONE, al._NONE)
        assert _equal(join(none, whole), whole) and _equal(join(whole, none), whole)
        assert not join(al.BAD, whole).good


def test_chunks_cover_the_text_and_open_in_words(pair):
    raw = (" " + " ".join(f"word{i}ing" for i in range(400))).encode()
    places = al.chunk_places(raw, 100, 40)
    assert len(places) > 30 and [p[1] for p in places[:-1]] == [p[0] for p in places[1:]] and (places[0][0], places[-1][1]) == (0, len(raw))
    found = list(al.chunk_fragments(pair, [(raw[a:b], s, e, a) for s, e, a, b in places]))
    assert any(f.tail_a.shape[1] or f.tail_b.shape[1] for f in found)  # some chunk ends inside a group
    assert al.chunk_places(b" " + b"x" * 1000, 100, 40) == [(0, 1001, 0, 1001)]  # no safe place: one chunk


def test_packed_fragments_come_back(pair):
    rows = pair.token_rows(" some words here", pair.cut([" some words here"])[0], 0)
    f = al.fragment(pair, *rows)
    assert _equal(al._unpacked(al._packed(f)), f)


def test_units_kept_are_bounded(pair, monkeypatch):
    monkeypatch.setattr(al, "UNITS_KEPT", 5)
    fresh = al.Pair(al.A, al.B)
    texts = [" " + t for t in random_texts(40, 20, seed=3)]
    for i in range(0, 40, 4):
        for t, parts in zip(texts[i:i + 4], fresh.cut(texts[i:i + 4])):
            a, b = fresh.ids(t, parts), pair.ids(t, pair.cut([t])[0])
            assert (a is None) == (b is None) and (a is None or all(map(np.array_equal, a, b)))
