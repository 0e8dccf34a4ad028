"""Token counts (operator 13) against the library's own encoding."""
import random

import pytest
from edge import CLASHING, edge_documents, edge_rows, empty_documents
from pyspark.sql import functions as F

from panelscore.llm import token_counts as tc
from panelscore.llm import tokenizing as tk


@pytest.fixture(scope="module")
def library():
    return tk.byte_bpe(tc.TOKENIZER, False)


def _length(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "中", "1", "!", " ", "　", "\x1c", "\x85", "᠎", "​", "\r", "<|endoftext|>", "😀", "́", "²", "word", "՘"]


def _random_texts(n, most=14):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_counts_equal_the_library(spark, library):
    texts = _random_texts(2000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for head in (tc.HEAD, 5, 0):
        got = {r["doc_id"]: r for r in tc.token_counts(spark, docs, head=head, limit=6).collect()}
        for i, t in enumerate(texts):
            n = _length(library, t)
            assert tuple(got[i])[1:] == (len(t.encode()), n, n > 6), repr(t)


def test_whole_table(spark, sf_dir, library):
    want = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = tc.query(spark, sf_dir).collect()
    assert len(rows) == len(want)
    for r in rows:
        n = _length(library, want[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(want[r["doc_id"]].encode()), n, n > 1024)


def test_edge_rows_and_clashing_names(spark, library):
    extra = [*CLASHING, "n_bytes", "n_tokens", "row", "known", "rest", "pretoken"]
    docs = edge_documents(spark).select("*", *[F.lit(1).alias(c) for c in dict.fromkeys(x.lower() for x in extra)])
    got = sorted(map(tuple, tc.token_counts(spark, docs).collect()), key=repr)
    want = sorted(((r[0], len((r[1] or "").encode()), n := _length(library, r[1] or ""), n > 1024) for r in edge_rows()), key=repr)
    assert got == want


def test_empty_table(spark):
    df = tc.token_counts(spark, empty_documents(spark))
    assert df.count() == 0 and df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_the_most_used_pretokens_keep_their_bounds(spark):
    pieces = spark.createDataFrame([("a", 100, 1), ("b", 70, 1), ("c", 3, 2), ("d", 2, 2), ("x" * 5000, 500, 9)], "pretoken string, uses long, pieces long")
    assert tc.most_used(pieces, 2) == {"a": 1, "b": 1}
    assert tc.most_used(pieces, 3) == {"a": 1, "b": 1}  # c and d are of one level
    assert tc.most_used(pieces, 10) == {"a": 1, "b": 1, "c": 2, "d": 2}
    assert tc.most_used(pieces, 10, most_bytes=1) == {}


def test_the_pattern_agrees_with_the_library_where_it_is_used(library):
    """Every character of the blocks where the pattern is applied: as a letter, number, other sign, space and at an end."""
    pattern = tk.split_pattern()
    ranges = [(0, 0x530), (0x2000, 0x2070), (0x3000, 0x3200), (0x4E00, 0x4F00), (0x9F00, 0xA000), (0xAC00, 0xAD00), (0xD700, 0xD7A4)]
    for c in (chr(i) for a, b in ranges for i in range(a, b)):
        assert not tk._UNSURE.search(c)
        text = f"a{c}a1{c}1!{c}! {c}  {c}\0"
        assert [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)] == pattern.findall(text), hex(ord(c))
        assert (f" {c}"[1:].isalpha()) <= (pattern.findall(f" {c}") == [f" {c}"])
    assert tk._UNSURE.search("՘") and tk._UNSURE.search("\U0001f600")


def test_units_have_the_texts_pretokens(library):
    for t in _random_texts(4000):
        parts = tk.units(t)
        if parts is not None:
            whole = [t[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(t)]
            assert "".join(parts) == t and [p for u in parts for p in tk.pretokens(library, u, True)] == whole, repr(t)


def test_spelling_is_the_librarys(library):
    for t in ["a b", " é中😀\n", "\x00\x7f\xad", "plain"]:
        assert tk.spelled(t) == "".join(s for s, _ in library.pre_tokenizer.pre_tokenize_str(t))
    assert len(tk.byte_alphabet()) == 256


def test_parts_behind_spaces_are_the_units_of_the_text(library):
    """Most texts are cut at spaces alone (they went through a pattern), and their pre-tokens are the library's."""
    splitter, plain = tc.Splitter(tc.TOKENIZER), 0
    for t in [*_random_texts(4000), "a b\nc d", " a", "a ", " ", "", "a\n b", "a \nb", "a  b", "a\n", "\n\na b\n\nc", "it's a b"]:
        whole, spaced, special = splitter.parts(t)
        units = [*whole, *(u for p in spaced for u in tc._spaced(p))]
        assert (units, special) == splitter.units(t) or t == "", repr(t)
        plain += bool(spaced)
        assert tk.has_odd_space(t) == bool(tk._ODD.search(t))
    assert plain > 30


def test_pieces_tell_the_others_from_the_most_used():
    by_part = tc.Pieces(tc.Splitter(tc.TOKENIZER), {" a": 1, "!": 2}, True)
    rest = []
    assert by_part.of(["a", "a!", "a\nb", "a"], rest) == 6 and rest == ["\n", "b"]
    assert by_part.of(["a"], rest) == 1 and len(rest) == 2
