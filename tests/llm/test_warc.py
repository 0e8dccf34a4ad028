"""WARC: exact round trip, revisits, and salvage after every kind of damage."""
import gzip
import random
import zlib

import pytest
from panelscore.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [(3, "http://a/1", "<p>one</p>"), (1, "http://a/2", "<p>one</p>"), (2, None, None), (7, "http://a/\r\nWARC-Type: x", ""), (5, "", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (8, "http://a/3", "x" * 300_000), (None, "http://a/4", "<p>one</p>"), (1, "http://a/2", "<p>one</p>"), (None, "http://a/5", "alone"), (9, "u", "\x00\x1f\u008b\x08")]


def test_round_trip(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS).repartition(3), f"{tmp_path}/w")
    got = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert all(r["kind"] == "record" for r in got) and len(got) == len(ROWS)
    want = []
    for i, _, html in ROWS:
        body = (html or "").encode()
        first = min((j for j, _, h in ROWS if (h or "") == (html or "") and j is not None), default=None)
        revisit = first is not None and i != first
        want.append((i, len(body), warc.sha1(body), "revisit" if revisit else "response", first if revisit else None, None if revisit else body))
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got]
    assert sorted(map(repr, have)) == sorted(map(repr, want))


def test_archives_are_plain_gzip_members(spark, tmp_path):
    import pathlib
    warc.write_archives(pages(spark, ROWS).coalesce(1), f"{tmp_path}/w")
    data = b"".join(p.read_bytes() for p in sorted(pathlib.Path(f"{tmp_path}/w").glob("part-*")))
    text = gzip.decompress(data)
    assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and text.count(b"WARC-Record-ID") == 8


def test_min_bytes_and_empty_table(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), f"{tmp_path}/w", min_bytes=3)
    got = {r["page_id"]: r["record_type"] for r in warc.read_archives(spark, f"{tmp_path}/w").collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    warc.write_archives(pages(spark, []), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


def archive(n=6, packed=True, seed=0):
    rnd = random.Random(seed)
    records = [warc.record(i, f"http://x/{i}", bytes(rnd.choices(b"abc <>\n", k=rnd.randint(50, 400))), None, False) for i in range(n)]
    return [warc.member(r) for r in records] if packed else records


def read(parts):
    data = b"".join(parts)
    out = list(warc.salvage(data))
    spans = sorted({(o[1], o[2]) for o in out})
    assert sum(n for _, n in spans) == len(data)  # every byte is in a record or in a gap
    return [int(o[3]["warc-record-id"][10:-1]) for o in out if o[0] == "record"], [(o[1], o[2], o[3]) for o in out if o[0] == "gap"]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts = archive(packed=packed)
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    assert read(parts) == (list(range(6)), [])
    damaged = parts[2][:30] + b"\xff\x00\xff" + parts[2][33:]
    assert read(parts[:2] + [damaged] + parts[3:])[0] == [0, 1, 3, 4, 5]
    assert read(parts[:2] + [damaged] + parts[3:])[1][0][:2] == (starts[2], len(parts[2]))
    flipped = bytearray(parts[3])
    flipped[-20] ^= 1  # inside the payload or its packed form: the checks find it
    ids, gaps = read(parts[:3] + [bytes(flipped)] + parts[4:])
    assert ids == [0, 1, 2, 4, 5] and gaps[0][:2] == (starts[3], len(parts[3]))
    ids, gaps = read(parts[:-1] + [parts[-1][:len(parts[-1]) // 2]])
    assert ids == [0, 1, 2, 3, 4] and gaps[0][0] == starts[5]
    ids, gaps = read([b"garbage first", *parts[:2], b"WARC/1.1 but no record", *parts[2:], b"tail"])
    assert ids == list(range(6)) and len(gaps) == 3
    assert read([parts[0][7:], *parts[1:]])[0] == [1, 2, 3, 4, 5]


def test_salvage_mixes_and_odd_inputs():
    assert list(warc.salvage(b"")) == []
    assert [o[0] for o in warc.salvage(b"\x1f\x8b\x08")] == ["gap"] and [o[0] for o in warc.salvage(b"no archive")] == ["gap"]
    ids, gaps = read([*archive(2), *archive(2, packed=False, seed=1), *archive(2, seed=2)])
    assert ids == [0, 1] * 3 and gaps == []
    two = warc.member(b"".join(archive(2, packed=False)))
    assert read([two]) == ([0, 1], [])
    no_length = b"WARC/1.1\r\nWARC-Type: response\r\n\r\nx\r\n\r\n"
    assert read([no_length, *archive(1)])[0] == [0]


def test_damaged_file_through_spark(spark, tmp_path):
    parts = archive(40)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts[:20]) + b"\x00" * 99 + b"".join(parts[20:]))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r["page_id"] for r in rows if r["kind"] == "record") == list(range(40))
    assert [(r["length"], r["reason"]) for r in rows if r["kind"] == "gap"] == [(99, "no version line")]


def test_salvage_inside_a_member():
    plain = archive(8, packed=False)
    bad = bytearray(plain[3])
    bad[-10] ^= 1  # block digest
    short = plain[5].replace(b"Content-Length: ", b"Content-Length: 9", 1) if b"HTTP" not in plain[5].split(b"Content-Length")[0] else plain[5][:-6] + plain[5][-4:]
    one = warc.member(b"".join([*plain[:3], bytes(bad), plain[4], short, *plain[6:]]))
    ids, gaps = read([*archive(1, seed=3), one, *archive(1, seed=4)])
    assert ids == [0, 0, 1, 2, 4, 6, 7, 0]
    assert len(gaps) == 2 and all(g[1] == len(one) for g in gaps) and "block digest" in gaps[0][2]


def test_salvage_before_the_error_of_a_member():
    rnd = random.Random(9)
    plain = [warc.record(i, "u", bytes(rnd.choices(range(256), k=3000)), None, False) for i in range(30)]
    for level in (0, 6):
        c = zlib.compressobj(level, zlib.DEFLATED, 31)
        whole = c.compress(b"".join(plain)) + c.flush()
        cut = whole[:len(whole) * 2 // 3]
        ids, gaps = read([cut])
        assert ids == list(range(len(ids))) and 18 <= len(ids) <= 20 and len(gaps) == 1
        ids, gaps = read([cut, *archive(2)])
        assert ids[-2:] == [0, 1] and ids[:-2] == list(range(len(ids) - 2)) and len(ids) >= 20
        crc = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
        assert read([crc])[0] == list(range(30)) and read([crc, *archive(2)])[0] == [*range(30), 0, 1]


@pytest.mark.parametrize("packed", [True, False])
def test_damaged_headers_are_quarantined(packed):
    plain = archive(4, packed=False)
    harm = [(b"<urn:page:1>", b"<urn:page:?>"), (b"<urn:page:1>", b"<urn:page:" + b"9" * 30 + b">"), (b"Content-Length: ", b"Content-Length: -"), (b"Content-Length: ", "Content-Length: ²".encode())]
    for old, new in harm:
        bad = plain[1].replace(old, new, 1)
        assert bad != plain[1]
        parts = [warc.member(p) for p in (plain[0], bad, *plain[2:])] if packed else [plain[0], bad, *plain[2:]]
        ids, gaps = read(parts)
        assert ids == [0, 2, 3] and len(gaps) == 1, new
    revisit = warc.record(7, "u", b"abc", 3, True).replace(b"Payload-Bytes: 3", b"Payload-Bytes: " + b"3" * 40).replace(b"<urn:page:3>", b"<urn:page:x>")
    assert read([plain[0], revisit, plain[2]])[0] == [0, 2]


@pytest.mark.parametrize("packed", [True, False])
def test_any_damage_is_covered_and_spares_the_other_records(spark, packed, tmp_path):
    """Random flips, cuts and splices: records and gaps cover every byte in order, and records that were not touched are read."""
    rnd = random.Random(11)
    parts = archive(12, packed=packed)
    ends = [sum(map(len, parts[:i + 1])) for i in range(len(parts))]
    for n in range(60):
        data, lo = bytearray(b"".join(parts)), rnd.randrange(ends[-1])
        what = n % 3
        if what == 0:
            hi = lo + 1
            data[lo] ^= 1 << rnd.randrange(8)
        elif what == 1:
            hi = min(ends[-1], lo + rnd.randrange(1, 40))
            del data[lo:hi]
        else:
            hi = lo
            data[lo:lo] = rnd.choice([b"\r\n\r\n", b"WARC/1.1\r\n", b"\x1f\x8b\x08", b"\x00" * 9])
        found = list(warc.salvage(bytes(data)))
        at, spans = 0, {(o[1], o[2]) for o in found}
        for begin, length in sorted(spans):
            assert begin == at
            at = begin + length
        assert at == len(data)
        untouched = {i for i, e in enumerate(ends) if e <= lo or e - len(parts[i]) > hi}
        ids = [int(o[3]["warc-record-id"][10:-1]) for o in found if o[0] == "record" and o[3].get("warc-record-id", "").startswith(warc.URN)]
        assert untouched <= set(ids), (what, lo, hi)
    (tmp_path / "x.warc").write_bytes(b"".join(archive(3, packed=False)).replace(b"<urn:page:1>", b"<urn:page:?>"))
    assert sorted(r["page_id"] for r in warc.read_archives(spark, str(tmp_path)).where("kind = 'record'").collect()) == [0, 2]
