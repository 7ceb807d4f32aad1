import gzip
import hashlib
import random

import pytest

from reportgrid.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "x" * 1200 + "</p>"
    rows = [(k, f"http://a.example/{k}", big if k % 3 == 0 else f"page {k} " + "y" * (k * 40)) for k in range(60)]
    rows += [(100, None, None), (101, "http://b.example/a b\r\nX: y", ""), (102, "u", "WARC/1.1\r\nWARC/1.0\r\n\r\n\r\n\r\n" * 60)]
    rows += [(None, "http://c.example/", big), (57, "http://a.example/57", big), (103, "é", "é" * 600), (104, "é", "é" * 600)]
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")


def test_round_trip(spark, pages, tmp_path):
    warc.write_archives(pages, str(tmp_path / "w"), max_records=7)
    rows = warc.read_archives(spark, str(tmp_path / "w"), with_payload=True).collect()
    assert not [r for r in rows if r.kind == "gap"]
    want = []
    for p in pages.collect():
        payload = (p.html or "").encode()
        same = [q.page_id for q in pages.collect() if q.page_id is not None and (q.html or "") == (p.html or "")]
        keeper = max(same, default=None)
        revisit = p.page_id is not None and len(payload) >= 1000 and keeper != p.page_id
        want.append((p.page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    by = {r.page_id: r for r in rows}
    assert bytes(by[102].payload).startswith(b"WARC/1.1\r\n") and bytes(by[103].payload) == b""
    assert by[101].url == "http://b.example/a%20b%20%20X:%20y" and by[100].url is None


def test_no_rows(spark, pages, tmp_path):
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    records, gaps = warc.recovered(spark, str(tmp_path / "none"))
    assert records.count() == 0 and gaps.count() == 0


@pytest.fixture(scope="module")
def raw(pages):
    return [(r.record + "\r\n\r\n").encode() for r in warc.records(pages).collect()]


def ids(found):
    return [x[3]["page_id"] for x in found if x[0] == "record"]


def spans_cover(found, n):
    """Records and gaps are in order, and leave nothing out."""
    at = 0
    for _, start, end, _ in found:
        assert start in (at, last_start(found, start))
        at = max(at, end)
    assert at == n


def last_start(found, start):
    return next(x[1] for x in found if x[1] == start)


@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress])
def test_whole_files(raw, pack):
    data = b"".join(map(pack, raw))
    found = list(warc.salvage(data))
    assert len(ids(found)) == len(raw) and not [x for x in found if x[0] == "gap"]
    spans_cover(found, len(data))


def test_changed_bytes_of_a_plain_file(raw):
    rng = random.Random(2)
    for _ in range(30):
        hit = rng.randrange(len(raw))
        parts = [bytearray(x) for x in raw]
        parts[hit][rng.randrange(len(parts[hit]))] ^= 0x55
        data = b"".join(map(bytes, parts))
        found = list(warc.salvage(data))
        # all others are there; what is lost is logged
        assert len(ids(found)) >= len(raw) - 2
        spans_cover(found, len(data))


def test_cut_and_filled_files(raw):
    data = b"".join(raw)
    for cut in (1, 100, len(data) // 2, len(data) - 3):
        found = list(warc.salvage(data[:cut]))
        spans_cover(found, cut)
    noise = b"noise\n" * 9
    found = list(warc.salvage(noise + raw[0] + noise + raw[1] + noise))
    assert len(ids(found)) == 2 and [x[2] - x[1] for x in found if x[0] == "gap"] == [len(noise)] * 3


def test_broken_members(raw):
    rng = random.Random(3)
    packed = [gzip.compress(x) for x in raw]
    for _ in range(30):
        hit = rng.randrange(len(raw) - 1)
        parts = list(packed)
        part = bytearray(parts[hit])
        at = rng.randrange(len(part))
        parts[hit] = bytes(part[:at] + bytes([part[at] ^ 0xFF]) + part[at + 1 :])
        data = b"".join(parts)
        found = list(warc.salvage(data))
        assert len(ids(found)) >= len(raw) - 1
        spans_cover(found, len(data))
    lost = b"".join(packed[:2]) + packed[2][: len(packed[2]) // 2] + b"".join(packed[3:])
    assert len(ids(warc.salvage(lost))) >= len(raw) - 1


def test_mixed_and_empty():
    assert list(warc.salvage(b"")) == []
    assert [x[0] for x in warc.salvage(b"\x1f\x8b\x08")] == ["gap"]
    assert [x[0] for x in warc.salvage(b"WARC/1.0\r\n")] == ["gap"]


def test_damage_is_reported(spark, raw, tmp_path, caplog):
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "a.warc").write_bytes(raw[0] + b"junk\r\n" + raw[1])
    records, gaps = warc.recovered(spark, str(folder))
    assert records.count() == 2
    assert [(r.place, r.length) for r in gaps.collect()] == [(len(raw[0]), 6)]
    assert "6 bytes" in caplog.text


@pytest.fixture(scope="module")
def long_records(spark):
    rng = random.Random(6)
    rows = [(k, f"http://a.example/{k}", "".join(rng.choice("abcdefgh ") for _ in range(2000))) for k in range(120)]
    made = warc.records(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [(r.record + "\r\n\r\n").encode() for r in made]


@pytest.mark.parametrize("n", [40, 120])
def test_records_before_the_damage_of_a_member_are_kept(long_records, n):
    raw = long_records[:n]
    packed = gzip.compress(b"".join(raw))
    for share in (0.1, 0.5, 0.9):
        hit = int(share * len(packed))
        data = packed[:hit] + bytes([packed[hit] ^ 0xFF]) + packed[hit + 1 :]
        whole = len(list(warc.salvage(packed[:hit])) ) - 1  # a file that is cut there
        found = list(warc.salvage(data))
        assert whole >= int(share * n) - 2 and len(ids(found)) >= whole > 0
        assert [x[0] for x in found].count("gap") >= 1
        spans_cover(found, len(data))


def test_a_wrong_checksum_loses_no_record(long_records):
    data = bytearray(gzip.compress(b"".join(long_records)))
    data[-6] ^= 1
    found = list(warc.salvage(bytes(data)))
    assert len(ids(found)) == len(long_records) and [x[0] for x in found].count("gap") == 1


def test_records_without_digest_need_a_whole_member():
    one = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    data = bytearray(gzip.compress(one))
    assert [x[0] for x in warc.salvage(bytes(data))] == ["record"]
    data[-6] ^= 1
    assert [x[0] for x in warc.salvage(bytes(data))] == ["gap"]


def test_the_writer_makes_a_member_per_record(spark, pages, tmp_path):
    warc.write_archives(pages, str(tmp_path / "m"))
    n = 0
    for file in (tmp_path / "m").rglob("part-*"):
        data = file.read_bytes()
        found = list(warc.salvage(data))
        starts = [x[1] for x in found]
        n += len(found)
        assert gzip.decompress(data).count(b"\r\nWARC-Type: ") == len(found) == len(set(starts))
        hit = starts[len(starts) // 2] + 30
        broken = data[:hit] + bytes([data[hit] ^ 0xFF]) + data[hit + 1 :]
        assert len(ids(warc.salvage(broken))) >= len(found) - 1
    assert n == pages.count()


def test_large_members_end_in_a_zero():
    for size in (0, 10, (1 << 24) - 1, 1 << 24, (1 << 24) + 77):
        assert gzip.decompress(warc.pack(b"x" * size) + b"\0") == b"x" * size


def warc_record(n):
    fields = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:%d:x>\r\nContent-Length: 10\r\n" % n
    return fields + b"\r\n" + b"x" * 10 + b"\r\n\r\n"


def test_a_cut_header_takes_nothing_of_the_next_record():
    """A header without its blank line is a gap; the record behind it keeps its own fields."""
    good = warc_record(1)
    cut = b"WARC/1.1\r\nWARC-Refers-To: <urn:x-page:99:x>\r\n"
    found = list(warc.salvage(cut + good))
    assert [(kind, start, end) for kind, start, end, _ in found] == [("gap", 0, len(cut)), ("record", len(cut), len(cut) + len(good))]
    assert found[0][3] == "header without end" and found[1][3]["page_id"] == 1 and found[1][3]["refers_to"] is None


def test_many_lone_version_lines_take_linear_time():
    import time

    began = time.perf_counter()
    found = list(warc.salvage(b"WARC/1.1\r\n" * 80_000 + warc_record(2)))
    assert time.perf_counter() - began < 5
    assert len(found) == 80_001 and found[-1][3]["page_id"] == 2


def test_file_numbers():
    assert list(warc.file_numbers(iter([5, 5, 5, 20, 1, 9, 1]), 10, 10)) == [0, 0, 1, 2, 3, 3, 4]
    assert list(warc.file_numbers(iter([1] * 5), 2, 10)) == [0, 0, 1, 1, 2]
    assert list(warc.file_numbers(iter([]), 2, 10)) == []


def test_files_are_bounded_by_bytes(spark, tmp_path):
    """No file of several records is larger than the bound, and all records come back from all files."""
    rng = random.Random(5)
    sizes = [rng.choice([0, 10, 20_000, 150_000]) for _ in range(60)]
    rows = [(k, f"http://x/{k}", "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))) for k, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    warc.write_archives(pages, str(tmp_path / "b"), max_bytes=100_000)
    files = list((tmp_path / "b").rglob("part-*"))
    held = [[k for kind, _, _, k in warc.salvage(f.read_bytes()) if kind == "record"] for f in files]
    assert len(files) > 10 and all(f.stat().st_size <= 100_000 or len(h) == 1 for f, h in zip(files, held))
    found, gaps = warc.recovered(spark, str(tmp_path / "b"))
    assert gaps.count() == 0
    got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in found.collect()}
    assert got == {k: (len(html), hashlib.sha1(html.encode()).hexdigest()) for k, _, html in rows}
