import base64
import gzip
import hashlib

from quarterline.llm.warc import parse_record, read_warc, record_bytes, salvage, write_warc

PAGES = "page_id long, url string, html string, top long, sha string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], PAGES)


ROWS = [(1, "http://a/1", "<p>same</p>"), (5, "http://a/5", "<p>same</p>"), (3, None, "<p>same</p>"), (2, "http://b", None),
        (4, "http://c\r\nX: y", ""), (None, "é", "<p>same</p>"), (6, "http://d", "WARC/1.1\r\n\r\n\x1f\u008b\x08" * 3),
        (7, "http://e", "é" * 100_000), (8, "http://f", "twice"), (8, "http://f", "twice")]


def test_round_trip_matches_brute_force(spark):
    files = write_warc(pages(spark, ROWS), roll_bytes=300)
    got = read_warc(files).collect()
    assert all(r.gap is None for r in got)
    top = {}
    for i, _, h in ROWS:
        top[h or ""] = max(top.get(h or "", -1), i if i is not None else -1)
    want = []
    for i, _, h in ROWS:
        raw = (h or "").encode()
        again = i != top[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if again else "response", top[h or ""] if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() == next(h or "" for i, _, h in ROWS if i == r.page_id)


def test_empty_table(spark):
    assert read_warc(write_warc(pages(spark, []))).count() == 0


def records(n=5):
    return [record_bytes(k, f"http://x/{k}", (f"page {k} " * 50).encode()) for k in range(n)]


def ids(found):
    return [r["page_id"] for _, _, r, _ in found if r]


def test_salvage_after_a_damaged_member():
    members = [gzip.compress(r, mtime=0) for r in records()]
    bad = bytearray(b"".join(members))
    at = len(members[0]) + len(members[1]) // 2
    bad[at:at + 4] = b"\0\0\0\0"
    found = list(salvage(bytes(bad)))
    assert ids(found) == [0, 2, 3, 4]
    gap = [(s, e) for s, e, r, _ in found if r is None]
    assert gap == [(len(members[0]), len(members[0]) + len(members[1]))]


def test_salvage_plain_file_with_cut_and_noise():
    parts = records()
    data = b"noise" + parts[0] + parts[1][:-20] + parts[2] + b"\xff" * 30 + parts[3] + parts[4][:40]
    found = list(salvage(data))
    # the noise has no version line at its start: the file is read as a plain one
    assert ids(found) == [0, 2, 3]
    gaps = [(e - s) for s, e, r, _ in found if r is None]
    assert gaps == [5, len(parts[1]) - 20, 30, 40]
    assert sum(e - s for s, e, _, _ in found) == len(data)


def test_salvage_of_a_wrong_digest_and_trailing_bytes():
    parts = records(3)
    wrong = parts[1].replace(b"page 1", b"page X", 1)
    found = list(salvage(b"".join(map(gzip.compress, [parts[0], wrong, parts[2]])) + b"tail"))
    assert ids(found) == [0, 2]
    assert [w for *_, r, w in found if r is None][0] == "block digest"


def test_empty_and_hopeless_files():
    assert list(salvage(b"")) == []
    assert list(salvage(b"nothing here")) == [(0, 12, None, "version line")]


def test_one_record():
    r, end = parse_record(records(1)[0])
    assert r["record_type"] == "response" and end == len(records(1)[0])


def test_members_and_plain_records_in_one_file():
    parts = records(10)
    members = [gzip.compress(r, mtime=0) for r in parts]
    for mixed in (members[:5] + parts[5:], parts[:5] + members[5:], [x for pair in zip(members[:5], parts[5:]) for x in pair]):
        found = list(salvage(b"".join(mixed)))
        assert sorted(ids(found)) == list(range(10)) and all(r for _, _, r, _ in found)
        damaged = [bytearray(x) for x in mixed]
        damaged[4][len(damaged[4]) // 2] ^= 0xFF
        found = list(salvage(b"".join(damaged)))
        assert len(ids(found)) == 9
        lo = sum(map(len, mixed[:4]))
        assert [(s, e) for s, e, r, _ in found if r is None] == [(lo, lo + len(mixed[4]))]


def test_several_records_in_one_member():
    parts = records(6)
    found = list(salvage(gzip.compress(parts[0] + parts[1]) + gzip.compress(parts[2]) + parts[3] + gzip.compress(parts[4] + parts[5])))
    assert ids(found) == [0, 1, 2, 3, 4, 5]
    wrong = parts[1].replace(b"page 1", b"page X", 1)
    found = list(salvage(gzip.compress(parts[0] + wrong + b"noise" + parts[2]) + gzip.compress(parts[3] + parts[4][:-9])))
    assert ids(found) == [0, 2, 3] and [w for *_, r, w in found if r is None] == ["block digest in a member", "record end in a member"]
    assert ids(salvage(gzip.compress(wrong) + parts[3])) == [3]


def test_a_gap_is_an_error_where_archives_must_be_whole(spark, tmp_path):
    import pytest

    from quarterline.llm.warc import whole_archives
    good = write_warc(pages(spark, ROWS[:4]), folder=str(tmp_path / "w"))
    assert whole_archives(read_warc(good)).count() == 4
    path = tmp_path / "bad.warc.gz"
    path.write_bytes(gzip.compress(records(1)[0]) + b"noise")
    bad = spark.createDataFrame([(str(path), 1)], "path string, n_records long")
    assert read_warc(bad).count() == 2
    with pytest.raises(Exception, match="lost bytes"):
        whole_archives(read_warc(bad)).collect()
