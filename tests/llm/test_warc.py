from __future__ import annotations

import io
import zipfile

import pytest

from inkprint.llm.warc import ARCHIVE, Package, package, parse, read_packages, record, write_packages
from inkprint.session import scratch_path

LONG = "<p>é" + "x" * 200


def test_round_trip(spark):
    rows = [(5, "http://a/1", LONG), (3, "http://a/2\r\nX: y", LONG), (9, None, LONG), (1, "u", "short"), (2, "u", "short"),
            (4, "u", None), (6, "u", ""), (None, "u", LONG), (7, "u", "y" * 100_000), (3, "http://a/2", LONG)]
    d = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    packages = write_packages(d, scratch_path(spark, "warc-test"), package_bytes=300)
    assert packages.count() >= 2
    got = read_packages(packages).collect()
    assert len(got) == len(rows)
    for page, _, html in rows:
        same = [r for r in got if r["page"] == ("null" if page is None else str(page))]
        raw = (html or "").encode()
        assert same and all(r["size"] == len(raw) for r in same)
        revisit = html == LONG and page != 3
        assert all(r["type"] == ("revisit" if revisit else "response") for r in same)
        assert all(r["refers_to"] == ("3" if revisit else None) for r in same)
        assert all(r["payload"] == (None if revisit else raw) for r in same)
    assert {r["url"] for r in got if r["page"] == "9"} == {""}


def test_empty_table(spark):
    d = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_packages(write_packages(d, scratch_path(spark, "warc-test"))).count() == 0


def reader(data, log=None):
    def read(at, n):
        if log is not None:
            log.append((at, n))
        return data[at:at + n]
    return Package(read, len(data))


def records(n, size=50):
    import hashlib
    out = []
    for k in range(n):
        body = bytes([65 + k % 26]) * size
        out.append((str(k), record(str(k), "u", body, hashlib.sha256(body).hexdigest(), size, None)))
    return out


@pytest.mark.parametrize("wide", [False, True])
def test_directories_with_and_without_zip64(wide):
    data = package(records(40), force_zip64=wide)
    assert zipfile.ZipFile(io.BytesIO(data)).testzip() is None
    got = [parse(raw) for _, raw in reader(data).records()]
    assert [r["page"] for r in got] == [str(k) for k in range(40)]


def test_zip64_end_record_and_comment():
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w") as z:
        for k in range(70_000):
            z.writestr(zipfile.ZipInfo(f"m{k}"), b"")
        inner = package(records(3))
        with zipfile.ZipFile(io.BytesIO(inner)) as y:
            for name in y.namelist():
                z.writestr(zipfile.ZipInfo(name), y.read(name))
    found = reader(many.getvalue())
    assert len(found.members) == 70_002 and len(list(found.records())) == 3
    commented = io.BytesIO(package(records(2)))
    with zipfile.ZipFile(commented, "a") as z:
        z.comment = b"PK\x05\x06 not the end" * 20
    assert len(list(reader(commented.getvalue()).records())) == 2


def test_reads_ranges_only():
    data, log = package(records(2000, 5000)), []
    found = reader(data, log)
    assert len(log) <= 3 and found.members[ARCHIVE].size > 400_000
    before = len(log)
    next(iter(found.records(window=2000)))
    assert sum(n for at, n in log[before:] if at < found.members[ARCHIVE].size) < 4000


def test_broken_packages():
    data = package(records(3))
    with pytest.raises(ValueError):
        reader(data[:-30])
    with pytest.raises(ValueError):
        reader(b"")
    squeezed = io.BytesIO()
    with zipfile.ZipFile(squeezed, "w", zipfile.ZIP_DEFLATED) as z, zipfile.ZipFile(io.BytesIO(data)) as y:
        for name in y.namelist():
            z.writestr(name, y.read(name))
    with pytest.raises(ValueError, match="compressed"):
        list(reader(squeezed.getvalue()).records())
    with pytest.raises(ValueError, match="payload"):
        parse(record("1", "u", b"abc", "0" * 64, 3, None))
