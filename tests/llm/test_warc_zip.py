import hashlib
import io
import json
import struct
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackset.llm import common, warc_zip

SCHEMA = "page_id long, url string, html string, payload string, digest string, path string, first long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "d", "x", 1) for r in rows], SCHEMA)


def brute(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in data:
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, b in data:
        again = b in first and first[b] != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    big = "<p>" + "ü" * 120
    out = [(i, f"http://h/{i}", f"<html>{'x' * i}\r\n\r\n ") for i in range(130)]
    out += [(200, "u", big), (150, None, big), (201, "a\nb cé", big), (None, "n", big), (150, "twice", big)]
    out += [(300, "u", "same but short"), (301, "u", "same but short"), (302, "u", None), (303, "u", ""), (None, None, None)]
    return out + [(400, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 50), (401, "u", "z" * 300_000)]


def test_round_trip(spark, rows, monkeypatch):
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", 2000)
    monkeypatch.setattr(warc_zip, "RANGE_BYTES", 700)
    found = warc_zip.round_trip(pages(spark, rows).repartition(3))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in found.collect()), key=str) == brute(rows)


def test_payloads_come_back(spark, rows):
    df, folder = pages(spark, rows), common.scratch_path(spark, "warc")
    packages = warc_zip.write_packages(warc_zip.decided(df, "page_id", "url", "html"), folder)
    read = warc_zip.read_records(packages, folder).where("record_type = 'response'").collect()
    texts = {}
    for i, _, h in rows:
        texts.setdefault(i, set()).add((h or "").encode())
    assert read and all(bytes(r.payload) in texts[r.page_id] for r in read)


def test_empty_table(spark):
    assert warc_zip.round_trip(pages(spark, [])).count() == 0


def test_central_directories(tmp_path):
    def directory(content):
        return warc_zip.central_directory(pa.PythonFile(io.BytesIO(content), mode="r"))

    plain, wide = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("a.txt", "alpha")
        z.writestr("b.txt", "beta" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"with a comment PK\x05\x06 in it"[:14]
    source = pa.PythonFile(io.BytesIO(plain.getvalue()), mode="r")
    members = warc_zip.central_directory(source)
    at, n = warc_zip.stored_range(source, members["a.txt"])
    assert plain.getvalue()[at : at + n] == b"alpha" and members["b.txt"][2] == zipfile.ZIP_DEFLATED
    with pytest.raises(ValueError):
        warc_zip.stored_range(source, members["b.txt"])
    with pytest.raises(ValueError):
        directory(b"no archive at all" * 10)
    # more members than 16 bits count: the stdlib writes a ZIP64 end record
    with zipfile.ZipFile(wide, "w") as z:
        for i in range(65_600):
            z.writestr(f"{i}", b"")
    assert len(directory(wide.getvalue())) == 65_600


def test_zip64_fields():
    """An entry and an end record whose 32-bit fields are full point to 64-bit ones."""
    data = b"payload"
    header = struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20)
    local = header + b"m" + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    entry = struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    entry += b"m" + extra
    end64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = struct.pack("<IIQI", 0x07064B50, 0, len(local) + len(entry), 1)
    end = struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    content = local + entry + end64 + locator + end
    source = pa.PythonFile(io.BytesIO(content), mode="r")
    at, n = warc_zip.stored_range(source, warc_zip.central_directory(source)["m"])
    assert content[at : at + n] == data


def test_broken_payloads_are_errors():
    record = warc_zip.warc_record(1, 0, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), 3, None, None)
    assert warc_zip.parse_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc_zip.parse_record(record.replace(b"abc", b"abd"))


def test_packages_are_zip_files(spark, rows, tmp_path):
    folder = str(tmp_path / "packages")
    packages = warc_zip.write_packages(warc_zip.decided(pages(spark, rows), "page_id", "url", "html"), folder)
    assert packages.agg(F.sum("n_records")).first()[0] == len(rows)
    with zipfile.ZipFile(f"{folder}/{packages.first().path}") as z:
        assert set(z.namelist()) == {warc_zip.DATA, warc_zip.INDEX} and z.testzip() is None


def test_all_archives_and_indexes_are_read(spark, tmp_path):
    def write(name, covered):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_STORED) as out:
            for k, archive in enumerate(("archive/a.warc.gz", "archive/b.warc.gz")):
                part = warc_zip.Package()
                for i in (2 * k, 2 * k + 1):
                    payload = f"page {i}".encode()
                    part.add(warc_zip.warc_record(i, 0, "u", payload, hashlib.sha256(payload).hexdigest(), len(payload), None, None), i)
                out.writestr(archive, part.data.getvalue())
                if k < covered:
                    lines = [json.dumps({**json.loads(x), "archive": archive}) for x in part.index]
                    out.writestr(f"indexes/{k}.jsonl", "\n".join(lines[::-1]))
        return warc_zip.read_records(spark.createDataFrame([(name,)], "path string"), f"file://{tmp_path}")

    assert sorted((r.page_id, bytes(r.payload)) for r in write("two.zip", 2).collect()) == [(i, f"page {i}".encode()) for i in range(4)]
    with pytest.raises(Exception, match="no index covers archive/b"):
        write("one.zip", 1).collect()


def test_record_ids_are_unique(spark, tmp_path):
    long = "x" * 200
    rows = [(1, "u", "a"), (1, "u", "b"), (None, "u", "a"), (None, "u", long), (7, "u", long), (3, "u", long), (3, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = str(tmp_path / "packages")
    packages = warc_zip.write_packages(warc_zip.decided(pages, "page_id", "url", "html"), folder)
    ids, named = [], {}
    for p in packages.collect():
        with open(f"{folder}/{p.path}", "rb") as f:
            for start, length in warc_zip.indexed(_Sized(f)):
                f.seek(start)
                head = zlib.decompress(f.read(length), 31).split(b"\r\n\r\n")[0].decode().split("\r\n")
                fields = dict(line.split(": ", 1) for line in head[1:])
                ids.append(fields["WARC-Record-ID"])
                named[ids[-1]] = fields
    assert len(ids) == len(set(ids)) == len(rows)
    for fields in named.values():
        if fields["WARC-Type"] == "revisit":
            first = named[fields["WARC-Refers-To"]]
            assert first["WARC-Type"] == "response" and first["X-Page-Id"] == fields["X-Refers-To-Page"] == "3"
    assert sum(f["WARC-Type"] == "revisit" for f in named.values()) == 2


class _Sized:
    def __init__(self, f):
        self.f, self.seek, self.read = f, f.seek, f.read

    def size(self):
        at = self.f.tell()
        n = self.f.seek(0, 2)
        self.f.seek(at)
        return n
