"""Operator 4: records in WARC files that lie, stored, in ZIP packages; written, indexed and read by byte ranges.

Writing: every task packs its records into packages of about PACKAGE_BYTES. A package holds `archive/data.warc.gz`
(each record a gzip member of its own) and `indexes/index.jsonl` (a line with offset and length for each record), both
stored, so that a record is a byte range of the package. Packages are named by the attempt that writes them, and the
table of packages that tasks return counts only those of attempts that ended well.

Reading takes all members under archive/ and indexes/; an index line names its archive. The end of each package is
searched for its end-of-central-directory record, and its ZIP64 record where sizes or counts say so; the central directory names the members; the local header says where a stored member's bytes begin.
Index lines become byte ranges, which are dealt out to tasks and read without unpacking the package.

Of records with equal payloads of at least LEAST_BYTES, the one with the smallest id is the response and the others
revisit it, without a payload of their own.

Defined results: a null payload is empty; rows with a null id are written, and are responses only where no id is known;
all rows that share the smallest id are responses; repeated rows each get a record; an empty table gives an empty
result; only the named columns are read. Record ids are unique, whatever the page ids; a revisit names the first row of
its response's id.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LEAST_BYTES = 100
PACKAGE_BYTES = 32 << 20
#: Bytes of records that one task reads at a time.
RANGE_BYTES = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
_NAMES = uuid.UUID("6f1f0f8e-2f4b-4f0a-9a53-5d9b6a3c1a77")
_END, _END64_AT, _END64, _ENTRY = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02"


def record_name(page_id: int | None, serial: int) -> str:
    """The id of a record: the page's id and the row's number, since pages may share an id or have none."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{serial}')}>"


def _one_line(text: str | None) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text or "")


def warc_record(page_id, serial, url, payload: bytes | None, digest: str, n_bytes: int, refers_to, refers_serial) -> bytes:
    """One WARC/1.1 record; `payload` is None for a revisit of the record that refers_to and refers_serial name."""
    head = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": record_name(page_id, serial),
        "WARC-Date": "2020-01-01T00:00:00Z",
        "WARC-Target-URI": _one_line(url) or "about:blank",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if payload is None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = record_name(refers_to, refers_serial)
        head["X-Refers-To-Page"] = str(refers_to)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = named["warc-payload-digest"].removeprefix("sha256:")
    kind = named["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {named['warc-record-id']} does not match its digest")
    number = lambda key: int(named[key]) if key in named else None
    return {
        "page_id": number("x-page-id"),
        "url": named["warc-target-uri"],
        "record_type": kind,
        "refers_to": number("x-refers-to-page"),
        "payload_digest": digest,
        "payload_bytes": length,
        "payload": payload if kind == "response" else None,
    }


class Package:
    """A package in the making."""

    def __init__(self):
        self.data, self.index = io.BytesIO(), []

    def add(self, record: bytes, page_id) -> None:
        packed = zlib.compressobj(1, zlib.DEFLATED, 31)
        member = packed.compress(record) + packed.flush()
        self.index.append(json.dumps({"page_id": page_id, "archive": DATA, "offset": self.data.tell(), "length": len(member)}))
        self.data.write(member)

    def write(self, out) -> None:
        """To a stream, which need not be able to seek; the records are held once."""
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
            package.writestr(DATA, self.data.getbuffer())
            package.writestr(INDEX, "\n".join(self.index))


def decided(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """page_id, serial, url, payload (null for revisits), digest, n_bytes, refers_to, refers_serial of every row."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("serial"),
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        common.text_or_empty(payload_col).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    known = rows.where((F.col("n_bytes") >= LEAST_BYTES) & F.col("page_id").isNotNull())
    first = known.groupBy("digest").agg(F.min(F.struct("page_id", "serial")).alias("at"))
    # written, so that the join exchanges both sides and Spark can split the payloads of a frequent digest
    first = common.materialise(first.select("digest", F.col("at.page_id").alias("first"), F.col("at.serial").alias("first_serial")), "first-pages")
    rows = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.select(
        "page_id",
        "serial",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "digest",
        "n_bytes",
        F.when(revisit, F.col("first")).alias("refers_to"),
        F.when(revisit, F.col("first_serial")).alias("refers_serial"),
    )


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """Write records to packages in `folder`, which all executors share; path, n_records of each package."""

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)

        def closed(package: Package) -> pa.RecordBatch:
            path = f"{root}/{uuid.uuid4().hex}.zip"
            with files.open_output_stream(path) as out:
                package.write(out)
            return pa.RecordBatch.from_pydict({"path": [path.rpartition("/")[2]], "n_records": [len(package.index)]})

        package = Package()
        for batch in batches:
            for row in batch.to_pylist():
                args = (row[k] for k in ("page_id", "serial", "url", "payload", "digest", "n_bytes", "refers_to", "refers_serial"))
                package.add(warc_record(*args), row["page_id"])
                if package.data.tell() >= PACKAGE_BYTES:
                    yield closed(package)
                    package = Package()
        if package.index:
            yield closed(package)

    return common.materialise(common.map_arrow(records, run, "path string, n_records long"), "packages")


def central_directory(source) -> dict[str, tuple[int, int, int]]:
    """name -> (place of the local header, stored bytes, method) from a seekable file with size(); ZIP64 included."""
    size = source.size()

    def read(at: int, n: int) -> bytes:
        source.seek(at)
        return source.read(n)

    tail_at = max(0, size - 22 - 0xFFFF)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if count == 0xFFFF or 0xFFFFFFFF in (length, start):
        locator = tail[at - 20 : at] if at >= 20 else read(tail_at + at - 20, 20)
        if locator[:4] == _END64_AT:
            end = read(struct.unpack("<Q", locator[8:16])[0], 56)
            if end[:4] != _END64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack("<QQQ", end[32:56])
    listed, members, at = read(start, length), {}, 0
    for _ in range(count):
        if listed[at : at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        method = struct.unpack("<H", listed[at + 10 : at + 12])[0]
        packed, plain, n_name, n_extra, n_note = struct.unpack("<IIHHH", listed[at + 20 : at + 34])
        header = struct.unpack("<I", listed[at + 42 : at + 46])[0]
        name = listed[at + 46 : at + 46 + n_name].decode()
        extra = listed[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:  # the 64-bit values of the fields that are full, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        members[name] = (header, packed, method)
        at += 46 + n_name + n_extra + n_note
    return members


def stored_range(source, member: tuple[int, int, int]) -> tuple[int, int]:
    """Where the bytes of a stored member begin, and how many there are."""
    header, packed, method = member
    if method:
        raise ValueError("only stored members can be read by ranges")
    source.seek(header + 26)
    n_name, n_extra = struct.unpack("<HH", source.read(4))
    return header + 30 + n_name + n_extra, packed


def indexed(source) -> list[tuple[int, int]]:
    """Place and length of every record of a package, by all its indexes; an index line names its archive, which may be
    left out if there is only one. An archive without an index is an error."""
    members = central_directory(source)
    held = {n: m for n, m in members.items() if not n.endswith("/")}
    archives = {n: stored_range(source, m) for n, m in held.items() if n.startswith("archive/")}
    covered, out = set(), []
    for name in (n for n in held if n.startswith("indexes/")):
        at, n = stored_range(source, held[name])
        source.seek(at)
        for line in source.read(n).splitlines():
            try:
                entry = json.loads(line)
                offset, length = int(entry["offset"]), int(entry["length"])
            except (ValueError, KeyError, TypeError) as e:
                raise ValueError(f"{name} has a line without offset and length") from e
            archive = entry.get("archive") or (next(iter(archives)) if len(archives) == 1 else None)
            if archive not in archives:
                raise ValueError(f"{name} has a line of no archive in the package: {archive}")
            base, size = archives[archive]
            if not 0 <= offset <= offset + length <= size:
                raise ValueError(f"{name} has a record beyond {archive}")
            covered.add(archive)
            out.append((base + offset, length))
    for archive in archives.keys() - covered:
        if archives[archive][1]:
            raise ValueError(f"no index covers {archive}")
    return out


def ranges(packages: DataFrame, folder: str) -> DataFrame:
    """path, start, lengths: contiguous records of each package, by its own directory and indexes."""

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out = {"path": [], "start": [], "lengths": []}
                with files.open_input_file(f"{root}/{name}") as source:
                    held, end = RANGE_BYTES, None
                    for start, length in indexed(source):
                        if held >= RANGE_BYTES or start != end:
                            held = 0
                            out["path"].append(name)
                            out["start"].append(start)
                            out["lengths"].append([])
                        out["lengths"][-1].append(length)
                        held, end = held + length, start + length
                schema = pa.schema({"path": pa.string(), "start": pa.int64(), "lengths": pa.list_(pa.int64())})
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return packages.select("path").mapInArrow(run, "path string, start long, lengths array<long>")


def read_records(packages: DataFrame, folder: str, want_payload: bool = True) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload of every record in the packages.

    A response's payload is checked against its digest; a revisit's payload is its response's."""
    spark = packages.sparkSession
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    kinds |= {"payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    shape = pa.schema(kinds)

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                found, at = [], 0
                with files.open_input_file(f"{root}/{row['path']}") as source:
                    source.seek(row["start"])
                    held = source.read(sum(row["lengths"]))
                for n in row["lengths"]:
                    found.append(parse_record(zlib.decompress(held[at : at + n], 31)))
                    at += n
                    if not want_payload:
                        found[-1]["payload"] = None
                yield pa.RecordBatch.from_pylist(found, schema=shape)

    places = ranges(packages, folder)
    places = places.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    return places.mapInArrow(run, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write every row as a record into packages in the shared folder, and read the records back, without payloads."""
    folder = common.scratch_path(pages.sparkSession, "warc")
    packages = write_packages(decided(pages, id_col, url_col, payload_col), folder)
    return read_records(packages, folder, want_payload=False).drop("payload")
