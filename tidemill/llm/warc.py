"""Operator 12: WARC archives with a two-level capture index.

Writing.  Rows are grouped by the digest of their payload; of equal payloads
the row with the largest id becomes a ``response`` record, the others become
``revisit`` records that name it.  Each task appends its records, every one a
gzip member of its own, to archive files in the shared folder and reports
where each record lies.  File names are new for each attempt of a task, and
only what a finished job reported is used, so a lost executor leaves at most
files that nothing names.

Index.  Captures are sorted by URL key (host parts reversed, then path and
query) and dealt by ranges.  Each range becomes one index file of compressed
blocks of ``LINES`` capture lines; the sparse directory holds one row for each
block: its first key and its place.  The first keys of the index files, one
for each ``PER_FILE`` captures, are the only thing sent to every task.

Looking up.  A key is routed to the index files that may hold it, found there
by binary search in the file's part of the directory, its blocks are read by
range, and the lines are searched by key.  The records themselves are then
read by range too, in the order in which they lie in their archives.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.llm.shared import map_batches, saved, text_or_empty
from tidemill.session import checkpoint_dir

LINES = 1000
PER_FILE = 200_000
ARCHIVE_BYTES = 256 << 20
#: compressed bytes that one task reads back
READ_BYTES = 16 << 20
SALT = 16
STAMP = "2026-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PLACE = "key binary, file string, offset long, length long"
CAPTURE = "page_id long, url string, record_type string, payload_digest string, " + PLACE
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
CAPTURE_NAMES, RECORD_NAMES = ([c.split()[0] for c in s.split(", ")] for s in (CAPTURE, RECORD))


def open_store(path: str):
    """The file system and path of a folder that driver and executors share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def url_key(url: str | None) -> bytes:
    """Host parts reversed and joined by commas, ``)``, then path and query; scheme, user, ``www.``, default port and
    fragment are left out and letters of the host lowered.  A text that is no URL with a host is its own key, null the empty one."""
    if url is None:
        return b""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return _plain(url)
    labels = host.rstrip(".").split(".")
    if len(labels) > 2 and labels[0] == "www":
        labels = labels[1:]
    standard = {"http": 80, "https": 443}.get(parts.scheme.lower())
    place = ",".join(reversed(labels)) + (f":{port}" if port not in (None, standard) else "")
    return _plain(place + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else ""))


def _plain(text: str) -> bytes:
    """No blanks, line ends or controls: they become percent escapes."""
    return b"".join(bytes([c]) if c > 32 and c != 127 else b"%%%02X" % c for c in text.encode("utf-8", "surrogatepass"))


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    number = name.strip("<>").rsplit(":", 1)[1]
    return None if number == "null" else int(number)


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None, refers_url: str | None = None, revisit: bool = False) -> tuple[bytes, str]:
    """An uncompressed WARC record and its payload digest; a revisit keeps the response's header lines alone."""
    digest = digest_text(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {STAMP}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _line(url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {_name(refers_to)}"]
        if refers_url is not None:
            lines.append("WARC-Refers-To-Target-URI: " + _line(refers_url))
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n", digest


def _line(text: str) -> str:
    """A header value on one line; what could not stand there is escaped as in JSON."""
    return text if text.isprintable() and text == text.strip() and not text.startswith('"') else json.dumps(text)


def _unline(text: str) -> str:
    return json.loads(text) if text.startswith('"') else text


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of an uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {n.lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record of another length than its header says")
    return fields, rest[:size]


def gzip_member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class _Appender:
    """New files in the shared folder, rolled at a size; ``put`` tells where the bytes went."""

    def __init__(self, folder: str, kind: str, roll: int):
        self.folder, self.kind, self.roll, self.stream = folder, kind, roll, None

    def put(self, data: bytes) -> tuple[str, int]:
        if self.stream is None or self.at >= self.roll:
            self.close()
            store, base = open_store(self.folder)
            store.create_dir(base, recursive=True)
            self.file, self.at = f"{self.kind}-{uuid.uuid4().hex}.gz", 0
            self.stream = store.open_output_stream(f"{base}/{self.file}", compression=None)
            if self.kind == "warc":
                block = b"software: tidemill\r\nformat: WARC File Format 1.1\r\n"
                info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {STAMP}\r\nWARC-Filename: {self.file}\r\n" \
                       f"Content-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
                first = gzip_member(info)
                self.stream.write(first)
                self.at = len(first)
        self.stream.write(data)
        self.at += len(data)
        return self.file, self.at - len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, and for rows that another row's equal payload stands for, ``of`` (its page_id and url).

    A payload that a third of all rows hold is dealt over ``SALT`` keys.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"))
    rows = rows.withColumn("payload", F.sha2(F.col("html").cast("binary"), 256))
    groups = (rows.where(F.octet_length("html") >= least_bytes).groupBy("payload")
              .agg(F.max(F.struct("page_id", "url")).alias("of"), F.count("*").alias("n")).where("n > 1")
              .select(F.col("payload").alias("_p"), "of", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_s")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int"))
    both = salted.join(groups, (F.col("payload") == F.col("_p")) & (F.col("salt") == F.col("_s")), "left")
    # rows that bear the largest id itself stay responses
    return both.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("of.page_id")), F.col("of")).alias("of"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row; the captures (where each record lies), saved in the shared folder.

    Of rows with equal payloads of at least ``least_bytes`` bytes those with
    the largest page_id are responses, the others revisit it (a null page_id
    counts as less than any; where all are null all are responses).  Null html
    is an empty payload.  A null url leaves its header line out.  Repeated
    rows are records of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Appender(folder, "warc", ARCHIVE_BYTES)
        for b in batches:
            rows = []
            for page, url, html, named, of, of_url in zip(*(c.to_pylist() for c in b.columns)):
                raw, digest = record_bytes(page, url, html, of, of_url, named)
                packed = gzip_member(raw)
                file, offset = files.put(packed)
                rows.append((page, url, "revisit" if named else "response", digest, url_key(url), file, offset, len(packed)))
            yield _batch(rows, CAPTURE)
        files.close()
    rows = with_revisits(pages, least_bytes).select(
        "page_id", "url", F.col("html").cast("binary").alias("html"), F.col("of").isNotNull().alias("named"),
        F.col("of.page_id").alias("of_page"), F.col("of.url").alias("of_url"))
    return saved(rows.mapInArrow(run, CAPTURE), "captures")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    fields = [c.split() for c in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def capture_line(row: tuple) -> bytes:
    """Key, time and a JSON object, as a line of the index."""
    page, url, kind, digest, key, file, offset, length = row
    said = {"page": page, "url": url, "mime": "text/html" if kind == "response" else "warc/revisit", "status": "200", "digest": digest,
            "length": length, "offset": offset, "filename": file}
    return key + b" 20260101000000 " + json.dumps(said).encode() + b"\n"


def line_capture(line: bytes) -> tuple:
    key, _, text = line.rstrip(b"\n").split(b" ", 2)
    said = json.loads(text)
    kind = "response" if said["mime"] == "text/html" else "revisit"
    return said["page"], said["url"], kind, said["digest"], key, said["filename"], said["offset"], said["length"]


DIRECTORY = "first binary, file string, offset long, length long, lines long"


def build_index(captures: DataFrame, folder: str, lines: int = LINES, per_file: int = PER_FILE) -> DataFrame:
    """Sort captures by key into index files of compressed blocks; the directory of blocks, saved in the shared folder."""
    parts = max(1, -(-captures.count() // per_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, held, entries = _Appender(folder, "index", 1 << 62), [], []

        def block() -> tuple:
            packed = gzip_member(b"".join(map(capture_line, held)))
            file, offset = files.put(packed)
            entry = (held[0][4], file, offset, len(packed), len(held))
            held.clear()
            return entry
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(row)
                if len(held) >= lines:
                    entries.append(block())
        if held:
            entries.append(block())
        files.close()
        yield _batch(entries, DIRECTORY)
    order = ("key", "file", "offset")  # unique, so that a range may end inside a key
    ranged = captures.select(*CAPTURE_NAMES).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return saved(ranged.mapInArrow(run, DIRECTORY), "capture-directory")


def lookup(directory: DataFrame, folder: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """All captures of the distinct keys of ``urls``: the columns of a capture, one row for each.

    Keys are compared whole.  A null url looks up the captures without one.
    URLs without captures give no rows, as does an empty index.
    """
    spark = directory.sparkSession
    keys = map_batches(urls.select(F.col(url_col).cast("string").alias("url")).distinct(),
                       lambda b: pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in b.column(0).to_pylist()], pa.binary())], names=["key"]),
                       "key binary").distinct()
    # one row for each index file, so one for PER_FILE captures
    tops = sorted((bytes(r["first"]), r["file"]) for r in directory.groupBy("file").agg(F.min("first").alias("first")).collect())
    if not tops:
        return spark.createDataFrame([], StructType.fromDDL(CAPTURE))
    firsts, files = [t[0] for t in tops], [t[1] for t in tops]

    def route(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for k in b.column(0).to_pylist():
            out += [(f, k) for f in files[max(0, bisect_left(firsts, k) - 1):bisect_right(firsts, k)]]
        return _batch(out, "file string, key binary")

    def find(entries: pa.Table, wanted: pa.Table) -> pa.Table:
        blocks = sorted(zip(entries["first"].to_pylist(), entries["offset"].to_pylist(), entries["length"].to_pylist()), key=lambda e: e[:2])
        starts, rows, now, lines = [e[0] for e in blocks], [], -1, []
        if blocks and wanted.num_rows:
            store, base = open_store(folder)
            with store.open_input_file(f"{base}/{entries['file'][0].as_py()}") as f:
                for k in sorted(wanted["key"].to_pylist()):
                    for n in range(max(0, bisect_left(starts, k) - 1), bisect_right(starts, k)):
                        if n != now:  # keys come in order, so one block is held at a time
                            f.seek(blocks[n][1])
                            lines = zlib.decompress(f.read(blocks[n][2]), 31).split(b"\n")[:-1]
                            now = n
                        at = bisect_left(lines, k + b" ")
                        while at < len(lines) and lines[at].startswith(k + b" "):
                            rows.append(line_capture(lines[at]))
                            at += 1
        return pa.Table.from_batches([_batch(rows, CAPTURE)])

    routed = map_batches(keys, route, "file string, key binary")
    # a stated number of partitions: rows are small, but each stands for a file or a block to read
    return (directory.repartition(len(tops), "file").groupBy("file")
            .cogroup(routed.repartition(len(tops), "file").groupBy("file")).applyInArrow(find, CAPTURE))


def read_records(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Read the records of ``captures`` from their archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Everything comes from the record: a response's payload is measured and
    its digest recomputed (a record that disagrees with its own header fails
    the job); a revisit gives the length and digest it carries.  With
    ``payloads`` the column ``payload`` (null in revisits) follows.
    """
    schema = RECORD + (", payload binary" if payloads else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        name, f, rows, size = None, None, [], 0
        for b in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, store.open_input_file(f"{base}/{file}")
                f.seek(offset)
                row = read_record(f.read(length))
                rows.append(row if payloads else row[:-1])
                size += len(row[-1] or b"") if payloads else 0
                if size > 8 << 20:
                    yield _batch(rows, schema)
                    rows, size = [], 0
            yield _batch(rows, schema)
            rows, size = [], 0
        if f is not None:
            f.close()
    places = saved(captures.select("file", "offset", "length"), "places")
    parts = max(1, -(-int(places.agg(F.sum("length")).first()[0] or 0) // READ_BYTES))
    order = ("file", "offset")
    return places.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, schema)


def read_record(member: bytes) -> tuple:
    fields, block = parse_record(zlib.decompress(member, 31))
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(next(v for n, _, v in (line.partition(b":") for line in head.split(b"\r\n")) if n.lower() == b"content-length"))
    if kind == "response" and (len(payload) != size or digest_text(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} is not what its header says")
    url = fields.get("warc-target-uri")
    refers = fields.get("warc-refers-to")
    return (_page(fields["warc-record-id"]), None if url is None else _unline(url), size, digest, kind,
            None if refers is None else _page(refers), payload if kind == "response" else None)


def archive(pages: DataFrame, least_bytes: int = 0) -> tuple[DataFrame, DataFrame, str]:
    """Write the archives and the index of ``pages`` (page_id, url, html): captures, directory and the shared folder.

    Other columns of ``pages`` are not read, so they may bear any name.  An
    empty table gives no files, an empty directory and empty results.
    """
    folder = f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    captures = write_archives(pages, folder, least_bytes)
    return captures, build_index(captures, folder), folder


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive ``pages``, look every URL up in the capture index, and read the records back from the archives."""
    _, directory, folder = archive(pages, least_bytes)
    return read_records(lookup(directory, folder, pages), folder, payloads=False)


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, upper(sha1(h)) AS x, max(page_id) OVER (PARTITION BY h) AS r FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = r THEN NULL ELSE r END AS refers_to
FROM k
"""
