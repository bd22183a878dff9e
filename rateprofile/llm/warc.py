"""WARC archives with an index first, read back by coalesced byte ranges.

Writing: pages with equal payloads share one response, the one with the largest
page id; the others are revisits of it. Each task writes its records into an
archive of its own (one gzip member per record) in the shared folder and returns
an index row per record: archive, offset, length, URL and digest. A task that is run again
writes a new file, and only the index rows of the finished attempt count.

Reading: the index rows of the selected records are sorted by archive and offset;
ranges that touch, or lie within ``max_gap`` bytes, become one read of up to about
``max_read`` bytes, and the records are cut out of it by their offsets.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, new_path

MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 512 << 20
MAX_GAP = 64 << 10
MAX_READ = 8 << 20
DATE = "2024-01-01T00:00:00Z"
_ID = "urn:x-page:"
_INDEX = "archive string, offset long, length long, url string, payload_digest string, page_id long, record_type string"
_RECORDS = "archive string, offset long, url string, page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary, intact boolean"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to): ``refers_to`` is null for responses."""
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    # small rows for the sums; only payloads that occur again are looked up
    same = rows.groupBy("sha").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).filter("n > 1").select("sha", "last")
    joined = rows.join(same, "sha", "left")
    revisit = (F.octet_length("payload") >= min_revisit_bytes) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("last")).alias("refers_to"))


def _clean(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sha: str) -> bytes:
    """One uncompressed WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = page_id if page_id is not None else "none-" + uuid.uuid4().hex
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def write(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives below ``path`` (default: the shared folder) and return
    their index (a table in the shared folder): ``archive``, ``offset``, ``length``, ``url``,
    ``payload_digest``, ``page_id``, ``record_type``.

    A null payload is empty, a null URL an empty target; a null page id is
    never the largest; rows that repeat the largest id are each a response. An empty
    table has an empty index. Other columns are not archived.
    """
    path = (path or new_path(pages.sparkSession, "warc")).rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = name = None
        at = 0
        try:
            for batch in batches:
                rows: dict[str, list] = {c: [] for c in ("archive", "offset", "length", "url", "payload_digest", "page_id", "record_type")}
                for page_id, url, payload, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                    page_id, url, payload, refers_to = page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py()
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{path}/{uuid.uuid4().hex}.warc.gz", 0
                        system, local = _open(name)
                        system.create_dir(local.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(local, compression=None)
                    sha = digest(payload)
                    member = gzip.compress(record(page_id, url, payload, refers_to, sha), 3, mtime=0)
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    for c, v in zip(rows, (name, at, len(member), url, sha, page_id, kind)):
                        rows[c].append(v)
                    at += len(member)
                types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))
        finally:
            if out is not None:
                out.close()

    return materialise(verdicts(pages, id_col, url_col, payload_col, min_revisit_bytes).mapInArrow(run, _INDEX), "warc-index")


def ranges(index: DataFrame, max_gap: int = MAX_GAP, max_read: int = MAX_READ) -> DataFrame:
    """(archive, start, end, records): the reads that cover the records of ``index``."""
    by_offset = Window.partitionBy("archive").orderBy("offset")
    gap = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(by_offset)
    runs = index.withColumn("new", F.when(gap <= max_gap, 0).otherwise(1)).withColumn("run", F.sum("new").over(by_offset))
    runs = runs.withColumn("part", F.floor(F.col("offset") / max_read))
    one = F.struct("offset", "length", "url", "payload_digest")
    return runs.groupBy("archive", "run", "part").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"), F.array_sort(F.collect_list(one)).alias("records")).drop("run", "part")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _page(name: str | None) -> int | None:
    m = re.fullmatch(rf"<{_ID}(-?\d+)>", name or "")
    return int(m[1]) if m else None


def read(index: DataFrame, max_gap: int = MAX_GAP, max_read: int = MAX_READ) -> DataFrame:
    """The records of ``index`` (or of any selection of its rows), read from the
    archives: ``archive``, ``offset``, ``url``, ``page_id``, ``record_type``, ``refers_to``,
    ``payload_digest`` and ``payload_bytes`` (both of the full payload), ``payload`` (null for
    revisits), ``intact`` (block, and payload if present, agree with the digests in record and
    index)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, pa.NativeFile] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                archive, start, end, records = (batch.column(c)[i].as_py() for c in ("archive", "start", "end", "records"))
                if archive not in files:
                    for f in files.values():
                        f.close()
                    system, local = _open(archive)
                    files = {archive: system.open_input_file(local)}
                data = files[archive].read_at(end - start, start)
                rows = [_decode(archive, start, data, r) for r in records]
                schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("url", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("intact", pa.bool_())])
                yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges(index, max_gap, max_read).mapInArrow(run, _RECORDS)


def _decode(archive: str, start: int, data: bytes, r: dict) -> dict:
    at = r["offset"] - start
    headers, block = parse(data[at : at + r["length"]])
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    sha = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit:
        found, size = digest(payload), len(payload)
    intact = headers["WARC-Block-Digest"] == f"sha1:{digest(block)}" and sha == r["payload_digest"] and (revisit or found == sha)
    return {
        "archive": archive,
        "offset": r["offset"],
        "url": headers["WARC-Target-URI"],
        "page_id": _page(headers["WARC-Record-ID"]),
        "record_type": headers["WARC-Type"],
        "refers_to": _page(headers.get("WARC-Refers-To")),
        "payload_digest": sha if revisit else found,
        "payload_bytes": size,
        "payload": None if revisit else payload,
        "intact": intact,
    }
