"""WARC archives: a writer of deduplicated records and a splittable reader.

Every record is a gzip member of its own. The reader cuts the archives into
byte ranges, one task each: it looks for the gzip magic, takes a candidate for
a member when its first bytes decode to a WARC header, and owns the records
that start inside its range, decoding the last one beyond the range's end.

Of rows with equal payloads the one with the largest page_id becomes a
response and the others revisits of it.

Defined results: a null html is an empty payload; a null url leaves out the
target field. A null page_id is never the largest, unless all are null, and
those are responses then. Rows that share the largest page_id are responses
each. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_schema, materialize, table
from tidewater.session import scratch_path

RANGE_BYTES = 4 << 20
READ_BYTES = 256 << 10
MAGIC = b"\x1f\x8b\x08"
# The profile of a revisit whose payload is identical
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRAWL_DATE = "2024-01-01T00:00:00Z"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
FILES = "path string, size long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return "<urn:page:null>" if page_id is None else f"<urn:page:{page_id}>"


def _page(urn: str) -> int | None:
    n = urn.strip("<>").rpartition(":")[2]
    return None if n == "null" else int(n)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The gzip member of a response, or of a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {CRAWL_DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%')}")
    head.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(raw: bytes) -> dict:
    """A record's digest columns, checked against its own lengths and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    revisit = fields["warc-type"] == "revisit"
    return {"page_id": _page(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": _page(fields["warc-refers-to"]) if revisit else None}


def write_archives(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``path``; their (path, size).

    A task writes a file named for its attempt, and only files of attempts
    that ended well are listed; those of lost executors are never read.
    """
    page = F.col("page_id").cast("long")
    sha = F.sha1(F.coalesce(F.col("html"), F.lit("")))
    slim = pages.select(page.alias("p"), sha.alias("sha"))
    groups = slim.groupBy("sha").agg(F.max("p").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = materialize(slim.join(groups, "sha").where("p IS NULL AND refers_to IS NOT NULL OR p <> refers_to").distinct(),
                           "revisits")
    rows = (pages.select(page.alias("page_id"), "url", "html", sha.alias("_sha"))
            .join(revisits, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("_sha") == F.col("sha")), "left")
            .select("page_id", "url", "html", "refers_to"))
    schema = arrow_schema(FILES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{path}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        fs, place = pafs.FileSystem.from_uri(name)
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        size = 0
        with fs.open_output_stream(place, compression=None) as out:
            for b in batches:
                for r in b.to_pylist():
                    size += out.write(record(r["page_id"], r["url"], (r["html"] or "").encode(), r["refers_to"]))
        yield pa.RecordBatch.from_pydict({"path": [name], "size": [size]}, schema=schema)

    return materialize(rows.mapInArrow(run, FILES), "archives")


def members(read, start: int, end: int) -> Iterator[bytes]:
    """Decoded WARC members that start in ``[start, end)``; ``read(at, n)`` gives bytes."""
    at, data, base = start, b"", start

    def view(pos: int, n: int) -> bytes:
        nonlocal data, base
        if pos < base or pos + n > base + len(data):
            data, base = read(pos, max(n, READ_BYTES)), pos
        return data[pos - base:pos - base + n]

    while at < end:
        window = view(at, min(READ_BYTES, end + len(MAGIC) - 1 - at))
        found = window.find(MAGIC)
        if found < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        out, stop = _member(view, at)
        if out is None:
            at += 1
        else:
            yield out
            at = stop


def _member(view, at: int) -> tuple[bytes | None, int]:
    """A member's content and its end; None unless it opens with a WARC header and ends well."""
    z, out, pos = zlib.decompressobj(31), [], at
    got, checked = 0, False
    while not z.eof:
        piece = view(pos, READ_BYTES // 4)
        if not piece:
            return None, at
        try:
            part = z.decompress(piece)
        except zlib.error:
            return None, at
        pos += len(piece)
        out.append(part)
        got += len(part)
        if not checked and got >= 5:
            if not b"".join(out)[:5] == b"WARC/":
                return None, at
            checked = True
    return (b"".join(out), pos - len(z.unused_data)) if checked else (None, at)


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the archives listed in ``files``, a byte range per row and task slot."""
    total = files.agg(F.sum(F.ceil(F.col("size") / range_bytes))).first()[0] or 1
    ranges = (files.where("size > 0")
              .select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
              .repartition(min(int(total), 100_000)))
    schema = arrow_schema(RECORDS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                fs, place = pafs.FileSystem.from_uri(r["path"])
                with fs.open_input_file(place) as f:
                    rows = [parse(m) for m in members(lambda at, n: f.read_at(n, at), r["start"],
                                                      min(r["start"] + range_bytes, f.size()))]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.mapInArrow(run, RECORDS)


def op4_splittable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "llm", "warc"))
    return read_archives(files)
