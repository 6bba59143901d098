"""WARC archives: written as one gzip stream each, normalised to a member per record with an offset index, read back.

1. ``write_archives``: pages with equal payloads become one response (the largest page_id) and revisits to it; tasks
   write archives whose records share a single gzip stream, as many tools do.
2. ``normalise``: such a file can only be read from its start.  A task inflates it once, as a stream, writes every
   record as a gzip member of its own, and beside it a sidecar index (JSON lines: record, type, offset, length).
   Memory holds a record's header and a piece of its block.
3. ``read_records``: any record by archive, offset and length, without what stands before it; payloads are checked
   against their digests.

A payload that very many pages share is a hot key of the join that finds its response; its sides are a table scan and
a written table, so that Spark can split it.  Files go to the shared folder under their final names only when whole.

Defined cases: null = empty payload; of equal payloads all rows that carry the largest page_id are responses
(repeated rows); a null page_id is no candidate for the response unless all are null; control characters in a url
are percent-encoded; extra columns pass by; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from .common import saved, small_batches, table, text_of
from .files import opened

PIECE = 1 << 20
#: An archive ends after the record that reaches this size.
ARCHIVE_BYTES = 64 << 20
LEVEL = 1
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
ENDING = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    name = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return None if name == "null" else int(name)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; a revisit (``refers_to`` set) carries no payload but its digest and length."""
    clean = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    block = HTTP.format(len(payload)).encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", page_urn(page_id)),
            ("WARC-Date", DATE), ("WARC-Target-URI", clean), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Length", str(len(payload)))]
    if refers_to is None:
        block += payload
    else:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", page_urn(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + ENDING


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:] if ": " in x)


class _Draft:
    """A file that gets its name when it is whole."""

    def __init__(self, folder: str, name: str):
        self.system, path = opened(folder)
        self.draft, self.final, self.uri = f"{path}/.{name}-{uuid.uuid4().hex}", f"{path}/{name}", f"{folder}/{name}"
        self.out, self.size = self.system.open_output_stream(self.draft), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def done(self) -> str:
        self.out.close()
        self.system.move(self.draft, self.final)
        return self.uri


def _write(folder: str, archive_bytes: int):
    def run(batches):
        draft = gzip = None
        size = n = 0
        for batch in batches:
            made = []
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for page_id, url, payload, digest, refers_to in zip(*columns):
                if draft is None:
                    draft = _Draft(folder, f"crawl-{uuid.uuid4().hex}.warc.gz")
                    gzip, size, n = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                name = base64.b32encode(bytes.fromhex(digest)).decode()
                whole = record(page_id, url, payload.encode(), name, refers_to)
                draft.write(gzip.compress(whole))
                size, n = size + len(whole), n + 1
                if size >= archive_bytes:
                    draft.write(gzip.flush())
                    made.append((draft.done(), n))
                    draft = None
            yield _listed(made)
        if draft is not None:
            draft.write(gzip.flush())
            yield _listed([(draft.done(), n)])
    return run


def _listed(made) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
                                      names=["archive", "records"])


def write_archives(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, records) of the monolithic archives written for ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = fresh_dir(spark, "warc-crawl")
    rows = pages.select("page_id", "url", text_of("html").alias("payload")) \
        .withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    responses = saved(rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
                      .agg(F.max("page_id").alias("response")), "warc-responses")
    known = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    dealt = rows.join(responses, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(known, F.col("response")).alias("refers_to"))
    return saved(dealt.mapInArrow(_write(folder, archive_bytes), "archive string, records bigint"), "warc-archives")


def _inflated(uri: str):
    """The bytes of a gzip file, piece by piece, over all its members; an error if the last one isn't whole."""
    system, path = opened(uri)
    with system.open_input_stream(path, compression=None) as source:
        gzip, begun = zlib.decompressobj(31), False
        while piece := source.read(PIECE):
            while piece:
                yield gzip.decompress(piece)
                begun = not gzip.eof
                piece = gzip.unused_data if gzip.eof else b""
                if gzip.eof:
                    gzip = zlib.decompressobj(31)
        if begun:
            raise ValueError(f"{uri}: the gzip stream is cut off")


def _rewrite(uri: str, folder: str, name: str) -> tuple[str, list[tuple[int, int, str, str]]]:
    """Every record as a member of its own, and the index (offset, length, record, type)."""
    source = _inflated(uri)
    out, index, held, at = _Draft(folder, name), [], b"", 0

    def more() -> bool:
        nonlocal held, at
        piece = next(source, None)
        held, at = held[at:] + (piece or b""), 0
        return piece is not None
    while True:
        while (end := held.find(ENDING, at)) < 0:
            if not more():
                break
        if end < 0:
            if held[at:].strip():
                raise ValueError(f"{uri}: the file ends within a record's header")
            break
        head = fields(held[at:end])
        left = end - at + len(ENDING) + int(head["Content-Length"]) + len(ENDING)
        start, gzip = out.size, zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        while left:
            if at == len(held) and not more():
                raise ValueError(f"{uri}: the file ends within a record")
            piece = held[at:at + left]
            out.write(gzip.compress(piece))
            at, left = at + len(piece), left - len(piece)
        out.write(gzip.flush())
        index.append((start, out.size - start, head["WARC-Record-ID"], head["WARC-Type"]))
    side = _Draft(folder, name + ".idx")
    for offset, length, urn, kind in index:
        side.write(json.dumps({"record": urn, "type": kind, "offset": offset, "length": length}).encode() + b"\n")
    side.done()
    return out.done(), index


def _normalise(folder: str):
    def run(batches):
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                archive, index = _rewrite(uri, folder, uri.rsplit("/", 1)[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([archive] * len(index), pa.string()), *(pa.array([x[i] for x in index], t) for i, t in (
                        (0, pa.int64()), (1, pa.int64()), (2, pa.string()), (3, pa.string())))],
                    names=["archive", "offset", "length", "record", "type"])
    return run


def normalise(archives: DataFrame) -> DataFrame:
    """The index (archive, offset, length, record, type) of the archives' normalised copies."""
    spark = archives.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return saved(archives.select("archive").repartition(n).mapInArrow(
        _normalise(fresh_dir(spark, "warc-normal")),
        "archive string, offset bigint, length bigint, record string, type string"), "warc-index")


def _read(batches):
    held, source = None, None
    for batch in batches:
        out = []
        for uri, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
            if uri != held:
                if source is not None:
                    source.close()
                system, path = opened(uri)
                held, source = uri, system.open_input_file(path)
            source.seek(offset)
            whole = zlib.decompress(source.read(length), 31)
            end = whole.index(ENDING)
            head = fields(whole[:end])
            block = whole[end + len(ENDING):-len(ENDING)]
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            refers = head.get("WARC-Refers-To")
            size = int(head["X-Payload-Length"])
            payload = block[block.index(ENDING) + len(ENDING):]
            if refers is None and (len(payload) != size or base32_sha1(payload) != digest):
                raise ValueError(f"{uri} at {offset}: the payload does not match its digest")
            out.append((page_of(head["WARC-Record-ID"]), head["WARC-Target-URI"], size, digest, head["WARC-Type"],
                        refers and page_of(refers), None if refers else payload.decode()))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=[
            "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of an index's records."""
    # a number of its own, so that the few bytes of the index aren't merged into one task that reads all archives
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(n, "archive").sortWithinPartitions("archive", "offset").select("archive", "offset", "length").mapInArrow(
        _read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
               "refers_to bigint, payload string")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_records(normalise(write_archives(table(spark, sf_dir, "pages")))) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p),
d AS (
  SELECT *, list_transform(range(0, 8), lambda j: ('0x' || substr(h, (1 + 5 * j)::BIGINT, 5))::INT) AS v FROM f)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((v[(i // 4 + 1)::INT] >> (15 - 5 * (i % 4))::INT) & 31) + 1)::BIGINT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""
