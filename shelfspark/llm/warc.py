"""WARC archives with revisit records.

``resolve`` works on headers alone: page, payload digest and length. Headers with
equal digests are brought together by a partial aggregation to the smallest page
(so a digest that a third of all pages share costs one row a task), and that page
is joined back as the original. ``write_archives`` puts the payload of originals and
of unshared records into the archives, and bare fresh headers for revisits.

Edge cases: a null html is an empty payload; payloads under 100 bytes are never
revisits; a page_id that comes twice with the same payload gives a response and no
revisit to itself; a null page_id can revisit, but is never the original; an empty
table gives an empty archive folder and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .common import fresh_path

#: Payloads below this many bytes are stored each time.
LEAST_BYTES = 100
#: An archive file is closed when it has this many bytes.
ARCHIVE_BYTES = 16 << 20
#: Date of the fresh headers, so that a task that runs again writes equal bytes.
WRITTEN_AT = "2024-01-01T00:00:00Z"

RESULT = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "target_uri string, archive string"
)


def resolve(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, payload_digest, payload_bytes and refers_to (null for a response), without payloads."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    heads = pages.select(
        "page_id", F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes")
    )
    firsts = (
        heads.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return heads.join(firsts, "payload_digest", "left").select(
        "page_id",
        "payload_digest",
        "payload_bytes",
        F.expr("nullif(first_id, page_id)").alias("refers_to"),
    )


def record(page_id, url, html, digest, size, refers_to) -> bytes:
    """One WARC/1.1 record as a gzip member of its own."""
    revisit = refers_to is not None
    body = b"" if revisit else html
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {WRITTEN_AT}",
        "WARC-Target-URI: " + (url or "").replace("\r", " ").replace("\n", " "),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head[7:7] = [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=1, mtime=0)


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes the partition's archives and yields their names and lengths."""
        from pyspark import TaskContext

        part, n, size, members = TaskContext.get().partitionId(), 0, 0, []

        def close():
            name = f"part-{part:06d}-{n:04d}.warc.gz"
            files.put(folder, name, b"".join(members))
            return pa.RecordBatch.from_pydict({"archive": [name], "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                members.append(record(*row))
                size += len(members[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    n, size, members = n + 1, 0, []
        if members:
            yield close()

    return write


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> int:
    """Write all pages as archives below folder; returns the number of archives.

    The payloads are shuffled once, by page, to meet their verdicts.
    """
    heads = resolve(pages, least_bytes).withColumnRenamed("page_id", "__id")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digest = F.sha2(payload, 256)
    # A page_id may come twice: the verdict belongs to the page and its payload.
    heads = heads.dropDuplicates(["__id", "payload_digest"])
    full = pages.select("page_id", "url", payload.alias("html"), digest.alias("__digest"))
    rows = full.join(
        heads, F.col("__id").eqNullSafe(F.col("page_id")) & (F.col("__digest") == F.col("payload_digest")), "left"
    ).select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "__digest", "payload_bytes", "refers_to")
    files.make_folder(folder)
    return rows.mapInArrow(_writer(folder), "archive string, bytes long").count()


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and body of each gzip member of an archive, one member in memory at a time."""
    view = memoryview(data)
    while len(view):
        d = zlib.decompressobj(31)
        raw = d.decompress(view) + d.flush()
        view = view[len(view) - len(d.unused_data) :]
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def _page(urn: str) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if len(urn) > len("<urn:page:>") else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows = []
            for h, body in parse(data.as_buffer()):
                revisit = h["WARC-Type"] == "revisit"
                digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                if not revisit and (hashlib.sha256(body).hexdigest() != digest or len(body) != int(h["X-Payload-Length"])):
                    raise ValueError(f"{path}: payload of {h['WARC-Record-ID']} is damaged")
                rows.append(
                    (_page(h["WARC-Record-ID"]), int(h["X-Payload-Length"]), digest, h["WARC-Type"], _page(h["WARC-Refers-To"]) if revisit else None, h["WARC-Target-URI"], path.rpartition("/")[2])
                )
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "archive"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record; response payloads are checked against their digests."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return raw.select("path", "content").mapInArrow(_read, RESULT)


def op7_warc(spark, sf_dir) -> DataFrame:
    folder = fresh_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(spark, folder).drop("target_uri", "archive")


ORACLE_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest, url FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100
"""
