"""WARC archives with a record index.

Writing: every task writes the records of its partition to archives of its own, one
gzip member per record, and returns the index rows (file, offset, length, url, digest,
...) of what it wrote. A file name carries a random part, so a task that runs again
writes other files and the index only names those of the attempt that counted.

Reading: selected index rows are sorted by file and offset; neighbouring byte ranges are
merged into one read, cut into records and parsed.

Folders may be local paths or URIs of any store that pyarrow.fs knows.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table, scratch_path

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
MERGE_GAP = 64 << 10
READ_BYTES = 8 << 20
TASK_BYTES = 128 << 20
DATE = "2000-01-01T00:00:00Z"
INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _store(path: str):
    """(file system, path in it)."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def _record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def build_record(page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to, revisit: bool) -> bytes:
    """One record as bytes: an HTTP response head, then the payload unless it is a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        fields += [("WARC-Refers-To", _record_id(refers_to)),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of RECORD from a record's bytes; a response's digest is taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    revisit = fields["WARC-Type"] == "revisit"
    said = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload,
            "payload_bytes": said if revisit else len(payload), "record_type": fields["WARC-Type"],
            "payload_digest": fields["WARC-Payload-Digest"][7:] if revisit else hashlib.sha256(payload).hexdigest(),
            "refers_to": number(fields.get("WARC-Refers-To"))}


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row below ``path`` and return the index, a written table.

    Of rows with equal payloads of at least ``min_revisit_bytes`` those with the smallest
    id are responses (several if the row is repeated), the others revisits of it; smaller
    payloads are all responses. Null html: empty payload. Null id: a record with an empty
    id, a revisit if another row with an id has the payload. Null url: no target field.
    An empty table writes no archive and returns an empty index.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("html"),
                     F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("digest"))
    # the smallest id of every payload that occurs more than once
    first = (p.filter(F.col("n_bytes") >= min_revisit_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1 and first is not null").select(F.col("digest").alias("f_digest"), "first"))
    first = materialize(first, "first")
    p = p.join(first, (p.digest == first.f_digest) & (p.n_bytes >= min_revisit_bytes), "left").drop("f_digest")
    p = p.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    p = p.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "n_bytes", "digest", "refers_to")
    schema = _arrow(INDEX)

    def write(batches):
        store, root = _store(path)
        name, out, offset = None, None, 0
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    revisit = r["refers_to"] is not None
                    raw = build_record(r["page_id"], r["url"], (r["html"] or "").encode(), r["digest"], r["n_bytes"], r["refers_to"], revisit)
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = z.compress(raw) + z.flush()
                    if out is None or offset + len(member) > archive_bytes:
                        if out is not None:
                            out.close()
                        else:
                            store.create_dir(root, recursive=True)
                        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        out, offset = store.open_output_stream(posixpath.join(root, name), compression=None), 0
                    out.write(member)
                    rows.append({"file": name, "offset": offset, "length": len(member), "page_id": r["page_id"], "url": r["url"],
                                 "digest": r["digest"], "record_type": "revisit" if revisit else "response"})
                    offset += len(member)
                yield pa.RecordBatch.from_pylist(rows, schema)
        finally:
            if out is not None:
                out.close()

    return materialize(p.mapInArrow(write, INDEX), "index")


def read_records(selected: DataFrame, path: str, merge_gap: int = MERGE_GAP, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records of index rows ``selected`` (RECORD), by merged byte-range reads.

    Ranges of a file that lie at most ``merge_gap`` bytes apart are read together, up to
    ``read_bytes`` at once; no task holds more than one such read. An index row that is
    selected twice is returned twice.
    """
    schema = _arrow(RECORD)

    def read(batches):
        store, root = _store(path)
        source, opened, run = None, None, []

        def records():
            nonlocal source, opened
            if not run:
                return
            file, start, stop = run[0][0], run[0][1], max(o + n for _, o, n in run)
            if opened != file:
                if source is not None:
                    source.close()
                source, opened = store.open_input_file(posixpath.join(root, file)), file
            data = source.read_at(stop - start, start)
            got = [parse_record(zlib.decompress(data[o - start:o - start + n], 31)) for _, o, n in run]
            run.clear()
            yield pa.RecordBatch.from_pylist(got, schema)

        try:
            for batch in batches:
                for file, offset, length in zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")]):
                    if run and (file != run[0][0] or offset > run[-1][1] + run[-1][2] + merge_gap or offset + length - run[0][1] > read_bytes):
                        yield from records()
                    run.append((file, offset, length))
            yield from records()
        finally:
            if source is not None:
                source.close()

    # few bytes of index stand for many bytes of archive: the tasks follow the latter
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES + 1)
    ranges = selected.select("file", "offset", "length").repartition(tasks, "file").sortWithinPartitions("file", "offset")
    return ranges.mapInArrow(read, RECORD)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    index = write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_records(index, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY ALL),
r AS (SELECT p.*, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
      FROM p LEFT JOIN f ON digest = payload_digest AND payload_bytes >= 100)
SELECT page_id, payload_bytes, payload_digest, refers_to,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type
FROM r
"""
