"""WARC archives: writer, monolithic gzip normaliser with a sidecar index, reader.

1. ``write_archives``: every task streams its pages as WARC records into one
   gzip stream over the whole file.  Of records with equal payloads the one
   with the smallest page_id is a ``response``; the others are ``revisit``
   records without payload that refer to it.
2. ``normalise``: each such file is inflated once, as a stream; every record
   is written again as a gzip member of its own, and a sidecar index lists
   offset, length, type and page of each member.  Memory does not grow with
   the file or with a record.
3. ``read_back``: records are read by seeking to their member.

Files go to the shared folder through ``pyarrow.fs`` (local, HDFS, S3 and
others, by the scheme of ``spark.checkpoint.dir``).  A file name holds the
task attempt, and only files that a committed table lists are read, so a lost
executor or a repeated task leaves at most an unread file.

A null page counts as an empty payload; a null url as an empty one.  Records
with a null page_id are responses only where no record with an id has the
payload.  Fully repeated rows have the same role: both responses, or both
revisits.  Equal payloads are grouped by digest and length, so a group of any
size is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged, table
from quarry.session import scratch_path

MIN_PAYLOAD = 0       # payloads of fewer bytes are never deduplicated
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"   # WARC-Date of the records; a parameter, so that archives are reproducible
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "path string, offset long, length long, record_type string, page_id long"


def _base32(hex_digest: str) -> str:
    import base64
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def with_roles(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(page_id, url, payload, sha1, size, refers_to): ``refers_to`` is null for responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    shared = staged(rows.where(F.col("size") >= min_payload).groupBy("sha1", "size")
                    .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-shared")
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, ["sha1", "size"], "left").select(
        "page_id", "url", "payload", "sha1", "size", F.when(F.col("first").isNotNull() & other, F.col("first")).alias("refers_to"))


def record_id(page_id) -> str:
    import uuid
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url: str, payload: bytes, sha1: str, size: int, refers_to, date: str = DATE) -> bytes:
    """One WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", date), ("WARC-Target-URI", "".join(url.split())), ("WARC-Payload-Digest", f"sha1:{_base32(sha1)}"),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(body))]
    if page_id is not None:
        fields.append(("WARC-Page-ID", page_id))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("WARC-Refers-To-Page-ID", refers_to)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def _attempt() -> str:
    from pyspark import TaskContext
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}" if task else "000000-0"


def write_archives(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(path, records): one whole-file gzip archive per task, written once."""
    def run(batches):
        import zlib

        import pyarrow as pa
        from pyarrow import fs
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        path, n = f"{root}/{_attempt()}.warc.gz", 0
        squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
        with files.open_output_stream(path, compression=None) as out:
            for b in batches:
                for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "size", "refers_to")), strict=True):
                    out.write(squeeze.compress(record(*row)))
                    n += 1
            out.write(squeeze.flush())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])

    return staged(with_roles(pages, min_payload).mapInArrow(run, "path string, records long"), "warc-archives")


class _Inflated:
    """Reads an inflated gzip stream, of one member or several, piece by piece."""

    def __init__(self, raw):
        import zlib
        self.raw, self.zlib, self.buffer, self.pending, self.started = raw, zlib, bytearray(), b"", False
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if not self.pending:
                self.pending = self.raw.read(CHUNK)
            if not self.pending:
                if self.started:
                    raise EOFError("the archive ends inside a gzip member")
                return False
            if self.inflate.eof:
                self.inflate = self.zlib.decompressobj(31)
            self.started = True
            got = self.inflate.decompress(self.pending, CHUNK)
            self.pending = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.started = False
            if got:
                self.buffer += got
                return True

    def head(self) -> bytes | None:
        """The next record's header with its empty line; None at the end."""
        at = 0
        while True:
            end = self.buffer.find(b"\r\n\r\n", at)
            if end >= 0:
                out = bytes(self.buffer[:end + 4])
                del self.buffer[:end + 4]
                return out
            at = max(0, len(self.buffer) - 3)
            if not self.more():
                if self.buffer.strip():
                    raise EOFError("the archive ends inside a record header")
                return None

    def pieces(self, n: int):
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.buffer and not self.more():
                raise EOFError("the archive ends inside a record")
            out = bytes(self.buffer[:n])
            del self.buffer[:n]
            n -= len(out)
            yield out


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def normalise_stream(raw, out, level: int = 6):
    """Inflate ``raw`` once and write each record as its own gzip member;
    yields (offset, length, type, page id) of each."""
    import zlib
    source, offset = _Inflated(raw), 0
    while (head := source.head()) is not None:
        named = fields_of(head)
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        size = out.write(squeeze.compress(head))
        for piece in source.pieces(int(named["content-length"]) + 4):
            size += out.write(squeeze.compress(piece))
        size += out.write(squeeze.flush())
        page = named.get("warc-page-id")
        yield offset, size, named.get("warc-type", ""), int(page) if page is not None else None
        offset += size


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Sidecar index rows (path, offset, length, record_type, page_id) of the
    record-wise archives, one file per input file with an ``.idx`` beside it."""
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        k = 0
        for b in batches:
            for source in b.column("path").to_pylist():
                path = f"{root}/{_attempt()}-{k}.warc.gz"
                k += 1
                rows: list[tuple] = []
                with files.open_input_stream(source, compression=None) as raw, \
                        files.open_output_stream(path, compression=None) as out, \
                        files.open_output_stream(path + ".idx", compression=None) as idx:
                    for row in normalise_stream(raw, out):
                        rows.append(row)
                        idx.write("\t".join("" if x is None else str(x) for x in row).encode() + b"\n")
                        if len(rows) >= 10_000:
                            yield _index_batch(pa, path, rows)
                            rows = []
                yield _index_batch(pa, path, rows)

    files = max(1, archives.count())
    return staged(archives.select("path").repartition(files).mapInArrow(run, INDEX), "warc-index")


def _index_batch(pa, path, rows):
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                                      names=["path", "offset", "length", "record_type", "page_id"])


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to) of every indexed record.  A revisit has no payload; its digest
    and length are those that it records of the full one."""
    def run(batches):
        import base64
        import hashlib
        import zlib

        import pyarrow as pa
        from pyarrow import fs
        files, _ = fs.FileSystem.from_uri(folder)
        kinds = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(),
                 "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
        source, opened = None, None
        try:
            for b in batches:
                out: dict[str, list] = {k: [] for k in kinds}
                for path, offset, length in zip(*(b.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                    if path != opened:
                        if source:
                            source.close()
                        source, opened = files.open_input_file(path), path
                    source.seek(offset)
                    data = zlib.decompress(source.read(length), 31)
                    cut = data.index(b"\r\n\r\n") + 4
                    named = fields_of(data[:cut])
                    body = data[cut:cut + int(named["content-length"])]
                    at = body.index(b"\r\n\r\n") + 4
                    revisit = named["warc-type"] == "revisit"
                    payload = None if revisit else body[at:]
                    page, refers = named.get("warc-page-id"), named.get("warc-refers-to-page-id")
                    out["page_id"].append(int(page) if page is not None else None)
                    out["url"].append(named["warc-target-uri"])
                    out["payload"].append(payload)
                    out["payload_bytes"].append(int(fields_of(body[:at])["content-length"]) if revisit else len(payload))
                    out["payload_digest"].append(named["warc-payload-digest"].removeprefix("sha1:") if revisit
                                                 else base64.b32encode(hashlib.sha1(payload).digest()).decode())
                    out["record_type"].append(named["warc-type"])
                    out["refers_to"].append(int(refers) if refers is not None else None)
                yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in kinds.items()], names=list(kinds))
        finally:
            if source:
                source.close()

    return index.mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long")


def archive(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write, normalise and read back; the files stay in the shared folder."""
    folder = scratch_path(pages.sparkSession, "warc")
    whole = write_archives(pages, f"{folder}/whole", min_payload)
    return read_back(normalise(whole, f"{folder}/records"), f"{folder}/records")


def op6_warc(spark, sf_dir):
    return archive(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _quintet(k: int) -> str:
    group = f"CAST('0x' || substr(h, {5 * (k // 4) + 1}, 5) AS BIGINT)"
    return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({group} >> {15 - 5 * (k % 4)}) & 31 AS INTEGER) + 1, 1)"


OP6_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {" || ".join(_quintet(k) for k in range(32))} AS payload_digest,
       CASE WHEN n >= {MIN_PAYLOAD} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_PAYLOAD} AND page_id <> first THEN first END AS refers_to
FROM f
"""
