"""WARC archives: a deterministic sharded writer with revisit records, and its reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import fresh_path, materialise

from .common import slices, table
from .order import sums_before

ROLL_BYTES = 1 << 20  # compressed size after which a file is closed; raise it with the corpus
REVISIT_BYTES = 0  # payloads of at least so many bytes are stored once
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
MOST_TASKS = 10_000  # that read archives; beyond, a task reads several files
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD = "page_id long, url string, key binary, digest binary, payload_bytes long, size long"
_MANIFEST = "file string, records long, bytes long, sha256 string"
_RECORD = "page_id long, url string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to long, file string, offset long"


def order_key(page_id: int | None, digest: bytes) -> bytes:
    """Bytes that sort by page_id, nulls last, then by payload digest."""
    return (b"\xff" * 9 if page_id is None else b"\x00" + (page_id + (1 << 63)).to_bytes(8, "big")) + digest + b"\x01"


def record_id(key: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(key).digest()[:16], version=4)}>"


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, key: bytes, digest: bytes, payload: bytes | None, payload_bytes: int, first: tuple[int, str] | None = None, date: str = DATE) -> bytes:
    """A whole record as a gzip member; without `first` a response, else a revisit of it."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block += payload or b""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if first else 'response'}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{b32(digest)}",
        f"WARC-Block-Digest: sha1:{b32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if first:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {first[1]}", f"X-Refers-To-Page-Id: {first[0]}"]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in slices(batches, "html"):
        out = []
        for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
            payload = (html or "").encode()
            digest = hashlib.sha1(payload).digest()
            key = order_key(page_id, digest)
            member = record(page_id, url, key, digest, payload, len(payload))
            out.append((page_id, url, key, digest, len(payload), len(member), member))
        yield out


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _responses(batches):
        types = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[x.split()[0] for x in _HEAD.split(", ")])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _responses(batches):
        yield pa.record_batch([pa.array([r[2] for r in rows], pa.binary()), pa.array([r[6] for r in rows], pa.binary())], names=["key", "member"])


def _revisits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            member = None
            if r["first_id"] is not None:
                first = r["first_id"], record_id(order_key(r["first_id"], r["digest"]))
                member = record(r["page_id"], r["url"], r["key"], r["digest"], None, r["payload_bytes"], first)
            out.append((r["key"], len(member) if member else r["size"], member))
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.binary()))], names=["key", "size", "revisit"])


def _open(root: str):
    """File system of the shared folder, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _writer(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by file, key and kind: a key's decisions before its members. A file gets its name when it is whole."""
        system, folder = _open(root)
        now, sink, temp, decision, n, size, digest = None, None, "", None, 0, 0, None

        def close() -> pa.RecordBatch:
            sink.close()
            name = f"part-{now:08d}.warc.gz"
            system.move(temp, f"{folder}/{name}")
            return pa.record_batch([[name], [n], [size], [digest.hexdigest()]], names=[x.split()[0] for x in _MANIFEST.split(", ")])

        for batch in batches:
            for file_no, key, kind, member in zip(*(batch.column(c).to_pylist() for c in ("file_no", "key", "kind", "member"))):
                if kind == 0:
                    decision = key, member
                    continue
                if file_no != now:
                    if sink:
                        yield close()
                    system.create_dir(f"{folder}/_temporary", recursive=True)
                    now, temp, n, size, digest = file_no, f"{folder}/_temporary/{uuid.uuid4().hex}", 0, 0, hashlib.sha256()
                    sink = system.open_output_stream(temp)
                if decision[0] != key:
                    raise ValueError("a record has no decision")
                body = decision[1] or member
                sink.write(body)
                digest.update(body)
                n, size = n + 1, size + len(body)
        if sink:
            yield close()

    return write


def write(pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES, roll: int = ROLL_BYTES) -> DataFrame:
    """Write one record per page below `root` (a shared folder) and return the manifest.

    Records are in order of page_id, nulls last, then payload digest; a file ends where the compressed
    sizes so far pass a multiple of `roll`. Both follow from the rows alone, so any layout of the input
    and any rerun gives the same bytes under the same names. Of the records with equal payloads of at
    least `least` bytes, those with the smallest page_id are responses (rows that repeat it are each
    one), the others revisit it; payloads whose pages all lack an id are all responses. A null html is an
    empty payload, a null url becomes `urn:page:<id>`. Files are written under temporary names and moved
    when whole, a retried task replaces a file by itself, and readers go by the manifest, which is
    written last. No pages give an empty manifest.
    """
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"))
    heads = materialise(rows.mapInArrow(_heads, _HEAD), "heads")  # the records are made anew for the files: time for disk
    firsts = materialise(heads.where(F.col("payload_bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("of"), "first_id"), "firsts")
    met = heads.join(firsts, heads["digest"] == firsts["of"], "left")
    first_id = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    decided = met.select(*heads.columns, first_id.alias("first_id")).mapInArrow(_revisits, "key binary, size long, revisit binary")
    placed = sums_before(decided, [F.col("key")], "size").withColumn("file_no", F.floor(F.col("before") / roll))
    placed = materialise(placed.select("key", "revisit", "file_no"), "placed")
    starts = [bytes(r["key"]) for r in placed.groupBy("file_no").agg(F.min("key").alias("key")).orderBy("file_no").collect()]  # a row per file

    @F.arrow_udf("long")
    def file_of(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(np.array(starts, "S30"), np.array(keys.to_pylist(), "S30"), side="right").astype(np.int64) - 1)

    bodies = rows.mapInArrow(_bodies, "key binary, member binary").select(F.lit(1), "key", "member")
    both = placed.select(F.lit(0).alias("kind"), "key", F.col("revisit").alias("member")).union(bodies)
    dealt = both.withColumn("file_no", file_of("key")).repartition("file_no").sortWithinPartitions("file_no", "key", "kind")
    dealt.mapInArrow(_writer(root), _MANIFEST).write.mode("overwrite").parquet(f"{root}/_manifest")
    return pages.sparkSession.read.schema(_MANIFEST).parquet(f"{root}/_manifest")


def _members(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every gzip member."""
    at, rest, offset = 0, b"", 0
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest and not (rest := stream.read(1 << 20)):
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(unpack.decompress(rest))
            at += len(rest) - len(unpack.unused_data)
            rest = unpack.unused_data
        yield offset, b"".join(parts)
        offset = at


def parse(content: bytes) -> dict:
    """Fields of a record; raises if a digest or length does not hold."""
    head, _, body = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block, end = body[: int(fields["Content-Length"])], body[int(fields["Content-Length"]) :]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, stated = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    good = lines[0] == "WARC/1.1" and end == b"\r\n\r\n" and fields["WARC-Block-Digest"] == f"sha1:{b32(hashlib.sha1(block).digest())}"
    good &= payload == b"" if kind == "revisit" else len(payload) == length and b32(hashlib.sha1(payload).digest()) == stated
    if not good:
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is damaged")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("X-Page-Id"), "url": fields["WARC-Target-URI"], "record_id": fields["WARC-Record-ID"], "record_type": kind,
        "payload_bytes": length, "payload_digest": stated, "refers_to": number("X-Refers-To-Page-Id"), "payload": payload,
    }


def read(spark: SparkSession, root: str, payload: bool = False) -> DataFrame:
    """One row per record of the files in the manifest, in streams; digests are checked on the way."""
    schema = _RECORD + ", payload binary" * payload
    names = [x.split()[0] for x in schema.split(", ")]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(root)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                out, size = [], 0
                with system.open_input_stream(f"{folder}/{file}", compression=None) as stream:
                    for offset, content in _members(stream):
                        r = parse(content) | {"file": file, "offset": offset}
                        out.append([r[k] for k in names])
                        size += len(content)
                        if size > 4 << 20:
                            yield batch_of(out)
                            out, size = [], 0
                if out:
                    yield batch_of(out)

    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[x.split()[1]] for x in schema.split(", ")]

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    files = spark.read.schema(_MANIFEST).parquet(f"{root}/_manifest").select("file")
    return files.repartition(max(1, min(files.count(), MOST_TASKS))).mapInArrow(records, schema)  # a count, so that small rows are not put together


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), root)
    return read(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p
), f AS (SELECT hex, min(page_id) AS first_id FROM d GROUP BY hex
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, (i // 4)::INT * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM d JOIN f USING (hex)
"""
