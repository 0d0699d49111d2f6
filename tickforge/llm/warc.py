"""WARC archives: writing them, and reading them back in byte ranges.

Every record is a gzip member of its own.  Spark's text writer joins the
members (the closing zero byte of each is its line separator), its text
reader cuts byte ranges at the gzip magic, and a task owns the members that
start inside its range.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import CHUNK_BYTES, prepare, saved

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def member(page_id, url, payload: bytes, refers_to, revisit: bool, date: str, level: int) -> bytes:
    """One record as gzip bytes that end with a zero byte."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}",
                 f"X-Refers-To-Page-Id: {refers_to}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress(raw) + packer.flush()
    if out[-1]:  # a record of 16 MiB or more: an empty member closes it
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += packer.flush()
    return out


def parse(raw: bytes) -> dict:
    """Fields of a decompressed record; a payload that differs from its digest raises."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b": ")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: ")]
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = field["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload differs from its digest: {field['WARC-Record-ID']}")
    page, refers = field.get("X-Page-Id"), field.get("X-Refers-To-Page-Id")
    return {"page_id": None if page is None else int(page), "url": field.get("WARC-Target-URI"),
            "record_type": kind, "payload_digest": digest,
            "payload_bytes": int(sizes[0]) if kind == "revisit" else len(payload),
            "refers_to": None if refers is None else int(refers),
            "payload": None if kind == "revisit" else payload}


class Open:
    """A candidate member: fed with pieces until its gzip stream ends."""

    def __init__(self):
        self.unpack, self.out, self.pieces = zlib.decompressobj(31), [], []

    def feed(self, piece: bytes) -> bool | None:
        """True: ended; False: goes on; None: no record starts here."""
        first = not self.pieces
        self.pieces.append(piece)
        try:
            self.out.append(self.unpack.decompress(MAGIC + piece))
        except zlib.error:
            return None
        if first and (not piece or piece[0] & 0xE0 or self.out[0] and not b"WARC/1.".startswith(self.out[0][:7])):
            return None
        return self.unpack.eof


RECORD = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
          "refers_to long, payload binary")
FIELDS = [x.split(" ")[0] for x in RECORD.split(", ")]
SCANNED = RECORD + ", file string, block long, seq long, fragment binary"


def scan(rows, keep_payload: bool):
    """Records that start in a task's ranges.  What is left over at the edges
    of a range (the magic also occurs inside compressed data) comes out as
    numbered fragments."""
    at, now, started, seq = None, None, False, 0

    def fragments(pieces):
        nonlocal seq
        for piece in pieces:
            yield {"file": at[0], "block": at[1], "seq": seq, "fragment": piece}
            seq += 1

    for file, block, piece in rows:
        if (file, block) != at:
            if now:
                yield from fragments(now.pieces)
            at, now, started, seq = (file, block), None, False, 0
            if block == 0 and not piece:
                continue  # nothing stands before the first magic of a file
        fresh = now is None
        now = now or Open()
        ended = now.feed(piece)
        if ended is None:
            if started or not fresh:
                raise ValueError(f"damaged member in {file}, range {block}")
            yield from fragments([piece])
            now = None
        elif ended:
            raw = b"".join(now.out)
            now, started = None, True
            if raw:
                found = parse(raw)
                yield found if keep_payload else found | {"payload": None}
    if now:
        yield from fragments(now.pieces)


def stitch(pieces: list[bytes], keep_payload: bool):
    """Records whose pieces lie in several ranges of a file, in file order."""
    now = None
    for piece in pieces:
        now = now or Open()
        ended = now.feed(piece)
        if ended is None:
            raise ValueError("damaged member at the edge of a range")
        if ended:
            raw, now = b"".join(now.out), None
            if raw:
                found = parse(raw)
                yield found if keep_payload else found | {"payload": None}
    if now:
        raise ValueError("the last member of a file is cut off")


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0,
               date: str = "2024-01-01T00:00:00Z", level: int = 3) -> None:
    """Write (page_id, url, html) as WARC records, one gzip member each, into
    the files of a new folder.

    A null html is an empty payload.  Of the records with equal payloads of
    at least ``min_revisit_bytes`` bytes those with the smallest page_id are
    responses and the others refer to it; smaller ones, and ones that have no
    page_id but null among them, are responses.  Other columns play no part."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # repeated payloads only, counted before the shuffle: one row a digest
    first = (rows.where(F.octet_length("html") >= min_revisit_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    rows = (rows.join(first, "digest", "left")
            .withColumn("revisit", F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "url", "refers_to", "revisit", "html"))

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import warc as op
        from tickforge.llm.common import chunks
        for batch in chunks(batches, "html", CHUNK_BYTES):
            # the writer's line separator is the last byte of each member
            out = [op.member(p, u, h.encode(), r, v, date, level)[:-1] for p, u, r, v, h in
                   zip(*(batch.column(i).to_pylist() for i in range(5)))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    (rows.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", "\0").option("compression", "none").text(path))


def read_warc(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """Records of the archives under ``path``: page_id, url, record_type,
    payload_digest, payload_bytes, refers_to, payload.

    Splits follow ``spark.sql.files.maxPartitionBytes``; an empty folder gives
    no rows; damaged archives raise."""
    prepare(spark)
    pieces = (spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1")
              .schema("value string").text(path)
              .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.col("value").cast("binary").alias("piece")))

    def run(batches):
        import pyarrow as pa

        from tickforge.llm import warc as op
        names = [x.split(" ")[0] for x in op.SCANNED.split(", ")]
        kinds = dict(long=pa.int64(), string=pa.string(), binary=pa.binary())
        schema = pa.schema([(x.split(" ")[0], kinds[x.split(" ")[1]]) for x in op.SCANNED.split(", ")])
        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3))))
        held, size = [], 0
        for record in op.scan(rows, keep_payload):
            held.append({n: record.get(n) for n in names})
            size += len(record.get("payload") or b"") + len(record.get("fragment") or b"") + 100
            if size > CHUNK_BYTES:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    scanned = saved(pieces.mapInArrow(run, SCANNED), "warc-scanned")

    def join(table):
        import pyarrow as pa

        from tickforge.llm import warc as op
        table = table.sort_by([("block", "ascending"), ("seq", "ascending")])
        found = list(op.stitch(table.column("fragment").to_pylist(), keep_payload))
        return pa.Table.from_pylist(found, table.select(op.FIELDS).schema)

    # a member crosses a range with the magic in its data about once in 2^24 bytes of edges
    edges = scanned.where("fragment IS NOT NULL").groupBy("file").applyInArrow(join, RECORD)
    return scanned.where("fragment IS NULL").select(*FIELDS).unionByName(edges)


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` as archives, read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to of every record."""
    write_warc(pages, path)
    return read_warc(pages.sparkSession, path, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
