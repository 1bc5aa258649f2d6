"""WARC archives: writing, reading back, and reassembly of segmented records.

Writing.  One record per row.  The payload is the text in UTF-8 inside an HTTP response in
chunked transfer framing.  Of equal payloads of at least ``min_bytes``, the row with the
smallest id is a ``response``, the others are ``revisit`` records that refer to it and
carry no payload.  A record whose block exceeds ``segment_bytes`` is split: the first
segment and ``continuation`` records, numbered, the last with the total length.
Each record is a gzip member of its own, as archives usually are.  Files are written by Spark's
text writer (its committer drops the files of lost tasks) on any store; its line separator is an
empty gzip member, which readers pass over.

Reading.  Files are read whole (their size is bounded when they are written) and cut by
Content-Length only, never by searching payloads.  Continuation records are grouped by
their origin's identifier, ordered by segment number, checked for gaps and against
the total length, and the chunked framing is decoded.  Unsegmented records need no shuffle.

Defined cases: a null text is an empty payload; a null id is written as ``null`` and
read back as null, and never chosen as a response's id unless all ids of that
payload are null; rows repeated with the same id and payload are all responses or revisits
alike; empty tables give empty archives; other columns are ignored.  A broken record (gap,
wrong total, bad chunk) comes back with ``error`` set and no payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import map_batches, small_batches

CRLF = b"\r\n"
END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"  # the tables hold no crawl time; a fixed one keeps files reproducible
ID = "urn:x-page:"
SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
PACK_BYTES = 1 << 20   # compressed records are handed to the writer in packs of this size
PACKS_PER_FILE = 64    # so a file has 64 MB at most, and one record more
GZIP_LEVEL = 4
NOTHING = gzip.compress(b"", mtime=0)  # an empty member: the writer's line separator
READ_BYTES = 4 << 20   # payload bytes in one batch when reading
SALTS = 16


def digest32(payload: bytes) -> str:
    """SHA-1 of the payload in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked transfer framing."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out += [b"%x" % len(part), CRLF, part, CRLF]
    return b"".join([*out, b"0", CRLF, CRLF])


def unchunked(body: bytes) -> bytes:
    """Decode chunked framing; extensions and trailers are skipped.  ValueError if it is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ValueError("chunk size line without end")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != CRLF:
            raise ValueError("chunk without end")
        out.append(body[at:at + size])
        at += size + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its end (two CRLF)."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION + CRLF + head.encode("utf-8") + CRLF + block


def records_of(page, uri: str | None, payload: bytes, digest: str, owner, revisit: bool,
               segment_bytes: int) -> list[bytes]:
    """The record of a page, in as many segments as it needs."""
    name = f"<{ID}{page if page is not None else 'null'}:{digest}>"
    clean = (uri or "").replace("\r", "%0D").replace("\n", "%0A")
    base = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE),
            ("WARC-Target-URI", clean), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response")]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        base += [("WARC-Refers-To", f"<{ID}{owner if owner is not None else 'null'}:{digest}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        return [record(base, status + b"Content-Length: %d" % len(payload) + END)]
    block = status + b"Transfer-Encoding: chunked" + END + chunked(payload)
    if len(block) <= segment_bytes:
        return [record(base, block)]
    parts = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    out = [record([*base, ("WARC-Segment-Number", "1")], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{ID}{page}:{digest}:{number}>"),
                  ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number))]
        if number == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record(fields, part))
    return out


def _owned(pages: DataFrame, id_col: str, text_col: str, uri_col: str | None, min_bytes: int) -> DataFrame:
    """``(page, uri, payload, digest, owner, revisit)``.

    Payload groups are counted from digests alone; only groups of two and more are looked
    up again, salted by row.  The digest is SHA-1 with the length, as the archive itself states.
    """
    uri = F.col(uri_col) if uri_col else F.lit(None).cast("string")
    src = pages.select(F.col(id_col).cast("long").alias("page"), uri.cast("string").alias("uri"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = (src.where(F.col("size") >= min_bytes).groupBy("sha", "size")
              .agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("owner")).where("n > 1")
              .select("sha", "size", "owner", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = src.withColumn("salt", F.pmod(F.xxhash64("page", "uri"), F.lit(SALTS)).cast("int"))
    joined = salted.join(groups.withColumn("grouped", F.lit(True)), ["sha", "size", "salt"], "left")
    return joined.select("page", "uri", "payload", "owner",
                         (F.col("grouped").isNotNull() & ~F.col("page").eqNullSafe(F.col("owner"))).alias("revisit"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", text_col: str = "html",
               uri_col: str | None = "url", min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write the rows as WARC files under ``path``."""
    def run(batches):
        pack, size = [], 0
        for batch in small_batches(batches):
            for page, uri, payload, owner, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                some = records_of(page, uri, payload, digest32(payload), owner, revisit, segment_bytes)
                members = [gzip.compress(r + END, GZIP_LEVEL, mtime=0) for r in some]
                pack += members
                size += sum(map(len, members))
                if size >= PACK_BYTES:
                    yield pa.RecordBatch.from_pydict({"value": [b"".join(pack)]}, schema=schema)
                    pack, size = [], 0
        if pack:
            yield pa.RecordBatch.from_pydict({"value": [b"".join(pack)]}, schema=schema)

    schema = pa.schema([("value", pa.binary())])
    packs = _owned(pages, id_col, text_col, uri_col, min_bytes).mapInArrow(run, "value binary")
    (packs.select(F.col("value").cast("string"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", NOTHING.decode("latin-1"))
     .option("maxRecordsPerFile", PACKS_PER_FILE).text(path))


def parse_records(data: bytes):
    """``(header fields in lower case, block)`` of each record, cut by Content-Length.

    Gzip members are opened as they are read, so one record is held beside the file's bytes.
    """
    stream = io.BytesIO(data)
    if data.startswith(b"\x1f\x8b"):
        stream = gzip.GzipFile(fileobj=stream)
    while line := stream.readline():
        if line != VERSION + CRLF:
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) != CRLF:
            if not line:
                raise ValueError("a record's head has no end")
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(len(END)) != END:
            raise ValueError(f"record {fields.get('warc-record-id')} has a wrong length")
        yield fields, block


def http_payload(block: bytes) -> tuple[bytes, int]:
    """Body of an HTTP response and the length that its head states (-1 if none)."""
    head, _, body = block.partition(END)
    lines = [x.partition(b":") for x in head.lower().split(CRLF)[1:]]
    fields = {k.strip(): v.strip() for k, _, v in lines}
    stated = int(fields.get(b"content-length", b"-1"))
    return (unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body), stated


_OUT = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                  ("refers_to", pa.string()), ("stated_digest", pa.string()), ("stated_bytes", pa.int64()),
                  ("payload", pa.binary()), ("error", pa.string())])
_OUT_DDL = ("record_id string, record_type string, target_uri string, refers_to string, stated_digest string, "
            "stated_bytes long, payload binary, error string")
_PART = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("head", pa.string()),
                   ("block", pa.binary())])


def _decoded(fields: dict, block: bytes | None, error: str | None = None) -> dict:
    payload, stated = None, -1
    if error is None:
        try:
            payload, stated = http_payload(block)
        except ValueError as e:
            error = str(e)
    revisit = fields.get("warc-type") == "revisit"
    return {"record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
            "stated_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
            "stated_bytes": stated if revisit else None, "payload": None if revisit else payload, "error": error}


def _segmented(fields: dict) -> bool:
    return "warc-segment-number" in fields


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per logical record of the archives under ``path`` (see ``_OUT_DDL``)."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def flush(schema, rows):
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def whole(batches):
        for batch in small_batches(batches, 1):
            rows, size = [], 0
            for fields, block in parse_records(batch.column(0)[0].as_py()):
                if not _segmented(fields):
                    rows.append(_decoded(fields, block))
                    size += len(block)
                if size > READ_BYTES:
                    yield flush(_OUT, rows)
                    rows, size = [], 0
            yield flush(_OUT, rows)

    def pieces(batches):
        for batch in small_batches(batches, 1):
            for fields, block in parse_records(batch.column(0)[0].as_py()):
                if _segmented(fields):
                    first = fields["warc-type"] != "continuation"
                    yield flush(_PART, [{
                        "origin": fields["warc-record-id" if first else "warc-segment-origin-id"],
                        "number": int(fields["warc-segment-number"]),
                        "total": int(fields.get("warc-segment-total-length", 0)) or None,
                        "head": "\n".join(f"{k}\t{v}" for k, v in fields.items()) if first else None,
                        "block": block}])

    parts = files.mapInArrow(pieces, "origin string, number int, total long, head string, block binary")
    # A group is one record; repeated rows repeat the same segments, counted by their first one.
    segments = parts.groupBy("origin", "number").agg(
        F.count(F.lit(1)).alias("copies"), F.max("total").alias("total"), F.max("head").alias("head"),
        F.first("block").alias("block"))
    grouped = segments.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "copies", "total", "head", "block"))).alias("parts"))

    def joined(batch: pa.RecordBatch) -> dict:
        rows = []
        for origin, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fields = dict(x.split("\t", 1) for x in (some[0]["head"] or "").split("\n") if x)
            block, error = b"".join(p["block"] for p in some), None
            if [p["number"] for p in some] != list(range(1, len(some) + 1)) or not fields:
                error = "missing segment"
            elif some[-1]["total"] != len(block):
                error = f"total length {some[-1]['total']} stated, {len(block)} found"
            fields.setdefault("warc-record-id", origin)
            rows += [_decoded(fields, block, error)] * some[0]["copies"]
        return {n: [r[n] for r in rows] for n in _OUT.names}

    return (files.mapInArrow(whole, _OUT_DDL)
            .unionByName(map_batches(grouped, joined, _OUT_DDL, _OUT, rows=64)))
