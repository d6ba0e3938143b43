"""WARC archives: a writer with revisit records, a normaliser of monolithic gzip files, and an indexed reader.

An archive is first written as one gzip stream.  The normaliser inflates that
stream once, from start to end and in bounded memory, and rewrites every record
as a gzip member of its own; a sidecar index keeps each member's offset and
length, so that any record can be read alone.  Files are named by the task
attempt and become visible only through the manifest that Spark commits, so a
retried or duplicated task changes nothing.

Defined results: null html is an empty payload; a null url leaves the target out;
a null page_id is older than any other; rows that share the largest page_id of a
payload are all responses; payloads of any length are whole; other columns are
left out, whatever their names; an empty table gives an empty table.  The payload
of a revisit isn't stored again: its length and digest stand in the record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import in_pieces
from .storage import delete, filesystem, get_file, put_file, ship, staged, workdir

MIN_REVISIT_BYTES = 1000
SHARD_BYTES = 32 << 20
#: Tasks that a digest's copies are dealt over.
SALTS = 16
END = b"\r\n\r\n"


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of equal payloads of min_bytes or more, all but the largest page_id refer to that one.

    Shorter payloads take no part in the join.  The keepers are found on digests alone, pre-aggregated
    before the shuffle; those of digests that occur twice are shown to SALTS tasks each, over which the
    payloads of one digest are dealt.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    base = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    is_long = F.octet_length("payload") >= min_bytes
    keepers = base.where(is_long).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1").select("digest", "keeper")
    keepers = keepers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = base.where(is_long).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper"))
    refers = F.when(F.col("keeper").isNotNull() & older, F.col("keeper"))
    marked = dealt.join(keepers, ["digest", "salt"], "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))
    return marked.unionByName(base.where(~is_long).withColumn("refers_to", F.lit(None).cast(marked.schema["refers_to"].dataType)))


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    kind = "revisit" if refers_to is not None else "response"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def write_archives(records: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the records as monolithic gzip files of about shard_bytes of records each; a row per file."""

    def write(batches):
        pack, parts, size, count = None, [], 0, 0

        def close():
            parts.append(pack.flush())
            uri = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            put_file(uri, parts)
            return pa.RecordBatch.from_pydict({"uri": [uri], "records": pa.array([count], pa.int64())})

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(x)) for x in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns):
                if pack is None:
                    pack, parts, size, count = zlib.compressobj(1, wbits=31), [], 0, 0
                data = _record(*(x.as_py() for x in row))
                parts.append(pack.compress(data))
                size, count = size + len(data), count + 1
                if size >= shard_bytes:
                    yield close()
                    pack = None
        if pack is not None:
            yield close()

    return records.mapInArrow(in_pieces(write), "uri string, records long")


#: Inflated bytes of a piece.
PIECE = 4 << 20


def inflate(uri: str, step: int = 1 << 20):
    """The bytes of a gzip file of one or many members, in pieces of PIECE at most; a file that ends inside a member is an error."""
    fs, path = filesystem(uri)
    with fs.open_input_stream(path, compression=None) as f:
        pack, rest, whole = zlib.decompressobj(31), b"", True
        while data := rest or f.read(step):
            if piece := pack.decompress(data, PIECE):
                yield piece
            rest, whole = pack.unconsumed_tail or pack.unused_data, pack.eof
            if whole:
                pack = zlib.decompressobj(31)
            elif not rest:
                while piece := pack.decompress(b"", PIECE):
                    yield piece
        if not whole:
            raise ValueError(f"{uri} is cut short")


def split_records(pieces):
    """(header bytes, block) of each record in a stream of pieces; holds one record and one piece at most."""
    buf = bytearray()
    pieces = iter(pieces)

    def fill(n: int) -> bool:
        while len(buf) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            buf.extend(piece)
        return True

    while True:
        while (at := buf.find(END)) < 0:
            if not fill(len(buf) + 1):
                if buf.strip():
                    raise ValueError("the archive ends inside a record header")
                return
        head = bytes(buf[:at])
        size = re.search(rb"(?im)^content-length: *(\d+)", head)
        if not head.startswith(b"WARC/") or not size:
            raise ValueError(f"not a WARC record: {head[:80]!r}")
        begin, end = at + 4, at + 4 + int(size[1])
        if not fill(end + 4):
            raise ValueError("the archive ends inside a record")
        yield head, bytes(buf[begin:end])
        del buf[: end + 4]


def fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def normalise_archives(manifest: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Rewrites each listed archive with a member per record beside a sidecar index (a JSON line for each record); a row per archive."""

    def rewrite(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                name, at, index = f"{folder}/{uuid.uuid4().hex}", 0, []

                def members():
                    nonlocal at
                    for head, block in split_records(inflate(uri)):
                        pack = zlib.compressobj(level, wbits=31)
                        data = pack.compress(head + END + block + END) + pack.flush()
                        told = fields(head)
                        index.append(json.dumps({"id": told["warc-record-id"], "type": told["warc-type"], "offset": at, "length": len(data)}))
                        at += len(data)
                        yield data

                put_file(f"{name}.warc.gz", members())
                put_file(f"{name}.idx", ["\n".join(index).encode()])
                yield pa.RecordBatch.from_pydict({"uri": [f"{name}.warc.gz"], "index_uri": [f"{name}.idx"], "records": pa.array([len(index)], pa.int64())})

    return manifest.select("uri").mapInArrow(rewrite, "uri string, index_uri string, records long")


def _number(urn: str):
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "null" else int(text)


READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, offset long, length long, payload binary"


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row per indexed record, each member inflated by itself from its offset; a payload that doesn't have its stated length and SHA-1 is an error."""

    def read(batches):
        for batch in batches:
            for uri, index_uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = filesystem(uri)
                rows, size = [], 0
                with fs.open_input_file(path) as f:
                    for line in get_file(index_uri).splitlines():
                        entry = json.loads(line)
                        f.seek(entry["offset"])
                        (head, block), = split_records([zlib.decompress(f.read(entry["length"]), 31)])
                        told = fields(head)
                        http, _, payload = block.partition(END)
                        n = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
                        digest = base64.b32decode(told["warc-payload-digest"].removeprefix("sha1:")).hex()
                        revisit = told["warc-type"] == "revisit"
                        if not revisit and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"damaged record {told['warc-record-id']} in {uri}")
                        refers = _number(told["warc-refers-to"]) if revisit else None
                        rows.append((_number(told["warc-record-id"]), told.get("warc-target-uri"), told["warc-type"], refers, n, digest, entry["offset"], entry["length"], None if revisit else payload))
                        size += len(payload)
                        if size >= 8 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return manifest.select("uri", "index_uri").mapInArrow(read, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)


def archive(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages to archives to normalised archives and back: the records as read, with their payloads (null for revisits)."""
    spark = ship(pages).sparkSession
    folder = workdir(spark, "warc")
    raw = staged(write_archives(mark_revisits(pages, min_bytes), f"{folder}/raw"), "warc-raw")
    own = staged(normalise_archives(spread(raw), f"{folder}/members"), "warc-members")
    delete(spark, f"{folder}/raw")
    return read_archives(spread(own))


def spread(manifest: DataFrame) -> DataFrame:
    """A task for every few files of a manifest."""
    return manifest.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4), "uri")
