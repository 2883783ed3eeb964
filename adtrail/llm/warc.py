"""WARC archives: written as one gzip stream per file, then normalised to a gzip member per record, with an index.

``write_archives`` turns rows into records and each task writes its rows as one monolithic ``.warc.gz``: a single gzip
member over the whole file, which cannot be entered in the middle. ``normalise`` inflates each such file once, as a
stream, and rewrites every record as a member of its own; beside each file goes an index of (record id, offset,
length). ``read_records`` enters the files at the indexed offsets.

Payloads that are equal share their SHA-1; the one with the smallest id is stored as a ``response``, the others as
``revisit`` records that refer to it and carry the digest and the HTTP header with the full length, without the body.

Files are written through ``pyarrow.fs`` into the shared folder (a path or a ``file:``, ``s3:``, ``gs:`` or ``hdfs:`` URI).
A task that is run twice writes files of its own: names are random, and only names that a committed Spark table lists
are ever read.

Defined cases: a null payload is empty; an empty payload counts like any other with ``least`` 0 and is always a response
above that; a null URL gives a record without target URI; control characters and spaces in URLs are percent-encoded; a
null id is written as ``null`` and never referred to unless all ids of its payload are null; rows with one id and one
payload are records each, and all of them are the response if that id is the smallest; an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.store import written

CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if urlparse(folder).scheme else (pafs.LocalFileSystem(), folder)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record with its closing blank lines."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-row:{id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_uri(url)}"] if url else []),
        *([f"WARC-Refers-To: <urn:x-row:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is under ``""``."""
    first, *lines = data.decode("utf-8").split("\r\n")
    fields = (line.partition(":") for line in lines if line)
    return {"": first, **{name.strip().lower(): value.strip() for name, _, value in fields}}


class Inflated:
    """The content of a gzip file (one member or several) as a stream with a buffer of about CHUNK bytes."""

    def __init__(self, stream):
        self.stream, self.engine, self.held, self.raw = stream, zlib.decompressobj(31), bytearray(), b""

    def _more(self) -> bool:
        while True:
            if self.engine.eof:  # another member may follow
                self.raw, self.engine = self.engine.unused_data, zlib.decompressobj(31)
            elif self.engine.unconsumed_tail:
                self.raw = self.engine.unconsumed_tail
            self.raw = self.raw or self.stream.read(CHUNK)
            if not self.raw:
                return False
            out = self.engine.decompress(self.raw, CHUNK)
            self.raw = b""
            if out:
                self.held += out
                return True

    def upto(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is passed; None at the end of the file."""
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                if bytes(self.held).strip():
                    raise ValueError("the archive ends inside a record")
                return None
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out


def records_of(stream) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record in a gzip stream."""
    inflated = Inflated(stream)
    while (head := inflated.upto(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        block = inflated.take(int(parse_head(head)["content-length"]))
        if inflated.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield head, block


def _member(data: bytes) -> bytes:
    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def with_revisits(rows: DataFrame, id: str, folder: str, least: int = 0) -> DataFrame:
    """(_id, _url, _payload, _digest, refers_to): ids as text, SHA-1 in hexadecimal, and the id of the response for revisits."""
    held = rows.withColumn("_digest", F.sha1("_payload"))
    first = held.where(F.length("_payload") >= least).groupBy("_digest").agg(F.min(id).alias("_first"), F.count("*").alias("_n"))
    # Written first, so that the join below meets two shuffles and can split a payload that many rows share. Only
    # digests found twice or more are in it, and they are the side that is hashed: payloads pass unsorted.
    first = written(first.where("_n > 1").select(F.col("_digest").alias("_d"), "_first"), folder).hint("shuffle_hash")
    joined = held.join(first, (F.col("_digest") == F.col("_d")) & (F.length("_payload") >= least), "left")
    later = F.col("_first").isNotNull() & ~F.col(id).eqNullSafe(F.col("_first"))
    return joined.withColumn("refers_to", F.when(later, F.col("_first").cast("string")))


def write_archives(rows: DataFrame, folder: str, id: str, url: str, payload: str, least: int = 0) -> DataFrame:
    """Write one monolithic archive per task into ``folder``; gives the table of file names, committed by Spark."""
    slim = rows.select(
        F.col(id).alias("_row"), F.col(url).cast("string").alias("_url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("_payload")
    )
    ready = with_revisits(slim, "_row", f"{folder}/first", least).select(F.coalesce(F.col("_row").cast("string"), F.lit("null")).alias("id"), "_url", "_payload", "refers_to")

    def write(batches):
        files, root = _store(folder)
        files.create_dir(root, recursive=True)
        name, out, engine, count = f"{root}/{uuid.uuid4().hex}.whole.warc.gz", None, zlib.compressobj(1, zlib.DEFLATED, 31), 0
        for batch in batches:
            for row in batch.to_pylist():
                out = out or files.open_output_stream(name, compression=None)
                data = record(row["id"], row["_url"], row["_payload"], base32_sha1(row["_payload"]), row["refers_to"])
                out.write(engine.compress(data))
                count += 1
        if out:
            out.write(engine.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([count], pa.int64())})

    return written(ready.mapInArrow(write, "file string, records bigint"), f"{folder}/files")


def normalise(whole: DataFrame, folder: str) -> DataFrame:
    """Rewrite each file of ``whole`` with a gzip member per record, and write its index beside it.

    Gives the index of all files: (file, id, offset, length), one row per record.
    """

    def rewrite(batches):
        files, root = _store(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                to = f"{root}/{uuid.uuid4().hex}.warc.gz"
                ids, offsets, lengths, at = [], [], [], 0
                with files.open_input_stream(name, compression=None) as stream, files.open_output_stream(to, compression=None) as out:
                    for head, block in records_of(stream):
                        data = _member(head + b"\r\n\r\n" + block + b"\r\n\r\n")
                        out.write(data)
                        ids.append(parse_head(head)["warc-record-id"].removeprefix("<urn:x-row:").removesuffix(">"))
                        offsets.append(at)
                        lengths.append(len(data))
                        at += len(data)
                with files.open_output_stream(to + ".idx", compression=None) as out:
                    out.write("".join(f"{o}\t{n}\t{i}\n" for i, o, n in zip(ids, offsets, lengths, strict=True)).encode())
                for start in range(0, len(ids), 10_000):
                    part = slice(start, start + 10_000)
                    yield pa.RecordBatch.from_pydict({
                        "file": pa.array([to] * len(ids[part]), pa.string()), "id": pa.array(ids[part], pa.string()),
                        "offset": pa.array(offsets[part], pa.int64()), "length": pa.array(lengths[part], pa.int64()),
                    })

    # About a file per task: a given number of partitions stays, however few rows list the files.
    spread = whole.select("file").repartition(max(1, whole.count()), "file")
    return written(spread.mapInArrow(rewrite, "file string, id string, offset bigint, length bigint"), f"{folder}/index")


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """(id, record_type, payload_bytes, payload_digest, refers_to, url[, payload]) of every indexed record.

    The payload's length and digest come from the stored payload of a response, which must agree with its header, and
    from the headers of a revisit.
    """
    fields = {"id": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.string(), "url": pa.string(), **({"payload": pa.binary()} if with_payload else {})}

    def row(data: bytes) -> dict:
        head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
        fields = parse_head(head)
        http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
        size, digest = int(parse_head(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "response" and (len(payload), base32_sha1(payload)) != (size, digest):
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
        plain = lambda name: fields[name].removeprefix("<urn:x-row:").removesuffix(">") if name in fields else None
        return {
            "id": plain("warc-record-id"), "record_type": fields["warc-type"], "payload_bytes": size, "payload_digest": digest,
            "refers_to": plain("warc-refers-to"), "url": fields.get("warc-target-uri"), "payload": payload,
        }

    def read(batches):
        files, _ = _store(folder)
        schema = pa.schema(list(fields.items()))
        name = source = None
        for batch in batches:
            out = []
            for entry in batch.to_pylist():
                if entry["file"] != name:
                    if source:
                        source.close()
                    name, source = entry["file"], files.open_input_file(entry["file"])
                source.seek(entry["offset"])
                out.append(row(source.read(entry["length"])))
                if len(out) == 500:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    return index.mapInArrow(read, ", ".join(f"{n} {kinds[t]}" for n, t in fields.items()))


def archive_round_trip(rows: DataFrame, folder: str, id: str, url: str, payload: str, least: int = 0) -> DataFrame:
    """Write, normalise and read back; ``id`` and ``refers_to`` have the type of the id column again."""
    index = normalise(write_archives(rows, folder, id, url, payload, least), folder)
    kind = rows.schema[id].dataType
    back = lambda c: F.when(F.col(c) != "null", F.col(c)).cast(kind)
    return read_records(index, folder).select(back("id").alias(id), "payload_bytes", "payload_digest", "record_type", back("refers_to").alias("refers_to"), F.col("url").alias("target_uri"))
