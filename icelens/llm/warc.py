"""Web archives as chunks.

Payloads travel as rows (page, chunk number, bytes), never as one value: the writer streams the chunks of a record to
its file one after the other, the reader streams them back and carries the digest along, so neither holds more than a
chunk. Equal payloads of at least LEAST bytes are stored once, in the record of the page with the largest id; the others
are revisit records that refer to it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icelens.llm.common import new_folder, opened
from icelens.session import settle

LEAST, CHUNK, SALTS = 1000, 1 << 20, 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_ROWS = "page_id long, url string, digest string, size long, refers_to long, chunk_no int, last boolean, data binary"
READ_ROWS = "page_id long, record_type string, refers_to long, chunk_no int, data binary, so_far long, digest string, last boolean"


def chunks(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", chunk: int = CHUNK) -> DataFrame:
    """CHUNK_ROWS of all pages, the rows of a page together and in order.

    refers_to: for a payload of at least LEAST bytes the largest page_id with an equal one, unless that is the page's
    own; such a page has one row without data. A null html is an empty payload. Repeated rows with the largest id are
    responses all of them, and a null id refers to the largest, if any. Payloads are equal if size and SHA-1 are.
    """
    payload = F.encode(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("data"))
    rows = rows.select("page_id", "url", "data", F.sha1("data").alias("digest"), F.length("data").cast("long").alias("size"))
    first = (rows.where(F.col("size") >= LEAST).groupBy("digest", "size").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
             .where("n > 1 AND first IS NOT NULL"))
    # a payload may make up a third of all pages: its one row is repeated under every salt
    first = first.select(F.col("digest").alias("_digest"), F.col("size").alias("_size"), "first",
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(first, (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size")) & (F.col("salt") == F.col("_salt")), "left")
    other = F.when(F.col("first") != F.coalesce("page_id", F.col("first") - 1), F.col("first"))
    known = joined.select("page_id", "url", "digest", "size", other.alias("refers_to"), "data")
    n = F.when(F.col("refers_to").isNotNull(), 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / chunk))).cast("int")
    cut = known.select("*", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no"))
    part = F.when(F.col("refers_to").isNull(), F.substring("data", F.col("chunk_no") * chunk + 1, F.lit(chunk))).otherwise(F.lit(b""))
    return cut.select("page_id", "url", "digest", "size", "refers_to", "chunk_no", (F.col("chunk_no") == F.col("n") - 1).alias("last"), part.alias("data"))


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page}')}>"


def head(page: int | None, url: str | None, digest: str, size: int, refers_to: int | None) -> bytes:
    """Everything of a record before its payload."""
    target = "".join(c for c in url or "" if c > " ") or "about:blank"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    length = len(http) + (size if refers_to is None else 0)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {length}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page: {refers_to}"]
    if page is not None:
        lines.append(f"Page: {page}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Write CHUNK_ROWS as WARC files below ``folder``, each record a gzip member of its own; returns (path, n_records), one
    row per file."""
    def save(batches):
        path, out, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for row in batch.to_pylist():
                out = out or opened(path, "w")
                if row["chunk_no"] == 0:
                    member = zlib.compressobj(6, wbits=31)
                    out.write(member.compress(head(row["page_id"], row["url"], row["digest"], row["size"], row["refers_to"])))
                out.write(member.compress(row["data"]))
                if row["last"]:
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

    return settle(rows.mapInArrow(save, "path string, n_records long"), "warc")


class Members:
    """The bytes of a file of gzip members, one after the other."""

    def __init__(self, stream):
        self.stream, self.member, self.packed = stream, zlib.decompressobj(wbits=31), b""

    def read(self, n: int) -> bytes:
        """1 to ``n`` bytes; none at the end."""
        while True:
            if self.member.eof:
                self.packed, self.member = self.member.unused_data, zlib.decompressobj(wbits=31)
            self.packed = self.packed or self.stream.read(1 << 16)
            if not self.packed:
                return b""
            out = self.member.decompress(self.packed, n)
            self.packed = self.member.unconsumed_tail
            if out:
                return out


class Reader:
    """Lines and bytes of a stream, read a chunk at a time."""

    def __init__(self, stream):
        self.stream, self.held = stream, b""

    def line(self) -> bytes | None:
        while b"\r\n" not in self.held:
            more = self.stream.read(1 << 16)
            if not more:
                return None
            self.held += more
        line, self.held = self.held.split(b"\r\n", 1)
        return line

    def take(self, n: int) -> bytes:
        """Up to ``n`` bytes."""
        if not self.held:
            return self.stream.read(n)
        out, self.held = self.held[:n], self.held[n:]
        return out

    def fields(self) -> dict[str, str]:
        out = {}
        while line := self.line():
            name, _, value = line.decode().partition(": ")
            out[name.lower()] = value
        return out


def records(stream, chunk: int = CHUNK):
    """CHUNK rows of one archive: dicts with page_id, record_type, refers_to, chunk_no, data, so_far (bytes of the payload
    up to here), digest (SHA-1 of them) and last. A revisit has one row without data, but size and digest of the payload.
    A payload that does not have its record's digest raises ValueError."""
    reader = Reader(stream)
    while (line := reader.line()) is not None:
        if not line:
            continue
        fields = reader.fields()
        page = int(fields["page"]) if "page" in fields else None
        stated = fields["warc-payload-digest"].removeprefix("sha1:")
        reader.line()  # the status line
        http = reader.fields()
        row = {"page_id": page, "record_type": fields["warc-type"], "refers_to": None}
        size = int(http["content-length"])
        if row["record_type"] == "revisit":
            yield row | {"refers_to": int(fields["refers-to-page"]), "chunk_no": 0, "data": b"", "so_far": size, "digest": stated, "last": True}
            continue
        digest, so_far, number = hashlib.sha1(), 0, 0
        while True:
            data = b""
            while len(data) < min(chunk, size - so_far):  # the stream may give less than asked for
                more = reader.take(min(chunk, size - so_far) - len(data))
                if not more:
                    raise ValueError(f"page {page}: the archive ends within its payload")
                data += more
            digest.update(data)
            so_far += len(data)
            last = so_far == size
            if last and digest.hexdigest() != stated:
                raise ValueError(f"page {page}: payload and digest differ")
            yield row | {"chunk_no": number, "data": data, "so_far": so_far, "digest": digest.hexdigest(), "last": last}
            number += 1
            if last:
                break


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The chunk rows of all archives, in parallel by file; ``data`` is empty unless ``payloads``."""
    def load(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened(path, "r") as stream:
                    rows, size = [], 0
                    for row in records(Members(stream)):
                        size += len(row["data"]) + 200 if payloads else 200
                        rows.append(row if payloads else row | {"data": b""})
                        if size > 1 << 22:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    return manifest.repartition(max(1, manifest.count()), "path").select("path").mapInArrow(load, READ_ROWS)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("chunk_no", pa.int32()),
             ("data", pa.binary()), ("so_far", pa.int64()), ("digest", pa.string()), ("last", pa.bool_())]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to), one row per row."""
    manifest = write(chunks(pages), new_folder(pages.sparkSession, "warc"))
    return read(manifest, payloads=False).where("last").select(
        "page_id", F.col("so_far").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
