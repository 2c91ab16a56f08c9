"""WARC archives through a table of payload chunks.

A payload is cut by Spark into rows of (record, chunk number, bytes), and tasks see one chunk at a time: digests are
carried from chunk to chunk, the writer appends chunks to an open gzip member, the reader takes a record's block in
bounded reads. No Python task holds a whole record.

Records with equal payloads of at least ``least_bytes`` bytes become one response and revisits that refer to it.
Every record is a gzip member of its own; a writing task starts a new file after ``file_bytes``. The table of files
(path, records) is checkpointed, so a repeated task's other files are not read.

* Null payload: empty. Null url: an empty target. Empty table: no files, no rows.
* Repeated page ids: one record per row; of equal rows one is the response (if it is the largest id), the others
  revisits of it. Rows that share an id but not the payload are separate records.
* Null page ids: written and read back as null; in a group of equal payloads a null id counts as the smallest.
* Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import saved, table, tasks
from ledgerline.session import fresh_dir

CHUNK_BYTES = 1 << 18
FILE_BYTES = 1 << 28
LEAST_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def chunks(pages: DataFrame, key: str, payload: str, chunk_bytes: int, *more: Column) -> DataFrame:
    """(page_id, mark, chunk_no, last, data): the payload's UTF-8 in pieces, an empty payload as one empty piece.

    ``mark`` is a hash of the payload; with the id it names the record.
    """
    held = pages.select(F.col(key).alias("page_id"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("b"), *more)
    names = held.columns[2:]
    last = "greatest(cast(ceil(length(b) / {0}) as int), 1) - 1".format(chunk_bytes)
    cut = f"transform(sequence(0, {last}), i -> substring(b, i * {chunk_bytes} + 1, {chunk_bytes}))"
    return held.select(
        "page_id",
        F.xxhash64("b").alias("mark"),
        *names,
        F.expr(last).alias("last"),
        F.posexplode(F.expr(cut)).alias("chunk_no", "data"),
    )


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def payload_digests(rows: DataFrame) -> DataFrame:
    """(page_id, mark, payload_bytes, payload_digest) of each record, from chunks in the order they were cut."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sha, size = hashlib.sha1(), 0
        for frame in frames:
            out = []
            for page, mark, last, no, data in frame.itertuples(index=False, name=None):
                sha.update(data)
                size += len(data)
                if no == last:
                    out.append((page, mark, size, base32(sha.digest())))
                    sha, size = hashlib.sha1(), 0
            if out:
                yield pd.DataFrame(out, columns=["page_id", "mark", "payload_bytes", "payload_digest"]).astype({"page_id": "Int64"})

    return rows.select("page_id", "mark", "last", "chunk_no", "data").mapInPandas(
        run, "page_id long, mark long, payload_bytes long, payload_digest string"
    )


def decided(digests: DataFrame, least_bytes: int) -> DataFrame:
    """Distinct records with ``copies`` and, for payloads that repeat, the id of the response (``first``)."""
    records = digests.groupBy("page_id", "mark", "payload_bytes", "payload_digest").agg(F.count("*").alias("copies"))
    payloads = records.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_bytes", "payload_digest")
    payloads = payloads.agg(F.max("page_id").alias("first"), F.sum("copies").alias("_n")).where("_n > 1").drop("_n")
    return records.join(payloads, ["payload_bytes", "payload_digest"], "left").select(
        "page_id",
        "mark",
        "payload_bytes",
        "payload_digest",
        "copies",
        F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
        (F.col("first").isNotNull()).alias("repeats"),
    )


def record_name(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_of(name: str) -> int | None:
    inner = name.strip("<>").removeprefix("urn:page:")
    return int(inner) if inner else None


def head(url: str, page: int | None, size: int, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record's headers and those of the HTTP answer inside; a revisit's block ends with the latter."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_name(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else size)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {record_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + http


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path on it."""
    folder = re.sub(r"\As3[an]:", "s3:", re.sub(r"\Afile:/+", "/", folder))
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


class Archive:
    """Files of gzip members in a folder."""

    def __init__(self, folder: str, file_bytes: int):
        self.folder = folder
        self.file_bytes, self.stream, self.member, self.done = file_bytes, None, None, []

    def begin(self) -> None:
        if self.stream is not None and self.written > self.file_bytes:
            self.close()
        if self.stream is None:
            self.path, self.written, self.records = f"{self.folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
            system, path = opened(self.path)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.stream = system.open_output_stream(path, compression=None)
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)

    def put(self, data: bytes) -> None:
        self._raw(self.member.compress(data))

    def _raw(self, data: bytes) -> None:
        self.written += len(data)
        self.stream.write(data)

    def end(self) -> None:
        self.put(b"\r\n\r\n")
        self._raw(self.member.flush())
        self.member = None
        self.records += 1

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((self.path, self.records))
            self.stream = None


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    payload: str = "html",
    url: str = "url",
    least_bytes: int = LEAST_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes the records below ``folder`` (a path that every executor reaches) and returns (path, records).

    Payloads are read twice: once for digests, once to be written. The second time their chunks, compressed, meet
    their record's decision in one shuffle by record; a decision row sorts before its chunks.
    """
    spark = pages.sparkSession
    decisions = decided(payload_digests(chunks(pages, key, payload, chunk_bytes)), least_bytes)
    target = F.coalesce(F.col(url), F.lit("")).alias("url")

    def shrink(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=1)
        for frame in frames:
            yield frame.assign(data=[press.compress(d) for d in frame["data"]], page_id=frame["page_id"].astype("Int64"))

    data = chunks(pages, key, payload, chunk_bytes, target).select("page_id", "mark", "chunk_no", "url", "data")
    data = data.mapInPandas(shrink, "page_id long, mark long, chunk_no int, url string, data binary")
    empty = {"payload_bytes": "long", "payload_digest": "string", "copies": "long", "refers_to": "long", "repeats": "boolean"}
    data = data.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in empty.items()])
    rows = data.unionByName(decisions.withColumn("chunk_no", F.lit(-1)), allowMissingColumns=True)
    rows = rows.repartition(tasks(spark), "page_id", "mark").sortWithinPartitions("page_id", "mark", "chunk_no")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive, grow = Archive(folder, file_bytes), zstandard.ZstdDecompressor()
        record, writing, at, kept = None, False, -1, []

        def finish() -> None:
            nonlocal kept
            if writing:
                archive.end()
            for _ in range(int(record["copies"]) - 1 if kept else 0):
                archive.begin()
                for part in kept:
                    archive.put(part)
                archive.end()
            kept = []

        for frame in frames:
            frame = frame.astype({"page_id": object, "refers_to": object})
            frame = frame.where(frame.notna(), None)
            for r in frame.to_dict("records"):
                if r["chunk_no"] < 0:
                    finish()
                    record, writing, at = r, False, -1
                    continue
                if at < 0:
                    page, first = (None if record[n] is None else int(record[n]) for n in ("page_id", "refers_to"))
                    about = (r["url"], page, int(record["payload_bytes"]), record["payload_digest"])
                    writing = first is None
                    revisits = int(record["copies"]) - writing if record["repeats"] else 0
                    for _ in range(revisits):
                        archive.begin()
                        archive.put(head(*about, page if writing else first, True))
                        archive.end()
                    if writing:
                        archive.begin()
                        archive.put(shown := head(*about, None, False))
                        if not record["repeats"] and record["copies"] > 1:
                            kept.append(shown)
                if writing and r["chunk_no"] == at + 1:  # an equal row's chunk has the same number
                    archive.put(part := grow.decompress(r["data"]))
                    if kept:  # below least_bytes, so small
                        kept.append(part)
                at = max(at, r["chunk_no"])
        finish()
        archive.close()
        if archive.done:
            yield pd.DataFrame(archive.done, columns=["path", "records"])

    return saved(rows.mapInPandas(write, "path string, records long"))


class Members:
    """The bytes of a file's gzip members, in bounded reads."""

    def __init__(self, stream, at_once: int = 1 << 18):
        self.stream, self.at_once, self.rest, self.held = stream, at_once, b"", b""
        self.member = zlib.decompressobj(31)

    def _more(self) -> bool:
        while not self.held:
            if self.member.eof:
                self.rest, self.member = self.member.unused_data, zlib.decompressobj(31)
            data = self.rest or self.member.unconsumed_tail or self.stream.read(self.at_once)
            self.rest = b""
            if not data:
                return False
            self.held = self.member.decompress(data, self.at_once)
        return True

    def line(self) -> bytes:
        """Up to a line feed; empty at the end."""
        out = b""
        while self._more():
            cut = self.held.find(b"\n") + 1
            out, self.held = out + self.held[: cut or None], self.held[cut:] if cut else b""
            if cut:
                break
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size and self._more():
            part, self.held = self.held[:size], self.held[size:]
            size -= len(part)
            yield part
        if size:
            raise ValueError("the archive ends inside a record")


def headers(source: Members) -> tuple[dict[str, str], int]:
    """Headers up to an empty line (names in lower case) and their size."""
    found, size = {}, 0
    while line := source.line():
        size += len(line)
        if not line.strip():
            return found, size
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    raise ValueError("the archive ends inside a header")


def read_records(stream) -> Iterator[tuple]:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of each record; checks responses' digests."""
    source = Members(stream)
    while line := source.line():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        own, _ = headers(source)
        kind, digest = own["warc-type"], own["warc-payload-digest"].removeprefix("sha1:")
        http, used = headers(source)
        size, sha = 0, hashlib.sha1()
        for part in source.take(int(own["content-length"]) - used):
            sha.update(part)
            size += len(part)
        if kind == "response" and (base32(sha.digest()) != digest or size != int(http["content-length"])):
            raise ValueError(f"payload of {own['warc-record-id']} differs from its digest")
        to = page_of(own["warc-refers-to"]) if kind == "revisit" else None
        yield page_of(own["warc-record-id"]), own["warc-target-uri"], int(http["content-length"]), digest, kind, to


def read_archives(files: DataFrame) -> DataFrame:
    """The records of the files in ``path``, one row each; a file is one task's work."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, system in ((p, opened(p)) for p in frame["path"]):
                rows = []
                with system[0].open_input_stream(system[1], compression=None) as stream:
                    for row in read_records(stream):
                        rows.append(row)
                        if len(rows) == 10_000:
                            yield shown(rows)
                            rows = []
                yield shown(rows)

    def shown(rows: list[tuple]) -> pd.DataFrame:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    dealt = files.select("path").repartition(tasks(files.sparkSession), "path")
    return dealt.mapInPandas(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record and read back from the archives."""
    files = write_archives(table(spark, sf_dir, "pages"), fresh_dir(spark, "warc"))
    return read_archives(files).drop("url")


SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
hashed AS (
  SELECT page_id, strlen(p)::BIGINT AS payload_bytes, unhex(sha1(p))::BIT::VARCHAR AS bits,
         max(page_id) OVER (PARTITION BY p) AS first FROM payloads
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(1, 161, 5), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', substr(bits, i::INT, 5)::BIT::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""
