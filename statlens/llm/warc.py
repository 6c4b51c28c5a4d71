"""WARC archives and the chunked record table.

Payloads are never taken as one block by a digest, a compressor or a reader:
they pass in chunks of ``CHUNK`` bytes.  Reading archives back gives a table with
a row per record and chunk (record id, chunk number, bytes) that carries the
SHA-1 of the payload up to that chunk, so a reader can check any prefix, and the
last chunk of a record has the digest of the whole.

Archives are gzip files, one member a record, in a shared folder.  A task writes
its own files under names that no other attempt uses; the manifest lists those
of the attempts that succeeded, and a reader opens only these.

The reader takes archives of other makers too: records of any type, with or
without an HTTP header (and with any fields in it), gzip of one or many members
or none, and lines that end with a bare line feed.  The payload is what follows
the HTTP header, else the whole block.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches, new_folder, staged

CHUNK, ARCHIVE_BYTES, LEVEL, DATE = 1 << 16, 32 << 20, 3, "2000-01-01T00:00:00Z"
#: Archives are read in as many tasks as there are, up to this many.
MOST_TASKS = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_TABLE = ("page_id long, record_id string, record_type string, url string, refers_to long, chunk int, last boolean, "
               "data binary, running_sha1 string, payload_bytes long, payload_digest string")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def pieces(payload: bytes, chunk: int = CHUNK) -> Iterator[memoryview]:
    view = memoryview(payload)
    for i in range(0, len(view), chunk):
        yield view[i:i + chunk]


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def payload_digests(pages: DataFrame) -> DataFrame:
    """``page_id, mark, payload_bytes, payload_digest, check`` of every row: SHA-1 in base32, and a SHA-256 beside it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for html in b["html"]:
                payload, one, two = utf8(html), hashlib.sha1(), hashlib.sha256()
                for part in pieces(payload):
                    one.update(part)
                    two.update(part)
                out.append((len(payload), base32(one.digest()), two.digest()))
            got = pd.DataFrame(out, columns=["payload_bytes", "payload_digest", "check"], index=b.index)
            yield pd.concat([b[["page_id", "mark"]].astype("Int64"), got], axis=1)

    return pages.select("page_id", "mark", "html").mapInPandas(
        run, "page_id long, mark long, payload_bytes long, payload_digest string, check binary")


def plan_records(spark: SparkSession, pages: DataFrame, least: int) -> DataFrame:
    """What each page's record is: ``page_id, mark, payload_bytes, payload_digest, refers_to`` (null: response)."""
    found = staged(spark, payload_digests(pages), "digests")
    groups = found.where(f"payload_bytes >= {least}").groupBy("check", "payload_bytes").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = staged(spark, groups.selectExpr("check AS c_", "payload_bytes AS b_", "first"), "payloads")
    joined = found.join(groups, F.expr("check = c_ AND payload_bytes = b_"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "mark", "payload_bytes", "payload_digest", refers.alias("refers_to")).distinct()


def head(page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None, date: str) -> tuple[bytes, bytes]:
    """(WARC header, HTTP header) of a page's record."""
    http = utf8(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n")
    clean = " ".join((url or "").split())
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
              f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {clean}",
              f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields.append(f"Content-Length: {len(http) + (size if refers_to is None else 0)}")
    return utf8("\r\n".join(fields) + "\r\n\r\n"), http


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, least: int = 0, date: str = DATE) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``) to archives in ``folder``; returns the manifest.

    Of records with equal payloads of at least ``least`` bytes, that with the
    smallest page_id is a response and the others revisit it; smaller ones are all
    responses.  Null html: an empty payload.  A null url is empty; line breaks in
    a url become blanks.  Rows that repeat a page_id and payload are written as
    often as they come, with the same type.  A page without an id revisits the
    first with one, else is a response.  An empty table gives an empty manifest.
    Manifest: ``path, records, bytes``.
    """
    bounded_batches(spark)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
                         F.xxhash64(html).alias("mark"))
    plan = staged(spark, plan_records(spark, pages, least).withColumnsRenamed({"page_id": "p_", "mark": "m_"}), "records")
    rows = pages.join(plan, F.col("page_id").eqNullSafe(F.col("p_")) & (F.col("mark") == F.col("m_")))
    html = F.when(F.col("refers_to").isNull(), F.col("html"))
    rows = rows.select(F.col("page_id").cast("string"), "url", html.alias("html"), "payload_bytes", "payload_digest", F.col("refers_to").cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out = path = None
        records = size = 0

        def closed():
            out.close()
            return pd.DataFrame({"path": [path], "records": [records], "bytes": [size]})

        for b in batches:
            for r in b.itertuples(index=False):
                if out is None:
                    path, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{path.rpartition('/')[2]}", compression=None)
                warc, http = head(None if r.page_id is None else int(r.page_id), r.url, int(r.payload_bytes), r.payload_digest,
                                  None if r.refers_to is None else int(r.refers_to), date)
                gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                for part in (warc, http, *(pieces(utf8(r.html)) if r.refers_to is None else ()), b"\r\n\r\n"):
                    if done := gz.compress(part):
                        size += out.write(done)
                size += out.write(gz.flush())
                records += 1
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return staged(spark, rows.mapInPandas(run, "path string, records long, bytes long"), "manifest")


class Stream:
    """Bytes of an archive, decompressed as they are asked for."""

    def __init__(self, raw, chunk: int):
        self.raw, self.chunk, self.gz, self.rest, self.held, self.taken = raw, chunk, None, b"", bytearray(), 0
        self.rest = raw.read(max(2, chunk))
        self.plain = self.rest[:2] != b"\x1f\x8b"

    def fill(self) -> bool:
        """Take up to a chunk more; False at the archive's end."""
        while True:
            if not self.rest:
                self.rest = self.raw.read(self.chunk)
                if not self.rest:
                    if self.gz is not None:
                        raise EOFError("the archive ends within a record")
                    return False
            if self.plain:
                got, self.rest = self.rest, b""
            else:
                self.gz = self.gz or zlib.decompressobj(31)
                got = self.gz.decompress(self.rest, self.chunk)
                if self.gz.eof:
                    self.rest, self.gz = self.gz.unused_data, None
                else:
                    self.rest = self.gz.unconsumed_tail
            if got:
                self.held += got
                return True

    def peek(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer at the archive's end; they stay."""
        while len(self.held) < n and self.fill():
            pass
        return bytes(self.held[:n])

    def line(self, limit: int | None = None) -> bytes | None:
        """The next line without its end; None at the archive's end or where ``limit`` bytes have no line."""
        at = 0
        while (i := self.held.find(b"\n", at)) < 0 and (limit is None or len(self.held) < limit):
            at = len(self.held)
            if not self.fill():
                if self.held:
                    raise EOFError("the archive ends within a line")
                return None
        if i < 0 or (limit is not None and i >= limit):
            return None
        out = bytes(self.held[:i])
        self.drop(i + 1)
        return out.removesuffix(b"\r")

    def drop(self, n: int) -> None:
        del self.held[:n]
        self.taken += n

    def take(self, n: int) -> bytes:
        """Between 1 and ``n`` bytes."""
        if not self.held and not self.fill():
            raise EOFError("the archive ends within a record")
        out = bytes(self.held[:n])
        self.drop(len(out))
        return out

    def fields(self, end: int | None = None) -> dict[str, str]:
        """Header fields up to the empty line (or to where ``taken`` is ``end``): names in small letters, folded lines joined."""
        out: dict[str, str] = {}
        name = ""
        while line := self.line(None if end is None else end - self.taken):
            text = line.decode("utf-8", "surrogateescape")
            if text[0] in " \t" and name:
                out[name] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
        return out


def number(urn: str | None) -> int | None:
    """The page_id of a record id that ``head`` made."""
    inner = (urn or "").strip("<>")
    digits = inner.removeprefix("urn:page:")
    return int(digits) if digits != inner and digits.isdigit() else None


def record_chunks(raw, chunk: int = CHUNK) -> Iterator[tuple]:
    """The rows of the chunked record table for one open archive.

    ``payload_digest`` is what the record states (SHA-1 in base32), else that of
    the payload; a response of which it states another raises ``ValueError``, unless its
    payload came in a transfer encoding, which it need not count.  ``payload_bytes`` of a revisit
    is what its HTTP header says; null without one.
    """
    s = Stream(raw, chunk)
    while True:
        while (first := s.line()) == b"":
            pass  # empty lines between records
        if first is None:
            return
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        f = s.fields()
        end = s.taken + int(f["content-length"])
        kind, http = f.get("warc-type", ""), {}
        if int(f["content-length"]) >= 5 and s.peek(5) == b"HTTP/" and s.line(end - s.taken) is not None:
            http = s.fields(end)
        left = end - s.taken
        said = f.get("warc-payload-digest", "")
        said = said[5:].upper() if said[:5].lower() == "sha1:" else None
        size = left
        if kind == "revisit":
            size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
        check = kind == "response" and "transfer-encoding" not in http
        ids = (number(f.get("warc-record-id")), f.get("warc-record-id"), kind, f.get("warc-target-uri"), number(f.get("warc-refers-to")))
        digest, no = hashlib.sha1(), 0
        while True:
            data = bytearray()
            while left and len(data) < chunk:
                got = s.take(min(left, chunk - len(data)))
                left -= len(got)
                data += got
            digest.update(data)
            own = base32(digest.digest())
            if not left and check and said not in (None, own):
                raise ValueError(f"payload digest of {ids[1]} is not {said}")
            stated = said or (own if not left and kind != "revisit" else None)
            yield (*ids, no, not left, bytes(data), digest.hexdigest(), size, stated)
            no += 1
            if not left:
                break


def read_archives(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table of the archives of ``manifest`` (``path``); every record has at least one (maybe empty) chunk.

    Columns: page_id and refers_to (null in archives of other makers), record_id,
    record_type, url, chunk, last, data, running_sha1, payload_bytes,
    payload_digest (of a record without a stated one: on its last chunk).  Archives
    are read side by side, each in one task; no archive gives an empty result.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        names = [c.split()[0] for c in CHUNK_TABLE.split(", ")]
        for b in batches:
            for path in b["path"]:
                fs, place = FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_stream(place, compression=None) as raw:
                    for row in record_chunks(raw, chunk):
                        rows.append(row)
                        held += len(row[7])
                        if held >= 64 * chunk or len(rows) >= 4096:
                            yield frame(rows, names)
                            rows, held = [], 0
                if rows:
                    yield frame(rows, names)

    def frame(rows, names):
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    tasks = max(1, min(manifest.count(), MOST_TASKS))
    return manifest.select("path").repartition(tasks).mapInPandas(run, CHUNK_TABLE)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``path, bytes`` of the archives (``*.warc``, ``*.warc.gz``) in ``folder`` and below it, for ``read_archives``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.where(r"path RLIKE '\.warc(\.gz)?$'").select("path", F.col("length").alias("bytes"))


def archive_and_read(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back as the chunked record table."""
    return read_archives(write_archives(spark, pages, new_folder(spark, "warc"), least))
