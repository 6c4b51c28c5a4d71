"""Token-id files: the documents' ids in id order, coded by ``id_coder``.

Texts are dealt by ranges of (doc_id, hash of the text, row number) and sorted
within them; a task tokenises its range in order and writes its ids to files of
about ``FILE_IDS`` ids under names that no other attempt uses.  The manifest has
a row per file of the attempts that succeeded.  The files' order is that of
their first keys, so where a file starts in the whole sequence is a running sum
over the manifest, a row per file.

A file: ``MAGIC``, the coded blocks one after the other, a table (zlib) and the
footer.  The table holds the documents (whether an id is given, doc_id, number
of ids) and where each block begins, so a reader can take single blocks.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlens.llm import id_coder
from statlens.llm.common import bounded_batches, new_folder, staged
from statlens.llm.word_tokens import TEXT_BLOCK, text_blocks, word_tokenizer

TOKENIZER, END_ID = "word_bpe_49k.json", 1
#: A file is closed after the block of texts with which it has this many ids; blocks that are coded side by side.
FILE_IDS, GROUP = 6_000_000, 4
#: Word parts of one generation that a worker keeps (about 110 bytes each).
KEPT = 600_000
MAGIC = b"IDRANGE1"
#: Bits of an id, blocks, documents, ids, where the table begins, its bytes, its CRC-32.
FOOTER, FOOTER_SIZE = "<IQQQQII", 44
MANIFEST = "path string, first_given boolean, first_id long, first_hash long, first_row long, docs long, n_ids long, bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Writer:
    """One file, written block by block."""

    def __init__(self, folder: str, bits: int, block: int):
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.ids"
        self.path, self.out = f"{folder}/{name}", fs.open_output_stream(f"{base}/{name}", compression=None)
        self.bits, self.block, self.at = bits, block, self.out.write(MAGIC)
        self.begins: list[int] = []
        self.docs: list[np.ndarray] = []
        self.held, self.n_held, self.n_ids = [], 0, 0

    def add(self, given: np.ndarray, doc_id: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Documents with ``size`` ids each, and their ids."""
        self.docs.append(np.stack([given.astype("<i8"), doc_id.astype("<i8"), size.astype("<i8")]))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= GROUP * self.block:
            self.code(self.n_held // (GROUP * self.block) * GROUP * self.block)

    def code(self, n: int) -> None:
        """Write the first ``n`` of the held ids."""
        ids = np.concatenate(self.held)
        for i in range(0, n, GROUP * self.block):
            part = ids[i:min(i + GROUP * self.block, n)]
            for data in id_coder.encode([part[k:k + self.block] for k in range(0, len(part), self.block)], self.bits):
                self.begins.append(self.at)
                self.at += self.out.write(data)
        self.held, self.n_held = [ids[n:].copy()], len(ids) - n

    def close(self) -> int:
        """End the file; its bytes."""
        self.code(self.n_held)
        docs = np.concatenate(self.docs, axis=1)
        table = zlib.compress(docs.tobytes() + np.array(self.begins, "<i8").tobytes(), 6)
        foot = struct.pack(FOOTER, self.bits, len(self.begins), docs.shape[1], self.n_ids, self.at, len(table), zlib.crc32(table))
        self.at += self.out.write(table) + self.out.write(foot) + self.out.write(MAGIC)
        self.out.close()
        return self.at


class Reader:
    """One open file (random access)."""

    def __init__(self, raw):
        end = raw.size()
        raw.seek(max(0, end - FOOTER_SIZE - len(MAGIC)))
        foot = raw.read()
        if len(foot) != FOOTER_SIZE + len(MAGIC) or foot[-len(MAGIC):] != MAGIC:
            raise ValueError("not a whole token-id file")
        self.bits, blocks, docs, self.n_ids, self.end, size, check = struct.unpack_from(FOOTER, foot)
        raw.seek(self.end)
        table = raw.read(size)
        if zlib.crc32(table) != check:
            raise ValueError("the checksum of the file's table is wrong")
        table = np.frombuffer(zlib.decompress(table), "<i8")
        self.raw, (self.given, self.doc_id, self.size) = raw, table[:3 * docs].reshape(3, docs)
        self.begins = [*table[3 * docs:3 * docs + blocks].tolist(), self.end]

    def blocks(self, first: int, last: int) -> list[np.ndarray]:
        """The ids of blocks ``first`` to ``last - 1``."""
        self.raw.seek(self.begins[first])
        data = self.raw.read(self.begins[last] - self.begins[first])
        cut = [b - self.begins[first] for b in self.begins[first:last + 1]]
        return id_coder.decode([data[a:b] for a, b in zip(cut, cut[1:])], self.bits)

    def documents(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(document, ids, whether they are its last): every document's ids, a long one's in parts."""
        ends = np.cumsum(self.size)
        at = doc = 0
        for first in range(0, len(self.begins) - 1, GROUP):
            ids = np.concatenate(self.blocks(first, min(first + GROUP, len(self.begins) - 1)))
            start, at = at, at + len(ids)
            while doc < len(ends) and ends[doc] <= at:
                yield doc, ids[max(0, ends[doc] - self.size[doc] - start):ends[doc] - start], True
                doc += 1
            if doc < len(ends) and ends[doc] - self.size[doc] < at:
                yield doc, ids[max(0, ends[doc] - self.size[doc] - start):], False
        if at != self.n_ids or doc != len(ends):
            raise ValueError("the file's blocks do not hold its documents' ids")


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      file_ids: int = FILE_IDS, block: int = id_coder.BLOCK, text_block: int = TEXT_BLOCK) -> DataFrame:
    """Write the ids of every row of ``docs`` to files in ``folder``; returns the manifest (see ``MANIFEST``).

    Documents come in ascending doc_id order, those without an id first, and rows
    that repeat an id by the hash of their texts; repeated rows are written as
    often as they come.  A null text counts as empty: its one id is ``end_id``.
    An empty table gives an empty manifest; other columns are not read.
    """
    bounded_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("m"), text.alias("t"))
    rows = rows.repartitionByRange("doc_id", "h", "m").sortWithinPartitions("doc_id", "h", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, KEPT)
        bits = max(id_coder.PLACE_BITS, 16, int(max(len(words.ends) - 1, end_id)).bit_length())
        out, first = None, ()

        def closed():
            size = out.close()
            row = [out.path, *first, sum(d.shape[1] for d in out.docs), out.n_ids, size]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        schema = pa.schema([("path", pa.string()), ("first_given", pa.bool_()), *((n, pa.int64()) for n in (
            "first_id", "first_hash", "first_row", "docs", "n_ids", "bytes"))])
        for b in text_blocks(batches, "t", text_block):
            given = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            doc_id = b.column("doc_id").fill_null(0).to_numpy()
            if out is None:
                out = Writer(folder, bits, block)
                first = bool(given[0]), int(doc_id[0]), b.column("h")[0].as_py(), b.column("m")[0].as_py()
            ids, ends = words.encode(b.column("t"))
            out.add(given, doc_id, np.diff(ends, prepend=0) + 1, np.insert(ids, ends, end_id))
            if out.n_ids >= file_ids:
                yield closed()
                out = None
        if out is not None:
            yield closed()

    return staged(spark, rows.mapInArrow(run, MANIFEST), "manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files; ``with_ids`` adds ``ids`` (little-endian uint32).

    ``start`` counts the ids of all documents before it in all files.  Raises
    ``ValueError`` where a checksum of a file, a block or its ids is wrong.
    """
    order = Window.orderBy("first_given", "first_id", "first_hash", "first_row")  # a row per file
    starts = staged(spark, manifest.select("path", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("start")), "starts")
    tasks = max(1, min(starts.count(), 100_000))
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                fs, place = FileSystem.from_uri(path)
                with fs.open_input_file(place) as raw:
                    file = Reader(raw)
                    crc = np.zeros(len(file.size), np.int64)
                    parts, kept = [], []
                    for doc, ids, last in file.documents():
                        data = ids.tobytes()
                        crc[doc] = zlib.crc32(data, int(crc[doc]))
                        if with_ids:
                            parts.append(data)
                            if last:
                                kept.append(b"".join(parts))
                                parts = []
                at = start + np.cumsum(file.size) - file.size
                columns = [pa.array(file.doc_id, pa.int64(), mask=file.given == 0), pa.array(at), pa.array(file.size), pa.array(crc)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names=names)

    return starts.repartition(tasks).mapInArrow(run, DOCUMENTS + ", ids binary" * with_ids)


def stored_documents(spark: SparkSession, docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write ``docs`` to files in the shared folder and read them back (see ``read_token_files``)."""
    return read_token_files(spark, write_token_files(spark, docs, new_folder(spark, "token-ids"), tokenizer))
