"""Token ids in directly addressable files.

An id is split into chunks of fixed widths, the lowest first. Level l of a file holds the l-th chunks of all
ids that reach it, a bitmap that tells for each whether the id goes on, and a rank directory: the number of
set bits before each block of 512. So the id at any place is read by one rank a level, without decoding
what stands before it.

A file: the magic ``DAC1``; a header of unsigned 64-bit words (number of levels, ids, documents); the widths;
of each document its id (signed 64-bit), whether it has one (byte), and its number of ids (unsigned 32-bit); then
for each level its length, chunks (bytes or 16-bit words), bitmap and rank directory. All little-endian.

Files are written by tasks over ranges of doc_id, each under a name of its own and then renamed, so a task
that runs twice leaves the same file. They lie in a folder that all executors share.

Defined cases: a null text counts as empty and has just the end id; a null doc_id sorts first and comes back as
null; rows with equal doc_id come in the order of a hash of their texts; an empty table gives no file and no rows.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.llm.common import library_encoder, once, slices
from tessarea.session import Scratch

MAGIC, BLOCK = b"DAC1", 512
MANIFEST = "part int, seq int, path string, docs long, tokens long, bytes long"


@dataclass
class Level:
    chunks: np.ndarray
    bitmap: np.ndarray
    ranks: np.ndarray

    def rank(self, i: int) -> int:
        """Set bits before place i."""
        block = i // BLOCK
        rest = np.unpackbits(self.bitmap[block * BLOCK // 8 : (i + 7) // 8], bitorder="little")
        return int(self.ranks[block]) + int(rest[: i - block * BLOCK].sum())

    def bits(self, a: int, b: int) -> np.ndarray:
        found = np.unpackbits(self.bitmap[a // 8 : (b + 7) // 8], bitorder="little")
        return found[a % 8 : a % 8 + b - a].astype(bool)


class TokenFile:
    """One file in memory: ``encode`` makes the bytes, ``TokenFile(data)`` reads them."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        at = 4

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        levels, self.n, docs = (int(x) for x in take("<u8", 3))
        self.widths = [int(x) for x in take("u1", levels)]
        self.doc_ids, self.has_id, self.lengths = take("<i8", docs), take("u1", docs).astype(bool), take("<u4", docs)
        self.levels = []
        for width in self.widths:
            n = int(take("<u8", 1)[0])
            self.levels.append(Level(take("u1" if width <= 8 else "<u2", n), take("u1", (n + 7) // 8), take("<u4", n // BLOCK + 1)))

    def __getitem__(self, i: int) -> int:
        """The id at place i alone."""
        value = shift = 0
        for level, width in zip(self.levels, self.widths, strict=True):
            value |= int(level.chunks[i]) << shift
            if not (level.bitmap[i // 8] >> (i % 8)) & 1:
                break
            i, shift = level.rank(i), shift + width
        return value

    def read(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b."""
        out = np.zeros(b - a, np.uint32)
        at, shift = np.arange(b - a), 0
        for level, width in zip(self.levels, self.widths, strict=True):
            if a >= b:
                break
            out[at] |= level.chunks[a:b].astype(np.uint32) << np.uint32(shift)
            more = level.bits(a, b)
            at, a, shift = at[more], level.rank(a), shift + width
            b = a + len(at)
        return out

    @staticmethod
    def encode(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, widths: tuple[int, ...] = (8, 8, 16)) -> bytes:
        if any(not 1 <= w <= 16 for w in widths) or sum(widths) < 32:
            raise ValueError("widths are 1 to 16 bits and cover 32")
        out, levels, rest, shift = io.BytesIO(), [], ids.astype(np.uint32), 0
        while len(rest) or not levels:
            width = widths[len(levels)]
            high = rest >> np.uint32(width)
            more = high > 0
            chunks = (rest & np.uint32((1 << width) - 1)).astype("u1" if width <= 8 else "<u2")
            counts = np.add.reduceat(np.append(more, False).astype(np.int64), np.arange(0, len(more) + 1, BLOCK))
            ranks = np.concatenate([[0], np.cumsum(counts)])[: len(more) // BLOCK + 1].astype("<u4")
            levels.append((width, chunks, np.packbits(more, bitorder="little"), ranks))
            rest, shift = high[more], shift + width
        out.write(MAGIC + np.array([len(levels), len(ids), len(doc_ids)], "<u8").tobytes() + bytes(w for w, *_ in levels))
        out.write(np.array([x or 0 for x in doc_ids], "<i8").tobytes() + bytes(x is not None for x in doc_ids) + np.array(lengths, "<u4").tobytes())
        for _, chunks, bitmap, ranks in levels:
            out.write(np.array([len(chunks)], "<u8").tobytes() + chunks.tobytes() + bitmap.tobytes() + ranks.tobytes())
        return out.getvalue()


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, file_tokens: int = 4_000_000, widths: tuple[int, ...] = (8, 8, 16)) -> DataFrame:
    """Encodes every document and writes the files in ascending doc_id order; returns the manifest, a row per file."""
    spark = docs.sparkSession
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = once(("library", tokenizer), lambda: library_encoder(tokenizer))
        part, seq = TaskContext.get().partitionId(), 0
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        parts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            data = TokenFile.encode(doc_ids, lengths, np.frombuffer(b"".join(parts), "<u4"), widths)
            name = f"{base}/tokens-{part:06d}-{seq:05d}.dac"
            draft = f"{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as f:
                f.write(data)
            store.move(draft, name)
            row = [part, seq, f"{folder}/tokens-{part:06d}-{seq:05d}.dac", len(doc_ids), held, len(data)]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)

        for rows in slices(batches):
            for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
                ids = encode(text or "") + end
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                held += len(ids) // 4
                if held >= file_tokens:
                    yield flush()
                    doc_ids, lengths, parts, held, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash of the text and the row's place part the rows without doc_id, or with the same, among tasks.
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("at"))
    ordered = rows.repartitionByRange(n, "doc_id", "h", "at").sortWithinPartitions("doc_id", "h", "at")
    return ordered.select("doc_id", "text").mapInArrow(run, MANIFEST)


def read_token_files(manifest: DataFrame, batch_tokens: int = 1_000_000) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids (packed)."""
    spark = manifest.sparkSession
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(("doc_id", "start", "n_tokens", "ids"), types, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            for path, first in zip(rows["path"], rows["first"], strict=True):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name) as f:
                    file = TokenFile(f.read())
                ends = np.cumsum(file.lengths.astype(np.int64))
                at = 0
                while at < len(ends):
                    begin = int(ends[at - 1]) if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, begin + batch_tokens, "right")))
                    ids = file.read(begin, int(ends[to - 1])).astype("<u4").tobytes()
                    starts = ends[at:to] - file.lengths[at:to]
                    yield pa.record_batch(
                        [
                            pa.array([int(d) if h else None for d, h in zip(file.doc_ids[at:to], file.has_id[at:to], strict=True)], types[0]),
                            pa.array(starts + first, types[1]),
                            pa.array(file.lengths[at:to].astype(np.int64), types[2]),
                            pa.array([ids[4 * (s - begin) : 4 * (s - begin + n)] for s, n in zip(starts.tolist(), file.lengths[at:to].tolist(), strict=True)], types[3]),
                        ],
                        schema=schema,
                    )
                    at = to

    # The manifest has a row per file of millions of ids; its running sum is small whatever the input.
    before = F.sum("tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("first", F.coalesce(before, F.lit(0).cast("long"))).select("path", "first")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_file_round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None, **how) -> DataFrame:
    """Writes the files of all documents, by default under the shared folder, and reads them back."""
    scratch = Scratch(docs.sparkSession, "token-files")
    manifest = scratch.keep(write_token_files(docs, tokenizer, folder or scratch.folder("ids"), **how), "manifest")
    return read_token_files(manifest)


class OpenTokenFile:
    """One file in its store, for access to single ids: the header is read once; an id costs a chunk, and a block of bits and its rank, a level."""

    def __init__(self, path: str):
        store, name = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(name)
        if self.file.read_at(4, 0) != MAGIC:
            raise ValueError("not a token file")
        levels, self.n, docs = self._words("<u8", 3, 4)
        self.widths = self._words("u1", levels, 28)
        at = 28 + levels + 13 * docs
        self.levels: list[tuple[str, int, int, int]] = []  # kind and places of chunks, bitmap and ranks
        for width in self.widths:
            n, kind = self._words("<u8", 1, at)[0], "u1" if width <= 8 else "<u2"
            bits = at + 8 + n * np.dtype(kind).itemsize
            self.levels.append((kind, at + 8, bits, bits + (n + 7) // 8))
            at = bits + (n + 7) // 8 + 4 * (n // BLOCK + 1)

    def _words(self, kind: str, n: int, at: int) -> list[int]:
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(n * size, at), kind).tolist()

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for (kind, chunks, bits, ranks), width in zip(self.levels, self.widths, strict=True):
            value |= self._words(kind, 1, chunks + i * np.dtype(kind).itemsize)[0] << shift
            block = i // BLOCK
            here = np.unpackbits(np.frombuffer(self.file.read_at(i // 8 + 1 - block * BLOCK // 8, bits + block * BLOCK // 8), np.uint8), bitorder="little")
            if not here[i - block * BLOCK]:
                break
            i, shift = self._words("<u4", 1, ranks + 4 * block)[0] + int(here[: i - block * BLOCK].sum()), shift + width
        return value

    def __enter__(self) -> OpenTokenFile:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()
