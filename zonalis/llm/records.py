"""Token ids as length-delimited binary records, with a separate offset index.

One record is, in this order (integers little-endian):

    8 bytes  length n of the payload
    4 bytes  masked CRC-32 of those 8 bytes
    n bytes  payload: document id (8 bytes, signed), bytes per token id (4), then the token ids
    4 bytes  masked CRC-32 of the payload
    1 byte   0x0A

The mask rotates a checksum right by 15 bits and adds 0xA282EAD8, so that a checksum of data that holds checksums stays
meaningful. Ids take two bytes where the vocabulary allows. Records lie in ascending document order within a shard and
over the shards. Shards are written through Spark's own writer, so they go to any file system Spark knows, under its
commit protocol; a lost task is written again and leaves nothing behind. The index (shard, offset, length, document id,
tokens) is read off the finished shards, which also checks every length and checksum.

Null texts are encoded as empty texts: their record holds the end id alone. Repeated document ids stay separate records,
ordered by text. Rows without an id come first, are stored under ``NO_ID`` and read back as null.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonalis.llm.textblock import flat, ragged, slices
from zonalis.session import shared_dir

END_ID = 2
NO_ID = -(1 << 63)
CACHE_CHUNKS = 600_000
JOINED_BYTES = 1 << 13  # of chunks encoded as one text, about
JOINED = 32  # such texts per call
SHARD_BYTES = 24 << 20  # text bytes per shard, about

_workers: dict[str, ChunkEncoder] = {}


def masked(checksum: int) -> int:
    return (((checksum >> 15) | (checksum << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(zlib.crc32(head))) + payload + struct.pack("<I", masked(zlib.crc32(payload))) + b"\n"


def unframe(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of every record; raises on a wrong length or checksum."""
    at = 0
    while at < len(data):
        if len(data) - at < 17:
            raise ValueError(f"record at {at} is cut off")
        (n,), (head,) = struct.unpack_from("<Q", data, at), struct.unpack_from("<I", data, at + 8)
        if masked(zlib.crc32(data[at : at + 8])) != head or at + 17 + n > len(data):
            raise ValueError(f"record at {at} has a wrong length")
        payload = data[at + 12 : at + 12 + n]
        if masked(zlib.crc32(payload)) != struct.unpack_from("<I", data, at + 12 + n)[0] or data[at + 16 + n] != 0x0A:
            raise ValueError(f"record at {at} has a wrong checksum")
        yield at, payload
        at += 17 + n


class ChunkEncoder:
    """Encodes texts chunk by chunk and keeps the ids of chunks it has seen, looked up by their bytes.

    Byte-level BPE splits a text before it merges. A space that follows a visible ASCII or letter byte always begins a new
    piece, so a text may be cut there and the ids of the parts are the ids of the whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        spelled = self.tokenizer.get_vocab()  # a letter of a byte-level token stands for a byte
        self.sizes = np.zeros(max(spelled.values(), default=0) + 1, np.int64)
        self.sizes[list(spelled.values())] = list(map(len, spelled))
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @staticmethod
    def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Chunk starts: text starts, and spaces whose predecessor cannot be white space of any alphabet."""
        ok = data == 0x20
        before = np.zeros(len(data), bool)
        if len(data) > 1:
            before[1:] = data[:-1] > 0x20
        # C2 85, C2 A0, E1 9A 80, E2 80 xx, E2 81 9F, E3 80 80 are white space too: never cut after such bytes.
        before[2:] &= ~((data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)))
        if len(data) > 3:
            wide = (data[:-3] >= 0xE1) & (data[:-3] <= 0xE3)
            middle = (data[1:-2] == 0x80) | (data[1:-2] == 0x81) | (data[1:-2] == 0x9A)
            before[3:] &= ~(wide & middle)
        before &= ok
        before[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(before)

    def coded(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after the other, and the number of each.

        Chunks that may stand behind each other are encoded as one text, which costs far less than a call for each, and its
        ids are dealt by the bytes that their tokens spell. Where tokens do not end with the chunks, each is encoded alone.
        """
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        raw = b"".join(chunks)
        free = np.zeros(len(raw) + 1, bool)
        free[self.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))] = True
        new = np.flatnonzero(~free[ends[:-1]] | (ends[1:] // JOINED_BYTES != ends[:-1] // JOINED_BYTES)) + 1
        bounds = [0, *ends[new - 1].tolist(), len(raw)]
        texts = [raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        parts = [np.array(e.ids, np.uint32) for at in range(0, len(texts), JOINED) for e in self.tokenizer.encode_batch_fast(texts[at : at + JOINED], add_special_tokens=False)]
        ids = np.concatenate(parts)
        reached = np.cumsum(self.sizes[ids])
        last = np.searchsorted(reached, ends)
        if len(ids) and reached[-1] == len(raw) and np.array_equal(reached[last], ends):
            return ids, np.diff(last, prepend=-1)
        alone = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]
        lengths = np.fromiter(map(len, alone), np.int64, len(alone))
        return np.fromiter(chain.from_iterable(alone), np.uint32, int(lengths.sum())), lengths

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        data, offsets = flat(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        starts = self.cuts(data, offsets)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = _bytes_of(chunks.dictionary)
        if len(self.known) + len(distinct) > CACHE_CHUNKS:
            self.clear()
        spots = [self.known.get(c, -1) for c in distinct]
        at = np.array(spots, np.int64)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            fresh = [distinct[i] for i in missing.tolist()]
            coded, lengths = self.coded(fresh)
            at[missing] = np.arange(len(self.known), len(self.known) + len(fresh))
            self.known.update(zip(fresh, at[missing].tolist(), strict=True))
            self.start = np.append(self.start, len(self.ids) + np.cumsum(lengths) - lengths)
            self.length = np.append(self.length, lengths)
            self.ids = np.append(self.ids, coded)
        place = at[np.asarray(chunks.indices)]
        begin, count = self.start[place], self.length[place]
        ids = self.ids[ragged(begin, count)]
        ends_of_chunks = np.concatenate([[0], np.cumsum(count)])
        bounds = ends_of_chunks[np.searchsorted(starts, offsets)]
        return ids, np.diff(bounds)


def _bytes_of(column: pa.Array) -> list[bytes]:
    """Values of a column without nulls."""
    data, offsets = flat(column)
    raw, at = data.tobytes(), offsets.tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def encoder(tokenizer_file: str) -> ChunkEncoder:
    """One encoder per Python worker and file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if tokenizer_file not in _workers:
        _workers[tokenizer_file] = ChunkEncoder(tokenizer_file)
    return _workers[tokenizer_file]


def write_records(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES,
) -> None:
    """Write ``docs`` in ascending id order as record shards under ``path``."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_file)
        kind = np.uint16 if coder.width == 2 else np.uint32
        for piece in slices(batches, limit=2 << 20):
            ids, counts = coder.encode(piece.column(1))
            ids, at, frames = ids.astype(kind), 0, []
            tail = np.array([end_id], kind).tobytes()
            for name, n in zip(piece.column(0).to_pylist(), counts.tolist(), strict=True):
                frames.append(frame(struct.pack("<qI", name, coder.width) + ids[at : at + n].tobytes() + tail)[:-1])
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
        coder.clear()  # workers are reused, by other steps too

    parts = max(1, -(-int(total or 0) // shard_bytes))
    ordered = rows.repartitionByRange(parts, "id", F.crc32(F.col("text").cast("binary"))).sortWithinPartitions("id", "text")
    ordered.mapInArrow(task, "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(path)  # the writer ends a row with 0x0A


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(shard, offset, length, doc_id, n_tokens, ids_crc32, place): one row per record, read from the finished shards.

    ``ids_crc32`` is of the ids as 32-bit little-endian integers; ``place`` counts ids before the record in its shard.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                out, place = [], 0
                for at, payload in unframe(memoryview(batch.column(1)[row].as_buffer())):
                    name, width = struct.unpack_from("<qI", payload)
                    ids = np.frombuffer(payload[12:], np.uint16 if width == 2 else np.uint32).astype("<u4")
                    out.append((at, 17 + len(payload), name, len(ids), zlib.crc32(ids.tobytes()), place))
                    place += len(ids)
                columns = np.array(out, np.int64).reshape(-1, 6)
                shard = pa.array([batch.column(0)[row].as_py()] * len(out), pa.string())
                yield pa.RecordBatch.from_arrays([shard, *(pa.array(columns[:, c]) for c in range(6))], names=["shard", "offset", "length", "doc_id", "n_tokens", "ids_crc32", "place"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(task, "shard string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, place long")


def tokenize_to_records(docs: DataFrame, tokenizer_file: str, path: str | None = None, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write shards and index under ``path`` (default: a new place in the shared folder) and return the index.

    Adds ``start``, the number of ids of all records before. Only one row per shard is numbered in one task.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    write_records(docs, f"{path}/shards", tokenizer_file, end_id, doc_id, text, shard_bytes)
    read_index(spark, f"{path}/shards").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    sums = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.length("shard"), "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("shard", before.alias("before"))
    out = index.join(F.broadcast(starts), "shard").withColumn("start", F.col("before") + F.col("place"))
    named = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias(doc_id)
    return out.select(named, "start", "n_tokens", "ids_crc32", "shard", "offset", "length")
