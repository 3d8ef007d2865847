"""Alignment of two tokenizers' tokens on the bytes they cover.

A text with a space before it is cut into tokens by a byte-level BPE (A) and by a piece model with byte fallback (B, which adds
that space itself). Both cover the same bytes, so every token has a byte range.

1. Both tokenizers work chunk by chunk. A chunk starts at a single space between visible characters; A starts a new piece there
   and no piece of B reaches over it, so the chunks' tokens are the text's tokens. A worker remembers the tokens of chunks it has
   met, looked up by their bytes. A text with a chunk whose tokens do not spell its bytes is encoded whole and compared again.
2. Per batch, ``pandas.merge_asof`` finds for each start of a token of A the last token of B that starts there or before, and the
   other way round, keyed by document. The union of both directions holds every pair of tokens that overlap.
3. Pairs with equal ends are links, and their ends cut the document's tokens into groups.
4. Documents are stored with their distinct id pairs and how often each is linked. Pairs are counted over the corpus by an
   aggregate, each B id's highest count follows from that, and both come back to the documents by a join on the pair: broadcast
   within a checked size, otherwise shuffled with hot pairs spread.

Texts that are null, empty, or whose tokens of A or B do not spell the text have no tokens: all their figures are 0 and their
digest is ''. Strings of special tokens are plain text. Repeated ids and rows stay rows of their own; a null id is kept. Other
columns are never read. A very long text is held whole by its task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.records import ChunkEncoder
from zonalis.llm.textblock import ragged, slices
from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join

SLICE = 1 << 20
CACHE_CHUNKS = 400_000
B_BITS = 16
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
_workers: dict[tuple[str, str], TokenPair] = {}


def byte_letters() -> dict[str, int]:
    """Letters of byte-level vocabularies: visible Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Pieces:
    """Bytes of every token of a vocabulary."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))


class TokenPair:
    """Both tokenizers and the tokens of chunks met so far."""

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        letters = byte_letters()
        self.a_pieces = Pieces([bytes(letters.get(c, 0x3F) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())])
        spelled = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            spelled.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.b_pieces = Pieces(spelled)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.tables = [_Rows(), _Rows()]
        self.good = np.zeros(0, bool)

    def whole(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a space and the text by A, of the text by B."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)

    def _learn(self, chunks: list[bytes]) -> None:
        a, b = self.whole([c[1:].decode() for c in chunks])
        for table, ids in zip(self.tables, (a, b), strict=True):
            table.add(ids)
        spelled = [self.spells(x, y, c) for x, y, c in zip(a, b, chunks, strict=True)]
        self.good = np.append(self.good, spelled)
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks)), strict=True))

    def spells(self, a: list[int], b: list[int], body: bytes) -> bool:
        return b"".join(map(self.a_pieces.spelled.__getitem__, a)) == body == b"".join(map(self.b_pieces.spelled.__getitem__, b))

    def encode(self, texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(ids, tokens per text) by A and by B; texts that a tokenizer does not spell have none."""
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise("", texts, " ")).cast(pa.large_binary())
        offsets = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        empty = (np.zeros(0, np.int64), np.zeros(len(texts), np.int64))
        if low == high:
            return empty, empty
        data, offsets = np.frombuffer(spaced.buffers()[2], np.uint8)[low:high], offsets - low
        starts = chunk_starts(data, offsets)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > CACHE_CHUNKS:
            self.clear()
        fresh = [c for c in distinct if c not in self.known]
        if fresh:
            self._learn(fresh)
        place = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[np.asarray(coded.indices)]
        text_of = np.searchsorted(offsets, starts, "right") - 1
        bad = np.unique(text_of[~self.good[place]])
        redone = {}
        if len(bad):
            some = texts.take(pa.array(bad)).to_pylist()
            redone = {int(t): (a, b) if self.spells(a, b, b" " + s.encode()) else ([], []) for t, s, a, b in zip(bad, some, *self.whole(some), strict=True)}
        out = []
        for side, table in enumerate(self.tables):
            begin, count = table.start[place], table.size[place]
            ids, per_text = table.ids[ragged(begin, count)], np.bincount(text_of, count, len(texts)).astype(np.int64)
            if redone:
                parts, bounds = [], np.append(0, np.cumsum(per_text))
                for t in range(len(texts)):
                    parts.append(np.array(redone[t][side], np.int64) if t in redone else ids[bounds[t] : bounds[t + 1]])
                ids, per_text = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
            out.append((ids, per_text))
        return out[0], out[1]


class _Rows:
    """Growing list of id lists as flat arrays."""

    def __init__(self):
        self.ids, self.start, self.size = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, lists: list[list[int]]) -> None:
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        self.start = np.append(self.start, len(self.ids) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum())))


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Text starts, and single spaces between something visible on both sides."""
    starts = ChunkEncoder.cuts(data, offsets)
    first = np.zeros(len(data), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    after = np.append(data[1:] > 0x20, False)
    after[offsets[(offsets > 0) & (offsets < len(data))] - 1] = False  # the last byte of a text has nothing after it
    return starts[first[starts] | after[starts]]


def token_pair(a_file: str, b_file: str) -> TokenPair:
    """One pair per Python worker."""
    if (a_file, b_file) not in _workers:
        _workers[a_file, b_file] = TokenPair(a_file, b_file)
    return _workers[a_file, b_file]


def token_table(per_text: np.ndarray, ends: np.ndarray, sizes: np.ndarray, side: str) -> pd.DataFrame:
    """Tokens of a batch: document, first byte in the batch's joined texts, number."""
    return pd.DataFrame({"doc": np.repeat(np.arange(len(per_text)), per_text), "at": ends - sizes, side: np.arange(len(ends))}, copy=False)


def overlaps(a_per: np.ndarray, a_sizes: np.ndarray, b_per: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, whether they end together): numbers of all pairs of overlapping tokens, both directions of covering tokens united.

    In a document both sides cover the same bytes from the first on, so every start has a covering token on the other side.
    """
    if not len(a_sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a, b = token_table(a_per, a_ends, a_sizes, "a"), token_table(b_per, b_ends, b_sizes, "b")
    forth = pd.merge_asof(a, b, on="at", by="doc")["b"].to_numpy()
    back = pd.merge_asof(b, a, on="at", by="doc")["a"].to_numpy()
    later = np.flatnonzero(a["at"].to_numpy()[back] < b["at"].to_numpy())  # equal starts are in the other direction
    of_a, of_b = np.append(a["a"].to_numpy(), back[later]), np.append(forth, later)
    return of_a, of_b, a_ends[of_a] == b_ends[of_b]


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal spellings of 0..n-1 with a comma after each: bytes, starts, sizes."""
    spelled = [f"{i},".encode() for i in range(n)]
    sizes = np.fromiter(map(len, spelled), np.int64, n)
    return np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(sizes) - sizes, sizes


class GroupDigest:
    """Digests of ``a1,a2|b1;a3|b2,b3`` per document."""

    def __init__(self, ids: int):
        self.letters, self.starts, self.sizes = _decimals(ids)

    def of(self, a: np.ndarray, b: np.ndarray, a_per_text: np.ndarray, b_per_text: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
        """``last_a`` and ``last_b`` are the numbers of the tokens that end the groups."""
        groups = len(last_a)
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        base = np.cumsum(n_a + n_b) - n_a - n_b
        merged = np.zeros(len(a) + len(b), np.int64)
        merged[ragged(base, n_a)] = a
        merged[ragged(base + n_a, n_b)] = b
        size = self.sizes[merged]
        body = self.letters[ragged(self.starts[merged], size)]
        ends = np.cumsum(size)
        body[ends[base + n_a - 1] - 1] = ord("|")
        body[ends[base + n_a + n_b - 1] - 1] = ord(";")
        stops = np.append(0, ends)[np.append(0, np.cumsum(a_per_text + b_per_text))]
        raw = memoryview(np.ascontiguousarray(body))
        return [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)] if groups else [""] * len(a_per_text)


def align(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, n_a, n_b, n_overlaps, n_groups, n_links, groups_sha256, pairs, times): one row per document, stored.

    ``pairs`` are the distinct linked pairs, a * 2^16 + b, and ``times`` how often each is linked in the document.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(a_file, b_file)
        digest = GroupDigest(max(len(pair.a_pieces.spelled), len(pair.b_pieces.spelled)))
        row = TaskContext.get().partitionId() << 33
        for piece in slices(batches, limit=SLICE):
            (a, a_per), (b, b_per) = pair.encode(piece.column(1))
            n = piece.num_rows
            over_a, over_b, together = overlaps(a_per, pair.a_pieces.sizes[a], b_per, pair.b_pieces.sizes[b])
            doc_of_a = np.repeat(np.arange(n), a_per)
            order = np.argsort(over_a[together])  # a token ends with at most one other
            last_a, last_b = over_a[together][order], over_b[together][order]
            doc = doc_of_a[last_a]
            links = np.bincount(doc, minlength=n)
            code = (doc << 32) + (a[last_a] << B_BITS) + b[last_b]
            distinct, times = np.unique(code, return_counts=True)
            offsets = pa.array(np.searchsorted(distinct, np.arange(n + 1) << 32).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)), piece.column(0), pa.array(a_per), pa.array(b_per), pa.array(np.bincount(doc_of_a[over_a], minlength=n)),
                    pa.array(links), pa.array(links), pa.array(digest.of(a, b, a_per, b_per, last_a, last_b), pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(distinct & 0xFFFFFFFF)), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                names=["row", "id", "n_a", "n_b", "n_overlaps", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )
            row += n

    kind = "row long, id long, n_a long, n_b long, n_overlaps long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    return materialize(rows.mapInArrow(task, kind))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links of every id pair over the corpus, and whether no other pair of its B id has more. Stored."""
    opened = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = materialize(opened.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")))
    b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # a row per B id: bounded by the vocabulary
    return materialize(counts.join(highest, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def with_counts(aligned: DataFrame, counts: DataFrame, **limits: int) -> DataFrame:
    """Adds n_best and count_sum to the documents of ``align``."""
    opened = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    met = lookup_join(opened, counts, ["pair"], null_safe=False, row_id="row", stored=True, **limits)
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"), F.sum(F.col("times") * F.col("n")).cast("long").alias("count_sum"))
    out = aligned.drop("pairs", "times").join(sums, "row", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}).drop("row")
