"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

A document's set holds its distinct shingles of a few consecutive words. Two documents are linked when the Jaccard
similarity of their full sets reaches a threshold. Candidates are found on signatures of ``SYMBOLS`` b-bit MinHash
values: two signatures that differ in at most ``DISTANCE`` symbols have, by pigeonhole, at least one of ``CHUNKS`` chunks
with at most ``CHUNK_ERRORS`` differing symbols, so they share the key of that chunk with those symbols left out. All
pairs within the distance are therefore met. At similarity 0.8 a symbol differs with probability 0.2, and more than 23 of
48 differ with a probability of about 1 in 300,000.

Equal sets are folded first. A bucket (key) is worked off without listing its pairs:

1. every member is compared with one member of the bucket (the star), one row per member; links merge components;
2. that is repeated with other stars, ``STAR_ROUNDS`` times in all;
3. what is left are buckets with members of different components. They are cut into blocks of bounded size, and each
   pair of blocks is compared in one task. A pair counts in the first bucket that it shares, if it is within the distance
   and not yet in one component. A first pass over signatures names the members that have such a pair, a second one holds
   their full sets, confirms the pairs and unites them at once: only links that unite something leave the task, fewer
   than it has rows.

Every link is confirmed on the full sets. Null and empty texts have an empty set and are linked with nothing. Rows that share
an id are told apart by a hash of the text; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.textblock import NOT_SPACE, Words, binary_rows, gram_hashes, mix, ragged, slices, within
from zonalis.plans.components import components
from zonalis.plans.materialize import materialize

SHINGLE_WORDS = 5
SIMILARITY = 80  # percent
SYMBOLS = 48
DISTANCE = 23
CHUNKS = 12
CHUNK_ERRORS = 1
BLOCK_ROWS = 1000
STAR_ROUNDS = 1
BLOCK_BYTES = 16 << 20  # of full sets, about

assert CHUNKS * (CHUNK_ERRORS + 1) > DISTANCE and SYMBOLS % CHUNKS == 0

_seeds = mix(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64))
_factors = (_seeds[:SYMBOLS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_addends = (_seeds[SYMBOLS:] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and the set sizes.

    Words are runs of non-whitespace with A-Z lowered. A text with fewer words than a shingle has one shingle, all of it.
    """
    w = Words(column, NOT_SPACE)
    grams = gram_hashes(w.hashes, words)
    at = np.flatnonzero(within(w.word_offsets, words, len(grams)))
    docs, values = w.doc_of(at), grams[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < words))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(words - 1):  # at most words-1 words each
            has = w.counts[short] > j
            whole[has] = mix(whole[has] * np.uint64(31) + w.hashes[w.word_offsets[short[has]] + j] + np.uint64(j + 1))
        docs, values = np.concatenate([docs, short]), np.concatenate([values, whole])
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    keep = np.ones(len(docs), bool)
    keep[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    docs, values = docs[keep], values[keep]
    return values, np.bincount(docs, minlength=len(column)).astype(np.int64)


def _fill(sizes: np.ndarray, values: np.ndarray, of_empty: int = 0) -> np.ndarray:
    out = np.full(len(sizes), of_empty, values.dtype)
    out[sizes > 0] = values
    return out


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_key, n_shingles, s1, s2, sig): two hashes of the whole set and the signature, 2 bytes a symbol."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            values, sizes = shingle_sets(piece.column(1), words)
            starts = (np.cumsum(sizes) - sizes)[sizes > 0]
            sig = np.zeros((len(sizes), SYMBOLS), np.uint16)
            if len(values):
                s1 = np.add.reduceat(mix(values), starts)
                s2 = np.bitwise_xor.reduceat(mix(values + np.uint64(77)), starts)
                small = (values >> np.uint64(32)).astype(np.uint32)
                for k in range(SYMBOLS):
                    least = np.minimum.reduceat(small * _factors[k] + _addends[k], starts)
                    sig[sizes > 0, k] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
            else:
                s1 = s2 = np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0), piece.column(2), pa.array(sizes), pa.array(_fill(sizes, s1).view(np.int64)), pa.array(_fill(sizes, s2).view(np.int64)),
                    binary_rows(sig.view(np.uint8).ravel(), np.full(len(sizes), 2 * SYMBOLS)),
                ],
                names=["id", "text_key", "n_shingles", "s1", "s2", "sig"],
            )

    return keyed(docs, doc_id, text).mapInArrow(task, "id long, text_key long, n_shingles long, s1 long, s2 long, sig binary")


def text_key(text: str = "text") -> Column:
    """Tells apart rows that share an id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), text_key(text).alias("text_key"))


def chunk_keys(nodes: DataFrame) -> DataFrame:
    """(key, slot, id): the keys of every chunk with each choice of ``CHUNK_ERRORS`` symbols left out, numbered by ``slot``."""
    width = SYMBOLS // CHUNKS
    choices = [c for c in combinations(range(width), width - CHUNK_ERRORS)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                sig = _matrix(piece.column(1)).astype(np.uint64)
                keys = []
                for chunk in range(CHUNKS):
                    for number, kept in enumerate(choices):
                        key = np.full(len(sig), chunk * len(choices) + number + 1, np.uint64)
                        for symbol in kept:
                            key = mix(key * np.uint64(31) + sig[:, chunk * width + symbol])
                        keys.append(key)
                ids = np.repeat(np.asarray(piece.column(0)), len(keys))
                slots = np.tile(np.arange(len(keys), dtype=np.int32), len(sig))
                yield pa.RecordBatch.from_arrays([pa.array(np.stack(keys, 1).ravel().view(np.int64)), pa.array(slots), pa.array(ids)], names=["key", "slot", "id"])

    return nodes.select("id", "sig").mapInArrow(task, "key long, slot int, id long")


def first_slots(unequal: np.ndarray) -> np.ndarray:
    """The lowest slot whose key a pair shares, from which of their symbols differ (pairs x symbols); -1 without any."""
    width = SYMBOLS // CHUNKS
    choices = [c for c in combinations(range(width), width - CHUNK_ERRORS)]
    parted = unequal.reshape(len(unequal), CHUNKS, width)
    shares = np.stack([~parted[:, :, list(c)].any(axis=2) for c in choices], axis=2).reshape(len(unequal), CHUNKS * len(choices))
    return np.where(shares.any(axis=1), shares.argmax(axis=1), -1)


def _matrix(column: pa.Array) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint16)
    return data.reshape(len(column), SYMBOLS)


def full_sets(docs: DataFrame, used: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """(node, items): the sorted shingle hashes of the documents named in the stored table ``used`` (node, id, text_key)."""

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            values, n = shingle_sets(piece.column(1), words)
            yield pa.RecordBatch.from_arrays([piece.column(0), binary_rows(values.view(np.uint8), 8 * n)], names=["node", "items"])

    wanted = keyed(docs, doc_id, text).join(used.hint("shuffle_hash"), ["id", "text_key"])
    return wanted.select("node", "text").mapInArrow(as_sets, "node long, items binary").dropDuplicates(["node"])


def named(nodes: DataFrame) -> DataFrame:
    """(node, id, text_key): the document that stands for each node."""
    return nodes.select(F.col("id").alias("node"), F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key"))


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, similarity: int, doc_id: str, text: str) -> DataFrame:
    """The (a, b) of ``pairs`` that are within the signature distance and whose full sets reach the similarity."""
    sizes = nodes.select("id", "n_shingles", "sig")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ok = np.count_nonzero(_matrix(batch.column(2)) != _matrix(batch.column(3)), axis=1) <= DISTANCE
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    first = sizes.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("sig_a"))
    second = sizes.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("sig_b"))
    sized = pairs.join(second, "b").join(first, "a").filter(
        (100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))
    )
    close = materialize(sized.select("a", "b", "sig_a", "sig_b").mapInArrow(near, "a long, b long"))

    # Only texts that occur in a pair are read into sets. Each set travels once per pair for b, once per document for a.
    used = close.select(F.col("a").alias("id")).union(close.select(F.col("b").alias("id"))).distinct()
    sets = full_sets(docs, named(nodes.join(used, "id", "left_semi")), words, doc_id, text)
    sets = materialize(sets.withColumnRenamed("node", "id"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, ok = batch.column(2), batch.column(3), np.zeros(batch.num_rows, bool)
            for row in range(batch.num_rows):
                x, y = np.frombuffer(left[row].as_buffer(), np.uint64), np.frombuffer(right[row].as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                ok[row] = 100 * common >= similarity * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    filled = close.join(sets.select(F.col("id").alias("b"), F.col("items").alias("set_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("items").alias("set_a")), "a"
    )
    return materialize(filled.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long"))


def _blocks_met(live: DataFrame, block_rows: int, size: Column) -> DataFrame:
    """Rows of buckets as pairs of blocks: key, low, high, block and the columns of ``live``, sorted by (key, low, high).

    A bucket gets as many blocks as its rows and bytes ask for; a block travels once per block that it meets, so no task holds
    more than two blocks.
    """
    counts = live.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum(size).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("members") / F.lit(block_rows)), F.ceil(F.col("bytes") / F.lit(BLOCK_BYTES))).cast("int")
    placed = live.join(counts, "key").withColumn("n", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", *[c for c in live.columns if c != "key"]
    )
    order = ["key", "low", "high"]
    return met.repartition(*order).sortWithinPartitions(*order)


def _whole_groups(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Rows of one (key, low, high) at a time, from sorted rows."""
    rest = None
    for batch in batches:
        for at in range(0, batch.num_rows, step):  # small steps: rows may hold whole sets
            part = batch.slice(at, step)
            rest = part if rest is None else pa.concat_batches([rest, part])
            key, low, high = (np.asarray(rest.column(c)) for c in range(3))
            new = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            for x, y in zip([0, *new[:-1]], new, strict=False):
                yield rest.slice(x, y - x)
            rest = rest.slice(new[-1]) if len(new) else rest
    if rest is not None and rest.num_rows:
        yield rest


class _Block:
    """Members of two blocks of a bucket: who may be linked with whom by size, component and signature."""

    def __init__(self, group: pa.RecordBatch, similarity: int):
        low, high, self.side, slot, self.ids, component, self.sizes = (np.asarray(group.column(c)) for c in (1, 2, 3, 4, 5, 6, 7))
        self.apart, self.slot, self.similarity = low[0] != high[0], slot[0], similarity
        self.sig = _matrix(group.column(8))
        names, self.group = np.unique(component, return_inverse=True)
        self.mixed = len(names) > 1
        self.largest = np.bincount(self.group).argmax()  # its members need no comparison with each other

    def rows(self) -> np.ndarray:
        return np.flatnonzero(self.group != self.largest) if self.mixed else np.zeros(0, np.int64)

    def near(self, row: int) -> np.ndarray:
        """Members of other components within the distance that meet ``row`` here first."""
        at = np.flatnonzero((self.group != self.group[row]) & ((self.side != self.side[row]) if self.apart else True))
        at = at[100 * np.minimum(self.sizes[at], self.sizes[row]) >= self.similarity * np.maximum(self.sizes[at], self.sizes[row])]
        unequal = self.sig[at] != self.sig[row]
        close = np.flatnonzero(unequal.sum(axis=1) <= DISTANCE)
        return at[close][first_slots(unequal[close]) == self.slot]


def _members_to_compare(live: DataFrame, block_rows: int, similarity: int) -> DataFrame:
    """(key, id) of bucket members that the signatures let be linked with a member of another component."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_groups(batches, 4 * block_rows):
            block = _Block(group, similarity)
            used = np.zeros(group.num_rows, bool)
            for row in block.rows():
                at = block.near(row)
                used[at] = True
                used[row] |= len(at) > 0
            if used.any():
                take = pa.array(np.flatnonzero(used))
                yield pa.RecordBatch.from_arrays([group.column(0).take(take), group.column(5).take(take)], names=["key", "id"])

    met = _blocks_met(live.select("key", "slot", "id", "component", "n_shingles", "sig"), block_rows, F.octet_length("sig"))
    return met.mapInArrow(task, "key long, id long").distinct()


def _block_links(live: DataFrame, block_rows: int, similarity: int) -> DataFrame:
    """Links (a, b) between components of one bucket, confirmed on the full sets and united block by block.

    ``live``: key, slot, id, component, n_shingles, sig, items.
    """

    def links(group: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        block = _Block(group, similarity)
        if not block.mixed:
            return
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column(9)]
        _, item = np.unique(np.concatenate(sets), return_inverse=True)
        by = np.argsort(item, kind="stable")  # documents of each shingle
        holders, first = np.repeat(np.arange(len(sets)), block.sizes)[by], np.searchsorted(item[by], np.arange(item.max() + 2))
        ends = np.cumsum(block.sizes)
        for row in block.rows():
            at = block.near(row)
            if not len(at):
                continue
            mine = item[ends[row] - block.sizes[row] : ends[row]]
            common = np.bincount(holders[ragged(first[mine], first[mine + 1] - first[mine])], minlength=len(sets))[at]
            for other in at[100 * common >= similarity * (block.sizes[at] + block.sizes[row] - common)]:
                if block.group[other] != block.group[row]:
                    block.group[block.group == block.group[other]] = block.group[row]
                    yield int(min(block.ids[row], block.ids[other])), int(max(block.ids[row], block.ids[other]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_groups(batches, block_rows):
            pairs = np.array(list(links(group)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    met = _blocks_met(live.select("key", "slot", "id", "component", "n_shingles", "sig", "items"), block_rows, F.octet_length("items"))
    return met.mapInArrow(task, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, similarity: int = SIMILARITY, doc_id: str = "doc_id", text: str = "text",
    block_rows: int = BLOCK_ROWS, star_rounds: int = STAR_ROUNDS,
) -> DataFrame:
    """One row per document: (doc_id, text_key, n_shingles, component_id, is_first).

    component_id is the smallest id reachable by links; ``is_first`` marks the document that comes first in its class, by id and
    then ``text_key`` (exact repeats of it too). Rows with a null id are linked with nothing: they cannot be named, so their
    class is null and they are first.
    """
    nameless = signatures(docs.filter(F.col(doc_id).isNull()), words, doc_id, text)
    docs = docs.filter(F.col(doc_id).isNotNull())
    signed = materialize(signatures(docs, words, doc_id, text))
    filled = signed.filter("n_shingles > 0")
    fold = ["s1", "s2", "n_shingles"]
    folded = filled.groupBy(*fold).agg(F.min(F.struct("id", "text_key")).alias("first"), F.min("sig").alias("sig"))
    folded = materialize(folded.withColumn("node", F.xxhash64(*fold)))
    nodes = folded.select(F.col("node").alias("id"), "n_shingles", "sig", "first")
    keys = chunk_keys(nodes)
    shared = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    live = materialize(keys.join(shared.select("key"), "key", "left_semi"))
    labels = nodes.select("id", F.col("id").alias("component"))
    links, tried = None, None
    for number in range(star_rounds):
        live = live.select("key", "slot", "id").join(labels, "id")
        mixed = live.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
        live = materialize(live.join(mixed.select("key"), "key", "left_semi"))
        star = F.min_by(F.struct("id", "component"), F.xxhash64(F.lit(number), F.col("id")) if number else F.col("id")).alias("star")
        stars = live.groupBy("key").agg(star).select("key", "star.id", "star.component").toDF("key", "star", "star_component")
        pairs = live.join(stars, "key").filter("component != star_component").select(
            F.least("id", "star").alias("a"), F.greatest("id", "star").alias("b")
        ).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs)
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = confirmed(pairs, nodes, docs, words, similarity, doc_id, text)
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        labels = materialize(components(nodes.select("id"), links, []))
    live = live.select("key", "slot", "id").join(labels, "id")
    mixed = live.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    rest = live.join(mixed.select("key"), "key", "left_semi").join(nodes.select("id", "n_shingles", "sig"), "id")
    rest = materialize(rest)
    rest = materialize(rest.join(_members_to_compare(rest, block_rows, similarity), ["key", "id"]))
    used = named(nodes.join(rest.select("id").distinct(), "id", "left_semi"))
    sets = full_sets(docs, used, words, doc_id, text).withColumnRenamed("node", "id")
    found = materialize(_block_links(rest.join(sets, "id"), block_rows, similarity))
    if not found.isEmpty():
        links = found if links is None else links.unionByName(found)
        labels = materialize(components(nodes.select("id"), links, []))
    members = folded.join(labels.withColumnRenamed("id", "node"), "node")
    heads = members.groupBy("component").agg(F.min("first").alias("head"))
    classes = members.join(heads, "component").select(*fold, "head")
    out = signed.join(classes, fold, "left")
    own = F.struct("id", "text_key")
    head = F.when(F.col("n_shingles") > 0, F.col("head")).otherwise(own)
    rows = out.select(F.col("id").alias(doc_id), "text_key", "n_shingles", head["id"].alias("component_id"), (head == own).alias("is_first"))
    return rows.unionByName(nameless.select(F.col("id").alias(doc_id), "text_key", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("is_first")))
