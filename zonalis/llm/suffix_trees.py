"""Removal of long repeated word sequences by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words of one document. A word goes when it lies in a window whose words also start
earlier: in a document before it, or further to the left in the same document.

1. Contexts. Of the hashes of all ``GRAM``-word grams in a window the smallest is its anchor (the rightmost of equal ones), so
   equal windows have equal anchors at the same place, and the windows of one anchor are a run: its context. A context
   that occurs again is repeated as a whole and only its first occurrence goes on; an anchor with a single context has no
   repeat at all. What remains are first occurrences of contexts that share an anchor with a different context.
2. Suffixes. Every window start of those contexts is a suffix: the words from there to the end of the context.
3. Prefixes. Suffixes are dealt by their first word; a prefix with more than ``GROUP_ROWS`` suffixes is extended, and again,
   until its group fits. A prefix of ``WINDOW`` words needs no tree: it is one deep node, whose first leaf is an aggregate.
4. Trees. A task takes whole groups, sorts their suffixes by bytes and builds the tree of nodes from common word prefixes of
   neighbours. Internal nodes of ``WINDOW`` or more words are repeats, and for a leaf the deepest such node that has an
   earlier leaf gives the longest stretch from there that occurs before.
5. Stretches and repeated contexts are merged per document, and the words left are joined by one space.

Hot keys: anchors that are frequent in a sample of the documents are dealt by anchor, context and a part of the document id
instead of the anchor alone; the list only steers where rows go. Contexts are folded in the map tasks first.

Documents are ordered by id, a null id last, then by a hash of the text. Rows equal in id and text are one document: none of
them is earlier than another. Null and empty texts have no words. A very long text is worked on in overlapping pieces. Other
columns are never read. Grams and contexts are compared by 64-bit hashes, suffixes by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.textblock import IS_SPACE, NOT_SPACE, Words, flat, gram_hashes, mix, ragged, slices
from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join

WINDOW = 20
GRAM = 8
GROUP_ROWS = 50_000
PREFIXES = (1, 2, 3, 5, 8, 12)
SEGMENT = 4 << 20
SAMPLE = 64
HOT_ANCHORS = 2_000
HOT_COUNT = 8
SALTS = 32
LAST = (1 << 63) - 1
_PLACE_BITS = 24


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, k, text): the id with null last, a hash of the text, the text itself."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(body).alias("k"), body.alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], text: int, overlap: int) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
    """(rows, words, number of words before): slices of texts; a very long text comes in pieces that share ``overlap`` words."""
    for piece in slices(batches, "text"):
        column = piece.column(text)
        data, offsets = flat(column)
        if len(data) <= SEGMENT:
            yield piece, Words(column, NOT_SPACE, lower=False), np.zeros(piece.num_rows, np.int64)
            continue
        for row in range(piece.num_rows):
            body, at, before, size = data[offsets[row] : offsets[row + 1]], 0, 0, SEGMENT
            while True:
                stop = min(len(body), at + size)
                while stop < len(body) and not IS_SPACE[body[stop]]:
                    stop += 1
                words = Words(pa.array([body[at:stop].tobytes()], pa.binary()), NOT_SPACE, lower=False)
                if len(words.starts) <= overlap and stop < len(body):
                    size *= 2  # very long words
                    continue
                yield piece.slice(row, 1), words, np.array([before])
                if stop == len(body):
                    break
                before += len(words.starts) - overlap
                at += int(words.starts[-overlap])


def contexts_of(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (text, anchor hash, context hash, first window, windows), words counted per slice."""
    counts = np.maximum(words.counts - window + 1, 0)
    starts = ragged(words.word_offsets[:-1], counts)
    texts = np.repeat(np.arange(len(counts)), counts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    grams = gram_hashes(words.hashes, gram)
    n, m = len(grams), window - gram + 1
    packed = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | ((1 << _PLACE_BITS) - 1 - np.arange(n)).astype(np.uint64)
    rows = -(-n // m)
    table = np.full(rows * m, np.iinfo(np.uint64).max, np.uint64)
    table[:n] = packed
    table = table.reshape(rows, m)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(backward[starts], forward[starts + m - 1])
    place = ((1 << _PLACE_BITS) - 1) - (best & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (texts[1:] != texts[:-1])))
    run = np.diff(np.append(new, len(starts)))
    first = starts[new]
    # The context's words, hashed in order, with the anchor's place in it.
    prefix = np.zeros(len(words.hashes) + 1, np.uint64)
    scale = np.cumprod(np.full(len(words.hashes), 0x9E3779B97F4A7C15, np.uint64))
    np.cumsum(words.hashes * scale, out=prefix[1:])
    back = np.cumprod(np.full(len(words.hashes), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
    stop = first + run - 1 + window
    context = mix((prefix[stop] - prefix[first]) * back[first] + (run * 64 + place[new] - first).astype(np.uint64))
    return texts[new], grams[place[new]], context, first, run


def spots(batch_ids: pa.Array, batch_keys: pa.Array, rows: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    take = pa.array(rows)
    return [batch_ids.take(take), batch_keys.take(take), pa.array(starts.astype(np.int32))]


def hot_anchors(rows: DataFrame, window: int, gram: int) -> np.ndarray:
    """Anchors met in many of the sampled documents: at most ``HOT_ANCHORS`` of them. They steer partitioning only."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, _ in pieces(batches, 0, window - 1):
            _, anchor, _, _, _ = contexts_of(words, window, gram)
            seen, n = np.unique(anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    sampled = rows.filter(F.pmod(F.xxhash64("id", "k"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(task, "anchor long, n long")
    counted = sampled.groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_COUNT)
    found = [r.anchor for r in counted.orderBy(F.col("n").desc(), "anchor").limit(HOT_ANCHORS).collect()]
    return np.sort(np.array(found, np.int64))


def fold_contexts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(repeated, id, k, start, run): context occurrences that are not the first of their kind, and first occurrences whose
    anchor has another context too. Stored."""
    rows = keyed(docs, doc_id, text)
    hot = hot_anchors(rows, window, gram)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, before in pieces(batches, 2, window - 1):
            which, anchor, context, first, run = contexts_of(words, window, gram)
            ids, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            start = first - words.word_offsets[which] + before[which]
            anchor, context = anchor.view(np.int64), context.view(np.int64)
            order = np.lexsort((start, keys[which], ids[which], context, anchor))
            same = np.zeros(len(order), bool)
            if len(order):
                a, c = anchor[order], context[order]
                opens = np.append(True, (a[1:] != a[:-1]) | (c[1:] != c[:-1]))
                lead = order[np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))]
                later = (ids[which[order]] != ids[which[lead]]) | (keys[which[order]] != keys[which[lead]]) | (start[order] != start[lead])
                same[order] = later
            crowded = np.isin(anchor, hot)
            salt = ids[which].astype(np.uint64) % np.uint64(SALTS)
            route = np.where(crowded, mix(anchor.view(np.uint64) ^ mix(context.view(np.uint64) + salt)).view(np.int64), anchor)
            route = np.where(same, mix(ids[which].view(np.uint64) + start.astype(np.uint64)).view(np.int64), route)  # nothing to meet
            yield pa.RecordBatch.from_arrays(
                [pa.array(route), pa.array(context), *spots(batch.column(0), batch.column(1), which, start), pa.array(run.astype(np.int16)), pa.array((crowded + 2 * same).astype(np.int16))],
                names=["route", "context", "id", "k", "start", "run", "mark"],
            )

    dealt = rows.mapInArrow(task, "route long, context long, id long, k long, start int, run short, mark short")
    dealt = dealt.repartition("route").sortWithinPartitions("route", "context", "id", "k", "start")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows carried to the next batch: a first occurrence of the last route whose fate is open, or two that are out already.
        names = ["route", "context", "id", "k", "start", "run", "mark"]
        carried: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if carried is not None:
                batch = pa.concat_batches([carried, batch])
            route, context, ids, keys, start, run, mark = (np.asarray(batch.column(n)).astype(np.int64, copy=False) for n in names)
            n = len(route)
            done = mark >= 4
            known = (mark & 2) > 0
            opens = np.append(True, (route[1:] != route[:-1]) | (context[1:] != context[:-1]) | known[1:] | known[:-1])
            lead = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
            repeated = known | (~opens & ((ids != ids[lead]) | (keys != keys[lead]) | (start != start[lead])))
            firsts = np.flatnonzero(opens & ~known)
            group = np.flatnonzero(np.append(True, route[firsts][1:] != route[firsts][:-1])) if len(firsts) else np.zeros(0, np.int64)
            size = np.diff(np.append(group, len(firsts)))
            several = np.repeat(size > 1, size) | ((mark[firsts] & 1) > 0)
            wanted = np.zeros(n, bool)
            wanted[firsts[several]] = True
            out = (repeated | wanted) & ~done
            carried = None
            if len(firsts) and route[firsts[-1]] == route[-1]:
                last = firsts[group[-1] :]
                keep = last[[0, -1]] if len(last) > 1 else last
                carried = batch.take(pa.array(keep))
                marks = mark[keep] | np.where(wanted[keep], 4, 0)
                carried = carried.set_column(6, "mark", pa.array(marks.astype(np.int16)))
            take = pa.array(np.flatnonzero(out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(repeated[out]), *(batch.column(c).take(take) for c in ("id", "k", "start", "run"))], names=["repeated", "id", "k", "start", "run"]
            )

    return materialize(dealt.mapInArrow(meet, "repeated boolean, id long, k long, start int, run short"))


def joined_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with one space after each: bytes, starts and lengths (the space included)."""
    lengths = words.ends - words.starts + 1
    starts = np.cumsum(lengths) - lengths
    out = np.full(int(lengths.sum()), 0x20, np.uint8)
    out[ragged(starts, lengths - 1)] = words.data[ragged(words.starts, lengths - 1)]
    return out, starts, lengths


def suffixes(docs: DataFrame, wanted: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    """(id, k, start, suffix binary): words from every window start of the wanted contexts to the context's end, each followed
    by a space. Stored."""
    marks = wanted.groupBy("id", "k").agg(F.collect_set(F.struct("start", "run")).alias("marks"))
    met = keyed(docs, doc_id, text).join(marks.hint("shuffle_hash"), ["id", "k"]).select("id", "k", "text", "marks")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, before in pieces(batches, 2, 2 * window):
            marked = batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(marked.offsets)))
            parts = marked.flatten()
            start, run = (np.asarray(parts.field(i)).astype(np.int64) for i in (0, 1))
            first = start - before[row]
            inside = (first >= 0) & (first + run - 1 + window <= words.counts[row])  # the others lie in another piece
            row, start, first, run = row[inside], start[inside], first[inside] + words.word_offsets[row[inside]], run[inside]
            data, at, lengths = joined_words(words)
            every = ragged(first, run)
            owner = np.repeat(np.arange(len(run)), run)
            last = first[owner] + run[owner] - 1 + window - 1
            begin, stop = at[every], at[last] + lengths[last]
            offsets = np.zeros(len(every) + 1, np.int64)
            np.cumsum(stop - begin, out=offsets[1:])
            body = np.ascontiguousarray(data[ragged(begin, stop - begin)])
            suffix = pa.Array.from_buffers(pa.large_binary(), len(every), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).cast(pa.binary())
            place = start[owner] + every - first[owner]
            yield pa.RecordBatch.from_arrays([*spots(batch.column(0), batch.column(1), row[owner], place), suffix], names=["id", "k", "start", "suffix"])

    return materialize(met.mapInArrow(task, "id long, k long, start int, suffix binary"))


def prefix_key(words: int) -> Column:
    """The first words of a suffix as a number."""
    return F.xxhash64(F.lit(words), F.substring_index(F.col("suffix").cast("string"), " ", words))


def dealt_by_prefix(found: DataFrame, group_rows: int, window: int) -> tuple[DataFrame, DataFrame]:
    """(suffixes with the ``key`` of their group, suffixes whose groups stay too large up to the window's length)."""
    open_ = found
    ready: list[DataFrame] = []
    for words in (*[p for p in PREFIXES if p < window], window):
        named = open_.withColumn("key", prefix_key(words))
        crowded = materialize(named.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows).select("key", F.lit(True).alias("crowded")))
        if crowded.isEmpty():
            return _union([*ready, named]), named.filter("false")
        parted = lookup_join(named, crowded, ["key"], null_safe=False, row_id="start", stored=True)
        ready.append(parted.filter("crowded IS NULL").drop("crowded"))
        open_ = parted.filter("crowded").drop("key", "crowded")
    return _union(ready), open_


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class SuffixTree:
    """Nodes over sorted suffixes, from the numbers of words that neighbours have in common.

    ``depth`` words, leaves ``first`` to ``last`` in sorted order and ``parent`` of every internal node of ``least`` or more
    words; the parent of a topmost one is -1.
    """

    def __init__(self, suffixes: list[bytes], least: int):
        self.order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
        common = self._common([suffixes[i] for i in self.order])
        self.depth: list[int] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.parent: list[int] = []
        #: For every leaf the deepest node above it, or -1.
        self.above = [-1] * len(suffixes)
        stack: list[tuple[int, int, list[int]]] = []  # (depth, first leaf, closed children)
        for leaf, shared in enumerate([*common, 0], 1):
            shared = shared if shared >= least else 0
            begin, children = leaf - 1, []
            while stack and stack[-1][0] > shared:
                depth, begin, below = stack.pop()
                node = len(self.depth)
                self.depth.append(depth)
                self.first.append(begin)
                self.last.append(leaf - 1)
                self.parent.append(-1)
                for child in below:
                    self.parent[child] = node
                for inner in range(begin, leaf):
                    if self.above[inner] == -1:
                        self.above[inner] = node
                if stack and stack[-1][0] >= shared and stack[-1][0] > 0:
                    stack[-1][2].append(node)
                else:
                    children.append(node)
            if shared and (not stack or stack[-1][0] < shared):
                stack.append((shared, begin, children))

    @staticmethod
    def _common(ordered: list[bytes]) -> list[int]:
        """Whole words that each suffix but the first shares with the one before it: spaces in the common bytes."""
        if len(ordered) < 2:
            return []
        lengths = np.fromiter(map(len, ordered), np.int64, len(ordered))
        data = np.frombuffer(b"".join(ordered), np.uint8)
        starts = np.cumsum(lengths) - lengths
        out = np.zeros(len(ordered) - 1, np.int64)
        for at in range(0, len(out), 8192):
            x, y = np.arange(at, min(at + 8192, len(out))), np.arange(at, min(at + 8192, len(out))) + 1
            n = np.minimum(lengths[x], lengths[y])
            rows, inside = np.repeat(np.arange(len(x)), n), ragged(np.zeros(len(x), np.int64), n)
            a, b = data[starts[x][rows] + inside], data[starts[y][rows] + inside]
            unequal = np.flatnonzero(a != b)
            stop = n.copy()
            first = unequal[np.append(True, rows[unequal][1:] != rows[unequal][:-1])] if len(unequal) else unequal
            stop[rows[first]] = inside[first]
            out[x] = np.bincount(rows[(a == 0x20) & (inside < stop[rows])], minlength=len(x))
        return out.tolist()

    def earlier(self, spots: list[tuple]) -> list[int]:
        """Per suffix, in the given order, the words of the deepest node that also has a leaf at an earlier spot; 0 if none."""
        least: list[tuple] = []
        for node in range(len(self.depth)):
            least.append(min(spots[self.order[leaf]] for leaf in range(self.first[node], self.last[node] + 1)))
        out = [0] * len(spots)
        for leaf, row in enumerate(self.order):
            node = self.above[leaf]
            while node != -1 and not least[node] < spots[row]:
                node = self.parent[node]
            if node != -1:
                out[row] = self.depth[node]
        return out


def tree_stretches(dealt: DataFrame, window: int, group_rows: int) -> DataFrame:
    """(id, k, start, stop): from each suffix with an earlier equal window the longest stretch that occurs before it."""

    def grown(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = [batch.column(c) for c in ("id", "k", "start")]
        tree = SuffixTree(batch.column("suffix").to_pylist(), window)
        depth = np.array(tree.earlier(list(zip(*(c.to_pylist() for c in names), strict=True))), np.int64)
        hit = pa.array(np.flatnonzero(depth))
        start = names[2].take(hit)
        stop = pa.array((np.asarray(start) + depth[depth > 0]).astype(np.int32))
        return pa.RecordBatch.from_arrays([names[0].take(hit), names[1].take(hit), start, stop], names=["id", "k", "start", "stop"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive sorted by group; some whole groups at a time make one tree.
        rest: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rest.append(batch)
            rows += batch.num_rows
            if rows >= group_rows:
                whole = pa.concat_batches(rest)
                key = np.asarray(whole.column("key"))
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield grown(whole.slice(0, cut))
                rest, rows = [whole.slice(cut)], whole.num_rows - cut
        if rows:
            yield grown(pa.concat_batches(rest))

    ordered = dealt.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(task, "id long, k long, start int, stop int")


def deep_nodes(crowded: DataFrame, window: int) -> DataFrame:
    """The same for groups that share a whole window: all leaves after the first one."""
    spot = F.struct("id", "k", "start")
    crowded = crowded.withColumn("key", F.substring_index(F.col("suffix").cast("string"), " ", window))
    first = materialize(crowded.groupBy("key").agg(F.min(spot).alias("first")))
    met = lookup_join(crowded, first, ["key"], null_safe=False, row_id="start", stored=True)
    return met.filter(F.col("first") < spot).select("id", "k", "start", (F.col("start") + window).cast("int").alias("stop"))


def repeated_stretches(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = GROUP_ROWS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, k, start, stop) in words: stretches that cover every window with an earlier equal one; they may overlap."""
    folded = fold_contexts(docs, window, gram, doc_id, text)
    stop = (F.col("start") + F.col("run") - 1 + window).cast("int").alias("stop")
    whole = folded.filter("repeated").select("id", "k", "start", stop)
    found = suffixes(docs, folded.filter("NOT repeated"), window, doc_id, text)
    dealt, crowded = dealt_by_prefix(found, group_rows, window)
    return whole.unionByName(tree_stretches(dealt, window, group_rows)).unionByName(deep_nodes(crowded, window))


def remove_earlier(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = GROUP_ROWS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept binary, kept_sha256): every row without words of windows that occur earlier."""
    stretches = repeated_stretches(docs, window, gram, group_rows, doc_id, text)
    listed = stretches.groupBy("id", "k").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    raw = F.col(doc_id).cast("long").alias("name")
    rows = docs.select(raw, *[c.alias(n) for c, n in zip(_row_key(doc_id, text), ("id", "k", "text"), strict=True)])
    met = rows.join(listed.hint("shuffle_hash"), ["id", "k"], "left").select("name", "text", "spans")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            words = Words(piece.column(1), NOT_SPACE, lower=False)
            spans = piece.column(2)
            counts = np.asarray(pc.fill_null(pc.list_value_length(spans), 0)).astype(np.int64)
            row = np.repeat(np.arange(piece.num_rows), counts)
            parts = spans.flatten()
            change = np.zeros(len(words.starts) + 1, np.int64)
            for field, sign in ((0, 1), (1, -1)):
                np.add.at(change, words.word_offsets[row] + np.asarray(parts.field(field)).astype(np.int64), sign)
            gone = np.cumsum(change)[:-1] > 0
            data, at, lengths = joined_words(words)
            left = np.flatnonzero(~gone)
            body = data[ragged(at[left], lengths[left])].tobytes()
            bounds = np.concatenate([[0], np.cumsum(lengths[left])])[np.searchsorted(left, words.word_offsets)]
            kept = [body[a : max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            removed = words.counts - np.diff(np.searchsorted(left, words.word_offsets))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(words.counts), pa.array(removed), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
                names=["name", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    out = met.mapInArrow(task, "name long, n_words long, n_removed long, kept binary, kept_sha256 string")
    return out.withColumnRenamed("name", doc_id)


def _row_key(doc_id: str, text: str) -> tuple[Column, Column, Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)), F.xxhash64(body), body


#: The contract of the query in plain SQL.
CHECK_SQL = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
l AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
m AS (SELECT p.doc_id, p.i, p.word, max(l.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM p LEFT JOIN l ON l.doc_id = p.doc_id AND l.i = p.i),
t AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS r, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n, 0) AS n_words, coalesce(t.r, 0) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id"""
