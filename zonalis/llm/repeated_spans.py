"""Removal of long repeated byte strings by a hash-compared suffix sort.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else is removed, matches never cross documents.

1. Anchors: of the polynomial hashes of all ``GRAM``-byte grams in a window of ``LENGTH`` bytes the smallest is the
   window's anchor (the rightmost of equal ones). Equal windows have equal anchors at the same place, so every window
   belongs to one anchor, and an anchor's windows are a run: together its context, at most 300 bytes.
2. Anchors are shuffled once by their hash. Those that occur once are done. Occurrences with the same context are
   repeated as a whole. For the rest, one representative per distinct context is kept.
3. Representatives meet by pigeonhole: a window that reaches l bytes to the left of its anchor, with l in one quarter of
   the range, contains the smallest left and right parts of that quarter. Contexts with equal parts form a group.
4. In a group, suffixes are sorted by a mergesort whose comparisons find the common extension by binary search on prefix
   polynomial hashes, so a comparison takes a logarithmic number of steps. Neighbours' extensions are verified byte by
   byte; a group in which a hash misleads is sorted by its bytes. Runs of neighbours with a common extension of the
   needed length, and equal bytes to the left, give the repeated windows.
5. Groups of more than ``GROUP_ROWS`` contexts are not sorted in one task: each of their windows becomes a row with its
   hash, and Spark counts these with map-side combining.

Null and empty texts have no bytes. Rows with equal or null ids are told apart by a hash of the text; exact repeats of a row
count as repeats of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.llm.textblock import binary_rows, flat, inverse_powers, mix, prefix_hashes, ragged, slices, span_hashes
from zonalis.plans.materialize import materialize

LENGTH = 200
GRAM = 100
QUARTERS = 4
GROUP_ROWS = 20_000
SEGMENT = 1 << 20
NO_ID = (1 << 63) - 1
_POSITION_BITS = 24


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (text, anchor hash, context hash, first window start, windows, anchor offset).

    Starts and offsets count from the start of the text. The anchor's place depends on the window's bytes only.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - gram + 1
    m = length - gram + 1
    if n < m:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    prefix = prefix_hashes(data)
    grams = mix((prefix[gram:] - prefix[:-gram]) * inverse_powers(n))
    # Smallest 40 bits of the hash win, then the rightmost place: one number per gram.
    packed = (grams >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | ((1 << _POSITION_BITS) - 1 - np.arange(n)).astype(np.uint64)
    rows = -(-n // m)
    table = np.full(rows * m, np.iinfo(np.uint64).max, np.uint64)
    table[:n] = packed
    table = table.reshape(rows, m)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - m + 1
    best = np.minimum(backward[:windows], forward[m - 1 : m - 1 + windows])
    place = ((1 << _POSITION_BITS) - 1) - (best & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    starts = ragged(offsets[:-1], counts)
    texts = np.repeat(np.arange(len(counts)), counts)
    if not len(starts):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    at = place[starts]
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (texts[1:] != texts[:-1])))
    run = np.diff(np.append(new, len(starts)))
    first, text, where = starts[new], texts[new], at[new]
    context = mix(span_hashes(prefix, first, first + run - 1 + length) + run.astype(np.uint64))
    return text, grams[where], context, first - offsets[text], run, where - first


def _segments(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, checksums, bytes, offsets, shift): slices of texts; a very long text comes in pieces that overlap by a window."""
    for piece in slices(batches, limit=SEGMENT):
        data, offsets = flat(piece.column(2))
        if len(data) <= 2 * SEGMENT:
            yield piece.column(0), piece.column(1), data, offsets, np.zeros(piece.num_rows, np.int64)
            continue
        for row in range(piece.num_rows):
            text = data[offsets[row] : offsets[row + 1]]
            for at in range(0, max(1, len(text) - length + 1), SEGMENT):
                part = text[at : at + SEGMENT + length - 1]
                yield piece.column(0).slice(row, 1), piece.column(1).slice(row, 1), part, np.array([0, len(part)]), np.array([at])


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(body).alias("crc"), body.alias("text"), F.col(doc_id).cast("long").alias("name"))


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(ah, ch, id, crc, start, run, before) for every anchor of every text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sums, data, offsets, shift in _segments(batches, length):
            which, ah, ch, start, run, before = anchors_of(data, offsets, length, gram)
            take = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ah.view(np.int64)), pa.array(ch.view(np.int64)), ids.take(take), sums.take(take),
                    pa.array((start + shift[which]).astype(np.int32)), pa.array(run.astype(np.int16)), pa.array(before.astype(np.int16)),
                ],
                names=["ah", "ch", "id", "crc", "start", "run", "before"],
            )

    return _rows(docs, doc_id, text).drop("name").mapInArrow(task, "ah long, ch long, id long, crc long, start int, run short, before short")


def contexts(docs: DataFrame, wanted: DataFrame, length: int, doc_id: str, text: str) -> DataFrame:
    """``wanted`` (id, crc, start, run, before, ...) with the bytes of each context, cut from the texts."""
    marks = wanted.groupBy("id", "crc").agg(F.collect_list(F.struct("start", "run", "before", "ah", "ch")).alias("marks"))
    rows = _rows(docs, doc_id, text)
    met = rows.join(marks.hint("shuffle_hash"), ["id", "crc"]).select("id", "crc", "text", "marks")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            data, offsets = flat(piece.column(2))
            marks = piece.column(3)
            rows = np.repeat(np.arange(piece.num_rows), np.diff(np.asarray(marks.offsets)))
            parts = marks.flatten()
            start, run = np.asarray(parts.field(0)).astype(np.int64), np.asarray(parts.field(1)).astype(np.int64)
            lengths = run - 1 + length
            cut = data[ragged(offsets[rows] + start, lengths)]
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(take), piece.column(1).take(take), *(parts.field(c) for c in range(5)), binary_rows(cut, lengths)],
                names=["id", "crc", "start", "run", "before", "ah", "ch", "bytes"],
            )

    # An exactly repeated row gives its contexts twice; one is enough.
    out = met.mapInArrow(task, "id long, crc long, start int, run short, before short, ah long, ch long, bytes binary")
    return materialize(out.dropDuplicates(["ah", "ch"]))


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    lengths = np.diff(offsets)
    out = np.zeros((len(column), int(lengths.max(initial=1))), np.uint8)
    out[np.repeat(np.arange(len(column)), lengths), ragged(np.zeros(len(column), np.int64), lengths)] = data
    return out, lengths


def quarter_keys(ctx: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, quarter, ah, ch): for every quarter that a context has windows in, the hash of what those windows share."""
    side = length - gram
    step = side // QUARTERS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = flat(batch.column(2))
            prefix = prefix_hashes(data)
            before, run = (np.asarray(batch.column(c)).astype(np.int64) for c in (3, 4))
            for quarter in range(QUARTERS):
                low, high = step * quarter, step * (quarter + 1)
                # A context has windows with l in [before - run + 1, before].
                ok = np.flatnonzero((before >= low) & (before - run + 1 <= high))
                from_, to = offsets[ok] + before[ok] - low, offsets[ok] + before[ok] + gram + side - high
                key = mix(span_hashes(prefix, from_, to) + np.uint64(quarter + 1))
                take = pa.array(ok)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(ok), quarter, np.int32)), batch.column(0).take(take), batch.column(1).take(take)],
                    names=["key", "quarter", "ah", "ch"],
                )

    return ctx.select("ah", "ch", "bytes", "before", "run").mapInArrow(task, "key long, quarter int, ah long, ch long")


class SuffixSort:
    """Sorts suffixes of rows of bytes within groups by merging; compares by common extension of prefix hashes."""

    def __init__(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, groups: np.ndarray):
        self.letters, self.starts, self.sizes, self.groups = letters, starts, ends - starts, groups
        self.width = letters.shape[1]
        flat_prefix = prefix_hashes(letters.ravel())
        self.prefix, self.inverse = flat_prefix, inverse_powers(len(flat_prefix))
        self.base = np.arange(len(letters)) * self.width + starts

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y by binary search on prefix hashes."""
        low = np.zeros(len(x), np.int64)
        high = np.minimum(self.sizes[x], self.sizes[y])
        a, b = self.base[x], self.base[y]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            p, q = a[open_], b[open_]
            same = (self.prefix[p + middle] - self.prefix[p]) * self.inverse[p] == (self.prefix[q + middle] - self.prefix[q]) * self.inverse[q]
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before y; equal ones by row."""
        common = self.extension(x, y)
        ended_x, ended_y = common == self.sizes[x], common == self.sizes[y]
        at = np.minimum(common, self.width - 1)
        flat_letters = self.letters.ravel()
        end = len(flat_letters) - 1
        cx, cy = flat_letters[np.minimum(self.base[x] + at, end)], flat_letters[np.minimum(self.base[y] + at, end)]
        return np.where(ended_x & ended_y, x < y, np.where(ended_x, True, np.where(ended_y, False, cx < cy)))

    def order(self) -> np.ndarray:
        """Rows by group, then suffix: bottom-up mergesort, each element placed by binary search in the other run."""
        order = np.argsort(self.groups, kind="stable")
        group = self.groups[order]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(first, len(group)))
        start, total = np.repeat(first, size), np.repeat(size, size)
        inside = np.arange(len(group)) - start
        width = 1
        while width < int(size.max(initial=1)):
            run = inside // width
            other = start + (run ^ 1) * width
            stop = np.minimum(other + width, start + total)
            low, high = other.copy(), np.maximum(other, stop)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                before = self.less(order[middle], order[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            pair = start + (run // 2) * 2 * width
            place = pair + (inside - run * width) + np.where(other < start + total, low - other, 0)
            merged = np.empty_like(order)
            merged[place] = order
            order = merged
            width *= 2
        return order

    def neighbours(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order and each row's common extension with the row before it (-1 at a group's start), verified on bytes."""
        common = np.full(len(order), -1, np.int64)
        inner = np.flatnonzero(self.groups[order[1:]] == self.groups[order[:-1]]) + 1
        common[inner] = self.extension(order[inner - 1], order[inner])
        wrong = set()
        flat_letters = self.letters.ravel()
        for part in range(0, len(inner), 4096):
            some = inner[part : part + 4096]
            x, y, n = order[some - 1], order[some], common[some]
            cells = ragged(np.zeros(len(some), np.int64), n)
            rows = np.repeat(np.arange(len(some)), n)
            unequal = flat_letters[self.base[x][rows] + cells] != flat_letters[self.base[y][rows] + cells]
            wrong.update(self.groups[x[rows[unequal]]].tolist())
        for group in wrong:  # a hash collision: sort this group by its bytes
            at = np.flatnonzero(self.groups[order] == group)
            suffix = {r: self.letters[r, self.starts[r] : self.starts[r] + self.sizes[r]].tobytes() for r in order[at].tolist()}
            fixed = sorted(suffix, key=lambda r: (suffix[r], r))
            order[at] = fixed
            for k in range(1, len(fixed)):
                a, b = suffix[fixed[k - 1]], suffix[fixed[k]]
                most = min(len(a), len(b))
                common[at[k]] = next((i for i in range(most) if a[i] != b[i]), most)
        return order, common


def repeated_windows(letters, lengths, before, run, quarter, groups, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, l) of every window, l bytes left of its anchor, that another row of its group has too."""
    side = length - gram
    step = side // QUARTERS
    low = step * quarter
    sorter = SuffixSort(letters, before - low, lengths, groups)
    order, common = sorter.neighbours(sorter.order())
    rows_out, left_out = [], []
    flat_letters, base = letters.ravel(), np.arange(len(letters)) * letters.shape[1]
    for extra in range(step + 1):
        l = low + extra
        has = ((l <= before) & (l >= before - run + 1))[order]
        # Rows of one run in suffix order agree from the shared left edge to the window's end.
        need = length - extra
        fresh = np.append(True, common[1:] < need)
        cls = np.cumsum(fresh)
        rows = order[has]
        if len(rows) < 2:
            continue
        left = (sorter.prefix[base[rows] + before[rows] - low[rows]] - sorter.prefix[base[rows] + before[rows] - l[rows]]) * sorter.inverse[base[rows] + before[rows] - l[rows]]
        pair = np.stack([cls[has].astype(np.uint64), left], 1)
        by = np.lexsort((pair[:, 1], pair[:, 0]))
        same = (pair[by][1:] == pair[by][:-1]).all(1)
        if extra and same.any():  # verify the left bytes
            x, y = rows[by[:-1][same]], rows[by[1:][same]]
            off = np.arange(extra)
            equal = (
                flat_letters[(base[x] + before[x] - l[x])[:, None] + off] == flat_letters[(base[y] + before[y] - l[y])[:, None] + off]
            ).all(1)
            same[np.flatnonzero(same)[~equal]] = False
        hit = np.zeros(len(rows), bool)
        hit[1:] |= same
        hit[:-1] |= same
        rows_out.append(rows[by[hit]])
        left_out.append(l[rows[by[hit]]])
    if not rows_out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows_out), np.concatenate(left_out)


def _ranges(rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, start) pairs as runs of consecutive starts: row, first, last."""
    if not len(rows):
        return rows, starts, starts
    order = np.lexsort((starts, rows))
    r, s = rows[order], starts[order]
    new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (s[1:] > s[:-1] + 1)))
    last = np.append(new[1:], len(r)) - 1
    return r[new], s[new], s[last]


def matched_contexts(ctx: DataFrame, length: int, gram: int, group_rows: int) -> DataFrame:
    """(id, crc, start, stop): runs of windows of different contexts that are equal, as byte spans."""
    keys = quarter_keys(ctx, length, gram)
    members = F.count(F.lit(1)).over(Window.partitionBy("key"))
    met = materialize(keys.withColumn("members", members).filter("members > 1"))
    filled = met.join(ctx.select("ah", "ch", "id", "crc", "start", "run", "before", "bytes"), ["ah", "ch"])
    columns = ["key", "quarter", "id", "crc", "start", "run", "before", "bytes"]

    def compared(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key, quarter, start, run, before = (np.asarray(batch.column(c)).astype(np.int64) for c in (0, 1, 4, 5, 6))
        letters, lengths = _padded(batch.column(7))
        _, groups = np.unique(key, return_inverse=True)
        rows, left = repeated_windows(letters, lengths, before, run, quarter, groups, length, gram)
        row, first, last = _ranges(rows, start[rows] + before[rows] - left)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column(2).take(take), batch.column(3).take(take), pa.array(first.astype(np.int32)), pa.array((last + length).astype(np.int32))],
            names=["id", "crc", "start", "stop"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive sorted by key; whole groups are compared some thousand rows at a time.
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            key = np.asarray(rest.column(0))
            cut = int(np.searchsorted(key, key[-1]))
            if cut >= 4096:
                yield from compared(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield from compared(rest)

    kind = "id long, crc long, start int, stop int"
    sorted_rows = filled.filter(F.col("members") <= group_rows).select(*columns).repartition("key").sortWithinPartitions("key")
    small = sorted_rows.mapInArrow(task, kind)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "bytes", 1 << 20):
            data, offsets = flat(piece.column(7))
            prefix = prefix_hashes(data)
            run = np.asarray(piece.column(5)).astype(np.int64)
            rows = np.repeat(np.arange(piece.num_rows), run)
            inside = ragged(np.zeros(len(run), np.int64), run)
            h = span_hashes(prefix, offsets[rows] + inside, offsets[rows] + inside + length)
            take = pa.array(rows)
            start = np.asarray(piece.column(4)).astype(np.int64)[rows] + inside
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(h).view(np.int64)), pa.array(mix(h ^ np.uint64(0x5555)).view(np.int64)), piece.column(2).take(take), piece.column(3).take(take), pa.array(start.astype(np.int32))],
                names=["h1", "h2", "id", "crc", "start"],
            )

    crowded = filled.filter(F.col("members") > group_rows).select(*columns).dropDuplicates(["id", "crc", "start"])
    opened = crowded.mapInArrow(windows, "h1 long, h2 long, id long, crc long, start int")
    counted = opened.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = opened.join(counted.select("h1", "h2"), ["h1", "h2"], "left_semi").select("id", "crc", "start", (F.col("start") + length).alias("stop"))
    return small.unionByName(large)


def repeated_spans(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, crc, start, stop): byte spans that cover every repeated ``length``-byte string; they may overlap."""
    gram = length // 2
    dealt = anchors(docs, length, gram, doc_id, text).repartition("ah")
    same = Window.partitionBy("ah", "ch")
    counted = dealt.withColumn("n", F.count(F.lit(1)).over(same)).withColumn("nth", F.row_number().over(same.orderBy("id", "crc", "start")))
    counted = counted.withColumn("all", F.count(F.lit(1)).over(Window.partitionBy("ah")))
    live = materialize(counted.filter("all > 1"))
    span = (F.col("start") + F.col("run") - 1 + length).cast("int")
    whole = live.filter("n > 1").select("id", "crc", "start", span.alias("stop"))
    wanted = live.filter("nth = 1 AND all > n").select("id", "crc", "start", "run", "before", "ah", "ch")
    ctx = contexts(docs, wanted, length, doc_id, text)
    return whole.unionByName(matched_contexts(ctx, length, gram, group_rows))


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary, kept_sha256): every row without its repeated bytes.

    ``kept`` are bytes, since a span may begin inside a character.
    """
    spans = repeated_spans(docs, length, doc_id, text, group_rows)
    listed = spans.groupBy("id", "crc").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    rows = _rows(docs, doc_id, text)
    met = rows.join(listed.hint("shuffle_hash"), ["id", "crc"], "left").select("name", "text", "spans")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            sizes, removed, runs, kept, digests = [], [], [], [], []
            spans = piece.column(2)
            for row in range(piece.num_rows):
                data = piece.column(1)[row].as_buffer().to_pybytes()
                out, at, count, gone = [], 0, 0, 0
                stop = -1
                for s in spans[row].as_py() or []:
                    if s["start"] > stop:
                        count += 1
                        out.append(data[at : s["start"]])
                        gone += s["stop"] - s["start"]
                        stop = s["stop"]
                    elif s["stop"] > stop:
                        gone += s["stop"] - stop
                        stop = s["stop"]
                    at = stop
                out.append(data[at:])
                rest = b"".join(out)
                sizes.append(len(data))
                removed.append(gone)
                runs.append(count)
                kept.append(rest)
                digests.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    out = met.mapInArrow(task, "id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.withColumnRenamed("id", doc_id)
