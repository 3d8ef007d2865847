"""Benchmark decontamination by winnowing.

Words are runs of digits, letters and non-ASCII characters with A-Z lowered. A window is ``WINDOW`` consecutive words of a
benchmark item; an item with fewer words is one window of its own length. Every occurrence of a window in a document is
found:

1. Fingerprints: of the hashes of all ``GRAM``-word grams, the smallest of each ``WINDOW - GRAM + 1`` neighbours is kept
   (the rightmost of equal ones). A span of ``WINDOW`` equal words has equal grams, so it shares a fingerprint.
   Windows of n < ``WINDOW`` words are winnowed with n-word grams and one neighbour.
2. Training and test fingerprints are joined on their hash. Test fingerprints are stored and broadcast only while their
   files are small; otherwise both sides are shuffled.
3. Hits are extended: around a matched fingerprint all windows that hold it are hashed and joined to the windows of the
   items, which gives the exact places and the items.

Null texts and texts without words have no windows and are never hit. Documents are told apart by id and a hash of the text,
so ids may be null or shared: every row has its own result, and rows equal in both get equal ones. Repeated item ids count
once; items without an id count as one item that the list leaves out. Only the named columns are read, and other columns may
have any names. A very long text stands alone in its slice; its words are hashed as flat arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.near_duplicates import text_key
from zonalis.llm.textblock import IS_ALNUM, Words, gram_hashes, mix, ragged, slices, within
from zonalis.plans.materialize import fits_broadcast, materialize

WINDOW = 13
GRAM = 7
SHARE = 20  # contaminated when hit words are at least 1/20 of all words
BROADCAST = 16 << 20


def _grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every k-word gram inside a text."""
    hashes = gram_hashes(w.hashes, k)
    at = np.flatnonzero(within(w.word_offsets, k, len(hashes)))
    return at, hashes[at]


def winnow(w: Words, k: int, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of the kept grams: the smallest of each run of ``neighbours`` grams of one text."""
    at, hashes = _grams(w, k)
    if neighbours == 1 or not len(at):
        return at, hashes
    docs = w.doc_of(at)
    runs = len(at) - neighbours + 1
    if runs <= 0:
        return at[:0], hashes[:0]
    best = hashes[:runs].copy()
    place = np.arange(runs)
    for j in range(1, neighbours):
        better = hashes[j : j + runs] <= best
        best[better] = hashes[j : j + runs][better]
        place[better] = np.flatnonzero(better) + j
    inside = docs[:runs] == docs[neighbours - 1 :]
    kept = np.unique(place[inside])
    return at[kept], hashes[kept]


def _gram_sizes(n: int) -> tuple[int, int]:
    return (GRAM, WINDOW - GRAM + 1) if n == WINDOW else (n, 1)


def _tag(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of different window lengths are kept apart."""
    return mix(hashes + np.uint64(n * 0x10001)).view(np.int64)


def item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, n, window): the hash of every window of every item."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            w = Words(piece.column(1), IS_ALNUM)
            for n in np.unique(np.minimum(w.counts[w.counts > 0], WINDOW)):
                at, hashes = _grams(w, int(n))
                docs = w.doc_of(at)
                use = w.counts[docs] >= WINDOW if n == WINDOW else w.counts[docs] == n
                docs, hashes = docs[use], hashes[use]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(pa.array(docs)), pa.array(np.full(len(docs), n, np.int32)), pa.array(_tag(hashes, int(n)))],
                    names=["item", "n", "window"],
                )

    return items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(
        task, "item string, n int, window long"
    ).distinct()


def document_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, text_key, text): what tells rows apart, and what is searched."""
    return docs.select(F.col(doc_id).cast("long").alias("id"), text_key(text).alias("text_key"), F.col(text).alias("text"))


def on_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on id, null or not, and text_key, which are kept once."""
    other = right.withColumnsRenamed({"id": "__id", "text_key": "__text_key"})
    return left.join(other, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__text_key")), how).drop("__id", "__text_key")


def fingerprints(table: DataFrame, lengths: list[int], exact: bool) -> DataFrame:
    """(id, text_key, n, at, print) of a table (id, text_key, text) for windows of n words; ``exact``: only texts that have
    windows of that length as items."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            w = Words(piece.column(2), IS_ALNUM)
            for n in lengths:
                at, hashes = winnow(w, *_gram_sizes(n))
                docs = w.doc_of(at)
                if exact:
                    use = w.counts[docs] >= WINDOW if n == WINDOW else w.counts[docs] == n
                    at, hashes, docs = at[use], hashes[use], docs[use]
                rows = pa.array(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(rows), piece.column(1).take(rows), pa.array(np.full(len(docs), n, np.int32)),
                        pa.array((at - w.word_offsets[docs]).astype(np.int32)), pa.array(_tag(hashes, n)),
                    ],
                    names=["id", "text_key", "n", "at", "print"],
                )

    return table.mapInArrow(task, "id long, text_key long, n int, at int, print long")


def _extend(table: DataFrame) -> DataFrame:
    """(id, text_key, n_words, wins) of a table (id, text_key, text, marks): per document the windows around its matched
    fingerprints as structs (n, at, window)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            w = Words(piece.column(2), IS_ALNUM)
            marks = piece.column(3)
            rows = np.repeat(np.arange(piece.num_rows), np.diff(np.asarray(marks.offsets)) if len(marks) else 0)
            flat = marks.flatten()
            ns, ats = np.asarray(flat.field(0)), np.asarray(flat.field(1))
            got = [np.zeros((0, 3), np.int64)]
            tags = [np.zeros(0, np.int64)]
            for n in np.unique(ns):
                use = ns == n
                k, neighbours = _gram_sizes(int(n))
                first = ats[use].astype(np.int64) - (neighbours - 1) if n == WINDOW else ats[use].astype(np.int64)
                docs = rows[use]
                starts = ragged(first, np.full(len(first), neighbours))
                docs = np.repeat(docs, neighbours)
                ok = (starts >= 0) & (starts + n <= w.counts[docs])
                places = np.unique(starts[ok] + w.word_offsets[docs[ok]])
                if len(places):
                    hashes = gram_hashes(w.hashes, int(n))[places]
                    docs = w.doc_of(places)
                    got.append(np.stack([docs, np.full(len(docs), n), places - w.word_offsets[docs]], 1))
                    tags.append(_tag(hashes, int(n)))
            rows_out, tag = np.concatenate(got), np.concatenate(tags)
            order = np.argsort(rows_out[:, 0], kind="stable")
            rows_out, tag = rows_out[order], tag[order]
            offsets = np.searchsorted(rows_out[:, 0], np.arange(piece.num_rows + 1)).astype(np.int32)
            wins = pa.StructArray.from_arrays(
                [pa.array(rows_out[:, 1].astype(np.int32)), pa.array(rows_out[:, 2].astype(np.int32)), pa.array(tag)], names=["n", "at", "window"]
            )
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:2], pa.array(w.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), wins)],
                names=["id", "text_key", "n_words", "wins"],
            )

    return table.mapInArrow(task, "id long, text_key long, n_words long, wins array<struct<n: int, at: int, window: long>>")


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    broadcast_limit: int = BROADCAST,
) -> tuple[DataFrame, DataFrame]:
    """Per document row (doc_id, text_key, n_words, n_hit, n_items, items, contaminated), and the hits (id, text_key, n, at, item).

    ``items`` of the first table is the sorted array of item ids, which are compared as strings.
    """
    windows = materialize(item_windows(items, item_id, item_text))
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most WINDOW values
    tests = materialize(fingerprints(document_key(items.select(F.lit(None).alias("id"), F.col(item_text).alias("text")), "id", "text"), lengths, True).select("print").distinct())
    small = fits_broadcast(tests, broadcast_limit)
    key = ["id", "text_key"]
    whole = document_key(docs, doc_id, text)
    met = fingerprints(whole, lengths, False).join(F.broadcast(tests) if small else tests, "print", "left_semi")
    marks = materialize(met.select(*key, "n", "at").distinct().groupBy(*key).agg(F.collect_list(F.struct("n", "at")).alias("marks")))
    marked = on_key(whole, F.broadcast(marks) if fits_broadcast(marks, broadcast_limit) else marks, "left")
    empty = F.array().cast("array<struct<n: int, at: int>>")
    extended = materialize(_extend(marked.select(*key, "text", F.coalesce("marks", empty).alias("marks"))))
    places = extended.select(*key, F.explode("wins").alias("w")).select(*key, "w.n", "w.at", "w.window")
    known = F.broadcast(windows) if fits_broadcast(windows, broadcast_limit) else windows
    hits = materialize(places.join(known, ["n", "window"]).select(*key, "n", "at", "item").distinct())
    covered = F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1))
    words = hits.select(*key, "n", "at").distinct().select(*key, covered.alias("word")).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    found = hits.select(*key, "item").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    out = on_key(on_key(extended.select(*key, "n_words"), words, "left"), found, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    report = out.select(
        F.col("id").alias(doc_id), "text_key", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
    return report, hits


#: The query over ``documents`` and ``benchmark`` in DuckDB.
CHECK_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
x AS (SELECT item_id, words, least(len(words), 13) AS n FROM b WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS win
        FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM x)),
g AS (SELECT doc_id, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS win
      FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM win) AS l WHERE len(words) >= n)),
hit AS (SELECT doc_id, g.n, i, item_id FROM g JOIN win USING (n, win)),
c AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit)) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(words) AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""
