"""Quality rules as a bitmask ledger (DataFrame operations only).

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose bit i says that rule i
failed. A policy is a versioned mask of rules that reject; applying another version, or asking what a rule contributes,
reads the ledger and never the texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

MIN_WORDS = 50
MAX_REPEAT = 50  # percent of words in repeated three-word windows
MAX_SYMBOLS = 10  # symbols per 100 word characters
MAX_DUP_LINES = 50  # percent of lines with a word
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 20  # mean code points per word


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _rules() -> dict[str, Column]:
    """Name -> failure condition on the measurements; the position is the bit."""
    n = F.col("n_words")
    return {
        "few_words": n < MIN_WORDS,
        "repeated_windows": 100 * F.col("n_repeat_words") > MAX_REPEAT * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars"),
        "duplicate_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"),
        "word_length": (F.col("word_chars") < MIN_WORD_CHARS * n) | (F.col("word_chars") > MAX_WORD_CHARS * n),
    }


RULES = ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length")
BASE_RULES = ("few_words", "repeated_windows")
#: Version -> rules that reject. Versions are never changed, only added.
POLICIES = {1: BASE_RULES, 2: RULES}


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES.index(r) for r in rules)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    A null text counts as empty and has zero of everything. Column names that clash with the new ones are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACE))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    staged = docs.withColumns({
        "__words": F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES, -1)),
        "__lines": lines,
        "word_chars": F.length(F.regexp_replace(body, SPACES, "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
    })
    words = F.col("__words")
    staged = staged.withColumns({
        "n_words": F.size(words).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__windows": F.expr(
            "CASE WHEN size(__words) < 4 THEN CAST(array() AS array<bigint>) ELSE"
            " transform(sequence(0, size(__words) - 3), i -> xxhash64(__words[i], __words[i + 1], __words[i + 2])) END"
        ),
    })
    # Only texts with an equal pair of hashes are looked at more closely. There a window is the long (hash << s) | position
    # with just enough low bits s for the positions, so that a primitive sort brings equal windows together.
    staged = staged.withColumns({
        "__mask": F.expr("shiftleft(1L, CAST(ceil(log2(size(__words) + 2.0D)) AS int)) - 1L"),
        "__repeats": F.size(F.array_distinct("__windows")) < F.size("__windows"),
    })
    staged = staged.withColumn("__codes", F.expr(
        "CASE WHEN __repeats THEN sort_array(transform(__windows, (h, i) -> (h & ~__mask) | CAST(i AS bigint)))"
        " ELSE CAST(array() AS array<bigint>) END"
    ))
    # A position is repeated when the code before or after it carries the same hash and the same three words.
    same = (
        "(__codes[{a}] & ~__mask) = (__codes[{b}] & ~__mask)"
        " AND slice(__words, CAST(__codes[{a}] & __mask AS int) + 1, 3) = slice(__words, CAST(__codes[{b}] & __mask AS int) + 1, 3)"
    )
    hits = F.expr(
        "sort_array(transform(filter(sequence(0, size(__codes) - 1), i ->"
        f" (i > 0 AND {same.format(a='i', b='i - 1')}) OR (i < size(__codes) - 1 AND {same.format(a='i', b='i + 1')})),"
        " i -> CAST(__codes[i] & __mask AS int)))"
    )
    staged = staged.withColumn("__hits", F.when(F.size("__codes") == 0, F.array().cast("array<int>")).otherwise(hits))
    # Windows of three words starting at the sorted positions cover 3 words each, less where the next starts earlier.
    covered = F.expr(
        "CASE WHEN size(__hits) = 0 THEN 0L ELSE"
        " aggregate(sequence(0, size(__hits) - 1), 3L, (n, i) -> n + CASE WHEN i = 0 THEN 0 ELSE least(3, __hits[i] - __hits[i - 1]) END) END"
    )
    computed = staged.withColumn("n_repeat_words", covered)
    # A later filter must not be pushed below the measurements: it would be rewritten in terms of the text and evaluate
    # them again for every element. Filters on what a generator returns stay above it.
    rest = [c for c in docs.columns if c not in MEASURES]
    return computed.select(*rest, F.explode_outer(F.array(F.struct(*MEASURES))).alias("__m")).select(*rest, "__m.*")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``fail_bits``; each rule is evaluated once."""
    measured = measure(docs, text)
    conditions = _rules()
    bits = [F.when(conditions[name], F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, name in enumerate(RULES)]
    return measured.withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits))


def apply_policy(book: DataFrame, version: int = 2) -> DataFrame:
    """Add ``base_failed`` and ``kept`` under a policy version."""
    bits = F.col("fail_bits")
    return book.withColumns({
        "base_failed": bits.bitwiseAND(F.lit(mask_of(BASE_RULES))) != 0,
        "kept": bits.bitwiseAND(F.lit(mask_of(POLICIES[version]) | mask_of(BASE_RULES))) == 0,
    })


def ablation(book: DataFrame, version: int = 2, by: tuple[str, ...] = ()) -> DataFrame:
    """What each rule of a policy does: rows it fails, rows that only it rejects, rows kept in all.

    The ledger is first counted by distinct bit patterns (at most 2^rules per group), so no key carries many rows.
    """
    mask = mask_of(POLICIES[version])
    patterns = book.groupBy(*by, F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of((r,))).cast("long").alias("bit")) for r in POLICIES[version]])
    each = patterns.select(*by, "bits", "n", F.explode(rules).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(*by, F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_by_this"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("kept"),
        F.sum("n").alias("rows"),
    )


#: The query over ``documents`` in DuckDB.
CHECK_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + j AS p FROM r, (VALUES (0), (1), (2)) AS o(j)) GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * n_symbols > 10 * word_chars THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END) AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, bits = 0 AS kept,
  n_lines, CAST(bits AS BIGINT) AS fail_bits
FROM f
"""
