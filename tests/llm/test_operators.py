"""The operators on training text against plain versions, on tables with every awkward row."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonalis.llm import (
    compression_quality,
    context_mixing,
    decontaminate,
    mixing,
    near_duplicates,
    quality_rules,
    quotation,
    records,
    repeated_spans,
    sharding,
)
from zonalis.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, id long, n_words string, h double, shard string, score string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "re", "ti", "on", "é", "st", "ou"]) for _ in range(1 + r.randrange(vocabulary) % 4)) for _ in range(n))


def rows() -> list[tuple]:
    a, b = prose(1, 120), prose(2, 90)
    words = a.split(" ")
    near = " ".join([*words[:60], "CHANGED", *words[61:]])
    texts = {
        0: None, 1: "", 2: " \t\n\x0b ", 3: a, 4: a, 5: near, 6: prose(3, 20_000), 7: b, 8: b + "\n" + a, 9: "ein Wort", 10: "ein Wort",
        11: "x", 12: "Ünïcödé ТЕКСТ 漢字    wide　space <|endoftext|> don't  stop", 13: "line\nline\nline\n\nother\n", 14: "tick " * 300,
        15: "# * $ % & | < > " * 40, 16: prose(4, 80) + " " + prose(5, 13), 17: prose(5, 13).upper(), 18: "a" * 450, 19: prose(6, 70),
    }
    out = [(i, t, ["en", "de", None][i % 3], [None, "s1", "s2", "s10"][i % 4], None if t is None else len(t)) for i, t in texts.items()]
    out.append(out[3])  # a repeated row
    return [(*r, 1, "x", 2, "y", 0.5, "z", "w") for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(table) -> list[tuple[int, bytes]]:
    return [(r[0], (r[1] or "").encode()) for r in table.select("doc_id", "text").collect()]


def test_rules_measure_every_row(docs, empty):
    got = {r["doc_id"]: r for r in quality_rules.apply_policy(quality_rules.ledger(docs)).collect()}
    for name, text in texts_of(docs):
        words = WORD.findall(text)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = Counter(grams)
        covered = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(3)}
        lines = [x for x in text.decode().split("\n") if WORD.search(x.encode())]
        r = got[name]
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text.decode()))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(covered)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r["base_failed"] == failed and (not failed or not r["kept"])
    assert quality_rules.apply_policy(quality_rules.ledger(empty)).count() == 0


def test_ablation_counts_by_bits(docs):
    book = quality_rules.ledger(docs).select("fail_bits").cache()
    bits = [r[0] for r in book.collect()]
    for r in quality_rules.ablation(book).collect():
        bit = quality_rules.mask_of((r["rule"],))
        assert r["failed"] == sum(bool(b & bit) for b in bits)
        assert r["only_by_this"] == sum(b == bit for b in bits)
        assert r["kept"] == sum(b == 0 for b in bits) and r["rows"] == len(bits)


def components_by_force(texts: list[tuple[int, bytes]], k: int) -> dict[int, tuple[int, int]]:
    sets = {}
    for name, text in texts:
        words = WORD.findall(text.translate(LOWER))
        sets[name] = {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("block_rows", [1000, 2])
def test_near_duplicates_by_force(spark, docs, block_rows):
    family = []
    base = prose(50, 150).split(" ")
    for n in range(12):  # each shares most of the base; neighbours link, ends need not
        words = list(base)
        for j in range(4 * n, 4 * n + 4):
            words[j * 3 % 150] = f"w{n}x{j}"
        family.append((100 + n, " ".join(words)))
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(family, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(table, words=4, block_rows=block_rows).collect()}
    assert got == components_by_force(texts_of(table), 4)


def test_near_duplicates_of_nothing(empty):
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_every_pair_within_the_distance_shares_a_key():
    r = random.Random(0)
    width = near_duplicates.SYMBOLS // near_duplicates.CHUNKS
    for _ in range(200):
        changed = set(r.sample(range(near_duplicates.SYMBOLS), near_duplicates.DISTANCE))
        assert any(len([s for s in changed if s // width == c]) <= near_duplicates.CHUNK_ERRORS for c in range(near_duplicates.CHUNKS))


def contamination_by_force(texts, items):
    windows = {}
    for item, text in items:
        words = ALNUM.findall((text or "").encode().translate(LOWER))
        n = min(13, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    out = {}
    for name, text in texts:
        words = ALNUM.findall(text.translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        out[name] = (len(words), len(hit), len(found), sorted(str(f) for f in found if f is not None))
    return out


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_decontamination_by_force(spark, docs, limit):
    items = [(1, prose(5, 13)), (2, prose(1, 120)[:300]), (3, "ein Wort"), (4, None), (5, ""), (6, "tick tick"), (7, "漢字"), (8, prose(90, 40)), (None, "x")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    report, hits = decontaminate.contamination(docs, tests, broadcast_limit=limit)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items"]) for r in report.collect()}
    assert got == contamination_by_force(texts_of(docs), items)
    assert hits.columns == ["id", "text_key", "n", "at", "item"]


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_decontamination_tells_rows_apart(spark, limit):
    bench = prose(5, 13)
    texts = [(1, bench), (1, prose(200, 10)), (1, bench), (2, f"{prose(300, 40)} {bench}"), (None, f"{prose(400, 400)} {bench}"), (None, None), (None, prose(500, 20)), (3, f"{prose(600, 20_000)} {bench}")]
    table = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"id": F.lit("clash"), "n": F.lit(1), "text_key": F.lit("clash"), "marks": F.lit(0)})
    items = spark.createDataFrame([(9, bench), (None, bench)], "item_id long, text string")
    report, _ = decontaminate.contamination(table, items, broadcast_limit=limit)
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"]) for r in report.collect())
    found = (13, 2, ("9",))
    assert got == Counter([
        (1, 13, *found, True), (1, 10, 0, 0, (), False), (1, 13, *found, True), (2, 53, *found, True), (None, 413, *found, False),
        (None, 0, 0, 0, (), False), (None, 20, 0, 0, (), False), (3, 20_013, *found, False),
    ])


def test_decontamination_of_nothing(docs, empty, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none)[0].filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(empty, none)[0].count() == 0


def test_budget_is_fitted_exactly_where_sizes_allow():
    r = random.Random(1)
    for _ in range(60):
        sizes = np.array(sorted(r.sample(range(1, 60), 6)))
        counts = np.array([r.randrange(0, 5) for _ in sizes])
        total = int((sizes * counts).sum())
        budget = r.randrange(0, total + 1)
        reach = {0}
        for s, n in zip(sizes.tolist(), counts.tolist(), strict=True):
            reach = {v + k * s for v in reach for k in range(n + 1)}
        take = mixing.fit_budget(sizes, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        floor = np.array([int(c) * budget // total if total else 0 for c in counts])
        left = budget - int((floor * sizes).sum())
        best = {0}
        for s, n in zip(sizes.tolist(), (counts - floor).tolist(), strict=True):
            best = {v + k * s for v in best for k in range(n + 1)}
        assert int((take * sizes).sum()) == int((floor * sizes).sum()) + max(v for v in best if v <= left)


def test_targets_stop_and_are_shared_again():
    assert mixing.share_out([10, 1000, 1000], [3, 1, 2], 1500) == pytest.approx([20, 1480 / 3, 2960 / 3])
    assert mixing.share_out([], [], 0) == []


def test_mix_comes_near_its_targets(docs, empty):
    mixed = mixing.mix(docs).cache()
    again = {(r["doc_id"], r["repeats"]) for r in mixing.mix(docs).collect()}
    got = mixed.collect()
    assert {(r["doc_id"], r["repeats"]) for r in got} == again and len(got) == docs.count()
    for name, text in texts_of(docs):
        assert {r["size"] for r in got if r["doc_id"] == name} == {len(WORD.findall(text))}
    by = {}
    for r in got:
        assert 0 <= r["repeats"] <= 2
        by.setdefault(r["source"], []).append(r)
    for part in by.values():
        taken, most = sum(r["size"] * r["repeats"] for r in part), max(r["size"] for r in part)
        assert part[0]["target"] - most - 1 <= taken <= part[0]["target"]
    assert mixing.mix(empty).count() == 0


def test_hot_sizes_are_numbered_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    table = spark.range(400).selectExpr("id AS doc_id", "'one two three' AS text", "if(id < 300, 'a', 'b') AS source")
    by = {r[0]: r[1:] for r in mixing.mix(table).groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")), F.max("target"), F.max("repeats")).collect()}
    for taken, target, most in by.values():
        assert 0 <= target - taken <= 3 and most <= 2


def test_records_round_trip(docs, empty, tmp_path, spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file())
    nameless = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("no id"))
    table = docs.unionByName(nameless)
    got = records.tokenize_to_records(table, tokenizer_file(), path=f"file://{tmp_path}/out", shard_bytes=40_000).collect()
    expected = sorted(((i is not None, i or 0, t.decode()) for i, t in texts_of(table)))
    start = 0
    for r, (has, name, text) in zip(sorted(got, key=lambda r: r["start"]), expected, strict=True):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (name if has else None, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len({r["shard"] for r in got}) > 1
    assert records.tokenize_to_records(empty, tokenizer_file()).count() == 0


def test_fresh_chunks_are_encoded_together(monkeypatch):
    coder = records.ChunkEncoder(tokenizer_file())
    odd = ["", " ", "a  b", "end \n", "\n next", "été là", "it's 10% of\u00a0it", "<|endoftext|> and <|endoftext|>x", "tab\t x", "\u3000 y", "z"]
    texts = odd + [prose(seed, 60) for seed in range(20)] + odd[::-1]
    whole = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    calls = []

    class Counted:
        def encode_batch_fast(self, parts, add_special_tokens):
            calls.extend(parts)
            return tokenizer.encode_batch_fast(parts, add_special_tokens=add_special_tokens)

    tokenizer, coder.tokenizer = coder.tokenizer, Counted()
    ids, counts = coder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in whole for i in t] and counts.tolist() == list(map(len, whole))
    assert len(calls) * 4 < len(coder.known)
    monkeypatch.setattr(records, "JOINED_BYTES", 64)
    coder.clear()
    assert coder.encode(pa.array(texts))[0].tolist() == ids.tolist()
    coder.clear()
    coder.sizes = coder.sizes + 1  # tokens that do not spell their chunks
    assert coder.encode(pa.array(texts))[0].tolist() == ids.tolist()


def test_damaged_records_are_refused():
    good = records.frame(b"payload") + records.frame(b"")
    assert [bytes(p) for _, p in records.unframe(memoryview(good))] == [b"payload", b""]
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(memoryview(bytes(bad))))
    with pytest.raises(ValueError):
        list(records.unframe(memoryview(good[:-1])))


def test_shards_are_even_and_gapless(spark, docs, empty):
    many = spark.range(4000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, repeat('same text ', 20), repeat(concat('w', id), 1 + CAST(id % 40 AS INT))) AS text"
    )
    for table, shards in ((many, 16), (docs, 3)):
        got = sharding.shard(table, shards).collect()
        assert len(got) == table.count()
        sizes, slots = Counter(), {}
        for r in got:
            text = (r["text"] or "").encode()
            assert r["size"] == len(text) + 1 and r["text_crc32"] == zlib.crc32(text)
            sizes[r["shard"]] += r["size"]
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        ideal, largest = sum(sizes.values()) / shards, max(r["size"] for r in got)
        assert all(abs(n - ideal) <= max(0.01 * ideal, 2 * largest) for n in sizes.values())
    assert sharding.shard(empty).count() == 0


def test_shards_lie_like_a_plain_sort(spark):
    """Splitters stand where the sorted rows' running bytes come nearest to the ideal places, within the tolerance."""
    table = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('w', id), 1 + CAST(id % 25 AS INT)) AS text").unionByName(
        spark.createDataFrame([(None, None), (None, ""), (7, "x" * 300_000)], "doc_id long, text string")
    )
    clashing = table.withColumns({c: F.lit(c) for c in ("h1", "is1", "h2", "is2", "n", "cell", "size", "slot", "shard", "bytes")})
    got = sharding.shard(clashing, 5).select("doc_id", "size", "shard", "slot", "h1", "is1", "cell", "bytes").collect()
    assert len(got) == 3003 and all((r["h1"], r["is1"], r["cell"], r["bytes"]) == ("h1", "is1", "cell", "bytes") for r in got)
    rows = sorted((r["__key"], r["size"]) for r in sharding.keyed(table, "doc_id", "text").select("__key", "size").collect())
    below, edges = 0, {0}
    for i, (key, size) in enumerate(rows):
        if i and key != rows[i - 1][0]:
            edges.add(below)
        below += size
    total, (keys, bytes_below) = below, sharding.splitters(sharding.keyed(table, "doc_id", "text").select("__key", "size"), 5)
    for i, (key, position) in enumerate(zip(keys, bytes_below, strict=True), 1):
        goal = total * i / 5
        assert position == sum(size for k, size in rows if k < key)
        nearest = min(abs(e - goal) for e in edges | {total})
        assert abs(position - goal) <= nearest + sharding.TOLERANCE * total / 5


def removal_by_force(texts, length):
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for name, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        rest = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        runs = int(np.count_nonzero(gone[:-1] & ~np.append(False, gone[:-2]))) if len(t) else 0
        out.append((name, len(t), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group_rows", [20_000, 1])
def test_repeats_by_force(spark, docs, group_rows):
    shared = prose(70, 60)[:230]
    extra = [(200 + n, prose(80 + n, 10) + shared[n : 200 + 3 * n] + prose(120 + n, 10)) for n in range(10)]
    table = docs.filter("doc_id <> 6").select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeated_spans.remove_repeats(table, group_rows=group_rows).collect())
    assert got == removal_by_force(texts_of(table), 200)


def test_repeats_of_nothing(empty):
    assert repeated_spans.remove_repeats(empty).count() == 0


def test_suffix_sort_orders_and_finds_extensions():
    r = random.Random(5)
    letters = np.array([[r.choice(b"ab") for _ in range(40)] for _ in range(300)], np.uint8)
    ends = np.array([r.randrange(20, 41) for _ in range(300)])
    groups = np.array([r.randrange(7) for _ in range(300)])
    s = repeated_spans.SuffixSort(letters, np.full(300, 3), ends, groups)
    order, common = s.neighbours(s.order())
    suffix = [letters[i, 3 : ends[i]].tobytes() for i in range(300)]
    assert [(groups[i], suffix[i]) for i in order] == sorted((groups[i], suffix[i]) for i in range(300))
    for k in range(1, 300):
        a, b = suffix[order[k - 1]], suffix[order[k]]
        same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert common[k] == (same if groups[order[k]] == groups[order[k - 1]] else -1)


def test_compression_tells_good_from_bad(spark, docs, empty):
    made = [(1000 + n, prose(n, 150) if n % 3 else ("buy!! now** " * 30 + prose(n, 20).upper() + "!!"), int(n % 3 > 0)) for n in range(240)]
    table = spark.createDataFrame(made, "doc_id long, text string, quality int")
    scorer = compression_quality.fit(table, table.filter("doc_id < 1180").select("doc_id", "quality"), "quality")
    held = compression_quality.score(table.filter("doc_id >= 1180"), scorer).join(table.select("doc_id", "quality"), "doc_id").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in held]) > 0.9
    everything = compression_quality.score(docs, scorer).collect()
    assert len(everything) == docs.count() and all(0 <= r["score"] <= 1 for r in everything)
    blank = compression_quality.fit(table, table.select("doc_id", "quality").limit(0), "quality")
    assert {r["score"] for r in compression_quality.score(docs, blank).collect()} == {0.5}
    assert compression_quality.score(empty, scorer).count() == 0


def test_compression_is_calibrated_on_whole_texts(spark, monkeypatch):
    made = [(n, prose(n, 4000 if n % 4 < 2 else 100) if n % 2 else prose(n, 4000 if n % 4 < 2 else 100).upper(), n % 2) for n in range(120)]
    table = spark.createDataFrame(made, "doc_id long, text string, quality int")
    fitted, calibrate = [], compression_quality.calibrate
    monkeypatch.setattr(compression_quality, "calibrate", lambda x, *rest: fitted.append(x) or calibrate(x, *rest))
    compression_quality.fit(table, table.select("doc_id", "quality"), "quality")
    lengths = np.expm1(fitted[0][:, 6] * 5)
    whole = {len(text.encode()) for _, text, _ in made}
    assert lengths.max() > 2 * compression_quality.PIECE and {round(x) for x in lengths} <= whole


def test_compression_scores_by_force(spark):
    """Ids shared by many documents, clashing columns; scores equal those of the plain sizes under both dictionaries."""
    import zstandard

    rows = [(n % 150, prose(7 * n % 300, 60) if n % 2 else " ".join(f"zq{(n * k) % 97}" for k in range(70))) for n in range(300)]
    rows += [(1, f"again {n} {prose(n, 40)}") for n in range(200)] + [(1, rows[1][1])] * 50 + [(None, None), (None, ""), (5, prose(3, 3000))]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("id", "y", "o", "x", "t", "one")})
    labels = spark.createDataFrame([(n, n % 2) for n in range(150)], "doc_id long, quality int")
    scorer = compression_quality.fit(table, labels, "quality")
    assert scorer.weights is not None
    plain = [zstandard.ZstdCompressor(level=compression_quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (scorer.good, scorer.bad)]
    expected = []
    for name, text in rows:
        body = (text or "").encode()
        pieces = [body[i : i + compression_quality.PIECE] for i in range(0, len(body), compression_quality.PIECE)]
        sizes = [len(body), *(sum(len(c.compress(p)) for p in pieces) for c in plain)]
        value = float(compression_quality.Scorer.features(np.array([sizes], float))[0] @ scorer.weights)
        expected.append((-1 if name is None else name, *sizes, round(1 / (1 + np.exp(-np.clip(value, -30, 30))), 9)))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["good_size"], r["bad_size"], round(r["score"], 9)) for r in compression_quality.score(table, scorer).collect()]
    assert sorted(got) == sorted(expected)


def test_context_mixing_counts_and_leaks_nothing(spark, docs, empty):
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    got = {r["doc_id"]: r for r in context_mixing.score_texts(docs, learn, kind="lang").collect()}
    train, counts = 0, Counter()
    for name, text in texts_of(docs):
        if zlib.crc32(str(name).encode()) % 5 != 1:
            counts.update([*WORD.findall(text.translate(LOWER)), b"\n"])
    train, distinct = sum(counts.values()), len(counts)
    base = Counter()
    for name, text in texts_of(docs):
        for w in [*WORD.findall(text.translate(LOWER)), b"\n"]:
            base[name] += math.log10((counts[w] + 0.5) / (train + 0.5 * (distinct + 1)))
    for name, r in got.items():
        assert r["train_tokens"] == train and r["base_score"] == pytest.approx(base[name], rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    other = docs.withColumn("text", F.when(learn, F.col("text")).otherwise(F.concat(F.lit("something else "), F.coalesce("text", F.lit("")))))
    after = {r["doc_id"]: r["score"] for r in context_mixing.score_texts(other, learn, kind="lang").collect()}
    for name, r in got.items():
        if zlib.crc32(str(name).encode()) % 5 != 1:
            assert after[name] == pytest.approx(r["score"], rel=1e-6)
    assert context_mixing.score_texts(empty, learn).count() == 0


def test_context_mixing_spells_frequent_words(spark):
    texts = [(n, "and ant any man an qz", "en") for n in range(12)] + [(100, "an", "en"), (101, "qz", "en")]
    scored = context_mixing.score_texts(spark.createDataFrame(texts, "doc_id long, text string, lang string"), F.col("doc_id") < 100, kind="lang")
    got = {r["doc_id"]: r for r in scored.collect()}
    assert got[100]["base_score"] == got[101]["base_score"] and abs(got[100]["score"] - got[101]["score"]) > 1e-9


def test_context_mixing_reads_texts_in_order(spark):
    r = random.Random(5)
    follow = {w: [prose(100 + 3 * w + j, 1, 9) for j in range(3)] for w in range(30)}
    def ordered(n): return [x for w in (r.randrange(30) for _ in range(n)) for x in follow[w]]
    texts = [(n, " ".join(ordered(60)), "en") for n in range(80)]
    for n in range(20):
        words = ordered(60)
        texts += [(1000 + n, " ".join(words), "en"), (2000 + n, " ".join(r.sample(words, len(words))), "en")]
    scored = context_mixing.score_texts(spark.createDataFrame(texts, "doc_id long, text string, lang string"), F.col("doc_id") < 1000, kind="lang")
    got = {r["doc_id"]: r for r in scored.collect()}
    for n in range(20):
        assert got[1000 + n]["base_score"] == pytest.approx(got[2000 + n]["base_score"])
        assert got[1000 + n]["score"] > got[2000 + n]["score"] + 1


def test_tokens_are_looked_at_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(context_mixing, "PIECE_TOKENS", 10)
    lists = [[1] * n for n in (4, 6, 1, 25, 0, 0, 9, 1, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(lists) + 2)), pa.array([[9] * 50, [9] * 50, *lists])], names=["id", "at"]).slice(2)
    pieces = list(context_mixing.few_tokens(iter([batch, batch.slice(0, 0)]), "at"))
    assert [r for p in pieces for r in p.column(1).to_pylist()] == lists
    assert max(len(p.column(1).flatten()) for p in pieces if p.num_rows > 1) <= 10


def test_tables_are_worked_out_one_by_one():
    rng = np.random.default_rng(5)
    shape = (len(context_mixing.ORDERS), context_mixing.SLOTS)
    model = context_mixing.Model(*(rng.integers(0, 70, shape).astype(np.float32) for _ in range(2)))
    tracemalloc.start()
    odds, seen = model.tables(True)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 1.5 * held
    for value, (less_zeros, less_ones) in enumerate(((1, 0), (0, 1))):
        zeros, ones = np.maximum(model.zeros - np.float32(less_zeros), 0), np.maximum(model.ones - np.float32(less_ones), 0)
        at = slice(value * context_mixing.SLOTS, (value + 1) * context_mixing.SLOTS)
        assert np.allclose(odds[:, at], np.clip(np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4))), -12, 12))
        assert np.array_equal(seen[:, at], np.searchsorted([3, 15, 63], zeros[-2:] + ones[-2:], "right"))


def test_spelling_is_a_probability():
    model = context_mixing.Model(*(np.random.default_rng(0).integers(0, 9, (2, len(context_mixing.ORDERS), context_mixing.SLOTS)).astype(np.float32)))
    words = [bytes([b]) for b in range(1, 256) if b not in (9, 10, 11, 12, 13, 32)]
    first = 10 ** context_mixing.log_probability(model, [*words, b"\n", b""])
    assert 0 < first.sum() < 1


def test_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "user", "First point.\nSecond point."), (1, 1, "assistant", "> Second   POINT.\n\nI agree."), (1, 2, "user", "An aside."),
        (1, 3, "assistant", ">> second point.\n> I agree.\nAnd so do I."), (1, 4, "user", None), (1, 4, "user", None), (2, 0, None, "> nobody said this\n"),
        (2, 1, "user", ""), (3, 5, "user", ">"), (None, 0, "user", "x"), (4, None, "user", "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
    got = {(r["conv_id"], r["turn"]): r for r in quotation.conversations(table).collect()}
    assert len(got) == 8
    assert got[1, 1]["text"] == "I agree." and (got[1, 1]["parent_turn"], got[1, 1]["n_linked"]) == (0, 1)
    assert got[1, 3]["text"] == "And so do I." and (got[1, 3]["parent_turn"], got[1, 3]["n_quotes"], got[1, 3]["n_linked"]) == (1, 2, 2)
    assert [t for _, t in sorted((r["position"], r["turn"]) for k, r in got.items() if k[0] == 1)] == [0, 1, 2, 3, 4]
    assert (got[2, 0]["text"], got[2, 0]["n_quotes"], got[2, 0]["n_linked"], got[2, 0]["depth"]) == ("", 1, 0, 0)
    assert quotation.conversations(table.limit(0)).count() == 0


def links_by_force(rows):
    said, out = {}, {}
    for conv, turn, text in sorted(rows):
        lines = text.split("\n")
        quoted = [x[1:].strip().lower() for x in lines if x.startswith(">")]
        earlier = [t for q in quoted for t in said.get((conv, q), []) if t < turn]
        if quoted:
            out[conv, turn] = max(earlier, default=None)
        own = [x.lower() for x in lines if not x.startswith(">")]
        for piece in {*own, " ".join(own)}:
            said.setdefault((conv, piece), []).append(turn)
    return out


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 20])
def test_quotes_of_a_much_repeated_passage(spark, monkeypatch, rows_per_slice):
    from zonalis.plans import slices

    monkeypatch.setattr(slices.slice_width, "__defaults__", (rows_per_slice,))
    monkeypatch.setattr(slices, "DAY_SECONDS", 100)
    r = random.Random(3)
    rows = [(1, t, r.choice(["same words", "> Same words\nyes", "> yes\nno", f"own {t}", f"> own {t // 2}\nsame words"])) for t in range(400)]
    rows += [(2, t, r.choice(["same words", "> same words\nyes"])) for t in range(30)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("role", F.lit("user"))
    got = {(x["conv_id"], x["turn"]): x for x in quotation.conversations(table).collect()}
    assert len(got) == len(rows)
    for key, parent in links_by_force(rows).items():
        assert got[key]["n_linked"] == (parent is not None)
        assert got[key]["parent_turn"] == (parent if parent is not None else key[1] - 1 if key[1] else None)
    for conv in (1, 2):
        mine = sorted((x["depth"], x["turn"], x["position"]) for x in got.values() if x["conv_id"] == conv)
        assert [p for _, _, p in mine] == list(range(1, len(mine) + 1))
        assert all(d == (0 if got[conv, t]["parent_turn"] is None else got[conv, got[conv, t]["parent_turn"]]["depth"] + 1) for d, t, _ in mine)
