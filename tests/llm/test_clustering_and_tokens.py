"""Centroid clustering, removal of earlier windows and token alignment against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.llm import centroid_clustering, near_duplicates, repeated_spans, suffix_trees, token_alignment
from zonalis.llm.queries import tokenizer_file

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id long, k string, start string, name string, row string, pairs string, spans string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(["sol", "mar", "été", "haus", "riv"]) + r.choice("abcdefghij") + r.choice("xyz") for _ in range(n))


def frame(spark, texts: list[tuple]):
    return spark.createDataFrame([(i, t, 5, "a", "b", "c", "d", "e", "f") for i, t in texts], SCHEMA)


# --- clustering -----------------------------------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, width, key):
    kept = []
    for name, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((name, [math.floor(1024 * float(x)) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{key}{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(col) // len(groups[i]) for col in zip(*groups[i])] if i in groups else c for i, c in enumerate(centres)]
    return sorted(((str(n), *nearest(v)[::-1]) for n, v in kept), key=str), centres


@pytest.mark.parametrize("pivots", [1, 3, 16])
def test_clusters_equal_plain_ones(spark, pivots):
    r = random.Random(7)
    rows = [(i, [float(np.float32(r.gauss(i % 3, 0.3))) for _ in range(6)]) for i in range(150)]
    rows += [(1, rows[1][1]), (1, rows[1][1]), (None, rows[3][1]), (None, [0.0] * 6)]  # repeated rows and null ids
    rows += [(200, None), (201, []), (202, [0.5] * 5), (203, [0.5] * 7), (204, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (205, [float("nan")] * 6), (206, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance double, v string").repartition(4)
    labelled, centres = centroid_clustering.cluster_vectors(df, k=5, rounds=4, width=6, pivots=pivots)
    want, final = plain_clusters([(i, None if v is None else v) for i, v in rows], 5, 4, 6, "3:")
    got = sorted(((str(x.id), x.cluster, x.distance) for x in centroid_clustering.with_inertia(labelled, centres).collect()), key=str)
    assert centres == final and got == want
    full = centroid_clustering.with_inertia(labelled, centres).collect()
    assert {x.inertia for x in full} == {sum(w[2] for w in want)}
    for x in full:
        assert x.cluster_inertia == sum(w[2] for w in want if w[1] == x.cluster)
        assert x.centroid_sha256 == hashlib.sha256(",".join(map(str, final[x.cluster])).encode()).hexdigest()


def test_clusters_of_few_and_equal_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    labelled, centres = centroid_clustering.cluster_vectors(spark.createDataFrame([], kind), width=2)
    assert labelled.count() == 0 and centres == [] and centroid_clustering.with_inertia(labelled, centres).count() == 0
    same = spark.createDataFrame([(i, [0.25, -0.5]) for i in range(20)], kind)
    labelled, centres = centroid_clustering.cluster_vectors(same, width=2)
    assert {(x.cluster, x.distance) for x in labelled.collect()} == {(0, 0)} and len(centres) == 8  # ties: the smaller number


def test_bounds_keep_the_nearest_centroid():
    r = np.random.default_rng(3)
    for size in (1, 4, 12):
        points, centres = r.integers(-500, 500, (400, 10)), r.integers(-500, 500, (9, 10))
        centres[3] = centres[2]
        simplex = centroid_clustering.Simplex.of(centroid_clustering.choose_pivots(points[:50], size))
        cluster, distance = centroid_clustering.nearest_centroids(points, simplex.apexes(points), centres, simplex, True)
        exact = ((points[:, None] - centres[None]) ** 2).sum(2)
        assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    # With a full simplex the bounds meet, so hardly any other centroid is left to compare.
    simplex = centroid_clustering.Simplex.of(centroid_clustering.choose_pivots(points, 11))
    assert centroid_clustering.candidates(simplex.apexes(points), simplex.apexes(centres)).sum(1).mean() < 1.6


# --- earlier windows ------------------------------------------------------------------------------------------------------


def plain_removal(texts, window):
    """Documents are distinct (id, text) pairs, in order of id; ids are not shared by different texts here."""
    words = {i: WORD.findall((t or "").encode()) for i, t in texts}
    first = {}
    order = sorted(words, key=lambda i: (i is None, i or 0))
    for i in order:
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s : s + window]), (i, s))
    out = {}
    for i in order:
        gone = set()
        for s in range(len(words[i]) - window + 1):
            if first[tuple(words[i][s : s + window])] != (i, s):
                gone.update(range(s, s + window))
        kept = b" ".join(w for n, w in enumerate(words[i]) if n not in gone)
        out[i] = (len(words[i]), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def window_texts():
    a, b, c = prose(1, 120), prose(2, 60), prose(3, 25)
    words = a.split(" ")
    texts = {
        0: None, 1: "", 2: " \t\n ", 3: a, 4: a, 5: " ".join([*words[:60], "CHANGED", *words[61:]]), 6: prose(4, 9000), 7: b, 8: b + "\n\n " + a,
        9: "tick " * 300, 10: c + " " + prose(5, 30) + " " + c, 11: prose(6, 19), 12: prose(6, 19), 13: prose(7, 20), 14: prose(7, 20) + "\x01", 15: "x\x01 " + prose(7, 20),
    }
    out = list(texts.items())
    for n in range(40):  # one passage in many surroundings
        out.append((100 + n, prose(200 + n, 30 + n) + " " + c + " " + prose(300 + n, 25)))
    for n in range(12):  # near copies
        r = random.Random(n)
        out.append((200 + n, " ".join(w if r.random() > 0.03 else f"n{r.randrange(9)}" for w in b.split(" "))))
    return [*out, (None, a + " " + prose(9, 40))]


@pytest.mark.parametrize("group_rows,segment,hot", [(50_000, 4 << 20, 8), (8, 4 << 20, 8), (30, 3000, 1)])
def test_earlier_windows_by_force(spark, monkeypatch, group_rows, segment, hot):
    monkeypatch.setattr(suffix_trees, "SEGMENT", segment)
    monkeypatch.setattr(suffix_trees, "HOT_COUNT", hot)
    monkeypatch.setattr(suffix_trees, "SAMPLE", 64 if hot > 1 else 1)
    texts = window_texts()
    docs = frame(spark, texts).repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in suffix_trees.remove_earlier(docs, group_rows=group_rows).collect()}
    assert got == plain_removal(texts, 20)


def test_earlier_windows_of_repeated_rows_and_shared_ids(spark):
    a, b = prose(1, 50), prose(2, 50)
    docs = frame(spark, [(1, a), (1, a), (2, a), (3, b), (3, b + " " + a), (None, b), (None, b)])
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in suffix_trees.remove_earlier(docs).collect())
    assert got[(1, 50, 0)] == 2 and got[(2, 50, 50)] == 1 and got[(None, 50, 50)] == 2
    # Of two texts that share an id one comes first; b is removed from the other one.
    assert got[(3, 50, 0)] + got[(3, 50, 50)] == 1 and got[(3, 100, 50)] + got[(3, 100, 100)] == 1 and got[(3, 50, 0)] == got[(3, 100, 100)]
    assert suffix_trees.remove_earlier(frame(spark, [(1, a)]).limit(0)).count() == 0


def test_tree_nodes():
    suffixes = [b"a b c d ", b"a b c x ", b"a b q ", b"z ", b"a b c d e ", b"a b c d "]
    tree = suffix_trees.SuffixTree(suffixes, 2)
    found = {(tree.depth[n], frozenset(tree.order[tree.first[n] : tree.last[n] + 1])): n for n in range(len(tree.depth))}
    assert set(found) == {(2, frozenset({0, 1, 2, 4, 5})), (3, frozenset({0, 1, 4, 5})), (4, frozenset({0, 4, 5}))}
    assert tree.parent[found[4, frozenset({0, 4, 5})]] == found[3, frozenset({0, 1, 4, 5})]
    assert tree.parent[found[2, frozenset({0, 1, 2, 4, 5})]] == -1
    assert tree.earlier([(1, 5, 0), (1, 3, 0), (1, 1, 0), (1, 0, 0), (1, 2, 0), (1, 4, 0)]) == [4, 3, 0, 0, 2, 4]


# --- token alignment ------------------------------------------------------------------------------------------------------


def plain_alignment(texts, a_file, b_file):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
    a.encode_special_tokens = True
    letters = token_alignment.byte_letters()
    rows, links = [], []
    for text in texts:
        body = b" " + (text or "").encode()
        ia, ib = (a.encode(body.decode(), add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not text or b"".join(ba) != body or b"".join(bb) != body:
            rows.append((0, 0, 0, 0, ""))
            links.append([])
            continue
        ends = [{}, {}]
        for side, (ids, parts) in enumerate(((ia, ba), (ib, bb))):
            at = 0
            for i, p in zip(ids, parts):
                at += len(p)
                ends[side][at] = i
        mine = [(ends[0][e], ends[1][e]) for e in ends[0] if e in ends[1]]
        groups, ga, gb, at, bt = [], [], [], 0, 0
        ja, jb = iter(zip(ia, ba)), iter(zip(ib, bb))
        for e in sorted(set(ends[0]) & set(ends[1])):
            ga, gb = [], []
            while at < e:
                i, p = next(ja)
                at += len(p)
                ga.append(str(i))
            while bt < e:
                i, p = next(jb)
                bt += len(p)
                gb.append(str(i))
            groups.append(",".join(ga) + "|" + ",".join(gb))
        links.append(mine)
        rows.append((len(ia), len(ib), len(groups), len(mine), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(p for m in links for p in m)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(*r[:4], sum(counts[p] == best[p[1]] for p in m), sum(counts[p] for p in m), r[4]) for r, m in zip(rows, links)]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_alignment_by_force(spark, monkeypatch, limit):
    monkeypatch.setattr(token_alignment, "CACHE_CHUNKS", 900)
    texts = [
        None, "", " ", "a ", "  a  b ", "x\n\n y", "été à la crème ", "<|endoftext|> <s> </s> <unk>", "漢字　テスト 12", "don't  stop\t now", "ﬁne ﬁsh", "a\u0000b \u0001c", "😀 😀😀 x",
        "▁x ▁", "a\u0085 b  c  d", "а б вг", prose(1, 400), prose(1, 400), prose(2, 3000).replace(" ", "\n", 7), "word " * 500, "The quick brown fox. " * 20,
    ]
    docs = frame(spark, [(None if i % 9 == 0 else i // 2, t) for i, t in enumerate(texts)]).repartition(3)
    a_file, b_file = tokenizer_file(), tokenizer_file("piece_bpe_32k.model")
    aligned = token_alignment.align(docs, a_file, b_file)
    got = token_alignment.with_counts(aligned, token_alignment.pair_counts(aligned), limit=limit, hot_floor=10)
    rows = Counter((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect())
    want = plain_alignment(texts, a_file, b_file)
    assert rows == Counter((None if i % 9 == 0 else i // 2, *w) for i, w in enumerate(want))
    assert sum(w[0] > 0 for w in want) >= 15
    none = token_alignment.align(docs.limit(0), a_file, b_file)
    assert token_alignment.with_counts(none, token_alignment.pair_counts(none)).count() == 0


def test_overlaps_by_force():
    r = np.random.default_rng(1)

    def cut(totals):
        sizes, per = [], []
        for n in totals:
            ends = np.unique(np.append(r.integers(1, n + 1, n // 2), n))
            sizes.append(np.diff(ends, prepend=0))
            per.append(len(ends))
        return np.array(per), np.concatenate(sizes)

    totals = [5, 40, 1, 17]
    (a_per, a_sizes), (b_per, b_sizes) = cut(totals), cut(totals)
    of_a, of_b, together = token_alignment.overlaps(a_per, a_sizes, b_per, b_sizes)
    ea, eb = np.cumsum(a_sizes), np.cumsum(b_sizes)
    want = {(i, j, bool(ea[i] == eb[j])) for i in range(len(ea)) for j in range(len(eb)) if max(ea[i] - a_sizes[i], eb[j] - b_sizes[j]) < min(ea[i], eb[j])}
    got = list(zip(of_a.tolist(), of_b.tolist(), together.tolist()))
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("column", ["doc_id", "text"])
def test_all_null_columns(spark, column):
    docs = frame(spark, [(1, prose(1, 30)), (2, prose(1, 30))]).withColumn(column, F.lit(None).cast("long" if column == "doc_id" else "string"))
    assert suffix_trees.remove_earlier(docs).count() == 2
    aligned = token_alignment.align(docs, tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))
    assert token_alignment.with_counts(aligned, token_alignment.pair_counts(aligned)).count() == 2


def test_repeats_of_rows_without_id(spark):
    """Bytes of a text without an id are repeated like those of any other."""
    body = "".join(random.Random(5).choice("abcdefghij ") for _ in range(600))
    docs = frame(spark, [(None, body), (1, body), (2, "zz" + body), (None, "short")])
    got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in repeated_spans.remove_repeats(docs).collect())
    assert got == Counter({(None, 600, 600): 1, (1, 600, 600): 1, (2, 602, 600): 1, (None, 5, 0): 1})


def test_block_without_repeats_has_no_runs():
    none = np.zeros(0, np.int64)
    assert [len(part) for part in repeated_spans._ranges(none, none)] == [0, 0, 0]


@pytest.mark.parametrize("block_rows", [1000, 40])
def test_large_group_of_near_copies_leaves_few_links(spark, monkeypatch, block_rows):
    """Near copies of one text, exact copies, and different texts that share an id."""
    r, base = random.Random(4), prose(1, 160).split(" ")
    texts = [(n, " ".join(w if r.random() > 0.02 else f"v{r.randrange(99)}" for w in base)) for n in range(150)]
    texts += [(200, texts[0][1]), (201, texts[0][1]), (7, prose(9, 80)), (300, prose(9, 80)), (None, prose(9, 80)), (301, None), (302, "")]
    out = []
    kept = near_duplicates._block_links
    monkeypatch.setattr(near_duplicates, "_block_links", lambda *a: out.append(kept(*a)) or out[-1])
    got = near_duplicates.near_duplicates(frame(spark, texts).repartition(4), 4, block_rows=block_rows).collect()
    sets = [({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if t else set()) for _, t in texts for w in [(t or "").split(" ")]]
    named = [i for i, (n, _) in enumerate(texts) if n is not None]
    root = {i: i for i in named}
    for i in named:
        for j in named:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: a if v == b else v for k, v in root.items()}
    least = {}
    for i in named:
        least[root[i]] = min(least.get(root[i], 1 << 60), texts[i][0])
    want = Counter((texts[i][0], least[root[i]]) for i in named) + Counter({(None, None): 1})
    assert Counter((x.doc_id, x.component_id) for x in got) == want
    assert out[0].count() <= 160 * 48
    firsts = Counter(x.component_id for x in got if x.is_first and x.component_id is not None)
    assert all(n == 1 for n in firsts.values())
