import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import kernel as K
from sedimenta.llm.near_duplicates import near_duplicates
from sedimenta.llm.similarity import bucket_pairs, meet_buckets, pair_buckets
from sedimenta.llm.split_overlap import conversation_text, shape, split_overlap, votes_of
from sedimenta.operators.components import components
from sedimenta.session import Scratch
from tests.conftest import rows


def shingle_set(text, k=3):
    w = re.findall(r"[a-z0-9_]+", re.sub(r"[^\x00-\x7f]", " ", text).lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}, len(w)


def brute(texts, threshold=0.6, min_words=20, ok=lambda a, b: True):
    sets = {i: s for i, t in texts.items() if t and (s := shingle_set(t))[1] >= min_words}
    ids = sorted(sets)
    return sorted((a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if ok(a, b) and len(sets[a][0] & sets[b][0]) >= threshold * len(sets[a][0] | sets[b][0]))


def corpus(n, seed, words=400):
    """Texts, their edits and copies; no pair of overlap next to the threshold."""
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(words)]
    texts = {}
    for i in range(n):
        if i > 3 and rng.random() < 0.5:
            t = texts[rng.randrange(i)].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
        else:
            t = [rng.choice(vocab) for _ in range(rng.randrange(60, 90))]
        texts[i] = " ".join(t)
    return texts


def test_kernel_words_and_shingles():
    texts = ["Ab_1 cd; Éf gh", "", "x", "a b\tc\nd", None, "end"]
    off, raw = K.buffers(pa.array(texts))
    doc, h = K.words(off, raw)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[a-z0-9_]+", (t or "").lower().replace("é", " "))]
    assert doc.tolist() == [i for i, _ in want]
    same = {}
    for (_, w), x in zip(want, h.tolist()):
        assert same.setdefault(w, x) == x
    assert len(set(same.values())) == len(same)
    d, s = K.shingles(doc, h, 3)
    assert d.tolist() == [0, 0, 3, 3]


def test_kernel_pieces_do_not_change_hashes():
    texts = [f"word{i} other{i % 7} thing" * (i % 5) for i in range(200)]
    col = pa.array(texts)
    off, raw = K.buffers(col)
    whole = K.words(off, raw)[1]
    parts = np.concatenate([K.words(off[i : j + 1], raw)[1] for i, j in K.pieces(off, 100)])
    assert (whole == parts).all()
    sliced = pa.array(["skip me", *texts]).slice(1)
    assert (K.words(*K.buffers(sliced))[1] == whole).all()


def test_kernel_very_long_text():
    text = "alpha beta gamma " * 400_000
    off, raw = K.buffers(pa.array(["a b c", text]))
    n = sum(len(K.words(off[i : j + 1], raw)[1]) for i, j in K.pieces(off))
    assert n == 3 + 1_200_000
    one = "x" * 9_000_000
    off, raw = K.buffers(pa.array([one, "a " + one + " b", "é" * 5_000_000 + "z"]))
    doc, h = K.words(off, raw)
    assert doc.tolist() == [0, 1, 1, 1, 2] and h[0] == h[2]


def test_bucket_pairs_and_streaming():
    rng = np.random.default_rng(0)
    key = np.sort(rng.integers(0, 40, 600))
    cls = rng.integers(0, 50, 600)
    order = np.lexsort((cls, key))
    key, cls = key[order], cls[order]
    want = {(min(a, b), max(a, b)) for k in set(key.tolist()) for a in cls[key == k] for b in cls[key == k] if a != b}
    for hot, step in ((1000, 7), (5, 7), (5, 1), (3, 600)):
        batches = [pa.record_batch([pa.array(key[i : i + step]), pa.array(cls[i : i + step])], ["key", "cls"]) for i in range(0, 600, step)]
        out = [b.to_pylist() for b in pair_buckets(hot)(iter(batches))]
        flat = [r for b in out for r in b]
        pairs = {(r["a"], r["b"]) for r in flat if r["b"] is not None}
        big = [r for r in flat if r["b"] is None]
        by_key = {}
        for r in big:
            by_key.setdefault(r["key"], []).append((r["block"], r["a"]))
        for k, members in by_key.items():
            assert sorted(a for _, a in members) == sorted(set(cls[key == k].tolist())), (hot, step)
            sizes = {}
            for b, _ in members:
                sizes[b] = sizes.get(b, 0) + 1
            assert max(sizes.values()) <= hot
            pairs |= {(min(a, b), max(a, b)) for _, a in members for _, b in members if a != b}
        assert pairs == want, (hot, step)
    assert len(bucket_pairs(np.zeros(0, np.int64), np.zeros(0, np.int64), 5)[0]) == 0


def odd(spark, texts):
    """The texts with redelivered rows, nulls, empty and short texts, and columns whose names clash with internal ones."""
    data = [(i, t, "c", 1, "k") for i, t in texts.items()] + [(0, texts[0], "again", 2, "k"), (None, texts[0], "c", 1, "k"), (9001, None, "c", 1, "k"), (9002, "", "c", 1, "k"), (9003, "too short", "c", 1, "k")]
    return spark.createDataFrame(data, "rid long, body string, class string, id int, text string")


@pytest.mark.parametrize("hot", [2048, 4])
def test_near_duplicates_equal_brute_force(spark, hot):
    texts = corpus(150, 11)
    r = near_duplicates(odd(spark, texts), "rid", "body", shingle=3, threshold=0.6, min_words=20, hot=hot)
    assert rows(r.pairs().distinct()) == sorted(brute(texts), key=repr)


def test_near_duplicate_groups(spark):
    texts = corpus(80, 12)
    r = near_duplicates(odd(spark, texts), "rid", "body", shingle=3, threshold=0.6, min_words=20)
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute(texts):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {i for p in brute(texts) for i in p}
    assert sorted(rows(r.groups(), "id", "group")) == sorted((i, find(i)) for i in linked)


def test_near_duplicates_of_nothing_and_of_one_hot_text(spark):
    none = spark.createDataFrame([], "rid long, body string")
    r = near_duplicates(none, "rid", "body")
    assert r.pairs().count() == 0 and r.groups().count() == 0
    same = " ".join(f"w{i}" for i in range(40))
    df = spark.range(0, 60).select(F.col("id").alias("rid"), F.lit(same).alias("body"))
    r = near_duplicates(df, "rid", "body", shingle=3, threshold=0.6, min_words=20)
    assert r.links.count() == 0 and r.pairs().count() == 60 * 59 // 2
    assert rows(r.groups(), "copy_of", "n_links", "group").count((0, 0, 0)) == 60


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(500, i) for i in range(501, 560)] + [(5, 5), (None, 3), (100, 101)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = rows(components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "c"))
    assert sorted(got) == sorted((i, find(i)) for i in parent)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t"), "c").count() == 0


@pytest.mark.parametrize("hot, step", [(1000, 13), (6, 13), (6, 1), (3, 900), (10, 40)])
def test_meet_buckets_streaming(hot, step):
    rng = np.random.default_rng(5)
    key, side = rng.integers(0, 12, 900), rng.integers(0, 2, 900)
    rows = np.stack([key * 2 + side, rng.integers(0, 10**6, 900), *rng.integers(-(2**62), 2**62, (2, 900))], axis=1)
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    ones = lambda x: bin(int(x) % (1 << 64)).count("1")
    far = lambda x, y: ones(x[2] ^ y[2]) + ones(x[3] ^ y[3])
    want = {(int(x[1]), int(y[1])) for x in rows for y in rows if x[0] & 1 and x[0] - 1 == y[0] and far(x, y) <= 60}
    batches = [pa.record_batch([pa.array(rows[i : i + step, c]) for c in range(4)], ["key", "class", "f0", "f1"]) for i in range(0, 900, step)]
    out = [r for b in meet_buckets(hot, 60, 50)(iter(batches)) for r in b.to_pylist()]
    got = {(r["a"], r["b"]) for r in out if r["key"] is None}
    big = [r for r in out if r["key"] is not None]
    shelf, asked = [r for r in big if r["side"] == 0], [r for r in big if r["side"] == 1]
    for x in asked:
        got |= {(x["a"], y["b"]) for y in shelf if x["key"] == y["key"] and far((0, 0, x["f0"], x["f1"]), (0, 0, y["f0"], y["f1"])) <= 60}
    sizes = {}
    for r in big:
        sizes[r["key"], r["side"], r["block"]] = sizes.get((r["key"], r["side"], r["block"]), 0) + 1
    assert max(sizes.values(), default=0) <= hot
    assert got == want and want


def test_votes_and_recall_of_lookups():
    """Votes equal the plain sum; of pairs at overlap 0.66, at least 0.99 share a looked-up block value."""
    rng = np.random.default_rng(0)
    doc, h = np.sort(rng.integers(0, 9, 5000)), rng.integers(0, 2**63, 5000).astype(np.uint64)
    docs, votes = votes_of(doc, h, 8, step=700)
    salt = K.mix(np.arange(1, 9, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    bits = np.unpackbits(K.mix(h[:, None] ^ salt).view(np.uint8), axis=1, bitorder="little").astype(int) * 2 - 1
    assert (np.array([bits[doc == d].sum(0) for d in docs]) == votes).all()
    for n in (5_000, 500_000, 50_000_000):
        cut = shape(n, 0.6, 8, 0.01)
        hit = 0
        for _ in range(300):
            both, mine, other = (rng.integers(0, 2**63, k).astype(np.uint64) for k in (32, 8, 8))
            votes = votes_of(np.repeat([0, 1], 40), np.r_[both, mine, both, other], cut.longs)[1][:, : cut.blocks * cut.width].reshape(2, cut.blocks, cut.width)
            rank = np.argsort(np.abs(votes[0]), axis=1, kind="stable")
            differ = np.take_along_axis((votes[0] > 0) != (votes[1] > 0), rank, 1)
            hit += any({tuple(np.flatnonzero(d))} & set(cut.flips) for d in differ)
        assert hit >= 0.98 * 300


@pytest.mark.parametrize("hot", [8192, 3])
def test_split_overlap_equals_brute_force(spark, hot):
    texts = corpus(160, 13)
    rng = random.Random(2)
    part = {i: rng.choice(["train", " Train", "TRAIN", "val", "Test ", "held out", "HELDOUT", "other", None]) for i in texts}
    side = lambda i: {"train": 0, "val": 1, "test": 1, "heldout": 1}.get((part[i] or "").replace(" ", "").lower())
    turns = lambda t: [("system", "ignored " * 30), ("human", t[:100]), ("gpt", t[100:])]
    data = [(i, part[i], turns(t), None if i % 9 == 0 else f"r{i % 3}", "clash") for i, t in texts.items()]
    data += [(0, part[0], turns(texts[0]), None, "clash"), (9001, "val", None, "r", "x"), (9002, "train", [], "r", "x"), (None, "val", turns(texts[1]), "r", "x"), (9003, "val", [("human", None), (None, "few words")], "r", "x")]
    df = spark.createDataFrame(data, "row_id long, split string, conversations array<struct<from:string,value:string>>, repo string, side string")
    joined = {i: t[:100] + "\n" + t[100:] for i, t in texts.items()}
    want = brute(joined, ok=lambda a, b: {side(a), side(b)} == {0, 1})
    r = split_overlap(df, "row_id", conversation_text(), F.col("split"), F.col("repo"), shingle=3, threshold=0.6, min_words=20, miss=0.001, hot=hot)
    got = sorted({(min(a, b), max(a, b)) for a, b in rows(r.pairs(), "id_eval", "id_train")})
    assert got == want and want
    leaked = {i for p in want for i in p if side(i) == 1}
    report = r.report()
    assert report.agg(F.sum("n_leaked")).first()[0] == len(leaked)
    assert report.agg(F.sum("n_records")).first()[0] == sum(1 for i in texts if side(i) == 1)


def test_split_overlap_of_empty_table(spark):
    df = spark.createDataFrame([], "row_id long, split string, conversations array<struct<from:string,value:string>>, repo string")
    r = split_overlap(df, "row_id", conversation_text(), F.col("split"), F.col("repo"))
    assert r.pairs().count() == 0 and r.report().count() == 0


def test_conversation_text(spark):
    df = spark.createDataFrame([([(" System ", "s"), ("human", "q"), ("gpt", None), (None, "x")],), ([],), (None,)], "conversations array<struct<from:string,value:string>>")
    assert [r[0] for r in df.select(conversation_text()).collect()] == ["q\nx", "", None]
