import random

from pyspark.sql import functions as F

from sedimenta.operators import assemble, decontam, dedup, split
from sedimenta.session import Scratch

from .conftest import rows


def test_exact_dedup_keeps_first_per_scope(spark):
    df = spark.createDataFrame([(1, "g", "A  b"), (2, "g", "a B"), (3, "h", "a b"), (4, "g", None), (5, "g", ""), (5, "g", ""), (None, "g", "z")], "id long, gen string, t string")
    assert rows(dedup.exact_dedup(df, F.col("t"), "id", "gen"), "id") == [(1,), (3,), (4,)]
    assert rows(dedup.exact_dedup(df, F.col("t"), "id"), "id") == [(1,), (4,)]
    assert dedup.exact_dedup(df.limit(0), F.col("t"), "id").count() == 0


def test_pairs_that_differ_in_the_broken_side_survive(spark):
    data = [(i, "p", "answer", "good", f"bad {i}") for i in range(5)]
    df = spark.createDataFrame(data, "id long, p string, a string, t string, r string")
    assert dedup.exact_dedup(df, dedup.dedup_text(F.col("p"), F.col("a"), F.col("t"), F.col("r")), "id").count() == 5


def _brute(texts, k, threshold):
    sets = {i: {tuple(t.split()[j : j + k]) for j in range(max(1, len(t.split()) - k + 1))} for i, t in texts.items()}
    ids = sorted(sets)
    return sorted((a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if texts[a] != texts[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold)


def test_shared_shingle_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(80):
        base = rng.choice(words[:3]) if i % 2 else ""
        t = texts[rng.randrange(i)].split() if i > 5 and rng.random() < 0.6 else [rng.choice(words) for _ in range(30)]
        t = list(t)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts[i] = " ".join(t) + (" " + base if base else "")
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    seen, uniq = set(), {}
    for i, t in texts.items():
        t = " ".join(t.split())
        if t not in seen:
            seen.add(t)
            uniq[i] = t
    got = rows(dedup.shared_shingle_pairs(df, "id", F.col("t"), k=3, threshold=0.5), "id_a", "id_b")
    assert got and sorted(got) == _brute(uniq, 3, 0.5)


def test_shared_shingle_pairs_read_their_input_once(spark):
    """Lineage is cut: a plan that holds the texts several times grows in the driver and computes them as often."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(reversed(words)), "one", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = dedup.shared_shingle_pairs(df.mapInArrow(counted, df.schema), "id", F.col("t"))
    assert rows(got, "id_a", "id_b") == [(0, 1)] and read.value == 6


def test_keep_first_is_the_sequential_pass(spark):
    rng = random.Random(3)
    for trial in range(3):
        bands = {(i, rng.randrange(25)) for i in range(60) for _ in range(2)} | {(i, 99) for i in range(0, 60, 7)}
        of = {}
        for i, b in bands:
            of.setdefault(i, set()).add(b)
        kept, used = [], set()
        for i in sorted(of):
            if not of[i] & used:
                kept.append(i)
                used |= of[i]
        ids = spark.createDataFrame([(i,) for i in range(60)], "id long")
        got = dedup.keep_first(ids, spark.createDataFrame(list(bands), "id long, band long"), Scratch(spark, "t"))
        assert rows(got) == sorted([(i,) for i in kept] + [(i,) for i in range(60) if i not in of], key=repr)


def test_chain_keeps_both_ends(spark):
    # A~B~C: the greedy pass keeps A and C, components would keep A alone
    bands = spark.createDataFrame([(1, 10), (2, 10), (2, 20), (3, 20)], "id long, band long")
    assert rows(dedup.keep_first(spark.range(1, 4), bands, Scratch(spark, "t"))) == [(1,), (3,)]


def test_minhash_bands_find_equal_sets_and_scopes_differ(spark):
    df = spark.createDataFrame([(1, "x", "a b c d e f g"), (2, "x", "A b c d e f  g"), (3, "y", "a b c d e f g"), (4, "x", None)], "id long, g string, t string")
    b = dedup.minhash_bands(df, "id", F.col("t"), "g")
    sets = {}
    for i, band in rows(b):
        sets.setdefault(i, set()).add(band)
    assert sets[1] == sets[2] and not sets[1] & sets[3] and len(sets[1]) == 5


def test_repeated_paragraphs(spark):
    same = "A sentence that is long enough to be told apart by forty characters."
    df = spark.createDataFrame([(f"{same}\n\nSecond.\n\n{same} Again.\n\nThird.",), ("\n \n",), ("one",)], "t string")
    assert [r[0] for r in df.select(dedup.drop_repeated_paragraphs(F.col("t"))).collect()] == [f"{same}\n\nSecond.", "\n \n", "one"]


def test_decontamination(spark):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog today", "+++ b/src/x.al\n--- a/y"), (2, "", None), (3, None, None), (4, "short", None)], "item_id long, text string, patch string")
    block = decontam.blocklist(items, ["text", "absent"], ["patch"])
    assert ("path", "src/x.al") in rows(block) and len(rows(block.where("kind = 'prompt'"))) == 2
    docs = spark.createDataFrame([(1, "so THE quick  brown fox jumps over the lazy dog today ends"), (2, "nothing"), (3, None), (4, "SHORT")], "doc_id long, text string")
    assert rows(decontam.containing(docs, "doc_id", F.col("text"), items, "item_id", "text")) == [(1, 1)]
    assert rows(decontam.equal_prompts(docs, F.col("text"), block.where("kind = 'prompt'").select("value")), "doc_id") == [(4,)]
    paths = spark.createDataFrame([(1, "a\\src\\x.al"), (2, "b"), (3, None)], "id long, path string")
    assert rows(decontam.path_contaminated(F.col("path"), block.where("kind = 'path'").select("value"), paths), "id") == [(1,)]


def test_licence_gate(spark):
    src = spark.createDataFrame([("a", "MIT", "code"), ("b", None, "code"), ("c", "CC-BY-4.0", "docs")], "src_key string, spdx string, src_role string")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "zzz"), (5, None)], "id long, repo string")
    assert rows(decontam.licence_gate(df, "repo", src), "id", "licence_ok") == [(1, True), (2, False), (3, True), (4, True), (5, True)]
    assert rows(decontam.licence_gate(df, "repo", src, strict=True), "id", "licence_ok") == [(1, True), (2, False), (3, True), (4, False), (5, False)]


def test_rank_and_stride(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = rows(split.rank_by(df, [F.col("k")]), "k", "rank")
    assert all(k == r for k, r in got) and len(got) == 1000
    assert rows(split.stride_sample(df, "k", 30), "k") == sorted([(i,) for i in range(0, 1000, 33)][:30], key=repr)


def test_splits_are_whole_and_disjoint(spark):
    data = [(i, "g1", [("user", f"q{i}"), ("assistant", f"a{i}")], None, f"src/App{i % 7}/x/f.al", None) for i in range(200)]
    df = spark.createDataFrame(data, "cand_id long, gen string, messages array<struct<role:string,content:string>>, rejected_al string, path string, object string")
    parts = {p: n for p, n in rows(assemble.routed(df, share=1.0, heldout_rate=3).groupBy("part").count())}
    assert sum(parts.values()) == 200 and set(parts) <= {"heldout", "train", "val"}
    sft = parts.get("train", 0) + parts.get("val", 0)
    assert parts.get("val", 0) == -(-sft // 20)


def test_kind_cap(spark):
    data = [(i, "big", f"a{i}") for i in range(180)] + [(i, "small", f"b{i}") for i in range(180, 200)]
    df = spark.createDataFrame(data, "id long, gen string, answer string")
    got = rows(split.kind_cap(df, "gen", F.col("answer"), "id", 0.5).groupBy("gen").count())
    assert got == [("big", 100), ("small", 20)]
    import hashlib

    want = {i for _, i in sorted((hashlib.sha1(f"big{a}".encode()).hexdigest(), i) for i, g, a in data if g == "big")[:100]}
    assert {r[0] for r in split.kind_cap(df, "gen", F.col("answer"), "id", 0.5).where("gen = 'big'").select("id").collect()} == want


def test_registered_kind_cap_is_that_of_the_reference(spark, sf):
    from sedimenta.plans import catalogue

    c = catalogue._candidates(spark, sf).where("coalesce(length(rejected_al), 0) = 0")
    sizes = dict(rows(c.groupBy("gen").count()))
    cap = int(sum(sizes.values()) * 0.35)
    assert max(sizes.values()) > cap
    assert dict(rows(catalogue.kind_cap_candidates(spark, sf).groupBy("gen").count())) == {g: min(n, cap) for g, n in sizes.items()}


def test_triple_cap_is_greedy(spark):
    rng = random.Random(1)
    data = [(str(i), f"m{rng.randrange(3)}", f"p{rng.randrange(5)}", f"a{rng.randrange(2)}", rng.random()) for i in range(200)]
    caps = {"m": 20, "p": 6, "a": 15}
    used, want = {}, []
    for i, m, p, a, o in sorted(data, key=lambda r: (r[4], r[0])):
        keys = [("m", m), ("p", p), ("a", a)]
        if all(used.get(k, 0) < caps[k[0]] for k in keys):
            for k in keys:
                used[k] = used.get(k, 0) + 1
            want.append((i,))
    df = spark.createDataFrame(data, "_id string, m string, p string, a string, o double")
    assert rows(split.triple_cap(df, caps, [F.col("o")]), "_id") == sorted(want, key=repr)


def test_conversations_refuse_unknown_roles(spark):
    import pytest

    ok = spark.createDataFrame([([("system", "s"), ("user", "q"), ("assistant", "a")],)], "m array<struct<role:string,content:string>>")
    assert [t["from"] for t in ok.select(assemble.conversations(F.col("m"))).first()[0]] == ["system", "human", "gpt"]
    bad = spark.createDataFrame([([("tool", "x")],)], "m array<struct<role:string,content:string>>")
    with pytest.raises(Exception, match="unknown role"):
        bad.select(assemble.conversations(F.col("m"))).collect()


def test_containing_equals_plain_search(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    items = {i: " ".join(word(rng.choice([1, 2, 3, 25, 45])) for _ in range(rng.randrange(1, 9))) for i in range(60)} | {90: None, 91: "", 92: "Short One"}
    docs = {i: f"{word(4)} x{rng.choice(list(items.values())[:60])}{rng.choice(['', 'y', ' z'])} {word(3)}" for i in range(80)} | {90: None, 91: ""}
    docs |= {200 + i: f"{t[1:]} {word(5)}" for i, t in items.items() if t}
    flat = lambda t: " ".join((t or "").lower().split())
    want = sorted((d, i) for d, t in docs.items() for i, p in items.items() if len(flat(p)) >= 40 and flat(p) in flat(t))
    d = spark.createDataFrame([*docs.items(), (0, docs[0])], "doc_id string, text string")
    got = decontam.containing(d, "doc_id", F.col("text"), spark.createDataFrame(list(items.items()), "item_id long, text string"), "item_id", "text")
    assert sorted((int(a), b) for a, b in rows(got)) == want and len(want) > 50
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_paths_with_fragments_of_any_length(spark):
    paths = {1: "src/App/Bench7/x.al", 2: "src\\App\\Other\\y.al", 3: "z", 4: None, 5: "src/App/Bench70/x.al"}
    frags = ["/Bench7/", "App\\Other\\y.al", "z", "", None]
    df = spark.createDataFrame(list(paths.items()), "id long, path string")
    f = spark.createDataFrame([(x,) for x in frags], "f string")
    assert rows(decontam.path_contaminated(F.col("path"), f, df), "id") == [(1,), (2,), (3,)]
    assert rows(decontam.path_contaminated(F.col("path"), f, df, outside=True), "id") == [(4,), (5,)]
    assert rows(decontam.path_contaminated(F.col("path"), f.limit(0), df), "id") == []


def test_keep_first_ends_long_chains(spark):
    """A chain of 300 versions, where every decision waits for the one before, a hub, and a row of its own."""
    bands = [(i, b) for i in range(300) for b in (i, i + 1)] + [(1000 + i, 5000) for i in range(50)] + [(2000, 9000)]
    want, kept = [], set()
    held = {}
    for i, b in bands:
        held.setdefault(i, set()).add(b)
    for i in sorted(held):
        if kept.isdisjoint(held[i]):
            kept |= held[i]
            want.append((i,))
    ids = spark.createDataFrame([(i,) for i in sorted(held)], "id long")
    for rounds in (1, 3):
        assert sorted(rows(dedup.keep_first(ids, spark.createDataFrame(bands, "id long, band long"), Scratch(spark, "t"), rounds=rounds))) == sorted(want)


def test_caps_in_stretches_and_chunks_of_a_hot_group(spark):
    rng = random.Random(8)
    data = [(i, rng.random(), f"m{rng.randrange(3)}", rng.choice(["p1", "p2", None, f"p{rng.randrange(40)}"])) for i in range(600)]
    caps, used, want = {"a": 25, "b": 6}, {}, []
    for i, o, a, b in sorted(data, key=lambda r: r[1]):
        if used.get(("a", a), 0) < 25 and used.get(("b", b), 0) < 6:
            used["a", a], used["b", b] = used.get(("a", a), 0) + 1, used.get(("b", b), 0) + 1
            want.append(i)
    df = spark.createDataFrame(data, "_id long, o double, a string, b string")
    for first in (10, 1000):
        assert sorted(r[0] for r in rows(split.triple_cap(df, caps, [F.col("o")], first=first), "_id")) == sorted(want)
    got = rows(split.chunks(df.select("_id", "a"), "a", order="_id", size=7), "_id", "a", "chunk")
    for a in ("m0", "m1", "m2"):
        assert [c for _, x, c in sorted(got) if x == a] == [k // 7 for k in range(sum(x == a for _, x, _ in got))]
