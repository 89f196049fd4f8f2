import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.llm import group_splits as S
from sedimenta.llm import leakage
from sedimenta.llm.leakage import leaked_items, reparameterised_items
from sedimenta.llm.mixture import mix, repetition_rates
from sedimenta.session import Scratch
from tests.conftest import rows


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=5), st.integers(0, 60))
def test_subset_sums_are_the_closest(hist, goal):
    taken = S.choose(list(hist.items()), goal)
    assert all(n <= hist[s] for s, n in taken.items())
    sums = {0}
    for s, n in hist.items():
        sums = {t + s * k for t in sums for k in range(n + 1)}
    assert abs(sum(s * n for s, n in taken.items()) - goal) == min(abs(t - goal) for t in sums)


def test_subset_sums_of_large_goals_stay_small():
    taken = S.choose([(1, 10**6), (10**6, 3000), (7, 10**5)], 10**9 + 3, residual=1 << 16)
    assert sum(s * n for s, n in taken.items()) == 10**9 + 3


def test_subset_sums_need_little_memory():
    """Many sizes and one group larger than any goal: the exact sum, in memory that follows the goal."""
    hist = [(s, 30) for s in range(1, 1401)] + [(20_000_000, 1)]
    goal = sum(s * n for s, n in hist) // 10
    tracemalloc.start()
    taken = S.choose(hist, goal)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(s * n for s, n in taken.items()) == goal and peak < 2e8


def test_a_key_of_many_apps_has_no_large_hub(spark):
    apps = spark.range(0, 300).select(F.col("id").alias("app"), F.format_string("src/P%d/App", "id").alias("app_dir"))
    cands = spark.range(0, 300).select(F.format_string("src/P%d/App/x.al", "id").alias("path"), F.when(F.col("id") < 250, "ann").alias("author"), F.lit(None).cast("string").alias("object"))
    got = S.related_apps(apps, cands, spokes=20).apps
    assert sorted(got.groupBy("root").count().select("count").toPandas()["count"].tolist()) == [1] * 50 + [250]


def test_persons_and_things(spark):
    df = spark.createDataFrame([("@Keen-Plover-0A",), (" keen plover_0a ",), ("KEEN-PLOVER-0A <k@x.y>",), ("n/a",), ("Unknown",), ("build-agent",), ("merge-queue",), ("dependabot[bot]",), ("",), (None,), ("abbot",)], "a string")
    got = [r[0] for r in df.select(S.person(F.col("a"))).collect()]
    assert got == ["keen-plover-0a"] * 3 + [None] * 7 + ["abbot"]
    o = spark.createDataFrame([('Table "My  Thing"',), ("table My Thing",), ('""',), (None,)], "o string")
    assert [r[0] for r in o.select(S.thing(F.col("o"))).collect()] == ["table my thing", "table my thing", None, None]


APPS = [(1, "src/X/App"), (2, "src/X/Test"), (3, "src/Y/App"), (4, "src/Z/App"), (5, "lib/X/App"), (6, "src/W/App"), (6, "src/W/App")]
CANDS = [
    (1, "src/X/App/a.al", "Ann", None), (2, "src\\Y\\App\\b.al", "@ann ", None), (3, "./src//Y/App/c.al", None, 'Table "T"'), (4, "src/Z/App/d.al", "unknown", "table t"),
    (5, "lib/X/App/e.al", "unknown", None), (6, "src/W/App/f.al", "unknown", ""), (7, "misc/q.al", "ann", "table t"), (8, None, "ann", None), (9, "src/W/App/g.al", "bot", None), (None, "src/W/App/g.al", "Ann", None),
]


def frames(spark):
    apps = spark.createDataFrame([(a, d, "clash") for a, d in APPS], "app long, app_dir string, root string")
    cands = spark.createDataFrame(CANDS, "record_id long, path string, author string, object string")
    return apps, cands


def test_related_apps(spark):
    apps, cands = frames(spark)
    got = rows(S.related_apps(apps, cands.where("record_id is not null")).pairs())
    assert got == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
    assert S.related_apps(apps.limit(0), cands.limit(0)).pairs().count() == 0
    assert rows(S.related_apps(apps, cands.limit(0)).pairs()) == [(1, 2)]


def test_group_splits(spark):
    apps, cands = frames(spark)
    rng = random.Random(1)
    more = [(100 + i, f"src/P{rng.randrange(60)}/App/x.al", None, None) for i in range(500)]
    apps = apps.unionByName(spark.createDataFrame([(100 + i, f"src/P{i}/App", "c") for i in range(60)], "app long, app_dir string, root string"))
    cands = cands.unionByName(spark.createDataFrame(more, "record_id long, path string, author string, object string"))
    members = spark.createDataFrame([(1, "src/X/App/m.al", None), (2, None, "src/Y/App/"), (3, "misc/q.al", None), (4, None, None), (4, None, None), (None, "x", "y")], "record_id long, path string, app_dir string")
    got = S.group_splits(apps, members, cands, {"train": 0.8, "validation": 0.1, "test": 0.1})
    out = {(r.origin, r.record_id): r.split for r in got.collect()}
    assert len(out) == got.count() == 4 + 9 + 500
    assert len({out["members", 1], out["members", 2], out["candidates", 1], out["candidates", 4]}) == 1
    assert out["members", 3] == out["candidates", 7]
    counts = {s: n for o, s, n in rows(got.groupBy("origin", "split").count()) if o == "candidates"}
    assert abs(counts["test"] - 51) <= 1 and abs(counts["validation"] - 51) <= 1


def test_ranks_inside_one_size_are_exact(spark):
    groups = spark.range(0, 5000).select(F.col("id").cast("string").alias("grp"), F.lit(1).alias("size"))
    got = {s: n for s, n in rows(S.assign_splits(groups, {"a": 0.7, "b": 0.2, "c": 0.1}, Scratch(spark, "t")).groupBy("split").count())}
    assert got == {"a": 3500, "b": 1000, "c": 500}


def words12(text):
    return [w.lower() for w in re.findall(r"[^\W_]+", text or "")]


def test_leaks_equal_brute_force(spark):
    rng = random.Random(9)
    vocab = ["set", "the", "Rows", "days", "PostSalesHeader", "GetCustomerLedger", "12", "99", "über", "x1"] + [f"word{i}" for i in range(30)]
    items = {i: " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 12, 30]))) for i in range(12)} | {50: None, 51: "", 52: "tiny"}
    docs = {}
    for d in range(60):
        t = [rng.choice(vocab) for _ in range(rng.randrange(40))]
        src = (items[rng.randrange(12)] or "").split()
        a = rng.randrange(max(1, len(src) - 10))
        part = src[a : a + rng.choice([11, 12, 15])]
        if d % 3:
            part = [w.upper() if d % 2 else w for w in part]
        docs[d] = " ".join(t[:10]) + "\n| " + ("*, " if d % 4 else "__ ").join(part) + ". " + " ".join(t[10:])
    docs |= {100: None, 101: ""}
    want = set()
    for d, t in docs.items():
        w = words12(t)
        for i, u in items.items():
            v = words12(u)
            runs = {tuple(v[k : k + 12]) for k in range(len(v) - 11)}
            if any(tuple(w[k : k + 12]) in runs for k in range(len(w) - 11)):
                want.add((d, i))
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in [*docs.items(), (0, docs[0])]], "doc_id long, text string, pos int, template string")
    it = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for bits in (24, 7):  # a small bit array lets more windows pass, which changes nothing
        assert rows(leaked_items(df, "doc_id", "text", it, "item_id", "text", filter_bits=bits), "doc_id", "item_id") == sorted(want, key=repr)
    assert want
    assert leaked_items(df.limit(0), "doc_id", "text", it, "item_id", "text").count() == 0
    assert leaked_items(df, "doc_id", "text", it.limit(0), "item_id", "text").count() == 0


def test_long_texts_are_read_in_stretches(monkeypatch):
    texts = [" ".join(f"w{(i * 7 + k) % 50}" for i in range(300)) for k in range(3)] + ["short text", ""]
    batch = pa.record_batch([pa.array(range(5)), pa.array(texts)], ["id", "text"])
    none = leakage.Bits(np.zeros(1, np.uint64))

    def flat(stretch):
        monkeypatch.setattr(leakage, "STRETCH", stretch)
        return sorted((r["id"], r["pos"], r["key"]) for b in leakage._windows(12, (none, none), None)(iter([batch])) for r in b.to_pylist())

    assert flat(10**6) == flat(37) == flat(12) and len(flat(37)) == 3 * 289


def test_words_are_typed_by_shape_and_use(spark):
    texts = ["Anna waits 30 kilometer for Anna", "we saw Anna go 7 kilometer to the depot", "the wait for code4you is long", "Wait for the depot"]
    items = spark.createDataFrame([(1, texts[0]), (2, texts[2]), (3, texts[3])], "id long, text string")
    every = leakage.Bits(np.full(1, ~np.uint64(0)))
    facts = items.sparkSession.createDataFrame([(9, texts[1])], "id long, text string").unionByName(items).coalesce(1).mapInArrow(leakage._uses(every), "h bigint, low bigint, named bigint, counted bigint, mixed boolean").collect()
    got = {r["h"]: (r["low"], r["named"], r["counted"], r["mixed"]) for r in facts}
    of = lambda w: got[xxhash.xxh3_64_intdigest(w) - (1 << 64) * (xxhash.xxh3_64_intdigest(w) >> 63)]
    assert of("anna") == (0, 2, 0, False) and of("kilometer") == (2, 0, 2, False) and of("code4you")[3] and of("wait") == (1, 0, 0, False)


def test_planted_variants_are_found(spark):
    """Items with other names, numbers and units: at least 0.9 of them are found, and with no other item."""
    rng = random.Random(5)
    plain = "open close check whether each pending entry needs approval before nightly posting starts because some users still work on older drafts and nobody wants lost data".split()
    name = lambda: "".join(rng.choice(["Blue", "Kiln", "Post", "Ledger", "Crane", "Open", "Batch", "Shift"]) for _ in range(3)) + rng.choice("abcdefgh")

    def question():
        words = rng.sample(plain, 18)
        for at in sorted(rng.sample(range(19), 4), reverse=True):
            words.insert(at, rng.choice(["{n}", "{n}", "{d}"]))
        return " ".join(words)

    def filled(frame):
        return re.sub(r"\{.\}", lambda m: name() if m.group() == "{n}" else str(rng.randrange(10**5)), frame)

    frames_ = [question() for _ in range(60)]
    items = [(i, filled(f)) for i, f in enumerate(frames_)]
    docs = [(i, f"Some words first. {filled(frames_[i % 60])} and some after.") for i in range(120)] + [(1000 + i, " ".join(rng.choice(plain) for _ in range(80))) for i in range(60)]
    d, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = set(rows(reparameterised_items(d, "doc_id", "text", it, "item_id", "text"), "doc_id", "item_id"))
    want = {(i, i % 60) for i in range(120)}
    assert len(got & want) >= 0.9 * len(want) and not got - want


def test_reparameterised_items(spark):
    item = "Add a guard to CollectStandardShift which compares CheckLegacyContract with RegisterRankedLadder and raises code 5995 when CollectStandardShift is older than 30 days in the batch run"
    swap = {"CollectStandardShift": "AssignForeignCrane", "CheckLegacyContract": "OpenModularKiln", "RegisterRankedLadder": "CloseExpiredDepot", "5995": "17", "30": "8"}
    other = item
    for a, b in swap.items():
        other = other.replace(a, b)
    mixed = other.replace("AssignForeignCrane is", "SomethingElseAgain is")
    docs = spark.createDataFrame([(1, f"intro {other} end"), (2, item), (3, mixed), (4, "nothing at all"), (5, None)], "doc_id long, text string")
    got = rows(reparameterised_items(docs, "doc_id", "text", spark.createDataFrame([(7, item)], "item_id long, text string"), "item_id", "text"), "doc_id", "item_id", "n_changed")
    assert [g for g in got if g[2] == 0] == [(2, 7, 0)] and (1, 7, 5) in got and not [g for g in got if g[0] in (3, 4, 5)]


def test_short_plain_and_repeated_passages_are_variants(spark):
    plain = "the quick brown fox jumps over the lazy dog and then it rests under one old tree until the next morning comes back again"
    asks = [f"Please answer the following question and explain for codeunit Collect{c}StandardShift how long the {w} runs" for c, w in zip("abcdefghijkl", "one two six ten red tan big dim wet hot old new".split())]
    short = "in codeunit BuildRankedPallet the posting of RefreshBlockedBuffer must stop after 874 rows"
    items = spark.createDataFrame([(1, plain), (2, short), (3, " ".join(f"{n}" for n in range(40, 53))), *[(10 + k, a) for k, a in enumerate(asks)]], "item_id long, text string")
    other = "in codeunit CompareOpenPayment the posting of ImportVirtualRebate must stop after 17 rows"
    docs = {
        1: f"x {plain} y",  # no slot at all
        2: f"see {' '.join(plain.split()[:12])} and more",  # twelve words, no slot
        3: f"so {short}, then",  # short, verbatim
        4: f"so {other}, then",  # short, changed, held by one item
        5: f"{asks[0].rsplit(' the ', 1)[0].replace('CollectaStandardShift', 'SomethingElseAgain')} nobody knows",  # a common opening with another name
        6: f"{' '.join(str(n) for n in range(70, 83))} of a table",  # slots alone say nothing
        7: f"{short.replace('BuildRankedPallet', 'RefreshBlockedBuffer', 1)}",  # one value for two, and fewer than twelve words verbatim
    }
    df = spark.createDataFrame([*docs.items(), *docs.items()], "doc_id long, text string")
    got = rows(reparameterised_items(df, "doc_id", "text", items.union(items), "item_id", "text"), "doc_id", "item_id", "n_words", "n_slots", "n_changed")
    assert got == sorted([(1, 1, 24, 0, 0), (2, 1, 12, 0, 0), (3, 2, 12, 4, 0), (4, 2, 12, 4, 3)], key=repr)


def test_variants_hold_every_verbatim_leak(spark, sf):
    from sedimenta.llm import queries as Q

    variants, found = Q.p5_variants(spark, sf), Q.p5_found(spark, sf)
    assert found.count() and found.join(variants, ["doc_id", "item_id"], "left_anti").count() == 0


def test_rates_respect_caps():
    rates = repetition_rates({"a": 1000, "b": 100, "c": 10}, {"a": (0.5, 1), "b": (0.4, 2), "c": (0.1, 5), "none": (0.1, 9), "zero": (0.0, 3)}, 1000)
    assert rates["b"] == 2 and rates["c"] == 5 and rates["none"] == rates["zero"] == 0
    assert abs(rates["a"] - 0.75) < 1e-9


def test_mixture(spark):
    rng = random.Random(8)
    data = [(i, f"text number {i} " + "word " * rng.randrange(5, 40), ["Big_one", "big-one ", "BIG ONE"][i % 3]) for i in range(900)]
    data += [(1000 + i, f"small {i} " + "word " * 20, "small") for i in range(60)] + [(2000 + i, "the same text " * 10, "small") for i in range(40)]
    data += [(3000, None, "small"), (3001, "", "small"), (None, "x y", "small"), (3002, "no source", None), (3003, "unwanted source", "other"), (0, data[0][1], "big-one")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("rate", F.lit("clash"))
    targets = spark.createDataFrame([("big-one", 0.6, 1), ("small", 0.3, 3), ("absent", 0.1, 5), (None, 0.5, 2), ("other", 0.0, 3)], "source string, target_share double, max_repeats int")
    m = mix(df, "doc_id", "text", "source", targets)
    report = {r.source: r for r in m.report().collect()}
    assert set(report) == {"big-one", "small", "absent", "other"} and report["absent"].actual_share == 0 == report["other"].mixed_tokens
    assert report["small"].rate <= 3 and report["small"].n_texts == 61 and report["big-one"].rate <= 1
    assert abs(sum(r.actual_share for r in report.values()) - 1) < 1e-4
    copies = m.copies()
    assert copies.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert copies.where("source = 'big-one'").groupBy("doc_id").count().agg(F.max("count")).first()[0] == 1
    assert rows(mix(df, "doc_id", "text", "source", targets).copies()) == rows(copies)
    assert mix(df.limit(0), "doc_id", "text", "source", targets).copies().count() == 0
    assert mix(df, "doc_id", "text", "source", targets.limit(0)).copies().count() == 0


def test_bernoulli_copies_meet_their_share(spark):
    df = spark.range(0, 4000).select(F.col("id").alias("d"), F.concat(F.lit("some words here "), F.col("id")).alias("t"), F.when(F.col("id") < 1000, "a").otherwise("b").alias("s"))
    targets = spark.createDataFrame([("a", 0.5, 5), ("b", 0.5, 5)], "source string, target_share double, max_repeats int")
    r = {x.source: x.actual_share for x in mix(df, "d", "t", "s", targets).report().collect()}
    assert abs(r["a"] - 0.5) < 0.02 and list(itertools.chain(r)) 
