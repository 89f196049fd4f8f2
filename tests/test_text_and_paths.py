from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.functions import text as X
from sedimenta.functions.paths import clean_path, group_of, place

from .conftest import rows


def test_norm_and_bucket(spark):
    df = spark.createDataFrame([(1, "  A\t b\n\nC "), (2, None), (3, "")], "id long, t string")
    assert rows(df.select("id", X.norm(F.col("t")))) == [(1, "a b c"), (2, ""), (3, "")]
    import hashlib

    key = "src/App/x.al"
    want = int.from_bytes(hashlib.sha1(key.encode()).digest()[:4], "big") % 12
    assert spark.range(1).select(X.hash_bucket(F.lit(key), 12)).first()[0] == want


def test_shingles_of_short_and_repeated_texts(spark):
    df = spark.createDataFrame([("a b c",), ("",), ("a b c d e f",), ("x x x x x x x",)], "t string")
    got = [sorted(r[0]) for r in df.select(X.shingles(F.col("t"), 5)).collect()]
    assert got == [["a b c"], [""], ["a b c d e", "b c d e f"], ["x x x x x"]]


def test_fences(spark):
    df = spark.createDataFrame([("see\n```\nold\n```\n```al\nnew\n```",), ("```\nonly\n```",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(X.first_fence(F.col("t"))).collect()] == ["new", "only", None, None]


def test_paths(spark):
    spelled = ["a/b/c.al", "./a//b\\c.al", "/a/x/../b/c.al", " a\\b\\c.al "]
    df = spark.createDataFrame([(p,) for p in spelled], "p string")
    assert {r[0] for r in df.select(clean_path(F.col("p"))).collect()} == {"a/b/c.al"}
    g = spark.createDataFrame([("x/y.al", "o", "g"), (None, "o", "g"), ("", None, "g"), ("top", "", "g")], "p string, o string, g string")
    assert [r[0] for r in g.select(group_of(F.col("p"), F.col("o"), F.col("g"))).collect()] == ["x", "o", "g", "g"]


def test_place_takes_the_deepest_app(spark):
    apps = spark.createDataFrame([(1, "src/A"), (2, "src/A/Test"), (3, "SRC/B"), (4, None)], "app long, app_dir string")
    p = spark.createDataFrame([("src/A/x.al",), ("src\\a\\Test\\y.al",), ("src/b/z.al",), ("misc/q.al",), (None,), ("src/AB/x.al",)], "path string")
    assert rows(place(p, apps)) == [("src/A/x.al", 1), ("src/b/z.al", 3), ("src\\a\\Test\\y.al", 2)]
    assert place(p.limit(0), apps).count() == 0 and place(p, apps.limit(0)).count() == 0


def test_versions(spark):
    df = spark.createDataFrame([("24.1.3.0",), ("v7.2",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(X.major_minor(F.col("v"))).collect()] == ["24.1", "7.2", "0.0", "0.0"]


def test_loc_of_any_body(spark):
    bodies = ["", "a", "a\n", "a\nb", "\n", None]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    assert [r[0] for r in df.select(X.body_loc(F.col("b"))).collect()] == [b.count("\n") + 1 if b else 0 for b in bodies]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcdAB"), max_size=6), st.lists(st.sampled_from("abcdAB"), max_size=6))
def test_distance_within_the_limit(a, b):
    from sedimenta.functions.repair import distance

    def full(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            new = [i]
            for j, d in enumerate(y, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    a, b = "".join(a), "".join(b)
    want = full(a, b)
    assert distance(a, b) == want if abs(len(a) - len(b)) <= 2 else distance(a, b) == 3
