import random

from pyspark.sql import functions as F

from ordermill.operators import keyed, matching, profile


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_completeness_and_groups(spark):
    df = spark.createDataFrame([("a", "x"), ("a", " "), ("b", None), ("b", "n/a")], "g string, v string")
    assert rows(profile.completeness(df)) == [("g", 4, 0, 4, 100.0), ("v", 4, 3, 1, 25.0)]
    assert rows(profile.missing_by_group(df, "g", "v")) == [("a", 2, 1, 50.0), ("b", 2, 2, 100.0)]
    assert rows(profile.groups_without(df, "g", F.col("v") == "x")) == [("b",)]
    assert rows(profile.completeness(df.limit(0))) == [("g", 0, 0, 0, 0.0), ("v", 0, 0, 0, 0.0)]


def test_mode_first_seen_wins_ties(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "a", 4), ("k", "b", 3), ("m", None, 5), ("n", "z", 6)], "k string, v string, o int")
    assert rows(profile.mode_by(df, ["k"], "v", "o")) == [("k", "b", 2), ("n", "z", 1)]


def test_first_filled_and_lists(spark):
    df = spark.createDataFrame([("k", "", 1), ("k", "b", 2), ("k", "a", 3), ("m", None, 1)], "k string, v string, o int")
    assert rows(profile.first_filled_by(df, ["k"], ["v"], "o"))[0] == ("k", "b")
    assert rows(profile.listed(df.filter("v <> ''"), ["k"], "v")) == [("k", "a, b")]


def test_cut_off_stops_at_first_excess(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 9), (1, 3, 1)], "k int, o int, s int")
    assert rows(profile.cut_off(df, ["k"], "s", ["o"], 10)) == [(1, 1, 5)]
    assert rows(profile.cut_off(df, ["k"], "s", ["o"], 100, most=2)) == [(1, 1, 5), (1, 2, 9)]


def test_keep_first_is_idempotent_and_matches_brute_force(spark):
    rng = random.Random(1)
    data = [(rng.randrange(20), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, o int, i int")
    first = keyed.keep_first(df, ["k"], ["o", "i"])
    want = sorted(min((d for d in data if d[0] == k), key=lambda d: (d[1], d[2])) for k in {d[0] for d in data})
    assert rows(first) == want and rows(keyed.keep_first(first, ["k"], ["o", "i"])) == want
    assert rows(keyed.keep_first(df, ["k"], ["o", "i"], last=True)) == sorted(max((d for d in data if d[0] == k), key=lambda d: (d[1], d[2])) for k in {d[0] for d in data})


def test_registry(spark):
    df = spark.createDataFrame([("A", "1"), ("a ", "1"), ("b", "2")], "x string, y string")
    empty = spark.createDataFrame([], "row_key string")
    fresh = keyed.not_yet(df, empty, ["x", "y"])
    assert fresh.count() == 2
    assert keyed.not_yet(df, fresh.select("row_key"), ["x", "y"]).count() == 0


def test_merged(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, only string")
    new = spark.createDataFrame([(2, None, "n"), (3, "c", "m")], "k int, v string, added string")
    assert rows(keyed.merged(base, new, "k").select("k", "v", F.coalesce("only", F.lit("")), F.coalesce("added", F.lit("")))) == [(1, "a", "x", ""), (2, "b", "", "n"), (3, "c", "", "m")]


def test_compared_and_window(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string")
    assert rows(keyed.compared(a, b, "k", ["v"])) == [(1, "v", "same"), (2, "v", "only_left"), (3, "v", "only_right")]
    assert keyed.in_window_or_all(a, F.col("k") > 1).count() == 1 and keyed.in_window_or_all(a, F.col("k") > 9).count() == 2


def test_first_match(spark):
    items = spark.createDataFrame([(1, "c", "AB1"), (2, "c", "ab1"), (3, "c", "zz"), (4, "d", "AB1")], "i int, cust string, code string")
    master = spark.createDataFrame([("c", "ab1", 1), ("c", "AB1", 2), ("c", "AB1X", 3)], "cust string, m string, o int")
    tiers = [F.col("code") == F.col("m"), F.lower("code") == F.lower("m"), F.col("m").startswith(F.col("code"))]
    assert rows(matching.first_match(items, master, ["cust"], tiers, "i", "o").select("i", "m", "tier")) == [(1, "AB1", 0), (2, "ab1", 0)]


def test_contained_takes_lowest_phrase(spark):
    texts = spark.createDataFrame([(1, "Please call ahead, gate 5."), (2, "recall ahead"), (3, "")], "i int, t string")
    phrases = spark.createDataFrame([("gate 5", 1), ("call ahead", 0)], "p string, o int")
    assert rows(matching.contained(texts, phrases, "t", "p", "o", "i")) == [(1, "call ahead")]


def test_fuzzy_against_brute_force(spark):
    import difflib

    rng = random.Random(2)
    names = ["".join(rng.choice("abcde") for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    left, right = names[:15], names[15:]
    got = {r["l"]: r["score"] for r in matching.fuzzy_best(spark.createDataFrame([(x,) for x in left], "l string"), spark.createDataFrame([(x,) for x in right], "r string"), "l", "r", "l", "r").collect()}
    for a in set(left):
        scores = [s for b in right if a[:3] in b and (s := difflib.SequenceMatcher(None, a, b).ratio()) >= 0.65]
        assert (round(max(scores), 3) == got[a]) if scores else a not in got


def test_uniquely(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b")], "k int, v string")
    assert rows(matching.uniquely(df, "k", "v").filter("v is not null")) == [(1, "a", 1)]
