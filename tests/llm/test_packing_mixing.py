import random

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm.mixing import fill, mix_shares, mix_sources, plan_budgets
from ordermill.llm.packing import pack, pack_documents
from ordermill.llm.tokens import count_tokens, encoding


def test_pack_follows_sum_of_squares():
    """Every choice against all levels, counted anew."""
    rng = random.Random(2)
    capacity, sizes = 20, [rng.randrange(1, 21) for _ in range(300)]
    levels: list[int] = []
    for c, h, s in pack(sizes, capacity):
        counts = np.bincount([x for x in levels if x < capacity], minlength=capacity + 1)
        counts[0] = 0

        def after(level):
            n = counts.copy()
            if level:
                n[level] -= 1
            if level + s < capacity:
                n[level + s] += 1
            return int((n**2).sum())

        options = [0, *[x for x in range(1, capacity - s + 1) if counts[x]]]
        assert after(h) == min(map(after, options))
        if c == len(levels):
            assert h == 0
            levels.append(0)
        assert levels[c] == h
        levels[c] += s
    assert max(levels) <= capacity and sum(levels) == sum(sizes)


def docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["order", "quantity", "red", "KG"]) for _ in range(rng.randrange(1, 400))), rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice(["s1", "s2", "s2", "s2", "s3"])) for i in range(300)]
    return spark.createDataFrame([*rows, (900, "", "a", "x", "s1"), (901, None, "a", "x", "s1"), (902, "word " * 9000, "a", "x", "s2")], "doc_id long, text string, doc_type string, lang string, source string")


def test_packed(spark):
    d, caps = docs(spark), spark.createDataFrame([(1, 128), (2, 1024), (3, 0)], "capacity_id int, capacity_tokens int")
    got = pack_documents(d, caps).toPandas()
    sizes = {r["doc_id"]: r["tokens"] for r in count_tokens(d, "doc_id").collect() if r["tokens"]}
    for cid, cap in ((1, 128), (2, 1024)):
        g = got[got.capacity_id == cid]
        assert g.groupby("doc_id").tokens.sum().to_dict() == sizes
        assert (g[g.doc_id.map(sizes) <= cap].groupby("doc_id").piece.count() == 1).all()
        assert g.groupby("container").tokens.sum().max() <= cap
        for _, c in g.sort_values("position").groupby("container"):
            assert list(c.position) == [0, *np.cumsum(c.tokens)[:-1]]
        assert g.drop_duplicates("container").fill.mean() > 0.95
    assert set(got.capacity_id) == {1, 2} and pack_documents(d.limit(0), caps).count() == 0


def test_tokens_are_whole(spark):
    e = encoding()
    d = docs(spark)
    want = {r["doc_id"]: len(e.encode_ordinary(r["text"])) if r["text"] else 0 for r in d.collect()}
    assert {r["doc_id"]: r["tokens"] for r in count_tokens(d, "doc_id").collect()} == want


def test_fill_goes_to_siblings_first():
    assert fill(100, [1, 1], [10, 500]) == [10, 90]
    assert np.allclose(fill(90, [1, 2, 0], [100, 100, 100]), [30, 60, 0])
    budgets = plan_budgets({("d1", "s1"): (0.25, 10.0), ("d1", "s2"): (0.25, 1000.0), ("d2", "s1"): (0.5, 1000.0)}, 400)
    assert np.allclose([budgets["d1", "s1"], budgets["d1", "s2"], budgets["d2", "s1"]], [10, 190, 200])
    assert plan_budgets({}, 5) == {}


def test_mix(spark):
    d = docs(spark)
    targets = spark.createDataFrame([("s1", 0.5, 2), ("s2", 0.3, 1), ("s3", 0.2, 1), ("gone", 0.1, 1)], "source string, target_share double, max_repeats int")
    a = mix_sources(d, targets, budget=40_000)
    b = mix_sources(d.repartition(7), targets, budget=40_000)
    rows = lambda x: sorted(tuple(r) for r in x.collect())
    assert rows(a) == rows(b)
    uses = a.groupBy("source", "doc_id").count().groupBy("source").agg(F.max("count")).collect()
    assert all(r[1] <= {"s1": 2, "s2": 1, "s3": 1}[r["source"]] for r in uses)
    total = a.agg(F.sum("tokens")).collect()[0][0]
    assert 0.9 * 40_000 < total <= 40_000
    shares = {r["source"]: r for r in mix_shares(a, targets).collect()}
    assert shares["gone"]["uses"] == 0 and abs(sum(r["share"] for r in shares.values()) - 1) < 1e-9
    assert abs(shares["s2"]["share"] - 0.3 / 1.0) < 0.15
    assert mix_sources(d.limit(0), targets).count() == 0
