"""Pairs of parts by their words: odd rows against SQL, and sets that very many parts share."""

import importlib
import random
from collections import Counter

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")
NAMES = ["jaccard_match", "short_set_overlap", "token_overlap_match"]
PART = "p_partkey long, p_brand string, p_name string, p_type string"


def odd_rows():
    rng = random.Random(4)
    words = ["red", "Ring", "bolt", "a", "größe", "x-9", "LARGE", "hot", "é", "rod"]
    text = lambda: rng.choice([None, "", "  ", *[rng.choice([" ", "-", ", "]).join(rng.choice(words) for _ in range(rng.randrange(1, 7))) for _ in range(12)]])
    return [(rng.choice([None, *range(150)]), rng.choice([None, "A", "A", "B", "B\nx", ""]), text(), text()) for _ in range(250)]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_against_sql(spark, tmp_path, name):
    spark.createDataFrame(odd_rows(), PART).write.parquet(f"{tmp_path}/part.parquet")
    got = Counter(tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).select("left_key", "right_key").collect())
    duck = duckdb.connect()
    duck.sql(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    want = Counter(duck.sql(f"select left_key, right_key from ({entry.oracle_sql()[name]})").fetchall())
    assert len(want) > 100 and got == want


@pytest.mark.parametrize("name", NAMES)
def test_pairs_are_made_last(spark, tmp_path, name):
    rows = [(i, "A", "red ring" if i % 3 else "red bolt", "LARGE") for i in range(600)]
    spark.createDataFrame(rows, PART).write.parquet(f"{tmp_path}/part.parquet")
    df = entry.queries()[name](spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # from the last join on only lists are written out: no join, aggregation or exchange of pairs
    last = plan[: plan.index("Join")]
    assert last.count("Generate explode") == 2 and "Aggregate" not in last, plan
    across = 0 if name == "token_overlap_match" else 200 * 400  # two of three words are shared
    assert df.count() == sum(n * (n - 1) // 2 for n in (200, 400)) + across
