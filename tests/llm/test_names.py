import random

from ordermill.llm.names import grams, link_customers, link_names, parse_name, token_similarity

MASTER = [("1", "Preixdicherk Automotive LLC"), ("2", "Tebiaskeilt Automotive Co., Ltd."), ("3", "Wilhelm Dekrarast Plastics"), ("4", "Houbreiscle Maschinenbau KG"), ("14", "Houbreiscle Masch.bau K.G."), ("5", "Jevabox Packaging Inc."), ("6", "Jevabox Verpakkingen N.V."), ("7", "锦柏远包装有限公司"), ("8", None)]
FILL = [(str(100 + i), f"{n} {k}") for i, (n, k) in enumerate((a + b + "kro", k) for a in ("Blan", "Dro", "Stir", "Mel", "Vort", "Quin") for b in ("dusk", "feld", "garn", "helz", "jork") for k in ("Automotive LLC", "Packaging Inc.", "Plastics AG", "Maschinenbau KG", "Verpakkingen N.V."))]
CASES = [
    ("Preixdicherk Automotive, LLC Preixdicherk Automotive, LLC", {"1"}), ("PREIXDICHERKAUTOMOTIVE", {"1"}), ("Preixidcherk Autom.", {"1"}), ("STÉ TEBIASKEILT CO., LTD.", {"2"}), ("W. Dekrarast Plastics", {"3"}), ("Dekrarast, Willi Plastics", {"3"}), ("Houbreiscle", {"4", "14"}), ("houbr eiscle maschinenbau kg / 99006", {"4", "14"}),
    ("Jevabox Pkg Inc.", {"5"}), ("Jevabox Verpakkingen", {"6"}), ("Jevabox", set()), ("錦柏遠包裝股份有限公司", {"7"}), ("Unknown Moulding Ltd.", set()), ("K-8566", set()), ("100685", set()), ("see letterhead", set()), ("", set()), (None, set()), ("z" * 20000, set()),
]


def test_links(spark):
    master = spark.createDataFrame(MASTER + FILL, "customer_number string, name string")
    names = spark.createDataFrame([(n,) for n, _ in CASES], "name string")
    got = [(r["name"], r["customer_number"]) for r in link_names(names, master).collect()]
    for n, want in CASES:
        assert {c for m, c in got if m == n} == want, n


def test_customers_with_short_names(spark):
    headers = spark.createDataFrame([(1, "PRXAL"), (2, "HBMKG GB"), (3, "Tebiaskeilt Automotive"), (3, "Tebiaskeilt Automotive"), (4, None)], "record_id long, customer_id_or_name string")
    alias = spark.createDataFrame([("PRXAL", "Preixdicherk Automotive LLC", "name"), ("hbmkg", "4", "id"), (None, "x", "name")], "alias string, canonical string, kind string")
    got = sorted((r["record_id"], r["customer_number"]) for r in link_customers(headers, spark.createDataFrame(MASTER + FILL, "customer_number string, name string"), alias).collect())
    assert got == [(1, "1"), (2, "14"), (2, "4"), (3, "2"), (3, "2")]  # the organisation of number 4 has number 14 too


def test_empty(spark):
    master, names = spark.createDataFrame(MASTER, "customer_number string, name string"), spark.createDataFrame([("Jevabox Packaging Inc.",)], "name string")
    assert link_names(names.limit(0), master).count() == 0 and link_names(names, master.limit(0)).count() == 0


def test_tokens():
    assert token_similarity("cbls", "cables") > 0.8 and token_similarity("mike", "michael") > 0.9 and token_similarity("r", "robert") == 0.8
    assert token_similarity("fligauqa", "fligaqua") > 0.8 and token_similarity("moulages", "envases") == 0
    assert parse_name("Fa. ACME GMBH [763]") == (("acme",), "gmbh") and grams(("abcd",)) == ["abc", "bcd"]


def test_prefix_finds_every_pair_of_enough_overlap(spark):
    """The looked-up pairs against all pairs: none that shares enough grams and agrees is lost."""
    rng = random.Random(6)
    core = lambda: "".join(rng.choice(["ba", "ke", "li", "mo", "nu", "ra", "so", "ti", "ve", "zu"]) for _ in range(5))
    names = [core().title() for _ in range(80)]
    master = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "customer_number string, name string")
    typed = [n[:k] + n[k + 1 :] for n in names for k in (3,)]
    got = {(r["name"], r["customer_number"]) for r in link_names(spark.createDataFrame([(t,) for t in typed], "name string"), master).collect()}
    hits = sum((t, str(i)) in got for i, t in enumerate(typed))
    assert hits >= 0.95 * len(typed)


def test_texts_of_any_length(spark):
    """Names with remarks of hundreds of characters, names of two letters, and texts without end."""
    master = spark.createDataFrame(MASTER + FILL + [("20", "BP AG"), ("21", "QX Packaging Inc."), ("22", " ".join(f"Zw{a}{b}lan" for a in "abcdefgh" for b in "klmnopqr"))], "customer_number string, name string")
    cases = [("Preixdicherk Automotive LLC (" + "deliver before noon, " * 20 + ")", {"1"}), ("BP AG", {"20"}), ("bp a.g.", {"20"}), ("QX Pkg Inc.", {"21"}), (" ".join(f"Zw{a}{b}lan" for a in "abcdefgh" for b in "klmnopqr"), {"22"}), (" ".join(f"word{i}x" for i in range(9000)), set()), ("1" * 20000 + "ab", set())]
    got = [(r["name"], r["customer_number"]) for r in link_names(spark.createDataFrame([(n,) for n, _ in cases], "name string"), master).collect()]
    for n, want in cases:
        assert {c for m, c in got if m == n} == want, n[:60]


def test_candidates_against_all_pairs(spark, monkeypatch):
    """gram_candidates against every pair: all of enough shared grams are found, by pairs and by single grams alike."""
    import math

    from ordermill.llm import names as N

    rng = random.Random(7)
    core = lambda: "".join(rng.choice(["ba", "ke", "li", "mo", "nu", "ra", "so", "ti"]) for _ in range(rng.randrange(2, 7)))
    rows = [(n, grams((n,))) for n in {core() for _ in range(200)}]
    left, right = spark.createDataFrame(rows[:100], "name string, grams array<string>"), spark.createDataFrame(rows[60:], "name string, grams array<string>")
    want = {(a, b) for a, g in rows[:100] for b, h in rows[60:] if len(set(g) & set(h)) >= max(1, math.ceil(N.OVERLAP * len(g)))}
    for many in (96, 4):
        monkeypatch.setattr(N, "MANY", many)
        assert len(want) > 100 and want <= {(r["name"], r["m"]) for r in N.gram_candidates(left, right).collect()}


def test_lists_of_grams_are_not_broadcast(spark, tmp_path):
    """However small the names' file is, the pairs of grams made of it don't go through the driver."""
    import re

    from ordermill.llm import names as N

    rows = [(f"name{i}", grams((f"na{i:03d}mebakeli{i}",))) for i in range(50)]
    spark.createDataFrame(rows, "name string, grams array<string>").write.parquet(str(tmp_path / "names"))
    side = spark.read.parquet(str(tmp_path / "names"))
    found = N.gram_candidates(side, side)
    assert {(n, n) for n, _ in rows} <= {(r["name"], r["m"]) for r in found.collect()}
    # the join of hashed grams: their column is a long
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[g#\d+L\]", plan) and not re.search(r"BroadcastHashJoin \[g#\d+L\]", plan)


def test_answers_of_another_run_are_not_used():
    from ordermill.llm.names import Weights, _like_common

    a, b = Weights({"packaging": 1.0}), Weights({"automotive": 1.0})
    assert _like_common("packagin", a) and not _like_common("packagin", b) and _like_common("packagin", a)
