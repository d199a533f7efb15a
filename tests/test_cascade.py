import difflib
import random
import re

from pyspark.sql import functions as F

from ordermill.operators import cascade, messages

ITEM, ROW = "item long, cust string, code string, told string", "row long, cust string, entry string, internal string, d string"
MASTER = [
    (1, "c", "AB-1234", "000000000007000001", "Preikol B4215 black"), (2, "c", "ab-1234", "000000000007000002", "Other X9999"), (3, "c", "45671 X", "000000000007000003", "Stanol G7788 GF30 nat"), (4, "c", "ZZ/Q-77", "7000004", "Durol H1212"), (5, "c", "RESIN, TYPE X 703126", "7000005", None), (6, "c", "KLM9900887", "7000006", None),
    (7, "d", "AB-1234", "7000007", "Preikol B4215 black"), (8, "d", "GLOB55", "7000008", "Globulin P6677 UV superfine"), (9, "c", None, None, None), (10, "c", "", "", ""),
]
CASES = [
    ("AB-1234", None, 1, 0), ("aB-1234", None, 1, 1), ("7000001", None, 1, 2), ("000000000007000003", None, 3, 2), ("7000003 (black)", None, 3, 3), ("zz\\q-77", None, 4, 1), ("AB-1234 black", None, 1, 4), ("ZZ/Q", None, 4, 5), ("45671-99", None, 3, 6),
    ("XKLM9900887", None, 6, 7), ("KLM9900987", None, 6, 8), ("A.B.1.2.3.4", None, 1, 9), ("B 4215", None, 1, 10), (None, "STANOL G 7788 GF30 (bag)", 3, 11), ("?", "klm 9900887 as usual", 6, 12), (None, "type x resin 703126", 5, 13), ("QQQ/KLM9900887", None, 6, 7), ("nothing", "at all", None, None), (None, None, None, None), ("", "", None, None), ("x" * 30000, "y " * 9000, None, None),
]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tiers(spark):
    items = spark.createDataFrame([(i, "c", c, t) for i, (c, t, _, _) in enumerate(CASES)], ITEM)
    got = {r["item"]: (r["row"], r["tier"]) for r in cascade.match_codes(items, spark.createDataFrame(MASTER, ROW), ["cust"]).collect()}
    for i, (c, t, row, tier) in enumerate(CASES):
        assert got.get(i) == ((row, tier) if row else None), (c and c[:40], t and t[:40], got.get(i))
    assert cascade.match_codes(items.limit(0), spark.createDataFrame(MASTER, ROW), ["cust"]).count() == 0


def test_anywhere(spark):
    items = spark.createDataFrame([(1, "c", "P6677", None), (2, "c", "x", "UV P 6677 globulin special"), (3, "c", "zz", "foo bar baz"), (4, "c", None, None)], ITEM)
    assert rows(cascade.match_anywhere(items, spark.createDataFrame(MASTER, ROW))) == [(1, 8, 14), (2, 8, 15)]


def test_finder_against_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "black", "white", "bag"]
    master = [(i, rng.choice("cd"), f"{rng.choice('ABC')}{rng.randrange(100, 999)}", str(7000 + i), " ".join(rng.sample(words, 4))) for i in range(40)]
    items = [(i, rng.choice("cd"), rng.choice([m[2] for m in master] + ["", "none", str(7000 + i)]), " ".join(rng.sample(words, rng.randrange(1, 6)))) for i in range(80)]
    clean = lambda s: re.sub("[^a-z0-9]", "", (s or "").lower())

    def find(item):
        own = [m for m in master if m[1] == item[1]]
        key, told = clean(item[2]), item[3]
        for n, hit in enumerate((
            lambda m: key and (clean(m[2]) == key or (len(key) >= 4 and len(clean(m[2])) >= 4 and (clean(m[2]) in key or key in clean(m[2])))),
            lambda m: item[2] and item[2].lstrip("0") == m[3].lstrip("0"), lambda m: len(clean(m[2])) >= 4 and clean(m[2]) in clean(told),
        ), 1):
            hits = [m for m in own if hit(m)]
            if hits:
                return item[0], min(h[0] for h in hits), n, 1.0
        best = (0.0, None)
        for m in own:
            a, b = set(told.split()), set(m[4].split())
            score = 0.6 * len(a & b) / len(a | b) + 0.4 * difflib.SequenceMatcher(None, told, m[4]).ratio()
            if score > best[0]:
                best = (score, m[0])
        return (item[0], best[1], 4, best[0]) if best[0] >= 0.35 else None

    got = rows(cascade.find_material(spark.createDataFrame(items, ITEM), spark.createDataFrame(master, ROW), ["cust"]))
    want = sorted(x for x in map(find, items) if x)
    assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))


def test_candidates_against_all_pairs(spark):
    """Containment, prefixes, likeness and rare words against every pair."""
    rng = random.Random(5)
    word = lambda a, b: "".join(rng.choice("ab1") for _ in range(rng.randrange(a, b)))
    left, right = [(i, word(1, 14)) for i in range(60)], [(i, word(1, 22)) for i in range(60)]
    a, b = spark.createDataFrame(left, "i int, s string"), spark.createDataFrame(right, "j int, t string")
    pairs = lambda df: {(r["i"], r["j"]) for r in df.collect()}
    assert pairs(cascade.contained_pairs(a, b, [], "s", "t")) == {(i, j) for i, s in left for j, t in right if len(s) >= 3 and s in t}
    assert pairs(cascade.either_contains(a, b, [], "s", "t", 4)) == {(i, j) for i, s in left for j, t in right if min(len(s), len(t)) >= 4 and (s in t or t in s)}
    assert pairs(cascade.prefix_pairs(a, b, [], "s", "t")) == {(i, j) for i, s in left for j, t in right if len(s) >= 3 and t.startswith(s)}
    ratio = lambda s, t: difflib.SequenceMatcher(None, s, t).ratio()
    want = {(i, j) for i, s in left for j, t in right if min(len(s), len(t)) >= 6 and abs(len(s) - len(t)) <= 4 and not s.isdigit() and not t.isdigit() and ratio(s, t) >= 0.82}
    assert want and pairs(cascade.alike_pairs(a, b, [], "s", "t")) == want
    sets = [(i, rng.sample("abcdefghij", rng.randrange(1, 7))) for i in range(50)]
    x, y = spark.createDataFrame(sets, "i int, x array<string>"), spark.createDataFrame(sets, "j int, y array<string>")
    want = {(i, j) for i, s in sets for j, t in sets if len(set(s) & set(t)) >= 0.6 * len(s)}
    assert want <= pairs(cascade.rare_token_pairs(x, y, "x", "y", "i", "j", 0.6))


def test_place_rules(spark):
    places = [("p1", "c", "ACME Plant A", "Brakenau", "10113", 1), ("p2", "c", "ACME Plant B", "Tessendorn", "12 345", 2), ("p3", "c", "ACME Storage Velm", "Velmünde", "20000", 3), ("p4", "c", "ACME Transport Velm", "Velmünde", "20000", 4), ("q1", "d", "Other", "Farville", "99999", 5), ("p5", "c", None, None, None, 6)]
    records = [
        (1, "c", "p2", "x", None, None, ("p2", 1)), (2, "c", None, "Deliver to plant B", None, None, ("p2", 2)), (3, "c", None, "terms DAP Tessendorn", None, None, ("p2", 4)), (4, "c", None, "any", "12-345", None, ("p2", 5)),
        (5, "c", None, "Transport yard, Velmünde", "20000", None, ("p4", 6)), (6, "c", None, "any", "99999", None, ("q1", 7)), (7, "c", None, "storage hall, Velmünde 7", None, None, ("p3", 10)), (8, "c", None, None, None, None, ("", 11)), (9, "c", None, "zzz", None, None, None), (10, "zz", None, "plant A", None, None, None),
    ]
    r = spark.createDataFrame([x[:6] for x in records], "record int, customer string, explicit string, address string, postcode string, city string")
    got = {x["record"]: (x["place"], x["rule"]) for x in cascade.resolve_places(r, spark.createDataFrame(places, "place string, customer string, name string, city string, postcode string, order int")).collect()}
    for x in records:
        assert got.get(x[0]) == x[-1], (x, got.get(x[0]))


def test_messages(spark):
    m = spark.createDataFrame([(1, "Order 4500012", [("PO4500099.pdf",)], ("text", "see 4500077")), (2, "x", [("other.pdf",)], ("text", "4500012")), (3, None, None, None)], "message_no int, subject string, attachments array<struct<name string>>, body struct<contentType string, content string>")
    n = spark.createDataFrame([("4500012",), ("4500099",), ("4500077",), ("4500000",), ("12",), (None,)], "number string")
    assert rows(messages.messages_of(n, m)) == [("4500012", 1, 1), ("4500077", 1, 2), ("4500099", 1, 0)]
    f, a = spark.createDataFrame([("PO123.PDF",), ("order77.pdf",), ("abc.pdf",)], "file string"), spark.createDataFrame([("po123.pdf",), ("order77.xlsx",), ("my_order77_b.doc",), ("abcd.x",)], "name string")
    assert rows(messages.attachments_of_files(f, a)) == [("PO123.PDF", "po123.pdf", 0), ("order77.pdf", "order77.xlsx", 1)]


def test_messages_against_all_pairs(spark):
    """Numbers of any form against every text; texts are searched whole only for numbers that aren't one word with a digit."""
    rng = random.Random(7)
    text = lambda a, b: "".join(rng.choice("1123 -ab#") for _ in range(rng.randrange(a, b)))
    mails = [(i, text(0, 40), [(text(0, 20),) for _ in range(rng.randrange(3))], ("text", text(0, 300))) for i in range(60)]
    mails += [(60, None, None, None), (61, None, [(None,)], ("text", None))]
    m = spark.createDataFrame(mails, "message_no int, subject string, attachments array<struct<name string>>, body struct<contentType string, content string>")
    asked = [text(3, 8) for _ in range(150)] + ["11", None, "", "1" * 12, *[mails[i][3][1][20:32] for i in range(20)]]
    told = [(i, tier, t) for i, s, a, b in mails for tier, ts in enumerate(([x for x, in a or []], [s], [b and b[1]])) for t in ts if t]
    n = lambda keep: spark.createDataFrame([(x,) for x in asked if x is None or keep(x)], "number string")
    plain = lambda x: " " not in x.strip(" ") and "#" not in x and any(c in "123" for c in x)
    for keep in (plain, lambda x: True):
        want = {}
        for x in {x.strip(" ") for x in asked if x and keep(x) and len(x.strip(" ")) >= 5}:
            hits = [(tier, i) for i, tier, t in told if x in t]
            if hits:
                want[x] = min(hits)
        assert len(want) > 5 and rows(messages.messages_of(n(keep), m)) == sorted((x, i, tier) for x, (tier, i) in want.items())
    # one look-up over distinct words, besides the join to one row of lengths; no text in a join
    plan = messages.messages_of(n(plain), m)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2, plan
