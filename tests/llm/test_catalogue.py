import random

from pyspark.sql import functions as F

from ordermill.llm.catalogue import map_to_catalogue, probes, segments

MATERIALS = [("UGW18433333", "000000000007000001", "Preischami B7581 MF20 black 500kg big bag"), ("8294.66.44K", "000000000007000002", "Kliskoudund K4305 GF30 white 25kg bag"), ("AAE 0489/6513", "000000000007000003", "Flawaxtrin E6668 UV yellow"), ("FCX-33174-708", "000000000007000004", "Ribeimtou E8191 CF10 yellow"), ("FCX-33174-708-NA", "000000000007000005", "Ribeimtou E8191 CF10 natural"), ("-", "000000000007000009", None), (None, "000000000007000010", "Nothing X0000 red")]
LINES = [
    ("ugw18433333", None, "UGW18433333"), ("Ihre Nr. UGW18433333", None, "UGW18433333"), ("UGW18433333 (bag)", "x", "UGW18433333"), ("UGW1843333", None, "UGW18433333"), ("UGW18433E33", None, "UGW18433333"),
    ("8294.66.44K rev.B", None, "8294.66.44K"), ("AAE O489/65I3", None, "AAE 0489/6513"), ("#AAE 0489-6513", None, "AAE 0489/6513"), ("7000002", None, "8294.66.44K"), ("000000000007000003", None, "AAE 0489/6513"),
    ("N/A", "Flawax. E-6668 yel UV", "AAE 0489/6513"), (None, "resin, e6668, flawaxtrn, yellow", "AAE 0489/6513"), ("", "Ribeimtou E8191 nat.", "FCX-33174-708-NA"), (None, "Ribeimtou E8191 gelb", "FCX-33174-708"), ("FCX 33174 708 NA", None, "FCX-33174-708-NA"),
    ("Preischami B7581 schwarz", "UGW18433333", "UGW18433333"), (None, "goods; your ref fcx-33174-708", "FCX-33174-708"), (None, "Freight charge", "UNMATCHED"), ("JJ-JJ-1221", "DOGRAUNPLAR Q331 RED", "UNMATCHED"), ("x" * 30000, None, "UNMATCHED"),
]


def tables(spark, lines):
    m = spark.createDataFrame(MATERIALS, "customer_material_number string, internal_material_number string, material_description string")
    return spark.createDataFrame(lines, "line_id long, material_code string, description string"), m


def test_lines(spark):
    rows = [(i, c, t) for i, (c, t, _) in enumerate(LINES)] + [(900, None, None), (901, "", "n/a"), (902, "-", None), (0, *LINES[0][:2])]
    got = [(r["line_id"], r["customer_material_number"]) for r in map_to_catalogue(*tables(spark, rows)).collect()]
    for i, (code, text, want) in enumerate(LINES):
        assert {v for k, v in got if k == i} == {want}, (code, text)
    assert len(got) == len(LINES) + 1


def test_empty(spark):
    lines, materials = tables(spark, [(1, "UGW18433333", None)])
    assert [r["customer_material_number"] for r in map_to_catalogue(lines, materials.limit(0)).collect()] == ["UNMATCHED"]
    assert map_to_catalogue(lines.limit(0), materials).count() == 0
    assert map_to_catalogue(lines.withColumns({"entry": F.lit("x"), "codes": F.lit(1)}), materials).count() == 1


def test_pigeonhole_join_finds_every_pair_within_two_edits(spark):
    """Against brute force on random strings."""
    rng = random.Random(4)
    refs = ["".join(rng.choice("ABC12") for _ in range(rng.randrange(8, 13))) for _ in range(60)]

    def edited(s):
        s = list(s)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(s))
            op = rng.randrange(3)
            s[i : i + (op != 1)] = [rng.choice("ABC12")] if op else []
        return "".join(s)

    asked = [edited(rng.choice(refs)) for _ in range(120)]
    q = spark.createDataFrame([(x,) for x in set(asked)], "q string").select("q", F.explode(probes(F.col("q"))).alias("p"))
    r = spark.createDataFrame([(x,) for x in set(refs)], "r string").select("r", F.explode(segments(F.col("r"))).alias("p"))
    got = {(x["q"], x["r"]) for x in q.join(r, "p").filter(F.levenshtein("q", "r") <= 2).select("q", "r").distinct().collect()}

    def distance(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    assert got == {(a, b) for a in set(asked) for b in set(refs) if distance(a, b) <= 2}


def test_codes_of_any_shape(spark):
    """Entries without digits, short and very long ones: an exact spelling always maps, edits as the length allows."""
    entries = ["AB-1234", "ABCDEFGHIJ", "ABC-1234-5678-9012-3456-78", "X7", "PN-5571", "LONG" * 60]
    m = spark.createDataFrame([(e, None, None) for e in entries], "customer_material_number string, internal_material_number string, material_description string")
    cases = [*[(e, e) for e in entries], ("AB-1235", "AB-1234"), ("AB-1255", "UNMATCHED"), ("ABCDEFGHXX", "ABCDEFGHIJ"), ("ABC-1234-5678-9012-3466-7", "ABC-1234-5678-9012-3456-78"), ("X8", "UNMATCHED"), ("LONG" * 59 + "LNG", "LONG" * 60), ("x7", "X7")]
    lines = spark.createDataFrame([(i, c, None) for i, (c, _) in enumerate(cases)], "line_id long, material_code string, description string")
    got = {r["line_id"]: r["customer_material_number"] for r in map_to_catalogue(lines, m).collect()}
    for i, (c, want) in enumerate(cases):
        assert got[i] == want, c


def test_join_for_every_number_of_edits(spark):
    """segment_join against brute force for k = 0, 1 and 2, with bounds on the length of references."""
    import random

    from ordermill.llm.catalogue import segment_join

    rng = random.Random(9)
    refs = ["".join(rng.choice("AB1") for _ in range(rng.randrange(3, 11))) for _ in range(80)]
    asked = [r[:i] + rng.choice(["", "A", "1B"]) + r[i + rng.randrange(2) :] for r in refs for i in (1, 2)]
    q, r = spark.createDataFrame([("c", x) for x in asked], "kind string, q string"), spark.createDataFrame([("c", x) for x in refs], "kind string, r string")
    for k in (0, 1, 2):
        got = {(x["q"], x["r"]) for x in segment_join(q, r, k, 4, 9).collect()}
        both = q.select("q").distinct().crossJoin(r.select("r").distinct().filter("length(r) between 4 and 8"))
        assert got == {(x["q"], x["r"]) for x in both.filter(F.levenshtein("q", "r") <= k).collect()}
