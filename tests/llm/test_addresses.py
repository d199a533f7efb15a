from pyspark.sql import functions as F

from ordermill.llm.addresses import match_addresses, parse_address

BOOK = [(1, "Vattaplut Allee 130, 36025 Hörlingsau, Germany", "Hörlingsau", "36025", "DE"), (2, "Vattaplut All. 130; Hoerlingsau", "Hoerlingsau", None, "Germany"), (3, "Vattaplut Allee 130, 10113 Grönhausling", "Grönhausling", "10113", "DE"), (4, "Vattaplut Allee 130a, 36025 Hörlingsau", "Hörlingsau", "36025", "DE"), (5, "22 Sadriassbrar Road, Kelsbury PN86 4XF, UK", "Kelsbury", "PN86 4XF", "GB"), (6, "79 route de Hocleilt, 25170 Brévannet", "Brévannet", "25170", "FR"), (7, "Pol. Ind. Naulauja 144, 74076 Villarmonte", "Villarmonte", "74076", "ES"), (8, None, None, None, None), (9, "Baunselstraat 115, 7603 NS Oosterwolm", "Oosterwolm", "7603 NS", "NL")]
CASES = [
    ("36025 Hoerlingsau\nVattaplut Allee No. 130, Halle B", None, None, {1, 2}), ("Dock 3, 130 VATTAPLUT ALL., HÖRLINGSAU", None, None, {1, 2}), ("Vattaplut Allee 130", "10113", None, {3}), ("Vattaplut Allee 130a 36025 Horlingsau", None, None, {4}),
    ("Vattaplutt Allee 130, Hörlingsau", None, None, {1, 2}), ("Attn: Receiving; Kelsbury PN86 4XF; Sadriassbrar Rd 22", None, None, {5}), ("#79 rte de Hocleilt / 25170 Brevannet", None, None, {6}), ("Polígono Industrial Naulauja nr. 144", None, "Vill. Monte", {7}),
    ("Baunselstr. 115, 7603 NS Oosterwolm", None, None, {9}), ("Vattaplut Allee 131, 36025 Hörlingsau", None, None, set()), ("same as ship-to", None, None, set()), ("s.o.", None, None, set()), ("", None, None, set()), (None, None, None, set()), ("Vattaplut Allee 130", None, None, set()), ("x " * 20000, None, None, set()),
]


def test_matches(spark):
    book = spark.createDataFrame(BOOK, "address_id long, address string, city string, postcode string, country string")
    headers = spark.createDataFrame([(i, a, p, c, a if p is None and c is None else None) for i, (a, p, c, _) in enumerate(CASES)], "record_id long, ship_to_address string, ship_to_postcode string, ship_to_city string, sold_to_address string")
    got = [tuple(r) for r in match_addresses(headers, book).collect()]
    for i, (a, p, c, want) in enumerate(CASES):
        assert {x for r, s, x in got if (r, s) == (i, "ship_to")} == want, a
        if p is None and c is None:
            assert {x for r, s, x in got if (r, s) == (i, "sold_to")} == want, a
    assert match_addresses(headers.limit(0), book).count() == 0 and match_addresses(headers, book.limit(0)).count() == 0


def test_readings():
    p = parse_address("Magazzino, V.le Quiagogrand 135, 79219 Castelverno, Italy")
    assert ("quiagogrand".replace("m", "rn"), "viale", "135") in p.streets and "79219" in p.postcodes and p.country == "IT"
    assert parse_address("no street here") is None


def test_no_reading_is_lost(spark):
    """Addresses of which no part may be cut off: long remarks before the town, long house numbers, short towns."""
    remark = "Please announce every delivery two days ahead by telephone and do not unload before the foreman has signed all of the papers"
    book = spark.createDataFrame([(1, "Vattaplut Allee 130, Hoerlingsau", "Hoerlingsau", None, None), (2, "Rosengasse 12345, Hoerlingsau", "Hoerlingsau", None, None), (3, "Rosengasse 12345, Brakenau", "Brakenau", None, None), (4, "Rosengasse 1234, Aix", "Aix", None, None), (5, "Rosengasse 1234, Bad", "Bad", None, None)], "address_id long, address string, city string, postcode string, country string")
    cases = [(1, f"{remark}, Vattaplut Allee 130, Hoerlingsau", {1}), (2, "Unloading zone, Vattaplut Allee 130, Hoerlingsau", {1}), (3, "Rosengasse 12345, Hoerlingsau", {2}), (4, "Rosengasse 12345, Brakenau", {3}), (5, "Rosengasse 1234, Aix", {4}), (6, "Rosengasse 1234 Bad", {5}), (7, "Rosengasse 12346, Hoerlingsau", set()), (8, f"Vattaplut Allee 130 {remark * 40} Hoerlingsau", {1})]
    headers = spark.createDataFrame([(i, a, None, None, None) for i, a, _ in cases], "record_id long, ship_to_address string, ship_to_postcode string, ship_to_city string, sold_to_address string")
    got = [(r["record_id"], r["address_id"]) for r in match_addresses(headers, book).collect()]
    for i, a, want in cases:
        assert {x for r, x in got if r == i} == want, a


def test_pairs_against_all_pairs(spark):
    """The hashes against every pair of addresses of which one has a typing error: no pair that the comparison accepts is missed."""
    import random

    from ordermill.llm import addresses as A

    rng = random.Random(8)
    streets = ["".join(rng.choice("abdefgiklmnoprstu") for _ in range(9)) + rng.choice([" Allee", "strasse", " Platz"]) for _ in range(12)]
    towns = ["Hoerlingsau", "Brakenau", "Tessendorn"]

    def spoilt(t):
        i = rng.randrange(1, len(t) - 1)
        return t[:i] + rng.choice(["", "x", t[i] * 2]) + t[i + 1 :] if rng.random() < 0.5 else t

    book = [(i, f"{rng.choice(streets)} {rng.randrange(1, 4)}, {rng.choice(towns)}", None, None, None) for i in range(120)]
    asked = [(1000 + i, f"{spoilt(rng.choice(streets))} {rng.randrange(1, 4)}, {spoilt(rng.choice(towns))}", None, None, None) for i in range(220)]
    schema = "a long, text string, postcode string, city string, country string"
    left, right = A.expand(spark.createDataFrame(asked, schema)), A.expand(spark.createDataFrame(book, schema))
    found = {(r["a"], r["b"]) for r in A._pairs(left, right).collect()}
    everyone = F.array(F.lit(1).cast("long"))
    want = {(r["a"], r["b"]) for r in A._pairs(left.withColumn("keys", everyone), right.withColumn("keys", everyone)).collect()}
    assert len(want) > 500 and found <= want
    assert len(want & found) >= 0.95 * len(want), (len(want), len(want & found), sorted(want - found)[:5])
