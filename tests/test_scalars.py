import difflib

from pyspark.sql import functions as F

from ordermill.functions import anchored, codes, text


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_anchored(spark):
    c = F.col("t")
    rows = [("P.S. Order date: 16/06/2026 and delivery date 01.07.2026",), ("발주일: 2025년 03월 15일, 납기 2025년 04월 01일",), ("GB 232819270\n25/03/26\n90 DAYS EOM",), ("lot of 3.4.25 things",), ("none",), (None,)]
    got = one(spark, rows, "t string", anchored.order_date(c), anchored.delivery_date(c))
    assert got == [("16/06/2026", "01.07.2026"), ("2025년 03월 15일", "2025년 04월 01일"), ("25/03/26", None), ("3.4.25", None), (None, None), (None, None)]
    rows = [("Contract No.: CSG0152081 of today",), ("our purchase order no 66090745",), ("PO number: ABC",), ("Purchase Order 0000123",), (None,)]
    assert [g[0] for g in one(spark, rows, "t string", anchored.document_number(c))] == ["CSG0152081", "66090745", None, None, None]
    assert one(spark, [("Sold to party code: 4020033653; ship-to = 4100000001",)], "t string", anchored.party_id(c, "sold"), anchored.party_id(c, "ship")) == [("4020033653", "4100000001")]
    assert one(spark, [("PO Sold-to 4020010339 Materials 7001+7002.pdf",), ("x.pdf",)], "t string", anchored.id_in_file_name(c), anchored.numbers_in_file_name(c)) == [("4020010339", ["7001", "7002"]), (None, [])]
    assert [g[0] for g in one(spark, [("Hi\n> From: Joe Doe <Joe.Doe@A.example>\nTo: x@b.example",), ("From: week 9",), (None,)], "t string", anchored.sender(c))] == ["joe.doe@a.example", None, None]
    rows = [("Weg 1, 12345 Bad Homburg, DE", "12345"), ("Weg 1, 12345", "12345"), ("x", None), ("8901 JB Hertenveld (dock 3)", "8901 JB")]
    assert [g[0] for g in one(spark, rows, "t string, p string", anchored.town_after_postcode(c, F.col("p")))] == ["Bad Homburg", None, None, "Hertenveld"]
    assert one(spark, [("please ship DAP: Freilassing soon",)], "t string", anchored.town_of_terms(c)) == [("Freilassing",)]
    assert one(spark, [("12 345",), ("D-1234",), ("",), (None,)], "t string", anchored.postcode_tokens(c)) == [(["12", "345", "12345"],), (["D1234"],), ([],), ([],)]
    assert one(spark, [("Geb. C 12, QA 7788, KHW, DAP",), (None,)], "t string", anchored.identifiers(c)) == [(["C12", "QA7788", "KHW"],), ([],)]
    assert one(spark, [("ACME Storage Hall X", "acme hall 3"), ("", "x"), (None, None)], "n string, t string", anchored.word_share(F.col("n"), c)) == [(0.5,), (0.0,), (0.0,)]


def test_codes(spark):
    c = F.col("t")
    assert one(spark, [("Pocol B3235 (bag) black",), (None,)], "t string", codes.bare_code(c, ("pocol ",))) == [("B3235",), (None,)]
    assert one(spark, [("Pocol B 4215 black (x) for NA",)], "t string", codes.grade_tokens(c, ("pocol",))) == [(["b4215", "black"],)]
    got = one(spark, [("25Kg",), ("1.500 kg",), ("70620 EUR",), ("B4215",), ("RESIN, TYPE X",), (None,)], "t string", codes.is_amount(c), codes.is_descriptive(c), codes.mostly_digits(c))
    assert got == [(True, False, False), (True, False, True), (True, True, True), (False, False, True), (False, True, False), (False, False, False)]
    assert [g[0] for g in one(spark, [("221LA112",), ("City Bank",), ("45000123",), (" ",), (None,)], "t string", codes.plausible_number(c, ("cash",), ("bank",)))] == [False, False, True, False, False]
    assert one(spark, [("4500/",), ("45 \\",)], "t string", codes.without_end_slashes(c)) == [("4500",), ("45",)]
    assert one(spark, [("a\\b/c",)], "t string", codes.slash_forms(c)) == [(["a\\b/c", "a/b/c", "a\\b\\c"],)]
    assert one(spark, [("x" * 50,), ("",), (None,)], "t string", codes.shown(c, 4)) == [("xxxx...",), ("-",), ("-",)]
    assert one(spark, [("ACME Sellers Ltd", "", "Real St 1"), ("Buyer", "a", "b")], "t string, a string, b string", codes.seller_guard(c, ("sellers",), F.col("a"), F.col("b"))) == [("Real St 1",), ("Buyer",)]


def test_names_and_ratios(spark):
    rows = [("ACMÉ S.A. ACMÉ S.A.",), ("Firma Müller GmbH & Co. KG",), ("海星科技有限公司",), ("GmbH",), ("",), (None,)]
    assert [g[0] for g in one(spark, rows, "t string", text.plain_name("t"))] == ["acme", "muller", "海星科技", "gmbh", "", None]
    pairs = [("red blue", "BLUE red"), ("acme", "the acme company"), (None, "x"), ("", "x")]
    got = one(spark, pairs, "a string, b string", text.token_sort_ratio("a", "b"), text.partial_ratio("a", "b"))
    assert got[0][0] == 1.0 and got[1][1] == 1.0 and got[2] == (None, None) and got[3][1] == 0.0
    want = max(difflib.SequenceMatcher(None, "abcdef", "xxabcxdefxx"[i : i + 6]).ratio() for i in range(6))
    assert abs(one(spark, [("abcdef", "xxabcxdefxx")], "a string, b string", text.partial_ratio("a", "b"))[0][0] - want) < 0.2
    assert one(spark, [("<b>a &amp; b</b> &#228;",)], "t string", text.unescaped(text.without_tags(F.col("t")))) == [("a & b ä",)]


def test_json(spark):
    rows = [('{"data": {"a": 1}}',), ('x {"a": [1,],} y',), ('{"a": 2}',), ("no",), (None,)]
    got = [g[0] for g in one(spark, rows, "t string", F.get_json_object(text.sound_json(F.col("t")), "$.a"))]
    assert got == ["1", "[1]", "2", None, None]
    rows = [('{"data": {"url": "https://a/b/c.pdf"}}',), ('{"filename": "d.pdf"}',), ("e.pdf",), ("{}",), (None,)]
    assert [g[0] for g in one(spark, rows, "t string", text.event_file(F.col("t")))] == ["c.pdf", "d.pdf", "e.pdf", None, None]
