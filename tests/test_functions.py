import difflib

from pyspark.sql import functions as F

from ordermill.functions import dates, numbers, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_nullish(spark):
    words = [None, "", " ", "NaN", "None ", "n/a", "-", "#N/A", "null", "x"]
    got = values(spark, [(w,) for w in words], "c string", text.is_nullish(F.col("c")), text.is_nullish(F.col("c"), "field"))
    assert [g[0] for g in got] == [True] * 9 + [False]
    assert [g[1] for g in got] == [True, True, True, True, True, False, False, False, False, False]


def test_combined_and_undoubled(spark):
    got = values(spark, [("ACME", "acme", None), ("A", "AB", "B"), (None, " ", "x")], "a string, b string, c string", text.combined(F.col("a"), F.col("b"), F.col("c")))
    assert got == [("ACME",), ("A AB B",), ("x",)]
    got = values(spark, [("ACME GMBH ACME GMBH",), ("ACME GMBH ACME GMBHStreet 1",), ("ACME",), ("A B A",)], "a string", text.undoubled(F.col("a")))
    assert got == [("ACME GMBH",), ("ACME GMBH Street 1",), ("ACME",), ("A B A",)]


def test_codes(spark):
    got = values(spark, [("00120",), ("000",), ("ÄB-1",)], "a string", text.no_zeros(F.col("a")), text.padded(F.col("a"), 6), text.code_key(F.col("a")), text.ascii_key(F.col("a")))
    assert got == [("120", "000120", "00120", "00120"), ("0", "000000", "000", "000"), ("ÄB-1", "00ÄB-1", "äb1", "b1")]


def test_row_key_ignores_case_and_blanks(spark):
    got = values(spark, [("A", " x "), ("a ", "X"), (None, "x"), ("", "x")], "a string, b string", text.row_key(F.col("a"), F.col("b")))
    assert got[0] == got[1] and got[2] == got[3] and got[0] != got[2]


def test_overlaps(spark):
    got = values(spark, [("red B4215 bulk", "RED b4215"), ("", "x")], "a string, b string", *[f(text.tokens(F.col("a"), 1), text.tokens(F.col("b"), 1)) for f in (text.overlap, text.short_overlap, text.jaccard)])
    assert got[0] == (2 / 3, 1.0, 2 / 3) and got[1] == (0.0, 0.0, 0.0)


def test_files_and_postcodes(spark):
    got = values(spark, [("/a/b/Order.1.PDF",), ("x",)], "p string", text.file_name(F.col("p")), text.file_stem(F.col("p")), text.file_extension(F.col("p")))
    assert got == [("Order.1.PDF", "Order.1", "pdf"), ("x", "x", "")]
    got = values(spark, [("Kelsbury CD86 5KS",), ("8901 JB Hertenveld",), ("78-012 X",), ("4000-123 P",), ("10710 G",), ("none",)], "p string", text.postcode(F.col("p")))
    assert [g[0] for g in got] == ["CD86 5KS", "8901 JB", "78-012", "4000-123", "10710", None]


def test_tags(spark):
    assert values(spark, [("<p>a<!-- <b> --> <br>b</p>",)], "h string", text.without_tags(F.col("h"))) == [("a b",)]


def test_arrow_functions(spark):
    pairs = [("abcd", "bcde"), ("", "x"), (None, "x"), ("ab" * 150, "ba" * 150)]
    got = values(spark, pairs, "a string, b string", text.sequence_ratio("a", "b"))
    assert [g[0] for g in got] == [None if a is None else difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert values(spark, [("Äé",), (None,)], "a string", text.accentless("a")) == [("Ae",), (None,)]
    got = values(spark, [('```json\n{"a": [1, 2,],}\n```',), ("no",), (None,), ('{"a": "}"} x',)], "a string", text.mended_json("a"))
    assert got == [('{"a": [1, 2]}',), (None,), (None,), ('{"a": "}"}',)]


def test_numbers(spark):
    words = ["1,000", "abc", "", "1.000,00", "1,000.00", "24,000", "1,5", "1.500", "500 kg", "1d"]
    got = values(spark, [(w,) for w in words], "q string", numbers.plain_number(F.col("q")), numbers.comma_decimal(F.col("q")), numbers.grouped_number(F.col("q")))
    assert [g[0] for g in got] == [1000, None, None, 1.0, 1000, 24000, 15, 1.5, None, None]  # commas go, the point stays decimal
    assert [g[1] for g in got] == [1.0, None, None, 1000, 1000, 24, 1.5, 1.5, 500, 1]
    assert [g[2] for g in got] == [1000, None, None, 1000, 1000, 24000, 1.5, 1500, 500, 1]
    assert values(spark, [(1, 8), (0, 0)], "a int, b int", numbers.percent(F.col("a"), F.col("b"))) == [(12.5,), (0.0,)]


def test_dates(spark):
    got = values(spark, [("2024-01-02T03:04:05",), ("2024-01-02 03:04:05",), ("2024-01-02",), ("x",)], "d string", F.date_format(dates.read_timestamp(F.col("d")), "yyyy-MM-dd HH:mm:ss"))
    assert [g[0] for g in got] == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", "2024-01-02 00:00:00", None]
    got = values(spark, [("2024-01-01 00:00:00", "2024-01-01 11:30:00"), (None, "2024-01-01 00:00:00")], "a string, b string", dates.age_hours(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")))
    assert [g[0] for g in got] == [11.5, 0.0]
    assert values(spark, [("0/00/00",), ("00/00/0000",), ("01/01/2024",)], "d string", dates.is_null_date(F.col("d"))) == [(True,), (True,), (False,)]
