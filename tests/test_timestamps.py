import datetime as dt
import random
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from ordermill.operators.timestamps import normalize_timestamps, order_timestamps

SCHEMA = "k long, source string, value string, date_order string, time_zone string"
CASES = [
    ("31.12.2024", "DMY", "Europe/Berlin", "2024-12-31"), ("01/02/2024", "DMY", "Europe/Berlin", "2024-02-01"), ("01/02/2024", "MDY", "America/New_York", "2024-01-02"), ("24/01/02", "YMD", "Asia/Tokyo", "2024-01-02"),
    ("20240116", "DMY", "Europe/Berlin", "2024-01-16"), ("45301", "DMY", "Europe/Berlin", "2024-01-10"), ("1704203254", "DMY", "Europe/Berlin", "2024-01-02T13:47:34Z"), ("1704203254240", "DMY", "Europe/Berlin", "2024-01-02T13:47:34Z"),
    ("Fri, 29 Dec 2023 14:06:49 +0900", "YMD", "Asia/Tokyo", "2023-12-29T05:06:49Z"), ("2024-01-26 04:26 AM", "MDY", "America/New_York", "2024-01-26T09:26:00Z"), ("2024-01-26 12:26 AM EST", "MDY", "America/New_York", "2024-01-26T05:26:00Z"),
    ("01-AUG-2025 14:12:50 GMT+08:00", "YMD", "Asia/Shanghai", "2025-08-01T06:12:50Z"), ("2024-04-14 03:13:03 UTC+8", "YMD", "Asia/Shanghai", "2024-04-13T19:13:03Z"), ("2024年1月24日", "YMD", "Asia/Tokyo", "2024-01-24"), ("2024년 01월 03일", "YMD", "Asia/Seoul", "2024-01-03"),
    ("17 février 2024", "DMY", "Europe/Berlin", "2024-02-17"), ("3. März 2024", "DMY", "Europe/Berlin", "2024-03-03"), ("December 18, 2024", "MDY", "America/New_York", "2024-12-18"), ("20231029T010005Z", "DMY", "Europe/Berlin", "2023-10-29T01:00:05Z"),
    ("2024-10-27 02:30", "DMY", "Europe/Berlin", "2024-10-27T00:30:00Z"), ("2024-10-27 02:30 CET", "DMY", "Europe/Berlin", "2024-10-27T01:30:00Z"), ("04-27-2024 07:02 America/New_York", "MDY", "America/New_York", "2024-04-27T11:02:00Z"),
    ("2025-02-18 08:28:58 CST", "YMD", "Asia/Shanghai", "2025-02-18T00:28:58Z"), ("2024-01-10 07:25:25.651296-05:00", "MDY", "America/New_York", "2024-01-10T12:25:25Z"), (" 01/03/2024 ", "DMY", "Europe/London", "2024-03-01"),
]
NONE = ["", None, "tbd", "ASAP", "KW 10/2025", "week 9", "00/00/0000", "0/00/00", "31/02/2025", "2025-13-05", "2024-03-31 02:30", "2024-01-01 25:00", "99 Foo 2024", "x" * 30000]


def read(spark, rows):
    return {r["k"]: r for r in normalize_timestamps(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_forms(spark):
    got = read(spark, [(i, "s", v, o, z) for i, (v, o, z, _) in enumerate(CASES)])
    for i, (v, _, _, want) in enumerate(CASES):
        assert i in got and got[i]["value_utc"] == want and got[i]["status"] == "resolved", (v, got.get(i))


def test_no_single_day(spark):
    assert read(spark, [(i, "s", v, "DMY", "Europe/Berlin") for i, v in enumerate(NONE)]) == {}


def test_source_decides_without_region(spark):
    known = [(i, "us", f"{1 + i % 12:02d}/{13 + i % 15}/2024", "MDY", "America/New_York") for i in range(40)]
    mixed = [(100 + i, "mix", f"{1 + i % 12:02d}/{13 + i % 15}/2024", None, None) for i in range(20)] + [(200 + i, "mix", f"{13 + i % 15}/{1 + i % 12:02d}/2024", None, None) for i in range(20)]
    got = read(spark, [*known, *mixed, (1000, "us", "02/03/2024", None, None), (1001, "mix", "02/03/2024", None, None), (1002, "mix", "05/05/2024", None, None), (1003, "us", "02/03/2024 10:00", None, None), (1004, "new", "02/03/2024", None, None)])
    assert got[1000]["value_utc"] == "2024-02-03" and got[1003]["value_utc"] == "2024-02-03T15:00:00Z"
    assert got[1001]["status"] == "ambiguous" and got[1001]["value_utc"] is None and got[1004]["status"] == "ambiguous"
    assert got[1002]["value_utc"] == "2024-05-05"


def test_round_trip(spark):
    rng, rows, want = random.Random(5), [], []
    ways = ["%Y-%m-%d %H:%M:%S", "%d.%m.%Y %H:%M:%S", "%d/%m/%Y, %H:%M:%S", "%d-%m-%Y %H:%M:%S", "%Y.%m.%d %H:%M:%S"]
    for i in range(400):
        zone = rng.choice(["Europe/Berlin", "America/New_York", "Asia/Kolkata"])
        utc = dt.datetime(2023, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=rng.randrange(3 * 365 * 86400))
        local = utc.astimezone(ZoneInfo(zone))
        if local.fold or local.replace(fold=1).utcoffset() != local.utcoffset():
            continue
        rows.append((i, "s", local.strftime(rng.choice(ways)), "DMY", zone))
        want.append((i, utc.strftime("%Y-%m-%dT%H:%M:%SZ")))
    got = read(spark, rows)
    assert [(k, got[k]["value_utc"]) for k, _ in want] == want


def test_empty_null_and_clashing_columns(spark):
    assert normalize_timestamps(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, None, "2024-01-02", None, None)] * 2, SCHEMA).withColumns({"w_dmy": F.lit(1), "zone": F.lit("x"), "known": F.lit(1)})
    assert [r["value_utc"] for r in normalize_timestamps(df.select(*[c for c in df.columns if c not in ("w_dmy", "zone", "known")])).collect()] == ["2024-01-02"] * 2


def test_orders(spark):
    headers = spark.createDataFrame([(1, "E1", "a", "01.02.2024", None), (2, None, "a", "tbd", "2024-03-04")], "record_id long, sales_organization string, sender_email string, order_date string, requested_delivery_date string")
    lines = spark.createDataFrame([(10, 1, "a", "05/06/24"), (11, 9, "b", "2024-05-05")], "line_id long, record_id long, sender_email string, delivery_date string")
    regions = spark.createDataFrame([("EU", ["E1"], "DMY", "Europe/Berlin")], "region string, sales_orgs array<string>, date_order string, time_zone string")
    got = {(r["field"], r["row_id"]): r["value_utc"] for r in order_timestamps(headers, lines, regions).collect()}
    assert got == {("order_date", 1): "2024-02-01", ("requested_delivery_date", 2): "2024-03-04", ("delivery_date", 10): "2024-06-05", ("delivery_date", 11): "2024-05-05"}


def test_posterior_of_each_value(spark):
    """Region and source together: the region always decides where its order fits; elsewhere the source's mixture does."""
    rows = [(i, "s", f"{1 + i % 12:02d}/{13 + i % 15}/2024", "MDY", "America/New_York") for i in range(3000)]
    rows += [(9000, "s", "02/03/2024", "DMY", "Europe/Berlin"), (9001, "s", "02/03/2024", "MDY", "America/New_York"), (9002, "s", "25/12/2024", "DMY", "Europe/Berlin"), (9003, "planted", "02/03/2024", None, None)]
    # a planted source that writes both orders alike stays open
    rows += [(9100 + i, "planted", v, None, None) for i, v in enumerate(["13/01/2024", "01/13/2024"] * 20)]
    got = read(spark, rows)
    assert (got[9000]["value_utc"], got[9001]["value_utc"], got[9002]["value_utc"]) == ("2024-03-02", "2024-02-03", "2024-12-25")
    assert 0.99 < got[9000]["posterior"] < got[9001]["posterior"] < 1 and got[9002]["posterior"] == 1.0
    assert got[9003]["status"] == "ambiguous" and got[9003]["value_utc"] is None and got[9003]["posterior"] < 0.6
