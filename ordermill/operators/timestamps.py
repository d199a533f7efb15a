"""Timestamps in mixed formats and zones, brought to one unambiguous form.

read_timestamps() splits a raw text into date parts, time and zone with anchored patterns and lists, as a bit mask,
the orders of day, month and year under which it names a real day. normalize_timestamps() runs expectation
maximisation over the mixture of those orders per source: values contribute likelihood under each valid order, the
posterior (mixture weight x what the record's region says) chooses, and what stays open is marked. Only counts per
source and mask enter the EM, so it is one aggregation with map-side combine and a fold over a few numbers.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import bind

# Bits of the orders.
DMY, MDY, YMD = 1, 2, 4
ORDERS = {"DMY": DMY, "MDY": MDY, "YMD": YMD}
# Month names (English, German, French, Spanish, Italian, Dutch, Portuguese, Polish), by month.
MONTHS = (
    ("jan", "january", "januar", "janvier", "enero", "gennaio", "januari", "janeiro", "jänner", "ene", "gen", "janv", "stycznia"),
    ("feb", "february", "februar", "février", "fevrier", "febrero", "febbraio", "februari", "fevereiro", "févr", "fév", "lutego"),
    ("mar", "march", "märz", "maerz", "mars", "marzo", "maart", "março", "mrz", "mär", "marca"),
    ("apr", "april", "avril", "abril", "aprile", "abr", "avr", "kwietnia"),
    ("may", "mai", "mayo", "maggio", "mei", "maio", "mag", "maja"),
    ("jun", "june", "juni", "juin", "junio", "giugno", "junho", "giu", "czerwca"),
    ("jul", "july", "juli", "juillet", "julio", "luglio", "julho", "lug", "juil", "lipca"),
    ("aug", "august", "août", "aout", "agosto", "augustus", "ago", "sierpnia"),
    ("sep", "sept", "september", "septembre", "septiembre", "settembre", "setembro", "set", "września"),
    ("oct", "october", "oktober", "octobre", "octubre", "ottobre", "outubro", "okt", "ott", "out", "października"),
    ("nov", "november", "novembre", "noviembre", "novembro", "listopada"),
    ("dec", "december", "dezember", "décembre", "decembre", "diciembre", "dicembre", "dezembro", "dez", "déc", "dic", "grudnia"),
)
# Abbreviations of zones as offsets; those with two meanings are settled by the region's own zone.
ZONES = {
    "": None, "Z": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "UT": "+00:00", "WET": "+00:00", "BST": "+01:00", "WEST": "+01:00", "CET": "+01:00", "MEZ": "+01:00",
    "CEST": "+02:00", "MESZ": "+02:00", "EET": "+02:00", "EEST": "+03:00", "MSK": "+03:00", "IST": "+05:30", "JST": "+09:00", "KST": "+09:00", "HKT": "+08:00", "SGT": "+08:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}
CST_CHINA = ("Asia/Shanghai", "Asia/Taipei", "Asia/Hong_Kong", "Asia/Macau")
#: A reading is taken from this posterior on; below it the value stays open.
SURE = 0.95
#: What a known region leaves to other orders than its own.
DOUBT = 1e-6
#: Least weight of an order in a mixture where the region is known: a source's other records never outweigh the region.
LEAST = 1e-3
ROUNDS = 20

_TAIL = r"(?:[T,\s]+(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*([AaPp]\.?[Mm]\.?(?![A-Za-z]))?\s*(Z|[A-Za-z]{0,5}(?:[+-]\d{1,2}(?::?\d{2})?)?|[A-Za-z]+/[A-Za-z_/]+)?)?$"
_S = "\u0001"
# kind, pattern, replacement by: kind, three date parts, hour, minute, second, half of the day, zone
_FORMS = (
    (rf"^(\d{{1,4}})([./-])(\d{{1,2}})\2(\d{{1,4}}){_TAIL}", "n $1 $3 $4 $5 $6 $7 $8 $9"),
    (rf"^(?:[^\d\s,]{{2,10}}\.?,?\s+)?(\d{{1,2}})(?:\.|st|nd|rd|th)?[\s-]*(?:de\s+)?([^\d\s.,-]+)\.?,?[\s-]+(?:de\s+)?(\d{{4}}|\d{{2}}){_TAIL}", "m $3 $2 $1 $4 $5 $6 $7 $8"),
    (rf"^(?:[^\d\s,]{{2,10}}\.?,?\s+)?([^\d\s.,-]+)\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}){_TAIL}", "m $3 $1 $2 $4 $5 $6 $7 $8"),
    (r"^(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2})?(Z|[+-]\d{2}:?\d{2})?)?$", "n $1 $2 $3 $4 $5 $6  $7"),
    (rf"^(\d{{4}})\s*[年년]\s*(\d{{1,2}})\s*[月월]\s*(\d{{1,2}})\s*[日일]{_TAIL}", "n $1 $2 $3 $4 $5 $6 $7 $8"),
    (r"^(\d{5}|\d{10}|\d{13})$", "e $1       "),
)


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _real_day(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    days = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.coalesce(y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= days), F.lit(False))


def read_timestamps(values: DataFrame, value: str = "value") -> DataFrame:
    """Adds _mask (orders under which the text names a real day), _p (its parts), _time (seconds of the day, NULL for
    a plain day), _zone (as written, '' if none) and _epoch (a number that counts seconds since 1970).

    Rows whose text names no day at all are dropped: NULL, blank, words, weeks, days that don't exist.
    """
    t = F.trim(F.regexp_replace(F.col(value), r"[\s   ]+", " "))
    s = F.col("_t")
    form = F.lit(None).cast("string")
    for pattern, to in reversed(_FORMS):
        form = F.when(s.rlike(pattern), F.regexp_replace(s, pattern, to.replace(" ", _S))).otherwise(form)
    df = bind(values, _t=t)
    df = bind(df, _f=F.split(form, _S)).filter("_f is not null").drop("_t")
    f = F.col("_f")
    kind, month = f[0], _map({w: str(i + 1) for i, words in enumerate(MONTHS) for w in words})
    number = f[1].try_cast("long")
    # spreadsheet serials count days from 1899-12-30; longer numbers are seconds or milliseconds since 1970
    epoch = F.when(F.length(f[1]) == 13, F.floor(number / 1000)).when(F.length(f[1]) == 10, number)
    serial = F.when((kind == "e") & (F.length(f[1]) == 5), F.date_add(F.lit("1899-12-30").cast("date"), number.cast("int")))
    half = F.lower(F.substring(f[7], 1, 1))
    hour = _int(f[4])
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    minute, second = _int(f[5]), F.coalesce(_int(f[6]), F.lit(0))
    time_ok = hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    plain = f[4] == ""
    df = bind(
        df,
        _kind=kind,
        _a=F.when(serial.isNotNull(), F.year(serial)).otherwise(F.when(kind != "e", _int(f[1]))),
        _b=F.when(serial.isNotNull(), F.month(serial)).when(kind == "m", _int(month[F.lower(F.regexp_replace(f[2], r"\.$", ""))])).when(kind == "n", _int(f[2])),
        _c=F.when(serial.isNotNull(), F.dayofmonth(serial)).when(kind != "e", _int(f[3])),
        _long=F.when((kind == "m") | (F.length(f[1]) >= 3) | serial.isNotNull(), 1).when(F.length(f[3]) >= 3, 3).otherwise(0),
        _epoch=F.when(kind == "e", epoch),
        _time=F.when(~plain & (kind != "e"), F.coalesce(F.when(time_ok, hour * 3600 + minute * 60 + second), F.lit(-1))),
        _zone=F.upper(F.coalesce(f[8], F.lit(""))),
        _zone_name=F.coalesce(f[8], F.lit("")),
    ).drop("_f")
    a, b, c, where = F.col("_a"), F.col("_b"), F.col("_c"), F.col("_long")
    year = lambda y: F.when(y < 100, y + 2000).otherwise(y)
    mask = (
        F.when((where != 3) & _real_day(year(a), b, c), YMD).otherwise(0)
        + F.when((where != 1) & _real_day(year(c), b, a), DMY).otherwise(0)
        + F.when((where != 1) & _real_day(year(c), a, b), MDY).otherwise(0)
    )
    df = bind(df, _mask=F.when(F.col("_epoch").isNotNull(), F.lit(YMD)).otherwise(mask))
    return df.filter("_mask > 0 and coalesce(_time, 0) >= 0").drop("_kind")


def _day(order: Column) -> Column:
    """The day under one order, as yyyyMMdd in an int."""
    a, b, c = F.col("_a"), F.col("_b"), F.col("_c")
    year = lambda y: F.when(y < 100, y + 2000).otherwise(y)
    return F.when(order == YMD, year(a) * 10000 + b * 100 + c).when(order == DMY, year(c) * 10000 + b * 100 + a).when(order == MDY, year(c) * 10000 + a * 100 + b)


def format_mixtures(read: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per source: w_dmy, w_mdy, w_ymd (weights of the orders), zone (the zone of at least SURE of its records).

    read has source, _mask, date_order and time_zone (both NULL where the region is unknown). The region's order of
    the source's other records is the prior; one fold over eight counts is the whole EM.
    """
    by_zone = read.groupBy("source", "time_zone").agg(
        *[F.count_if(F.col("_mask") == m).alias(f"m{m}") for m in range(1, 8)],
        *[F.count_if(F.col("date_order") == o).alias(f"r_{o.lower()}") for o in ORDERS],
        F.count_if(F.col("date_order").isNotNull()).alias("known"),
    )
    sums = [f"m{m}" for m in range(1, 8)] + [f"r_{o.lower()}" for o in ORDERS] + ["known"]
    agg = by_zone.groupBy("source").agg(
        *[F.sum(c).cast("double").alias(c) for c in sums],
        F.max_by("time_zone", F.when(F.col("time_zone").isNotNull(), F.struct("known", "time_zone"))).alias("zone"),
        (F.max(F.when(F.col("time_zone").isNotNull(), F.col("known"))) / F.sum("known")).alias("zone_share"),
    )
    total = F.col("known") + 3e-3
    start = F.array(*[(F.col(f"r_{o.lower()}") + 1e-3) / total for o in ORDERS])

    def step(w: Column, _: Column) -> Column:
        mass = [F.lit(0.0)] * 3
        for m in range(1, 8):
            bits = [k for k in range(3) if m >> k & 1]
            share = sum((w[k] for k in bits[1:]), w[bits[0]]) + F.lit(1e-300)
            for k in bits:
                mass[k] = mass[k] + F.col(f"m{m}") * w[k] / share
        n = sum((F.col(f"m{m}") for m in range(2, 8)), F.col("m1"))
        return F.array(*[(mass[k] + start[k] * 2.0) / (n + 2.0) for k in range(3)])

    zone = F.when(F.col("zone_share") >= SURE, F.col("zone")).alias("zone")
    weights = agg.select("source", zone, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("w"))
    return weights.select("source", "zone", *[F.col("w")[k].alias(f"w_{o.lower()}") for k, o in enumerate(ORDERS)])


def _java_zones(spark) -> list[str]:
    return [str(z) for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds() if "/" in str(z)]


def normalize_timestamps(values: DataFrame) -> DataFrame:
    """values: source, value, date_order, time_zone and any others -> those others, value_utc, posterior, status.

    value_utc is yyyy-MM-ddTHH:mm:ssZ for a moment (fractions cut) and yyyy-MM-dd for a plain day, unshifted; status is
    'resolved', or 'ambiguous' (value_utc NULL) where several days or no zone remain possible. A missing zone is
    the region's; a local time that occurs twice means the first, one skipped by a change of clocks is no moment and
    gives no row. NULL, blank and unreadable texts give no row. A NULL source is one source of its own. Repeated rows
    are kept; an empty table gives an empty result.
    """
    others = [c for c in values.columns if c not in ("source", "value", "date_order", "time_zone")]
    values = values.withColumn("source", F.coalesce("source", F.lit("")))
    # A record's region is the prior of its orders, the source's mixture their weight: both make the posterior of each
    # value. Where only one order is possible it is 1 under any weights, so these rows need no mixture (nor, with a
    # region, its zone); their key is their own hash, which spreads them evenly and meets nothing.
    own = _map(ORDERS)[F.col("date_order")]
    single = F.col("_mask").isin(DMY, MDY, YMD)
    mixtures = format_mixtures(read_timestamps(values.select("source", "value", "date_order", "time_zone"))).withColumnRenamed("source", "_key").withColumnRenamed("zone", "_zone_source")
    free = single & (F.col("time_zone").isNotNull() | F.col("_epoch").isNotNull() | F.col("_time").isNull())
    alone = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in others], "_a", "_b", "_c", "source").cast("string"))
    read = read_timestamps(values).drop("value").withColumn("_key", F.when(free, alone).otherwise(F.col("source"))).join(mixtures, "_key", "left")

    def weight(o: str) -> Column:
        mixed = F.greatest(F.coalesce(F.col(f"w_{o.lower()}"), F.lit(1 / 3)), F.when(own.isNotNull(), LEAST).otherwise(0.0))
        prior = F.when(own.isNull(), 1.0).when(own == ORDERS[o], 1.0 - DOUBT).otherwise(DOUBT)
        return F.when(F.col("_mask").bitwiseAND(ORDERS[o]) > 0, mixed * prior).otherwise(0.0)

    read = bind(read, **{f"_w{b}": weight(o) for o, b in ORDERS.items()})
    # the readings of one text may fall on the same day; their weights add up
    same = lambda o, p: F.when(_day(F.lit(o)) == _day(F.lit(p)), F.col(f"_w{p}")).otherwise(0.0)
    scored = [F.struct(sum((same(b, p) for p in ORDERS.values() if p != b), F.col(f"_w{b}")).alias("w"), F.lit(b).alias("o")) for b in ORDERS.values()]
    total = sum((F.col(f"_w{b}") for b in ORDERS.values()), F.lit(0.0))
    best = F.array_max(F.filter(F.array(*scored), lambda x: F.col("_mask").bitwiseAND(x["o"]) > 0))
    both = bind(read, _best=best).withColumns({
        "_post": F.when(single, 1.0).otherwise(F.least(F.col("_best")["w"] / total, F.lit(1.0))), "_order": F.col("_best")["o"], "_zone_of": F.coalesce("time_zone", "_zone_source"),
    })
    both = both.select(*others, "_a", "_b", "_c", "_epoch", "_time", "_zone", "_zone_name", "_order", "_post", "_zone_of")

    day = _day(F.col("_order"))
    text = F.format_string("%04d-%02d-%02d", F.floor(day / 10000).cast("int"), F.floor(day % 10000 / 100).cast("int"), (day % 100).cast("int"))
    z = F.col("_zone")
    part = lambda k: F.regexp_extract(z, r"^(?:GMT|UTC|UT)?([+-])(\d{1,2}):?(\d{2})?$", k)
    zone = (
        F.when(z == "", F.col("_zone_of"))
        .when(part(1) != "", F.concat(part(1), F.lpad(part(2), 2, "0"), F.lit(":"), F.rpad(part(3), 2, "0")))
        .when((z == "CST") & F.col("_zone_of").isin(*CST_CHINA), F.lit("+08:00"))
        .when(z.contains("/"), F.when(F.col("_zone_name").isin(*_java_zones(values.sparkSession)), F.col("_zone_name")))
        .otherwise(_map({k: v for k, v in ZONES.items() if v})[z])
    )
    out = bind(both, _text=text, _tz=F.when(F.col("_time").isNotNull(), zone))
    local = F.when(F.col("_time").isNotNull() & F.col("_tz").isNotNull(), F.to_timestamp_ntz(F.concat("_text", F.lit(" "), F.format_string("%02d:%02d:%02d", F.floor(F.col("_time") / 3600).cast("int"), F.floor(F.col("_time") % 3600 / 60).cast("int"), F.col("_time") % 60)), F.lit("yyyy-MM-dd HH:mm:ss")))
    local = F.coalesce(local, F.when(F.col("_epoch").isNotNull(), F.timestamp_add("SECOND", F.col("_epoch"), F.lit("1970-01-01").cast("timestamp_ntz"))))
    out = bind(out, _local=local)
    tz = F.when(F.col("_epoch").isNotNull(), F.lit("+00:00")).otherwise(F.col("_tz"))
    utc = F.convert_timezone(tz, F.lit("UTC"), F.col("_local"))
    out = bind(out, _utc=utc)
    exists = F.col("_local").isNull() | F.col("_epoch").isNotNull() | ~F.col("_tz").contains("/") | (F.convert_timezone(F.lit("UTC"), F.col("_tz"), F.col("_utc")) == F.col("_local"))
    moment = F.col("_time").isNotNull() | F.col("_epoch").isNotNull()
    sure = (F.col("_post") >= SURE) & (~moment | F.col("_utc").isNotNull())
    value = F.when(sure, F.when(moment, F.date_format("_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.col("_text")))
    return out.filter(exists).select(*others, value.alias("value_utc"), F.col("_post").alias("posterior"), F.when(sure, F.lit("resolved")).otherwise(F.lit("ambiguous")).alias("status"))


def order_timestamps(headers: DataFrame, lines: DataFrame, regions: DataFrame) -> DataFrame:
    """field, row_id, value_utc, posterior, status for the three date fields of orders; a record's region is the one
    that lists its sales organisation (the smallest by name if several do), none if no region does."""
    region = regions.select(F.explode("sales_orgs").alias("sales_organization"), F.struct("region", "date_order", "time_zone").alias("r")).groupBy("sales_organization").agg(F.min("r").alias("r"))
    head = headers.select("record_id", "sales_organization", F.col("sender_email").alias("source"), "order_date", "requested_delivery_date").join(F.broadcast(region), "sales_organization", "left").withColumns({"date_order": F.col("r.date_order"), "time_zone": F.col("r.time_zone")}).drop("r", "sales_organization")
    both = head.select(F.col("record_id").alias("row_id"), "source", "date_order", "time_zone", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("order_date", "requested_delivery_date")])))
    per_record = head.groupBy("record_id").agg(F.first("date_order", True).alias("date_order"), F.first("time_zone", True).alias("time_zone"))
    line = lines.select("record_id", F.col("line_id").alias("row_id"), F.col("sender_email").alias("source"), F.col("delivery_date").alias("value"), F.lit("delivery_date").alias("field")).filter(F.col("value").rlike(r"\d")).join(per_record, "record_id", "left")
    return normalize_timestamps(both.select("field", "row_id", "source", "date_order", "time_zone", "value").unionByName(line.select("field", "row_id", "source", "date_order", "time_zone", "value")))
