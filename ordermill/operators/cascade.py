"""Cascades of matches between items and a master table: codes by equality, prefix, containment, similarity and
descriptions, and places by number, postcode, town and score.

Every tier finds its candidates by an equality (of a code, a prefix, the first characters of a text, a rare word), so
no tier compares all items with all rows. Tiers of equal cost run together; only what they leave open goes on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import anchored, codes, text
from ordermill.functions.text import sequence_ratio
from ordermill.session import cut

#: First characters of a text by which containment is looked up: as many as it has, between these.
HEAD = (3, 8)


def best_rows(candidates: DataFrame, item: str, *order: str | Column) -> DataFrame:
    """Of each item the first row by order: an aggregation, so candidates are combined before the shuffle."""
    row = F.struct(*candidates.columns)
    return candidates.groupBy(F.col(item).alias("_item")).agg(F.min_by(row, F.struct(*order)).alias("_r")).select("_r.*")


def contained_pairs(part: DataFrame, whole: DataFrame, on: list[str], part_text: str, whole_text: str, least: int = HEAD[0], most: int = HEAD[1]) -> DataFrame:
    """Rows of part joined to rows of whole (equal in on) whose text contains part's text of `least` characters and more.

    The first characters of the part (as many as it has, `most` at most) equal a substring of the whole: an equality
    join; the rest is verified. on may be empty. Other columns must have different names on both sides.
    """
    a = part.filter(F.length(part_text) >= least).withColumn("_g", F.substring(part_text, 1, most))
    n = F.length(whole_text)
    windows = F.flatten(F.transform(F.sequence(F.lit(least), F.lit(most)), lambda k: F.when(k <= n, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col(whole_text), i, k))).otherwise(F.array().cast("array<string>"))))
    b = whole.filter(n >= least).withColumn("_g", F.explode(F.array_distinct(windows)))
    return a.join(b, [*on, "_g"]).filter(F.contains(F.col(whole_text), F.col(part_text))).drop("_g")


def either_contains(items: DataFrame, master: DataFrame, on: list[str], item_text: str, master_text: str, least: int = HEAD[0]) -> DataFrame:
    """Pairs of which one text contains the other; both have `least` characters and more."""
    there = contained_pairs(items.filter(F.length(item_text) >= least), master, on, item_text, master_text, least)
    back = contained_pairs(master.filter(F.length(master_text) >= least), items, on, master_text, item_text, least)
    return there.unionByName(back.select(*there.columns)).distinct()


def prefix_pairs(short: DataFrame, long_: DataFrame, on: list[str], short_text: str, long_text: str, least: int = HEAD[0], most: int = 40) -> DataFrame:
    """Rows whose long_text begins with short_text: equality with one of its first `least` to `most` characters."""
    a = short.filter(F.length(short_text).between(least, most)).withColumn("_g", F.col(short_text))
    ends = F.sequence(F.lit(least), F.least(F.length(long_text), F.lit(most)))
    b = long_.filter(F.length(long_text) >= least).withColumn("_g", F.explode(F.transform(ends, lambda k: F.substring(F.col(long_text), F.lit(1), k))))
    return a.join(b, [*on, "_g"]).drop("_g")


def rare_token_pairs(left: DataFrame, right: DataFrame, left_tokens: str, right_tokens: str, left_key: str, right_key: str, share: float, same: list[str] | None = None) -> DataFrame:
    """left_key, right_key of pairs of which the right set may hold `share` of the left one's tokens: a prefix filter.

    Tokens are ordered by how many right sets hold them. A right set with enough of them holds one of the left set's
    rarest ones, as many as may be missing and one more; only these are looked up.
    """
    same = same or []
    b = right.select(right_key, *same, F.explode(right_tokens).alias("_t"))
    held = b.groupBy(*same, "_t").agg(F.count("*").alias("_n"))
    n = F.size(left_tokens)
    a = left.filter(n > 0).select(left_key, *same, n.alias("_k"), F.explode(left_tokens).alias("_t")).join(held, [*same, "_t"], "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_t").alias("t"))))
    few = a.groupBy(left_key, *same, "_k").agg(order.alias("_o"))
    prefix = F.slice("_o", F.lit(1), (F.col("_k") - F.ceil(F.col("_k") * F.lit(share) - 1e-9) + 1).cast("int"))
    asked = few.select(left_key, *same, F.explode(prefix).alias("_p")).select(left_key, *same, F.col("_p.t").alias("_t"))
    return asked.join(b, [*same, "_t"]).select(left_key, right_key).distinct()


def alike_pairs(items: DataFrame, master: DataFrame, on: list[str], item_text: str, master_text: str, least: float = 0.82, shortest: int = 6, differ: int = 4) -> DataFrame:
    """Pairs equal in on whose sequence ratio is least and more, with score; digits-only texts and short ones aren't compared.

    Texts of that ratio share two characters beside each other, which is looked up; what the lengths and shared pairs of
    characters rule out never reaches the ratio, and equal pairs of texts are scored once.
    """
    fit = lambda df, c: df.filter((F.length(c) >= shortest) & ~F.col(c).rlike("^[0-9]+$"))
    two = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(F.col(c), i, F.lit(2))))
    a = fit(items.select(*on, item_text).distinct(), item_text).select("*", two(item_text).alias("_x"))
    b = fit(master.select(*on, master_text).distinct(), master_text).select("*", two(master_text).alias("_y"))
    met = a.select(*on, item_text, F.explode("_x").alias("_g")).join(b.select(*on, master_text, F.explode("_y").alias("_g")), [*on, "_g"]).groupBy(*on, item_text, master_text).agg(F.count("*").alias("_shared"))
    # each unmatched stretch spoils two pairs of characters at most
    n, m = F.length(item_text), F.length(master_text)
    near = met.filter((F.abs(n - m) <= differ) & (2.0 * F.least(n, m) / (n + m) >= least))
    pairs = near.select(item_text, master_text).distinct().withColumn("score", sequence_ratio(item_text, master_text)).filter(F.col("score") >= least)
    scored = near.select(*on, item_text, master_text).join(pairs, [item_text, master_text])
    return items.join(scored, [*on, item_text]).join(master, [*on, master_text])


def match_codes(items: DataFrame, master: DataFrame, on: list[str], prefixes: tuple[str, ...] = ()) -> DataFrame:
    """item, row, tier: the master row of each item by the first tier that has one; ties to the first row by order.

    items: item, code, told (a description) and the columns on; master: row (unique, also the order), entry, internal, d
    and on. Tiers: 0 entry equal, 1 ignoring case or turned slashes, 2 internal number (zeros aside), 3 internal number of the bare
    code, 4 entry equal to the bare code, 5 entry begins with the code, 6 code begins with the entry's digits, 7 one
    contains the other, 8 sequence ratio, 9 one's letters and digits contain the other's, 10 code and description,
    11 descriptions by containment or grade words, 12 description and entry, 13 words of an entry that reads like a
    description, 16 parts between slashes. Items without a match, NULL and blank ones give no row.
    """
    cleaned = codes.bare_code(F.trim("code"), prefixes)
    i = cut(items.select("item", *on, F.trim("code").alias("code"), F.lower(cleaned).alias("bare"), text.ascii_key(cleaned).alias("key"), F.trim("told").alias("told"), text.ascii_key(codes.without_brackets(F.col("told"))).alias("told_key"), codes.grade_tokens(F.col("told"), prefixes).alias("x")))
    m = cut(master.select("row", *on, F.trim("entry").alias("entry"), F.lower(F.trim("entry")).alias("low"), text.ascii_key(F.col("entry")).alias("entry_key"), text.no_zeros(F.trim("internal")).alias("number"), text.ascii_key(F.col("d")).alias("d_key"), codes.plain_tokens(F.col("d")).alias("y")))
    none = i.select("item", F.lit(0).cast(master.schema["row"].dataType).alias("row"), F.lit(0).alias("tier"), F.lit(0.0).alias("less")).limit(0)
    row = lambda df, tier, less=F.lit(0.0): df.select("item", "row", F.lit(tier).alias("tier"), less.cast("double").alias("less"))
    settled = lambda parts: best_rows(reduce(lambda a, b: a.unionByName(b), parts), "item", "tier", "less", "row")

    # equalities
    forms = F.filter(F.array_distinct(F.concat(F.transform(codes.slash_forms(F.lower("code")), lambda c: F.concat(F.lit("c"), c)), F.transform(codes.slash_forms(F.col("bare")), lambda c: F.concat(F.lit("c"), c)), F.array(F.concat(F.lit("i"), text.no_zeros(F.col("code"))), F.concat(F.lit("i"), text.no_zeros(F.col("bare")))))), lambda k: F.length(k) > 1)
    known = F.filter(F.array(F.concat(F.lit("c"), "low"), F.concat(F.lit("i"), "number")), lambda k: F.length(k) > 1)
    equal = i.select("item", *on, "code", "bare", F.explode(forms).alias("_k")).join(m.select("row", *on, "entry", "low", "number", F.explode(known).alias("_k")), [*on, "_k"])
    number = F.col("_k").startswith("i")
    tier = (
        F.when(~number & (F.col("entry") == F.col("code")), 0).when(~number & F.array_contains(codes.slash_forms(F.lower("code")), F.col("low")), 1)
        .when(number & (F.col("number") == text.no_zeros(F.col("code"))), 2).when(number, 3).otherwise(4)
    )
    found = [cut(settled([none, equal.select("item", "row", tier.alias("tier"), F.lit(0.0).alias("less"))]))]
    # prefixes and containment of codes
    rest = i.join(found[0].select("item"), "item", "left_anti")
    head = m.withColumn("head", F.regexp_extract("entry", "^([0-9]{4,})", 1))
    second = [
        row(prefix_pairs(rest.select("item", *on, "bare"), m.select("row", *on, "low"), on, "bare", "low"), 5),
        row(prefix_pairs(head.filter("head <> ''").select("row", *on, "head"), rest.select("item", *on, "bare"), on, "head", "bare", 4), 6),
        row(either_contains(rest.select("item", *on, "bare"), m.select("row", *on, "low"), on, "bare", "low"), 7),
        row(either_contains(rest.select("item", *on, "key"), m.select("row", *on, "entry_key"), on, "key", "entry_key"), 9),
    ]
    near = alike_pairs(rest.select("item", *on, "bare"), m.select("row", *on, "low"), on, "bare", "low")
    found.append(cut(settled([*second, row(near, 8, -F.col("score"))])))
    # descriptions
    rest = rest.join(found[1].select("item"), "item", "left_anti")
    words = rare_token_pairs(rest.filter(F.size("x") >= 2), m, "x", "y", "item", "row", 0.75, on).unionByName(rare_token_pairs(m.filter(F.size("y") >= 2), rest.filter(F.size("x") >= 2), "y", "x", "row", "item", 0.65, on).select("item", "row")).distinct()
    words = words.join(rest.select("item", "x"), "item").join(m.select("row", "y"), "row")
    words = words.filter((text.overlap(F.col("x"), F.col("y")) >= 0.75) | ((F.size("y") >= 2) & (text.overlap(F.col("y"), F.col("x")) >= 0.65)))
    like = m.filter(codes.is_descriptive(F.col("entry"))).select("row", *on, codes.plain_tokens(F.col("entry")).alias("y"))
    shorter = rare_token_pairs(rest, like, "x", "y", "item", "row", 0.4, on).unionByName(rare_token_pairs(like, rest, "y", "x", "row", "item", 0.4, on).select("item", "row")).distinct()
    shorter = shorter.join(rest.select("item", "x"), "item").join(like.select("row", "y"), "row").withColumn("share", text.short_overlap(F.col("x"), F.col("y"))).filter("share >= 0.4")
    third = [
        row(either_contains(rest.select("item", *on, "key"), m.select("row", *on, "d_key"), on, "key", "d_key"), 10),
        row(either_contains(rest.select("item", *on, "told_key"), m.select("row", *on, "d_key"), on, "told_key", "d_key"), 11), row(words, 11),
        row(either_contains(rest.select("item", *on, "told_key"), m.select("row", *on, "entry_key"), on, "told_key", "entry_key"), 12),
        row(shorter, 13, -F.col("share")),
    ]
    found.append(cut(settled(third)))
    # parts between slashes, the last first
    rest = rest.join(found[2].select("item"), "item", "left_anti").filter(F.contains(F.col("code"), F.lit("/")))
    parts = rest.select("item", *on, F.posexplode(F.reverse(F.split("code", "/"))).alias("place", "part")).withColumn("part", F.lower(F.trim("part"))).filter("length(part) >= 3")
    found.append(settled([row(parts.withColumnRenamed("part", "low").join(m.select("row", *on, "low"), [*on, "low"]), 16, F.col("place"))]))
    return reduce(lambda a, b: a.unionByName(b), found).select("item", "row", "tier")


def match_anywhere(items: DataFrame, master: DataFrame, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """item, row, tier for items that their own rows don't answer: 14 the code's letters and digits (four and more) in a
    description of any row, or the other way round; 15 most grade words (0.7) of a description of three words and more."""
    i = items.select("item", text.ascii_key(codes.bare_code(F.col("code"), prefixes)).alias("key"), codes.grade_tokens(F.col("told"), prefixes).alias("x"))
    m = master.select("row", text.ascii_key(F.col("d")).alias("d_key"), codes.plain_tokens(F.col("d")).alias("y"))
    # equal descriptions are met once, by their first row
    m = m.groupBy("d_key").agg(F.min("row").alias("row"), F.min_by("y", "row").alias("y"))
    within = either_contains(i.select("item", "key"), m.select("row", "d_key"), [], "key", "d_key", 4).select("item", "row", F.lit(14).alias("tier"))
    full = m.filter(F.size("y") >= 3)
    words = rare_token_pairs(full, i, "y", "x", "row", "item", 0.7).join(full.select("row", "y"), "row").join(i.select("item", "x"), "item").filter(text.overlap(F.col("y"), F.col("x")) >= 0.7)
    return best_rows(within.unionByName(words.select("item", "row", F.lit(15).alias("tier"))), "item", "tier", "row")


def find_material(items: DataFrame, master: DataFrame, on: list[str], least: float = 0.35) -> DataFrame:
    """item, row, pass, score: four passes. 1 letters and digits of code and entry equal or (four and more) one in the
    other, 2 the internal number, zeros aside, 3 the entry in the description, 4 the best 0.6 Jaccard + 0.4 sequence
    ratio of the descriptions, `least` at least."""
    i = cut(items.select("item", *on, text.ascii_key(F.trim("code")).alias("key"), text.no_zeros(F.trim("code")).alias("number"), text.ascii_key(F.col("told")).alias("told_key"), F.lower(F.trim("told")).alias("told"), codes.plain_tokens(F.col("told")).alias("x")))
    m = cut(master.select("row", *on, text.ascii_key(F.col("entry")).alias("entry_key"), text.no_zeros(F.trim("internal")).alias("number"), F.lower(F.trim("d")).alias("d"), codes.plain_tokens(F.col("d")).alias("y")))
    row = lambda df, n: df.select("item", "row", F.lit(n).alias("pass"))
    one = i.filter("key <> ''").join(m.select("row", *on, F.col("entry_key").alias("key")), [*on, "key"])
    inside = either_contains(i.select("item", *on, "key"), m.select("row", *on, "entry_key"), on, "key", "entry_key", 4)
    two = i.filter("number <> ''").join(m.select("row", *on, "number"), [*on, "number"])
    three = contained_pairs(m.select("row", *on, "entry_key"), i.select("item", *on, "told_key"), on, "entry_key", "told_key", 4)
    first = cut(best_rows(row(one, 1).unionByName(row(inside, 1)).unionByName(row(two, 2)).unionByName(row(three, 3)), "item", "pass", "row").withColumn("score", F.lit(1.0)))
    rest = i.join(first.select("item"), "item", "left_anti")
    return first.unionByName(best_described(rest, m, on, least).withColumn("pass", F.lit(4)).select("item", "row", "pass", "score"))


def best_described(items: DataFrame, master: DataFrame, on: list[str], least: float = 0.35) -> DataFrame:
    """item, row, score: the row of the best weighted score of two descriptions (items: told, x; master: d, y).

    0.6 Jaccard + 0.4 ratio can only reach `least` without a common word if the ratio alone does; such pairs need the
    same customer's every row, so they are met by common runs of three characters instead.
    """
    a = items.filter("told <> ''").select(*on, "told", "x").distinct()
    b = master.filter("d <> ''").groupBy(*on, "d").agg(F.min("row").alias("row"), F.first("y").alias("y"))
    runs = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(3))))
    met = a.select(*on, "told", F.explode(runs("told")).alias("_g")).join(b.select(*on, "d", F.explode(runs("d")).alias("_g")), [*on, "_g"]).select(*on, "told", "d").distinct()
    ratio = met.select("told", "d").distinct().withColumn("ratio", sequence_ratio("told", "d"))
    scored = met.join(ratio, ["told", "d"]).join(a, [*on, "told"]).join(b, [*on, "d"]).withColumn("score", 0.6 * text.jaccard(F.col("x"), F.col("y")) + 0.4 * F.col("ratio")).filter(F.col("score") >= least)
    best = scored.groupBy(*on, "told").agg(F.min_by(F.struct("row", "score"), F.struct(-F.col("score"), "row")).alias("_b"))
    return items.join(best, [*on, "told"]).select("item", "_b.row", "_b.score")


def place_score(name: Column, city: Column, address: Column, asked_city: Column, ratio: Column) -> Column:
    """Score of a place for an address: 2 for its name's words in it, 6 for its town in it, 8 for the same town as the
    town field (4 if one is part of the other), the ratio of name and address, 10 for each identifier in the name."""
    town, field = F.lower(F.trim(city)), F.lower(F.trim(asked_city))
    given = (town != "") & (field != "")
    marks = F.size(F.filter(anchored.identifiers(address), lambda t: F.contains(F.regexp_replace(F.upper(name), r"\s", ""), t)))
    points = (
        2.0 * anchored.word_share(name, address) + F.when((town != "") & F.contains(F.lower(address), town), 6.0).otherwise(0.0)
        + F.when(given & (town == field), 8.0).when(given & (F.contains(town, field) | F.contains(field, town)), 4.0).otherwise(0.0) + F.coalesce(ratio, F.lit(0.0)) + 10.0 * marks
    )
    return F.coalesce(points, F.lit(0.0))


def by_postcode(records: DataFrame, places: DataFrame, on: list[str]) -> DataFrame:
    """record, place, hits: places whose postcode field means the record's postcode; hits counts the record's places."""
    asked = records.select("record", *on, F.upper(F.regexp_replace("postcode", r"[\s-]+", "")).alias("_p")).filter("_p <> ''")
    held = places.select("place", *on, F.explode(anchored.postcode_tokens(F.col("postcode"))).alias("_p")).distinct()
    found = asked.join(held, [*on, "_p"]).select("record", "place").distinct()
    return found.join(found.groupBy("record").agg(F.count("*").alias("hits")), "record")


def resolve_places(records: DataFrame, places: DataFrame, least: float = 0.25) -> DataFrame:
    """record, place, rule: the delivery place of each record among its customer's, by the first rule that has one.

    records: record, customer, explicit, address, postcode, city; places: place, customer, name, city, postcode and
    order. Rules: 1 an explicit number of the customer's, 2 a plant or warehouse letter, 4 the town of a term of delivery,
    5 the one place of the postcode, 6 the best score among several, 7 the first place of the postcode anywhere, 10 the
    best score of name words, ratio and town above `least`, 11 nothing said: the customer itself ('' as place).
    """
    r = cut(records.select("record", "customer", *[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ("explicit", "address", "postcode", "city")]))
    p = cut(places.select("place", "customer", "order", *[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ("name", "city", "postcode")]).withColumnRenamed("city", "town"))
    row = lambda df, n, less=F.lit(0.0): df.select("record", "place", F.lit(n).alias("rule"), less.cast("double").alias("less"), "order")
    letter = lambda c: F.upper(F.regexp_extract(c, r"(?i)\b(?:plant|warehouse|werk|lager|hall)\s+([a-z]|[0-9]{1,3})\b", 1))
    own = r.filter("explicit <> ''").join(p.select("customer", F.col("place").alias("explicit"), "place", "order"), ["customer", "explicit"])
    plant = r.withColumn("_l", letter("address")).filter("_l <> ''").join(p.withColumn("_l", letter("name")).select("customer", "_l", "place", "order"), ["customer", "_l"])
    term = r.withColumn("_t", F.lower(anchored.town_of_terms(F.col("address")))).filter("_t is not null")
    terms = contained_pairs(term.select("record", "customer", "_t"), p.select("customer", F.lower("town").alias("_c"), "place", "order"), ["customer"], "_t", "_c")
    first = cut(best_rows(row(own, 1).unionByName(row(plant, 2)).unionByName(row(terms, 4)), "record", "rule", "less", "order"))

    rest = r.join(first.select("record"), "record", "left_anti")
    coded = cut(by_postcode(rest, p, ["customer"]))
    full = coded.join(rest.drop("postcode"), "record").join(p.select("place", "customer", "name", "town", "order"), ["customer", "place"])
    one = row(full.filter("hits = 1"), 5)
    several = full.filter("hits > 1").withColumn("ratio", sequence_ratio(F.lower("name"), F.lower("address")))
    many = row(several, 6, -place_score(F.col("name"), F.col("town"), F.col("address"), F.col("city"), F.col("ratio")))
    anywhere = by_postcode(rest.join(coded.select("record").distinct(), "record", "left_anti"), p.groupBy("postcode").agg(F.min_by(F.struct("place", "order"), "order").alias("_p")).select("postcode", "_p.*"), []).join(p.select("place", "order").distinct(), "place")
    second = cut(best_rows(one.unionByName(many).unionByName(row(anywhere, 7)), "record", "rule", "less", "order"))

    rest = rest.join(second.select("record"), "record", "left_anti")
    said = (F.col("address") != "") | (F.col("postcode") != "") | (F.col("city") != "")
    # a place is a candidate if the address or town field has its town or a word of its name; the ratio alone decides nothing
    asked = rest.filter(said).select("record", "customer", F.lower(F.concat_ws(" ", "address", "city")).alias("_whole"))
    words = F.filter(F.array_union(F.split(F.lower("name"), r"\s+"), F.array(F.lower("town"))), lambda w: F.length(w) > 3)
    pairs = contained_pairs(p.select("place", "customer", F.explode(words).alias("_part")), asked, ["customer"], "_part", "_whole", 4).select("record", "place").distinct()
    met = pairs.join(rest, "record").join(p.drop("postcode"), ["customer", "place"]).withColumn("ratio", sequence_ratio(F.lower("name"), F.lower("address")))
    same_town = (F.col("town") != "") & (F.contains(F.lower("address"), F.lower("town")) | (F.lower("city") == F.lower("town")))
    score = 0.6 * anchored.word_share(F.col("name"), F.col("address")) + 0.4 * F.coalesce("ratio", F.lit(0.0)) + F.when(same_town, 0.5).otherwise(0.0)
    scored = best_rows(row(met.withColumn("_s", score).filter(F.col("_s") > least), 10, -F.col("_s")), "record", "rule", "less", "order")
    silent = rest.filter(~said).select("record", F.lit("").alias("place"), F.lit(11).alias("rule"))
    return first.unionByName(second).unionByName(scored).select("record", "place", "rule").unionByName(silent)
