"""Queries of the match cascades and their SQL: lines of customers whose name the master lists exactly, against the
customer's materials; records against places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import anchored, codes, text
from ordermill.operators import cascade
from ordermill.plans.reference import query
from ordermill.session import table


def _records(spark: SparkSession, d: str) -> DataFrame:
    """record_id, customer_number of records that write a customer's name as the master does, case aside."""
    v = table(spark, d, "vendors").filter("name is not null").groupBy(F.lower(F.trim("name")).alias("k")).agg(F.min("customer_number").alias("customer_number"))
    return table(spark, d, "po_headers").withColumn("k", F.lower(F.trim("customer_id_or_name"))).join(v, "k").drop("k")


def _items(spark: SparkSession, d: str) -> DataFrame:
    """item, customer_number, code, told: the lines of these records."""
    lines = table(spark, d, "po_line_items").select("record_id", F.col("line_id").alias("item"), F.trim("material_code").alias("code"), F.trim("description").alias("told"))
    return lines.join(_records(spark, d).select("record_id", "customer_number"), "record_id").drop("record_id")


def _master(spark: SparkSession, d: str) -> DataFrame:
    """row, customer_number, entry, internal, d; repeated rows once."""
    m = table(spark, d, "materials")
    return m.groupBy("customer_number", F.trim("customer_material_number").alias("entry"), F.trim("internal_material_number").alias("internal"), F.trim("material_description").alias("d")).agg(F.min("_ord").alias("row"))


_R = "R AS (SELECT h.*, v.customer_number FROM po_headers h JOIN (SELECT lower(trim(name)) AS k, min(customer_number) AS customer_number FROM vendors WHERE name IS NOT NULL GROUP BY 1) v ON v.k = lower(trim(h.customer_id_or_name)))"
_I = _R + ", I0 AS (SELECT l.line_id AS item, R.customer_number, trim(l.material_code) AS code, trim(l.description) AS told FROM po_line_items l JOIN R USING (record_id))"
_BARE = "trim(regexp_replace(trim(regexp_replace({0}, '\\s*\\([^)]*\\)', '', 'g')), '(?i)\\b(" + "|".join(codes.COLOURS) + ")\\b', '', 'g'))"
_ALNUM = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
_ZEROS = "CASE WHEN {0} ~ '^0+$' THEN '0' ELSE ltrim({0}, '0') END"
_WORDS = "list_distinct(list_filter(string_split(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> ''))"
_NO_BRACKETS = "trim(regexp_replace({0}, '\\s*\\([^)]*\\)', '', 'g'))"
_GRADE = "list_filter(" + _WORDS.format("regexp_replace(" + _NO_BRACKETS + ", '(?i)\\b([A-Z]+)\\s+([0-9]+)\\b', '\\1\\2', 'g')") + ", lambda x: x NOT IN (" + ", ".join(f"'{w}'" for w in codes.STOP) + "))"
_WITH = (
    f"WITH {_I}, I AS (SELECT *, lower({_BARE.format('code')}) AS bare, {_ALNUM.format(_BARE.format('code'))} AS key, {_ALNUM.format(_NO_BRACKETS.format('told'))} AS told_key, {_GRADE.format('told')} AS x FROM I0), "
    "M0 AS (SELECT customer_number, trim(customer_material_number) AS entry, trim(internal_material_number) AS internal, trim(material_description) AS d, min(_ord) AS row FROM materials GROUP BY ALL), "
    f"M AS (SELECT *, lower(entry) AS low, {_ALNUM.format('entry')} AS entry_key, {_ZEROS.format('internal')} AS number, {_ALNUM.format('d')} AS d_key, {_WORDS.format('d')} AS y FROM M0) "
)
_ONE = "SELECT item, row{2} FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY {1}row) AS r FROM ({0})) WHERE r = 1"


def _inputs(spark, d):
    i, m = _items(spark, d), _master(spark, d)
    bare = codes.bare_code(F.col("code"))
    i = i.select("*", F.lower(bare).alias("bare"), text.ascii_key(bare).alias("key"), text.ascii_key(codes.without_brackets(F.col("told"))).alias("told_key"), codes.grade_tokens(F.col("told")).alias("x"))
    m = m.select("*", F.lower("entry").alias("low"), text.ascii_key(F.col("entry")).alias("entry_key"), text.ascii_key(F.col("d")).alias("d_key"), codes.plain_tokens(F.col("d")).alias("y"))
    return i, m


def _first(pairs: DataFrame) -> DataFrame:
    return cascade.best_rows(pairs.select("item", "row"), "item", "row").select("item", "row")


_CODE_FORMS = "[lower(code), replace(lower(code), chr(92), '/'), replace(lower(code), '/', chr(92))]"
_BARE_FORMS = "[bare, replace(bare, chr(92), '/'), replace(bare, '/', chr(92))]"
_KEY_TIER = f"CASE WHEN code = entry THEN 0 WHEN list_contains({_CODE_FORMS}, low) THEN 1 WHEN number = {_ZEROS.format('code')} THEN 2 WHEN number = {_ZEROS.format('bare')} THEN 3 WHEN list_contains({_BARE_FORMS}, low) THEN 4 END"


@query(_WITH + _ONE.format(f"SELECT item, row, {_KEY_TIER} AS tier FROM I JOIN M USING (customer_number) WHERE code <> '' AND tier IS NOT NULL", "tier, ", ", tier"))
def code_cascade_equal(spark, d):
    """Tiers 0 to 4 of the cascade: what equality settles."""
    found = cascade.match_codes(_items(spark, d), _master(spark, d), ["customer_number"])
    return found.filter("tier <= 4")


@query(_WITH + _ONE.format("SELECT item, row FROM I JOIN M USING (customer_number) WHERE length(bare) >= 3 AND starts_with(low, bare)", "", ""))
def code_is_prefix(spark, d):
    i, m = _inputs(spark, d)
    return _first(cascade.prefix_pairs(i, m.select("customer_number", "row", "low"), ["customer_number"], "bare", "low"))


@query(_WITH + _ONE.format("SELECT item, row FROM I JOIN M USING (customer_number) WHERE regexp_extract(entry, '^([0-9]{4,})', 1) <> '' AND starts_with(bare, regexp_extract(entry, '^([0-9]{4,})', 1))", "", ""))
def digits_are_prefix(spark, d):
    i, m = _inputs(spark, d)
    head = m.select("customer_number", "row", F.regexp_extract("entry", "^([0-9]{4,})", 1).alias("head")).filter("head <> ''")
    return _first(cascade.prefix_pairs(head, i.select("customer_number", "item", "bare"), ["customer_number"], "head", "bare", 4))


def _either(a: str, b: str, least: int = 3) -> str:
    return f"length({a}) >= {least} AND length({b}) >= {least} AND (contains({a}, {b}) OR contains({b}, {a}))"


def _containing(a: str, b: str):
    def run(spark, d):
        i, m = _inputs(spark, d)
        return _first(cascade.either_contains(i.select("customer_number", "item", a), m.select("customer_number", "row", b), ["customer_number"], a, b))

    return run


for _name, _a, _b in (("code_contains_entry", "bare", "low"), ("alnum_contains_entry", "key", "entry_key"), ("code_in_description", "key", "d_key"), ("description_in_description", "told_key", "d_key"), ("entry_in_description", "told_key", "entry_key")):
    _run = _containing(_a, _b)
    _run.__name__ = _name
    query(_WITH + _ONE.format(f"SELECT item, row FROM I JOIN M USING (customer_number) WHERE {_either(_a, _b)}", "", ""))(_run)


@query()
def near_code_match(spark, d):
    """Tier 8: the most alike code of the customer; the ratio has no SQL."""
    i, m = _inputs(spark, d)
    near = cascade.alike_pairs(i.select("item", "customer_number", "bare"), m.select("row", "customer_number", "low"), ["customer_number"], "bare", "low")
    return cascade.best_rows(near.withColumn("_less", -F.col("score")), "item", "_less", "row").select("item", "row", F.bround("score", 3).alias("score"))


@query(_WITH + _ONE.format("SELECT item, row FROM I JOIN M USING (customer_number) WHERE len(x) >= 2 AND (len(list_intersect(x, y)) >= 0.75 * len(x) OR (len(y) >= 2 AND len(list_intersect(x, y)) >= 0.65 * len(y)))", "", ""))
def grade_token_match(spark, d):
    i, m = _inputs(spark, d)
    i, m, on = i.filter(F.size("x") >= 2), m.select("row", "customer_number", "y"), ["customer_number"]
    pairs = cascade.rare_token_pairs(i, m, "x", "y", "item", "row", 0.75, on).unionByName(cascade.rare_token_pairs(m.filter(F.size("y") >= 2), i, "y", "x", "row", "item", 0.65, on).select("item", "row")).distinct()
    pairs = pairs.join(i.select("item", "x"), "item").join(m.select("row", "y"), "row")
    return _first(pairs.filter((text.overlap(F.col("x"), F.col("y")) >= 0.75) | ((F.size("y") >= 2) & (text.overlap(F.col("y"), F.col("x")) >= 0.65))))


_DESCRIPTIVE = "length({0}) >= 5 AND regexp_matches({0}, '[ ,]') AND length(regexp_replace({0}, '[^A-Za-z]', '', 'g')) > 0.25 * length({0})"


@query(
    "WITH L AS (SELECT customer_number, name, " + _WORDS.format("name") + " AS y FROM (SELECT DISTINCT customer_number, name FROM vendors) WHERE " + _DESCRIPTIVE.format("name") + "), I AS (SELECT vendor_id AS item, customer_number, " + _WORDS.format("ship_to_name") + " AS x FROM vendors WHERE ship_to_name IS NOT NULL), "
    "P AS (SELECT item, name, len(list_intersect(x, y)) / least(len(x), len(y)) AS share FROM I JOIN L USING (customer_number) WHERE len(x) > 0 AND len(y) > 0) SELECT item, name, share FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY share DESC, name) AS r FROM P WHERE share >= 0.4) WHERE r = 1"
)
def descriptive_code_overlap(spark, d):
    """Tier 13 on names: the customer's name that shares most of the shorter one's words with the ship-to name, 0.4 and more."""
    v, on = table(spark, d, "vendors"), ["customer_number"]
    i = v.filter("ship_to_name is not null").select(F.col("vendor_id").alias("item"), *on, codes.plain_tokens(F.col("ship_to_name")).alias("x"))
    m = v.select(*on, "name").distinct().filter(codes.is_descriptive(F.col("name"))).select("name", *on, codes.plain_tokens(F.col("name")).alias("y"))
    # rows are told by customer and name
    m = m.withColumn("row", F.struct(*on, "name"))
    pairs = cascade.rare_token_pairs(i, m, "x", "y", "item", "row", 0.4, on).unionByName(cascade.rare_token_pairs(m, i, "y", "x", "row", "item", 0.4, on).select("item", "row")).distinct()
    scored = pairs.join(i.select("item", "x"), "item").join(m.select("row", "y"), "row").withColumn("share", text.short_overlap(F.col("x"), F.col("y"))).filter("share >= 0.4")
    best = scored.select("item", F.col("row.name").alias("name"), "share", (-F.col("share")).alias("_less"))
    return cascade.best_rows(best, "item", "_less", "name").select("item", "name", "share")


@query(
    _WITH.rstrip() + ", G AS (SELECT d_key, min(row) AS row, arg_min(y, row) AS y FROM M GROUP BY 1), "
    f"P AS (SELECT item, row, 14 AS tier FROM I JOIN G ON {_either('key', 'd_key', 4)} UNION ALL SELECT item, row, 15 FROM I JOIN G ON len(y) >= 3 AND len(list_intersect(x, y)) >= 0.7 * len(y))"
    + " "
    + _ONE.format("SELECT * FROM P", "tier, ", ", tier")
)
def match_anywhere(spark, d):
    """Tiers 14 and 15: descriptions of any customer's materials."""
    return cascade.match_anywhere(_items(spark, d), _master(spark, d)).select("item", "row", "tier")


@query(_WITH + _ONE.format("SELECT item, row, len(parts) - n AS place FROM (SELECT item, customer_number, string_split(code, '/') AS parts, unnest(generate_series(1, len(string_split(code, '/')))) AS n FROM I WHERE contains(code, '/')) p JOIN M ON M.customer_number = p.customer_number AND M.low = lower(trim(p.parts[p.n])) WHERE length(trim(p.parts[p.n])) >= 3", "place, ", ""))
def slash_segment_match(spark, d):
    i, m = _inputs(spark, d)
    parts = i.filter(F.contains(F.col("code"), F.lit("/"))).select("item", "customer_number", F.posexplode(F.reverse(F.split("code", "/"))).alias("place", "part")).withColumn("low", F.lower(F.trim("part"))).filter("length(low) >= 3")
    return cascade.best_rows(parts.join(m.select("customer_number", "low", "row"), ["customer_number", "low"]).select("item", "row", "place"), "item", "place", "row").select("item", "row")


@query()
def code_cascade(spark, d):
    """All tiers for every line whose customer is known; tested against brute force (tests/test_cascade.py)."""
    return cascade.match_codes(_items(spark, d), _master(spark, d), ["customer_number"])


_FOUR = (
    _WITH + _ONE.format(
        "SELECT item, row, CASE WHEN key2 <> '' AND key2 = entry_key THEN 1 WHEN " + _either("key2", "entry_key", 4) + f" THEN 1 WHEN code <> '' AND number = {_ZEROS.format('code')} THEN 2 WHEN length(entry_key) >= 4 AND contains(told2, entry_key) THEN 3 END AS pass FROM (SELECT *, {_ALNUM.format('code')} AS key2, {_ALNUM.format('told')} AS told2 FROM I) JOIN M USING (customer_number) WHERE pass IS NOT NULL", "pass, ", ", pass"
    )
)


@query(_FOUR)
def material_three_passes(spark, d):
    return cascade.find_material(_items(spark, d), _master(spark, d), ["customer_number"]).filter("pass <= 3").select("item", "row", "pass")


@query()
def material_finder(spark, d):
    """With the fourth pass, the weighted score of descriptions; tested against brute force."""
    return cascade.find_material(_items(spark, d), _master(spark, d), ["customer_number"]).select("item", "row", "pass", F.bround("score", 3).alias("score"))


@query(
    "WITH m AS (SELECT customer_number, customer_material_number AS entry, min(_ord) AS row FROM materials WHERE trim(coalesce(customer_material_number, '')) NOT IN ('', '-') GROUP BY ALL), "
    + _I + " SELECT item, coalesce(a.row, b.row) AS row, CASE WHEN a.row IS NULL AND b.row IS NOT NULL THEN 'bare' WHEN a.row IS NOT NULL THEN 'written' END AS key FROM I0 LEFT JOIN (SELECT customer_number, trim(entry) AS entry, min(row) AS row FROM m GROUP BY ALL) a ON a.customer_number = I0.customer_number AND a.entry = I0.code "
    f"LEFT JOIN (SELECT customer_number, {_ZEROS.format('trim(entry)')} AS entry, min(row) AS row FROM m GROUP BY ALL) b ON b.customer_number = I0.customer_number AND b.entry = {_ZEROS.format('I0.code')}"
)
def composite_key_lookup(spark, d):
    """Customer and code as one key; where that has no row, the code without its zeros."""
    m = table(spark, d, "materials").filter("trim(coalesce(customer_material_number, '')) not in ('', '-')").withColumn("code", F.trim("customer_material_number"))
    a = m.groupBy("customer_number", "code").agg(F.min("_ord").alias("a"))
    b = m.groupBy("customer_number", text.no_zeros(F.col("code")).alias("bare")).agg(F.min("_ord").alias("b"))
    both = _items(spark, d).withColumn("bare", text.no_zeros(F.col("code"))).join(a, ["customer_number", "code"], "left").join(b, ["customer_number", "bare"], "left")
    return both.select("item", F.coalesce("a", "b").alias("row"), F.when(F.col("a").isNotNull(), "written").when(F.col("b").isNotNull(), "bare").alias("key"))


_PLACES = "P0 AS (SELECT address_id AS place, list_distinct(list_filter(list_transform(list_concat(w, list_transform(generate_series(1, greatest(len(w) - 1, 0)), lambda i: w[i] || w[i + 1])), lambda t: replace(t, '-', '')), lambda t: t <> '')) AS codes FROM (SELECT *, list_filter(regexp_split_to_array(upper(trim(postcode)), '\\s+'), lambda t: t <> '') AS w FROM address_book WHERE postcode IS NOT NULL))"


@query(f"WITH {_PLACES}, F AS (SELECT DISTINCT record_id AS record, place FROM po_headers JOIN (SELECT place, unnest(codes) AS c FROM P0) ON c = upper(regexp_replace(ship_to_postcode, '[\\s-]+', '', 'g'))) SELECT record, place, count(*) OVER (PARTITION BY record) AS hits FROM F")
def place_by_postcode(spark, d):
    r = table(spark, d, "po_headers").select(F.col("record_id").alias("record"), F.col("ship_to_postcode").alias("postcode"))
    return cascade.by_postcode(r, table(spark, d, "address_book").select(F.col("address_id").alias("place"), "postcode"), []).select("record", "place", "hits")


def _place_tables(spark, d):
    r = _records(spark, d).select(F.col("record_id").alias("record"), F.col("customer_number").alias("customer"), F.lit(None).cast("string").alias("explicit"), F.col("ship_to_address").alias("address"), F.col("ship_to_postcode").alias("postcode"), F.col("ship_to_city").alias("city"))
    p = table(spark, d, "vendors").groupBy(F.col("ship_to").alias("place"), F.col("customer_number").alias("customer")).agg(F.first("ship_to_name", True).alias("name"), F.first("city", True).alias("city"), F.min("_ord").alias("order")).withColumn("postcode", F.lit(""))
    return r, p


@query(f"WITH {_R}, P AS (SELECT customer_number, ship_to, min(_ord) AS o, lower(trim(city)) AS town FROM vendors WHERE trim(coalesce(city, '')) <> '' GROUP BY ALL) SELECT record, place FROM (SELECT record_id AS record, ship_to AS place, row_number() OVER (PARTITION BY record_id ORDER BY o, ship_to) AS r FROM R JOIN P ON P.customer_number = R.customer_number AND P.town = lower(trim(R.ship_to_city))) WHERE r = 1")
def place_by_town(spark, d):
    r, _ = _place_tables(spark, d)
    p = table(spark, d, "vendors").filter("trim(coalesce(city, '')) <> ''").groupBy(F.col("customer_number").alias("customer"), F.col("ship_to").alias("place"), F.lower(F.trim("city")).alias("town")).agg(F.min("_ord").alias("order"))
    return cascade.best_rows(r.withColumn("town", F.lower(F.trim("city"))).join(p, ["customer", "town"]).select("record", "place", "order"), "record", "order", "place").select("record", "place")


@query()
def place_cascade(spark, d):
    """All rules; tested by examples of each."""
    return cascade.resolve_places(*_place_tables(spark, d))


_EDGE, _END = r"(?:^|[^\p{L}\p{N}])", r"(?:[^\p{L}\p{N}]|$)"


@query(
    rf"SELECT record_id, array_to_string(list_sort(list_filter(list_distinct(list_transform(list_concat(list_concat(regexp_extract_all(upper(ship_to_address), '{_EDGE}(?:GEB(?:ÄUDE)?|BLDG|BUILDING)\.?\s*([A-Z]?\s*[0-9]+){_END}', 1), regexp_extract_all(ship_to_address, '{_EDGE}([A-Z]{{1,3}}\s*[0-9]{{2,4}}){_END}', 1)), "
    rf"list_filter(regexp_split_to_array(ship_to_address, '[^\p{{L}}\p{{N}}]+'), lambda w: regexp_full_match(w, '[A-Z]{{3,6}}'))), lambda x: regexp_replace(x, '\s', '', 'g'))), lambda x: x NOT IN (" + ", ".join(f"'{w}'" for w in anchored.NO_IDENTIFIER) + "))), ' ') AS marks FROM po_headers WHERE ship_to_address IS NOT NULL"
)
def address_identifiers(spark, d):
    h = table(spark, d, "po_headers").filter("ship_to_address is not null")
    return h.select("record_id", F.array_join(F.array_sort(anchored.identifiers(F.col("ship_to_address"))), " ").alias("marks"))


@query("SELECT record_id, coalesce(len(list_filter(w, lambda x: length(x) > 3 AND contains(lower(ship_to_address), x))) / greatest(len(w), 1), 0)::DOUBLE AS share FROM (SELECT *, list_filter(regexp_split_to_array(lower(trim(ship_to_name)), '\\s+'), lambda x: x <> '') AS w FROM po_headers WHERE ship_to_name IS NOT NULL AND ship_to_address IS NOT NULL)")
def name_word_share(spark, d):
    h = table(spark, d, "po_headers").filter("ship_to_name is not null and ship_to_address is not null")
    return h.select("record_id", anchored.word_share(F.col("ship_to_name"), F.col("ship_to_address")).alias("share"))
