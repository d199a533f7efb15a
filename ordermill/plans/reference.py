"""Queries of the general operators, over the order-intake and the star-schema tables, and their SQL.

Every query reads its whole tables. QUERIES holds (query, SQL) by name; SQL is None where SQL can't express it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import dates, numbers, text
from ordermill.operators import cascade, keyed, matching, profile
from ordermill.session import table
from ordermill.sources import readers, sinks
from ordermill.streaming import pipelines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}

_NULLISH = "({0} IS NULL OR lower(trim({0})) IN ('', 'nan', 'none', 'null', 'n/a', 'na', '-', '#n/a'))"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def _profile_sql(t: str, columns: list[str]) -> str:
    one = "SELECT '{c}' AS column_name, count(*) AS total, sum(CASE WHEN {m} THEN 1 ELSE 0 END)::BIGINT AS missing, sum(CASE WHEN {m} THEN 0 ELSE 1 END)::BIGINT AS present, coalesce(round_even(100.0 * sum(CASE WHEN {m} THEN 0 ELSE 1 END) / nullif(count(*), 0), 1), 0)::DOUBLE AS present_pct FROM {t}"
    return " UNION ALL ".join(one.format(c=c, t=t, m=_NULLISH.format(c)) for c in columns)


_HEADER_COLUMNS = ["po_number", "order_date", "customer_id_or_name", "vendor_name", "ship_to_name", "ship_to_address", "ship_to_postcode", "ship_to_city", "sold_to_address", "sender_email", "sales_organization", "currency"]


@query(_profile_sql("po_headers", _HEADER_COLUMNS))
def completeness_profile(spark, d):
    return profile.completeness(table(spark, d, "po_headers"), _HEADER_COLUMNS)


@query(f"SELECT sales_organization, count(*) AS total, count(*) FILTER ({_NULLISH.format('ship_to_city')}) AS missing, round_even(100.0 * count(*) FILTER ({_NULLISH.format('ship_to_city')}) / count(*), 1)::DOUBLE AS missing_pct FROM po_headers GROUP BY 1")
def missing_by_group(spark, d):
    return profile.missing_by_group(table(spark, d, "po_headers"), "sales_organization", "ship_to_city")


@query("SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def distinct_entities(spark, d):
    return table(spark, d, "lineitem").agg(*[F.count_distinct(c).alias(n) for c, n in (("l_orderkey", "orders"), ("l_partkey", "parts"), ("l_suppkey", "suppliers"))])


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING NOT bool_or(o_orderpriority = '1-URGENT')")
def groups_without_value(spark, d):
    return profile.groups_without(table(spark, d, "orders"), "o_custkey", F.col("o_orderpriority") == "1-URGENT")


@query("SELECT l_suppkey, l_returnflag, count(DISTINCT l_partkey) AS values FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) > 1")
def ambiguous_mapping(spark, d):
    return profile.ambiguous(table(spark, d, "lineitem"), ["l_suppkey", "l_returnflag"], "l_partkey")


@query("SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def volume_by_group(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def status_pivot(spark, d):
    return profile.pivot_counts(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


_MODE = "SELECT {k}, {v}, n FROM (SELECT {k}, {v}, n, row_number() OVER (PARTITION BY {k} ORDER BY n DESC, first_at, {v}) AS r FROM (SELECT {k}, {v}, count(*) AS n, min({o}) AS first_at FROM {t} WHERE {v} IS NOT NULL GROUP BY {k}, {v})) WHERE r = 1"


@query(_MODE.format(k="o_custkey", v="o_orderpriority", o="o_orderkey", t="orders"))
def historical_mode(spark, d):
    return profile.mode_by(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query(
    f"WITH a AS ({_MODE.format(k='o_custkey, o_orderstatus', v='o_orderpriority', o='o_orderkey', t='(SELECT * FROM orders WHERE o_totalprice > 200000)')}), b AS ({_MODE.format(k='o_custkey', v='o_orderpriority', o='o_orderkey', t='(SELECT * FROM orders WHERE o_totalprice > 200000)')}), "
    "k AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) SELECT k.o_custkey, k.o_orderstatus, coalesce(a.o_orderpriority, b.o_orderpriority) AS o_orderpriority, CASE WHEN a.o_orderpriority IS NOT NULL THEN 0 WHEN b.o_orderpriority IS NOT NULL THEN 1 END AS level FROM k LEFT JOIN a USING (o_custkey, o_orderstatus) LEFT JOIN b USING (o_custkey)"
)
def mode_fallback(spark, d):
    # priority counts only for large orders, so some groups have none of their own
    o = table(spark, d, "orders").withColumn("o_orderpriority", F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")))
    return profile.mode_with_fallback(o, [["o_custkey", "o_orderstatus"], ["o_custkey"]], "o_orderpriority", "o_orderkey")


@query("SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1")
def set_flag_any(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS listed FROM orders GROUP BY 1")
def concat_unique(spark, d):
    return profile.listed(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority")


@query("SELECT o_custkey, CASE min(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END) WHEN 0 THEN 'F' WHEN 1 THEN 'P' ELSE 'O' END AS o_orderstatus FROM orders GROUP BY 1")
def status_precedence(spark, d):
    return profile.most_severe(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus", ["F", "P", "O"])


@query("SELECT l_orderkey, min(l_shipdate) AS first_date FROM lineitem GROUP BY 1")
def earliest_item_date(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_date"))


@query(f"SELECT a.*, b.suppliers FROM ({_MODE.format(k='l_partkey', v='l_returnflag', o='l_orderkey', t='lineitem')}) a JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1) b USING (l_partkey)")
def mode_report(spark, d):
    l = table(spark, d, "lineitem")
    return profile.mode_by(l, ["l_partkey"], "l_returnflag", "l_orderkey").join(l.groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("suppliers")), "l_partkey")


_KEEP = "SELECT event_id, ts, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts {0}, event_id {0}) AS r FROM events) WHERE r = 1"


@query(_KEEP.format("ASC"))
def dedup_keep_first(spark, d):
    return keyed.keep_first(table(spark, d, "events").select("event_id", "ts", "user_id", "event_type"), ["user_id", "event_type"], ["ts", "event_id"])


@query(_KEEP.format("DESC"))
def dedup_keep_last(spark, d):
    return keyed.keep_first(table(spark, d, "events").select("event_id", "ts", "user_id", "event_type"), ["user_id", "event_type"], ["ts", "event_id"], last=True)


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 25")
def topk_groups(spark, d):
    return profile.top_groups(table(spark, d, "lineitem"), "l_partkey", 25)


@query("SELECT o_orderkey, printf('SO-%04d', row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS number FROM orders")
def sequential_numbering(spark, d):
    return keyed.numbered(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "SO", ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "number")


_PRIORITY = "CASE WHEN regexp_full_match(code, '[0-9]{7,}') THEN 0 WHEN regexp_full_match(code, '[0-9]+') THEN 1 ELSE 2 END"


@query(f"SELECT code, {_PRIORITY} AS priority, row_number() OVER (ORDER BY {_PRIORITY}, code) AS place FROM (SELECT DISTINCT material_code AS code FROM po_line_items WHERE material_code IS NOT NULL)")
def id_priority_sort(spark, d):
    codes = table(spark, d, "po_line_items").filter("material_code is not null").select(F.col("material_code").alias("code")).distinct()
    codes = codes.withColumn("priority", F.when(F.col("code").rlike(r"^\d{7,}$"), 0).when(F.col("code").rlike(r"^\d+$"), 1).otherwise(2))
    return keyed.placed(codes, ["priority", "code"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS s FROM lineitem) WHERE s <= 100")
def running_total_cutoff(spark, d):
    return profile.cut_off(table(spark, d, "lineitem"), ["l_orderkey"], "l_quantity", ["l_linenumber", "l_partkey", "l_suppkey"], 100).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_projection(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


@query("SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer")
def union_ids(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("id")).union(table(spark, d, "customer").select("c_custkey")).distinct()


@query("SELECT p_partkey AS id FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49")
def diff_ids(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id")).subtract(table(spark, d, "lineitem").filter("l_quantity > 49").select("l_partkey"))


@query("SELECT c_custkey AS id FROM customer INTERSECT SELECT o_custkey FROM orders")
def intersect_ids(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id")).intersect(table(spark, d, "orders").select("o_custkey"))


@query("SELECT row_key FROM (SELECT DISTINCT md5(concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR)) AS row_key FROM lineitem) WHERE row_key NOT IN (SELECT md5(concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR)) FROM lineitem WHERE l_returnflag = 'R')")
def anti_already_pushed(spark, d):
    l = table(spark, d, "lineitem")
    registry = l.filter("l_returnflag = 'R'").select(text.row_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("row_key"))
    return keyed.not_yet(l.select("l_orderkey", "l_linenumber"), registry, ["l_orderkey", "l_linenumber"]).select("row_key")


@query("SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def semi_history(spark, d):
    return table(spark, d, "part").join(table(spark, d, "lineitem").filter("l_quantity > 49"), F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey")


@query("SELECT line_id, md5(concat_ws('|', lower(trim(coalesce(po_number, ''))), lower(trim(coalesce(line_number, ''))), lower(trim(coalesce(packaging, ''))))) AS row_key FROM po_line_items")
def composite_key_md5(spark, d):
    return table(spark, d, "po_line_items").select("line_id", text.row_key(F.col("po_number"), F.col("line_number"), F.col("packaging")).alias("row_key"))


@query("SELECT e.user_id, count(*) AS repeats FROM events e WHERE EXISTS (SELECT 1 FROM (SELECT user_id, event_type, min(ts) AS first_ts FROM events GROUP BY 1, 2) f WHERE f.user_id = e.user_id AND f.event_type = e.event_type AND e.ts > f.first_ts AND epoch_us(e.ts) - epoch_us(f.first_ts) < 12 * 3600000000) GROUP BY 1")
def duplicate_guard(spark, d):
    e = table(spark, d, "events")
    first = e.groupBy("user_id", "event_type").agg(F.min("ts").alias("first_ts"))
    age = dates.age_hours(F.col("first_ts"), F.col("ts"))
    return e.join(first, ["user_id", "event_type"]).filter((F.col("ts") > F.col("first_ts")) & (age < 12)).groupBy("user_id").agg(F.count("*").alias("repeats"))


_CASCADE = """WITH m AS (SELECT DISTINCT customer_number, customer_material_number AS entry, material_description AS d, _ord FROM materials WHERE customer_material_number IS NOT NULL AND length(trim(customer_material_number)) > 2),
n AS (SELECT entry, d, min(_ord) AS _ord FROM m GROUP BY 1, 2),
i AS (SELECT line_id, trim(material_code) AS code FROM po_line_items WHERE length(trim(material_code)) > 2),
c AS (SELECT line_id, entry, CASE WHEN code = entry THEN 0 WHEN lower(code) = lower(entry) THEN 1 ELSE 2 END AS tier, _ord FROM i JOIN n ON regexp_replace(lower(code), '[^a-z0-9]', '', 'g') = regexp_replace(lower(entry), '[^a-z0-9]', '', 'g'))
SELECT line_id, entry, tier FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY tier, _ord) AS r FROM c) WHERE r = 1"""


@query(_CASCADE)
def first_match_cascade(spark, d):
    """The tiers that are equalities of the key, over all customers; the whole cascade is in reference_match."""
    m = table(spark, d, "materials").filter("length(trim(customer_material_number)) > 2").groupBy(F.col("customer_material_number").alias("entry"), "material_description").agg(F.min("_ord").alias("_ord")).withColumn("_key", text.ascii_key(F.col("entry")))
    items = table(spark, d, "po_line_items").filter("length(trim(material_code)) > 2").select("line_id", F.trim("material_code").alias("code")).withColumn("_key", text.ascii_key(F.col("code")))
    tiers = [F.col("code") == F.col("entry"), F.lower("code") == F.lower("entry"), F.lit(True)]
    return matching.first_match(items, m, ["_key"], tiers, "line_id", "_ord").select("line_id", "entry", "tier")


_TOK = "list_distinct(list_filter(string_split(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) >= {1}))"
_PAIRS = "WITH a AS (SELECT p_partkey AS left_key, p_brand, " + _TOK.format("p_name || ' ' || p_type", 2) + " AS t FROM part), b AS (SELECT left_key AS right_key, p_brand, t FROM a), p AS (SELECT left_key, right_key, a.t AS x, b.t AS y FROM a JOIN b USING (p_brand) WHERE left_key < right_key AND len(list_intersect(a.t, b.t)) > 0) SELECT left_key, right_key FROM p WHERE {0}"


def _set_pairs(spark, d, share: float, kept: Callable[[Column, Column], Column], either: bool = False):
    """left_key, right_key of the parts of a brand whose tokens x and y are `kept`, left_key below right_key. The second holds
    `share` of the first one's tokens (or the other way round).

    Sets are compared once however many parts have them: sets are found by their rarest tokens, and only a pair of sets
    that is kept meets the two lists of keys. Pairs of parts are made last and never shuffled; a list of n keys has as
    many results as n (n - 1) / 2, so it is short where the result can be kept at all.
    """
    words = F.split(F.trim(F.regexp_replace(F.lower(F.concat("p_name", F.lit(" "), "p_type")), "[^a-z0-9]+", " ")), " ")
    p = table(spark, d, "part").select("p_partkey", "p_brand", F.array_sort(F.array_distinct(F.filter(words, lambda w: F.length(w) >= 2))).alias("t"))
    # a set by its name: tokens have no line break
    named = p.filter("p_brand is not null and size(t) > 0").select("p_partkey", "p_brand", "t", F.concat(F.array_join("t", " "), F.lit("\n"), "p_brand").alias("c"))
    sets, keys = named.select("c", "p_brand", "t").distinct(), named.groupBy("c").agg(F.array_sort(F.collect_list("p_partkey")).alias("k"))
    a, b = sets.select(F.col("c").alias("a"), "p_brand", F.col("t").alias("x")), sets.select(F.col("c").alias("b"), "p_brand", F.col("t").alias("y"))
    met = cascade.rare_token_pairs(a, b, "x", "y", "a", "b", share, ["p_brand"])
    if either:
        met = met.unionByName(cascade.rare_token_pairs(b, a, "y", "x", "b", "a", share, ["p_brand"]).select("a", "b")).distinct()
    tokens = lambda c: F.split(F.substring_index(c, "\n", 1), " ")
    met = met.filter(kept(tokens("a"), tokens("b")))
    lists = met.join(keys.select(F.col("c").alias("a"), F.col("k").alias("l")), "a").join(keys.select(F.col("c").alias("b"), F.col("k").alias("r")), "b")
    return lists.select(F.explode("l").alias("left_key"), "r").select("left_key", F.explode("r").alias("right_key")).filter("left_key < right_key")


@query(_PAIRS.format("len(list_intersect(x, y)) >= 0.75 * len(x) AND len(list_intersect(x, y)) >= 0.65 * len(y) AND len(x) >= 2"))
def token_overlap_match(spark, d):
    return _set_pairs(spark, d, 0.75, lambda x, y: (text.overlap(x, y) >= 0.75) & (text.overlap(y, x) >= 0.65) & (F.size(x) >= 2))


@query(_PAIRS.format("len(list_intersect(x, y)) / least(len(x), len(y)) >= 0.6"))
def short_set_overlap(spark, d):
    return _set_pairs(spark, d, 0.6, lambda x, y: text.short_overlap(x, y) >= 0.6, either=True)


@query(_PAIRS.format("len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) >= 0.5"))
def jaccard_match(spark, d):
    return _set_pairs(spark, d, 0.5, lambda x, y: text.jaccard(x, y) >= 0.5)


@query()
def fuzzy_seq_match(spark, d):
    v = table(spark, d, "vendors")
    names = v.select(F.col("name").alias("right_name")).filter("right_name is not null").distinct()
    ships = v.select(F.col("ship_to_name").alias("left_name")).filter("left_name is not null").distinct()
    return matching.fuzzy_best(ships, names, "left_name", "right_name", "left_name", "right_name")


@query("SELECT l_partkey, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS l_suppkey, count(DISTINCT l_suppkey) AS candidates FROM lineitem WHERE l_quantity > 48 GROUP BY 1")
def uniqueness_resolution(spark, d):
    return matching.uniquely(table(spark, d, "lineitem").filter("l_quantity > 48"), "l_partkey", "l_suppkey")


# Phrases of the lookup, in their order.
_PHRASES = ("credit check", "please deliver", "melt flow", "call ahead", "gate 5", "damaged bags")


@query("SELECT doc_id, p.phrase FROM documents, (VALUES " + ", ".join(f"({i}, '{p}')" for i, p in enumerate(_PHRASES)) + ") p(ord, phrase) WHERE contains(' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ', ' ' || p.phrase || ' ') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p.ord) = 1")
def alias_substring_join(spark, d):
    phrases = spark.createDataFrame([(i, p) for i, p in enumerate(_PHRASES)], "ord int, phrase string")
    return matching.contained(table(spark, d, "documents").select("doc_id", "text"), phrases, "text", "phrase", "ord", "doc_id")


@query("SELECT r.region, count(*) AS n FROM po_headers h LEFT JOIN (SELECT region, unnest(sales_orgs) AS so FROM regional_config) r ON r.so = h.sales_organization GROUP BY 1")
def array_membership_join(spark, d):
    r = table(spark, d, "regional_config").select("region", F.explode("sales_orgs").alias("sales_organization"))
    return table(spark, d, "po_headers").join(F.broadcast(r), "sales_organization", "left").groupBy("region").agg(F.count("*").alias("n"))


@query("SELECT sender_email, arg_min(ship_to_city, _ord) FILTER (trim(ship_to_city) <> '') AS ship_to_city, arg_min(currency, _ord) FILTER (trim(currency) <> '') AS currency FROM po_headers GROUP BY 1")
def first_nonblank(spark, d):
    return profile.first_filled_by(table(spark, d, "po_headers"), ["sender_email"], ["ship_to_city", "currency"], "_ord")


_DBL = "CASE WHEN regexp_full_match({0}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)') THEN try_cast({0} AS DOUBLE) END"
_QE = "regexp_replace(q, '[^0-9.,-]', '', 'g')"
_QG = "regexp_extract(q, '[0-9.,]+')"
_FOLDED = "regexp_replace(translate(quantity, '０１２３４５６７８９', '0123456789'), '[\\s\\p{Z}]', ' ', 'g')"
_GROUPED = f"CASE WHEN regexp_full_match({_QG}, '[0-9]{{1,3}}(\\.[0-9]{{3}})+(,[0-9]+)?') THEN {_DBL.format(f'''replace(replace({_QG}, '.', ''), ',', '.')''')} WHEN regexp_full_match({_QG}, '[0-9]{{1,3}}(,[0-9]{{3}})+(\\.[0-9]+)?') THEN {_DBL.format(f'''replace({_QG}, ',', '')''')} ELSE {_DBL.format(f'''replace({_QG}, ',', '.')''')} END"


@query(
    f"SELECT quantity, {_DBL.format('''replace(trim(q), ',', '')''')} AS plain, "
    f"CASE WHEN instr(reverse({_QE}), ',') > 0 AND instr(reverse({_QE}), '.') > 0 AND instr(reverse({_QE}), ',') < instr(reverse({_QE}), '.') THEN {_DBL.format(f'''replace(replace({_QE}, '.', ''), ',', '.')''')} "
    f"WHEN (instr(reverse({_QE}), ',') > 0 AND instr(reverse({_QE}), '.') > 0) OR instr(reverse({_QE}), ',') = 0 THEN {_DBL.format(f'''replace({_QE}, ',', '')''')} ELSE {_DBL.format(f'''replace({_QE}, ',', '.')''')} END AS comma, "
    f"{_GROUPED} AS grouped FROM (SELECT DISTINCT quantity, {_FOLDED} AS q FROM po_line_items WHERE quantity IS NOT NULL)"
)
def number_parsers(spark, d):
    q = table(spark, d, "po_line_items").filter("quantity is not null").select("quantity").distinct()
    c = F.col("quantity")
    return q.select("quantity", numbers.plain_number(c).alias("plain"), numbers.comma_decimal(c).alias("comma"), numbers.grouped_number(c).alias("grouped"))


@query(
    f"WITH u AS (SELECT raw, min(code) AS code, max(factor) FILTER (NOT us_only) AS f, max(factor) FILTER (us_only) AS fu FROM unit_map GROUP BY 1), r AS (SELECT DISTINCT unnest(sales_orgs) AS so FROM regional_config WHERE us_units), "
    f"p AS (SELECT line_id, record_id, upper(trim(unit)) AS raw, {_GROUPED} AS amount FROM (SELECT *, {_FOLDED} AS q FROM po_line_items)) "
    "SELECT p.line_id, u.code, p.amount * CASE WHEN r.so IS NOT NULL THEN coalesce(u.fu, u.f) ELSE coalesce(u.f, u.fu) END AS converted FROM p JOIN u ON u.raw = p.raw LEFT JOIN po_headers h ON h.record_id = p.record_id LEFT JOIN r ON r.so = h.sales_organization WHERE p.amount IS NOT NULL"
)
def unit_conversion(spark, d):
    """Written units of unit_map, by the record's region; spellings beyond them are p3_amounts' task."""
    u = table(spark, d, "unit_map").groupBy("raw").agg(F.min("code").alias("code"), F.max(F.when(~F.col("us_only"), F.col("factor"))).alias("f"), F.max(F.when(F.col("us_only"), F.col("factor"))).alias("fu"))
    r = table(spark, d, "regional_config").filter("us_units").select(F.explode("sales_orgs").alias("sales_organization")).distinct()
    us = table(spark, d, "po_headers").join(F.broadcast(r), "sales_organization", "left_semi").select("record_id", F.lit(True).alias("us"))
    p = table(spark, d, "po_line_items").select("line_id", "record_id", F.upper(F.trim("unit")).alias("raw"), numbers.grouped_number(F.col("quantity")).alias("amount")).filter("amount is not null")
    factor = F.when(F.col("us"), F.coalesce("fu", "f")).otherwise(F.coalesce("f", "fu"))
    return p.join(F.broadcast(u), "raw").join(us, "record_id", "left").select("line_id", "code", (F.col("amount") * factor).alias("converted"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_normalizer(spark, d):
    from ordermill.operators.timestamps import normalize_timestamps

    # each date is written in one of six ways and read back
    day = F.to_date("o_orderdate")
    ways = ["dd.MM.yyyy", "yyyy-MM-dd", "dd/MM/yyyy", "d MMMM yyyy", "MMMM d, yyyy", "dd-MMM-yy"]
    written = F.coalesce(*[F.when(F.col("o_orderkey") % len(ways) == i, F.date_format(day, w)) for i, w in enumerate(ways)])
    way = F.when((F.col("o_orderkey") % len(ways) == 5) & (F.year(day) < 2000), F.date_format(day, "yyyy/MM/dd")).otherwise(written)
    values = table(spark, d, "orders").select("o_orderkey", F.lit("s").alias("source"), way.alias("value"), F.lit("DMY").alias("date_order"), F.lit("UTC").alias("time_zone"))
    return normalize_timestamps(values).select("o_orderkey", F.col("value_utc").alias("day"))


@query("SELECT record_id, regexp_extract(source_file, '([^/\\\\]+)$', 1) AS name, regexp_replace(regexp_extract(source_file, '([^/\\\\]+)$', 1), '\\.[^.]*$', '') AS stem, lower(regexp_extract(source_file, '\\.([^.]+)$', 1)) AS extension FROM po_headers")
def filename_extract(spark, d):
    c = F.col("source_file")
    return table(spark, d, "po_headers").select("record_id", text.file_name(c).alias("name"), text.file_stem(c).alias("stem"), text.file_extension(c).alias("extension"))


@query("SELECT record_id, coalesce(" + ", ".join(f"nullif(regexp_extract(ship_to_address, '{p}', 1), '')" for p in text.POSTCODES) + ") AS postcode FROM po_headers WHERE ship_to_address IS NOT NULL")
def postcode_extract(spark, d):
    return table(spark, d, "po_headers").filter("ship_to_address is not null").select("record_id", text.postcode(F.col("ship_to_address")).alias("postcode"))


@query("SELECT message_no, trim(regexp_replace(regexp_replace(body.content, '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS content FROM mailbox_message WHERE body.contentType = 'html' AND body.content IS NOT NULL")
def html_strip(spark, d):
    return table(spark, d, "mailbox_message").filter("body.contentType = 'html' and body.content is not null").select("message_no", text.without_tags(F.col("body.content")).alias("content"))


_WORDS = ["order", "quantity", "material", "delivery", "price", "bestellung"]


@query("SELECT doc_id, " + " + ".join(f"contains(lower(text), '{w}')::INT" for w in _WORDS) + " AS hits FROM documents WHERE n_chars >= 100 AND " + " + ".join(f"contains(lower(text), '{w}')::INT" for w in _WORDS) + " >= 2")
def looks_like_order(spark, d):
    return table(spark, d, "documents").filter("n_chars >= 100").select("doc_id", text.keyword_hits(F.col("text"), _WORDS).alias("hits")).filter("hits >= 2")


@query("SELECT message_no, name, size FROM (SELECT message_no, unnest(attachments, recursive := true) FROM mailbox_message) WHERE (isInline AND size >= 15000) OR (NOT isInline AND size >= 5000)")
def noise_filter(spark, d):
    a = table(spark, d, "mailbox_message").select("message_no", F.inline("attachments"))
    return a.filter((F.col("isInline") & (F.col("size") >= 15000)) | (~F.col("isInline") & (F.col("size") >= 5000))).select("message_no", "name", "size")


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("SELECT l_orderkey, bool_and(l_linestatus = 'F') AS all_final, bool_or(l_returnflag = 'R') AS any_returned FROM lineitem GROUP BY 1")
def nested_forall(spark, d):
    nested = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linestatus", "l_returnflag")).alias("items"))
    return nested.select("l_orderkey", F.forall("items", lambda x: x["l_linestatus"] == "F").alias("all_final"), F.exists("items", lambda x: x["l_returnflag"] == "R").alias("any_returned"))


@query("SELECT DISTINCT h.po_number AS \"PO_NUMBER\", coalesce(h.order_date, '') AS \"ORDER_DATE\", coalesce(l.material_code, '') AS \"MATERIAL_CODE\", coalesce(l.quantity, '') AS \"QUANTITY\", coalesce(l.unit, '') AS \"UNIT\" FROM po_headers h LEFT JOIN po_line_items l USING (record_id)")
def nested_export(spark, d):
    lines = table(spark, d, "po_line_items").groupBy("record_id").agg(F.collect_list(F.struct("material_code", "quantity", "unit")).alias("items"))
    records = table(spark, d, "po_headers").select("record_id", "po_number", "order_date").join(lines, "record_id", "left")
    flat = records.select("po_number", "order_date", F.explode_outer("items").alias("i")).select("po_number", "order_date", "i.*")
    filled = flat.select("po_number", *[F.coalesce(c, F.lit("")).alias(c) for c in ("order_date", "material_code", "quantity", "unit")])
    return readers.plain_names(filled, upper=True).distinct()


_CODE = "[A-Z]{3}[- ]?[0-9]{4,5}[-/]?[0-9]{3,4}"


@query(f"WITH m AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '{_CODE}')) AS code FROM documents), e AS (SELECT DISTINCT customer_material_number AS entry FROM materials WHERE regexp_full_match(customer_material_number, '{_CODE}')), c AS (SELECT doc_id, code, entry, CASE WHEN code = entry THEN 0 ELSE 1 END AS tier FROM m JOIN e ON regexp_replace(lower(code), '[^a-z0-9]', '', 'g') = regexp_replace(lower(entry), '[^a-z0-9]', '', 'g')) SELECT doc_id, entry, tier FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tier, entry) AS r FROM c) WHERE r = 1")
def tiered_reference_match(spark, d):
    # references are taken out of the texts and joined by equality, instead of asking every text for every reference
    m = table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_CODE), F.lit(0)))).alias("code")).withColumn("_key", text.ascii_key(F.col("code")))
    e = table(spark, d, "materials").filter(F.col("customer_material_number").rlike(f"^{_CODE}$")).select(F.col("customer_material_number").alias("entry")).distinct().withColumn("_key", text.ascii_key(F.col("entry")))
    return matching.first_match(m, e, ["_key"], [F.col("code") == F.col("entry"), F.lit(True)], "doc_id", "entry").select("doc_id", "entry", "tier")


@query("WITH a AS (SELECT * FROM customer WHERE c_nationkey <> 3), b AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'NONE' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_nationkey <> 5), j AS (SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, a.c_custkey AS l, b.c_custkey AS r, a.c_name AS ln, b.c_name AS rn, a.c_mktsegment AS lm, b.c_mktsegment AS rm FROM a FULL JOIN b ON a.c_custkey = b.c_custkey) SELECT c_custkey, 'c_name' AS field, CASE WHEN r IS NULL THEN 'only_left' WHEN l IS NULL THEN 'only_right' WHEN ln IS NOT DISTINCT FROM rn THEN 'same' ELSE 'changed' END AS outcome FROM j UNION ALL SELECT c_custkey, 'c_mktsegment', CASE WHEN r IS NULL THEN 'only_left' WHEN l IS NULL THEN 'only_right' WHEN lm IS NOT DISTINCT FROM rm THEN 'same' ELSE 'changed' END FROM j")
def full_outer_compare(spark, d):
    c = table(spark, d, "customer")
    b = c.filter("c_nationkey <> 5").withColumn("c_mktsegment", F.when(F.col("c_acctbal") < 0, "NONE").otherwise(F.col("c_mktsegment")))
    return keyed.compared(c.filter("c_nationkey <> 3"), b, "c_custkey", ["c_name", "c_mktsegment"])


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2031-01-01' OR NOT EXISTS (SELECT 1 FROM events WHERE ts >= TIMESTAMP '2031-01-01')")
def window_filter_fallback(spark, d):
    return keyed.in_window_or_all(table(spark, d, "events").select("event_id", "ts"), F.col("ts") >= F.lit("2031-01-01").cast("timestamp")).select("event_id")


@query(f"WITH f AS (SELECT customer_number, arg_min(struct_pack(country := country, city := city), _ord) AS r FROM vendors GROUP BY 1) SELECT r.country AS country, count(*) AS keys, count(*) FILTER (NOT {_NULLISH.format('r.city')}) AS covered, round_even(100.0 * count(*) FILTER (NOT {_NULLISH.format('r.city')}) / count(*), 1)::DOUBLE AS covered_pct FROM f GROUP BY 1")
def coverage_by_group(spark, d):
    return profile.coverage_of_first(table(spark, d, "vendors"), "customer_number", "country", "city", "_ord")


@query("SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN trim(coalesce(l.material_code, '')) IN ('', '-', 'n/a', 'N/A') THEN 'no code' WHEN c.k IS NOT NULL THEN 'customer code' WHEN i.k IS NOT NULL THEN 'internal code' ELSE 'unknown code' END AS verdict FROM po_line_items l LEFT JOIN (SELECT DISTINCT regexp_replace(lower(customer_material_number), '[^a-z0-9]', '', 'g') AS k FROM materials WHERE customer_material_number IS NOT NULL) c ON c.k = regexp_replace(lower(l.material_code), '[^a-z0-9]', '', 'g') LEFT JOIN (SELECT DISTINCT ltrim(internal_material_number, '0') AS k FROM materials) i ON i.k = ltrim(l.material_code, '0')) GROUP BY 1")
def verdict_join(spark, d):
    m = table(spark, d, "materials")
    c = m.filter("customer_material_number is not null").select(text.ascii_key(F.col("customer_material_number")).alias("_c")).distinct().withColumn("_hit_c", F.lit(True))
    i = m.select(F.ltrim(F.col("internal_material_number"), F.lit("0")).alias("_i")).distinct().withColumn("_hit_i", F.lit(True))
    l = table(spark, d, "po_line_items").select("material_code", text.ascii_key(F.col("material_code")).alias("_c"), F.ltrim(F.col("material_code"), F.lit("0")).alias("_i"))
    verdict = F.when(F.trim(F.coalesce("material_code", F.lit(""))).isin("", "-", "n/a", "N/A"), "no code").when(F.col("_hit_c"), "customer code").when(F.col("_hit_i"), "internal code").otherwise("unknown code")
    return l.join(c, "_c", "left").join(i, "_i", "left").select(verdict.alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n"))


@query("WITH u AS (SELECT o_custkey AS c_custkey, NULL::VARCHAR AS c_name, max(o_orderpriority) AS c_mktsegment FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) SELECT coalesce(u.c_custkey, c.c_custkey) AS c_custkey, coalesce(u.c_name, c.c_name) AS c_name, coalesce(u.c_mktsegment, c.c_mktsegment) AS c_mktsegment FROM customer c FULL JOIN u ON u.c_custkey = c.c_custkey")
def upsert_merge(spark, d):
    u = table(spark, d, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment")).withColumn("c_name", F.lit(None).cast("string"))
    return keyed.merged(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), u, "c_custkey")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def latest_per_key(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"))


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS flag FROM customer")
def any_of_lookups(spark, d):
    o = table(spark, d, "orders")
    return keyed.one_of(table(spark, d, "customer").select("c_custkey"), (o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey"), (o.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey"))


@query("SELECT vendor_id, CASE WHEN trim(coalesce(city, '')) = '' THEN trim(coalesce(ship_to_name, '')) WHEN trim(coalesce(ship_to_name, '')) = '' OR lower(trim(city)) = lower(trim(ship_to_name)) THEN trim(coalesce(ship_to_name, city)) ELSE trim(ship_to_name) || ' ' || trim(city) END AS place FROM vendors")
def combined_columns(spark, d):
    return table(spark, d, "vendors").select("vendor_id", text.combined(F.col("ship_to_name"), F.col("city")).alias("place"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_events(spark, d):
    e = table(spark, d, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    return e.select(F.col("window.start").alias("window_start"), "event_type", "n")


def _streamed(spark, d, name: str):
    """Folders for a stream's table, registry and checkpoint: in the shared checkpoint folder where there is one."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared or 'file://' + tempfile.gettempdir()}/{name}-{uuid.uuid4().hex}"


def _arriving(spark, d, at: str, parts: int = 3):
    """Events in `parts` deliveries by time, each written when the one before it has been processed."""
    e = table(spark, d, "events")
    first, last = e.agg(F.min("ts"), F.max("ts")).collect()[0]
    if first is None:
        return
    ends = [first + (last - first) * (i + 1) / parts for i in range(parts - 1)]
    number = sum(((F.col("ts") > end).cast("int") for end in ends), F.lit(0))
    for i in range(parts):
        e.filter(number == i).write.parquet(f"{at}/in/{i}")
        yield i


def _stream(spark, d, at: str):
    return spark.readStream.schema(table(spark, d, "events").schema).option("recursiveFileLookup", True).parquet(f"{at}/in")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def stream_dedup(spark, d):
    """Three deliveries; the registry of keys carries over from one run to the next."""
    at = _streamed(spark, d, "dedup")
    for _ in _arriving(spark, d, at):
        pipelines.into_registry(_stream(spark, d, at), ["user_id", "event_type"], ["ts", "event_id"], f"{at}/table", f"{at}/registry", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/table").select("event_id", "user_id", "event_type")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark, d):
    """Counts by hour kept up to date over three deliveries, repeats of an event within the watermark dropped."""
    at = _streamed(spark, d, "windows")
    for _ in _arriving(spark, d, at):
        counts = pipelines.windowed(_stream(spark, d, at), "ts", "1 hour", "event_type", lateness="7 days")
        pipelines.latest_of(counts, ["window_start", "event_type"], f"{at}/table", f"{at}/checkpoint").awaitTermination()
    return sinks.table(spark, f"{at}/table").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def stream_latest_state(spark, d):
    at = _streamed(spark, d, "state")
    for _ in _arriving(spark, d, at):
        pipelines.into_table(_stream(spark, d, at), "user_id", ["ts", "event_id"], f"{at}/table", f"{at}/checkpoint").awaitTermination()
    return sinks.table(spark, f"{at}/table").select("user_id", "event_id", "event_type")
