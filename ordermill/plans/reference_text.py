"""Queries of the scalar operators, filters, reports and message lookups, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordermill.functions import anchored, codes, numbers, text
from ordermill.operators import messages, profile
from ordermill.plans.reference import _NULLISH, query
from ordermill.session import table

_DAY = r"(\d{1,2}[./-]\d{1,2}[./-]\d{2,4})"
_EAST = r"(\d{4}\s*[년年]\s*\d{1,2}\s*[월月]\s*\d{1,2}\s*[일日])"


def _labels(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(w.replace(" ", r"\s*") for w in words) + ")"


def _extract(c: str, pattern: str) -> str:
    return f"nullif(trim(regexp_extract({c}, '{pattern}', 1)), '')"


def _after(c: str, words: tuple[str, ...]) -> str:
    head = rf"(?i){_labels(words)}\s*[:.]?\s*"
    return f"coalesce({_extract(c, head + _DAY)}, {_extract(c, head + _EAST)})"


_ORDER_DATE = "coalesce(" + _after("text", anchored.ORDER_DATE) + ", " + _extract("text", rf"(?i){_DAY}\s*(?:\d+\s+days|net\s+\d+|eom)") + ", " + _extract("text", rf"(?:^|[^0-9]){_DAY}(?:[^0-9]|$)") + ")"


@query(f"SELECT doc_id, {_ORDER_DATE} AS order_date, {_after('text', anchored.DELIVERY_DATE)} AS delivery_date FROM documents")
def dates_in_text(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", anchored.order_date(c).alias("order_date"), anchored.delivery_date(c).alias("delivery_date"))


_NUMBERS = [_extract("text", rf"(?i){_labels(anchored.CONTRACT)}[\s:.#]*([A-Z0-9-]{{4,25}})"), _extract("text", rf"(?i){_labels(anchored.NUMBER)}\s*(?:no|nr|#)?\s*[:.#]?\s*([A-Z0-9][\w-]{{0,20}})")]


@query("SELECT doc_id, coalesce(" + ", ".join(f"CASE WHEN regexp_matches({n}, '[0-9]') AND length({n}) <= 20 AND NOT starts_with({n}, '0000') THEN {n} END" for n in _NUMBERS) + ") AS number FROM documents")
def numbers_in_text(spark, d):
    return table(spark, d, "documents").select("doc_id", anchored.document_number(F.col("text")).alias("number"))


_SOLD = rf"(?i)sold[\s-]*to(?:\s*party)?(?:\s*(?:code|id|no))?\s*[:=]?\s*([0-9]{{8,10}})(?:[^0-9]|$)"


@query(f"SELECT customer_number, vendor_id, {_extract('note', _SOLD)} AS sold, {_extract('note', _SOLD.replace('sold', 'ship', 1))} AS ship FROM (SELECT *, 'Please note: sold-to party code: ' || sold_to || ', ship to ' || ship_to || '.' AS note FROM vendors)")
def party_ids(spark, d):
    v = table(spark, d, "vendors").withColumn("note", F.concat(F.lit("Please note: sold-to party code: "), "sold_to", F.lit(", ship to "), "ship_to", F.lit(".")))
    return v.select("customer_number", "vendor_id", anchored.party_id(F.col("note"), "sold").alias("sold"), anchored.party_id(F.col("note"), "ship").alias("ship"))


@query("SELECT name, customer_number AS sold_to, n FROM (SELECT customer_number, count(DISTINCT internal_material_number) AS n, 'Order Sold-to_' || customer_number || ' Materials ' || string_agg(DISTINCT internal_material_number, '+' ORDER BY internal_material_number) || '.pdf' AS name FROM materials GROUP BY 1)")
def ids_in_file_names(spark, d):
    # names as senders write them, made of the customers' materials
    listed = F.array_join(F.array_sort(F.collect_set("internal_material_number")), "+")
    names = table(spark, d, "materials").groupBy("customer_number").agg(F.concat(F.lit("Order Sold-to_"), F.first("customer_number"), F.lit(" Materials "), listed, F.lit(".pdf")).alias("name"))
    return names.select("name", anchored.id_in_file_name(F.col("name")).alias("sold_to"), F.size(anchored.numbers_in_file_name(F.col("name"))).cast("bigint").alias("n"))


_BEHIND = "list_last(string_split(ship_to_address, trim(ship_to_postcode)))"


@query("SELECT record_id, CASE WHEN contains(ship_to_address, trim(ship_to_postcode)) THEN nullif(trim(regexp_extract(" + _BEHIND + r", '^[\s,]+([\p{L}][\p{L}\s.''-]{1,30}?)\s*(?:[(,;/\n\d]|$)', 1)), '') END AS town FROM po_headers WHERE trim(coalesce(ship_to_postcode, '')) <> ''")
def town_after_postcode(spark, d):
    h = table(spark, d, "po_headers").filter("trim(coalesce(ship_to_postcode, '')) <> ''")
    return h.select("record_id", anchored.town_after_postcode(F.col("ship_to_address"), F.col("ship_to_postcode")).alias("town"))


@query(r"SELECT message_no, lower(nullif(trim(regexp_extract(replace(body.content, chr(13), ''), '(?im)^[>\s]*(?:from|von|de)\s*:.*?([\w.+-]+@[\w-]+(?:\.[\w-]+)+)', 1)), '')) AS sender FROM mailbox_message WHERE body.content IS NOT NULL")
def sender_in_body(spark, d):
    m = table(spark, d, "mailbox_message").filter("body.content is not null")
    return m.select("message_no", anchored.sender(F.regexp_replace("body.content", "\r", "")).alias("sender"))


@query(r"SELECT doc_id, nullif(trim(regexp_extract(text, '(?:^|[^\p{L}\p{N}])(?:" + "|".join(anchored.TERMS) + r")\s*:?\s*(\p{L}{3,25})', 1)), '') AS town FROM documents")
def town_of_terms(spark, d):
    return table(spark, d, "documents").select("doc_id", anchored.town_of_terms(F.col("text")).alias("town"))


@query(
    r"SELECT line_id, coalesce(regexp_full_match(trim(material_code), '(?i)\d+([.,]\d+)?\s*(kg|pcs|pc|ton|lb|g|eur|€)'), false) AS amount, coalesce(length(material_code) >= 5 AND regexp_matches(material_code, '[ ,]') AND length(regexp_replace(material_code, '[^A-Za-z]', '', 'g')) > 0.25 * length(material_code), false) AS descriptive, "
    r"coalesce(2 * length(regexp_replace(material_code, '[^0-9]', '', 'g')) > length(regexp_replace(material_code, '\s', '', 'g')), false) AS digits, coalesce(regexp_full_match(trim(material_code), '70[0-9]{5}'), false) AS internal FROM po_line_items"
)
def code_shapes(spark, d):
    c = F.col("material_code")
    return table(spark, d, "po_line_items").select("line_id", codes.is_amount(c).alias("amount"), codes.is_descriptive(c).alias("descriptive"), codes.mostly_digits(c).alias("digits"), codes.shape_of_id(c, "70", 7).alias("internal"))


_BARE = "trim(regexp_replace(trim(regexp_replace({0}, '\\s*\\([^)]*\\)', '', 'g')), '(?i)\\b(" + "|".join(codes.COLOURS) + ")\\b', '', 'g'))"


@query("SELECT line_id, CASE WHEN starts_with(lower(b), 'your ref') THEN trim(substring(b, 9)) WHEN starts_with(lower(b), 'ref') THEN trim(substring(b, 4)) ELSE b END AS bare, list_distinct([material_code, replace(material_code, chr(92), '/'), replace(material_code, '/', chr(92))]).list_sort().array_to_string(' ') AS forms FROM (SELECT *, " + _BARE.format("trim(material_code)") + " AS b FROM po_line_items WHERE material_code IS NOT NULL)")
def bare_codes(spark, d):
    c = F.col("material_code")
    return table(spark, d, "po_line_items").filter("material_code is not null").select("line_id", codes.bare_code(F.trim(c), ("your ref", "ref")).alias("bare"), F.array_join(F.array_sort(codes.slash_forms(c)), " ").alias("forms"))


@query(r"SELECT record_id, regexp_replace(trim(po_number), '[/\\\s]+$', '') AS number, coalesce(NOT (upper(trim(po_number)) IN ('', 'N/A', 'TBD') OR contains(upper(trim(po_number)), 'BANK') OR regexp_full_match(replace(upper(trim(po_number)), ' ', ''), '[0-9]{1,4}[A-Z]{1,4}[0-9]{1,6}')), false) AS plausible FROM po_headers")
def number_sanity(spark, d):
    c = F.col("po_number")
    return table(spark, d, "po_headers").select("record_id", codes.without_end_slashes(c).alias("number"), codes.plausible_number(c, ("N/A", "TBD"), ("bank",)).alias("plausible"))


@query("SELECT record_id, CASE WHEN trim(coalesce(ship_to_address, '')) = '' THEN '-' WHEN length(trim(ship_to_address)) > 20 THEN substring(trim(ship_to_address), 1, 20) || '...' ELSE trim(ship_to_address) END AS shown FROM po_headers")
def shown_values(spark, d):
    return table(spark, d, "po_headers").select("record_id", codes.shown(F.col("ship_to_address"), 20).alias("shown"))


@query("SELECT record_id, CASE WHEN contains(upper(coalesce(ship_to_address, '')), 'BRAKENAU') THEN coalesce(nullif(trim(sold_to_address), ''), '') ELSE ship_to_address END AS address FROM po_headers")
def seller_guard(spark, d):
    return table(spark, d, "po_headers").select("record_id", codes.seller_guard(F.col("ship_to_address"), ("brakenau",), F.col("sold_to_address")).alias("address"))


@query("SELECT id, coalesce(starts_with(id, substring((SELECT min(id) FROM mailbox_message), 1, 2)) AND length(id) > 10, false) AS ok FROM (SELECT DISTINCT id FROM mailbox_message)")
def message_id_shape(spark, d):
    m = table(spark, d, "mailbox_message").select("id").distinct()
    head = m.agg(F.substring(F.min("id"), 1, 2)).collect()[0][0] or ""
    return m.select("id", codes.message_id_ok(F.col("id"), head, 10).alias("ok"))


@query("SELECT line_id, " + " AND ".join(f"NOT {_NULLISH.format(c)}" for c in ("material_code", "quantity")) + " AS valid, concat_ws('; ', " + ", ".join(f"CASE WHEN {_NULLISH.format(c)} THEN 'no {c}' END" for c in ("material_code", "quantity")) + ") AS reasons FROM po_line_items WHERE lower(coalesce(status, 'open')) IN ('open', 'complete')")
def valid_rows(spark, d):
    """Lines of wanted states, valid or with the reasons why not."""
    lines = table(spark, d, "po_line_items").filter(F.lower(F.coalesce("status", F.lit("open"))).isin("open", "complete"))
    bad = {c: text.is_nullish(F.col(c)) for c in ("material_code", "quantity")}
    return lines.select("line_id", (~bad["material_code"] & ~bad["quantity"]).alias("valid"), F.concat_ws("; ", *[F.when(b, f"no {c}") for c, b in bad.items()]).alias("reasons"))


@query("SELECT DISTINCT m.conversation_id FROM mailbox_message m WHERE conversation_id IS NOT NULL AND conversation_id NOT IN (SELECT conversation_id FROM mailbox_message WHERE starts_with(subject, 'RE:') AND conversation_id IS NOT NULL)")
def not_final_yet(spark, d):
    m = table(spark, d, "mailbox_message").filter("conversation_id is not null")
    return m.select("conversation_id").distinct().join(m.filter(F.col("subject").startswith("RE:")).select("conversation_id").distinct(), "conversation_id", "left_anti")


@query("SELECT message_no, a.name AS name FROM (SELECT message_no, subject, unnest(attachments) AS a FROM mailbox_message) WHERE starts_with(subject, 'RE:') AND a.type = 'application/pdf'")
def attachments_of_some(spark, d):
    """Attachments only of the messages that need them."""
    m = table(spark, d, "mailbox_message").filter(F.col("subject").startswith("RE:"))
    return m.select("message_no", F.inline("attachments")).filter("type = 'application/pdf'").select("message_no", "name")


_STEM = "lower(regexp_replace({0}, '\\.[^.]*$', ''))"


@query(
    f"WITH n AS (SELECT DISTINCT a.name AS name, a.type AS type FROM (SELECT unnest(attachments) AS a FROM mailbox_message)), f AS (SELECT name AS file, {_STEM.format('name')} AS fs FROM n WHERE type = 'application/pdf'), t AS (SELECT name, {_STEM.format('name')} AS ns FROM n WHERE type <> 'application/pdf'), "
    "c AS (SELECT file, name, CASE WHEN lower(file) = lower(name) THEN 0 WHEN fs = ns THEN 1 WHEN length(fs) >= 5 AND contains(ns, fs) THEN 2 WHEN length(ns) >= 5 AND contains(fs, ns) THEN 2 END AS tier FROM f, t) SELECT file, name, tier FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY tier, name) AS r FROM c WHERE tier IS NOT NULL) WHERE r = 1"
)
def file_of_attachment(spark, d):
    a = table(spark, d, "mailbox_message").select(F.inline("attachments"))
    return messages.attachments_of_files(a.filter("type = 'application/pdf'").select(F.col("name").alias("file")), a.filter("type <> 'application/pdf'").select("name"))


@query(
    "WITH n AS (SELECT DISTINCT regexp_extract(subject, '[0-9]{6,}') AS number FROM mailbox_message WHERE regexp_matches(subject, '[0-9]{6,}')), t AS (SELECT message_no, a.name AS t, 0 AS tier FROM (SELECT message_no, unnest(attachments) AS a FROM mailbox_message) UNION ALL SELECT message_no, subject, 1 FROM mailbox_message UNION ALL SELECT message_no, body.content, 2 FROM mailbox_message) "
    "SELECT number, message_no, tier FROM (SELECT number, message_no, tier, row_number() OVER (PARTITION BY number ORDER BY tier, message_no) AS r FROM n JOIN t ON contains(t.t, n.number)) WHERE r = 1"
)
def message_of_number(spark, d):
    m = table(spark, d, "mailbox_message")
    return messages.messages_of(m.select(F.regexp_extract("subject", "[0-9]{6,}", 0).alias("number")), m)


@query("SELECT DISTINCT a.source_file FROM po_headers a JOIN po_headers b ON lower(trim(a.source_file)) = lower(trim(b.source_file)) AND b._ord < a._ord")
def pushed_again(spark, d):
    """Files that came before: the first of each name is known, a later one is a repeat."""
    h = table(spark, d, "po_headers").withColumn("k", F.lower(F.trim("source_file")))
    first = h.groupBy("k").agg(F.min("_ord").alias("first"))
    return h.join(first, "k").filter("_ord > first").select("source_file").distinct()


@query(
    "SELECT o_orderkey, lines_total, difference_pct, difference_pct <= 5.0 AS within FROM (SELECT o_orderkey, round(s, 2) AS lines_total, round(abs(round(s, 2) - o_totalprice) * 100.0 / greatest(abs(o_totalprice), 0.01), 1) AS difference_pct FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"
)
def total_tolerance(spark, d):
    heads = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return messages.totals_within(heads, lines, "o_orderkey", "o_totalprice", F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 0.05)


_OUTCOME = f"CASE WHEN error IS NOT NULL THEN 'failed' WHEN {_NULLISH.format('customer_id_or_name')} THEN 'missing' ELSE 'success' END"


@query(f"SELECT sales_organization, count(*) AS n, count(*) FILTER (o = 'success') AS success, count(*) FILTER (o = 'missing') AS missing, count(*) FILTER (o = 'failed') AS failed, round_even(100.0 * count(*) FILTER (o = 'success') / count(*), 1)::DOUBLE AS success_pct FROM (SELECT sales_organization, {_OUTCOME} AS o FROM po_headers) GROUP BY 1")
def run_accuracy(spark, d):
    outcome = F.when(F.col("error").isNotNull(), "failed").when(text.is_nullish(F.col("customer_id_or_name")), "missing").otherwise("success")
    return messages.accuracy(table(spark, d, "po_headers"), "sales_organization", outcome)


@query(f"SELECT count(*) AS records, count(*) FILTER (error IS NULL) AS matched, sum(n)::BIGINT AS items, sum(ok)::BIGINT AS items_ok, sum(n - ok)::BIGINT AS items_missing FROM po_headers h LEFT JOIN (SELECT record_id, count(*) AS n, count(*) FILTER (NOT {_NULLISH.format('material_code')}) AS ok FROM po_line_items GROUP BY 1) USING (record_id)")
def run_totals(spark, d):
    per = table(spark, d, "po_line_items").groupBy("record_id").agg(F.count("*").alias("n"), F.count_if(~text.is_nullish(F.col("material_code"))).alias("ok"))
    return table(spark, d, "po_headers").join(per, "record_id", "left").agg(F.count("*").alias("records"), F.count_if(F.col("error").isNull()).alias("matched"), F.sum("n").alias("items"), F.sum("ok").alias("items_ok"), F.sum(F.col("n") - F.col("ok")).alias("items_missing"))


@query("SELECT from_address, count(*) AS messages, sum(len(attachments))::BIGINT AS files, strftime(max(received_ts), '%Y-%m-%d %H:%M:%S') AS latest FROM mailbox_message GROUP BY 1")
def sender_counts(spark, d):
    return table(spark, d, "mailbox_message").groupBy("from_address").agg(F.count("*").alias("messages"), F.sum(F.size("attachments")).alias("files"), F.date_format(F.max("received_ts"), "yyyy-MM-dd HH:mm:ss").alias("latest")).select("from_address", "messages", "files", "latest")


@query("SELECT (SELECT strftime(max(received_ts), '%Y-%m-%d %H:%M:%S') FROM po_headers) AS latest, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'P') AS partial FROM orders")
def run_marks(spark, d):
    """Latest extraction and the counts of the states, in one row."""
    states = table(spark, d, "orders").agg(*[F.count_if(F.col("o_orderstatus") == s).alias(n) for s, n in (("F", "done"), ("O", "open"), ("P", "partial"))])
    return table(spark, d, "po_headers").agg(F.date_format(F.max("received_ts"), "yyyy-MM-dd HH:mm:ss").alias("latest")).join(states, F.lit(True))


@query("SELECT o_custkey, o_orderpriority, n FROM (SELECT o_custkey, o_orderpriority, count(*) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, min(o_orderkey), o_orderpriority) AS r FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2) WHERE r = 1")
def first_of_set(spark, d):
    """The most frequent value of a set, of those that a group has."""
    return profile.mode_by(table(spark, d, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("SELECT customer_number, arg_min(name, _ord) AS name, count(*) AS n FROM vendors GROUP BY 1")
def first_rule_and_count(spark, d):
    return table(spark, d, "vendors").groupBy("customer_number").agg(F.min_by("name", F.when(F.col("name").isNotNull(), F.col("_ord"))).alias("name"), F.count("*").alias("n"))


@query("SELECT record_id, array_to_string(list(unit ORDER BY o, unit), '; ') AS units FROM (SELECT record_id, unit, min(_ord) AS o FROM po_line_items WHERE unit IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def listed_in_order(spark, d):
    """Distinct values in the order in which they first came."""
    return profile.listed_in_order(table(spark, d, "po_line_items").filter("unit is not null"), ["record_id"], "unit", "_ord").withColumnRenamed("listed", "units")


@query("SELECT from_address, coalesce(arg_min(from_name, message_no) FILTER (contains(from_name, ' ')), arg_min(from_name, message_no)) AS contact FROM mailbox_message GROUP BY 1")
def contact_of_sender(spark, d):
    """The first full name of an address, else its first name."""
    full = F.when(F.contains(F.col("from_name"), F.lit(" ")), F.col("message_no"))
    return table(spark, d, "mailbox_message").groupBy("from_address").agg(F.coalesce(F.min_by("from_name", full), F.min_by("from_name", F.when(F.col("from_name").isNotNull(), F.col("message_no")))).alias("contact"))


@query("WITH f AS (SELECT sender_email, arg_min(ship_to_city, _ord) FILTER (trim(ship_to_city) <> '') AS a FROM po_headers GROUP BY 1), g AS (SELECT sales_organization, arg_min(ship_to_city, _ord) FILTER (trim(ship_to_city) <> '') AS b FROM po_headers GROUP BY 1) SELECT h.record_id, coalesce(nullif(trim(h.ship_to_city), ''), f.a, g.b) AS town FROM po_headers h LEFT JOIN f ON f.sender_email = h.sender_email LEFT JOIN g ON g.sales_organization = h.sales_organization")
def first_nonblank_fallback(spark, d):
    """A record's own value, else its sender's first, else its organisation's first."""
    h = table(spark, d, "po_headers")
    f = profile.first_filled_by(h, ["sender_email"], ["ship_to_city"], "_ord").withColumnRenamed("ship_to_city", "a")
    g = profile.first_filled_by(h, ["sales_organization"], ["ship_to_city"], "_ord").withColumnRenamed("ship_to_city", "b")
    return h.join(f, "sender_email", "left").join(g, "sales_organization", "left").select("record_id", F.coalesce(F.nullif(F.trim("ship_to_city"), F.lit("")), "a", "b").alias("town"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'file' || event_id || '.pdf' WHEN 1 THEN 'scan' || event_id || '.pdf' ELSE 'plain' || event_id || '.pdf' END AS file FROM events")
def event_files(spark, d):
    """Names of files in events: the end of a link, a name, or the text itself."""
    i, n = F.col("event_id"), F.col("event_id").cast("string")
    told = F.when(i % 3 == 0, F.concat(F.lit('{"data": {"url": "https://store.example/in/file'), n, F.lit('.pdf"}}'))).when(i % 3 == 1, F.concat(F.lit('{"filename": "scan'), n, F.lit('.pdf"}'))).otherwise(F.concat(F.lit("plain"), n, F.lit(".pdf")))
    return table(spark, d, "events").select("event_id", text.event_file(told).alias("file"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def sound_json(spark, d):
    """Objects under 'data', damaged in one of three ways, or sound."""
    damaged = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('Here it is:\n```json\n{"data": '), "props", F.lit(",}\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"data": '), "props", F.lit("}"))).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", F.get_json_object(text.sound_json(damaged), "$.k").try_cast("bigint").alias("k"))


@query()
def plain_names_core(spark, d):
    """Names for comparison (tests/test_scalars.py has the examples; accents have no equal SQL)."""
    return table(spark, d, "vendors").select("vendor_id", text.plain_name("name").alias("name"))


@query("SELECT record_id, translate(vendor_name, '" + text.TRADITIONAL + "', '" + text.SIMPLIFIED + "') AS vendor_name FROM po_headers")
def simplified_names(spark, d):
    return table(spark, d, "po_headers").select("record_id", text.simplified(F.col("vendor_name")).alias("vendor_name"))


@query("WITH n AS (SELECT record_id, count(*) AS n, min(delivery_date) FILTER (NOT " + _NULLISH.format("delivery_date") + ") AS own FROM po_line_items GROUP BY 1) SELECT l.line_id, CASE WHEN NOT " + _NULLISH.format("l.delivery_date") + " THEN l.delivery_date WHEN n.n = 1 THEN h.requested_delivery_date END AS day FROM po_line_items l JOIN n USING (record_id) LEFT JOIN po_headers h USING (record_id)")
def item_dates(spark, d):
    """A line's own date; the record's where it is the only line."""
    l = table(spark, d, "po_line_items")
    n = l.groupBy("record_id").agg(F.count("*").alias("n"))
    both = l.select("line_id", "record_id", "delivery_date").join(n, "record_id").join(table(spark, d, "po_headers").select("record_id", "requested_delivery_date"), "record_id", "left")
    return both.select("line_id", F.when(~text.is_nullish(F.col("delivery_date")), F.col("delivery_date")).when(F.col("n") == 1, F.col("requested_delivery_date")).alias("day"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_quantity / 8, 2)::DOUBLE AS score, coalesce(l_discount, 0) <> 0 AS discounted FROM lineitem")
def rounded_scores(spark, d):
    """Half-even rounding of eighths to two places, and a NULL-safe test of a number."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.bround(F.col("l_quantity") / 8, 2).alias("score"), numbers.truthy(F.col("l_discount")).alias("discounted"))
