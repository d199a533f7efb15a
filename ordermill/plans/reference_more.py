"""More queries of the general operators: cleansing, filters, lookups, nested values, message keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.functions import text
from ordermill.functions.numbers import percent
from ordermill.operators import keyed, profile
from ordermill.plans.reference import _NULLISH, query
from ordermill.session import table


@query("SELECT record_id, _ord FROM po_headers ORDER BY _ord DESC, record_id DESC LIMIT 20")
def tail_rows(spark, d):
    return table(spark, d, "po_headers").select("record_id", "_ord").orderBy(F.desc("_ord"), F.desc("record_id")).limit(20)


@query("SELECT h.record_id, l.first_unit FROM po_headers h LEFT JOIN (SELECT record_id, arg_min(unit, (_ord, line_id)) FILTER (unit IS NOT NULL) AS first_unit FROM po_line_items GROUP BY 1) l USING (record_id)")
def pull_up_first(spark, d):
    first = table(spark, d, "po_line_items").filter("unit is not null").groupBy("record_id").agg(F.min_by("unit", F.struct("_ord", "line_id")).alias("first_unit"))
    return table(spark, d, "po_headers").select("record_id").join(first, "record_id", "left")


_WRONG = {"no code": "material_code", "no quantity": "quantity", "no unit": "unit"}


@query("SELECT line_id, concat_ws('; ', " + ", ".join(f"CASE WHEN {_NULLISH.format(c)} THEN '{r}' END" for r, c in _WRONG.items()) + ") AS reasons FROM po_line_items")
def rows_with_reasons(spark, d):
    reasons = [F.when(text.is_nullish(F.col(c)), F.lit(r)) for r, c in _WRONG.items()]
    return table(spark, d, "po_line_items").select("line_id", F.concat_ws("; ", *reasons).alias("reasons"))


@query("SELECT record_id FROM po_headers WHERE contains(lower(coalesce(vendor_name, '')), 'resins') OR contains(lower(coalesce(ship_to_name, '')), 'resins') OR contains(lower(coalesce(customer_id_or_name, '')), 'resins')")
def any_column_contains(spark, d):
    hit = reduce(lambda a, b: a | b, [F.lower(F.coalesce(c, F.lit(""))).contains("resins") for c in ("vendor_name", "ship_to_name", "customer_id_or_name")])
    return table(spark, d, "po_headers").filter(hit).select("record_id")


@query("SELECT doc_type, count(*) AS n FROM documents WHERE regexp_matches(text, 'credit check|Kreditpr|contr.le cr.dit') GROUP BY 1")
def regex_alternatives(spark, d):
    return table(spark, d, "documents").filter(F.col("text").rlike("credit check|Kreditpr|contr.le cr.dit")).groupBy("doc_type").agg(F.count("*").alias("n"))


@query("SELECT line_id, regexp_replace(unit_price, '\\.0+$', '') AS unit_price FROM po_line_items WHERE unit_price IS NOT NULL")
def no_decimal_zeros(spark, d):
    return table(spark, d, "po_line_items").filter("unit_price is not null").select("line_id", F.regexp_replace("unit_price", r"\.0+$", "").alias("unit_price"))


_MARKED = ["quantity", "unit", "material_code", "delivery_date"]


_TRIMMED = "regexp_replace({0}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


@query("SELECT line_id, " + ", ".join(f"CASE WHEN NOT {_NULLISH.format(_TRIMMED.format(c))} THEN {_TRIMMED.format(c)} END AS {c}" for c in _MARKED) + " FROM po_line_items")
def markers_to_null(spark, d):
    # any blank at the ends, no-break and full-width ones too
    bare = lambda c: F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return table(spark, d, "po_line_items").select("line_id", *[text.null_if_word(bare(F.col(c))).alias(c) for c in _MARKED])


@query("WITH n AS (SELECT DISTINCT ship_to FROM vendors) SELECT r.vendor_id, min(n.ship_to) AS ship_to FROM (SELECT vendor_id, right(ship_to, 7) AS digits FROM vendors) r JOIN n ON suffix(n.ship_to, r.digits) GROUP BY 1")
def suffix_id_join(spark, d):
    # suffixes of the lengths that occur are keys, so the join is on equality
    r = table(spark, d, "vendors").select("vendor_id", F.right(F.col("ship_to"), F.lit(7)).alias("digits"))
    n = table(spark, d, "vendors").select("ship_to").filter("ship_to is not null").distinct()
    n = n.select("ship_to", F.explode(F.transform(F.sequence(F.lit(4), F.greatest(F.length("ship_to"), F.lit(4))), lambda k: F.right(F.col("ship_to"), k))).alias("digits")).distinct()
    return r.join(n, "digits").groupBy("vendor_id").agg(F.min("ship_to").alias("ship_to"))


@query("SELECT message_no, a.name AS name, lower(regexp_extract(a.name, '\\.([^.]+)$', 1)) AS extension, CASE lower(regexp_extract(a.name, '\\.([^.]+)$', 1)) WHEN 'pdf' THEN 'application/pdf' WHEN 'xlsx' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' WHEN 'png' THEN 'image/png' WHEN 'txt' THEN 'text/plain' ELSE 'application/octet-stream' END AS mime FROM (SELECT message_no, unnest(attachments) AS a FROM mailbox_message)")
def mime_types(spark, d):
    # Types by extension.
    known = {"pdf": "application/pdf", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "png": "image/png", "txt": "text/plain"}
    a = table(spark, d, "mailbox_message").select("message_no", F.inline("attachments")).select("message_no", "name", text.file_extension(F.col("name")).alias("extension"))
    types = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return a.withColumn("mime", F.coalesce(types[F.col("extension")], F.lit("application/octet-stream")))


@query("SELECT sender_email, array_to_string(list_sort(list_distinct(list_concat(coalesce(list(DISTINCT currency) FILTER (currency IS NOT NULL), []), coalesce(list(DISTINCT sales_organization) FILTER (sales_organization IS NOT NULL), [])))), ', ') AS codes FROM po_headers GROUP BY 1")
def united_lists(spark, d):
    both = table(spark, d, "po_headers").groupBy("sender_email").agg(F.collect_set("currency").alias("a"), F.collect_set("sales_organization").alias("b"))
    return both.select("sender_email", F.array_join(F.array_sort(F.array_union("a", "b")), ", ").alias("codes"))


@query("SELECT line_id, (n - 1)::INT AS place, parts[n] AS part FROM (SELECT line_id, list_reverse(string_split(material_code, '/')) AS parts FROM po_line_items WHERE contains(material_code, '/')) t, LATERAL (SELECT unnest(generate_series(1, len(t.parts))) AS n) WHERE length(parts[n]) >= 3")
def slash_parts(spark, d):
    parts = table(spark, d, "po_line_items").filter(F.col("material_code").contains("/")).select("line_id", F.posexplode(F.reverse(F.split("material_code", "/"))).alias("place", "part"))
    return parts.filter(F.length("part") >= 3)


@query("SELECT lang, count(*) FILTER (regexp_matches(text, '[一-鿿]')) AS han, count(*) FILTER (regexp_matches(text, '[가-힣]')) AS hangul, count(*) AS n FROM documents GROUP BY 1")
def scripts_by_language(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.count_if(F.col("text").rlike("[一-鿿]")).alias("han"), F.count_if(F.col("text").rlike("[가-힣]")).alias("hangul"), F.count("*").alias("n"))


@query("SELECT l.line_id, coalesce(nullif(trim(l.sender_email), ''), nullif(trim(h.sender_email), ''), 'unknown') AS sender, coalesce(nullif(trim(l.po_number), ''), nullif(trim(h.po_number), '')) AS po FROM po_line_items l LEFT JOIN po_headers h USING (record_id)")
def outer_enrich(spark, d):
    l, h = table(spark, d, "po_line_items").alias("l"), table(spark, d, "po_headers").alias("h")
    both = l.join(h, F.col("l.record_id") == F.col("h.record_id"), "left")
    return both.select("line_id", text.first_filled(F.col("l.sender_email"), F.col("h.sender_email"), F.lit("unknown")).alias("sender"), text.first_filled(F.col("l.po_number"), F.col("h.po_number")).alias("po"))


_FILLED = ["order_date", "customer_id_or_name", "ship_to_name", "ship_to_address", "ship_to_city", "currency"]


@query("WITH f AS (SELECT record_id, source_file, " + " + ".join(f"(NOT {_NULLISH.format(c)})::INT" for c in _FILLED) + " AS filled FROM po_headers) SELECT source_file, record_id, filled FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY filled DESC, record_id) AS r FROM f) WHERE r = 1")
def best_extraction(spark, d):
    filled = reduce(lambda a, b: a + b, [(~text.is_nullish(F.col(c))).cast("int") for c in _FILLED])
    f = table(spark, d, "po_headers").select("record_id", "source_file", filled.alias("filled")).withColumn("_less", -F.col("filled"))
    return keyed.keep_first(f, ["source_file"], ["_less", "record_id"]).select("source_file", "record_id", "filled")


@query("SELECT record_id, substring(regexp_replace(source_file, '[^A-Za-z0-9._-]+', '_', 'g'), 1, 40) AS safe FROM po_headers WHERE source_file IS NOT NULL")
def safe_names(spark, d):
    return table(spark, d, "po_headers").filter("source_file is not null").select("record_id", F.substring(F.regexp_replace("source_file", "[^A-Za-z0-9._-]+", "_"), 1, 40).alias("safe"))


@query("SELECT lower(regexp_extract(from_address, '@(.+)$', 1)) AS domain, count(*) AS n, count(DISTINCT from_address) AS senders FROM mailbox_message GROUP BY 1")
def sender_domains(spark, d):
    return table(spark, d, "mailbox_message").groupBy(F.lower(F.regexp_extract("from_address", "@(.+)$", 1)).alias("domain")).agg(F.count("*").alias("n"), F.count_distinct("from_address").alias("senders"))


@query("SELECT record_id, count(*) FILTER (NOT regexp_matches(lower(coalesce(status, '')), 'cancel|forecast')) AS kept, count(*) AS n FROM po_line_items GROUP BY 1")
def nested_filter(spark, d):
    nested = table(spark, d, "po_line_items").groupBy("record_id").agg(F.collect_list(F.lower(F.coalesce("status", F.lit("")))).alias("s"))
    return nested.select("record_id", F.size(F.filter("s", lambda x: ~x.rlike("cancel|forecast"))).cast("bigint").alias("kept"), F.size("s").cast("bigint").alias("n"))


@query("SELECT message_no, CASE WHEN conversation_id IS NOT NULL AND conversation_id <> '' THEN 'cid:' || conversation_id ELSE concat_ws('|', subject, from_address, strftime(received_ts, '%Y-%m-%dT%H:%M:%S')) END AS message_key FROM mailbox_message")
def message_keys(spark, d):
    other = F.concat_ws("|", "subject", "from_address", F.date_format("received_ts", "yyyy-MM-dd'T'HH:mm:ss"))
    known = F.col("conversation_id").isNotNull() & (F.col("conversation_id") != "")
    return table(spark, d, "mailbox_message").select("message_no", F.when(known, F.concat(F.lit("cid:"), F.col("conversation_id"))).otherwise(other).alias("message_key"))


@query("SELECT strftime(received_ts, '%Y-%m-%d') AS day, count(*) AS n, strftime(max(received_ts), '%H:%M:%S') AS latest FROM po_headers GROUP BY 1")
def counts_by_day(spark, d):
    return table(spark, d, "po_headers").groupBy(F.date_format("received_ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.date_format(F.max("received_ts"), "HH:mm:ss").alias("latest"))


@query("WITH u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY _ord, record_id) AS r FROM po_headers) WHERE r = 1) " + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS records, count(*) FILTER (NOT {_NULLISH.format(c)}) AS filled, round_even(100.0 * count(*) FILTER (NOT {_NULLISH.format(c)}) / count(*), 1)::DOUBLE AS filled_pct FROM u" for c in _FILLED))
def coverage_of_unique(spark, d):
    unique = keyed.keep_first(table(spark, d, "po_headers"), ["source_file"], ["_ord", "record_id"])
    c = profile.completeness(unique, _FILLED)
    return c.select(F.col("column_name").alias("field"), F.col("total").alias("records"), F.col("present").alias("filled"), F.col("present_pct").alias("filled_pct"))


@query("SELECT outcome, count(*) AS n, round_even(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM (SELECT CASE WHEN error IS NOT NULL THEN 'error' WHEN " + _NULLISH.format("customer_id_or_name") + " THEN 'no customer' WHEN " + _NULLISH.format("ship_to_address") + " THEN 'no address' ELSE 'complete' END AS outcome FROM po_headers) GROUP BY 1")
def outcome_counts(spark, d):
    outcome = F.when(F.col("error").isNotNull(), "error").when(text.is_nullish(F.col("customer_id_or_name")), "no customer").when(text.is_nullish(F.col("ship_to_address")), "no address").otherwise("complete")
    n = table(spark, d, "po_headers").select(outcome.alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n"))
    return n.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def mended_props(spark, d):
    # the objects are damaged in the ways that texts around them cause, and mended
    noisy = F.concat(F.lit("```json\n"), F.regexp_replace("props", r"\}$", ",}"), F.lit("\n```"))
    return table(spark, d, "events").select("event_id", F.get_json_object(text.mended_json(noisy), "$.k").try_cast("bigint").alias("k"))


@query("SELECT line_id, CASE WHEN material_code ~ '^0+$' THEN '0' ELSE ltrim(material_code, '0') END AS bare, CASE WHEN length(material_code) >= 18 THEN material_code ELSE lpad(material_code, 18, '0') END AS padded FROM po_line_items WHERE regexp_full_match(material_code, '[0-9]+')")
def zero_padding(spark, d):
    c = F.col("material_code")
    return table(spark, d, "po_line_items").filter(c.rlike("^[0-9]+$")).select("line_id", text.no_zeros(c).alias("bare"), text.padded(c, 18).alias("padded"))


@query("SELECT a.vendor_id, a.name FROM vendors a JOIN (SELECT lower(trim(name)) AS k FROM vendors WHERE name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT name) > 1) b ON lower(trim(a.name)) = b.k")
def same_but_case(spark, d):
    v = table(spark, d, "vendors").filter("name is not null").withColumn("_k", F.lower(F.trim("name")))
    return v.join(profile.ambiguous(v, ["_k"], "name").select("_k"), "_k", "left_semi").select("vendor_id", "name")


@query()
def accentless_names(spark, d):
    return table(spark, d, "vendors").select("vendor_id", text.accentless("name").alias("name"))
