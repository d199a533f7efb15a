"""Values found in running text by the words before them: document numbers, dates, parties, towns, identifiers.

Every function takes its words as a parameter; the defaults are plain words of the documents' languages.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the two dates, of document numbers, and terms of delivery before a town.
ORDER_DATE = ("order date", "document date", "bestelldatum", "date de commande", "订单日期", "발주일", "주문일", "작성일")
DELIVERY_DATE = ("requested delivery date", "delivery date", "liefertermin", "date de livraison", "交货日期", "납기일", "납기")
NUMBER = ("purchase order", "po number", "po no", "order no", "bestellnummer", "commande no")
CONTRACT = ("contract no", "agreement no", "contract")
TERMS = ("CIP", "DAP", "DDP", "FCA", "CPT", "FOB", "CIF")
# Short words in capitals that name no building.
NO_IDENTIFIER = ("DAP", "FOB", "CIF", "EUR", "DIN", "ISO", "VAT", "STR", "AND", "THE", "GEB")

_DAY = r"(\d{1,2}[./-]\d{1,2}[./-]\d{2,4})"
_EAST_DAY = r"(\d{4}\s*[년年]\s*\d{1,2}\s*[월月]\s*\d{1,2}\s*[일日])"


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.trim(F.regexp_extract(text, pattern, group)), F.lit(""))


def _words(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(re.escape(w).replace(r"\ ", r"\s*") for w in words) + ")"


def date_after(text: Column, labels: tuple[str, ...]) -> Column:
    """The day written behind one of the labels, in figures or in East Asian form; NULL if there is none."""
    head = rf"(?i){_words(labels)}\s*[:.]?\s*"
    return F.coalesce(_found(text, head + _DAY), _found(text, head + _EAST_DAY))


def order_date(text: Column) -> Column:
    """Behind its label, else before terms of payment, else the first day of the text."""
    return F.coalesce(date_after(text, ORDER_DATE), _found(text, rf"(?i){_DAY}\s*(?:\d+\s+days|net\s+\d+|eom)"), _found(text, rf"(?:^|[^0-9]){_DAY}(?:[^0-9]|$)"))


def delivery_date(text: Column) -> Column:
    return date_after(text, DELIVERY_DATE)


def document_number(text: Column, most: int = 20) -> Column:
    """A contract's number, else one behind a label of orders: letters, digits and hyphens, with a digit, no zeros ahead."""
    tried = [_found(text, rf"(?i){_words(CONTRACT)}[\s:.#]*([A-Z0-9-]{{4,25}})"), _found(text, rf"(?i){_words(NUMBER)}\s*(?:no|nr|#)?\s*[:.#]?\s*([A-Z0-9][\w-]{{0,20}})")]
    return F.coalesce(*[F.when(t.rlike("[0-9]") & (F.length(t) <= most) & ~t.startswith("0000"), t) for t in tried])


def party_id(text: Column, party: str) -> Column:
    """The number of eight to ten digits behind 'sold to' or 'ship to' (party: 'sold' or 'ship')."""
    return _found(text, rf"(?i){party}[\s-]*to(?:\s*party)?(?:\s*(?:code|id|no))?\s*[:=]?\s*([0-9]{{8,10}})(?:[^0-9]|$)")


def id_in_file_name(name: Column, label: str = "sold-to") -> Column:
    return _found(name, rf"(?i){re.escape(label)}\s*[-_]?\s*([0-9A-Za-z]+)")


def numbers_in_file_name(name: Column, label: str = "material") -> Column:
    """Numbers joined by plus signs behind the label, as an array; empty if there are none."""
    return F.filter(F.split(F.regexp_extract(name, rf"(?i){label}s?[\s_-]+([0-9+]+)", 1), r"\+"), lambda x: x != "")


def sender(text: Column) -> Column:
    """The address in the first 'From:' line of a body."""
    return F.lower(_found(text, r"(?im)^[>\s]*(?:from|von|de)\s*:.*?([\w.+-]+@[\w-]+(?:\.[\w-]+)+)"))


def town_after_postcode(address: Column, postcode: Column) -> Column:
    """The words behind the postcode, up to a comma, bracket, line end or digit."""
    code = F.trim(postcode)
    # what stands behind the code, without a pattern that is made from data
    behind = F.when((code != "") & F.contains(address, code), F.call_function("substring_index", address, code, F.lit(-1)))
    return _found(behind, r"^[\s,]+([\p{L}][\p{L}\s.'-]{1,30}?)\s*(?:[(,;/\n\d]|$)")


def town_of_terms(text: Column, terms: tuple[str, ...] = TERMS) -> Column:
    return _found(text, rf"(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(terms)})\s*:?\s*(\p{{L}}{{3,25}})")


def postcode_tokens(c: Column) -> Column:
    """Forms a postcode field may mean: its words and two words beside each other as one, marks left out, upper case."""
    words = F.filter(F.split(F.upper(F.trim(c)), r"\s+"), lambda w: w != "")
    two = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(w, F.get(words, i + 1)))
    plain = F.transform(F.concat(words, two), lambda w: F.regexp_replace(w, "-", ""))
    return F.coalesce(F.array_distinct(F.filter(plain, lambda w: w != "")), F.array().cast("array<string>"))


def identifiers(address: Column, stop: tuple[str, ...] = NO_IDENTIFIER) -> Column:
    """Building numbers, letter-digit codes and short words in capitals of an address, blanks left out."""
    edge, end = r"(?:^|[^\p{L}\p{N}])", r"(?:[^\p{L}\p{N}]|$)"
    parts = F.concat(
        F.regexp_extract_all(F.upper(address), F.lit(edge + r"(?:GEB(?:ÄUDE)?|BLDG|BUILDING)\.?\s*([A-Z]?\s*[0-9]+)" + end), F.lit(1)),
        F.regexp_extract_all(address, F.lit(edge + r"([A-Z]{1,3}\s*[0-9]{2,4})" + end), F.lit(1)),
        F.filter(F.split(address, r"[^\p{L}\p{N}]+"), lambda w: w.rlike("^[A-Z]{3,6}$")),
    )
    found = F.array_distinct(F.transform(parts, lambda x: F.regexp_replace(x, r"\s", "")))
    return F.coalesce(F.array_except(found, F.array(*[F.lit(s) for s in stop])), F.array().cast("array<string>"))


def word_share(name: Column, text: Column) -> Column:
    """Share of the name's words that are longer than three letters and occur in the text; 0 for no words."""
    words = F.filter(F.split(F.lower(F.trim(name)), r"\s+"), lambda w: w != "")
    hits = F.filter(words, lambda w: (F.length(w) > 3) & F.contains(F.lower(text), w))
    return F.coalesce(F.size(hits) / F.greatest(F.size(words), F.lit(1)), F.lit(0.0))
