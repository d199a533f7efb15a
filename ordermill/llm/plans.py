"""Queries of the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm.addresses import match_addresses
from ordermill.llm.catalogue import map_to_catalogue
from ordermill.llm.encodings import repair_encoding
from ordermill.llm.entities import match_entities
from ordermill.llm.mail import new_lines
from ordermill.llm.mixing import mix_shares, mix_sources
from ordermill.llm.names import link_customers
from ordermill.llm.packing import pack_documents
from ordermill.session import table


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    """Documents with garbled characters, and their text as far as it can be regained."""
    return repair_encoding(table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_restored(spark, d).select("doc_id")


def p5_spans(spark: SparkSession, d: str) -> DataFrame:
    """Every visible line of every message with the kind of span that it belongs to."""
    return new_lines(table(spark, d, "mailbox_message"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_spans(spark, d).filter("span = 'authored'").select("message_no", "line_no")


def p6_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Every line with a code or description: its entry of materials and the edits between them."""
    return map_to_catalogue(table(spark, d, "po_line_items"), table(spark, d, "materials"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_mapped(spark, d).select("line_id", "customer_material_number")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Delivery and invoice addresses of the records and the address-book entries of the same place."""
    return match_addresses(table(spark, d, "po_headers"), table(spark, d, "address_book"))


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    """Typed names of the records linked to customer numbers, with confidence."""
    return link_customers(table(spark, d, "po_headers"), table(spark, d, "vendors"), table(spark, d, "name_alias"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_links(spark, d).select("record_id", "customer_number")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Container of every document (piece) for each capacity, and how full the container is."""
    return pack_documents(table(spark, d, "documents"), table(spark, d, "pack_capacity"))


def p9_selected(spark: SparkSession, d: str) -> DataFrame:
    """Every use of a document in the mix."""
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of each source."""
    return mix_shares(p9_selected(spark, d), table(spark, d, "mix_targets"))


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """Records and the rows of the customer master that describe their customer at their place, with confidence."""
    return match_entities(table(spark, d, "po_headers"), table(spark, d, "vendors"), table(spark, d, "name_alias"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).select("record_id", "vendor_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_matches, p8_packed, p9_selected, p9_shares, p4_found, p4_links, p2_found, p6_found, p6_mapped, p5_found, p5_spans, p10_found, p10_restored)}
ORACLES: dict[str, str] = {}
