"""Queries of the order-data operators that belong to the core: quantities and timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.operators.quantities import normalize_quantities
from ordermill.operators.timestamps import order_timestamps
from ordermill.session import table


def p3_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Every usable amount in base units, stated or inferred, with the posterior of its unit."""
    return normalize_quantities(table(spark, d, "po_line_items"), table(spark, d, "po_headers"), table(spark, d, "regional_config"), table(spark, d, "unit_map"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_amounts(spark, d).filter("status = 'stated'").select("line_id", "base_unit", "base_amount")


def p7_readings(spark: SparkSession, d: str) -> DataFrame:
    """Every readable date with its posterior; open ones are marked."""
    return order_timestamps(table(spark, d, "po_headers"), table(spark, d, "po_line_items"), table(spark, d, "regional_config"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_readings(spark, d).filter("status = 'resolved'").select("field", "row_id", "value_utc")


QUERIES = {f.__name__: f for f in (p3_found, p3_amounts, p7_found, p7_readings)}
