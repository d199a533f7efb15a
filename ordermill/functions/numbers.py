"""Three readings of written numbers that disagree on purpose, and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(text: Column) -> Column:
    """double of plain digits; the pattern keeps out suffixes that a cast would take for types."""
    return F.when(text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$"), text.try_cast("double"))


def _folded(c: Column) -> Column:
    """Full-width digits as ASCII ones, any blank as a plain one."""
    return F.regexp_replace(F.translate(c, "０１２３４５６７８９", "0123456789"), r"[\s\p{Z}]", " ")


def plain_number(c: Column) -> Column:
    """Commas group, the point is decimal: '1,000' is 1000, 'abc' is NULL."""
    return _number(F.translate(F.trim(_folded(c)), ",", ""))


def comma_decimal(c: Column) -> Column:
    """Of both separators the last is the decimal one; a comma alone is decimal: '24,000' is 24, '1.000,00' is 1000."""
    t = F.regexp_replace(_folded(c), r"[^\d.,-]", "")
    comma, point = F.instr(F.reverse(t), ","), F.instr(F.reverse(t), ".")
    both = (comma > 0) & (point > 0)
    return F.when(both & (comma < point), _number(F.translate(F.translate(t, ".", ""), ",", "."))).when(both | (comma == 0), _number(F.translate(t, ",", ""))).otherwise(_number(F.translate(t, ",", ".")))


def grouped_number(c: Column) -> Column:
    """Groups of three digits are thousands whatever separates them: '24,000' and '1.500' are 24000 and 1500."""
    t = F.regexp_extract(_folded(c), r"[\d.,]+", 0)
    return (
        F.when(t.rlike(r"^\d{1,3}(\.\d{3})+(,\d+)?$"), _number(F.translate(F.translate(t, ".", ""), ",", ".")))
        .when(t.rlike(r"^\d{1,3}(,\d{3})+(\.\d+)?$"), _number(F.translate(t, ",", "")))
        .otherwise(_number(F.translate(t, ",", ".")))
    )


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage, half to even as people's tools have it; 0 of nothing is 0."""
    return F.when(whole > 0, F.bround(part * 100.0 / whole, digits)).otherwise(0.0)


def truthy(c: Column) -> Column:
    """A number that is there and not zero."""
    return F.coalesce(c != 0, F.lit(False))
