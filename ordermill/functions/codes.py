"""Expressions on codes, descriptions and document numbers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.functions.text import no_zeros, tokens

# Words that say nothing about a grade.
STOP = ("the", "and", "for", "of", "in", "to", "a", "an", "or", "na", "kg")
# Colours in the languages of the codes.
COLOURS = ("natural", "nat", "black", "blk", "white", "wht", "grey", "gray", "red", "blue", "green", "yellow", "orange", "brown")


def without_brackets(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s*\([^)]*\)", ""))


def without_words(c: Column, words: tuple[str, ...] = COLOURS) -> Column:
    """Without these whole words, in any case."""
    return F.trim(F.regexp_replace(c, rf"(?i)\b({'|'.join(words)})\b", "")) if words else c


def without_prefix(c: Column, prefixes: tuple[str, ...]) -> Column:
    """Without the first of the prefixes that it begins with, in any case; at most one goes."""
    hit = [F.when(F.lower(c).startswith(p.lower()), F.trim(F.substring(c, len(p) + 1, 1 << 30))) for p in prefixes]
    return F.coalesce(*hit, c)


def bare_code(c: Column, prefixes: tuple[str, ...] = ()) -> Column:
    return without_prefix(without_words(without_brackets(c)), prefixes)


def slash_forms(c: Column) -> Column:
    """The code as written and with its slashes turned either way."""
    return F.array_distinct(F.array(c, F.translate(c, "\\", "/"), F.translate(c, "/", "\\")))


def grade_tokens(c: Column, prefixes: tuple[str, ...] = (), stop: tuple[str, ...] = STOP) -> Column:
    """Words of a description that tell its grade: brackets and brand gone, 'B 4215' as one word, stop words left out."""
    joined = F.regexp_replace(without_prefix(without_brackets(c), prefixes), r"(?i)\b([A-Z]+)\s+([0-9]+)\b", "$1$2")
    words = F.split(F.regexp_replace(F.lower(joined), "[^a-z0-9]+", " "), " ")
    return F.array_except(F.filter(F.array_distinct(words), lambda w: w != ""), F.array(*[F.lit(s) for s in stop]))


def is_descriptive(c: Column) -> Column:
    """A code that reads like a description: five characters and more, a blank or comma, over a quarter of it letters."""
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    return F.coalesce((F.length(c) >= 5) & c.rlike("[ ,]") & (letters > 0.25 * F.length(c)), F.lit(False))


def mostly_digits(c: Column) -> Column:
    """More digits than other characters, blanks aside."""
    return F.coalesce(2 * F.length(F.regexp_replace(c, "[^0-9]", "")) > F.length(F.regexp_replace(c, r"\s", "")), F.lit(False))


def is_amount(c: Column) -> Column:
    """An amount, weight or price that stands where a code should."""
    return F.coalesce(F.trim(c).rlike(r"(?i)^\d+([.,]\d+)?\s*(kg|pcs|pc|ton|lb|g|eur|€)$"), F.lit(False))


def shape_of_id(c: Column, prefix: str, digits: int) -> Column:
    return F.coalesce(F.trim(c).rlike(f"^{re.escape(prefix)}[0-9]{{{digits - len(prefix)}}}$"), F.lit(False))


def plausible_number(c: Column, never: tuple[str, ...] = (), nowhere: tuple[str, ...] = ()) -> Column:
    """Whether a document number can be one: not blank, none of the words `never`, none of the words `nowhere` in it, not
    digits-letters-digits like a supplier's code. NULL is none."""
    t = F.upper(F.trim(c))
    bad = (t == "") | t.isin(*[w.upper() for w in never]) | F.regexp_replace(t, " ", "").rlike("^[0-9]{1,4}[A-Z]{1,4}[0-9]{1,6}$")
    inside = reduce(lambda a, b: a | b, [t.contains(w.upper()) for w in nowhere], F.lit(False))
    return F.coalesce(~(bad | inside), F.lit(False))


def without_end_slashes(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"[/\\\s]+$", "")


def message_id_ok(c: Column, prefix: str, longer_than: int = 40) -> Column:
    return F.coalesce(c.startswith(prefix) & (F.length(c) > longer_than), F.lit(False))


def shown(c: Column, most: int = 40, blank: str = "-") -> Column:
    """For display: cut at `most` characters with an ellipsis, `blank` for nothing."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(t == "", blank).when(F.length(t) > most, F.concat(F.substring(t, 1, most), F.lit("..."))).otherwise(t)


def seller_guard(c: Column, sellers: tuple[str, ...], *instead: Column) -> Column:
    """An address that names a seller is not the buyer's: the first filled one of the others stands for it."""
    named = reduce(lambda a, b: a | b, [F.upper(c).contains(s.upper()) for s in sellers], F.lit(False))
    other = F.coalesce(*[F.nullif(F.trim(x), F.lit("")) for x in instead], F.lit(""))
    return F.when(F.coalesce(named, F.lit(False)), other).otherwise(c)


def number_keys(c: Column) -> Column:
    """Forms under which an internal number is looked up: without zeros, and as written."""
    return F.array_distinct(F.array(no_zeros(F.trim(c)), F.trim(c)))


def plain_tokens(c: Column) -> Column:
    return F.filter(tokens(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), lambda w: w != "")
