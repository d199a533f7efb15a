"""Cascades of matches and set-similarity matches, always behind an equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import sequence_ratio


def first_match(items: DataFrame, master: DataFrame, on: list[str], tiers: list[Column], item_key: str, order: str, score: Column | None = None) -> DataFrame:
    """The best master row of each item: the lowest tier whose condition holds, then score, then the master's order.

    Items and master meet on the equality of on, so it is a hash join; the choice is an aggregation, not a sort of
    all candidates. Adds tier; items without a match are left out.
    """
    tier = F.coalesce(*[F.when(c, i) for i, c in enumerate(tiers)])
    found = items.join(master, on).withColumn("tier", tier).filter("tier is not null")
    rank = F.struct("tier", -(score if score is not None else F.lit(0.0)), order)
    row = F.struct(*[c for c in found.columns])
    return found.groupBy(F.col(item_key).alias("_item")).agg(F.min_by(row, rank).alias("_r")).select("_r.*")


def tokens_meet(left: DataFrame, right: DataFrame, left_tokens: str, right_tokens: str, left_key: str, right_key: str, same: list[str] | None = None) -> DataFrame:
    """left_key, right_key, shared: pairs with a common token, by an inverted index instead of all pairs.

    same: columns that must be equal besides; they keep frequent tokens from pairing everything.
    """
    same = same or []
    a = left.select(left_key, *same, F.explode(left_tokens).alias("_t"))
    b = right.select(right_key, *same, F.explode(right_tokens).alias("_t"))
    return a.join(b, [*same, "_t"]).groupBy(left_key, right_key).agg(F.count("*").alias("shared"))


def contained(texts: DataFrame, phrases: DataFrame, text: str, phrase: str, order: str, key: str) -> DataFrame:
    """key and, of the phrases that a text contains as whole words, the one of lowest order; one row per key.

    A phrase is a candidate where the text has its first word: an equality between distinct words. Only then is the
    text searched for it, so no text is searched for phrases that can't be in it.
    """
    plain = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    read = texts.select(key, plain(F.col(text)).alias("_t"))
    keyed = phrases.select(plain(F.col(phrase)).alias("_p"), F.struct(order, phrase).alias("_o")).filter("_p <> ''").withColumn("_w", F.substring_index("_p", " ", 1))
    # keys and words alone go through the first join, whole texts only where a phrase may be
    words = read.select(key, F.explode(F.array_distinct(F.split("_t", " "))).alias("_w"))
    may = words.join(keyed, "_w").select(key, "_p", "_o")
    within = F.concat(F.lit(" "), F.col("_t"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("_p"), F.lit(" ")))
    found = may.join(read, key).filter(within).groupBy(key).agg(F.min("_o").alias("_o"))
    return found.select(key, F.col(f"_o.{phrase}").alias(phrase))


def fuzzy_best(left: DataFrame, right: DataFrame, left_text: str, right_text: str, left_key: str, right_key: str, least: float = 0.65, block: int = 3) -> DataFrame:
    """left_key, right_key, score: the most similar right text of each left text at or above least.

    A right text is a candidate if it contains the first block characters of the left one; that is an equality
    between this head and the right text's distinct substrings of that length. The ratio is an Arrow function over
    candidates only; lengths that can't reach least are filtered before it.
    """
    a = left.select(left_key, F.lower(F.trim(left_text)).alias("_a")).filter(F.length("_a") >= block).withColumn("_h", F.substring("_a", 1, block))
    b = right.select(right_key, F.lower(F.trim(right_text)).alias("_b")).filter(F.length("_b") >= block)
    heads = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_b") - block + 1), lambda i: F.substring(F.col("_b"), i, F.lit(block))))
    pairs = a.join(b.withColumn("_h", F.explode(heads)), "_h").drop("_h")
    bound = 2.0 * F.least(F.length("_a"), F.length("_b")) / (F.length("_a") + F.length("_b"))
    # equal pairs of texts are scored once
    scored = pairs.filter(bound >= least).select("_a", "_b").distinct().withColumn("score", sequence_ratio("_a", "_b")).filter(F.col("score") >= least)
    return pairs.join(scored, ["_a", "_b"]).groupBy(left_key).agg(F.max_by(F.struct(right_key, "score"), F.struct("score", "_b")).alias("_r")).select(left_key, f"_r.{right_key}", F.bround("_r.score", 3).alias("score"))


def uniquely(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, candidates: the value of keys that have just one; NULL where several are possible."""
    out = df.groupBy(key).agg(F.count_distinct(value).alias("candidates"), F.min(value).alias("_v"))
    return out.select(key, F.when(F.col("candidates") == 1, F.col("_v")).alias(value), "candidates")
