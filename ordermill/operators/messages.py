"""Files and messages that belong together, and reports over runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import text
from ordermill.functions.numbers import percent
from ordermill.operators.cascade import HEAD, best_rows, contained_pairs


def attachments_of_files(files: DataFrame, attachments: DataFrame, least: int = 5) -> DataFrame:
    """file, name, tier: the attachment name of each file name. 0 the same name, 1 the same stem, 2 a stem of `least`
    characters and more inside the other; case aside, ties to the first by name."""
    a = files.select("file").distinct().select("file", F.lower("file").alias("f"), F.lower(text.file_stem(F.col("file"))).alias("fs"))
    b = attachments.select("name").distinct().select("name", F.lower("name").alias("n"), F.lower(text.file_stem(F.col("name"))).alias("ns"))
    equal = a.join(b.select("name", F.col("n").alias("f")), "f").select("file", "name", F.lit(0).alias("tier"))
    stem = a.join(b.select("name", F.col("ns").alias("fs")), "fs").select("file", "name", F.lit(1).alias("tier"))
    there = contained_pairs(a.select("file", "fs"), b.select("name", "ns"), [], "fs", "ns", least)
    back = contained_pairs(b.select("name", "ns"), a.select("file", "fs"), [], "ns", "fs", least)
    inside = there.select("file", "name").unionByName(back.select("file", "name")).withColumn("tier", F.lit(2))
    return best_rows(equal.unionByName(stem).unionByName(inside), "file", "tier", "name").select("file", "name", "tier")


def messages_of(numbers: DataFrame, messages: DataFrame, least: int = 5) -> DataFrame:
    """number, message_no, tier: the message of each document number. 0 in a file name, 1 in the subject, 2 in the body;
    ties to the first message.

    A number without blanks lies inside one word that has a digit, so each distinct word is searched once, with the first
    message that has it. Numbers of other forms are searched in the texts themselves, if there are any: that is decided
    by a look at the numbers when the plan is made.
    """
    n = numbers.select(F.trim("number").alias("number")).filter(F.length("number") >= least)
    word = r"[\p{L}\p{N}/_.-]"
    plain = F.col("number").rlike(f"^{word}*[0-9]{word}*$")
    names = messages.select("message_no", F.explode("attachments.name").alias("t"))
    parts = [(names, 0), (messages.select("message_no", F.col("subject").alias("t")), 1), (messages.select("message_no", F.col("body.content").alias("t")), 2)]
    texts = reduce(lambda x, y: x.unionByName(y), [where.filter("t is not null").withColumn("tier", F.lit(tier)) for where, tier in parts])
    words = F.filter(F.regexp_extract_all("t", F.lit(f"{word}+"), F.lit(0)), lambda w: (F.length(w) >= least) & w.rlike("[0-9]"))
    told = texts.select("tier", "message_no", F.explode(words).alias("t")).groupBy("t", "tier").agg(F.min("message_no").alias("message_no"))
    hits = _words_with(n.filter(plain).distinct(), told, least)
    if not n.filter(~plain).isEmpty():
        hits = hits.unionByName(contained_pairs(n.filter(~plain).distinct(), texts, [], "number", "t", least).select(*hits.columns))
    first = hits.groupBy("number", "tier").agg(F.min("message_no").alias("message_no"))
    return best_rows(first, "number", "tier", "message_no").select("number", "message_no", "tier")


def _words_with(n: DataFrame, told: DataFrame, least: int) -> DataFrame:
    """number, message_no, tier of the words (t) that contain a number: its first characters, HEAD at most, equal a substring
    of the word. Only substrings of lengths that such beginnings have are made."""
    a = n.withColumn("_g", F.substring("number", 1, max(least, HEAD[1])))
    sizes = a.agg(F.collect_set(F.length("_g")).alias("_sizes"))  # one row, HEAD values at most
    windows = F.flatten(F.transform(F.filter("_sizes", lambda k: k <= F.length("t")), lambda k: F.transform(F.sequence(F.lit(1), F.length("t") - k + 1), lambda i: F.substring(F.col("t"), i, k))))
    b = told.crossJoin(F.broadcast(sizes)).select("t", "tier", "message_no", F.explode(F.array_distinct(windows)).alias("_g"))
    return a.join(b, "_g").filter(F.contains("t", "number")).select("number", "message_no", "tier")


def accuracy(rows: DataFrame, group: str, outcome: Column) -> DataFrame:
    """group, n, success, missing, failed, success_pct: outcomes named so, and the share of success."""
    one = rows.select(group, outcome.alias("_o"))
    out = one.groupBy(group).agg(F.count("*").alias("n"), *[F.count_if(F.col("_o") == o).alias(o) for o in ("success", "missing", "failed")])
    return out.withColumn("success_pct", percent(F.col("success"), F.col("n")))


def totals_within(heads: DataFrame, lines: DataFrame, key: str, total: str, amount: Column, tolerance: float) -> DataFrame:
    """key, lines_total, difference_pct, within: the sum of the lines against the stated total."""
    s = lines.groupBy(key).agg(F.round(F.sum(amount), 2).alias("lines_total"))
    off = F.round(F.abs(F.col("lines_total") - F.col(total)) * 100.0 / F.greatest(F.abs(F.col(total)), F.lit(0.01)), 1)
    return heads.join(s, key).select(key, "lines_total", off.alias("difference_pct"), (off <= 100.0 * tolerance).alias("within"))
