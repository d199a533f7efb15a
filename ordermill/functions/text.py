"""Text expressions. All are columns inside code generation but the few Arrow functions at the end."""

from __future__ import annotations

import difflib
import html
import json
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

# The words that mean null, by use.
NULL_POLICIES = {
    "profile": ("", "nan", "none", "null", "n/a", "na", "-", "#n/a"),
    "result": ("", "nan", "none", "null"),
    "field": ("", "nan", "none"),
    "blank": ("",),
}


def squeezed(c: Column) -> Column:
    """Without white space at the ends, tabs and no-break blanks included (trim removes blanks only)."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def is_nullish(c: Column, policy: str = "profile") -> Column:
    return c.isNull() | F.lower(squeezed(c)).isin(*NULL_POLICIES[policy])


def null_if_word(c: Column, policy: str = "profile") -> Column:
    return F.when(~is_nullish(c, policy), squeezed(c))


def first_filled(*columns: Column) -> Column:
    """The first that is not blank."""
    return F.coalesce(*[null_if_word(c, "blank") for c in columns])


def combined(*columns: Column, separator: str = " ") -> Column:
    """Parts joined, blanks skipped, and a part that equals (in any case) one before it."""
    parts = F.filter(F.array(*[null_if_word(c, "blank") for c in columns]), lambda p: p.isNotNull())
    fresh = F.filter(parts, lambda p, i: ~F.exists(F.slice(parts, F.lit(1), i), lambda q: F.lower(q) == F.lower(p)))
    return F.array_join(fresh, separator)


def undoubled(c: Column) -> Column:
    """'ACME GMBH ACME GMBH' -> 'ACME GMBH'; text after the second time stays if it is glued to it."""
    t = F.regexp_replace(squeezed(c), r"\s+", " ")
    words = F.split(t, " ")
    half = F.floor(F.size(words) / 2).cast("int")
    same = (F.size(words) % 2 == 0) & (F.lower(F.array_join(F.slice(words, F.lit(1), half), " ")) == F.lower(F.array_join(F.slice(words, half + 1, half), " ")))
    return F.when((half > 0) & same, F.array_join(F.slice(words, F.lit(1), half), " ")).otherwise(F.regexp_replace(t, r"^(.{3,}?) \1(?=\S)", "$1 "))


def code_key(c: Column) -> Column:
    """Letters and digits of any script, in lower case."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def ascii_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def no_zeros(c: Column) -> Column:
    """Without leading zeros; a code of zeros only stays '0'."""
    return F.regexp_replace(c, r"^0+(?=.)", "")


def padded(c: Column, n: int) -> Column:
    """Zeros to n characters; longer codes stay whole."""
    return F.when(F.length(c) >= n, c).otherwise(F.lpad(c, n, "0"))


def tokens(c: Column, least: int = 1) -> Column:
    """Distinct words of letters and digits, lower case, in order."""
    return F.filter(F.array_distinct(F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " ")), lambda w: F.length(w) >= least)


def shared_tokens(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def overlap(a: Column, b: Column) -> Column:
    """Share of a's tokens in b; 0 for no tokens."""
    return F.when(F.size(a) > 0, shared_tokens(a, b) / F.size(a)).otherwise(0.0)


def short_overlap(a: Column, b: Column) -> Column:
    """Shared tokens over those of the smaller set."""
    n = F.least(F.size(a), F.size(b))
    return F.when(n > 0, shared_tokens(a, b) / n).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, shared_tokens(a, b) / n).otherwise(0.0)


def row_key(*columns: Column) -> Column:
    """md5 of the values in lower case without blanks around, NULL as empty, joined by a bar."""
    return F.md5(F.concat_ws("|", *[F.lower(squeezed(F.coalesce(c.cast("string"), F.lit("")))) for c in columns]))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def file_extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"\.([^.]+)$", 1))


# Shapes of postcodes, the most specific first (UK, Netherlands, Portugal, Poland, five digits).
POSTCODES = (r"\b([A-Z]{1,2}\d{1,2}[A-Z]? ?\d[A-Z]{2})\b", r"\b(\d{4} ?[A-Z]{2})\b", r"\b(\d{4}-\d{3})\b", r"\b(\d{2}-\d{3})\b", r"\b(\d{5})\b")


def postcode(c: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in POSTCODES])


def without_tags(c: Column) -> Column:
    """Text of markup: tags and comments removed, white space squeezed; entities stay."""
    return squeezed(F.regexp_replace(F.regexp_replace(c, r"(?s)<!--.*?-->|<[^>]*>", " "), r"\s+", " "))


# Traditional characters of company names and their simplified forms.
TRADITIONAL, SIMPLIFIED = "廠業電機東華國際貿實發銀鋼鐵鋁膠纖維長陽陰車馬門廣開關興豐龍鳳張陳劉黃", "厂业电机东华国际贸实发银钢铁铝胶纤维长阳阴车马门广开关兴丰龙凤张陈刘黄"
# Legal forms at the end of a name, and words before it.
LEGAL_FORMS = ("gmbh", "ag", "kg", "co", "ltd", "limited", "plc", "llc", "inc", "incorporated", "corp", "corporation", "pvt", "pte", "sa", "sas", "sarl", "srl", "spa", "sl", "bv", "nv", "lda", "oy", "ab", "as", "kk", "有限公司", "股份", "株式会社")
BEFORE_NAMES = ("sc", "fa", "firma", "m/s", "the", "ets", "soc")


def simplified(c: Column) -> Column:
    return F.translate(c, TRADITIONAL, SIMPLIFIED)


def event_file(c: Column) -> Column:
    """The file that an event is about: the last part of data.url, else its filename, else the text itself."""
    url = F.element_at(F.split(F.get_json_object(c, "$.data.url"), "/"), -1)
    return F.coalesce(url, F.get_json_object(c, "$.filename"), F.when(~F.trim(c).startswith("{"), F.trim(c)))


def keyword_hits(c: Column, words: list[str]) -> Column:
    """How many of the words a text contains, in any case."""
    return reduce(lambda x, y: x + y, [F.coalesce(F.lower(c).contains(w.lower()).cast("int"), F.lit(0)) for w in words])


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity by matching blocks (2 M / T). It isn't symmetric: keep the order of the arguments."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


@pandas_udf(StringType())
def accentless(c: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        return None if t is None else "".join(x for x in unicodedata.normalize("NFD", t) if not unicodedata.combining(x))

    return c.map(one)


@pandas_udf(StringType())
def plain_name(c: pd.Series) -> pd.Series:
    """A company name for comparison: accents, case, doubling, words before it and legal forms behind it removed.

    A name of legal forms only keeps the first; NULL stays NULL.
    """
    forms, before = set(LEGAL_FORMS), set(BEFORE_NAMES)

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        t = t.translate(str.maketrans(TRADITIONAL, SIMPLIFIED))
        t = "".join(x for x in unicodedata.normalize("NFD", t) if unicodedata.category(x) != "Mn").lower()
        words = [w for w in (x.strip(".,;:()") for x in re.sub(r"(?<=\b\w)\.(?=\w\b)", "", t).split()) if w]
        half = len(words) // 2
        if half and len(words) % 2 == 0 and words[:half] == words[half:]:
            words = words[:half]
        while len(words) > 1 and words[0] in before:
            words = words[1:]
        while len(words) > 1 and words[-1] in forms | {"&", "und", "and"}:
            words = words[:-1]
        last = words[-1] if words else ""
        while (ends := [f for f in forms if f > "⺀" and last.endswith(f) and len(last) > len(f)]):
            last = last[: -len(max(ends, key=len))]
        return " ".join([*words[:-1], last])

    return c.map(one)


@pandas_udf(StringType())
def unescaped(c: pd.Series) -> pd.Series:
    """Entities of markup as characters."""
    return c.map(lambda t: None if t is None else html.unescape(t))


@pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Sequence ratio of the words in alphabetical order, case aside."""
    sort = lambda t: " ".join(sorted(re.findall(r"\w+", t.lower())))
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, sort(x), sort(y)).ratio() for x, y in zip(a, b)], dtype="float64")


@pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Best sequence ratio of the shorter text and a piece of the longer one that is as long, around each matching block."""

    def one(x: str | None, y: str | None) -> float | None:
        if x is None or y is None:
            return None
        short, long_ = (x, y) if len(x) <= len(y) else (y, x)
        if not short:
            return 0.0
        starts = {max(0, b.b - b.a) for b in difflib.SequenceMatcher(None, short, long_, autojunk=False).get_matching_blocks()}
        return max(difflib.SequenceMatcher(None, short, long_[i : i + len(short)], autojunk=False).ratio() for i in starts)

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def sound_json(c: Column, unwrap: str | None = "data") -> Column:
    """A text's object as JSON: as it stands where it can be read, else mended; the object under `unwrap` if it has one."""
    good = F.try_parse_json(c)
    whole = F.when(good.isNotNull() & c.rlike(r"(?s)^\s*\{.*\}\s*$"), F.trim(c)).otherwise(mended_json(F.when(good.isNull() | ~c.rlike(r"(?s)^\s*\{.*\}\s*$"), c)))
    inner = F.get_json_object(whole, f"$.{unwrap}") if unwrap else F.lit(None)
    return F.when(inner.startswith("{"), inner).otherwise(whole)


@pandas_udf(StringType())
def mended_json(c: pd.Series) -> pd.Series:
    """The first balanced object of a text as valid JSON: fences and trailing commas removed; NULL if there is none."""

    def one(t: str | None) -> str | None:
        start = -1 if t is None else t.find("{")
        if start < 0:
            return None
        depth, inside, escaped = 0, False, False
        for i in range(start, len(t)):
            ch = t[i]
            if inside:
                escaped, inside = (ch == "\\" and not escaped), not (ch == '"' and not escaped)
            elif ch == '"':
                inside = True
            elif ch in "{}":
                depth += 1 if ch == "{" else -1
                if not depth:
                    break
        body = re.sub(r",\s*([}\]])", r"\1", t[start : i + 1])
        try:
            return json.dumps(json.loads(body), ensure_ascii=False)
        except ValueError:
            return None

    return c.map(one)
