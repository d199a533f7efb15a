"""Variant spellings of names typed by people, linked to the organisations of the customer master.

A set-similarity join on the q-grams of a name's tokens finds candidates: grams are ordered by how many master names
hold them, and only the rare prefix that any partner with enough overlap must share is looked up (prefix filter).
Candidates are verified by a soft weighted token similarity: tokens match by edit distance, abbreviation, initial or
nickname, and count the more the fewer customers they occur with; words that contradict each other reject.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.session import cut

Q = 3
#: Share of a name's grams that a partner must hold; it fixes the length of the looked-up prefix.
OVERLAP = 0.4
#: Names of more grams than this are looked up by single grams, the others by pairs of grams, whose number grows with
#: the square of the name's grams.
MANY = 96
#: Least similarity of two tokens, and of a linked pair of names.
TOKEN, NAME = 0.74, 0.72
#: Names this close to the best one may be the same organisation under another number.
MARGIN = 0.15

# Spellings of legal forms, by form.
_LEGAL = {
    "gmbh": ("gmbh", "g m b h", "gesellschaft mbh", "gesellschaft m b h", "ges m b h", "gesmbh", "gmbh co kg"),
    "ag": ("ag", "a g", "aktiengesellschaft"),
    "kg": ("kg", "k g", "kommanditges", "kommanditgesellschaft"),
    "ltd": ("ltd", "limited", "l t d"),
    "plc": ("plc", "p l c", "public limited company"),
    "coltd": ("co ltd", "company limited", "co limited", "company ltd"),
    "pvtltd": ("pvt ltd", "private limited", "p ltd", "pvt limited", "private ltd"),
    "inc": ("inc", "incorporated", "i n c"),
    "corp": ("corp", "corporation"),
    "llc": ("llc", "l l c"),
    "sa": ("sa", "s a", "societe anonyme", "sociedad anonima"),
    "sas": ("sas", "s a s"),
    "sarl": ("sarl", "s a r l"),
    "srl": ("srl", "s r l"),
    "spa": ("spa", "s p a"),
    "sl": ("sl", "s l", "sociedad limitada"),
    "bv": ("bv", "b v", "besloten vennootschap"),
    "nv": ("nv", "n v"),
    "spzoo": ("sp z o o", "spolka z o o", "sp zoo"),
    "lda": ("lda", "limitada", "l d a"),
    "kk": ("kk", "k k", "kabushiki kaisha"),
}
_LEGAL_WIDE = re.compile(r"[(（]集[团團][)）]|集[团團](?=有限|股份|公司)|股份有限公司|有限责任公司|有限公司|公司$|株式会社|有限会社|주식회사|\(주\)|㈜|（주）|（株）|\(株\)")
# Traditional characters of company names and their simplified forms.
_SIMPLE = str.maketrans("錦遠裝莊製業電機東華廠國際貿實發銀鋼鐵鋁塑膠纖維張陳劉黃孫楊趙吳鄭馮蔣龍鳳豐興榮達運輸車馬橋連環藝術應線纜組織紡絲綢為聯萬億廣門闊廈濱灣島嶺維嵐澤磐盤創匯產師資優質選極階層級類號學會團集辦處務財報價額銷營維瀾瑩晟陽陰", "锦远装庄制业电机东华厂国际贸实发银钢铁铝塑胶纤维张陈刘黄孙杨赵吴郑冯蒋龙凤丰兴荣达运输车马桥连环艺术应线缆组织纺丝绸为联万亿广门阔厦滨湾岛岭维岚泽磐盘创汇产师资优质选极阶层级类号学会团集办处务财报价额销营维澜莹晟阳阴")
# Words around a name that are no part of it.
_BESIDE = re.compile(r"\[[^\[\]]*\]|\((?!주|株)[^()]*\)|\bc/o\b.*$|\battn\b.*$|\bz\.? ?hd\.?\b.*$|/ ?\d{3,}\s*$|,? ?\bdept\.? ?\d*|gate ?\d+\s*$|\b(?:ap dept|head office|purchasing|einkauf|goods in|accounts payable|compras|achats|acquisti)\b|^\s*(?:the|m/s\.?|messrs\.?|fa\.?|firma|kd\.?|kunde|société|ste\.?|sté\.?|soc\.?|ets\.?|company)\s+", re.I)
# Short forms of first names.
_NICKS = {
    "mike": "michael",
    "rob": "robert",
    "bob": "robert",
    "bill": "william",
    "will": "william",
    "beppe": "giuseppe",
    "pino": "giuseppe",
    "peppe": "giuseppe",
    "fco": "francisco",
    "paco": "francisco",
    "pancho": "francisco",
    "chris": "christopher",
    "kathy": "katharina",
    "kathi": "katharina",
    "kate": "katharina",
    "kath": "katharina",
    "alex": "alexander",
    "tom": "thomas",
    "dick": "richard",
    "rick": "richard",
    "rich": "richard",
    "liz": "elizabeth",
    "beth": "elizabeth",
    "betty": "elizabeth",
    "joe": "joseph",
    "toni": "antonio",
    "tony": "antonio",
    "maggie": "margaret",
    "meg": "margaret",
    "peggy": "margaret",
    "charlie": "charles",
    "chuck": "charles",
    "fritz": "friedrich",
    "fred": "friedrich",
    "heinz": "heinrich",
    "heiner": "heinrich",
    "willi": "wilhelm",
    "hans": "johannes",
    "jo": "johannes",
    "hannes": "johannes",
    "jim": "james",
    "dave": "david",
    "steve": "stephen",
    "andy": "andreas",
}
_FORMS = sorted(((w, k) for k, ws in _LEGAL.items() for w in ws), key=lambda x: -len(x[0]))
_FORM_RE = re.compile(r"(?<![a-z0-9])(%s)(?![a-z0-9])" % "|".join(re.escape(w) for w, _ in _FORMS))
_FORM_OF = dict(_FORMS)
# quantifiers that give nothing back, so that very long texts take linear time
_CODE = re.compile(r"^(?=\D*+\d)[\W\d_]*+(?:[a-z]{1,2}[- ]?\d[\d\W]*+)?$", re.I)
_REMARK = re.compile(r"^(see letterhead|see .*|siehe .*|as above|same|n/?a|none|null|nan|tbd|unknown|various|diverse|-+|\?+)?$", re.I)


def folded(text: str) -> str:
    t = unicodedata.normalize("NFKC", text).lower().replace("ß", "ss").replace("ł", "l").replace("ø", "o").replace("æ", "ae")
    t = unicodedata.normalize("NFKD", t)
    t = unicodedata.normalize("NFC", "".join(c for c in t if not "̀" <= c <= "ͯ"))
    return re.sub(r"([aou])e(?=[^aeiou\s]|$)", r"\1", t)


def _digits(m: re.Match) -> str:
    w = m.group()
    return w.translate(str.maketrans("0159", "olsg")) if re.search(r"[a-z]", w) and len(re.sub(r"\d", "", w)) >= 3 else w


@lru_cache(120_000)
def parse_name(name: str | None) -> tuple[tuple[str, ...], str]:
    """(tokens, legal form) of a name; no tokens for blanks, remarks and bare numbers."""
    if not name or _REMARK.match(name.strip()) or _CODE.match(name.strip()):
        return (), ""
    t = _BESIDE.sub(" ", name.replace("_", " "))
    t = _BESIDE.sub(" ", t)
    wide = "".join(re.findall(r"[぀-鿿가-힣]+", _LEGAL_WIDE.sub("", unicodedata.normalize("NFKC", t).translate(_SIMPLE))))
    if len(wide) >= 2:
        return (wide,), ""
    # the land behind a doubled name
    t = re.sub(r"\b(?:DE|AT|FR|IT|ES|PT|NL|BE|PL|GB|UK|US|USA|CA|CN|JP|KR|IN)\s*$", " ", t)
    t = re.sub(r"\w+", _digits, folded(re.sub(r"(?<=[A-Za-z]{3})\.(?=[a-z]{3})|(?<=[A-Za-z])['’](?=[a-z])", "", t)))
    t = re.sub(r"[^a-z0-9]+", " ", t).strip()
    legal = ""
    for m in _FORM_RE.finditer(t):
        legal = _FORM_OF[m.group(1)]
    t = _FORM_RE.sub(" ", t)
    words = [w for w in t.split() if not w.isdigit() and w not in ("co", "und", "and", "o", "of", "de", "et")]
    half = len(words) // 2
    if half and len(words) % 2 == 0 and words[:half] == words[half:]:
        words = words[:half]
    # 'ACME GMBHGate', doubled with something glued to the end
    seen: dict[str, None] = {}
    times = Counter(words)
    first: dict[str, int] = {}
    for i, w in enumerate(words):
        first.setdefault(w, i)
    for w in words:
        heads = (w[:n] for n in range(max(4, len(w) - 4), len(w)))
        if w not in seen and not any(x in seen and times[x] == 1 and first[x] < first[w] - 1 for x in heads):
            seen[w] = None
    # scanning takes 'rn' for 'm'
    return tuple(dict.fromkeys(w.replace("rn", "m") for w in seen)), legal


def grams(tokens: tuple[str, ...]) -> list[str]:
    """q-grams of the tokens; of East Asian ones bigrams."""
    found: dict[str, None] = {}
    for t in tokens:
        q = 2 if t[0] > "⺀" else Q
        for i in range(max(1, len(t) - q + 1)):
            if len(t) >= q:
                found[t[i : i + q]] = None
    return list(found)


def _edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps, or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


@lru_cache(40_000)
def _bigrams(t: str) -> frozenset[str]:
    return frozenset(t[i : i + 2] for i in range(len(t) - 1))


def _missing(a: str, b: str) -> int:
    """How many letters of a, each as often as it occurs, b lacks."""
    for c in b:
        a = a.replace(c, "", 1)
    return len(a)


def token_similarity(a: str, b: str) -> float:
    """1 for equal; less for typing errors, abbreviations, initials and nicknames; else 0."""
    if a == b:
        return 1.0
    # with another first letter only edits and nicknames make them alike, and edits so few leave a bigram
    if a[0] != b[0] and (abs(len(a) - len(b)) > 3 or _bigrams(a).isdisjoint(_bigrams(b))) and _NICKS.get(a) != b and _NICKS.get(b) != a:
        return 0.0
    return _unlike(a, b)


@lru_cache(150_000)
def _unlike(a: str, b: str) -> float:
    if _NICKS.get(a) == b or _NICKS.get(b) == a:
        return 0.97
    short, long_ = (a, b) if len(a) < len(b) else (b, a)
    if len(short) == 1:
        return 0.8 if long_[0] == short else 0.0
    if len(short) >= 3 and long_.startswith(short):
        return 0.9
    n = len(long_)
    if n >= 4 and n - len(short) <= 3:
        # more edits would leave less than TOKEN
        most = min(1 if n < 6 else 2 if n < 12 else 3, int((1 - TOKEN) * n + 1e-9))
        # an edit or swap spoils three bigrams at most, and one letter on each side
        enough = len(_bigrams(a) & _bigrams(b)) >= min(len(_bigrams(a)), len(_bigrams(b))) - 3 * most and _missing(long_, short) <= most
        d = _edits(a, b, most) if enough else most + 1
        if d <= most and 1 - d / n >= TOKEN:
            return 1 - d / n
    if len(short) >= 6 and any(long_.startswith(short[:k]) and long_.endswith(short[k:]) for k in range(3, len(short) - 2)):
        return 0.85  # 'maschbau'
    if 4 <= len(short) <= n - 2 and short[0] == long_[0] and min(_edits(short, long_[: len(short) + k], 1) for k in (-1, 0)) <= 1:
        return 0.78
    if 2 <= len(short) <= 7 and n >= len(short) + 2 and short[0] == long_[0]:
        # letters left out: 'cbls' for 'cables'
        it = iter(long_)
        if all(c in it for c in short) and len(re.sub("[aeiou]", "", short)) >= len(short) - 1 and len(short) >= 3:
            return 0.85
    return 0.0


def _matched(t: str, others: tuple[str, ...], joined: str) -> float:
    best = max((token_similarity(t, o) for o in others), default=0.0)
    if best < 0.95 and len(t) >= 5:
        if t in joined:
            return max(best, 0.95)
        if len(t) >= 6:
            g = [t[i : i + 3] for i in range(len(t) - 2)]
            share = sum(x in joined for x in g) / len(g)
            if share >= 0.55 and len(joined) >= len(t) - 1:
                # the same length of text around the shared grams
                at = min((joined.find(x) - i for i, x in enumerate(g) if x in joined), default=0)
                piece = joined[max(0, at) : max(0, at) + len(t) + 1]
                d = min(_edits(t, piece[: len(t) + k], 2) for k in (-1, 0, 1))
                if d <= 2:
                    return max(best, 1 - d / len(t) - 0.02)
    return best


class Weights(dict):
    """Weight by token of the common words of one run; run tells the answers that a worker keeps from those of other runs."""

    def __init__(self, *args) -> None:
        super().__init__(*args)
        self.run = uuid.uuid4().hex


_LIKE: dict[str, dict[str, bool]] = {}


def _like_common(t: str, weight: Weights) -> bool:
    """Whether a token is a short form or a misspelling of a common word."""
    known = _LIKE.get(weight.run)
    if known is None or len(known) > 50_000:
        _LIKE.clear()
        known = _LIKE[weight.run] = {}
    if t not in known:
        known[t] = any(token_similarity(t, c) >= TOKEN for c in weight if c[0] == t[0] and len(c) >= 4)
    return known[t]


def agree(q: tuple[str, ...], m: tuple[str, ...], weight: Weights, rare: float) -> float:
    """Soft weighted similarity of two names; 0 if rare tokens have no partner or common ones contradict."""
    qj, mj = "".join(q), "".join(m)
    total = got = 0.0
    open_m = open_q = False
    for t in m:
        w = weight.get(t, rare)
        s = _matched(t, q, qj)
        if s < TOKEN:
            if w >= rare * 0.6 and len(t) > 2:
                if t == m[0] and len(m) > 1 or not _like_common(t, weight):
                    return 0.0
                w = rare * 0.3
            open_m = True
            s = 0.0
        # a missing common word costs little, a contradicting one everything
        total += w if s else 0.5 * w
        got += w * s
    for t in q:
        w = weight.get(t, rare)
        if len(t) > 1 and _matched(t, m, mj) < TOKEN and not any(len(x) >= 5 and x in t for x in m):
            near = max((token_similarity(t, c) for c in m), default=0)
            if near < TOKEN:
                known = w < rare * 0.6
                glued = len(t) >= 9 and any(len(x) >= 6 and _matched(x, (t,), t) >= TOKEN for x in m)
                if not known and not glued and len(t) >= 4:
                    return 0.0
                open_q = open_q or known
        elif len(t) == 1 and not any(x[0] == t for x in m):
            open_q = True
    if open_m and open_q:
        return 0.0
    return got / total if total else 0.0


def _contradict(a: tuple[str, ...], b: tuple[str, ...], form_a: str, form_b: str, weight: Weights, rare: float) -> bool:
    return (agree(a, b, weight, rare) < NAME and agree(b, a, weight, rare) < NAME) or (bool(form_a) and bool(form_b) and form_a != form_b and {form_a, form_b} not in ({"ltd", "coltd"}, {"ltd", "pvtltd"}, {"coltd", "pvtltd"}))


def parsed_names(names: DataFrame) -> DataFrame:
    """name -> name, tokens, form, for distinct names that have tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = [parse_name(n) for n in pdf["name"]]
            out = pd.DataFrame({"name": pdf["name"], "tokens": [list(t) for t, _ in p], "form": [f for _, f in p]})
            yield out[[bool(t) for t, _ in p]]

    return names.select("name").filter("name is not null").distinct().mapInPandas(run, "name string, tokens array<string>, form string")


def with_grams(parsed: DataFrame, common: DataFrame) -> DataFrame:
    """Adds grams: those of the tokens that few customers share; of all tokens where there are no others. Tokens of two
    letters count whole, single letters where a name has nothing else."""
    single = parsed.select("name", F.explode("tokens").alias("token"))
    kept = single.join(common, "token", "left_anti").groupBy("name").agg(F.collect_set("token").alias("rare"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            told = [tuple(r) if r is not None and len(r) else tuple(t) for r, t in zip(pdf["rare"], pdf["tokens"])]
            short = [[f"={w}" for w in t if len(w) == 2 and w < "⺀"] for t in told]
            yield pdf.assign(grams=[grams(t) + s or [f"={w}" for w in t] for t, s in zip(told, short)])[["name", "tokens", "form", "grams"]]

    return parsed.join(kept, "name", "left").mapInPandas(run, "name string, tokens array<string>, form string, grams array<string>")


def _gram_pairs(grams):
    """All pairs of an array's texts, each in one order."""
    g = F.array_sort(grams)
    return F.flatten(F.transform(g, lambda x, i: F.transform(F.slice(g, i + 2, F.size(g)), lambda y: F.concat(x, F.lit("|"), y))))


def gram_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """name, m: names of left and of right (name, grams) of which the second holds OVERLAP of the first one's grams."""
    index = right.select(F.col("name").alias("m"), F.explode("grams").alias("g"))
    df = index.groupBy("g").agg(F.count("*").alias("n"))
    # rarest grams first; a gram that no master name holds is free
    ordered = left.select("name", F.size("grams").alias("k"), F.explode("grams").alias("g")).join(df, "g", "left").groupBy("name", "k").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g"))).alias("gs"))
    # with the prefix longer by one gram a partner of enough overlap shares two of it, so pairs of grams are looked up:
    # few names hold both, and lists stay short however many names there are
    share = F.ceil(F.col("k") * OVERLAP).cast("int")
    least = F.least(share, F.lit(2))
    rarest = lambda n: F.transform(F.slice("gs", F.lit(1), F.col("k") - share + n), lambda x: x["g"])
    # names of very many grams on either side are looked up by the single grams of the prefix
    single = F.transform(rarest(F.lit(1)), lambda g: F.concat(F.lit("="), g))
    asked = F.when(F.col("k") > MANY, F.concat(rarest(F.lit(1)), single)).otherwise(F.concat(F.when(least == 1, rarest(least)).otherwise(_gram_pairs(rarest(least))), single))
    lookup = ordered.select(F.xxhash64("name").alias("i"), F.explode(asked).alias("g")).select("i", F.xxhash64("g").alias("g"))
    many = F.size("grams") > MANY
    held = F.when(many, F.concat("grams", F.transform("grams", lambda g: F.concat(F.lit("="), g)))).otherwise(F.concat("grams", _gram_pairs(F.when(many, F.slice("grams", 1, 0)).otherwise(F.col("grams")))))
    coded = right.select(F.xxhash64("name").alias("j"), F.explode(held).alias("g")).select("j", F.xxhash64("g").alias("g"))
    # the planner's estimates don't count what explode adds, so it would broadcast these lists through the driver
    pairs = lookup.join(coded.hint("merge"), "g").select("i", "j").distinct()
    return pairs.join(left.select("name", F.xxhash64("name").alias("i")), "i").join(right.select(F.col("name").alias("m"), F.xxhash64("name").alias("j")), "j").select("name", "m")


def link_names(names: DataFrame, master: DataFrame) -> DataFrame:
    """name, customer_number, confidence for the names (column name) that are spellings of master's organisations.

    master has customer_number and name. An organisation under two numbers gives two rows. Names that fit several
    organisations alike, blanks, remarks and bare numbers give none. Distinct spellings are compared once.
    """
    spark = names.sparkSession
    owners = master.filter("name is not null").select("customer_number", "name").distinct()
    known = cut(parsed_names(owners))
    counts = owners.join(known, "name").select("customer_number", F.explode("tokens").alias("token")).groupBy("token").agg(F.count_distinct("customer_number").alias("n"))
    customers = owners.select("customer_number").distinct().count()
    # tokens that more customers share are words of trade and first names: a short list, however large the master is
    bound = 5 + 0.0005 * customers
    common = cut(counts.filter(F.col("n") > bound))
    few = {r["token"]: r["n"] for r in common.toLocalIterator()}
    rare = math.log(1 + customers / 2)
    weight = Weights({t: max(0.3, math.log(1 + customers / n) * 0.45) for t, n in few.items()})
    # common words in the short forms of which people write them must not pass as rare
    shared = spark.sparkContext.broadcast((weight, rare))

    left = cut(with_grams(parsed_names(names), common.select("token")))
    right = cut(with_grams(known, common.select("token")))
    pairs = gram_candidates(left, right)
    both = pairs.join(left.select("name", F.col("tokens").alias("a"), F.col("form").alias("fa")), "name").join(right.select(F.col("name").alias("m"), F.col("tokens").alias("b"), F.col("form").alias("fb")), "m")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, rare = shared.value
        for pdf in batches:
            s = []
            for a, b, fa, fb in zip(pdf["a"], pdf["b"], pdf["fa"], pdf["fb"]):
                v = agree(tuple(a), tuple(b), weight, rare)
                if v and fa and fb:
                    v += 0.04 if fa == fb else -0.06
                s.append(v)
            out = pdf.assign(score=s)
            yield out[out["score"] >= NAME][["name", "m", "b", "fb", "score"]]

    scored = both.mapInPandas(verify, "name string, m string, b array<string>, fb string, score double")
    lists = scored.groupBy("name").agg(F.collect_list(F.struct("score", "m", "b", "fb")).alias("c"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, rare = shared.value
        for pdf in batches:
            rows = []
            for name, c in zip(pdf["name"], pdf["c"]):
                c = sorted(((x["score"], x["m"], tuple(x["b"]), x["fb"]) for x in c), key=lambda x: (-x[0], -len(x[2]), x[1]))
                best = c[0]
                near = [x for x in c if x[0] >= best[0] - MARGIN]
                # the fullest of the best names speaks for the organisation
                head = max((x for x in near if x[0] >= best[0] - 0.03), key=lambda x: (len(x[2]), x[0], x[1]))
                same = [x for x in near if not _contradict(head[2], x[2], head[3], x[3], weight, rare)]
                other = [x for x in near if x not in same and x[0] >= best[0] - 0.03]
                if not other:
                    rows += [(name, x[1], min(1.0, x[0])) for x in same]
            yield pd.DataFrame(rows, columns=["name", "m", "confidence"])

    decided = lists.mapInPandas(decide, "name string, m string, confidence double")
    return decided.join(owners.select(F.col("name").alias("m"), "customer_number"), "m").groupBy("name", "customer_number").agg(F.max("confidence").alias("confidence"))


def link_customers(headers: DataFrame, vendors: DataFrame, alias: DataFrame) -> DataFrame:
    """record_id, customer_number, confidence: customer_id_or_name of each record, known short names included.

    Records with NULL, blank, remark or bare number give no row; duplicates of a record are linked one by one.
    """
    typed = headers.select("record_id", F.trim("customer_id_or_name").alias("name")).filter("name is not null and name != ''")
    short = alias.filter("alias is not null and canonical is not null").select(F.lower(F.trim("alias")).alias("alias"), "canonical", "kind").distinct()
    distinct = typed.select("name").distinct()
    # a number or a land may follow the short name
    bare = F.regexp_replace(F.regexp_replace(F.lower("name"), r" / \d+$", ""), r" [a-z]{2}$", "")
    known = distinct.withColumn("alias", F.explode(F.array_distinct(F.array(F.lower("name"), F.regexp_replace(F.lower("name"), r" / \d+$", ""), bare)))).join(short, "alias")
    # a number stands for the names listed under it, so the organisation's other numbers are found too
    listed = known.filter("kind = 'id'").select("name", F.col("canonical").alias("customer_number")).join(vendors.select("customer_number", F.trim("name").alias("c")).filter("c is not null").distinct(), "customer_number").select("name", "c")
    asked = distinct.unionByName(known.filter("kind = 'name'").select(F.col("canonical").alias("name"))).unionByName(listed.select(F.col("c").alias("name"))).distinct()
    found = cut(link_names(asked, vendors))
    by_name = known.filter("kind = 'name'").select("name", F.col("canonical").alias("c")).unionByName(listed).join(found.withColumnRenamed("name", "c"), "c").select("name", "customer_number", "confidence")
    by_id = known.filter("kind = 'id'").select("name", F.col("canonical").alias("customer_number"), F.lit(1.0).alias("confidence"))
    names = found.unionByName(by_name).unionByName(by_id).groupBy("name", "customer_number").agg(F.max("confidence").alias("confidence"))
    return typed.join(names, "name").select("record_id", "customer_number", "confidence")
