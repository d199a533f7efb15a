"""Addresses of one place that are written differently.

Each address is expanded into its plausible normalised forms: every reading of street, house number, postcode and
town, streets with their type in one spelling and, for typing errors, with each single letter left out. Combinations
of components (street and number with postcode, with town, or alone) are hashed and exploded; addresses that share a
hash are compared, conflicting numbers, postcodes or towns reject them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.session import cut

# Street types by class. A type stands behind the name, before it, or is the end of its word.
_BEHIND = {
    "str": ("strasse", "str", "street"),
    "platz": ("platz", "pl", "place", "plein"),
    "allee": ("allee", "all"),
    "weg": ("weg", "wg"),
    "road": ("road", "rd"),
    "st": ("street", "st"),
    "av": ("avenue", "ave", "av", "aven"),
    "blvd": ("boulevard", "blvd", "bvd"),
    "lane": ("lane", "ln"),
    "drive": ("drive", "dr"),
    "way": ("way",),
    "ind": ("industrial park", "industrial pk", "ind park", "ind pk", "industriepark", "industrial estate", "ind est"),
    "straat": ("straat",),
    "laan": ("laan", "ln"),
    "gasse": ("gasse", "g"),
    "ring": ("ring",),
    "kade": ("kade",),
    "marg": ("marg",),
}
_BEFORE = {
    "rue": ("rue", "r"),
    "av": ("avenue", "avenida", "ave", "av", "avda", "avd"),
    "blvd": ("boulevard", "blvd", "bvd", "bd", "bld"),
    "allee": ("allee", "all"),
    "platz": ("place", "plaza", "praca", "piazza", "plac", "pl"),
    "chemin": ("chemin", "ch"),
    "route": ("route", "rte"),
    "via": ("via", "v"),
    "viale": ("viale", "v le", "vle"),
    "corso": ("corso", "c so", "cso"),
    "calle": ("calle", "c", "cl"),
    "polind": ("poligono industrial", "pol ind", "pol industrial", "poligono ind", "p i"),
    "paseo": ("paseo", "p o"),
    "rua": ("rua", "r"),
    "ul": ("ulica", "ul"),
    "al": ("aleja", "al", "aleje"),
    "largo": ("largo",),
    "zi": ("zona industrial", "zone industrielle", "zona ind", "z i", "zi"),
}
_SUFFIX = (("strasse", ("str",)), ("str", ("str", "straat")), ("weg", ("weg",)), ("wg", ("weg",)), ("gasse", ("gasse",)), ("straat", ("straat",)), ("laan", ("laan",)), ("ln", ("laan",)), ("kade", ("kade",)), ("plein", ("plein",)), ("platz", ("platz",)), ("allee", ("allee",)))
_ENDS = tuple(e for e, _ in _SUFFIX)
_COUNTRIES = {
    "DE": ("de", "deu", "d", "germany", "deutschland", "allemagne"),
    "AT": ("at", "aut", "a", "austria", "osterreich"),
    "CH": ("ch", "che", "switzerland", "schweiz"),
    "FR": ("fr", "fra", "f", "france", "frankreich"),
    "IT": ("it", "ita", "i", "italy", "italia", "italien"),
    "ES": ("es", "esp", "e", "spain", "espana", "spanien"),
    "PT": ("pt", "prt", "portugal"),
    "NL": ("nl", "nld", "netherlands", "nederland", "niederlande", "the netherlands", "holland"),
    "BE": ("be", "bel", "belgium", "belgique"),
    "PL": ("pl", "pol", "poland", "polska", "polen"),
    "GB": ("gb", "gbr", "uk", "england", "united kingdom", "great britain", "u k", "scotland", "wales"),
    "US": ("us", "usa", "u s a", "u s", "united states", "united states of america"),
    "CA": ("ca", "can", "canada", "kanada"),
    "CN": ("cn", "chn", "prc", "china", "p r china", "p r c"),
    "JP": ("jp", "jpn", "japan", "nippon"),
    "KR": ("kr", "kor", "korea", "south korea", "republic of korea", "rep of korea"),
    "IN": ("in", "ind", "india", "bharat"),
}
_NOISE = re.compile(
    r"\b(?:dock|gate|tor|rampe|ramp|halle|hall|hal|hala|building|bldg|bld|gebaude|batiment|bat|edificio|edif|unit|suite|door|porte|quai|muelle|nave|puerta|cancello|porta|brama|bloc|block|lager|level|stock|gebouw|gbd)\s*(?:no|nr|n)?\s*(?:[a-z]?\d{1,3}[a-z]?|[a-z])\b"
    r"|\b\d{1,2}\s*(?:st|nd|rd|th|er|eme|e|o|a)?\s*(?:floor|fl|etage|og|stock|piso|planta|piano|pietro|obergeschoss|andar|verdieping)\b|\b(?:floor|fl|etage|piso|planta|piano)\s*\d{1,2}\b|\b(?:attn|att|zhd|z hd|c o|fao)\s*:?\s*[a-z]+\b|\bp ?o ?box\s*\d+\b|\bpostfach\s*\d+\b"
)
# a remark that refers to another field
_REMARK = re.compile(r"^(s ?o|s ?u|same( as)?.*|as above.*|see .*|siehe .*|wie .*|dito|ditto|idem.*|id|ibid.*|voir .*|igual (que|a) .*|gleiche? (wie|adresse|lieferadresse|lieferanschrift).*|unchanged|n a|none|null|nan|tbd|-)?$")
_POSTCODES = tuple(re.compile(p) for p in (
    r"\b[a-z]{1,2}\d{1,2}[a-z]? ?\d[a-z]{2}\b", r"\b[a-z]\d[a-z] ?\d[a-z]\d\b", r"\b\d{4} ?[a-z]{2}\b(?= |$)", r"\b\d{2}-\d{3}\b", r"\b\d{3}-\d{4}\b", r"\b\d{4}-\d{3}\b", r"\b\d{5,7}\b", r"\b\d{4}\b(?!-)",
))
_SAINTS = {"st": "saint", "ste": "saint", "sankt": "saint", "ft": "fort", "mt": "mount", "sta": "santa", "sto": "santo", "pt": "port", "pto": "puerto", "nw": "new"}


_UMLAUT = re.compile(r"([aou])e(?=[^aeiou]|$)")


def _umlauts(t: str) -> str:
    return _UMLAUT.sub(r"\1", t)


_TYPE_BEHIND = [(_umlauts(w), k) for k, words in _BEHIND.items() for w in words]
_TYPE_BEFORE = [(_umlauts(w), k) for k, words in _BEFORE.items() for w in words]
_COUNTRY_OF = {_umlauts(w): k for k, words in _COUNTRIES.items() for w in words}
_BEHIND_RE = re.compile(r"(?=\b([a-z]{3,}(?: ?- ?[a-z]{3,})?) (%s)\b)" % "|".join(sorted({w for w, _ in _TYPE_BEHIND}, key=len, reverse=True)))
_BEFORE_RE = re.compile(r"(?=\b(%s) (?:(?:de la|de|du|des|del|della|da|do|dos) )?([a-z]{4,})\b)" % "|".join(sorted({w for w, _ in _TYPE_BEFORE}, key=len, reverse=True)))
_NO_LETTERS = re.compile(r"[^a-z ]+")
_BEHIND_OF: dict[str, set[str]] = {}
for _w, _k in _TYPE_BEHIND:
    _BEHIND_OF.setdefault(_w, set()).add(_k)
_BEFORE_OF: dict[str, set[str]] = {}
for _w, _k in _TYPE_BEFORE:
    _BEFORE_OF.setdefault(_w, set()).add(_k)
_NUMBER = r"(?:no|nr|num|n|numero|haus)? ?#? ?(\d{1,6}) ?([a-z])?\b(?!-?\d)"
_NUMBER_AFTER, _NUMBER_NEXT, _NUMBER_BEFORE = (re.compile(p) for p in (r"^ ?(,)? ?" + _NUMBER, r"^ ?,? ?" + _NUMBER, r"(?:^|[ ,])" + _NUMBER + r" ?,? ?$"))
_BLANKS, _NO_SIGN, _WORD, _LETTERS, _BETWEEN = (re.compile(p) for p in (r"\s+", r"[^a-z0-9# -]+", r"\w+", r"[a-z]+", r"[,0-9#]+"))
_NAME, _TWO_NUMBERS = re.compile(r"[a-z]+(?: ?- ?[a-z]+)?"), re.compile(r"\b(\d{1,4}) (\d{1,4})\b")
#: Digits of a house number that is told from a postcode by nothing else.
SHORT = 3


@lru_cache(50_000)
def folded(text: str) -> str:
    """Lower case without accents; ae, oe, ue as a, o, u, so that both ways to write an umlaut agree."""
    t = text.lower().replace("ß", "ss").replace("ł", "l").replace("ø", "o").replace("æ", "ae").replace("đ", "d")
    if not t.isascii():
        t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return _umlauts(t)


def _letters(m: re.Match) -> str:
    w = m.group()
    if w.isalpha() or w.isdigit():
        return w
    return w.replace("0", "o").replace("1", "l").replace("5", "s") if len(re.sub(r"\d", "", w)) >= 4 and re.search(r"[a-z]\d[a-z]|^\d[a-z]{4}|[a-z]{4}\d$", w) else w


def _strokes(word: str) -> str:
    """Letters that scanning takes for each other as one: towns, compared by edits as their length allows."""
    return word.replace("m", "rn").replace("w", "vv")


def _letter(word: str) -> str:
    """The same for streets, of which every letter is left out once: one letter each."""
    return word.replace("rn", "m").replace("vv", "w")


def town_form(town: str) -> str:
    """One form for a town's spellings: abbreviations written out, blanks, marks and additions dropped."""
    t = re.sub(r"\(.*?\)|/.*$| a d .*$| am .*$| an der .*$", "", folded(town))
    words = [_SAINTS.get(w, w) for w in re.findall(r"[a-z]+", re.sub(r"\w+", _letters, re.sub(r"^\W*(?:'s|den|het)\b", "", t)))]
    return _strokes("".join(words))


def postcode_form(code: str) -> str:
    t = re.sub(r"^(d|de|a|at|f|fr|nl|ca|gb|pl|pt|us|i|it|e|es|ch|b|be|jp|cn|in|kr)[- ](?=[a-z\d]{3})", "", folded(code).strip())
    return re.sub(r"[^a-z0-9]", "", t)


class Parsed:
    __slots__ = ("streets", "postcodes", "towns", "country", "short")

    def __init__(self, streets: list[tuple[str, str, str]], postcodes: list[str], towns: list[str], country: str, short: list[str]) -> None:
        self.streets, self.postcodes, self.towns, self.country, self.short = streets, postcodes, towns, country, short


def parse_address(text: str | None, postcode: str | None = None, city: str | None = None, country: str | None = None) -> Parsed | None:
    """Readings of an address: (name, type, number) of each possible street, postcodes, town forms, country.

    A number of more than SHORT digits is read as the house number only if the street has no shorter one and no mark
    parts them; it is read as a postcode besides. Words of two or three letters are kept apart (short): they are a town
    only where the other address names it in its own field.
    """
    if not text:
        return None
    t = folded(text)
    parts = re.split(r"[,;/|\n\r]+", re.sub(r"\bc/o\b", "c o", re.sub(r"\bc/ ?", "calle ", t)))
    parts = [_BLANKS.sub(" ", _NO_SIGN.sub(" ", p)).strip() for p in parts]
    flat = " , ".join(p for p in parts if p)
    if _REMARK.match(flat.strip(" -#")):
        return None
    flat = _WORD.sub(_letters, flat)
    flat = re.sub(r"(?<=\d) ?- (?=\d)|(?<=\d) -(?=\d)", "-", flat)
    flat = _NOISE.sub(" , ", re.sub(r"\b([a-z])-(?=\d)", r"\1-", flat))
    flat = _BLANKS.sub(" ", flat).strip()
    found_country = ""
    # the parts of the text are folded already
    for p in [folded(country or ""), *reversed(flat.split(" , "))]:
        k = _COUNTRY_OF.get(_NO_LETTERS.sub(" ", p).strip())
        if k:
            found_country = k
            break
    if not found_country:
        last = re.search(r"\b(?:([a-z]{2,}) )?([a-z]{2,})$", flat)
        if last:
            found_country = _COUNTRY_OF.get(f"{last.group(1)} {last.group(2)}", "") or (_COUNTRY_OF.get(last.group(2), "") if len(last.group(2)) > 2 else "")
    streets: dict[tuple[str, str, str], None] = {}
    used: list[tuple[int, int]] = []

    def numbered(a: int, b: int, name: str, kinds: set[str]) -> None:
        before, after = flat[:a], flat[b:]
        m = _NUMBER_AFTER.match(after)
        hits = []
        if m and not (m.group(1) and len(m.group(2)) > SHORT) and postcode_form(postcode or "") != m.group(2):
            hits.append((_NUMBER_NEXT.match(after), b, b + m.end()))
        m2 = _NUMBER_BEFORE.search(before)
        if m2:
            hits.append((m2, m2.start(), a))
        few = [h for h in hits if len(h[0].group(1)) <= SHORT]
        for m, x, y in few or hits:
            if int(m.group(1)):
                for k in sorted(kinds):
                    streets.setdefault((_letter(name), k, str(int(m.group(1))) + (m.group(2) or "")))
                used.append((min(a, x), max(b, y)) if few or len(m.group(1)) == 4 and x < a else (a, b))

    for m in _NAME.finditer(flat):
        w = m.group().replace(" ", "").replace("-", "")
        for end, k in _SUFFIX if w.endswith(_ENDS) else ():
            if w.endswith(end) and len(w) - len(end) >= 3 and w not in _BEHIND_OF:
                numbered(m.start(), m.end(), w[: -len(end)], set(k))
                break
    for m in _BEHIND_RE.finditer(flat):
        if m.group(1) not in _BEFORE_OF and m.group(1) not in _BEHIND_OF:
            numbered(m.start(1), m.end(2), re.sub(r"[ -]", "", m.group(1)), _BEHIND_OF[m.group(2)])
    for m in _BEFORE_RE.finditer(flat):
        if m.group(2) not in _BEHIND_OF:
            numbered(m.start(1), m.end(2), m.group(2), _BEFORE_OF[m.group(1)])
    if not streets:
        return None
    rest = list(flat)
    for a, b in used:
        rest[a:b] = [","] * (b - a)
    left = "".join(rest)
    codes = [postcode_form(postcode)] if postcode and postcode_form(postcode) else []
    for p in _POSTCODES:
        for m in p.finditer(left):
            codes.append(postcode_form(m.group()))
            end = m.end()
            if re.fullmatch(r"\d{4} [a-z]{2}", m.group()):
                # two letters of the code, or a word of the town
                codes.append(m.group()[:4])
                end = m.start() + 4
            left = left[: m.start()] + "," * (end - m.start()) + left[end:]
    for m in _TWO_NUMBERS.finditer(left):
        if 4 <= len(m.group(1) + m.group(2)) <= 6:
            codes.append(m.group(1) + m.group(2))
    own = [town_form(city)] if city and len(town_form(city)) >= 2 else []
    towns, short = [], []
    for p in _BETWEEN.split(left):
        words = [_SAINTS.get(w, w) for w in _LETTERS.findall(p)]
        words = [w for w in words if not (w in _COUNTRY_OF and (len(w) > 2 or len(words) == 1))] or []
        for n in (3, 2, 1):
            for i in range(len(words) - n + 1):
                g = _strokes("".join(words[i : i + n]))
                if len(g) >= 4:
                    towns.append(g)
                elif n == 1 and len(g) >= 2:
                    short.append(g)
    return Parsed(list(streets), list(dict.fromkeys(c for c in codes if c)), list(dict.fromkeys(own + towns)), found_country, list(dict.fromkeys(short)))


def _shortened(name: str) -> list[str]:
    """The name and, from six letters on, the name with each letter left out."""
    return [name] if len(name) < 6 else list(dict.fromkeys([name, *(name[:i] + name[i + 1 :] for i in range(len(name)))]))


def _keys(p: Parsed) -> set[int]:
    found = set()
    for name, kind, number in p.streets:
        for form in _shortened(name):
            found.add(xxhash.xxh64_intdigest(f"{form}|{kind}|{number}") - (1 << 63))
        for code in p.postcodes:
            found.add(xxhash.xxh64_intdigest(f"{number}|{code}") - (1 << 63))
    return found


_PARSED = "streets array<struct<name:string,kind:string,number:string>>, postcodes array<string>, towns array<string>, country string, short array<string>"


def expand(addresses: DataFrame) -> DataFrame:
    """address (any columns called a, text, postcode, city, country) -> one row per hash: a, key and the readings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for a, text, code, city, country in zip(pdf["a"], pdf["text"], pdf["postcode"], pdf["city"], pdf["country"]):
                p = parse_address(text, code, city, country)
                if p:
                    rows.append((a, [{"name": n, "kind": k, "number": h} for n, k, h in p.streets], p.postcodes, p.towns, p.country, p.short, sorted(_keys(p))))
            yield pd.DataFrame(rows, columns=["a", "streets", "postcodes", "towns", "country", "short", "keys"])

    kind = addresses.schema["a"].dataType.simpleString()
    return addresses.select("a", "text", "postcode", "city", "country").mapInPandas(run, f"a {kind}, {_PARSED}, keys array<bigint>")


#: Words that towns begin with and that say little alone.
_COMMON = ("saint", "fort", "port", "puerto", "santa", "mount", "upper", "east", "west", "north", "south", "nova", "nowy", "stoke", "groot")


def _near(x, y):
    """Two town forms of one town: equal, typing errors, cut off or with an addition."""
    n = F.least(F.length(x), F.length(y))
    starts = lambda a, b: (F.length(a) >= 4) & (2 * F.length(a) >= F.length(b)) & ~a.isin(*_COMMON) & b.startswith(a)
    initial = lambda a, b: (F.length(a) >= 7) & (F.substring(a, 1, 1) == F.substring(b, 1, 1)) & b.endswith(F.substring(a, 2, 40))
    return (x == y) | initial(x, y) | initial(y, x) | ((n >= 5) & (F.levenshtein(x, y, 1) >= 0)) | ((n >= 8) & (F.levenshtein(x, y, 2) >= 0)) | starts(x, y) | starts(y, x)


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b of readings (left's a, right's a) that share a hash and whose places agree; agreed: 'place' or 'street'.

    'street' is left where neither postcode nor town could be compared.
    """
    hashes = left.select("a", F.explode("keys").alias("key")).join(right.select(F.col("a").alias("b"), F.explode("keys").alias("key")), "key").select("a", "b").distinct()
    one = left.select("a", "streets", F.col("postcodes").alias("codes"), "towns", "country", "short")
    two = right.select(F.col("a").alias("b"), F.col("streets").alias("streets_b"), F.col("postcodes").alias("codes_b"), F.col("towns").alias("towns_b"), F.col("country").alias("country_b"), F.col("short").alias("short_b"))
    both = hashes.join(one, "a").join(two, "b")
    same = F.exists("streets", lambda x: F.exists("streets_b", lambda y: (x["number"] == y["number"]) & (x["kind"] == y["kind"]) & (F.levenshtein(x["name"], y["name"], 2) >= 0)))
    # a long house number, read as a postcode too, is no evidence for the place
    code = F.arrays_overlap(F.array_except("codes", F.transform("streets", lambda x: x["number"])), "codes_b")
    town = F.arrays_overlap("short", "towns_b") | F.arrays_overlap("towns", "short_b") | F.exists("towns", lambda x: F.exists("towns_b", lambda y: _near(x, y)))
    abroad = (F.col("country") != "") & (F.col("country_b") != "") & (F.col("country") != F.col("country_b"))
    judged = both.filter(same).select("a", "b", "country", "codes", F.get("towns_b", F.lit(0)).alias("town_b"), F.coalesce(code, F.lit(False)).alias("code"), F.coalesce(town, F.lit(False)).alias("town"), abroad.alias("abroad"))
    return judged.filter("code or not abroad").select("a", "b", "codes", "town_b", F.when(F.col("code") | F.col("town"), F.lit("place")).otherwise(F.lit("street")).alias("agreed"))


def same_places(addresses: DataFrame, book: DataFrame) -> DataFrame:
    """a, b: addresses (a, text, postcode, city, country) and entries of book (same columns) that are the same place.

    Street and house number must agree, and postcode or town; an address that names neither counts where the book
    has its street and number in one town only. Entries of one place share their matches, so that typing errors on
    both sides don't part them. NULL, blank and remark addresses, and those without a readable street and number,
    give no row; repeated entries all count.
    """
    left, right = cut(expand(addresses)), cut(expand(book))
    found = _pairs(left, right)
    # towns the book knows: an address that names one of them elsewhere is no 'address without town'
    towns = right.select(F.get("towns", F.lit(0)).alias("t")).distinct()
    names_town = left.select("a", F.explode(F.concat("towns", "short")).alias("t")).join(towns, "t", "left_semi").select("a").distinct()
    sure = found.filter("agreed = 'place'").select("a", "b")
    open_ = found.filter("agreed = 'street' and size(codes) = 0").join(sure.select("a").distinct(), "a", "left_anti").join(names_town, "a", "left_anti")
    single = open_.groupBy("a").agg(F.count_distinct("town_b").alias("n")).filter("n = 1").select("a")
    direct = sure.unionByName(open_.join(single, "a", "left_semi").select("a", "b"))
    twins = _pairs(right, right).filter("agreed = 'place'").select(F.col("a").alias("b"), F.col("b").alias("c"))
    return direct.unionByName(direct.join(twins, "b").select("a", F.col("c").alias("b"))).distinct()


def match_addresses(headers: DataFrame, book: DataFrame) -> DataFrame:
    """record_id, side ('ship_to', 'sold_to'), address_id: both addresses of the records against the address book.

    The same text with the same postcode and city is compared once, however many records have it.
    """
    none = F.lit(None).cast("string")
    sides = F.array(
        F.struct(F.lit("ship_to").alias("side"), F.col("ship_to_address").alias("text"), F.col("ship_to_postcode").alias("postcode"), F.col("ship_to_city").alias("city")),
        F.struct(F.lit("sold_to").alias("side"), F.col("sold_to_address").alias("text"), none.alias("postcode"), none.alias("city")),
    )
    blank = lambda c: F.when(~F.lower(F.trim(c)).isin("", "n/a", "none", "null", "nan", "-", "tbd"), F.col(c))
    asked = headers.select("record_id", F.inline(sides)).withColumns({c: blank(c) for c in ("text", "postcode", "city")}).filter("text is not null")
    asked = asked.withColumn("a", F.md5(F.concat_ws("\u0001", "text", F.coalesce("postcode", F.lit("\u0002")), F.coalesce("city", F.lit("\u0002")))))
    entries = book.select(F.col("address_id").alias("a"), F.col("address").alias("text"), "postcode", "city", "country")
    unique = asked.select("a", "text", "postcode", "city").dropDuplicates(["a"]).withColumn("country", none)
    places = same_places(unique, entries)
    return asked.select("record_id", "side", "a").join(places, "a").select("record_id", "side", F.col("b").alias("address_id")).distinct()
