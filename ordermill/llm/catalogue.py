"""Free-typed codes and descriptions mapped to the entries of a reference list.

A pigeonhole join by partitions: a reference string is cut into k + 1 segments; a string within k edits holds one of
them unchanged, at a position that the lengths bound. So the edits become an equality join on positional substrings,
verified with the built-in levenshtein. The join runs with k = 0 for all strings (codes, internal numbers, the grade in
a description), then with the k that a reference's length allows for the strings of the lines that are still open; an
anti-join reports the rest. Look-alike characters are folded before. All of it is column expressions and joins.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import bind, cut

NULL_WORDS = ("", "NAN", "NONE", "NULL", "N/A", "NA", "-", "#N/A", "?", "TBD", "X")
UNMATCHED = "UNMATCHED"
#: Edits allowed, by the least length of the reference string; shorter ones must be equal.
EDITS = {8: 2, 5: 1}
MOST = max(EDITS.values())
#: Rank of what a description tells, behind the whole code, other codes and internal numbers.
TOLD = 3

# Words for colours in descriptions, by colour.
COLOURS = {
    "WHITE": ("WHITE", "WHT", "WH", "WEISS", "WEIß", "BLANC", "BIANCO", "BLANCO"),
    "BLACK": ("BLACK", "BLK", "BK", "SCHWARZ", "NOIR", "NERO", "NEGRO"),
    "RED": ("RED", "RD", "ROT", "ROUGE", "ROSSO", "ROJO"),
    "BLUE": ("BLUE", "BLU", "BL", "BLAU", "BLEU", "AZUL"),
    "YELLOW": ("YELLOW", "YEL", "YL", "GELB", "JAUNE", "GIALLO", "AMARILLO"),
    "GREY": ("GREY", "GRY", "GRAY", "GRAU", "GRIS", "GRIGIO", "GR"),
    "GREEN": ("GREEN", "GRN", "GN", "GRÜN", "VERT", "VERDE"),
    "NATURAL": ("NATURAL", "NAT", "NATUR", "NATUREL", "NATURALE", "NA"),
}
# Words of a description that are neither name nor grade nor colour.
OTHER_WORDS = ("BULK", "KG", "BAG", "BAGS", "BIG", "OCTABIN", "OCTABINS", "COMPOUND", "GRANULAT", "GRANULÉS", "GRANULES", "GRANULATE", "RESIN", "MAT", "ART", "REF", "YOUR", "IHRE", "NR", "PN", "HI", "FR", "UV", "GF", "CF", "MF", "SACK", "LOSE", "VRAC", "MATERIAL", "REV")

_FOLD = ("OISZB", "01528")
_NOISE_BEFORE = r"^(?:#|ART\.?-? ?NR\.?|ART\.|P/N|PN:?|MAT(?:ERIAL)?\.?(?:-?NR\.?)?:?|R[ÉE]F\.?|IHRE NR\.?|YOUR REF\.?:?|OUR REF\.?|ITEM|NO\.|NR\.)\s*(?=[A-Z0-9])"
_NOISE_AFTER = r"(?:\s+REV\.? ?[A-Z0-9]+|\s*/\s*\d+ ?KG|\s*\([A-Z ]+\)|[*;.,:\s]+)$"
_GRADE = r"(?:^|[^A-Z0-9])([A-Z])[ -]?(\d{4})(?=[^A-Z0-9]|$)"


def _text(c: Column) -> Column:
    t = F.upper(F.trim(F.regexp_replace(c, r"[\s ]+", " ")))
    return F.when(t.isin(*NULL_WORDS) | t.isNull(), "").otherwise(t)


def _plain(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Z0-9]", "")


def fold(c: Column) -> Column:
    """Characters that are mistaken for each other as one."""
    return F.translate(c, *_FOLD)


def _codes(text: Column, field: str) -> Column:
    """kind, q: strings in a text that may be a code. 'w' is the whole text, as it is and without marks around it; 'c'
    what stands in brackets or behind a mark, first and last words. In descriptions only strings with a digit count."""
    parts = F.array(
        F.regexp_extract(text, r"\(([^)]+)\)", 1),
        F.regexp_extract(text, r";\s*(.+)$", 1),
        F.regexp_extract(text, r" / ([^ ]+(?: [^ /]+)?)$", 1),
        F.regexp_extract(text, r"^(\S+) ", 1),
        F.regexp_extract(text, r"^(\S+ \S+) ", 1),
        F.regexp_extract(text, r"[ ,;](\S+)$", 1),
        F.regexp_extract(text, r"[ ,;](\S+ \S+)$", 1),
    )
    bare = lambda p: F.regexp_replace(F.regexp_replace(F.regexp_replace(p, _NOISE_BEFORE, ""), _NOISE_AFTER, ""), _NOISE_BEFORE, "")
    more = lambda ps: F.array_union(ps, F.transform(ps, lambda p: F.regexp_replace(p, "^00(?=[A-Z0-9]{8})", "")))
    whole = more(F.array(_plain(text), _plain(bare(text))))
    whole = F.filter(whole, lambda p: p.rlike("[0-9]")) if field == "description" else whole
    inside = F.filter(more(F.transform(F.filter(parts, lambda p: p != ""), lambda p: _plain(bare(p)))), lambda p: p.rlike("[0-9]") if field == "description" else F.length(p) >= 3)
    told = lambda kind, ps: F.transform(F.array_distinct(F.filter(ps, lambda p: p != "")), lambda p: F.struct(F.lit(kind).alias("kind"), fold(p).alias("q")))
    return F.array_union(told("w", whole), told("c", inside))


def _is_code(p: Column) -> Column:
    """Whether a part of a text may be a misspelt code: a word with four digits and more that look like some."""
    return (F.length(p) >= 8) & (F.length(F.regexp_replace(p, "[^0-9]", "")) >= 6)


def _described(text: Column) -> dict[str, Column]:
    """grade, name, colour that a description states; name is its longest word of at least four letters."""
    colours = F.create_map(*[F.lit(x) for x in chain.from_iterable((w, k) for k, ws in COLOURS.items() for w in ws)])
    words = F.split(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "), " ")
    other = F.array(*[F.lit(w) for w in OTHER_WORDS])
    named = F.filter(words, lambda w: (F.length(F.regexp_replace(w, r"\P{L}", "")) >= 4) & ~F.array_contains(other, w) & colours[w].isNull() & ~w.rlike(r"\d{3}|^\d+KG$"))
    seen = F.filter(F.transform(words, lambda w: colours[w]), lambda w: w.isNotNull())
    name = F.array_max(F.transform(named, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    return {
        "grade": F.nullif(F.concat(F.regexp_extract(text, _GRADE, 1), F.regexp_extract(text, _GRADE, 2)), F.lit("")),
        "name": name,
        "colour": F.get(seen, F.lit(0)),
    }


def segments(text: Column, k: int = MOST) -> Column:
    """The k + 1 segments of a reference string: length, number, substring."""
    n = F.length(text)
    at = lambda i: F.floor(n * i / (k + 1)).cast("int")
    return F.array(*[F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(text, at(i) + 1, at(i + 1) - at(i)).alias("s")) for i in range(k + 1)])


def probes(text: Column, k: int = MOST) -> Column:
    """The substrings of a string that can equal a segment of a reference string within k edits.

    Of segment i only shifts count that leave at most i edits before it and k - i behind it.
    """
    m = F.length(text)
    found = []
    for change in range(-k, k + 1):  # m - n
        n = m - change
        for i in range(k + 1):
            start, end = F.floor(n * i / (k + 1)).cast("int"), F.floor(n * (i + 1) / (k + 1)).cast("int")
            for shift in range(max(-i, change - (k - i)), min(i, change + (k - i)) + 1):
                inside = (start + shift >= 0) & (end + shift <= m)
                found.append(F.when(inside, F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(text, start + shift + 1, end - start).alias("s"))))
    return F.array_compact(F.array(*found))


def segment_join(asked: DataFrame, references: DataFrame, k: int, least: int = 0, below: int | None = None) -> DataFrame:
    """kind, q, r, distance: strings of asked (kind, q) and of references (kind, r) within k edits.

    Only references of at least `least` and fewer than `below` characters count. Distinct strings meet once.
    """
    sized = lambda n: (n >= least) & (n < below if below else F.lit(True))
    q = asked.select("kind", "q").distinct()
    r = references.select("kind", "r").distinct().filter(sized(F.length("r")))
    near = F.filter(probes(F.col("q"), k), lambda p: sized(p["n"]))
    met = q.select("kind", "q", F.explode(near).alias("p")).join(r.select("kind", "r", F.explode(segments(F.col("r"), k)).alias("p")), ["kind", "p"])
    return met.withColumn("distance", F.levenshtein("q", "r", k)).filter("distance >= 0").select("kind", "q", "r", "distance").distinct()


def catalogue_entries(materials: DataFrame) -> DataFrame:
    """entry (as spelled), code, internal numbers, grade, name, colour: one row per customer material number."""
    m = materials.select(F.col("customer_material_number").alias("entry"), F.regexp_replace("internal_material_number", r"^0+|\D", "").alias("internal"), "material_description")
    m = m.filter(_text(F.col("entry")) != "").groupBy("entry").agg(F.collect_set("internal").alias("internals"), F.min("material_description").alias("d"))
    text = F.coalesce(_text(F.col("d")), F.lit(""))
    return m.select("entry", fold(_plain(_text(F.col("entry")))).alias("code"), "internals", *[c.alias(f"r_{n}") for n, c in _described(text).items()])


def _name_fits(name: Column, other: Column) -> Column:
    return (F.levenshtein(name, other, MOST) >= 0) | (F.length(name).between(4, 6) & other.startswith(name))


#: Names of a pair of texts: two hashes of it.
PAIR = ("_i", "_j")


def _best(candidates: DataFrame) -> DataFrame:
    """Of each text pair the entry of lowest (rank, distance, disagreement); ties within that go to none but exact ones."""
    order = F.struct("rank", "distance", "disagrees")
    best = candidates.groupBy(*PAIR).agg(F.min(F.struct(order.alias("o"), F.col("entry").alias("entry"))).alias("b"), F.min(F.when(F.col("rank") == TOLD, F.struct(order.alias("o"), F.col("entry")))).alias("lo"), F.max(F.when(F.col("rank") == TOLD, F.col("entry"))).alias("hi"))
    # a description that fits several entries says nothing
    open_ = (F.col("b.o.rank") == TOLD) & (F.col("lo.entry") != F.col("hi"))
    return best.filter(~F.coalesce(open_, F.lit(False))).select(*PAIR, F.col("b.entry").alias("entry"), F.col("b.o.distance").alias("distance"))


def map_to_catalogue(lines: DataFrame, materials: DataFrame) -> DataFrame:
    """line_id, customer_material_number (UNMATCHED if the line names what is no entry), distance (edits; NULL for none).

    A line with neither code nor description gives no row; repeated lines one each. With an empty list every line
    is UNMATCHED. Texts and codes of any length are compared whole; lines with the same two texts are matched once.
    """
    entries = catalogue_entries(materials)
    texts = lines.select("line_id", F.coalesce(_text(F.col("material_code")), F.lit("")).alias("code_text"), F.coalesce(_text(F.col("description")), F.lit("")).alias("desc_text")).filter("code_text != '' or desc_text != ''")
    texts = texts.withColumns({"_i": F.xxhash64("code_text", "desc_text"), "_j": F.xxhash64(F.lit(1), "desc_text", "code_text")})
    pairs = texts.select(*PAIR, "code_text", "desc_text").distinct()
    # a code field may hold the description and the other way round
    swapped = F.col("code_text").rlike(r"[A-Z]{4,}") & F.col("code_text").rlike(_GRADE)
    told = F.when(swapped, F.concat_ws(" ", "code_text", "desc_text")).otherwise(F.col("desc_text"))
    number = F.regexp_extract("code_text", r"^0*([1-9]\d{5,17})$", 1)
    pairs = bind(pairs, codes=F.array_union(_codes(F.col("code_text"), "code"), _codes(F.col("desc_text"), "description")), number=number, **_described(told))
    string = lambda kind, q: F.struct(F.lit(kind).alias("kind"), q.alias("q"))
    described = F.filter(F.array(string("i", F.col("number")), string("g", F.coalesce("grade", F.lit("")))), lambda x: x["q"] != "")
    # two joins read the strings, so they are made once
    pairs = cut(pairs.select(*PAIR, "grade", "name", "colour", F.array_union("codes", described).alias("strings")))

    reference = lambda kind, r: F.struct(F.lit(kind).alias("kind"), r.alias("r"))
    known = F.array_union(F.array(reference("w", F.col("code")), reference("c", F.col("code")), reference("g", F.coalesce("r_grade", F.lit("")))), F.transform("internals", lambda i: reference("i", i)))
    answers = entries.select("entry", "r_grade", "r_name", "r_colour", F.inline(F.filter(known, lambda x: x["r"] != "")))
    same_colour = F.col("colour") == F.col("r_colour")
    agrees = F.coalesce((F.col("grade") == F.col("r_grade")), F.lit(False)).cast("int") + F.coalesce(same_colour, F.lit(False)).cast("int")
    columns = [*PAIR, "entry", "rank", "distance", (2 - agrees).alias("disagrees")]
    rank = F.when(F.col("kind") == "w", 0).when(F.col("kind") == "c", 1).when(F.col("kind") == "i", 2).otherwise(TOLD).alias("rank")

    # strings travel with the pair's name only; what a description tells is fetched for pairs that met an entry
    told_of = pairs.select(*PAIR, "grade", "name", "colour")
    asked = pairs.select(*PAIR, F.inline("strings"))
    # with k = 0 the one segment is the whole string and equality is the verification
    equal = asked.withColumnRenamed("q", "r").join(answers, ["kind", "r"]).drop("r").join(told_of, list(PAIR)).withColumns({"rank": rank, "distance": F.lit(0)})
    fits = _name_fits(F.col("name"), F.col("r_name")) & (same_colour | F.col("colour").isNull())
    first = cut(_best(equal.filter((F.col("kind") != "g") | fits).select(*columns)))

    # of the lines still open: codes, and grade + name as one string
    rest = pairs.join(first, list(PAIR), "left_anti")
    told_as = lambda g, n: fold(F.concat(g, n))
    both = F.filter(F.array(string("d", told_as(F.col("grade"), F.col("name")))), lambda x: F.length(x["q"]) >= 10)
    codes = F.filter("strings", lambda x: (x["kind"] == "w") | ((x["kind"] == "c") & _is_code(x["q"])))
    rest = cut(rest.select(*PAIR, "grade", "name", "colour", F.inline(F.array_union(codes, both))))
    whole = F.array(reference("w", F.col("code")), reference("c", F.col("code")), reference("d", told_as(F.col("r_grade"), F.col("r_name"))))
    spelled = cut(entries.select("entry", "r_grade", "r_name", "r_colour", F.inline(F.filter(whole, lambda x: F.length(x["r"]) >= min(EDITS)))))
    longest = None
    met = None
    for least, k in sorted(EDITS.items(), reverse=True):
        part = segment_join(rest, spelled, k, least, longest)
        met, longest = part if met is None else met.unionByName(part), least
    near = rest.join(met, ["kind", "q"]).join(spelled, ["kind", "r"]).withColumn("rank", rank).filter((F.col("kind") != "d") | F.coalesce(same_colour, F.col("colour").isNull()))
    second = _best(near.select(*columns))

    found = first.unionByName(second)
    lines_ = texts.select("line_id", *PAIR)
    matched = lines_.join(found, list(PAIR))
    unmatched = lines_.join(found, list(PAIR), "left_anti")
    return matched.select("line_id", F.col("entry").alias("customer_material_number"), F.col("distance").cast("int").alias("distance")).unionByName(unmatched.select("line_id", F.lit(UNMATCHED).alias("customer_material_number"), F.lit(None).cast("int").alias("distance")))
