"""Texts garbled by a wrong decoding: found and, where possible, restored.

For every pair (encoding of the text, encoding it was decoded with) the garbled form of each character is computed
beforehand. Pairs from a multi-byte encoding give sequences of two to four characters that no language writes; pairs
of two single-byte encodings give a single other character, so their patterns are trigrams whose right form is common
in the corpus and whose garbled form is not. One Aho-Corasick automaton holds all patterns; only matched spans are
replaced, so correct text beside them stays as it is.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.session import cut

# Single-byte encodings a text may be decoded with, and those it may have been written in.
READ_AS = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "cp1253", "cp437", "cp850", "cp852", "cp866", "mac-roman", "koi8-r")
WRITTEN_IN = ("cp1252", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "mac-roman", "cp437", "cp850", "cp852")
# East Asian encodings and the blocks of which texts in them mostly consist.
WIDE_WRITTEN_IN = ("euc-kr", "gb18030", "shift_jis", "euc-jp", "big5")
WIDE_READ_AS = ("gb18030", "cp932", "cp949", "big5")
#: A trigram must be seen this often to be a right form, and this many times as often as its garbled form.
SEEN, RATIO = 10, 15
#: A text, or line, is garbled throughout if under one pair of encodings so many of its distinct trigrams, and this
#: share of those that change, turn into forms seen MORE times as often; forms no more frequent count against.
TURNED, SHARE, MORE = 5, 0.9, 2

#: Share of all counted trigrams from which on one is kept (and two times at least): at most 4,000,000 are, whatever the
#: corpus, and what is rarer tells nothing.
KEPT = 2.5e-7
#: Scripts whose garbled forms right texts have by chance (a sign before a no-break blank) count in runs of so many.
RUN = 3

#: Signs whose garbled form tells even without letters around it.
_SIGNS = "€–’“”„«»½±°§µ"

LOST = "�"
_WIDE = re.compile("[⺀-鿿가-힣！-｠　-ヿ]")
#: Letters of another script, or parts of drawn tables, between Latin letters.
_MIXED = re.compile("(?<=[A-Za-zÀ-ž])([Ͱ-ϿЀ-ӿ─-▟ⁿ]{1,2})(?=[A-Za-zÀ-ž])")
_NORMAL = {i: chr(i) if chr(i).isalpha() else ("0" if 48 <= i <= 57 else " ") for i in range(128)}


@lru_cache(None)
def _decoded(name: str) -> list[str]:
    """Character of each byte; bytes without one are control characters, as browsers have it."""
    table = []
    for b in range(256):
        try:
            table.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            table.append(chr(b))
    return table


@lru_cache(None)
def _encoded(name: str) -> dict[str, int]:
    return {c: b for b, c in reversed(list(enumerate(_decoded(name))))}


# Blocks of Hebrew, Arabic, Indic scripts, Thai and Lao.
_IN_RUNS = ((0x5BE, 0x5F5), (0x60C, 0x6D4), (0x900, 0xEE0))


def _repertoire() -> Iterator[str]:
    for a, b in ((0xA0, 0x180), (0x218, 0x21C), (0x391, 0x3CA), (0x401, 0x460), (0x490, 0x492), *_IN_RUNS, (0x2010, 0x2027), (0x2030, 0x203B), (0x20A0, 0x20BF), (0x2100, 0x2123), (0x2190, 0x2194), (0x2200, 0x2270), (0x2500, 0x25A0), (0x3000, 0x3100), (0x4E00, 0xA000), (0xAC00, 0xD7A4), (0xFF01, 0xFF61)):
        yield from map(chr, range(a, b))
    # what one layer of garbling makes another may garble again
    yield from sorted({c for name in READ_AS for c in _decoded(name)[128:] if c > "\x9f"})


def _written(s: str) -> bool:
    """Sequences that right texts have too: Cyrillic letters, lines of drawn tables."""
    return all("Ѐ" <= c <= "ӿ" and c.isalpha() for c in s) or all("─" <= c <= "▟" for c in s)


def garbled_sequences() -> dict[str, tuple[str, str, int]]:
    """Garbled sequence -> (kind, right character, bits of READ_AS), for texts in UTF-8 read as a single-byte encoding.

    Kind 'sure', 'weak' for what right texts have too (that counts only beside a sure one of the same encoding), or 'run'.
    """
    in_runs = {chr(c) for a, b in _IN_RUNS for c in range(a, b)}
    found: dict[str, tuple[str, str, int]] = {}
    for k, wrong in enumerate(READ_AS):
        table = _decoded(wrong)
        for c in _repertoire():
            g = "".join(table[b] for b in c.encode())
            kind, right, bits = found.get(g, ("run" if c in in_runs else "weak" if _written(g) else "sure", c, 0))
            found[g] = kind, right, bits | 1 << k
    return found


def wide_sequences() -> dict[str, str]:
    """Garbled pair -> right character, for East Asian texts read as a Western encoding; counts only in runs."""
    found: dict[str, str] = {}
    table = _decoded("cp1252")
    for source in WIDE_WRITTEN_IN:
        for c in _repertoire():
            if _WIDE.match(c):
                try:
                    b = c.encode(source)
                except UnicodeEncodeError:
                    continue
                if len(b) == 2 and min(b) >= 0x80:
                    for g in ("".join(table[x] for x in b), b.decode("latin-1")):
                        found.setdefault(g, c)
    return found


@lru_cache(None)
def embedded_wide() -> dict[str, str]:
    """East Asian character -> the Western letter whose UTF-8 bytes were read as it."""
    found: dict[str, str] = {}
    for wrong in WIDE_READ_AS:
        for c in map(chr, range(0xC0, 0x180)):
            try:
                g = c.encode().decode(wrong)
            except UnicodeDecodeError:
                continue
            if len(g) == 1:
                found.setdefault(g, c)
    return found


@lru_cache(None)
def misread_leads() -> frozenset[str]:
    """East Asian characters that come from the first two bytes of a UTF-8 character of three."""
    found = set()
    for wrong in WIDE_READ_AS:
        for lead in range(0xE3, 0xEF):
            for follow in range(0x80, 0xC0):
                try:
                    g = bytes([lead, follow]).decode(wrong)
                except UnicodeDecodeError:
                    continue
                if len(g) == 1:
                    found.add((wrong, g))
    return frozenset(found)


def normal(text: str) -> str:
    """Same length: digits as 0, all of ASCII but letters as blanks."""
    return text.translate(_NORMAL)


def count_trigrams(text: str, into: Counter) -> None:
    s = f" {normal(text)} "
    for m in re.finditer(r"[^\x00-\x7f]", s):
        i = m.start()
        t = s[i - 1 : i + 2]
        if not _WIDE.search(t):
            into[t] += 1


def trigram_patterns(seen: dict[str, int]) -> dict[str, list[tuple[str, str, int]]]:
    """Garbled trigram -> its readings: (pair, right trigram, how often that is seen)."""
    found: dict[str, list[tuple[str, str, int]]] = {}
    for right, n in seen.items():
        if n < SEEN or LOST in right:
            continue
        for source in WRITTEN_IN:
            back = _encoded(source)
            try:
                codes = [b if (b := ord(c)) < 128 else back[c] for c in right]
            except KeyError:
                continue
            for wrong in READ_AS:
                if wrong == source:
                    continue
                table = _decoded(wrong)
                g = "".join(table[b] if b >= 128 else chr(b) for b in codes)
                if g == right or g[1] == right[1] or n < RATIO * seen.get(g, 0):
                    continue
                found.setdefault(g, []).append((f"{source}>{wrong}", right, n))
    return found


# First bytes of the frequent characters in each encoding.
_FREQUENT = {"gb18030": (0xB0, 0xD7), "euc-jp": (0xB0, 0xCF), "shift_jis": (0x88, 0x97), "big5": (0xA4, 0xC6)}


def _usual(text: str, source: str) -> float:
    """How much a text looks like one in the languages of an East Asian encoding: share of its frequent characters."""
    chars = _WIDE.findall(text)
    marks = sum("　" <= c <= "〿" or "！" <= c <= "｠" for c in chars)
    kana, hangul = sum("぀" <= c <= "ヿ" for c in chars), sum("가" <= c <= "힣" for c in chars)
    if source == "euc-kr":
        return (hangul + marks) / len(chars) - (0.5 if hangul + marks < len(chars) else 0) if chars else 0.0
    low, high = _FREQUENT[source]
    frequent = sum("⺀" <= c <= "鿿" and low <= c.encode(source, "replace")[0] <= high for c in chars)
    share = (frequent + kana + marks) / len(chars) if chars else 0.0
    return share - (0.5 if (source in ("euc-jp", "shift_jis")) != (kana > 0.15 * len(chars)) else 0)


class Matcher:
    """The automaton over all patterns; made once in each worker."""

    def __init__(self, seen: dict[str, int]) -> None:
        machine = ahocorasick.Automaton()
        for g, value in trigram_patterns(seen).items():
            machine.add_word(g, ("trigram", g, value))
        for g, c in wide_sequences().items():
            if g not in machine:
                machine.add_word(g, ("wide", g, c))
        self.seen = seen
        self.single: Counter = Counter()
        for t, n in seen.items():
            self.single[t[1]] += n
        for g, (kind, c, bits) in garbled_sequences().items():
            # letters that would stand for one the corpus does not use
            doubtful = kind == "sure" and g.isalpha() and self.single[c] < SEEN
            machine.add_word(g, ("weak" if doubtful else kind, g, (c, bits)))
        machine.make_automaton()
        self.machine = machine
        self.turns: dict[str, tuple[frozenset[str], frozenset[str]]] = {}

    def once(self, text: str) -> tuple[str, bool, bool]:
        """The text with its garbled spans replaced once, whether there were any, and whether more may lie beneath."""
        if text.isascii():
            return text, False, False
        s = f" {normal(text)} "
        sure: list[tuple[int, int, str]] = []
        weak: list[tuple[int, int, tuple[str, int]]] = []
        read_as = 0
        wide: list[int] = []
        run: list[tuple[int, int, tuple[str, int]]] = []
        grams: dict[str, list[tuple[int, str, str, int]]] = {}
        for end, (kind, g, value) in self.machine.iter(s):
            start = end - len(g)  # positions in text: s has one blank before it
            if kind == "sure":
                sure.append((start, start + len(g), value[0]))
                read_as |= value[1]
            elif kind == "weak":
                weak.append((start, start + len(g), value))
            elif kind == "run":
                run.append((start, start + len(g), value))
            elif kind == "wide":
                wide.append(start)
            else:
                for pair, right, n in value:
                    grams.setdefault(pair, []).append((start, g, right, n))
        sure += self._runs(run)
        spans = sure + [(a, b, c) for a, b, (c, bits) in weak if bits & read_as]
        if len(wide) >= 3:
            runs = self._wide(text, wide, [(a, b) for a, b, _ in sure])
            strange = sum(ord(c) > 127 for c in text)
            # words of a single-byte script decode by chance here and there, a text does so throughout
            if sure or sum(sum(ord(c) > 127 for c in text[a:b]) for a, b, _ in runs) >= 0.8 * strange or not self._single(text, grams):
                spans += runs
        spans += self._embedded(text) + self._misread(text)
        beneath = bool(spans)
        if not spans:
            spans = self._single(text, grams) or self._throughout(text) or self._mixed(text)
        out, at = [], 0
        for a, b, right in sorted(spans, key=lambda x: (x[0], -x[1])):
            if a >= at:
                out += [text[at:a], right]
                at = b
        return "".join(out) + text[at:], bool(spans), beneath

    @staticmethod
    def _runs(hits: list[tuple[int, int, tuple[str, int]]]) -> list[tuple[int, int, str]]:
        """Sequences of one encoding that follow each other, with one character between them at most, RUN or more."""
        found, row, bits = [], [], 0
        for a, b, (c, k) in hits:
            if row and a - row[-1][1] <= 1 and a >= row[-1][1] and bits & k:
                row.append((a, b, c))
                bits &= k
                continue
            found += row if len(row) >= RUN else []
            row, bits = [(a, b, c)], k
        return found + (row if len(row) >= RUN else [])

    @staticmethod
    def _wide(text: str, hits: list[int], sure: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
        """Segments that a Western encoding can write and that decode strictly to East Asian text."""
        back, found = _encoded("cp1252"), []
        for m in re.finditer(r"[^\n⺀-￯]+", text):
            a, b = m.span()
            if sum(a <= h < b for h in hits) < 3 or 2 * sum(y - x for x, y in sure if a <= x < b) >= sum(ord(c) > 127 for c in m.group()):
                continue
            codes = bytearray()
            for c in m.group():
                code = ord(c) if ord(c) < 256 and (ord(c) < 128 or ord(c) >= 160) else back.get(c, ord(c) if ord(c) < 256 else None)
                if code is None:
                    break
                codes.append(code)
            else:
                best = None
                for source in WIDE_WRITTEN_IN:
                    try:
                        right = bytes(codes).decode(source)
                    except UnicodeDecodeError:
                        continue
                    n = len(_WIDE.findall(right))
                    usual = _usual(right, source)
                    if n >= 3 and usual >= 0.5 and n >= 0.9 * sum(ord(c) > 127 for c in right) and (best is None or (usual, -len(right)) > best[0]):
                        best = (usual, -len(right)), right
                if best:
                    found.append((a, b, best[1]))
        return found

    @staticmethod
    def _embedded(text: str) -> list[tuple[int, int, str]]:
        """'f眉r': a lone East Asian character inside a Western word."""
        table = embedded_wide()
        return [(m.start(1), m.end(1), table[m.group(1)]) for m in re.finditer(r"(?<=[a-zA-Z])([⺀-鿿가-힣])(?=[a-z])", text) if m.group(1) in table]

    @staticmethod
    def _misread(text: str) -> list[tuple[int, int, str]]:
        leads, found = misread_leads(), []
        for m in re.finditer(r"[⺀-鿿가-힣！-｠　-ヿ€·]{3,}", text):
            run = m.group()
            for wrong in WIDE_READ_AS:
                if sum((wrong, c) in leads for c in run) * 4 < len(run):
                    continue
                try:
                    codes = run.encode(wrong)
                except UnicodeEncodeError:
                    continue
                right = codes.decode("utf-8", "replace")
                if len(right) > 1 and right.count(LOST) * 5 <= len(right):
                    found.append((m.start(), m.end(), right))
                    break
        return found

    def _single(self, text: str, grams: dict[str, list[tuple[int, str, str, int]]]) -> list[tuple[int, int, str]]:
        """The pair of single-byte encodings with most trigrams, if they are enough to tell."""
        if not grams:
            return []
        pair = max(grams, key=lambda p: (len({g for _, g, _, _ in grams[p]}), len(grams[p]), sum(h[3] for h in grams[p]), p))
        hits = grams[pair]
        word = [h for h in hits if h[1][0].isalpha() or h[1][2].isalpha()]
        strange = [h for h in hits if h[2][1] in _SIGNS and h[3] >= 5 * SEEN and self.single[h[2][1]] >= RATIO * self.single[h[1][1]]]
        if len({g for _, g, _, _ in word}) < 2 and not any(h[3] >= 5 * SEEN for h in word) and not strange:
            return []
        source, wrong = pair.split(">")
        table, back, found = _decoded(source), _encoded(wrong), []
        for start, _, _, _ in hits:
            # the whole word of the match is in the same encoding
            a = b = start + 1
            while a > 0 and not text[a - 1].isspace():
                a -= 1
            while b < len(text) and not text[b].isspace():
                b += 1
            for i in range(a, b):
                if ord(text[i]) >= 128 and text[i] in back:
                    found.append((i, i + 1, table[back[text[i]]]))
        return found

    def _turned(self, t: str) -> tuple[frozenset[str], frozenset[str]]:
        """Pairs whose reading of a trigram is seen MORE times as often, and those whose reading is not or that a text read
        so can't have; pairs that leave it, or of which neither form is known, are in neither."""
        found = self.turns.get(t)
        if found is None:
            better, worse, n = set(), set(), self.seen.get(t, 0)
            for wrong in READ_AS:
                back = _encoded(wrong)
                codes = [ord(c) if ord(c) < 128 else back.get(c) for c in t]
                for source in WRITTEN_IN:
                    if source == wrong:
                        continue
                    pair, table = f"{source}>{wrong}", _decoded(source)
                    if None in codes:
                        worse.add(pair)  # a text read as that encoding has no such character
                        continue
                    right = "".join(table[b] if b >= 128 else chr(b) for b in codes)
                    m = self.seen.get(right, 0)
                    if right[1] != t[1] and m + n > 0:
                        (better if m >= 3 and m >= MORE * n else worse).add(pair)
            if len(self.turns) > 100_000:
                self.turns.clear()
            found = self.turns[t] = frozenset(better), frozenset(worse)
        return found

    def _candidates(self, trigrams: Counter) -> list[str]:
        """Pairs under which TURNED trigrams and more turn: few texts have any."""
        better: Counter = Counter()
        for t in trigrams:
            better.update(self._turned(t)[0])
        return [p for p, n in better.items() if n >= TURNED]

    def pair_throughout(self, text: str) -> str | None:
        """The pair of single-byte encodings of a text that is garbled from end to end, however frequent its garbled forms are.

        A pair with fewer than TURNED trigrams can't have more turned less unturned ones than one that passes.
        """
        c: Counter = Counter()
        count_trigrams(text, c)
        if len(c) < TURNED:
            return None
        score = {}
        for p in self._candidates(c):
            better, worse = sum(p in self._turned(t)[0] for t in c), sum(p in self._turned(t)[1] for t in c)
            score[p] = better, worse
        best = max(score, key=lambda p: (score[p][0] - score[p][1], p), default=None)
        return best if best and score[best][0] >= SHARE * sum(score[best]) else None

    def _throughout(self, text: str) -> list[tuple[int, int, str]]:
        """The whole text's characters under its pair; else those of the lines that have one."""
        c: Counter = Counter()
        count_trigrams(text, c)
        if not self._candidates(c):
            return []  # lines have no other trigrams than the text
        parts = [(0, text)]
        if self.pair_throughout(text) is None:
            parts = [(m.start(), m.group()) for m in re.finditer(r"[^\n]+", text)] if "\n" in text else []
        found = []
        for at, part in parts:
            if not part.isascii() and (pair := self.pair_throughout(part)):
                source, wrong = pair.split(">")
                table, back = _decoded(source), _encoded(wrong)
                found += [(at + i, at + i + 1, table[back[c]]) for i, c in enumerate(part) if ord(c) >= 128 and c in back]
        return found

    def _mixed(self, text: str) -> list[tuple[int, int, str]]:
        """'Wistδlax': the reading as Latin letters whose trigrams are seen most."""
        found = []
        for m in _MIXED.finditer(text):
            s, options = m.group(1), set()
            for source in ("cp1252", "cp1250"):
                for wrong in READ_AS:
                    back = _encoded(wrong)
                    if all(c in back for c in s) and (right := "".join(_decoded(source)[back[c]] for c in s)).isalpha() and right < "Ͱ":
                        options.add(right)
            if options:
                found.append((*m.span(1), max(options, key=lambda r: (self.seen.get(normal(text[m.start(1) - 1 : m.start(1)] + r + text[m.end(1) : m.end(1) + 1]), 0), self.single[r[0]], r))))
        return found

    def restore(self, text: str) -> tuple[bool, str]:
        """(garbled, text with what can be regained)."""
        garbled = LOST in text or any("\x80" <= c <= "\x9f" for c in text)
        beneath = True
        while beneath:
            before = len(text)
            text, changed, beneath = self.once(text)
            garbled |= changed
            # what lies beneath came out of longer sequences, so each layer makes the text shorter
            beneath = beneath and len(text) < before
        return garbled, text


_MATCHERS: dict[str, Matcher] = {}


def corpus_trigrams(documents: DataFrame, text: str = "text") -> DataFrame:
    """trigram, n over all distinct texts, so copies don't count: only non-ASCII ones, counted within each batch first.
    The alphabets bound it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        for pdf in batches:
            for t in pdf["t"]:
                count_trigrams(t, c)
        yield pd.DataFrame({"trigram": list(c.keys()), "n": list(c.values())}, columns=["trigram", "n"]).astype({"trigram": "object", "n": "int64"})

    plain = documents.filter(F.col(text).rlike(r"[^\x00-\x7f]")).select(F.col(text).alias("t")).distinct()
    return plain.mapInPandas(count, "trigram string, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def repair_encoding(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, original, restored (no character is lost any more): one row per document with garbled characters.

    NULL and empty texts, and texts without such characters, give no row. Repeated rows are judged one by one. Whole
    texts are read, however long.
    """
    spark = documents.sparkSession
    counted = cut(corpus_trigrams(documents, text))
    total = counted.agg(F.sum("n")).collect()[0][0] or 0
    seen = {r["trigram"]: r["n"] for r in counted.filter(F.col("n") >= max(2, KEPT * total)).toLocalIterator()}
    shared = spark.sparkContext.broadcast(seen)
    made = uuid.uuid4().hex

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = None
        for pdf in batches:
            if matcher is None:
                matcher = _MATCHERS.get(made)
                if matcher is None:
                    matcher = Matcher(shared.value)
                    _MATCHERS.clear()
                    _MATCHERS[made] = matcher
            done = [matcher.restore(t) for t in pdf["t"]]
            keep = [g for g, _ in done]
            if not any(keep):
                continue  # an empty column has no type that Arrow takes for text
            out = pdf.loc[keep, ["k"]].assign(original=[t for g, t in done if g])
            yield out.assign(restored=[LOST not in t for t in out["original"]])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.filter(F.col(text).rlike(r"[^\x00-\x7f]")).select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInPandas(repair, f"k {kind}, original string, restored boolean").withColumnRenamed("k", key)
