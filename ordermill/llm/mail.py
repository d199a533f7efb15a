"""E-mail bodies reduced to what their sender wrote newly.

A semi-Markov model divides the visible lines of a body into segments: authored text, quotes marked by a prefix,
quotes below a header or an attribution, signatures (with their closing formula) and notices (legal text, warnings,
device footers). The score of a segment is the sum of its lines' scores, of cues at its two boundaries, of a
length score and of features of the whole span; the best division is found by dynamic programming over segments.
Line and length scores are sums of the weights given here and of what a first decoding of all messages taught:
log-odds of line shapes, hashed to a fixed number of buckets, and histograms of segment lengths.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUTHORED, PREFIXED, QUOTED, SIGNATURE, NOTICE = range(5)
STATES = 5
#: Longer segments have the length score of this length.
LONG = 24
#: Lines from which on a signature or notice gets no less likely by the weights given here.
SHORT = 14
BUCKETS = 1 << 16

# Words of mail programs and formulas, in the languages of the mail. Patterns without a flag are searched in
# lower-case text, which is four times as fast as ignoring case.
_HEADER = re.compile(r"^[*_ ]*(from|von|de|da|van|od|sent|gesendet|envoyé|enviado|inviato|date|datum|fecha|data|to|an|à|a|para|pour|cc|kopie|copie|subject|betreff|objet|asunto|oggetto|onderwerp)[*_ ]*:[*_]*\s*\S", re.I)
_HEADER_KIND = {w: k for k, ws in enumerate(("from von de da van od", "sent gesendet envoyé enviado inviato date datum fecha data", "to an à a para pour", "cc kopie copie", "subject betreff objet asunto oggetto onderwerp")) for w in ws.split()}
_ORIGINAL = re.compile(r"^[-_\s]{3,}.*(original|ursprüngliche|origine|forwarded|weitergeleitete|transféré|reenviado|inoltrato|message|nachricht|mensaje|messaggio).*[-_\s]{3,}$", re.I)
_RULE = re.compile(r"^[_=]{10,}$")
_WROTE = re.compile(r"(wrote|schrieb|a écrit|escribió|ha scritto|schreef|escreveu|napisał)( (am|on|le|el)\b.*)?\s*:$|(wrote|schrieb|a écrit|escribió) (on|am|le|el)\b.*:$")
_WROTE_PART = re.compile(r"\b(wrote|schrieb|écrit|escribió|scritto|schreef|escreveu)\b")
_DATED = re.compile(r"\d{1,4}[./-]\d{1,2}[./-]\d{1,4}|\b\d{1,2} \w{3,9} \d{4}\b")
_ATTRIBUTION = re.compile(r"^(on|am|le|el|il|op)\b.*\d.*|^\d{4}-\d\d-\d\d.*|^\d{1,2}[./]\d{1,2}[./]\d{2,4}.*", re.I)
_PREFIX = re.compile(r"^([>|]\s?)+")
_CLOSING = re.compile(
    r"^(kind(est)?|best|warm|many|with( kind| best)?|thanks and|thank you and)? ?(regards|wishes)\W*$|^(thank you|thanks|thx|many thanks|cheers|br|kr|rgds|sincerely|yours sincerely|yours faithfully|yours truly|regards|all the best)\W*$"
    r"|^(mit )?(freundliche[nm]?|beste[nm]?|viele|liebe|herzliche|schöne)? ?(grüße[n]?|gruß|grüssen?|gruss)\W*$|^(mfg|vg|lg|danke|vielen dank|besten dank|danke und gruß)\W*$"
    r"|^(bien )?(cordialement|à vous|salutations( distinguées)?|sincères salutations|merci|merci d'avance|bien à vous)\W*$"
    r"|^(un )?(saludo|saludos|cordial saludo|saludos cordiales|atentamente|gracias|un abrazo|muchas gracias)\W*$|^(cordiali|distinti) saluti\W*$|^met vriendelijke groet(en)?\W*$|^z poważaniem\W*$|^(com os melhores )?cumprimentos\W*$",
    re.I,
)
_GREETING = re.compile(r"^(hi|hello|hey|dear|good (morning|day|afternoon|evening)|hallo|liebe[rs]?|sehr geehrte|guten (tag|morgen|abend)|moin|bonjour|bonsoir|madame|monsieur|cher|chère|hola|buen[oa]s (días|tardes)|estimad[oa]s?|caro|gentile|buongiorno|geachte|szanowni|prezados?|all)\b[^.]{0,50}[,:!]?\s*$", re.I)
_POSTSCRIPT = re.compile(r"^(p\.? ?s\.?|n\.? ?b\.?|nachtrag|p\. ?d\.?)\s*[:.]?\s", re.I)
_DELIMITER = re.compile(r"^(--+|\*{3,}|_{2,9}|~{3,}|={3,9}|—+)$")
_CONTACT = re.compile(r"^((phone|tel|telefon|fon|fax|mobile?|mob|cell|m|t|f|p|téléphone|móvil|handy|direct)\b\.?:?\s*)?\+?\(?\d[\d ()/.-]{6,}$|^((e-?mail|mail(to)?|web|courriel|correo)\s*:?\s*)?[\w.+-]+@[\w.-]+\w$|^(https?://|www\.)\S+$", re.I)
_DEVICE = re.compile(r"^(sent|gesendet|envoyé|enviado|inviato|verzonden|von meinem|get outlook|diese nachricht wurde von)\b.*\b(phone|iphone|ipad|android|mobile?|mobilgerät|handheld|handy|blackberry|móvil|smartphone|tablet|telefon|outlook|gerät)\b", re.I)
_LEGAL = re.compile(
    r"confidential|vertraulich|confidentiel|confidencial|riservat|intended (recipient|only)|richtige adressat|destinata(ire|rio)|disclaimer|registered (office|in)|company number|registergericht|handelsregister|amtsgericht|geschäftsführer|sitz der gesellschaft|geschäftsbedingungen|general terms|siège social|rcs |capital (social|de)|domicilio social|registro mercantil|conditions générales|condiciones generales"
    r"|think of the environment|before printing|ausgedruckt werden|avant d'imprimer|antes de imprimir|medio ambiente|outside (the|your) organi[sz]ation|external (e-?mail|sender|message)|\bcaution\b|achtung: |scanned (for|by)|virus|opt.?out|unsubscribe|steuernummer|ust-?id|vat (no|number|id)",
)
_COMPANY = re.compile(r"\b(gmbh|ag|kg|ltd|llc|inc|corp|corporation|company|s\.?a\.?s?|s\.?r\.?l|s\.?p\.?a|b\.?v|n\.?v|sarl|sas|sp\. z o\.o|co|k\.?k|pvt|plc|limited|s\.?l)\.?$|\|")
_ENDED = re.compile(r"[.!?…]['\")]*$")


class Line:
    """A visible line with what is known of it."""

    __slots__ = ("number", "text", "depth", "space", "cue", "cited", "block", "scores")

    def __init__(self, number: int, text: str, space: bool, cited: bool, block: bool) -> None:
        self.number, self.space, self.cited, self.block = number, space, cited, block
        m = _PREFIX.match(text)
        self.depth = len(re.sub(r"\s", "", m.group())) if m else 0
        self.text = text[m.end() :].strip() if m else text
        self.cue = _cue(self.text)


@lru_cache(100_000)
def _cue(t: str) -> str:
    if not t:
        return "empty"
    low = t.lower()
    if _DELIMITER.match(t):
        return "delimiter"
    if _ORIGINAL.match(t) or _RULE.match(t):
        return "original"
    if len(t) > 20 and _LEGAL.search(low):
        return "legal"
    if _DEVICE.match(t) and len(t) < 90:
        return "device"
    if t.endswith(":") and (_WROTE.search(low) or (_WROTE_PART.search(low) and _DATED.search(t))):
        return "wrote"
    if _HEADER.match(t):
        return "header"
    if _POSTSCRIPT.match(t):
        return "postscript"
    if _CLOSING.match(t):
        return "closing"
    if _CONTACT.match(t):
        return "contact"
    if _GREETING.match(t):
        return "greeting"
    if _ENDED.search(t) and len(t) > 15 and not _COMPANY.search(low):
        return "sentence"
    words = t.split()
    if len(words) <= 9 and _COMPANY.search(low):
        return "company"
    if len(words) <= 4 and all(w[0].isupper() or w in ("de", "von", "van", "del", "la") for w in words if w[0].isalpha()) and not re.search(r"[,;:!?]$", t):
        return "name"
    if len(words) <= 4:
        return "short"
    return "text"


# Scores of a line's cue in each state: authored, prefixed quote, quote, signature, notice. Quotes hold all kinds of
# lines, so a line counts there what it counts in its best other state.
CUES = {
    "empty": (0, 0, 0, 0, -2),
    "delimiter": (-3, 0, 0, 1.5, -3),
    "original": (-6, 0, 1.5, -4, -4),
    "legal": (-4, 0, 0, -2, 4),
    "device": (-4, 0, 0, -1, 4),
    "wrote": (-4, 0.5, 1, -6, -6),
    "header": (0, 0, 1, -4, -5),
    "headline": (-9, 0, 1, -9, -9),
    "postscript": (2.5, 0, 0, -6, -5),
    "closing": (-2.5, 0, 0, 2, -4),
    "contact": (-3.5, 0, 0, 2.5, -2),
    "greeting": (2, 0, 0, -4, -4),
    "sentence": (1.5, 0, 0, -5, -2),
    "company": (-1.5, 0, 0, 1.5, -2),
    "name": (-0.5, 0, 0, 1, -3),
    "short": (0.7, 0, 0, 0.2, -3),
    "text": (1, 0, 0, -2.5, -3),
}
#: Cost of a new segment; length scores (by number of lines) on top of it.
NEW = -1.5


def visible_lines(content: str, is_html: bool) -> list[Line]:
    """The lines with visible text: tags, styles, scripts and comments removed, entities decoded."""
    lines, space, cited, hidden, block, comment = [], False, 0, "", False, False
    for number, raw in enumerate(content.split("\n"), 1):
        t = raw
        if is_html:
            block = block or bool(re.search(r"<hr\b|<blockquote\b|class=.?(gmail_quote|sig)", t, re.I))
            before = cited
            cited += len(re.findall(r"<blockquote\b", t, re.I)) - len(re.findall(r"</blockquote", t, re.I))
            inside = max(before, cited) > 0
            if comment:
                t, comment = ("", True) if "-->" not in t else (t.split("-->", 1)[1], False)
            t = re.sub(r"<!--.*?-->", "", t)
            if "<!--" in t:
                t, comment = t.split("<!--", 1)[0], True
            if hidden:
                m = re.search(rf"</{hidden}\s*>", t, re.I)
                t, hidden = (t[m.end() :], "") if m else ("", hidden)
            t = re.sub(r"<(style|script|head|title)\b.*?</\1\s*>", " ", t, flags=re.I)
            m = re.search(r"<(style|script|title)\b", t, re.I)
            if m:
                t, hidden = t[: m.start()], m.group(1)
            t = html.unescape(re.sub(r"<[^>]*>", " ", t))
        else:
            inside = False
        t = re.sub(r"[\s ​‌‍﻿­]+", " ", t).strip()
        if not t:
            space = True
            continue
        lines.append(Line(number, t, space, inside, block))
        space = block = False
    return lines


def _bucket(line: Line) -> int:
    return zlib.crc32(re.sub(r"\d+", "9", line.text.lower()).encode()) % BUCKETS


class Taught:
    """What a first decoding of all messages taught: log-odds by bucket and state, length scores by state."""

    def __init__(self, odds: np.ndarray | None = None, lengths: np.ndarray | None = None) -> None:
        self.odds = odds
        if lengths is None:
            lengths = np.zeros((STATES, LONG + 1))
            for n in range(LONG + 1):
                lengths[SIGNATURE, n] = -0.35 * abs(min(n, SHORT) - 4)
                lengths[NOTICE, n] = -0.5 * (min(n, SHORT) - 1)
        self.lengths = lengths.tolist()


def _starts(lines: list[Line]) -> list[tuple[float, ...]]:
    """Score of a segment of each state that begins at each line."""
    found, second = [], -1
    for i, x in enumerate(lines):
        after = lines[i + 1 : i + 6]
        kinds, run = set(), 0
        for y in [x, *after]:
            if y.cue == "original" and not run:
                continue
            if y.cue not in ("header", "headline") or y.depth != x.depth or (not run and y.text.endswith(".")):
                break
            run += 1
            kinds.add(_HEADER_KIND.get(re.match(r"[*_ ]*(\w+)", y.text).group(1).lower()))
        block = len(kinds - {None}) >= 2 and (x.cue == "original" or 0 in kinds)
        if block:
            for y in [x, *after]:
                if y.cue not in ("header", "original") or y.depth != x.depth:
                    break
                y.cue = "headline" if y.cue == "header" else y.cue
        # an attribution may be broken into two lines
        both = f"{x.text} {after[0].text}" if after else ""
        pair = bool(after) and x.depth == after[0].depth and not after[0].space and len(x.text) < 90 and x.cue not in ("sentence", "closing", "greeting", "headline", "wrote") and after[0].cue != "headline" and after[0].text.endswith(":") and (_WROTE_PART.search(both.lower()) is not None or "@" in both) and _DATED.search(both) is not None
        wrote = i != second and (pair or x.cue == "wrote" or (_ATTRIBUTION.match(x.text) is not None and x.text.endswith(":") and ("<" in x.text or _DATED.search(x.text) is not None)))
        if pair:
            second = i + 1
        marked = block or (x.cue == "original" and not _RULE.match(x.text))
        quoted = 7.0 if marked or (x.cited and x.block) else (4.0 if wrote else -14.0)
        signature = {"closing": 2.5, "delimiter": 2.0, "name": -1.0, "company": -2.0, "contact": -2.0}.get(x.cue, -7.0) + (0.5 if x.space else 0)
        if x.cue == "delimiter" and not x.depth and i and not after:
            signature -= 1
        prefixed = 2.0 if x.depth else (7.0 if wrote and any(y.depth for y in lines[i + 1 : i + 4]) else -14.0)
        authored = (0.3 if x.space else 0) + (2.0 if x.cue == "postscript" else 0)
        found.append((authored, prefixed, quoted, signature, 0.3 if x.space else -0.5))
    return found


def _emissions(lines: list[Line], taught: Taught) -> np.ndarray:
    e = np.zeros((len(lines) + 1, STATES))
    for i, x in enumerate(lines):
        s = list(CUES[x.cue])
        if taught.odds is not None and not x.depth:
            s = [a + float(b) for a, b in zip(s, taught.odds[_bucket(x)])]
        s[QUOTED] += max(0.0, s[AUTHORED], s[SIGNATURE], s[NOTICE]) - 0.2
        if x.depth:
            s = [s[0] - 7, 3.0, 0.6, s[3] - 7, s[4] - 7]
        else:
            s[PREFIXED] -= 9
        if x.cited:
            s[AUTHORED] -= 5
            s[SIGNATURE] -= 5
            s[NOTICE] -= 5
        e[i + 1] = s
    return e.cumsum(0)


# From row to column; -1e9 forbids. A quote below a header runs to the end of the body or of its block.
_NEXT = [
    [-1e9, 0, 0, 0, 0],
    [0, -1e9, 0, -1.0, 0],
    [-9, -3, -1.0, -12, -6],
    [-2.5, 0, 0, -3, 0],
    [-1.5, 0, 0, -1.0, -1e9],
]


_INTO = [list(c) for c in zip(*_NEXT)]


def decode(lines: list[Line], taught: Taught) -> list[tuple[int, int, int]]:
    """Best division into segments (from, to, state)."""
    n = len(lines)
    if not n:
        return []
    starts = _starts(lines)
    e = _emissions(lines, taught).tolist()
    lengths = taught.lengths
    attribution = [0] * (n + 1)  # unprefixed lines of an attribution at the start of a prefixed quote
    for i in range(n):
        if not lines[i].depth and starts[i][PREFIXED] > 0:
            attribution[i] = next(k for k in range(1, 4) if lines[i + k].depth)
    best = [[-1e18] * STATES for _ in range(n + 1)]
    back: list[list[tuple[int, int] | None]] = [[None] * STATES for _ in range(n + 1)]
    # open_[s]: best score, less its emissions, of a segment of state s that began so long ago that its length counts no
    # more: LONG lines for signatures and notices; other segments have no length score, so any that began before
    enter = [[-1e18] * STATES for _ in range(n + 1)]
    came = [[-1] * STATES for _ in range(n + 1)]
    open_: list[tuple[float, int]] = [(-1e18, 0)] * STATES
    for j in range(n + 1):
        if j:
            for s in range(STATES):
                top, arg = -1e18, None
                es = e[j][s]
                if s < SIGNATURE:
                    i = j - 1
                    v = enter[i][s] - e[i][s] + (9.0 * attribution[i] if s == PREFIXED else 0.0)
                    if v > open_[s][0]:
                        open_[s] = (v, i)
                    if open_[s][0] > -1e17:
                        top, arg = open_[s][0] + es, open_[s][1]
                    if s == PREFIXED:
                        # an attribution that isn't over yet counts for the lines it has so far
                        i = arg if arg is not None else 0
                        if arg is not None and j - i < attribution[i]:
                            top, arg = max((enter[i][s] + es - e[i][s] + 9.0 * min(attribution[i], j - i), i) for i in range(j) if enter[i][s] > -1e17)
                else:
                    ls = lengths[s]
                    for i in range(max(0, j - LONG + 1), j):
                        v = enter[i][s] - e[i][s] + ls[j - i]
                        if s == SIGNATURE and j - i == 1 and lines[i].cue in ("name", "short", "company"):
                            v -= 2.5
                        if v > top:
                            top, arg = v, i
                    if j >= LONG:
                        i = j - LONG
                        v = enter[i][s] - e[i][s]
                        if v > open_[s][0]:
                            open_[s] = (v, i)
                        if open_[s][0] + ls[LONG] > top:
                            top, arg = open_[s][0] + ls[LONG], open_[s][1]
                    top, arg = (top + es, arg) if top > -1e17 else (-1e18, None)
                if s == QUOTED and j < n and top > -1e17:
                    # ends early only where a cited block ends
                    top += 0.0 if lines[j - 1].cited and not lines[j].cited else (-8.0 if not lines[j - 1].depth else -3.0)
                best[j][s], back[j][s] = top, (arg, s) if arg is not None else None
        if j < n:
            for s in range(STATES):
                if j == 0:
                    v, p = 0.0 if s in (AUTHORED, PREFIXED, QUOTED, NOTICE) else -3.0, -1
                else:
                    a, b, c, d, f = best[j]
                    ways = (a + _INTO[s][0], b + _INTO[s][1], c + _INTO[s][2], d + _INTO[s][3], f + _INTO[s][4])
                    v = max(ways)
                    p = 4 - ways[::-1].index(v)  # of equals the last state
                    if p == QUOTED and s == AUTHORED and lines[j - 1].cited and not lines[j].cited:
                        v += 8
                enter[j][s], came[j][s] = v + NEW + starts[j][s], p
    segments, j, s = [], n, max(range(STATES), key=lambda q: best[n][q])
    while j > 0:
        i = back[j][s][0]
        segments.append((i, j, s))
        j, s = i, came[i][s]
    return segments[::-1]


def _bodies(messages: DataFrame, key: str) -> DataFrame:
    text = F.col("body.content")
    return messages.filter(text.isNotNull() & (text != "")).select(F.col(key).alias("k"), text.alias("t"), F.coalesce(F.lower(F.col("body.contentType")) == "html", F.lit(False)).alias("h"))


def teach(messages: DataFrame, key: str = "message_no", weight: float = 0.5, most: float = 1.5) -> Taught:
    """Decodes all messages with the given weights and counts line shapes by state and segment lengths.

    What comes back is BUCKETS x states counts at most, however many messages there are.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = Taught()
        shapes, lengths = np.zeros((BUCKETS, STATES), "int64"), np.zeros((LONG + 1, STATES), "int64")
        for pdf in batches:
            for t, h in zip(pdf["t"], pdf["h"]):
                lines = visible_lines(t, h)
                for i, j, s in decode(lines, plain):
                    lengths[min(j - i, LONG), s] += 1
                    for x in lines[i:j]:
                        if not x.depth:
                            shapes[_bucket(x), s] += 1
        for kind, a in (("shape", shapes), ("length", lengths)):
            rows = np.flatnonzero(a.sum(1))
            yield pd.DataFrame({"kind": kind, "at": rows, **{f"n{s}": a[rows, s] for s in range(STATES)}})

    fields = ", ".join(f"n{s} long" for s in range(STATES))
    counted = _bodies(messages, key).mapInPandas(count, f"kind string, at long, {fields}").groupBy("kind", "at").agg(*[F.sum(f"n{s}").alias(f"n{s}") for s in range(STATES)])
    shapes, lengths = np.zeros((BUCKETS, STATES)), np.zeros((LONG + 1, STATES))
    for r in counted.toLocalIterator():
        (shapes if r["kind"] == "shape" else lengths)[r["at"]] = [r[f"n{s}"] for s in range(STATES)]
    total = shapes.sum(0) + 1
    share = (shapes + 2 * total / total.sum()) / (shapes.sum(1, keepdims=True) + 2)
    odds = np.clip(weight * np.log(share / (total / total.sum())), -most, most)
    odds[shapes.sum(1) < 5] = 0
    odds[:, PREFIXED] = 0
    odds[:, QUOTED] = 0
    ls = np.log((lengths + 0.5) / (lengths.sum(0) + 0.5 * (LONG + 1))).T
    ls -= ls.max(1, keepdims=True)
    # quotes and authored text of any length are alike; decode() relies on it
    base = np.array(Taught().lengths)
    base[SIGNATURE:] = 0.5 * base[SIGNATURE:] + 0.5 * np.maximum(ls[SIGNATURE:], -6)
    return Taught(odds, base)


def new_lines(messages: DataFrame, key: str = "message_no") -> DataFrame:
    """key, line_no, span ('authored', 'quoted', 'signature', 'notice'): one row per line with visible text.

    body.content is split at line feeds and lines count from 1. NULL and empty bodies, and those of markup only,
    give no row; messages polled twice are decoded twice; bodies of any length are read whole.
    """
    shared = messages.sparkSession.sparkContext.broadcast(teach(messages, key))
    names = np.array(["authored", "quoted", "quoted", "signature", "notice"])

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, numbers, spans = [], [], []
            for k, t, h in zip(pdf["k"], pdf["t"], pdf["h"]):
                lines = visible_lines(t, h)
                for i, j, s in decode(lines, shared.value):
                    keys += [k] * (j - i)
                    numbers += [x.number for x in lines[i:j]]
                    spans += [s] * (j - i)
            yield pd.DataFrame({"k": keys, "line_no": numbers, "span": names[spans] if spans else []}).astype({"line_no": "int64", "span": "object"})

    kind = messages.schema[key].dataType.simpleString()
    return _bodies(messages, key).mapInPandas(split, f"k {kind}, line_no long, span string").withColumnRenamed("k", key)
