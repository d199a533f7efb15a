import random

from ordermill.llm import encodings as E
from ordermill.llm.encodings import SEEN, Matcher, count_trigrams, repair_encoding

TEXTS = {
    "de": "Für die Größe der Säcke müssen wir die Kreditprüfung über das Prüfzeugnis abschließen – möchten Sie dafür „grün“ wählen?",
    "fr": "Où en est l’enlèvement prévu ? Le destinataire diffère, ça reste très urgent, n’a pas été reconnu « blanc ».",
    "pl": "Świadectwo jakości i płatność w ciągu dni, proszę wcześniej zadzwonić, zgłasza uszkodzone worki.",
    "pt": "RECEÇÃO SÓ DAS 7 ÀS 15 H. NÃO É POSSÍVEL. A condição de pagamento não está atualizada; a direção já foi avisada.",
    "ru": "Оплата в течение дней, цена за килограмм. Сертификат на партию приложен к письму, приёмка товара с утра.",
    "en": "Prices in € per kg; nozzle Ø 34 mm, Δp 49 bar, filter 40 µm, area 34 m² ├────┼────┤ grade “Â21” from the Ångdal line.",
}
WIDE = {"zh": "请尽快确认交货日期，物料编码未能匹配。", "ja": "納期の変更をお願いいたします。在庫を確認してください。", "ko": "로트 시험 성적서를 첨부합니다. 오전에 납품해 주세요."}


def seen():
    from collections import Counter

    c = Counter()
    for t in TEXTS.values():
        count_trigrams(t, c)
    return {k: n * SEEN * 4 for k, n in c.items()}


def test_right_texts_stay():
    m = Matcher(seen())
    for t in [*TEXTS.values(), *WIDE.values()]:
        assert m.restore(t) == (False, t)


def test_round_trip_through_utf8():
    m = Matcher(seen())
    for wrong in ("latin-1", "cp1252", "cp437", "cp850", "mac-roman", "cp1251"):
        for t in [*TEXTS.values(), *WIDE.values()]:
            try:
                g = t.encode().decode(wrong)
            except UnicodeDecodeError:
                continue
            garbled, back = m.restore(g)
            assert garbled and back == t, (wrong, t, back)


def test_round_trip_between_single_bytes():
    m = Matcher(seen())
    for source, wrong, lang in (("cp1252", "cp1253", "de"), ("cp1252", "cp437", "de"), ("cp1252", "mac-roman", "de"), ("cp1251", "cp1252", "ru"), ("koi8-r", "cp1251", "ru"), ("cp1250", "cp1252", "pl"), ("cp1252", "cp1251", "fr")):
        t = TEXTS[lang]
        g = t.encode(source).decode(wrong, "replace")
        garbled, back = m.restore(g)
        words = sum(a == b for a, b in zip(t.split(), back.split())) / len(t.split())
        assert garbled and words >= 0.85, (source, wrong, back)


def test_east_asian_as_western():
    m = Matcher(seen())
    for lang, source in (("zh", "gb18030"), ("ja", "euc-jp"), ("ko", "euc-kr")):
        g = WIDE[lang].encode(source).decode("latin-1")
        assert m.restore(g) == (True, WIDE[lang]), lang


def test_only_the_garbled_part_changes():
    m = Matcher(seen())
    right, part = TEXTS["en"], "Die Spedition übernimmt".encode().decode("cp1252")
    assert m.restore(f"{right}\n{part}")[1] == f"{right}\nDie Spedition übernimmt"
    twice = "für".encode().decode("cp1252").encode().decode("cp1252")
    assert m.restore(f"x {twice} y") == (True, "x für y")


def test_lost_and_controls():
    m = Matcher({})
    assert m.restore("diff�re")[0] and m.restore("a\x96b")[0] and not m.restore("plain")[0] and not m.restore("")[0]


def test_operator(spark):
    rng = random.Random(1)
    rows = [(i, TEXTS[rng.choice(list(TEXTS))], "x") for i in range(200)] + [(1000, TEXTS["de"].encode().decode("cp1252"), "x"), (1001, None, "x"), (1002, "", None), (1003, "w�rd", "x"), (1003, "w�rd", "x"), (1004, "ü" * 60000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, restored string")
    got = sorted((r["doc_id"], r["restored"]) for r in repair_encoding(df).collect())
    assert got == [(1000, True), (1003, False), (1003, False)]
    assert repair_encoding(df.limit(0)).count() == 0


def test_frequent_garbling_is_found(spark):
    """Copies of one garbled text, and a quarter of all texts garbled alike, hide nothing."""
    rng = random.Random(3)
    for lang, source, wrong in (("ru", "koi8-r", "cp1251"), ("de", "cp1252", "mac-roman")):
        words = TEXTS[lang].split()
        texts = [" ".join(rng.sample(words, len(words))) for _ in range(120)]
        bad = [t.encode(source, "replace").decode(wrong, "replace") for t in texts[:30]]
        rows = list(enumerate(texts[30:])) + [(1000 + i, b) for i, b in enumerate(bad)] + [(2000 + i, bad[0]) for i in range(300)]
        got = {r["doc_id"] for r in repair_encoding(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {i for i, _ in rows if i >= 1000}, lang


def test_scripts_in_runs_and_layers():
    """Hebrew, Arabic, Hindi and Thai in UTF-8 read as a Western encoding; a text garbled five times; signs alone."""
    m = E.Matcher({})
    for right in ("הזמנה דחופה", "طلب عاجل جدا", "तत्काल आदेश", "คำสั่งซื้อด่วน"):
        for wrong in ("cp1252", "latin-1"):
            table = E._decoded(wrong)
            garbled = "Order 7: " + "".join(table[b] for b in right.encode()) + " end"
            assert m.restore(garbled) == (True, f"Order 7: {right} end")
    for right in ("25 ×\xa010 cm", "Ø\xa025 mm", "plain", "הזמנה דחופה", "3 ×\xa04, Ø\xa05"):
        assert m.restore(right) == (False, right)
    text = "Grüße aus Köln"
    for _ in range(5):
        text = "".join(E._decoded("cp1252")[b] for b in text.encode())
    assert m.restore(text) == (True, "Grüße aus Köln")
