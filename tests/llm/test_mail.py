from ordermill.llm.mail import Taught, decode, new_lines, visible_lines

BODIES = [
    ("text", "Hi all,\n\nThe price should read 2.45 per kg.\nRegards to the colleagues in planning, they did a great job.\n\nKind regards,\nJohn Miller\nPurchasing\nPhone +49 123 456 789", {1, 3, 4}),
    ("text", "Guten Tag,\n\nbitte den Termin bestätigen.\n\n-- \nAnna Berg\nTel. +49 55 1234567\n\nVon: Max Holz <m.holz@a.example>\nGesendet: 2024-03-01 10:00\nAn: Anna Berg\nBetreff: AW: 123\n\nLiebe Kollegen,\nDie Menge ist falsch.\nViele Grüße\nMax", {1, 3}),
    ("text", "On 2024-01-02 10:00, John wrote:\n> Dear team,\n> please split the shipment.\n>\n> BR\n> John\n\nYes, we can do that next week.\n\nBest regards\nEve Stone", {8}),
    ("text", "Dear team,\n\nFrom: week 9 on we can unload only before noon.\n-- urgent -- the line stops on 9.9 without this material.\n\nBR\nJoe\n\nP.S. We need 24 t by Monday.\n\nThis e-mail and any attachment are confidential. If you are not the intended recipient, please delete it.", {1, 3, 4, 9}),
    ("html", "<html><head><style>\np{margin:0}\n</style></head><body>\n<div>Bonjour,</div>\n<div>&nbsp;</div>\n<div>Merci de joindre le certificat.</div>\n<div class=\"sig\">\n<div>Cordialement</div>\n<div>Paul Petit</div>\n</div>\n<blockquote type=\"cite\">\n<div>De: Eve</div>\n<div>Envoy&eacute;: 23/06/2024</div>\n<div>Objet: x</div>\n<div>Ancien texte de la commande.</div>\n</blockquote>\n</body></html>", {4, 6}),
    ("text", "fyi\r\n\r\n-----Original Message-----\r\nFrom: A <a@b.example>\r\nSent: 01.02.2024\r\nSubject: x\r\n\r\nOld words of somebody else.\r\n", {1}),
]


def authored(kind, body):
    lines = visible_lines(body, kind == "html")
    return {x.number for i, j, s in decode(lines, Taught()) if s == 0 for x in lines[i:j]}


def test_bodies():
    for kind, body, want in BODIES:
        assert authored(kind, body) == want, body


def test_decoding_is_the_best_division():
    """Against all divisions of short bodies, with the same scores."""
    import itertools

    from ordermill.llm import mail

    lines = visible_lines("Hi all,\nPlease send it.\nBest regards\nJoe Doe", False)
    e, starts, lengths = mail._emissions(lines, Taught()), mail._starts(lines), Taught().lengths

    def score(segments):
        total, before = 0.0, None
        for i, j, s in segments:
            enter = (0.0 if s in (0, 1, 2, 4) else -3.0) if before is None else mail._NEXT[before][s]
            total += enter + mail.NEW + starts[i][s] + e[j][s] - e[i][s] + lengths[s][j - i]
            if s == mail.SIGNATURE and j - i == 1 and lines[i].cue in ("name", "short", "company"):
                total -= 2.5
            if s == mail.QUOTED and j < len(lines):
                total -= 8.0
            before = s
        return total

    best = max((score(list(zip([0, *cuts], [*cuts, 4], states))) for k in range(4) for cuts in itertools.combinations((1, 2, 3), k) for states in itertools.product(range(5), repeat=k + 1)))
    assert abs(score(decode(lines, Taught())) - best) < 1e-9


def test_long_body():
    body = "\n".join(["We need the goods by Monday."] * 3000)
    assert len(authored("text", body)) == 3000


def test_operator(spark):
    rows = [(i, (k, b)) for i, (k, b, _) in enumerate(BODIES)] + [(100, ("text", None)), (101, ("html", "<p></p>\n<br>")), (102, None), (0, BODIES[0][:2])]
    df = spark.createDataFrame(rows, "message_no long, body struct<contentType string, content string>").selectExpr("*", "'x' as span", "1 as line_no")
    got = [(r["message_no"], r["line_no"]) for r in new_lines(df).filter("span = 'authored'").collect()]
    for i, (_, _, want) in enumerate(BODIES):
        assert {n for k, n in got if k == i} == want
    assert sum(k == 0 for k, _ in got) == 2 * len(BODIES[0][2]) and not {100, 101, 102} & {k for k, _ in got}
    assert new_lines(df.limit(0)).count() == 0


def test_long_notices_and_signatures():
    """Legal text and signatures of any number of lines stay one kind of span."""
    from ordermill.llm import mail

    legal = "This e-mail is confidential and intended only for the intended recipient of it, number {0}."
    for n in (1, 5, 14, 15, 20, 40, 90):
        body = "Hi all,\nPlease send the goods by Monday.\n\nKind regards,\nJoe Doe\n\n" + "\n".join(legal.format(i) for i in range(n))
        lines = visible_lines(body, False)
        kinds = [s for i, j, s in decode(lines, Taught()) for _ in lines[i:j]]
        assert kinds == [mail.AUTHORED] * 2 + [mail.SIGNATURE] * 2 + [mail.NOTICE] * n, n
    for n in (3, 13, 14, 20, 60):
        body = "Hi all,\nPlease send the goods by Monday.\n\nKind regards,\nJoe Doe\n" + "\n".join(f"Tel. +49 123 45{i:04d}" for i in range(n))
        assert authored("text", body) == {1, 2}, n


def test_division_against_all_segments():
    """decode() against plain dynamic programming over all segments of any length, on random mixtures of lines."""
    import random

    from ordermill.llm import mail

    rng = random.Random(3)
    pool = ["Hi all,", "Please send it.", "Kind regards,", "Joe Doe", "ACME GmbH", "Tel. +49 123 456789", "> old words", "On 2024-01-02 10:00, John wrote:", "From: A <a@b.example>", "Sent: 01.02.2024", "This e-mail is confidential and for you.", "P.S. We need it now.", "-- ", "short one"]
    for _ in range(60):
        body = "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 45)))
        lines = visible_lines(body, False)
        got = decode(lines, Taught())
        e, starts, lengths, n = mail._emissions(lines, Taught()), mail._starts(lines), Taught().lengths, len(lines)
        mark = [next(k for k in range(1, 4) if lines[i + k].depth) if not lines[i].depth and starts[i][mail.PREFIXED] > 0 else 0 for i in range(n)]

        def piece(i, j, s):
            v = mail.NEW + starts[i][s] + e[j][s] - e[i][s] + lengths[s][min(j - i, mail.LONG)]
            v += 9.0 * min(mark[i], j - i) if s == mail.PREFIXED else -2.5 if s == mail.SIGNATURE and j - i == 1 and lines[i].cue in ("name", "short", "company") else 0.0
            return v + ((-8.0 if not lines[j - 1].depth else -3.0) if s == mail.QUOTED and j < n else 0.0)

        best = [[-1e18] * 5 for _ in range(n + 1)]
        for j in range(1, n + 1):
            for s in range(5):
                best[j][s] = max(piece(i, j, s) + ((-3.0 if s == mail.SIGNATURE else 0.0) if not i else max(best[i][q] + mail._NEXT[q][s] for q in range(5))) for i in range(j))
        total, before = 0.0, None
        for i, j, s in got:
            total += piece(i, j, s) + ((-3.0 if s == mail.SIGNATURE else 0.0) if before is None else mail._NEXT[before][s])
            before = s
        assert abs(total - max(best[n])) < 1e-6, body
