"""Personal data: base spans by brute force, the estimate against a plain one."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from airtrace.llm import pii
from airtrace.llm.pii import KINDS, LABELERS, candidates, estimate, find_personal_data, listing, matches
from tests.llm.helpers import documents, rows, with_clashes

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def good(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    text = text or ""
    return ",".join(f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PATTERNS.items()
                    for m in re.finditer(pattern, text) if good(kind, m.group()))


def found(docs, **options):
    spans = find_personal_data(docs, **options)
    return spans.selectExpr("doc_id", f"{listing('filter(spans, s -> s.base)')} AS base",
                            f"{listing('filter(spans, s -> not s.base)')} AS added")


ODD = [
    None, "", " ", "no data here", "a@b.c", "mail a.b+c@d-e.example.com, x@y", "é@x.yz ü a@b.com_c@d.ef@g.hi",
    "a@b.com.@c.de", "@x.y a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.00.1 99999999999999999999999999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111 1111 1111 1111 4012888888881881", "0000000000000", "+1 (683) 555-0093 +49 30 1234567 +1 2",
    "+12345678 +123456789 +1 234 567 890 123 456", "🙂🙂 a@b.co 🙂 10.0.0.1 ß +33 1 23 45 67 89.", "1-2 3-4", "+", "x" * 500 + "@", "٤١١١ ٣",
    "4" * 16 + "\n" + "5105105105105100\t378282246310005",
]


def test_base_spans_equal_brute_force(spark):
    docs = documents(spark, ODD)
    got = {r["doc_id"]: r["base"] for r in found(docs).collect()}
    assert got == {i: base(t) for i, t in enumerate(ODD)}


def test_base_spans_of_random_texts(spark):
    rng = random.Random(7)
    alphabet = ["@", ".", "a", "b-", "1", "23", "+", " ", "(", ")", "-", "4111111111111111", "10.0.0.1", "é", "🙂", "\n", "x@y.zz"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(600)]
    got = {r["doc_id"]: r["base"] for r in found(documents(spark, texts)).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_long_texts_take_linear_time(spark):
    """Long runs that a backtracking search would take for ever on, and many matches."""
    long = ["a" * 400_000, "a" * 200_000 + "@" + "b" * 200_000, "9" * 400_000, "1." * 150_000, "+1" + " " * 300_000,
            "x" + ".y" * 50_000 + "@z" + ".w" * 50_000, "a@b.cd " * 20_000]
    got = {r["doc_id"]: r["base"] for r in found(documents(spark, long)).collect()}
    assert got[0] == got[1] == got[2] == got[4] == ""
    assert got[3].count("ip:") == 37_500
    assert got[5] == f"email:0:{len(long[5])}"
    assert got[6] == ",".join(f"email:{7 * i}:{7 * i + 6}" for i in range(20_000))


def corpus():
    """Cards and phone numbers among decoys; some base matches hide two spans."""
    rng = random.Random(5)

    def card():
        body = "4" + "".join(rng.choices("0123456789", k=14))
        return next(body + d for d in "0123456789" if luhn(body + d))

    texts, hidden = [], []
    for i in range(300):
        words = " ".join(rng.choices("some words of plain prose without any meaning".split(), k=6))
        kind = i % 6
        if kind == 0:
            texts.append(f"{words} {card()} {words}")
        elif kind == 1:
            texts.append(f"{words} {''.join(rng.choices('0123456789', k=rng.choice([8, 11, 20])))} {words}")
        elif kind == 2:
            texts.append(f"{words} +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} {words}")
        elif kind == 3:
            texts.append(f"{words} user{i}@mail.example.com {words}")
        elif kind == 4:
            texts.append(f"{words} {rng.randint(1, 9)} {words}")
        else:
            texts.append(f"{words} 10.{i % 256}.7.9 {words}")
    for i in range(6):
        text = f"plain prose {card()} {card()} without"
        hidden.append((len(texts), text))
        texts.append(text)
    return texts, hidden


def test_adds_what_base_matches_hide(spark):
    texts, hidden = corpus()
    got = {r["doc_id"]: r for r in found(documents(spark, texts)).collect()}
    for key, text in hidden:
        at = text.index("4")
        assert got[key]["base"] == base(text)
        if not base(text):  # the run of both is no card
            assert got[key]["added"] == f"card:{at}:{at + 16},card:{at + 17}:{at + 33}"
    clean = [i for i in range(300) if i % 6 in (1, 4)]
    assert all(got[i]["added"] == "" for i in clean)


def plain_estimate(patterns, steps):
    """The same expectation-maximisation, candidate by candidate."""
    kinds, n = range(len(KINDS)), len(LABELERS)
    guess = {-1: (0.1, 0.6), 0: (0.3, 0.3), 1: (0.6, 0.1)}
    table = {(k, i, v): guess[v] for k in kinds for i in range(n) for v in guess}
    prior = {k: 0.5 for k in kinds}
    for _ in range(steps):
        t = dict.fromkeys(table, 0.0)
        f = dict.fromkeys(table, 0.0)
        for kind, votes, count in patterns:
            a, b = prior[kind], 1 - prior[kind]
            for i, v in enumerate(votes):
                a, b = a * table[kind, i, v][0], b * table[kind, i, v][1]
            for i, v in enumerate(votes):
                t[kind, i, v] += count * a / (a + b)
                f[kind, i, v] += count * b / (a + b)
        for k in kinds:
            for i in range(n):
                true, false = (sum(side[k, i, v] for v in guess) + 1.5 for side in (t, f))
                for v in guess:
                    table[k, i, v] = ((t[k, i, v] + 0.5) / true, (f[k, i, v] + 0.5) / false)
            prior[k] = true / (true + false)
    return prior, table


def test_estimate_equals_plain_form(spark):
    rng = random.Random(3)
    patterns = {}
    for _ in range(400):
        truth = rng.random() < 0.3
        votes = tuple(rng.choices((1, 0, -1) if truth else (-1, 0, 1), (0.7 - 0.05 * i, 0.2, 0.1 + 0.05 * i))[0]
                      for i in range(len(LABELERS)))
        key = (rng.randrange(len(KINDS)), votes)
        patterns[key] = patterns.get(key, 0) + 1
    given = [(k, list(v), n) for (k, v), n in patterns.items()]
    frame = spark.createDataFrame(given, "kind int, votes array<int>, n long")
    got = estimate(frame, steps=4)
    prior, table = plain_estimate(given, 4)
    assert got.prior == pytest.approx([prior[k] for k in range(len(KINDS))])
    for key, pair in table.items():
        assert got.votes[key] == pytest.approx(pair)
    # reliable labelers come out as such
    assert all(got.votes[k, 0, 1][0] > got.votes[k, 0, 1][1] for k in range(len(KINDS)))
    first = frame.withColumn("p", got.posterior()).first()
    a, b = prior[first["kind"]], 1 - prior[first["kind"]]
    for i, v in enumerate(first["votes"]):
        a, b = a * table[first["kind"], i, v][0], b * table[first["kind"], i, v][1]
    assert first["p"] == pytest.approx(a / (a + b))
    assert math.isfinite(first["p"])


def test_native_plan_and_one_shuffle_of_matches(spark):
    docs = documents(spark, ODD)
    spans = candidates(matches(docs, "doc_id", "text"))
    plan = find_personal_data(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert spans.where(F.col("touches") & ~F.col("base")).count() > 0


def test_repeated_null_empty_and_clashing(spark):
    texts = ["a@b.cd", "a@b.cd", None, "x 10.0.0.1", "x 10.0.0.1"]
    ids = [1, 1, None, None, 2]
    docs = documents(spark, texts, ids)
    got = rows(found(docs))
    assert got == sorted([(1, "email:0:6", ""), (1, "email:0:6", ""), (None, "", ""), (None, "ip:2:10", ""),
                          (2, "ip:2:10", "")], key=repr)
    clashing = with_clashes(docs).selectExpr("*", "1 AS kind", "2 AS spans", "3 AS pos", "4 AS hit")
    assert rows(found(clashing)) == got
    assert found(documents(spark, [])).collect() == []
    assert rows(found(documents(spark, ["nothing", None]))) == [(0, "", ""), (1, "", "")]


def test_luhn_and_parts(spark):
    cards = ["4111111111111111", "4111111111111112", "378282246310005", "6011000990139424", "1" * 13, "1" * 20]
    got = spark.createDataFrame([(2, c) for c in cards], "kind int, hit string").withColumn("digits", F.col("hit"))
    assert [r[0] for r in got.select(pii._passes()).collect()] == [good("card", c) for c in cards]
