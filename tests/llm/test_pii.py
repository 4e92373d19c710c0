import hashlib
import random
import re

import pytest
from airlake.llm import pii
from airlake.llm.queries import QUERIES
from llm_helpers import SF_SMALL, make_docs
from pyspark.sql import functions as F

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = {}
    for kind, pattern in BASE.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out[kind].append((m.start(), m.end()))
    return out


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k in BASE for a, b in spans[k]).encode()).hexdigest()


def check(rows, got):
    assert len(rows) == len(got)
    expected = sorted((i or 0, *(len(brute(t)[k]) for k in BASE), digest(brute(t))) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == expected


def test_base_spans_against_brute_force(spark):
    rng = random.Random(3)
    bits = ["a", "b.c", "@", "x@y.z", ".", "_", "-", " ", "1", "22", "255", "256.1", "1.2.3.4", "007", "4111111111111111", "4111 1111 1111 1111", "+1 (523) 555-1055", "+", "(", ")", "😀é", "\n", "%"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(1500)]
    rows += [(None, None), (7, ""), (8, "a" * 3000), (9, "1" * 3000 + "."), (10, "1." * 3000), (11, "a@" + "b." * 3000 + "c"), (12, "+" * 3000 + "1 " * 3000), (3, "dup 1.2.3.4"), (3, "dup 1.2.3.4")]
    df = make_docs(spark, rows).withColumns({"body": F.lit("x"), "key": F.lit(1), "email": F.lit(2), "added": F.lit(3)})
    check(rows, pii.report(pii.detect(df), ["doc_id"]).collect())


def test_very_long_runs_stay_linear(spark):
    n = 20_000
    rows = [(1, "a" * n + "@"), (2, "1" * n + "."), (3, "a@" + "b." * n + "c"), (4, "+" * n + "1 " * n), (5, "1.2.3.4 " * 2000)]
    got = {r.doc_id: r for r in pii.report(pii.detect(make_docs(spark, rows)), ["doc_id"]).collect()}
    assert [(got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) for i in range(1, 6)] == [(0, 0, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0), (0, 0, 0, 0), (0, 2000, 0, 0)]


def test_contexts_discover_unseen_values(spark):
    rng = random.Random(1)
    # cards follow "konto"; one number there fails the Luhn test, and one elsewhere does too
    bad = "4111111111111112"
    good = []
    while len(good) < 30:
        n = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        good += [n] * luhn(n)
    rows = [(i, f"prose {i % 7} konto {n} ende") for i, n in enumerate(good)] + [(100, f"😀 konto {bad}, ende"), (101, f"serial {bad[:-1]}3 made")]
    out = {r.doc_id: r for r in pii.report(pii.detect(make_docs(spark, rows)), ["doc_id"]).collect()}
    assert out[100].spans == "card:8:24" and out[100].n_added == 1 and out[100].n_card == 0
    assert out[101].spans == ""
    assert out[0].spans == "card:14:30"
    done = {r.doc_id: r for r in pii.redact(make_docs(spark, rows)).collect()}
    assert done[100].text == "😀 konto [CARD], ende" and done[0].text == "prose 0 konto [CARD] ende" and done[101].text == rows[-1][1]


def test_contexts_discover_unseen_forms(spark):
    # numbers after "rufe" and addresses after "mail" are seeds; the other forms match no base pattern
    rows = [(i, f"word{'abc'[i % 3]} rufe +1-555-{200 + i}-{1000 + 7 * i} bitte an") for i in range(60)]
    rows += [(100 + i, f"so mail n{chr(97 + i % 26)}{i}@host{i % 5}.org {'now later soon'.split()[i % 3]} ok") for i in range(60)]
    rows += [(200 + i, f"the year {1900 + i} was long") for i in range(40)]
    rows += [(300, "then rufe 555-523-1055 morgen an"), (301, "so mail name[at]host now ok"), (302, "room 555-523-1056 is free"), (303, "call f(x) or list[int] now")]
    # an ip with more digits in its groups than any seed before the same word
    rows += [(400 + i, f"node 10.{i}.1.2 up") for i in range(10)] + [(450, "node 1000.1.1.2 up")]
    out = {r.doc_id: r for r in pii.report(pii.detect(make_docs(spark, rows)), ["doc_id"]).collect()}
    assert out[300].spans == "phone:10:22" and out[301].spans == "email:8:20" and out[450].spans == "ip:5:15"
    assert out[302].spans == out[303].spans == "" and all(out[200 + i].spans == "" for i in range(40))


def test_a_long_neighbour_counts_whole(spark):
    rng = random.Random(2)
    good = []
    while len(good) < 30:
        n = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        good += [n] * luhn(n)
    bad, long = "4111111111111112", "k" * 60
    rows = [(i, f"{long}\n{n} w{chr(97 + i % 26)}x") for i, n in enumerate(good)]
    # only the first or the last letter of the neighbour differs; an unseen number follows each
    rows += [(100, f"{long} \t {bad}"), (101, f"z{long[1:]} {bad[:-1]}3"), (102, f"{long[1:]}z {bad[:-1]}4"), (103, f"{bad[:-1]}5 {long}")]
    out = {r.doc_id: r for r in pii.report(pii.detect(make_docs(spark, rows)), ["doc_id"]).collect()}
    assert out[100].spans == "card:63:79"
    assert out[101].spans == out[102].spans == out[103].spans == ""


def test_rounds_pass_from_one_form_to_another(spark):
    # the new form is learned beside seeds, and then found after a word that no seed follows
    rows = [(i, f"rufe +1-555-{200 + i}-{1000 + 7 * i} an") for i in range(150)]
    rows += [(200 + i, f"rufe 555/{200 + i}/77 an") for i in range(12)] + [(300 + i, f"fax 555/{200 + i}/77 ab") for i in range(12)]
    rows += [(400, "fax 555/999/77 ab")]
    out = {r.doc_id: r for r in pii.report(pii.detect(make_docs(spark, rows)), ["doc_id"]).collect()}
    assert out[200].spans == "phone:5:15" and out[300].spans == "phone:4:14" and out[400].spans == "phone:4:14"


def test_redaction_and_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.de now, +1 (523) 555-1055 or 1.2.3.4!"), (3, "mail a.b@c.de now, +1 (523) 555-1055 or 1.2.3.4!"), (5, "+4111111111111111 x"), (6, "clean text")]
    df = make_docs(spark, rows)
    out = pii.redact(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id, r.text or "") for r in out.collect())
    assert got == [(1, ""), (2, ""), (3, "mail [EMAIL] now, [PHONE] or [IP]!"), (3, "mail [EMAIL] now, [PHONE] or [IP]!"), (5, "+[CARD] x"), (6, "clean text")]
    assert pii.redact(make_docs(spark, [])).count() == 0
    many = "".join(f"é{i} a{i}@b.cd, {'x' * (i % 50 * 20)}1.2.3.{i % 250}" for i in range(1500))
    expected = re.sub(BASE["email"], "[EMAIL]", many)
    expected = re.sub(BASE["ip"], lambda m: "[IP]" if int(m.group().split(".")[-1]) <= 255 else m.group(), expected)
    assert pii.redact(make_docs(spark, [(1, many)])).first().text == expected


@pytest.mark.parametrize("sf_dir", [SF_SMALL])
def test_query_base_spans(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op2_pii"](spark, sf_dir).collect())
