import hashlib
import re

from pyspark.sql import functions as F

from tradewell.llm.common import table
from tradewell.llm.pii import find_personal_data, sanitise
from tradewell.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def spans(r, col="base"):
    return [(s.kind, s.start, s.end) for s in r[col]]


def test_query_base_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op5_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    some = 0
    for r in rows:
        b = base(texts[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in b)
        some += bool(b)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in b) for k in ("email", "ip", "card", "phone")]
        assert r.spans.startswith(text)
    assert some > 20


HARD = ["a@b.c_d@e.f", "x a@b.c.@d.e é 🙂 q@w.e", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.04 9999999999999.1.1.1", "@", "a@b", "%@x.y-",
        "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111", "+49 (30) 1234-567. +1 2 +1234567890123456 +12345678",
        "1" * 30_000, "12 " * 20_000, "a" * 60_000 + "@x", "a.b" * 20_000 + "@c.d", "1.2" * 5_000, "+1" + "(" * 9000, "🙂" * 50 + "z@z.zz"]


def test_odd_texts(spark):
    rows = [(i if i else None, t, "x") for i, t in enumerate(HARD + [None, "", "k@k.kk", "k@k.kk"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = {r.doc_id: r for r in find_personal_data(df).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert spans(got[i]) == base(t), t and t[:40]
    assert find_personal_data(df.limit(0)).count() == 0


def test_disclosing_terms(spark):
    fill = [f"filler{i} the plain words here of text number{i}" for i in range(80)]
    texts = [f"alpha{i} Zorblax, {w} ann@x.org beta{i} here" for i, w in enumerate(["wrote", "sent", "mailed", "asked"])]
    texts += ["About ZORBLAX (zorblaxian) alone", "zorblax the plain words"] + fill
    texts += ["copied Quuxy text bob@x.org stays the same"] * 9  # one context only: no support
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in find_personal_data(df).collect()}
    assert [texts[0][s.start:s.end] for s in rows[0].spans] == ["ann@x.org", "Zorblax"]
    assert [texts[4][s.start:s.end] for s in rows[4].spans] == ["ZORBLAX"]
    assert all(not r.spans for i, r in rows.items() if 6 <= i < 6 + len(fill))
    assert [len(rows[i].spans) for i in range(6 + len(fill), len(texts))] == [1] * 9
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert clean[0] == "alpha0 [TERM], wrote [EMAIL] beta0 here" and clean[6] == texts[6]


def test_native_plan(spark):
    plan = find_personal_data(table(spark, "/root/testdata/sf0.001", "documents")).select(F.size("spans"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text
