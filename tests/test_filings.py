"""Form 4 parsing + combining (P5-P9, F6-F8, R7-R9, A1), on hand-written
submissions and as properties on derived data."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tradewell.operators.combine import combine_transactions
from tradewell.operators.filings import parse_filings

HEADER = ["x_flag", "filing_ts", "ticker", "insider_name", "title"]


def tx(date, code, shares, price, ad, tag="nonDerivativeTransaction"):
    d = f"<transactionDate><value>{date}</value></transactionDate>" if date is not None else ""
    c = f"<transactionCoding><transactionCode>{code}</transactionCode></transactionCoding>" if code is not None else ""
    p = f"<value>{price}</value>" if price is not None else '<footnoteId id="F1"/>'
    return (f"<{tag}>{d}{c}<transactionAmounts><transactionShares><value>{shares}</value></transactionShares>"
            f"<transactionPricePerShare>{p}</transactionPricePerShare>"
            f"<transactionAcquiredDisposedCode><value>{ad}</value></transactionAcquiredDisposedCode>"
            f"</transactionAmounts></{tag}>")


def doc(txs, deriv=None, owners=None, remarks="Chief Example Officer", accept="20240105163012",
        ticker="AAPL", rel=None):
    owners = owners or ["MCDONALD-SMITH ANN"]
    rel = rel if rel is not None else ("<isDirector>1</isDirector><isOfficer>true</isOfficer>"
                                       "<officerTitle>See Remarks</officerTitle>")
    own = "".join(f"<reportingOwner><reportingOwnerId><rptOwnerName>{o}</rptOwnerName></reportingOwnerId>"
                  f"<reportingOwnerRelationship>{rel}</reportingOwnerRelationship></reportingOwner>" for o in owners)
    dtab = "" if deriv is None else f"<derivativeTable>{deriv}</derivativeTable>"
    acc = f"<ACCEPTANCE-DATETIME>{accept}\n" if accept else ""
    tick = f"<issuer><issuerTradingSymbol>{ticker}</issuerTradingSymbol></issuer>" if ticker else ""
    rem = f"<remarks>{remarks}</remarks>" if remarks is not None else ""
    return (f"{acc}<XML>\n<?xml version=\"1.0\"?>\n<ownershipDocument>{tick}{own}"
            f"<nonDerivativeTable>{''.join(txs)}</nonDerivativeTable>{dtab}{rem}</ownershipDocument>\n</XML>")


EXAMPLE = [tx("2024-01-03", "S", "100", "10.00", "D"), tx("2023-12-01", "S", "300", "12.00", "D")]


def run(spark, docs, by_date=False):
    df = spark.createDataFrame([(f"acc-{i}", b) for i, b in enumerate(docs)], "accession string, body string")
    t, rej = parse_filings(df)
    out = combine_transactions(t, by_date=by_date, header_cols=HEADER)
    return out, rej


def test_example_combined(spark):
    out, rej = run(spark, [doc(EXAMPLE)])
    rows = out.collect()
    assert rej.count() == 0 and len(rows) == 1
    r = rows[0]
    assert (r.x_flag, r.filing_ts, r.trade_date, r.ticker, r.insider_name, r.title, r.trade_type) == (
        "M", dt.datetime(2024, 1, 5, 16, 30, 12), dt.date(2023, 12, 1), "AAPL", "McDonald-smith Ann",
        "Chief Example Officer, Director", "S - Sale")
    assert (r.price, r.qty, r.value, r.accession) == (11.5, -400, 4600.0, "acc-0")


def test_example_by_date(spark):
    out, _ = run(spark, [doc(EXAMPLE)], by_date=True)
    rows = sorted(out.collect(), key=lambda r: r.trade_date)
    assert [(r.x_flag, r.qty, r.price, r.value) for r in rows] == [("", -300, 12.0, 3600.0), ("", -100, 10.0, 1000.0)]


def test_edge_cases(spark):
    docs = [
        doc([tx("2024-01-03", "P", "100", None, "A")]),                      # footnote price -> 0.0
        doc([tx("2024-01-03", "P", "12.5", "5", "A")]),                      # shares 12.5 -> 0
        doc([tx(None, "P", "10", "5", "A"), tx("2024-01-04", "P", "10", "5", "A")]),  # one tx rejected
        doc([tx("2024-01-03", "P", "10", "5", "A")], deriv=""),              # empty derivative table -> D
        doc([tx("2024-01-03", "P", "10", "5", "A")], owners=["FIRST ONE", "SECOND TWO"]),
        "<ACCEPTANCE-DATETIME>20240105163012\n<XML><ownershipDocument><issuer>",  # malformed
        doc([tx("2024-01-03", "Z", "10", "5", "A")]),                        # unknown code
        doc([tx("2024-01-03", "S", "10", "5", "A"), tx("2024-01-03", "S", "10", "7", "A"),
             tx("2024-01-03", "S", "20", "7", "D")]),
        doc([tx("2024-01-03", "P", "10", "5", "D"), tx("2024-01-04", "P", "10", "5", "A")]),
        doc([tx("2024-01-03", "P", "10", "5", "A")], accept=None),           # no acceptance time
        doc([tx("2024-01-03", "P", "10", "5", "A")], ticker=None),           # no issuer symbol
        doc([tx("2024-01-03", "P", "10", "5", "A")], rel="<isOfficer>1</isOfficer><officerTitle/>"),
        doc([tx("2024-01-03", "P", "10", "5", "A")], rel="<isOfficer>1</isOfficer><officerTitle>See Remarks</officerTitle>",
            remarks=""),
        doc([]),                                                             # no transactions: nothing
        doc([tx("2024-01-03", None, "10", "5", "A")]),                       # no code: rejected
        doc([tx("2024-01-03", "M", "10", "5", "A")], deriv=tx("2024-01-02", "M", "5", "1", "A", "derivativeTransaction")),
    ]
    out, rej = run(spark, docs)
    by = {}
    for r in out.collect():
        by.setdefault(r.accession, []).append(r)
    assert by["acc-0"][0].price == 0.0 and by["acc-0"][0].value == 0.0
    assert by["acc-1"][0].qty == 0 and by["acc-1"][0].price == 0.0
    assert by["acc-2"][0].trade_date == dt.date(2024, 1, 4) and by["acc-2"][0].x_flag == ""
    assert by["acc-3"][0].x_flag == "D"
    assert by["acc-4"][0].insider_name == "First One"
    assert by["acc-6"][0].trade_type == "Z - Unknown"
    s = sorted(by["acc-7"], key=lambda r: r.qty)
    assert [(r.qty, r.price, r.value, r.x_flag) for r in s] == [(-20, 7.0, 140.0, ""), (20, 6.0, 120.0, "M")]
    s = sorted(by["acc-8"], key=lambda r: r.qty)
    assert [(r.qty, r.x_flag) for r in s] == [(-10, ""), (10, "")]
    assert by["acc-15"][0].x_flag == "DM" and by["acc-15"][0].qty == 15
    assert by["acc-15"][0].trade_date == dt.date(2024, 1, 2)
    for a in ["acc-5", "acc-9", "acc-10", "acc-11", "acc-12", "acc-13", "acc-14"]:
        assert a not in by
    reasons = {(r.accession, r.reject) for r in rej.collect()}
    assert reasons == {("acc-2", "missing trade date"), ("acc-5", "malformed XML"),
                       ("acc-9", "missing acceptance time"), ("acc-10", "missing issuer symbol"),
                       ("acc-11", "empty officer title or remarks"), ("acc-12", "empty officer title or remarks"),
                       ("acc-14", "missing transaction code")}


def test_zero_total_qty_price_zero(spark):
    out, _ = run(spark, [doc([tx("2024-01-03", "S", "10", "5", "A"), tx("2024-01-03", "S", "10", "9", "A")])])
    # same A/D code; build a zero sum with an explicit negative share count
    out2, _ = run(spark, [doc([tx("2024-01-03", "S", "10", "5", "A"), tx("2024-01-03", "S", "-10", "9", "A")])])
    r = out2.collect()[0]
    assert (r.qty, r.price, r.value) == (0, 0.0, 140.0)


def test_combine_preserves_sums_and_order(spark):
    """Property: per filing, Σqty and Σ(price·|qty|) are preserved, and the
    result does not depend on input order."""
    rnd = random.Random(7)
    rows = [(f"a{rnd.randint(0, 20)}", "", rnd.choice(["P - Purchase", "S - Sale"]), rnd.choice(["A", "D"]),
             dt.date(2024, 1, rnd.randint(1, 28)), round(rnd.uniform(1, 500), 2), rnd.randint(-500, 500))
            for _ in range(600)]
    schema = "accession string, x_flag string, trade_type string, a_d string, trade_date date, price double, qty bigint"
    df = spark.createDataFrame(rows, schema)
    shuffled = spark.createDataFrame(rnd.sample(rows, len(rows)), schema).repartition(5)
    a = combine_transactions(df, header_cols=["x_flag"])
    b = combine_transactions(shuffled, header_cols=["x_flag"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    got = {r.accession: r.q for r in a.groupBy("accession").agg(F.sum("qty").alias("q")).collect()}
    want = {}
    for r in rows:
        want[r[0]] = want.get(r[0], 0) + r[6]
    assert got == want


def test_wall_clock_survives_dst_session_zone(spark):
    """A filing accepted at 02:07 on a spring-forward day stays 02:07 even if
    the session time zone skips that hour."""
    from tradewell.functions.scalars import coerce_ts, py_ts_text, wall_text
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        out, _ = run(spark, [doc(EXAMPLE, accept="19960407020726")])
        assert out.collect()[0].filing_ts == dt.datetime(1996, 4, 7, 2, 7, 26)
        df = spark.createDataFrame([("1996-04-07 02:07:26.5",)], "t string").select(coerce_ts("t").alias("ts"))
        r = df.select("ts", wall_text("ts").alias("w"), py_ts_text("ts").alias("p")).collect()[0]
        assert (r.ts, r.w, r.p) == (dt.datetime(1996, 4, 7, 2, 7, 26, 500000), "1996-04-07 02:07:26",
                                    "1996-04-07 02:07:26.500000")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_signed_value_option(spark):
    df = spark.createDataFrame([(f"acc-0", doc(EXAMPLE))], "accession string, body string")
    t, _ = parse_filings(df)
    r = combine_transactions(t, header_cols=HEADER, signed_value=True).collect()[0]
    assert (r.qty, r.value) == (-400, -4600.0)


REALISTIC = """<SEC-DOCUMENT>0001234567-24-000012.txt : 20240105
<SEC-HEADER>0001234567-24-000012.hdr.sgml : 20240105
<ACCEPTANCE-DATETIME>20240105163012
ACCESSION NUMBER:\t\t0001234567-24-000012
CONFORMED SUBMISSION TYPE:\t4
PUBLIC DOCUMENT COUNT:\t\t2
</SEC-HEADER>
<DOCUMENT>
<TYPE>4
<SEQUENCE>1
<FILENAME>form4.xml
<TEXT>
<XML>
<?xml version="1.0"?>
<ownershipDocument>
    <schemaVersion>X0508</schemaVersion>
    <documentType>4</documentType>
    <periodOfReport>2024-01-03</periodOfReport>
    <notSubjectToSection16>0</notSubjectToSection16>
    <issuer>
        <issuerCik>0000320193</issuerCik>
        <issuerName>Example Corp &amp; Co</issuerName>
        <issuerTradingSymbol>EXMP</issuerTradingSymbol>
    </issuer>
    <reportingOwner>
        <reportingOwnerId>
            <rptOwnerCik>0001111111</rptOwnerCik>
            <rptOwnerName>O'NEIL MARY  K</rptOwnerName>
        </reportingOwnerId>
        <reportingOwnerAddress>
            <rptOwnerStreet1>ONE EXAMPLE WAY</rptOwnerStreet1>
            <rptOwnerCity>SPRINGFIELD</rptOwnerCity>
        </reportingOwnerAddress>
        <reportingOwnerRelationship>
            <isDirector>false</isDirector>
            <isOfficer>true</isOfficer>
            <isTenPercentOwner>false</isTenPercentOwner>
            <isOther>false</isOther>
            <officerTitle>SVP, General Counsel</officerTitle>
        </reportingOwnerRelationship>
    </reportingOwner>
    <nonDerivativeTable>
        <nonDerivativeTransaction>
            <securityTitle><value>Common Stock</value></securityTitle>
            <transactionDate><value>2024-01-03</value></transactionDate>
            <transactionCoding>
                <transactionFormType>4</transactionFormType>
                <transactionCode>S</transactionCode>
                <equitySwapInvolved>0</equitySwapInvolved>
                <footnoteId id="F1"/>
            </transactionCoding>
            <transactionAmounts>
                <transactionShares><value>1000</value></transactionShares>
                <transactionPricePerShare><value>185.5</value><footnoteId id="F2"/></transactionPricePerShare>
                <transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode>
            </transactionAmounts>
            <postTransactionAmounts><sharesOwnedFollowingTransaction><value>5000</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
            <ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature>
        </nonDerivativeTransaction>
        <nonDerivativeTransaction>
            <securityTitle><value>Common Stock</value></securityTitle>
            <transactionDate><value>2024-01-04</value></transactionDate>
            <transactionCoding><transactionFormType>4</transactionFormType><transactionCode>S</transactionCode><equitySwapInvolved>0</equitySwapInvolved></transactionCoding>
            <transactionAmounts>
                <transactionShares><value>500</value></transactionShares>
                <transactionPricePerShare><value>186.25</value></transactionPricePerShare>
                <transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode>
            </transactionAmounts>
        </nonDerivativeTransaction>
        <nonDerivativeHolding>
            <securityTitle><value>Common Stock</value></securityTitle>
            <postTransactionAmounts><sharesOwnedFollowingTransaction><value>100</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
        </nonDerivativeHolding>
    </nonDerivativeTable>
    <derivativeTable>
        <derivativeTransaction>
            <securityTitle><value>Restricted Stock Unit</value></securityTitle>
            <conversionOrExercisePrice><footnoteId id="F3"/></conversionOrExercisePrice>
            <transactionDate><value>2024-01-02</value></transactionDate>
            <transactionCoding><transactionFormType>4</transactionFormType><transactionCode>M</transactionCode><equitySwapInvolved>0</equitySwapInvolved></transactionCoding>
            <transactionAmounts>
                <transactionShares><value>200</value></transactionShares>
                <transactionPricePerShare><value>0</value></transactionPricePerShare>
                <transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode>
            </transactionAmounts>
            <exerciseDate><footnoteId id="F4"/></exerciseDate>
            <underlyingSecurity><underlyingSecurityTitle><value>Common Stock</value></underlyingSecurityTitle>
                <underlyingSecurityShares><value>200</value></underlyingSecurityShares></underlyingSecurity>
        </derivativeTransaction>
    </derivativeTable>
    <footnotes>
        <footnote id="F1">Sold under a 10b5-1 plan.</footnote>
        <footnote id="F2">Weighted average price.</footnote>
    </footnotes>
    <remarks>Exhibit 24 - Power of Attorney</remarks>
    <ownerSignature><signatureName>/s/ Agent, attorney-in-fact</signatureName><signatureDate>2024-01-05</signatureDate></ownerSignature>
</ownershipDocument>
</XML>
</TEXT>
</DOCUMENT>
<DOCUMENT>
<TYPE>EX-24
<SEQUENCE>2
<TEXT>
Power of attorney text.
</TEXT>
</DOCUMENT>
</SEC-DOCUMENT>
"""


def test_realistic_submission(spark):
    out, rej = run(spark, [REALISTIC])
    assert rej.count() == 0
    rows = {r.trade_type: r for r in out.collect()}
    s = rows["S - Sale"]
    assert (s.x_flag, s.filing_ts, s.ticker, s.insider_name, s.title) == (
        "DM", dt.datetime(2024, 1, 5, 16, 30, 12), "EXMP", "O'neil Mary K", "SVP, General Counsel")
    # 1000 @ 185.5 + 500 @ 186.25 -> 278625, VWAP 185.75
    assert (s.qty, s.value, s.price, s.trade_date) == (-1500, 278625.0, 185.75, dt.date(2024, 1, 3))
    m = rows["M - OptEx"]
    assert (m.x_flag, m.qty, m.price, m.value) == ("D", -200, 0.0, 0.0)


def test_any_depth_and_several_tables(spark):
    loose = ("<nonDerivativeTransaction><transactionCode>S</transactionCode><x><transactionDate><note/><value>2024-01-04</value></transactionDate></x>"
             "<transactionShares><value>7</value></transactionShares><y><y2><transactionPricePerShare><value>2</value></transactionPricePerShare></y2></y>"
             "<transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode></nonDerivativeTransaction>")
    body = doc([tx("2024-01-03", "P", "10", "5", "A")]).replace("<remarks>", f"<nonDerivativeTable>{loose}</nonDerivativeTable><wrap>{loose}</wrap><remarks>")
    body = body.replace("<rptOwnerName>MCDONALD-SMITH ANN</rptOwnerName>", "<rptOwnerCik>1</rptOwnerCik>").replace(
        "<remarks>", "<reportingOwner><rptOwnerName>DOE JANE</rptOwnerName></reportingOwner><remarks>")
    out, rej = run(spark, [body])
    rows = {r.trade_type: r for r in out.collect()}
    assert rej.count() == 0 and rows["P - Purchase"].qty == 10
    s = rows["S - Sale"]
    assert (s.qty, s.price, s.value, s.x_flag, s.insider_name, s.title) == (-14, 2.0, 28.0, "M", "Doe Jane", "Chief Example Officer, Director")


def test_markup_that_is_no_element(spark):
    body = doc([tx("2024-01-03", "P", "10", "5", "A")], ticker="<![CDATA[A<B>&amp;]]>", remarks="R&amp;D &#38; T&#x26;A &lt;b&gt; &amp;lt; &#0;")
    body = body.replace("<nonDerivativeTable>", "<!-- <transactionCode>X</transactionCode> --><nonDerivativeTable a = 'x > \"y\"' b=\"'\">")
    r = run(spark, [body])[0].collect()
    assert [(x.ticker, x.title) for x in r] == [("A<B>&amp;", "R&D & T&A <b> &lt; &#0;, Director")] or r == []  # &#0; is no XML


def test_stray_ampersands_and_cut_documents(spark):
    whole = doc([tx("2024-01-03", "P", "10", "5", "A"), tx("2024-01-04", "P", "20", "5", "A")], ticker="AT&T", remarks="R&D & &nbsp; &amp; &#65;")
    at = whole.index("20</value>")
    bodies = [whole, whole[:at], whole[:whole.index("<remarks>")], whole[:whole.index("10</value>")]]
    out, rej = run(spark, bodies)
    by = {r.accession: r for r in out.collect()}
    assert (by["acc-0"].ticker, by["acc-0"].title, by["acc-0"].qty) == ("AT&T", "R&D & &nbsp; & A, Director", 30)
    assert (by["acc-1"].title, by["acc-1"].qty) == ("See Remarks, Director", 10) and by["acc-2"].qty == 30 and "acc-3" not in by
    assert {(r.accession, r.reject) for r in rej.collect()} == {("acc-1", "document cut off"), ("acc-2", "document cut off"),
                                                                 ("acc-3", "malformed XML")}


def test_plain_elements_are_only_ever_well_formed(spark):
    """What the quick pass takes for well formed is so for the XML parser, too."""
    from tradewell.functions import xml as X
    from tradewell.operators.filings import ROOT
    rng = random.Random(5)

    def element(depth):
        kids = "".join(rng.choice([element(depth - 1), "text ", "&amp;", " > "[:rng.randint(0, 1)]])
                       for _ in range(rng.randint(0, 3))) if depth else rng.choice(["", "1.5", " x "])
        name, attr = rng.choice("abc"), rng.choice(["", "", ' id="F1"', ' id="a > b"'])
        return rng.choice([f"<{name}{attr}>{kids}</{name}>", f"<{name}{attr}>{kids}</{name}>", f"<{name}{attr}/>"])

    def broken(t):
        at = rng.randrange(len(t))
        return t[:at] + rng.choice(["", "<", ">", "&", "/", '"', "<a>", "</a>", "]]>", "\x01"]) + t[at + rng.randint(0, 2):]

    texts = [f"<{ROOT}>{''.join(element(4) for _ in range(rng.randint(0, 4)))}</{ROOT}>" for _ in range(600)]
    texts += [broken(t) for t in texts] + [f"<{ROOT}>" + "<a>" * 9 + "</a>" * 9 + f"</{ROOT}>",
                                           f"<{ROOT}>" + "<a>1</a>" * 50_000 + f"</{ROOT}>"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    bad = F.from_xml("x", "_corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})["_corrupt_record"].isNotNull()
    got = df.select(X.plain_elements(F.col("x"), ROOT).alias("plain"), bad.alias("bad")).collect()
    assert not any(r.plain and r.bad for r in got)
    assert sum(r.plain for r in got[:600]) > 400 and got[-1].plain and not got[-2].plain and sum(r.bad for r in got) > 200


def test_elements_by_one_pass(spark):
    from tradewell.functions import xml as X
    texts = ["<r><a>1</a><b></b><a>2<c>x</c></a></r>", "<r><a>cut", "<r><ab>no</ab></r>", "", None, "<a>" + "<c>x</c>" * 50_000 + "</a>"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(X.first("x", "a"), X.first("x", "b"), X.every("x", "a")).collect()
    assert [tuple(r) for r in got[:5]] == [("1", "", ["1", "2<c>x</c>"]), ("cut", None, ["cut"]), (None, None, []), (None, None, []),
                                           (None, None, None)]
    assert len(got[5][0]) == 400_000 and len(got[5][2]) == 1


def test_comments_and_sections_skip_the_parser(spark):
    from tradewell.functions import xml as X
    well = ["<r><!-- <a> - b --><a>x</a></r>", "<r><![CDATA[<b>&]]></r>", "<r><a/><![CDATA[]]]]></r>"]
    other = ["<r><!-- a -- b --></r>", "<r><!-- a ---></r>", "<r>]]></r>", "<r><![CDATA[x]]</r>", "<r><!-- é --></r>"]
    rows = spark.createDataFrame([(x,) for x in well + other], "x string").select(X.plain_elements(F.col("x"), "r").alias("p")).collect()
    assert [r.p for r in rows] == [True] * len(well) + [False] * len(other)


def test_transaction_values_in_every_form(spark):
    from tradewell.operators.filings import transaction_values
    date, code = "<transactionDate><value>2024-01-02</value></transactionDate>", "<transactionCode>P</transactionCode>"
    rest = "<transactionShares><value>5</value></transactionShares>"
    texts = [f"{date}<c>{code}</c>{rest}", f"{rest}{code}<d>{date}</d>", f"{date}{code}{rest}{date.replace('2024', '2023')}",
             date.replace("<value>", "<n></n><value> ") + code + rest, f"{code}<transactionDate></transactionDate>{rest}",
             f"{date}<transactionCode></transactionCode>{rest}", f"\x01{date}{code}{rest}", "\x01\x01\x01\x01\x01\x01", ""]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    got = [tuple(r.v) for r in df.select(transaction_values(F.col("x")).alias("v")).collect()]
    one = ("2024-01-02", "P", "5", None, None)
    assert got == [one, one, one, one, (None, "P", "5", None, None), ("2024-01-02", "", "5", None, None), one,
                   (None,) * 5, (None,) * 5]


def test_relationship_in_its_usual_order_is_one_pass(spark):
    from tradewell.functions import xml as X
    from tradewell.operators.filings import _USUAL_RELATION, relation_values
    values = {"isDirector": "1", "isOfficer": " true", "isTenPercentOwner": "0", "officerTitle": "VP, Sales "}
    usual = "".join(f"<{k}>{v}</{k}>" for k, v in values.items())
    docs = [usual, usual.replace("<isOfficer> true</isOfficer>", ""), usual + "<isOther>0</isOther><otherText/>",
            "".join(f"<{k}>{v}</{k}>" for k, v in reversed(values.items())), usual + "<isDirector>0</isDirector>",
            usual.replace("VP, Sales ", "<b>VP</b> &amp; Sales"), usual.replace("VP, Sales ", ""), "", None]
    df = spark.createDataFrame([(d,) for d in docs], "x string")
    rows = df.select(relation_values("x").alias("v"), F.col("x").rlike(rf"(?s)\A{_USUAL_RELATION}").alias("usual"),
                     F.struct(*[X.text(X.first("x", k)).alias(k) for k in ("isOfficer", "officerTitle", "isDirector", "isTenPercentOwner")]
                              ).alias("want")).collect()
    assert [r.v for r in rows] == [r.want for r in rows]
    assert [r.usual for r in rows] == [True, True, True, False, False, False, False, True, None]


def test_documents_are_spread_behind_the_join(spark):
    # their tasks follow the cores, not the bytes of the joined rows
    from tradewell.plans import fixtures as fx
    sf = "/root/testdata/sf0.001"
    tables = fx.table(spark, sf, "orders"), fx.table(spark, sf, "lineitem")
    for docs in (fx.filing_documents(*tables), fx.odd_documents(*tables)):
        assert docs.rdd.getNumPartitions() == fx.TASKS_A_CORE * spark.sparkContext.defaultParallelism


def test_plain_markup_computes_its_text_once(spark):
    """The text may be an expression of its own (that of a cut document): it is not written out in every branch."""
    from tradewell.functions.xml import plain_markup
    docs = spark.createDataFrame([("a <b x='1'/> <!-- <c/> --><![CDATA[d&<e/>]]><f  />",)], "x string")
    out = docs.select(plain_markup(F.concat(F.lit("<r>"), F.reverse("x"), F.lit("</r>")), F.col("x").isNull()).alias("m"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 1
    got = docs.select(plain_markup(F.col("x"), F.lit(False)).alias("m")).first().m
    assert got == "a <b></b> d&amp;&lt;e/><f></f>"
