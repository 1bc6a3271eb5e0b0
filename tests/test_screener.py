"""Screener pages: containers, rows, cells, typed rows."""

import datetime as dt
import html.entities

from pyspark.sql import functions as F

from tradewell.operators import screener as sc
from tradewell.sources.screener import compact_pages, read_page_files, read_pages

ROW1 = ["", "2024-01-05 16:30:12", "2024-01-03", "AAPL", "Doe Jane", "CEO; Dir", "P - Purchase", "$10.50",
        "+1,000", "5,000", "+25%", "+$10,500", "", "", "", ""]
ROW2 = ["D", "2024-01-06 09:00:00", "2024-01-04", "AAPL", "Doe Jane", "CEO", "S - Sale", "$1,234.56", "-10",
        "1", "-1%", "-$12,346", "", "", "", ""]
ROW3 = ["", "bad", "bad", "AAPL", "Roe Al", "Dir", "A - Grant", "n/a", "n/a", "", "", "n/a", "", "", "", ""]


def page(*rows, tbodies=2):
    trs = "".join("<tr>" + "".join(f'<td><a href="/x">{c.replace("&", "&amp;")}</a></td>' for c in r) + "</tr>"
                  for r in rows)
    first = "<table><tbody><tr><td>filter</td></tr></tbody></table>"
    data = f'<table class="tinytable"><thead><tr><th>X</th></tr></thead><tbody>{trs}</tbody></table>'
    return "<html><body>" + first + (data if tbodies > 1 else "") + "</body></html>"


def test_screener_rows(spark):
    pages = spark.createDataFrame([("AAPL", page(ROW1, ROW2, ROW3)), ("MSFT", page(ROW1, tbodies=1)),
                                   ("NONE", "<html></html>")], "ticker string, html string")
    cells = sc.table_cells(pages, ["ticker"])
    rows = sorted(sc.screener_trades(cells, ["ticker"], sep=";").collect(), key=lambda r: r.row_pos)
    assert len(rows) == 3
    a, b, c = rows
    assert (a.x_flag, a.filing_ts, a.trade_date, a.title, a.price, a.qty, a.value, a.accession) == (
        "", dt.datetime(2024, 1, 5, 16, 30, 12), dt.date(2024, 1, 3), "CEO, Dir", 10.5, 1000, 10500.0, None)
    assert (b.x_flag, b.price, b.qty, b.value) == ("D", 1234.56, -10, -12346.0)
    assert (c.filing_ts, c.trade_date, c.price, c.qty, c.value, c.trade_type) == (None, None, None, None, None,
                                                                                   "A - Grant")


def test_comma_separator_title(spark):
    pages = spark.createDataFrame([("AAPL", page(ROW1))], "ticker string, html string")
    r = sc.screener_trades(sc.table_cells(pages, ["ticker"]), ["ticker"], sep=",").collect()[0]
    assert r.title == "CEO; Dir"


def test_entities_and_nested_tags(spark):
    html = "<ul><li><a href='/1'>Tom &amp; <b>Jerry</b></a></li><li><a>&nbsp;x&lt;y </a></li></ul>"
    df = spark.createDataFrame([(1, html)], "id int, html string")
    got = [r.cells for r in sc.table_cells(df, ["id"], container="ul", index=1, row="li", cell="a")
           .orderBy("row_pos").collect()]
    assert got == [["Tom & Jerry"], ["x<y"]]


def test_entities_case_and_short_rows(spark):
    page = ("<TABLE><TBODY></TBODY></TABLE><tBody><TR><td>D</td><TD>2024-01-02 10:00:00</TD></tr>"
            "<tr><td>Co&#8217;s Ren&#xE9;e&eacute; &amp;lt; &nope; &#0;</td></tr></tBODY >")
    df = spark.createDataFrame([("A", page)], "ticker string, html string")
    cells = sc.table_cells(df, ["ticker"])
    rows = [r.cells for r in cells.orderBy("row_pos").collect()]
    assert rows == [["D", "2024-01-02 10:00:00"], ["Co\u2019s Ren\u00e9e\u00e9 &lt; &nope; &#0;"]]
    out = sc.screener_trades(cells, ["ticker"]).orderBy("row_pos").collect()
    assert out[0].x_flag == "D" and out[0].price is None and out[1].title is None


def cells_of(spark, html):
    df = spark.createDataFrame([(html,)], "html string").withColumn("id", F.lit(1))
    return [r.cells for r in sc.table_cells(df, ["id"]).orderBy("row_pos").collect()]


FORM = "<form><table><tbody><tr><td>Filter</td></tr></tbody></table></form>"


def test_quotes_comments_and_scripts(spark):
    """Markup in quoted attributes, comments and scripts is no markup."""
    tip = """<td><a href="/ABC" onmouseover="Tip('<img src=x width=500>', DELAY, 1)" onmouseout="UnTip()">ABC</a></td>"""
    html = ("<!-- <table><tbody><tr><td>old</td></tr></tbody></table> --><script>document.write('<tbody>' < 1)</script>" + FORM
            + f"<table><tbody>{tip}<tr>{tip}<td title=\"a>b\">Doe</td><td it's>x<!-- </td> > -->y</td><td a = 'q\"'>z < 1</td></tr></tbody></table>")
    assert cells_of(spark, html) == [["ABC", "Doe", "xy", "z < 1"]]


def test_nested_tables_and_missing_end_tags(spark):
    html = (FORM + "<table><tbody><tr><td>a<td>in <table><tbody><tr><td>n1</td><td>n2</td></tr></tbody></table> out"
            "<tr><TD>b</TD><td>c</td></td></tr></div><tr></tr></table><p>after")
    assert cells_of(spark, html) == [["a", "in n1n2 out"], ["b", "c"], []]
    # containers count in document order, nested ones too
    nested = "<table><tbody><tr><td><table><tbody><tr><td>x</td></tr></tbody></table></td></tr></tbody></table>"
    assert cells_of(spark, nested) == [["x"]]
    assert cells_of(spark, FORM + "<table><tbody><tr><td>to the end") == [["to the end"]]
    assert cells_of(spark, FORM + "<table><tbody><tr><td>x <td") == [["x <td"]]


def test_all_entities(spark):
    names = sorted(n[:-1] for n in html.entities.html5 if n.endswith(";"))
    page_ = FORM + "<table><tbody><tr>" + "".join(f"<td>[&{n};]" for n in names) + "".join(f"<td>[&{n}]" for n in names)
    want = [f"[{html.entities.html5[n + ';']}]" for n in names]
    assert cells_of(spark, page_)[0] == want + want
    odd = FORM + "<table><tbody><tr><td>&#x1F600;&#128512 &#150;&#xD800;&#1114112;&#0;&bogus; & &; &amp;amp;"
    assert cells_of(spark, odd) == [["\U0001F600\U0001F600 \u2013&#xD800;&#1114112;&#0;&bogus; & &; &amp;"]]


def test_noncharacters_in_a_page_are_no_marks(spark):
    assert cells_of(spark, FORM + "<table><tbody><tr><td>a\ufdd0\ufdd6b\ufdde</td></tr></tbody></table>") == [["ab"]]


def test_rejects_and_counts(spark):
    wide = FORM + "<table><tbody><tr>" + "<td>x</td>" * 17 + "</tr><tr><td>D</td></tr></tbody></table>"
    rows = [("A", None), ("B", ""), ("C", FORM), ("D", FORM + "<table><tbody></tbody></table>"), ("E", wide), ("F", page(ROW1, ROW2))]
    df = spark.createDataFrame(rows, "ticker string, html string")
    items = sc.page_items(df, ["ticker"])
    got = sorted((r.ticker, r.row_pos, r.reject) for r in sc.page_rejects(items, ["ticker"]).collect())
    assert got == [("A", None, "no page"), ("B", None, "no data table"), ("C", None, "no data table"), ("D", None, "no rows"),
                   ("E", 0, "more cells than columns")]
    good = items.where("reject IS NULL")
    assert sorted((r.ticker, r.row_pos) for r in good.collect()) == [("E", 1), ("F", 0), ("F", 1)]
    counts = {r.ticker: r.n_rows for r in sc.rows_per_ticker(df, "ticker").collect()}
    assert counts == {"E": 2, "F": 2}


def test_a_page_of_a_thousand_rows(spark):
    df = spark.createDataFrame([("A", page(*[ROW1] * 1000))], "ticker string, html string")
    rows = sc.table_cells(df, ["ticker"]).collect()
    assert len(rows) == 1000 and all(r.cells == ROW1 for r in rows)


def test_landed_pages(spark, tmp_path):
    for name, text in (("AAPL.html", page(ROW1)), ("brk.b.HTM", page(ROW2)), ("1+0% x.html", "-")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "note.txt").write_text("x")
    got = {r.ticker: r.html for r in read_page_files(spark, str(tmp_path / "*.{html,HTM}")).collect()}
    assert got == {"AAPL": page(ROW1), "BRK.B": page(ROW2), "1+0% X": "-"}
    compact_pages(spark, str(tmp_path / "*.html"), str(tmp_path / "pages.parquet"))
    assert read_pages(spark, str(tmp_path / "pages.parquet")).count() == 2
    assert read_pages(spark, str(tmp_path / "*.html")).count() == 2


def test_rows_per_ticker_reads_a_page_once(spark):
    """A filter on the count would go below the aggregate and bring the whole
    structural index of the page with it, once more."""
    pages = spark.createDataFrame([("T1", "<table><tbody></tbody><tbody><TR><td>1<tr><Td>2</tbody></table>"), ("T1", None),
                                   ("T2", "<tbody></tbody>"), (None, "<table><tbody></tbody><tbody><tr></tr></tbody></table>")],
                                  "page_ticker string, html string")
    out = sc.rows_per_ticker(pages)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("script|style") == 1
    assert {(r.page_ticker, r.n_rows) for r in out.collect()} == {("T1", 2), (None, 1)}
