"""Main text of pages: known articles, damaged markup, and the inferred wrappers."""

import html
import re

from lexshelf.llm import pages
from lexshelf.llm.queries import QUERIES


def plain(page):
    """The article element of the test pages, by string work alone."""
    body = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", page or "", flags=re.DOTALL)
    inner = body.split("<article>", 1)[-1].split("</article>", 1)[0] if "<article>" in body else ""
    parts = re.split(r"</?(?:p|h1)>", inner)
    return "\n".join(t for part in parts if (t := " ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in part else "", part)).split())))


def test_query_against_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op1_html_text"](spark, sf).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r.url, r.text) == want[r.page_id], r.page_id
        assert r.n_chars == len(r.text)


PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body><div id="top-menu"><a href="/">Home</a></div>
<div class="wrap"><div class="content"><h2>Title {0}</h2><p>First &amp; {0}<b> bold</b> end<p>Second<br>line {0} {1}
<div class="cookie-notice">We use cookies</div><ul><li>one {0}<li>two</ul><form>Name <input></form></div>
<div class="sidebar">Latest {0}</div><section class="comments"><p>Nice {0} {0} {0} {0}</p></section></div><footer>{0}</footer>"""


def test_pages_without_article_elements(spark):
    rows = [(i, f"https://a.example/{i}", PAGE.format(f"word{i}", "more " * i)) for i in range(12)]
    rows += [(20, "https://b.example/", None), (21, None, ""), (22, "odd", "just <b>text</b> &lt;here"), (23, "https://c.example", "<p>broken <a href='x"), (0, "https://a.example/0", PAGE.format("word0", ""))]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        more = " more" * i
        assert got[i] == f"Title word{i}\nFirst & word{i} bold end\nSecond line word{i}{more}\none word{i}\ntwo"
    assert (got[20], got[21], got[22], got[23]) == ("", "", "just text <here", "broken")


def test_union_free_expressions():
    one = "<ul><li>a</li><li>b</li></ul><p>x</p><i>same</i>"
    two = "<ul><li>c</li><li>d</li><li>e</li></ul><img><p>y</p><i>same</i>"
    assert pages.expression(pages.infer([one, two])) == "<ul> (<li> #text </li>)+ </ul> (<img>)? <p> #text </p> <i> same </i>"


def test_hot_host_and_empty_table(spark):
    rows = [(i, "https://hot.example/" + str(i), f"<body><nav>menu</nav><main><p>text {i}</p></main></body>") for i in range(300)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    assert {(r.page_id, r.text) for r in pages.extracted(frame).collect()} == {(i, f"text {i}") for i in range(300)}
    assert pages.wrappers(frame).count() == 1
    assert pages.extracted(frame.where("false")).collect() == []


def test_wrappers_come_from_every_page(spark):
    """Nine pages of one template hide nothing of the tenth; long streams are aligned too, and the order does not matter."""
    page = lambda i, extra="": f"<div class='a'><p>text {i}</p>{extra}</div>"
    rare = page(99, "<table><tr><td>cell</td></tr></table>")
    rows = [(i, "https://h.example/", page(i)) for i in range(40)] + [(99, "https://h.example/", rare)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.wrapper for n in (1, 3, 9) for r in pages.wrappers(frame.repartition(n)).collect()}
    assert len(found) == 1 and "(<table> <tr> <td> cell </td> </tr> </table>)?" in found.pop()
    long = [f"<b{i % 31}>same</b{i % 31}><i{i % 17}>" for i in range(500)]
    one, two = ("".join(long) + "<p>x</p>", "".join(long[:250]) + "<u>" + "".join(long[250:]) + "<p>y</p>")
    wrapper = pages.infer([one, two])
    assert pages.expression(wrapper).count("?") == 1 and pages.expression(wrapper).endswith("<p> #text </p>")


def test_rows_made_again_are_the_same():
    a = [("open", str(i * i % 7), "") for i in range(50)]
    b = [("open", str(i * 3 % 7), "") for i in range(37)]
    scores = pages.Scores(a, b)
    best = [[0] * 38 for _ in range(51)]
    for i in range(49, -1, -1):
        for j in range(36, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + 2 if a[i] == b[j] else 0)
    assert [scores.row(i).tolist() for i in range(50)] == best[:50]
