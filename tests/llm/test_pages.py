import re
from html.parser import HTMLParser

import pytest

from strata.llm import pages, queries

SF = "/root/testdata/sf0.01"

CASES = [
    ("<p>one<p>two <b>bold</b>\n  text<div>block</div>tail", "one\n\ntwo bold text\n\nblock\ntail"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>x<li>y<ul><li>deep</ul><li>z</ul>after", "- x\n- y\n  - deep\n- z\n\nafter"),
    ("<ol start=3><li>c<li>d</ol>", "3. c\n4. d"),
    ("<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>b<td>22</table>", "name       n\nlong name  1\nb          22"),
    ("<table><td>a<td>b<tr><td colspan=2>wide cell here<tr><td>c<td>d</table>x", "a  b\nwide cell here\nc  d\n\nx"),
    ("<table><tr><td>1<br>2<td>x</table>", "1  x\n2"),
    ("<pre>  keep\n   this  </pre>", "  keep\n   this  "),
    ("<head><title>no</title><style>p{}</style></head><body><script>if (a<b) '</p>'</script>yes", "yes"),
    ("<div hidden>no</div><div style='display: none'>no</div><i style=\"visibility:hidden\">no<b style='visibility:visible'>yes</b></i>", "yes"),
    ("<details><summary>more</summary>closed</details><details open><summary>s</summary>shown</details>", "more\ns\nshown"),
    ("<!-- a --><p>&copy; &lt;x&gt; &#233;</p><!-- unclosed", "© <x> é"),
    ("text <b", "text"), ("1 < 2 <3", "1 < 2 <3"), ("</p></td></li>x", "x"), ("<a href='x>y'>link</a>", "link"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("<p>a</p><hr><p>b", "a\n\nb"), ("", ""), (" \n ", ""),
    ("<select><option>a<option>b</select>", "a\nb"), ("<textarea>a &amp; <b>b</textarea>", "a & <b>b"),
    ("<input type=hidden value=no><input type=submit value=Go>", "Go"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d</table>", "a  b\n   c  d"),
    ("<table><tr><td>a<td rowspan=0>long<td>z<tr><td>b<td>y<tr><td>c<td>x</table>", "a  long  z\nb        y\nc        x"),
    ("<table><tr><td colspan=2>wide cell here<td>end<tr><td>c<td>d<td>e</table>", "wide cell here  end\nc  d            e"),
    ("<table><tr><td rowspan=2 colspan=2>ab<td>x<tr><td>y<tr><td>1<td>2<td>3</table>", "ab    x\n      y\n1  2  3"),
    ("<div style='visibility:hidden'>no<b style='visibility:inherit'>no</b><i style='visibility: visible'>yes</i></div>", "yes"),
    ("<p style='visibility:hidden;visibility:visible'>yes</p><p style='visibility:visible;visibility:collapse'>no", "yes"),
    ("<ol><li>a<li value=5>b<li>c</ol>", "1. a\n5. b\n6. c"), ("<ol start=x><li value=-1>a</ol>", "1. a"),
    ("<pre>\n  kept\n</pre>x<pre>\r\ny</pre>", "  kept\n\nx\n\ny"), ("<pre>\n\nz</pre>", "\nz"),
    ("<table><caption>cap</caption><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "cap\nin  ner  out"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_layout(html, text):
    assert pages.render(html) == text


@pytest.mark.parametrize("html,text", [
    ('<a title="a hidden gem in Rome">Rome</a>', "Rome"), ("<div class='relative hidden md:block'>x</div>", "x"),
    ('<button aria-label="Show hidden files">Files</button>', "Files"), ('<p data-style="display:none">x</p>', "x"),
    ("<p title='style=display:none'>x</p>", "x"), ('<p title="a > b hidden">x</p>', "x"), ("<p data-hidden>x</p>", "x"),
    ('<p title = "hidden" class= hidden>x</p>', "x"), ("<p title=it's>x</p>", "x"), ('<p title="unclosed hidden>x</p>', "x"),
    ('<table><tr title="a hidden row" class="hidden"><td data-colspan=9 title="colspan=2 ">a<td>b<tr><td>c<td>d</table>', "a  b\nc  d"),
    ('<details title="an open door"><summary>s</summary>closed</details>', "s"),
    ('<ol title="a start=7 b"><li>x</ol>', "1. x"), ('<input title=" type=submit value=no ">x', "x"),
    ('<input data-value=no type="submit" value="&quot;Go&quot;">', '"Go"'),
    ('<div HIDDEN>no</div><div class="x"hidden>no</div><div hidden="">no</div><div hidden/>no</div>', ""),
    ("<p hidden=until-found>no</p><p STYLE='Display : none'>no</p><p style=display:none style=color:red>no</p>yes", "yes"),
])
def test_only_attributes_themselves_count(html, text):
    assert pages.render(html) == text


@pytest.mark.parametrize("html,text", [
    ("<head><title>t</title>Hello <a>x</a>", "Hello x"), ("<head><title>t</title><font face=x><p>one<p>two", "one\n\ntwo"),
    ("<html><head>\n<meta charset=x>\n<a href=y>link</a> on", "link on"), ("<head><img src=x><input type=submit value=Go>", "Go"),
    ("<head><basefont size=3><title>t</title><p>x", "x"), ("<head><my-tag><div>x</div>", "x"), ("<head>&nbsp;<b>x</b>", "\xa0x"),
    ("<head><textarea>x</textarea>", "x"), ("<head><head><title>t</title>x", "x"), ("<p>a<head><title>t</title>b", "ab"),
    ("<head><title>no</title> \n <script>no</script><style>no</style><noscript><p>no</p></noscript><template><b>no</b></template>"
     "<!-- no --></head><body>x", "x"),
])
def test_head_ends_at_what_it_cannot_hold(html, text):
    assert pages.render(html) == text


class Visible(HTMLParser):
    """All character data outside elements that never show, in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.off, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.off -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.off:
            self.words += data.split()


def letters(words):
    """Without markers and spacing, which layout adds."""
    return sorted(re.sub(r"^(-|\d+\.)$", "", w) for w in words if not re.fullmatch(r"-|\d+\.", w))


def test_query_keeps_all_visible_words(spark):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op2_html_rendering"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(rows)
    for r in got:
        parser = Visible()
        parser.feed(rows[r.page_id])
        parser.close()
        assert letters("".join(r.text).split()) == letters(parser.words), r.page_id
        assert r.n_lines == r.text.count("\n") + 1 and r.n_chars == len(r.text)


def test_deep_long_and_odd_pages(spark):
    deep = "<div>" * 5000 + "deep" + "<table><tr><td>" * 300 + "cell"
    rows = [(1, None), (2, ""), (3, deep), (4, "<p>w " * 50000), (5, "<" * 20000), (6, "<a '" * 3000), (5, "again"), (None, "x")]
    df = spark.createDataFrame([(*r, "r", 1) for r in rows], "page_id long, html string, rendered string, c0 int")
    got = {}
    for r in pages.rendered(df).toDF("page_id", "html", "was", "c", "text").collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[1] == got[2] == [""] and "deep" in got[3][0] and "cell" in got[3][0]
    assert got[4][0].count("w") == 50000 and got[5][1:] == ["again"] or "again" in got[5]
    assert got[None] == ["x"] and pages.rendered(df.limit(0)).collect() == []
