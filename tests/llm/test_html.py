import random

import pytest

pytest.importorskip("lakevec.llm")
from lakevec.llm import html  # noqa: E402
from lakevec.llm.html import render  # noqa: E402

CASES = [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br/>c", "a\nb\nc"), ("<div>a</div><div>b</div>", "a\nb"),
    ("  a \n\t b  <i> c</i> d", "a b c d"), ("a &amp; b &lt;c&gt; &eacute;", "a & b <c> é"), ("1 < 2 and 3<4", "1 < 2 and 3<4"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=9><li>a<li>b<li value=3>c</ol>", "9. a\n10. b\n3. c"),
    ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"), ("<table><tr><td>a<td>b<tr><td>long one<td>c</table>", "a         b\nlong one  c"),
    ("<table><tr><td colspan=2>wide<td>x<tr><td>a<td>b<td>c</table>", "wide  x\na  b  c"), ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><caption>C<tr><th>h</table>", "C\nh"), ("<table><tr><td>a<table><tr><td>b</table><td>c</table>", "a  c\n\nb"),
    ("<table>stray<tr><td>a</table>", "stray\n\na"), ("<td>no table", "no table"), ("<pre>\n a\n  b </pre>", " a\n  b"),
    ("<script>var a='<p>x</p>'</script>y", "y"), ("<style>.x{display:none}#y{visibility:hidden}b.z{display:none}</style><b class='x w'>1</b><i id=y>2</i><b class=z>3</b><i class=z>4</i>", "4"),
    ("<p hidden>a<p>b", "b"), ("<div style='DISPLAY : none !important'>a</div>b", "b"), ("<p style='visibility:hidden'>a<b style='visibility:visible'>b</b>", "b"),
    ("<!-- a --><p>b<!-- c", "b"), ("<!doctype html><title>t</title><body>b", "b"), ("<head><meta charset=x><p>b", "b"), ("<details><summary>s</summary>x</details>", "s"),
    ("<details open><summary>s</summary>x</details>", "s\nx"), ("<dialog>x</dialog>y", "y"), ("<select><option>a<option selected>b</select>", "b"),
    ("<input type=submit value=Go><input type=hidden value=no>", "Go"), ("<textarea> a\n b</textarea>", " a\n b"), ("<a href='x>y'>t</a>", "t"), ("<a title=it's>t</a><b>u</b>", "tu"),
    ("</p>a</b></div>b", "ab"), ("<blockquote>q</blockquote>r", "  q\n\nr"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("<h1>a<h2>b</h2>", "a\n\nb"),
    ("<p>a<div>b</div>c", "a\n\nb\nc"), ("<noscript>seen</noscript>", "seen"), ("<ruby>x<rp>(<rt>y<rp>)</ruby>", "xy"), ("<template>no</template>a", "a"),
    ("<a href=\"unclosed>text", "text"), ("a<", "a<"), ("<table><tr><td>日本<td>x<tr><td>a<td>y</table>", "日本  x\na     y"),
]


@pytest.mark.parametrize(("source", "want"), CASES)
def test_rendering(source, want):
    assert render(source) == want


def test_wide_cells_do_not_multiply():
    row = f"<tr><td>{'w' * 5000}<td>b"
    assert len(render(f"<table>{row * 50}<tr><td>a<td>b</table>")) < 50 * 5100


def test_any_markup_is_rendered():
    r = random.Random(4)
    parts = ["<p>", "</p>", "<table>", "<tr>", "<td colspan=3>", "</td>", "</table>", "<ul>", "<li>", "</ul>", "<b>", "</b>", "<div hidden>", "</div>", "<select>", "<option>", "<pre>", "</pre>", "<caption>", "<ol>", "<a>", "<", "&", "&#0;", "<!--", "-->", "<style>", "</style>", "word ", "\n", "<td rowspan=9>", "<h1>", "</body>", "<head>", "<textarea>"]
    for _ in range(1500):
        assert isinstance(render("".join(r.choice(parts) for _ in range(r.randint(1, 60)))), str)
    for deep in ("<div>", "<table><tr><td>", "<ul><li>", "<b>", "<blockquote>", "<details open>"):
        assert render(deep * 5000 + "x").strip().endswith("x")


def test_all_words_come_out():
    r = random.Random(5)
    seen = [f"w{i}" for i in range(200)]
    source = "".join(r.choice(["<p>", "<li>", "<div>", "<table><tr><td>", "</table>", "<td>", "<ul>", "</ul>", "<b>", "</b>"]) + f" {w} " for w in seen)
    assert sorted(render(source).replace("- ", " ").split()) == sorted(seen)


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<table><tr><td>a</td></tr><p>note</p><tr><td>b</td></tr></table>", "note\n\na\nb"), ("<table><tr><td>a</td></tr><div>x<b>y</b><tr><td>b</table>z", "xy\n\na\nb\n\nz"),
        ("<table><tbody><form><tr><td>a<td>b</tr><tr><td>c<td>d</tr></form></tbody></table>", "a  b\nc  d"), ("<table><tr><form><td>a<td>b</form><tr><td>c<td>d</table>", "a  b\nc  d"),
        ("<table><thead><a href=x>link</a><tr><th>h</table>", "link\n\nh"), ("<table><tr><td>a</tr><caption>C</caption></table>", "C\na"),
        ("<table><tr><td>a</tr><table><tr><td>b</table>c", "a\n\nb\n\nc"), ("<table><tr><td>a</tr><select><option>o</select><tr><td>b</table>", "o\n\na\nb"),
        ("<table><tr><td>a<table><tr></tr><p>in</p></table></table>", "a\n\nin"),
    ],
)
def test_elements_between_rows(source, want):
    assert render(source) == want


def test_all_words_between_table_parts_come_out():
    r = random.Random(6)
    tags = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<tbody>", "</tbody>", "<caption>", "</caption>", "<thead>", "<form>", "</form>", "<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<a>", "<h1>", "<center>"]
    for _ in range(300):
        seen = [f"w{i}" for i in range(60)]
        source = "".join("".join(r.choices(tags, k=r.randint(0, 3))) + f" {w} " for w in seen)
        assert sorted(render(source).split()) == sorted(seen), source


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be", "let x=1 be"), ("<math display=block><mfrac><mi>a</mi><mi>b</mi></mfrac></math>c", "a b\nc"),
        ("<math><semantics><mi>x</mi><annotation encoding=t>\\x</annotation></semantics></math>", "x"), ("<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr><mtr><mtd><mn>3</mn></mtd></mtr></mtable></math>", "1 2\n3"),
        ("<svg width=1><title>no</title><desc>no</desc><defs><text>no</text></defs><rect x='1'/><g><text x=1>one <tspan>two</tspan></text></g><path d=M/><text>three</text></svg>", "one two\nthree"),
        ("a<svg viewBox='0 0 1 1'/>b<svg><title/><use href='#a'/></svg>c", "abc"), ("<svg><path><circle></svg><p>after", "after"), ("<svg><g><div>html</div>x", "html\nx"),
        ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"), ("<svg><switch><foreignObject><b>first</b></foreignObject><text>second</text></switch></svg>", "first"),
        ("<svg><text display=none>no</text><g visibility=hidden><text>no</text></g><text><![CDATA[a < b]]></text></svg>", "a < b"), ("<svg display='none'><text>no</text></svg>y", "y"),
        ("<style>.h{display:none}</style><svg><text class=h>no</text><text><tspan x=0>l</tspan><tspan x=0 dy=9>m</tspan></text></svg>", "l\nm"),
        ("<map name=m><a href=x>north</a> <area alt=no> south</map>", "north south"), ("<table><tr><td><svg><text>t</text></svg><td>u</table>", "t  u"), ("<svg><tr>x</svg>y", "y"),
    ],
)
def test_drawings_formulas_and_maps(source, want):
    assert render(source) == want


def test_any_drawing_is_rendered():
    r = random.Random(7)
    parts = ["<svg>", "</svg>", "<math>", "</math>", "<text>", "<g/>", "<tr>", "<td>", "<table>", "</table>", "<mi>", "<foreignObject>", "<title/>", "<form>", "<p>", "</p>", "</br>", "<switch>", "<select>", "<![CDATA[x]]>", "<html>", "<head>", "<a>", "word "]
    for _ in range(1500):
        assert isinstance(render("".join(r.choice(parts) for _ in range(r.randint(1, 60)))), str)
    assert render("<svg>" + "<g>" * 5000 + "<text>x</svg>") is not None


def test_table(spark):
    df = spark.createDataFrame([(1, "<p>a<p>b", "u"), (1, "<p>a<p>b", "v"), (None, None, "w"), (2, "", "x")], "page_id long, html string, text string")
    got = sorted((str(x.page_id), x.text, x.n_lines) for x in html.extract_pages(df).collect())
    assert got == [("1", "a\n\nb", 3), ("1", "a\n\nb", 3), ("2", "", 0), ("None", "", 0)]
    assert html.extract_pages(df.limit(0)).count() == 0
