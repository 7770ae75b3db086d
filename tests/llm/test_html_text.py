import html
import re

import pytest

from tallyward.llm.html_text import main_text, page_texts
from tallyward.llm.queries import QUERIES

PROSE = "This is a sentence of the article, with words that go on for quite a while so that its text is dense."


def paragraphs(n):
    return "".join(f"<p>{PROSE} Part {i}.</p>" for i in range(n))


def expected(n):
    return [f"{PROSE} Part {i}." for i in range(n)]


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a\n <b>b</b>c&nbsp;&eacute;<p>&lt;d&gt; &#x41;", "a bc é\n<d> A"),
        ("<script>var a = '<p>no</p>'</script><style>p{}</style>", ""),
        ("<p>one<br>two<!-- <p>no</p> --></p>", "one two"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"),
        ('<p>cut <a href="/x', "cut"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p title='a > b'>kept</p>", "kept"),
        ("<textarea>no</textarea><p>yes</p><select><option>no</select>", "yes"),
        ("<div hidden>no</div><div style='display: none'>no</div><div aria-hidden=true>no</div>yes", "yes"),
    ],
)
def test_small_pages(source, text):
    assert main_text(source) == text


@pytest.mark.parametrize(
    "noise",
    [
        "<nav><ul><li><a href=/>Home</a></ul></nav>", "<header><p>Site name and slogan</p></header>", "<footer><p>All rights reserved by us</p></footer>", "<aside>More for you to read</aside>",
        "<div class='sidebar'><p>See also this other thing</p></div>", "<div class='ad-slot ad'>Buy it now</div>", "<div id=cookie-notice>We use cookies</div>", "<form><p>Your name</p><input></form>",
        "<section class='comments'><h2>Comments</h2><p>" + PROSE + "</p></section>", "<div role=navigation>Menu of things</div>", "<script>if (a < b) { c() }</script>",
    ],
)
@pytest.mark.parametrize("frame", ["<article><h1>Title</h1>{}</article>", "<main><h1>Title</h1>{}</main>", "<div class=content><h1>Title</h1>{}</div>"])
def test_noise_around_and_inside(noise, frame):
    want = "\n".join(["Title", *expected(3)])
    assert main_text(f"<html><body>{noise}{frame.format(paragraphs(3))}{noise}</body></html>") == want
    assert main_text(f"<html><body>{frame.format(paragraphs(3) + noise)}</body></html>") == want


def test_dense_part_wins_over_link_lists():
    links = "".join(f"<li><a href=/{i}>Another page about thing {i}</a></li>" for i in range(30))
    assert main_text(f"<body><div><ul>{links}</ul></div><div>{paragraphs(4)}</div></body>") == "\n".join(expected(4))


def test_header_of_the_article_stays():
    assert main_text(f"<article><header><h1>T</h1></header>{paragraphs(1)}</article>") == f"T\n{expected(1)[0]}"


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(main_text("<article>" + paragraphs(5000) + "</article>").split("\n")) == 5000
    assert main_text("<a <b <c='" * 3000) is not None


def reference(page):
    """The article of the generated pages, by their one known layout."""
    article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    text = re.sub(r"</?(p|h1|article)>", "\n", article[1] if article else "")
    text = re.sub(r"<[^>]*(>|$)", "", text.replace("<br>", " "))
    return "\n".join(b for b in (" ".join(html.unescape(line).split()) for line in text.split("\n")) if b)


def test_query_over_pages(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op3_html_text"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, reference(pages[r.page_id].html), len(r.text))


def test_awkward_rows(frame):
    pages = frame([(1, None, None, "x"), (None, "u", "<p>a</p>", None), (2, "u", "", "x"), (2, "u", "", "x")], "page_id long, url string, html string, text string")
    assert sorted((tuple(r) for r in page_texts(pages).collect()), key=str) == sorted([(1, None, "", 0), (None, "u", "a", 1), (2, "u", "", 0), (2, "u", "", 0)], key=str)
    assert page_texts(pages.limit(0)).collect() == []
