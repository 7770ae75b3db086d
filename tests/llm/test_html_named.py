"""Names of containers do not take the article away, and an article may be split."""

import pytest

from tallyward.llm.html_text import main_text

from test_html_text import expected, paragraphs

MENU = "<nav><a href=/>Home</a></nav>"


@pytest.mark.parametrize("name", ["elementor-widget elementor-widget-text-editor", "layout-sidebar", "related", "promo"])
def test_named_container_of_the_article_stays(name):
    assert main_text(f"<body>{MENU}<div class='{name}'><h1>Title</h1>{paragraphs(4)}</div><div class=ad>Buy it now</div></body>") == "\n".join(["Title", *expected(4)])


def test_several_widgets_make_one_article():
    parts = paragraphs(6).replace("<p>", "<div class='elementor-widget'><p>").replace("</p>", "</p></div>")
    assert main_text(f"<body>{MENU}<div>{parts}</div></body>") == "\n".join(expected(6))


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<div>{}</div>"])
def test_title_named_header_stays(frame):
    assert main_text(f"<body>{MENU}{frame.format("<h1 class='header'>Title</h1>" + paragraphs(3))}</body>") == "\n".join(["Title", *expected(3)])


def test_named_lists_of_links_go():
    links = "".join(f"<li><a href=/{i}>Another page about thing {i} that one may want to read</a></li>" for i in range(60))
    assert main_text(f"<body><div class=related><ul>{links}</ul></div><div>{paragraphs(3)}</div></body>") == "\n".join(expected(3))


def test_second_article_of_a_split_one_stays():
    text = paragraphs(6)
    cut = text.index("<p>", len(text) // 2)
    assert main_text(f"<body>{MENU}<article>{text[:cut]}</article><div class=ad>Buy it now</div><article>{text[cut:]}</article></body>") == "\n".join(expected(6))


def test_short_teaser_articles_go():
    teaser = "<article><h3><a href=/x>Other</a></h3><p><a href=/x>more</a></p></article>"
    assert main_text(f"<body><article>{paragraphs(4)}</article>{teaser * 3}</body>") == "\n".join(expected(4))
