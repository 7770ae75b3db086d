"""Names of classes, reader comments, main parts and deep nesting."""

import time

import pytest

from tallyward.llm.html_text import main_text

LINES = [f"This is line {i} of the article, which says something of interest to its readers." for i in range(6)]


def paragraphs(lines=LINES):
    return "".join(f"<p>{x}</p>" for x in lines)


def test_paragraphs_stay_whatever_they_are_called():
    body = f"<p>{LINES[0]}</p><p class='related'>{LINES[1]}</p><p class='share'>{LINES[2]}</p><p id='login'>{LINES[3]}</p>"
    assert main_text(f"<body><nav><a href=x>Home</a></nav><article>{body}</article></body>") == "\n".join(LINES[:4])
    assert main_text(f"<body><article><p>{LINES[0]} <span class='comment'>see there</span></p>{paragraphs(LINES[1:])}</article></body>") == "\n".join([LINES[0] + " see there", *LINES[1:]])


@pytest.mark.parametrize("tag", ["article", "div", "li"])
def test_reader_comments_go_also_as_articles(tag):
    comments = "".join(f"<{tag} class='comment'><p>{who} says that this is a long and thoughtful comment on the whole matter.</p></{tag}>" for who in ("Ann", "Bob", "Cy"))
    assert main_text(f"<body><article>{paragraphs()}</article><section id='comments'><ol>{comments}</ol></section></body>") == "\n".join(LINES)
    assert main_text(f"<body><article>{paragraphs()}</article><div>{comments}</div></body>").startswith("\n".join(LINES))


def test_a_comments_class_around_the_main_part_drops_nothing():
    assert main_text(f"<body class='comments-open'><div class='page comments-area'><main>{paragraphs()}</main></div></body>") == "\n".join(LINES)


def test_main_counts_more_than_a_longer_teaser():
    teaser = "<article><p>" + "A teaser for another story that goes on and on without an end. " * 12 + "</p></article>"
    assert main_text(f"<body>{teaser}<main>{paragraphs(LINES[:3])}</main></body>").endswith("\n".join(LINES[:3]))


def test_deep_nesting_takes_linear_time():
    deep = "<div>" * 100_000 + "text of the innermost" + "</div>" * 100_000
    start = time.perf_counter()
    assert main_text(f"<body>{deep}</body>") == "text of the innermost"
    assert time.perf_counter() - start < 10
