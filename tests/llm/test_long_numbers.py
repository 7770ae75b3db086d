"""Numbers of more digits than `int` reads from a text."""

import html

import pytest

from tallyward.llm import pii
from tallyward.llm.html_text import main_text

ZEROS = "0" * 5000


@pytest.mark.parametrize("text, base", [(f"1.{ZEROS}.2.3", True), (f"1.{ZEROS}7.2.255", True), (f"1.{ZEROS}256.2.3", False), (f"1.{'9' * 5000}.2.3", False)])
def test_long_parts_of_addresses(text, base):
    assert (("ip", 0, len(text)) in pii.base_spans(text)) == base
    assert (("ip", 0, len(text)) in pii.all_spans(text, pii.field())) == base


@pytest.mark.parametrize("reference, text", [(f"&#{ZEROS}65;", "A"), (f"&#{ZEROS}65b", "Ab"), (f"&#{'9' * 5000};", "�"), (f"&#{'9' * 5000}x", "�x"), (f"&#{ZEROS};", "�"), (f"&#x{ZEROS}41;", "A"), (f"&#x{'f' * 5000};", "�")])
def test_long_references(reference, text):
    assert main_text(f"<p>{reference}</p>") == text


@pytest.mark.parametrize("reference", ["&#65;", "&#065", "&#00000065;", "&#00000065x", "&#99999999;", "&#9999999;", "&#00000000;", "&#1114111;", "&#128512;", "&#x41;", "&#;", "&#00000128;", "&amp;#00000065;"])
def test_short_references_are_as_in_the_library(reference):
    assert main_text(f"<p>a{reference}b</p>") == f"a{html.unescape(reference + 'b')}"
