"""Conditional compression decides which templates are compared, and which goes first."""

import pytest

from wherry.llm import license_scan

PROSE = "In the early morning the boats came back to the harbour with more fish than anyone there could remember having seen in one day. "


def test_identifying_words_far_from_any_wording_are_not_compared(monkeypatch):
    scan = license_scan.Scanner(license_scan.TEMPLATES)
    compared = []
    align = scan._align
    monkeypatch.setattr(scan, "_align", lambda name, *rest: compared.append(name) or align(name, *rest))
    text = "".join(PROSE + word + " " for word in ("mit", "apache", "2.0", "mozilla", "cc0", "by", "4.0", "lesser", "3", "public", "domain"))
    assert [f.license for f in scan.scan(text + "a license to fish. " + PROSE)] == [None] and compared == []
    assert [f.license for f in scan.scan(text + license_scan.TEMPLATES["MPL-2.0"][0] + " " + PROSE)] == ["MPL-2.0"] and compared == ["MPL-2.0"]


def test_the_template_that_explains_more_bytes_goes_first():
    templates = {"A": ("aa bb license xx", "license"), "B": ("license horticultural documentation xx", "license")}  # alike in words
    assert [f.license for f in license_scan.Scanner(templates).scan("aa bb license horticultural documentation")] == ["B"]


def test_without_compression_nothing_is_near():
    scan = license_scan.Scanner(license_scan.TEMPLATES)
    scan.given_words = {n: scan.plain for n in scan.given_words}
    assert {f.license for text, _ in license_scan.TEMPLATES.values() for f in scan.scan(text)} == {None}


@pytest.mark.parametrize("name", license_scan.TEMPLATES)
def test_a_word_longer_than_any_templates_does_not_hide_a_statement(name):
    text = f"{'QmFzZTY0' * 5000} {license_scan.TEMPLATES[name][0]} {'x7' * 5000} {PROSE}"
    assert [f.license for f in license_scan.Scanner(license_scan.TEMPLATES).scan(text)] == [name]
