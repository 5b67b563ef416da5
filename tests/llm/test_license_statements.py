"""License statements inside long lines and beside each other."""

import textwrap

import pytest

from wherry.llm import license_scan

PROSE = "In the early morning the boats came back to the harbour with more fish than anyone there could remember having seen in one day. "
STATEMENTS = {n: license_scan.TEMPLATES[n][0] for n in ("MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0", "MPL-2.0")}


def licenses(text):
    return [f.license for f in license_scan.scanner(license_scan.TEMPLATES).scan(text)]


@pytest.mark.parametrize("name", STATEMENTS)
@pytest.mark.parametrize("times", [1, 3, 20])
def test_a_statement_inside_a_long_line(name, times):
    assert licenses(PROSE * times + STATEMENTS[name] + " " + PROSE * max(1, times // 4)) == [name]


@pytest.mark.parametrize("text", ["All that prose has no terms of its own, and a license to fish is not one. ", PROSE + "The license was lost."])
def test_prose_with_a_license_word_stays_without(text):
    assert licenses(text + PROSE * 5) == [None]


@pytest.mark.parametrize("between", ["\n", " ", " Or, at your choice: "])
def test_every_license_of_a_block_is_a_row(between):
    names = ["MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", "BSD-3-Clause", "All-Rights-Reserved"]
    assert licenses(between.join(license_scan.TEMPLATES[n][0] for n in names)) == names


def test_one_sentence_with_two_licenses():
    assert licenses("Licensed under the MIT license or the Apache License, Version 2.0, as you like.") == ["MIT", "Apache-2.0"]


@pytest.mark.parametrize("name", ["MIT-text", "Apache-2.0-header", "BSD-text", "GPL-header"])
@pytest.mark.parametrize("width", [50, 72])
def test_a_wrapped_text_is_one_block(name, width):
    lines = textwrap.wrap(license_scan.TEMPLATES[name][0], width)
    found = license_scan.scanner(license_scan.TEMPLATES).scan("\n".join([PROSE, *lines, PROSE]))
    assert [(f.license, f.line, f.text, f.missing, f.added) for f in found] == [(name, 1, "\n".join(lines), "", "")]


def test_the_first_line_of_a_text_is_not_the_text():
    lines = textwrap.wrap(license_scan.TEMPLATES["MIT-text"][0], 72)
    assert licenses("\n".join([lines[0], PROSE, PROSE])) == [None]


@pytest.mark.parametrize("seed", range(12))
def test_generated_wrappings_are_found_by_name_and_place(seed):
    """Full texts and sentences at random widths, indented, commented, in capitals or with prose before them; all are found, in order, and nothing else."""
    import random

    r = random.Random(seed)
    lines, want = [], []
    for name in r.sample([n for n in license_scan.TEMPLATES if n != "All-Rights-Reserved"], 4):
        text = license_scan.TEMPLATES[name][0]
        full = len(license_scan.wording(text)) >= license_scan.FULL_WORDS
        text = text.upper() if r.random() < 0.2 else text
        mark = r.choice(["", "    ", "# ", " * ", "// ", "> "])
        wrapped = textwrap.wrap(text, r.randint(45, 110)) if full else [PROSE * r.randrange(3) + text]
        lines += [PROSE] * r.randint(1, 3) + [mark + x for x in wrapped]
        want.append((name, len(lines) - len(wrapped)))
    found = license_scan.scanner(license_scan.TEMPLATES).scan("\n".join([*lines, PROSE]))
    assert [(f.license, f.line) for f in found] == want


def test_a_very_long_line_is_scanned_whole():
    text = PROSE * 20_000 + license_scan.TEMPLATES["MIT"][0] + " " + PROSE * 10
    assert licenses(text) == ["MIT"]
