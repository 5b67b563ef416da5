"""The shape of a word is that of the whole word."""

from wherry.llm.quality_classifier import Hasher, shape


def test_shape_reads_past_64_characters():
    a, b = "x" * 64 + "9A", "x" * 64 + "-a"
    assert (shape(a), shape(b)) == ("x0X", "x-x")
    assert Hasher()._slots(a)[1] != Hasher()._slots(b)[1]
