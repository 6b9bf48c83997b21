"""The alignment kernel on small cases."""

import pytest

from tagweave.functions import align as A


@pytest.mark.parametrize(
    "hay, needle, threshold, span",
    [("abc", "abc", 0.8, (0, 3)), ("xyz abc 123", "abc", 0.8, (4, 7)), *[(f"{c}abc{d}", "abc", 0.8, (1, 4)) for c, d in ("()", "[]", ",,", "--", "::", ";;", "..", "\t\t", "\n\n")],
     ("abc.", "abc.", 0.8, (0, 4)), ("abc.", "abc .", 0.9, (0, 4)), ("abc .", "abc.", 0.9, (0, 5)), ("Smith ,J .A .", "Smith, J. A.", 0.5, (0, 13)), ("PO Box 12345", "P.O. Box 12345", 0.8, (3, 12)),
     ("nothing here at all", "completely different", 0.8, None), ("", "abc", 0.8, None), ("abc", "", 0.8, None), ("some text with a smal typo", "a small typo", 0.8, (15, 26))],
)
def test_find(hay, needle, threshold, span):
    assert A.find(hay, needle, threshold) == span


def test_strided():
    two = "abc 123456789 def"
    assert A.strided(two, "abc def", 30, 30, 0.8, 2) == [[(0, 0, 4)], [(14, 4, 3)]]
    assert A.strided("abc 123456789 defghi", "abc defghi", 30, 30, 0.8, 2) == [[(0, 0, 3)], [(13, 3, 7)]]
    assert A.strided(two, "abc def", 30, 30, 0.8, 1) == []
    for length in (5, 12, 20):
        assert A.strided("0123456789abc", "abc", length, 5, 0.8) == [[(10, 0, 3)]]
    assert A.strided("a123456789abc", "abc", 5, 5, 0.8) == [[(10, 0, 3)]]


def test_windows():
    assert A.window_size(20, 10, 0.8, 1) == (48, 36)
    assert A.window_size(200, 10, 0.8, 100) == (100, 88)
    assert A.window_size(20, 10, 0.8, 100) == (20, 20)
    words = [f"w{i * i}x" for i in range(3000)]
    text = " ".join(words)
    needle = " ".join(words[2000:2030]).replace("w4004001x", "w400x01x")
    assert A.find(text, needle) == (text.index(words[2000]), text.index(words[2029]) + len(words[2029]))


def test_all_and_ranges():
    assert list(A.find_all("abc abc abc", "abc")) == [(0, 3), (4, 7), (8, 11)]
    assert A.select_ranges([(0, 3), (100, 110), (112, 120), (500, 503)]) == [(100, 110), (112, 120)]
    assert A.select_ranges([]) == []
    assert A.join_with_ranges(["a", "bc"], [" ", "\n"]) == ("a bc", [(0, 1), (2, 4)])
    assert A.join_with_ranges([]) == ("", [])
