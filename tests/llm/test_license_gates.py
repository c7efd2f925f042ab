"""The keywords of licence rules never hide a match."""

from re import _parser

import pytest

from quorumdf.llm import licenses
from quorumdf.llm.license_rules import signatures


def samples(tree):
    """Texts that the pattern matches: every branch, every optional part, both ends of a class."""
    out = [""]
    for op, arg in tree:
        kind = str(op)
        if kind == "LITERAL":
            parts = [chr(arg)]
        elif kind in ("AT", "ASSERT_NOT"):
            parts = [""]
        elif kind == "SUBPATTERN":
            parts = samples(arg[3])
        elif kind == "BRANCH":
            parts = [x for branch in arg[1] for x in samples(branch)]
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            parts = [*([""] if arg[0] == 0 else []), *samples(arg[2])]
        elif kind == "IN":
            parts = [chr(c) for o, v in arg for c in ([v] if str(o) == "LITERAL" else v)]
        else:
            assert kind == "ANY"
            parts = ["x"]
        out = [a + b for a in out for b in parts]
    return out


def test_every_sample_of_a_pattern_has_a_keyword():
    for order, kind, label, keyword, pattern in signatures():
        rule = licenses._whole_words(pattern)
        for sample in samples(_parser.parse(pattern)):
            for text in (sample, sample + "x", sample + " x"):  # an open end may lie within a word
                stream, words = licenses.normalise(text)
                if rule.search(stream):
                    assert {k.encode() for k in keyword.split(",")} & set(words), (order, label, pattern, text)


@pytest.mark.parametrize(
    "text, label",
    [("LGPLv2.1", "lgpl-2.1"), ("MPLv2.0", "mpl-2"), ("GPL2", "gpl-2"), ("GPL3", "gpl-3"), ("FreeBSD License", "bsd-2"), ("AGPL3", "agpl-3"), ("You may not use this file except in compliance with the License", "apache-2")],
)
def test_mentions_without_the_bare_keyword(text, label):
    assert licenses.scan(text)["labels"] == label


def test_a_rule_with_two_keywords_present_counts_once():
    assert licenses.scan("GPL2")["n_detections"] == 1 and licenses.scan("gpl 2 and gpl2")["n_detections"] == 2
