"""Licence scan by ordered signature rules.

Every whole text is lower-cased and reduced to its words with one space
between.  A rule runs only when one of its keywords is among the words.  Of overlapping
detections, one whose interval lies inside that of a detection with a higher
priority (kind, then length, then order in the rule list) is dropped.  The base
phrases are rules that nothing suppresses.

Defined results: null and empty texts have no words, no labels and score 0;
rows that repeat an id give one result row each; texts of any length are read
whole; detections of equal place and rank stay by the order of the rules; other
columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text
from .license_rules import BASE_PHRASES, KINDS, signatures

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_BASE = [(re.compile(rb"(?<![^ ])" + p.encode() + rb"(?![^ ])"), label, p.split()[0].encode(), p.count(" ") + 1) for p, label in BASE_PHRASES]
_COMPILED: dict[bytes, list] = {}


def _whole_words(pattern: str) -> re.Pattern:
    """Word edges are spaces here: bytes of other alphabets belong to words."""
    inner = pattern.removeprefix(r"\b").replace(r"\b", "(?![^ ])")
    return re.compile(f"(?<![^ ])(?:{inner})".encode())


def _rules() -> dict[bytes, list]:
    """Rules by keyword, compiled once per process."""
    if not _COMPILED:
        by_word: dict[bytes, list] = {}
        for order, kind, label, keyword, pattern in signatures():
            rank, confidence = KINDS[kind]
            rule = (_whole_words(pattern), rank, order, label, confidence)
            for word in keyword.split(","):
                by_word.setdefault(word.encode(), []).append(rule)
        _COMPILED.update(by_word)
    return _COMPILED


def normalise(text: str) -> tuple[bytes, list[bytes]]:
    """The words of the text, and the stream with one space between them."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    return b" ".join(words), words


def suppress(found: list[tuple[int, int, int, int, str, float]]) -> list[tuple[int, int, int, int, str, float]]:
    """Drop detections contained in the interval of one of higher priority.

    ``found`` holds (start, end, rank, order, label, confidence).  Going from
    high to low priority, the kept intervals that can contain a later one are
    those that start no later; a running maximum of ends over sorted starts
    answers that, so n detections cost n log n plus the kept starts touched.
    """
    import bisect

    kept, starts, reach = [], [], []
    for d in sorted(found, key=lambda d: (-d[2], -(d[1] - d[0]), d[3], d[0])):
        i = bisect.bisect_right(starts, d[0])
        if i and reach[i - 1] >= d[1]:
            continue
        kept.append(d)
        starts.insert(i, d[0])
        reach.insert(i, max(reach[i - 1] if i else 0, d[1]))
        j = i + 1
        while j < len(reach) and reach[j] < reach[i]:
            reach[j] = reach[i]
            j += 1
    return kept


def scan(text: str) -> dict:
    """All results for one text; detections are (first word, words, kind rank, label)."""
    stream, words = normalise(text)
    present = set(words)
    base, found = [], []
    for pattern, label, keyword, size in _BASE:
        if keyword in present:
            at = seen = 0
            for m in pattern.finditer(stream):
                seen += stream.count(b" ", at, m.start())
                at = m.start()
                base.append((seen, size, label))
    rules = _rules()
    wanted = {rule[2]: rule for keyword in rules.keys() & present for rule in rules[keyword]}  # once, whatever the keywords present
    for pattern, rank, order, label, confidence in wanted.values():
        found += [(m.start(), m.end(), rank, order, label, confidence) for m in pattern.finditer(stream)]
    kept = suppress(found)
    base_labels = sorted({b[2] for b in base})
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((b[0] for b in base), default=None),
        "last_word": max((b[0] for b in base), default=None),
        "base_labels": ",".join(base_labels),
        "labels": ",".join(sorted({*base_labels, *(d[4] for d in kept)})),
        "score": max([0.0, *(0.95 for _ in base), *(d[5] for d in kept)]),
        "n_detections": len(kept),
    }


_FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_detections long"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the words, base places, labels and score."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def run(batches):
        for pdf in batches:
            found = [scan(t) for t in pdf["text"]]
            out = {"doc_id": pdf["doc_id"]}
            for n in names:
                kind = "Int64" if n in ("first_word", "last_word") else None
                out[n] = pd.array([f[n] for f in found], dtype=kind) if kind else [f[n] for f in found]
            yield pd.DataFrame(out)

    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_FIELDS}")


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
