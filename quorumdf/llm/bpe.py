"""Byte-pair encoding and decoding through a merge-gadget automaton.

Method.  The deterministic automaton over tokens starts as one state per byte
with every arc present.  The merges are applied in rank order; the gadget of
merge (a, b) -> ab

  * removes arc ``b`` from the state reached by ``a`` (that pair now merges),
  * adds arc ``ab`` wherever arc ``a`` is present and its state still has ``b``,
  * and makes the state of ``ab`` a copy of the state of ``b`` as it is then.

A state is therefore the last token read, and copies share their past: the
compiled form keeps, per token, the two states that it was copied from and the
rank at which that happened, plus the removed arcs with their ranks.  An arc is
looked up in a transition table that is filled from this form on first use.

Encoding is deterministic.  A row of tokens that the merges give is one for each
of its prefixes, too, so after every byte of a pre-split word the automaton is in
exactly one state, the last token of the bytes so far.  Going from left to right,
the state after a byte is the one token that ends there and that the table has as
an open arc out of the state where it begins; nothing is tried again.  The path
is then read from the last state back.  Decoding emits the labels of the arcs.

The vocabulary, the merges and the special tokens are read from the tokenizer's
JSON file; the pre-splitting pattern is the constant ``PRE_SPLIT``.  Nothing is
trained and the file is not copied.

Defined results: null and empty texts have no tokens; rows that repeat an id are
encoded each, equal texts alike; texts and words of any length are read whole;
other columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text

PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 400_000
CACHED_ARCS = 600_000
_SHORT = (2, 1)


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, symbol -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class MergeAutomaton:
    """Compiled merges: states are tokens, arcs are the tokens that may follow."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int] | None = None):
        self.ids = vocab
        self.labels = {i: label for label, i in vocab.items()}
        self.special = dict(special or {})
        self.labels.update({i: s.encode("utf-8") for s, i in self.special.items()})
        self.born: dict[int, int] = {}  # state -> rank of the gadget that made it; bytes have none
        self.copied: dict[int, tuple[int, int]] = {}  # state ab -> (a, b)
        self.removed: dict[tuple[int, int], int] = {}  # arc b out of state a -> rank
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocab[a], vocab[b], vocab[a + b])
        self.arcs: dict[tuple[int, int], bool] = {}
        #: Tokens that are a path of one arc: both parts are, and they were still apart at the token's birth.
        self.reachable = {label: i for label, i in vocab.items() if i not in self.copied and len(label) == 1}
        for i, (a, b) in self.copied.items():  # by rank
            if self.labels[a] in self.reachable and self.labels[b] in self.reachable and self._resolve(a, b, self.born[i]):
                self.reachable[self.labels[i]] = i
        #: Sizes of the tokens that end in three bytes, from the longest; a shorter one may always end there.
        by_last: dict[bytes, set[int]] = {}
        for label in self.reachable:
            if len(label) > 2:
                by_last.setdefault(label[-3:], set()).add(len(label))
        self.sizes = {last: (*sorted(x, reverse=True), 2, 1) for last, x in by_last.items()}
        self.words = _Words(self)

    def _gadget(self, rank: int, a: int, b: int, ab: int) -> None:
        self.removed.setdefault((a, b), rank)
        if ab not in self.born:
            self.born[ab], self.copied[ab] = rank, (a, b)

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the finished automaton has arc ``token`` out of ``state``."""
        known = self.arcs.get((state, token))
        if known is None:
            known = self._resolve(state, token)
            if len(self.arcs) >= CACHED_ARCS:
                self.arcs.clear()
            self.arcs[(state, token)] = known
        return known

    def _resolve(self, x: int, y: int, at: int | None = None) -> bool:
        """Follow the copies back: did a gadget before rank ``at`` remove this arc?

        A state is a copy of that of its right part as it was before its own
        gadget.  An arc was added beside that of its left part, and a merge runs
        from left to right, so the gadget of the arc itself counts as well: of
        three equal tokens the first two merge.
        """
        at = len(self.copied) + len(self.removed) + 1 if at is None else at
        born, copied, removed = self.born, self.copied, self.removed
        while True:
            if removed.get((x, y), at) < at:
                return False
            bx, by = born.get(x, -1), born.get(y, -1)
            if bx < 0 and by < 0:
                return True
            if bx > by:
                at, x = bx, copied[x][1]
            else:
                at, y = by + 1, copied[y][0]

    def encode_word(self, word: bytes) -> list[int]:
        """The one accepted path of a pre-split word."""
        ids, arcs, sizes = self.reachable, self.arcs, self.sizes
        whole = ids.get(word)
        if whole is not None:
            return [whole]
        states, begins = [-1], [0]  # the state after each prefix, and where its token begins
        for end in range(1, len(word) + 1):
            for size in sizes.get(word[end - 3 : end], _SHORT) if end > 2 else _SHORT:
                begin = end - size
                if begin < 0:
                    continue
                token = ids.get(word[begin:end])
                if token is None:
                    continue
                state = states[begin]
                if begin:
                    is_open = arcs.get((state, token))
                    if is_open is None:
                        is_open = self.has_arc(state, token)
                    if not is_open:
                        continue
                states.append(token)
                begins.append(begin)
                break
            else:
                raise ValueError("a byte of the word is not in the vocabulary")
        path, at = [], len(word)
        while at:
            path.append(states[at])
            at = begins[at]
        path.reverse()
        return path

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if not self.special:
            return self._plain(text)
        if not hasattr(self, "_special_at"):
            self._special_at = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        out, at = [], 0
        for m in self._special_at.finditer(text):
            out.append(self._plain(text[at : m.start()]))
            out.append(struct.pack("<I", self.special[m.group()]))
            at = m.end()
        out.append(self._plain(text[at:] if at else text))
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, split_words(text)))

    def decode(self, ids: bytes) -> str:
        count = len(ids) // 4
        return b"".join(map(self.labels.__getitem__, struct.unpack(f"<{count}I", ids))).decode("utf-8", "replace")


class _Words(dict):
    """Encoded words, kept up to a bound."""

    def __init__(self, automaton: MergeAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        ids = self.automaton.encode_word(word.encode("utf-8"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = packed
        return packed


_SPLIT = regex.compile(PRE_SPLIT)
# Texts of ASCII and Latin letters alone are split by the same pattern with the
# classes written out, which the standard library's engine runs faster.
_LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_OTHER_THAN_LATIN = re.compile(rf"[^\t\n\r\x20-\x7e{_LATIN}]")
_SPLIT_LATIN = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LATIN}]+| ?[0-9]+| ?[^\t\n\r {_LATIN}0-9]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)


def split_words(text: str) -> list[str]:
    return (_SPLIT if _OTHER_THAN_LATIN.search(text) else _SPLIT_LATIN).findall(text)


_LOADED: dict[str, MergeAutomaton] = {}


def load_automaton(path: str) -> MergeAutomaton:
    """Compile the merges of a byte-level tokenizer file; one per process and path."""
    if path not in _LOADED:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        raw = lambda s: bytes(symbols[c] for c in s)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        _LOADED[path] = MergeAutomaton(vocab, [(raw(a), raw(b)) for a, b in pairs], special)
    return _LOADED[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """Encode every whole text and decode it again, in Arrow batches on the executors.

    Returns doc_id, ids (binary, little-endian unsigned 32-bit), n_tokens and,
    with ``decode``, the decoded text.  Null and empty texts have no tokens; the
    tokenizer file is read where the tasks run, so it has to be there.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, n_tokens long" + (", decoded string" if decode else "")

    def run(batches):
        automaton = load_automaton(path)
        for pdf in batches:
            ids = [automaton.encode(t) for t in pdf["text"]]
            out = {"doc_id": pdf["doc_id"], "ids": ids, "n_tokens": [len(x) // 4 for x in ids]}
            if decode:
                out["decoded"] = [automaton.decode(x) for x in ids]
            yield pd.DataFrame(out)

    return rows.mapInPandas(run, schema)


def token_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The operator's outputs as digests, hashed beside the encoding so ids stay on the executors."""
    out = encode_documents(docs, tokenizer)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
