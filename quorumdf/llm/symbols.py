"""A shared vocabulary of 64 symbols for character n-gram models.

Every byte of a text is one symbol: each lower-case letter its own, capitals in
six classes, digits, white space, common punctuation, and the bytes of other
alphabets by their lead or their two low payload classes.  The vocabulary is the
same for every model and does not depend on data, so a table of order n never
has more than 64 ** n entries.
"""

from __future__ import annotations

import numpy as np

SIZE = 64


def _table() -> np.ndarray:
    t = np.zeros(256, np.int32)
    t[0x61:0x7B] = np.arange(1, 27)
    t[0x41:0x5B] = 27 + np.arange(26) // 5
    t[0x30:0x3A] = 33
    t[0x20], t[0x0A], t[0x0D], t[0x09] = 34, 35, 35, 34
    for i, c in enumerate(b".,;:!?'\"-()/*#$%&|<>@="):
        t[c] = 36 + min(i, 15)
    t[0x80:0xC0] = 52 + (np.arange(64) >> 3)  # continuation bytes
    t[0xC0:0x100] = np.where(np.arange(64) == 3, 60, np.where(np.arange(64) < 32, 61, 62))
    return t


SYMBOL = _table()


def codes(raw: bytes, order: int) -> np.ndarray:
    """Codes of all n-grams of the order in a text that starts with order - 1 blanks."""
    s = np.concatenate([np.zeros(order - 1, np.int32), SYMBOL[np.frombuffer(raw, np.uint8)]])
    out = np.zeros(len(raw), np.int32)  # 64 ** 4 fits
    for k in range(order):
        out = out * SIZE + s[k : k + len(raw)]
    return out
