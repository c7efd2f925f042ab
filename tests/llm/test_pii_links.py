"""Pseudonyms against a plain network and plain validators, over documents whose values are known."""

import datetime
import hashlib
import random
import re

import pytest

from quorumdf.llm import pii

KEY = b"key of the test"


def feistel(value, n, tweak):
    """One round after the other, and again until the number is in range."""
    secret = hashlib.blake2b(KEY, digest_size=32).digest()
    width = ((n - 1).bit_length() + 1) // 2
    size = (width + 7) // 8
    while True:
        left, right = value >> width, value % (1 << width)
        for r in range(8):
            body = b"\0" + bytes([r]) + f"{tweak}:{n}".encode() + b"|" + right.to_bytes(size, "big")
            out = hashlib.blake2b(body, key=secret, digest_size=max(8, size)).digest()[:size]
            left, right = right, left ^ int.from_bytes(out, "big") % (1 << width)
        value = (left << width) + right
        if value < n:
            return value


def luhn_ok(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0


def fill(shape, digits):
    for d in digits:
        shape = re.sub(r"\d", "#" + chr(ord("a") + int(d)), shape, count=1)
    return re.sub("#(.)", lambda m: str(ord(m.group(1)) - ord("a")), shape)


def planted(rnd):
    """(value, expected pseudonym) of one value of each kind, written in some form."""
    local = f"{rnd.randint(1000000000, 9999999999)}"
    phone = rnd.choice([f"+44 {local[:2]} {local[2:6]} {local[6:]}", f"+44{local}", f"+44-{local[:4]}-{local[4:7]}-{local[7:]}"])
    phone_out = fill(phone, "44" + f"{feistel(int(local), 10**10, 'phone44'):010d}")
    body = "4" + "".join(str(rnd.randint(0, 9)) for _ in range(14))
    card = next(body + str(c) for c in range(10) if luhn_ok(body + str(c)))
    new = "4" + f"{feistel(int(card[1:-1]), 10**14, 'card16'):014d}"
    card_out = next(new + str(c) for c in range(10) if luhn_ok(new + str(c)))
    shape = rnd.choice(["{}{}{}{}", "{}-{}-{}-{}", "{} {} {} {}"])
    cut = lambda s: shape.format(s[:4], s[4:8], s[8:12], s[12:])
    first = datetime.date(1900, 1, 1)
    days = (datetime.date(2100, 1, 1) - first).days
    at = rnd.randrange(days)
    day_out = first + datetime.timedelta(feistel(at, days, "date(2, 2)False"))
    octets = [rnd.randint(0, 255) for _ in range(4)]
    ip = feistel(int.from_bytes(bytes(octets), "big"), 1 << 32, "ip").to_bytes(4, "big")
    return [
        (phone, phone_out),
        (cut(card), cut(card_out)),
        ((first + datetime.timedelta(at)).isoformat(), day_out.isoformat()),
        (".".join(map(str, octets)), ".".join(map(str, ip))),
    ]


def test_documents_equal_brute_force(spark):
    rnd, rows, want = random.Random(5), [], {}
    for i in range(40):
        values = planted(rnd)
        rnd.shuffle(values)
        words = ["le mot", "und der", "a line\nmore", "x" * (50_000 if i == 3 else 5)]
        rows.append((i, " ; ".join(w + " , " + v for w, (v, _) in zip(words, values))))
        want[i] = (" ; ".join(w + " , " + v for w, (_, v) in zip(words, values)), 4, "card,date,ip,phone")
    rows += [(i, None) for i in (90, 90)] + [(91, ""), (92, "no values here 12 345")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' as kinds", "7 as n_private")
    got = pii.pseudonymise_documents(docs, KEY, outputs=("n", "k"))
    assert got.columns == ["doc_id", "text", "kinds", "n_private", "n", "k"]
    for r in got.collect():
        assert (r.text, r.n, r.k) == want.get(r.doc_id, (dict(rows)[r.doc_id], 0, "")) and r.kinds == "mine"


@pytest.mark.parametrize("forms", [
    ["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+44 (20) 7946 0958"],
    ["+1 (212) 555-0187", "+12125550187", "(212) 555-0187", "212-555-0187", "212.555.0187"],
    ["+351 912 345 678", "+351912345678"],
])
def test_one_number_has_one_pseudonym_however_written(forms):
    perm = pii.Permutation(KEY)
    out = {re.sub(r"\D", "", pii.pseudonymise(f"call {f} now", perm)[0])[-9:] for f in forms}
    assert len(out) == 1 and re.sub(r"\D", "", forms[0])[-9:] not in out
    for f in forms:
        hidden = pii.pseudonymise(f"call {f} now", perm)[0]
        assert pii.pseudonymise(hidden, perm, back=True)[0] == f"call {f} now"


def test_the_key_is_the_callers(spark):
    docs = spark.createDataFrame([(1, "call +442079460958")], "doc_id long, text string")
    with pytest.raises(TypeError):
        pii.pseudonymise_documents(docs)
    a, b = (pii.pseudonymise_documents(docs, k).first().text for k in (b"one", b"two"))
    assert a != b
