"""Private values beside upper-case words, and very long ones."""

import pytest

from quorumdf.llm import pii


@pytest.mark.parametrize(
    "text, values",
    [
        ("ES91 2100 0418 4502 0005 1332 BIC: X", ["ES91 2100 0418 4502 0005 1332"]),
        ("BE68 5390 0754 7034 BIC GEBABEBB", ["BE68 5390 0754 7034"]),
        ("BE68 5390 0754 7034 GB82 WEST 1234 5698 7654 32 END", ["BE68 5390 0754 7034", "GB82 WEST 1234 5698 7654 32"]),
        ("AB12 CODE WORD BE68539007547034 OK", ["BE68539007547034"]),
        ("BE68 5390 0754 7035 BIC", []),
    ],
)
def test_an_iban_ends_before_an_upper_case_word(text, values):
    perm = pii.Permutation(b"key")
    hidden, spans = pii.pseudonymise(text, perm)
    assert [text[a:b] for a, b, _ in spans] == values and not any(v in hidden for v in values)
    assert pii.pseudonymise(hidden, perm, back=True)[0] == text


@pytest.mark.parametrize("size", [513, 5000, 60_000])
def test_long_secrets_and_local_parts(size):
    perm = pii.Permutation(b"key")
    value = ("aZ3" * size)[:size]
    text = f'token = "{value}" mail {value[:2000]}@mail.example.com'
    hidden, spans = pii.pseudonymise(text, perm)
    assert [k for _, _, k in spans] == ["secret", "email"] and value[:40] not in hidden
    assert pii.pseudonymise(hidden, perm, back=True)[0] == text
