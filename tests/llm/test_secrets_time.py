"""The scan's time on crafted texts, and its spans against other matchers."""

import random
import re
import time

import pytest

from uptake.llm import secrets

PATTERNS = {
    "hosting": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36,}"),
    "chat": re.compile(rb"xox[abprs]-[A-Za-z0-9-]{20,}"),
    "signed": re.compile(rb"eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,}", re.ASCII),
}
PIECES = [
    b"eyJ", b"eyJ", b"eyJeyJeyJ", b".", b".eyJ", b"abcdefgh", b"-", b"x" * 30, b" ", b"ghp_", b"gho_", b"A1" * 18, b"xoxb-", b"xoxa", b"1-2-" * 6,
    b"\n", b"-----BEGIN ", b"RSA ", b"PRIVATE KEY-----", b"-----END ", b"MIIabc+/=", b"K: v", b"token=", b"secret :  ", b"deadbeef" * 3, b"AKIA", b"9" * 17, b"\xc3\xa4",
]


def texts(n, most):
    rng = random.Random(31)
    return [b"".join(rng.choices(PIECES, k=rng.randrange(1, most))) for _ in range(n)]


def test_spans_of_counted_rules_match_another_matcher():
    scanner = secrets.Scanner()
    hits = 0
    for data in texts(3000, 40):
        got = scanner.spans(data)
        for kind, pattern in PATTERNS.items():
            want = [m.span() for m in pattern.finditer(data)]
            assert [(s, e) for k, s, e in got if k == kind] == want, (kind, data)
            hits += len(want)
    assert hits > 300


def test_reading_backwards_changes_no_span():
    early, never = secrets.Scanner(patience=0), secrets.Scanner(patience=1 << 40)
    for data in texts(1500, 30):
        assert early.spans(data) == never.spans(data), data


CRAFTED = {
    "signed run": b"eyJ" * 350_000 + b".eyJ" + b"a" * 8,
    "signed parts": b"eyJaaaaaaaa.eyJ" * 70_000,
    "signed at the end": b"eyJ" * 350_000 + b".eyJabcdefgh.abcdefgh",
    "private heads": b"-----BEGIN PRIVATE KEY----- " * 40_000,
    "private headers": b"-----BEGIN PRIVATE KEY-----\nK: -----BEGIN " * 25_000,
    "private openings": b"-----BEGIN " * 100_000 + b"PRIVATE KEY-----",
    "dashes": b"-" * 1_000_000 + b"-----BEGIN PRIVATE KEY-----",
    "settings": b"token" + b" " * 1_000_000 + b"token=secret" * 10,
    "words": b"password" * 125_000 + b"=abcdefg",
    "hosting": b"ghp_" * 250_000 + b"a" * 36,
    "chat": b"xoxb-" * 200_000,
    "access": b"AKIA" * 250_000,
    "hex": b"0123456789abcdef" * 62_500,
}


@pytest.mark.parametrize("name", CRAFTED)
def test_a_megabyte_takes_seconds(name):
    began = time.process_time()
    secrets.scanner().spans(CRAFTED[name])
    assert time.process_time() - began < 12


def test_a_late_match_after_many_starts():
    ((kind, start, end),) = [x for x in secrets.scanner().spans(CRAFTED["signed at the end"]) if x[0] == "signed"]
    assert (kind, start, end) == ("signed", 0, len(CRAFTED["signed at the end"]))
    broken = b"eyJ" * 1000 + b" " + CRAFTED["signed at the end"]
    assert [x[1:] for x in secrets.scanner().spans(broken) if x[0] == "signed"] == [(3001, len(broken))]
