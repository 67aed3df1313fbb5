"""The one-pass scan of all rules against plain regular expressions."""

import random
import re

import pytest

from kubus.llm import secrets
from kubus.llm.automaton import compile_matcher, compile_scanner, parse

PIECES = ["token", "secret", "password", "passwd", "api_key", "APIKEY", " ", "  ", "=", ":", '"', "'",
          "AKIA", "A", "Z9", "abc", "0123456789abcdef", "f", "g", "xoxb-", "xoxp", "-", "ghp_", "gho_",
          "AIza", "_", ".", "-----BEGIN ", "-----", "RSA ", "PRIVATE KEY", "PRIVATE KEY-----", "é", "\n",
          "x" * 12, "a" * 35, "Z" * 40]


def plain_spans(text):
    found = []
    for k, rule in enumerate(secrets.RULES):
        flags = re.IGNORECASE | re.ASCII if rule.any_case else re.ASCII
        for m in re.finditer(rule.pattern, text, flags):
            start = re.match(rule.prefix, m.group(), flags).end() if rule.prefix else 0
            if len(m.group()) - start >= rule.min_length:
                found.append((m.start(), k, m.end(), rule.kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def test_all_kinds_match_regular_expressions():
    rng = random.Random(11)
    kinds = set()
    for _ in range(4000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 14)))
        expected = plain_spans(text)
        assert secrets.spans(text.encode()) == expected, text
        kinds |= {s[2] for s in expected}
    assert kinds == {r.kind for r in secrets.RULES}


def test_long_texts_are_settled_on_the_way():
    rng = random.Random(12)
    words = ["ab", "cafe", "token=", "deadbeefdeadbeef0123", "AKIA" * 6, "the", " ", " ", "\n"]
    text = "".join(rng.choices(words, k=30_000))
    assert secrets.spans(text.encode()) == plain_spans(text)
    assert secrets.spans(b"a1" * 200_000) == [(0, 400_000, "hex")]
    assert secrets.spans("é€".encode() * 1000 + b"a1" * 8) == [(2000, 2016, "hex")]


def brute_matches(text, pattern):
    """Leftmost longest, not overlapping, by trying every stretch."""
    found, at = [], 0
    while at < len(text):
        end = next((e for e in range(len(text), at, -1) if re.fullmatch(pattern, text[at:e])), at)
        if end > at:
            found.append((at, end))
        at = max(end, at + 1)
    return found


def test_overlapping_rules_meet_every_longest_match():
    rules = ["a(b|bc)*d?", "ab+|bca", "(a|b)+c", "(ab?c|a)(bcd)?", "b{2,3}a?", "[a-c]d{2}", "a(ba)+", r"\x61b*\."]
    start = compile_scanner([(r, False) for r in rules]).rows()[0]
    rng = random.Random(13)
    for _ in range(3000):
        text = "".join(rng.choices("aabbcd.", k=rng.randint(0, 16)))
        met = secrets.matches(text.encode(), start, len(rules))
        assert met == [brute_matches(text, r) for r in rules], text


def test_patterns_outside_the_subset_are_refused():
    for pattern in ["a.b", "^a", "a$", "[^a]", r"\d", "a*?", "é", "a)"]:
        with pytest.raises(ValueError):
            parse(pattern)
    with pytest.raises(ValueError):
        compile_scanner([("a*", False)])


def test_matcher_takes_the_longest_match():
    matcher = compile_matcher("ab*(cb)?", any_case=True)
    assert matcher.longest(b"xABBcbb", 1) == 6
    assert matcher.longest(b"xABBcc", 1) == 4
    assert matcher.longest(b"xABB", 0) == -1
