"""Base spans against the plain patterns; disguises and what must not be taken for one."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewmill.llm import private

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def by_definition(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+ -()5%bé\n２о", max_size=60))
def test_base_spans(text):
    assert private.base_spans(text) == by_definition(text)
    assert [s[:3] for s in private.find_spans(text) if s[3]] == by_definition(text)


def test_base_spans_of_dense_text():
    pick = random.Random(1)
    for _ in range(3000):
        text = "".join(pick.choice(["4", "0", "255", ".", " ", "-", "+1", "@", "x.y", "(2)"]) for _ in range(pick.randint(5, 40)))
        assert private.base_spans(text) == by_definition(text)


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("write bob [at] mail dot example.com now", "email", "bob [at] mail dot example.com"),
        ("jane(at)corp(dot)org!", "email", "jane(at)corp(dot)org"),
        ("me at home dot org", "email", "me at home dot org"),
        ("аdmin@ехample.com", "email", "аdmin@ехample.com"),
        ("j​ane@ex​ample.com", "email", "j​ane@ex​ample.com"),
        ("name @ example.com", "email", "name @ example.com"),
        ("call +one two zero two five five five zero one four three ok", "phone", "+one two zero two five five five zero one four three"),
        ("card ４５３９ 1488 0343 6467 end", "card", "４５３９ 1488 0343 6467"),
        ("vier fünf drei neun eins vier acht acht null drei vier drei sechs vier sechs sieben", "card", None),
        ("ip 192 dot 168 dot 1 dot 20", "ip", "192 dot 168 dot 1 dot 20"),
        ("ip 10․0․0․1", "ip", "10․0․0․1"),
    ],
)
def test_disguises(text, kind, span):
    found = [(k, text[s:e]) for k, s, e, base in private.find_spans(text) if not base]
    assert found == [(kind, span or text)]


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("to jоhn@example.com now", "email", "jоhn@example.com"),
        ("to jo​hn@example.com now", "email", "jo​hn@example.com"),
        ("to john [dot] smith@example.com now", "email", "john [dot] smith@example.com"),
        ("to john@example.cоm now", "email", "john@example.cоm"),
        ("ip 10.0.0.1２ now", "ip", "10.0.0.1２"),
        ("call +1 202 555 014３ now", "phone", "+1 202 555 014３"),
    ],
)
def test_disguises_in_one_part(text, kind, span):
    spans = private.find_spans(text)
    assert (kind, span) in [(k, text[s:e]) for k, s, e, base in spans if not base]
    assert [s[:3] for s in spans if s[3]] == by_definition(text)


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("ip one nine two dot one six eight dot one dot two zero", "ip", "one nine two dot one six eight dot one dot two zero"),
        ("ip one zero dot zero dot zero dot one now", "ip", "one zero dot zero dot zero dot one"),
        ("ip 10.zero.0.one now", "ip", "10.zero.0.one"),
        ("call +49 one 7 two 3 four 5 six 7 eight now", "phone", "+49 one 7 two 3 four 5 six 7 eight"),
        ("card 4539 1488 zero three 43 6467 end", "card", "4539 1488 zero three 43 6467"),
    ],
)
def test_short_runs_of_spelled_digits(text, kind, span):
    assert [(k, text[s:e]) for k, s, e, base in private.find_spans(text) if not base] == [(kind, span)]


@pytest.mark.parametrize("text", ["one or two of ten, three at most", "in 2024 one of 12 had two", "un deux, 3 trois. eins zwei."])
def test_digit_words_in_prose(text):
    assert private.find_spans(text) == []


@pytest.mark.parametrize(
    "text", ["look at example.com.", "we met at noon, dot by dot", "one two three", "at the dot of ten", "m² at 5 dots", "seven of nine"]
)
def test_plain_prose_has_none(text):
    assert private.find_spans(text) == []


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "+1" + " (" * 100_000, "@" * 100_000, "one " * 50_000):
        private.find_spans(text)


def test_documents(make, odd_texts):
    texts = [*odd_texts, "a@b.co +1 (234) 555-0199", "a@b.co +1 (234) 555-0199"]
    docs = make(texts)
    rows = private.find_private(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [tuple(s) for s in r.spans] == private.find_spans(texts[r.doc_id] or "")
        assert (r.body, r.q) == ("b", 2)
    assert private.find_private(docs.limit(0)).count() == 0
