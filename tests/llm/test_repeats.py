from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import repeats

N = repeats.LENGTH


def cut(texts):
    """Remaining bytes, their number before, removed bytes and runs, by the definition."""
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i : i + N] for d in data for i in range(len(d) - N + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - N + 1):
            if times[d[i : i + N]] > 1:
                gone[i : i + N] = b"\1" * N
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((kept, len(d), sum(gone), runs))
    return out


def corpus(seed, n=40):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 8)))
    passages = [" ".join(word() for _ in range(k)) for k in (30, 45, 60, 120)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(pick.randint(0, 60)))]
        for _ in range(pick.randint(0, 3)):
            parts += [pick.choice(passages), " ".join(word() for _ in range(pick.randint(0, 30)))]
        texts.append("|".join(parts))
    for _ in range(6):
        copy = list(pick.choice(texts))
        for _ in range(2):
            if copy:
                copy[pick.randrange(len(copy))] = "X"
        texts.append("".join(copy))
    return texts + texts[:3]


def removed(frame, texts):
    found = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in frame.collect()}
    return [found[i] for i in range(len(texts))]


@pytest.mark.parametrize("seed", range(2))
def test_corpus(make, odd_texts, seed):
    texts = [*corpus(seed), *odd_texts, "ab" * 400, "z" * 199, "z" * 200, "y" * 201]
    assert removed(repeats.remove_repeats(make(texts)), texts) == cut(texts)


def test_crowded_anchors_are_counted(make, monkeypatch):
    monkeypatch.setattr(repeats, "MANY", 2)
    texts = corpus(5)
    assert removed(repeats.remove_repeats(make(texts)), texts) == cut(texts)


def test_small_transforms_and_chunks(make, monkeypatch):
    monkeypatch.setattr(repeats, "INDEXED", 1000)
    monkeypatch.setattr(repeats, "CHUNK", 300)
    texts = corpus(6)
    assert removed(repeats.remove_repeats(make(texts)), texts) == cut(texts)


def test_transform_finds_all_repeated_strings():
    pick = random.Random(4)
    base = [bytes(pick.choice(b"abcdefgh ") for _ in range(pick.randint(100, 900))) for _ in range(5)]
    for _ in range(25):
        parts = []
        for _ in range(pick.randint(1, 12)):
            part = bytearray(pick.choice(base)[pick.randint(0, 60) :])
            for _ in range(pick.randint(0, 2)):
                part[pick.randrange(len(part))] = pick.choice(b"xyz")
            parts.append(bytes(part))
        times = Counter(p[i : i + N] for p in parts for i in range(len(p) - N + 1))
        wanted = {(k, i) for k, p in enumerate(parts) for i in range(len(p) - N + 1) if times[p[i : i + N]] > 1}
        runs = zip(*repeats.repeated_strings(parts))
        assert {(int(k), int(first) + i) for k, first, n in runs for i in range(n)} == wanted


def test_hashes_of_windows():
    pick = random.Random(2)
    data = np.frombuffer(bytes(pick.choice(b"ab") for _ in range(2000)), np.uint8)
    for width in (1, 3, 32, 40, 128, 200):
        hashes = repeats.window_hashes(data, width).tolist()
        strings = [bytes(data[i : i + width]) for i in range(len(data) - width + 1)]
        assert len(hashes) == len(strings) and len(set(zip(hashes, strings))) == len(set(strings)) == len(set(hashes))


def test_odd_ids(make):
    one, two = "x" * 50 + "".join(chr(97 + i % 26) for i in range(400)), "other " * 3
    docs = make([one, one, two, two, None], ids=[1, 1, 1, None, None])
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs).collect())
    assert rows == [(0, 0, 0), (0, 18, 0), (1, 18, 0), (1, 450, 450), (1, 450, 450)]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("place, length", [(0, 200), (168, 200), (168, 368), (100, 250), (60, 240)])
def test_halves_hold_each_distance_once(place, length):
    """Down to single distances every string of a segment is in one part, and parts hold the bytes they share."""
    own = range(max(0, place - (length - repeats.LENGTH)), min(place, 168) + 1)
    data, found = bytes(i % 251 for i in range(length)), []

    def divide(low, high, place, data, base):
        for a, b, nearest, farthest in repeats._halves(data, place, low, high):
            start = place - farthest
            part = data[start : place - nearest + repeats.LENGTH]
            assert len(data[place - a : place - b + repeats.LENGTH]) == repeats.LENGTH - (b - a)
            if a == b:
                assert len(part) == repeats.LENGTH
                found.append(base + start)
            else:
                divide(a, b, farthest, part, base + start)

    divide(0, 168, place, data, 0)
    assert sorted(found) == sorted(place - distance for distance in own)


@pytest.mark.parametrize("many", [1, 20])
def test_a_line_in_every_text(make, monkeypatch, many):
    """Texts around one frequent line: some share more of what stands beside it, some enough for a string."""
    monkeypatch.setattr(repeats, "MANY", many)
    pick = random.Random(9)
    word = lambda n: "".join(pick.choice("abcdefghij ") for _ in range(n))
    line, left, right = word(60), word(300), word(300)
    texts = []
    for i in range(90):
        before = word(200) + left[len(left) - pick.choice([0, 0, 10, 70, 130, 200]) :] if i % 2 else word(250)
        after = right[: pick.choice([0, 0, 10, 70, 130, 200])] + word(200) if i % 3 else word(250)
        texts.append(before + line + after)
    texts += texts[:4]
    assert removed(repeats.remove_repeats(make(texts)), texts) == cut(texts)
