import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shiftloom.llm import spans, suffixes as s

from .conftest import ODD, words


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p:p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        edges = np.flatnonzero(np.diff(np.r_[False, gone].astype(int)) == 1)
        out.append((len(d), len(d) - len(kept), len(edges), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passages = [words(900 + k, rng.randint(40, 160)) for k in range(6)]
    rows = []
    for k in range(60):
        parts = [words(seed * 1000 + k, rng.randint(1, 90)) for _ in range(2)]
        for _ in range(rng.randint(0, 2)):
            body = rng.choice(passages)
            cut = rng.randint(0, 30)
            parts.insert(rng.randint(0, len(parts)), body[cut:len(body) - rng.randint(0, 60)])
        rows.append((100 + k, " ".join(parts)))
    base = words(77, 400)
    for k in range(8):
        at = rng.randrange(len(base))
        rows.append((300 + k, base[:at] + rng.choice("xyz") + base[at + 1:]))
    return rows + [(400, "a" * 1500), (401, "b" * 700 + "a" * 450), (402, "xy" * 600), (403, words(5, 100) * 3),
                   (404, "teieö " * 300), (405, words(6, 40) + "teieö " * 200 + words(8, 90)), (406, "na " * 140 + "so " * 200)]


def digest(found):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)


@pytest.mark.parametrize("bits, stretch", [(6, 1 << 20), (4, 1 << 20), (6, 900)])
def test_equals_brute_force(stored, monkeypatch, bits, stretch):
    # Workers import the module with its own settings, so other settings are tried on the parsing alone.
    rows = ODD + corpus(bits)
    if (bits, stretch) != (6, 1 << 20):
        monkeypatch.setattr(s, "PERIOD_BITS", bits)
        monkeypatch.setattr(s, "STRETCH", stretch)
        s._powers.cache_clear()
        texts = [np.frombuffer((t or "").encode(), np.uint8) for _, t in rows]
        found = [[b for _, p in s.stretches(t) for b in [s.bundles(p)]] for t in texts]
        for text, parts in zip(texts, found):
            starts = [p for (base, _), (_, _, _, lo, hi) in zip(s.stretches(text), parts) for a, b in zip(lo, hi) for p in range(base + a, base + b + 1)]
            assert sorted(set(starts)) == list(range(max(0, len(text) - s.LENGTH + 1)))
        s._powers.cache_clear()
        return
    assert digest(s.report(stored(rows)).collect()) == sorted(plain([t for _, t in rows], s.LENGTH))


def test_classes_of_many_bundles(stored, monkeypatch):
    monkeypatch.setattr(s, "CLASS", 1)  # read on the driver
    rows = ODD + corpus(3)
    assert digest(s.report(stored(rows)).collect()) == sorted(plain([t for _, t in rows], s.LENGTH))


def test_hashes_do_not_depend_on_place():
    data = np.frombuffer(words(3, 200).encode(), np.uint8)
    twice = s.Hashes(np.r_[data, data])
    at = np.arange(0, len(data) - 50)
    assert (twice.first(at, at + 50) == twice.first(at + len(data), at + len(data) + 50)).all()
    assert (twice.second(at, at + 50) == twice.second(at + len(data), at + len(data) + 50)).all()


def test_spans():
    assert spans.union([(5, 9), (0, 2), (2, 4), (6, 7)]) == [(0, 4), (5, 9)]
    assert spans.kept_bytes(b"0123456789", [(0, 4), (5, 9)]) == b"49"


def test_empty_table(stored):
    assert s.report(stored([], 1)).count() == 0
