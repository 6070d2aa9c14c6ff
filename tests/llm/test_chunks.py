import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from shiftloom.llm import chunks as c, spans

from .conftest import ODD, words


def gear_cuts(data):
    """Byte by byte, as the hash is defined."""
    ends, at, rolled = [], 0, 0
    for k, byte in enumerate(data):
        rolled = ((rolled << 1) + int(c.GEAR[byte])) % 2**32
        proposed = rolled >> (32 - c.CUT_BITS) == 0 and k + 1 - at >= c.MIN_CHUNK
        if k + 1 - at > c.MAX_CHUNK:
            ends.append(at := at + c.MAX_CHUNK)
            proposed = proposed and k + 1 - at >= c.MIN_CHUNK
        if proposed:
            ends.append(at := k + 1)
    return [*ends, len(data)] if at < len(data) else ends


@given(st.integers(0, 10**6), st.integers(0, 600))
@settings(max_examples=40, deadline=None)
def test_cuts_equal_the_rolling_hash(seed, n):
    data = words(seed, n).encode()
    assert c.cuts(np.frombuffer(data, np.uint8)) == gear_cuts(data)


def test_long_texts_without_cuts():
    for data in (b"a" * 2000, b"", b"ab", b"ab" * 700):
        ends = c.cuts(np.frombuffer(data, np.uint8))
        assert ends == gear_cuts(data) and max(np.diff([0, *ends]), default=0) <= c.MAX_CHUNK


def plain(texts):
    cut = []
    for t in texts:
        data = (t or "").encode()
        ends = gear_cuts(data)
        cut.append([(a, b, data[a:b]) for a, b in zip([0, *ends], ends)])
    counts = Counter(body for own in cut for _, _, body in own)
    return cut, counts


def test_equals_brute_force(stored):
    passage = words(800, 60)
    rows = ODD + [(100 + k, f"{words(k, 70)} {passage} {words(k + 50, 70)}") for k in range(12)]
    rows += [(200 + k, words(300 + k, 150)) for k in range(10)] + [(300, words(5, 120) * 3)]
    docs = stored(rows, 1)
    order = [(r.doc_id, r.text) for r in docs.collect()]
    cut, counts = plain([t for _, t in order])
    expected, owners = [], {}
    for k, own in enumerate(cut):
        data = (order[k][1] or "").encode()
        long = [x for x in spans.union((a, b) for a, b, body in own if counts[body] > 1) if x[1] - x[0] >= c.RUN]
        gone, repeated = [], 0
        for a, b, body in own:
            first = owners.setdefault(body, (k, a)) == (k, a)
            if counts[body] > 1 and any(x <= a and b <= y for x, y in long):
                repeated += b - a
                gone += [] if first else [(a, b)]
        left = spans.kept_bytes(data, spans.union(gone))
        expected.append((str(order[k][0]), len(data), len(data) - len(left), repeated, hashlib.sha256(left).hexdigest()))
    found = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_repeated, r.kept_sha256) for r in c.report(docs).collect()]
    assert sorted(found) == sorted(expected)
    by = {x[0]: x for x in found}
    assert all(by[str(100 + k)][3] >= c.RUN for k in range(12)) and all(by[str(200 + k)][3] == 0 for k in range(10))
    assert c.report(stored([], 1)).count() == 0


def test_passages_of_51_words_in_two_documents(stored):
    rng = np.random.default_rng(3)
    rows, sizes = [], []
    for k in range(60):
        passage = " ".join("".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 10))) for _ in range(51))
        sizes.append(len(passage))
        rows += [(2 * k + j, f"{words(1000 + 2 * k + j, 70)} {passage} {words(2000 + 2 * k + j, 70)}") for j in range(2)]
    removed = {r.doc_id: r.n_removed for r in c.report(stored(rows, 1)).collect()}
    gone = [removed[2 * k] + removed[2 * k + 1] for k in range(60)]
    print("found", sum(x > 0 for x in gone), "mean size", sum(sizes) / 60, "mean removed", sum(gone) / 60)
    assert sum(x > 0 for x in gone) >= 59
