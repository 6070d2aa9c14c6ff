import random

import numpy as np
from hypothesis import given, settings, strategies as st

from shiftloom.llm import setsketch as ss

from .conftest import ODD, words


def edited(seed, text, share):
    rng = random.Random(seed)
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in text.split())


def plain(text):
    found = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()]
    size = min(2, len(found))
    return {tuple(found[k:k + size]) for k in range(len(found) - size + 1)} if size else set()


def brute(rows):
    """Set sizes and classes of row numbers under all pairs of similarity 0.8."""
    sets, root = [plain(r[1]) for r in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return [len(s) for s in sets], root


def made():
    rows, base = list(ODD), words(1, 200)
    rows += [(100 + k, edited(k, base, 0.04)) for k in range(60)]  # pairs on both sides of the bound
    rows += [(200 + k, edited(k, words(50 + k // 2, 120), 0.03)) for k in range(30)]
    passage = words(99, 120)
    rows += [(300 + k, f"{words(400 + k, 50)} {passage}") for k in range(120)]  # a common passage, alike to 0.6
    rows += [(500 + k, passage) for k in range(5)]
    return rows


def groups(rows, root):
    out = {}
    for r, row in zip(root, rows):
        out.setdefault(r, []).append(str(row[0]))
    return sorted(map(sorted, out.values()))


def check(stored, rows):
    sizes, root = brute(rows)
    docs, found = stored(rows), {}
    for r in ss.near_copies(docs).collect():
        found.setdefault(r.best, []).append(str(r.doc_id))
    assert sorted(map(sorted, found.values())) == groups(rows, root)
    low = {}
    for r, row in zip(root, rows):
        low.setdefault(r, []).append(row[0])
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in low.items()}
    expected = sorted(((row[0], n, low[r], row[0] is not None and row[0] == low[r]) for row, n, r in zip(rows, sizes, root)), key=repr)
    assert sorted((tuple(r) for r in ss.report(docs).collect()), key=repr) == expected
    kept = ss.without_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))


def test_groups_equal_brute_force(stored):
    check(stored, made())
    assert ss.report(stored([], 1)).count() == 0


@given(st.integers(0, 1 << 30), st.integers(4, 60), st.sampled_from([(80, 100), (50, 100), (9, 10)]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_a_rarer_difference(seed, size, similarity):
    rng = np.random.default_rng(seed)
    base = rng.permutation(size + 30).astype(np.uint64)
    leader = np.sort(base[:size])

    def near(s, edits):
        kept = rng.choice(s, max(1, len(s) - rng.integers(0, edits + 1)), replace=False)
        return np.unique(np.r_[kept, rng.choice(base, rng.integers(0, edits + 1))])

    a = near(leader, 2 + size // 4)
    b = near(a, 1 + size // 8)
    apart = [ss.differences(x, leader, similarity) for x in (a, b)]
    met = any(np.isin(x[0][:x[1]], y[0][:y[2]]).any() for x, y in (apart, apart[::-1]))
    linked = ss.alike(a, b, similarity) and not np.array_equal(a, b)
    by_leader = ss.alike(a, leader, similarity) and ss.alike(b, leader, similarity)
    assert met or by_leader or not linked


def test_rows_far_from_their_leader_are_compared(stored):
    base, rng = words(5, 60), random.Random(4)
    far = [edited(900 + k, base, 0.14) for k in range(40)]
    rows = [(k, edited(k, base, 0.05)) for k in range(150)] + [(200 + k, text) for k, text in enumerate(far)]
    rows += [(300 + k, edited(1000 + k, rng.choice(far), 0.05)) for k in range(80)]  # linked to far ones alone
    check(stored, rows)


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    every = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    a, b = every[:2200], every[200:]
    one, two, both = ss.sketches([a, b, every])
    assert (np.maximum(one, two) == both).all()
    assert (ss.sketches([a])[0] == one).all() and (ss.sketches([rng.permutation(a), b])[0] == one).all()
    size = np.array([float(len(a))]), np.array([float(len(b))])
    grid = np.linspace(0, 1, 101)
    best = grid[ss.likelihood(one[None], two[None], *size, grid[None]).argmax()]
    assert abs(best - 0.5) < 0.12
    assert not ss.plausible(one[None], two[None], *size, (80, 100))[0]
    near = every[:3600]
    three, four = ss.sketches([near, every])
    assert ss.plausible(three[None], four[None], np.array([3600.0]), np.array([4000.0]), (80, 100))[0]


def test_a_large_set_is_merged_from_parts(monkeypatch):
    found = np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)
    whole = ss.sketches([found])
    monkeypatch.setattr(ss, "SLICE", 700)
    assert (ss.sketches([found]) == whole).all()


def test_pairs_at_the_bound_meet():
    rng, missed = np.random.default_rng(3), 0
    for _ in range(300):
        every = rng.integers(0, 1 << 63, 200).astype(np.uint64)
        one, two = ss.bands(ss.sketches([every[:180], every[20:]]))  # 160 of 200
        missed += not (one == two).any()
    assert missed == 0


def test_few_pairs_of_a_group_around_a_leader_are_compared(stored, monkeypatch):
    """Near copies of one text, many of them apart: by far most pairs share no early difference."""
    base, met, real = words(7, 150), [], ss._apart
    rows = [(k, edited(k, base, 0.015 + 0.06 * (k % 3 == 0))) for k in range(200)]

    def counted(*args):
        found = ss.settle(real(*args))
        met.append(found.count())
        return found

    monkeypatch.setattr(ss, "_apart", counted)
    found = {}
    for r in ss.near_copies(stored(rows)).collect():
        found.setdefault(r.best, []).append(str(r.doc_id))
    assert sorted(map(sorted, found.values())) == groups(rows, brute(rows)[1])
    assert met[0] < 2000
