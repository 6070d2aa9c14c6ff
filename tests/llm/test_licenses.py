import random

from hypothesis import given, settings, strategies as st

from shiftloom.llm import licenses as l

from .conftest import ODD, words

VOCABULARY = sorted({w.decode() for _, t in l.NOTICES for w in l._words(t)})[:40] + "under the mit license cc by nc apache version 2 zzz".split()


def statistics(have, templates):
    """The longest run ending at each word that some template holds."""
    out = []
    for k in range(len(have)):
        size = 0
        while size <= k and any(
            t[j:j + size + 1] == have[k - size:k + 1] for t in templates for j in range(len(t) - size)
        ):
            size += 1
        out.append(size)
    return out


def maximal(sizes):
    return [(k, n) for k, n in enumerate(sizes) if n >= l.LONG and (k + 1 == len(sizes) or sizes[k + 1] <= n)]


def places(have):
    return sorted(
        (k, label) for phrase, label in l.BASE.items() for k in range(len(have))
        if have[k:k + len(phrase.split())] == l._words(phrase)
    )


@given(st.integers(0, 10**6), st.integers(1, 50))
@settings(max_examples=60, deadline=None)
def test_matching_statistics_equal_brute_force(seed, piece):
    rng = random.Random(seed)
    templates = [l._words(p) for p in l.BASE] + [l._words(t) for _, t in l.NOTICES]
    have = []
    for _ in range(rng.randint(0, 8)):
        part = rng.choice(templates)
        at = rng.randrange(len(part))
        have += part[at:at + rng.randint(1, 12)] + [rng.choice(VOCABULARY).encode() for _ in range(rng.randint(0, 3))]
    found = l.Scan(l.automaton())
    for at in range(0, len(have), piece):
        found.feed(have[at:at + piece])
    found.close(found.total)
    assert [(k, n) for k, n, _ in found.matches] == maximal(statistics(have, templates))
    assert sorted(found.base) == places(have) and found.total == len(have)


def labels(text):
    found = l.scan(text.encode(), l.automaton())
    return sorted({x["label"] for x in found.chains() if x["covered"] >= l.COVERED})


def test_chains_bridge_edits():
    notice = l.NOTICES[1][1].split()
    assert labels(" ".join(notice)) == ["mit"]
    assert labels(" ".join(notice[:12] + ["verily"] + notice[13:])) == ["mit"]
    assert labels(" ".join(notice[:6])) == [] and labels(" ".join(notice[20:] + notice[:8])) == []
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["gpl-3"]
    assert labels(f"{words(1, 300)} {' '.join(notice)} {words(2, 300)}") == ["mit"]


def test_report(stored):
    rows = ODD + [
        (30, f"{words(3, 10)} Licensed under the Apache License, Version 2.0. {words(4, 10)} under the MIT license"),
        (31, "CC BY-NC cc by nc " * 50), (32, words(5, 200)), (33, "under the " * 100 + "mit license"),
        (34, "This work is licensed under the GNU General Public License, version 3."),
    ]
    found = l.report(stored(rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for doc, text in rows:
        have, r = l._words(text or ""), by[doc]
        if doc != 4:
            starts = places(have)
            assert (r.n_words, r.n_base) == (len(have), len(starts))
            assert (r.first_word, r.last_word) == ((starts[0][0], starts[-1][0]) if starts else (None, None))
            assert r.base_labels == ",".join(sorted({x for _, x in starts}))
            assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert by[30].labels == "apache-2,mit" and by[34].labels == "gpl-3" and by[34].base_labels == ""
    assert (by[32].labels, by[32].score) == ("", 0.0)
    assert l.report(stored([], 1)).count() == 0
