import hashlib
from collections import Counter

import numpy as np

from shiftloom.llm import imatch as m

from .conftest import ODD, words


def test_every_document_with_the_next(spark, stored):
    rows = [(k * 7 % 101, words(k, 5 + k)) for k in range(100)]
    found = {r.doc_id: r for r in m.report(spark, stored(rows, 4)).collect()}
    assert len(found) == 100
    order = sorted(rows, reverse=True)
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert found[doc].n_chars == len(text)
        assert found[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), doc


def test_lexicon_counts_all_documents(stored):
    rows = [(k, words(k % 50, 40)) for k in range(3000)]
    counts = Counter(w for _, t in rows for w in m.distinct_terms(t.encode()))
    expected = sorted(m.xxhash.xxh64_intdigest(w) for w, n in counts.items() if 3 <= n <= 300)
    assert m.lexicon(stored(rows)).tolist() == expected


def test_lexicon_is_bounded(stored, monkeypatch):
    rows = [(k, " ".join(f"w{j}" for j in range(k + 1))) for k in range(40)]
    monkeypatch.setattr(m, "MOST", 1.0)
    monkeypatch.setattr(m, "MAX_LEXICON", 10)
    expected = sorted(m.xxhash.xxh64_intdigest(f"w{j}".encode()) for j in range(10))
    assert m.lexicon(stored(rows)).tolist() == expected


def test_equal_texts_and_likeness(spark, stored):
    same = words(3, 200)
    rows = ODD + [(50 + k, same) for k in range(4)] + [(70 + k, words(100 + k, 120)) for k in range(40)]
    rows += [(200, same.replace(same.split()[50], "otherword", 1))]
    docs = stored(rows)
    found = m.report(spark, docs).collect()
    assert len(found) == len(rows)
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(d) for d, *_ in rows)
    prints = {r.doc_id: r.fingerprint for r in found}
    assert len({prints[50 + k] for k in range(4)}) == 1 and prints[10] == prints[11]
    assert m.likeness(prints[50], prints[200]) > 0.5
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert {r.near_next for r in found if r.doc_id in (51, 52, 53)} == {1.0}
    several = [r for r in found if r.doc_id and r.doc_id >= 70 and r.doc_id < 110]
    assert np.mean([r.near_edited for r in several]) > np.mean([r.near_next for r in several]) + 0.1


def test_few_rows(spark, stored):
    assert m.report(spark, stored([], 1)).count() == 0
    alone = m.report(spark, stored([(5, "abcd")], 1)).collect()
    assert [(r.n_chars, r.edited_sha256) for r in alone] == [(4, hashlib.sha256(b"abab").hexdigest())]
    none = m.report(spark, stored([(None, "ab"), (None, None)], 1)).collect()
    assert sorted(r.n_chars for r in none) == [0, 2]
