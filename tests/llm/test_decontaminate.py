import re

from hypothesis import example, given, settings, strategies as st

from shiftloom.llm import decontaminate as d

from .conftest import ODD, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def plain(text, items):
    have = WORD.findall(folded(text))
    hit, found = set(), set()
    for item, body in items:
        own = WORD.findall(folded(body))
        for at in range(max(1, len(own) - 9) if own else 0):
            window = own[at:at + 10]
            for k in range(len(have) - len(window) + 1):
                if have[k:k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    found |= {item} - {None}
    return len(have), hit, sorted(found)


@given(st.text(alphabet="ab ,Bß", max_size=120), st.lists(st.text(alphabet="ab Aß", max_size=40), max_size=4))
@example("B", ["b"])
@settings(max_examples=80, deadline=None)
def test_matcher_equals_brute_force(text, bodies):
    items = [(str(k), body) for k, body in enumerate(bodies)]
    cut = [(k, body.encode().translate(d.ALNUM_LOWER).split()) for k, body in items]
    total, spans, found = d.Matcher([x for x in cut if x[1]]).scan(text.encode())
    expected = plain(text, items)
    assert (total, {w for a, b in spans for w in range(a, b + 1)}, sorted(found)) == expected
    for span in d.code_points(text.encode(), spans):
        part = WORD.findall(folded(text[span["start"]:span["end"]]))
        assert len(part) == span["last"] - span["first"] + 1


ITEMS = [(1, words(500, 25)), (2, "Same, text twice!"), (3, None), (4, ""), (None, words(501, 12)), (5, words(500, 25)), (2, "x y")]


def rows():
    passage = words(500, 25).split()
    long = words(9, 400_000)
    return ODD + [
        (30, f"{words(31, 40)} {' '.join(passage[5:17]).translate({c: c - 32 for c in range(97, 123)})}. {words(32, 40)}"),
        (32, words(501, 12)), (33, words(34, 50)), (35, f"{long} {words(500, 25)} {long}"),
        (36, " ".join(passage[:9])),
    ]


def check(spark, stored):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = stored(rows())
    found = {}
    for r in d.contamination(docs, items).collect():
        hit = {w for s in r.spans for w in range(s["first"], s["last"] + 1)}
        assert len(hit) == sum(s["last"] - s["first"] + 1 for s in r.spans)
        found.setdefault(r.doc_id, []).append((r.n_words, hit, r["items"]))
    texts = [(str(i), b) if i is not None else (None, b) for i, b in ITEMS]
    for doc, text in rows():
        if doc != 35:
            assert plain(text, texts) in found[doc], doc
    assert len(found[35][0][1]) == 25 and found[35][0][2] == ["1", "5"]
    kept = d.clean(docs, items)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id and r.doc_id > 29) == [33, 36]


def test_odd_rows(spark, stored):
    check(spark, stored)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r.contaminated for r in d.report(stored(ODD), none).collect())
    assert d.report(stored([], 1), none).count() == 0


def test_several_automata(spark, stored, monkeypatch):
    monkeypatch.setattr(d, "MAX_PATTERNS", 4)
    check(spark, stored)
