import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings, strategies as st

from shiftloom.llm import alignment as al
from shiftloom.llm.texts import table

from .conftest import ODD, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(text, models):
    """Groups of (place, id) of A and B by cutting where both end, whole texts encoded at once."""
    a, b = models
    if not text:
        return []
    whole, letters = (" " + text).encode(), al._letters()
    one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    first = [bytes(letters[c] for c in a.id_to_token(k)) for k in one]
    second = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in two]
    if b"".join(first) != whole or b"".join(second) != whole:
        return []
    ends = [set(np.cumsum([len(x) for x in part]).tolist()) for part in (first, second)]
    out, at = [([], [])], 0
    places = [dict(zip(np.cumsum([len(x) for x in part]).tolist(), ids)) for part, ids in ((first, one), (second, two))]
    for at in range(1, len(whole) + 1):
        for k in (0, 1):
            if at in places[k]:
                out[-1][k].append(places[k][at])
        if at in ends[0] and at in ends[1]:
            out.append(([], []))
    return out[:-1]


def plain(rows, models):
    cut = [plain_groups(r[1], models) for r in rows]
    linked = [Counter((x, y) for one, two in groups for x in one for y in two) for groups in cut]
    count = Counter(pair for links in linked for pair in links)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for row, groups, links in zip(rows, cut, linked):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            row[0], sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for (x, y), n in links.items() if count[x, y] == most[x]), sum(n * count[pair] for pair, n in links.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def found(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@given(st.text(alphabet=st.one_of(st.sampled_from("ab  \n\t'sé文🙂0▁\xa0<|>"), st.characters(codec="utf-8")), max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_have_the_ids_of_the_whole_text(models, text):
    a, b = al._sides(A, B)
    assert a.ids_of([text])[0].tolist() == models[0].encode(" " + text, add_special_tokens=False).ids
    if "▁" not in text:
        assert not text or b.ids_of([text])[0].tolist() == models[1].encode(text)


@given(st.lists(st.lists(st.integers(0, 3), min_size=4, max_size=4), max_size=5), st.lists(st.lists(st.integers(0, 3), min_size=3, max_size=3), min_size=4, max_size=4))
@settings(max_examples=100, deadline=None)
def test_products_equal_dense_ones(one, two):
    def csr(rows, width):
        dense = np.array(rows, np.int64).reshape(-1, width)
        r, c = np.nonzero(dense)
        return dense, al.Csr.of(r, c, dense[r, c], len(dense), width)

    (a, left), (b, right) = csr(one, 4), csr(two, 3)
    found = al.product(left, right)
    dense = np.zeros((len(a), 3), np.int64)
    dense[found.rows(), found.indices] = found.data
    assert (dense == a @ b).all()
    back = right.transposed()
    assert (np.stack([back.rows(), back.indices]) == np.stack(np.nonzero(b.T))).all()


def test_query_equals_plain_python(spark, models):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(al.alignments(docs, A, B)) == plain(rows, models)


def test_odd_texts_and_many_blocks(spark, stored, models, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 200)
    rows = [*ODD, (20, "<|endoftext|> </s> <0x41>"), (21, "a▁b"), (22, "=" * 5000), (23, "  two  spaces \n\n x "), (24, words(7, 300))]
    docs = stored(rows)
    expected = plain(rows, models)
    assert found(al.alignments(docs, A, B)) == expected
    assert al.alignments(stored([], 1), A, B).count() == 0
    links = al.token_links(docs, A, B).where("doc_id = 24").orderBy("a_place", "b_place").collect()
    assert sum(r.bytes for r in links) == len(words(7, 300).encode()) + 1
    assert links[-1].group + 1 == next(r[3] for r in expected if r[0] == 24)


def test_a_run_without_common_ends_is_not_multiplied_out():
    ids, group = np.zeros(100_000, np.int64), np.zeros(100_000, np.int64)
    doc, a, b, times = al.shared(ids, group, ids + 1, group, np.zeros(1, np.int64))
    assert (doc.tolist(), a.tolist(), b.tolist(), times.tolist()) == ([0], [0], [1], [10**10])


def test_a_long_text_is_worked_on_in_parts(models, monkeypatch):
    a, b = al._sides(A, B)
    texts = [words(3, 2000), "", "x" * 3000, words(4, 10)]
    whole = al.align(texts, a, b)
    monkeypatch.setattr(al, "PIECE", 64)
    parts = al.align(texts, a, b)
    for name, value in whole.items():
        assert list(value) == list(parts[name]), name
