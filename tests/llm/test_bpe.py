import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from shiftloom.llm import blocks, bpe

from .conftest import ODD, words

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
OTHER = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@given(st.text(max_size=200))
@settings(max_examples=150, deadline=None)
def test_ids_equal_tiktoken(text):
    found = [k for word in bpe.splitter(P.PATTERN)(text.encode())[0] for k in bpe.encode_word(word, RANKS)]
    assert found == OTHER.encode_ordinary(text)


@given(st.text(alphabet="aabbcdeé", min_size=1, max_size=200))
@settings(max_examples=100, deadline=None)
def test_long_words_merge_alike(word):
    assert bpe._encode_long(word.encode(), {k: v for k, v in RANKS.items()}) == OTHER.encode_ordinary(word) or word.encode() in RANKS


def check(docs, rows, spark):
    found = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(spark, docs, PATH, P.PATTERN).collect())
    expected = []
    for doc, text in rows:
        ids = OTHER.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        expected.append((str(doc), len(ids), *sha))
    assert found == sorted(expected)


def test_odd_rows(spark, stored, monkeypatch):
    rows = ODD + [(20 + k, words(k, 200)) for k in range(30)] + [(60, "a" * 5000), (61, "x " * 3000 + "\u2003\x1c \n\n z")]
    check(stored(rows), rows, spark)
    assert bpe.encode(spark, stored([], 1), PATH, P.PATTERN).count() == 0


def test_round_trip(spark, stored):
    rows = [(k, words(k, 50)) for k in range(20)] + [(30, None), (31, "")]
    tokens = bpe.encode(spark, stored(rows), PATH, P.PATTERN)
    assert {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(tokens, PATH).collect()} == {d: t or "" for d, t in rows}


def test_packing():
    for values in ([], [0], [5, 2**32 - 1, 7]):
        assert blocks.unpack(blocks.pack(values)).tolist() == values
    assert blocks.slices(blocks.pack_ragged([b"", b"ab", b"c"])) == [b"", b"ab", b"c"] and blocks.slices(blocks.pack_ragged([])) == []


def test_byte_without_rank():
    with pytest.raises(KeyError):
        bpe.encode_word(b"ab", {b"a": 0})


def test_words_side_by_side_equal_one_by_one():
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    pairs, rng = bpe.pairs_of(ranks), np.random.default_rng(4)
    some = [b"a", b" the", b" " * 9, b"aaaaaaaaaaaaaaa", b" x" * 70, bytes(range(256)), "日本語テキスト".encode(), b" abababababab"]
    some += [rng.choice(list(b"etaoinshrdlu 019."), rng.integers(1, 30)).astype(np.uint8).tobytes() for _ in range(9_000)]
    some += [rng.integers(0, 256, rng.integers(1, bpe.LONG + 3)).astype(np.uint8).tobytes() for _ in range(500)]
    expected = [bpe.encode_word(word, ranks) for word in some]
    flat, counts = bpe.encode_words(some, ranks, pairs)
    assert counts.tolist() == [len(ids) for ids in expected]
    assert flat.tolist() == [k for ids in expected for k in ids]
    assert [len(x) for x in bpe.encode_words([], ranks, pairs)] == [0, 0]
    left, right = rng.integers(0, len(ranks), (2, 50_000))
    table = bpe.token_table(ranks)
    assert pairs.find(left, right).tolist() == [ranks.get(table[a] + table[b], bpe.NONE) for a, b in zip(left, right)]


def test_blocks_number_words_in_parts_alike(spark, monkeypatch):
    """A long document's words are not all held at once; the numbers do not tell."""
    monkeypatch.setattr(blocks, "TaskContext", type("One", (), {"get": classmethod(lambda c: c), "partitionId": classmethod(lambda c: 0)}))
    lists = [[b"a", b"b", b"a"], [], [b"c", b"a", b"\xff"], [b"b"] * 5]
    found, held = [], []
    for waiting in (1, 4, 500_000):
        monkeypatch.setattr(blocks, "WAITING", waiting)
        builder = blocks._Builder(3)
        for k, one in enumerate(lists):
            builder.add(k, k != 3, [one[:2], one[2:]])
            held.append((waiting, builder.waits))
        found.append(list(builder.rows()))
    assert found[0] == found[1] == found[2] and max(n for w, n in held if w == 4) < 4
    numbers = blocks.unpack(found[0][0]["payload"]).tolist()
    names = {}
    for row in found[0][1:]:
        steps, chosen = blocks.slices(row["extra"])
        for place, n, word in zip(np.cumsum(blocks.unpack(steps)).tolist(), blocks.unpack(chosen).tolist(), blocks.slices(row["payload"])):
            names[place] = word
            assert n == sum(one.count(word) for one in lists[:3])
    assert [names[k] for k in numbers] == [word for one in lists for word in one]
