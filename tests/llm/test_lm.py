import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P

from shiftloom.llm import lm

from .conftest import ODD, words

PATH = P.path("byte_bpe_multi_50k.tiktoken")
SMALL = lm.Settings(sample=60, steps=120)


def some_weights(seed=1):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, lm.CLASSES, n) for n in (1, 5, 16, 17, 40, 70)]
    w = lm.train(texts, np.full(lm.CLASSES, 1 / lm.CLASSES), lm.Settings(steps=3))
    return texts, {name: v.astype(np.float64) for name, v in w.items()}


def test_each_subword_is_scored_once():
    texts, _ = some_weights()
    inputs, targets, owner = lm.windows(texts)
    for k, t in enumerate(texts):
        own = targets[owner == k]
        assert own[own >= 0].tolist() == t.tolist()
        assert inputs[owner == k][0][lm.STEP] == lm.BEGIN
    assert lm.windows([])[0].shape[0] == 0


def test_no_place_sees_what_follows():
    texts, w = some_weights()
    inputs, targets, _ = lm.windows(texts)
    plain = lm.class_log10(w, inputs, targets)
    changed = inputs.copy()
    changed[:, lm.STEP + 9:] = 3
    assert np.allclose(lm.class_log10(w, changed, targets)[:, :9], plain[:, :9])
    sums = np.exp(lm.forward(w, inputs)["logits"])
    assert np.allclose(10 ** plain[targets >= 0], (sums / sums.sum(axis=2, keepdims=True))[targets >= 0][np.arange((targets >= 0).sum()), targets[targets >= 0]])


def test_gradients_equal_differences():
    texts, w = some_weights()
    inputs, targets, _ = lm.windows(texts)
    loss = lambda v: -lm.class_log10(v, inputs, targets).sum() * math.log(10) / (targets >= 0).sum()
    found, rng = lm.gradients(w, inputs, targets), np.random.default_rng(2)
    for name, value in w.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            up, down = ({**w, name: value.copy()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - found[name][at]) < 1e-5, name


def test_base_equals_brute_force_and_model_learns(spark, stored):
    rows = ODD + [(100 + k, words(k, 60)) for k in range(150)]
    found = lm.report(spark, stored(rows), PATH, SMALL).collect()
    assert len(found) == len(rows)
    cut = lambda t: [w for w in (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()] + [None]
    train = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 != 0
    counts = Counter(w for d, t in rows if train(d) for w in cut(t))
    total = sum(counts.values())
    expected = sorted(
        (str(d), not train(d), len(cut(t)), sum(counts[w] > 0 for w in cut(t)), total,
         round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in cut(t)), 6))
        for d, t in rows
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    held = [r for r in found if r.held_out and r.doc_id and r.doc_id >= 100]
    assert all(r.score < 0 for r in found)
    assert sum(r.score for r in held) > 1.1 * sum(r.base_score for r in held)


def test_classes_are_a_distribution():
    counts = np.array([5.0, 0, 100, 3, 3, 900] + [1] * 500)
    classes, inside = lm.class_table(counts, np.arange(len(counts)) % 7)
    assert classes.max() < lm.CLASSES
    assert np.allclose(np.bincount(classes, 10**inside, lm.CLASSES)[np.unique(classes)], 1)


def test_nothing_to_learn_from(spark, stored):
    found = lm.report(spark, stored([(None, "ab cd"), (None, None)], 1), PATH, SMALL).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in found) == [(1, 0, 0), (3, 0, 0)]
    assert all(np.isfinite([r.base_score, r.score]).all() for r in found)
    assert lm.report(spark, stored([], 1), PATH, SMALL).count() == 0


def test_every_training_text_is_learned_from(spark, stored):
    """The order of the words of one text, which no count tells, changes the model."""
    rows = [(100 + k, words(k, 60)) for k in range(120)]
    few = lm.Settings(sample=3, steps=10)
    score = lambda table: {r.doc_id: r.score for r in lm.report(spark, stored(table, 1), PATH, few).collect()}
    plain, at = score(rows), 7
    turned = score([(d, " ".join(sorted(t.split())) if k == at else t) for k, (d, t) in enumerate(rows)])
    assert zlib.crc32(str(rows[at][0]).encode()) % 10
    assert any(abs(plain[d] - turned[d]) > 1e-6 for d, _ in rows if d != rows[at][0])


def test_kinds_are_those_of_all_texts():
    rng = np.random.default_rng(5)
    texts = [rng.integers(100 * (k % 6), 100 * (k % 6) + 80, 200) for k in range(240)]
    rows = lm._shape(texts)
    parts = [lm.cluster(rows[k:k + 60], np.ones(60)) for k in range(0, 240, 60)]
    centres, weight = lm.cluster(*map(np.concatenate, zip(*parts)))
    kind = lm._nearest(rows, centres)[0]
    assert weight.sum() == 240 and all(len({*kind[k::6]}) == 1 for k in range(6)) and len({*kind}) == 6


def test_large_weights_give_finite_scores():
    """Where chances are too small for a float, and where nothing may be raised to as it is."""
    texts, w = some_weights()
    inputs, targets, _ = lm.windows(texts)
    for factor in (8, 60):
        for kind in (np.float32, np.float64):
            large = {name: (v * factor).astype(kind) for name, v in w.items()}
            found = lm.class_log10(large, inputs, targets)
            assert np.isfinite(found).all() and found.min() < -5
            assert all(np.isfinite(g).all() for g in lm.gradients(large, inputs, targets).values())
    assert lm._steep(large) and not lm._tables(large)["small"]
    rows, places = np.nonzero(targets >= 0)
    expected = lm.forward(large, inputs)["logits"][rows, places, targets[rows, places]] / math.log(10)
    assert np.allclose(found[rows, places], expected)
