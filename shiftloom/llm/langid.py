"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its subwords, which are byte n-grams inside a word and
its edges, hashed into buckets. The model is trained on the driver by stochastic gradient
descent over a bounded sample of labelled rows; its size depends on the buckets and labels only.
For prediction the embeddings are multiplied with the softmax weights once, so a text's logits
are the mean of one table row per subword.

A softmax over known labels cannot tell that a text is in none of them. So the mean log-likelihood of
its subwords, counted over the training texts of all labels together, is calibrated beside it: a text that is
less likely than any of the texts set aside, with a margin that is wider for short ones, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .texts import byte_texts, numbered, whole_text

BUCKET_BITS = 16
SIZES = (2, 3, 4)
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
# ASCII letters in lower case and bytes of other scripts count; all others end a word.
LETTERS = bytes(
    ord(chr(b).lower()) if b < 0x80 and chr(b).isalpha() else b if b >= 0x80 else 0x20 for b in range(0x100)
)
#: Bytes looked at in one go. Longer texts are summed over several pieces.
SPAN = 1 << 19


@dataclass(frozen=True)
class Settings:
    """``sample`` and ``total``: distinct texts that training sees at most, on average, per label and in all.
    ``excerpt``: characters of a sampled text that training sees, from a place its hash picks.
    ``lost``: share of the rightly predicted calibration texts that may lie under the score (0.5 at most) whose
    middle with that of a blind guess is the least one that is not rejected.
    ``margin``: how many times as unlikely as the least likely calibration text a text may be, ``spread``
    the part of that which does not shrink with its length; ``foreign``: how much of the way from the usual
    likelihood to that of subwords never seen it must be off as well, so a text mostly in a learned language stays."""

    sample: int = 1200
    total: int = 10_000
    excerpt: int = 8000
    max_labels: int = 1000
    size: int = 16
    batch: int = 32
    rounds: int = 2
    rate: float = 0.5
    lost: float = 0.0005
    margin: float = 2.0
    spread: float = 0.1
    foreign: float = 1 / 3
    seed: int = 17


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    weights: np.ndarray  # bucket x label
    bias: np.ndarray
    temperature: float
    threshold: float
    known: np.ndarray  # log-likelihood by bucket
    spread: float = Settings.spread
    usual: float = 0.0  # mean of it over calibration texts, and how far a text may be below
    reach: float = np.inf
    least: float = -np.inf  # a text at least as likely is never too strange


def subwords(data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each n-gram size: the places where a subword starts, and their buckets."""
    space = data == 0x20
    for size in SIZES:
        places = len(data) - size + 1
        if places <= 0:
            continue
        code, valid = np.full(places, size, np.uint32), np.ones(places, bool)
        for k in range(size):
            code = code * np.uint32(0x01000193) ^ data[k:places + k]
            if 0 < k < size - 1:
                valid &= ~space[k:places + k]
        if size == 2:
            valid &= ~(space[:places] & space[1:places + 1])
        code = code * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKET_BITS)
        at = np.flatnonzero(valid)
        yield size, at, code[at]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each between spaces, and where each starts."""
    parts = [b" " + text.translate(LETTERS) + b"  " for text in texts]
    starts = np.cumsum([0, *map(len, parts)])
    return np.frombuffer(b"".join(parts), np.uint8), starts


def measured(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the logits (the mean of the weights of its subwords, and the bias), the mean log-likelihood and the number of its subwords."""
    data, starts = _joined(texts)
    sums, likely, counts = np.zeros((len(texts), len(model.labels))), np.zeros(len(texts)), np.zeros(len(texts))
    for begin in range(0, len(data), SPAN):
        end = min(len(data), begin + SPAN)
        for size, at, bucket in subwords(data[begin:end + max(SIZES) - 1]):
            at, bucket = at[: (n := np.searchsorted(at, end - begin))] + begin, bucket[:n]
            own = np.searchsorted(at, starts)
            full = np.flatnonzero(own[1:] > own[:-1])
            if len(full):
                sums[full] += np.add.reduceat(model.weights[bucket], own[full], axis=0, dtype=np.float32)
                likely[full] += np.add.reduceat(model.known[bucket], own[full], dtype=np.float64)
                counts[full] += own[full + 1] - own[full]
    most = np.maximum(counts, 1)
    return (sums / most[:, None] + model.bias) / model.temperature, likely / most, counts


def logits(texts: list[bytes], model: Model) -> np.ndarray:
    return measured(texts, model)[0]


def below(likely: np.ndarray, counts: np.ndarray, usual: float, spread: float) -> np.ndarray:
    """How far texts are below the usual likelihood, in units that are wider for short ones."""
    return (usual - likely) / (spread + 1 / np.sqrt(np.maximum(counts, 1)))


def softmax(rows: np.ndarray) -> np.ndarray:
    raised = np.exp(rows - rows.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def sample(labelled: DataFrame, settings: Settings) -> list[tuple[str, bytes]]:
    """A bounded set of distinct labelled texts, chosen by the hash of the text alone."""
    distinct = labelled.where("text is not null and lang is not null").select("text", "lang")
    distinct = distinct.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 30)))
    sizes = {
        r.lang: r.n for r in distinct.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
        .limit(settings.max_labels + 1).collect()
    }
    if len(sizes) > settings.max_labels:
        raise ValueError(f"more than {settings.max_labels} labels")
    if not sizes:
        return []
    most = min(settings.sample, settings.total // len(sizes))
    bound = F.create_map(*[
        F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, most / max(1, n)) * (1 << 30)))
    ])
    room = F.greatest(F.length("text") - settings.excerpt, F.lit(0))
    excerpt = F.substring("text", (F.pmod(F.xxhash64("text", F.lit(1)), room + 1) + 1).cast("int"), F.lit(settings.excerpt))
    rows = distinct.where(F.col("h") < bound[F.col("lang")]).select("h", "lang", excerpt.alias("text")).distinct()
    return [(r.lang, r.text.encode()) for r in rows.orderBy("h", "lang", "text").collect()]


def train(rows: list[tuple[str, bytes]], settings: Settings = Settings()) -> Model:
    """Fit on whole excerpts and on short pieces of them, calibrate on a fifth that was set aside."""
    labels = tuple(sorted({label for label, _ in rows}))
    if not labels:
        return Model((), np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0), 1.0, 1.0, np.zeros(1 << BUCKET_BITS, np.float32))
    rng, place = np.random.default_rng(settings.seed), {label: k for k, label in enumerate(labels)}
    aside = np.arange(len(rows)) % 5 == 0
    examples: list[tuple[int, bytes]] = []
    for (label, text), out in zip(rows, aside):
        if not out:
            parts = text.split()
            for most in (4, 40, 400):
                begin = int(rng.integers(0, max(1, len(parts) - most)))
                examples.append((place[label], b" ".join(parts[begin:begin + int(rng.integers(1, most + 1))])))
    embed = rng.normal(0, 0.01, (1 << BUCKET_BITS, settings.size))
    weights, bias = rng.normal(0, 1, (settings.size, len(labels))), np.zeros(len(labels))
    steps = max(1, settings.rounds * len(examples) // settings.batch)
    done = 0
    for _ in range(settings.rounds):
        order = rng.permutation(len(examples))
        for begin in range(0, len(order), settings.batch):
            chosen = [examples[k] for k in order[begin:begin + settings.batch]]
            data, starts = _joined([text for _, text in chosen])
            found = [(at, bucket) for _, at, bucket in subwords(data)]
            at, bucket = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2
            owner = np.searchsorted(starts, at, side="right") - 1
            share = 1 / np.maximum(np.bincount(owner, minlength=len(chosen)), 1)
            order_b = np.argsort(bucket, kind="stable")
            bucket, owner = bucket[order_b], owner[order_b]
            mean = np.stack([
                np.bincount(owner, embed[bucket, d], len(chosen)) for d in range(settings.size)
            ], axis=1) * share[:, None]
            wrong = softmax(mean @ weights + bias)
            wrong[np.arange(len(chosen)), [label for label, _ in chosen]] -= 1
            rate = settings.rate * (1 - done / steps)
            back = (wrong @ weights.T) * share[:, None]
            if len(bucket):
                first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                embed[bucket[first]] -= rate * np.add.reduceat(back[owner], first, axis=0)
            weights -= rate * mean.T @ wrong / len(chosen)
            bias -= rate * wrong.mean(axis=0)
            done += 1
    seen = np.full(1 << BUCKET_BITS, 0.5)
    for begin in range(0, len(examples), 256):
        data, _ = _joined([text for _, text in examples[begin:begin + 256]])
        for _, _, bucket in subwords(data):
            seen += np.bincount(bucket, minlength=len(seen))
    raw = Model(labels, (embed @ weights).astype(np.float32), bias, 1.0, 0.0, np.log(seen / seen.sum()).astype(np.float32))
    return _calibrated(raw, [(place[label], text) for (label, text), out in zip(rows, aside) if out], settings, rng)


def _calibrated(model: Model, held: list[tuple[int, bytes]], settings: Settings, rng: np.random.Generator) -> Model:
    """Choose the temperature by likelihood, and the least score and likelihood that are not rejected."""
    pieces = []
    for label, text in held:
        parts = text.split()
        begin, most = int(rng.integers(0, max(1, len(parts)))), int(rng.integers(1, 30))
        pieces.append((label, b" ".join(parts[begin:begin + most])))
    both = [row for row in held + pieces if row[1].strip()]
    if not both:
        return model
    rows, likely, counts = measured([text for _, text in both], model)
    own = np.array([label for label, _ in both])
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(rows / t)[np.arange(len(own)), own] + 1e-12).mean() for t in grid]
    heat = float(grid[int(np.argmin(loss))])
    chances = softmax(rows / heat)
    right = chances.max(axis=1)[chances.argmax(axis=1) == own]
    # A text of two known languages falls between both, with half of the score for one of them; only
    # what is nearer to a blind guess is rejected.
    least = min(0.5, float(np.quantile(right, settings.lost)) if len(right) else 0.0)
    usual = float(likely.mean())
    reach = settings.margin * float(below(likely, counts, usual, settings.spread).max())
    return replace(model, temperature=heat, threshold=(least + 1 / len(model.labels)) / 2, spread=settings.spread, usual=usual, reach=reach,
                   least=usual - settings.foreign * (usual - float(model.known.min())))


def predict(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Label, score and rejection of each text of an Arrow column."""
    found, scores, far = [UNKNOWN] * len(column), np.zeros(len(column)), np.zeros(len(column), bool)
    group: list[tuple[int, bytes]] = []

    def flush() -> None:
        if group:
            rows, likely, counts = measured([text for _, text in group], model)
            chances, strange = softmax(rows), (below(likely, counts, model.usual, model.spread) > model.reach) & (likely < model.least)
            for (k, _), best, row, odd in zip(group, chances.argmax(axis=1), chances, strange):
                found[k], scores[k], far[k] = model.labels[best], min(1.0, float(row[best])), odd
        group.clear()

    size = 0
    for k, text in enumerate(byte_texts(column) if model.labels else ()):
        if LETTER.search(text.decode("utf-8", "replace")):
            group.append((k, text))
            size += len(text)
        if size > SPAN:
            flush()
            size = 0
    flush()
    return found, scores, np.array([lang == UNKNOWN for lang in found], bool) | far | (scores < model.threshold)


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from the labelled rows that are not held out."""
    return train(sample(docs.where(~held_out()), settings), settings)


def held_out() -> Column:
    """Rows whose labels are never learned from: crc32 of the ``doc_id`` as text, modulo 4, is 2.

    A null ``doc_id`` has no such number; its row is held out too.
    """
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, model: Model, *keys: str) -> DataFrame:
    """``keys`` with ``lang_pred``, ``score`` (calibrated, 0 to 1) and ``rejected``.

    A text that is null or has no letter is ``und`` with score 0 and rejected; any other is
    rejected if its score, or the likelihood of its subwords, is below what calibration allows. Repeated rows get equal results, an
    empty table none, and without labelled rows every text is ``und``. Only the text is looked at.
    """
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores, rejected = predict(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(key) for key in keys), pa.array(found, pa.string()), pa.array(scores), pa.array(rejected)],
                names=[*keys, "lang_pred", "score", "rejected"],
            )

    rows = whole_text(docs, *keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(scored, f"{schema}, lang_pred string, score double, rejected boolean")


def report(docs: DataFrame) -> DataFrame:
    found = identify(docs.withColumn("held_out", held_out()), fit(docs), "doc_id", "held_out")
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns."""
    model = fit(docs)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~predict(batch.column("text"), model)[2]))

    return docs.mapInArrow(kept, docs.schema)
