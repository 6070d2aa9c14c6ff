"""Scores of a causal self-attention model over subword ids.

Words and their subwords are counted over all training texts: equal words meet in one bucket (see
``blocks``), where they are counted, and cut into subwords, once. Subwords fall into classes by
whether they begin a word, by the kind of text that they prefer, and by count. Kinds are clusters of all
training texts: each block clusters its own, the centres are clustered once more, and every text then
counts for the nearest. The model gives the probability of the next class from the classes before it,
that of its family first; the counts give that of a subword inside its class. It is trained by gradient
descent in the tasks, on every window of every training text: in each round the blocks of that round
start from the same weights, whose means the next round starts from. Its size does not depend on the
corpus. A word's probability is a weighted mean of the product over its subwords and of its own
share of all training words.

A text is scored in overlapping windows: ``STEP`` subwords that are scored, each attending to the ones
before it and to the ``STEP`` subwords before the window, so every subword is scored once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import blocks, bpe
from .texts import LOWER, settle, whole_text, word_lists

STEP, SIZE, CLASSES = 16, 16, 256
#: Classes of a family; a class's probability is that of its family times its own inside it.
FAMILY = 16
FAMILIES = CLASSES // FAMILY
#: Weight of a word's share of all training words beside its subwords.
KNOWN = 0.7
#: Kinds of text that subwords are grouped by.
KINDS = 6
#: Subwords are counted by their numbers modulo this where texts are clustered.
SPREAD = 512
SMOOTH = 0.1
#: Windows that are scored in one go.
BATCH = 256
#: Rounds of a pass over all training texts, after each of which the weights are averaged.
ROUNDS = 4
#: Partial sums that reach the driver.
PARTS = 16


@dataclass(frozen=True)
class Settings:
    """Every training text is learned from; a small corpus is passed over until it has given ``steps`` batches of windows.

    ``sample`` bounds nothing any more; it is accepted for callers that still name it.
    """

    sample: int | None = None
    steps: int = 900
    batch: int = 256
    rate: float = 0.02
    seed: int = 11


@dataclass(frozen=True)
class Model:
    classes: np.ndarray  # of each subword id; the last id is the end of a text
    inside: np.ndarray  # log10 probability of a subword in its class
    weights: dict[str, np.ndarray]
    total: int  # training tokens
    distinct: int
    ends: int  # training texts


def training() -> Column:
    """Rows that may be learned from: crc32 of the ``doc_id`` as text, modulo 10, is not 0.

    A null ``doc_id`` has no such number; its row is held out.
    """
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0, F.lit(False))


def split_words(text: bytes) -> Iterator[list[bytes]]:
    return word_lists(text, LOWER)


ANSWER = "block bigint, bucket int, payload binary, extra binary, total bigint, distinct bigint"


def _counted(ranks: bpe.Ranks, pairs: bpe.Pairs):
    """Count the words of a bucket over all blocks and cut each into subwords."""

    def run(table: pa.Table) -> pa.Table:
        counts: dict[bytes, int] = defaultdict(int)
        rows = table.to_pylist()
        for row in rows:
            chosen = blocks.unpack(blocks.slices(row["extra"])[1]).tolist()
            for word, n in zip(blocks.slices(row["payload"]), chosen):
                counts[word] += n
        flat, sizes = bpe.encode_words([b" " + word for word in counts], ranks, pairs)
        data, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        ids = {word: data[a:b] for word, a, b in zip(counts, [0, *ends], ends)}
        out = []
        for row in rows:
            words = blocks.slices(row["payload"])
            steps = blocks.slices(row["extra"])[0]
            seen = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
            out.append({
                "block": row["block"], "bucket": row["bucket"], "payload": blocks.pack_ragged([ids[w] for w in words]),
                "extra": blocks.pack_ragged([steps, seen.tobytes()]), "total": None, "distinct": None,
            })
        # One more row: the subwords of the bucket with their counts.
        weight = np.repeat(np.fromiter(counts.values(), np.int64, len(counts)), sizes)
        names = np.flatnonzero(np.bincount(flat))
        sums = np.bincount(flat, weight)[names].astype(np.int64)
        out.append({
            "block": -1, "bucket": rows[0]["bucket"], "payload": blocks.pack(names), "extra": sums.tobytes(),
            "total": sum(counts.values()), "distinct": sum(n > 0 for n in counts.values()),
        })
        return pa.Table.from_pylist(out, pa.schema([
            ("block", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary()), ("extra", pa.binary()),
            ("total", pa.int64()), ("distinct", pa.int64()),
        ]))

    return run


def _subword_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for names, sums in zip(batch.column("payload").to_pylist(), batch.column("extra").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks.unpack(names).astype(np.int64)), pa.array(np.frombuffer(sums, np.int64))], names=["id", "n"]
            )


def _shape(texts: list[np.ndarray]) -> np.ndarray:
    """Square roots of the shares of a text's subwords, by their numbers modulo ``SPREAD``."""
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.repeat(np.arange(len(texts)) * SPREAD, sizes) + np.concatenate(texts).astype(np.int64) % SPREAD
    counts = np.bincount(at, minlength=len(texts) * SPREAD).reshape(-1, SPREAD)
    return np.sqrt(counts / np.maximum(sizes, 1)[:, None]).astype(np.float32)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the square of its distance but for a constant of the row."""
    away = (centres**2).sum(axis=1) - 2 * (rows @ centres.T)
    return away.argmin(axis=1), away.min(axis=1)


def cluster(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``KINDS`` centres of weighted rows, and the weight of each."""
    lengths, centres = (rows**2).sum(axis=1), rows[[int(weight.argmax())]]
    while len(centres) < min(KINDS, len(rows)):  # the row farthest from all centres so far
        centres = np.r_[centres, rows[[int((lengths + _nearest(rows, centres)[1]).argmax())]]]
    for _ in range(12):
        member = (_nearest(rows, centres)[0][:, None] == np.arange(len(centres))) * weight[:, None]
        sums = member.sum(axis=0)
        # Each row with its share of the centre's weight, so that no sum is large.
        shares = (member / np.maximum(sums, 1e-9)).astype(np.float32)
        centres = np.where(sums[:, None] > 0, shares.T @ rows, centres)
    return centres, sums


def kinds_of(counts: np.ndarray) -> np.ndarray:
    """The kind of text in which each subword (column) is most at home, from its count in each; ``KINDS`` if it is unseen."""
    rates = (counts + 0.01) / (counts.sum(axis=1, keepdims=True) + 1)
    return np.where(counts.sum(axis=0) > 0, rates.argmax(axis=0), KINDS)


def class_table(counts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each subword and log10 P(subword | class).

    Each group gets classes by its share of the counts' square roots, one at least, and divides them
    by descending count.
    """
    smooth = counts + SMOOTH
    names, group = np.unique(group, return_inverse=True)
    share = np.bincount(group, np.sqrt(smooth), len(names))
    room = 1 + np.floor((CLASSES - len(names)) * share / share.sum()).astype(np.int64)
    classes, at = np.empty(len(counts), np.int64), 0
    for k, n in enumerate(room):
        own = np.flatnonzero(group == k)
        own = own[np.argsort(-smooth[own], kind="stable")]
        weight = np.sqrt(smooth[own])
        classes[own] = at + np.minimum((np.cumsum(weight) - weight / 2) / weight.sum() * n, n - 1).astype(np.int64)
        at += n
    return classes, np.log10(smooth / np.bincount(classes, smooth, CLASSES)[classes])


BEGIN, PAD = CLASSES, CLASSES + 1


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input classes (window x 2 STEP), target classes (window x STEP, -1 beyond the end) and each window's text."""
    counts = np.array([-(-len(t) // STEP) for t in texts], np.int64)
    starts = np.r_[0, np.cumsum(counts + 1)]
    inputs = np.full(starts[-1] * STEP, PAD, np.int16)
    targets = np.full(starts[-1] * STEP, -1, np.int16)
    for at, t in zip((starts * STEP).tolist(), texts):
        if len(t):
            inputs[at + STEP] = BEGIN
            inputs[at + STEP + 1:at + STEP + len(t)] = t[:-1]
            targets[at + STEP:at + STEP + len(t)] = t
    first = np.repeat(starts[:-1] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    rows = inputs.reshape(-1, STEP)
    return np.concatenate([rows[first], rows[first + 1]], axis=1), targets.reshape(-1, STEP)[first + 1], np.repeat(np.arange(len(texts)), counts)


#: What a scored place may look at: itself and what is before it in the window; and how far away that is.
_BEHIND = STEP + np.arange(STEP)[:, None] - np.arange(2 * STEP)[None, :]
_VISIBLE = _BEHIND >= 0


def _tables(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What the attention needs of each class: queries, keys and values depend on a class alone.

    The hidden weights are already applied to the values. ``given`` is what a query's class gives to a
    key's class; it and ``distance`` are multiplied if ``small``, which nothing overflows then, else logarithms.
    """
    query, key = w["embed"] @ w["query"], w["embed"] @ w["key"]
    given, distance = query @ key.T, w["distance"][np.maximum(_BEHIND, 0)]
    small = bool(max(given.max(), -given.min(), np.abs(w["distance"]).max()) < 30)
    if small:
        np.exp(given, out=given)
        distance = np.where(_VISIBLE, np.exp(distance), distance.dtype.type(0))
    else:
        distance = np.where(_VISIBLE, distance, distance.dtype.type(-1e9))
    given[:, PAD] = 0 if small else -1e9
    return {
        "query": query, "key": key, "given": given, "distance": distance, "small": small,
        "own": w["embed"] @ w["hidden"][:SIZE], "value": w["embed"] @ (w["value"] @ w["hidden"][SIZE:]),
    }


def _attention(t: dict[str, np.ndarray], inputs: np.ndarray) -> dict[str, np.ndarray]:
    """Masked attention of the second half of each window over the whole window, then the hidden layer ``h``.

    ``e`` over ``total`` is the attention, ``mix`` its mean of the values ``v``; ``pair`` numbers a query's and a key's class.
    """
    whole = inputs.astype(np.intp)
    late = whole[:, STEP:]
    pair = (late * len(t["given"]))[:, :, None] + whole[:, None, :]
    e = t["given"].take(pair)
    if t["small"]:
        e *= t["distance"]
    else:
        e += t["distance"]
        e -= e.max(axis=2, keepdims=True)
        np.exp(e, out=e)
    v = t["value"].take(whole, axis=0)
    total = (e.reshape(-1, 2 * STEP) @ np.ones(2 * STEP, e.dtype)).reshape(late.shape)
    mix = e @ v
    mix /= total[:, :, None]
    h = t["own"].take(late, axis=0)
    h += mix
    return {"whole": whole, "pair": pair, "v": v, "e": e, "total": total, "mix": mix, "h": np.tanh(h, out=h)}


def _steep(w: dict[str, np.ndarray]) -> bool:
    """Whether logits may be too large to be raised to; hidden values lie between -1 and 1."""
    return bool(max((np.abs(w[a]).sum(axis=0) + np.abs(w[b])).max() for a, b in (("out", "bias"), ("family", "family_bias"))) > 60)


def _level(logits: np.ndarray, steep: bool) -> np.ndarray:
    """The logits, lowered in place to 0 at most where they are too large to be raised to."""
    if steep:
        logits -= logits.max(axis=-1, keepdims=True)
    return logits


def _sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[-1], values.dtype)


def forward(w: dict[str, np.ndarray], inputs: np.ndarray) -> dict[str, np.ndarray]:
    """The attention of each window and, as ``logits``, the logarithms of all classes' probabilities."""
    f, steep = _attention(_tables(w), inputs), _steep(w)
    family = _level(f["h"] @ w["family"] + w["family_bias"], steep)
    inner = _level((f["h"] @ w["out"] + w["bias"]).reshape(*family.shape, FAMILY), steep)
    family, inner = (x - np.log(_sums(np.exp(x)))[..., None] for x in (family, inner))
    return f | {"logits": (family[..., None] + inner).reshape(*family.shape[:-1], CLASSES)}


def _by_family(w: dict[str, np.ndarray], h: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Logits of the families, and of the classes of the target's own; rows in the order of families, with its edges."""
    edges = y.searchsorted(np.arange(FAMILIES + 1) * FAMILY).tolist()
    weights = np.ascontiguousarray(w["out"].reshape(SIZE, FAMILIES, FAMILY).transpose(1, 0, 2))
    inner = np.empty((len(h), FAMILY), h.dtype)
    for own, a, b in zip(weights, edges, edges[1:]):
        if a < b:
            np.matmul(h[a:b], own, out=inner[a:b])
    inner += w["bias"].reshape(-1, FAMILY).take(y // FAMILY, axis=0)
    family = h @ w["family"]
    family += w["family_bias"]
    return family, inner, edges


def _by_target(targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that have a target, in the order of their targets; these targets."""
    flat = targets.ravel()
    order = np.argsort(flat, kind="stable")[np.count_nonzero(flat < 0):]
    return order, flat.take(order).astype(np.intp)


def class_log10(
    w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, tables: dict[str, np.ndarray] | None = None
) -> np.ndarray:
    """log10 probability of each target class; 0 beyond the end of a text. ``tables`` are those of ``w``."""
    order, y = _by_target(targets)
    hidden = _attention(tables or _tables(w), inputs)["h"].reshape(-1, SIZE)
    family, inner, _ = _by_family(w, hidden.take(order, axis=0), y)
    row, steep, out = np.arange(len(y)) * FAMILY, _steep(w), np.zeros(targets.size)
    for part, at in ((family, y // FAMILY), (inner, y % FAMILY)):
        own = _level(part, steep).take(row + at)
        out[order] += (own - np.log(_sums(np.exp(part, out=part)))) / np.log(10)
    return out.reshape(targets.shape)


def _scattered(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the columns of ``values`` by ``index``, as rows."""
    order = np.argsort(index, kind="stable")
    ranked, out = index.take(order), np.zeros((size, len(values)), values.dtype)
    starts = np.flatnonzero(np.diff(ranked, prepend=-1))
    out[ranked[starts]] = np.add.reduceat(values.take(order, axis=1), starts, axis=1).T
    return out


def gradients(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log likelihood of the targets."""
    t, size = _tables(w), CLASSES + 2
    f, steep = _attention(t, inputs), _steep(w)
    order, y = _by_target(targets)
    h = f["h"].reshape(-1, SIZE)
    hs, row = h.take(order, axis=0), np.arange(len(y)) * FAMILY
    family, inner, edges = _by_family(w, hs, y)
    scale = h.dtype.type(1 / max(1, len(y)))
    for part, at in ((family, y // FAMILY), (inner, y % FAMILY)):
        np.exp(_level(part, steep), out=part)
        part *= (scale / _sums(part))[:, None]
        part.reshape(-1)[row + at] -= scale
    dh, one = np.empty_like(hs), np.ones(len(y), h.dtype)
    out, bias = np.zeros((FAMILIES, SIZE, FAMILY), h.dtype), np.zeros((FAMILIES, FAMILY), h.dtype)
    weights = np.ascontiguousarray(w["out"].T).reshape(FAMILIES, FAMILY, SIZE)
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        if a < b:
            np.matmul(inner[a:b], weights[k], out=dh[a:b])
            np.matmul(hs[a:b].T, inner[a:b], out=out[k])
            np.matmul(one[a:b], inner[a:b], out=bias[k])
    dh += family @ w["family"].T
    dh *= 1 - hs * hs
    place = np.full(len(h), len(y))
    place[order] = np.arange(len(y))
    d = np.concatenate([dh, np.zeros((1, SIZE), h.dtype)]).take(place, axis=0).reshape(f["h"].shape)
    own = _scattered(inputs[:, STEP:].ravel(), np.ascontiguousarray(d.reshape(-1, SIZE).T), size)
    # Through the attention, to the tables of queries, keys and values, then to the weights behind them.
    d /= f["total"][:, :, None]
    ds = d @ f["v"].transpose(0, 2, 1)
    ds -= np.einsum("ijk,ijk->ij", d, f["mix"])[:, :, None]
    ds *= f["e"]
    pairs = np.bincount(f["pair"].ravel(), ds.ravel(), size * size).reshape(size, size).astype(h.dtype)
    query, key = pairs @ t["key"], pairs.T @ t["query"]
    value = (f["e"].transpose(0, 2, 1) @ d).reshape(-1, SIZE)
    value = _scattered(inputs.ravel(), np.ascontiguousarray(value.T), size)
    upper, lower, up = w["hidden"][:SIZE], w["hidden"][SIZE:], w["embed"].T
    distance, through = np.zeros_like(w["distance"]), up @ value
    np.add.at(distance, _BEHIND[_VISIBLE], ds.sum(axis=0)[_VISIBLE])
    return {
        "embed": query @ w["query"].T + key @ w["key"].T + own @ upper.T + value @ (w["value"] @ lower).T,
        "distance": distance, "query": up @ query, "key": up @ key, "value": through @ lower.T,
        "hidden": np.concatenate([up @ own, w["value"].T @ through]), "out": out.transpose(1, 0, 2).reshape(SIZE, CLASSES), "bias": bias.ravel(),
        "family": hs.T @ family, "family_bias": one @ family,
    }


def first_weights(share: np.ndarray, settings: Settings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(settings.seed)
    shapes = {
        "embed": (CLASSES + 2, SIZE), "query": (SIZE, SIZE), "key": (SIZE, SIZE), "value": (SIZE, SIZE), "hidden": (2 * SIZE, SIZE),
        "out": (SIZE, CLASSES), "family": (SIZE, FAMILIES), "distance": (2 * STEP,), "bias": (CLASSES,), "family_bias": (FAMILIES,),
    }
    w = {name: rng.normal(0, 0.3 if len(shape) == 2 else 0, shape).astype(np.float32) for name, shape in shapes.items()}
    w["out"] *= 0.3
    w["family"] *= 0.3
    w["bias"] = np.log(share).astype(np.float32)
    w["family_bias"] = np.log(share.reshape(-1, FAMILY).sum(axis=1)).astype(np.float32)
    return w


def train(
    texts: list[np.ndarray], share: np.ndarray, settings: Settings, start: dict[str, np.ndarray] | None = None,
    passes: int | None = None, rate: float = 1.0, seed: int = 0,
) -> dict[str, np.ndarray]:
    """Weights after each window of the texts (classes) has been learned from ``passes`` times.

    Without ``start`` the first weights, which give each class about its ``share``; without ``passes`` as
    many as give ``settings.steps`` batches. ``rate`` falls to a half of itself.
    """
    w = {name: v.copy() for name, v in (start or first_weights(share, settings)).items()}
    inputs, targets, _ = windows(texts)
    if not len(inputs):
        return w
    rng, size = np.random.default_rng([settings.seed, seed]), len(inputs)
    size = -(-size // -(-size // settings.batch))  # batches of about the same size
    rounds = -(-len(inputs) // size)
    passes = passes or max(1, -(-settings.steps // rounds))
    names, flat = sorted(w), np.concatenate([w[name].ravel() for name in sorted(w)])
    w = _views(flat, w)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, passes * rounds + 1):
        if step % rounds == 1 or rounds == 1:
            order = rng.permutation(len(inputs))
        at = (step - 1) % rounds * size
        pick = order[at:at + size]
        found = gradients(w, inputs.take(pick, axis=0), targets.take(pick, axis=0))
        g = np.concatenate([found[name].ravel() for name in names])
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        now = settings.rate * rate * (1 - step / (passes * rounds + 1) / 2) / (1 - 0.9**step)
        flat -= now * mean / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return w


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[name].ravel() for name in sorted(w)]).astype(np.float64)


def _views(flat: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    parts = np.split(flat, np.cumsum([w[name].size for name in sorted(w)])[:-1])
    return {name: part.reshape(w[name].shape) for name, part in zip(sorted(w), parts)}


def _summed(texts: DataFrame, each: Callable[[dict], np.ndarray]) -> np.ndarray | None:
    """The sum of what ``each`` gives for the rows of ``texts``: summed in the tasks, then in ``PARTS`` parts, then on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                found = each(row)
                total = found if total is None else total + found
        if total is not None:
            part = TaskContext.get().partitionId() % PARTS
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("sums"))
        return pa.table({"sums": pa.array([sums.tobytes()], pa.binary())})

    found = texts.mapInArrow(run, "part int, sums binary").groupBy("part").applyInArrow(add, "sums binary").collect()
    return sum(np.frombuffer(r.sums, np.float64) for r in found) if found else None


def _texts_of(row: dict) -> list[np.ndarray]:
    return np.split(blocks.unpack(row["ids"]).astype(np.int64), np.cumsum(blocks.unpack(row["sizes"]), dtype=np.int64)[:-1])


def _encoded(cut: DataFrame, mine: DataFrame, end: int) -> DataFrame:
    """A written table: the subwords of the training texts of each block, how many windows they have, the centres of their kinds."""

    def finish(own: list[dict], numbers: np.ndarray, gathered: list) -> pa.Table:
        found = [np.r_[ids, end].astype(np.uint32) for doc, ids in bpe.documents_of(gathered, own, numbers) if doc["flag"]]
        if not found:
            return schema.empty_table()
        centres, weight = cluster(_shape(found), np.ones(len(found)))
        sizes = np.array([len(t) for t in found])
        return pa.Table.from_pylist([{
            "ids": blocks.pack(np.concatenate(found)), "sizes": blocks.pack(sizes), "windows": int((-(-sizes // STEP)).sum()),
            "centres": centres.tobytes(), "weight": weight.tobytes(),
        }], schema)

    schema = pa.schema([("ids", pa.binary()), ("sizes", pa.binary()), ("windows", pa.int64()), ("centres", pa.binary()), ("weight", pa.binary())])
    found = blocks.assemble(cut, mine, finish, "ids binary, sizes binary, windows bigint, centres binary, weight binary")
    return settle(found.withColumn("number", F.xxhash64("ids", "sizes")))


def _centres(texts: DataFrame) -> np.ndarray:
    """The centres of all blocks, clustered in ``PARTS`` parts and then once more."""

    def read(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        centres = np.concatenate([np.frombuffer(r["centres"], np.float32).reshape(-1, SPREAD) for r in rows])
        return centres, np.concatenate([np.frombuffer(r["weight"], np.float64) for r in rows])

    def merge(table: pa.Table) -> pa.Table:
        centres, weight = cluster(*read(table.sort_by("number").to_pylist()))
        return pa.table({"centres": pa.array([centres.tobytes()], pa.binary()), "weight": pa.array([weight.tobytes()], pa.binary())})

    parts = texts.select("number", "centres", "weight").groupBy(F.pmod("number", F.lit(PARTS)).alias("part"))
    rows = [r.asDict() for r in parts.applyInArrow(merge, "centres binary, weight binary").collect()]
    return cluster(*read(sorted(rows, key=lambda r: r["centres"])))[0]


def _kind_counts(texts: DataFrame, centres: np.ndarray, end: int) -> np.ndarray:
    """How often the texts of each kind have each subword."""

    def each(row: dict) -> np.ndarray:
        found = _texts_of(row)
        kind = _nearest(_shape(found), centres)[0]
        at = np.repeat(kind * (end + 1), [len(t) for t in found]) + np.concatenate(found)
        return np.bincount(at, minlength=KINDS * (end + 1)).astype(np.float64)

    return _summed(texts.select("ids", "sizes"), each).reshape(KINDS, -1)


def _trained(texts: DataFrame, classes: np.ndarray, share: np.ndarray, settings: Settings) -> dict[str, np.ndarray]:
    """The weights after all windows of all texts; a block learns by itself, and the blocks of a round are averaged by their windows."""
    w = first_weights(share, settings)
    stats = texts.agg(F.count("*").alias("n"), F.sum("windows").alias("windows")).first()
    if not stats.n:
        w["out"] *= 0
        w["family"] *= 0
        return w
    rounds = min(ROUNDS, stats.n)
    passes = max(1, -(-settings.steps * settings.batch // stats.windows))
    passes, inside = (1, passes) if stats.n == 1 else (min(passes, ROUNDS), -(-passes // ROUNDS))
    ranked = texts.select("ids", "sizes", "windows", "number")
    for k in range(passes * rounds):
        shared = texts.sparkSession.sparkContext.broadcast((classes, w))

        def each(row: dict, k: int = k) -> np.ndarray:
            group, start = shared.value
            found = train([group[t] for t in _texts_of(row)], share, settings, start, inside, 1 - k / (passes * rounds), abs(row["number"]) + k)
            return np.r_[_flat(found) * row["windows"], row["windows"]]

        sums = _summed(ranked.where(F.pmod(F.col("number"), F.lit(rounds)) == k % rounds), each)
        if sums is not None:
            w = _views((sums[:-1] / sums[-1]).astype(np.float32), w)
        shared.unpersist()
    return w


def _subword_log10(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 probabilities of all subwords of the texts, one text after the other."""
    inputs, targets, _ = windows([model.classes[t] for t in texts])
    found, tables = [], _tables(model.weights)
    for begin in range(0, len(inputs), BATCH):
        part = slice(begin, begin + BATCH)
        found.append(class_log10(model.weights, inputs[part], targets[part], tables)[targets[part] >= 0])
    return np.concatenate(found) + model.inside[np.concatenate(texts)]


def _scores(texts: list[np.ndarray], lengths: list[np.ndarray], shares: list[np.ndarray], model: Model) -> list[float]:
    """log10 probability of each text: subword ids with the end, how many each word has, log10 shares of the words."""
    sizes, logs = np.concatenate(lengths), _subword_log10(texts, model)
    words = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
    known = (np.concatenate(shares) + np.log10(KNOWN)) * np.log(10)
    both = np.logaddexp((words + np.log10(1 - KNOWN)) * np.log(10), known) / np.log(10)
    counts = np.array([len(x) for x in lengths])
    return np.add.reduceat(both, np.cumsum(counts) - counts).tolist()


def report(spark: SparkSession, docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """Score every whole text: ``base_score`` from word counts, ``score`` from the model.

    A null text is an empty one, which has the end as its only token. Repeated rows count and are scored
    one by one; without any training text all counts are 0; an empty table gives no rows; further
    columns are ignored.
    """
    ranks = bpe.load_ranks(path)
    end = max(ranks.values(), default=-1) + 1
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = whole_text(docs.withColumn("flag", training()), "doc_id", "flag")
    cut = blocks.cut_into_blocks(rows, split_words, buckets)
    shared = spark.sparkContext.broadcast((ranks, bpe.pairs_of(ranks)))

    def count(table: pa.Table) -> pa.Table:
        return _counted(*shared.value)(table)

    answered = settle(blocks.words_of(cut).groupBy("bucket").applyInArrow(count, ANSWER))
    stats = answered.where(F.col("block") < 0)
    sums = stats.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    ends = blocks.docs_of(cut).agg(F.sum(F.size(F.filter("docs", lambda x: x["flag"])))).first()[0] or 0
    # As many rows as the vocabulary has tokens.
    counts = np.zeros(end + 1)
    subwords = stats.select("payload", "extra").mapInArrow(_subword_rows, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    for r in subwords.collect():
        counts[r.id] = r.n
    counts[end] = ends
    mine = answered.where(F.col("block") >= 0).select("block", "bucket", "payload", "extra")
    texts = _encoded(cut, mine, end)
    begins = np.array([token[:1] == b" " for token in bpe.token_table(ranks)] + [True], np.int64)
    kinds = kinds_of(_kind_counts(texts, _centres(texts), end)) if ends else np.full(end + 1, KINDS)
    classes, inside = class_table(counts, kinds * 2 + begins)
    share = np.bincount(classes, counts + SMOOTH, CLASSES)
    weights = _trained(texts, classes, np.maximum(share, 1e-9) / share.sum(), settings)
    model = spark.sparkContext.broadcast(Model(classes, inside, weights, sums.n + ends, sums.v + (ends > 0), ends))
    arrow, kind = to_arrow_type(docs.schema["doc_id"].dataType), docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def finish(own: list[dict], numbers: np.ndarray, gathered: list) -> pa.Table:
        m = model.value
        seen = np.zeros(1 + max((int(place[-1]) for place, _, _ in gathered if len(place)), default=-1), np.int64)
        for place, _, more in gathered:
            seen[place] = np.frombuffer(more[0], np.int64)
        below = m.total + SMOOTH * (m.distinct + 1)
        logs = np.log10((np.r_[seen, m.ends] + SMOOTH) / below)
        out: dict[str, list] = {name: [] for name in names}
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        long = bpe.word_lengths(gathered)
        for (doc, ids), (_, places) in zip(bpe.documents_of(gathered, own, numbers), blocks.doc_numbers(own, numbers)):
            out["doc_id"].append(doc["doc_id"])
            out["held_out"].append(not doc["flag"])
            out["n_tokens"].append(len(places) + 1)
            out["n_known"].append(int((seen[places] > 0).sum()) + (m.ends > 0))
            out["train_tokens"].append(m.total)
            shares = np.r_[logs[places], logs[-1]]
            out["base_score"].append(float(shares.sum()))
            held.append((np.r_[ids, end].astype(np.int64), np.r_[long[places], 1], shares))
            size += len(held[-1][0])
            if size > STEP * 4 * BATCH:
                out["score"].extend(_scores(*map(list, zip(*held)), m))
                held, size = [], 0
        if held:
            out["score"].extend(_scores(*map(list, zip(*held)), m))
        kinds = [arrow, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({name: pa.array(out[name], t) for name, t in zip(names, kinds)})

    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return blocks.assemble(cut, mine, finish, schema)
