"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters with two vectors: one of its own, if the training texts hold it often enough, and
the mean of those of its character trigrams. Windows of ``WINDOW`` words that overlap by half
run through a gated recurrent layer in either direction; attention weighs the states of a window
into one vector and a logit. A text is as toxic as its most toxic window. In training only whole
texts have labels, so a text's probability is that at least one window is toxic (noisy or).

The labelled sample is bounded by ``SAMPLE`` texts of each label, chosen by their ids' hashes, and
taken whole. It is read by one task, which keeps four bytes for each word, trains, and returns the
weights; the driver sees only those. Of a text with more than ``DRAWN`` windows a step of the
training draws half of them from the whole text and half from those the network last took for the
most toxic. Scoring takes all windows of whole texts.

Defined results: texts that are null or hold no word score 0; labels that are null are not
learned from; with no labelled text of both kinds every score is 0; repeated rows give repeated
results. A score reads only ``text``; ``doc_id`` is passed on, and further columns can't clash.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import keep, map_rows, pieces, ship, texts

WINDOW, STRIDE = 32, 16
WORD_SIZE, CHAR_SIZE, HIDDEN, BUCKETS = 8, 12, 8, 1 << 13
SAMPLE, VOCABULARY, LEAST_TEXTS = 800, 20_000, 4
#: Windows of a text that a training step takes; steps after which long texts are scored anew.
DRAWN, REFRESH = 96, 75
#: One labelled text in so many sets the threshold.
APART = 5
STEPS, TEXTS_A_STEP, RATE, SEED = 450, 16, 0.01, 7
#: The share of words that a training step hides.
HIDDEN_WORDS = 0.3
THRESHOLD = 0.7
#: Words whose inputs a worker remembers at most, and windows it runs at once.
REMEMBERED, AT_ONCE = 300_000, 4096

WORDS = re.compile(r"\w+")
#: Longer runs (scripts without blanks, names with underscores) are cut into pieces of so many
#: characters that overlap by half; each is a word of its own.
LONGEST = 40


def words(text: str) -> list[str]:
    out: list[str] = []
    for word in WORDS.findall(text.lower()):
        if len(word) <= LONGEST:
            out.append(word)
        else:
            half = LONGEST // 2
            out += [word[i:i + LONGEST] for i in range(0, len(word) - half, half)]
    return out


def trigrams(word: str) -> list[int]:
    data = f"<{word}>".encode()
    return [zlib.crc32(data[i:i + 3]) % BUCKETS for i in range(max(1, len(data) - 2))]


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many words, put one after another: each window's text, first word and end."""
    many = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(sizes)), many)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    return owner, begin[owner] + STRIDE * place, (begin + sizes)[owner]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Weights:
    """The network's weights; of each pair the first belongs to the forward direction."""

    word: np.ndarray  # by vocabulary, row 0 for the others
    char: np.ndarray  # by trigram bucket
    inward: np.ndarray  # (2, word and char size, 3 hidden): update, reset, new
    bias: np.ndarray  # (2, 3 hidden)
    state: np.ndarray  # (2, hidden, 3 hidden)
    attention: np.ndarray  # 2 hidden
    out: np.ndarray  # 2 hidden
    shift: np.ndarray  # 1

    @classmethod
    def start(cls, vocabulary: int) -> Weights:
        random = np.random.default_rng(SEED)
        size = WORD_SIZE + CHAR_SIZE

        def drawn(*shape: int, scale: float) -> np.ndarray:
            return (random.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            drawn(vocabulary + 1, WORD_SIZE, scale=0.1), drawn(BUCKETS, CHAR_SIZE, scale=0.3),
            drawn(2, size, 3 * HIDDEN, scale=size ** -0.5), np.zeros((2, 3 * HIDDEN), np.float32),
            drawn(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5), drawn(2 * HIDDEN, scale=0.3),
            drawn(2 * HIDDEN, scale=0.3), np.full(1, -3, np.float32),
        )


def run_layer(gates: np.ndarray, rows: np.ndarray, mask: np.ndarray, state: np.ndarray, save: bool = False):
    """States (steps, windows, hidden) of one direction over the inputs ``gates[rows]``."""
    steps, many = rows.shape
    h = np.zeros((many, HIDDEN), np.float32)
    out, kept = np.empty((steps, many, HIDDEN), np.float32), []
    zr = state[:, :2 * HIDDEN]
    new = state[:, 2 * HIDDEN:]
    for t in range(steps):
        x = gates[rows[t]]
        g = sigmoid(x[:, :2 * HIDDEN] + h @ zr)
        z, r = g[:, :HIDDEN], g[:, HIDDEN:]
        hn = h @ new
        n = np.tanh(x[:, 2 * HIDDEN:] + r * hn)
        if save:
            kept.append((h, z, r, hn, n))
        h = (n + z * (h - n)) * mask[t][:, None]
        out[t] = h
    return (out, kept) if save else out


def back_layer(grad: np.ndarray, kept: list, mask: np.ndarray, state: np.ndarray):
    """Gradients of the inputs (steps, windows, 3 hidden) and of ``state``."""
    steps = len(kept)
    dgates = np.empty((*grad.shape[:2], 3 * HIDDEN), np.float32)
    dstate, dh = np.zeros_like(state), np.zeros(grad.shape[1:], np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, hn, n = kept[t]
        d = (dh + grad[t]) * mask[t][:, None]
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        dgates[t] = np.concatenate([dz, dr, dn], axis=1)
        dzr = dgates[t][:, :2 * HIDDEN]
        dhn = dn * r
        dstate[:, :2 * HIDDEN] += h.T @ dzr
        dstate[:, 2 * HIDDEN:] += h.T @ dhn
        dh = d * z + dzr @ state[:, :2 * HIDDEN].T + dhn @ state[:, 2 * HIDDEN:].T
    return dgates, dstate


def pool(weights: Weights, states: np.ndarray, mask: np.ndarray):
    """Attention over the steps: logits, and what the gradient needs."""
    e = states @ weights.attention
    e = np.where(mask, e, -1e9)
    a = np.exp(e - e.max(axis=0)) * mask
    a /= a.sum(axis=0)
    c = (a[:, :, None] * states).sum(axis=0)
    return c @ weights.out + weights.shift[0], a, c


class Network:
    """Weights, and the vocabulary they belong to."""

    def __init__(self, weights: Weights, vocabulary: dict[str, int]):
        self.weights, self.vocabulary = weights, vocabulary
        self.rows: dict[str, int] = {}
        self.gates = np.empty((2, 0, 3 * HIDDEN), np.float32)

    def inputs(self, some: list[str], hide: np.ndarray | None = None):
        """The words' vectors, with their numbers, trigrams and how many each has; a word whose
        share in ``hide`` is under ``HIDDEN_WORDS`` counts as not in the vocabulary."""
        numbers = np.array([self.vocabulary.get(w, 0) for w in some])
        if hide is not None:
            numbers[hide < HIDDEN_WORDS] = 0
        grams = [trigrams(w) for w in some]
        counts = np.array([len(g) for g in grams])
        flat = np.concatenate(grams) if grams else np.zeros(0, int)
        starts = np.cumsum(counts) - counts
        chars = np.add.reduceat(self.weights.char[flat], starts, axis=0) / counts[:, None]
        return np.hstack([self.weights.word[numbers], chars]).astype(np.float32), numbers, flat, counts

    def word_gates(self, some: list[str]) -> np.ndarray:
        x = self.inputs(some)[0]
        return np.stack([x @ self.weights.inward[d] + self.weights.bias[d] for d in (0, 1)])

    def numbered(self, lists: list[list[str]]) -> np.ndarray:
        """Rows of ``gates`` for the words, worked out once while they are remembered."""
        new = set().union(*lists).difference(self.rows)
        if len(self.rows) + len(new) > REMEMBERED:
            self.rows, new = {}, set().union(*lists)
            self.gates = self.gates[:, :0]
        if new:
            new = sorted(new)
            at = len(self.rows)
            self.rows.update(zip(new, range(at, at + len(new))))
            if at + len(new) > self.gates.shape[1]:
                room = np.empty((2, 2 * (at + len(new)), 3 * HIDDEN), np.float32)
                room[:, :at] = self.gates[:, :at]
                self.gates = room
            self.gates[:, at:at + len(new)] = self.word_gates(new)
        get = self.rows.__getitem__
        return np.fromiter((n for ws in lists for n in map(get, ws)), dtype=np.int64, count=sum(map(len, lists)))

    def logits(self, gates: np.ndarray, numbers: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(first), np.float32)
        for at in range(0, len(first), AT_ONCE):
            rows = (first[at:at + AT_ONCE] + np.arange(WINDOW)[:, None])
            mask = rows < end[at:at + AT_ONCE]
            rows = numbers[np.where(mask, rows, 0)]
            forward = run_layer(gates[0], rows, mask, self.weights.state[0])
            backward = run_layer(gates[1], rows[::-1], mask[::-1], self.weights.state[1])[::-1]
            out[at:at + AT_ONCE] = pool(self.weights, np.concatenate([forward, backward], axis=2), mask)[0]
        return out

    def scores(self, some: list[str]) -> np.ndarray:
        """The highest probability of each text's windows."""
        lists = [words(t) for t in some]
        numbers = self.numbered(lists)
        owner, first, end = windows(np.array([len(ws) for ws in lists], dtype=np.int64))
        best = np.full(len(some), -np.inf, np.float32)
        np.maximum.at(best, owner, self.logits(self.gates, numbers, first, end))
        return np.where(np.isfinite(best), sigmoid(best), 0.0).astype(float)


class Samples:
    """Labelled texts as numbers of their words."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.texts: list[np.ndarray] = []
        self.labels: list[int] = []

    def add(self, text: str, label: int) -> None:
        """Takes a text in; one without words is left out."""
        numbers = self.numbers
        found = np.array([numbers.setdefault(w, len(numbers)) for w in words(text)], dtype=np.int32)
        if len(found):
            self.texts.append(found)
            self.labels.append(label)


def drawn(size: int, hard: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of a text's windows that a step takes: all, or ``DRAWN`` of a long one."""
    _, first, end = windows(np.array([size]))
    if len(first) <= DRAWN:
        return first, end
    some = np.unique(np.concatenate([hard, random.choice(len(first), DRAWN - len(hard), replace=False)]))
    return first[some], end[some]


def train_step(
    net: Network, names: list[str], texts: list[np.ndarray], hard: list[np.ndarray], labels: np.ndarray,
    random: np.random.Generator,
) -> dict[str, np.ndarray]:
    """Gradients of the loss of some texts (numbers into ``names``); part of the words are hidden, so
    that their characters are learned as well."""
    w = net.weights
    some = [drawn(len(t), h, random) for t, h in zip(texts, hard)]
    sizes = np.array([len(t) for t in texts])
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), [len(f) for f, _ in some])
    first = np.concatenate([f + b for (f, _), b in zip(some, base)])
    end = np.concatenate([e + b for (_, e), b in zip(some, base)])
    used, numbers = np.unique(np.concatenate(texts), return_inverse=True)
    vocabulary = [names[i] for i in used]
    x, word_numbers, flat, counts = net.inputs(vocabulary, random.random(len(vocabulary)))
    gates = np.stack([x @ w.inward[d] + w.bias[d] for d in (0, 1)])
    rows = first + np.arange(WINDOW)[:, None]
    mask = rows < end
    rows = numbers[np.where(mask, rows, 0)]
    forward, kept_f = run_layer(gates[0], rows, mask, w.state[0], save=True)
    backward, kept_b = run_layer(gates[1], rows[::-1], mask[::-1], w.state[1], save=True)
    states = np.concatenate([forward, backward[::-1]], axis=2)
    logits, a, c = pool(w, states, mask)
    p = sigmoid(logits.astype(np.float64))
    none = np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-7)), minlength=len(texts))
    toxic = np.maximum(1 - np.exp(none), 1e-7)
    factor = np.where(labels > 0, -(1 - toxic) / toxic, 1.0)[owner]
    d = (p * factor / len(texts)).astype(np.float32)

    grads = {"shift": np.array([d.sum()]), "out": d @ c}
    dc = d[:, None] * w.out
    da = np.einsum("twh,wh->tw", states, dc)
    de = a * (da - (a * da).sum(axis=0))
    grads["attention"] = np.einsum("tw,twh->h", de, states)
    dstates = a[:, :, None] * dc + de[:, :, None] * w.attention
    df, sf = back_layer(dstates[:, :, :HIDDEN], kept_f, mask, w.state[0])
    db, sb = back_layer(dstates[::-1, :, HIDDEN:], kept_b, mask[::-1], w.state[1])
    grads["state"] = np.stack([sf, sb])
    dx = np.zeros_like(x)
    inward, bias = [], []
    for d_, grad, order in ((0, df, rows), (1, db, rows[::-1])):
        summed = np.zeros((len(vocabulary), 3 * HIDDEN), np.float32)
        flat_rows = order.ravel()
        for k in range(3 * HIDDEN):
            summed[:, k] = np.bincount(flat_rows, weights=grad[:, :, k].ravel(), minlength=len(vocabulary))
        inward.append(x.T @ summed)
        bias.append(summed.sum(axis=0))
        dx += summed @ w.inward[d_].T
    grads["inward"], grads["bias"] = np.stack(inward), np.stack(bias)
    grads["word"] = np.zeros_like(w.word)
    np.add.at(grads["word"], word_numbers, dx[:, :WORD_SIZE])
    grads["char"] = np.zeros_like(w.char)
    np.add.at(grads["char"], flat, np.repeat(dx[:, WORD_SIZE:] / counts[:, None], counts, axis=0))
    return grads


def train(samples: Samples, steps: int = STEPS) -> Network | None:
    """A network from labelled texts, or None without texts of both labels.

    As many texts of either label make a step. A text in ``APART`` of either label is not learned
    from: afterwards the threshold that parts those best, by F1, is moved to ``THRESHOLD`` (that of
    all texts, if a label has fewer than ``APART``).
    """
    labels = np.array(samples.labels)
    every = [np.flatnonzero(labels == side) for side in (0, 1)]
    if not all(len(s) for s in every):
        return None
    some_apart = all(len(s) >= APART for s in every)
    sides = [s[np.arange(len(s)) % APART > 0] for s in every] if some_apart else every
    apart = np.concatenate([s[::APART] for s in every] if some_apart else every)
    names = list(samples.numbers)
    seen = np.zeros(len(names), dtype=np.int64)
    for text in samples.texts:
        seen[np.unique(text)] += 1
    common = sorted((-int(seen[i]), names[i]) for i in np.flatnonzero(seen >= LEAST_TEXTS))[:VOCABULARY]
    net = Network(Weights.start(len(common)), {word: i + 1 for i, (_, word) in enumerate(common)})
    random = np.random.default_rng(SEED)
    first = {f.name: np.zeros_like(getattr(net.weights, f.name)) for f in fields(Weights)}
    second = {k: v.copy() for k, v in first.items()}
    half = np.repeat([0, 1], TEXTS_A_STEP // 2)
    hard = [np.empty(0, np.int64)] * len(labels)
    long = [i for i, t in enumerate(samples.texts) if len(windows(np.array([len(t)]))[0]) > DRAWN]
    for step in range(1, steps + 1):
        if step % REFRESH == 0:
            for i, logits in window_logits(net, names, samples.texts, long):
                hard[i] = np.argsort(-logits, kind="stable")[:DRAWN // 2]
        some = np.concatenate([s[random.integers(len(s), size=TEXTS_A_STEP // 2)] for s in sides])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        grads = train_step(net, names, [samples.texts[i] for i in some], [hard[i] for i in some], half, random)
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            change = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
            setattr(net.weights, k, (getattr(net.weights, k) - rate * change).astype(np.float32))
    best = [logits.max() for _, logits in window_logits(net, names, samples.texts, apart.tolist())]
    net.weights.shift += parting(sigmoid(np.array(best, dtype=float)), labels[apart])
    return Network(net.weights, net.vocabulary)


def window_logits(
    net: Network, names: list[str], texts: list[np.ndarray], some: Iterable[int]
) -> Iterator[tuple[int, np.ndarray]]:
    """The logits of all windows of some texts."""
    some = list(some)
    gates = net.word_gates(names) if some else None
    for i in some:
        _, first, end = windows(np.array([len(texts[i])]))
        yield i, net.logits(gates, texts[i], first, end)


def parting(scores: np.ndarray, labels: np.ndarray) -> np.float32:
    """What to add to the logits, so that the best parting threshold becomes ``THRESHOLD``."""
    logits = np.log(np.clip(scores, 1e-7, 1 - 1e-7) / (1 - np.clip(scores, 1e-7, 1 - 1e-7)))
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    best = int(f1.argmax())
    low = logits[order[best]]
    high = logits[order[best + 1]] if best + 1 < len(order) else low - 2
    return np.float32(np.log(THRESHOLD / (1 - THRESHOLD)) - (low + high) / 2)


def learn(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Network | None:
    """A network from at most ``most`` labelled texts of each label, chosen by their ids' hashes;
    it is trained in a task."""
    ship(documents.sparkSession)
    known = labels.where(F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    ).join(documents.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")
    sides = [
        known.where(F.col("toxic") == side).withColumn("place", F.xxhash64("doc_id"))
        .orderBy("place", "doc_id").limit(most) for side in (0, 1)
    ]
    chosen = keep(sides[0].unionByName(sides[1]), "labelled")
    rows = keep(  # at most 2 * most ids, and of repeated ids 2 * most texts a label
        texts(documents).join(F.broadcast(chosen), "doc_id").select("toxic", "place", "doc_id", "text")
        .orderBy("place", "doc_id", "toxic", "text").limit(4 * most), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = Samples()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                samples.add(text, label)
        net = train(samples)
        made = [] if net is None else [pickle.dumps((net.weights, net.vocabulary))]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["net"])

    order = ("place", "doc_id", "toxic", "text")
    found = rows.repartition(1).sortWithinPartitions(*order).select("toxic", "text").mapInArrow(run, "net binary").collect()
    return Network(*pickle.loads(found[0].net)) if found else None


def score(documents: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""
    if net is None:
        return texts(documents).select("doc_id", F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast((net.weights, net.vocabulary))
    made: list[Network] = []

    def run(rows: dict) -> dict:
        if not made:
            made.append(Network(*shared.value))
        return {"doc_id": rows["doc_id"], "score": made[0].scores(rows["text"])}

    return map_rows(texts(documents), "doc_id bigint, score double", run)


def without_toxic(documents: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score under the threshold, with all their columns; nothing is shuffled."""
    if net is None:
        return documents
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((net.weights, net.vocabulary))
    made: list[Network] = []

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 2 << 20):
                if not made:
                    made.append(Network(*shared.value))
                some = [t or "" for t in part.column("text").to_pylist()]
                yield part.filter(pa.array(made[0].scores(some) < threshold))

    return documents.mapInArrow(run, documents.schema)
