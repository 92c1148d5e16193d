"""Language-model scores: a word unigram base and a causal self-attention model.

One pass over the documents makes blocks: the subword ids of their texts, and their words as
numbers that hold within a lot of some blocks. Word counts are then joined by word, with one
row per lot and word, however common the word is, and return to the blocks of the lot as one
array. The attention model is trained
in numpy by the tasks that hold the training documents: each trains a copy on its share,
copies are averaged by a shuffle, and so on for some rounds. From a window of context it
predicts the class of the next subword, starting from how often classes follow the last
subword; the subword's share of its class, given the last one, is counted over all training
documents. Windows overlap so that each subword is scored once, with context before it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.pieces import encoder, slices
from ledgerspark.llm.text import LOWER, UPPER, whole_text
from ledgerspark.session import materialize, materialized


@dataclass(frozen=True)
class LmConfig:
    """Size of the model, and how it is trained."""

    hidden: int = 16
    step: int = 16  # subwords scored per window; as many stand before them as context
    units: int = 2048  # subwords told apart; the rare ones share a unit
    classes: int = 64  # of units that have like neighbours
    rounds: int = 2
    every: int = 2  # a round takes one window in so many, so that ``every`` rounds take each once
    batch: int = 64
    rate: float = 0.015
    smoothing: float = 0.1  # of a subword's share of its unit
    prior: float = 20.0  # weight of the plain frequencies in what follows a unit
    seed: int = 7


# ------------------------------------------------------------------ the model, in numpy


BLOCKS_PER_TASK = 1 << 18
PAD, START = 0, 1  # units of the place before a text and of its start


@dataclass
class Units:
    """Unit of each subword id (the end is the last id) and log10 of its share of the unit."""

    of: np.ndarray
    log_share: np.ndarray


def make_units(counts: np.ndarray, config: LmConfig) -> Units:
    """The end and the most frequent subwords get units of their own, the rest bins of equal mass."""
    weight = counts.astype(np.float64)
    weight[-1] = np.inf
    order = np.lexsort((np.arange(len(counts)), -weight))
    bins = config.units // 8
    single = min(config.units - 2 - bins, len(counts))
    of = np.empty(len(counts), np.int32)
    of[order[:single]] = 2 + np.arange(single)
    rest = counts[order[single:]] + 1.0
    mass = np.cumsum(rest)
    total = mass[-1] if len(mass) else 1.0
    of[order[single:]] = 2 + single + np.minimum((mass - rest) * bins / total, bins - 1).astype(np.int32)
    smooth = counts + config.smoothing
    return Units(of, np.log10(smooth / np.bincount(of, smooth, config.units)[of]))


@dataclass
class Language:
    """What the counts of neighbours say; the frame that the attention model fills in."""

    units: Units
    classes: np.ndarray  # class of each unit
    log_class: np.ndarray  # natural log: class after unit
    log_unit: np.ndarray  # log10: unit after unit, within its class


def cluster_units(pairs: np.ndarray, config: LmConfig, turns: int = 15) -> np.ndarray:
    """k-means of units by what stands before and after them (a fixed random projection)."""
    rng = np.random.default_rng(config.seed)
    n = len(pairs)

    def profile(counts: np.ndarray) -> np.ndarray:
        share = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)
        return share @ (rng.standard_normal((n, 48)).astype(np.float32) / np.float32(48**0.5))

    points = np.concatenate([profile(pairs), profile(pairs.T)], 1)
    weight = np.log1p(pairs.sum(0)) + 1e-3
    centres = points[np.argsort(-pairs.sum(0), kind="stable")[: config.classes]].copy()
    for _ in range(turns):
        distance = (centres**2).sum(1)[None, :] - 2 * points @ centres.T
        nearest = distance.argmin(1)
        for k in range(len(centres)):
            own = nearest == k
            if own.any():
                centres[k] = np.average(points[own], axis=0, weights=weight[own])
    return nearest.astype(np.int32)


def make_language(units: Units, pairs: np.ndarray, config: LmConfig) -> Language:
    """From counts of (unit, next unit) over all training documents."""
    classes = cluster_units(pairs, config)
    plain = pairs.sum(0) + config.smoothing
    plain[~np.isin(np.arange(len(plain)), units.of)] = 1e-9  # not a unit of any subword
    follows = (pairs + config.prior * plain / plain.sum()) / (pairs.sum(1, keepdims=True) + config.prior)
    mass = np.zeros((len(pairs), config.classes))
    for k in range(config.classes):
        mass[:, k] = follows[:, classes == k].sum(1)
    mass = np.maximum(mass, 1e-12)
    return Language(
        units,
        classes,
        np.log(mass).astype(np.float32),
        np.log10(follows / mass[:, classes]).astype(np.float32),
    )


def exponentials(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of numbers and their sums along the last axis.

    Where one could overflow, or all of a row vanish, ``rows`` are first shifted to a largest
    value of 0, in place; a row's exponentials are the same multiple of its sum either way.
    """
    ones = np.ones(rows.shape[-1], rows.dtype)
    if rows.max(initial=0) < 60:
        odds = np.exp(rows)
        total = odds @ ones
        if total.min(initial=1) > 1e-20:
            return odds, total
    rows -= rows.max(-1, keepdims=True)
    odds = np.exp(rows)
    return odds, odds @ ones


class Attention:
    """One head of causal attention over unit embeddings, with a bias per distance.

    Its output is added to the log-probabilities of the classes after the last unit.
    """

    NAMES = ("embed", "query", "key", "value", "distance", "out", "bias")

    def __init__(self, config: LmConfig, log_class: np.ndarray) -> None:
        rng = np.random.default_rng(config.seed)
        d, c, k = config.hidden, config.units, config.classes

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.config = config
        self.embed = normal(c, d, scale=0.3)
        self.query, self.key, self.value = (normal(d, d, scale=d**-0.5) for _ in range(3))
        self.distance = np.zeros(2 * config.step, np.float32)
        self.out = np.zeros((2 * d, k), np.float32)  # so that training starts from the counts
        self.bias = np.zeros(k, np.float32)
        self.log_class = log_class
        step = config.step
        gap = step + np.arange(step)[:, None] - np.arange(2 * step)[None, :]
        self.future = gap < 0
        self.gap = np.where(self.future, 0, gap)

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.NAMES]

    def vector(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, vector[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def forward(self, x: np.ndarray):
        """Class log-probabilities (natural) after each of the last ``step`` inputs of windows.

        Not normalised; with the logarithm of their sum, and what the gradient needs.
        """
        d, step = self.config.hidden, self.config.step
        e = self.embed.take(x, 0)
        h = np.empty((len(x), step, 2 * d), e.dtype)
        h[:, :, d:] = e[:, step:]
        q = e[:, step:].reshape(-1, d) @ (self.query / np.float32(d**0.5))
        q = q.reshape(-1, step, d)
        kv = e.reshape(-1, d) @ np.concatenate([self.key, self.value], 1)
        kv = kv.reshape(-1, 2 * step, 2 * d)
        p = q @ kv[:, :, :d].transpose(0, 2, 1)
        p += np.where(self.future, np.float32(-1e9), self.distance[self.gap])
        absent = x == PAD
        if absent.any():
            p += np.where(absent, np.float32(-1e9), np.float32(0))[:, None, :]
        p, total = exponentials(p)
        p /= total[:, :, None]
        np.matmul(p, kv[:, :, d:], out=h[:, :, :d])
        logits = h.reshape(-1, 2 * d) @ self.out
        logits += self.bias
        logits += self.log_class.take(x[:, step:].ravel(), 0)
        odds, total = exponentials(logits)
        return logits, np.log(total), (e, q, kv, p, h, odds, total)

    def gradient(self, x: np.ndarray, target: np.ndarray, valid: np.ndarray) -> list[np.ndarray]:
        d, step = self.config.hidden, self.config.step
        _, _, (e, q, kv, p, h, g, total) = self.forward(x)
        weight = valid.ravel() / np.float32(max(valid.sum(), 1))
        g *= (weight / total)[:, None]
        g[np.arange(len(g)), target.ravel()] -= weight
        g_out = h.reshape(-1, 2 * d).T @ g
        g_h = (g @ self.out.T).reshape(h.shape)
        g_mix = g_h[:, :, :d]
        g_s = g_mix @ kv[:, :, d:].transpose(0, 2, 1)
        # The sum of the weights' gradients times the weights is that of the mix times the mix.
        g_s -= np.einsum("bij,bij->bi", g_mix, h[:, :, :d])[:, :, None]
        g_s *= p
        g_distance = np.bincount(self.gap.ravel(), g_s.sum(0).ravel(), len(self.distance))
        g_q = (g_s @ kv[:, :, :d]).reshape(-1, d)
        g_q /= np.float32(d**0.5)
        g_kv = np.empty_like(kv)
        np.matmul(g_s.transpose(0, 2, 1), q, out=g_kv[:, :, :d])
        np.matmul(p.transpose(0, 2, 1), g_mix, out=g_kv[:, :, d:])
        flat_kv = g_kv.reshape(-1, 2 * d)
        g_key_value = e.reshape(-1, d).T @ flat_kv
        g_e = (flat_kv @ np.concatenate([self.key, self.value], 1).T).reshape(e.shape)
        g_e[:, step:] += (g_q @ self.query.T).reshape(-1, step, d)
        g_e[:, step:] += g_h[:, :, d:]
        return [
            self._by_unit(x, g_e),
            e[:, step:].reshape(-1, d).T @ g_q,
            g_key_value[:, :d],
            g_key_value[:, d:],
            g_distance,
            g_out,
            np.ones(len(g), g.dtype) @ g,
        ]

    def _by_unit(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sums of the rows of each unit."""
        total = np.zeros_like(self.embed, rows.dtype)
        np.add.at(total.reshape(-1), (x.reshape(-1, 1) * rows.shape[2] + np.arange(rows.shape[2])).ravel(), rows.ravel())
        return total


class Adam:
    def __init__(self, model: Attention) -> None:
        self.model, self.t = model, 0
        self.m = [np.zeros_like(p) for p in model.parameters()]
        self.v = [np.zeros_like(p) for p in model.parameters()]
        self.room = [np.empty_like(p) for p in model.parameters()]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        rate = self.model.config.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for p, g, m, v, room in zip(self.model.parameters(), gradients, self.m, self.v, self.room):
            g = g.astype(np.float32, copy=False)
            np.subtract(g, m, out=room)
            room *= np.float32(0.1)
            m += room
            np.multiply(g, g, out=room)
            room -= v
            room *= np.float32(0.001)
            v += room
            np.sqrt(v, out=room)
            room += np.float32(1e-8)
            np.divide(m, room, out=room)
            room *= np.float32(rate)
            p -= room


def windows(texts: list[np.ndarray], units: Units, step: int):
    """Inputs (rows of 2 * step), target ids, which targets are real, and rows per text.

    A text is its ids and the end; its inputs are the start and its ids. Each window has the
    ``step`` inputs before those whose next subword it scores.
    """
    end = len(units.of) - 1
    rows = np.array([-(-(len(t) + 1) // step) for t in texts], np.int64)
    total = int(rows.sum())
    inputs = np.zeros((total + len(texts), step), np.int32)  # a row of nothing before each text
    target = np.zeros((total, step), np.int32)
    valid = np.zeros((total, step), bool)
    at = 0
    for k, (ids, n) in enumerate(zip(texts, rows.tolist())):
        flat = inputs[at + k + 1 : at + k + 1 + n].reshape(-1)
        flat[0] = START
        flat[1 : len(ids) + 1] = units.of[ids]
        goal = target[at : at + n].reshape(-1)
        goal[: len(ids)] = ids
        goal[len(ids)] = end
        valid[at : at + n].reshape(-1)[: len(ids) + 1] = True
        at += n
    place = np.arange(total) + np.repeat(np.arange(len(texts)), rows)
    return np.concatenate([inputs[place], inputs[place + 1]], 1), target, valid, rows


def windows_of_round(rows: np.ndarray, every: int, turn: int) -> np.ndarray:
    """Places of the windows that a round learns from, of texts with ``rows`` windows each.

    Rounds one after another take disjoint windows, and any ``every`` of them all windows.
    """
    nth = np.arange(int(rows.sum())) - np.repeat(np.cumsum(rows) - rows, rows)
    phase = np.repeat(np.arange(len(rows)) + turn, rows)
    return np.flatnonzero((nth + phase) % every == 0)


class Scorer:
    """The model's forward pass with everything that depends on one unit looked up.

    The same numbers as :meth:`Attention.forward`, without what only training needs: the
    last unit's part of the logits is a table, keys and values are one table, and the mask
    and the distances are one matrix.
    """

    def __init__(self, model: Attention, language: Language) -> None:
        d = model.config.hidden
        self.step, self.hidden, self.language = model.config.step, d, language
        self.query = model.embed @ model.query / np.float32(d**0.5)
        self.seen = model.embed @ np.concatenate([model.key, model.value], 1)
        self.shift = np.where(model.future, np.float32(-1e9), model.distance[model.gap]).astype(np.float32)
        self.mix_out = np.ascontiguousarray(model.out[:d])
        self.last_out = model.embed @ model.out[d:] + model.bias + language.log_class

    def log_words(self, x: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 probability of each target after the windows' inputs."""
        d = self.hidden
        flat, goal = x[:, self.step :].ravel(), target.ravel()
        seen = self.seen.take(x, 0)
        weights = self.query.take(flat, 0).reshape(len(x), self.step, d) @ seen[:, :, :d].transpose(0, 2, 1)
        weights += self.shift
        absent = x == PAD
        if absent.any():
            weights += np.where(absent, np.float32(-1e9), np.float32(0))[:, None, :]
        weights, total = exponentials(weights)
        mixed = weights @ seen[:, :, d:]
        mixed /= total[:, :, None]
        logits = mixed.reshape(-1, d) @ self.mix_out
        logits += self.last_out.take(flat, 0)
        _, total = exponentials(logits)
        unit = self.language.units.of.take(goal)
        own = logits[np.arange(len(goal)), self.language.classes.take(unit)]
        log_class = (own - np.log(total)) / np.log(10)
        within = self.language.log_unit[flat, unit] + self.language.units.log_share.take(goal)
        return (log_class + within).reshape(target.shape)

    def texts(self, texts: list[np.ndarray], chunk: int = 256) -> np.ndarray:
        """log10 probability of each text, end included."""
        x, target, valid, rows = windows(texts, self.language.units, self.step)
        row_score = np.empty(len(x))
        for a in range(0, len(x), chunk):
            log_word = self.log_words(x[a : a + chunk], target[a : a + chunk])
            row_score[a : a + chunk] = np.where(valid[a : a + chunk], log_word, 0).sum(1)
        return np.add.reduceat(row_score, np.cumsum(rows) - rows) if len(rows) else np.zeros(0)


# ------------------------------------------------------------------------- the passes


class Lot:
    """Numbers of the words of some blocks, and how often training texts of these hold each."""

    def __init__(self, number: int) -> None:
        self.number, self.chars = number, 0
        self.of: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.train = np.zeros(0, np.int64)

    def add(self, texts: list[str], training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts, one after the other, and how many each text has."""
        split = [text.encode().split() for text in texts]  # ASCII white space only
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(
            map(self.of.__getitem__, chain.from_iterable(split)), np.int32, int(lengths.sum())
        )
        train = np.bincount(numbers[np.repeat(training, lengths)], minlength=len(self.of))
        train[: len(self.train)] += self.train
        self.train = train
        self.chars += sum(map(len, texts))
        return numbers, lengths


def _halves(numbers: np.ndarray) -> bytes:
    """Lower halves of all numbers, then the upper ones, which are few and compress well."""
    return np.concatenate([numbers & 0xFFFF, numbers >> 16]).astype("<u2").tobytes()


def _from_halves(data: pa.Buffer) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int32)
    return low | high << 16


def _make_blocks(tokenizer: str, block_chars: int, lot_words: int = 400_000):
    """A row per block with its documents, and one per word of each lot of blocks. Rows of
    either kind have nulls in the columns of the other. A lot is closed at some 8 blocks or
    at ``lot_words`` words, after whole blocks."""

    names = [
        "lot", "block", "doc_id", "held_out", "n_tokens", "ids", "sizes", "id", "id_count",
        "words", "word", "number", "train",
    ]

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        task, made, lot, kinds = TaskContext.get().partitionId(), 0, None, []

        def words_of_lot() -> pa.RecordBatch:
            n = len(lot.of)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, lot.number, np.int64)),
                    *(pa.nulls(n, kind) for kind in kinds),
                    pa.array(list(lot.of), pa.binary()),
                    pa.array(np.arange(n, dtype=np.int32)),
                    pa.array(lot.train),
                ],
                names,
            )

        for batch in batches:
            texts = batch.column("body").to_pylist()
            training = ~np.array(batch.column("held_out").to_pylist(), bool)
            for a, b in slices(texts, block_chars):
                own = texts[a:b]
                encoded = [coder.encode(own[x:y]) for x, y in slices(own)]
                ids = np.concatenate([flat.astype("<u2") for flat, _ in encoded])
                sizes = np.concatenate([counts for _, counts in encoded])
                learnt = np.bincount(ids[np.repeat(training[a:b], sizes)], minlength=1)
                seen = np.flatnonzero(learnt)
                number = task * BLOCKS_PER_TASK + made
                made += 1
                lot = lot or Lot(number)
                words, lengths = lot.add(own, training[a:b])
                columns = [
                    pa.array([number]),
                    one(batch.column("doc_id").slice(a, b - a)),
                    one(batch.column("held_out").slice(a, b - a)),
                    one(pa.array(lengths + 1)),
                    pa.array([ids.tobytes()], pa.binary()),
                    one(pa.array(sizes)),
                    one(pa.array(seen)),
                    one(pa.array(learnt[seen])),
                    pa.array([_halves(words)], pa.binary()),
                ]
                kinds = [x.type for x in columns]
                of_words = (pa.nulls(1, kind) for kind in (pa.binary(), pa.int32(), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([lot.number]), *columns, *of_words], names)
                if lot.chars >= 8 * block_chars or len(lot.of) >= lot_words:
                    yield words_of_lot()
                    lot = None
        if lot:
            yield words_of_lot()

    return run


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Row number and the subword ids of each text, block by block."""
    for k, (data, sizes) in enumerate(zip(batch.column("ids"), batch.column("sizes"))):
        flat = np.frombuffer(data.as_buffer(), "<u2")
        yield k, np.split(flat, np.cumsum(sizes.values.to_numpy())[:-1])


def _learnt_texts(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
    for k, texts in _texts(batch):
        held = batch.column("held_out")[k].values.to_pylist()
        yield [t for t, h in zip(texts, held) if not h]


def _pair_counts(config: LmConfig, shared):
    """Counts of (unit, next unit) in the task's documents, start and end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.of
        counts = np.zeros(config.units**2, np.int64)
        for texts in chain.from_iterable(map(_learnt_texts, batches)):
            for a, b in slices(texts, 1_000_000):
                # PAD between texts: pairs with it are taken out on the driver.
                row = np.concatenate(
                    [x for t in texts[a:b] for x in ((PAD, START), of[t], of[-1:])]
                ).astype(np.int64)
                counts += np.bincount(row[:-1] * config.units + row[1:], minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["id", "n"])

    return run


def _train(config: LmConfig, shared, turn: int):
    """Train a copy on the task's documents; its parameters, weighted by its subwords."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, vector = shared.value
        model = Attention(config, language.log_class)
        model.load(vector)
        adam, weight = Adam(model), 0
        rng = np.random.default_rng(config.seed + turn)
        for texts in chain.from_iterable(map(_learnt_texts, batches)):
            for a, b in slices(texts, 500_000):
                x, target, valid, rows = windows(texts[a:b], language.units, config.step)
                chosen = rng.permutation(windows_of_round(rows, config.every, turn))
                for at in range(0, len(chosen), config.batch):
                    pick = chosen[at : at + config.batch]
                    goal = language.classes[language.units.of[target[pick]]]
                    adam.step(model.gradient(x[pick], goal, valid[pick]))
                weight += int(valid[chosen].sum())
        if weight:
            values = model.vector().astype(np.float64) * weight
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), float(weight)))],
                ["place", "value", "weight"],
            )

    return run


def _score(config: LmConfig, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, vector = shared.value
        model = Attention(config, language.log_class)
        model.load(vector)
        scorer = Scorer(model, language)
        for batch in batches:
            for k, texts in _texts(batch):
                scores = [scorer.texts(texts[a:b]) for a, b in slices(texts, 500_000)]
                block = batch.column("block")[k].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(texts), block)),
                        pa.array(np.arange(len(texts), dtype=np.int32)),
                        *(batch.column(c)[k].values for c in ("doc_id", "held_out", "n_tokens")),
                        pa.array(np.concatenate([*scores, np.zeros(0)])),
                    ],
                    ["block", "at", "doc_id", "held_out", "n_tokens", "score"],
                )

    return run


def _base_scores(total: int, distinct: int):
    """Sums over the words of each document of a lot, from its blocks and its words' totals."""

    def run(blocks: pa.Table, counted: pa.Table) -> pa.Table:
        c = np.zeros(counted.num_rows)
        c[counted.column("number").to_numpy()] = counted.column("c").to_numpy()
        score = np.log10(c + 0.1) - np.log10(total + 0.1 * (distinct + 1))
        found = []
        for block, words, n_tokens in zip(*(blocks.column(x) for x in ("block", "words", "n_tokens"))):
            numbers = _from_halves(words.as_buffer())
            lengths = n_tokens.values.to_numpy() - 1
            owner = np.repeat(np.arange(len(lengths)), lengths)
            found.append(
                pa.table(
                    {
                        "block": pa.array(np.full(len(lengths), block.as_py(), np.int64)),
                        "at": pa.array(np.arange(len(lengths), dtype=np.int32)),
                        "base": pa.array(np.bincount(owner, score[numbers], len(lengths))),
                        "known": pa.array(np.bincount(owner, c[numbers] > 0, len(lengths)).astype(np.int64)),
                    }
                )
            )
        return pa.concat_tables(found)

    return run


def word_totals(words: DataFrame) -> DataFrame:
    """How often each word occurs in training documents, summed on the map side first."""
    return words.groupBy("word").agg(F.sum("train").alias("c"))


def with_totals(words: DataFrame, totals: DataFrame) -> DataFrame:
    """The rows of words, by now without the words themselves, with the word's total.

    ``totals`` must be stored, so that both sides are shuffled for this join and AQE can split
    a word that most lots hold.
    """
    return words.join(totals, "word").drop("word", "train")


def lm_scores(
    docs: DataFrame,
    tokenizer: str,
    vocabulary: int,
    doc_id: str = "doc_id",
    text: str = "text",
    config: LmConfig | None = None,
    block_chars: int = 2_000_000,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Documents whose crc32 of the id as text is not divisible by ten are learnt from; the
    rest is held out. A null id is learnt from. Texts are lower-cased (A-Z); the base counts
    words at ASCII white space and one end per text. ``score`` is the attention model's
    log10 probability of the text's subwords and its end. A null or empty text is its end
    alone. Repeated rows count as often as they occur and get a row each; further columns are
    ignored; an empty table gives an empty result. ``vocabulary`` is the tokenizer's size, at
    most 65,535.

    The driver sees the counts of subwords and of pairs of units, and the model, all of a
    size that the configuration bounds. Training takes every window of every training document.
    """
    spark = docs.sparkSession
    config = config or LmConfig()
    if config.rounds < config.every:
        raise ValueError("Fewer rounds than ``every`` leave windows out of training.")
    if vocabulary > 65_535:
        raise ValueError("Subword ids must fit 16 bits.")
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        F.translate(whole_text(text), UPPER, LOWER).alias("body"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    stored = materialize(
        rows.mapInArrow(
            _make_blocks(tokenizer, block_chars),
            f"lot bigint, block bigint, doc_id array<{kind}>, held_out array<boolean>, n_tokens array<bigint>, "
            "ids binary, sizes array<bigint>, id array<bigint>, id_count array<bigint>, words binary, "
            "word binary, number int, train bigint",
        ),
        "lm-blocks",
    )
    blocks = stored.where("ids IS NOT NULL")
    # Each word has one row per lot.
    words = stored.where("word IS NOT NULL").select("lot", "number", "word", "train")
    with materialized(word_totals(words), "lm-totals") as totals:
        word_total, word_types = totals.where("c > 0").agg(
            F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))
        ).first()
        counted = materialize(with_totals(words, totals), "lm-words")
    counts = np.zeros(vocabulary + 1, np.int64)  # and the end
    by_id = (
        blocks.select(F.explode(F.arrays_zip("id", "id_count")).alias("c"))
        .groupBy("c.id")
        .agg(F.sum("c.id_count").alias("n"))
    )
    for row in by_id.collect():
        counts[row["id"]] = row["n"]
    counts[-1] = blocks.agg(F.sum(F.size(F.filter("held_out", lambda h: ~h)))).first()[0] or 0
    ends = int(counts[-1])
    total, distinct = word_total + ends, word_types + (ends > 0)

    learnt = blocks.select("ids", "sizes", "held_out")
    units = make_units(counts, config)
    shared = spark.sparkContext.broadcast(units)
    grouped = learnt.mapInArrow(_pair_counts(config, shared), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    found = grouped.toArrow()
    pairs = np.zeros(config.units**2)
    pairs[found["id"].to_numpy()] = found["n"].to_numpy()
    pairs = pairs.reshape(config.units, config.units)
    pairs[PAD] = pairs[:, PAD] = 0
    language = make_language(units, pairs, config)
    vector = Attention(config, language.log_class).vector()
    for turn in range(config.rounds):
        shared = spark.sparkContext.broadcast((language, vector))
        means = (
            learnt.mapInArrow(_train(config, shared, turn), "place bigint, value double, weight double")
            .groupBy("place")
            .agg((F.sum("value") / F.sum("weight")).alias("mean"))
            .collect()
        )
        for row in means:
            vector[row["place"]] = row["mean"]
    shared = spark.sparkContext.broadcast((language, vector))
    scored = blocks.select("block", "doc_id", "held_out", "n_tokens", "ids", "sizes").mapInArrow(
        _score(config, shared),
        f"block bigint, at int, doc_id {kind}, held_out boolean, n_tokens bigint, score double",
    )
    base = (
        blocks.select(F.col("lot").alias("of"), "block", "words", "n_tokens")
        .groupBy("of")
        .cogroup(counted.groupBy("lot"))
        .applyInArrow(_base_scores(total, distinct), "block bigint, at int, base double, known bigint")
    )
    end_score = float(np.log10(ends + 0.1) - np.log10(total + 0.1 * (distinct + 1)))
    return scored.join(base, ["block", "at"], "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.coalesce("known", F.lit(0)) + F.lit(int(ends > 0))).cast("bigint").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.coalesce("base", F.lit(0.0)) + F.lit(end_score)).alias("base_score"),
        "score",
    )
