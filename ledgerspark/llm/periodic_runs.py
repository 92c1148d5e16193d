"""Periodic runs of words: stretches that repeat themselves, with their smallest periods.

Words become numbers, the texts of a batch one array with a mark of its own after each text,
and everything below works on that array. Stretches of 1, 2, 4, ... words get exact names
(equal names, equal words), by which two places are compared over any length in few steps.

Periods too short for windows are found by direct scans, one per lag. The others are found
scale by scale. At scale w every window of w / 2 + 1 places selects those whose next w / 2
words have the smallest hash. A run of period q, w <= q < 2w, holds two whole periods, so
the window at its start and the one a period later lie in it, hold the same words and select
places a period apart: a pair of equal minimizers, whose extension to both sides is the run.

Equal minimizers less than w / 4 apart overlap in a run of a shorter period d, and are one
chain. A pair of chains stands for its maximal stretches [a, b) and [c, e) of period d. An
extension through both goes on past a start or an end only where both stretches start, or
both end, at the same step: at the lags c - a and e - b. All other lags end with the
stretches, which takes them to two periods only if the stretches touch, and then every lag
that fits the period d is a run. So each pair of chains has two candidates, and stretches
that touch one per run. Fewer than 8 chains of a minimizer fit into 2w places.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.pieces import ragged, slices
from ledgerspark.llm.text import whole_text

SHORTEST_WINDOW = 16
# Runs are looked up by shorter ones, so those of fewer words than reported are kept as well.
LEAST = 8
MIX = np.uint64(0x9E3779B97F4A7C15)


def _slide(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Least (or greatest) of ``size`` consecutive values, for every window."""
    pick = np.minimum if least else np.maximum
    width = 1
    while width < size:
        step = min(width, size - width)
        values = pick(values[:-step], values[step:])
        width += step
    return values


class RunFinder:
    """Runs of several texts, given as arrays of word numbers (0 and up)."""

    def __init__(self, texts: list[np.ndarray], top: int = 14) -> None:
        self.sizes = np.array([len(t) for t in texts], np.int64)
        # Longest first: what is long enough for a scale is a prefix of the array.
        self.order = np.argsort(-self.sizes, kind="stable")
        marks = int(max((t.max() for t in texts if len(t)), default=-1)) + 1
        parts = []
        for k, text in enumerate(self.order.tolist()):
            parts += [texts[text], [marks + k]]
        self.words = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
        ends = np.cumsum(self.sizes[self.order] + 1)
        self.begins = ends - self.sizes[self.order] - 1
        self.ends = ends
        self.names = [pd.factorize(self.words)[0]]
        self.top = top
        self.next_name = (0, self.names[0])
        # start, end, period of what was found, one array each per step
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _prefix(self, size: int) -> int:
        """Words (and marks) of the texts of at least ``size`` words."""
        k = int(np.searchsorted(-self.sizes[self.order], -size, "right"))
        return int(self.ends[k - 1]) if k else 0

    def _double(self, level: int, names: np.ndarray) -> np.ndarray:
        """Names of stretches of 2 ** (level + 1) words, from those of 2 ** level."""
        size = 1 << level
        n = min(len(names), self._prefix(2 * size)) - size
        if n <= 0:
            return np.empty(0, np.int64)
        left, right = names[:n], names[size : size + n]
        return pd.factorize(left.astype(np.int64) * (int(names.max()) + 1) + right)[0]

    def _named(self, level: int) -> np.ndarray:
        """Names of stretches of 2 ** level words; those up to ``top`` are kept."""
        while len(self.names) <= min(level, self.top):
            self.names.append(self._double(len(self.names) - 1, self.names[-1]))
        if level <= self.top:
            return self.names[level]
        at, names = self.next_name
        if at < self.top or at > level:
            at, names = self.top, self.names[self.top]
        while at < level:
            at, names = at + 1, self._double(at, names)
        self.next_name = (at, names)
        return names

    def _reach(self, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
        """How many words from x and y on (or before them) are equal; x < y."""
        done = np.zeros(len(x), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            names, size = self.names[level], 1 << level
            rows = np.arange(len(x))
            while len(rows):
                a = x[rows] - done[rows] - size if back else x[rows] + done[rows]
                b = a + (y[rows] - x[rows])
                inside = (a >= 0) & (b < len(names))
                rows, a, b = rows[inside], a[inside], b[inside]
                rows = rows[names[a] == names[b]]
                done[rows] += size
                if level < len(self.names) - 1:
                    break  # only the longest stretch may fit more than once
        return done

    def _extend(self, x: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the longest stretch of that period around x and x + period."""
        return x - self._reach(x, x + period, True), x + period + self._reach(x, x + period, False)

    def _keep(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        good = end - start >= np.maximum(LEAST, 2 * period)
        if good.any():
            self.found.append((start[good], end[good], period[good]))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """start, end and smallest period of all stretches found so far, by start and end."""
        if not self.found:
            empty = np.empty(0, np.int64)
            return empty, empty, empty
        start, end, period = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), bool)
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        self.found = [(start[first], end[first], period[first])]
        return self.found[0]

    def _scan_lags(self) -> None:
        words = self.words
        for lag in range(1, SHORTEST_WINDOW):
            n = self._prefix(max(LEAST, 2 * lag))
            equal = np.flatnonzero(words[: n - lag] == words[lag:n]) if n > lag else []
            if len(equal):
                breaks = np.flatnonzero(np.diff(equal) != 1)
                start = equal[np.concatenate([[0], breaks + 1])]
                end = equal[np.concatenate([breaks, [len(equal) - 1]])] + 1 + lag
                self._keep(start, end, np.full(len(start), lag))

    def _minimizers(self, scale: int) -> tuple[np.ndarray, np.ndarray]:
        """Places selected at a scale and the names of their next scale / 2 words, ordered."""
        half = scale // 2
        names = self._named(half.bit_length() - 1)[: self._prefix(2 * scale)]
        if len(names) <= half:
            return np.empty(0, np.int64), names
        values = (names.astype(np.uint64) + np.uint64(1)) * MIX
        # The greatest of the minima of all windows around a place is its own value if one
        # window selects it.
        opened = _slide(np.pad(_slide(values, half + 1, True), half, constant_values=0), half + 1, False)
        places = np.flatnonzero(opened == values)
        places = places[np.argsort(names[places], kind="stable")]
        return places, names[places]

    def _scan_scale(self, scale: int) -> None:
        places, names = self._minimizers(scale)
        if not len(places):
            return
        same = names[1:] == names[:-1]
        step = np.diff(places)
        linked = same & (4 * step <= scale)
        heads = np.flatnonzero(np.concatenate([[True], ~linked]))
        tails = np.concatenate([heads[1:] - 1, [len(places) - 1]])
        # A name with any chain is periodic; the step of one of its chains is a period.
        group = np.cumsum(np.concatenate([[0], ~same]))[heads]
        chain_step = np.zeros(int(group[-1]) + 1, np.int64)
        several = tails > heads
        chain_step[group[several]] = step[heads[several]]
        x, lag, chained = [], [], []
        for j in range(1, 8):
            first, second = heads[:-j], heads[j:]
            near = (group[:-j] == group[j:]) & (places[second] - places[tails[:-j]] < 2 * scale)
            if not near.any():
                break
            a, b = places[first[near]], places[second[near]]
            period = chain_step[group[:-j][near]]
            alone = period == 0
            x.append(a[alone])
            lag.append(b[alone] - a[alone])
            chained.append((a[~alone], b[~alone], period[~alone]))
        if not x:
            return
        for a, b, period in chained:
            for at, by in self._of_chains(scale, a, b, period):
                x.append(at)
                lag.append(by)
        at, period = np.concatenate(x), np.concatenate(lag)
        wanted = (period >= scale) & (period < 2 * scale)
        at, period = at[wanted], period[wanted]
        for k in range(0, len(at), 200_000):
            part, by = at[k : k + 200_000], period[k : k + 200_000]
            start, end = self._extend(part, by)
            self._keep(start, end, by)
        self.runs()

    def _of_chains(self, scale: int, x: np.ndarray, y: np.ndarray, step: np.ndarray) -> Iterator:
        """Candidate places and lags for pairs of chains that begin at x and y."""
        a, b = self._extend(x, step)
        c, e = self._extend(y, step)
        other = a != c
        a, b, c, e, x, y = (v[other] for v in (a, b, c, e, x, y))
        yield a, c - a
        yield b - 1, e - b
        touch = np.flatnonzero(b >= c)
        if not len(touch):
            return
        a, b, c, e, x, y = (v[touch] for v in (a, b, c, e, x, y))
        # Shorter periods are complete by now: the smallest one of [a, b) is known.
        start, end, period = self.runs()
        size = len(self.words) + 1
        at = np.searchsorted(start * size + end, a * size + b)
        d = period[at]
        fit = np.minimum(b - a, e - c)
        low = scale + (y - x - scale) % d
        many = np.maximum(0, (np.minimum(2 * scale - 1, fit) - low) // d + 1)
        row = np.repeat(np.arange(len(a)), many)
        lag = low[row] + ragged(np.zeros(len(many), np.int64), many) * d[row]
        # The first word of [a, b) that lies a lag before a word of [c, e).
        yield np.maximum(a[row], c[row] - lag), lag

    def find(self, least: int = 12) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """start, length and period of the runs of each text, by start, then period."""
        self._scan_lags()
        self.runs()
        longest = int(self.sizes.max()) if len(self.sizes) else 0
        while 1 << len(self.names) <= longest and len(self.names) <= self.top:
            self._named(len(self.names))
        scale = SHORTEST_WINDOW
        while 2 * scale <= longest:
            self._scan_scale(scale)
            scale *= 2
        start, end, period = self.runs()
        long = end - start >= least
        start, end, period = start[long], end[long], period[long]
        text = np.searchsorted(self.begins, start, "right") - 1
        order = np.lexsort((period, start, text))
        start, length, period, text = start[order], (end - start)[order], period[order], text[order]
        bounds = np.searchsorted(text, np.arange(len(self.sizes) + 1))
        found: list = [None] * len(self.sizes)
        for k, owner in enumerate(self.order.tolist()):
            a, b = bounds[k], bounds[k + 1]
            found[owner] = (start[a:b] - self.begins[k], length[a:b], period[a:b])
        return found


def kept_words(size: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Numbers of the words that no run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) == 0)


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 12
) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every document.

    ``runs``: array of start (word number), length and smallest period, by start, then
    period, of all maximal stretches of at least two periods and ``least`` words. The
    collapsed text is the words, one space apart, without those that a run holds after its
    first period. A text is taken whole, whatever its length. A null text counts as empty;
    empty texts have no words and no runs. Repeated rows and null ids give their own rows;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("body").to_pylist()
            for a, b in slices(texts, 4_000_000):
                # Words end at the six ASCII white-space characters and nowhere else.
                words = [t.split() for t in texts[a:b]]
                number = defaultdict(count().__next__)
                arrays = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words]
                columns: dict[str, list] = {"runs": [], "collapsed": []}
                ends, flat = [0], []
                for w, found in zip(words, RunFinder(arrays).find(least)):
                    ends.append(ends[-1] + len(found[0]))
                    flat.append(np.stack(found))
                    if len(found[0]):
                        w = [w[k] for k in kept_words(len(w), *found).tolist()]
                    columns["collapsed"].append(b" ".join(w))
                values = np.concatenate(flat, axis=1)
                runs = pa.StructArray.from_arrays(list(map(pa.array, values)), RUN.fieldNames())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                        pa.array(columns["collapsed"], pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).cast("binary").alias("body"))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])
    return rows.mapInArrow(run, schema)
