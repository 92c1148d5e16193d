"""How the word use of each source departs from other sources and from its language.

Which terms are common enough is found by iceberg prefix refinement: the documents of a
language that hold a term beginning with some bytes are counted for short prefixes first; a
prefix in too few documents is discarded with all terms that begin with it, and only those
below a kept prefix are counted at the next, twice as long one, until complete terms are
left. Texts are read once, by tasks that count their own documents, each term and each prefix
once per document; refinement works on these counts, which add up and are stored by level.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.pieces import ragged, slices
from ledgerspark.llm.text import whole_text
from ledgerspark.session import materialize, scratch_path

FIRST_PREFIX = 8
SCALE = 1_000_000_000

# Bytes of terms: ASCII letters, in lower case, and all bytes of other characters.
_TERM_BYTES = bytes(
    b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256)
)

COUNTED = T.StructType([
    T.StructField("level", T.IntegerType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),  # null for prefixes
    T.StructField("item", T.BinaryType()),
    T.StructField("n", T.LongType()),
    T.StructField("n_docs", T.LongType()),
])


def _width(level: int) -> int:
    """Bytes of the prefixes of a level; terms up to that length are complete there."""
    return FIRST_PREFIX << level


def _sums(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of the weights of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], *(np.add.reduceat(w[order], first) if len(first) else w[:0] for w in weights)


class _Counts:
    """Counts of terms per language and source, and of prefixes per language."""

    def __init__(self) -> None:
        self.terms: dict = defaultdict(count().__next__)
        self.groups: dict = defaultdict(count().__next__)
        self.langs: dict = defaultdict(count().__next__)
        self.used: list[tuple] = []  # group, term, occurrences, documents
        # Per level: numbers of prefixes, the prefix of each term, (language, prefix, documents)
        self.prefixes: list[tuple[dict, list, list]] = []
        self.size = 0

    def _own_prefixes(self, fresh: list[bytes]) -> None:
        """Prefixes of terms that were not seen before; -1 for terms that are no longer."""
        level = 0
        longest = max(map(len, fresh), default=0)
        while level < len(self.prefixes) or longest > _width(level):
            if level == len(self.prefixes):
                known = len(self.terms) - len(fresh)
                self.prefixes.append((defaultdict(count().__next__), [-1] * known, []))
            number, own, _ = self.prefixes[level]
            width = _width(level)
            own.extend([number[t[:width]] if len(t) > width else -1 for t in fresh])
            level += 1

    def add(self, langs: list, sources: list, bodies: list) -> None:
        words = [body.translate(_TERM_BYTES).split() for body in bodies]
        sizes = np.array([len(w) for w in words], np.int64)
        before, number = len(self.terms), self.terms
        ids = np.fromiter((number[w] for own in words for w in own), np.int64, int(sizes.sum()))
        del words
        self._own_prefixes(list(islice(number, before, None)))
        n_terms = max(1, len(number))
        held, n = np.unique(np.repeat(np.arange(len(sizes)), sizes) * n_terms + ids, return_counts=True)
        doc, term = held // n_terms, held % n_terms
        group = np.array([self.groups[g] for g in zip(langs, sources)], np.int64)
        lang = np.array([self.langs[x] for x in langs], np.int64)
        keys, total, n_docs = _sums(group[doc] * n_terms + term, n, np.ones(len(n), np.int64))
        self.used.append((keys // n_terms, keys % n_terms, total, n_docs))
        self.size += len(keys)
        for number, own, found in self.prefixes:
            prefix = np.array(own, np.int64)[term]
            rows = prefix >= 0
            # Once per document, whatever the number of its terms that begin so.
            once = np.unique(doc[rows] * len(number) + prefix[rows])
            at, which = lang[once // len(number)], once % len(number)
            keys, n_docs = _sums(at * len(number) + which, np.ones(len(once), np.int64))
            found.append((keys // len(number), keys % len(number), n_docs))

    def batches(self, rows: int = 200_000) -> Iterator[pa.RecordBatch]:
        """All counts, added up over what was added."""
        terms = list(self.terms)
        if terms:
            lengths = np.array([len(t) for t in terms], np.int64)
            levels = np.ceil(np.log2(np.maximum(lengths, FIRST_PREFIX) / FIRST_PREFIX)).astype(np.int32)
            group, term, n, n_docs = (np.concatenate(c) for c in zip(*self.used))
            keys, n, n_docs = _sums(group * len(terms) + term, n, n_docs)
            group, term = keys // len(terms), keys % len(terms)
            names = [pa.array([g[k] for g in self.groups], pa.string()) for k in (0, 1)]
            for a in range(0, len(keys), rows):
                part = slice(a, a + rows)
                own = pa.array(group[part])
                items = [terms[t] for t in term[part].tolist()]
                yield _batch(levels[term[part]], names[0].take(own), names[1].take(own), items, n[part], n_docs[part])
        names = pa.array(list(self.langs), pa.string())
        for level, (number, _, found) in enumerate(self.prefixes):
            spelt = list(number)
            lang, prefix, n_docs = (np.concatenate(c) for c in zip(*found))
            keys, n_docs = _sums(lang * len(spelt) + prefix, n_docs)
            for a in range(0, len(keys), rows):
                own, docs = keys[a : a + rows], n_docs[a : a + rows]
                items = [spelt[p] for p in (own % len(spelt)).tolist()]
                yield _batch(
                    np.full(len(own), level), names.take(pa.array(own // len(spelt))),
                    pa.nulls(len(own), pa.string()), items, np.zeros(len(own), np.int64), docs,
                )


def _batch(level, lang: pa.Array, source: pa.Array, items: list, n, n_docs) -> pa.RecordBatch:
    columns = [pa.array(level, pa.int32()), lang, source, pa.array(items, pa.binary()),
               pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, COUNTED.fieldNames())


# A task adds up so many terms, or rows of counts, before it passes them on.
MOST_TERMS, MOST_ROWS = 300_000, 1_500_000


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        langs, sources, bodies = (batch.column(c).to_pylist() for c in ("lang", "source", "body"))
        for a, b in slices(bodies, 8_000_000):
            counts.add(langs[a:b], sources[a:b], bodies[a:b])
            if len(counts.terms) >= MOST_TERMS or counts.size >= MOST_ROWS:
                yield from counts.batches()
                counts = _Counts()
    yield from counts.batches()


# The rows of a level go to a folder of their own, without a sort.
WRITERS, MOST_WRITERS = "spark.sql.maxConcurrentOutputFileWriters", 64


def _stored_by_level(counted: DataFrame) -> DataFrame:
    spark = counted.sparkSession
    path = scratch_path(spark, "term-counts")
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, str(MOST_WRITERS))
    try:
        counted.write.partitionBy("level").parquet(path)
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)
    return spark.read.schema(COUNTED).parquet(path)


def _refine(counted: DataFrame, min_docs: int) -> DataFrame:
    """lang, item, uses: terms in at least ``min_docs`` documents of the language.

    ``uses`` holds the number of occurrences per source, one entry for each that has the
    term. A term has one row per source and task that counted it, as tasks add up their own;
    one exchange by term serves the sums per source and per term.
    """
    kept: DataFrame | None = None
    above: DataFrame | None = None
    for level in sorted(r["level"] for r in counted.select("level").distinct().collect()):
        rows = counted.where(F.col("level") == level)
        if above is not None:
            parent = F.substring("item", 1, _width(level - 1))
            rows = rows.withColumn("parent", parent).join(above, ["lang", "parent"], "left_semi")
        common = materialize(
            rows.repartition("lang", "item")
            .groupBy("lang", "item", "source")
            .agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
            .groupBy("lang", "item", F.col("source").isNotNull().alias("complete"))
            .agg(F.sum("n_docs").alias("n_docs"), F.collect_list(F.struct("source", "n")).alias("uses"))
            .where(F.col("n_docs") >= min_docs)
            .drop("n_docs"),
            "prefixes",
        )
        terms = common.where("complete").select("lang", "item", "uses")
        kept = terms if kept is None else kept.unionByName(terms)
        above = common.where("NOT complete").select("lang", F.col("item").alias("parent"))
        if above.isEmpty():
            break
    if kept is None:
        return counted.select("lang", "item", F.array(F.struct("source", "n")).alias("uses")).limit(0)
    return kept


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact; null without terms."""
    return F.lit(1) + F.call_function(
        "div",
        (n + 1).cast("decimal(19,0)") * F.lit(SCALE),
        F.when(terms > 0, total + terms).cast("decimal(29,0)"),
    )


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same of arrays; ``total`` is that of the words and the terms."""
    if len(n) and n.max() > 9_000_000_000:
        exact = (n.astype(object) + 1) * SCALE // total.astype(object)
        return exact.astype(np.int64) + 1
    return (n + 1) * SCALE // total + 1


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


COMPARED = "lang string, source string, part string, item binary, value bigint, m bigint"


def _compare(groups: dict[tuple[str, str], tuple[int, int, int]], langs: dict[str, int]):
    """Rows of parts ``term``, ``both`` and ``spread`` from terms and their uses.

    ``groups``: (lang, source) -> words, terms, share of a term it lacks; ``langs``: words.
    """
    numbers = {g: k for k, g in enumerate(groups)}
    names = list(groups)
    size = np.array([n + v for n, v, _ in groups.values()], np.int64)
    none = np.array([p0 or 1 for _, _, p0 in groups.values()], np.int64)
    lang_size = np.array([langs[lang] + v for (lang, _), (_, v, _) in groups.items()], np.int64)
    lang_names, source_names = (pa.array([g[k] for g in names], pa.string()) for k in (0, 1))

    def batch(group: np.ndarray, part: str, items: pa.Array, value: np.ndarray, m: np.ndarray | None):
        own = pa.array(group)
        columns = [
            lang_names.take(own), source_names.take(own), pa.array([part] * len(group), pa.string()), items,
            pa.array(value, pa.int64()), pa.nulls(len(group), pa.int64()) if m is None else pa.array(m, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "part", "item", "value", "m"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            uses = rows.column("uses")
            ends = uses.offsets.to_numpy().astype(np.int64) - uses.offsets[0].as_py()
            many = np.diff(ends)
            term = np.repeat(np.arange(len(many)), many)
            entries = uses.flatten()
            of = list(zip(rows.column("lang").take(pa.array(term)).to_pylist(), entries.field("source").to_pylist()))
            group = np.fromiter(map(numbers.__getitem__, of), np.int64, len(of))
            n = entries.field("n").to_numpy()
            p = _shares(n, size[group])
            q = _shares(np.add.reduceat(n, ends[:-1]), lang_size[group[ends[:-1]]])[term]
            above = np.flatnonzero(p > q)
            items = rows.column("item").take(pa.array(term[above]))
            yield batch(group[above], "term", items, _gaps(p[above], q[above]), None)
            keys, m = _sums(group << 31 | p, np.ones(len(p), np.int64))
            yield batch(keys >> 31, "spread", pa.nulls(len(keys), pa.binary()), keys & ((1 << 31) - 1), m)
            # Pairs of sources that both have a term, added up over the terms of the batch.
            begin = 0
            work = np.cumsum(many * many)
            while begin < len(many):
                done = work[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(work, done + 4_000_000, "right")))
                own = np.arange(ends[begin], ends[end])
                width = many[term[own]]
                x = np.repeat(own, width)
                y = ragged(ends[:-1][term[own]], width)
                x, y = x[x != y], y[x != y]
                value = _gaps(p[x], p[y]) - _gaps(p[x], none[group[y]]) - _gaps(none[group[x]], p[y]) + _gaps(none[group[x]], none[group[y]])
                keys, value = _sums(group[x] * len(names) + group[y], value)
                other = source_names.take(pa.array(keys % len(names))).cast(pa.binary())
                yield batch(keys // len(names), "both", other, value, None)
                begin = end

    return run


def _gap(p: str, q: str) -> str:
    """floor((p - q)^2 / q) of two columns; shares are at most SCALE + 1."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def source_divergence(
    docs: DataFrame,
    min_docs: int = 3,
    top: int = 200,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """lang, source, part, item, value, rank for every language and source that occur.

    Terms are stretches of ASCII letters and characters beyond ASCII, in lower case as far
    as A-Z go; a language keeps those in ``min_docs`` of its documents (rows). A group's
    share of a term is 1 + floor(10^9 (n + 1) / (N + V)), N its kept words and V the kept terms, and a departure of share p from q
    is floor((p - q)^2 / q). Part ``pair``: the sum over all kept terms against each other
    source of the language, 0 without kept terms. Part ``term``: kept terms the source has
    and uses more than its language, the first ``top``. Ranks go by value, then by item.
    Null lang, source and text count as empty; a group without terms has its pairs; repeated
    rows count each; other columns are ignored; an empty table gives an empty result.

    The sum over all terms needs no row for a term that neither source has, and for terms of
    one source only the numbers of its terms per share; terms of both are compared where the
    refinement left them, one row per term with its sources, and added up per task. The
    result holds every pair of sources of a language, so the groups are few next to it; their
    totals are what the driver sees and passes on.
    """
    spark = docs.sparkSession
    rows = docs.select(
        whole_text(lang).alias("lang"), whole_text(source).alias("source"), whole_text(text).cast("binary").alias("body")
    )
    kept = _refine(_stored_by_level(rows.mapInArrow(_count, COUNTED)), min_docs)
    used = kept.select("lang", F.explode("uses").alias("use")).groupBy("lang", F.col("use.source").alias("source"))
    totals = used.agg(F.sum("use.n").alias("total"), F.count(F.lit(1)).alias("n_terms"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_kept"))
    groups = materialize(
        rows.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(terms, "lang", "left")
        .fillna(0, ["total", "n_terms", "n_kept"])
        .withColumn("none", _share(F.lit(0), F.col("total"), F.col("n_kept"))),
        "groups",
    )
    known = {(r["lang"], r["source"]): (r["total"], r["n_kept"], r["none"]) for r in groups.collect()}
    words: dict[str, int] = defaultdict(int)
    for (name, _), (total, _, _) in known.items():
        words[name] += total
    shared = spark.sparkContext.broadcast((known, dict(words)))
    compared = materialize(
        kept.select("lang", "item", "uses").mapInArrow(
            lambda batches: _compare(*shared.value)(batches), COMPARED
        ),
        "compared",
    )

    x = groups.selectExpr("lang", "source", "none AS p0", "n_kept", "n_terms AS p_terms")
    y = groups.selectExpr("lang", "CAST(source AS binary) AS item", "source AS other", "none AS q0", "n_terms AS q_terms")
    pairs = materialize(x.join(y, "lang").where("source <> other"), "pairs")
    spread = materialize(
        compared.where("part = 'spread'").groupBy("lang", "source", F.col("value").alias("p")).agg(F.sum("m").alias("m")),
        "spread",
    )
    big = "CAST({} AS decimal(38,0)) AS value".format
    parts = [
        pairs.selectExpr("lang", "source", "item", big(f"(n_kept - p_terms - q_terms) * {_gap('p0', 'q0')}")),
        spread.join(pairs, ["lang", "source"]).selectExpr("lang", "source", "item", big(f"m * {_gap('p', 'q0')}")),
        spread.selectExpr("lang", "source AS other", "p AS q", "m")
        .join(pairs, ["lang", "other"])
        .selectExpr("lang", "source", "item", big(f"m * {_gap('p0', 'q')}")),
        compared.where("part = 'both'").selectExpr("lang", "source", "item", big("value")),
    ]
    joined = reduce(DataFrame.unionByName, parts)
    against = joined.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).selectExpr(
        "lang", "source", "'pair' AS part", "item", "CAST(coalesce(value, 0) AS bigint) AS value"
    )
    departures = compared.where("part = 'term'").select("lang", "source", "part", "item", "value")

    def ranked(rows: DataFrame, limit: int | None) -> DataFrame:
        place = "row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank"
        found = rows.selectExpr("*", place)
        return found if limit is None else found.where(F.col("rank") <= limit)

    return (
        ranked(against, None)
        .unionByName(ranked(departures, top))
        .withColumn("item", F.col("item").cast("string"))
    )
