"""Exact Jaccard self-join on word n-grams with adaptive multi-match prefixes.

Two sets that reach the threshold share at least ``l`` tokens among the first
``n - t + l`` of each in any common order, where ``t`` is the least overlap that a set of
``n`` needs. A longer prefix thus asks for more matches, and pairs that share a passage by
chance are not candidates. This is used twice, both times without loss:

1. Over all documents, in the order of the tokens' hashes. Tokens are counted in chunks of
   documents first, so that a token costs at most one row per chunk, however common it is.
   Documents without enough shared tokens in their prefix have no partner and end here.
2. Over the rest, in the order of frequency. Now tokens of one document only are known:
   they bound a pair's overlap before it is formed. Each document takes the length ``l``
   whose estimated cost (rows to scan, candidates to verify) is least; a pair must share
   the smaller of both ``l``.

Groups of near copies are first tied to one hub per token, which gives as many pairs as rows;
after that only pairs of different components are formed. For tokens of many sets, signatures
bound how many tokens only one set of a pair has, so pairs that are too far apart are not formed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.components import components
from ledgerspark.llm.pieces import ragged, slices
from ledgerspark.llm.text import whole_text
from ledgerspark.operators.quality import own_exchange
from ledgerspark.session import materialize

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finish)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    """A random-looking number for each byte; those of A-Z are those of a-z."""
    values = _mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
    values[65:91] = values[97:123]
    return values


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, MULTIPLIER, np.uint64)
    out[0] = 1
    return np.cumprod(out)


@lru_cache(1)
def _inverse() -> np.uint64:
    return U64(pow(int(MULTIPLIER), -1, 1 << 64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts in order, and the number of words of each.

    A word's hash is a polynomial in its bytes, taken as a difference of prefix sums.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    begin, end = edges[0::2], edges[1::2]
    powers = _powers(len(data))
    sums = np.concatenate([[U64(0)], np.cumsum(_byte_values()[data] * powers[:-1])])
    inverse = np.cumprod(np.concatenate([[U64(1)], np.full(len(data), _inverse(), np.uint64)]))
    hashes = _mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    lengths = np.array([len(t) + 1 for t in texts])
    bounds = np.searchsorted(begin, np.concatenate([[0], np.cumsum(lengths)]))
    return hashes, np.diff(bounds)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, as signed 64-bit numbers.

    A text of fewer words has its whole sequence as its only shingle.
    """
    hashes, counts = word_hashes(texts)
    rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        rolled = _mix(rolled * U64(31) + hashes[k : k + len(rolled)])
    out, at = [], 0
    for count in counts.tolist():
        if count >= words:
            found = np.unique(rolled[at : at + count - words + 1].view(np.int64))
        elif count:
            value = np.full(1, count, np.uint64)
            for h in hashes[at : at + count]:
                value = _mix(value * U64(31) + h)
            found = value.view(np.int64)
        else:
            found = np.zeros(0, np.int64)
        out.append(found)
        at += count
    return out


def least_overlap(n: int, percent: int) -> int:
    """Tokens that a set of n must share with any partner: the union has n at least."""
    return -(-percent * n // 100)


def first_length(n: int, percent: int, share: int) -> tuple[int, int]:
    """(prefix length, least ``l`` of any partner) of the first pass; ``share`` in percent.

    A set takes l = 1 + share * n; its smallest partner has ``least_overlap`` tokens, and
    so the l that the pair has in common is known from n alone.
    """
    t = least_overlap(n, percent)
    return min(n, n - t + 1 + share * n // 100), min(1 + share * t // 100, t)


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _first_pass(words: int, percent: int, share: int):
    """Per document: id, content hash, key of its set, size, shared tokens found within the
    chunk, matches needed, and the tokens of the chunk that it is the one to report."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("body").cast(pa.binary()).to_pylist()
            for a, b in slices(texts, 1_000_000):
                sets = shingle_sets(texts[a:b], words)
                keys = [_key(s) for s in sets]
                first = {}
                for k, key in enumerate(keys):
                    first.setdefault(key, k)  # equal sets of a chunk count once
                spans = [first_length(len(s), percent, share) for s in sets]
                own = [
                    s[:n] if first[key] == k else s[:0]
                    for k, (s, (n, _), key) in enumerate(zip(sets, spans, keys))
                ]
                owner = np.repeat(np.arange(len(own)), [len(x) for x in own])
                tokens = np.concatenate([*own, np.zeros(0, np.int64)])
                order = np.argsort(tokens, kind="stable")
                tokens, owner = tokens[order], owner[order]
                new = np.ones(len(tokens), bool)
                new[1:] = tokens[1:] != tokens[:-1]
                twin = ~new
                twin[:-1] |= ~new[1:]
                hits = np.bincount(owner[twin], minlength=len(own))
                # One row per token and chunk; a token of several documents has no owner to
                # credit, as they have their hit already.
                report = [[] for _ in own]
                shared = [[] for _ in own]
                for lists, mask in ((report, new & ~twin), (shared, new & twin)):
                    held = owner[mask]
                    by = np.argsort(held, kind="stable")
                    held, values = held[by], tokens[mask][by]
                    at = np.searchsorted(held, np.arange(len(own) + 1))
                    for k in np.unique(held).tolist():
                        lists[k] = values[at[k] : at[k + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("content").slice(a, b - a),
                        pa.array(keys, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(hits, pa.int32()),
                        pa.array([need for _, need in spans], pa.int32()),
                        pa.array(report, pa.list_(pa.int64())),
                        pa.array(shared, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "content", "key", "n", "hits", "need", "alone", "shared"],
                )

    return run


def _sets_of(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("body").cast(pa.binary()).to_pylist()
            for a, b in slices(texts, 1_000_000):
                sets = shingle_sets(texts[a:b], words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_key(s) for s in sets], pa.binary()),
                        pa.array(sets, pa.list_(pa.int64())),
                    ],
                    ["key", "tokens"],
                )

    return run


def _prefixes(percent: int, longest: int = 8):
    """Choose ``l`` per document and give its prefix, from tokens in order of frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranked = batch.column("ranked")
            items = ranked.flatten()  # tokens of all sets, one after the other
            counts = items.field("df").to_numpy()
            ends = ranked.offsets.to_numpy() - ranked.offsets[0].as_py()
            sizes = batch.column("n").to_numpy()
            chosen, taken = np.empty(len(sizes), np.int32), np.empty(len(sizes), np.int64)
            for row, (size, begin, end) in enumerate(zip(sizes.tolist(), ends[:-1].tolist(), ends[1:].tolist())):
                held = end - begin
                # The other tokens are of this document only, and first in order.
                shortest = size - least_overlap(size, percent) - (size - held) + 1
                lengths = np.arange(shortest, min(held, shortest + longest - 1) + 1)
                part = counts[begin : begin + lengths[-1]]
                scan = np.cumsum(part)[lengths - 1]
                most = np.maximum.accumulate(part)[lengths - 1]
                # Partners that share l of the tokens: at most the rows divided by l;
                # in a group of near copies, all those of the most frequent one.
                partners = np.minimum(scan / np.arange(1, len(lengths) + 1), most)
                best = int(np.argmin(scan + partners * size / 8))
                chosen[row], taken[row] = best + 1, lengths[best]
            at = pa.array(ragged(ends[:-1].astype(np.int64), taken))
            starts = np.concatenate([[0], np.cumsum(taken)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("n"),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array(chosen),
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), items.field("token").take(at)),
                ],
                ["node", "n", "m", "l", "prefix"],
            )

    return run


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two sets may reach the threshold, from sizes and tokens that are not alone."""
    most = F.least(f"{a}.m", f"{b}.m")
    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    return (100 + percent) * most >= percent * total


def _reachable(a: str, b: str, percent: int) -> Column:
    """Whether a pair that shares a token at these places may reach the threshold.

    Both sets are in one order, so at most the smaller place has been shared before the
    token, and at most the shorter rest can be shared after it.
    """
    before = F.least(f"{a}.place", f"{b}.place")
    after = F.least(F.col(f"{a}.m") - F.col(f"{a}.place"), F.col(f"{b}.m") - F.col(f"{b}.place"))
    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    return (100 + percent) * (before + after) >= percent * total


# A set's signature: for each of so many bits, whether an odd number of its tokens fall on it.
SIGNATURE_BITS = 512
SIGNATURE = [f"s{k}" for k in range(SIGNATURE_BITS // 64)]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and the signature of its tokens."""
    for batch in batches:
        for begin in range(0, len(batch), 2_000):
            part = batch.slice(begin, 2_000)
            tokens = part.column("tokens")
            sizes = np.diff(tokens.offsets.to_numpy())
            bits = tokens.flatten().to_numpy() & (SIGNATURE_BITS - 1)
            owner = np.repeat(np.arange(len(part)), sizes)
            odd = np.bincount(owner * SIGNATURE_BITS + bits, minlength=len(part) * SIGNATURE_BITS) & 1
            words = np.packbits(odd.astype(np.uint8).reshape(len(part), SIGNATURE_BITS), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), *[pa.array(words[:, k].copy()) for k in range(len(SIGNATURE))]],
                ["node", *SIGNATURE],
            )


def _close(a: str, b: str, percent: int) -> Column:
    """Whether a pair may reach the threshold by its signatures; without one, it may.

    Each bit that differs stands for a token that only one of the sets has, and so does each
    token that is in no other set.
    """
    differ = reduce(add, [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SIGNATURE])
    alone = F.col(f"{a}.n") - F.col(f"{a}.m") + F.col(f"{b}.n") - F.col(f"{b}.m")
    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    return F.coalesce((100 + percent) * (differ + alone) <= (100 - percent) * total, F.lit(True))


def _signed_in_crowds(labelled: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add signatures to the rows of tokens of many sets, which would form most pairs."""
    crowded = (
        labelled.groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where((F.col("count") >= CROWD) & (F.col("low") != F.col("high")))
        .select("token", F.lit(True).alias("crowded"))
    )
    marked = labelled.join(own_exchange(crowded), "token", "left")
    kind = ", ".join(f"{c} bigint" for c in ("node", *SIGNATURE))
    signed = nodes.select("node", "tokens").mapInArrow(_signatures, kind)
    plain = marked.where("crowded IS NULL").drop("crowded")
    with_all = marked.where("crowded").drop("crowded").join(signed, "node")
    return materialize(plain.unionByName(with_all, allowMissingColumns=True), "signed-prefixes")


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    x = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    y = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(x, "a").join(y, "b")
    overlap = F.size(F.array_intersect("ta", "tb"))
    return both.where(100 * overlap >= percent * (F.col("na") + F.col("nb") - overlap)).select("a", "b")


def _candidate_nodes(docs: DataFrame, first: DataFrame, words: int, percent: int) -> DataFrame:
    """node, key, n, tokens (those in two sets or more), ranked: sets that may have a partner."""
    rows = first.select("row", F.explode("alone").alias("token")).unionByName(
        first.select(F.lit(None).cast("bigint").alias("row"), F.explode("shared").alias("token"))
    )
    # Tokens that no other chunk has, by the row that has them: a token of many chunks is
    # combined on the map side, and its rows never meet.
    lonely = (
        rows.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
        .where("n = 1 AND row IS NOT NULL")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("lonely"))
    )
    alive = (
        first.where("n > 0")
        .select("row", "key", "need", (F.col("hits") + F.size("alone")).alias("found"))
        .join(lonely, "row", "left")
        .where("found - coalesce(lonely, 0) >= need")
        .select("key")
        .distinct()
    )
    # One document stands for each set; the content tells apart rows without an id.
    stand_in = (
        first.where("n > 0")
        .groupBy("key")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("least"))
        .join(alive, "key", "left_semi")
        .select("key", "least.doc_id", "least.content")
    )
    texts = docs.alias("d").join(
        stand_in.alias("s"),
        F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.content") == F.col("s.content")),
        "left_semi",
    )
    found = texts.select("body").mapInArrow(_sets_of(words), "key binary, tokens array<bigint>")
    sets = materialize(
        found.groupBy("key")
        .agg(F.first("tokens").alias("tokens"))
        .select(F.monotonically_increasing_id().alias("node"), "key", F.size("tokens").cast("bigint").alias("n"), "tokens"),
        "sets",
    )
    tokens = sets.select("node", F.explode("tokens").alias("token"))
    frequent = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (
        tokens.join(own_exchange(frequent), "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    )
    nodes = sets.select("node", "key", "n").join(ranked, "node")
    return materialize(
        nodes.where(100 * F.size("ranked") >= percent * F.col("n")).select(
            "node", "key", "n", "ranked", F.col("ranked.token").alias("tokens")
        ),
        "nodes",
    )


# Tokens of so many sets are looked at again while these are in several components.
CROWD = 16


def _tied_in_crowds(
    labelled: DataFrame, nodes: DataFrame, percent: int, rounds: int = 8
) -> DataFrame | None:
    """More pairs (a, b) that reach the threshold, among sets of frequent tokens; or None.

    Copies of a lost original may be like some of each other, and not like one hub. Each
    round takes another hub per crowded token and compares it with the sets of other
    components, one row per posting, so that components grow before pairs are formed; the
    pairs between those that are left are formed in full afterwards.
    """
    crowded = (
        labelled.groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where((F.col("count") >= CROWD) & (F.col("low") != F.col("high")))
        .select("token")
    )
    crowd = materialize(
        labelled.join(own_exchange(crowded), "token", "left_semi").select("token", "node", "n", "m", "root"),
        "crowd",
    )
    found: DataFrame | None = None
    for turn in range(rounds):
        drawn = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n", "m", "root")
        hubs = crowd.groupBy("token").agg(F.min(drawn).alias("hub")).select("token", "hub.*").drop("h")
        spokes = materialize(
            crowd.alias("p")
            .join(own_exchange(hubs).alias("h"), "token")
            .where((F.col("p.root") != F.col("h.root")) & _possible("p", "h", percent))
            .select(
                F.col("p.node").alias("a"), F.col("h.node").alias("b"),
                F.col("p.root").alias("root_a"), F.col("h.root").alias("root_b"),
            )
            .distinct(),
            "crowd-spokes",
        )
        reached = materialize(_verified(spokes.select("a", "b"), nodes, percent), "crowd-links")
        if reached.isEmpty():
            break
        found = reached if found is None else found.unionByName(reached)
        joined = reached.join(spokes, ["a", "b"]).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        merged = components(joined).select(F.col("node").alias("root"), F.col("root").alias("now"))
        crowd = materialize(
            crowd.join(merged, "root", "left").select(
                "token", "node", "n", "m", F.coalesce("now", "root").alias("root")
            ),
            "crowd",
        )
    return found


def _links(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that reach the threshold; not all of them, but enough to connect
    what the full set would connect."""
    # Sizes of partners differ by less than a bucket, so each set looks in two of them.
    if percent < 100:
        log_size = F.log(F.col("n").cast("double"))
        bucket = F.floor(log_size / F.lit(float(np.log(100 / percent)))).cast("bigint")
    else:
        bucket = F.col("n")
    posted = materialize(
        nodes.select("node", "n", "ranked")
        .mapInArrow(
            _prefixes(percent), "node bigint, n bigint, m bigint, l int, prefix array<bigint>"
        )
        .select(
            "node", "n", "m", "l",
            bucket.alias("bucket"),
            F.posexplode("prefix").alias("place", "token"),
        ),
        "prefixes",
    )
    # A hub per token: the set with the largest part of its tokens shared, as most near
    # copies are nearest to it.
    standing = F.struct((-F.col("m") / F.col("n")).alias("s"), "node", "n", "m")
    hubs = posted.groupBy("token").agg(F.min(standing).alias("hub"))
    spokes = (
        posted.alias("p")
        .join(own_exchange(hubs.select("token", "hub.node", "hub.n", "hub.m")).alias("h"), "token")
        .where((F.col("p.node") != F.col("h.node")) & _possible("p", "h", percent))
        .select(F.least("p.node", "h.node").alias("a"), F.greatest("p.node", "h.node").alias("b"))
        .distinct()
    )
    tied = materialize(_verified(spokes, nodes, percent), "spokes")

    def with_roots() -> DataFrame:
        roots = components(tied)
        rooted = posted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        return materialize(rooted, "labelled-prefixes")

    labelled = with_roots()
    more = _tied_in_crowds(labelled, nodes, percent)
    if more is not None:
        tied = materialize(tied.unionByName(more), "spokes")
        labelled = with_roots()
    labelled = _signed_in_crowds(labelled, nodes)
    here = labelled.withColumn("at", F.col("bucket"))
    near = labelled.select("*", F.explode(F.array("bucket", F.col("bucket") + 1)).alias("at"))
    order = (F.col("x.n") < F.col("y.n")) | (
        (F.col("x.n") == F.col("y.n")) & (F.col("x.node") < F.col("y.node"))
    )
    pairs = (
        near.alias("x")
        .join(here.alias("y"), ["token", "at"])
        .where((F.col("x.root") != F.col("y.root")) & order & _reachable("x", "y", percent) & _close("x", "y", percent))
        .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .agg(F.count(F.lit(1)).alias("matches"), F.least(F.first("x.l"), F.first("y.l")).alias("l"))
        .where("matches >= l")
        .select("a", "b")
    )
    rest = materialize(_verified(pairs, nodes, percent), "links")
    return tied.unionByName(rest)


def ngram_components(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    share: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, content, n_shingles, component_id, first for every row.

    Two documents link if ``100 * intersection >= percent * union`` of their sets of
    ``words``-word shingles (A-Z lower-cased, words at ASCII white space; fewer words are
    one shingle). ``component_id`` is the smallest id that links lead to. A document
    without words, or a null text, is linked with nothing and is its own component. Rows
    that repeat an id belong to the component of their text; a null id never is the smallest
    unless there is no other. ``content`` is a hash of the text, and ``first`` marks the one
    (id, content) that stands for its component (always true without words).
    Shingles are 64-bit hashes; sets of equal hashes are held to be equal by a 128-bit
    digest. ``share`` lengthens the prefixes of the first pass, in percent of a set.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole_text(text)).alias("content"),
        whole_text(text).alias("body"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    first = materialize(
        rows.mapInArrow(
            _first_pass(words, percent, share),
            f"doc_id {kind}, content bigint, key binary, n bigint, hits int, need int, "
            "alone array<bigint>, shared array<bigint>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "shingles",
    )
    nodes = _candidate_nodes(rows, first, words, percent)
    roots = components(_links(nodes, percent))
    rooted = nodes.select("node", "key").join(roots, "node", "left").select(
        "key", F.coalesce("root", "node").alias("root")
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content"))
    classes = first.where("n > 0").groupBy("key").agg(least.alias("least"))
    known = classes.join(rooted, "key", "left").withColumn(
        "group", F.coalesce(F.col("root").cast("string"), F.hex("key"))
    )
    of_group = known.groupBy("group").agg(F.min("least").alias("least"))
    labels = known.select("key", "group").join(of_group, "group").select("key", "least")
    labelled = first.select("doc_id", "content", "key", "n").join(labels, "key", "left")
    worded = F.col("n") > 0
    return labelled.select(
        "doc_id",
        "content",
        F.col("n").alias("n_shingles"),
        F.when(worded, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (
            ~worded
            | (
                F.col("least.doc_id").eqNullSafe(F.col("doc_id"))
                & (F.col("least.content") == F.col("content"))
            )
        ).alias("first"),
    )


def ngram_jaccard_join(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    share: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; see :func:`ngram_components`."""
    return ngram_components(docs, words, percent, share, doc_id, text).drop("content", "first")


def keep_one_of_each(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    share: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all columns.

    Rows without words stay. Rows that repeat id and text stay together.
    """
    found = ngram_components(docs, words, percent, share, doc_id, text)
    stay = materialize(
        found.where("first").select("doc_id", "content").distinct(), "representatives"
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole_text(text)).alias("content"),
    )
    same = F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.content") == F.col("s.content"))
    return rows.alias("r").join(stay.alias("s"), same, "left_semi").select("row.*")
