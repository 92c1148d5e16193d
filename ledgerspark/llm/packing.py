"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Only sizes matter for the packing, and there are no more sizes than the capacity: a
histogram, whatever the number of documents, is enough to plan it. Pieces above a third of
the capacity go at most two to a sequence, so they are matched: the largest with the
largest that still fits. Smaller pieces then go, largest first, where they leave the
smallest gap. The plan names, for each size, ranges of ranks and the sequences they go to;
a piece finds its place from its size and its rank among the pieces of that size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.pieces import encoder, slices
from ledgerspark.llm.text import whole_text
from ledgerspark.session import materialize


@dataclass
class Plan:
    """Placements: pieces ``rank ... rank + n - 1`` of a size go ``each`` to a sequence,
    from ``sequence`` on, at ``offset``. Ordered by size and rank."""

    sequences: int = 0
    size: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)

    def arrays(self) -> dict[str, np.ndarray]:
        columns = {
            name: np.array(getattr(self, name), np.int64)
            for name in ("size", "rank", "each", "sequence", "offset")
        }
        order = np.lexsort((columns["rank"], columns["size"]))
        return {name: values[order] for name, values in columns.items()}


def plan_packing(histogram: dict[int, int], capacity: int) -> Plan:
    """A plan for so many pieces of each size (1 to capacity).

    Sequences that look alike are one range, and a step fills or splits a range, so the
    work depends on the capacity and not on the number of pieces.
    """
    plan = Plan()
    left = {s: n for s, n in histogram.items() if n > 0}
    placed = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first sequence, how many)

    def put(size: int, count: int, each: int, sequence: int, offset: int) -> None:
        plan.size.append(size)
        plan.rank.append(placed[size])
        plan.each.append(each)
        plan.sequence.append(sequence)
        plan.offset.append(offset)
        placed[size] += count
        left[size] -= count

    def leave(gap: int, sequence: int, count: int) -> None:
        if gap and count:
            gaps.setdefault(gap, []).append((sequence, count))

    def open_range(count: int) -> int:
        plan.sequences += count
        return plan.sequences - count

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for s in large:
        while left[s]:
            mates = [t for t in large if left[t] and s + t <= capacity]
            t = mates[0] if mates else None
            if t == s and left[s] < 2:
                t = next((m for m in mates if m != s), None)
            if t is None:
                n = left[s]
                first = open_range(n)
                put(s, n, 1, first, 0)
                leave(capacity - s, first, n)
            elif t == s:
                n = left[s] // 2
                first = open_range(n)
                put(s, 2 * n, 2, first, 0)
                leave(capacity - 2 * s, first, n)
            else:
                n = min(left[s], left[t])
                first = open_range(n)
                put(s, n, 1, first, 0)
                put(t, n, 1, first, s)
                leave(capacity - s - t, first, n)

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= s):
            if not left[s]:
                break
            each = gap // s
            ranges = gaps.pop(gap)
            while ranges and left[s]:
                first, count = ranges.pop()
                full = min(count, left[s] // each)
                if full:
                    put(s, full * each, each, first, capacity - gap)
                    leave(gap - each * s, first, full)
                rest = left[s] if full < count else 0
                if rest:  # fewer than a sequence takes
                    put(s, rest, rest, first + full, capacity - gap)
                    leave(gap - rest * s, first + full, 1)
                    full += 1
                if full < count:
                    ranges.append((first + full, count - full))
            for first, count in ranges:
                leave(gap, first, count)
        if left[s]:
            each = capacity // s
            n = left[s] // each
            if n:
                first = open_range(n)
                put(s, n * each, each, first, 0)
                leave(capacity - each * s, first, n)
            if left[s]:
                rest = left[s]
                first = open_range(1)
                put(s, rest, rest, first, 0)
                leave(capacity - rest * s, first, 1)
    return plan


def encode_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, on demand, ids.

    A document is its ids and ``end_id``; one longer than the capacity is cut into pieces
    of that length, of which the first is the shorter one. A null text counts as empty and
    still has its end. Repeated rows and null ids give their own pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            texts = batch.column("body").to_pylist()
            for a, b in slices(texts):
                flat, counts = coder.encode(texts[a:b])
                rows: dict[str, list] = {c: [] for c in ("at", "piece", "start", "length", "crc", "ids")}
                begin = 0
                for k, count in enumerate(counts.tolist()):
                    ids = np.append(flat[begin : begin + count], end_id).astype("<u4")
                    begin += count
                    n = count + 1
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                    for p, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        rows["at"].append(k)
                        rows["piece"].append(p)
                        rows["start"].append(x)
                        rows["length"].append(y - x)
                        rows["crc"].append(zlib.crc32(ids[x:y].tobytes()))
                        if keep_ids:
                            rows["ids"].append(ids[x:y].astype(np.int32))
                columns = [
                    batch.column("doc_id").slice(a, b - a).take(pa.array(rows["at"], pa.int64())),
                    pa.array(rows["piece"], pa.int32()),
                    *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "crc")),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(rows["ids"], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the pieces of each size within the task."""
    seen: dict[int, int] = {}
    task = TaskContext.get().partitionId()
    for batch in batches:
        places = []
        for n in batch.column("length").to_pylist():
            places.append(seen.get(n, 0))
            seen[n] = places[-1] + 1
        columns = [batch.column("piece"), batch.column("length")]
        columns += [pa.array([task] * len(places), pa.int32()), pa.array(places, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "length", "task", "place"])


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to pieces that have a ``length`` of 1 to capacity.

    Ranks within a size come from the counts of each task and size, so that no size, however
    common, is brought to one place. The histogram and the plan, bounded by the capacity,
    are all that passes the driver. Further columns are carried along whatever their names,
    but for those called sequence_id or offset, which the result replaces. An empty table
    gives an empty result.
    """
    spark = pieces.sparkSession
    carried = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    rows = pieces.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("piece"),
        F.col("length").cast("bigint").alias("length"),
    )
    schema = T.StructType([*rows.schema.fields]).add("task", T.IntegerType()).add("place", T.LongType())
    # Stored, as a task may number its pieces in another order when it runs again.
    stored = materialize(rows.mapInArrow(_number, schema), "pieces")
    counts = stored.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(not 1 <= s <= capacity for s in histogram):
        raise ValueError(f"Lengths must be 1 to {capacity}.")
    shared = spark.sparkContext.broadcast(plan_packing(histogram, capacity).arrays())
    offsets = counts.selectExpr(
        "task", "length",
        "sum(n) OVER (PARTITION BY length ORDER BY task ROWS UNBOUNDED PRECEDING) - n AS before",
    )
    ranked = stored.join(offsets, ["task", "length"]).select(
        "piece", "length", (F.col("before") + F.col("place")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        first = np.searchsorted(plan["size"], np.arange(capacity + 2))
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(size), np.int64)
            for s in np.unique(size):
                own = size == s
                a, b = first[s], first[s + 1]
                at[own] = a + np.searchsorted(plan["rank"][a:b], rank[own], "right") - 1
            nth = rank - plan["rank"][at]
            each = plan["each"][at]
            columns = [
                batch.column("piece"),
                pa.array(plan["sequence"][at] + nth // each),
                pa.array(plan["offset"][at] + nth % each * size),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "sequence_id", "offset"])

    schema = T.StructType([rows.schema["piece"]]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    return ranked.mapInArrow(place, schema).select("piece.*", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """:func:`encode_pieces`, then :func:`pack`: each piece with its place in a sequence.

    Nulls, empty and long texts as there; columns of ``docs`` other than the two named are
    ignored.
    """
    return pack(encode_pieces(docs, tokenizer, capacity, end_id, doc_id, text, keep_ids), capacity)
