"""Token ids in files of patched frame-of-reference blocks, in document order.

A file holds the ids of consecutive documents, cut into blocks of ``BLOCK`` ids. A block
keeps its smallest id, the other ids as differences to it in a fixed number of bits, and
patches: the width is that of a percentile of the differences, and the high bits of the few
that need more stand in a list of exceptions. A footer names where each block begins and the
length and id of each document, so that a reader takes any range of documents by one range
read. Files are written by tasks through Arrow's file systems, under names of their own.

Layout, little-endian: MAGIC; blocks, each ``<IHBB`` (smallest id, exceptions, width, 0),
packed differences, exception places (u16), exception high bits (u32); footer: block starts
(u64, one more than blocks), Arrow stream of (doc_id, n_tokens); trailer ``<QQQQ``: footer
offset, number of blocks, ids, bytes of the Arrow stream; MAGIC.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.pieces import encoder, slices
from ledgerspark.llm.text import whole_text
from ledgerspark.llm.warc_zip import _filesystem
from ledgerspark.session import materialize

MAGIC = b"PFORIDS1"
BLOCK = 4096
HEAD, TRAILER = struct.Struct("<IHBB"), struct.Struct("<QQQQ")
END_BYTES = TRAILER.size + len(MAGIC)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs (0 for 0)."""
    return np.frexp(values.astype(np.float64))[1]


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of uint32 values below 2 ** width as rows of packed bytes."""
    kind = np.uint16 if width <= 16 else np.uint32
    bits = np.unpackbits(values.astype(kind).view(np.uint8), axis=1, bitorder="little")
    bits = bits.reshape(len(values), -1, kind(0).nbytes * 8)[:, :, :width]
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _unpack_bits(packed: np.ndarray, count: int, width: int) -> np.ndarray:
    """The ``count`` values of one packed row."""
    kind = np.uint16 if width <= 16 else np.uint32
    whole = np.zeros((count, kind(0).nbytes * 8), np.uint8)
    whole[:, :width] = np.unpackbits(packed, count=count * width, bitorder="little").reshape(count, width)
    return np.packbits(whole, axis=1, bitorder="little").view(kind).ravel().astype(np.uint32)


def encode_blocks(ids: np.ndarray, percentile: float = 0.95) -> list[bytes]:
    """One byte string per row of a (blocks, ids) array of uint32.

    The width holds the differences up to the percentile; larger ones are exceptions.
    """
    if not ids.size:
        return []
    least = ids.min(axis=1)
    above = ids - least[:, None]
    n = ids.shape[1]
    at = max(0, int(np.ceil(n * percentile)) - 1)
    widths = _bits(np.partition(above, at, axis=1)[:, at])
    blocks: list[bytes] = [b""] * len(ids)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        packed = _pack_bits(above[rows] & np.uint32((1 << width) - 1), width) if width else None
        high = above[rows] >> np.uint32(width) if width < 32 else np.zeros_like(above[rows])
        for k, row in enumerate(rows.tolist()):
            places = np.flatnonzero(high[k])
            blocks[row] = b"".join([
                HEAD.pack(int(least[row]), len(places), width, 0),
                packed[k].tobytes() if width else b"",
                places.astype("<u2").tobytes(),
                high[k][places].astype("<u4").tobytes(),
            ])
    return blocks


def decode_block(data: bytes, count: int) -> np.ndarray:
    """The ``count`` ids of one block."""
    least, exceptions, width, _ = HEAD.unpack_from(data)
    at = HEAD.size
    size = -(-count * width // 8)
    if width:
        values = _unpack_bits(np.frombuffer(data, np.uint8, size, at), count, width)
    else:
        values = np.zeros(count, np.uint32)
    if exceptions:
        at += size
        places = np.frombuffer(data, "<u2", exceptions, at)
        high = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
        values[places] |= high << np.uint32(width)
    return values + np.uint32(least)


class ShardWriter:
    """Writes one file; ids are kept only until they fill a block."""

    def __init__(self, stream, percentile: float = 0.95) -> None:
        self.stream, self.percentile = stream, percentile
        self.at, self.ids = 0, 0
        self.starts: list[int] = []
        self.keys: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.rest = np.empty(0, np.uint32)
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _blocks(self, ids: np.ndarray) -> None:
        for block in encode_blocks(ids, self.percentile):
            self.starts.append(self.at)
            self._write(block)

    def add(self, keys: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents that follow those added before: ids one after the other, and lengths."""
        self.keys.append(keys)
        self.lengths.append(lengths)
        self.ids += len(ids)
        ids = np.concatenate([self.rest, ids.astype(np.uint32)])
        whole = len(ids) - len(ids) % BLOCK
        for a in range(0, whole, 64 * BLOCK):
            self._blocks(ids[a : min(whole, a + 64 * BLOCK)].reshape(-1, BLOCK))
        self.rest = ids[whole:]

    def close(self) -> tuple[int, int]:
        """Write the last block and the footer; number of documents and of ids."""
        if len(self.rest):
            self._blocks(self.rest[None, :])
        footer = self.at
        self._write(np.array([*self.starts, footer], "<u8").tobytes())
        lengths = np.concatenate(self.lengths) if self.lengths else np.empty(0, np.int64)
        keys = pa.chunked_array(self.keys) if self.keys else pa.chunked_array([pa.array([], pa.null())])
        table = pa.table({"doc_id": keys, "n_tokens": pa.array(lengths, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        documents = sink.getvalue().to_pybytes()
        self._write(documents)
        self._write(TRAILER.pack(footer, len(self.starts), self.ids, len(documents)) + MAGIC)
        return len(lengths), self.ids


class ShardReader:
    """Reads a file by ranges: the trailer, the footer, then only the blocks asked for."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        trailer = file.read_at(END_BYTES, max(0, size - END_BYTES))
        if size < END_BYTES + len(MAGIC) or trailer[-len(MAGIC) :] != MAGIC:
            raise ValueError("Not a file of token ids.")
        footer, blocks, self.n_ids, length = TRAILER.unpack_from(trailer)
        data = file.read_at(size - END_BYTES - footer, footer)
        if len(data) != 8 * (blocks + 1) + length:
            raise ValueError("Damaged file of token ids.")
        self.starts = np.frombuffer(data, "<u8", blocks + 1).astype(np.int64)
        documents = pa.ipc.open_stream(pa.py_buffer(data[8 * (blocks + 1) :])).read_all()
        self.keys = documents.column("doc_id")
        self.ends = np.concatenate([[0], np.cumsum(documents.column("n_tokens").to_numpy())])

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the file, from the blocks that hold them."""
        if begin >= end:
            return np.empty(0, np.uint32)
        first, last = begin // BLOCK, -(-end // BLOCK)
        base = self.starts[first]
        data = self.file.read_at(int(self.starts[last] - base), int(base))
        parts = []
        for k in range(first, last):
            count = min(BLOCK, self.n_ids - k * BLOCK)
            parts.append(decode_block(data[self.starts[k] - base : self.starts[k + 1] - base], count))
        return np.concatenate(parts)[begin - first * BLOCK : end - first * BLOCK]

    def documents(self, first: int, last: int) -> Iterator[np.ndarray]:
        """Ids of each document from ``first`` up to ``last``."""
        begin = int(self.ends[first])
        ids = self.ids(begin, int(self.ends[last]))
        for k in range(first, last):
            yield ids[self.ends[k] - begin : self.ends[k + 1] - begin]


def write_token_ids(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_ids: int = 16_000_000,
    percentile: float = 0.95,
) -> DataFrame:
    """Write the ids of all documents; a stored table of the files.

    path, part, number, n_documents, n_ids and ``start``: the ids in all files before it.
    Documents are ordered by id (null first; rows of one id by a hash of their text) by
    range partitioning; rows of one id may share several tasks. A null text counts as empty
    and still has its end id. A task that runs again writes other files, and only those of
    attempts that succeeded are in the result. An empty table gives no file.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body")).withColumns(
        {"tie": F.xxhash64("body"), "row": F.monotonically_increasing_id()}
    )
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        filesystem, root = _filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        stream = writer = None
        name, number = "", 0

        def close() -> pa.RecordBatch:
            with stream:
                n_documents, n_ids = writer.close()
            row = [[f"{folder}/{name}"], [part], [number], [n_documents], [n_ids]]
            return pa.RecordBatch.from_arrays(list(map(pa.array, row)), columns)

        for batch in batches:
            texts = batch.column("body").to_pylist()
            for a, b in slices(texts, min(2_000_000, 2 * shard_ids)):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.ids"
                    stream = filesystem.open_output_stream(f"{root}/{name}")
                    writer = ShardWriter(stream, percentile)
                flat, lengths = coder.encode(texts[a:b])
                ids = np.insert(flat, np.cumsum(lengths), end_id)
                writer.add(batch.column("doc_id").slice(a, b - a), ids, lengths + 1)
                if writer.ids >= shard_ids:
                    yield close()
                    writer, number = None, number + 1
        if writer is not None:
            yield close()

    columns = ["path", "part", "number", "n_documents", "n_ids"]
    schema = "path string, part bigint, number bigint, n_documents bigint, n_ids bigint"
    written = materialize(ordered.mapInArrow(run, schema), "token-files")
    # One row per file of some ten million ids.
    return written.selectExpr(
        "*", "sum(n_ids) OVER (ORDER BY part, number ROWS UNBOUNDED PRECEDING) - n_ids AS start"
    )


def read_token_ids(
    files: DataFrame, id_type: str, split_ids: int = 4_000_000, keep_ids: bool = True
) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, on demand, ids of all documents in the files.

    ``files``: path, start, n_documents and n_ids as from :func:`write_token_ids`;
    ``id_type``: the type of doc_id. A file is read by as many tasks as its size asks for,
    each of which reads the blocks of its documents only. No file gives no document.
    """
    parts = F.greatest(F.lit(1), F.least("n_documents", F.ceil(F.col("n_ids") / split_ids)))
    ranges = files.select(
        "path", "start", "n_documents", F.explode(F.sequence(F.lit(0), parts - 1)).alias("k"), parts.alias("of")
    ).selectExpr("path", "start", "n_documents * k div of AS first", "n_documents * (k + 1) div of AS last")
    tasks = files.agg(F.sum(parts)).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                filesystem, name = _filesystem(path)
                with filesystem.open_input_file(name) as file:
                    reader = ShardReader(file)
                    for a in range(first, last, 2000):
                        b = min(last, a + 2000)
                        found = list(reader.documents(a, b))
                        columns = [
                            reader.keys.slice(a, b - a).combine_chunks().cast(key_type),
                            pa.array(start + reader.ends[a:b]),
                            pa.array(np.diff(reader.ends[a : b + 1])),
                            pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in found], pa.int64()),
                        ]
                        if keep_ids:
                            columns.append(pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([
        T.StructField("doc_id", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    key_type = pa.string()
    names = schema.fieldNames()
    read = ranges.repartition(int(min(tasks, 100_000))).mapInArrow(run, schema)
    return read.withColumn("doc_id", F.col("doc_id").cast(id_type))


def token_id_round_trip(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document as read back from the files.

    Nulls, empty and long texts and repeated ids as in :func:`write_token_ids`; other columns
    are ignored.
    """
    files = write_token_ids(docs, tokenizer, folder, end_id, doc_id, text)
    return read_token_ids(files, docs.schema[doc_id].dataType.simpleString(), keep_ids=False)
