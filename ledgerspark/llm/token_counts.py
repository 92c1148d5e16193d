"""Token counts through a cache of digests.

A text is known by the digest of its normalised content, a tokenizer by the digest of its
vocabulary. Texts are looked up in the cache under both; only distinct misses are encoded,
and their counts are appended for the next run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib import metadata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark import fs
from ledgerspark.llm.text import one_spaced, whole_text
from ledgerspark.operators.quality import own_exchange

COUNT_SCHEMA = "digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library's version."""
    digest = hashlib.sha256(metadata.version("tokenizers").encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


def content_digest(text: str) -> Column:
    """Digest of the text with each run of ASCII white space as one space.

    The tokenizer drops white space and never joins what it separates, so that texts with
    this digest in common have the same count.
    """
    return F.unhex(F.sha2(one_spaced(whole_text(text)), 256))


class WordCounter:
    """Counts per word; words at ASCII white space are encoded independently of each other."""

    def __init__(self, path: str, max_words: int = 1_000_000) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_words = max_words
        self.known: dict[bytes, int] = {}

    def count(self, texts: list[bytes]) -> list[int]:
        if len(self.known) > self.max_words:
            self.known.clear()
        known = self.known
        split = [text.split() for text in texts]  # bytes split at ASCII white space only
        new = list(set().union(*split).difference(known))
        encoded = self.tokenizer.encode_batch_fast(
            [w.decode() for w in new], add_special_tokens=False
        )
        known.update(zip(new, [len(e.ids) for e in encoded]))
        return [sum(map(known.__getitem__, words)) for words in split]


_COUNTERS: dict[str, WordCounter] = {}


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerspark.llm.pieces import slices

        counter = _COUNTERS.setdefault(path, WordCounter(path))
        for batch in batches:
            texts = batch.column("norm").cast(pa.binary()).to_pylist()
            counts = [n for a, b in slices(texts) for n in counter.count(texts[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return run


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 2048,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; appends to the cache folder.

    ``tokenizer`` is a file of the tokenizers library that drops white space (words are
    encoded apart), ``cache`` a folder that all executors share; it need not exist. No
    special tokens are added; strings of special tokens within a text are treated as the
    library does by default. A null text counts as empty: no bytes, no tokens. Repeated rows
    and null ids give a row each; further columns are ignored; an empty table gives an
    empty result. Runs that append the same texts at the same time do no harm.
    """
    spark = docs.sparkSession
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_version(tokenizer)}"
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        content_digest(text).alias("digest"),
        F.octet_length(whole_text(text)).cast("bigint").alias("n_bytes"),
    )
    # One text per digest, chosen on the map side first. The result lies by digest, so that
    # the texts are not shuffled again to be compared with the cache.
    distinct = (
        docs.select(content_digest(text).alias("digest"), one_spaced(whole_text(text)).alias("norm"))
        .groupBy("digest")
        .agg(F.first("norm").alias("norm"))
    )
    if fs.exists(spark, folder):
        stored = spark.read.schema(COUNT_SCHEMA).parquet(folder)
        distinct = distinct.join(stored.select("digest"), "digest", "left_anti")
    distinct.mapInArrow(_encode(tokenizer), COUNT_SCHEMA).write.mode("append").parquet(folder)
    stored = spark.read.schema(COUNT_SCHEMA).parquet(folder)
    counts = stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    # An exchange of its own lets adaptive execution split a content that many rows share.
    return rows.join(own_exchange(counts), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
