"""Exact duplicates by skew-safe combining.

Three stages, each of which groups by the full normalised content and not only by its
digest: the map side of the first aggregate combines equal texts within a task, its reduce
side combines the rows of one salt, and the second aggregate combines the winners of all
salts. A group that holds a third of all rows is thus at most one row per task and salt
before it is shuffled, and at most ``salts`` rows before it meets in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.text import one_spaced, whole_text
from ledgerspark.session import materialize


def _content(text: str) -> list[Column]:
    norm = one_spaced(whole_text(text))
    return [norm.alias("norm"), F.unhex(F.sha2(norm, 256)).alias("digest")]


def winners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """One row per distinct content: digest, check, keep_id, group_size.

    ``check`` is a second hash of the content; the digest and it name the content where
    the text itself is no longer carried.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.pmod(F.xxhash64(doc_id), F.lit(salts)).cast("int").alias("salt"),
        *_content(text),
    )
    salted = rows.groupBy("digest", "salt", "norm").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    merged = salted.groupBy("digest", "norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
    )
    return merged.select("digest", F.xxhash64("norm").alias("check"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Texts are equal if they are identical after each run of ASCII white space became one
    space; a null text is an empty one. The row with the smallest id stays. Rows that
    repeat both id and text count in ``group_size`` and one of them stays. Null ids lose
    against all others; a group of null ids keeps one row and has a null ``keep_id``.
    Other columns are ignored; an empty table gives an empty result.
    """
    keyed = docs.select(F.col(doc_id).alias("id"), *_content(text)).select(
        "id", "digest", F.xxhash64("norm").alias("check")
    )
    # Copies of a row are one row with a count until the end, so none is hot by itself.
    ids = keyed.groupBy("digest", "check", "id").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    joined = ids.join(winners(docs, doc_id, text, salts), ["digest", "check"])
    return joined.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns.

    Of rows that repeat id and text any one stays.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).alias("id"),
        *_content(text),
    ).select("row", "id", "digest", F.xxhash64("norm").alias("check"))
    same = (
        (F.col("l.digest") == F.col("r.digest"))
        & (F.col("l.check") == F.col("r.check"))
        & F.col("l.id").eqNullSafe(F.col("r.id"))
    )
    first = winners(docs, doc_id, text, salts).select("digest", "check", F.col("keep_id").alias("id"))
    copies = keyed.groupBy("digest", "check", "id").agg(F.count(F.lit(1)).alias("copies"))
    # Digests and ids only: the texts are shuffled once more, to be joined with these.
    kept = materialize(
        first.alias("l").join(copies.alias("r"), same).select("l.*", "r.copies"), "kept-ids"
    )

    def rows_of(wanted: DataFrame) -> DataFrame:
        return keyed.alias("l").join(wanted.alias("r"), same).select("l.*")

    alone = rows_of(kept.where("copies = 1")).select("row.*")
    repeated = kept.where("copies > 1")
    if repeated.isEmpty():
        return alone
    one = rows_of(repeated).groupBy("digest", "check").agg(F.first("row").alias("row"))
    return alone.unionByName(one.select("row.*"))
