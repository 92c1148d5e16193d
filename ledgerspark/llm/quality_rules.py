"""Quality rules, line first.

Every line is judged by itself; lines that fail are removed; a document is rejected if it
fails the base rules or if removal took too much of its text. All of it is one projection:
no shuffle and no explode, so the longest text is the only thing a task must hold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.text import SPACE, WORD, whole_text, words_of

SYMBOLS = "#*$%&|<>"
NAV_MARKS = "|»›•>"
SPACES = " \t\n\x0b\x0c\r"

# Phrases of web boilerplate, lower case.
BOILERPLATE = (
    "accept all cookies",
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "javascript is required",
    "lorem ipsum",
    "privacy policy",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "we use cookies",
)


@dataclass(frozen=True)
class QualityRules:
    """Bounds of the line rules, of the loss a document may have, and of the base rules."""

    max_symbol_share: float = 0.1  # punctuation: symbols among the characters of words
    max_loud_share: float = 0.5  # punctuation: words that end in !! or ??
    min_nav_marks: int = 2  # navigation: separators in a line ...
    max_nav_words: float = 3.0  # ... with at most so many words on average between them
    max_boilerplate_words: int = 40  # boilerplate: a phrase in a line of so many words
    max_lost_share: float = 0.5  # characters of words that removal may take
    min_words: int = 50
    max_repeat_percent: int = 50


def _without(text: Column, characters: str) -> Column:
    """Code points of the text that are none of the characters."""
    return F.char_length(F.translate(text, characters, ""))


def line_fails(line: Column, rules: QualityRules) -> Column:
    """True for a line that must go. Lines without words always stay."""
    chars = _without(line, SPACES)
    words = F.regexp_count(line, F.lit(f"{WORD}+"))
    symbols = F.char_length(line) - _without(line, SYMBOLS)
    marks = F.char_length(line) - _without(line, NAV_MARKS)
    loud = F.regexp_count(line, F.lit(rf"[!?]{{2}}(?={SPACE}|$)"))
    phrases = reduce(lambda a, b: a | b, [F.lower(line).contains(p) for p in BOILERPLATE])
    punctuation = (symbols > chars * rules.max_symbol_share) | (loud > words * rules.max_loud_share)
    navigation = (marks >= rules.min_nav_marks) & (
        words - marks <= (marks + 1) * rules.max_nav_words
    )
    boilerplate = (words <= rules.max_boilerplate_words) & phrases
    return (chars > 0) & (punctuation | navigation | boilerplate)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often and wherever ``body`` uses it.

    A column used within a lambda is not enough: where Catalyst merges projections or pushes
    a filter down, its expression would be made again for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are sorted with their places; those with an equal neighbour are repeated. Each
    of them adds the words up to the next repeated one, three at most.
    """
    # Words hold no space, so joining them by one keeps different windows different.
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)),
    )

    def starts(placed: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            same = [F.get(placed, k + d)["w"] == x["w"] for d in (-1, 1)]
            return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(placed, repeated), lambda x: x["i"]))

    def covered(found: Column) -> Column:
        steps = F.transform(
            found, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(found, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def count(made: Column) -> Column:
        placed = F.sort_array(F.transform(made, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.when(
            F.size(F.array_distinct(made)) < F.size(made),
            _let(placed, lambda x: _let(starts(x), covered)),
        ).otherwise(F.lit(0))

    return _let(windows, count)


def quality_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: QualityRules | None = None,
) -> DataFrame:
    """One row per document: ``document`` (all its columns as a struct), doc_id, counts, verdict.

    ``clean_text`` is the text without the lines that fail; lines are what ``\\n``
    separates, and a line without words always stays. ``lost_chars`` counts the characters
    of words in removed lines. ``kept`` is false if ``base_failed``, or if more than
    ``max_lost_share`` of the characters went. A null text has no words and fails the base
    rules. Rows are judged one by one, so repeated rows, null ids and further columns
    change nothing; an empty table gives an empty result.
    """
    rules = rules or QualityRules()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
        F.col(doc_id).alias("doc_id"),
        whole_text(text).alias("body"),
    )
    rows = rows.withColumns(
        {
            "words": _let(
                words_of(F.col("body")),
                lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeated")),
            ),
            "n_dup_lines": _let(
                F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD)),
                lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
            ),
            "clean_text": F.array_join(
                F.filter(F.split("body", "\n"), lambda x: ~line_fails(x, rules)), "\n"
            ),
        }
    )
    rows = rows.select(
        "document",
        "doc_id",
        "clean_text",
        F.col("words.n").cast("bigint").alias("n_words"),
        _without(F.col("body"), SPACES).cast("bigint").alias("word_chars"),
        (F.char_length("body") - _without(F.col("body"), SYMBOLS))
        .cast("bigint")
        .alias("n_symbols"),
        F.col("n_dup_lines").cast("bigint").alias("n_dup_lines"),
        F.col("words.repeated").cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    lost = F.col("word_chars") - _without(F.col("clean_text"), SPACES)
    rows = rows.withColumns({"lost_chars": lost.cast("bigint"), "base_failed": failed})
    return rows.withColumn(
        "kept",
        ~F.col("base_failed")
        & (F.col("lost_chars") <= F.col("word_chars") * rules.max_lost_share),
    )


def clean_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: QualityRules | None = None,
    n_chars: str | None = "n_chars",
) -> DataFrame:
    """The kept documents with their columns; the text without the removed lines.

    ``n_chars``, if the table has it, is counted anew.
    """
    judged = quality_rules(docs, doc_id, text, rules)
    # The row number keeps the filter above the judgement; pushed below, it would judge twice.
    judged = judged.withColumn("row_number", F.monotonically_increasing_id())
    judged = judged.where("kept AND row_number >= 0")
    new = {text: F.col("clean_text")}
    if n_chars in docs.columns:
        new[n_chars] = F.char_length("clean_text").cast(docs.schema[n_chars].dataType)
    return judged.select(*[new.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns])
