"""Licence scan: lines, whole texts and passages against templates by Dice over word bigrams.

Size bounds prune first: two sets of a and b bigrams reach a Dice coefficient of d only if
a lies between b*d/(2-d) and b*(2-d)/d, so most lines are never compared. They also share
b*d/(2-d) bigrams at least, so a passage is compared only where a window of its template's
size holds as many places with a bigram of the template. Windows of long templates are never
formed: the distinct and the shared bigrams of any window follow from running counts of the
places whose bigram comes again within, or came before within, the template's length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.text import LOWER, UPPER, whole_text


@dataclass(frozen=True)
class Template:
    license: str
    text: str


# Short notices as they are put into documents.
TEMPLATES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("MIT", "Released under the MIT License."),
    Template("MIT", "This software is licensed under the MIT License."),
    Template("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0."),
    Template("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Template("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work under CC0 1.0."),
    Template("all-rights-reserved", "All rights reserved."),
)

# Whole licence texts and the standard headers of files, as NAME.txt and NAME.header.txt.
TEXTS = tuple(
    Template(path.stem.removesuffix(".header"), path.read_text(encoding="utf-8"))
    for path in sorted((Path(__file__).parent / "licenses").glob("*.txt"))
)


def normal_words(text: str) -> list[str]:
    """Lower case ASCII; words are runs of ASCII letters and digits."""
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    clean = "".join(c if c.isascii() and c.isalnum() else " " for c in lower)
    return clean.split()


def bigrams_of(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _bigrams(words: Column) -> Column:
    pairs = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)),
    )
    return F.array_distinct(pairs)


def _best(grams: Column, templates: tuple[Template, ...], least: float) -> Column:
    """Struct (dice, license) of the best template, null below ``least``.

    Of equal coefficients the licence that sorts last is taken.
    """
    best = F.lit(None).cast("struct<dice:double,license:string>")
    scored = [best]
    for template in templates:
        wanted = bigrams_of(normal_words(template.text))
        b = len(wanted)
        near = F.size(grams).between(b * least / (2 - least), b * (2 - least) / least)
        shared = F.size(F.array_intersect(grams, F.array(*map(F.lit, wanted))))
        dice = F.lit(2.0) * shared / (F.size(grams) + b)
        scored.append(
            F.when(
                near & (dice >= least),
                F.struct(dice.alias("dice"), F.lit(template.license).alias("license")),
            )
        )
    return F.greatest(*scored, best)


def _one_of(value: str, grams: list[str]) -> str:
    """SQL condition; bigrams are ASCII letters, digits and a space."""
    return f"{value} IN ({', '.join(repr(g) for g in grams)})"


# Windows of templates with up to so many bigrams are formed as arrays.
SHORT_WIDTH = 32
# Running counts are kept in blocks of so many places.
BLOCK = 256


def _starts(template: Template, least: float) -> str:
    """SQL: where windows of the template's size may begin; null without any.

    From ``hits``, the places of bigrams that some template has: a window begins with a bigram
    of the template and holds as many places with such bigrams as the coefficient needs.
    """
    words = normal_words(template.text)
    wanted = bigrams_of(words)
    b, width = len(wanted), len(words) - 1
    need = max(1, math.ceil(b * least / (2 - least) - 1e-9))
    return f"""CASE WHEN size(hits) >= {need} THEN transform(
      array(transform(filter(hits, h -> {_one_of("h.g", wanted)}), h -> h.i)),
      at -> filter(at, (p, k) -> coalesce(get(at, k + {need - 1}) - p < {width}, false)))[0] END"""


def _candidate(template: Template, short: bool, size: str) -> str:
    """SQL: one passage, from its start ``p``, its ``shared`` bigrams and the ``size`` of its set."""
    words = normal_words(template.text)
    return f"""named_struct(
      'dice', 2.0D * shared / ({size} + {len(bigrams_of(words))}), 'license', '{template.license}',
      'shared', shared, 'start', p, 'stop', p + {len(words)}, 'short', {str(short).lower()})"""


def _passages(template: Template, starts: str, least: float, short: bool) -> str:
    """SQL: the windows from ``starts`` that reach ``least``, formed one by one.

    From ``grams``, the bigrams of the text in order. ``x -> ...`` over an array of one value
    gives that value a name.
    """
    words = normal_words(template.text)
    return f"""filter(transform({starts},
      p -> transform(array(array_distinct(slice(grams, p + 1, {len(words) - 1}))),
        own -> transform(array(size(array_intersect(own, split('{",".join(bigrams_of(words))}', ',')))),
          shared -> {_candidate(template, short, "size(own)")})[0])[0]),
      c -> c.dice >= {least!r}D)"""


# SQL: for each place of a text, how far its bigram's last and next places are; far without any.
_GAPS = f"""transform(
  array(array_sort(transform(grams, (g, i) -> named_struct('g', g, 'i', i)))),
  s -> transform(
    array_sort(transform(s, (x, k) -> named_struct('i', x.i,
      'back', IF(get(s, k - 1).g = x.g, x.i - get(s, k - 1).i, {2**31 - 1}),
      'ahead', IF(get(s, k + 1).g = x.g, get(s, k + 1).i - x.i, {2**31 - 1})))),
    x -> named_struct('back', x.back, 'ahead', x.ahead)))[0]"""


def _running(values: str) -> str:
    """SQL: blocks of running sums of an array of longs, each block with the sum before it.

    Appending to an array copies it, so sums are made within blocks, and over the blocks.
    """
    appended = "(x, y) -> concat(x, array(element_at(x, -1) + y))"
    return f"""transform(array({values}), v -> transform(
      array(transform(sequence(0, size(v) div {BLOCK}),
        j -> aggregate(slice(v, j * {BLOCK} + 1, {BLOCK}), array(0L), {appended}))),
      blocks -> transform(
        array(aggregate(transform(blocks, y -> element_at(y, -1)), array(0L), {appended})),
        before -> transform(blocks, (y, j) -> named_struct('before', before[j], 'sums', y)))[0])[0])[0]"""


def _sum_before(blocks: str, place: str) -> str:
    """SQL: the sum of the values before a place."""
    block = f"{blocks}[({place}) div {BLOCK}]"
    return f"({block}.before + {block}.sums[({place}) % {BLOCK}])"


def _long_passages(template: Template, starts: str, least: float, short: bool) -> str:
    """SQL: as ``_passages``, with work that grows with the text and not with its windows.

    A window of w places that begins at p has as many distinct bigrams as there are places
    before p + w whose bigram does not come in the w - 1 places before, less the places before
    p whose bigram does not come in the w - 1 places after. Those of the template are counted
    in the upper half of the same long. From ``grams`` and ``gaps``.
    """
    words = normal_words(template.text)
    width = len(words) - 1
    weights = f"transform(grams, g -> IF({_one_of('g', bigrams_of(words))}, {2**32 + 1}L, 1L))"

    def sums(side: str) -> str:
        return _running(f"transform(gaps, (x, i) -> IF(x.{side} >= {width}, weights[i], 0L))")

    both = f"{_sum_before('came', f'least(p + {width}, size(gaps))')} - {_sum_before('went', 'p')}"
    return f"""CASE WHEN size({starts}) > 0 THEN transform(array({weights}), weights ->
      transform(array({sums("back")}), came -> transform(array({sums("ahead")}),
        went -> filter(transform({starts},
          p -> transform(array({both}), n -> transform(array(CAST(shiftright(n, 32) AS int)),
            shared -> {_candidate(template, short, f"(n & {2**32 - 1}L)")})[0])[0]),
          c -> c.dice >= {least!r}D))[0])[0])[0] END"""


# Passages that overlap neither a better one nor, if they are short notices, a line found before.
_APART = """aggregate(
  array_sort(passages, (a, b) -> CASE
    WHEN a.shared * a.dice > b.shared * b.dice THEN -1 WHEN a.shared * a.dice < b.shared * b.dice THEN 1
    WHEN a.license > b.license THEN -1 WHEN a.license < b.license THEN 1
    ELSE a.start - b.start END),
  slice(passages, 1, 0),
  (kept, c) -> CASE
    WHEN exists(kept, o -> c.start < o.stop AND o.start < c.stop)
      OR (c.short AND exists(spans, o -> c.start < o.stop AND o.start < c.stop)) THEN kept
    ELSE concat(kept, array(c)) END)"""


def license_scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    least: float = 0.8,
    texts: tuple[Template, ...] = TEXTS,
) -> DataFrame:
    """doc_id, n_lines, n_notices, licenses, best_license, best_dice per document.

    Candidates are the lines of a text (what ``\\n`` separates) and, if there are several,
    the text as a whole, for ``templates``; and passages of a text, for ``templates`` and
    ``texts``: all windows of as many words as the template has that begin with a bigram of
    it, wherever lines and sentences end. They are normalised to words of lower-case ASCII
    letters and digits. Of passages that overlap, the one with the largest product of shared
    bigrams and coefficient counts; a short notice's passage counts only apart from lines and
    whole texts that count themselves. ``n_lines`` counts lines with two words or more, ``n_notices`` the candidates
    that reach ``least`` for some template, ``licenses`` is the sorted list of their
    licences joined by commas, empty if there are none; the best of them has the largest
    coefficient and, of equal ones, the name that sorts last. Null and empty texts have no
    lines. Rows are scanned one by one: repeated rows, null ids and further columns change
    nothing; an empty table gives an empty result.
    """
    longest = max((len(bigrams_of(normal_words(t.text))) for t in templates), default=0)
    most = int(longest * (2 - least) / least)

    def words(body: Column) -> Column:
        lower = F.translate(body, UPPER, LOWER)
        return F.split(F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " ")), " ")

    # Words are columns of their own, so that the lambdas below do not make them anew.
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body"))
    rows = rows.withColumn("lines", F.split("body", "\n"))
    rows = rows.select(
        "doc_id",
        F.transform("lines", words).alias("line_words"),
        words(F.col("body")).alias("text_words"),
    )
    rows = rows.select(
        "doc_id",
        F.transform("line_words", F.size).alias("line_sizes"),
        F.transform("line_words", _bigrams).alias("line_grams"),
        F.transform("line_words", lambda w: F.element_at(w, 1) != "").alias("line_full"),
        F.when(F.size("line_words") > 1, _bigrams(F.col("text_words"))).alias("whole_grams"),
        F.size("text_words").alias("n_words"),
        F.expr(
            "transform(slice(text_words, 1, size(text_words) - 1),"
            " (w, i) -> concat(w, ' ', get(text_words, i + 1)))"
        ).alias("grams"),
    )
    every = sorted({g for t in templates + texts for g in bigrams_of(normal_words(t.text))})

    def best(grams: Column) -> Column:
        return F.when(F.size(grams).between(1, most), _best(grams, templates, least))

    rows = rows.select(
        "*",
        F.transform("line_grams", best).alias("line_best"),
        best(F.col("whole_grams")).alias("whole_best"),
        F.expr(
            f"filter(transform(grams, (g, i) -> named_struct('i', i, 'g', g)), h -> {_one_of('h.g', every)})"
        ).alias("hits"),
    )
    long = [t for t in templates + texts if len(normal_words(t.text)) - 1 > SHORT_WIDTH]
    rows = rows.select("*", *(F.expr(_starts(t, least)).alias(f"starts{k}") for k, t in enumerate(long)))
    wide = " OR ".join(f"size(starts{k}) > 0" for k in range(len(long))) or "false"
    rows = rows.select("*", F.expr(f"CASE WHEN {wide} THEN {_GAPS} END").alias("gaps"))
    found = [
        _long_passages(t, f"starts{long.index(t)}", least, t in templates) if t in long
        else _passages(t, _starts(t, least), least, t in templates)
        for t in templates + texts
    ]
    none = "array<struct<dice:double,license:string,shared:int,start:int,stop:int,short:boolean>>"
    rows = rows.select(
        "*",
        # The words that a found line, or the whole text, takes in the text.
        F.expr("""concat(
          transform(
            filter(transform(line_best, (b, j) -> IF(b IS NULL, -1, j)), j -> j >= 0),
            j -> transform(
              array(aggregate(
                zip_with(slice(line_sizes, 1, j), slice(line_full, 1, j), (n, f) -> IF(f, n, 0)),
                0, (x, n) -> x + n)),
              p -> named_struct('start', p, 'stop', p + line_sizes[j]))[0]),
          IF(whole_best IS NULL, array(), array(named_struct('start', 0, 'stop', n_words))))""").alias("spans"),
        F.concat(*(F.coalesce(F.expr(x), F.array().cast(none)).cast(none) for x in found)).alias("passages"),
    )
    rows = rows.select(
        "doc_id",
        F.size(F.filter("line_grams", lambda g: F.size(g) > 0)).alias("n_lines"),
        F.concat(
            F.filter(F.concat("line_best", F.array("whole_best")), lambda x: x.isNotNull()),
            F.expr(f"transform({_APART}, c -> named_struct('dice', c.dice, 'license', c.license))"),
        ).alias("found"),
    )
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"])))
    return rows.select(
        "doc_id",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.size("found").cast("bigint").alias("n_notices"),
        F.array_join(names, ",").alias("licenses"),
        F.array_max("found")["license"].alias("best_license"),
        F.array_max("found")["dice"].alias("best_dice"),
    )
