"""Duplicates, quality rules, licences and language-model scores on small cases."""

import collections
import hashlib
import math
import random
import re
import time
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import exact_dedup, license_scan, lm_score, ngram_join, quality_rules
from ledgerspark.llm.components import components

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_duplicates_of_odd_documents(docs, odd_docs):
    found = exact_dedup.exact_dedup(odd_docs)
    got = {}
    for r in found.collect():
        got.setdefault((r["doc_id"], r["text_sha256"]), []).append((r["keep_id"], r["group_size"], r["kept"]))

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    six, none = sha("one two three four five six"), sha("")
    assert sorted(got[(1, six)]) == [(1, 3, False), (1, 3, True)]
    assert got[(None, six)] == [(1, 3, False)]
    # Null and empty texts are equal; white space alone is one space.
    assert got[(3, none)] == [(3, 3, True)] and got[(4, none)] == [(3, 3, False)]
    assert got[(None, none)] == [(3, 3, False)]
    assert got[(5, sha(" "))] == [(5, 1, True)]
    kept = exact_dedup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 6, 7]
    assert exact_dedup.exact_dedup(docs([])).count() == exact_dedup.keep_first(docs([])).count() == 0


def test_a_group_of_null_ids_keeps_one(docs):
    found = exact_dedup.exact_dedup(docs([(None, "a"), (None, "a")])).collect()
    assert sorted(r["kept"] for r in found) == [False, True]
    assert {r["keep_id"] for r in found} == {None}
    assert exact_dedup.keep_first(docs([(None, "a"), (None, "a")])).count() == 1


def test_hot_group_is_combined_before_it_is_shuffled(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
    )
    found = exact_dedup.exact_dedup(rows, salts=4)
    assert found.where("kept").count() == 2001
    assert found.where("group_size = 1000 AND keep_id = 0").count() == 1000


def brute_base(text):
    words = WORD.findall(text)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = collections.Counter(wins)
    covered = {i + d for i, w in enumerate(wins) if counts[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts_against_brute_force(docs, odd_docs):
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a ", "b ", "c\n", "# ", "\t", "é"], k=rng.randint(0, 60))) for _ in range(80)]
    for frame in (docs(list(enumerate(texts))), odd_docs):
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        judged = quality_rules.quality_rules(frame)
        for row in judged.select("document.text", *names, "base_failed", "kept").collect():
            expected = brute_base(row["text"] or "")
            assert tuple(row[n] for n in names) == expected
            n, repeated = expected[0], expected[4]
            assert row["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
            assert not (row["base_failed"] and row["kept"])
    assert quality_rules.quality_rules(docs([])).count() == 0


def prose(k):
    return " ".join(f"{w}{k}" for w in "some plain words that go on in a line of ordinary text".split()) + "."


def test_lines_are_judged_one_by_one(docs):
    clean = "\n".join(prose(k) for k in range(8))
    menu = "Home | News | Sport | About\n"
    cookies = "We use cookies. Accept all cookies to go on.\n"
    junk = "\n".join("".join(f"{w}### " for w in prose(k).split()) for k in range(12))
    loud = "\n".join(" ".join(f"{w}!!" for w in prose(k).upper().split()) for k in range(12))
    frame = docs([(1, clean), (2, menu + cookies + clean), (3, junk), (4, loud), (5, junk + "\n\n" + clean)])
    kept = {r["doc_id"]: r for r in quality_rules.clean_documents(frame).collect()}
    assert sorted(kept) == [1, 2]
    assert kept[1]["text"] == kept[2]["text"] == clean
    assert kept[2]["n_chars"] == len(clean) and kept[2]["lang"] == "en"


def test_filter_on_the_verdict_is_not_slow(spark, docs):
    """The judgement must not be made anew for every word where the filter is pushed down."""
    long = " ".join(str(i) for i in range(30_000))
    judged = quality_rules.quality_rules(docs([(1, long)]))
    assert judged.where("kept AND n_repeat_words = 0").count() == 1


def test_licences(docs, odd_docs):
    found = license_scan.license_scan(
        docs([
            (1, "Text before.\nLicensed under the Apache License, version 2.0!\nText after."),
            (2, "released UNDER the mit license"),
            (3, "All rights reserved.\nLicensed under CC BY-NC 4.0."),
            (4, "A license is something else than a licence."),
            (5, None), (6, ""), (7, "Released under\nthe MIT License."),
        ])
    )
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[1]["licenses"] == "Apache-2.0" and rows[1]["best_dice"] == 1.0 and rows[1]["n_lines"] == 3
    assert rows[2]["licenses"] == "MIT" and rows[2]["n_notices"] == 1
    assert rows[3]["licenses"] == "CC-BY-NC-4.0,all-rights-reserved"
    assert [rows[k]["n_notices"] for k in (4, 5, 6)] == [0, 0, 0] and rows[5]["best_license"] is None
    assert rows[7]["licenses"] == "MIT", "the text as a whole"
    assert license_scan.license_scan(odd_docs).count() == 9
    assert license_scan.license_scan(docs([])).count() == 0


def test_licence_texts_and_headers_inside_documents(docs):
    folder = license_scan.Path(license_scan.__file__).parent / "licenses"
    mit, gpl = (folder / "MIT.txt").read_text(), (folder / "GPL-3.0.header.txt").read_text()
    bsd, apache = (folder / "BSD-2-Clause.txt").read_text(), (folder / "Apache-2.0.txt").read_text()
    other = "\n".join(prose(k) for k in range(30))
    found = license_scan.license_scan(
        docs([
            (1, f"Copyright (c) 2024 Example\n\n{mit}\n{other}"),
            (2, f"{other}\n# " + gpl.replace("\n", "\n# ") + f"\n{other}"),
            (3, apache),  # and its line of the short notice
            (4, f"{other} {' '.join(bsd.split())} {other}"), (5, other),
            (6, f"{mit}\n{other}\n{gpl}"),
        ])
    )
    rows = {r["doc_id"]: (r["licenses"], r["n_notices"]) for r in found.collect()}
    assert rows == {
        1: ("MIT", 1), 2: ("GPL-3.0", 1), 3: ("Apache-2.0", 2), 4: ("BSD-2-Clause", 1),
        5: ("", 0), 6: ("GPL-3.0,MIT", 2),
    }


def test_notices_within_lines_and_over_lines(docs):
    other = " ".join(prose(k) for k in range(30))
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    found = license_scan.license_scan(
        docs([
            (1, "Copyright 2024 Example. All rights reserved."), (2, bsd),
            (3, f"{other}\nThis work is licensed under the GNU General\nPublic License, version 3.\n{other}"),
            (4, f"{other} Released under the MIT License."), (5, "All rights\n\n reserved by others\n" + other),
            (6, "All rights reserved. Text. Licensed under CC BY-NC 4.0. " + other), (7, "!\n\nAll rights reserved.\n" + other),
        ])
    )
    rows = {r["doc_id"]: (r["licenses"], r["n_notices"]) for r in found.collect()}
    assert rows == {
        1: ("all-rights-reserved", 1), 2: ("BSD-3-Clause", 1), 3: ("GPL-3.0", 1), 4: ("MIT", 1),
        5: ("all-rights-reserved", 1), 6: ("CC-BY-NC-4.0,all-rights-reserved", 2),
        7: ("all-rights-reserved", 1),
    }


def passages_by_force(text, templates, least):
    """Licences of the passages that count, best first, with windows formed one by one."""
    words = license_scan.normal_words(text or "")
    grams, found = [f"{a} {b}" for a, b in zip(words, words[1:])], []
    for template in templates:
        own = license_scan.normal_words(template.text)
        wanted = set(license_scan.bigrams_of(own))
        for p, gram in enumerate(grams):
            window = set(grams[p : p + len(own) - 1])
            dice = 2.0 * len(window & wanted) / (len(window) + len(wanted))
            if gram in wanted and dice >= least:
                found.append((-len(window & wanted) * dice, template.license, p, p + len(own), dice))
    found.sort(key=lambda c: (c[0], [-ord(x) for x in c[1]], c[2]))
    kept = []
    for c in found:
        if not any(c[2] < o[3] and o[2] < c[3] for o in kept):
            kept.append(c)
    return kept


@pytest.mark.parametrize("least", [0.5, 0.8])
def test_passages_against_brute_force(docs, least):
    rng = random.Random(int(10 * least))
    vocabulary = [f"w{k}" for k in range(12)]
    templates = tuple(
        license_scan.Template(f"T{k}", " ".join(rng.choices(vocabulary, k=n)))
        for k, n in enumerate((5, 20, 34, 60, 150, 400))
    )
    rows = []
    for k in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            words = rng.choice(templates).text.split()
            for _ in range(rng.choice([0, 1, 3, 10])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            parts += words[rng.choice([0, 0, 3]) :] + rng.choices(vocabulary, k=rng.choice([0, 5, 200, 600]))
        rows.append((k, " ".join(parts)))
    rows += [(60, None), (61, ""), (62, "w1"), (63, "w1 " * 900)]
    found = license_scan.license_scan(docs(rows), templates=(), texts=templates, least=least)
    got = {r["doc_id"]: (r["n_notices"], r["licenses"], r["best_dice"]) for r in found.collect()}
    kept = {k: passages_by_force(text, templates, least) for k, text in rows}
    assert got == {
        k: (len(v), ",".join(sorted({c[1] for c in v})), max((c[4] for c in v), default=None))
        for k, v in kept.items()
    }
    assert sum(map(len, kept.values())) > 50


def test_many_copies_of_a_long_licence(docs):
    gpl = (license_scan.Path(license_scan.__file__).parent / "licenses" / "GPL-3.0.txt").read_text()
    begin = time.monotonic()
    row = license_scan.license_scan(docs([(1, "\n".join([gpl] * 20))])).first()
    assert (row["licenses"], row["n_notices"], row["best_dice"]) == ("GPL-3.0", 20, 1.0)
    assert time.monotonic() - begin < 600, "formed window by window this takes an hour"


def brute_components(rows, words, percent):
    def shingles(text):
        ws = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        return {tuple(ws[i : i + words]) for i in range(len(ws) - words + 1)} or ({tuple(ws)} if ws else set())

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(
        ((i, len(s), least.get(g) if s else i) for (i, _), s, g in zip(rows, sets, group)), key=repr
    )


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_components_against_brute_force(docs, words, percent):
    rng = random.Random(words)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for k in range(60):
        own = rng.choices(vocabulary, k=rng.randint(1, 120))
        if k % 3 == 0:
            own = own[:40] + passage
        rows.append((k, " ".join(own)))
    base = rng.choices(vocabulary, k=100)
    for k in range(60, 150):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5])):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            del copy[rng.randrange(len(copy))]
        rows.append((k, " ".join(copy)))
    rows += [(200, "A b"), (201, "a B"), (202, "a"), (203, ""), (204, None), (205, rows[3][1].upper())]
    rng.shuffle(rows)
    found = ngram_join.ngram_jaccard_join(docs(rows), words=words, percent=percent)
    assert rows_of(found.select("doc_id", "n_shingles", "component_id")) == brute_components(rows, words, percent)


def test_join_of_odd_documents(docs, odd_docs):
    found = ngram_join.ngram_jaccard_join(odd_docs, words=3, percent=90)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(found) == brute_components(rows, 3, 90)
    kept = ngram_join.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    # Documents without words stay, and of the others one of each group (or its repeats).
    ids = collections.Counter(r["doc_id"] for r in kept.collect())
    assert ids == {1: 2, None: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1}
    assert ngram_join.ngram_jaccard_join(docs([])).count() == 0
    assert ngram_join.keep_one_of_each(docs([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 40)] + [(50, 50)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert roots == {k: 100 for k in range(101, 141)} | {k: 7 for k in range(8, 40)}


def test_gradient_is_the_slope_of_the_loss():
    config = lm_score.LmConfig(hidden=4, step=4, units=16, classes=6)
    rng = np.random.default_rng(0)
    units = lm_score.make_units(rng.integers(0, 50, 40), config)
    language = lm_score.make_language(units, rng.integers(0, 9, (16, 16)).astype(float), config)
    model = lm_score.Attention(config, language.log_class)
    for name in model.NAMES:
        value = getattr(model, name)
        setattr(model, name, value + 0.3 * rng.standard_normal(value.shape))
    texts = [rng.integers(0, 39, n) for n in (9, 3, 0)]
    x, target, valid, _ = lm_score.windows(texts, units, 4)
    goal = language.classes[units.of[target]]

    def loss():
        logits, norm, _ = model.forward(x)
        own = logits[np.arange(len(logits)), goal.ravel()]
        return ((norm - own) * valid.ravel()).sum() / valid.sum()

    for name, gradient in zip(model.NAMES, model.gradient(x, goal, valid)):
        value = getattr(model, name)
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in value.shape)
            old, losses = value[at], []
            for step in (1e-4, -1e-4):
                value[at] = old + step
                losses.append(loss())
            value[at] = old
            assert abs((losses[0] - losses[1]) / 2e-4 - gradient[at]) < 1e-6


def test_probabilities_of_the_next_subword_add_up_to_one():
    config = lm_score.LmConfig(hidden=4, step=4, units=16, classes=6)
    rng = np.random.default_rng(3)
    units = lm_score.make_units(rng.integers(0, 50, 30), config)
    pairs = rng.integers(0, 9, (16, 16)).astype(float)
    pairs[:, ~np.isin(np.arange(16), units.of)] = 0
    language = lm_score.make_language(units, pairs, config)
    model = lm_score.Attention(config, language.log_class)
    model.out += rng.standard_normal(model.out.shape).astype(np.float32)
    start = rng.integers(0, 29, 6)
    x, _, _, _ = lm_score.windows([start], units, 4)
    logits, norm, _ = model.forward(x)
    row = len(start)  # the place after the last subword
    log_class = (logits[row] - norm[row]) / np.log(10)
    last = x[:, 4:].ravel()[row]
    each = log_class[language.classes[units.of]] + language.log_unit[last, units.of] + units.log_share
    assert abs((10.0**each).sum() - 1) < 1e-3
    quick = lm_score.Scorer(model, language)
    goal = np.resize(np.arange(30), (len(x), 4))
    slow = (logits - norm[:, None])[np.arange(goal.size), language.classes[units.of[goal.ravel()]]] / np.log(10)
    slow = slow + language.log_unit[x[:, 4:].ravel(), units.of[goal.ravel()]] + units.log_share[goal.ravel()]
    assert np.abs(quick.log_words(x, goal).ravel() - slow)[: row + 1].max() < 1e-4


@pytest.mark.parametrize("shift", [200, -200])
def test_probabilities_do_not_depend_on_how_large_the_numbers_are(shift):
    """The same number added to all of a row's logits, or to all attention scores, changes nothing."""
    config = lm_score.LmConfig(hidden=4, step=4, units=16, classes=6)
    rng = np.random.default_rng(4)
    units = lm_score.make_units(rng.integers(0, 50, 30), config)
    language = lm_score.make_language(units, rng.integers(0, 9, (16, 16)).astype(float), config)
    model = lm_score.Attention(config, language.log_class)
    model.out += rng.standard_normal(model.out.shape).astype(np.float32)
    x, target, valid, _ = lm_score.windows([rng.integers(0, 29, 11)], units, 4)
    goal = language.classes[units.of[target]]
    plain, slopes = lm_score.Scorer(model, language).log_words(x, target), model.gradient(x, goal, valid)
    model.bias += np.float32(shift)
    model.distance += np.float32(shift)
    assert np.abs((lm_score.Scorer(model, language).log_words(x, target) - plain)[valid]).max() < 1e-3
    for a, b in zip(slopes, model.gradient(x, goal, valid)):
        assert np.abs(a - b).max() < 1e-3


def test_scores_of_odd_documents(docs, odd_docs):
    found = lm_score.lm_scores(odd_docs, BYTES, 50_257, config=lm_score.LmConfig(units=256, classes=8)).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    tokens = [
        (i, [*WORD.findall("".join(c.lower() if c.isascii() else c for c in t)), None]) for i, t in rows
    ]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    counts = collections.Counter(w for i, ws in tokens if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (
            (i, held[i], len(ws), sum(counts[w] > 0 for w in ws), total,
             round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws), 4))
            for i, ws in tokens
        ),
        key=repr,
    )
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    got = sorted(((*(r[n] for n in names), round(r["base_score"], 4)) for r in found), key=repr)
    assert got == expected
    assert all(r["score"] < 0 for r in found)
    assert lm_score.lm_scores(docs([]), BYTES, 50_257, config=lm_score.LmConfig(units=256, classes=8)).count() == 0


def test_a_word_has_one_row_in_a_lot_of_blocks(monkeypatch):
    """However many blocks hold it; the blocks' numbers and the lots' counts give the base scores."""
    here = types.SimpleNamespace(partitionId=lambda: 3)
    monkeypatch.setattr(lm_score, "TaskContext", types.SimpleNamespace(get=lambda: here))
    texts = ["b a a", "", "a \u00e9 c", "a b", "d", "a", "  ", "c c a"] * 5
    held = [k % 3 == 0 for k in range(len(texts))]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "held_out": held, "body": texts})
    rows = pa.Table.from_batches(lm_score._make_blocks(BYTES, 6)(iter([batch])))
    blocks, words = rows.filter(pc.is_valid(rows["ids"])), rows.filter(pc.is_valid(rows["word"]))
    keys = list(zip(words["lot"].to_pylist(), words["word"].to_pylist()))
    lots = sorted(set(blocks["lot"].to_pylist()))
    assert 1 < len(lots) < len(blocks) and len(set(keys)) == len(keys)
    counts = collections.Counter(w for t, h in zip(texts, held) if not h for w in t.encode().split())
    learnt = collections.Counter()
    for (_, word), n in zip(keys, words["train"].to_pylist()):
        learnt[word] += n
    assert +learnt == counts
    total, scores = sum(counts.values()), []
    for lot in lots:
        of = words.filter(pc.equal(words["lot"], lot))
        counted = pa.table({"number": of["number"], "c": [counts[w] for w in of["word"].to_pylist()]}).take(
            np.random.default_rng(lot).permutation(len(of))
        )
        own = blocks.filter(pc.equal(blocks["lot"], lot)).select(["block", "words", "n_tokens"])
        scores += lm_score._base_scores(total, len(counts))(own, counted).to_pylist()
    scores.sort(key=lambda r: (r["block"], r["at"]))
    floor = math.log10(total + 0.1 * (len(counts) + 1))
    for text, found in zip(texts, scores, strict=True):
        split = text.encode().split()
        assert found["known"] == sum(counts[w] > 0 for w in split)
        assert abs(found["base"] - sum(math.log10(counts[w] + 0.1) - floor for w in split)) < 1e-9


def test_a_word_of_every_block_is_split(spark, tmp_path):
    """A third of the posting rows are of one word: no window gathers them, AQE cuts them."""
    words = spark.range(60_000).selectExpr(
        "id AS block", "CAST(IF(id % 3 = 0, 'hot', CAST(id AS string)) AS binary) AS word", "1L AS train",
        "array(CAST(rand(1) * 1e9 AS int), CAST(rand(2) * 1e9 AS int)) AS docs", "array(1, 1) AS times",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for name, frame in (("words", words), ("totals", lm_score.word_totals(words))):
            frame.write.parquet(str(tmp_path / name))
        counted = lm_score.with_totals(*(spark.read.parquet(str(tmp_path / n)) for n in ("words", "totals")))
        assert collections.Counter(r["c"] for r in counted.collect()) == {1: 40_000, 20_000: 20_000}
        plan = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Window" not in plan and "SortMergeJoin(skew=true)" in plan, plan


def test_training_takes_every_window_once(docs):
    config = lm_score.LmConfig()
    rows = np.array([1, 2, 3, 16, 40, 1])
    chosen = [lm_score.windows_of_round(rows, config.every, turn) for turn in range(config.rounds)]
    assert sorted(np.concatenate(chosen).tolist()) == list(range(rows.sum()))
    with pytest.raises(ValueError):
        lm_score.lm_scores(docs([]), BYTES, 50_257, config=lm_score.LmConfig(rounds=2, every=16))


def test_held_out_text_is_likelier_than_its_shuffle(spark, docs):
    """Sentences of a fixed order: the model must have learnt what follows what."""
    rng = random.Random(5)
    subjects, verbs, objects = (["the cat", "a dog", "my friend"], ["sees", "likes"], ["green trees.", "old houses."])

    def text():
        return " ".join(rng.choice(p) for _ in range(15) for p in (subjects, verbs, objects))

    rows = [(k, text()) for k in range(300)]
    shuffled = []
    for k, t in rows:
        if zlib.crc32(str(k).encode()) % 10 == 0:
            words = t.split()
            rng.shuffle(words)
            other = next(n for n in range(1000 * (k + 1), 10**7) if zlib.crc32(str(n).encode()) % 10 == 0)
            shuffled.append((k, other, " ".join(words)))
    frame = docs(rows + [(other, t) for _, other, t in shuffled])
    config = lm_score.LmConfig(units=256, classes=16, every=1, rounds=3)
    score = {r["doc_id"]: r["score"] for r in lm_score.lm_scores(frame, BYTES, 50_257, config=config).collect()}
    assert shuffled and all(score[k] > score[other] for k, other, _ in shuffled)


@pytest.mark.parametrize("rounds", [0, 8])
def test_copies_of_a_lost_original_are_connected(spark, docs, monkeypatch, rounds):
    """Each copy lacks other words, so only some pairs are near, and no one hub has them all."""
    rng = random.Random(11)
    rows = []
    for family in range(2):
        base = [f"w{family}x{k}" for k in range(90)]
        rows += [(family * 100 + k, " ".join(w for w in base if rng.random() < 0.885)) for k in range(45)]
    original = ngram_join._tied_in_crowds
    tied = []

    def crowds(labelled, nodes, percent):
        found = original(labelled, nodes, percent, rounds)
        tied.append(0 if found is None else found.count())
        return found

    monkeypatch.setattr(ngram_join, "_tied_in_crowds", crowds)
    sets = {i: set(t.split()) for i, t in rows}
    least = {i: i for i in sets}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert 50 < len(linked) < 1500
    for _ in sets:
        for a, b in linked:
            least[a] = least[b] = min(least[a], least[b])
    found = ngram_join.ngram_jaccard_join(docs(rows), words=1, percent=80)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == least
    assert (tied[0] > 0) == (rounds > 0)


def test_signatures_keep_every_pair_that_reaches_the_threshold(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 400)
    sets = [sorted(rng.choice(base, size, replace=False).tolist()) for size in rng.integers(1, 400, 150)]
    sets += [sorted({*base[: 200 - k].tolist(), *base[200 : 200 + k].tolist()}) for k in range(0, 60, 3)]
    nodes = spark.createDataFrame(
        [(k, len(s) + k % 3, len(s), s) for k, s in enumerate(sets)], "node bigint, n bigint, m bigint, tokens array<bigint>"
    )
    kind = ", ".join(f"{c} bigint" for c in ("node", *ngram_join.SIGNATURE))
    signed = nodes.join(nodes.select("node", "tokens").mapInArrow(ngram_join._signatures, kind), "node")
    pairs = signed.alias("a").join(signed.alias("b"), F.col("a.node") < F.col("b.node"))
    found = pairs.select("a.node", "b.node", ngram_join._close("a", "b", 80)).collect()
    kept = wrong = 0
    for a, b, close in found:
        both = len({*sets[a]} & {*sets[b]})
        union = len(sets[a]) + a % 3 + len(sets[b]) + b % 3 - both
        kept += close
        wrong += 100 * both >= 80 * union and not close
    assert wrong == 0 and kept < len(found) / 5


def test_dense_group_that_is_not_similar(spark, docs, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join(rng.choice(words, 60, replace=False))) for k in range(120)]
    rows += [(1000 + k, f"{rows[k][1]} extra{k}") for k in range(20)]
    signed = []
    original = ngram_join._signed_in_crowds

    def recorded(labelled, nodes):
        found = original(labelled, nodes)
        signed.append(found.where("s0 IS NOT NULL").count())
        return found

    monkeypatch.setattr(ngram_join, "_signed_in_crowds", recorded)
    found = ngram_join.ngram_jaccard_join(docs(rows), words=1, percent=80)
    by_id = {r["doc_id"]: r["component_id"] for r in found.collect()}
    sets = {k: {*t.split()} for k, t in rows}
    least = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if least[b] < least[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a], changed = least[b], True
    assert by_id == least
    assert signed[-1] > 100
