"""Token-id files, periodic runs and source divergence against brute force."""

import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerspark.llm import divergence, packing, periodic_runs, queries, token_store

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- token ids ----------------------------------------------------------------------------


class Memory:
    """Bytes with the two calls that the reader needs; remembers the ranges read."""

    def __init__(self, data):
        self.data, self.ranges = data, []

    def size(self):
        return len(self.data)

    def read_at(self, length, offset):
        self.ranges.append((offset, length))
        return self.data[offset : offset + length]


def shard(documents, percentile=0.95):
    stream = io.BytesIO()
    writer = token_store.ShardWriter(stream, percentile)
    for k, ids in enumerate(documents):
        writer.add(pa.array([k]), np.array(ids, np.uint32), np.array([len(ids)]))
    writer.close()
    return Memory(stream.getvalue())


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=300), max_size=6),
    st.sampled_from([0.0, 0.5, 0.95, 1.0]),
)
def test_blocks_are_a_round_trip(documents, percentile):
    reader = token_store.ShardReader(shard(documents, percentile))
    assert [x.tolist() for x in reader.documents(0, len(documents))] == documents


def test_many_blocks_exceptions_and_ranges():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 50_000), 2**31).astype(np.uint32)
    documents = [part.tolist() for part in np.split(ids, np.sort(rng.integers(0, len(ids), 40)))]
    file = shard(documents)
    reader = token_store.ShardReader(file)
    assert len(reader.starts) == -(-len(ids) // token_store.BLOCK) + 1
    for a, b in ((0, 41), (7, 9), (40, 41), (5, 5)):
        file.ranges.clear()
        assert [x.tolist() for x in reader.documents(a, b)] == documents[a:b]
        # One range of the blocks that hold these documents, and no more.
        n = reader.ends[b] - reader.ends[a]
        assert sum(length for _, length in file.ranges) <= (n + 2 * token_store.BLOCK) * 5
    # Patches cost less than a width for all.
    small, wide = shard([ids.tolist()]), shard([ids.tolist()], 1.0)
    assert len(small.data) < len(wide.data)


def test_equal_ids_take_no_bits_and_foreign_files_are_refused():
    assert len(shard([[7] * 40_960]).data) < 1000
    with pytest.raises(ValueError, match="Not a file"):
        token_store.ShardReader(Memory(b"x" * 200))


def expected_ids(rows):
    """Documents by id (null first); the rows of an id in any order."""
    library, found, start = Tokenizer.from_file(BYTES), defaultdict(list), 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        found[doc_id].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return found


def test_token_files_of_odd_documents(spark, odd_docs, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    expected = expected_ids(rows)
    found = token_store.token_id_round_trip(odd_docs, BYTES, str(tmp_path / "ids")).collect()
    by_start = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == sorted(
        [r[0] for r in rows], key=lambda i: (i is not None, i or 0)
    )
    at = 0
    for row in by_start:
        assert row["start"] == at
        at += row["n_tokens"]
    for doc_id, lists in expected.items():
        assert sorted(lists) == sorted((r["n_tokens"], r["ids_crc32"]) for r in found if r["doc_id"] == doc_id)


def test_token_files_are_split_and_read_by_many_tasks(spark, docs, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randrange(400)))) for i in range(300)]
    rng.shuffle(rows)
    files = token_store.write_token_ids(docs(rows), BYTES, str(tmp_path / "ids"), shard_ids=5000)
    assert files.count() > 5
    read = token_store.read_token_ids(files, "bigint", split_ids=1000)
    library = Tokenizer.from_file(BYTES)
    start = 0
    for row, (doc_id, text) in zip(read.orderBy("start").collect(), sorted(rows)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (row["doc_id"], row["start"], row["ids"]) == (doc_id, start, ids)
        start += len(ids)
    empty = token_store.token_id_round_trip(docs([]), BYTES, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_token_files_of_text_ids(spark, tmp_path):
    df = spark.createDataFrame([("b", "x"), ("a", "y y")], "doc_id string, text string")
    found = token_store.token_id_round_trip(df, BYTES, str(tmp_path / "ids"))
    assert [r["doc_id"] for r in found.orderBy("start").collect()] == ["a", "b"]


# --- periodic runs ------------------------------------------------------------------------


def runs_by_force(words, least=12):
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            begin = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            if at + period - begin >= max(least, 2 * period):
                found.setdefault((begin, at + period), period)
            at += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def texts_with_runs(rng):
    """One text of a kind: random, Fibonacci, junctions of one period, planted, equal words."""
    kind, n = rng.randrange(8), rng.choice([0, 1, 11, 12, 13, 40, 150, 400, 900])
    if kind < 2:
        return [rng.randrange(kind + 2) for _ in range(n)]
    if kind == 2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 3:
        unit = [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
        many = unit * (n // (2 * len(unit)) + 2)
        return many[: n // 2 + rng.randrange(3)] + [rng.randrange(3)] * rng.randrange(2) + many[rng.randrange(len(unit)) : n // 2]
    if kind == 4:
        unit = [0] * rng.randrange(1, 40) + [1] + [0] * rng.randrange(40) + [rng.randrange(3)]
        return (unit * 30)[:n]
    if kind == 5:
        return [bin(i).count("1") % 2 for i in range(n)]
    words = [rng.randrange(100) for _ in range(n)]
    for _ in range(4 if n > 40 else 0):
        begin, period = rng.randrange(n - 20), rng.randrange(1, 200)
        for i in range(begin + period, min(n, begin + rng.randrange(12, 600))):
            words[i] = words[i - period]
    return words


@pytest.mark.parametrize("top", [3, 4, 14])
def test_runs_are_those_of_brute_force(top):
    rng = random.Random(top)
    for _ in range(60):
        texts = [texts_with_runs(rng) for _ in range(rng.randrange(1, 9))]
        finder = periodic_runs.RunFinder([np.array(t, np.int64) for t in texts], top)
        for text, found in zip(texts, finder.find()):
            assert list(zip(*(c.tolist() for c in found))) == runs_by_force(text)


def test_long_junction_has_a_run_for_every_lag():
    text = [0, 1] * 6000 + [1, 0] * 6000
    (start, length, period), = periodic_runs.RunFinder([np.array(text)]).find()
    assert period.tolist().count(2) == 2 and len(period) > 5000
    for s, n, q in list(zip(start.tolist(), length.tolist(), period.tolist()))[::500]:
        assert text[s : s + n - q] == text[s + q : s + n]


def collapsed_by_force(words, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def test_runs_of_odd_documents(spark, odd_docs, docs):
    cases = ["one two three four five six seven " * 9, "x " * 30 + "end", " a  \x1cb\x1c\n" * 8]
    more = odd_docs.select("doc_id", "text").unionByName(docs([(10 + k, t) for k, t in enumerate(cases)]).select("doc_id", "text"))
    found = rows_of(periodic_runs.periodic_runs(more.withColumn("runs", more["doc_id"]).withColumn("n_words", more["text"])))
    expected = []
    for row in more.collect():
        words = [w.decode() for w in (row["text"] or "").encode().split()]
        if len(words) > 5000:  # the long one: one word again and again, then others
            runs = [(0, 30_000, 1)]
            assert set(words[:30_000]) == {"word"} and words[30_000] != "word"
        else:
            runs = runs_by_force(words)
        expected.append((row["doc_id"], len(words), runs, collapsed_by_force(words, runs)))
    plain = [(d, n, [tuple(r) for r in runs], text) for d, n, runs, text in found]
    assert plain == sorted(expected, key=repr)
    assert periodic_runs.periodic_runs(docs([])).count() == 0


def planted_by_force(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_of_runs_is_brute_force(spark, tmp_path):
    import hashlib

    rng = random.Random(8)
    rows = [(i, " ".join(map(str, texts_with_runs(rng)))) for i in range(120)] + [(None, "a " * 20), (7, None), (7, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def hashed(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected, changed = [], 0
    for doc_id, text in rows:
        words = planted_by_force(doc_id, (text or "").split())
        changed += words != (text or "").split()
        runs = runs_by_force(words)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        first = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append((doc_id, len(runs), *first, hashed(lines), hashed(collapsed_by_force(words, runs))))
    assert changed > 3
    assert rows_of(found.select(*names)) == sorted(expected, key=repr)


# --- source divergence --------------------------------------------------------------------


def terms_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isalpha() and c.isascii() or ord(c) > 127 else " " for c in lowered).split(" ")


def divergence_by_force(rows, top=200):
    used, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [t for t in terms_of(text) if t]
        used[lang, source].update(terms)
        seen[lang].update(set(terms))
        groups[lang].add(source)
    found = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= 3]
        counts = {s: {t: used[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(counts[s][t] for s in sources) for t in kept}

        def shares(own):
            total = sum(own.values())
            return {t: 1 + 10**9 * (n + 1) // (total + len(kept)) for t, n in own.items()}

        share, of_lang = {s: shares(counts[s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [
                (sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o) for o in sources if o != s
            ]
            own = [
                ((share[s][t] - of_lang[t]) ** 2 // of_lang[t], t)
                for t in kept if counts[s][t] and share[s][t] > of_lang[t]
            ]
            for part, ranked in (("pair", pairs), ("term", own)):
                ranked.sort(key=lambda r: (-r[0], r[1].encode()))
                found += [
                    (lang, s, part, item, value, k + 1)
                    for k, (value, item) in enumerate(ranked) if part == "pair" or k < top
                ]
    return sorted(found, key=repr)


def test_shares_of_any_size_are_exact():
    n = np.array([0, 5, 9_000_000_001, 4 * 10**12])
    total = np.array([10, 7, 10**11, 10**15])
    assert divergence._shares(n, total).tolist() == [1 + 10**9 * (a + 1) // b for a, b in zip(n.tolist(), total.tolist())]


def test_divergence_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "MOST_TERMS", 5)
    monkeypatch.setattr(divergence, "slices", lambda bodies, size: [(k, k + 1) for k in range(len(bodies))])
    rng = random.Random(2)
    words = ["Straße", "İstanbul", "a", "ab", "abc", "abcdefgh", "abcdefghi", "x" * 70, "漢字" * 30, "don't", "Z9z", "é", "É"]
    rows = [
        (rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "", None]),
         " ".join(rng.choices(words[: rng.randrange(1, len(words) + 1)], k=rng.randrange(30))))
        for _ in range(60)
    ]
    rows += [("xx", "only", "alone alone alone"), ("xx", "two", "alone"), ("xx", "none", None), ("yy", "solo", "")]
    rows += [("en", "s1", "the same row")] * 3
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    clashing = df.selectExpr("*", "1 AS level", "2 AS item", "3 AS n", "4 AS p", "'q' AS body")
    assert rows_of(divergence.source_divergence(clashing)) == divergence_by_force(rows)
    assert rows_of(divergence.source_divergence(df, top=2)) == divergence_by_force(rows, 2)


def test_prefixes_are_counted_once_per_document_and_discarded(spark):
    """Ten terms of one beginning in two documents: a prefix of two, whatever its terms."""
    many = " ".join("abcdefgh" + chr(97 + k) + "tuvwxyzuvw" for k in range(10))
    rows = [("l", "s", many)] * 2 + [("l", "s", "abcdefghi cd"), ("l", "t", "cd cd"), ("l", "t", "cd")]
    counts = divergence._Counts()
    for lang, source, text in rows:
        counts.add([lang], [source], [text.encode()])
    counted = [batch.to_pylist() for batch in counts.batches()]
    prefixes = {(r["level"], r["item"]): r["n_docs"] for batch in counted[1:] for r in batch}
    assert prefixes.pop((0, b"abcdefgh")) == 3
    assert len(prefixes) == 10 and set(prefixes.values()) == {2}
    complete = {(r["source"], r["item"]): (r["level"], r["n"], r["n_docs"]) for r in counted[0]}
    assert complete["s", b"abcdefghi"] == (1, 1, 1)
    assert complete["s", b"abcdefghatuvwxyzuvw"] == (2, 2, 2)
    assert complete["t", b"cd"] == (0, 3, 2)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert rows_of(divergence.source_divergence(df)) == divergence_by_force(rows)


def test_divergence_of_no_documents(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


# --- packing ------------------------------------------------------------------------------


def test_pack_carries_columns_of_any_name(spark):
    rows = [(k, 1 + k % 7, k, k, k, k, k) for k in range(50)]
    df = spark.createDataFrame(rows, "rank int, length int, task int, place int, sequence_id int, before int, piece int")
    packed = packing.pack(df, 8)
    assert packed.columns == ["rank", "length", "task", "place", "before", "piece", "sequence_id", "offset"]
    taken = defaultdict(list)
    for r in packed.collect():
        assert r["rank"] == r["task"] == r["place"] == r["before"] == r["piece"]
        taken[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in taken.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 8
