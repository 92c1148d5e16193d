"""Counting, packing and byte-level BPE against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerspark.llm import byte_bpe, packing, pieces, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = st.sampled_from(
    [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\xa0", "'s", "'ll", "'", "a", "The", "é", "ΑΣ", "1", "²",
     "!", ".", ",", "?.", "漢", "😀", "́", "<|endoftext|>", "s", "re", "x" * 90]
)
TEXTS = st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=8)


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(RANKS)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={}
    )


def split(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if len(counts) else []


@settings(max_examples=200, deadline=None)
@given(texts=TEXTS)
def test_byte_bpe_is_the_library(bpe, library, texts):
    ids, counts = bpe.encode(texts)
    assert split(ids, counts) == [library.encode_ordinary(t) for t in texts]
    assert bpe.decode(ids, counts) == [t.encode() for t in texts]
    offsets = split(bpe.offsets(ids, counts), counts)
    for text, own, at in zip(texts, split(ids, counts), offsets):
        data = text.encode()
        for i, a, b in zip(own, at, [*at[1:], len(data)]):
            assert library.decode_single_token_bytes(i) == data[a:b]


def test_every_code_point_has_the_class_the_pattern_gives_it(bpe, library):
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1{chr(c)}!" for c in points]
    ids, counts = bpe.encode(texts)
    assert split(ids, counts) == [library.encode_ordinary(t) for t in texts]


def test_scan_is_the_stepwise_composition():
    machine = byte_bpe.automaton()
    rng = np.random.default_rng(1)
    functions = machine.generator[rng.integers(0, 9, 5000)]
    done, expected = machine.prefix(functions, 7), 0
    for k, f in enumerate(functions.tolist()):
        expected = int(machine.compose[expected * machine.size + f])
        assert done[k] == expected


def test_long_piece_and_small_cache(library):
    small = byte_bpe.ByteBpe(RANKS, max_pieces=2)
    rng = random.Random(4)
    texts = ["".join(rng.choices("abtheing", k=20_000)), "the " * 5000]
    for text in texts:
        ids, counts = small.encode([text])
        assert ids.tolist() == library.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(texts=TEXTS)
def test_ranks_are_the_library(texts):
    coder = pieces.encoder(BYTES)
    assert coder.ranked is not None
    reference = coder.tokenizer
    ids, counts = coder.encode(texts)
    assert split(ids, counts) == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_ranks_are_the_library_for_every_character():
    """Both libraries split texts by the classes of characters: the same for all of them."""
    coder = pieces.encoder(BYTES)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 500):
        text = "".join(f"x{chr(c)}1{chr(c)} " for c in points[a : a + 500])
        assert coder.ranked.encode_ordinary(text) == coder.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


def test_other_files_go_through_the_library():
    assert pieces.byte_ranks(WORDS) is None
    coder = pieces.TextEncoder(WORDS)
    ids, counts = coder.encode(["Hello  there", ""])
    assert ids.tolist() == Tokenizer.from_file(WORDS).encode("Hello  there", add_special_tokens=False).ids
    assert counts[1] == 0


@settings(max_examples=150, deadline=None)
@given(texts=TEXTS)
def test_word_counts_are_the_library(texts):
    counter = token_counts.WordCounter(WORDS, max_words=5)
    reference = Tokenizer.from_file(WORDS)
    for _ in range(2):
        assert counter.count([t.encode() for t in texts]) == [
            len(reference.encode(t, add_special_tokens=False).ids) for t in texts
        ]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_token_counts_of_odd_documents_and_of_none(spark, docs, odd_docs, tmp_path):
    reference = Tokenizer.from_file(WORDS)
    expected = []
    for row in odd_docs.collect():
        text = row["text"] or ""
        n = len(reference.encode(text, add_special_tokens=False).ids)
        expected.append((row["doc_id"], len(text.encode()), n, n > 2048))
    found = token_counts.token_counts(odd_docs, WORDS, str(tmp_path / "c"))
    assert rows_of(found) == sorted(expected, key=repr)
    assert token_counts.token_counts(docs([]), WORDS, str(tmp_path / "d")).count() == 0


def test_only_distinct_misses_are_encoded(spark, docs, tmp_path):
    cache = str(tmp_path / "cache")

    def stored():
        return spark.read.parquet(f"{cache}/tokenizer={token_counts.tokenizer_version(WORDS)}").count()

    first = docs([(1, "a b c"), (2, "a  b\nc"), (3, "x")])
    token_counts.token_counts(first, WORDS, cache).collect()
    assert stored() == 2
    second = docs([(4, "a b c"), (5, "new text"), (6, "new text")])
    found = token_counts.token_counts(second, WORDS, cache)
    assert [r["n_tokens"] for r in found.orderBy("doc_id").collect()] == [3, 2, 2]
    assert stored() == 3


def test_round_trip_of_odd_documents(spark, docs, odd_docs, library):
    expected = []
    for row in odd_docs.collect():
        text = row["text"] or ""
        ids = np.array(library.encode_ordinary(text), "<u4")
        expected.append(
            (row["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
             hashlib.sha256(text.encode()).hexdigest())
        )
    assert rows_of(byte_bpe.round_trip_digests(odd_docs, RANKS)) == sorted(expected, key=repr)
    encoded = byte_bpe.byte_bpe(odd_docs, RANKS)
    back = byte_bpe.decode(encoded, RANKS)
    texts = sorted((r["doc_id"], (r["text"] or "").encode()) for r in odd_docs.collect() if r["doc_id"])
    assert sorted((r["doc_id"], bytes(r["content"])) for r in back.collect() if r["doc_id"]) == texts
    assert byte_bpe.byte_bpe(docs([]), RANKS).count() == 0


def unpacked(rows, capacity):
    """Check that sequences are gapless and within the capacity; how many there are."""
    sequences = {}
    for offset, length, sequence in rows:
        sequences.setdefault(sequence, []).append((offset, length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@settings(max_examples=100, deadline=None)
@given(sizes=st.lists(st.integers(1, 40), max_size=80))
def test_plan_places_every_piece(sizes):
    histogram = {s: sizes.count(s) for s in set(sizes)}
    plan = packing.plan_packing(histogram, 40)
    a = plan.arrays()
    rows = []
    for s, n in histogram.items():
        own = a["size"] == s
        for rank in range(n):
            k = np.flatnonzero(own)[np.searchsorted(a["rank"][own], rank, "right") - 1]
            nth = rank - a["rank"][k]
            rows.append((a["offset"][k] + nth % a["each"][k] * s, s, a["sequence"][k] + nth // a["each"][k]))
    assert unpacked(rows, 40) == plan.sequences
    # No worse than first-fit's bound, and two small bins never stay half empty.
    assert plan.sequences <= max(1, 2 * sum(sizes) // 40 + 1) or not sizes


def test_pairs_are_matched_where_they_fit():
    # Three of 60 and three of 40 make three full sequences; 35 goes nowhere else.
    assert packing.plan_packing({60: 3, 40: 3, 35: 1}, 100).sequences == 4
    assert packing.plan_packing({50: 5}, 100).sequences == 3
    assert packing.plan_packing({}, 100).sequences == 0


def test_packing_of_odd_documents(spark, docs, odd_docs):
    reference = Tokenizer.from_file(BYTES)
    found = packing.pack_documents(odd_docs, BYTES, capacity=64).collect()
    expected = []
    for row in odd_docs.collect():
        ids = [*reference.encode(row["text"] or "", add_special_tokens=False).ids, 0]
        at, n = 0, len(ids)
        while at < n:
            end = n if n <= 64 else at + (n % 64 or 64 if at == 0 else 64)
            data = np.array(ids[at:end], "<u4").tobytes()
            expected.append((row["doc_id"], at, end - at, zlib.crc32(data), tuple(ids[at:end])))
            at = end
    got = [(r["doc_id"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    total = sum(r["length"] for r in found)
    assert unpacked([(r["offset"], r["length"], r["sequence_id"]) for r in found], 64) <= total // 64 + 2
    assert packing.pack_documents(docs([]), BYTES).count() == 0


def test_lengths_beyond_the_capacity_are_refused(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(9,)], "length bigint"), capacity=8)
