"""Subword ids of whole texts, equal to the tokenizers library's, at a fraction of its time.

A byte-level BPE file whose ids follow its merges says the same as a table of ranks, and the
tiktoken library encodes from ranks several times faster. Texts that hold one of the file's
added strings, which the tokenizers library takes apart first, and files of any other kind
go through the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np


def slices(texts: list, size: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of the list whose texts have about so many characters together."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class IdTable:
    """Id lists under consecutive numbers, in one growing array."""

    def __init__(self) -> None:
        self.flat = np.empty(1 << 16, np.int32)
        self.used = 0
        self.starts: list[int] = []
        self.lengths: list[int] = []

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Add lists that stand one after the other; the number of the first."""
        end = self.used + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), len(ids)), np.int32)])
        self.flat[self.used : end] = ids
        first = len(self.starts)
        self.starts.extend((self.used + np.cumsum(lengths) - lengths).tolist())
        self.lengths.extend(lengths.tolist())
        self.used = end
        return first

    def add_one(self, ids: list[int]) -> int:
        return self.add(np.array(ids, np.int32), np.array([len(ids)]))

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered lists, and the lengths of the lists."""
        lengths = np.array(self.lengths, np.int64)[numbers]
        starts = np.array(self.starts, np.int64)[numbers]
        return self.flat[ragged(starts, lengths)], lengths


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """Rank of each token's bytes in a tokenizers file; None if ranks cannot stand for it."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, splitter = content["model"], content.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and content.get("normalizer") is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
    )
    if not plain:
        return None
    vocabulary = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in pairs]
    added = {t["content"] for t in content["added_tokens"]}
    alphabet = byte_alphabet()
    tokens = {t: i for t, i in vocabulary.items() if t not in added}
    if made != sorted(set(made)) or not set("".join(tokens)) <= alphabet.keys():
        return None
    ranks = {bytes(alphabet[c] for c in t): i for t, i in tokens.items()}
    # Every token but the bytes themselves comes from one merge, later than all bytes.
    if len(ranks) != len(made) + 256 or min(made, default=256) < 256:
        return None
    return ranks


class TextEncoder:
    """Encodes batches of texts with a file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings that the library treats apart, wherever they stand in a text.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = byte_ranks(path)
        self.ranked = None
        if ranks is not None:
            self.ranked = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def _one(self, text: str) -> list[int]:
        if self.ranked is None or any(s in text for s in self.added):
            return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self.ranked.encode_ordinary(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        lists = [self._one(text) for text in texts]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())), lengths


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker process's encoder for a file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
