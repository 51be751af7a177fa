"""Token ids of whole texts, through a table of the words seen by the worker.

The tokenizer never joins bytes across ASCII white space, so a text's ids are
the ids of its words in a row.  Each distinct word is given to the tokenizer
once per worker; texts are then gathered from the table of word ids.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from claimflow.llm.words import Words, word_hashes

TOKENIZER = "word_bpe_49k.json"
WORDS_KEPT = 1_500_000   # of a worker's table (about 40 bytes each); it starts anew beyond that
RECENT = 100_000         # words learnt since the table was last sorted
MARK = "\x01"            # stands between words that are given to the tokenizer together


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Encodes slices of texts; holds the word table.

    Slot k of the table is ``ids[offsets[k]:offsets[k + 1]]``; words find their slot
    by their hash in two sorted lists, a large one and that of recent words.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        [self.mark] = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.ids = np.zeros(1 << 16, np.uint32)
        self.offsets = np.zeros(1 << 14, np.int64)
        self.size = 0
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.old, self.recent = none, none

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, -1 for an unknown word."""
        out = np.full(len(hashes), -1)
        for keys, slots in (self.old, self.recent):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[at] == hashes, slots[at], out)
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Give new words to the tokenizer, many in one text with marks between them."""
        plain = [k for k, w in enumerate(words) if MARK not in w]
        order = np.array(plain + [k for k, w in enumerate(words) if MARK in w], np.int64)
        found, lengths = [], []
        for lo in range(0, len(plain), 1000):
            text = f" {MARK} ".join(words[k] for k in plain[lo:lo + 1000])
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            lengths.append(np.diff(ends, prepend=-1) - 1)
            found.append(ids[ids != self.mark])
        for k in order[len(plain):]:
            ids = self.tokenizer.encode(words[k], add_special_tokens=False).ids
            found.append(np.array(ids, np.uint32))
            lengths.append(np.array([len(ids)]))
        all_ids, all_lengths = np.concatenate(found), np.concatenate(lengths)
        n, a = self.size, int(self.offsets[self.size])
        b = a + len(all_ids)
        while n + len(words) + 1 > len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        while b > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[a:b] = all_ids
        self.offsets[n + 1:n + 1 + len(words)] = a + np.cumsum(all_lengths)
        self.size += len(words)
        added = hashes[order], np.arange(n, self.size)
        self.recent = _merged(self.recent, added)
        if len(self.recent[0]) > RECENT:
            self.old, self.recent = _merged(self.old, self.recent), (added[0][:0], added[1][:0])

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of the slice, where each text's ids begin)."""
        if self.size > WORDS_KEPT:
            self._clear()
        distinct, at, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        found = self._slots(distinct)
        new = np.flatnonzero(found < 0)
        if len(new):
            spots = at[new]
            self._learn(distinct[new], [words.data[a:b].tobytes().decode("utf-8", "replace") for a, b in
                                        zip(words.starts[spots].tolist(), words.ends[spots].tolist(), strict=True)])
            found = self._slots(distinct)
        slots = found[inverse]
        begin = self.offsets[slots]
        lengths = self.offsets[slots + 1] - begin
        until = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(begin - until[:-1], lengths) + np.arange(until[-1])
        return self.ids[take], until[words.first]


def _merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, slots = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
    order = np.argsort(keys, kind="stable")
    return keys[order], slots[order]


@lru_cache(maxsize=1)
def shared_encoder(path: str | None = None) -> Encoder:
    """The worker process' encoder: the next task finds its word table filled."""
    return Encoder(path)


def encoded(encoder: Encoder, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of each text of a column, in order."""
    for words in word_hashes(texts):
        ids, first = encoder.encode(words)
        for k in range(words.hi - words.lo):
            yield words.lo + k, ids[first[k]:first[k + 1]]
