"""Counts of word sequences in a trie of word codes with burstable hash containers.

A sequence is one number: 32 bits for each word's code, the first word lowest. The trie's
levels take eight bits each from the low end; the rest is a key in a hash container, which is
replaced by 256 smaller ones when it grows too large. The lowest eight bits of a code come
from the word's hash, so a subtree of the root holds the sequences of the same first words in
every task, whatever numbers the tasks have given their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

# Entries of a container before it bursts, and levels below which it only grows.
BURST = 8192
DEPTH = 4
CODE_BITS = 32

Container = dict[int, int]


class Vocabulary(dict):
    """Numbers of words from 1 on; 0 for a break between pieces and for words left out."""

    def __init__(self, allowed=None):
        super().__init__({b"\xff": 0})
        self.allowed = allowed
        self.words = [b""]
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        digest = xxhash.xxh64_intdigest(word, seed=42)
        number = 0
        if self.allowed is None or self.allowed(digest):
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(digest)
        self[word] = number
        return number

    def codes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and hashes of words by their numbers."""
        hashes = np.array(self.hashes, dtype=np.uint64)[numbers]
        return (numbers.astype(np.uint64) << np.uint64(8)) | (hashes & np.uint64(255)), hashes


class PhraseTrie:
    """Counts of sequences of at most ``longest`` words, four at most."""

    def __init__(self, longest: int = 4, burst: int = BURST):
        self.longest, self.burst = longest, burst
        self.root: list = [{} for _ in range(256)]

    def __len__(self) -> int:
        return sum(map(_size, self.root))

    def add(self, keys: list[int], counts: list[int]) -> None:
        root, burst = self.root, self.burst
        for key, count in zip(keys, counts, strict=True):
            node, at, rest = root[key & 255], key & 255, key >> 8
            holder, depth = root, 1
            while type(node) is list:
                holder, at = node, rest & 255
                node, rest, depth = node[at], rest >> 8, depth + 1
            if rest in node:
                node[rest] += count
            else:
                node[rest] = count
                if len(node) > burst and depth < DEPTH:
                    holder[at] = _burst(node)

    def spill(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Take whole subtrees of the root out, the largest first, until ``most`` entries are
        left: low and high halves of their sequences, and the counts."""
        sizes = [_size(node) for node in self.root]
        left = sum(sizes)
        for digit in sorted(range(256), key=sizes.__getitem__, reverse=True):
            if left <= most or not sizes[digit]:
                return
            left -= sizes[digit]
            node, self.root[digit] = self.root[digit], {}
            yield from self._entries(node, digit, 8)

    def _entries(self, node, prefix: int, bits: int) -> Iterator[tuple]:
        if type(node) is list:
            for digit, child in enumerate(node):
                if child:
                    yield from self._entries(child, prefix | digit << bits, bits + 8)
        elif node:
            counts = np.fromiter(node.values(), np.int64, len(node))
            if self.longest <= 2:
                low = np.fromiter(node, np.uint64, len(node))
                low = (low << np.uint64(bits)) | np.uint64(prefix)
                yield low, np.zeros(len(low), np.uint64), counts
            else:
                keys = [key << bits | prefix for key in node]
                low = np.array([key & _HALF for key in keys], dtype=np.uint64)
                high = np.array([key >> 64 for key in keys], dtype=np.uint64)
                yield low, high, counts


_HALF = (1 << 64) - 1


def _size(node) -> int:
    return sum(map(_size, node)) if type(node) is list else len(node)


def _burst(container: Container) -> list:
    children: list = [{} for _ in range(256)]
    for key, count in container.items():
        children[key & 255][key >> 8] = count
    return children


def sequences(
    codes: np.ndarray, joined: np.ndarray, sizes: tuple[int, ...]
) -> tuple[list[int], list[int]]:
    """The distinct sequences of ``sizes`` words in a row of codes, and their counts.

    A sequence holds no code 0, and ``joined`` is true between each two of its words.
    """
    keys: list[int] = []
    counts: list[int] = []
    places = np.flatnonzero(codes)
    low = high = np.zeros(0, dtype=np.uint64)
    # Number the distinct beginnings, a word longer at a time.
    for i in range(max(sizes)):
        if i:
            goes_on = places + i < len(codes)
            places, inverse = places[goes_on], inverse[goes_on]
            goes_on = (codes[places + i] != 0) & joined[places + i - 1]
            places, inverse = places[goes_on], inverse[goes_on]
            pair = (inverse.astype(np.uint64) << np.uint64(CODE_BITS)) | codes[places + i]
        else:
            pair = codes[places]
        if not len(places):
            break
        distinct, inverse, n = np.unique(pair, return_inverse=True, return_counts=True)
        last = distinct & np.uint64(0xFFFFFFFF)
        before = (distinct >> np.uint64(CODE_BITS)).astype(np.int64)
        if i == 0:
            low, high = last, np.zeros(len(last), dtype=np.uint64)
        elif i == 1:
            low, high = low[before] | last << np.uint64(CODE_BITS), high[before]
        else:
            low, high = low[before], high[before] | last << np.uint64(CODE_BITS * (i - 2))
        if i + 1 in sizes:
            # Those of one container after each other, which is kinder to the caches.
            order = np.argsort(low.astype(np.uint16), kind="stable")
            if i < 2:
                keys += low[order].tolist()
            else:
                halves = zip(low[order].tolist(), high[order].tolist(), strict=True)
                keys += [a | b << 64 for a, b in halves]
            counts += n[order].tolist()
    return keys, counts
