"""Benchmark decontamination by the q-gram lemma.

A passage is any run of 120 characters of a benchmark item, at whatever offset; a shorter item
is one passage. Where a passage of m characters occurs with at most k edits, it shares at least
``m - q + 1 - k * q`` q-grams with that place, on diagonals that differ by at most k. The
q-grams of whole items are counted in diagonal bands of twice the width k + 1, each overlapping
the next by half, so one band holds them all. Every start in the item from which a passage
reaches the bound within its band is aligned within those diagonals, which decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, map_batches, mix64

Q = 16
EDIT_RATE = 0.04

# Characters of a passage; one starts at every offset of an item, shorter items are whole.
PASSAGE = 120

# A block of the benchmark is searched at a time; only one is in memory.
BLOCK_CHARS = 4_000_000

# Passages that are aligned at a time.
ALIGNED_AT_ONCE = 8192

_TABLE_BITS = 22
_BLANK = 32


def _folding() -> np.ndarray:
    """Lower case and plain blanks for the scripts that have cases."""
    table = np.arange(0x3000, dtype=np.uint32)
    for code in range(0x3000):
        char = chr(code)
        low = char.lower()
        if char.isspace():
            table[code] = _BLANK
        elif len(low) == 1:
            table[code] = ord(low)
    return table


_FOLD = _folding()


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points with runs of blanks as one, and each one's place in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(codes < len(_FOLD), _FOLD[np.minimum(codes, len(_FOLD) - 1)], codes)
    blank = codes == _BLANK
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    places = np.flatnonzero(keep)
    return codes[places], places


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash for each run of ``q`` codes, by doubling."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    size = len(codes) - q + 1
    power = codes.astype(np.uint64)
    power *= np.uint64(0x9E3779B97F4A7C15)
    total, done, width = None, 0, 1
    while True:
        if q & width:
            piece = power[done : done + size]
            if total is None:
                total = piece.copy()
            else:
                total = total * np.uint64(0xD6E8FEB86659FD93) + piece
            done += width
        if done == q:
            return total
        power = power[:-width] * np.uint64(0xA0761D6478BD642F + 2 * width) + power[width:]
        width *= 2


class GramIndex:
    """Every q-gram of some of the items, by its hash."""

    def __init__(self, q: int, whole: list[np.ndarray], chosen: np.ndarray):
        self.q = q
        grams = [gram_hashes(whole[i], q) for i in chosen.tolist()]
        count = [len(g) for g in grams]
        hashes = np.concatenate([*grams, np.zeros(0, dtype=np.uint64)])
        item = np.repeat(chosen, count).astype(np.int32)
        place = np.concatenate([*map(np.arange, count), np.zeros(0, dtype=np.int64)])
        order = np.argsort(hashes, kind="stable")
        self.item, self.place = item[order], place[order].astype(np.int32)
        self.hashes, self.first, self.times = np.unique(
            hashes[order], return_index=True, return_counts=True
        )
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``codes``, item, place in the item) of every shared q-gram."""
        hashes = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.table[self._slot(hashes)])
        found = np.searchsorted(self.hashes, hashes[at])
        found = np.minimum(found, len(self.hashes) - 1)
        same = self.hashes[found] == hashes[at]
        at, found = at[same], found[same]
        times = self.times[found]
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.first[found], times) + nth
        return np.repeat(at, times), self.item[entry].astype(np.int64), self.place[entry].astype(np.int64)


@dataclass
class Patterns:
    """The items of a block, folded, and the index of their q-grams."""

    items: list
    whole: list[np.ndarray]
    short: list[tuple[object, str]]

    def __post_init__(self) -> None:
        self.size = np.array([len(c) for c in self.whole], dtype=np.int64)
        self.length = np.minimum(self.size, PASSAGE)
        self.budget = (self.length * EDIT_RATE).astype(np.int64)
        # Where the edits could break every q-gram, smaller ones are left over by the lemma.
        sure = self.length - Q + 1 - self.budget * Q >= 1
        smaller = (self.length // (self.budget + 1))[~sure].min(initial=Q)
        self.q = np.where(sure, Q, smaller)
        self.bound = self.length - self.q + 1 - self.budget * self.q
        self.first = np.cumsum(self.size) - self.size
        self.joined = np.concatenate([*self.whole, np.zeros(1, dtype=np.uint32)])
        # Added to diagonals, so that even the band below the first is positive.
        self.reach = int(self.size.max(initial=0)) + 2 * PASSAGE
        self.indexes = [
            GramIndex(int(q), self.whole, np.flatnonzero(self.q == q)) for q in np.unique(self.q)
        ]

    @property
    def codes(self) -> list[np.ndarray]:
        """All passages. They are many, so the search never lists them."""
        return [
            c[start : start + PASSAGE]
            for c in self.whole
            for start in range(max(len(c) - PASSAGE, 0) + 1)
        ]

    @property
    def edits(self) -> np.ndarray:
        """The edits that each passage may have."""
        return np.repeat(self.budget, self.size - self.length + 1)


def patterns_of(items: list[tuple[object, str | None]]) -> Patterns:
    """Items without characters have no passage; those below q characters are sought as whole
    words without edits."""
    ids, whole, short = [], [], []
    for item, text in items:
        folded = fold((text or "").strip())[0]
        folded = folded[folded != 0]
        if not len(folded):
            continue
        if len(folded) < Q:
            short.append((item, folded.tobytes().decode("utf-32-le")))
            continue
        ids.append(item)
        whole.append(folded)
    return Patterns(ids, whole, short)


def _starts(
    patterns: Patterns, index: GramIndex, codes: np.ndarray, owner: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(item, start in the item, band, text) of the passages that reach their bound in a band."""
    at, item, place = index.shared(codes)
    if not len(at):
        return (np.zeros(0, dtype=np.int64),) * 4
    band = (at - place + patterns.reach) // (patterns.budget[item] + 1)
    most = int(band.max()) + 2
    texts = int(owner[-1]) + 1
    key = (item * most + band) * texts + owner[at]
    key = np.concatenate([key, key - texts])
    keys, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    enough = (counts >= patterns.bound[keys // (most * texts)])[inverse]
    key, place = key[enough], np.concatenate([place, place])[enough]
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    # Of q-grams in order, a passage needs as many as its bound within its length.
    item = key // (most * texts)
    last = np.arange(len(key)) + patterns.bound[item] - 1
    inside = last < len(key)
    last = np.minimum(last, len(key) - 1)
    lowest = np.maximum(place[last] - (patterns.length[item] - index.q), 0)
    highest = np.minimum(place, (patterns.size - patterns.length)[item])
    inside &= (key[last] == key) & (lowest <= highest)
    key, lowest, highest = key[inside], lowest[inside], highest[inside]
    # Both ends grow along a band, so what the range before holds is cut off.
    follows = key[1:] == key[:-1]
    lowest[1:] = np.where(follows, np.maximum(lowest[1:], highest[:-1] + 1), lowest[1:])
    count = np.maximum(highest - lowest + 1, 0)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    key, start = np.repeat(key, count), np.repeat(lowest, count) + nth
    rest = key % (most * texts)
    return key // (most * texts), start, rest // texts, rest % texts


def _verbatim(
    patterns: Patterns,
    codes: np.ndarray,
    item: np.ndarray,
    begin: np.ndarray,
    band: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
) -> np.ndarray:
    """The first place in its band where each passage stands without an edit, or -1."""
    k, length = patterns.budget[item], patterns.length[item]
    across = np.arange(int(length.max()))
    own = patterns.first[item] + begin
    own = patterns.joined[np.minimum(own[:, None] + across, len(patterns.joined) - 1)]
    beyond = across >= length[:, None]
    found = np.full(len(item), -1, dtype=np.int64)
    for step in range(2 * (int(k.max()) + 1)):
        start = begin + band * (k + 1) - patterns.reach + step
        todo = (found < 0) & (step < 2 * (k + 1)) & (start >= low) & (start + length <= high)
        todo = np.flatnonzero(todo)
        # Most differ at once.
        todo = todo[codes[start[todo]] == own[todo, 0]]
        there = codes[np.minimum(start[todo][:, None] + across, len(codes) - 1)]
        same = ((there == own[todo]) | beyond[todo]).all(axis=1)
        found[todo[same]] = start[todo[same]]
    return found


def _align(
    patterns: Patterns,
    codes: np.ndarray,
    item: np.ndarray,
    begin: np.ndarray,
    band: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits of each passage within its band, start and end of that place.

    All candidates advance together, a row of every matrix at a time; those over their budget
    are left. A cell holds edits and start in one number, so the smaller start wins ties.
    ``low`` and ``high`` bound the text.
    """
    k = patterns.budget[item]
    width = int((2 * (k + 1)).max() + 2 * k.max()) + 1
    start = begin + band * (k + 1) - patterns.reach - k
    own = patterns.first[item] + begin
    length = patterns.length[item]
    one = np.int64(1) << np.int64(40)
    never = one * (1 << 20)
    across = np.arange(width, dtype=np.int64)
    place = start[:, None] + across
    fits = (place >= low[:, None]) & (place <= high[:, None])
    cells = np.where(fits, place - low[:, None], never)
    best = np.full(len(item), never)
    end = np.zeros(len(item), dtype=np.int64)
    first = low
    alive = np.arange(len(item))
    for row in range(1, int(length.max()) + 1):
        here = place + row - 1  # the text's character that this row's match would use
        inside = (here >= low[:, None]) & (here < high[:, None])
        char = codes[np.clip(here, 0, len(codes) - 1)]
        mine = patterns.joined[np.minimum(own + row - 1, len(patterns.joined) - 1)]
        equal = inside & (char == mine[:, None])
        match = np.where(inside, cells + np.where(equal, 0, one), never)
        skipped = np.full_like(cells, never)
        skipped[:, :-1] = cells[:, 1:] + one
        reach = (place + row >= low[:, None]) & (place + row <= high[:, None])
        cells = np.where(reach, np.minimum(match, skipped), never)
        cells = np.minimum.accumulate(cells - across * one, axis=1) + across * one
        cells = np.where(reach, np.minimum(cells, never), never)
        done = length == row
        if done.any():
            column = cells[done].argmin(axis=1)
            best[alive[done]] = cells[done][np.arange(len(column)), column]
            end[alive[done]] = start[done] + column + row
        if row % 8 == 0:
            stay = (length > row) & (cells.min(axis=1) // one <= k)
            if not stay.any():
                break
            if not stay.all():
                alive, cells, place, start = alive[stay], cells[stay], place[stay], start[stay]
                low, high, own, length, k = low[stay], high[stay], own[stay], length[stay], k[stay]
    return best // one, best % one + first, end


def find_in_texts(patterns: Patterns, texts: list[str | None]) -> list[tuple]:
    """(text number, item, regions, fewest edits, start, end) for each text and item.

    Regions are the places of the text that passages cover, those that overlap as one. Offsets
    are code points of the original text.
    """
    folded = [fold(text or "") for text in texts]
    sizes = np.array([len(codes) + 1 for codes, _ in folded], dtype=np.int64)
    ends = np.cumsum(sizes)
    zero = np.zeros(1, dtype=np.uint32)
    codes = np.concatenate([part for c, _ in folded for part in (c, zero)] + [zero])
    owner = np.append(np.repeat(np.arange(len(texts)), sizes), max(len(texts) - 1, 0))
    hits: dict[tuple, list] = {}

    def hit(text: int, item: object, regions: int, edits: int, start: int, end: int) -> None:
        known = hits.setdefault((text, item), [0, edits, start, end])
        known[0] += regions
        known[1] = min(known[1], edits)
        known[2] = min(known[2], start)
        known[3] = max(known[3], end)

    found = []
    for index in patterns.indexes:
        every = _starts(patterns, index, codes, owner)
        for at in range(0, len(every[0]), ALIGNED_AT_ONCE):
            item, begin, band, text = (x[at : at + ALIGNED_AT_ONCE] for x in every)
            high = ends[text] - 1
            low = ends[text] - sizes[text]
            start = _verbatim(patterns, codes, item, begin, band, low, high)
            end = start + patterns.length[item]
            edits = np.zeros(len(item), dtype=np.int64)
            rest = np.flatnonzero(start < 0)
            if len(rest):
                edits[rest], start[rest], end[rest] = _align(
                    patterns, codes, *(x[rest] for x in (item, begin, band, low, high))
                )
            held = edits <= patterns.budget[item]
            found.append(np.stack([text, item, start, end, edits])[:, held])
    found = np.concatenate([np.zeros((5, 0), dtype=np.int64), *found], axis=1)
    if found.shape[1]:
        text, item, start, end, edits = found[:, np.lexsort(found[2::-1])]
        opens = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]))
        group = np.cumsum(opens) - 1
        covered = np.maximum.accumulate(end + group * len(codes)) - group * len(codes)
        apart = opens.copy()
        apart[1:] |= start[1:] >= covered[:-1]
        first = np.flatnonzero(opens)
        regions = np.add.reduceat(apart.astype(np.int64), first)
        fewest, last = np.minimum.reduceat(edits, first), np.maximum.reduceat(end, first)
        for i, g in enumerate(first.tolist()):
            n = int(text[g])
            low, places = ends[n] - sizes[n], folded[n][1]
            hit(n, patterns.items[item[g]], int(regions[i]), int(fewest[i]),
                int(places[start[g] - low]), int(places[last[i] - low - 1]) + 1)
    if patterns.short:
        for n, (own, places) in enumerate(folded):
            plain = own.tobytes().decode("utf-32-le", "surrogatepass")
            for item, words in patterns.short:
                at = plain.find(words)
                while at >= 0:
                    stop = at + len(words)
                    if not plain[at - 1 : at].isalnum() and not plain[stop : stop + 1].isalnum():
                        hit(n, item, 1, 0, int(places[at]), int(places[stop - 1]) + 1)
                    at = plain.find(words, at + 1)
    return [(n, item, *found) for (n, item), found in hits.items()]


def benchmark_blocks(benchmark: DataFrame) -> Iterator[Patterns]:
    """The benchmark's patterns, a bounded block of items at a time."""
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield patterns_of(sorted(map(tuple, mine.collect()), key=lambda r: (r[0] is None, r)))


_HITS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("n_regions", pa.int64()),
        ("n_edits", pa.int64()),
        ("match_start", pa.int64()),
        ("match_end", pa.int64()),
    ]
)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item of which it holds a passage.

    Case and runs of blanks do not matter; a passage may start anywhere in the item and have
    4 % edits. ``match_start`` and
    ``match_end`` span all of the item's passages in the text. Null and empty texts match
    nothing, null and empty items are in nothing, repeated documents are reported each, and a
    repeated item is found once more under its own id. Documents are never shuffled.
    """
    spark = docs.sparkSession
    result = None
    for patterns in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(patterns)  # a block, so its size is bounded

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                found = find_in_texts(shared.value, texts)
                yield batch_of([(ids[n], *rest) for n, *rest in found], _HITS)

        hits = map_batches(
            docs.select("doc_id", "text"),
            search,
            "doc_id long, item_id long, n_regions long, n_edits long, match_start long,"
            " match_end long",
        )
        result = hits if result is None else result.unionByName(hits)
    if result is None:
        return spark.createDataFrame([], "doc_id long, item_id long, n_regions long,"
                                         " n_edits long, match_start long, match_end long")  # fmt: skip
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no passage of any item, with all their columns."""
    text_at = docs.columns.index("text")
    for patterns in benchmark_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(patterns)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(text_at).to_pylist()
                keep = np.ones(len(texts), dtype=bool)
                for n, *_ in find_in_texts(shared.value, texts):
                    keep[n] = False
                yield batch.filter(pa.array(keep))

        docs = map_batches(docs, clean, docs.schema)
    return docs
