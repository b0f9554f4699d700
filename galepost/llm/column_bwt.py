"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

Round t adds the suffix of length t of every text: the symbol before the last suffix goes to
that suffix's row, and the new suffix's row follows from how often the symbol stands above.
The transform, the common prefixes and the suffixes' names are sequential files that each
round reads once and writes once; a file shorter than its buffer stays in memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

# Rows of a file that are in memory at a time, and bytes up to which a file is not on disk.
BLOCK_ROWS = 1 << 21
BUFFER_BYTES = 1 << 25

_STEP = 256


class ColumnFile:
    """A sequence of numbers, written once and then read in blocks from its start."""

    def __init__(self, dtype: type, folder: str | None = None):
        self.dtype = np.dtype(dtype)
        self.rows = 0
        self.file = tempfile.SpooledTemporaryFile(max_size=BUFFER_BYTES, dir=folder)

    def write(self, values: np.ndarray) -> None:
        self.file.write(np.ascontiguousarray(values, dtype=self.dtype).data)
        self.rows += len(values)

    def blocks(self, size: int) -> Iterator[tuple[int, np.ndarray]]:
        self.file.seek(0)
        for start in range(0, self.rows, size):
            count = min(size, self.rows - start)
            data = self.file.read(count * self.dtype.itemsize)
            yield start, np.frombuffer(data, dtype=self.dtype)

    def close(self) -> None:
        self.file.close()


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low:high]`` for each pair, none empty; whole steps by their minima."""

    def flat(source: np.ndarray, start: np.ndarray, stop: np.ndarray, into: np.ndarray) -> None:
        size = stop - start
        some = np.flatnonzero(size > 0)
        if not len(some):
            return
        start, size = start[some], size[some]
        first = np.cumsum(size) - size
        index = np.repeat(start - first, size) + np.arange(int(size.sum()))
        into[some] = np.minimum(into[some], np.minimum.reduceat(source[index], first))

    best = np.full(len(low), np.iinfo(values.dtype).max, dtype=values.dtype)
    inner_low, inner_high = -(-low // _STEP), high // _STEP
    wide = inner_high - inner_low > 1
    if wide.any():
        steps = np.minimum.reduceat(values, np.arange(0, len(values), _STEP))
        stop_left = np.where(wide, inner_low * _STEP, high)
        start_right = np.where(wide, inner_high * _STEP, high)
        flat(values, low, stop_left, best)
        flat(values, start_right, high, best)
        flat(steps, inner_low, np.where(wide, inner_high, inner_low), best)
    else:
        flat(values, low, high, best)
    return best


class Collection:
    """The transform of a collection of texts, grown from their ends.

    Symbols are bytes plus one; 0 is the end of a text and stands where nothing precedes a
    suffix yet. ``cap`` bounds the common prefixes that are kept.
    """

    def __init__(self, texts: list[bytes], cap: int, block: int = BLOCK_ROWS):
        self.texts, self.cap, self.block = texts, cap, block
        self.count = len(texts)
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        # Bytes 254 and 255 never occur in UTF-8, so byte + 1 fits in a byte.
        joined = np.frombuffer(b"".join(texts), dtype=np.uint8) + np.uint8(1)
        self.symbols = joined
        self.stop = np.cumsum(self.length)
        self.row = np.arange(self.count, dtype=np.int64)
        self.files = self._fresh()
        self.files[0].write(np.zeros(self.count))
        self.files[1].write(np.zeros(self.count))
        self.files[2].write(np.arange(self.count, dtype=np.int64) << 32)

    @staticmethod
    def _fresh() -> tuple[ColumnFile, ColumnFile, ColumnFile]:
        return ColumnFile(np.uint8), ColumnFile(np.uint16), ColumnFile(np.int64)

    def build(self) -> None:
        for t in range(1, int(self.length.max()) + 1 if self.count else 1):
            self._add(t)

    def _add(self, t: int) -> None:
        """Add the suffixes of length ``t``."""
        text = np.flatnonzero(self.length >= t)
        text = text[np.argsort(self.row[text], kind="stable")]
        at = self.row[text]
        symbol = self.symbols[self.stop[text] - t]
        place, prefix, below_row, below_prefix = self._ranked(at, symbol)
        order = np.argsort(place, kind="stable")
        self.row = self._merged(
            at, symbol, place[order], prefix[order], text[order], t, below_row, below_prefix
        )

    def _ranked(self, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, ...]:
        """For new symbols at sorted rows: the new suffixes' rows, their common prefixes with
        the row above, and the rows below that are old with their new common prefixes.

        One pass. Between blocks it keeps for each symbol how often it stood above, the least
        common prefix since then, and whether its last row was a new one.
        """
        counts = np.zeros(257, dtype=np.int64)
        running = np.zeros(256, dtype=np.int64)  # least common prefix since the last one
        waiting = np.zeros(256, dtype=bool)  # the last one was new
        place = np.empty(len(at), dtype=np.int64)
        prefix = np.zeros(len(at), dtype=np.int64)
        below: list[tuple[np.ndarray, ...]] = []
        blocks = zip(
            self.files[0].blocks(self.block), self.files[1].blocks(self.block), strict=True
        )
        for (start, bwt), (_, lcp) in blocks:
            low, high = np.searchsorted(at, [start, start + len(bwt)])
            mine, own = at[low:high] - start, symbol[low:high]
            bwt = bwt.copy()
            bwt[mine] = own
            is_new = np.zeros(len(bwt), dtype=bool)
            is_new[mine] = True
            order = np.argsort(bwt, kind="stable")
            seen = np.bincount(bwt, minlength=256)
            first = np.cumsum(seen) - seen
            inverse = np.empty(len(bwt), dtype=np.int64)
            inverse[order] = np.arange(len(bwt))
            k = inverse[mine]
            place[low:high] = k - first[own] + counts[own]  # within the symbol for now
            # Common prefix with the row above of the same symbol.
            has = k > first[own]
            got = np.zeros(len(k), dtype=np.int64)
            if has.any():
                before = order[np.maximum(k - 1, 0)]
                got[has] = 1 + range_minima(lcp, before[has] + 1, mine[has] + 1)
            edge = ~has & (counts[own] > 0)
            if edge.any():
                lead = range_minima(lcp, np.zeros(edge.sum(), dtype=np.int64), mine[edge] + 1)
                got[edge] = 1 + np.minimum(running[own[edge]], lead)
            prefix[low:high] = got
            # The old row below of the same symbol.
            after = np.minimum(k + 1, len(bwt) - 1)
            has = (k + 1 < first[own] + seen[own]) & ~is_new[order[after]]
            if has.any():
                follower = order[after[has]]
                value = 1 + range_minima(lcp, mine[has] + 1, follower + 1)
                inside = k[has] + 1 - first[own[has]] + counts[own[has]]
                below.append((own[has].astype(np.int64), inside, value.astype(np.int64)))
            # An old first row of this block whose symbol's last row was new.
            present = np.flatnonzero(seen)
            heads = order[first[present]]
            owed = waiting[present] & ~is_new[heads]
            if owed.any():
                who, head = present[owed], heads[owed]
                lead = range_minima(lcp, np.zeros(len(head), dtype=np.int64), head + 1)
                value = 1 + np.minimum(running[who], lead)
                below.append((who.astype(np.int64), counts[who].copy(), value))
            # Carry over to the next block.
            tails = order[first[present] + seen[present] - 1]
            whole = int(lcp.min()) if len(lcp) else 0
            running = np.minimum(running, whole)
            open_end = tails + 1 < len(bwt)
            running[present] = np.iinfo(np.int64).max
            if open_end.any():
                running[present[open_end]] = range_minima(
                    lcp, tails[open_end] + 1, np.full(open_end.sum(), len(bwt), dtype=np.int64)
                )
            waiting[present] = is_new[tails]
            counts[:256] += seen
        # Rows of the empty suffixes come first, then those of each symbol.
        base = self.count + np.cumsum(counts[:256]) - counts[:256] - counts[0]
        place += base[symbol]
        np.minimum(prefix, self.cap, out=prefix)
        if below:
            who, inside, value = (np.concatenate(x) for x in zip(*below, strict=True))
            return place, prefix, base[who] + inside, np.minimum(value, self.cap)
        empty = np.zeros(0, dtype=np.int64)
        return place, prefix, empty, empty

    def _merged(
        self,
        at: np.ndarray,
        symbol: np.ndarray,
        place: np.ndarray,
        prefix: np.ndarray,
        text: np.ndarray,
        t: int,
        below_row: np.ndarray,
        below_prefix: np.ndarray,
    ) -> np.ndarray:
        """Write the next files: new symbols at ``at``, new rows at ``place``. Returns the rows
        of the texts' last suffixes, which move as rows are put above them."""
        turn = np.argsort(below_row)
        below_row, below_prefix = below_row[turn], below_prefix[turn]
        fresh = self._fresh()
        before = place - np.arange(len(place))  # old rows above each new one
        blocks = zip(*(f.blocks(self.block) for f in self.files), strict=True)
        total = self.files[0].rows
        for (start, bwt), (_, lcp), (_, name) in blocks:
            stop = start + len(bwt)
            low = np.searchsorted(before, start, side="left")
            # Rows put after the last old one belong to the last block.
            high = len(before) if stop == total else np.searchsorted(before, stop, side="left")
            spots = place[low:high] - start - low
            size = len(bwt) + high - low
            old = np.ones(size, dtype=bool)
            old[spots] = False
            bwt = bwt.copy()
            a, b = np.searchsorted(at, [start, stop])
            bwt[at[a:b] - start] = symbol[a:b]
            new_bwt = np.zeros(size, dtype=np.uint8)
            new_bwt[old] = bwt
            new_lcp = np.empty(size, dtype=np.uint16)
            new_lcp[old] = lcp
            new_lcp[spots] = prefix[low:high]
            a, b = np.searchsorted(below_row, [start + low, start + low + size])
            new_lcp[below_row[a:b] - start - low] = below_prefix[a:b]
            new_name = np.empty(size, dtype=np.int64)
            new_name[old] = name
            new_name[spots] = (text[low:high] << 32) | t
            for file, values in zip(fresh, (new_bwt, new_lcp, new_name), strict=True):
                file.write(values)
        for file in self.files:
            file.close()
        self.files = fresh
        row = self.row.copy()
        row[text] = place
        return row

    def repeated(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, start) of the suffixes that share ``cap`` symbols with another one."""
        last: tuple[int, int] | None = None
        blocks = zip(
            self.files[1].blocks(self.block), self.files[2].blocks(self.block), strict=True
        )
        for (_, lcp), (_, name) in blocks:
            same = lcp >= self.cap
            hit = same.copy()
            hit[:-1] |= same[1:]
            if last is not None and len(same) and same[0] and not last[1]:
                yield self._placed(np.array([last[0]], dtype=np.int64))
            yield self._placed(name[hit])
            last = (int(name[-1]), bool(hit[-1]))

    def _placed(self, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = name >> 32
        return text, self.length[text] - (name & 0xFFFFFFFF)

    def close(self) -> None:
        for file in self.files:
            file.close()
