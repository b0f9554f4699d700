"""Near-duplicates by 64-bit fingerprints, compared exactly in tiles.

A tile holds the fingerprints with the same numbers of set bits in each of four parts of
sixteen bits. Two fingerprints differ in at least as many bits as these numbers do, so tile
pairs whose numbers differ by more than the radius are skipped; all others are compared with
exclusive-or and bit counts. A tile of any size is compared in blocks, and what is found in a
block leaves as a forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.session import stage

from .common import batch_of, map_batches
from .components import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 2
PARTS = 4
BITS = 64 // PARTS
# Fingerprints of a tile that one group compares with all that may be near them.
BLOCK = 4096
# Fingerprints compared with a block at a time.
CHUNK = 256

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes) -> int:
    """Bit b is set if it is set in over half the hashes of the text's shingles."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = (np.cumsum([len(word) for word in words]) + np.arange(len(words))).tolist()
    starts = [0, *(end + 1 for end in ends[:-1])]
    width = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [
            digest(line[a:b], SEED)
            for a, b in zip(starts[: len(words) - width + 1], ends[width - 1 :], strict=True)
        ],
        dtype="<u8",
    )
    half = len(hashes) / 2
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a text may be long
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits > half, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)``, a row for each document; a null text has fingerprint zero."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(text or b"") for text in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(found.view(np.int64))],
                schema=schema,
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, fp long")


def near_offsets(radius: int) -> list[tuple[int, ...]]:
    """One of each two opposite differences of tiles that can be near; the first is zero."""
    every = [o for o in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, o)) <= radius]
    return sorted(o for o in every if o >= (0,) * PARTS)


def _tile(offset: tuple[int, ...], radius: int) -> F.Column:
    """The tile at ``offset`` before that of ``fp``, as a number without collisions."""
    out = F.lit(0)
    for part, less in enumerate(offset):
        ones = F.bit_count(
            F.shiftrightunsigned("fp", part * BITS).bitwiseAND(F.lit((1 << BITS) - 1))
        )
        out = out * F.lit(BITS + 2 * radius + 1) + (ones + F.lit(radius - less))
    return out.cast("int")


def tile_members(points: DataFrame, radius: int, block: int) -> DataFrame:
    """``(tile, block, role, fp)``: role 0 for a block's own fingerprints, 1 for others that
    may be near them. Of two tiles, or blocks, only one is sent to the other."""
    sizes = (
        points.groupBy(_tile((0,) * PARTS, radius).alias("tile"))
        .count()
        .select("tile", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    own, *others = (_tile(offset, radius) for offset in near_offsets(radius))
    places = points.select(
        "fp", F.explode(F.array(*others, own)).alias("tile"), own.alias("home")
    )
    # A row for each of the 17^4 tiles at most.
    placed = places.join(F.broadcast(sizes), "tile")
    at_home = F.col("tile") == F.col("home")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    first = F.when(at_home, mine).otherwise(0)
    return placed.select(
        "tile",
        F.explode(F.sequence(first, F.col("blocks") - 1)).alias("block"),
        at_home.alias("at_home"),
        mine.alias("mine"),
        "fp",
    ).select(
        "tile",
        "block",
        F.when(F.col("at_home") & (F.col("block") == F.col("mine")), 0).otherwise(1).alias("role"),
        "fp",
    )


class _Block:
    """The own fingerprints of a block, and which are known to be connected."""

    def __init__(self, own: np.ndarray, radius: int):
        self.own, self.radius = own, radius
        self.label = np.arange(len(own))
        self.edges: list[tuple[int, int]] = []
        for start in range(0, len(own), CHUNK):
            near = self._near(own[start : start + CHUNK])
            for row in np.flatnonzero(near.sum(axis=1) > 1):
                labels = self.label[near[row]]
                if (labels != labels[0]).any():
                    self._join(np.unique(labels))
        moved = np.flatnonzero(self.label != np.arange(len(own)))
        self._name(own[moved], own[self.label[moved]])

    def _near(self, others: np.ndarray) -> np.ndarray:
        return np.bitwise_count(others[:, None] ^ self.own[None, :]) <= self.radius

    def _join(self, labels: np.ndarray) -> None:
        self.label[np.isin(self.label, labels)] = labels[0]

    def _name(self, a: np.ndarray, b: np.ndarray) -> None:
        self.edges += zip(a.view(np.int64).tolist(), b.view(np.int64).tolist(), strict=True)

    def meet(self, others: np.ndarray) -> None:
        """Connect fingerprints of other blocks: one edge to each group that they join."""
        for start in range(0, len(others), CHUNK):
            chunk = others[start : start + CHUNK]
            near = self._near(chunk)
            for row in np.flatnonzero(near.any(axis=1)):
                labels = np.unique(self.label[near[row]])
                self._name(np.full(len(labels), chunk[row]), self.own[labels])
                if len(labels) > 1:
                    self._join(labels)


def near_edges(members: DataFrame, radius: int) -> DataFrame:
    """``(a, b)``: pairs of fingerprints that connect what lies within the radius."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            tile, number, role, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fp = fp.astype(np.int64).view(np.uint64)
            turns = np.diff(tile) | np.diff(number) | np.diff(role)
            cuts = [0, *(np.flatnonzero(turns) + 1), len(fp)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                here = (tile[start], number[start])
                if here != key:
                    if own:  # nothing else came near
                        block = _Block(np.concatenate(own), radius)
                    if block and block.edges:
                        yield batch_of(block.edges, schema)
                    key, own, block = here, [], None
                if role[start] == 0:
                    own.append(fp[start:end])
                    continue
                if block is None:
                    block, own = _Block(np.concatenate(own), radius), []
                block.meet(fp[start:end])
                if len(block.edges) > 1 << 16:
                    yield batch_of(block.edges, schema)
                    block.edges = []
        if own:
            block = _Block(np.concatenate(own), radius)
        if block and block.edges:
            yield batch_of(block.edges, schema)

    dealt = members.repartition("tile", "block").sortWithinPartitions("tile", "block", "role")
    return map_batches(dealt.select("tile", "block", "role", "fp"), run, "a long, b long")


def link_fingerprints(docs: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row for each row of ``docs``.

    Only ``doc_id`` and ``text`` are read. A null, empty or blank text has fingerprint zero,
    which is linked like any other. Rows that repeat each other have one result. Null ids take
    part, but a component is named by its least id that is not null, or null if it has none.
    An empty table gives no rows.
    """
    marked = stage(fingerprints(docs), "fingerprints")
    points = stage(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints"
    )
    edges = near_edges(tile_members(points.select("fp"), radius, block), radius)
    found = connected_components(edges, "fingerprints")
    named = points.join(
        found.select(F.col("node").alias("fp"), "component"), "fp", "left"
    ).select("fp", F.coalesce("component", "fp").alias("component"), "least")
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # Written, so that a join with a very frequent fingerprint can be split.
    classes = stage(
        named.select("fp", "component").join(roots, "component").select("fp", "component_id"),
        "fingerprint-classes",
    )
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
