"""Byte-level BPE: pre-tokenise overlapping chunks, stitch where they agree, then encode.

The splitting pattern looks only forward, so a match depends on its start and on what
follows. Two chunks that share a match boundary therefore agree from there on, and a long
text can be split by many tasks: each finds the boundaries of its chunk, and the first one
that both neighbours of an overlap have is where their pieces are joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galepost.session import stage

from .chat_format import ranks_of
from .common import batch_of, map_batches, rows_of

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
CACHED_PIECES = 65_536


class PieceEncoder:
    """Ids of the matches of a pattern, each encoded by itself; frequent ones are cached."""

    def __init__(self, ranks_file: str, pattern: str, entries: int = CACHED_PIECES):
        self.codec = tiktoken.Encoding(
            "pieces", pat_str=pattern, mergeable_ranks=ranks_of(ranks_file), special_tokens={}
        )
        self.pattern = regex.compile(pattern)
        self.entries = entries
        self.known: dict[str, bytes] = {}

    def encode(self, text: str, start: int = 0, stop: int | None = None) -> bytes:
        """Little-endian 32-bit ids of the matches from ``start`` that end by ``stop``.

        The text may go on after ``stop``, which the last matches look at.
        """
        known = self.known
        if len(known) > self.entries:
            known.clear()
        if start == 0 and stop is None:
            pieces = self.pattern.findall(text)
        else:
            stop = len(text) if stop is None else stop
            pieces = []
            for m in self.pattern.finditer(text, start):
                if m.end() > stop:
                    break
                pieces.append(m[0])
        out = []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = np.array(self.codec.encode_ordinary(piece), dtype="<u4").tobytes()
                if len(piece) <= 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)


class PieceDecoder:
    """The bytes of ids: the strings of the vocabulary in place, without an encoder."""

    def __init__(self, ranks_file: str):
        ranks = ranks_of(ranks_file)
        self.strings = [b""] * (max(ranks.values(), default=-1) + 1)
        for string, rank in ranks.items():
            self.strings[rank] = string

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def boundaries(pattern: regex.Pattern, text: str, last: bool) -> list[int]:
    """Ends of the matches that what follows the chunk cannot change."""
    ends = [m.end() for m in pattern.finditer(text)]
    return ends if last else [end for end in ends if end < len(text)]


_CHUNK = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("chunk", pa.int32()),
        ("last", pa.bool_()),
        ("text", pa.string()),
    ]
)


def _chunks(docs: DataFrame, size: int, overlap: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc, text in rows_of(batch):
                starts = range(0, len(text), size)
                yield batch_of(
                    [
                        (row, doc, i, i == len(starts) - 1, text[s : s + size + overlap])
                        for i, s in enumerate(starts)
                    ],
                    _CHUNK,
                )
                row += 1

    return map_batches(
        docs.select("doc_id", "text"),
        cut,
        "row long, doc_id long, chunk int, last boolean, text string",
    )


_ZONE = pa.schema(
    [
        ("row", pa.int64()),
        ("chunk", pa.int32()),
        ("last", pa.bool_()),
        ("head", pa.list_(pa.int32())),
        ("tail", pa.list_(pa.int32())),
    ]
)


def _cuts(chunks: DataFrame, pattern: str, size: int, overlap: int) -> DataFrame:
    """Where each chunk's own pieces start and stop, counted from the chunk's start; null
    where the boundaries of an overlap never meet."""

    def zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            out = []
            for row, chunk, last, text in rows_of(batch):
                ends = boundaries(compiled, text, last)
                head = [e for e in ends if e < overlap] if chunk else []
                tail = [] if last else [e - size for e in ends if e >= size]
                out.append((row, chunk, last, head, tail))
            yield batch_of(out, _ZONE)

    found = map_batches(
        chunks.select("row", "chunk", "last", "text").repartition("row", "chunk"),
        zones,
        "row long, chunk int, last boolean, head array<int>, tail array<int>",
    )
    order = Window.partitionBy("row").orderBy("chunk")
    meeting = found.withColumn(
        "stop", F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    )
    return meeting.select(
        "row",
        "chunk",
        "last",
        F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.lag("stop").over(order)).alias("start"),
        (F.col("stop") + size).alias("stop"),
    )


_CODED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("chunk", pa.int32()),
        ("ids", pa.binary()),
    ]
)
_CODED_DDL = "doc_id long, row long, chunk int, ids binary"


def encode_texts(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Pieces ``(doc_id, row, chunk, ids)`` whose ids, by chunk, are those of the whole text.

    A text of one chunk is encoded where it is read. Longer ones are dealt out by chunk,
    stitched, and encoded chunk by chunk. Where an overlap has no common boundary (a run of
    letters or blanks longer than it) that text is encoded in one piece, from its chunks.

    Null texts count as empty: one piece without ids. ``row`` tells repeated rows apart. Only
    ``doc_id`` and ``text`` are read; empty tables give no rows.
    """
    short = docs.select("doc_id", "text").where(
        F.col("text").isNull() | (F.length("text") <= chunk_chars)
    )
    long = docs.select("doc_id", "text").where(F.length("text") > chunk_chars)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(ranks_file, pattern)
        # Negative, so that these rows never meet those of the long texts.
        row = -1 - (TaskContext.get().partitionId() << 40)
        for batch in batches:
            out = []
            for doc, text in rows_of(batch):
                out.append((doc, row, 0, encoder.encode(text or "")))
                row -= 1
            yield batch_of(out, _CODED)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(ranks_file, pattern)
        for batch in batches:
            out = []
            for doc, row, chunk, text, start, stop in rows_of(batch):
                out.append((doc, row, chunk, encoder.encode(text, start, stop)))
            yield batch_of(out, _CODED)

    chunks = stage(_chunks(long, chunk_chars, overlap_chars), "bpe-chunks")
    cuts = stage(_cuts(chunks, pattern, chunk_chars, overlap_chars), "bpe-cuts")
    apart = cuts.where(
        F.col("start").isNull() | (F.col("stop").isNull() & ~F.col("last"))
    ).select("row").distinct()
    stitched = (
        chunks.join(cuts.drop("last"), ["row", "chunk"])
        .join(apart, "row", "left_anti")
        .select("doc_id", "row", "chunk", "text", "start", "stop")
    )
    own = F.when(F.col("last"), F.col("text")).otherwise(
        F.substring("text", 1, chunk_chars)
    )
    rejoined = (
        chunks.join(apart, "row", "left_semi")
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.sort_array(F.collect_list(F.struct("chunk", own.alias("text")))).alias("parts"),
        )
        .select(
            "doc_id",
            "row",
            F.lit(0).alias("chunk"),
            F.array_join("parts.text", "").alias("text"),
            F.lit(0).alias("start"),
            F.lit(None).cast("int").alias("stop"),
        )
    )
    return map_batches(short, whole, _CODED_DDL).unionByName(
        map_batches(stitched.unionByName(rejoined), pieces, _CODED_DDL)
        # Only these rows need sorting for whoever reads a text's pieces in order.
        .repartition("row")
        .sortWithinPartitions("row", "chunk")
    )


_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


def round_trip(coded: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """Per text the count and digest of its ids and the digest of the bytes they decode to.

    Takes the pieces as ``encode_texts`` leaves them: those of a text follow each other.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = PieceDecoder(ranks_file)
        state = None

        def closed() -> tuple:
            return state[1], state[2], state[3].hexdigest(), state[4].hexdigest()

        for batch in batches:
            out = []
            for doc, row, _, ids in rows_of(batch):
                if state is None or state[0] != row:
                    if state:
                        out.append(closed())
                    state = [row, doc, 0, hashlib.sha256(), hashlib.sha256()]
                state[2] += len(ids) // 4
                state[3].update(ids)
                state[4].update(decoder.decode(ids))
            yield batch_of(out, _DIGEST)
        if state:
            yield batch_of([closed()], _DIGEST)

    return map_batches(
        coded, digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
