"""Removal of long repeated byte strings by column-wise suffix sorting of many texts.

Where a byte string of the wanted length occurs twice, both places choose the same anchor in
it: the run of bytes with the least hash. So texts are cut into pieces, each the strings of
one anchor, and only pieces of equal anchors can share strings. Equal pieces are settled by
counting them. The others are cut where the anchor's place in their strings passes a multiple
of a step: all strings of such a part have a long core in common, and parts of equal cores
form a group. Whole groups are put in collections of bounded size, a core shortened to a few
symbols that name it, and the Burrows-Wheeler transform and the common prefixes of a
collection are built column by column. A group too large for a collection is cut with a
smaller step, in the end to single strings, which counting settles.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.session import stage

from .column_bwt import Collection
from .common import (
    MASK64,
    batch_of,
    key_bitmap,
    map_batches,
    may_hold,
    mix64,
    rows_of,
    text_key,
)

LENGTH = 400
GRAM = 64

# Pieces of a collection, and the largest group that is sorted in one.
COLLECTION = 1500
LARGEST_GROUP = 4096

# How far the anchor's place may differ within a part, from one cut to the next.
STEPS = (64, 8, 1)

# Bytes that no UTF-8 text has; a few of them name a core. As many names as a collection of
# the largest size may need.
_NAME_BYTES = bytes([0xC0, 0xC1, *range(0xF5, 0xFE)])
_NAME_LENGTH = 4

# Starts that are looked at together when a text is cut.
CUT_BLOCK = 1 << 20
_LOW_BITS = np.uint64((1 << 24) - 1)

_BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of every run of ``gram`` bytes (a power of two), by doubling."""
    total, width = _BYTE_HASH[data], 1
    while width < gram:
        total = total[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + total[width:]
        width *= 2
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    size, done = len(values) - width + 1, 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:size], values[width - done : width - done + size])


def cut(text: bytes, length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int, int]]:
    """(start, strings, anchor, hash of the anchor) of every piece; each string of ``length``
    bytes starts in one."""
    out: list[tuple[int, int, int, int]] = []
    strings = len(text) - length + 1
    for base in range(0, strings, CUT_BLOCK):
        count = min(CUT_BLOCK, strings - base)
        data = np.frombuffer(text, dtype=np.uint8, count=count + length - 1, offset=base)
        hashes = gram_hashes(data, gram)
        keys = (hashes & ~_LOW_BITS) | np.arange(len(hashes), dtype=np.uint64)
        least = sliding_minima(keys, length - gram + 1)
        anchor = (least & _LOW_BITS).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        size = np.diff(first, append=count)
        anchor = anchor[first]
        out += zip(
            (first + base).tolist(),
            size.tolist(),
            (anchor + base).tolist(),
            hashes[anchor].view(np.int64).tolist(),
            strict=True,
        )
    return out


def finer(
    text: bytes, key: int, start: int, strings: int, anchor: int, step: int, length: int = LENGTH
) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(key, start, strings, left, edges) of a piece cut where the anchor's place in its strings
    passes a multiple of ``step``. The key covers the core, the bytes that all strings of such
    a part have; the edges are the ``left`` bytes before it and those after."""
    while strings:
        turn = (anchor - start) // step
        first = anchor - turn * step  # where the last string of the part may start
        count = min(strings, first - start + 1)
        end = first - step + 1 + length
        name = xxhash.xxh3_64_intdigest(text[first:end], seed=(key ^ turn) & MASK64)
        edges = text[start:first] + text[end : start + count - 1 + length]
        yield name, start, count, first - start, edges
        start += count
        strings -= count


def core_name(number: int) -> bytes:
    """The symbols that stand for the core of a group of a collection."""
    digits = []
    for _ in range(_NAME_LENGTH):
        number, digit = divmod(number, len(_NAME_BYTES))
        digits.append(_NAME_BYTES[digit])
    if number:
        raise ValueError("too many groups in a collection")
    return bytes(digits)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _named(text: bytes, start: int, strings: int, length: int) -> int:
    return _signed(xxhash.xxh3_64_intdigest(text[start : start + strings + length - 1]))


_DOC = "id long, no_id boolean, tie long"
_KEYS = ["id", "no_id", "tie"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"),
        text_key().alias("tie"),
        "text",
    )


_PLACE = pa.struct(
    [
        ("key", pa.int64()),
        ("name", pa.int64()),
        ("start", pa.int64()),
        ("strings", pa.int32()),
        ("anchor", pa.int64()),
        ("left", pa.int32()),
        ("edges", pa.binary()),
    ]
)
_PLACE_DDL = (
    "array<struct<key:long,name:long,start:long,strings:int,anchor:long,left:int,edges:binary>>"
)
_CUT = pa.schema(
    [("id", pa.int64()), ("no_id", pa.bool_()), ("tie", pa.int64()), ("pieces", pa.list_(_PLACE))]
)


def _cut_batch(names: list[list], found: list[list[tuple]]) -> pa.RecordBatch:
    """Names of texts and lists of their pieces as one batch."""
    flat = [x for rows in found for x in rows]
    columns = list(zip(*flat, strict=True)) if flat else [()] * len(_PLACE)
    struct = pa.StructArray.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, _PLACE, strict=True)], fields=list(_PLACE)
    )
    offsets = np.concatenate([[0], np.cumsum([len(rows) for rows in found])]).astype(np.int32)
    keys = list(zip(*names, strict=True)) if names else [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array(c, type=f.type) for c, f in zip(keys, _CUT, strict=False)),
            pa.ListArray.from_arrays(pa.array(offsets), struct),
        ],
        schema=_CUT,
    )


def _cut_texts(docs: DataFrame, length: int) -> DataFrame:
    """The pieces of every text that is long enough, one row per text."""
    gram = min(GRAM, 1 << ((length + 1) // 2).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = [], []
            for *name, text in rows_of(batch):
                data = text.encode("utf-8", "surrogatepass")
                if len(data) >= length:
                    names.append(name)
                    found.append(
                        [
                            (key, _named(data, start, strings, length), start, strings, anchor,
                             None, None)
                            for start, strings, anchor, key in cut(data, length, gram)
                        ]
                    )
            yield _cut_batch(names, found)

    texts = _keyed(docs).where(F.octet_length("text") >= length)
    return map_batches(texts, run, f"{_DOC}, pieces {_PLACE_DDL}")


def _recut(docs: DataFrame, pieces: DataFrame, step: int, length: int) -> DataFrame:
    """Parts of the given pieces, one row per text. Repetitions of a text give theirs each;
    such pieces occur more than once anyway."""
    asked = pieces.groupBy(*_KEYS).agg(
        F.collect_list(F.struct("key", "start", "strings", "anchor")).alias("asked")
    )
    bitmap = stage(key_bitmap(pieces, "tie"), "repeats-bitmap")
    texts = may_hold(_keyed(docs), bitmap, "tie", "has").where("has")
    texts = texts.join(asked, _KEYS).select(*_KEYS, "text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = [], []
            for *name, text, asked in rows_of(batch):
                data = text.encode("utf-8", "surrogatepass")
                rows = []
                for p in asked:
                    for key, start, strings, left, edges in finer(
                        data, p["key"], p["start"], p["strings"], p["anchor"], step, length
                    ):
                        # Parts of one core are equal where the edges and their places are.
                        own = xxhash.xxh3_64_intdigest(edges, seed=(left << 32) | strings)
                        rows.append(
                            (_signed(key), _signed(own), start, strings, p["anchor"], left, edges)
                        )
                names.append(name)
                found.append(rows)
            yield _cut_batch(names, found)

    return map_batches(texts, run, f"{_DOC}, pieces {_PLACE_DDL}")


_SPAN = pa.schema(
    [
        ("id", pa.int64()),
        ("no_id", pa.bool_()),
        ("tie", pa.int64()),
        ("start", pa.int64()),
        ("strings", pa.int32()),
    ]
)


def _sorted_spans(parts: DataFrame, step: int, collection: int) -> DataFrame:
    """Runs of starts whose strings occur twice, from collections of whole groups.

    With the core named by symbols of its own, strings are equal where ``step - 1`` bytes of
    the edges and the name are.
    """

    def spans(rows: list[tuple]) -> list[tuple]:
        groups: dict[int, bytes] = {}
        texts = []
        for key, *_, left, edges in rows:
            name = groups.setdefault(key, core_name(len(groups)))
            texts.append(edges[:left] + name + edges[left:])
        built = Collection(texts, step - 1 + _NAME_LENGTH)
        built.build()
        marks = [np.zeros(r[5], dtype=bool) for r in rows]
        for text, start in built.repeated():
            for n, s in zip(text.tolist(), start.tolist(), strict=True):
                marks[n][s] = True
        built.close()
        out = []
        for row, mark in zip(rows, marks, strict=True):
            edge = np.flatnonzero(np.diff(mark, prepend=False, append=False))
            for first, stop in edge.reshape(-1, 2).tolist():
                out.append((*row[1:4], row[4] + first, stop - first))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            for row in rows_of(batch):
                if len(waiting) >= collection and waiting[-1][0] != row[0]:
                    yield batch_of(spans(waiting), _SPAN)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield batch_of(spans(waiting), _SPAN)

    return map_batches(
        parts.select("key", *_KEYS, "start", "strings", "left", "edges")
        .repartition("key")
        .sortWithinPartitions("key"),
        run,
        f"{_DOC}, start long, strings int",
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written and read again; the shuffle files behind it are then of no use, and
    Spark deletes them when the driver's garbage is collected."""
    done = stage(df, label)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return done


def repeated_strings(
    docs: DataFrame,
    length: int = LENGTH,
    collection: int = COLLECTION,
    largest_group: int = LARGEST_GROUP,
) -> DataFrame:
    """``(id, no_id, tie, start, strings)``: runs of starts, in bytes, of strings of ``length``
    bytes that start anywhere else too. Rows that agree in id and text share their runs."""
    pieces = _written(_cut_texts(docs, length), "repeats-cut")
    steps = [s for s in STEPS if s <= length // 2] or [1]
    found = None
    for level, step in enumerate([None, *steps]):
        each = pieces.select(*_KEYS, F.explode("pieces").alias("p")).select(*_KEYS, "p.*")
        if step is not None:
            # Parts of single strings have no edges and need no sorting.
            each = each if step > 1 else each.drop("edges", "left")
        groups = each.groupBy("key").agg(
            F.count("*").alias("total"), (F.min("name") != F.max("name")).alias("different")
        )
        # Written before they are joined: a join of two plain exchanges can be split where a
        # key is hot, one with an aggregate in between cannot.
        groups = _written(groups.where("total > 1").drop("total"), "repeats-groups")
        shared = _written(each.join(groups, "key"), "repeats-shared")
        named = shared.groupBy("key", "name").agg(
            F.count("*").alias("times"), F.min(F.struct(*_KEYS, "start")).alias("first")
        )
        named = _written(named, "repeats-named")
        # All strings of a piece that occurs twice do; of equal pieces one goes on.
        counted = _written(
            shared.join(named, ["key", "name"])
            .withColumn("goes_on", F.col("different") & (F.col("first") == F.struct(*_KEYS, "start")))
            .where("times > 1 OR goes_on")
            .drop("first", "different", "name"),
            "repeats-counted",
        )
        spans = counted.where("times > 1").select(*_KEYS, "start", "strings")
        found = spans if found is None else found.unionByName(spans)
        left_over = counted.where("goes_on").drop("times", "goes_on")
        if step == 1:
            break
        if step is None:
            large = left_over
        else:
            sizes = left_over.groupBy("key").agg(F.count("*").alias("members"))
            sized = _written(left_over.join(sizes, "key"), "repeats-different")
            small = sized.where(F.col("members") <= largest_group)
            found = found.unionByName(
                _written(_sorted_spans(small, step, collection), "repeats-sorted")
            )
            large = sized.where(F.col("members") > largest_group)
        if not large.take(1):
            break
        pieces = _written(_recut(docs, large, steps[level], length), "repeats-recut")
    return found


_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)


def covered(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes of the strings that start in the spans."""
    runs: list[list[int]] = []
    for start, strings in sorted((s["start"], s["strings"]) for s in spans):
        stop = start + strings + length - 1
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return [(a, b) for a, b in runs]


def remaining(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, stop in runs:
        out.append(text[at:start])
        at = stop
    return b"".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """Per row how much is removed and a digest of what remains.

    Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere
    else, in another row or the same. Null texts count as empty. Repeated rows are copies of
    each other, so of a repeated text of ``length`` bytes or more nothing remains. Only
    ``doc_id`` and ``text`` are read.
    """
    spans = repeated_strings(docs, length, **options)
    of_doc = stage(
        spans.groupBy(*_KEYS).agg(F.collect_list(F.struct("start", "strings")).alias("spans")),
        "repeats-spans",
    )
    # Texts that certainly keep all of their bytes are not moved.
    bitmap = stage(key_bitmap(of_doc, "tie"), "repeats-bitmap")
    texts = may_hold(_keyed(docs), bitmap, "tie", "has")
    wanted = ["id", "no_id", "text", "spans"]
    none = F.lit(None).cast("array<struct<start:long,strings:int>>")
    untouched = texts.where("NOT has").withColumn("spans", none).select(*wanted)
    rows = texts.where("has").join(of_doc, _KEYS, "left").select(*wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, no_id, text, spans in rows_of(batch):
                data = (text or "").encode("utf-8", "surrogatepass")
                runs = covered(spans or [], length)
                kept = remaining(data, runs)
                out.append(
                    (None if no_id else doc, len(data), len(data) - len(kept), len(runs),
                     hashlib.sha256(kept).hexdigest())
                )
            yield batch_of(out, _KEPT)

    return map_batches(
        rows.unionByName(untouched),
        run,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )
