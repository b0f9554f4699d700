"""Near-duplicate join on word shingles by chosen paths.

Texts with the same shingles are one class. A class is embedded as a fixed number of tokens
(minhashes), two of which are shared as often as their sets overlap. Every run deals the
classes to buckets by a few sampled tokens; small buckets are compared in full by their tokens.
Large ones are first compared with some of their classes. Where most turn out to be alike, the
few others are compared with the whole bucket once and the bucket is done; else it is split
again by further sampled tokens. Runs repeat until the target recall. What this leaves
connected is then compared exactly, on whole shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.session import stage

from .common import (
    WordHasher,
    batch_of,
    key_bitmap,
    map_batches,
    may_hold,
    mix64,
    rows_of,
    text_key,
    word_shingles,
)
from .components import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.9999

# Tokens of the embedding, tokens sampled at a node, and how far paths go.
TOKENS = 128
SAMPLED = 3
DEPTH = 4

# Buckets up to this size are compared in full.
SMALL_BUCKET = 128

# Classes of a larger bucket that all of it is compared with (as expected; a hash picks them),
# members that one group holds meanwhile, and the side of a block of the others' comparison.
PIVOTS = 64
CHUNK = 4096
CROSS = 1024

# Classes of a component are compared block by block.
BLOCK = 256


def _agreement(share: float) -> np.ndarray:
    """Probability of each number of equal tokens, where one is equal with this probability."""
    return np.array(
        [math.comb(TOKENS, n) * share**n * (1 - share) ** (TOKENS - n) for n in range(TOKENS + 1)]
    )


def missed_by_paths(similarity: float, runs: int) -> float:
    """Probability that a pair shares no last bucket in any run.

    All runs sample from one embedding, so a pair whose tokens happen to agree less is more
    likely to be missed by each of them; hence the mean over what may agree.
    """
    agreeing = np.arange(TOKENS + 1)
    sampled = [
        np.array([math.comb(n, h) * math.comb(TOKENS - n, SAMPLED - h) for n in agreeing.tolist()])
        / math.comb(TOKENS, SAMPLED)
        for h in range(SAMPLED + 1)
    ]
    missed = np.zeros(TOKENS + 1)
    for _ in range(DEPTH):
        missed = sum(chance * missed**h for h, chance in enumerate(sampled))
    return float(_agreement(similarity) @ missed**runs)


def runs_for(similarity: float, recall: float) -> int:
    """Runs until a pair at the threshold shares a bucket with the wanted probability."""
    if not recall < 1:
        raise ValueError(f"no number of runs reaches a recall of {recall}")
    runs = 1
    while missed_by_paths(similarity, runs) >= 1 - recall:
        runs += 1
    return runs


def sketch_bound(similarity: float, recall: float) -> float:
    """Share of equal embedding bytes below which a pair is not looked at again.

    Pairs at the threshold that fall below it, and those that paths miss, are together no more
    than ``recall`` leaves. Bytes of different tokens agree by chance as well.
    """
    left = 1 - recall - missed_by_paths(similarity, runs_for(similarity, recall))
    below = np.cumsum(_agreement(similarity + (1 - similarity) / 256))
    return min(int(np.searchsorted(below, left, side="right")), TOKENS) / TOKENS


_FACTORS = mix64(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mix64(np.arange(1001, TOKENS + 1001, dtype=np.uint64))


def embed(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each of the hash functions, as 32 bits."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096] * _FACTORS[:, None]
        part += _OFFSETS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def children(paths: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Paths (rows x SAMPLED) that continue each row's path by its sampled tokens.

    Which places are sampled depends on the path alone, so classes on the same path that
    share a sampled token stay together.
    """
    order = mix64(paths[:, None] + mix64(np.arange(1, TOKENS + 1, dtype=np.uint64)))
    places = np.argpartition(order, SAMPLED - 1, axis=1)[:, :SAMPLED]
    places.sort(axis=1)
    picked = np.take_along_axis(tokens, places, axis=1).astype(np.uint64)
    key = mix64(paths[:, None] * np.uint64(0x9E3779B97F4A7C15) + places.astype(np.uint64))
    return mix64(key + picked * np.uint64(0xD6E8FEB86659FD93))


def roots(runs: int) -> np.ndarray:
    return mix64(np.arange(77, 77 + runs, dtype=np.uint64))


def set_name(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    one = np.bitwise_xor.reduce(mix64(shingles)) if len(shingles) else np.uint64(0)
    two = np.add.reduce(mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)))
    return np.array([one, two], dtype=np.uint64).tobytes()


def streamed_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list]]:
    """Groups of rows that follow each other with the same first ``keys`` columns."""
    current, rows = None, []
    for batch in batches:
        for row in rows_of(batch):
            if row[:keys] != current:
                if rows:
                    yield current, rows
                current, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield current, rows


class Forest:
    """Union of pairs; keeps the pairs that joined something."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, pairs: np.ndarray) -> list[tuple[int, int]]:
        kept = []
        for i, j in pairs.tolist():
            a, b = self.find(i), self.find(j)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                kept.append((i, j))
        return kept


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("tie", pa.int64()),
        ("sid", pa.binary()),
        ("size", pa.int32()),
        ("tokens", pa.binary()),
    ]
)


def sign(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Set name, size and embedding of every row; all null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            out = []
            for doc, tie, text in rows_of(batch):
                shingles = word_shingles(hasher(text), width)
                if len(shingles):
                    tokens = embed(shingles).tobytes()
                    out.append((doc, tie, set_name(shingles), len(shingles), tokens))
                else:
                    out.append((doc, tie, None, 0, None))
            yield batch_of(out, _SIGNED)

    return map_batches(
        docs.select("doc_id", text_key().alias("tie"), "text"),
        run,
        "doc_id long, tie long, sid binary, size int, tokens binary",
    )


_EDGE = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _agreeing(codes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Share of equal embedding bytes of each pair."""
    return (codes[:, None, :] == others[None, :, :]).mean(axis=2, dtype=np.float32)


def _bucket_edges(bound: float):
    """Compares the classes of each bucket and names pairs that connect what agrees.

    Classes with the same anchor are connected by it already. Of a pair of blocks, pairs
    within a block are that block's own turn; here they only tell what is connected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (_, i, j), rows in streamed_groups(batches, 3):
            names = [r[0] for r in rows]
            codes = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint8)
            codes = codes.reshape(len(rows), TOKENS)
            near = np.concatenate(
                [_agreeing(codes[k : k + 64], codes) for k in range(0, len(rows), 64)]
            )
            near = np.triu(near >= bound, 1)
            forest, held = Forest(len(rows)), {}
            for k, (_, _, anchor, _) in enumerate(rows):
                if anchor is not None:
                    forest.join(np.array([[held.setdefault(anchor, k), k]]))
            if i != j:
                block = np.array([r[3] for r in rows])
                inside = block[:, None] == block[None, :]
                forest.join(np.argwhere(near & inside))
                near &= ~inside
            out += [(names[a], names[b]) for a, b in forest.join(np.argwhere(near))]
            if len(out) > 5000:
                yield batch_of(out, _EDGE)
                out = []
        yield batch_of(out, _EDGE)

    return run


_PATH = pa.schema([("path", pa.int64()), ("sid", pa.binary()), ("anchor", pa.binary())])


def _deal(rows: DataFrame, start: np.ndarray | None) -> DataFrame:
    """The child paths of (path, anchor, sid, tokens); of every root for a first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, anchors, names, packed = (column.to_pylist() for column in batch.columns)
            if not names:
                continue
            tokens = np.frombuffer(b"".join(packed), dtype=np.uint32).reshape(-1, TOKENS)
            if start is None:
                own = np.array(paths, dtype=np.int64).view(np.uint64)
                found = children(own, tokens)
            else:
                found = np.concatenate(
                    [children(np.full(len(names), root), tokens) for root in start], axis=1
                )
            each = found.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.view(np.int64).ravel()),
                    pa.array([n for n in names for _ in range(each)], type=pa.binary()),
                    pa.array([a for a in anchors for _ in range(each)], type=pa.binary()),
                ],
                schema=_PATH,
            )

    return map_batches(
        rows.select("path", "anchor", "sid", "tokens"),
        run,
        "path long, sid binary, anchor binary",
    )


_CODED = pa.schema([("sid", pa.binary()), ("code", pa.binary())])


def _coded(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, packed = (column.to_pylist() for column in batch.columns)
            low = [np.frombuffer(p, dtype=np.uint32).astype(np.uint8).tobytes() for p in packed]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, type=pa.binary()), pa.array(low, type=pa.binary())],
                schema=_CODED,
            )

    return map_batches(classes.select("sid", "tokens"), run, "sid binary, code binary")


_LABELLED = pa.schema(
    [
        ("path", pa.int64()),
        ("sid", pa.binary()),
        ("anchor", pa.binary()),
        ("members", pa.int64()),
        ("code", pa.binary()),
        ("other", pa.binary()),
    ]
)


def _label(bound: float):
    """Compares each chunk of a bucket with the bucket's pivots.

    A row with ``other`` null is a member and its new anchor: the least pivot it is connected
    with in this chunk, else the anchor it had. Rows with ``other`` are pairs that connect.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (path, _), rows in streamed_groups(batches, 2):
            # Pivots come first, by name, so the root of a tree is its least pivot.
            rows.sort(key=lambda r: (not r[0], r[1]))
            pivots = sum(r[0] for r in rows)
            codes = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint8)
            codes = codes.reshape(len(rows), TOKENS)
            forest, known, held = Forest(len(rows)), {}, {}
            for k, (_, name, anchor, _, _) in enumerate(rows):
                forest.join(np.array([[known.setdefault(name, k), k]]))
                if anchor is not None:
                    forest.join(np.array([[held.setdefault(anchor, k), k]]))
            for start in range(pivots, len(rows) if pivots else 0, 256):
                near = _agreeing(codes[start : start + 256], codes[:pivots]) >= bound
                found = forest.join(np.argwhere(near) + [start, 0])
                out += [(path, rows[a][1], None, 0, None, rows[b][1]) for a, b in found]
            for k, (_, name, anchor, members, code) in enumerate(rows[pivots:], pivots):
                root = forest.find(k)
                label = rows[root][1] if root < pivots else anchor
                out.append((path, name, label, members, code, None))
            if len(out) > 5000:
                yield batch_of(out, _LABELLED)
                out = []
        yield batch_of(out, _LABELLED)

    return run


def _labelled(large: DataFrame, coded: DataFrame, bound: float) -> DataFrame:
    """Members of large buckets with the anchors that the buckets' pivots give them."""
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    own = F.struct(
        F.pmod(F.xxhash64("sid"), chunks).cast("int").alias("chunk"), F.lit(False).alias("pivot")
    )
    # A pivot is shown to every chunk as well.
    shown = F.transform(
        F.sequence(F.lit(0), chunks - 1),
        lambda chunk: F.struct(chunk.alias("chunk"), F.lit(True).alias("pivot")),
    )
    is_pivot = F.pmod(F.xxhash64("path", "sid"), F.col("members")) < PIVOTS
    dealt = large.select(
        "*", F.explode(F.when(is_pivot, F.concat(F.array(own), shown)).otherwise(F.array(own))).alias("to")
    )
    return map_batches(
        dealt.join(coded, "sid")
        .select("path", "to.chunk", "to.pivot", "sid", "anchor", "members", "code")
        .repartition("path", "chunk")
        .sortWithinPartitions("path", "chunk"),
        _label(bound),
        "path long, sid binary, anchor binary, members long, code binary, other binary",
    )


def _cross_edges(bound: float):
    """Compares a block of one side with a block of the other, and names pairs that connect.

    Nothing counts as connected here but what an anchor connects.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, rows in streamed_groups(batches, 3):
            # The others of the bucket first, then all of it.
            rows.sort(key=lambda r: r[3])
            first = sum(r[3] == 0 for r in rows)
            codes = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint8)
            codes = codes.reshape(len(rows), TOKENS)
            forest, known, held = Forest(len(rows)), {}, {}
            for k, (name, _, anchor, _) in enumerate(rows):
                forest.join(np.array([[known.setdefault(name, k), k]]))
                if anchor is not None:
                    forest.join(np.array([[held.setdefault(anchor, k), k]]))
            for start in range(0, first, 64):
                part = codes[start : min(start + 64, first)]
                near = _agreeing(part, codes[first:]) >= bound
                found = forest.join(np.argwhere(near) + [start, first])
                out += [(rows[a][0], rows[b][0]) for a, b in found]
            if len(out) > 5000:
                yield batch_of(out, _EDGE)
                out = []
        yield batch_of(out, _EDGE)

    return run


def _others_with_all(settled: DataFrame, bound: float) -> DataFrame:
    """Pairs that connect, from comparing what lacks a bucket's main anchor with all of it."""
    count = F.col("members") - F.col("held")
    rows = settled.where(count > 0).select(
        "*",
        F.ceil(count / CROSS).cast("int").alias("high"),
        F.ceil(F.col("members") / CROSS).cast("int").alias("wide"),
    )
    columns = ["path", "i", "j", "sid", "code", "anchor", "own"]
    others = rows.where(~F.col("anchor").eqNullSafe(F.col("main")) | F.isnull("main")).select(
        "*",
        F.pmod(F.xxhash64("sid"), "high").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("j"),
        F.lit(0).alias("own"),
    )
    everything = rows.select(
        "*",
        F.explode(F.sequence(F.lit(0), F.col("high") - 1)).alias("i"),
        F.pmod(F.xxhash64("sid"), "wide").cast("int").alias("j"),
        F.lit(1).alias("own"),
    )
    return map_batches(
        others.select(columns)
        .unionByName(everything.select(columns))
        .repartition("path", "i", "j")
        .sortWithinPartitions("path", "i", "j"),
        _cross_edges(bound),
        "a binary, b binary",
    )


def _bucket_sizes(rows: DataFrame) -> DataFrame:
    """Members of every bucket, and whether it holds what no anchor connects yet."""
    return rows.groupBy("path").agg(
        F.count("*").alias("members"),
        (F.max(F.isnull("anchor")) | (F.min("anchor") != F.max("anchor"))).alias("alive"),
    )


def candidate_edges(classes: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Pairs ``(a, b)`` of classes that connect all whose embeddings met and agree.

    A large bucket is first compared with a few of its classes, its pivots. What is connected
    by that has a common anchor. Where one anchor holds half of the bucket, everything else is
    compared with the whole bucket, which is then done; classes with the same anchor are not
    compared again, so a bucket full of copies of one text is never expanded to pairs nor
    split. A more mixed bucket is split, until the last depth ends all alike.
    """
    bound = sketch_bound(similarity, recall)
    coded = met = None
    dealt = _deal(
        classes.select(
            F.lit(0).cast("long").alias("path"),
            F.lit(None).cast("binary").alias("anchor"),
            "sid",
            "tokens",
        ),
        roots(runs_for(similarity, recall)),
    )
    # No level needs the pairs of another, so what is to be compared in full is collected over
    # all levels and compared at the end, at once.
    small, finished, found = [], [], []
    for level in range(1, DEPTH + 1):
        rows = stage(dealt, "join-paths")
        sizes = _bucket_sizes(rows).where("members > 1 AND alive")
        full = stage(rows.join(sizes, "path").drop("alive"), "join-buckets")
        if met is None:
            # Few classes meet any other; only theirs are moved from here on.
            met = stage(
                classes.select("sid", "tokens").join(full.select("sid").distinct(), "sid"),
                "join-met",
            )
            coded = stage(_coded(met), "join-codes")
        small.append(
            full.where(F.col("members") <= SMALL_BUCKET).select(
                "path",
                F.lit(level).alias("i"),
                F.lit(level).alias("j"),
                "sid",
                "anchor",
                F.lit(0).alias("own"),
            )
        )
        large = full.where(F.col("members") > SMALL_BUCKET)
        if not large.take(1):
            break
        labelled = stage(_labelled(large, coded, bound), "join-pivots")
        found.append(
            labelled.where("other IS NOT NULL").select(F.col("sid").alias("a"), F.col("other").alias("b"))
        )
        members = labelled.where("other IS NULL").drop("other")
        mains = (
            members.where("anchor IS NOT NULL")
            .groupBy("path", "anchor")
            .agg(F.count("*").alias("held"))
            .groupBy("path")
            .agg(F.max(F.struct("held", "anchor")).alias("most"))
            .select("path", "most.held", F.col("most.anchor").alias("main"))
        )
        judged = members.join(mains, "path", "left").withColumn(
            "held", F.coalesce("held", F.lit(0))
        )
        judged = stage(judged, "join-judged")
        done = F.lit(level == DEPTH) | (2 * F.col("held") >= F.col("members"))
        finished.append(judged.where(done))
        if level < DEPTH:
            dealt = _deal(judged.where(~done).select("path", "anchor", "sid").join(met, "sid"), None)
    compared = (
        reduce(DataFrame.unionByName, small)
        .join(coded, "sid")
        .select("path", "i", "j", "sid", "code", "anchor", "own")
        .repartition("path", "i", "j")
        .sortWithinPartitions("path", "i", "j")
    )
    found.append(
        stage(map_batches(compared, _bucket_edges(bound), "a binary, b binary"), "join-edges")
    )
    if finished:
        settled = reduce(DataFrame.unionByName, finished)
        found.append(stage(_others_with_all(settled, bound), "join-edges"))
    return reduce(DataFrame.unionByName, found)


def _links(similarity: float):
    """Exact links of the classes of each pair of blocks: how many rows each class gains as
    partners, and pairs that connect what is linked. A block's own turn connects its classes
    with the least that they are linked to in it, and only these with those of other blocks,
    so that no long paths arise."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (_, i, j), rows in streamed_groups(batches, 3):
            # By name, so the root of a tree is its least class.
            rows.sort(key=lambda r: r[0])
            names = [r[0] for r in rows]
            block = np.array([r[1] for r in rows])
            weight = np.array([r[2] for r in rows], dtype=np.int64)
            sets = [np.frombuffer(r[3], dtype=np.uint64) for r in rows]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            shared = shared_counts(sets)
            union = sizes[:, None] + sizes[None, :] - shared
            linked = shared >= similarity * union - 1e-9
            np.fill_diagonal(linked, False)
            forest = Forest(len(rows))
            inside = block[:, None] == block[None, :]
            forest.join(np.argwhere(np.triu(linked & inside, 1)))
            root = [forest.find(k) for k in range(len(rows))]
            if i == j:
                out += [(names[k], names[r], 0) for k, r in enumerate(root) if k != r]
            else:
                # What a block holds alone is named in its own turn.
                linked &= ~inside
                joined = forest.join(np.argwhere(np.triu(linked, 1)))
                out += [(names[root[a]], names[root[b]], 0) for a, b in joined]
            gained = linked.astype(np.int64) @ weight
            out += [(names[k], None, int(gained[k])) for k in np.flatnonzero(gained).tolist()]
            if len(out) > 5000:
                yield batch_of(out, schema)
                out = []
        yield batch_of(out, schema)

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other."""
    count = len(sets)
    sizes = [len(s) for s in sets]
    if count <= 4:
        shared = np.diag(sizes).astype(np.int64)
        for i in range(count):
            for j in range(i):
                same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                shared[i, j] = shared[j, i] = same
        return shared
    owner = np.repeat(np.arange(count), sizes)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times[code] > 1
    owner, code = owner[several], code[several]
    _, code = np.unique(code, return_inverse=True)
    shared = np.zeros((count, count), dtype=np.float64)
    width = 4096
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        low, high = np.searchsorted(code, [start, start + width])
        has = np.zeros((count, width), dtype=np.float32)
        has[owner[low:high], code[low:high] - start] = 1
        shared += has @ has.T
    shared = shared.astype(np.int64)
    np.fill_diagonal(shared, sizes)
    return shared


_SETS = pa.schema([("sid", pa.binary()), ("shingles", pa.binary())])


def _whole_sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """The shingle sets of some classes, from the text of one row of each."""
    keyed = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"),
        text_key().alias("tie"),
        "text",
    )
    wanted = members.select(
        F.coalesce("first.doc_id", F.lit(0)).alias("id"),
        F.col("first.doc_id").isNull().alias("no_id"),
        F.col("first.tie").alias("tie"),
        "sid",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            yield batch_of(
                [
                    (sid, word_shingles(hasher(text), width).tobytes())
                    for sid, text in rows_of(batch)
                ],
                _SETS,
            )

    asked = stage(key_bitmap(wanted, "tie"), "join-bitmap")
    keyed = may_hold(keyed, asked, "tie", "asked").where("asked").drop("asked")
    texts = keyed.join(wanted, ["id", "no_id", "tie"]).select("sid", "text")
    # Repetitions of a row are the same set.
    return map_batches(texts, run, "sid binary, shingles binary").dropDuplicates(["sid"])


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    width: int = SHINGLE_WORDS,
    recall: float = TARGET_RECALL,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, classes)``: every row with the name of its shingle set, and for every set its
    group, its links and its first row.

    ``rows`` has (doc_id, tie, sid); ``classes`` has (sid, group, n_links, class_id, keeper).
    A link is another row whose set has a Jaccard similarity of ``similarity`` or more; groups
    are what links connect. ``class_id`` is the least ``doc_id`` of the group, nulls last, and
    ``keeper`` the (doc_id, tie) of one row of it. A text of one to four words is a single
    shingle. Texts without words (null, empty, blank) have no set and no links.
    """
    signed = stage(sign(docs, width), "join-signed")
    order = F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id"),
        F.col("tie"),
    )
    classes = stage(
        signed.where("sid IS NOT NULL")
        .groupBy("sid")
        .agg(
            F.count("*").alias("members"),
            F.min(order).alias("first"),
            F.min("tokens").alias("tokens"),
        ),
        "join-classes",
    )
    edges = candidate_edges(classes, similarity, recall)
    near = stage(connected_components(edges, "join-near"), "join-near")
    sizes = near.groupBy("component").agg(F.count("*").alias("nodes"))
    placed = (
        near.join(sizes, "component")
        .withColumnRenamed("node", "sid")
        .withColumn("blocks", F.ceil(F.col("nodes") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
        .join(classes.select("sid", "members", "first"), "sid")
    )
    placed = stage(placed, "join-placed")
    pairs = (
        _whole_sets(docs, placed, width)
        .join(placed.select("sid", "component", "blocks", "own", "members"), "sid")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "component",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "sid",
            "own",
            "members",
            "shingles",
        )
        .repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j")
    )
    exact = stage(
        map_batches(pairs, _links(similarity), "a binary, b binary, links long"), "join-links"
    )
    linked = stage(
        connected_components(exact.where("b IS NOT NULL").select("a", "b"), "join-groups"),
        "join-groups",
    )
    gained = (
        exact.where("b IS NULL")
        .groupBy(F.col("a").alias("sid"))
        .agg(F.sum("links").alias("gained"))
    )
    named = (
        classes.select("sid", "members", "first")
        .join(linked.withColumnRenamed("node", "sid"), "sid", "left")
        .join(gained, "sid", "left")
        .select(
            "sid",
            F.coalesce("component", "sid").alias("group"),
            (F.coalesce("gained", F.lit(0)) + F.col("members") - 1).alias("n_links"),
            "first",
        )
    )
    groups = named.groupBy("group").agg(F.min("first").alias("keeper"))
    found = named.join(groups, "group").select(
        "sid",
        "group",
        "n_links",
        F.col("keeper.doc_id").alias("class_id"),
        "keeper",
    )
    return signed.select("doc_id", "tie", "sid"), found


def link_documents(docs: DataFrame, **options) -> DataFrame:
    """Every row with its class and its number of links.

    A row without words is a class of its own, named by its own id.
    """
    rows, classes = near_duplicates(docs, **options)
    return rows.join(classes.select("sid", "class_id", "n_links"), "sid", "left").select(
        "doc_id",
        F.when(F.col("sid").isNull(), F.col("doc_id"))
        .otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one_per_group(docs: DataFrame, **options) -> DataFrame:
    """One row of each group, with all its columns; rows without words stay.

    The row with the least id stays (nulls last, then by a hash of the text). Of repetitions
    of one row, equal in id and text, any one stays. Rows that are alone in their group are
    passed on where they are read; only the others are moved.
    """
    rows, classes = near_duplicates(docs, **options)
    mark = "__"
    while any(name.lower().startswith(f"{mark}key") for name in docs.columns):
        mark += "_"
    keys = [f"{mark}key{i}" for i in range(3)]
    hit, stays, alone = f"{mark}key_hit", f"{mark}key_stays", f"{mark}key_alone"

    def keyed(tie: F.Column) -> list[F.Column]:
        return [
            F.coalesce("doc_id", F.lit(0)).alias(keys[0]),
            F.col("doc_id").isNull().alias(keys[1]),
            tie.alias(keys[2]),
        ]

    grouped = rows.join(classes, "sid").groupBy("group").agg(F.count("*").alias("members"))
    several = classes.join(grouped.where("members > 1"), "group").select("sid", "keeper")
    is_keeper = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (
        F.col("tie") == F.col("keeper.tie")
    )
    judged = stage(
        rows.join(several, "sid")
        .select(*keyed(F.col("tie")), is_keeper.alias(stays))
        .distinct(),
        "join-judged",
    )
    bitmap = stage(key_bitmap(judged, keys[2]), "join-bitmap")
    told = may_hold(docs.select("*", *keyed(text_key())), bitmap, keys[2], hit)
    moved = (
        told.where(hit)
        .join(judged, keys, "left")
        .where(F.coalesce(stays, F.lit(True)))
        # Repetitions of a row that stays are one; rows of no group are told apart.
        .withColumn(alone, F.when(F.isnull(stays), F.monotonically_increasing_id()))
        .dropDuplicates([*keys, alone])
    )
    helpers = [*keys, hit, stays, alone]
    return told.where(~F.col(hit)).drop(*helpers).unionByName(moved.drop(*helpers))
