import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as registry
from galepost.llm import simhash as sh

from .conftest import prose


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    width = min(3, len(words))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(points, radius):
    """Least position of what is reachable from each point, by comparing all pairs."""
    label = list(range(len(points)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(points))]


def check(rows, ids, texts, radius=2):
    points = [plain_fingerprint(t) for t in texts]
    groups = components(points, radius)
    least = {}
    for i, g in zip(ids, groups, strict=True):
        known = [x for x in (least.get(g), i) if x is not None]
        least[g] = min(known) if known else None
    want = [(i, f"{p:016x}", least[g]) for i, p, g in zip(ids, points, groups, strict=True)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def copies(seed, n):
    """Near copies: long texts with a word or two replaced."""
    rng = random.Random(seed)
    base = prose(seed, 400).split(" ")
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = "new" + str(rng.randrange(99))
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [sh.BLOCK, 3])
def test_equals_brute_force(documents, edge_texts, block):
    texts = edge_texts + copies(1, 60) + copies(2, 40) + [prose(s, 30) for s in range(40)]
    ids = [7 * i % 1009 for i in range(len(texts))]
    check(sh.link_fingerprints(documents(texts, ids), block=block).collect(), ids, texts)
    assert sh.link_fingerprints(documents([])).count() == 0


def test_null_and_repeated_ids(documents):
    texts = ["a b c d", "a b c d", None, "", "x y"]
    rows = sh.link_fingerprints(documents(texts, [None, 5, None, None, 5])).collect()
    check(rows, [None, 5, None, None, 5], texts)


def points_near(spark, values):
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    return spark.createDataFrame([(v,) for v in signed], "fp long")


@pytest.mark.parametrize("radius, block", [(0, 50), (1, 7), (2, 7), (2, 4096), (3, 20)])
def test_crowded_tiles(spark, radius, block):
    """Points around few centres, on every border of the tiles, in blocks of all sizes."""
    rng = random.Random(radius)
    values = {0, (1 << 64) - 1, 1 << 63, 3, 7}
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            value = centre
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    points = points_near(spark, values)
    members = sh.tile_members(points, radius, block)
    # Blocks are no larger than they may be, but for the luck of the hash.
    assert members.where("role = 0").count() == len(values)
    edges = sh.near_edges(members, radius).collect()
    number = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))
    for _ in range(len(values)):
        before = list(label)
        for a, b in edges:
            i, j = (number[v % (1 << 64)] for v in (a, b))
            assert (values[i] ^ values[j]).bit_count() <= 64
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    assert label == components(values, radius)
    assert len(edges) <= members.count() + len(values)


def test_tiles_do_not_collide(spark):
    offsets = sh.near_offsets(2)
    assert offsets[0] == (0, 0, 0, 0) and len(offsets) == 21
    counts = [(0, 16, 0, 16), (1, 0, 0, 0), (0, 16, 0, 15), (16,) * 4, (0,) * 4]
    values = [sum(((1 << n) - 1) << 16 * i for i, n in enumerate(ns)) for ns in counts]
    tiles = [sh._tile(o, 2).alias(str(i)) for i, o in enumerate(offsets)]
    places = set()
    for value, *row in points_near(spark, values).select("fp", *tiles).collect():
        ones = [(value >> 16 * i & 0xFFFF).bit_count() for i in range(4)]
        for offset, tile in zip(offsets, row, strict=True):
            places.add((tuple(n - d for n, d in zip(ones, offset, strict=True)), tile))
    assert len(places) == len({p for p, _ in places}) == len({t for _, t in places})


def test_query(spark):
    docs = spark.read.parquet(f"{registry.SMOKE_DIR}/documents.parquet").orderBy("doc_id").collect()
    rows = registry.queries()["op12_simhash_tiles"](spark, registry.SMOKE_DIR)
    assert rows.agg(F.count("*")).first()[0] == len(docs)
    check(rows.collect(), [d.doc_id for d in docs], [d.text for d in docs])
