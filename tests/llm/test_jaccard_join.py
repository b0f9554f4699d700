import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

import __spark_entry__ as registry
from galepost.llm import common
from galepost.llm import jaccard_join as jj
from galepost.llm.components import connected_components

from .conftest import prose


def shingles(text, width=5):
    words = (text or "").encode().split()
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def expected(texts):
    """{row: (least row of its group, links)} by comparing what shares a shingle."""
    sets = [shingles(t) for t in texts]
    holders = defaultdict(list)
    for n, own in enumerate(sets):
        for s in own:
            holders[s].append(n)
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(texts)
    for n, own in enumerate(sets):
        shared = defaultdict(int)
        for s in own:
            for other in holders[s]:
                shared[other] += 1
        for other, count in shared.items():
            if other != n and count >= 0.8 * (len(own) + len(sets[other]) - count) - 1e-9:
                links[n] += 1
                a, b = find(n), find(other)
                parent[max(a, b)] = min(a, b)
    return {n: (find(n), links[n]) for n in range(len(texts))}


def altered(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(["ONE", "TWO", "SIX"])
    return " ".join(words)


def near_copies(seed, groups=12):
    rng = random.Random(seed)
    texts = []
    for g in range(groups):
        base = prose(seed * 100 + g, rng.randint(20, 200))
        texts.append(base)
        texts += [altered(rng, base, rng.randint(0, 5)) for _ in range(rng.randint(0, 6))]
    rng.shuffle(texts)
    return texts


def found(df):
    return {r.doc_id: (r.class_id, r.n_links) for r in df.collect()}


def test_near_copies(spark, documents):
    texts = near_copies(1) + [None, "", "  ", "one two", "one two", "one  two three"]
    texts += ["same line of words that many texts have in common\n" + prose(i, 12) for i in range(9)]
    want = expected(texts)
    assert found(jj.link_documents(documents(texts))) == want


def test_large_buckets_are_split_and_blocked(spark, documents, monkeypatch):
    """Small limits, so that pivots, deeper paths and pairs of blocks are all used."""
    monkeypatch.setattr(jj, "SMALL_BUCKET", 4)
    monkeypatch.setattr(jj, "BLOCK", 5)
    rng = random.Random(4)
    base = prose(7, 120)
    texts = [altered(rng, base, rng.randint(0, 3)) for _ in range(60)]
    texts += [f"{prose(8, 30)} {prose(100 + i, 25)}" for i in range(30)]
    texts += near_copies(3, 4) + [base] * 20
    want = expected(texts)
    assert max(n for _, n in want.values()) > 30
    assert found(jj.link_documents(documents(texts))) == want


def test_repeated_rows_and_null_ids(spark, documents):
    text, other = prose(1, 50), prose(2, 50)
    docs = documents([text, text, text, other, other, None, None], [5, 5, None, None, None, 9, 9])
    rows = sorted(((r.doc_id, r.class_id, r.n_links) for r in jj.link_documents(docs).collect()),
                  key=repr)
    assert rows == sorted(
        [(5, 5, 2)] * 2 + [(None, 5, 2)] + [(None, None, 1)] * 2 + [(9, 9, 0)] * 2, key=repr
    )
    kept = jj.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(5, text), (None, other), (9, None), (9, None)], key=repr
    )


def test_empty_table(spark, documents):
    none = documents(["x"]).limit(0)
    assert jj.link_documents(none).count() == 0
    assert jj.keep_one_per_group(none).count() == 0


def test_embedding_estimates_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        both = int(1000 * share)
        values = rng.integers(0, 2**63, 2 * 1000 - both, dtype=np.int64).astype(np.uint64)
        a, b = values[:1000], values[1000 - both :]
        same = (jj.embed(a) == jj.embed(b)).mean()
        assert abs(same - both / (2000 - both)) < 0.15


def test_runs_reach_the_recall():
    assert jj.runs_for(0.8, 0.9999) > jj.runs_for(0.8, 0.99) or jj.runs_for(0.8, 0.99) == 1


def test_recall_counts_every_way_to_lose_a_pair():
    runs, bound = jj.runs_for(0.8, 0.9999), jj.sketch_bound(0.8, 0.9999)
    equal = 0.8 + 0.2 / 256
    below = sum(
        math.comb(jj.TOKENS, n) * equal**n * (1 - equal) ** (jj.TOKENS - n)
        for n in range(round(bound * jj.TOKENS))
    )
    assert below + jj.missed_by_paths(0.8, runs) <= 1e-4
    # One set of tokens for all runs: two runs miss more than the square of what one does.
    assert jj.missed_by_paths(0.8, 2) > jj.missed_by_paths(0.8, 1) ** 2


def bucket(rows):
    names = ["path", "i", "j", "sid", "code", "anchor", "own"]
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    columns[3] = columns[3].cast(pa.binary())
    columns[5] = columns[5].cast(pa.binary())
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    return [
        pair
        for out in jj._bucket_edges(jj.sketch_bound(0.8, 0.9999))(iter([batch]))
        for pair in zip(*(c.to_pylist() for c in out.columns), strict=True)
    ]


def test_classes_of_different_anchors_are_compared():
    code, other = bytes(jj.TOKENS), bytes([1]) * jj.TOKENS
    two = [(1, 0, 0, b"a", code, b"P", 0), (1, 0, 0, b"b", code, b"Q", 0)]
    assert bucket(two) == [(b"a", b"b")]
    same = [(1, 0, 0, b"a", code, b"P", 0), (1, 0, 0, b"b", code, b"P", 0)]
    assert bucket(same) == []
    apart = [(1, 0, 0, b"a", code, b"P", 0), (1, 0, 0, b"b", other, b"Q", 0)]
    assert bucket(apart) == []
    # Of two blocks, what one of them holds alone is named in its own turn.
    blocks = [
        (1, 0, 1, b"a", code, b"P", 0),
        (1, 0, 1, b"b", code, b"Q", 0),
        (1, 0, 1, b"c", code, b"R", 1),
    ]
    assert len(bucket(blocks)) == 1 and b"c" in bucket(blocks)[0]


def test_buckets_of_several_anchors_stay(spark):
    rows = [(1, b"P"), (1, b"Q"), (2, b"P"), (2, b"P"), (3, None), (3, b"P"), (4, None), (4, None)]
    sizes = jj._bucket_sizes(spark.createDataFrame(rows, "path long, anchor binary"))
    assert {r.path: r.alive for r in sizes.collect()} == {1: True, 2: False, 3: True, 4: True}


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(30)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    own = {a for a, b in edges if a != b} | {b for a, b in edges if a != b}
    table = spark.createDataFrame(edges, "a long, b long").repartition(3)
    rows = connected_components(table, "test").collect()
    assert {r.node: r.component for r in rows} == {i: find(i) for i in own}
    assert len(rows) == len(own)


def test_query(spark):
    sf = registry.SMOKE_DIR
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    rows = registry.queries()["op9_jaccard_join"](spark, sf)
    assert found(rows) == expected([d.text for d in docs])


def test_bitmap_never_loses_a_key(spark):
    rows = spark.range(0, 3000).selectExpr("id", "xxhash64(id) h")
    keys = rows.where("id % 7 = 0")
    kept = common.may_hold(rows, common.key_bitmap(keys, "h"), "h", "has").where("has")
    ids = {r.id for r in kept.collect()}
    assert {r.id for r in keys.collect()} <= ids and len(ids) < 450
    none = common.may_hold(rows, common.key_bitmap(keys.limit(0), "h"), "h", "has")
    assert none.where("has").count() == 0 and none.count() == 3000


def test_full_comparisons_of_all_levels_are_one_pass(spark, documents, monkeypatch):
    """Each pass over the buckets costs its shuffles, so there is not one per level."""
    monkeypatch.setattr(jj, "SMALL_BUCKET", 4)
    passes, written = defaultdict(int), jj.stage

    def counted(df, label):
        passes[label] += 1
        return written(df, label)

    monkeypatch.setattr(jj, "stage", counted)
    rng = random.Random(5)
    # A common first half, and a second that two texts share: buckets that are split.
    texts = [f"{prose(8, 90)} {prose(100 + i // 2, 60)}" for i in range(40)]
    texts += [altered(rng, prose(7, 120), rng.randint(0, 3)) for _ in range(30)]
    assert found(jj.link_documents(documents(texts))) == expected(texts)
    assert passes["join-pivots"] > 1
    # Small buckets, and what large ones leave to compare.
    assert passes["join-edges"] == 2


def test_links_of_a_component_are_no_paths():
    """A class is connected with the least of its tree, blocks by the least of theirs."""
    base = np.arange(100, dtype=np.uint64)
    # Each similar to the next few only.
    sets = {bytes([65 + k]): base + np.uint64(5 * k) for k in range(12)}
    names = list(sets)
    rows = {"component": [], "i": [], "j": [], "sid": [], "own": [], "members": [], "shingles": []}
    for i, j in ((0, 0), (0, 1), (1, 1)):
        for k, name in reversed(list(enumerate(names))):
            if k // 6 in (i, j):
                row = (b"c", i, j, name, k // 6, 1, np.sort(sets[name]).tobytes())
                for column, value in zip(rows, row, strict=True):
                    rows[column].append(value)
    batch = pa.RecordBatch.from_pydict(rows)
    out = [r for b in jj._links(0.8)(iter([batch])) for r in common.rows_of(b)]
    assert sorted((a, b) for a, b, _ in out if b is not None) == sorted(
        [(n, names[0]) for n in names[1:6]] + [(n, names[6]) for n in names[7:]]
        + [(names[0], names[6])]
    )
    gained = defaultdict(int)
    for a, b, links in out:
        gained[a] += links
    # 100 - 5 d shared of 100 + 5 d: up to two steps apart.
    assert [gained[n] for n in names] == [2, 3] + [4] * 8 + [3, 2]
