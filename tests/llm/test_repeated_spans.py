import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as registry
from galepost.llm import repeated_spans as rs
from galepost.llm.column_bwt import Collection, range_minima

from .conftest import prose


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, ids, texts, **options):
    rows = rs.remove_repeats(docs, **options).collect()
    want = [(i, *e) for i, e in zip(ids, expected(texts, options["length"]), strict=True)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def brute_rows(texts):
    return sorted(
        (text[i:], n, i) for n, text in enumerate(texts) for i in range(len(text) + 1)
    )


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_transform_and_common_prefixes(block):
    rng = random.Random(block)
    for _ in range(40):
        texts = [
            bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 25)))
            for _ in range(rng.randint(1, 8))
        ]
        built = Collection(texts, 1000, block)
        built.build()
        bwt, lcp, name = (np.concatenate([b for _, b in f.blocks(block)]) for f in built.files)
        rows = [(int(x >> 32), len(texts[x >> 32]) - int(x & 0xFFFFFFFF)) for x in name]
        suffixes = [texts[n][i:] for n, i in rows]
        assert suffixes == sorted(suffixes)
        assert [r[1:] for r in brute_rows(texts)][: len(texts)] == rows[: len(texts)]
        assert lcp.tolist() == [0] + [
            shared(a, b) for a, b in zip(suffixes, suffixes[1:], strict=False)
        ]
        assert bwt.tolist() == [texts[n][i - 1] + 1 if i else 0 for n, i in rows]
        built.close()


def test_range_minima():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1000, 5000).astype(np.uint16)
    low = rng.integers(0, 4999, 300)
    high = low + 1 + (rng.random(300) * (5000 - low - 1)).astype(int)
    want = [int(values[a:b].min()) for a, b in zip(low, high, strict=True)]
    assert range_minima(values, low, high).tolist() == want


def test_finer_pieces_cover_the_strings():
    text = prose(3, 300).encode()
    for start, strings, anchor, key in rs.cut(text, 40, 8):
        for step in (16, 1):
            parts = list(rs.finer(text, key, start, strings, anchor, step, 40))
            starts = [s for _, a, n, _, _ in parts for s in range(a, a + n)]
            assert starts == list(range(start, start + strings))


def passages(seed):
    rng = random.Random(seed)
    common = [prose(900 + i, 30) for i in range(3)]
    texts = []
    for i in range(25):
        parts = [prose(seed * 1000 + i, rng.randint(1, 40))]
        if rng.random() < 0.7:
            part = rng.choice(common)
            cut = rng.randint(0, 40)
            parts.append(part[cut : len(part) - rng.randint(0, 40)])
        parts.append(prose(seed * 1000 + 500 + i, rng.randint(1, 40)))
        texts.append(" ".join(parts))
    return texts + texts[:4]


def test_shared_passages(spark, documents):
    texts = passages(1)
    check(documents(texts), range(len(texts)), texts, length=60)


def test_large_groups_are_cut_finer(spark, documents):
    texts = passages(2)
    options = {"length": 60, "largest_group": 2, "collection": 3}
    check(documents(texts), range(len(texts)), texts, **options)


def test_periodic_and_edge_rows(spark, documents, edge_texts):
    texts = [*edge_texts[:9], "ab" * 300, "x" * 700, "abc" * 100, prose(4, 90), prose(4, 90)]
    ids = [None, *range(1, len(texts) - 1), None]
    check(documents(texts, ids), ids, texts, length=50)


def test_repeated_rows_and_empty_table(spark, documents):
    texts = [prose(1, 100), prose(1, 100), prose(2, 100)]
    check(documents(texts, [3, 3, 4]), [3, 3, 4], texts, length=100)
    assert rs.remove_repeats(documents(["x"]).limit(0)).count() == 0


def test_query(spark):
    sf = registry.SMOKE_DIR
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = registry.queries()["op10_repeated_spans"](spark, sf).collect()
    want = {
        d.doc_id: e for d, e in zip(docs, expected([d.text for d in docs], 400), strict=True)
    }
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want
    assert any(e[1] for e in want.values())
