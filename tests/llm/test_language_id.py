import zlib

import numpy as np
import pytest

import __spark_entry__ as registry
from galepost.llm import language_id as li

from .conftest import prose


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(1)
    net = li.Network.fresh(["a", "b", "c"], hidden=3)
    net.weights = {k: v.astype(np.float64) * 0.3 for k, v in net.weights.items()}
    windows = rng.integers(1, 256, (4, 6)).astype(np.uint8)
    windows[0, 4:] = 0
    gold = np.array([0, 1, 2, 0])
    _, grads = net.gradients(windows, gold)
    for name, value in net.weights.items():
        at = tuple(int(rng.integers(0, s)) for s in value.shape)
        if name.startswith("in"):
            at = (int(windows[1, 2]), at[1])
        old = value[at]
        value[at] = old + 1e-2
        up, _ = net.gradients(windows, gold)
        value[at] = old - 1e-2
        down, _ = net.gradients(windows, gold)
        value[at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=1e-4)


def test_fast_states_are_the_plain_ones():
    net = li.Network.fresh(["a", "b"])
    windows, _ = li.windows_of([prose(1, 100)])
    columns = np.ascontiguousarray(windows.T).astype(np.intp)
    for d in (0, 1):
        plain = net._direction(windows, d).transpose(0, 2, 1)
        assert np.allclose(net._states(columns, d), plain, atol=1e-5)


def test_pooling_is_the_mean_of_positions():
    net = li.Network.fresh(["a", "b", "c"])
    texts = ["", "x", prose(2, 50), "é" * 70]
    found, votes = li.pooled(net, texts)
    for n, text in enumerate(texts):
        windows, _ = li.windows_of([text])
        if not len(windows):
            assert not found[n].any()
            continue
        share = net.positions(windows)
        live = windows.T != 0
        mean = np.stack([share[:, k][live].mean() for k in range(3)])
        assert np.allclose(found[n], mean / mean.sum(), atol=1e-5)
        assert votes[n].sum() == live.sum() == len(li.label_positions(net, text))


def test_edge_rows(spark, documents, edge_texts):
    docs = documents(edge_texts, [None, *range(1, len(edge_texts))])
    net = li.Network.fresh(["en", "fr"])
    rows = {r.doc_id: r for r in li.predict_languages(docs, net).collect()}
    assert len(rows) == len(edge_texts)
    assert rows[None].held_out and rows[None].lang_pred == "und"
    for n, text in enumerate(edge_texts):
        row = rows[n or None]
        has_letter = any(c.isalpha() for c in text or "")
        assert (row.lang_pred == "und") == (not has_letter)
        assert 0 <= row.score <= 1
    assert rows[7].lang_pred == rows[8].lang_pred and rows[7].score == rows[8].score
    assert li.predict_languages(docs.limit(0), net).count() == 0


def test_nothing_to_learn_from(spark, documents):
    empty = documents(["x"]).limit(0)
    net = li.fit_languages(empty)
    rows = li.predict_languages(documents(["some words", "1 2"]), net).collect()
    assert {r.lang_pred for r in rows} == {"und"}


def test_query_on_held_out_documents(spark):
    sf = registry.SMOKE_DIR
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = registry.queries()["op8_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    held = [r for r in rows if r.held_out]
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
    right = sum(docs[r.doc_id].lang == r.lang_pred for r in held)
    assert right >= 0.95 * len(held)
