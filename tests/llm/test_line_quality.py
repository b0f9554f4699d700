import itertools
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as registry
from galepost.llm import line_quality as lq

from .conftest import prose

BLANKS = " \t\n\v\f\r"


def plain_measures(text):
    text = text or ""
    words, word = [], ""
    for char in text + " ":
        if char in BLANKS:
            if word:
                words.append(word)
            word = ""
        else:
            word += char
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines, again = set(), 0
    for line in text.split("\n"):
        if any(c not in BLANKS for c in line):
            again += line in lines
            lines.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def test_measures(edge_texts):
    for text in [*edge_texts[:9], edge_texts[11], "a b c a b c\nx\nx\n\x1cy #|", prose(5, 400)]:
        assert lq.measures(text) == plain_measures(text)


def brute_viterbi(model, lines):
    scores = model.scores(lines)
    best = None
    for labels in itertools.product((0, 1), repeat=len(lines)):
        total = sum(scores[i, s] for i, s in enumerate(labels))
        total += sum(model.move[a, b] for a, b in itertools.pairwise(labels))
        if best is None or total > best[0] + 1e-6:
            best = total, list(labels)
    return best


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(20):
        model = lq.LineModel(
            rng.normal(size=(len(lq.FEATURES), 2)).astype(np.float32), rng.normal(size=(2, 2))
        )
        lines = prose(int(rng.integers(1e6)), 45, line=6).split("\n")[:7]
        found = model.decode(lines)
        scores = model.scores(lines)
        total = sum(scores[i, s] for i, s in enumerate(found))
        total += sum(model.move[a, b] for a, b in itertools.pairwise(found))
        assert total == pytest.approx(brute_viterbi(model, lines)[0], abs=1e-4)


def test_training_separates_lines():
    good = [lq.line_features(prose(i, 60).split("\n")) for i in range(20)]
    bad = [
        lq.line_features([f"menu{i} | home | about"] * 3 + ["buy### now***"]) for i in range(20)
    ]
    model = lq.train_lines(good + bad, [lq.CONTENT] * 20 + [lq.BOILERPLATE] * 20)
    assert set(model.decode(prose(77, 60).split("\n"))) == {lq.CONTENT}
    assert set(model.decode(["menu9 | home | about", "buy### now***"])) == {lq.BOILERPLATE}


def test_without_labels_everything_is_content(spark, documents):
    docs = documents([prose(1, 80)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = lq.fit_line_model(docs, labels)
    assert [r.kept for r in lq.quality_of(docs, model).collect()] == [True]


def test_edge_rows(spark, documents, edge_texts):
    docs = documents(edge_texts, [None, *range(1, len(edge_texts))])
    model = lq.train_lines([], [])
    rows = lq.quality_of(docs, model).collect()
    assert len(rows) == len(edge_texts)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].n_words == 0 and by_id[None].base_failed and not by_id[None].kept
    assert by_id[7].kept and by_id[8].kept and by_id[11].base_failed
    kept = lq.keep_quality(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}
    assert lq.quality_of(docs.limit(0), model).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{registry.SMOKE_DIR}/documents.parquet").collect()
    labels = spark.read.parquet(f"{registry.SMOKE_DIR}/labels.parquet").collect()
    rows = {
        r.doc_id: r
        for r in registry.queries()["op1_line_quality"](spark, registry.SMOKE_DIR).collect()
    }
    assert len(rows) == len(docs)
    for doc in docs:
        row = rows[doc.doc_id]
        want = plain_measures(doc.text)
        assert tuple(row[1:6]) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row.base_failed and row.kept)
    judged = [(rows[x.doc_id], x.quality) for x in labels if not rows[x.doc_id].base_failed]
    right = sum(row.kept == bool(quality) for row, quality in judged)
    assert right >= 0.97 * len(judged)


def test_repeated_ids_fit_the_same_model(spark, documents):
    """Rows beyond the sample's bound do not decide by chance what is learned."""
    good, bad = "A whole sentence stands here and ends.\nAnother one follows it.", "BUY | NOW |\n$$ ** ##"
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    texts = [good, bad] + [f"{good} {i}" for i in range(40)]
    docs = documents(texts, [1, 2] + [1] * 40)
    models = [
        lq.fit_line_model(d, labels, per_label=1) for d in (docs, docs.repartition(5, "text"))
    ]
    assert (models[0].emit == models[1].emit).all() and (models[0].move == models[1].move).all()


def junk(seed, lines):
    rng = np.random.default_rng(seed)
    return [
        " ".join(f"menu{n}{'#$&*'[n % 4] * 3}" for n in rng.integers(10_000, size=7))
        for _ in range(lines)
    ]


def test_mixed_sequences_hold_every_document():
    content = [lq.line_features(prose(i, 90).split("\n")) for i in range(3)]
    other = [lq.line_features(junk(i, 1 + i)) for i in range(5)]
    features, labels = lq.mixed_sequences(content, other, most=8)
    assert len(features) == 5 and all(len(f) == len(y) <= 8 for f, y in zip(features, labels, strict=True))
    first, alone = lq.FEATURES.index("first"), lq.FEATURES.index("few words in text")
    for rows, own in zip(features, labels, strict=True):
        assert set(own) == {lq.CONTENT, lq.BOILERPLATE}
        assert rows[0, first] == 1 and not rows[1:, first].any() and not rows[:, alone].any()
    for i, rows in enumerate(other):
        assert (labels[i] == lq.BOILERPLATE).sum() == min(len(rows), 4)
    assert {tuple(y[np.append(True, np.diff(y) != 0)]) for y in labels} >= {(0, 1), (1, 0)}
    assert lq.mixed_sequences(content, []) == ([], []) == lq.mixed_sequences([], other)


def test_labels_change_inside_a_text(spark, documents):
    texts = [prose(i, 120, line=12) for i in range(30)] + ["\n".join(junk(i, 12)) for i in range(30)]
    labels = spark.createDataFrame(
        [(i, int(i < 30)) for i in range(60)], "doc_id long, quality int"
    )
    model = lq.fit_line_model(documents(texts), labels)
    assert model.move[0, 0] > model.move[0, 1] and model.move[1, 1] > model.move[1, 0]
    above, below = prose(91, 120, line=12).split("\n"), prose(92, 96, line=12).split("\n")
    for planted in (junk(93, 3), junk(94, 6)):
        lines = above + planted + below
        want = [lq.CONTENT] * len(above) + [lq.BOILERPLATE] * len(planted) + [lq.CONTENT] * len(below)
        assert model.decode(lines) == want
        kept, share = lq.judge(model, "\n".join(lines))[6:8]
        assert kept and 0 < share < 1
    mostly = lq.judge(model, "\n".join(above[:3] + junk(95, 20)))
    assert not mostly[5] and not mostly[6] and 0 < mostly[7] < lq.CONTENT_SHARE
