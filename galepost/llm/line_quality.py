"""Quality rules: a linear-chain conditional random field labels the lines of a text.

Two states, content and boilerplate. The weights are learned by maximum likelihood from the
lines of labelled documents, which take their document's label, and from documents of both
labels put into each other, in which the label changes: those teach what a change costs.
Viterbi decoding labels the lines of every text, and the share of words in content lines
decides whether it stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, map_batches, rows_of

CONTENT, BOILERPLATE = 0, 1

# The rules before the model.
MIN_WORDS = 50
MAX_REPEATED = 0.5
REPEAT_WIDTH = 3

# Content lines must hold at least this share of the words.
CONTENT_SHARE = 0.5

# Bounds of the training sample: documents of each label and lines of each document.
TRAIN_DOCS = 1500
TRAIN_LINES = 40
EPOCHS = 150

_SYMBOL = re.compile(r"[#*$%&|<>]")
_BLANKS = (" ", "\t", "\n", "\v", "\f", "\r")
_BLANK_CHARS = "".join(_BLANKS)

FEATURES = (
    "bias", "words<4", "words<9", "words>=20", "symbols", "symbols>5%", "symbols>15%",
    "bar", "upper", "exclaims>25%", "ends with stop", "repeats>30%", "repeats>60%",
    "earlier line", "no lower start", "digits", "word>25", "mean word<4", "mean word>9",
    "first", "few words in text",
)
_FIRST, _ALONE = FEATURES.index("first"), FEATURES.index("few words in text")


def line_features(lines: list[str]) -> np.ndarray:
    """A row of 0/1 features for each line."""
    out = np.zeros((len(lines), len(FEATURES)), dtype=np.float32)
    seen: set[str] = set()
    for i, line in enumerate(lines):
        words = line.split()
        n, chars = len(words), len(line)
        symbols = len(_SYMBOL.findall(line))
        distinct = len(set(words))
        longest = max(map(len, words)) if words else 0
        mean = chars / n if n else 0
        marks = line.count("!")
        out[i] = (
            1, n < 4, n < 9, n >= 20, symbols > 0, symbols > 0.05 * chars,
            symbols > 0.15 * chars, "|" in line, line.isupper(), marks > 0.25 * n,
            line.rstrip()[-1:] in (".", "?", "!"), n - distinct > 0.3 * n,
            n - distinct > 0.6 * n, line in seen, not line[:1].isupper(),
            any(c in line for c in "0123456789"), longest > 25, n > 0 and mean < 4, mean > 9,
            i == 0, len(lines) == 1 and n < 20,
        )
        seen.add(line)
    return out


def text_lines(text: str | None) -> list[str]:
    """The lines of a text that hold a word."""
    return [line for line in (text or "").split("\n") if line.strip(_BLANK_CHARS)]


@dataclass(frozen=True)
class LineModel:
    emit: np.ndarray  # features x states
    move: np.ndarray  # from state x to state

    def scores(self, lines: list[str]) -> np.ndarray:
        return line_features(lines) @ self.emit

    def decode(self, lines: list[str]) -> list[int]:
        """The likeliest labels; content wins ties."""
        if not lines:
            return []
        (cc, cb), (bc, bb) = self.move.tolist()
        scores = self.scores(lines).tolist()
        c, b = scores[0]
        back = []
        for score_c, score_b in scores[1:]:
            from_c = c + cc >= b + bc
            to_b = c + cb >= b + bb
            back.append((CONTENT if from_c else BOILERPLATE, CONTENT if to_b else BOILERPLATE))
            c, b = (
                score_c + (c + cc if from_c else b + bc),
                score_b + (c + cb if to_b else b + bb),
            )
        label = CONTENT if c >= b else BOILERPLATE
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def mixed_sequences(
    content: list[np.ndarray], boilerplate: list[np.ndarray], most: int = TRAIN_LINES
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sequences of two documents, one of each label, and the label of each line.

    One follows the other or stands inside it, by turns; the shorter list is gone through
    again, so every document is in one of them. At most ``most`` lines each. None without
    documents of both labels.
    """
    features, labels = [], []
    if not content or not boilerplate:
        return features, labels
    for i in range(max(len(content), len(boilerplate))):
        pair = [
            (content[i % len(content)], CONTENT),
            (boilerplate[i % len(boilerplate)], BOILERPLATE),
        ]
        (outer, a), (inner, b) = pair if i % 2 else pair[::-1]
        outer, inner = outer[: max(most // 2, 1)], inner[: max(most // 2, 1)]
        # Of every four, two begin with the other document or a part of it.
        cut = len(outer) if i // 2 % 2 else len(outer) // 2
        rows = np.concatenate([outer[:cut], inner, outer[cut:]])
        rows[:, _FIRST] = 0
        rows[0, _FIRST] = 1
        rows[:, _ALONE] = 0
        features.append(rows)
        labels.append(np.repeat([a, b, a], [cut, len(inner), len(outer) - cut]))
    return features, labels


def train_lines(
    features: list[np.ndarray],
    labels: list[int | np.ndarray],
    epochs: int = EPOCHS,
    decay: float = 1e-3,
) -> LineModel:
    """Maximum likelihood by full-batch Adam; ``labels`` has one state for all lines of a
    sequence, or one for each.

    Without any sequence the model calls every line content.
    """
    width = len(FEATURES)
    emit, move = np.zeros((width, 2)), np.zeros((2, 2))
    if not features:
        emit[0, CONTENT] = 1.0
        return LineModel(emit.astype(np.float32), move)
    longest = max(map(len, features))
    count = len(features)
    x = np.zeros((longest, count, width), dtype=np.float32)
    live = np.zeros((longest, count), dtype=bool)
    for i, rows in enumerate(features):
        x[: len(rows), i] = rows
        live[: len(rows), i] = True
    gold = np.zeros((longest, count), dtype=np.int64)
    for i, (rows, own) in enumerate(zip(features, labels, strict=True)):
        gold[: len(rows), i] = own
    # Sequences of one label, of the other and of both weigh the same, however many there are.
    kind = 2 * (live & (gold == CONTENT)).any(axis=0) + (live & (gold == BOILERPLATE)).any(axis=0)
    weight = 1 / np.bincount(kind)[kind]
    weight = weight / weight.sum()
    lengths = live.sum(axis=0)
    params = np.concatenate([emit.ravel(), move.ravel()])
    first, second = np.zeros_like(params), np.zeros_like(params)
    target = np.stack([live & (gold == state) for state in (CONTENT, BOILERPLATE)], axis=2)
    moves = np.zeros((2, 2))
    np.add.at(moves, (gold[:-1], gold[1:]), live[1:] * weight)
    for step in range(1, epochs + 1):
        emit, move = params[: 2 * width].reshape(width, 2), params[2 * width :].reshape(2, 2)
        score = x @ emit
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[0] = score[0]
        for t in range(1, longest):
            joint = forward[t - 1][:, :, None] + move
            new = np.logaddexp(joint[:, 0], joint[:, 1]) + score[t]
            forward[t] = np.where(live[t][:, None], new, forward[t - 1])
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        for t in range(longest - 2, -1, -1):
            joint = move + (score[t + 1] + backward[t + 1])[:, None, :]
            new = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            backward[t] = np.where(live[t + 1][:, None], new, backward[t + 1])
        state = np.exp(forward + backward - total[None, :, None]) * live[:, :, None]
        pull = (target - state) * weight[None, :, None]
        grad_emit = np.einsum("tif,tis->fs", x, pull)
        grad_move = moves.copy()
        for t in range(1, longest):
            both = live[t]
            joint = forward[t - 1][:, :, None] + move + (score[t] + backward[t])[:, None, :]
            shares = np.exp(joint - total[:, None, None])
            grad_move -= (shares * (weight * both)[:, None, None]).sum(axis=0)
        grad = np.concatenate([grad_emit.ravel(), grad_move.ravel()]) / max(
            (lengths * weight).sum(), 1e-9
        )
        grad -= decay * params
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        params = params + 0.05 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-8
        )
    emit, move = params[: 2 * width].reshape(width, 2), params[2 * width :].reshape(2, 2)
    return LineModel(emit.astype(np.float32), move)


def fit_line_model(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> LineModel:
    """Learn from at most ``per_label`` documents of each quality label, chosen by a hash.

    Those that the rules reject are not mixed with others: their lines may be like any content.
    Only bounded rows of features reach the driver, never texts.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("__quality"))
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("__quality") == value)
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most two times per_label rows of two numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("quality", pa.int32()),
            ("failed", pa.bool_()),
            ("features", pa.binary()),
        ]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, quality in rows_of(batch):
                lines = text_lines(text)[:TRAIN_LINES]
                if lines:
                    packed = line_features(lines).astype(np.uint8).tobytes()
                    out.append((doc, quality, fails(*measures(text)), packed))
            yield batch_of(out, schema)

    found = map_batches(
        sample.select("doc_id", "text", "__quality"),
        measure,
        "doc_id long, quality int, failed boolean, features binary",
    )
    # Of rows that share an id one is learned from, the same in every run.
    found = found.groupBy("doc_id").agg(
        F.max(F.struct("quality", "failed", "features")).alias("row")
    )
    found = found.select("doc_id", "row.*")
    rows = sorted((r.doc_id, r.quality, r.failed, bytes(r.features)) for r in found.collect())
    features, labels, judged = [], [], ([], [])
    for _, quality, failed, packed in rows:
        features.append(np.frombuffer(packed, dtype=np.uint8).reshape(-1, len(FEATURES)))
        labels.append(CONTENT if quality == 1 else BOILERPLATE)
        if not failed:
            judged[labels[-1]].append(features[-1])
    mixed, changing = mixed_sequences(judged[CONTENT], judged[BOILERPLATE])
    return train_lines(features + mixed, labels + changing)


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line.strip(_BLANK_CHARS):
            if line in seen:
                repeated_lines += 1
            else:
                seen.add(line)
    covered = 0
    if n > REPEAT_WIDTH:
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
        size = n - REPEAT_WIDTH + 1
        _, code = np.unique(ids[:size] * len(known) + ids[1 : size + 1], return_inverse=True)
        _, code, times = np.unique(
            code * len(known) + ids[2 : size + 2], return_inverse=True, return_counts=True
        )
        again = times[code] > 1
        mark = np.zeros(n, dtype=bool)
        for i in range(REPEAT_WIDTH):
            mark[i : size + i] |= again
        covered = int(mark.sum())
    chars = len(text) - sum(text.count(blank) for blank in _BLANKS)
    return n, chars, len(_SYMBOL.findall(text)), repeated_lines, covered


def fails(n_words: int, chars: int, symbols: int, dup_lines: int, repeat_words: int) -> bool:
    """Whether the rules reject a text, whatever the model says."""
    return n_words < MIN_WORDS or repeat_words > MAX_REPEATED * n_words


def judge(model: LineModel, text: str | None) -> tuple:
    """The measures, then whether the rules fail it, whether it stays, its content share and
    the number of content lines."""
    measured = measures(text)
    failed = fails(*measured)
    lines = text_lines(text)
    labels = model.decode(lines)
    content = words = 0
    for line, label in zip(lines, labels, strict=True):
        count = len(line.split())
        words += count
        content += count * (label == CONTENT)
    share = content / words if words else 0.0
    kept = not failed and share >= CONTENT_SHARE
    return *measured, failed, kept, share, labels.count(CONTENT)


_JUDGED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("content_share", pa.float64()),
        ("n_content_lines", pa.int64()),
    ]
)


def quality_of(docs: DataFrame, model: LineModel) -> DataFrame:
    """Measures and verdict of every row; a null or empty text has no words and fails.

    Repeated rows get the same answer; only ``doc_id`` and ``text`` are read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of([(doc, *judge(model, text)) for doc, text in rows_of(batch)], _JUDGED)

    return map_batches(
        docs.select("doc_id", "text"),
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_repeat_words long, base_failed boolean, kept boolean, content_share double,"
        " n_content_lines long",
    )


def keep_quality(docs: DataFrame, model: LineModel) -> DataFrame:
    """The rows that stay, with all their columns.

    A null or empty text goes; repeated rows stay or go together; an empty table gives none.
    """
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(model, text)[6] for text in batch.column(text_at).to_pylist()]
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    return map_batches(docs, run, docs.schema)
