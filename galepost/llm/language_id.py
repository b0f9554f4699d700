"""Language identification: a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time. It gives every byte of a text
a label; a document's probabilities are the mean of its positions'. Texts are run in windows
of a fixed length, all of them, so one long text is as cheap per byte as many short ones, and
both directions see up to a window of context.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, map_batches

HIDDEN = 8
WINDOW = 64
UNKNOWN = "und"

# Bounds of the training sample: documents of each language, and windows of each document.
TRAIN_DOCS = 800
TRAIN_WINDOWS = 6
STEPS = 250
BATCH = 256

# Windows run together; the arrays of a step then stay in the cache.
RUN_WINDOWS = 1024

_LETTER = re.compile(r"[^\W\d_]")
_PAD = 0  # the byte that fills up a window; its position has no vote


def _gate(x: np.ndarray) -> np.ndarray:
    """A piecewise linear sigmoid, cheap and with a simple derivative."""
    return np.clip(x * 0.25 + 0.5, 0.0, 1.0)


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), for the candidate state."""
    return x / (1.0 + np.abs(x))


@dataclass
class Network:
    """Weights by name: for each direction ``d`` in 0, 1 the byte inputs ``in{d}`` (256 x 3H:
    update, reset, candidate), ``gates{d}`` (H x 2H), ``cand{d}`` (H x H); ``out`` (2H x L),
    ``bias`` (L)."""

    labels: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, labels: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        weights = {}
        for d in (0, 1):
            weights[f"in{d}"] = normal(256, 3 * hidden, scale=0.5)
            weights[f"gates{d}"] = normal(hidden, 2 * hidden, scale=hidden**-0.5)
            weights[f"cand{d}"] = normal(hidden, hidden, scale=hidden**-0.5)
        weights["out"] = normal(2 * hidden, len(labels), scale=0.3)
        weights["bias"] = np.zeros(len(labels), dtype=np.float32)
        return cls(labels, weights)

    @property
    def hidden(self) -> int:
        return self.weights["cand0"].shape[0]

    def _direction(self, windows: np.ndarray, d: int, trace: list | None = None) -> np.ndarray:
        """States after each byte, (length, windows, hidden), at the byte's own place."""
        size, h = self.hidden, None
        table, gates, cand = (self.weights[f"{name}{d}"] for name in ("in", "gates", "cand"))
        length = windows.shape[1]
        states = np.empty((length, len(windows), size), dtype=np.float32)
        h = np.zeros((len(windows), size), dtype=np.float32)
        for t in range(length) if d == 0 else range(length - 1, -1, -1):
            given = table[windows[:, t]]
            opened = h @ gates
            opened += given[:, : 2 * size]
            gate = _gate(opened)
            update, reset = gate[:, :size], gate[:, size:]
            kept = reset * h
            raw = kept @ cand
            raw += given[:, 2 * size :]
            new = _squash(raw)
            if trace is not None:
                trace.append((t, h, gate, kept, raw, new))
            h = h + update * (new - h)
            states[t] = h
        return states

    def _states(self, columns: np.ndarray, d: int) -> np.ndarray:
        """What ``_direction`` gives, as (length, hidden, windows), for windows as columns.

        Features are rows here and every step writes into the same arrays, which halves the
        time of a step.
        """
        size, (length, count) = self.hidden, columns.shape
        table, gates, cand = (self.weights[f"{name}{d}"] for name in ("in", "gates", "cand"))
        table = np.ascontiguousarray(table.T)
        # The slope and middle of the gate are put into the weights.
        table = np.concatenate([table[: 2 * size] * 0.25 + 0.5, table[2 * size :]])
        gates, cand = np.ascontiguousarray(gates.T) * np.float32(0.25), np.ascontiguousarray(cand.T)
        states = np.empty((length, size, count), dtype=np.float32)
        h = np.zeros((size, count), dtype=np.float32)
        gate = np.empty((2 * size, count), dtype=np.float32)
        raw, scale = np.empty_like(h), np.empty_like(h)
        given = np.empty((3 * size, count), dtype=np.float32)
        for t in range(length) if d == 0 else range(length - 1, -1, -1):
            np.take(table, columns[t], axis=1, out=given, mode="clip")
            np.matmul(gates, h, out=gate)
            gate += given[: 2 * size]
            np.maximum(gate, 0, out=gate)
            np.minimum(gate, 1, out=gate)
            np.multiply(gate[size:], h, out=scale)
            np.matmul(cand, scale, out=raw)
            raw += given[2 * size :]
            np.abs(raw, out=scale)
            scale += 1
            raw /= scale
            raw -= h
            raw *= gate[:size]
            np.add(h, raw, out=states[t])
            h = states[t]
        return states

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities (length, labels, windows) of every position."""
        columns = np.ascontiguousarray(windows.T).astype(np.intp)
        out = np.ascontiguousarray(self.weights["out"].T)
        size = self.hidden
        score = np.matmul(out[:, :size], self._states(columns, 0))
        score += np.matmul(out[:, size:], self._states(columns, 1))
        score += self.weights["bias"][:, None]
        score -= score.max(axis=1, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=1, keepdims=True)
        return score

    def gradients(self, windows: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
        """Mean cross entropy over the positions that are not padding, and its gradients, by
        backpropagation through time in both directions."""
        w, size = self.weights, self.hidden
        traces: tuple[list, list] = ([], [])
        states = [self._direction(windows, d, traces[d]) for d in (0, 1)]
        both = np.concatenate(states, axis=2)
        score = both @ w["out"] + w["bias"]
        score -= score.max(axis=2, keepdims=True)
        share = np.exp(score)
        share /= share.sum(axis=2, keepdims=True)
        voting = (windows.T != _PAD)[:, :, None] / max((windows != _PAD).sum(), 1)
        every = np.arange(len(windows))
        loss = float(-(np.log(share[:, every, gold] + 1e-9)[:, :, None] * voting).sum())
        pull = share.copy()
        pull[:, every, gold] -= 1
        pull = (pull * voting).astype(np.float32)
        grads = {name: np.zeros_like(value) for name, value in w.items()}
        grads["out"] = np.einsum("tbh,tbl->hl", both, pull)
        grads["bias"] = pull.sum(axis=(0, 1))
        for d in (0, 1):
            from_out = pull @ w["out"][d * size : (d + 1) * size].T
            carry = np.zeros((len(windows), size), dtype=np.float32)
            for t, h, gate, kept, raw, new in reversed(traces[d]):
                carry = carry + from_out[t]
                update, reset = gate[:, :size], gate[:, size:]
                to_update = carry * (new - h)
                to_raw = carry * update / (1.0 + np.abs(raw)) ** 2
                to_kept = to_raw @ w[f"cand{d}"].T
                to_gate = np.concatenate([to_update, to_kept * h], axis=1)
                to_opened = to_gate * (0.25 * ((gate > 0) & (gate < 1)))
                grads[f"cand{d}"] += kept.T @ to_raw
                grads[f"gates{d}"] += h.T @ to_opened
                given = np.concatenate([to_opened, to_raw], axis=1).astype(np.float32)
                seen, slot = np.unique(windows[:, t], return_inverse=True)
                pick = (slot == np.arange(len(seen))[:, None]).astype(np.float32)
                grads[f"in{d}"][seen] += pick @ given
                carry = carry * (1 - update) + to_kept * reset + to_opened @ w[f"gates{d}"].T
        return loss, grads


def windows_of(texts: list[str], length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts in rows of ``length``, and the text of each row."""
    rows, owner = [], []
    for n, text in enumerate(texts):
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        count = -(-len(data) // length)
        block = np.full(count * length, _PAD, dtype=np.uint8)
        block[: len(data)] = data
        rows.append(block.reshape(count, length))
        owner.append(np.full(count, n))
    if not rows:
        return np.zeros((0, length), dtype=np.uint8), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(owner)


def train(labels: list[str], windows: np.ndarray, gold: np.ndarray, steps: int = STEPS) -> Network:
    """Adam over random batches; every label is drawn equally often."""
    network = Network.fresh(labels)
    if len(windows) == 0 or len(labels) < 2:
        return network
    rng = np.random.default_rng(11)
    by_label = [np.flatnonzero(gold == i) for i in range(len(labels))]
    by_label = [rows for rows in by_label if len(rows)]
    first = {name: np.zeros_like(value) for name, value in network.weights.items()}
    second = {name: np.zeros_like(value) for name, value in network.weights.items()}
    for step in range(1, steps + 1):
        chosen = np.concatenate(
            [rng.choice(rows, max(BATCH // len(by_label), 1)) for rows in by_label]
        )
        _, grads = network.gradients(windows[chosen], gold[chosen])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * min(1.0, 1.0 / max(norm, 1e-9)) * (1 - 0.9 * step / steps)
        for name, grad in grads.items():
            first[name] = 0.9 * first[name] + 0.1 * grad
            second[name] = 0.99 * second[name] + 0.01 * grad * grad
            network.weights[name] = (
                network.weights[name]
                - rate
                * (first[name] / (1 - 0.9**step))
                / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
            ).astype(np.float32)
    return network


def held_out(column: str = "doc_id") -> F.Column:
    """The third of the ids that nothing is learned from; a null id is among them."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(True))


_SAMPLE = pa.schema([("lang", pa.string()), ("windows", pa.binary())])


def fit_languages(
    docs: DataFrame, per_label: int = TRAIN_DOCS, window: int = WINDOW
) -> Network:
    """Learn from at most ``per_label`` documents of each language, chosen by a hash, and
    ``TRAIN_WINDOWS`` windows spread over each of them. Only those windows reach the driver."""
    known = docs.select("doc_id", "text", "lang").where(
        ~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    labels = sorted(r[0] for r in known.select("lang").distinct().collect())
    chosen = None
    for label in labels:
        some = (
            known.where(F.col("lang") == label)
            .select("doc_id", "lang")
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(per_label)
        )
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None:
        return Network.fresh([UNKNOWN])
    # At most per_label rows of an id for each language.
    picked = F.broadcast(chosen.select("doc_id").distinct())

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for text, lang in zip(texts, langs, strict=True):
                rows, _ = windows_of([text], window)
                at = np.unique(np.linspace(0, len(rows) - 1, TRAIN_WINDOWS).astype(int))
                out.append((lang, rows[at].tobytes()))
            yield batch_of(out, _SAMPLE)

    found = map_batches(
        known.join(picked, "doc_id", "left_semi").select("text", "lang"),
        sample,
        "lang string, windows binary",
    )
    rows = sorted((r.lang, bytes(r.windows)) for r in found.collect())
    blocks = [np.frombuffer(data, dtype=np.uint8).reshape(-1, window) for _, data in rows]
    gold = [np.full(len(b), labels.index(lang)) for (lang, _), b in zip(rows, blocks, strict=True)]
    return train(labels, np.concatenate(blocks), np.concatenate(gold))


def pooled(network: Network, texts: list[str], window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """For each text the mean probability of every label over its positions, and the number
    of positions whose own likeliest label is each."""
    windows, owner = windows_of(texts, window)
    total = np.zeros((len(texts), len(network.labels)))
    votes = np.zeros((len(texts), len(network.labels)))
    for start in range(0, len(windows), RUN_WINDOWS):
        part, mine = windows[start : start + RUN_WINDOWS], owner[start : start + RUN_WINDOWS]
        share = network.positions(part)
        best = share.argmax(axis=1)
        live = part.T != _PAD
        share *= live[:, None, :]
        # The windows of a text follow each other.
        first = np.flatnonzero(np.diff(mine, prepend=-1))
        total[mine[first]] += np.add.reduceat(share.sum(axis=0), first, axis=1).T
        for label in range(len(network.labels)):
            own = ((best == label) & live).sum(axis=0)
            votes[mine[first], label] += np.add.reduceat(own, first)
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-9), votes


def label_positions(network: Network, text: str, window: int = WINDOW) -> list[str]:
    """The label of every byte of a text."""
    windows, _ = windows_of([text], window)
    if not len(windows):
        return []
    best = network.positions(windows).argmax(axis=1).T.ravel()
    return [network.labels[i] for i in best[: len(text.encode("utf-8", "surrogatepass"))]]


_PREDICTED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("position_share", pa.float64()),
    ]
)


def predict_languages(docs: DataFrame, network: Network, window: int = WINDOW) -> DataFrame:
    """The likeliest language of every whole text and its pooled probability.

    A null text and one without a letter are ``und`` with score 0. ``position_share`` is the
    share of positions that alone would be given the same label. Ties go to the first label in
    order; repeated rows get the same answer. Prediction reads nothing but the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a few thousand numbers

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            ids, kept, texts = (column.to_pylist() for column in batch.columns)
            found, votes = pooled(network, [text or "" for text in texts], window)
            best = found.argmax(axis=1)
            out = []
            for n, text in enumerate(texts):
                if text is None or not _LETTER.search(text):
                    out.append((ids[n], kept[n], UNKNOWN, 0.0, 0.0))
                    continue
                label = int(best[n])
                share = votes[n, label] / max(votes[n].sum(), 1)
                score = min(max(float(found[n, label]), 0.0), 1.0)
                out.append((ids[n], kept[n], network.labels[label], score, float(share)))
            yield batch_of(out, _PREDICTED)

    return map_batches(
        docs.select("doc_id", held_out().alias("__held_out"), "text"),
        predict,
        "doc_id long, held_out boolean, lang_pred string, score double, position_share double",
    )
