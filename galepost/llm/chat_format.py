"""Chat formatting: conversations become budgeted windows with a loss mask.

A window is plain text. Turns that it teaches open with ``<|turn|>``; turns that it repeats
(the system turn, limited history) open with ``<|again|>`` and carry no loss. In texts and
roles one backslash is added inside whatever could be read as a control string, so the
windows can be read back exactly.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.session import stage

from .common import batch_of, map_batches, rows_of
from .running import carried

TURN, AGAIN, SEP, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"

BUDGET_TOKENS = 1024
HISTORY_TOKENS = 256
LOSS_ROLES = ("assistant",)

_BARE = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")
_TURNS = re.compile(
    re.escape(TURN[:2]) + r"(turn|again)\|>(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END),
    re.DOTALL,
)


def escape(text: str) -> str:
    return _BARE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def formatted(role: str, text: str, again: bool = False) -> str:
    return f"{AGAIN if again else TURN}{escape(role)}{SEP}{escape(text)}{END}"


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_SIZED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("part", pa.int32()),
        ("n", pa.int64()),
        ("tokens", pa.int64()),
        ("run_tokens", pa.int64()),
    ]
)


def _sized_turns(turns: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """Turns in order over all tasks, with their tokens and totals within the part.

    A conversation may span parts, so a very long one is not a task of its own.
    """

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = tiktoken.Encoding(
            "turns", pat_str=pattern, mergeable_ranks=ranks_of(ranks_file), special_tokens={}
        )
        part = TaskContext.get().partitionId()
        current, n, total, started = None, 0, 0, False
        for batch in batches:
            out = []
            for conv, role, text in rows_of(batch):
                if not started or conv != current:
                    current, n, total, started = conv, 0, 0, True
                tokens = len(codec.encode_ordinary(formatted(role, text)))
                out.append((conv, role, text, part, n, tokens, total))
                n += 1
                total += tokens
            yield batch_of(out, _SIZED)

    ordered = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).repartitionByRange("conv_id", "turn", "role", "text")
    return map_batches(
        ordered.sortWithinPartitions("conv_id", "turn", "role", "text").select(
            "conv_id", "role", "text"
        ),
        size,
        "conv_id long, role string, text string, part int, n long, tokens long, run_tokens long",
    )


_WINDOW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("text", pa.string()),
        (
            "loss_spans",
            pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
        ),
        ("n_tokens", pa.int64()),
    ]
)


def chat_windows(
    conversations: DataFrame,
    ranks_file: str,
    pattern: str,
    budget: int = BUDGET_TOKENS,
    history: int = HISTORY_TOKENS,
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """Windows ``(conv_id, window, text, loss_spans, n_tokens)`` of all conversations.

    A conversation that fits in the budget is one window. Prefix sums of the turns' tokens cut
    a longer one at multiples of its stride: what the budget leaves beside the system turn, the history and the longest turn. A turn is taught
    in the window in which its prefix sum falls, whole. Turns that begin within ``history``
    tokens before a window are repeated in it without loss, and so is a leading system turn.
    Short of room, the history takes half of it at most. A window exceeds the budget only
    where the system turn and the longest turn alone do not fit in it.

    Rows are ordered by turn (null first), then role and text, so ties and repeated rows have
    a fixed place. Null roles and texts count as empty, a null ``conv_id`` is one
    conversation. Empty tables give no rows; other columns are ignored.
    """
    sized = stage(_sized_turns(conversations, ranks_file, pattern), "turns")
    # Plain columns stand in for keys that may be null.
    keyed = sized.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("conv_null"),
        "*",
    )
    keys = ["conv", "conv_null"]
    parts = keyed.groupBy("part", *keys).agg(
        F.count("*").alias("turns"),
        F.sum("tokens").alias("sum_tokens"),
    )
    starts = carried(parts, "part", keys, ["turns", "sum_tokens"])
    placed = (
        keyed.join(starts, ["part", *keys])
        .withColumn("seq", F.col("n") + F.col("before_turns"))
        .withColumn("at", F.col("run_tokens") + F.col("before_sum_tokens"))
    )
    is_system = (F.col("seq") == 0) & (F.col("role") == "system")
    limits = placed.groupBy(*keys).agg(
        F.max("tokens").alias("longest"),
        F.sum("tokens").alias("total"),
        F.max(F.when(is_system, F.struct("tokens", "role", "text"))).alias("system"),
    )
    whole = F.col("total") <= budget
    limits = limits.withColumn(
        "room", F.lit(budget) - F.col("longest") - F.coalesce(F.col("system.tokens"), F.lit(0))
    ).withColumn(
        "kept",
        F.when(whole, F.lit(0)).otherwise(
            F.greatest(F.least(F.lit(history), F.floor(F.col("room") / 2)), F.lit(0))
        ),
    )
    limits = stage(
        limits.withColumn(
            "stride",
            F.when(whole, F.col("total")).otherwise(
                F.greatest(F.col("room") - F.col("kept"), F.lit(1))
            ),
        ),
        "chat-limits",
    )
    cut = placed.join(limits.select(*keys, "stride", "kept"), keys).withColumn(
        "window", F.floor(F.col("at") / F.col("stride"))
    )
    turn = ["conv_id", "seq", "role", "text", "tokens"]
    taught = cut.select(*keys, "window", F.lit(False).alias("again"), *turn)
    repeated = cut.where(
        ~is_system & (F.col("at") >= (F.col("window") + 1) * F.col("stride") - F.col("kept"))
    ).select(
        *keys, (F.col("window") + 1).alias("window"), F.lit(True).alias("again"), *turn
    )
    opened = taught.where(F.col("window") > 0).select(*keys, "window", "conv_id").distinct()
    system = opened.join(limits.where(F.col("system").isNotNull()), keys).select(
        *keys,
        "window",
        F.lit(True).alias("again"),
        "conv_id",
        F.lit(0).cast("long").alias("seq"),
        "system.role",
        "system.text",
        "system.tokens",
    )
    loss = frozenset(loss_roles)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, window, turns in rows_of(batch):
                if all(turn["again"] for turn in turns):
                    continue
                pieces, spans, at, tokens = [], [], 0, 0
                for turn in turns:
                    piece = formatted(turn["role"], turn["text"], turn["again"])
                    if not turn["again"] and turn["role"] in loss:
                        end = at + len(piece) - len(END)
                        spans.append({"start": end - len(escape(turn["text"])), "end": end})
                    pieces.append(piece)
                    at += len(piece)
                    tokens += turn["tokens"]
                out.append((conv, window, "".join(pieces), spans, tokens))
            yield batch_of(out, _WINDOW)

    # A window holds about a budget of tokens, so its turns fit in a row.
    gathered = (
        taught.unionByName(repeated)
        .unionByName(system)
        .groupBy(*keys, "window")
        .agg(
            F.first("conv_id").alias("conv_id"),
            F.sort_array(
                F.collect_list(F.struct("seq", "again", "role", "text", "tokens"))
            ).alias("turns"),
        )
    )
    return map_batches(
        gathered.select("conv_id", "window", "turns"),
        write,
        "conv_id long, window long, text string,"
        " loss_spans array<struct<start:int,end:int>>, n_tokens long",
    )


def turns_of(window: str) -> Iterator[tuple[bool, str, str]]:
    """(repeated, role, text) of each turn of a window."""
    for m in _TURNS.finditer(window):
        yield m[1] == "again", unescape(m[2]), unescape(m[3])


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_windows", pa.int64()),
        ("max_tokens", pa.int64()),
    ]
)


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation with digests of its turns and of the text under the mask.

    The windows of a conversation pass one by one in order; none is kept.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            out = []
            for conv, _, text, spans, tokens in rows_of(batch):
                if state is None or state[0] != conv:
                    if state:
                        out.append(_closed(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for again, role, said in turns_of(text):
                    if not again:
                        state[1] += 1
                        state[2].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    taught = unescape(text[span["start"] : span["end"]])
                    state[3] += len(taught)
                    state[4].update(taught.encode())
                state[5] += len(text)
                state[6] += 1
                state[7] = max(state[7], tokens)
            yield batch_of(out, _READ)
        if state:
            yield batch_of([_closed(state)], _READ)

    def _closed(state: list) -> tuple:
        conv, turns, said, chars, taught, total, count, most = state
        return conv, turns, said.hexdigest(), chars, taught.hexdigest(), total, count, most

    return map_batches(
        windows.repartition("conv_id").sortWithinPartitions("conv_id", "window"),
        digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
        " loss_sha256 string, formatted_chars long, n_windows long, max_tokens long",
    )
