import hashlib
import random

import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st

import __spark_entry__ as registry
from galepost.llm import chat_format as cf

from .conftest import prose

CHAT = (public_tokenizers.path("byte_bpe_50k.json").replace(".json", ".tiktoken"), public_tokenizers.PATTERN)
TRICKY = st.text(alphabet="<|\\>turnagaiexd\n /[]é", max_size=60)


@given(TRICKY)
def test_escape_round_trip(text):
    hidden = cf.escape(text)
    assert cf.unescape(hidden) == text
    assert "<|" not in hidden


@given(st.lists(st.tuples(TRICKY, TRICKY), min_size=1, max_size=5))
def test_windows_can_be_read_back(turns):
    window = "".join(cf.formatted(r, t, i % 2 == 1) for i, (r, t) in enumerate(turns))
    assert list(cf.turns_of(window)) == [(i % 2 == 1, r, t) for i, (r, t) in enumerate(turns)]


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        key = (turn is not None, turn or 0, role or "", text or "")
        by.setdefault(conv, []).append(key)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256(said.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def found(windows):
    return {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        for r in cf.read_back(windows).collect()
    }


SCHEMA = "conv_id long, turn long, role string, text string, window long, conv string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "c") for r in rows], SCHEMA).repartition(3)


def test_edges_and_a_long_conversation(spark):
    rng = random.Random(2)
    rows = [
        (1, 0, "system", "You <|turn|> help."),
        *((1, i, ("user", "assistant")[i % 2], prose(i, rng.randint(1, 60))) for i in range(1, 300)),
        (2, 0, "user", None),
        (2, 1, None, "hm"),
        (2, 1, None, "hm"),
        (2, None, "assistant", "first \\<|end|> é"),
        (None, 0, "user", "who"),
        (None, 1, "assistant", ""),
        (0, 0, "assistant", "x" * 20000),
        (0, 1, "assistant", "y"),
    ]
    windows = cf.chat_windows(table(spark, rows), *CHAT, budget=256, history=64)
    windows = windows.cache()
    assert found(windows) == expected(rows)
    of_one = windows.where("conv_id = 1").orderBy("window").collect()
    assert len(of_one) > 20
    assert max(w.n_tokens for w in of_one) <= 256
    repeats = 0
    for number, window in enumerate(of_one):
        turns = list(cf.turns_of(window.text))
        assert turns[0][1:] == ("system", "You <|turn|> help.")
        assert turns[0][0] == (number > 0)
        repeats += sum(again for again, _, _ in turns[1:])
        taught = [t for again, r, t in turns if not again and r == "assistant"]
        masked = [cf.unescape(window.text[s.start : s.end]) for s in window.loss_spans]
        assert masked == taught
    assert repeats > 5


def test_what_fits_is_one_window(spark):
    """One token less of budget cuts it."""
    long = [(1, i, ("user", "assistant")[i % 2], prose(i, 40)) for i in range(8)]
    rows = [*long, (2, 0, "system", "Be brief."), (2, 1, "assistant", prose(9, 150))]
    rows += [(None, None, None, None)]
    loose = cf.chat_windows(table(spark, rows), *CHAT, budget=100_000, history=64).collect()
    sizes = {w.conv_id: w.n_tokens for w in loose}
    assert len(loose) == len(sizes) == 3
    for budget in (sizes[1], sizes[1] - 1):
        windows = cf.chat_windows(table(spark, rows), *CHAT, budget=budget, history=64).cache()
        assert found(windows) == expected(rows)
        count = {r.conv_id: r["count"] for r in windows.groupBy("conv_id").count().collect()}
        assert (count[1] == 1) == (budget == sizes[1])
        assert count[2] == count[None] == 1
        assert windows.agg({"n_tokens": "max"}).first()[0] <= budget


def test_empty_table(spark):
    windows = cf.chat_windows(table(spark, []), *CHAT)
    assert windows.count() == 0 and cf.read_back(windows).count() == 0


def test_query(spark):
    sf = registry.SMOKE_DIR
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in turns.collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    result = registry.queries()["op3_chat_windows"](spark, sf).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in result}
    assert got == expected(rows)
