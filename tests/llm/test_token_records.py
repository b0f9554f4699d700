import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registry
from galepost.llm import common
from galepost.llm import token_records as tr

from .conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(texts):
    model = Tokenizer.from_file(PATH)
    return [
        np.array([*x.ids, tr.END_ID], dtype="<u4").tobytes()
        for x in model.encode_batch([t or "" for t in texts], add_special_tokens=False)
    ]


ODD = [
    "don't STOP <|endoftext|> now", "a\tb c d\x1ce\x85f", "İΣσ Σ",
    "é ́x", "12 345'll", "\r\n\n x", "x<|startoftext|>y",
    "one <|endoftext|> two", "<|ENDOFTEXT|>", "a <|endoftext|><|endoftext|>b", "<|endoftext |>",
]


def test_pieces_give_the_ids_of_whole_texts(edge_texts):
    texts = [*(t or "" for t in edge_texts), *ODD]
    texts += ["".join(map(chr, range(start, start + 64))) for start in range(0, 0x300, 64)]
    encode = tr.PieceIds(PATH)
    for _ in range(2):
        got = encode(texts)
        assert [g + np.array([2], "<u4").tobytes() for g in got] == plain_ids(texts)


def test_known_words_are_not_encoded_again(monkeypatch):
    given, encoded = [], tr.PieceIds._encoded

    def seen(self, words):
        given.append(words.to_pylist())
        return encoded(self, words)

    monkeypatch.setattr(tr.PieceIds, "_encoded", seen)
    encode = tr.PieceIds(PATH)
    first, second = "Unbelievable things, 12 things", "things believe, 12 unbelievable 12x things!"
    tail = np.array([tr.END_ID], "<u4").tobytes()
    for texts in ([first], [second, first], [second], [""], []):
        assert [ids + tail for ids in encode(texts)] == plain_ids(texts)
    assert sorted(given[0]) == ["", ",", "12", "things", "unbelievable"]
    assert sorted(given[1]) == ["!", "12x", "believe"]
    assert given[2:] == [[]] * 3


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tr, "KNOWN_BYTES", 2000)
    encode = tr.PieceIds(PATH)
    tail = np.array([tr.END_ID], "<u4").tobytes()
    held = set()
    for n in range(12):
        texts = [f"{prose(n, 20)} w{n} {'y' * 90 * n}", prose(1, 20)]
        assert [ids + tail for ids in encode(texts)] == plain_ids(texts)
        assert encode.known.nbytes <= 2000
        held.add(len(encode.known) > 0)
    assert held == {True, False}


def test_a_worker_holds_small_pools():
    """A worker's memory is that of a pool; two at a time are in an executor beside the JVM."""
    rows = [(n, "x" * 50_000) for n in range(100)]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    batches = iter([common.batch_of(rows[k : k + 20], schema) for k in range(0, 100, 20)])
    pools = list(tr.gathered(batches))
    assert [n for ids, _ in pools for n in ids] == list(range(100))
    assert max(sum(map(len, texts)) for _, texts in pools) <= 2_000_000


def test_records_of_edge_rows(spark, documents, edge_texts, tmp_path):
    texts = [*edge_texts, *ODD]
    ids = [None, *range(len(texts) - 2, 0, -1), 3]
    folder = tr.write_records(documents(texts, ids), PATH, folder=f"file://{tmp_path}/out")
    rows = tr.read_records(spark, folder).collect()
    want = plain_ids(texts)
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in rows) == sorted(
        (d is not None, d or 0, w) for d, w in zip(ids, want, strict=True)
    )
    digest = tr.record_digests(tr.read_records(spark, folder)).collect()
    start = 0
    for row in sorted(digest, key=lambda r: r.start):
        assert row.start == start
        start += row.n_tokens
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(digest, key=lambda r: r.start)]
    assert keys == sorted(keys)


def test_shuffled_read_and_damage(spark, documents, tmp_path):
    folder = tr.write_records(documents([prose(i, 30) for i in range(9)], parts=1), PATH,
                              folder=f"{tmp_path}/out")
    index = spark.read.parquet(f"{folder}/index").orderBy("doc_id").collect()
    want = plain_ids([prose(i, 30) for i in range(9)])
    for n in (5, 0, 8):
        with open(f"{folder}/shard-{index[n].shard:06d}.rec", "rb") as source:
            source.seek(index[n].offset)
            ids = np.frombuffer(tr.read_record(source), dtype=f"<u{index[n].width}")
            assert ids.astype("<u4").tobytes() == want[n]
    record = bytearray(tr.frame(b"12345678"))
    for at in (0, 9, 14, len(record) - 1):
        bad = bytearray(record)
        bad[at] ^= 1
        (tmp_path / "bad").write_bytes(bad)
        with open(tmp_path / "bad", "rb") as source, pytest.raises(ValueError):
            tr.read_record(source)


def test_empty_table(spark, documents, tmp_path):
    folder = tr.write_records(documents(["x"]).limit(0), PATH, folder=f"{tmp_path}/none")
    assert tr.record_digests(tr.read_records(spark, folder)).count() == 0


def test_query(spark):
    sf = registry.SMOKE_DIR
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    rows = registry.queries()["op4_token_records"](spark, sf).collect()
    start, want = 0, []
    for doc, ids in zip(docs, plain_ids([d.text for d in docs]), strict=True):
        want.append((doc.doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(tuple(r) for r in rows) == want
