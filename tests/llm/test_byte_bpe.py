import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as registry
from galepost.llm import byte_bpe
from galepost.llm.chat_format import ranks_of

from .conftest import prose

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=ranks_of(RANKS), special_tokens={}
    )


def expected(codec, text):
    ids = codec.encode_ordinary(text or "")
    packed = np.array(ids, dtype="<u4").tobytes()
    return (
        len(ids),
        hashlib.sha256(packed).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def ragged(seed, size):
    """Runs of letters, blanks, digits and marks, so that boundaries often meet late or never."""
    rng = random.Random(seed)
    out = []
    while size > 0:
        run = rng.choice(["a", " ", "\n", "7", "!", "'s", "é", " \n", "x'll "]) * rng.randint(1, 40)
        out.append(run)
        size -= len(run)
    return "".join(out)


@pytest.mark.parametrize("size,overlap", [(64, 16), (50, 50), (200, 8), (97, 31)])
def test_stitched_chunks_give_the_ids_of_whole_texts(spark, documents, codec, size, overlap):
    texts = [ragged(i, 900) for i in range(12)] + [prose(3, 300), "a" * 500, " " * 400 + "b"]
    coded = byte_bpe.encode_texts(documents(texts), RANKS, PATTERN, size, overlap)
    rows = {r.doc_id: tuple(r)[1:] for r in byte_bpe.round_trip(coded, RANKS, PATTERN).collect()}
    assert rows == {i: expected(codec, t) for i, t in enumerate(texts)}


def test_edge_rows(spark, documents, codec, edge_texts):
    ids = [None, *range(1, len(edge_texts) - 1), 1]
    docs = documents(edge_texts, ids)
    rows = byte_bpe.round_trip(byte_bpe.encode_texts(docs, RANKS, PATTERN), RANKS, PATTERN)
    want = [(d, *expected(codec, t)) for d, t in zip(ids, edge_texts, strict=True)]
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, want))
    none = byte_bpe.encode_texts(docs.limit(0), RANKS, PATTERN)
    assert byte_bpe.round_trip(none, RANKS, PATTERN).count() == 0


def test_query(spark, codec):
    sf = registry.SMOKE_DIR
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = registry.queries()["op7_byte_bpe"](spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {d.doc_id: expected(codec, d.text) for d in docs}
