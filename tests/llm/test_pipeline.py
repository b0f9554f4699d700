import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__ as registry
import corpus_pipeline
from galepost.llm import decontaminate, line_quality, secret_scan
from galepost.llm.chat_format import ranks_of

from .test_jaccard_join import expected


def test_stages_are_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "secrets", "byte_ids",
    ]


def test_stages_keep_the_columns(spark, documents, edge_texts):
    docs = documents(edge_texts)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, registry.SMOKE_DIR).schema == docs.schema


def test_query_against_the_steps_one_by_one(spark):
    sf = registry.SMOKE_DIR
    table = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    model = line_quality.fit_line_model(table, labels)
    docs = sorted((r.doc_id, r.text) for r in table.collect())
    docs = [d for d in docs if line_quality.judge(model, d[1])[6]]
    groups = expected([t for _, t in docs])
    docs = [d for n, d in enumerate(docs) if groups[n][0] == n]
    found = decontaminate.find_in_texts(decontaminate.patterns_of(items), [t for _, t in docs])
    leaks = {n for n, *_ in found}
    docs = [d for n, d in enumerate(docs) if n not in leaks]
    codec = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        special_tokens={},
    )
    want = {}
    for doc, text in docs:
        text = secret_scan.redacted(text)
        ids = codec.encode_ordinary(text)
        want[doc] = (
            len(ids),
            hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
    rows = registry.queries()["pipeline"](spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want
