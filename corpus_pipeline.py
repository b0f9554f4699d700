"""From raw documents to token ids: the operators of ``galepost.llm`` one after another."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from galepost.llm import byte_bpe, decontaminate, jaccard_join, line_quality, secret_scan
from galepost.llm.common import read_table
from galepost.llm.queries import BYTE_RANKS
from galepost.session import stage, tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the line model reject go."""
    model = line_quality.fit_line_model(docs, read_table(spark, sf_dir, "labels"))
    return line_quality.keep_quality(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays."""
    return jaccard_join.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks; every document stays."""
    return secret_scan.redact_secrets(docs)


def byte_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: per document the count and digests of its ids."""
    ranks = public_tokenizers.path(BYTE_RANKS)
    coded = byte_bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN)
    return byte_bpe.round_trip(coded, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("byte_ids", byte_ids),
]

# A trained model and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``, each written and read again."""
    docs = read_table(tune(spark), sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
