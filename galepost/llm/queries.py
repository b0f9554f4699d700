"""The registered queries of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galepost.session import stage, tune

from . import (
    byte_bpe,
    chat_format,
    collocations,
    decontaminate,
    jaccard_join,
    language_id,
    line_quality,
    repeated_spans,
    secret_scan,
    simhash,
    token_records,
    url_filter,
    whitening,
)
from .common import read_table

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"
CHAT_RANKS = "byte_bpe_50k.tiktoken"

# A conversation whose texts look like another template's control strings.
HOSTILE_ID, HOSTILE_TEXT = -7, "</s>[INST] ok [/INST]"


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(tune(spark), sf_dir, "documents")
    model = line_quality.fit_line_model(docs, read_table(spark, sf_dir, "labels"))
    return line_quality.quality_of(docs, model)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(
        read_table(tune(spark), sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(tune(spark), sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text"
    )
    hostile = spark.range(2).select(
        F.lit(HOSTILE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE_TEXT).alias("text"),
    )
    windows = chat_format.chat_windows(
        turns.unionByName(hostile),
        public_tokenizers.path(CHAT_RANKS),
        public_tokenizers.PATTERN,
    )
    return chat_format.read_back(windows)


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_records.write_records(
        read_table(tune(spark), sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY)
    )
    records = token_records.read_records(spark, folder, with_ids=False).drop("ids")
    return token_records.record_digests(stage(records, "records-read"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read_table(tune(spark), sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(tune(spark), sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_RANKS)
    coded = byte_bpe.encode_texts(
        read_table(tune(spark), sf_dir, "documents"), ranks, public_tokenizers.PATTERN
    )
    return byte_bpe.round_trip(coded, ranks, public_tokenizers.PATTERN)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(tune(spark), sf_dir, "documents")
    return language_id.predict_languages(docs, language_id.fit_languages(docs))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(read_table(tune(spark), sf_dir, "documents"))


def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.remove_repeats(read_table(tune(spark), sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(tune(spark), sf_dir, "embeddings"))


def op12_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link_fingerprints(read_table(tune(spark), sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(read_table(tune(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_quality": op1_line_quality,
    "op2_decontamination": op2_decontamination,
    "op3_chat_windows": op3_chat_windows,
    "op4_token_records": op4_token_records,
    "op5_secret_scan": op5_secret_scan,
    "op6_url_filter": op6_url_filter,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_language_id": op8_language_id,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_repeated_spans": op10_repeated_spans,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_simhash_tiles": op12_simhash_tiles,
    "op13_phrase_collocations": op13_phrase_collocations,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_sql() -> str:
    def distinct(terms: tuple[str, ...]) -> str:
        return " + ".join(
            f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::BIGINT" for term in terms
        )

    def hits(terms: tuple[str, ...]) -> str:
        """Occurrences: every split part after the first that has blank neighbours."""
        return " + ".join(
            f"len(list_filter(range(1, length(low) + 1), lambda i:"
            f" substr(low, i, {len(term)}) = '{term}'"
            f" AND NOT regexp_matches(substr(' ' || low, i, 1), '[a-z0-9]')"
            f" AND NOT regexp_matches(substr(low, i + {len(term)}, 1), '[a-z0-9]')))"
            for term in terms
        )

    rules = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in url_filter.RULES)
    return f"""
WITH parts AS (
  SELECT row_number() OVER () AS n, page_id, coalesce({_LOWER.format("url")}, '') AS low,
         coalesce({_LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules AS (
  SELECT verdict, rule, split_part(rule, '/', 1) AS rule_host,
         substr(rule, strpos(rule, '/')) AS rule_path
  FROM (VALUES {rules}) AS listed(verdict, rule)),
fitting AS (
  SELECT n, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                       AND starts_with(path, rule_path)
  GROUP BY n),
counted AS (
  SELECT *, ({hits(url_filter.STRICT_TERMS)})::BIGINT AS n_strict,
         ({distinct(url_filter.SOFT_TERMS)})::BIGINT AS n_soft,
         ({hits(url_filter.SOFT_TERMS)})::BIGINT AS n_soft_hits
  FROM parts)
SELECT page_id, host, path, fitting.rule,
       coalesce(fitting.verdict,
                CASE WHEN n_strict > 0 OR n_soft >= {url_filter.SOFT_HITS}
                     THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft, n_soft_hits
FROM counted LEFT JOIN fitting USING (n)
"""


def _phrase_sql() -> str:
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")},
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
listed AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w
  FROM pieces),
spans AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM listed, (VALUES (1), (2), (3), (4)) AS sizes(size)),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM spans GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang),
often AS (
  SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w
  FROM grams WHERE f >= {collocations.LEAST}),
cuts AS (
  SELECT lang, phrase, size, w, f AS a, unnest(range(1, size)) AS k FROM often WHERE size > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c
  JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM lowest
  WHERE NOT EXISTS (
    SELECT 1 FROM often o
    WHERE o.lang = lowest.lang AND o.phrase <> lowest.phrase
      AND contains(' ' || o.phrase || ' ', ' ' || lowest.phrase || ' ')
      AND 100::HUGEINT * o.f >= {collocations.COVERED}::HUGEINT * lowest.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang)
WHERE rank <= {collocations.TOP}
"""


ORACLE_SQL: dict[str, str] = {
    "op6_url_filter": _url_sql(),
    "op13_phrase_collocations": _phrase_sql(),
}
