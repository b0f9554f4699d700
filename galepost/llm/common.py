"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a Python worker holds at a time. Texts may be long, so a batch is short.
BATCH_ROWS = 500

MASK64 = (1 << 64) - 1

_ROOT = str(Path(__file__).resolve().parents[2])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` over short batches, by workers that find this package where it is here."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(columns, schema, strict=True)],
        schema=schema,
    )


def text_key(column: str = "text") -> F.Column:
    """With the id, this tells the rows of a table of texts apart.

    Rows that agree in both are repetitions of one row, and every result is the same for them.
    """
    return F.xxhash64(F.col(column))


# Bits of a key bitmap; 4 MB, whatever the number of keys.
BITMAP_BITS = 1 << 25
_BITMAP_ROW = 1 << 15


def key_bitmap(keys: DataFrame, column: str) -> DataFrame:
    """A bitmap of the hashes in ``column``: at most 1,024 rows of 4 KB."""
    place = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    return keys.select(
        F.floor(place / _BITMAP_ROW).cast("int").alias("__bucket"),
        F.pmod(place, F.lit(_BITMAP_ROW)).alias("__bit"),
    ).groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits"))


def may_hold(rows: DataFrame, bitmap: DataFrame, column: str, flag: str) -> DataFrame:
    """``rows`` with a flag that is false only where no key has the hash in ``column``.

    Before a join this keeps most of the rows without a partner from being moved. A bitmap
    too full to tell keys apart lets all pass, so results never depend on it.
    """
    # Names that ``rows`` does not have.
    free = "_" * max(2, *(len(name) for name in rows.columns))
    bucket, bits = f"{free}bucket", f"{free}bits"
    place = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    bit = F.pmod(place, F.lit(_BITMAP_ROW))
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.pmod(F.floor(byte.cast("int") / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    return (
        rows.withColumn(bucket, F.floor(place / _BITMAP_ROW).cast("int"))
        # Its size is bounded, see key_bitmap.
        .join(F.broadcast(bitmap.toDF(bucket, bits)), bucket, "left")
        .withColumn(flag, F.coalesce(is_set, F.lit(False)))
        .drop(bucket, bits)
    )


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    """64-bit hashes of the words of a text; the cache is cleared when it is full."""

    def __init__(self, entries: int = 300_000):
        self.entries = entries
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Words are what ASCII white space separates."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        known = self.known
        if len(known) > self.entries:
            known.clear()
        out = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = xxhash.xxh3_64_intdigest(word)
                if len(word) <= 64:
                    known[word] = value
            out.append(value)
        return np.array(out, dtype=np.uint64)


def word_shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words.

    A text of fewer words, but at least one, has a single shingle: all of it.
    """
    if len(hashes) == 0:
        return hashes
    width = min(width, len(hashes))
    total = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(total)
