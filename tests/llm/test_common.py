from pyspark.sql import functions as F

from galepost.llm import common, jaccard_join

from .conftest import prose


def test_bitmap_beside_columns_of_its_names(spark):
    rows = spark.range(50).select(
        F.xxhash64("id").alias("h"), "id", *(F.lit(n).alias(n) for n in ("__bucket", "__bits", "__bit"))
    )
    bitmap = common.key_bitmap(rows.where("id < 9"), "h")
    found = common.may_hold(rows, bitmap, "h", "held")
    assert found.columns == [*rows.columns, "held"]
    assert {r.id for r in found.where("held").collect()} == set(range(9))


def test_groups_beside_columns_of_its_names(spark, documents):
    docs = documents([prose(1, 60), prose(1, 60), prose(2, 60)])
    docs = docs.withColumns({"__bucket": F.lit("a"), "__bits": F.lit(1), "___bits": F.lit(2)})
    kept = jaccard_join.keep_one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == 2
