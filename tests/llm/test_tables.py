"""Samples: bounded, the same whatever the order of rows, whole where there are few."""

from pyspark.sql import functions as F

from orderlake.llm.tables import SLACK, few_of, first_of_each


def rows(spark, n):
    return spark.range(n).select(
        (F.col("id") % 2).alias("kind"),
        "id",
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
    )


def test_few_rows_are_left_of_many(spark):
    many = rows(spark, 40_000)
    counts = {r.kind: r["count"] for r in many.groupBy("kind").count().collect()}
    left = many.filter(few_of(F.col("kind"), counts, 100, "id")).groupBy("kind").count().collect()
    assert len(left) == 2 and all(0.7 < r["count"] / (SLACK * 100) < 1.3 for r in left)
    assert many.filter(few_of(F.col("kind"), {}, 100, "id")).count() == 0


def test_small_groups_stay_whole(spark):
    few = rows(spark, 60)
    assert few.filter(few_of(F.col("kind"), {0: 30, 1: 30}, 100, "id")).count() == 60


def test_first_of_each_ignores_order_and_repeats(spark):
    some = rows(spark, 500)
    first = first_of_each(some, "kind", 20).collect()
    again = first_of_each(some.union(some).orderBy(F.rand(1)), "kind", 20).collect()
    assert first == again and len(first) == 40
    assert first_of_each(some.limit(0), "kind", 20).collect() == []
