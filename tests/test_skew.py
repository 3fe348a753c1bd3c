"""Lookups that split hot keys: equal to the plain join, and even tasks without help from AQE."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tillstar.operators import skew


@pytest.fixture()
def settings(spark):
    """32 shuffle partitions, no AQE, no broadcasts of the planner's own."""
    wanted = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def lines(spark, n=60_000):
    """A third of the rows on one key, a sixth without a key, the rest on keys of their own."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 9000).cast("string")))
    return spark.range(n).select(F.col("id").alias("row_id"), key.alias("k"), (F.col("id") * 2).alias("v"))


def mapping(spark):
    keys = spark.range(9000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("k_id"))
    return keys.where("k_id % 7 <> 0").unionByName(spark.createDataFrame([("hot", -1)], "k string, k_id long"))


def largest_over_median(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / statistics.median(sizes)


def test_hot_keys_are_found(settings):
    hot = skew.hot_keys(lines(settings), ["k", "v"])
    assert [k for k, _ in hot["k"].keys] == ["hot"] and hot["k"].null_salts > 1
    assert not hot["v"]
    assert hot["k"].keys[0][1] == pytest.approx(32 * skew.SALTS_PER_PARTITION / 3, abs=1)


def test_lookup_equals_the_plain_join(settings):
    df, keys = lines(settings), mapping(settings)
    found = skew.lookup(df, keys, "k", skew.hot_keys(df, ["k"])["k"])
    plain = df.join(keys, "k", "left")
    assert found.columns == plain.columns and found.schema == plain.schema
    assert found.count() == 60_000
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0


def test_tasks_are_even_without_aqe(settings):
    """One key in a third of the rows: no task over three times the median; the plain join's largest has far more."""
    df, keys = lines(settings), mapping(settings)
    assert largest_over_median(df.join(keys, "k", "left")) > 5
    assert largest_over_median(skew.lookup(df, keys, "k", skew.hot_keys(df, ["k"])["k"])) <= 3


def test_dates_and_edges(settings):
    """All rows on NULL or one date; no row at all; a mapping without the hot key."""
    day = dt.date(2020, 1, 1)
    rows = [(i, None if i % 2 else day) for i in range(200)]
    df = settings.createDataFrame(rows, "row_id long, d date")
    keys = settings.createDataFrame([(day, 7)], "d date, date_id long")
    hot = skew.hot_keys(df, ["d"])["d"]
    assert hot.keys[0][0] == day and hot.null_salts > 1
    found = skew.lookup(df, keys, "d", hot).collect()
    assert sorted((r["row_id"], r["date_id"]) for r in found) == [(i, None if i % 2 else 7) for i in range(200)]
    assert {r["date_id"] for r in skew.lookup(df, keys.where("false"), "d", hot).collect()} == {None}
    none = skew.hot_keys(df.where("false"), ["d"])["d"]
    assert not none and skew.lookup(df.where("false"), keys, "d", none).count() == 0
