"""Operator laws: dense ids, windows on gaps and zero bases, one-hot of unseen levels, model
persistence, pivot."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tillstar.operators import windows as W
from tillstar.operators.keys import number_rows


def test_number_rows_dense_in_key_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    out = number_rows(df, ["k"], "kid", start=10, num_partitions=7).collect()
    by_key = sorted(out, key=lambda r: r.k)
    assert [r.kid for r in by_key] == list(range(11, 5011))


def test_lag_by_row_and_zero_base(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 5.0), (dt.date(2020, 3, 1), 0.0), (dt.date(2020, 4, 1), 3.0)],
                               "m date, s double")
    out = df.select("m", W.lag_value("s", ["m"]).alias("lag"), W.pct_diff("s", ["m"]).alias("p")).orderBy("m").collect()
    assert out[1].lag == 5.0  # March's previous row is January (gaps are not filled)
    assert out[2].p is None  # zero base -> NULL


def test_moving_and_running(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "t int, v double")
    got = df.select(W.moving_avg("v", ["t"]).alias("m"), W.running_sum("v", ["t"]).alias("r")).collect()
    assert [r.m for r in got] == [1.0, 1.5, 2.0, 3.0, 4.0]
    assert [r.r for r in got] == [1.0, 3.0, 6.0, 10.0, 15.0]


def test_forecast_pipeline_unseen_category_and_persistence(spark, tmpdir_path):
    from tillstar.plans import forecast

    rows = []
    for p in range(6):
        for m in range(1, 13):
            rows.append((p, f"P{p}", "A" if p % 2 else "B", dt.date(2020, m, 1), float(100 + p * 10 + m),
                         float(99 + p * 10 + m), None, None, None, None, m, float(101 + p * 10 + m)))
    schema = ("product_id long, product_key string, category string, month date, monthly_sales double, "
              "lag_1 double, lag_2 double, lag_3 double, roll3_mean double, prod_mean_sales double, "
              "month_of_year long, next_month double")
    train = spark.createDataFrame(rows, schema)
    model = forecast.fit(train)
    test = spark.createDataFrame([(9, "P9", "ZZ", dt.date(2021, 1, 1), 150.0, 149.0, None, None, None, None, 1, 151.0)],
                                 schema)
    scored = model.transform(test)
    vec = scored.select("cat_vec").first()[0]
    assert vec.numNonzeros() == 0  # unseen category encodes to all zeros
    path = os.path.join(tmpdir_path, "model")
    forecast.save_model(model, path)
    again = forecast.load_model(path)
    a = scored.select("pred_next_month").first()[0]
    b = again.transform(test).select("pred_next_month").first()[0]
    assert abs(a - b) < 1e-9
    m = forecast.metrics(forecast.scores(model, train)).first()
    assert m.test_rows == len(rows) and m.r2 > 0.9


def test_closed_form_is_the_pipeline_and_survives_storage(spark, tmpdir_path):
    """The ridge of the normal equations against MLlib's, on rows with missing values, a constant feature and unseen levels."""
    import random

    from tillstar.plans import forecast, ridge

    some = random.Random(3)
    schema = ("product_id long, product_key string, category string, month date, monthly_sales double, "
              "lag_1 double, lag_2 double, lag_3 double, roll3_mean double, prod_mean_sales double, month_of_year long, next_month double")
    rows = [(k, f"P{k}", some.choice(["A", "B", None, "C"]), dt.date(2020, 1 + k % 12, 1), 1.0, some.uniform(1, 900), some.choice([None, some.uniform(1, 9)]),
             7.0, some.uniform(-5, 5), some.uniform(0, 1e5), 1 + k % 12, some.uniform(0, 1000)) for k in range(200)]
    train = spark.createDataFrame(rows, schema)
    test = spark.createDataFrame([rows[3], rows[7], (9, "P9", "new", dt.date(2021, 1, 1), 1.0, 3.0, None, None, None, None, 13, 5.0)], schema)
    mllib = forecast.scores(forecast.fit(train), test).orderBy("product_id").collect()
    model = ridge.fit(train)
    path = os.path.join(tmpdir_path, "terms")
    ridge.save(model, path)
    again = ridge.load(spark, path)
    assert again.count() == model.count() == 5 + 12 + 4 + 1
    for a, b, c in zip(mllib, *(ridge.score(m, test).orderBy("product_id").collect() for m in (model, again))):
        assert abs(a["pred_next_month"] - b["pred_next_month"]) < 1e-4 and b == c


def test_pivot_heatmap(spark):
    from tillstar.plans.dashboard import pivot_heatmap

    cells = spark.createDataFrame([("E", "X", 1.0), ("E", "Y", 2.0), ("W", "X", 3.0)], "region string, category string, profit double")
    got = {r.region: (r.X, r.Y) for r in pivot_heatmap(cells, ["X", "Y"]).collect()}
    assert got == {"E": (1.0, 2.0), "W": (3.0, None)}


def test_snapshot_written_by_year(spark, tmpdir_path):
    from helpers import SF_SMALL
    from tillstar.plans.dashboard import snapshot, write_snapshot
    from tillstar.plans.star import SourceStar

    s = snapshot(SourceStar(spark, SF_SMALL), years=(1996, 1997))
    path = os.path.join(tmpdir_path, "snap")
    write_snapshot(s.select("l_orderkey", "sales", "order_year"), path)
    back = spark.read.parquet(path)
    assert sorted(r[0] for r in back.select("order_year").distinct().collect()) == [1996, 1997]
    assert back.count() == s.count()


def test_report_json_payload(spark):
    import json

    from helpers import SF_SMALL
    from tillstar.plans import reports
    from tillstar.plans.star import SourceStar

    star = SourceStar(spark, SF_SMALL)
    payload = json.loads(reports.report_json(star).first()["json"])
    direct = reports.sales_by_region(star).collect()
    assert [r["region"] for r in payload] == [r.region for r in direct][:8]
    assert payload[0]["total_sales"] == direct[0].total_sales


def test_hot_key_survivor_is_partially_aggregated(spark):
    from tillstar.operators.stage import first_per_key

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.format_string("%08d", F.col("id")).alias("row_id"),
        (F.col("id") * 2).alias("v"),
    ).repartition(8)
    out = first_per_key(df, "k", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan  # map-side combine before the shuffle
    got = {r.k: r.v for r in out.collect()}
    assert got["HOT"] == 0 and len(got) == 1 + (n - n // 3)
