from tillstar.functions.intent import detect_intent


def route(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(detect_intent(df.text)).collect()]


def test_rules_and_order(spark):
    got = route(spark, [
        "Show sales by region", "What is the monthly profit trend?", "Top customers please",
        "best products", "top customers by region sales", "hello", "regional sales",
        "Total REVENUE per Regions", "product history sales",
    ])
    assert got == ["sales_by_region", "monthly_trend", "top_customers", "top_products",
                   "sales_by_region", None, None, "sales_by_region", "monthly_trend"]


def test_unicode_word_boundary(spark):
    # a letter with an accent is part of the word, so "éregion" is not "region"
    assert route(spark, ["éregion sales", "région sales", "region-sales"]) == [None, None, "sales_by_region"]
