from datetime import date

import pytest
from pyspark.sql import functions as F

from orelake import schemas, vocab
from orelake.operators import encode, evaluate, models
from orelake.plans import exchange, features, gold, layers, silver
from orelake.sources import bronze, generate


def test_generators_fill_the_declared_tables(spark):
    made = {
        "CUSTOMERS": generate.customers(spark, 300),
        "PRODUCTS": generate.products(spark, 60),
        "ORDERS": generate.orders(spark, 500, n_customers=300),
        "PRODUCT_REVIEWS": generate.product_reviews(spark, 200),
        "SUPPORT_TICKETS": generate.support_tickets(spark, 200),
        "CLICKSTREAM": generate.clickstream(spark, 400),
        "IOT_EVENTS": generate.iot_events(spark, 400),
    }
    made["ORDER_ITEMS"] = generate.order_items(made["ORDERS"])
    for name, df in made.items():
        schema = getattr(schemas, name)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema], name
        required = [f.name for f in schema if not f.nullable]
        assert df.filter(" OR ".join(f"{c} IS NULL" for c in required)).count() == 0, name
    o = made["ORDERS"]
    assert {r[0] for r in o.select("REGION").distinct().collect()} <= set(vocab.REGIONS)
    assert {r[0] for r in o.select("ORDER_STATUS").distinct().collect()} <= set(vocab.ORDER_STATUSES)
    assert o.agg(F.min("TOTAL_AMOUNT") >= 50, F.max("TOTAL_AMOUNT") <= 10000).first()[:] == (True, True)
    items = made["ORDER_ITEMS"]
    per_order = items.groupBy("ORDER_ID").count().agg(F.max("count")).first()[0]
    assert per_order <= 3 and 1000 < items.count() < 1400
    assert items.select("ORDER_ITEM_ID").distinct().count() == items.count()
    clicks = made["CLICKSTREAM"]
    assert 0.6 < clicks.filter("USER_ID IS NOT NULL").count() / 400 < 0.95
    alerts = made["IOT_EVENTS"].filter("ALERT_TRIGGERED AND DEVICE_TYPE IN ('motion','pressure')").count()
    assert alerts == 0


def test_generated_rows_do_not_depend_on_partitioning(spark, collect):
    a = generate.customers(spark, 50)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    b = generate.customers(spark, 50)
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert collect(a) == collect(b)
    assert collect(a) != collect(generate.customers(spark, 50, seed=99))


def test_stimulus_increment_and_planning_rows(spark):
    new = generate.new_orders(spark, 50_001)
    assert new.count() == 100 and new.filter("ORDER_STATUS <> 'Pending'").count() == 0
    assert new.agg(F.min("ORDER_ID")).first()[0] == 50_001
    assert generate.new_tickets(spark, 8_001).count() == 50
    assert generate.incremental_clicks(spark).filter("SESSION_ID LIKE 'SES-INC-%'").count() == 1_000
    assert generate.incremental_readings(spark).count() == 500
    assert generate.quarterly_targets(spark, ["A", "B"], [2024, 2025]).count() == 16
    assert generate.campaigns(spark).filter("clicks < impressions").count() == 5


def test_targets_from_sales(spark):
    s = spark.createDataFrame(
        [(date(2023, 1, 1), "EUROPE", "ONLINE", "100.05", 4), (date(2023, 2, 1), "EUROPE", "ONLINE", "0.00", 1), (date(2023, 5, 1), "EUROPE", "ONLINE", "10.00", 3)],
        "MONTH date, REGION string, CHANNEL string, TOTAL_REVENUE string, TOTAL_ORDERS long",
    ).withColumn("TOTAL_REVENUE", F.col("TOTAL_REVENUE").cast("decimal(24,2)"))
    got = exchange.targets_from_sales(s, "1.10").orderBy("FISCAL_QUARTER").collect()
    assert [(r.FISCAL_YEAR, r.FISCAL_QUARTER, str(r.REVENUE_TARGET), r.ORDER_TARGET) for r in got] == [
        (2024, 1, "110.06", 6), (2024, 2, "11.00", 4),
    ]


def test_long_numbers_keep_their_digits(spark):
    from orelake.functions.columns import padded

    ids = spark.createDataFrame([(7,), (99_999,), (100_000,), (1_234_567,), (None,)], "n long")
    assert [r[0] for r in ids.select(padded(F.col("n"))).collect()] == ["00007", "99999", "100000", "1234567", None]
    events = generate.iot_events(spark, 150_000).select("DEVICE_ID").distinct()
    assert events.count() == 150_000


def test_target_attainment(spark):
    t = spark.createDataFrame(
        [("EMEA", "Online", 2024, 1, 100), ("EMEA", "Direct", 2024, 1, 100), (" north america", "Online", 2024, 1, 10), ("ANZ", "Online", 2024, 1, 5)],
        "REGION string, CHANNEL string, FISCAL_YEAR short, FISCAL_QUARTER short, REVENUE_TARGET long",
    ).withColumn("REVENUE_TARGET", F.col("REVENUE_TARGET").cast("decimal(14,2)"))
    s = spark.createDataFrame(
        [(date(2024, 1, 1), "EUROPE", "ONLINE", 80), (date(2024, 3, 1), "EUROPE", "ONLINE", 50), (date(2024, 4, 1), "EUROPE", "ONLINE", 999), (date(2024, 2, 1), "NORTH AMERICA", "ONLINE", 10)],
        "MONTH date, REGION string, CHANNEL string, TOTAL_REVENUE long",
    ).withColumn("TOTAL_REVENUE", F.col("TOTAL_REVENUE").cast("decimal(24,2)"))
    got = {r.REGION: (float(r.ATTAINMENT_PCT), r.STATUS) for r in exchange.target_attainment(t, s, vocab.PLANNING_REGION_MAP).collect()}
    assert got == {"EUROPE": (65.0, "Under"), "NORTH AMERICA": (100.0, "Over")}
    assert exchange.target_attainment(t, s, vocab.PLANNING_REGION_MAP, literal=True).count() == 2 * 3 + 1
    assert exchange.target_attainment(t, s, year=2023).count() == 0


def test_encoders_and_scalers(spark):
    df = spark.createDataFrame([("b", 1.0, 5.0), ("a", 2.0, 5.0), (None, 4.0, 5.0)], "c string, x double, k double")
    got = encode.ordinal_encode(df, "c", "e").orderBy("x").collect()
    assert [r.e for r in got] == [1.0, 0.0, None]
    assert [r.e for r in encode.ordinal_encode(df, "c", "e", ["b", "z"]).orderBy("x").collect()] == [0.0, None, None]
    s = encode.standard_scale(df, ["x", "k"]).orderBy("x").collect()
    assert s[0].x_SCALED == pytest.approx(-1.0690449676) and s[0].k_SCALED == 0.0
    m = encode.minmax_scale(df, ["x", "k"]).orderBy("x").collect()
    assert [r.x_SCALED for r in m] == pytest.approx([0.0, 1 / 3, 1.0]) and m[1].k_SCALED == 0.0
    train, test = encode.hash_split(spark.range(2000), "id")
    assert train.count() + test.count() == 2000 and 0.75 < train.count() / 2000 < 0.85


def test_metrics_agree_with_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (2, 2), (3, 0)], "y int, p int").select(
        *[F.col(c).cast("double").alias(c) for c in ("y", "p")]
    )
    m = evaluate.classification_metrics(pred, "y", "p").first()
    for name, field in [("accuracy", m.ACCURACY), ("weightedPrecision", m.PRECISION_WEIGHTED), ("weightedRecall", m.RECALL_WEIGHTED), ("f1", m.F1_WEIGHTED)]:
        assert field == pytest.approx(MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(pred))
    r = evaluate.regression_metrics(pred, "y", "p").first()
    for name, field in [("mae", r.MAE), ("mse", r.MSE), ("rmse", r.RMSE), ("r2", r.R2)]:
        assert field == pytest.approx(RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(pred))
    assert r.MAPE == pytest.approx(30.0)  # two zero targets left out
    cm = {x.TRUE_CLASS: tuple(x)[1:] for x in evaluate.confusion_matrix(pred, "y", "p", [0, 1, 2, 3]).collect()}
    assert cm == {0.0: (1, 1, 0, 0), 1.0: (0, 1, 0, 0), 2.0: (0, 1, 2, 0), 3.0: (1, 0, 0, 0)}


def test_first_of_tied_models_wins(spark):
    one = spark.createDataFrame([(0.5,)], "F1 double")
    got = {r.MODEL: r.IS_BEST for r in evaluate.compare_models({"rf": one, "lr": one}, "F1").collect()}
    assert got == {"rf": True, "lr": False}


def test_models_train_store_and_score(spark, small, tmp_path):
    tables = {n: f(spark, small) for n, f in bronze.TABLES.items()}
    t = features.ticket_model_table(
        features.ticket_features(tables["support_tickets"], tables["customers"], tables["products"], tables["orders"])
    ).coalesce(1).cache()
    rf = models.train_ticket_classifier(t, features.TICKET_INPUTS, "rf", numTrees=5, maxDepth=3)
    models.save_model(spark, rf, str(tmp_path), "TICKETS", "v1", {"n_features": len(features.TICKET_INPUTS)})
    again = models.load_model(spark, str(tmp_path), "TICKETS")
    a, b = (models.predict(m, t, features.TICKET_INPUTS).orderBy("TICKET_ID").select("PREDICTED").collect() for m in (rf, again))
    assert a == b
    assert models.model_metrics(spark, str(tmp_path), "TICKETS").first().VALUE == "14"
    imp = models.feature_importance(spark, rf, features.TICKET_INPUTS)
    assert imp.count() == 14 and imp.agg(F.sum("IMPORTANCE")).first()[0] == pytest.approx(1.0)
    models.score_view(rf, t, features.TICKET_INPUTS, "scored_tickets")
    assert spark.sql("SELECT TICKET_ID, PREDICTED FROM scored_tickets").count() == t.count()

    r = features.revenue_model_table(
        features.revenue_features(tables["orders"], tables["order_items"], tables["products"])
    ).coalesce(1).cache()
    for kind, extra in (("gbt", {"maxIter": 3, "maxDepth": 2}), ("linear", {})):
        m = models.train_revenue_model(r, features.REVENUE_INPUTS, kind, **extra)
        fit = evaluate.regression_metrics(models.predict(m, r, features.REVENUE_INPUTS), "MONTHLY_REVENUE", "PREDICTED").first()
        assert fit.R2 > 0.3, kind


def test_layers_refresh_and_exports(spark, small, tmp_path):
    tables = {n: f(spark, small) for n, f in bronze.TABLES.items()}
    done = layers.refresh(tables, str(tmp_path / "lake"), date(2001, 8, 2))
    want = gold.sales_summary(silver.orders_enriched(silver.orders_cleaned(tables["orders"]), tables["customers"]))
    assert done["sales_summary"].exceptAll(want).count() == 0
    assert done["top_customers"].count() > 0
    assert set(done) == {
        "orders_cleaned", "orders_enriched", "processed_reviews", "product_sentiment_summary", "customer_order_patterns",
        "monthly_revenue_by_category", "orders_scd2", "daily_order_metrics", "support_ticket_metrics", "sales_summary",
        "customer_360", "product_performance", "top_customers", "monthly_kpi", "product_health",
    }
    out = exchange.export_gold({**tables, **done}, str(tmp_path / "x"), date(2001, 8, 2), "2024-02-01 00:00:00")
    assert all(df.columns[-1] == "EXPORTED_AT" and df.count() > 0 for df in out.values()) and len(out) == 3
    by_region = gold.region_revenue(out["sales_summary"], "NET_REVENUE")
    assert by_region.exceptAll(gold.region_revenue(done["sales_summary"])).count() == 0
    pred = evaluate.prediction_table(
        spark.createDataFrame([(date(2024, 1, 1), "c", 10.0, 8.0)], "ORDER_MONTH date, CATEGORY string, MONTHLY_REVENUE double, P double"),
        "m", "v1", ["ORDER_MONTH", "CATEGORY", "MONTHLY_REVENUE"], "P", "PREDICTED_REVENUE", "MONTHLY_REVENUE",
    )
    out = exchange.export_predictions(pred, str(tmp_path / "p"), "2024-02-01 00:00:00").first()
    assert (out.ACTUAL_REVENUE, out.RESIDUAL, out.PCT_ERROR) == (10.0, 2.0, 20.0)
