from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orelake import schemas
from orelake.operators.history import scd2_from_log, table_changes
from orelake.plans import metrics
from orelake.plans.silver import orders_cleaned, orders_enriched
from orelake.sources import bronze, files, sinks
from orelake.streaming import jobs

CAMPAIGNS = """CAMPAIGN_ID,CAMPAIGN_NAME,CAMPAIGN_TYPE,START_DATE,END_DATE,TARGET_SEGMENT,BUDGET_USD,SPEND_USD,IMPRESSIONS,CLICKS,CONVERSIONS
C1,"Spring, first wave",Email,2024-03-01,2024-03-31,SMB,100.50,90,10,5,1
C2,  padded  ,NULL,03/01/2024,null,,100,90,10,5,1
C3,short row,Email
C4,long row,Email,2024-03-01,2024-03-31,SMB,1,1,1,1,1,extra,more
C5,bad number,Email,2024-03-01,2024-03-31,SMB,abc,90,10,5,1
C6,NULL,Email,2024-03-01,2024-03-31,SMB,1,1,1,1,1
"""
STORE_HEAD = "STORE_ID,STORE_NAME,REGION,CITY,STATE,COUNTRY,STORE_TYPE,OPEN_DATE,IS_ACTIVE\n"


def test_campaign_feed(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CAMPAIGNS)
    got = {r.CAMPAIGN_ID: r for r in files.load_campaigns(spark, str(tmp_path), "2024-05-01 00:00:00").collect()}
    assert sorted(got) == ["C1", "C2", "C3", "C4"]
    assert got["C1"].CAMPAIGN_NAME == "Spring, first wave" and got["C1"].BUDGET_USD == D("100.50")
    assert got["C2"].CAMPAIGN_NAME == "padded" and got["C2"].CAMPAIGN_TYPE is None
    assert got["C2"].START_DATE is None and got["C2"].END_DATE is None and got["C2"].TARGET_SEGMENT is None
    assert got["C3"].BUDGET_USD is None and got["C4"].CONVERSIONS == 1
    assert got["C1"].START_DATE == date(2024, 3, 1)
    assert got["C1"].SOURCE_FILE.endswith("c.csv") and got["C1"].LOADED_AT == datetime(2024, 5, 1)
    raw = files.read_csv_feed(spark, str(tmp_path), schemas.CAMPAIGNS_FEED.schema)
    log = files.load_log(files.typed_rows(raw, schemas.CAMPAIGNS_FEED, "2024-05-01 00:00:00"), "MARKETING_CAMPAIGNS")
    r = files.load_history(log).first()
    assert (r.TABLE_NAME, r.STATUS, r.ROW_COUNT, r.ERROR_COUNT) == ("MARKETING_CAMPAIGNS", "PARTIALLY_LOADED", 4, 2)
    assert files.load_history(log, "2024-06-01 00:00:00").count() == 0


def test_target_and_store_feeds(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text(
        "REGION,CHANNEL,FISCAL_YEAR,FISCAL_QUARTER,REVENUE_TARGET,ORDER_TARGET,CUSTOMER_TARGET\nEMEA,Online,2024,1,5200000.00,20800,16640\nAPAC,Online,2024,2,4200000,16800,13440\n"
    )
    t = files.load_targets(spark, str(tmp_path / "t"), first_id=5)
    assert t.columns[0] == "TARGET_ID" and len({r.TARGET_ID for r in t.collect()}) == 2
    assert t.agg(F.min("TARGET_ID")).first()[0] >= 5
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text(STORE_HEAD + "S1,Main,EU,X,,DE,Outlet,2020-01-01,TRUE\n")
    s = files.load_stores(spark, str(tmp_path / "s")).first()
    assert s.IS_ACTIVE is True and s.STATE is None


def test_json_feed(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "name": null}, {"id": 2, "name": "b"}]')
    got = files.read_json_feed(spark, str(tmp_path / "a.json"), schemas.struct("id long", "name string"))
    assert sorted(map(tuple, got.collect())) == [(1, None), (2, "b")]


def test_ingest_takes_each_file_once(spark, tmp_path):
    landing, out, ckpt = (str(tmp_path / n) for n in ("landing", "out", "ckpt"))
    (tmp_path / "landing").mkdir()

    def ingest(at):
        jobs.ingest_stream(spark, landing, out, ckpt, schemas.STORES_FEED, at)
        return spark.read.parquet(f"{out}/data")

    (tmp_path / "landing" / "1.csv").write_text(STORE_HEAD + "S1,Main,EU,X,,DE,Outlet,2020-01-01,TRUE\nS2,Side,EU,X,,DE,Outlet,soon,perhaps\n")
    assert ingest("2024-01-01 00:00:00").count() == 1
    assert ingest("2024-01-02 00:00:00").count() == 1  # nothing new
    (tmp_path / "landing" / "2.csv").write_text(STORE_HEAD + "S3,Third,EU,X,,DE,Outlet,2020-01-01,FALSE\n")
    assert sorted(r.STORE_ID for r in ingest("2024-01-03 00:00:00").collect()) == ["S1", "S3"]
    assert [r.STORE_ID for r in spark.read.parquet(f"{out}/rejected").collect()] == ["S2"]
    history = [(r.FILE_NAME[-5:], r.STATUS, r.ROW_COUNT, r.ERROR_COUNT) for r in files.load_history(spark.read.parquet(f"{out}/log")).collect()]
    assert history == [("2.csv", "LOADED", 1, 0), ("1.csv", "PARTIALLY_LOADED", 1, 1)]


def test_streamed_history_equals_one_batch_after_another(spark, small, tmp_path):
    before, after = bronze.orders_before(spark, small), bronze.orders_after(spark, small)
    steps = [
        ("2001-01-01 00:00:00", table_changes(before.limit(0), before, "ORDER_ID")),
        ("2001-08-02 00:00:00", table_changes(before, after, "ORDER_ID")),
    ]
    want = None
    for n, (at, changes) in enumerate(steps):
        changes = changes.withColumns({"_commit": F.lit(n).cast("long"), "_committed_at": F.lit(at).cast("timestamp_ntz")})
        changes.write.mode("append").parquet(str(tmp_path / "landing"))
        source = jobs.change_source(spark, str(tmp_path / "landing"), changes.schema)
        for _ in range(2):  # the second run finds nothing
            jobs.order_history_stream(source, str(tmp_path / "log"), str(tmp_path / "ckpt"))
        want = metrics.orders_scd2(want, changes, at)
    for max_files in (None, 1, 1000):  # the log above; one run over both commits, file by file and at once
        log = str(tmp_path / (f"log{max_files}" if max_files else "log"))
        if max_files:
            source = jobs.change_source(spark, str(tmp_path / "landing"), changes.schema, max_files)
            jobs.order_history_stream(source, log, f"{log}-ckpt")
        got = scd2_from_log(jobs.read_change_log(spark, log), "ORDER_ID")
        want = want.select(*got.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):  # batch numbers would begin again
        jobs.order_history_stream(source, log, str(tmp_path / "another"))


def test_ticket_metrics_and_enrichment_streams(spark, small, tmp_path):
    tickets = bronze.support_tickets(spark, small)
    feed = table_changes(tickets.limit(0), tickets, "TICKET_ID")
    feed.write.parquet(str(tmp_path / "tickets"))
    source = jobs.change_source(spark, str(tmp_path / "tickets"), feed.schema)
    jobs.ticket_metrics_stream(source, str(tmp_path / "tm"), str(tmp_path / "tc"), date(2001, 8, 2))
    assert spark.read.parquet(str(tmp_path / "tm")).agg(F.sum("TICKET_COUNT")).first()[0] == tickets.count()

    orders, people = bronze.orders(spark, small), bronze.customers(spark, small)
    orders.write.parquet(str(tmp_path / "orders"))
    jobs.enrich_stream(
        jobs.change_source(spark, str(tmp_path / "orders"), orders.schema), people, str(tmp_path / "eo"), str(tmp_path / "ec")
    )
    got, want = spark.read.parquet(str(tmp_path / "eo")), orders_enriched(orders_cleaned(orders), people)
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_a_stream_can_start_at_the_present(spark, tmp_path):
    src, ckpt, seen = str(tmp_path / "src"), str(tmp_path / "ckpt"), []
    schema = spark.range(1).schema

    def source():
        return jobs.change_source(spark, src, schema)

    spark.range(3).write.parquet(src)
    jobs.skip_existing(source(), ckpt)
    spark.range(10, 12).write.mode("append").parquet(src)
    jobs.run_available(source(), lambda b, i: seen.extend(r.id for r in b.collect()), ckpt)
    assert sorted(seen) == [10, 11]


def test_daily_refresh_recomputes_only_touched_days(spark, small):
    before, after = bronze.orders_before(spark, small), bronze.orders_after(spark, small)
    changes = table_changes(before, after, "ORDER_ID")
    history = metrics.orders_scd2(None, table_changes(before.limit(0), before, "ORDER_ID"), "2001-01-01 00:00:00")
    history = metrics.orders_scd2(history, changes, "2001-08-02 00:00:00")
    old = metrics.refresh_daily(
        spark.createDataFrame([], schemas.DAILY_ORDER_METRICS),
        metrics.orders_scd2(None, table_changes(before.limit(0), before, "ORDER_ID"), "2001-01-01 00:00:00"),
        "2001-01-01 00:00:00",
    )
    part = metrics.refresh_daily(old, history, "2001-08-02 00:00:00", changes).drop("UPDATED_AT")
    full = metrics.refresh_daily(old, history, "2001-08-02 00:00:00").drop("UPDATED_AT")
    assert part.exceptAll(full).count() == 0 and full.exceptAll(part).count() == 0


def test_append_defaults_export_snapshots_and_counts(spark, tmp_path):
    df = spark.createDataFrame([(9, datetime(2024, 1, 1))], "CUSTOMER_ID long, ORDER_DATE timestamp_ntz")
    full = sinks.append_with_defaults(df, schemas.ORDERS, {"SOURCE_SYSTEM": F.lit("NATIVE"), "DISCOUNT_AMOUNT": F.lit(0)}, "ORDER_ID", 100)
    r = full.first()
    assert full.columns == schemas.ORDERS.fieldNames()
    assert r.ORDER_ID >= 100 and r.SOURCE_SYSTEM == "NATIVE" and r.DISCOUNT_AMOUNT == 0 and r.REGION is None

    path = str(tmp_path / "t")
    assert [tuple(x) for x in _start(sinks, full, path).collect()] == [("BEFORE", "ORDERS", 1), ("AFTER", "ORDERS", 2)]

    out = sinks.export(full, str(tmp_path / "x"), ["ORDER_ID"], "2024-02-02 00:00:00")
    assert [tuple(x) for x in out.collect()] == [(r.ORDER_ID, datetime(2024, 2, 2))]

    snap = str(tmp_path / "snap")
    sinks.publish_snapshot(spark.range(2), snap, 1)
    sinks.publish_snapshot(spark.range(5), snap, 2)
    assert sinks.read_snapshot(spark, snap).count() == 5 and sinks.read_snapshot(spark, snap, 1).count() == 2

    got = sinks.row_counts({"B": spark.range(3), "A": spark.range(1)})
    assert [tuple(x) for x in got.collect()] == [("A", 1), ("B", 3)]


def _start(sinks, df, path):
    df.write.parquet(path)
    return sinks.append_and_reconcile(df, path, "ORDERS")


def test_catalog_listing(spark):
    spark.range(1).createOrReplaceTempView("listed_view")
    assert "listed_view" in {r.TABLE_NAME for r in sinks.list_tables(spark, ["default"]).collect()}


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_read_table_formats(spark, tmp_path, fmt):
    spark.range(4).write.format(fmt).save(str(tmp_path / fmt))
    assert files.read_table(spark, str(tmp_path / fmt), fmt).count() == 4


def test_daily_metrics_follow_the_changes(spark, tmp_path):
    ddl = (
        "ORDER_ID long, CUSTOMER_ID long, ORDER_DATE timestamp_ntz, ORDER_STATUS string, TOTAL_AMOUNT decimal(12,2), "
        "DISCOUNT_AMOUNT decimal(10,2), SHIPPING_AMOUNT decimal(10,2), REGION string, CHANNEL string, SOURCE_SYSTEM string, "
        "_action string, _is_update boolean, _commit long, _committed_at timestamp_ntz"
    )

    def image(key, day, total, action, update, commit):
        at = datetime(2024, 1, 1 + commit)
        return (key, key, day, "New", D(total), D(0), D(0), "EU", "Web", "X", action, update, commit, at)

    jan, feb = datetime(2024, 1, 5, 10), datetime(2024, 2, 7, 11)
    commits = [
        [image(1, jan, 10, "INSERT", False, 0), image(2, jan, 20, "INSERT", False, 0), image(3, feb, 30, "INSERT", False, 0)],
        [image(3, feb, 30, "DELETE", False, 1), image(1, jan, 10, "DELETE", True, 1), image(1, jan, 15, "INSERT", True, 1)],
    ]
    base = str(tmp_path)
    for rows in commits:
        changes = spark.createDataFrame(rows, ddl)
        changes.write.mode("append").parquet(f"{base}/landing")
        source = jobs.change_source(spark, f"{base}/landing", changes.schema)
        jobs.daily_metrics_stream(source, f"{base}/log", f"{base}/daily", f"{base}/ckpt")
    got = [(str(r.METRIC_DATE), r.ORDER_COUNT, int(r.TOTAL_REVENUE)) for r in jobs.read_daily(spark, f"{base}/daily").collect()]
    assert got == [("2024-01-05", 2, 35)]
