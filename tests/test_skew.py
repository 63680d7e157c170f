"""One key holds a third of the rows: results stay whole and no task receives the key's rows at once."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstar.operators import dedup, integrity
from tillstar.plans import customers, dashboard, orders_etl, products, sales
from tillstar.sources import orders_feed, workspace

ROWS = 30_000
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def tight(spark):
    """Thresholds a few hundred thousand times smaller than in production, to match the test data."""
    before = {k: spark.conf.get(k, None) for k in TIGHT}
    for key, value in TIGHT.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def skewed(spark):
    """Sales where customer, product and category of a third of all rows are the same."""
    hot, n = F.col("id") % 3 == 0, F.col("id")
    return spark.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("O"), n).alias("order_id"),
        F.when(hot, F.lit("C0")).otherwise(F.concat(F.lit("C"), n % 997 + 1)).alias("customer_id"),
        F.when(hot, F.lit("P0")).otherwise(F.concat(F.lit("P"), n % 211 + 1)).alias("product_id"),
        F.lit("S1").alias("store_id"),
        F.when(hot, F.lit("Toys")).otherwise(F.lit("Books")).alias("product_category"),
        F.lit("online").alias("sales_channel"), F.lit("upi").alias("payment_method"), F.lit("completed").alias("order_status"),
        F.lit("IN").alias("country_code"), F.lit(1).alias("quantity"), (n % 100 + 1).cast("double").alias("unit_price"),
        F.lit(0).alias("discount_pct"), (n % 100 + 1).cast("double").alias("gross_amount"), F.lit(0.0).alias("discount_amount"),
        (n % 100 + 1).cast("double").alias("net_amount"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (n % 300).cast("int")).alias("order_date"), F.lit(None).cast("date").alias("ship_date"),
        F.lit(1).alias("days_to_ship"), F.lit(2024).alias("order_year"), F.lit(1).alias("order_month"), F.lit(1).alias("order_quarter"),
        F.lit(1).alias("day_of_week"), F.lit(False).alias("is_weekend"), F.lit(None).cast("timestamp_ntz").alias("etl_loaded_at"),
    )


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_hot_customer_is_split_in_the_fact_join(spark, skewed, tight, tmp_path):
    path = str(tmp_path / "dim")
    customers.dim_customers(skewed, dt.date(2024, 12, 31)).write.parquet(path)
    fact = sales.fct_sales(skewed, spark.read.parquet(path))
    rows = fact.collect()
    assert len(rows) == len({r.order_id for r in rows}) == ROWS
    assert {r.customer_segment for r in rows if r.customer_id == "C0"} == {"platinum"}
    assert "SortMergeJoin(skew=true)" in final_plan(fact)


def test_a_hot_child_key_is_split_in_the_relationship_test(spark, skewed, tight):
    parent = spark.range(1, 400).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"))
    lost = integrity.relationships(skewed, "customer_id", parent, "customer_id")
    expected = ROWS // 3 + skewed.where("customer_id <> 'C0' and cast(substr(customer_id, 2) as int) >= 400").count()
    assert lost.count() == expected
    keyed = integrity.orphan_keys(skewed, "customer_id", parent, "customer_id")
    assert keyed.agg(F.sum("orphan_rows")).first()[0] == expected


def shuffled_records(frame):
    """Rows each exchange of an executed plan received, by the key it hashes on."""
    frame.collect()
    found = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "ShuffleExchangeExec":
            metric = node.metrics().get("shuffleRecordsWritten").get()
            found.append((node.outputPartitioning().toString(), metric.value()))
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(frame._jdf.queryExecution().executedPlan())
    assert found
    return found


def test_copies_of_a_hot_order_are_dropped_before_the_shuffle(spark, skewed):
    repeated = skewed.withColumn("order_id", F.when(F.col("customer_id") == "C0", F.lit("HOT")).otherwise(F.col("order_id")))
    best = dedup.keep_best(repeated, "order_id", [F.col("order_date").desc(), F.col("net_amount").desc()])
    (_, moved), = shuffled_records(best)
    distinct = ROWS - ROWS // 3
    assert best.count() == distinct + 1
    # At most one candidate per map task remains of the hot order.
    assert moved <= distinct + 8


@pytest.mark.parametrize(
    "report",
    [
        lambda s, d, p: dashboard.top_countries(s, d),
        lambda s, d, p: dashboard.revenue_by_category(s, p),
    ],
)
def test_reports_shuffle_keys_not_sales(spark, skewed, report, tmp_path):
    fact = skewed.withColumn("date_key", F.lit(20240101))
    customers.dim_customers(skewed, dt.date(2024, 12, 31)).write.parquet(str(tmp_path / "c"))
    products.dim_products(skewed).write.parquet(str(tmp_path / "p"))
    frame = report(fact, spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p")))
    # 8 map tasks with at most 998 keys each; the sales themselves never move.
    assert all(moved <= 8 * 998 for _, moved in shuffled_records(frame))


def test_a_hot_product_counts_every_buyer(skewed):
    wide = skewed.withColumn("customer_id", F.when(F.col("product_id") == "P0", F.col("order_id")).otherwise(F.col("customer_id")))
    dim = {r.product_id: r for r in products.dim_products(wide).collect()}
    assert (dim["P0"].unique_buyers, dim["P0"].total_orders, dim["P0"].category) == (ROWS // 3, ROWS // 3, "Toys")
    assert sum(r.total_orders for r in dim.values()) == ROWS


def test_a_hot_month_is_written_by_several_tasks(spark, skewed, tight):
    months = skewed.withColumn("order_month", F.when(F.col("customer_id") == "C0", 6).otherwise(F.month("order_date")))
    back = workspace.persisted(months, "hot_month", ("order_month",))
    assert back.count() == ROWS
    files = back.select("order_month", F.input_file_name().alias("file")).distinct().groupBy("order_month").count()
    assert {r.order_month: r["count"] for r in files.collect()}[6] > 1


def below_the_rebalance(frame):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    return plan.split("RebalancePartitions", 1)[1]


def test_derived_columns_of_staged_orders_do_not_move(spark, raw):
    feed = raw({"order_id": "A"}, {"order_id": "A", "quantity": "3"}, {"order_id": "B", "order_date": "2023-12-31"}, {"order_id": None})
    whole, moved = orders_etl.staged_orders(feed), orders_etl.staged_by_month(feed)
    assert moved.columns == whole.columns
    assert sorted(moved.drop("etl_loaded_at").collect()) == sorted(whole.drop("etl_loaded_at").collect())
    assert not any(name in below_the_rebalance(moved) for name in ("net_amount", "gross_amount", "days_to_ship"))


def test_derived_columns_of_the_fact_do_not_move(spark, skewed):
    segments = spark.createDataFrame([("C0", "gold")], "customer_id string, customer_segment string")
    fact, moved = sales.fct_sales(skewed, segments), sales.fct_sales(skewed, segments, together=True)
    assert moved.columns == fact.columns
    assert sorted(moved.drop("dbt_updated_at").collect(), key=str) == sorted(fact.drop("dbt_updated_at").collect(), key=str)
    assert not any(name in below_the_rebalance(moved) for name in ("sale_key", "date_key"))


def test_a_packed_feed_reads_the_same(raw, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(orders_feed, "ROWS_PER_PACKED_FILE", 2)
    feed = raw(*[{"order_id": f"O{i}", "channel": " In-Store "} for i in range(5)]).coalesce(1)
    orders_feed.write_feed(feed, str(tmp_path / "packed"), packed=True)
    assert len(list((tmp_path / "packed").glob("*.csv.gz"))) == 3
    assert sorted(orders_feed.read_feed(spark, str(tmp_path / "packed")).collect()) == sorted(feed.collect())


def test_small_scans_end_with_the_write_and_yield_to_the_session(spark):
    assert spark.conf.get(workspace.SCAN_BYTES) == workspace.USUAL_SCAN
    with pytest.raises(ZeroDivisionError), workspace.small_scans(spark):
        assert spark.conf.get(workspace.SCAN_BYTES) == workspace.SMALL_SCAN
        1 / 0
    assert spark.conf.get(workspace.SCAN_BYTES) == workspace.USUAL_SCAN
    spark.conf.set(workspace.SCAN_BYTES, "1m")
    with workspace.small_scans(spark):
        assert spark.conf.get(workspace.SCAN_BYTES) == "1m"
    spark.conf.unset(workspace.SCAN_BYTES)


def test_children_of_known_parents_do_not_move(spark):
    """Neither the child nor the parent is small, the keys without a parent are."""
    key = F.concat(F.lit("K"), F.col("id"))
    child = spark.range(0, 20_000).select(key.alias("k"), F.col("id").alias("n")).unionByName(spark.range(1).select(F.lit(None).cast("string").alias("k"), F.lit(-1).alias("n")))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for name in names:
            spark.conf.set(name, "20KB")
        lost = integrity.relationships(child, "k", spark.range(3, 20_000).select(key.alias("p")), "p")
        assert sorted(r.n for r in lost.collect()) == [0, 1, 2]
        assert "BroadcastHashJoin" in final_plan(lost) and "SortMergeJoin" not in final_plan(lost)
    finally:
        for name in names:
            spark.conf.unset(name)
