"""What the optimizer makes of the plans, and that nothing runs before it is asked to."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import orderflow as of
from orderflow.schemas import ACCOUNTS, ORDERS, TRANSACTIONS
from tests.frames import rows

DAYS = 8 * 30


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Parquet inputs over eight months. A third of the orders is of one account, a third
    has the same order id and a sixth has none; a third of the payments is for that id."""
    folder = tmp_path_factory.mktemp("shop")
    number = F.col("id")
    sold = spark.range(0, 24_000, 1, 8).select(
        F.when(number % 6 < 2, "O-hot")
        .when(number % 6 < 5, F.concat(F.lit("O"), number.cast("string")))
        .alias("order_id"),
        F.when(number % 3 == 0, "A-hot").otherwise(F.concat(F.lit("A"), number % 1000)).alias("account_id"),
        F.date_add(F.lit(date(2024, 1, 1)), (number / (24_000 / DAYS)).cast("int")).alias("order_date"),
        (F.xxhash64("id") % 10_000 / 4).alias("total_amount"),
        (number % 7).cast("int").alias("product_count"),
        F.when(number % 11 == 0, "CANCELLED").otherwise("COMPLETED").alias("status"),
    )
    paid = spark.range(0, 30_000, 1, 8).select(
        F.concat(F.lit("T"), number.cast("string")).alias("transaction_id"),
        F.when(number % 3 == 0, "O-hot").otherwise(F.concat(F.lit("O"), number % 24_000)).alias("order_id"),
        F.lit(0.25).alias("amount"),
        F.lit("2024-01-01").cast("timestamp").alias("transaction_date"),
        F.lit("SUCCESS").alias("status"),
    )
    known = spark.range(1000).select(
        F.concat(F.lit("A"), number).alias("account_id"),
        F.lit("Name").alias("customer_name"),
        F.lit(5).alias("order_limit"),
        F.lit(None).cast("date").alias("created_date"),
        F.lit("ACTIVE").alias("status"),
    )
    paths = {}
    for name, table, schema in (
        ("accounts", known, ACCOUNTS),
        ("orders", sold, ORDERS),
        ("transactions", paid, TRANSACTIONS),
    ):
        paths[f"{name}_path"] = f"{folder}/{name}.parquet"
        table.select(*schema.names).write.option("parquet.block.size", 1 << 14).parquet(
            paths[f"{name}_path"]
        )
    return paths


@pytest.fixture
def settings(spark):
    """Set options for one test."""
    saved = {}

    def set_all(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            saved[key] = spark.conf.get(key)
            spark.conf.set(key, value)

    yield set_all
    for key, value in saved.items():
        spark.conf.set(key, value)


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def _final_plan(frame) -> str:
    return _plan(frame).split("== Initial Plan ==")[0]


def _exchanges(frame) -> int:
    return len(re.findall(r"\bExchange hashpartitioning", _plan(frame)))


def _scans(frame, column: str) -> int:
    """Scans that read the column, in the plan that ran if it did."""
    return len(re.findall(rf"ReadSchema: struct<[^>]*\b{column}:", _final_plan(frame)))


def _load(spark, shop):
    return (
        of.load_orders(spark, shop["orders_path"]),
        of.load_transactions(spark, shop["transactions_path"]),
        of.load_accounts(spark, shop["accounts_path"]),
    )


def test_nothing_runs_before_it_is_asked_to(spark, shop):
    # Everything here is a transformation; a job in one of them would carry the group.
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job expected")
    try:
        of.run_pipeline(spark, **shop)
        of.run_rag_analysis(spark, **shop)
        orders, transactions, accounts = _load(spark, shop)
        of.payment_reconciliation(of.join_orders_with_transactions(orders, transactions))
        classified = of.classify_orders(orders, accounts, "ALL", with_violations=True)
        of.calculate_customer_risk_score(classified, per_failure=True)
        output = of.split_by_validation(classified)
        of.result_summary(output.result_table)
        of.holding_summary_total(output.holding_table)
        of.rag_tables(orders, accounts, "ALL")
        assert list(tracker.getJobIdsForGroup("building")) == []
        classified.count()
        assert list(tracker.getJobIdsForGroup("building")) != []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("month", [None, "2024-03", "ALL"])
def test_unused_payments_are_never_read(spark, shop, month):
    for table in (
        of.run_pipeline(spark, **shop, target_month=month).result_table,
        of.run_rag_analysis(spark, **shop, target_month=month),
    ):
        assert "transactions.parquet" not in _plan(table)
        assert "transaction_id" not in _plan(table)


def test_month_and_status_reach_the_scan(spark, shop, settings):
    settings(maxMetadataStringLength="1000")
    plan = _plan(of.run_pipeline(spark, **shop, target_month="2024-03").result_table)
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    for part in (
        "In(status, [COMPLETED,PENDING])",
        "GreaterThanOrEqual(order_date,2024-03-01)",
        "LessThan(order_date,2024-04-01)",
    ):
        assert part in pushed


def _scanned_rows(frame) -> list[int]:
    """Rows put out by each file scan of the executed plan, subqueries included."""
    frame.collect()
    found = []

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        if kind == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())
        for branch in (node.subqueries(), node.children()):
            for i in range(branch.size()):
                visit(branch.apply(i))

    visit(frame._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("rag", [False, True])
def test_latest_month_skips_older_row_groups(spark, shop, rag):
    orders, _, accounts = _load(spark, shop)
    classify = of.classify_rag if rag else of.classify_orders
    scanned = _scanned_rows(classify(orders, accounts).agg(F.sum("monthly_total")))
    # The latest month is found in one pass over dates and statuses; the second
    # pass over the orders reads one or two months of eight.
    assert sorted(scanned)[-1] == 24_000
    assert sorted(scanned)[-2] < 24_000 * (0.5 if rag else 0.3)


def test_shuffles(spark, shop, settings):
    settings(autoBroadcastJoinThreshold="-1")
    orders, transactions, accounts = _load(spark, shop)
    assert _exchanges(of.calculate_monthly_totals(orders)) == 1
    assert _exchanges(of.payment_summary(transactions)) == 1
    # Monthly totals, then both sides by account.
    totals = of.calculate_monthly_totals(orders)
    assert _exchanges(of.enrich_with_account_data(totals, accounts)) == 3
    # The window's partitioning serves the join with the accounts.
    every = of.compare_with_previous_month(orders, "ALL")
    assert _exchanges(of.enrich_with_account_data(every, accounts)) == 3
    # One month needs no window: orders by account and accounts by account.
    single = of.compare_with_previous_month(orders, "2024-03")
    single = of.enrich_with_account_data(single, accounts)
    assert _exchanges(single) == 2
    assert "Window" not in _plan(single)


@pytest.mark.parametrize("month", ["2024-03", None])
def test_one_month_is_validated_in_two_shuffles(spark, shop, settings, month):
    """Orders by account and accounts by account; the check for repeats adds none."""
    settings(autoBroadcastJoinThreshold="-1")
    orders, _, accounts = _load(spark, shop)
    for table in (
        of.classify_orders(orders, accounts, month),
        of.classify_rag(orders, accounts, month),
    ):
        assert _exchanges(table) == 2
        assert _plan(table).count("ReadSchema: struct<account_id:string,customer_name:") == 1
    both = accounts.union(accounts.limit(1))
    with pytest.raises(Exception, match="account listed more than once"):
        of.classify_orders(orders, both, month).collect()


def test_partial_aggregation_precedes_every_shuffle_of_totals(spark, shop):
    orders, transactions, _ = _load(spark, shop)
    for frame in (of.calculate_monthly_totals(orders), of.payment_summary(transactions)):
        plan = _plan(frame)
        assert plan.index("Exchange") < plan.index("partial_sum")


SPLITTING = {
    "autoBroadcastJoinThreshold": "-1",
    "adaptive__advisoryPartitionSizeInBytes": "16KB",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "32KB",
    "adaptive__skewJoin__skewedPartitionFactor": "2",
    "shuffle__partitions": "16",
}


def _digest(frame):
    """Number of rows, and a value that needs every column, as a write would."""
    return frame.agg(F.count("*"), F.sum(F.xxhash64(*frame.columns) % 1000))


def test_repeated_order_id_is_split(spark, shop, settings):
    orders, transactions, _ = _load(spark, shop)
    plain = orders.join(of.payment_summary(transactions), "order_id", "left").na.fill(0)
    expected = rows(plain.groupBy("order_id").agg(F.count("*"), F.sum("total_paid")))
    settings(**SPLITTING)
    joined = of.join_orders_with_transactions(orders, transactions)
    digest = _digest(joined)
    assert digest.collect()[0][0] == orders.count()
    assert "skew=true" in _final_plan(digest)
    actual = joined.groupBy("order_id").agg(F.count("*"), F.sum("total_paid"))
    assert rows(actual) == expected


def test_repeated_account_is_split(spark, shop, settings, tmp_path):
    orders, _, accounts = _load(spark, shop)
    copies = spark.range(0, 20_000, 1, 8).select(
        F.lit("A7").alias("account_id"),
        F.concat(F.lit("Name "), F.xxhash64("id")).alias("customer_name"),
        F.lit(1).alias("order_limit"),
    )
    repeated = accounts.select(copies.columns).union(copies)
    repeated.write.parquet(f"{tmp_path}/repeated")
    repeated = spark.read.parquet(f"{tmp_path}/repeated")
    totals = of.calculate_monthly_totals(orders)
    expected = _digest(of.enrich_with_account_data(totals, repeated)).collect()
    settings(**SPLITTING)
    digest = _digest(of.enrich_with_account_data(totals, repeated, unique=False))
    assert digest.collect() == expected
    assert "skew=true" in _final_plan(digest)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_totals_of_repeated_accounts_are_computed_once(spark, shop, settings, tmp_path, threshold):
    settings(autoBroadcastJoinThreshold=threshold)
    orders, _, accounts = _load(spark, shop)
    twice = accounts.union(accounts.where("account_id < 'A3'"))
    totals = of.calculate_monthly_totals(orders)
    expected = rows(of.enrich_with_account_data(totals, twice))
    apart = of.enrich_with_account_data(totals, twice, unique=False)
    assert rows(apart) == expected
    assert _scans(apart, "order_id") == 1
    assert _scans(of.classify_orders(orders, twice, "ALL", unique_accounts=False), "order_id") == 1


def test_totals_of_unknown_accounts_are_dealt_out(spark, shop, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )
    orders, _, accounts = _load(spark, shop)
    totals = of.calculate_monthly_totals(orders)
    joined = of.enrich_with_account_data(totals, accounts.where("false"), unique=False)
    counts = [len(part) for part in joined.select("order_count", "customer_name").rdd.glom().collect()]
    assert sum(counts) == totals.count()
    assert max(counts) < 3 * sum(counts) / 16


@pytest.mark.parametrize("month", ["2024-03", None, "ALL"])
def test_account_check_needs_no_sort_of_accounts(spark, shop, settings, month):
    """With small accounts there is no sort at all but that of a single month's totals."""
    settings(autoBroadcastJoinThreshold="10MB", maxMetadataStringLength="1000")
    orders, _, accounts = _load(spark, shop)
    guarded = _plan(of.require_unique_accounts(accounts))
    assert "Sort " not in guarded and "SortAggregate" not in guarded and "Window" not in guarded
    assert guarded.count("Exchange hashpartitioning(account_id") == 1
    plan = _plan(of.classify_orders(orders, accounts, month))
    below = plan[plan.index("BroadcastExchange") :]
    assert "Sort " not in below and "Window" not in below
    # A single month: accounts are broadcast as they are, and only the totals are shuffled.
    assert _exchanges(of.classify_orders(orders, accounts, month)) == (2 if month == "ALL" else 1)


def test_hot_repeated_account_fails(spark, shop, settings, tmp_path):
    """A third of all account rows repeats one account; each task sends one row of it."""
    settings(autoBroadcastJoinThreshold="-1")
    orders, _, accounts = _load(spark, shop)
    copies = accounts.where("account_id = 'A7'").crossJoin(spark.range(0, 500, 1, 4)).drop("id")
    both = accounts.union(copies)
    for month in ("2024-03", None, "ALL"):
        for build in (of.classify_orders, of.classify_rag):
            with pytest.raises(Exception, match="account listed more than once: A7"):
                build(orders, both, month).collect()
    with pytest.raises(Exception, match="account listed more than once: A7"):
        of.require_unique_accounts(both).collect()


def test_rows_without_order_id_are_dealt_out(spark, shop, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )
    orders, transactions, _ = _load(spark, shop)
    joined = of.join_orders_with_transactions(orders.where("order_id IS NULL"), transactions)
    counts = [len(part) for part in joined.select("total_paid", "account_id").rdd.glom().collect()]
    assert sum(counts) == orders.where("order_id IS NULL").count()
    assert len(counts) == 16 and max(counts) < 3 * sum(counts) / 16


@pytest.mark.parametrize("name", sorted(registered._QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    frame = registered.queries()[name](spark, registered.SMALL_TABLES)
    plan = _plan(frame)
    for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "MapPartitions"):
        assert word not in plan
