import json
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import orderflow as of
from orderflow.schemas import (
    ACCOUNTS,
    HOLDING_COLUMNS,
    ORDERS,
    RESULT_COLUMNS,
    ROUTED,
    TRANSACTIONS,
)
from orderflow.sources.files import _format_of, read_table
from orderflow.sources.retail import RetailTables
from tests.frames import rows

ACCOUNT_LINES = """account_id,customer_name,order_limit,created_date,status
A1,Ann,1,2023-01-15,ACTIVE
A2,,5,2023-02-20,ACTIVE
A3,Cid,abc,2023-03-10,ACTIVE
"""
ORDER_LINES = """order_id,account_id,order_date,total_amount,product_count,status
O1,A1,2024-11-02,100.10,5,COMPLETED
O2,A1,2024-12-03,100.10,3,COMPLETED
O3,A1,2024-12-04,60.05,2,PENDING
O4,A1,2024-12-05,999.00,9,CANCELLED
O5,A2,2024-12-05,10.00,1,COMPLETED
O6,A3,2024-12-06,10.00,1,COMPLETED
"""
TRANSACTION_LINES = """transaction_id,order_id,amount,transaction_date,status
T1,O1,100.10,2024-11-02T10:30:00,SUCCESS
T2,O2,50.00,2024-12-03T10:30:00,SUCCESS
T3,O2,50.10,2024-12-03T11:30:00,FAILED
"""


@pytest.fixture
def files(tmp_path):
    paths = {}
    for name, text in (
        ("accounts", ACCOUNT_LINES),
        ("orders", ORDER_LINES),
        ("transactions", TRANSACTION_LINES),
    ):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        paths[f"{name}_path"] = str(path)
    return paths


@pytest.mark.parametrize("suffix", ["csv", "json"])
def test_rejected_records_whatever_is_read(spark, tmp_path, suffix):
    """A record is unreadable or not, whichever of its columns a query asks for."""
    path = tmp_path / f"accounts.{suffix}"
    if suffix == "csv":
        path.write_text(ACCOUNT_LINES)
    else:
        path.write_text(
            '{"account_id":"A1","order_limit":1}\n{"account_id":"A2","order_limit":2}\n'
            '{"account_id":"A3","order_limit":"abc"}\n'
        )
    rejected = of.rejected_records(spark, str(path), ACCOUNTS)
    assert rejected.count() == 1
    assert rows(rejected, "account_id") == [("A3",)]
    assert rejected.select("status").count() == 1
    kept = of.load_accounts(spark, str(path), reject_corrupt=True)
    assert kept.count() == 2
    assert rows(kept, "account_id") == [("A1",), ("A2",)]
    both = of.load_accounts(spark, str(path), keep_corrupt=True)
    assert both.where("_corrupt_record IS NULL").select("account_id").count() == 2


@pytest.mark.parametrize("suffix", ["csv", "json", "parquet", "csv.gz"])
def test_written_tables_are_read_back(spark, tmp_path, suffix):
    accounts = spark.createDataFrame(
        [("A1", "Ann, \"B\"", 1), ("A2", None, None), (None, "é\u00a0x", -3)],
        "account_id string, customer_name string, order_limit int",
    )
    orders = spark.createDataFrame(
        [("O1", "A1", date(2024, 1, 2), Decimal("100.10"), 3, "COMPLETED"), (None, None, None, None, None, "PENDING")],
        "order_id string, account_id string, order_date date, total_amount decimal(18,2), product_count int, status string",
    )
    options = {"compression": "gzip"} if suffix.endswith("gz") else {}
    of.write_table(accounts, f"{tmp_path}/accounts.{suffix}", ACCOUNTS, **options)
    of.write_table(orders, f"{tmp_path}/orders.{suffix}", ORDERS, **options)
    found = of.load_accounts(spark, f"{tmp_path}/accounts.{suffix}")
    assert found.columns == ACCOUNTS.names
    assert rows(found, *accounts.columns) == rows(accounts)
    assert rows(of.load_orders(spark, f"{tmp_path}/orders.{suffix}", money="decimal")) == rows(orders)
    with pytest.raises(Exception, match="already exists"):
        of.write_table(accounts, f"{tmp_path}/accounts.{suffix}", ACCOUNTS)


def test_csv_tables(spark, files):
    orders = of.load_orders(spark, files["orders_path"])
    assert rows(orders, "order_id", "order_date", "total_amount")[0] == (
        "O1",
        date(2024, 11, 2),
        100.10,
    )
    assert [row[0] for row in rows(orders, "order_id")] == ["O1", "O2", "O3", "O5", "O6"]
    payments = of.load_transactions(spark, files["transactions_path"])
    assert rows(payments, "transaction_id", "transaction_date") == [
        ("T1", datetime(2024, 11, 2, 10, 30)),
        ("T2", datetime(2024, 12, 3, 10, 30)),
    ]
    # An empty cell and an unreadable number are NULL.
    assert rows(of.load_accounts(spark, files["accounts_path"]), "customer_name", "order_limit") == [
        (None, 5),
        ("Ann", 1),
        ("Cid", None),
    ]


def test_unreadable_records_can_be_kept(spark, files):
    accounts = of.load_accounts(spark, files["accounts_path"], keep_corrupt=True)
    assert rows(accounts.cache().where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [
        ("A3,Cid,abc,2023-03-10,ACTIVE",)
    ]
    assert "_corrupt_record" not in ACCOUNTS.names


@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
def test_rejected_records_have_a_way_out(spark, tmp_path, format):
    good = {"order_id": "O1", "account_id": "A1", "order_date": "2024-12-01",
            "total_amount": "5.5", "product_count": "2", "status": "PENDING"}
    bad = good | {"order_id": "O2", "total_amount": "many"}
    path = str(tmp_path / f"orders.{format}")
    if format == "parquet":
        frame = spark.createDataFrame([("O1", "A1", date(2024, 12, 1), 5.5, 2, "PENDING")], ORDERS)
        frame.write.parquet(path)
    else:
        lines = [",".join(good), *(",".join(r.values()) for r in (good, bad))]
        if format == "json":
            numbers = {"total_amount": 5.5, "product_count": 2}
            lines = [json.dumps(good | numbers), json.dumps(bad | {"product_count": 2})]
        (tmp_path / f"orders.{format}").write_text("\n".join(lines) + "\n")
    kept = of.load_orders(spark, path, reject_corrupt=True)
    assert kept.columns == ORDERS.names
    assert rows(kept, "order_id", "total_amount") == [("O1", 5.5)]
    rejected = of.rejected_records(spark, path, ORDERS).collect()
    assert ["many" in r["_corrupt_record"] for r in rejected] == [True] * (format != "parquet")


@pytest.mark.parametrize(
    "path, format",
    [
        ("/a/orders.csv", "csv"),
        ("/a.json/orders", "csv"),
        ("/a/orders.json.gz", "json"),
        ("/a/*.json", "json"),
        ("/a/orders.parquet/", "parquet"),
        ("orders.snappy.parquet", "parquet"),
    ],
)
def test_format_of_a_path(path, format):
    assert _format_of(path) == format


def test_header_in_another_order_is_an_error(spark, tmp_path):
    path = tmp_path / "accounts.csv"
    path.write_text("customer_name,account_id,order_limit,created_date,status\nAnn,A1,1,,\n")
    with pytest.raises(Exception, match="(?i)header"):
        of.load_accounts(spark, str(path)).collect()


def test_money_as_decimal(spark, files):
    orders = of.load_orders(spark, files["orders_path"], money="decimal")
    totals = of.calculate_monthly_totals(orders)
    assert Decimal("160.15") in {row["monthly_total"] for row in totals.collect()}
    with pytest.raises(ValueError):
        of.load_orders(spark, files["orders_path"], money="cents")


def test_run_pipeline_from_files(spark, files):
    output = of.run_pipeline(spark, **files)
    assert rows(output.result_table, "account_id", "monthly_total", "order_count") == [
        ("A1", pytest.approx(160.15), 2)
    ]
    assert rows(output.holding_table, "account_id", "hold_reason") == [
        ("A2", "MISSING_CUSTOMER_NAME"),
        ("A3", "MISSING_ORDER_LIMIT"),
    ]
    november = of.run_pipeline(spark, **files, target_month="2024-11")
    assert rows(november.result_table, "monthly_total") == [(100.10,)]


@pytest.mark.parametrize("format", ["json", "parquet"])
def test_rag_analysis_from_other_formats(spark, files, tmp_path, format):
    paths = {}
    loaders = {
        "accounts_path": of.load_accounts,
        "orders_path": of.load_orders,
        "transactions_path": of.load_transactions,
    }
    for name, load in loaders.items():
        paths[name] = str(tmp_path / f"{name}.{format}")
        load(spark, files[name]).write.format(format).save(paths[name])
    for inputs in (files, paths):
        assert rows(of.run_rag_analysis(spark, **inputs)) == [
            ("A1", "Ann", pytest.approx(160.15), 100.10, pytest.approx(59.99, abs=0.01), 2, 1, "RED", "YES")
        ]


def test_json_file_written_by_hand(spark, tmp_path):
    path = tmp_path / "orders.json"
    order = {"order_id": "O1", "account_id": "A1", "order_date": "2024-12-01",
             "total_amount": 5.5, "product_count": 2, "status": "PENDING"}
    path.write_text(json.dumps(order) + "\n")
    loaded = of.load_orders(spark, str(path))
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in ORDERS]
    assert rows(loaded, "order_date", "total_amount") == [(date(2024, 12, 1), 5.5)]


@pytest.mark.parametrize("by_month", [False, True])
def test_routed_table_round_trip(spark, files, tmp_path, by_month):
    classified = of.classify_orders(
        of.load_orders(spark, files["orders_path"]),
        of.load_accounts(spark, files["accounts_path"]),
        of.ALL_MONTHS,
    )
    path = str(tmp_path / "routed")
    time = datetime(2025, 1, 1, 6)
    of.write_routed(classified, path, as_of=time, by_month=by_month)
    written = of.read_routed(spark, path)
    expected = of.split_by_validation(classified, as_of=time)
    assert written.result_table.columns == RESULT_COLUMNS
    assert written.holding_table.columns == HOLDING_COLUMNS
    assert rows(written.result_table) == rows(expected.result_table)
    assert rows(written.holding_table) == rows(expected.holding_table)
    with pytest.raises(Exception, match="(?i)already exists"):
        of.write_routed(classified, path)
    valid_only = classified.where("NOT validation_failed")
    of.write_routed(valid_only, path, by_month=by_month, mode="overwrite")
    assert of.read_routed(spark, path).holding_table.count() == 0


def test_routed_rag_table(spark, files, tmp_path):
    classified = of.classify_rag(
        of.load_orders(spark, files["orders_path"]), of.load_accounts(spark, files["accounts_path"])
    )
    path = str(tmp_path / "rag")
    columns = ["account_id", "previous_month_total", "rag_status", "limit_exceeded"]
    of.write_routed(classified, path, columns=columns, by_month=True)
    written = of.read_routed(spark, path)
    assert rows(written.result_table) == [("A1", 100.10, "RED", "YES")]
    assert rows(written.holding_table, "account_id", "rag_status", "hold_reason") == [
        ("A2", "GREEN", "MISSING_CUSTOMER_NAME"),
        ("A3", "GREEN", "MISSING_ORDER_LIMIT"),
    ]


def test_each_route_reads_only_its_partitions(spark, files, tmp_path):
    classified = of.classify_orders(
        of.load_orders(spark, files["orders_path"]), of.load_accounts(spark, files["accounts_path"])
    )
    of.write_routed(classified, str(tmp_path / "routed"))
    held = of.read_routed(spark, str(tmp_path / "routed")).holding_table
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "(route#" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]


def test_views_over_catalog_tables(spark, files):
    for name, schema in (("accounts", ACCOUNTS), ("orders", ORDERS), ("transactions", TRANSACTIONS)):
        frame = read_table(spark, files[f"{name}_path"], schema)
        frame.createOrReplaceTempView(f"shop_{name}")
    of.register_views(spark, "shop_accounts", "shop_orders", "shop_transactions")
    assert spark.table("orders_with_payments").count() == 5
    assert spark.table("successful_transactions").count() == 2
    assert spark.table("valid_orders").count() == 5
    assert spark.table("monthly_account_totals").count() == 4
    assert spark.table("enriched_monthly_totals").count() == 3
    summary = spark.sql(
        "SELECT count(*), sum(monthly_total), sum(order_count) FROM validated_orders"
        " WHERE hold_reason IS NULL"
    )
    assert tuple(summary.first()) == (1, pytest.approx(160.15), 2)


def _shop_tables(spark, path):
    """Classified account-months of two months, some of them held."""
    sold = of.load_orders(spark, path["orders_path"])
    return of.classify_orders(sold, of.load_accounts(spark, path["accounts_path"]), of.ALL_MONTHS)


def test_a_month_is_replaced_and_the_others_stay(spark, files, tmp_path):
    classified, path = _shop_tables(spark, files), str(tmp_path / "routed")
    of.write_routed(classified, path, by_month=True)
    whole = of.read_routed(spark, path)
    before = rows(whole.result_table), rows(whole.holding_table, *HOLDING_COLUMNS[:-1])
    assert before[1]
    december = classified.where("order_month >= DATE '2024-12-01'")
    of.write_routed(december, path, by_month=True, mode="replace")
    again = of.read_routed(spark, path)
    assert (rows(again.result_table), rows(again.holding_table, *HOLDING_COLUMNS[:-1])) == before
    of.write_routed(december.where("NOT validation_failed"), path, by_month=True, mode="replace")
    cleared = of.read_routed(spark, path)
    assert rows(cleared.result_table) == before[0]
    assert not cleared.holding_table.where("order_month >= DATE '2024-12-01'").count()
    with pytest.raises(ValueError, match="by_month"):
        of.write_routed(december, path, mode="replace")


@pytest.mark.parametrize("by_month", [False, True])
def test_summaries_come_from_the_same_pass(spark, files, tmp_path, by_month):
    classified = _shop_tables(spark, files)
    output = of.split_by_validation(classified)
    found = of.write_routed(classified, str(tmp_path / "routed"), by_month=by_month)
    wanted = of.get_result_summary(output.result_table)
    assert found["result"] == {k: pytest.approx(v) for k, v in wanted.items()}
    assert found["holding"] == of.get_holding_summary(output.holding_table)


@pytest.mark.parametrize("by_month", [False, True])
def test_an_empty_run_can_be_read_back(spark, files, tmp_path, by_month):
    path = str(tmp_path / "routed")
    found = of.write_routed(_shop_tables(spark, files).where("false"), path, by_month=by_month)
    assert found["holding"] == {"total_held": 0, "by_reason": {}}
    for schema in (None, ROUTED):
        written = of.read_routed(spark, path, schema)
        assert written.result_table.columns == RESULT_COLUMNS and not written.result_table.count()
        assert written.holding_table.columns == HOLDING_COLUMNS and not written.holding_table.count()


def test_views_refuse_repeated_accounts_and_take_rules(spark, files):
    for name, schema in (("accounts", ACCOUNTS), ("orders", ORDERS), ("transactions", TRANSACTIONS)):
        frame = read_table(spark, files[f"{name}_path"], schema)
        frame = frame.union(frame) if name == "accounts" else frame
        frame.createOrReplaceTempView(f"shop_{name}")
    names = ["shop_accounts", "shop_orders", "shop_transactions"]
    of.register_views(spark, *names)
    with pytest.raises(Exception, match="account listed more than once"):
        spark.sql("SELECT * FROM validated_orders").collect()
    rules = (of.Rule("ANY", "true"), *of.DEFAULT_RULES)
    of.register_views(spark, *names, rules=rules, with_violations=True, unique_accounts=False)
    held = spark.sql("SELECT DISTINCT hold_reason, violations[0] AS first FROM validated_orders")
    assert rows(held) == [("ANY", "ANY")]
    assert "status" not in spark.table("orders_with_payments").columns


RETAIL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(RETAIL), reason="no test tables")
@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
def test_files_against_sql(spark, tmp_path, format):
    """The adapter's tables as files, through the file entries, against their SQL."""
    tables, paths = RetailTables(spark, RETAIL), {}
    inputs = {
        "accounts": (tables.accounts, ACCOUNTS),
        "orders": (tables.orders, ORDERS),
        "transactions": (tables.transactions, TRANSACTIONS),
    }
    for name, (table, schema) in inputs.items():
        columns = [
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in table.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        paths[f"{name}_path"] = path = str(tmp_path / f"{name}.{format}")
        writer = table.select(*columns).write
        (writer.option("header", True) if format == "csv" else writer).format(format).save(path)
    connection = duckdb.connect()
    for name in ("customer", "orders", "lineitem"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{RETAIL}/{name}.parquet')")

    def compare(table, query, columns):
        wanted = connection.sql(registered.oracle_sql()[query]).select(", ".join(columns)).fetchall()
        found = [tuple(r) for r in table.select(*columns).collect()]

        def plain(row):
            return tuple(str(round(v, 2)) if isinstance(v, float) else str(v) for v in row)

        assert sorted(map(plain, found)) == sorted(map(plain, wanted)) and found

    output = of.run_pipeline(spark, **paths, target_month=of.ALL_MONTHS)
    compare(output.result_table, "result_table", ["account_id", "monthly_total", "order_count"])
    held = ["account_id", "monthly_total", "hold_reason"]
    compare(output.holding_table, "holding_table", held)
    time = datetime(2025, 1, 1)
    rag = of.run_rag_tables(spark, **paths, target_month=of.ALL_MONTHS, as_of=time)
    columns = ["account_id", "current_month_total", "previous_month_total", "rag_status"]
    compare(rag.result_table, "rag_result", columns)
    compare(rag.holding_table, "rag_holding", [*columns, "hold_reason"])
    assert {r.hold_timestamp for r in rag.holding_table.collect()} == {time}
