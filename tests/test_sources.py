import json

import pytest
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.operators import mart, reports
from tellerlake.sources import catalog, readers, writers
from tellerlake.sources.testtables import transactions
from conftest import SF_DIR


@pytest.fixture
def lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    txns = transactions(spark, SF_DIR).where("step <= 60").select(S.TRANSACTION_SCHEMA.fieldNames())
    writers.overwrite_parquet(txns, path, ["step"])
    return path, txns


def test_lake_round_trip_and_partition_pruning(spark, lake):
    path, txns = lake
    back = readers.read_transactions(spark, path)
    assert back.schema["step"].dataType.simpleString() == "int"
    assert sorted(back.select(txns.columns).collect()) == sorted(txns.collect())
    plan = back.where("step > 50")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(step" in plan


def test_partition_columns_come_back_from_directories(spark, tmp_path):
    path = str(tmp_path / "d")
    writers.overwrite_parquet(spark.range(4).withColumn("step", F.col("id") % 2), path, ["step"])
    back = readers.read_parquet_dir(spark, path, "id bigint, step int")
    assert sorted(back.collect()) == [(0, 0), (1, 1), (2, 0), (3, 1)]


def test_single_csv_is_one_ordered_file(spark, tmp_path):
    path = str(tmp_path / "report.csv")
    df = spark.range(1000).repartition(5)
    writers.write_single_csv(df, path, [F.desc("id")])
    writers.write_single_csv(df, path, [F.desc("id")])      # replaces itself
    lines = (tmp_path / "report.csv").read_text().split()
    assert lines[0] == "id" and [int(x) for x in lines[1:]] == list(range(999, -1, -1))
    assert sorted(p.name for p in tmp_path.iterdir() if "__" in p.name) == []
    assert readers.read_report(spark, path, "id bigint").count() == 1000


def test_single_csv_is_written_by_all_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "wide.csv")
    joined = []
    join = writers._join_files
    monkeypatch.setattr(writers, "_join_files", lambda df, fs, parts: joined.append(len(parts)) or join(df, fs, parts))
    text = F.concat(F.lit('q"uo,te\n'), "id")
    writers.write_single_csv(spark.range(5_000, numPartitions=6).select("id", text.alias("a b")), path)
    assert joined == [7]  # a header and six parts
    back = spark.read.option("header", True).option("multiLine", True).schema("id long, `a b` string").csv(path)
    assert back.count() == 5_000 and (tmp_path / "wide.csv").read_text().count("a b") == 1
    writers.write_single_csv(spark.range(0), path)
    assert (tmp_path / "wide.csv").read_text() == "id\n"


def test_single_csv_keeps_the_order_of_uneven_parts(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        heavy = F.when(F.col("id") < 300_000, 0).otherwise(F.col("id"))
        df = spark.range(400_000).select("id", heavy.alias("k")).orderBy("k", "id")
        writers.write_single_csv(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (tmp_path / "big.csv").is_file()
    lines = (tmp_path / "big.csv").read_text().split()[1:]
    assert [int(x.split(",")[0]) for x in lines] == list(range(400_000))


def test_customers_from_json_lines(spark, tmp_path):
    doc = {"customerId": "C0007", "name": "n", "age": 41, "segment": "Basic",
           "products": ["savings", "mortgage"], "kyc_status": "pending", "risk_score": 0.5,
           "churn_probability": 0.25, "account_opened": "2011-02-03", "preferred_channel": "atm"}
    file = tmp_path / "c.json"
    file.write_text(json.dumps(doc) + "\n" + json.dumps({**doc, "customerId": "C0008", "products": None}))
    got = readers.read_customers(spark, str(file)).orderBy("customerId").collect()
    assert got[0].asDict() == doc and got[1].products is None


def test_graph_files_are_read_under_plain_names(spark, tmp_path):
    files = {
        "accounts": "accountId:ID,accountType,:LABEL\nC1,CUSTOMER,Account\n",
        "transactions": "txnId:ID,step:int,type,amount:float,isFraud:int,:LABEL\n"
                        "TXN000001,3,TRANSFER,10.50,1,Transaction\n",
        "sent": ":START_ID,:END_ID,amount:float,timestamp:int,transactionType,:TYPE\n"
                "C1,TXN000001,10.50,3,TRANSFER,SENT\n",
        "received": ":START_ID,:END_ID,newbalanceDest:float,isFraud:int,:TYPE\n"
                    "TXN000001,M1,0.00,1,RECEIVED_BY\n",
    }
    paths = {}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
        paths[name] = str(tmp_path / name)
    got = {name: df.first().asDict() for name, df in readers.read_graph_csv(spark, paths).items()}
    assert got["accounts"] == {"accountId": "C1", "accountType": "CUSTOMER"}
    assert got["transactions"]["amount"] == 10.5 and got["transactions"]["txnId"] == "TXN000001"
    assert got["sent"]["timestamp"] == 3 and got["received"]["accountId"] == "M1"


def test_messages_decode_in_both_shapes(spark):
    flat = {"step": 4, "type": "DEBIT", "amount": 1.5, "nameOrig": "C1", "isFraud": 0}
    texts = [json.dumps(flat), json.dumps({"schema": {"x": 1}, "payload": {**flat, "step": 5}}),
             "{not json", json.dumps({"step": 6}), "", None]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    got = readers.decode_transactions(raw.withColumn("timestamp", F.current_timestamp()))
    assert sorted((r.step, r.nameOrig, r.amount) for r in got.collect()) == [(4, "C1", 1.5), (5, "C1", 1.5)]
    assert got.columns == [*S.TRANSACTION_SCHEMA.fieldNames(), "kafkaTimestamp"]


def test_catalog_tables_over_the_lake(spark, lake, tmp_path):
    path, txns = lake
    assert catalog.register_source(spark, "bank.transactions", path) == "lake_transactions"
    assert spark.table("lake_transactions").count() == txns.count()
    catalog.register_lake(spark, "bank", "transactions", path)
    assert catalog.register_source(spark, "bank.transactions", path) == "bank.transactions"
    assert spark.table("bank.transactions").count() == txns.count()

    catalog.create_fraud_view(spark, "bank", "transactions", "confirmed")
    assert sorted(spark.table("bank.confirmed").collect()) == sorted(reports.confirmed_fraud(txns).collect())

    catalog.analyze(spark, "bank.transactions")
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED bank.transactions").collect()}
    assert "bytes" in described["Statistics"]

    out = str(tmp_path / "daily")
    writers.overwrite_parquet(reports.daily_summary(txns), out)
    catalog.register_table(spark, "bank", "daily_summary", out)
    catalog.register_table(spark, "bank", "daily_summary", out)
    assert spark.table("bank.daily_summary").count() == reports.daily_summary(txns).count()


def test_bucketed_mart_aggregates_by_customer_without_a_shuffle(spark, lake):
    _, txns = lake
    catalog.save_mart(mart.txn_summary_mart(txns), "bank", buckets=4)
    catalog.save_mart(mart.txn_summary_mart(txns), "bank", buckets=4)
    stored = spark.table("bank.txn_summary_mart")
    assert sorted(stored.collect()) == sorted(mart.txn_summary_mart(txns).collect())
    catalog.analyze(spark, "bank.txn_summary_mart", columns=True)
    by_customer = stored.groupBy("customerId").agg(F.sum("txn_count"))
    assert "Exchange" not in by_customer._jdf.queryExecution().executedPlan().toString()


def test_blend_export(spark, tmp_path, profiles, txns):
    from tellerlake.operators.blend import customer_risk_blend_from, segment_rollup

    detail = customer_risk_blend_from(profiles({"customerId": "C1"}), txns({}))
    writers.write_blend(detail, segment_rollup(detail), str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "customer_risk")).count() == 1
    assert len((tmp_path / "segment_rollup.csv").read_text().splitlines()) == 2


def test_key_value_messages(spark):
    df = spark.createDataFrame([(7, "x", None)], "id int, a string, b string")
    assert writers.to_kv(df, "id", "a", "b").first()[:] == ("7", '{"id":7,"a":"x"}')


def test_append_keeps_what_is_there(spark, tmp_path):
    for _ in range(2):
        writers.append_parquet(spark.range(3), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6
