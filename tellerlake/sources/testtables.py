"""The benchmark tables seen as bank data: orders, customer and events.

Orders become transactions with one step per day, customers become profiles, and
events become an hourly transaction stream. The mappings are plain projections, so
column pruning reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import CENTS, cents

# Which order priority and which event type stands for which transaction.
ORDER_TYPES = {"1": "TRANSFER", "2": "CASH_OUT", "3": "PAYMENT", "4": "CASH_IN", "5": "DEBIT"}
EVENT_TYPES = {
    "purchase": "PAYMENT", "signup": "DEBIT", "view": "CASH_IN",
    "click": "CASH_OUT", "error": "TRANSFER",
}

TABLES = {
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,
        o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
        c_mktsegment STRING""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table under its declared schema, so no job has to infer one."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lookup(key: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.element_at(F.create_map(*pairs), key)


def _utc(ts: str) -> Column:
    """A zone-less timestamp as an instant; the session runs in UTC."""
    return F.col(ts).cast("timestamp")


def _dollars(whole_cents: Column) -> Column:
    return whole_cents / F.lit(float(CENTS))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions. Balances are worked out in whole cents, so they are exact."""
    pool = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    typed = table(spark, sf_dir, "orders").select(
        key.alias("txnId"),
        (day + 1).alias("step"),
        _lookup(F.substring("o_orderpriority", 1, 1), ORDER_TYPES).alias("type"),
        cents("o_totalprice").alias("paid"),
        F.concat(F.when(owner % 10 == 9, "M").otherwise("C"), owner).alias("nameOrig"),
        ((key * 31 + 7) % pool).alias("counterparty"),
        (F.col("o_orderstatus") == "F").alias("settled"),
        (F.unix_millis(_utc("o_orderdate")) + key % 1000).alias("ingestedAt"),
    )
    txn, paid, settled = F.col("txnId"), F.col("paid"), F.col("settled")
    shop = F.col("type").isin("PAYMENT", "DEBIT")
    before = paid + txn % 1000 * CENTS
    after = F.when(F.col("type") == "CASH_IN", before + paid).otherwise(before - paid)
    dest_before = F.when(shop, 0).otherwise(txn % 5000 * CENTS)
    dest_after = F.when(shop | settled, 0).otherwise(dest_before + paid)
    fraud = F.col("type").isin(S.FRAUD_TYPES) & settled & (txn % 10 != 0)
    large = (F.col("type") == "TRANSFER") & (paid > 400_000 * CENTS)
    return typed.select(
        "txnId", "step", "type", _dollars(paid).alias("amount"), "nameOrig",
        _dollars(before).alias("oldbalanceOrg"),
        _dollars(after).alias("newbalanceOrig"),
        F.when(shop, F.concat(F.lit("M"), txn % 100))
        .otherwise(F.concat(F.lit("C"), F.col("counterparty"))).alias("nameDest"),
        _dollars(dest_before).alias("oldbalanceDest"),
        _dollars(dest_after).alias("newbalanceDest"),
        fraud.cast("int").alias("isFraud"),
        large.cast("int").alias("isFlaggedFraud"),
        "ingestedAt",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    catalogue = F.array(*map(F.lit, sorted(S.PRODUCTS)))
    opened = F.concat_ws(
        "-", 2005 + key % 20, F.lpad((1 + key % 12).cast("string"), 2, "0"),
        F.lpad((1 + key % 28).cast("string"), 2, "0"),
    )
    kyc = F.when(key % 100 < 92, "verified").when(key % 100 < 96, "pending").otherwise("expired")
    channel = F.element_at(F.array(*map(F.lit, S.CHANNELS)), F.col("c_nationkey") % 5 + 1)
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), key).alias("customerId"),
        F.col("c_name").alias("name"),
        (18 + key % 61).cast("int").alias("age"),
        F.col("c_mktsegment").alias("segment"),
        F.slice(catalogue, 1, (1 + key % 4).cast("int")).alias("products"),
        kyc.alias("kyc_status"),
        (key * 37 % 100 / F.lit(100.0)).alias("risk_score"),
        (key * 53 % 100 / F.lit(100.0)).alias("churn_probability"),
        opened.alias("account_opened"),
        channel.alias("preferred_channel"),
    )


def stream_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions in the 12-field record, plus the event id as ``txnId``."""
    key, seen = F.col("event_id"), _utc("ts")
    hours = F.floor((F.unix_seconds(seen) - S.STEP_EPOCH_SECONDS) / 3600)
    base = table(spark, sf_dir, "events").select(
        key.alias("txnId"),
        (hours + 1).cast("int").alias("step"),
        _lookup(F.col("event_type"), EVENT_TYPES).alias("type"),
        _dollars(cents(F.col("value") * 4000)).alias("amount"),
        F.concat(F.lit("C"), F.col("user_id")).alias("nameOrig"),
        F.when(key % 3 == 0, 100.0).otherwise(5000.0).alias("newbalanceOrig"),
        F.concat(F.lit("C"), F.get_json_object("props", "$.k")).alias("nameDest"),
        F.unix_millis(seen).alias("ingestedAt"),
    )
    settled = base.withColumn(
        "newbalanceDest", F.when(F.col("txnId") % 2 == 0, 0.0).otherwise(F.col("amount"))
    )
    fraud = rules.fraud_rule() & (F.col("txnId") % 10 != 0)
    return settled.select(
        "txnId", "step", "type", "amount", "nameOrig",
        _dollars(cents("newbalanceOrig") + cents("amount")).alias("oldbalanceOrg"),
        "newbalanceOrig", "nameDest",
        F.lit(0.0).alias("oldbalanceDest"), "newbalanceDest",
        fraud.cast("int").alias("isFraud"), F.lit(0).alias("isFlaggedFraud"), "ingestedAt",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event transactions as message text: envelopes and flat records alternate.

    Some rows are followed by a truncated copy and some by a copy without a sender;
    a decoder has to drop both.
    """
    txns = stream_transactions(spark, sf_dir)
    record = F.struct(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRANSACTION_SCHEMA]
    )
    flat = F.to_json(record)
    envelope = F.to_json(F.struct(F.lit("transaction").alias("schema"), record.alias("payload")))
    text = F.when(F.col("txnId") % 2 == 0, envelope).otherwise(flat)
    truncated = F.when(F.col("txnId") % 97 == 0, F.substring(flat, 1, 40))
    unsent = F.when(F.col("txnId") % 89 == 0, F.to_json(record.dropFields("nameOrig")))
    copies = F.array_compact(F.array(text, truncated, unsent))
    return txns.select(
        F.explode(copies).alias("value"), F.timestamp_millis("ingestedAt").alias("timestamp")
    )
