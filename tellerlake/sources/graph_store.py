"""A stored graph in buckets of keys, merged without rewriting what stays the same.

Nodes and edges each are a directory of ``bucket=<n>/`` directories, by a hash of their key.
``merge`` first drops updates that are stored already; only the buckets of the others are
read and replaced (dynamic partition overwrite, which moves finished files in at its commit).
Applying the same updates again therefore writes nothing. Buckets spread by hash, so no key
or account makes one larger than the others; more buckets make smaller rewrites. Large buckets
are written by several tasks, so their number does not bound how many work; the first rows of
a table are written as they come, once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.operators import graph as G

BUCKETS = 64


@dataclass(frozen=True)
class BucketedTable:
    """Rows of one kind under a key, in a fixed number of buckets."""

    spark: SparkSession
    path: str
    schema: str
    key: tuple[str, ...]
    buckets: int = BUCKETS

    @property
    def _data(self) -> str:
        return f"{self.path}/buckets-{self.buckets}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _filesystem(self):
        context = self.spark.sparkContext
        hadoop_path = context._jvm.org.apache.hadoop.fs.Path
        return hadoop_path(self._data).getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path

    def _stored(self) -> DataFrame:
        fs, hadoop_path = self._filesystem()
        schema = f"{self.schema}, bucket int"
        if not fs.exists(hadoop_path(self._data)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._data)

    def read(self) -> DataFrame:
        return self._stored().drop("bucket")

    def merge(self, updates: DataFrame) -> int:
        """Upsert rows; the number of rows that were new or differed.

        Of several updates with one key the greatest row wins, as in ``graph.upsert``.
        """
        columns = self.read().columns
        rest = [c for c in columns if c not in self.key]
        # each decided once, since the rewrite must not see its own result
        folder = f"{self.path}/updates-{uuid.uuid4().hex}"
        fs, hadoop_path = self._filesystem()
        wanted = G.upsert(None, updates.select(columns), self.key).select("*", self._bucket())
        if not fs.exists(hadoop_path(self._data)):
            self._replace(wanted)
            return self._stored().count()
        try:
            wanted = self._kept(wanted, f"{folder}/wanted")
            stored = self._stored_in(wanted)
            same = wanted["bucket"] == stored["bucket"]
            for c in columns:
                same = same & (wanted[c].eqNullSafe(stored[c]) if c in rest else wanted[c] == stored[c])
            fresh = self._kept(wanted.join(stored, same, "left_anti"), f"{folder}/fresh")
            n = fresh.count()
            if n:
                before = self._stored_in(fresh).select(*columns)
                self._replace(G.upsert(before, fresh.select(columns), self.key).select("*", self._bucket()))
            return n
        finally:
            fs.delete(hadoop_path(folder), True)

    def _replace(self, rows: DataFrame) -> None:
        """Writes whole buckets."""
        rows.hint("rebalance", "bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("bucket").parquet(self._data)

    def _kept(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _stored_in(self, rows: DataFrame) -> DataFrame:
        """What is stored in the buckets of the given rows; other buckets are not read."""
        numbers = [r.bucket for r in rows.select("bucket").distinct().toLocalIterator()]
        return self._stored().where(F.col("bucket").isin(numbers))


@dataclass(frozen=True)
class GraphStore:
    """Accounts, transactions and both kinds of edges of the payment graph."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    def _table(self, name: str, schema: str, *key: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.path}/{name}", schema, key, self.buckets)

    @property
    def accounts(self) -> BucketedTable:
        return self._table("accounts", "accountId string, accountType string", "accountId")

    @property
    def transactions(self) -> BucketedTable:
        return self._table("transactions", "txnId string, step int, type string, amount double, isFraud int", "txnId")

    @property
    def sent(self) -> BucketedTable:
        return self._table(
            "sent", "accountId string, txnId string, amount double, timestamp int, transactionType string", "accountId", "txnId"
        )

    @property
    def received(self) -> BucketedTable:
        return self._table(
            "received", "txnId string, accountId string, newbalanceDest double, isFraud int", "txnId", "accountId"
        )

    def load(self, txns: DataFrame, key: str = "txnId") -> dict[str, int]:
        """Merge the nodes and edges of transactions; changed rows of each kind."""
        return {
            "accounts": self.accounts.merge(G.account_nodes(txns)),
            "transactions": self.transactions.merge(G.transaction_nodes(txns, key)),
            "sent": self.sent.merge(G.sent_edges(txns, key)),
            "received": self.received.merge(G.received_edges(txns, key)),
        }

    def paths(self) -> DataFrame:
        """Whole paths from the stored edges, as the pattern operators take them."""
        return G.graph_paths(self.sent.read(), self.received.read())
