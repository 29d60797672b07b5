import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def txns(spark):
    """Builds transactions from short rows; unnamed fields get neutral values."""
    from tellerlake.schemas import TRANSACTION_SCHEMA

    neutral = {
        "step": 1, "type": "PAYMENT", "amount": 100.0,
        "nameOrig": "C1", "oldbalanceOrg": 0.0, "newbalanceOrig": 1000.0,
        "nameDest": "M1", "oldbalanceDest": 0.0, "newbalanceDest": 0.0,
        "isFraud": 0, "isFlaggedFraud": 0, "ingestedAt": 0,
    }

    def build(*rows):
        full = [tuple({**neutral, **row}[n] for n in TRANSACTION_SCHEMA.fieldNames()) for row in rows]
        return spark.createDataFrame(full, TRANSACTION_SCHEMA)

    return build


@pytest.fixture
def profiles(spark):
    from tellerlake.schemas import CUSTOMER_SCHEMA

    neutral = {
        "customerId": "C1", "name": "n", "age": 30, "segment": "Basic", "products": ["savings"],
        "kyc_status": "verified", "risk_score": 0.1, "churn_probability": 0.2,
        "account_opened": "2010-01-01", "preferred_channel": "web",
    }

    def build(*rows):
        full = [tuple({**neutral, **row}[n] for n in CUSTOMER_SCHEMA.fieldNames()) for row in rows]
        return spark.createDataFrame(full, CUSTOMER_SCHEMA)

    return build
