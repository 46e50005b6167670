import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rollcall import prepare_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rollcall-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare_session(session)
    session.stop()


@pytest.fixture
def envelopes(spark):
    """Landed rows from (sync time, records) pairs."""

    def make(loads, sync_date=None):
        rows = []
        for load in loads:
            stamp, records = load[0], load[-1]
            text = json.dumps({"data": records, "error": False}, ensure_ascii=False)
            rows.append((stamp, load[1], text) if len(load) == 3 else (stamp, text))
        names = "SYNC_TIME string, SYNC_DATE string, RAW_DATA string"
        if len(loads[0]) == 2:
            names = "SYNC_TIME string, RAW_DATA string"
        df = spark.createDataFrame(rows, names)
        return df.withColumn("SYNC_TIME", df.SYNC_TIME.cast("timestamp"))

    return make


@pytest.fixture
def documents(spark):
    """Landed request documents from (id, document, ingest time) triples."""

    def make(rows):
        data = [(i, json.dumps(d, ensure_ascii=False), t) for i, d, t in rows]
        df = spark.createDataFrame(data, "APPROVAL_ID bigint, RAW_DATA string, INGEST_TS string")
        return df.withColumn("INGEST_TS", df.INGEST_TS.cast("timestamp"))

    return make


def rows(df, *names):
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
