"""lossless_events counts every row once and every record that doesn't come back, without a join."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewell.plans import catalogue

#: Repeated and null ids, nulls in every column, texts that need escapes, and values that JSON writes as text or with exponents.
ODD = [
    (1, 7, "view", 1.5, '{"k": 3}'), (1, 7, "view", 1.5, '{"k": 3}'), (1, 8, "click", 2.25, '{"k": 4}'), (None, 9, "a", 0.1, '{"k": 5}'), (None, None, None, None, None),
    (2, None, 'q"\\\t\n漢', float("nan"), '{"k": null}'), (3, 1, "", float("-inf"), "{}"), (4, 1, "}", 1e300, "{bad"), (2**63 - 1, -(2**63), "{}", 1e-7, '{"k": 9007199254740993}'),
]


@pytest.fixture
def odd(spark, tmp_path):
    df = spark.createDataFrame(ODD, "event_id bigint, user_id bigint, event_type string, value double, props string")
    df.withColumn("ts", F.lit(0).cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_every_row_once(spark, odd):
    df = entry.queries()["lossless_events"](spark, odd)
    assert differences(df, connect(odd), entry.oracle_sql()["lossless_events"]) is None


def test_no_join(spark, odd):
    plan = entry.queries()["lossless_events"](spark, odd)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan


def test_lost_records_count(spark, odd, monkeypatch):
    monkeypatch.setattr(catalogue, "rebuild", lambda df, *_: df.withColumn("record_json", F.lit(None).cast("string")))
    row = entry.queries()["lossless_events"](spark, odd).first()
    assert (row.n_rows, row.n_changed) == (len(ODD), len(ODD))
