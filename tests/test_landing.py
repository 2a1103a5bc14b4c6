"""How the jobs' input is spread, and how often documents are parsed."""

import datetime as dt

from pyspark.sql import functions as F

from deedmill.plans import model
from deedmill.registry import adapters as ad
from tests.test_operators import plan


def test_nested_transactions_are_dealt_over_all_cores(spark, tmp_path):
    rows = [(k, k % 7, "OFP"[k % 3], 10.5 * k, dt.datetime(1995, 1, 1 + k % 28), "1-URGENT") for k in range(60)]
    rows += [rows[5], (None, 3, "O", 1.0, dt.datetime(1995, 1, 1), "2-HIGH"), (9999, None, None, None, None, None)]
    orders = spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    plain, dealt = (ad.nested_transactions(spark, str(tmp_path), spread=s) for s in (False, True))
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > plain.rdd.getNumPartitions()
    as_text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())
    assert as_text(dealt) == as_text(plain) and len(as_text(plain)) == len(rows)


def test_party_documents_are_parsed_once(spark):
    rows = [("1", '{"recorder_id":"1","grantor_name":"Ann"}'), ("2", '{"recorder_id":"2","grantor_name":""}'), ("3", None), ("4", "no json")]
    raw = spark.createDataFrame(rows, "recorder_id string, data string").withColumn("extracted_at", F.lit("2025-01-01").cast("timestamp"))
    opened = model.open_parties(raw, "grantor", ad.FEED)
    assert [r[0] for r in opened.select("recorder_id").collect()] == ["1", "2", None, None]
    named = opened.where(F.coalesce(F.col("grantor_name") != "", F.lit(False))).select("recorder_id", "grantor_name", "_extracted_at")
    assert [tuple(r)[:2] for r in named.collect()] == [("1", "Ann")]
    assert plan(named).count("from_json(") == 1
