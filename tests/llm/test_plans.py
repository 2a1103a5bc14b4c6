"""Plans of the training-data operators: no cross joins, no Python where none is allowed, texts moved where they must be only."""

import pytest

from deedmill.llm.queries import QUERIES
from tests.llm.data import SF


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op7_sharding", "op9_quality_rules", "op10_source_mixing", "op11_line_dedup"])
def test_native_operators_run_no_python(spark, name):
    text = plan(spark, name)
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "ExternalRDD"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_token_counts_have_no_exchange(spark):
    assert "Exchange" not in plan(spark, "op4_token_counts")


def test_encoding_reads_one_exchange_twice(spark):
    df = QUERIES["op3_bpe_round_trip"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    text = plan(spark, "op3_bpe_round_trip")
    # texts feed the Python side directly, below the first exchange
    assert text.count("FileScan parquet [doc_id") == text.count("MapInArrow ask") == 2
