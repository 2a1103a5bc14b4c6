"""Targets far above the natural share."""

from collections import Counter

from pyspark.sql import functions as F

from deedmill.llm import mixing
from tests.llm.data import documents


def test_a_rare_language_reaches_its_named_share(spark):
    rows = [
        {"doc_id": k, "text": f"w{k} " * (20 + k % 50), "lang": "xx" if k % 50 == 0 else "en", "source": "web", "n_chars": 0}
        for k in range(4000)
    ]
    found = mixing.mix(documents(spark, rows), keep_cols=["doc_id", "lang"], lang_shares={"xx": 0.3}).collect()
    expected, drawn, once = Counter(), Counter(), 0.0
    for r in found:
        expected[r["lang"]] += r["n_tokens"] * r["expected"]
        drawn[r["lang"]] += r["n_tokens"] * r["copies"]
        once += r["n_tokens"] * r["probability"]
        assert abs(r["copies"] - r["expected"]) < 1 and r["sampled"] == (r["copies"] > 0)
    assert abs(expected["xx"] / expected.total() - 0.3) < 1e-4
    assert abs(drawn["xx"] / drawn.total() - 0.3) < 0.02
    assert abs(once / sum(r["n_tokens"] for r in found) - 1 / mixing.MAX_RATIO) < 1e-4


def test_reached_shares_are_reported(spark):
    rows = [("web", "en", "long", 9900), ("web", "xx", "long", 100), (None, "en", "long", 500)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    margins = mixing.targets(cells, lang_shares={"xx": 0.4})
    found = {(r["margin"], r["value"]): r for r in mixing.reached(mixing.rake(cells, margins), margins).collect()}
    assert len(found) == 5 and abs(found["lang", "xx"]["target"] - 0.4) < 1e-9
    assert all(abs(r["reached"] - r["target"]) < 1e-4 for r in found.values())
