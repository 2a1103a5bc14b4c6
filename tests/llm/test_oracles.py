"""Queries of the subpackage against their SQL."""

import pytest

from deedmill.llm.oracle import ORACLE
from deedmill.llm.queries import QUERIES
from tests.compare import difference, tables
from tests.llm.data import SF


@pytest.fixture(scope="module")
def duck():
    return tables(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    columns = [c[0] for c in duck.execute(ORACLE[name]).description]
    assert difference(QUERIES[name](spark, SF).select(*columns), duck, ORACLE[name]) is None


def test_the_tables_of_sql_name_the_rules(duck):
    from deedmill.llm import quality

    rows = duck.execute(f"WITH {ORACLE['op9_quality_rules'].split('WITH', 1)[1].split('texts AS', 1)[0].strip().rstrip(',')} SELECT * FROM rules").fetchall()
    assert sorted(rows) == sorted((r.metric, r.at, r.beyond, r.slack, r.both) for r in quality.RULES)
