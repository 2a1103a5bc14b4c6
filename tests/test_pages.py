"""Pages by position, and history kept up by change."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from deedmill.operators.history import scd2_history
from deedmill.plans.versions import read_history, take_in_versions
from deedmill.sources import pages
from tests.conftest import values


def stored(spark, tmp_path, n=500, per_file=60):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(9)]), k) for k in range(n)]
    df = spark.createDataFrame(rows, "a int, k int").repartition(5)
    path = str(tmp_path / "paged")
    assert pages.write_pages(df, ["a", "k"], path, per_file) == n
    return path, sorted(rows, key=lambda r: (r[0] is not None, r))


def test_pages_and_caps(spark, tmp_path):
    path, ordered = stored(spark, tmp_path)
    for size, page in ((10, 0), (10, 7), (70, 3), (500, 0), (33, 15), (100, 5), (1, 499)):
        found = [tuple(r) for r in pages.read_page(spark, path, size, page).collect()]
        assert found == ordered[page * size : (page + 1) * size]
    assert [tuple(r) for r in pages.read_page(spark, path, 30, 2, max_records=75).collect()] == ordered[60:75]
    assert pages.read_page(spark, path, 30, 3, max_records=75).count() == 0
    for cap in (1, 60, 61, 200, 499, 500, 9000):
        assert sorted(map(str, map(tuple, pages.read_first(spark, path, cap).collect()))) == sorted(map(str, ordered[:cap]))
    assert pages.read_first(spark, path, None).count() == 500


def test_a_page_reads_its_own_files(spark, tmp_path):
    path, ordered = stored(spark, tmp_path)
    # every file but those of the page is broken
    index = {r["_range"]: (r["before"], r["rows"]) for r in spark.read.parquet(f"{path}/index").collect()}
    first, after = 200, 230
    for number, (before, rows) in index.items():
        if before >= after or before + rows <= first:
            for file in pathlib.Path(path, "rows", f"_range={number}").glob("*.parquet"):
                file.write_bytes(b"broken")
    for crc in pathlib.Path(path).rglob(".*.crc"):
        crc.unlink()
    assert len(index) > 4
    page = [tuple(r) for r in pages._rows_between(spark, path, first, after).orderBy(F.asc_nulls_first("a"), "k").collect()]
    assert page == ordered[first:after]


def test_pages_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    assert pages.write_pages(spark.createDataFrame([], "a int, k int"), ["a", "k"], path) == 0
    assert pages.read_page(spark, path, 10).collect() == [] and pages.read_first(spark, path, 5).collect() == []


# ---- history -----------------------------------------------------------------------


def some_versions(n=300):
    rng = random.Random(8)
    keys = ["a"] * 5 + ["b", "c", None]
    return [(rng.choice(keys), f"2024-01-{rng.randrange(1, 29):02d} 0{rng.randrange(3)}:00:00", rng.choice("xy"), rng.choice([None, "z"])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, ts string, v string, w string").withColumn("ts", F.col("ts").cast("timestamp"))


def tie():
    return [F.asc_nulls_first("v"), F.asc_nulls_first("w")]


def plain_history(df):
    return sorted(map(str, df.select("k", "v", "w", "valid_from", "valid_to", "is_current").collect()))


@pytest.mark.parametrize("segment", [1_000_000, 25])
def test_history_by_change_equals_a_rebuild(spark, tmp_path, segment):
    rows = some_versions()
    base = str(tmp_path / "history")
    at = 0
    for size in (60, 0, 90):
        batch = rows[at : at + size]
        at += size
        take_in_versions(frame(spark, batch), base, "k", "ts", ["v", "w"], tie(), buckets=4, segment_rows=segment)
        want = scd2_history(frame(spark, rows[:at]), "k", "ts", ["v", "w"], tie())
        assert plain_history(read_history(spark, base)) == plain_history(want)
    take_in_versions(frame(spark, rows[:50]), base, "k", "ts", ["v", "w"], tie())  # once more: nothing changes
    assert plain_history(read_history(spark, base)) == plain_history(want)


def test_history_touches_the_keys_of_a_batch_only(spark, tmp_path):
    base = str(tmp_path / "history")
    rows = [(f"k{k}", "2024-01-01 00:00:00", "x", None) for k in range(200)]
    assert take_in_versions(frame(spark, rows), base, "k", "ts", ["v", "w"], tie(), buckets=16) == 16
    assert take_in_versions(frame(spark, [("k7", "2023-12-31 00:00:00", "y", None)]), base, "k", "ts", ["v", "w"], tie()) == 1
    found = read_history(spark, base)
    assert found.count() == 201
    assert sorted(values(found.where("k = 'k7'"), "v", "is_current")) == [("x", True), ("y", False)]
