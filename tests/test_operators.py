import random
from collections import Counter


import pytest
from pyspark.sql import functions as F

from deedmill.functions.truth import truthy_text
from deedmill.operators import aggregates, dedupe, history, joins, keys, nested, skew, upsert
from deedmill.sources import raw, scan
from deedmill.operators.sizing import estimated_bytes
from tests.conftest import values


# ---- dedupe ------------------------------------------------------------------


def test_latest_per_key(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", None, 3), ("b", "2024-01-01", 4),
            ("c", "2024-01-01", 6), ("c", "2024-01-01", 5), ("d", None, 7)]
    df = spark.createDataFrame(rows, "k string, ts string, n int")
    got = dedupe.latest_per_key(df, ["k"], "ts", ["n"])
    assert sorted(values(got, "k", "n")) == [("a", 2), ("b", 4), ("c", 5), ("d", 7)]
    again = dedupe.latest_per_key(got, ["k"], "ts", ["n"])
    assert sorted(values(again, "k", "n")) == sorted(values(got, "k", "n"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int").repartition(4)
    text = plan(dedupe.first_per_key(df, ["k"], [F.asc("n")]))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


# ---- nested ------------------------------------------------------------------

NESTED = "id string, amount int, recorder_g_a array<struct<pk: string, name: string>>"
NESTED_ROWS = [
    ("missing", 1, None),
    ("empty", 2, []),
    ("one", 3, [("p1", "x")]),
    ("twins", 4, [("p2", "y"), ("p2", "y")]),
    ("no name", 5, [("p3", None)]),
    ("null element", 6, [None, ("p4", "z")]),
]


def test_flatten_counts(spark):
    df = spark.createDataFrame(NESTED_ROWS, NESTED)
    flat = nested.flatten_counts(df, "recorder_g", {"n": "recorder_g_a", "absent": "recorder_g_b"})
    assert flat.columns == ["id", "amount", "n", "absent"]
    assert dict(values(flat, "id", "n")) == {
        "missing": 0, "empty": 0, "one": 1, "twins": 2, "no name": 1, "null element": 2,
    }
    assert {r[0] for r in values(flat, "absent")} == {0}


def test_explode_children(spark):
    df = spark.createDataFrame(NESTED_ROWS, NESTED)
    rows = nested.explode_children(df, "id", "recorder_g_a", ["pk", "name"])
    assert sorted(values(rows, "id", "pk"), key=str) == sorted(
        [("one", "p1"), ("twins", "p2"), ("twins", "p2"), ("no name", "p3"), ("null element", None), ("null element", "p4")],
        key=str,
    )
    total = nested.flatten_counts(df, "recorder_g", {"n": "recorder_g_a"}).agg(F.sum("n")).first()[0]
    assert rows.count() == total
    kept = nested.explode_children(df, "id", "recorder_g_a", ["pk", "name"], drop_empty=True)
    assert kept.count() == total - 1


# ---- keys --------------------------------------------------------------------


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_dense_index_is_dense_and_ordered(spark, rows):
    names = [f"k{random.Random(i).random():.9f}" for i in range(rows)]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    got = values(keys.dense_index(df, ["k"]).orderBy("idx"), "idx", "k")
    assert [i for i, _ in got] == list(range(1, rows + 1))
    assert [k for _, k in got] == sorted(names)


@pytest.mark.parametrize("narrow", [True, False])
def test_rebuild_keeps_keys(spark, narrow):
    build = lambda names, known: keys.attach_keys(
        (df := spark.createDataFrame([(n, n * 2) for n in names], "k string, v string")),
        ["k"], "key", known, ids=df if narrow else None,
    )
    first = build(["m", "n", "z"], None)
    old = dict(values(first, "k", "key"))
    assert old == {"m": 1, "n": 2, "z": 3}
    new = dict(values(build(["a", "m", "n", "o", "z"], first), "k", "key"))
    assert {k: new[k] for k in old} == old
    assert new["a"] == 4 and new["o"] == 5


# ---- upsert ------------------------------------------------------------------

TARGET = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]


def target(spark):
    return spark.createDataFrame(TARGET, "k int, v string, extra string")


def test_upsert(spark):
    source = spark.createDataFrame([(2, "B"), (4, "D")], "k int, v string")
    got = upsert.upsert(target(spark), source, ["k"])
    expected = [(1, "a", "x"), (2, "B", "y"), (3, "c", "z"), (4, "D", None)]
    assert sorted(values(got, "k", "v", "extra")) == expected
    again = upsert.upsert(got, source, ["k"])
    assert sorted(values(again, "k", "v", "extra")) == expected


def test_upsert_empty_source_and_repeats(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert sorted(values(upsert.upsert(target(spark), empty, ["k"]), "k", "v", "extra")) == TARGET
    twice = spark.createDataFrame([(1, "p", 1), (1, "q", 2)], "k int, v string, n int")
    got = upsert.upsert(target(spark).drop("extra"), twice, ["k"], [F.desc("n")])
    assert dict(values(got, "k", "v"))[1] == "q" and got.count() == 3


def test_upsert_stamps(spark):
    first, second = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    empty = spark.createDataFrame([], "k int, v string").withColumns({"created_at": first, "updated_at": first})
    one = upsert.upsert(empty, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], stamp=first)
    two = upsert.upsert(one, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"], stamp=second)
    months = two.select("k", F.month("created_at"), F.month("updated_at"))
    assert sorted(tuple(r) for r in months.collect()) == [(1, 1, 1), (2, 1, 2), (3, 2, 2)]


# ---- joins under skew --------------------------------------------------------


def skewed(spark):
    """A third of the rows share one key, another third has none."""
    rows = [(i, "hot") for i in range(300)] + [(300 + i, None if i % 2 else "") for i in range(300)]
    rows += [(600 + i, f"k{i % 40}") for i in range(300)] + [(900, "gone")]
    return spark.createDataFrame(rows, "id int, key string")


def dimension(spark):
    rows = [("hot", 1, "H")] + [(f"k{i}", 10 + i, None if i % 5 == 0 else f"v{i}") for i in range(35)] + [("", 99, "E"), ("0", 98, "Z")]
    return spark.createDataFrame(rows, "key string, dim_key int, label string")


@pytest.mark.parametrize("min_rows", [50, 10_000])
def test_lookup_left_with_hot_keys(no_broadcast, min_rows):
    spark = no_broadcast
    df, dim = skewed(spark), dimension(spark)
    got = skew.lookup_left(
        df, dim, "key", ["dim_key", "label"], truthy_text(F.col("key")), F.col("id"), max_keys=20, min_rows=min_rows
    )
    assert got.columns == ["id", "key", "dim_key", "label"]
    look = {k: (n, v) for k, n, v in values(dim, "key", "dim_key", "label")}
    expected = {i: (k, *(look.get(k, (None, None)) if k else (None, None))) for i, k in values(df, "id", "key")}
    rows = values(got, "id", "key", "dim_key", "label")
    assert len(rows) == 901 and {r[0]: r[1:] for r in rows} == expected


def test_lookup_left_hot_key_without_match(no_broadcast):
    spark = no_broadcast
    dim = dimension(spark).where("key != 'hot'")
    got = skew.lookup_left(
        skewed(spark), dim, "key", ["dim_key"], truthy_text(F.col("key")), F.col("id"), max_keys=20, min_rows=50
    )
    assert got.count() == 901 and got.where("key = 'hot' and dim_key is not null").count() == 0


def task_sizes(spark, df):
    """Rows per task of the last shuffle, without AQE mending anything."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_rows_are_spread(no_broadcast):
    """No task of the shuffle holds much more than its share."""
    spark = no_broadcast
    got = skew.lookup_left(
        skewed(spark), dimension(spark), "key", ["dim_key"], truthy_text(F.col("key")), F.col("id"),
        max_keys=20, min_rows=50,
    )
    assert max(task_sizes(spark, got)) < 250


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("min_rows", [50, 10_000])
def test_salted_join_equals_plain(no_broadcast, how, min_rows):
    spark = no_broadcast
    right = dimension(spark).unionByName(spark.createDataFrame([("hot", 2, "H2")], "key string, dim_key int, label string"))
    df = skewed(spark)
    got = skew.salted_join(df, right, "key", F.col("id"), how, salts=7, max_keys=20, min_rows=min_rows)
    plain = df.join(right, "key", how)
    pick = ("id", "key", "dim_key", "label")
    assert sorted(map(str, values(got, *pick))) == sorted(map(str, values(plain, *pick)))


def test_hot_keys_are_bounded(spark):
    hot = skew.hot_keys(skewed(spark), "key", max_keys=5, min_rows=1)
    assert {r["key"] for r in hot.collect()} == {"hot"} or hot.count() < 5


def test_small_dimensions_are_joined_plainly(spark):
    dim = spark.range(50).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("dim_key"))
    assert estimated_bytes(dim) < 10_000
    text = plan(skew.lookup_left(skewed(spark), dim, "key", ["dim_key"], F.lit(True), F.col("id")))
    assert "_place" not in text and "BroadcastHashJoin" in text


def test_salted_rows_are_spread(no_broadcast):
    spark = no_broadcast
    for how, most in (("inner", 200), ("left", 300)):
        got = skew.salted_join(
            skewed(spark), dimension(spark), "key", F.col("id"), how, salts=50, max_keys=20, min_rows=50
        )
        assert max(task_sizes(spark, got)) < most


def test_fk_counts(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    assert tuple(joins.fk_counts(child, "fk", parent, "pk").first()) == (3, 5)
    with_null = parent.unionByName(spark.createDataFrame([(None,)], "pk int"))
    assert tuple(joins.fk_counts(child, "fk", with_null, "pk").first()) == (4, 5)
    assert tuple(joins.fk_counts(child.where("fk > 99"), "fk", parent, "pk").first()) == (0, 0)


def test_unique_lookup_prefers_newest(spark):
    rows = [("a", 1, 10, True), ("a", 2, 20, True), ("b", 3, 5, False), ("", 4, 1, True), (None, 5, 1, True)]
    dim = spark.createDataFrame(rows, "k string, v int, ts int, cur boolean")
    is_key = truthy_text(F.col("k"))
    assert sorted(values(joins.unique_lookup(dim, "k", "v", is_key, ts="ts"), "k", "v")) == [("a", 2), ("b", 3)]
    assert values(joins.unique_lookup(dim, "k", "v", is_key, "cur"), "k", "v") == [("a", 2)]


# ---- history -----------------------------------------------------------------


def brute_history(rows):
    out, by_key = [], {}
    for key, ts, a, b in sorted(rows, key=lambda r: (r[0], r[1], str(r[2:]))):
        versions = by_key.setdefault(key, [])
        if versions and versions[-1][0] == ts:
            continue
        versions.append((ts, a, b))
    for key, versions in by_key.items():
        kept = [v for i, v in enumerate(versions) if i == 0 or v[1:] != versions[i - 1][1:]]
        for i, (ts, a, b) in enumerate(kept):
            out.append((key, a, b, ts, kept[i + 1][0] if i + 1 < len(kept) else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment_rows", [3, 10, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_brute_force(spark, segment_rows, seed):
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(2000), rng.choice("xyz"), rng.choice([None, 1])) for _ in range(400)]
    # long stretches without any change, across many segments
    rows += [("still", i, "x", 1) for i in range(200)] + [("still", 500, "y", 1)]
    rows += [(f"k{i % 30}", rng.randrange(50), rng.choice("xy"), 1) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, sec int, a string, b int").withColumn(
        "ts", F.timestamp_seconds("sec")
    )
    tie = [F.expr("cast(struct(a, b) as string)")]
    got = history.scd2_history(df, "k", "ts", ["a", "b"], tie, segment_rows)
    seconds = got.select("k", "a", "b", F.unix_seconds("valid_from"), F.unix_seconds("valid_to"), "is_current")
    found = [tuple(r) for r in seconds.collect()]
    assert all(cur == (end is None) for *_, end, cur in found)
    # ties are broken by text in both; compare the shape of every interval
    unique = {}
    for r in rows:
        unique.setdefault((r[0], r[1]), []).append(r)
    if all(len({x[2:] for x in v}) == 1 for v in unique.values()):
        assert sorted((f[:5] for f in found), key=str) == brute_history(rows)
    plain = history.scd2_history(df, "k", "ts", ["a", "b"], tie)
    pick = ("k", "a", "b", "valid_from", "valid_to", "is_current")
    assert sorted(map(str, values(got, *pick))) == sorted(map(str, values(plain, *pick)))


def test_history_without_ties(spark):
    rows = [("hot", t, "xyz"[(t * t) % 3], t % 4 == 0) for t in range(300)]
    df = spark.createDataFrame(rows, "k string, sec int, a string, b boolean").withColumn("ts", F.timestamp_seconds("sec"))
    got = history.scd2_history(df, "k", "ts", ["a", "b"], [F.asc("a")], segment_rows=7)
    found = got.select("k", "a", "b", F.unix_seconds("valid_from").alias("f"), F.unix_seconds("valid_to").alias("t"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_history(rows)


# ---- aggregates and scans ----------------------------------------------------


def test_distinct_count_counts_null(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None)], "a int, b int")
    assert aggregates.distinct_count(df, "a").first()["n"] == 2
    assert aggregates.distinct_count(df, "a", "b").first()["n"] == 2


def test_most_common_breaks_ties_low(spark):
    df = spark.createDataFrame([("p", "b", 2), ("p", "a", 2), ("p", "c", 1), ("p", None, 9)], "k string, v string, n int")
    assert values(aggregates.most_common(df, ["k"], "v", "n"), "k", "v") == [("p", "a")]


def test_pages_early_and_late_agree(spark):
    k = F.when(F.col("id") % 4 != 0, 102 - F.col("id")).alias("k")
    df = spark.range(0, 103).select(k, F.col("id").alias("v"))
    early = [values(scan.page_slice(df, ["k", "v"], 10, p), "k", "v") for p in range(12)]
    late = [values(scan.page_slice(df, ["k", "v"], 10, p, shallow_rows=0), "k", "v") for p in range(12)]
    assert early == late and [len(p) for p in early] == [10] * 10 + [3, 0]
    assert [k for k, _ in sum(early, [])][:26] == [None] * 26 and len(set(sum(early, []))) == 103


def test_cap(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    assert scan.capped(df, ["k"], 7).count() == 7 and scan.capped(df, ["k"], None).count() == 50
    assert [scan.page_slice(df, ["k"], 10, p, max_records=25).count() for p in range(4)] == [10, 10, 5, 0]


def test_date_range_is_inclusive_and_pushed_down(spark, tmp_path):
    days = spark.sql("select explode(sequence(timestamp_ntz'2024-01-01 13:00:00', timestamp_ntz'2024-01-10 13:00:00', interval 1 day)) ts, 1 a, 2 b")
    days.withColumn("d", F.to_date("ts")).withColumn("s", F.date_format("ts", "yyyy-MM-dd")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for column in ("ts", "d", "s"):
        got = scan.scan_date_range(df.select(column, "a"), column, "2024-01-03", "2024-01-05")
        assert got.count() == 3
        text = plan(got)
        assert f"GreaterThanOrEqual({column}" in text and "b:" not in text.split("ReadSchema")[-1]


def test_scan_table(spark, tmp_path):
    spark.range(20).select("id", (F.col("id") % 2).alias("odd"), F.lit("x").alias("c")).write.parquet(f"{tmp_path}/t")
    path = f"{tmp_path}/t"
    assert scan.scan_table(spark, path).count() == 20
    assert scan.scan_table(spark, path, "id, odd", {"odd": 1, "c": "x"}).columns == ["id", "odd"]
    assert scan.scan_table(spark, path, ["id"], {"odd": 1}, 3).count() == 3
    assert scan.scan_table(spark, path, limit=0).count() == 20


# ---- raw envelope ------------------------------------------------------------


def test_envelope_keeps_null_keys(spark):
    df = spark.createDataFrame([("1", None, 2.5)], "id string, a string, b double")
    wrapped = raw.wrap_raw(df, "id")
    assert wrapped.columns == ["id", "data", "extracted_at"]
    assert wrapped.first()["data"] == '{"id":"1","a":null,"b":2.5}'
    assert raw.wrap_raw(df, "nowhere").first()["nowhere"] is None


def test_key_fallback(spark):
    rows = [("1", '{"id":"9"}'), (None, '{"id":"2"}'), ("", '{"id":"3"}'), (None, '{"id":""}'), (None, "{}"), (None, None)]
    df = spark.createDataFrame(rows, "id string, data string")
    assert sorted(r["id"] for r in raw.with_resolved_id(df, "id").collect()) == ["1", "2", "3"]
    assert sorted(r["id"] for r in raw.resolved_ids(df, "id").collect()) == ["1", "2", "3"]


def test_ids_are_read_without_documents(spark, tmp_path):
    spark.createDataFrame([("1", "{}")], "id string, data string").write.parquet(f"{tmp_path}/raw")
    scans = plan(raw.resolved_ids(spark.read.parquet(f"{tmp_path}/raw"), "id")).split("FileScan")[1:]
    assert "data" not in scans[0].split("ReadSchema")[1].split("\n")[0]
    assert "PushedFilters: [Or(IsNull(id),EqualTo(id,))" in scans[1]


def test_party_fields_are_not_read_for_counts(spark, tmp_path):
    spark.createDataFrame(NESTED_ROWS, NESTED).write.parquet(f"{tmp_path}/nested")
    flat = nested.flatten_counts(spark.read.parquet(f"{tmp_path}/nested"), "recorder_g", {"n": "recorder_g_a"})
    assert "name:string" not in plan(flat).split("ReadSchema")[1]
    assert sorted(values(flat, "n")) == [(0,), (0,), (1,), (1,), (2,), (2,)]


def test_append_counts_and_appends(spark, tmp_path):
    path = f"{tmp_path}/raw"
    rows = raw.wrap_raw(spark.range(5).select(F.col("id").cast("string").alias("rid")), "rid")
    assert raw.append_raw(rows, path, "2024-01-01") == 5
    assert raw.append_raw(rows, path, "2024-01-02") == 5
    assert raw.append_raw(rows.limit(0), path, "2024-01-03") == 0
    assert raw.read_raw(spark, path, "rid").count() == 10
    raw.replace_batches(rows.limit(2).withColumn("batch", F.lit("2024-01-02")), path)
    assert raw.read_raw(spark, path, "rid").groupBy("batch").count().orderBy("batch").collect() == [
        ("2024-01-01", 5), ("2024-01-02", 2),
    ]


def test_history_cuts_a_null_key_like_others(spark):
    rows = [(key, t, (t * 7 // 5) % 3) for key in (None, "a") for t in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, v int").withColumn("t", F.timestamp_seconds("t"))
    cut, whole = (
        Counter(map(tuple, history.scd2_history(df, "k", "t", ["v"], [F.asc("v")], segment_rows=n).collect()))
        for n in (20, 1_000_000)
    )
    assert cut == whole and any(r[0] is None for r in cut)
