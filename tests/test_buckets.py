"""Tables in hash buckets, and the jobs that keep entities and bridges up by change."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from deedmill import schemas
from deedmill.plans import model
from deedmill.plans.extract import extract_job
from deedmill.plans.transform import bridges_job, read_model, transform_job
from deedmill.sources import buckets
from deedmill.sources.buckets import ManifestTaken, merge_buckets, read_buckets, upsert_buckets
from tests.conftest import values
from tests.test_jobs import FEED, PROPERTIES, deed, party


def files(base):
    """Data files that the newest manifest names."""
    newest = sorted(pathlib.Path(base, "manifest").glob("v*.json"))[-1]
    folders = json.loads(newest.read_text())["folders"]
    return {b: sorted(p.name for p in pathlib.Path(base, f).glob("*.parquet")) for b, f in folders.items()}


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k long, v string")


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    base = str(tmp_path / "table")
    assert read_buckets(spark, base) is None
    assert upsert_buckets(rows(spark, [(k, f"old{k}") for k in range(200)]), base, ["k"], buckets=16) == 16
    before = files(base)
    assert upsert_buckets(rows(spark, [(7, "new7"), (1000, "new1000")]), base, ["k"]) <= 2
    after = files(base)
    place = buckets.bucket_of(["k"], 16)
    touched = {str(r[0]) for r in rows(spark, [(7, ""), (1000, "")]).select(place).collect()}
    assert {b for b in before if before[b] != after[b]} == touched
    want = {**{k: f"old{k}" for k in range(200)}, 7: "new7", 1000: "new1000"}
    assert dict(values(read_buckets(spark, base), "k", "v")) == want
    # the same load again changes no row, an empty one not even a file
    upsert_buckets(rows(spark, [(7, "new7"), (1000, "new1000")]), base, ["k"])
    assert dict(values(read_buckets(spark, base), "k", "v")) == want
    assert upsert_buckets(rows(spark, []), base, ["k"]) == 0


def test_readers_keep_what_they_began_with(spark, tmp_path):
    base = str(tmp_path / "table")
    upsert_buckets(rows(spark, [(1, "a"), (2, "b"), (None, "n")]), base, ["k"], buckets=4)
    seen = read_buckets(spark, base)
    upsert_buckets(rows(spark, [(1, "c")]), base, ["k"])
    assert sorted(values(seen, "v")) == [("a",), ("b",), ("n",)]
    for k in range(6):
        upsert_buckets(rows(spark, [(1, str(k))]), base, ["k"])
    assert len(list((tmp_path / "table" / "manifest").glob("v*.json"))) == buckets.KEPT_MANIFESTS
    # no load stays that no manifest names
    assert len(list((tmp_path / "table" / "data").iterdir())) <= 1 + buckets.KEPT_MANIFESTS
    assert sorted(values(read_buckets(spark, base), "v")) == [("5",), ("b",), ("n",)]


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    base = str(tmp_path / "table")
    upsert_buckets(rows(spark, [(1, "a")]), base, ["k"], buckets=4)

    def fails(current, load):
        return load.withColumn("v", F.raise_error(F.lit("no")).cast("string"))

    with pytest.raises(Exception):
        merge_buckets(rows(spark, [(1, "b")]), base, ["k"], fails)
    assert values(read_buckets(spark, base), "k", "v") == [(1, "a")]

    def meanwhile(current, load):
        upsert_buckets(rows(spark, [(2, "other")]), base, ["k"])
        return load

    with pytest.raises(ManifestTaken):
        merge_buckets(rows(spark, [(1, "b")]), base, ["k"], meanwhile)
    assert sorted(values(read_buckets(spark, base), "k", "v")) == [(1, "a"), (2, "other")]


def test_emptied_buckets_and_whole_loads(spark, tmp_path):
    base = str(tmp_path / "table")
    upsert_buckets(rows(spark, [(k, "x") for k in range(20)]), base, ["k"], buckets=4)
    merge_buckets(rows(spark, [(3, "")]), base, ["k"], lambda current, load: current.join(load.select("k"), "k", "left_anti"))
    assert sorted(r[0] for r in values(read_buckets(spark, base), "k")) == [k for k in range(20) if k != 3]
    merge_buckets(rows(spark, [(5, "only")]), base, ["k"], lambda current, load: load, whole=True)
    assert values(read_buckets(spark, base), "k", "v") == [(5, "only")]
    merge_buckets(rows(spark, []), base, ["k"], lambda current, load: load, whole=True)
    assert values(read_buckets(spark, base), "k", "v") == []


# ---- loads one after the other -----------------------------------------------------


def sale(rid, tax, day, amount, seller, *buyers):
    grantors = [party("grantor", f"{rid}-g", seller)] if seller else []
    return deed(rid, tax, day, amount, grantors=grantors, grantees=[party("grantee", f"{rid}-e{k}", b) for k, b in enumerate(buyers)])


LOADS = {
    "2024-01-31": [
        sale("r1", "t1", "2024-01-05", "100", "Acme LLC", "Jo Doe", "Bank One"),
        sale("r2", "t3", "2024-01-20", "50", "bank one", "Acme llc"),
        sale("r6", "t3", "2023-12-24", "10", "Old Owner", "Zed"),
        sale("r7", "", "2023-11-11", "10", "Old Owner", "Ann"),
    ],
    # r1 moves to another month and is no sale any more; r3 is new and brings an earlier role of Jo Doe
    "2024-02-29": [
        sale("r1", "t1", "2024-02-01", "0", "Acme LLC", "Jo Doe", "Bank One"),
        sale("r3", "t1", "2024-02-10", "70", " jo doe", "New Name", "Acme LLC"),
    ],
    # the latest sale of t3 comes to belong to t1
    "2024-03-31": [sale("r2", "t1", "2024-03-20", "55", "bank one", "Acme llc", "Late Name"), sale("r8", "t3", "2024-03-02", None, None)],
}


@pytest.fixture
def feeds(spark, tmp_path):
    props = spark.createDataFrame([tuple(p.get(f) for f in schemas.PROPERTY_FIELDS) for p in PROPERTIES], schemas.raw_property())
    out = {}
    for day, deeds in LOADS.items():
        path = tmp_path / f"{day}.json"
        path.write_text("\n".join(map(json.dumps, deeds)))
        spark.read.schema(schemas.nested_transaction(FEED)).json(str(path)).write.parquet(f"{tmp_path}/deeds-{day}")
        out[day] = spark.read.parquet(f"{tmp_path}/deeds-{day}")
    return out, props


def land(feeds, raw_base, day):
    extract_job(feeds[0][day], feeds[1], raw_base, FEED, "2023-01-01", day, as_of=day)


def plain_model(spark, base):
    """Model tables by natural keys."""
    fact = read_model(spark, base, "fact_transaction").select("recorder_id", "transaction_key", "property_key", "transaction_category")
    entity = read_model(spark, base, "dim_entity").select("entity_key", "canonical_entity_id", "canonical_entity_name")
    prop = read_model(spark, base, "dim_property").select("property_key", "tax_assessor_id")
    party_rows = read_model(spark, base, "bridge_transaction_party").join(fact, "transaction_key").join(entity, "entity_key", "left")
    owners = read_model(spark, base, "bridge_property_owner").join(prop, "property_key").join(entity, "entity_key")
    return (
        sorted(values(fact.join(prop, "property_key", "left"), "recorder_id", "tax_assessor_id", "transaction_category"), key=str),
        sorted(values(entity, "canonical_entity_id", "canonical_entity_name")),
        sorted(values(party_rows, "recorder_id", "party_role", "party_name_raw", "canonical_entity_id"), key=str),
        sorted(values(owners, "tax_assessor_id", "canonical_entity_id")),
    )


def month_files(base):
    return {p.parent.name: p.name for p in pathlib.Path(base, "bridge_transaction_party").glob("*/*.parquet")}


def test_loads_by_change_equal_a_full_run(spark, tmp_path, feeds):
    raw_base = f"{tmp_path}/raw"
    part = f"{tmp_path}/part"
    months = {}
    for day in LOADS:
        land(feeds, raw_base, day)
        transform_job(spark, raw_base, part, FEED, batches=[day])
        bridges_job(spark, raw_base, part, FEED, batches=[day])
        months[day] = month_files(part)
    full = f"{tmp_path}/full"
    transform_job(spark, raw_base, full, FEED)
    bridges_job(spark, raw_base, full, FEED)
    assert plain_model(spark, part) == plain_model(spark, full)
    untouched = {"transaction_month=2023-12", "transaction_month=2023-11"}
    assert untouched <= set(months["2024-01-31"])
    for month in untouched:
        assert len({m[month] for m in months.values()}) == 1
    owners = plain_model(spark, part)[3]
    assert owners == [("t1", "feed::ACME LLC"), ("t1", "feed::LATE NAME"), ("t3", "feed::ZED")]
    # the same load once more
    transform_job(spark, raw_base, part, FEED, batches=["2024-03-31"])
    bridges_job(spark, raw_base, part, FEED, batches=["2024-03-31"])
    assert plain_model(spark, part) == plain_model(spark, full)


def test_a_later_load_reads_its_own_parties_only(spark, tmp_path, feeds):
    raw_base, base = f"{tmp_path}/raw", f"{tmp_path}/model"
    first, second, third = LOADS
    for day in (first, second):
        land(feeds, raw_base, day)
        transform_job(spark, raw_base, base, FEED, batches=[day])
        bridges_job(spark, raw_base, base, FEED, batches=[day])
    # documents of loads already taken in can no longer be read
    for table in ("grantors", "grantees", "transactions", "properties"):
        for day in (first, second):
            for file in pathlib.Path(raw_base, table, f"batch={day}").glob("*.parquet"):
                file.write_bytes(b"no parquet at all")
    for crc in pathlib.Path(raw_base).rglob(".*.crc"):
        crc.unlink()
    land(feeds, raw_base, third)
    transform_job(spark, raw_base, base, FEED, batches=[third])
    bridges_job(spark, raw_base, base, FEED, batches=[third])
    fact, entities, parties, owners = plain_model(spark, base)
    assert ("r2", "grantee", "Late Name", "feed::LATE NAME") in parties
    assert ("feed::JO DOE", " jo doe") in entities  # a grantor of the second load comes before a grantee of the first


def test_parties_wait_for_their_transaction(spark, tmp_path, feeds):
    raw_base, base, full = (f"{tmp_path}/{n}" for n in ("raw", "model", "full"))
    first, second, third = LOADS
    land(feeds, raw_base, first)
    # the transactions of the second load come a day after its parties
    land(feeds, f"{tmp_path}/other", second)
    other = f"{tmp_path}/other"
    for table in ("grantors", "grantees"):
        spark.read.parquet(f"{other}/{table}").drop("batch").withColumn("batch", F.lit("p")).write.mode("append").partitionBy("batch").parquet(f"{raw_base}/{table}")
    spark.read.parquet(f"{other}/transactions").where("recorder_id = 'r3'").drop("batch").withColumn("batch", F.lit("q")).write.mode(
        "append"
    ).partitionBy("batch").parquet(f"{raw_base}/transactions")
    for batch in (first, "p", "q"):
        transform_job(spark, raw_base, base, FEED, batches=[batch])
        bridges_job(spark, raw_base, base, FEED, batches=[batch])
        waiting = read_buckets(spark, f"{base}/waiting_parties")
        # the first run has no bridge to change and takes in all that has landed
        assert waiting.where("recorder_id = 'r3'").count() == (0 if batch == "q" else 3)
    transform_job(spark, raw_base, full, FEED)
    bridges_job(spark, raw_base, full, FEED)
    assert plain_model(spark, base) == plain_model(spark, full)


def test_first_mentions_merge_in_any_order(spark):
    schema = "recorder_id string, name string, entity_code string, first_name string, last_name string, role string, source_pk string, role_rank int, seen_at timestamp"
    all_rows = [(f"r{k % 7}", f" Name {k % 5} ".upper() if k % 2 else f"name {k % 5}", None, None, None, "X", f"p{k}", k % 2, None) for k in range(60)]
    df = lambda part: spark.createDataFrame(part, schema)
    want = sorted(map(str, model.first_parties(df(all_rows)).select(*model.MENTION).collect()))
    for cut in (1, 20, 45):
        for parts in ((all_rows[:cut], all_rows[cut:]), (all_rows[cut:], all_rows[:cut])):
            known, fresh = (model.first_parties(df(p)).select(*model.MENTION) for p in parts)
            assert sorted(map(str, model.earlier_mentions(known, fresh).collect())) == want


def test_transactions_look_up_the_version_of_their_day(spark, tmp_path, feeds):
    raw_base, base = f"{tmp_path}/raw", f"{tmp_path}/model"
    first, second, _ = LOADS
    land(feeds, raw_base, first)
    newer = feeds[1].withColumn("year_built", F.when(F.col("tax_assessor_id") == "t1", "2001").otherwise(F.col("year_built")))
    extract_job(feeds[0][second], newer, raw_base, FEED, "2023-01-01", second, as_of="2024-02-05")
    transform_job(spark, raw_base, base, FEED, history=True)
    dim = read_model(spark, base, "dim_property")
    versions = sorted(values(dim, "tax_assessor_id", "year_built", "is_current"), key=str)
    assert versions == [("t1", 1990, False), ("t1", 2001, True), ("t3", None, True)]
    fact = read_model(spark, base, "fact_transaction").join(dim, "property_key", "left")
    # r1 was recorded before the second version, r3 after it, r6 before there was any
    assert sorted(values(fact, "recorder_id", "tax_assessor_id", "year_built")) == [
        ("r1", "t1", 1990), ("r2", "t3", None), ("r3", "t1", 2001), ("r6", "t3", None), ("r7", None, None),
    ]
    keys = {(r["tax_assessor_id"], r["year_built"]): r["property_key"] for r in dim.collect()}
    transform_job(spark, raw_base, base, FEED, history=True)
    again = read_model(spark, base, "dim_property").collect()
    assert {(r["tax_assessor_id"], r["year_built"]): r["property_key"] for r in again} == keys
