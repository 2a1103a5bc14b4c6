"""The jobs end to end, on small hand-written landings."""

import json
import os

import pytest
from pyspark.sql import functions as F

from deedmill import schemas
from deedmill.plans import audit, backfill, enrich, model, quality, rollups
from deedmill.plans.extract import extract_job
from deedmill.plans.transform import bridges_job, read_model, transform_job
from deedmill.plans.validate import validate_job
from deedmill.schemas import Feed
from deedmill.operators.upsert import upsert
from deedmill.session import freeze, job_folder, scratch_path
from deedmill.sources import files, snapshots
from deedmill.sources.buckets import read_buckets
from deedmill.sources.raw import read_raw
from deedmill.sources.snapshots import read_snapshot, upsert_partitions, upsert_snapshot, write_snapshot
from deedmill.streaming.ingest import incremental_ingest
from tests.conftest import values
from tests.test_operators import plan

FEED = Feed("feed")


def party(role, pk, name, code=None, first=None, last=None):
    return dict(zip(FEED.party_fields(role), (pk, name, "addr", code, first, last)))


def deed(rid, tax, day, amount, arms="A", grantors=(), grantees=()):
    return {
        "recorder_id": rid, "tax_assessor_id": tax, "document_recorded_date": day, "document_amount": amount,
        "arms_length_code": arms, "inter_family_flag": "N",
        schemas.PARTY_ARRAY["grantor"]: list(grantors), schemas.PARTY_ARRAY["grantee"]: list(grantees),
    }


DEEDS = [
    deed("r1", "t1", "2024-01-05", "100.50", grantors=[party("grantor", "g1", "Acme LLC", "LLC")],
         grantees=[party("grantee", "e1", "Jo Doe", None, "Jo", "Doe"), party("grantee", "e2", " acme llc\t", "C")]),
    deed("r2", "t2", "2024-01-31", "0", grantors=[party("grantor", "g2", "Bank One", "C")]),
    deed("r3", "t9", "2024-02-01", "55", arms=None, grantees=[party("grantee", "e3", None)]),
    deed("r4", "", "2024-02-10", None),
    deed("r5", "t1", "2024-03-15", "200", grantees=[party("grantee", "e5", "Zed", "T")]),
]
PROPERTIES = [
    {"tax_assessor_id": "t1", "property_use_standardized_code": "1104", "year_built": "1990", "assessed_value_total": "10.50", "address": "1 Main"},
    {"tax_assessor_id": "t2", "property_use_standardized_code": "9999", "year_built": "x"},
    {"tax_assessor_id": "t3", "property_use_standardized_code": "1112"},
]


@pytest.fixture
def landing(spark, tmp_path):
    path = tmp_path / "deeds.json"
    path.write_text("\n".join(map(json.dumps, DEEDS)))
    nested = spark.read.schema(schemas.nested_transaction(FEED)).json(str(path))
    nested.write.parquet(f"{tmp_path}/deeds")
    props = spark.createDataFrame(
        [tuple(p.get(f) for f in schemas.PROPERTY_FIELDS) for p in PROPERTIES], schemas.raw_property()
    )
    return spark.read.parquet(f"{tmp_path}/deeds"), props


def test_extract_transform_validate(spark, tmp_path, landing):
    source, props = landing
    raw_base, model_base, reports = (f"{tmp_path}/{n}" for n in ("raw", "model", "reports"))
    got = extract_job(source, props, raw_base, FEED, "2024-01-01", "2024-02-10", as_of="2024-02-11")
    assert got["counts"] == {
        "transactions": 4, "grantors": 2, "grantees": 3, "properties": 1, "mortgages": 0,
    }
    assert got["total"] == 10

    assert transform_job(spark, raw_base, model_base, FEED)["counts"] == {
        "dim_property": 1, "dim_entity": 3, "fact_transaction": 4,
    }
    entities = read_snapshot(spark, f"{model_base}/dim_entity")
    first = dict(values(entities, "canonical_entity_id", "entity_key"))
    assert first == {"feed::ACME LLC": 1, "feed::BANK ONE": 2, "feed::JO DOE": 3}
    kinds = dict(values(entities, "canonical_entity_name", "entity_type"))
    assert kinds == {"Acme LLC": "LLC", "Bank One": "CORPORATION", "Jo Doe": "INDIVIDUAL"}

    fact = read_model(spark, model_base, "fact_transaction")
    rows = {r["recorder_id"]: r for r in fact.collect()}
    assert {k: r["transaction_category"] for k, r in rows.items()} == {
        "r1": "SALE", "r2": "MORTGAGE", "r3": "OTHER", "r4": "OTHER",
    }
    assert rows["r1"]["property_key"] == 1 and rows["r2"]["property_key"] is None
    assert rows["r1"]["grantee_count"] == 2 and rows["r4"]["grantor_count"] == 0
    assert rows["r1"]["is_inter_family"] is True  # the text "N" is not empty

    # the next window overlaps the first and brings one new deed
    extract_job(source, props, raw_base, FEED, "2024-02-01", "2024-03-31", as_of="2024-04-01")
    transform_job(spark, raw_base, model_base, FEED)
    again = read_model(spark, model_base, "fact_transaction")
    assert again.count() == 5
    old = {k: r["transaction_key"] for k, r in rows.items()}
    new = dict(values(again, "recorder_id", "transaction_key"))
    assert {k: new[k] for k in old} == old and new["r5"] == 5
    later = dict(values(read_snapshot(spark, f"{model_base}/dim_entity"), "canonical_entity_id", "entity_key"))
    assert {k: later[k] for k in first} == first and later["feed::ZED"] == 4

    assert bridges_job(spark, raw_base, model_base, FEED)["counts"] == {
        "bridge_transaction_party": 5, "bridge_property_owner": 1,
    }
    owners = values(read_model(spark, model_base, "bridge_property_owner"), "property_key", "entity_key")
    assert owners == [(1, later["feed::ZED"])]

    report = validate_job(spark, model_base, reports, "2024-01-01", "2024-12-31")
    # one grantee has no name, so parties are complete but the counts of grantors agree
    assert report["total_checks"] == 22 and report["failed"] == len(report["failed_checks"])
    checks = {r["check"]: r for r in read_snapshot(spark, f"{reports}/dq_checks").collect()}
    assert checks["bridge grantor count = fact.grantor_count sum"]["status"] == "PASS"
    assert checks["Transactions have at least one party"]["passed"] == 4


def test_validate_empty_tables_give_no_rows(spark):
    prop = spark.createDataFrame([], "property_key long, tax_assessor_id string, valid_from date, is_current boolean, property_use_code string, property_address string")
    entity = spark.createDataFrame([], "entity_key long, canonical_entity_id string, canonical_entity_name string")
    fact = spark.createDataFrame([], "transaction_key long, recorder_id string, property_key long, transaction_date date, document_amount decimal(18,2), transaction_category string, is_sale boolean, grantor_count int, grantee_count int")
    checks, stats = quality.validate_all(quality.Tables(prop, entity, fact), "2024-01-01", "2024-12-31")
    assert checks.count() == 0 and stats.count() == 0


def fact_rows(spark, rows):
    return spark.createDataFrame(
        rows, "transaction_key long, recorder_id string, property_key long, transaction_date date, document_amount decimal(18,2), transaction_category string, is_sale boolean, grantor_count int, grantee_count int"
    )


def test_quality_edge_rows(spark):
    prop = spark.createDataFrame(
        [(1, "a", False), (1, "a", False), (2, "b", False)], "property_key long, tax_assessor_id string, is_current boolean"
    ).withColumns({"valid_from": F.lit(None).cast("date"), "property_use_code": F.lit("x"), "property_address": F.lit("")})
    entity = spark.createDataFrame(
        [(None, "", None), (None, "e", "n"), (1, "f", "m")], "entity_key long, canonical_entity_id string, canonical_entity_name string"
    )
    fact = fact_rows(spark, [(1, "r", None, None, None, None, False, 0, None)])
    party = spark.createDataFrame([(1, "grantee", "n")], "transaction_key long, party_role string, party_name_raw string")
    tables = quality.Tables(prop, entity, fact, party)
    checks, stats = quality.validate_all(tables)
    by = {r["check"]: r for r in checks.collect()}
    assert (by["dim_property.property_key is unique"]["passed"], by["dim_property.property_key is unique"]["total"]) == (2, 3)
    assert by["dim_entity.entity_key is unique"]["passed"] == 2  # NULL is a value
    current = by["dim_property: 1 current row per tax_assessor_id"]
    assert (current["passed"], current["total"], current["status"], current["message"]) == (0, 1, "FAIL", "OK")
    totals = by["bridge grantor count = fact.grantor_count sum"]
    assert (totals["passed"], totals["total"], totals["status"]) == (0, 1, "FAIL")
    assert "fact_transaction.property_key → dim_property" not in by
    assert "Sales have document_amount > 0" not in by and "Transactions within date range" not in by
    stat = {r["metric"]: r["value"] for r in stats.collect()}
    assert stat["Transactions with property_key"] == "0/1 (0.0%)"
    assert stat["UNKNOWN transactions"] == "1 (100.0%)"
    order = [r["category"] for r in checks.orderBy("seq").collect()]
    assert order == sorted(order, key=quality.CHECK_CATEGORIES.index)


# ---- load log and backfill ---------------------------------------------------


def log(spark, rows):
    return spark.createDataFrame(
        [(m, s, n, None, t) for m, s, n, t in rows], "month string, status string, rows long, error string, t int"
    ).select("month", "status", "rows", "error", F.timestamp_seconds("t").alias("logged_at"))


def test_load_state(spark):
    rows = [
        ("ok twice", "ok", 1, 1), ("ok twice", "ok", 1, 2),
        ("fail then ok", "failed", None, 1), ("fail then ok", "ok", 2, 2),
        ("ok then fail", "ok", 3, 1), ("ok then fail", "failed", None, 2),
        ("fail", "failed", None, 1),
    ]
    state = dict(values(audit.load_state(log(spark, rows)), "month", "state"))
    assert state == {"ok twice": "completed", "fail then ok": "completed", "ok then fail": "completed", "fail": "failed"}
    assert audit.completed_months(log(spark, rows)).count() == 3
    assert values(audit.failed_months(log(spark, rows)), "month") == [("fail",)]


@pytest.mark.parametrize(
    "done, expected",
    [([], ["2024-01", "2024-02", "2024-03"]), (["2024-01"], ["2024-02", "2024-03"]), (["2024-01", "2024-02", "2024-03"], [])],
)
def test_pending_months(spark, done, expected):
    logged = log(spark, [(m, "ok", 1, 1) for m in done])
    assert [r["month"] for r in backfill.pending_months(spark, "2024-01", "2024-03", logged).collect()] == expected


def test_missing_log_is_empty(spark, tmp_path):
    assert audit.read_log(spark, f"{tmp_path}/none").count() == 0


def test_backfill_resumes_and_replaces(spark, tmp_path, landing):
    source, props = landing
    base, log_path, runs = f"{tmp_path}/raw", f"{tmp_path}/log", []
    run = lambda end, **kw: backfill.backfill_job(
        source, props, base, log_path, FEED, "2024-01", end, transform=lambda: runs.append(end), **kw
    )
    first = run("2024-02")
    assert first["pending"] == ["2024-01", "2024-02"] and first["succeeded"] == 2
    assert first["extracted"] == (2 + 2 + 2 + 1) + (2 + 0 + 1 + 0)
    second = run("2024-03")
    assert second["pending"] == ["2024-03"] and second["extracted"] == 1 + 0 + 1 + 1
    assert run("2024-03")["pending"] == [] and runs == ["2024-02", "2024-03"]
    batches = spark.read.parquet(f"{base}/transactions").groupBy("batch").count()
    assert dict(values(batches, "batch", "count")) == {"2024-01": 2, "2024-02": 2, "2024-03": 1}


def test_backfill_isolates_a_bad_month(spark, tmp_path, landing, monkeypatch):
    source, props = landing
    good = backfill._load

    def load(frames, base, months):
        if "2024-02" in months:
            raise RuntimeError("bad month")
        return good(frames, base, months)

    monkeypatch.setattr(backfill, "_load", load)
    args = (source, props, f"{tmp_path}/raw", f"{tmp_path}/log", FEED, "2024-01", "2024-03")
    got = backfill.backfill_job(*args)
    assert (got["succeeded"], got["failed"]) == (2, 1)
    assert values(audit.failed_months(audit.read_log(spark, f"{tmp_path}/log")), "month") == [("2024-02",)]
    monkeypatch.setattr(backfill, "_load", good)
    again = backfill.backfill_job(*args)
    assert again["pending"] == ["2024-02"] and again["succeeded"] == 1
    assert audit.failed_months(audit.read_log(spark, f"{tmp_path}/log")).count() == 0


def test_backfill_stops_on_error(spark, tmp_path, landing, monkeypatch):
    source, props = landing
    monkeypatch.setattr(backfill, "_load", lambda *a: (_ for _ in ()).throw(RuntimeError("down")))
    got = backfill.backfill_job(
        source, props, f"{tmp_path}/raw", f"{tmp_path}/log", FEED, "2024-01", "2024-03", stop_on_error=True
    )
    assert (got["succeeded"], got["failed"]) == (0, 1)


@pytest.mark.parametrize("bad", [set(), {17}, {0}, {63}, {3, 4}, {0, 31, 32, 63}, set(range(64))])
@pytest.mark.parametrize("stop", [False, True])
def test_bad_months_are_found_by_halves(bad, stop):
    months = [f"{2020 + k // 12}-{k % 12 + 1:02d}" for k in range(64)]
    tried = []

    def attempt(some):
        tried.append(some)
        if any(months.index(m) in bad for m in some):
            raise RuntimeError("bad")
        return {m: 1 for m in some}

    lines = backfill._settle(months, attempt, stop)
    upto = min(bad) + 1 if stop and bad else 64
    assert lines == [
        (m, audit.FAILED, None, "bad") if k in bad else (m, audit.OK, 1, None) for k, m in enumerate(months[:upto])
    ]
    assert len(tried) <= 1 + 12 * len(bad)


def test_quality_suite_reads_the_fact_twice(spark, tmp_path, landing, monkeypatch):
    source, props = landing
    raw_base, model_base = f"{tmp_path}/raw", f"{tmp_path}/model"
    extract_job(source, props, raw_base, FEED, "2024-01-01", "2024-03-31", as_of="2024-04-01")
    transform_job(spark, raw_base, model_base, FEED)
    bridges_job(spark, raw_base, model_base, FEED)
    read = lambda name: read_model(spark, model_base, name)
    tables = quality.Tables(*[read(n) for n in ("dim_property", "dim_entity", "fact_transaction", "bridge_transaction_party", "bridge_property_owner")])
    scans = []
    staged = quality.staged

    def watched(df, name):
        out = staged(df, name)
        scans.append(any("fact_transaction" in f for f in df.inputFiles()))
        return out

    monkeypatch.setattr(quality, "staged", watched)
    checks, stats = quality.validate_all(tables, "2024-01-01", "2024-12-31")
    assert sum(scans) == 2  # row metrics and keys; reports are made of what these have left
    assert not any("fact_transaction" in f for f in [*checks.inputFiles(), *stats.inputFiles()])
    # the same rows as the checks give one by one
    parts = [
        quality.check_required_fields(tables), quality.check_uniqueness(tables), quality.check_referential_integrity(tables),
        quality.check_consistency(tables, "2024-01-01", "2024-12-31"), quality.check_business_logic(tables),
    ]
    alone = sorted(str(r) for part in parts for r in part.collect())
    assert sorted(map(str, checks.collect())) == alone
    assert sorted(map(str, stats.collect())) == sorted(map(str, quality.collect_statistics(tables).collect()))


def test_owners_and_mortgages_land_where_nested(spark, tmp_path, landing):
    source, props = landing
    owner = dict(zip(FEED.owner_fields(), ["o1", "Jo Doe"]))
    unmask = dict(zip(FEED.unmask_fields(), ["u1", "7", "Jo Doe"]))
    texts = lambda row, names: F.array(
        F.struct(*[F.lit(row.get(n)).cast("string").alias(n) for n in names]),
        F.struct(*[F.lit(None).cast("string").alias(n) for n in names]),
    )
    nested_props = props.withColumns(
        {schemas.OWNER_ARRAY: texts(owner, FEED.owner_fields()), schemas.UNMASK_ARRAY: texts(unmask, FEED.unmask_fields())}
    )
    deeds = source.withColumn(
        schemas.MORTGAGE_ARRAY, texts(dict(zip(FEED.mortgage_fields(), ["m1"])), FEED.mortgage_fields())
    )
    got = extract_job(deeds, nested_props, f"{tmp_path}/raw", FEED, "2024-01-01", "2024-12-31", as_of="2025-01-01")
    assert got["counts"]["mortgages"] == 5 and got["counts"]["owners"] == 1 and got["counts"]["owners_unmask"] == 1
    document = json.loads(read_raw(spark, f"{tmp_path}/raw/properties", "tax_assessor_id").first()["data"])
    assert list(document) == schemas.PROPERTY_FIELDS
    unmasked = json.loads(read_raw(spark, f"{tmp_path}/raw/owners_unmask", "tax_assessor_id").first()["data"])
    assert unmasked["tax_assessor_id"] == "t1" and unmasked["owner_id"] == "7"


# ---- snapshots ---------------------------------------------------------------


def test_snapshot_upsert(spark, tmp_path):
    base = f"{tmp_path}/t"
    assert read_snapshot(spark, base) is None
    assert upsert_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), base, ["k"]) == 2
    assert upsert_snapshot(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), base, ["k"]) == 2
    assert sorted(values(read_snapshot(spark, base), "k", "v")) == [(1, "a"), (2, "c"), (3, "d")]
    assert upsert_snapshot(spark.createDataFrame([], "k int, v string"), base, ["k"]) == 0
    assert read_snapshot(spark, base).count() == 3
    assert write_snapshot(spark.createDataFrame([(9, "z")], "k int, v string"), base) == 1
    assert values(read_snapshot(spark, base), "k") == [(9,)]


def test_upsert_partitions_touches_only_theirs(spark, tmp_path):
    path = f"{tmp_path}/fact"
    schema = "k int, v string, month string"
    spark.createDataFrame([(1, "a", "01"), (2, "b", "01"), (3, "c", "02")], schema).write.partitionBy("month").parquet(path)
    files_of = lambda month: sorted(p.name for p in (tmp_path / "fact" / f"month={month}").iterdir())
    untouched = files_of("02")
    rows = lambda: sorted(values(spark.read.schema(schema).parquet(path), "k", "v", "month"))
    assert upsert_partitions(spark.createDataFrame([(2, "B", "01"), (4, "d", "03")], schema), path, ["k"], "month") == 2
    assert rows() == [(1, "a", "01"), (2, "B", "01"), (3, "c", "02"), (4, "d", "03")]
    assert files_of("02") == untouched
    # a key that moves takes its old row along
    assert upsert_partitions(spark.createDataFrame([(1, "A", "02")], schema), path, ["k"], "month") == 1
    assert rows() == [(1, "A", "02"), (2, "B", "01"), (3, "c", "02"), (4, "d", "03")]
    # the only row of a month moves: the month goes
    assert upsert_partitions(spark.createDataFrame([(4, "x", "02")], schema), path, ["k"], "month") == 1
    assert rows() == [(1, "A", "02"), (2, "B", "01"), (3, "c", "02"), (4, "x", "02")]
    assert not (tmp_path / "fact" / "month=03").exists()


def test_upsert_partitions_reads_touched_months_only(spark, tmp_path, monkeypatch):
    path, seen = f"{tmp_path}/fact", []
    upsert_partitions(spark.range(30).selectExpr("id k", "cast(id % 10 as string) month", "id v"), path, ["k"], "month")
    monkeypatch.setattr(snapshots, "upsert", lambda target, *a, **k: seen.append(plan(target)) or upsert(target, *a, **k))
    upsert_partitions(spark.createDataFrame([(3, "4", 0)], "k long, month string, v long"), path, ["k"], "month")
    assert "PartitionFilters: [month" in seen[0] and "Join" not in seen[0]


def test_jobs_leave_nothing_behind(spark, tmp_path):
    with job_folder(spark):
        inside = scratch_path(spark, "x")
        assert freeze(spark.range(5)).count() == 5
        folder = os.path.dirname(inside).removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    for k in range(6):
        write_snapshot(spark.range(k), f"{tmp_path}/t")
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v00000004", "v00000005", "v00000006"]


def test_a_run_with_a_name_replaces_its_first_try(spark, tmp_path, landing):
    source, props = landing
    for _ in range(2):
        extract_job(source, props, str(tmp_path), FEED, "2024-01-01", "2024-03-31", as_of="2024-04-01", run="r1")
    extract_job(source, props, f"{tmp_path}/once", FEED, "2024-01-01", "2024-03-31", as_of="2024-04-01")
    for table in ("transactions", "grantors", "grantees", "properties"):
        counts = [spark.read.parquet(f"{tmp_path}/{base}{table}").count() for base in ("", "once/")]
        assert counts[0] == counts[1] > 0


def test_incremental_transform_equals_full(spark, tmp_path, landing):
    source, props = landing
    raw_base, part, full = (f"{tmp_path}/{n}" for n in ("raw", "part", "full"))
    # the first window wrote an older amount of r1 and no r5
    older = source.withColumn("document_amount", F.when(F.col("recorder_id") == "r1", "1").otherwise(F.col("document_amount")))
    extract_job(older, props, raw_base, FEED, "2024-01-01", "2024-02-10", as_of="2024-02-11")
    transform_job(spark, raw_base, part, FEED, batches=["2024-02-10"])
    extract_job(source, props, raw_base, FEED, "2024-01-01", "2024-03-31", as_of="2024-04-01")
    transform_job(spark, raw_base, part, FEED, batches=["2024-03-31"])
    transform_job(spark, raw_base, full, FEED)
    for table in ("dim_property", "dim_entity", "fact_transaction"):
        rows = [
            sorted(map(str, read_model(spark, base, table).drop("created_at", "updated_at").collect()))
            for base in (part, full)
        ]
        assert rows[0] == rows[1]


# ---- streaming ---------------------------------------------------------------


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    schema = schemas.text_struct(["id", "ts", "v"])

    def land(name, rows):
        (landing / name).write_text("\n".join(json.dumps(dict(zip(("id", "ts", "v"), r))) for r in rows))

    def run():
        incremental_ingest(
            spark, str(landing), schema, "id", "ts", f"{tmp_path}/raw", f"{tmp_path}/table", f"{tmp_path}/progress",
            tiebreak=["v"], file_format="json", files_per_batch=1,
        )
        return sorted(values(read_buckets(spark, f"{tmp_path}/table"), "id", "ts", "v"))

    land("1.json", [("a", "2024-01-02", "a2"), ("a", "2024-01-01", "a1"), ("b", "2024-01-01", "b1")])
    assert run() == [("a", "2024-01-02", "a2"), ("b", "2024-01-01", "b1")]
    assert run() == [("a", "2024-01-02", "a2"), ("b", "2024-01-01", "b1")]
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 3
    land("2.json", [("a", "2024-01-01", "late"), ("b", "2024-01-05", "b5"), ("c", "2024-01-01", "c1")])
    assert run() == [("a", "2024-01-02", "a2"), ("b", "2024-01-05", "b5"), ("c", "2024-01-01", "c1")]
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 6
    # equal times: the tiebreak decides between batches as it does within one
    land("3.json", [("a", "2024-01-02", "a0"), ("b", "2024-01-05", "b9")])
    assert run() == [("a", "2024-01-02", "a0"), ("b", "2024-01-05", "b5"), ("c", "2024-01-01", "c1")]


# ---- files, roll-ups, identifiers --------------------------------------------


def test_property_files(spark, tmp_path):
    names = schemas.SNAPSHOT_PROPERTY.fieldNames()
    for month, units in (("2024-01", "1,200"), ("2024-02", "1,300")):
        row = {"property_id": "p1", "units": f'"{units}"', "completion_date": "1999-05-01", "latitude": "29.5"}
        (tmp_path / f"{month}.csv").write_text(",".join(names) + "\n" + ",".join(row.get(n, "") for n in names) + "\n")
    df = files.read_snapshot_files(spark, {m: f"{tmp_path}/{m}.csv" for m in ("2024-01", "2024-02")})
    merged = files.clean_snapshot(rollups.merge_snapshots(df, "property_id", "snapshot_month"))
    row = merged.first()
    assert merged.count() == 1 and row["units"] == 1300 and str(row["completion_date"]) == "1999-05-01"


def test_loan_sale_series_and_mapping_files(spark, tmp_path):
    write = lambda name, text: (tmp_path / name).write_text(text) and f"{tmp_path}/{name}"
    loans = files.read_loans(spark, write("loans.csv", (
        "property_id,property_name,zip,loan_amount(MM),loan_origination_date,loan_maturity_date,loan_status,lender,originator\n"
        "p1,Elm,77001,12.5,2020-01-01,2030-01-01,Current,Big Bank,Broker\n"
        "p1,Elm,77001,13.5,2020-01-01,2030-01-01,Current,Zed Bank,Broker\n"
        "p2,Oak,77002,1,2020-01-01,2030-01-01,Paid Off,Big Bank,Broker\n")))
    cleaned = rollups.clean_loans(loans, ["lender"])
    row = cleaned.first()
    assert cleaned.count() == 1 and float(row["loan_amount"]) == 12_500_000 and row["lender_name"] == "Big Bank"
    assert "originator_name" in cleaned.columns

    sales = files.read_sales(spark, write("sales.csv", "property_id,property_name,zip,sale_date,sale_price,buyer,seller\np1,Elm,77001,2020-01-01,\"1,000\",B,S\n"))
    assert float(sales.first()["sale_price"]) == 1000.0

    series = files.read_series(spark, write("series.csv", (
        "property_id,property_name,market_name,submarket_name,series,record_date,record_values\n"
        "p1,Elm,M,S,Rent Actual,2022-01-01,900\np1,Elm,M,S,Rent Actual,2024-06-01,1000\n"
        "p1,Elm,M,S,Occupancy Rate,2024-06-01,0.9\np1,Elm,M,S,Other,2024-06-01,1\np9,Elm,M,S,Rent Actual,2024-06-01,5\n")))
    mapping = files.require_columns(files.read_mapping(spark, write("map.csv", (
        "property_id,tax_assessor_id,identifier,zip,property_name,active_flag,insert_date\n"
        "p1,t1,ELM,77001,Elm,Y,2024-01-01\np9,t9,OLD,77009,Old,N,2024-01-01\n"))), ["property_id", "active_flag"])
    links = rollups.active_mapping(mapping)
    assert values(links, "property_id", "derived_property_id") == [("p1", "ELM 77001")]
    ids = links.select("property_id", "derived_property_id")
    rent = rollups.agg_series(series, ids, files.RENT)
    assert values(rent, "property_id", "record_values", "derived_property_id") == [("p1", 1000.0, "ELM 77001")]
    assert rollups.agg_series(series, ids, files.OCCUPANCY).count() == 1
    with pytest.raises(ValueError):
        files.require_columns(mapping, ["nothing"])


def test_rollup_defaults(spark):
    rows = [("P", "t2", 1990, 10, 100, 2, 1995, 5.0, 50, 7, "B"), ("P", "t1", 2000, 20, 200, 3, None, 7.0, 60, None, "A"),
            ("P", None, None, 1, None, None, None, None, None, None, None)]
    parcels = spark.createDataFrame(
        rows, "derived_property_id string, tax_assessor_id string, year_built int, assessed_value_total long, building_sq_ft long, units_count long, effective_year_built int, assessed_value_improvements double, last_sale_amount long, prior_sale_amount long, building_sq_ft_code string"
    )
    row = rollups.rollup_parcels(parcels).first().asDict()
    assert row == {
        "derived_property_id": "P", "tax_assessor_id": "t1", "parcels": 3, "assessed_value_total": 31,
        "building_sq_ft": 300, "units_count": 5, "year_built": 1990, "effective_year_built": 1995,
        "last_sale_amount": 60, "prior_sale_amount": 7, "assessed_value_improvements": 6.0, "building_sq_ft_code": "A",
    }


def test_vintage_defaults_to_newest(spark):
    demographics = spark.createDataFrame([("1", "2023A", 5), ("1", "2024A", 6), ("2", "2024A", 7)], "geography_code string, vintage string, n int")
    props = spark.createDataFrame([("P", "t1", "77", "1"), ("Q", "t2", "77", "3")], "derived_property_id string, tax_assessor_id string, zip string, tract string")
    got = rollups.agg_demographic(props, demographics, "tract", ["n"])
    assert values(got, "derived_property_id", "vintage", "n") == [("P", "2024A", 6)]
    old = rollups.agg_demographic(props, demographics, "tract", ["n"], vintage="2023A")
    assert values(old, "n") == [(5,)]


def test_identifiers_link_to_the_first(spark):
    rows = [(1, "Acme LLC"), (2, "ACME, LLC"), (3, "LLC Acme"), (4, "Other Co"), (5, "  ")]
    df = spark.createDataFrame(rows, "entity_key long, canonical_entity_name string")
    got = {r["entity_key"]: (r["resolved_entity_key"], r["is_match"]) for r in enrich.entity_identifiers(df).collect()}
    assert got == {1: (1, True), 2: (1, True), 3: (1, False), 4: (4, True)}


def test_entities_options(spark):
    rows = [("r1", "  ", None, None, None, "GRANTOR", "1", 0, None), ("r1", "Acme", "C", None, None, "GRANTEE", "2", 1, None),
            ("r0", "ACME ", "T", None, None, "GRANTOR", "3", 0, None)]
    parties = spark.createDataFrame(rows, "recorder_id string, name string, entity_code string, first_name string, last_name string, role string, source_pk string, role_rank int, seen_at timestamp")
    kept = model.entities_from_parties(parties, FEED)
    assert sorted(values(kept, "entity_key", "canonical_entity_id", "entity_type")) == [(1, "feed::", "UNKNOWN"), (2, "feed::ACME", "TRUST")]
    counted = model.entities_from_parties(parties, FEED, drop_blank=True, true_counts=True)
    assert values(counted, "canonical_entity_id", "occurrences_count") == [("feed::ACME", 2)]
