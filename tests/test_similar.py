"""Similar names, components, identifiers and lookups as of a date, against plain loops."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from deedmill.operators import asof, history, similar
from deedmill.operators.components import components
from deedmill.plans import enrich
from tests.test_operators import plan


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def numbers(name):
    return " ".join("".join(c if c.isnumeric() else " " for c in name).split())


def plain_pairs(names, most):
    names = sorted(names)
    out = set()
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            allowed = min(most, min(len(a), len(b)) // 4)
            if abs(len(a) - len(b)) <= allowed and numbers(a) == numbers(b):
                d = distance(a, b)
                if 0 < d <= allowed:
                    out.add((a, b, d))
    return out


def misspelt(rng, name, edits):
    for _ in range(edits):
        at = rng.randrange(max(1, len(name)))
        kind = rng.randrange(3)
        name = name[:at] + (rng.choice("ABCXYZ") if kind else "") + name[at + (kind < 2) :]
    return name


def some_names(seed, n, alphabet, sizes):
    rng = random.Random(seed)
    names = set()
    for _ in range(n):
        stem = "".join(rng.choices(alphabet, k=rng.choice(sizes)))
        names |= {stem, *(misspelt(rng, stem, e) for e in (1, 1, 2, 2, 3))}
    return sorted({similar_clean(x) for x in names} - {""})


def similar_clean(name):
    return " ".join("".join(c if c.isalnum() else " " for c in name.upper()).split())


FEW = some_names(1, 60, "AB ", range(4, 12))
MANY = some_names(2, 50, "ABCDEFGHIJKLMNOPQRSTUVWXYZ  ", range(1, 30))
STEM = sorted({f"THE HOLDINGS OF {a}{b} AND SONS {k}".strip() for a in "ABCDEFGH" for b in "ABCDEFGH" for k in ("", "1", "2")})


@pytest.mark.parametrize("names", [FEW, MANY, STEM, ["ABCD"], []])
@pytest.mark.parametrize("pairs, most", [(1024, 2), (2, 2), (6, 1), (2, 3)])
def test_similar_names_misses_nothing(spark, monkeypatch, names, pairs, most):
    monkeypatch.setattr(similar, "GROUP_PAIRS", pairs)
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = [tuple(r) for r in similar.similar_names(df, most).select("a", "b", "edits").collect()]
    assert len(found) == len(set(found)) and set(found) == plain_pairs(names, most)


def test_similar_names_without_broadcasts(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(similar, "GROUP_PAIRS", 4)
    df = spark.createDataFrame([(n,) for n in FEW], "name string")
    found = {tuple(r) for r in similar.similar_names(df, 2, max_keys=50, min_rows=5).select("a", "b", "edits").collect()}
    assert found == plain_pairs(FEW, 2)


def plain_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize(
    "edges",
    [
        [], [(1, 1)], [(2, 1), (1, 2), (2, 2)], [(k, k + 1) for k in range(200)], [(0, k) for k in range(1, 300)],
        [(500 - k, 500 - k - 1) for k in range(0, 400, 2)], [(random.Random(7).randrange(400), k) for k in range(300)],
        [(random.Random(k).randrange(600), random.Random(k + 9999).randrange(600)) for k in range(320)],
    ],
)
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    found = [tuple(r) for r in components(df).select("node", "root").collect()]
    assert len(found) == len(dict(found)) and dict(found) == plain_components(edges)


def test_components_around_hot_nodes(spark, no_broadcast):
    edges = [(0, k) for k in range(1, 200)] + [(199, 1000 + k) for k in range(100)]
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["root"] for r in components(df, max_keys=10, min_rows=5).collect()} == {0}


def test_fuzzy_identifiers(spark):
    rows = [
        (5, "Acme Holdings LLC"), (3, "ACME HOLDNGS LLC"), (9, "acme.holdngs  l.l.c"), (7, "Acme Holdngs  Llc."), (8, "Acme Holdings LLC 2"),
        (1, "Zed"), (2, "Zet"), (4, None), (6, " -- "),
    ]
    df = spark.createDataFrame(rows, "entity_key long, canonical_entity_name string")
    found = {r["entity_key"]: tuple(r)[1:] for r in enrich.fuzzy_identifiers(df).collect()}
    value = "ACME HOLDNGS LLC"
    assert found == {
        5: ("name_edits", value, 3, 1, 1, True), 3: ("name_edits", value, 3, 2, 0, True), 7: ("name_edits", value, 3, 2, 0, True),
        9: ("name_edits", value, 3, 1, 2, True), 8: ("name_edits", "ACME HOLDINGS LLC 2", 8, 0, 0, True),
        1: ("name_edits", "ZED", 1, 0, 0, True), 2: ("name_edits", "ZET", 2, 0, 0, True),
    }


# ---- lookups as of a date ----------------------------------------------------------

HISTORY = "k string, v string, valid_from date, valid_to date"


def plain_as_of(facts, versions):
    out = []
    for f, k, at in facts:
        known = [v for v in versions if v[0] == k and k is not None and at is not None and (v[2] is None or v[2] <= at)]
        last = max(known, key=lambda v: (v[2] or "", v[1]), default=None)
        valid = last is not None and (last[3] is None or at < last[3])
        out.append((f, k, at, last[1] if valid else None))
    return sorted(map(str, out))


def as_of_rows(n=400):
    rng = random.Random(11)
    day = lambda: f"20{rng.randrange(10, 14)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d}"
    versions = []
    for k in "abcd":
        days = sorted({day() for _ in range(30 if k == "a" else 4)})
        ends = [*days[1:], None]
        versions += [(k, f"{k}{i}", s, e) for i, (s, e) in enumerate(zip(days, ends))]
    versions += [("e", "e0", None, "2011-01-01"), ("e", "e1", "2012-01-01", "2012-02-01"), (None, "none", "2010-01-01", None)]
    facts = [(i, rng.choice(["a", "a", "a", "b", "c", "e", "zz", None, None, ""]), rng.choice([day(), day(), None])) for i in range(n)]
    facts += [(n + i, v[0], v[2]) for i, v in enumerate(versions)] + [(n + 99, "a", "1999-01-01"), (0, "a", "2011-11-11"), (0, "a", "2011-11-11")]
    return facts, versions


def frames(spark, facts, versions):
    dated = lambda df, *names: df.withColumns({c: F.col(c).cast("date") for c in names})
    rows = dated(spark.createDataFrame(facts, "f long, k string, at string"), "at")
    return rows, dated(spark.createDataFrame(versions, "k string, v string, valid_from string, valid_to string"), "valid_from", "valid_to")


@pytest.mark.parametrize("segment", [1_000_000, 60, 7])
def test_lookup_as_of(spark, segment):
    facts, versions = as_of_rows()
    rows, dim = frames(spark, facts, versions)
    found = asof.lookup_as_of(rows, dim, "k", "at", ["v"], F.col("k") != "", F.col("f"), segment_rows=segment)
    assert found.columns == ["f", "k", "at", "v"]
    got = sorted(str((r["f"], r["k"], None if r["at"] is None else str(r["at"]), r["v"])) for r in found.collect())
    assert got == plain_as_of(facts, versions)


def test_lookup_as_of_has_no_range_join(spark):
    rows, dim = frames(spark, *as_of_rows(20))
    text = plan(asof.lookup_as_of(rows, dim, "k", "at", ["v"], F.col("k") != "", F.col("f")))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Join" not in text


@pytest.mark.parametrize("facts, versions", [([], [("a", "x", "2010-01-01", None)]), ([(1, "a", "2010-01-01")], [])])
def test_lookup_as_of_of_nothing(spark, facts, versions):
    rows, dim = frames(spark, facts, versions)
    found = asof.lookup_as_of(rows, dim, "k", "at", ["v"], F.col("k") != "", F.col("f")).collect()
    assert [r["v"] for r in found] == [None] * len(facts)


def test_similar_names_keys_do_not_grow_with_the_table(spark, monkeypatch):
    """Names that differ in a few letters of a small alphabet and share a long end: groups stay small, one round does."""
    rng = random.Random(5)
    names = sorted({"".join(rng.choice("BCDF") for _ in range(11)) + " HOLDINGS LLC" for _ in range(300)})
    written, plain = [], similar.staged

    def counted(df, name):
        rows = plain(df, name)
        if name in ("name-keys", "name-pairs"):
            written.append((name, rows.count()))
        return rows

    monkeypatch.setattr(similar, "GROUP_PAIRS", 200)
    monkeypatch.setattr(similar, "staged", counted)
    found = {tuple(r) for r in similar.similar_names(spark.createDataFrame([(n,) for n in names], "name string"), 2).select("a", "b", "edits").collect()}
    assert found == plain_pairs(names, 2)
    # 1 + 12 + 66 ways to shorten the first 12 characters
    assert sum(n for name, n in written if name == "name-keys") <= 79 * len(names)
    assert sum(n for name, n in written if name == "name-pairs") <= 4 * len(names)
