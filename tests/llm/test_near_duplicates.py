"""Components, near-duplicate documents and vectors against brute force."""

import random

import numpy as np
import pytest

from deedmill.llm import minhash, vector_dedup
from deedmill.llm.graph import components
from deedmill.llm.queries import QUERIES
from tests.llm.data import SF, documents, least_reachable, odd_documents, rows_of, sample_documents, shingle_set, with_clashes


def reach(n, edges):
    parent = list(range(n))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 60
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range((20, 45, 90)[seed])]
    edges += [(k, k + 1) for k in range(n, n + 30)] + [(5, 5), (59, 59)] + edges[:3]
    want = reach(n + 31, edges)
    found = components(spark.createDataFrame(edges, "a long, b long"))
    touched = {x for e in edges for x in e}
    assert {(r["node"], r["component"]) for r in found.collect()} == {(x, want[x]) for x in touched}
    assert found.count() == len(touched)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert components(spark.createDataFrame([(1, None), (None, None)], "a long, b long")).collect() == []


# ---- documents ---------------------------------------------------------------------


def want_rows(rows):
    """Expected rows where all ids are there."""
    sets = [shingle_set(r["text"]) for r in rows]
    root = least_reachable(sets)
    least = {}
    for r, k, s in zip(rows, root, sets):
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    out = {}
    for r, k, s in zip(rows, root, sets):
        first = least[k] if s else r["doc_id"]
        row = (r["doc_id"], len(s), first, r["doc_id"] == first)
        out[row] = out.get(row, 0) + 1
    return out


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_query_equals_brute_force(spark):
    found = QUERIES["op5_minhash_near_dedup"](spark, SF)
    assert rows_of(found, *COLUMNS) == want_rows(sample_documents())


def variant(rng, words, changes):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def chains():
    """A hub whose copies are far from each other, chains, and many texts that share half of their words."""
    rng = random.Random(11)
    texts = []
    hub = [f"h{k}" for k in range(204)]
    texts += [" ".join(hub)] + [variant(rng, hub, 2 + k % 2) for k in range(60)]
    link = [f"c{k}" for k in range(150)]
    for _ in range(12):
        texts.append(" ".join(link))
        at = rng.randrange(140)
        link = [*link[:at], f"x{rng.randrange(10**6)}", *link[at + 1 :]]
    shared = [f"s{k}" for k in range(100)]
    texts += [" ".join(shared + [f"o{j}x{k}" for k in range(24)]) for j in range(80)]
    return [{"doc_id": 10 * k, "text": t, "lang": "en", "source": "s", "n_chars": 0} for k, t in enumerate(texts)]


@pytest.mark.parametrize("small, first", [(16, 32), (2, 2)])
def test_hubs_chains_and_shared_passages(spark, monkeypatch, small, first):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "FIRST_STEP", first)
    rows = chains()
    rng = random.Random(0)
    rng.shuffle(rows)
    assert rows_of(minhash.near_duplicates(documents(spark, rows)), *COLUMNS) == want_rows(rows)


def test_odd_rows_and_one_of_each(spark):
    rows = [r for r in odd_documents() if r["doc_id"] is not None]
    df = with_clashes(documents(spark, rows))
    assert rows_of(minhash.near_duplicates(df), *COLUMNS) == want_rows(rows)
    kept = minhash.one_of_each(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == sorted({i for i, _, first, _ in want_rows(rows) if i == first})


def test_null_ids(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "q r s t u v"), (None, "q r s t u v"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(minhash.near_duplicates(df), *COLUMNS)
    assert found == {(None, 2, 7, False): 1, (7, 2, 7, True): 1, (None, 2, None, True): 2, (None, 0, None, True): 1}
    assert sorted(r["text"] or "" for r in minhash.one_of_each(df).collect()) == ["", "a b c d e f", "q r s t u v"]


def test_no_documents(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    assert minhash.one_of_each(documents(spark, [])).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    same = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        a, b = minhash.signature(np.unique(base[:280]), 120), minhash.signature(np.unique(base[20:]), 120)
        same.append((a == b).mean())
    assert abs(np.mean(same) - 260 / 300) < 0.02
    few = minhash.signature(np.array([1, 2], np.uint64), 120)
    assert len(set(few.tolist())) == 2  # empty bins borrow from filled ones


# ---- vectors -----------------------------------------------------------------------

VECTOR_COLUMNS = ("vec_id", "n_links", "component_id", "kept")


def want_vectors(rows, least=0.9):
    usable = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        for _, v in rows
    ]
    edges, links = [], [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if usable[a] and usable[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    edges.append((a, b))
                    links[a] += 1
                    links[b] += 1
    root = reach(len(rows), edges)
    out = {}
    for k, (i, _) in enumerate(rows):
        first = min(rows[j][0] for j in range(len(rows)) if root[j] == root[k])
        row = (i, links[k], first, i == first)
        out[row] = out.get(row, 0) + 1
    return out


def clustered():
    rng = np.random.default_rng(2)
    rows, nan, inf = [], float("nan"), float("inf")
    for size in (120, 40, 3, 2, 2):
        centre = rng.normal(size=16)
        rows += [(centre + 0.25 * rng.normal(size=16)).astype(np.float32).tolist() for _ in range(size)]
    rows += [rng.normal(size=16).astype(np.float32).tolist() for _ in range(200)]
    rows += [rows[0]] * 4 + [(2 * np.array(rows[5])).tolist(), (-np.array(rows[5])).tolist()]
    rows += [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.1], [1e30, 1e30]]
    order = rng.permutation(len(rows))
    return [(int(k), rows[k]) for k in order]


@pytest.mark.parametrize("leaf, block", [(64, 2048), (30, 37)])
def test_vectors_equal_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rows = clustered()
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert rows_of(vector_dedup.near_vectors(df, leaf=leaf), *VECTOR_COLUMNS) == want_vectors(rows)


def test_vector_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows_of(QUERIES["op8_vector_near_dedup"](spark, SF), *VECTOR_COLUMNS) == want_vectors(rows)


def test_no_vectors_and_null_ids(spark):
    schema = "vec_id long, embedding array<float>"
    assert vector_dedup.near_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.1]), (None, None), (9, None)]
    found = rows_of(vector_dedup.near_vectors(spark.createDataFrame(rows, schema)), *VECTOR_COLUMNS)
    assert found == {(None, 1, 3, False): 1, (3, 1, 3, True): 1, (None, 0, None, True): 1, (9, 0, 9, True): 1}
