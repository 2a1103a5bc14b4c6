"""Line dedup against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest

from deedmill.llm import line_dedup
from deedmill.llm.queries import QUERIES
from tests.llm.data import SF, documents, odd_documents, rows_of, sample_documents, with_clashes

WHITE = " \t\n\x0b\x0c\r"
LOWER = {k: k + 32 for k in range(65, 91)}


def plain_dedup(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda line: line.strip(WHITE).translate(LOWER)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= min_chars and r["doc_id"] is not None:
                holders[key(line)].add(r["doc_id"])
    out = Counter()
    for r in rows:
        lines = (r["text"] or "").split("\n")
        held = [holders.get(key(x), ()) for x in lines]
        kept = [x for x, h in zip(lines, held) if len(h) < min_docs or r["doc_id"] == max(h)]
        out[r["doc_id"], len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


COLUMNS = ("doc_id", "n_lines", "n_dropped", "kept")


def shared_rows():
    long = "This line is shared by many of them"
    texts = [
        f"{long}\nown one", f"  {long.upper()}\t\nown two\n", f"x\n\n{long}", f"{long}\n{long}\nlast holder",
        "short one\nshort one", "short one", "short one", "Ünïcode línes are shared äöü", " Ünïcode línes are shared äöü\r",
        "ÜNïcode línes are shared äöü\nünïcode línes are shared äöü", "Ünïcode línes are shared äöü", "exactly twenty chars", "exactly twenty chars!\nexactly twenty chars",
        "exactly twenty chars\n\n\n", "nineteen chars here", "nineteen chars here", "nineteen chars here",
        "\n".join(f"line {k} of a long list of lines" for k in range(3000)), "\n".join(f"line {k} of a long list of lines" for k in range(0, 3000, 2)),
        "\n".join(f"LINE {k} of a long list of lines" for k in range(0, 3000, 3)) + "\n",
    ]
    rows = [{"doc_id": 5000 + k, "text": t, "lang": "en", "source": "s", "n_chars": 1} for k, t in enumerate(texts)]
    rows += [dict(rows[0]), dict(rows[0]), {**rows[3], "doc_id": None}, {**rows[3], "doc_id": None}, {**rows[3], "doc_id": rows[0]["doc_id"]}]
    return rows + [{**rows[0], "doc_id": 2**62, "text": f"{long}"}] * 2


@pytest.mark.parametrize("limit, share", [(200_000, 1000), (0, 1000), (0, 4)])
def test_against_brute_force(spark, monkeypatch, limit, share):
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", limit)
    monkeypatch.setattr(line_dedup, "HEAVY_SHARE", share)
    rows = sample_documents() + odd_documents() + shared_rows()
    found = line_dedup.drop_repeated_lines(with_clashes(documents(spark, rows)))
    assert found.columns == list(COLUMNS)
    assert rows_of(found, *COLUMNS) == plain_dedup(rows)
    assert sum(r[2] > 0 for r in plain_dedup(rows)) > 10


def test_other_thresholds(spark):
    rows = sample_documents()[:60] + shared_rows()
    found = line_dedup.drop_repeated_lines(documents(spark, rows), min_chars=5, min_docs=2)
    assert rows_of(found, *COLUMNS) == plain_dedup(rows, 5, 2)


def test_giant_groups(spark):
    rows = [{"doc_id": k, "text": f"own {k}\nThe same footer stands under every document" + "\nand a second one of them" * (k % 3)} for k in range(6000)]
    rows = [{**r, "lang": "en", "source": "s", "n_chars": 1} for r in rows]
    assert rows_of(line_dedup.drop_repeated_lines(documents(spark, rows)), *COLUMNS) == plain_dedup(rows)


@pytest.mark.parametrize("rows", [[], odd_documents()[:2]])
def test_nothing_to_drop(spark, rows):
    assert rows_of(line_dedup.drop_repeated_lines(documents(spark, rows)), *COLUMNS) == plain_dedup(rows)


def test_query(spark):
    found = QUERIES["op11_line_dedup"](spark, SF)
    want = Counter()
    for (i, n, dropped, kept), times in plain_dedup(sample_documents()).items():
        want[i, n, dropped, hashlib.sha256(kept.encode()).hexdigest()] += times
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
