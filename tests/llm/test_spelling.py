"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from deedmill.llm import spelling
from deedmill.llm.queries import QUERIES
from tests.llm.data import SF, documents, odd_documents, rows_of, sample_documents, with_clashes

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def plain_words(rows, noise, min_chars=7, min_count=2):
    words = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_forms(words, ratio=10):
    near = {w: [] for w in words}
    ordered = sorted(words, key=len)
    for k, a in enumerate(ordered):
        for b in ordered[k + 1 :]:
            if len(b) > len(a) + 1:
                break
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = Counter()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w, words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root] += 1
    return out


def odd_words():
    rng = random.Random(5)
    words = {"abcdefg": 500, "abcdefgh": 40, "abcdefgi": 40, "abcdefghi": 4, "abcdef": 9, "bcdefgh": 3, "zabcdefg": 3, "aabcdefg": 2,
             "straße" * 2: 30, "strasse" * 2: 2, "straßestraß": 3, "ÀÉÎÕÜßÿ": 20, "ÀÉÎÕÜßþ": 2, "÷×÷×÷×÷": 3, "÷×÷×÷×÷×": 3,
             "a" * 7: 900, "a" * 8: 80, "a" * 9: 7, "a" * 11: 2, "x" * 5000 + "y": 2, "x" * 5001: 3, "x" * 2000 + "z" + "x" * 3000: 25}
    for _ in range(60):  # a family around one stem
        at = rng.randrange(9)
        words["character"[:at] + rng.choice("abcxyzß") + "character"[at + 1 :]] = rng.randint(2, 30)
        words["character"[:at] + rng.choice("abcxyzé") + "character"[at:]] = rng.randint(2, 30)
    return words


def rows_with(words, start=9000):
    text = " ".join(f"{w} " * n for w, n in words.items())
    return [{"doc_id": start, "text": text, "lang": "en", "source": "s", "n_chars": 1}]


@pytest.mark.parametrize("pairs, heavy_rows", [(512, 10_000), (3, 10_000), (3, 5)])
def test_against_all_pairs(spark, monkeypatch, pairs, heavy_rows):
    monkeypatch.setattr(spelling, "GROUP_PAIRS", pairs)
    monkeypatch.setattr(spelling, "HEAVY_ROWS", heavy_rows)
    rows = sample_documents()[:120] + odd_documents() + rows_with(odd_words())
    found = spelling.spelling_forms(with_clashes(documents(spark, rows)), noise=31)
    assert found.columns == list(COLUMNS)
    want = plain_forms(plain_words(rows, 31))
    assert rows_of(found, *COLUMNS) == want
    assert sum(w[3] is not None for w in want) > 10


def test_pairs_come_once(spark):
    words = {w: n for w, n in odd_words().items() if len(w) < 100}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.near_pairs(df, 1).collect()
    pairs = Counter(frozenset((r["a"], r["b"])) for r in found)
    assert set(pairs.values()) == {1}
    assert set(pairs) == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_one_stem_with_very_many_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "GROUP_PAIRS", 64)
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèé"
    words = {f"common{a}stem{b}": 2 for a in letters for b in letters}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.near_pairs(df, 7)
    n = len(letters)
    assert found.count() == 2 * n * n * (n - 1) // 2
    assert found.select("a", "b").distinct().count() == found.count()


def test_chains_are_followed_to_their_end(spark):
    chain = {"abcdefg" + "h" * k: 10 ** (4 - k) * 2 for k in range(5)}
    df = documents(spark, rows_with(chain))
    found = {r["word"]: r for r in spelling.spelling_forms(df).collect()}
    assert {r["root"] for r in found.values()} == {"abcdefg"}
    assert found["abcdefghhhh"]["form"] == "abcdefghhh" and found["abcdefg"]["form"] is None


@pytest.mark.parametrize("rows", [[], odd_documents()[:3], rows_with({"lonelyword": 2})])
def test_few_rows(spark, rows):
    found = spelling.spelling_forms(documents(spark, rows), noise=31)
    assert rows_of(found, *COLUMNS) == plain_forms(plain_words(rows, 31))


def test_query(spark):
    found = QUERIES["op12_spelling_variants"](spark, SF)
    assert [f.dataType.simpleString() for f in found.select(*COLUMNS).schema] == ["string", "bigint", "bigint", "string", "bigint", "string"]
    assert rows_of(found, *COLUMNS) == plain_forms(plain_words(sample_documents(), 31))
