"""Small inputs that hold every odd case, and brute-force helpers."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use inside, to clash with them.
CLASHES = [
    "id", "key", "block", "words", "n", "node", "shard", "tokens", "weight", "rule", "kept", "ids", "_text", "place",
    "_row_key", "_place", "n_words", "sampled", "topic", "row", "row_key", "component", "_terms", "copies"]


def sample_documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def odd_documents():
    long = "lorem ipsum dolor sit amet, " * 9000
    texts = [
        None, "", "   \n\t ", "one", "a b c d", "same words here for all of us", "same words here for all of us",
        "SAME words here for all of us", "<|endoftext|>a<|endoftext|> b<|startoftext|>", "日本語 テキスト 한국어 αΣ ς İ x́   ½",
        "aaaa" * 300, "  \n\n x\t\ty 'll don't 12345", long, long + "tail", "\u0085  \x1c x", "😀😀 emoji🎉",
        "mail a.b@c.d.org, 10.0.0.1 and 300.1.1.1, 4111 1111 1111 1111, +1 (555) 010-9999.",
    ]
    rows = [{"doc_id": 1000 + k, "text": t, "lang": "en", "source": "odd", "n_chars": len(t or "")} for k, t in enumerate(texts)]
    rows += [dict(rows[5]), dict(rows[5])]  # repeated rows
    rows += [{**rows[5], "doc_id": None}, {**rows[16], "doc_id": None, "lang": None, "source": None}]
    return rows


def documents(spark, rows=None):
    rows = sample_documents() + odd_documents() if rows is None else rows
    return spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)


def stored(df, tmp_path, name="docs"):
    path = str(tmp_path / name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def least_reachable(sets, per_hundred=85):
    """Index of the component of each set, by all pairs that share an element."""
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for k, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j > k).items():
            if 100 * both >= per_hundred * (len(s) + len(sets[j]) - both):
                a, b = find(k), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(sets))]
