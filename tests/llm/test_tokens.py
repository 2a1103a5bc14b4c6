"""Tokenizer units, BPE encoding and decoding, token counts, token files."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedmill.llm import bpe, token_counts, token_files
from deedmill.llm.queries import QUERIES
from deedmill.llm.tokenizers import default_path, load_units
from tests.llm.data import SF, documents, odd_documents, rows_of, sample_documents, stored, with_clashes

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module", params=NAMES)
def units(request):
    return load_units(default_path(request.param))


def encoded(units, text):
    split = units.split(text)
    ids, sizes = units.merge(split)
    assert len(sizes) == len(split) and sizes.sum() == len(ids)
    return ids.tolist()


def test_latin_characters_split_like_the_library(units):
    for c in map(chr, range(256)):
        for text in (c, f"a{c}", f"{c}a", f"1{c}1", f" {c} ", f"{c}{c}", f"a {c}\n{c}b", f"'{c}s"):
            want = units.library.encode(text, add_special_tokens=False).ids
            assert encoded(units, text) == want, repr(text)


def test_random_texts_encode_like_the_library(units):
    rng = random.Random(3)
    alphabet = "aabbe  \n\t'’st01!?éßñαΣ日本  x́😀|#"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]
    texts += ["a" * k for k in range(1, 40)] + ["ab" * 700, "<|endoftext|>x", "<|endoftext|><|endoftext|>", "<|endoftext"]
    for text in texts:
        assert encoded(units, text) == units.library.encode(text, add_special_tokens=False).ids, repr(text)


def test_merge_of_nothing(units):
    ids, sizes = units.merge([])
    assert len(ids) == len(sizes) == 0


def test_encode_equals_the_library_on_all_odd_rows(spark, tmp_path):
    path = default_path(NAMES[0])
    library = load_units(path).library
    rows = sample_documents() + odd_documents()
    found = bpe.encode(stored(with_clashes(documents(spark, rows)), tmp_path), path)
    assert found.columns == ["doc_id", "ids"]
    want = [(r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in rows]
    assert sorted((r[0] or -1, tuple(r[1])) for r in found.collect()) == sorted((i or -1, t) for i, t in want)
    back = bpe.decode(found, path)
    want = sorted((i or -1, library.decode(list(t), skip_special_tokens=False)) for i, t in want)
    assert sorted((r["doc_id"] or -1, r["decoded"]) for r in back.collect()) == want


def test_many_small_blocks_give_the_same(spark, tmp_path, monkeypatch):
    path = default_path(NAMES[0])
    docs = stored(documents(spark), tmp_path)
    want = sorted((r[0] or -1, tuple(r[1])) for r in bpe.encode(docs, path).collect())
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 5_000)
    assert bpe.bucket_count(docs, "text") > 20
    assert sorted((r[0] or -1, tuple(r[1])) for r in bpe.encode(docs, path).collect()) == want


def test_decode_of_odd_ids(spark):
    rows = [(1, [50256, 10**6, -1]), (2, None), (3, []), (4, [262, None])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(df, default_path(NAMES[0])).collect()}
    assert found == {1: "<|endoftext|>", 2: None, 3: "", 4: " the"}


def test_round_trip_query(spark):
    library = load_units(default_path(NAMES[0])).library
    found = {r["doc_id"]: r for r in QUERIES["op3_bpe_round_trip"](spark, SF).collect()}
    for r in sample_documents():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        row = found[r["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", NAMES)
def test_counts_equal_the_library(spark, name):
    library = load_units(default_path(name)).library
    rows = sample_documents() + odd_documents()
    found = token_counts.count_tokens(with_clashes(documents(spark, rows)), default_path(name))
    want = {}
    for r in rows:
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        key = (r["doc_id"], len((r["text"] or "").encode()), n, n > 1024)
        want[key] = want.get(key, 0) + 1
    assert rows_of(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_counts_do_not_depend_on_what_is_remembered(spark, monkeypatch):
    path = default_path(NAMES[0])
    docs = documents(spark)
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    want = rows_of(token_counts.count_tokens(docs, path), *columns)
    encoder = token_files.TextEncoder(path)
    texts = [r["text"] or "" for r in odd_documents()]
    first = encoder(texts, 1)
    monkeypatch.setattr(token_files, "REMEMBERED", 10)
    second = token_files.TextEncoder(path)(texts, 1)
    assert (first[0] == second[0]).all() and (first[1] == second[1]).all()
    assert rows_of(token_counts.count_tokens(docs, path), *columns) == want


@pytest.mark.parametrize("dictionary", [True, False])
def test_token_files_round_trip(spark, tmp_path, dictionary):
    import pyarrow.parquet as pq

    path = default_path(NAMES[1])
    library = load_units(path).library
    rows = [r for r in sample_documents() + odd_documents() if r["doc_id"] is not None]
    rows = list({r["doc_id"]: r for r in rows}.values())
    folder = str(tmp_path / "files")
    token_files.write_token_files(
        with_clashes(documents(spark, rows)), folder, path, end_id=1, dictionary=dictionary, page_rows=20
    )
    found = token_files.with_crc32(token_files.read_token_files(spark, folder)).orderBy("doc_id").collect()
    start = 0
    for r, row in zip(sorted(rows, key=lambda r: r["doc_id"]), found, strict=True):
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (r["doc_id"], start, len(ids), crc)
        start += len(ids)
    file = next((tmp_path / "files" / "tokens").glob("*.parquet"))
    column = pq.ParquetFile(file).metadata.row_group(0).column(4)
    assert column.path_in_schema.startswith("ids") and column.has_offset_index
    assert any(("DICTIONARY" in e) == dictionary for e in column.encodings if e.startswith(("RLE_DICT", "DELTA")))


def test_token_files_are_read_in_part(spark, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write_token_files(documents(spark, sample_documents()), folder, default_path(NAMES[1]))
    plan = token_files.read_token_files(spark, folder, with_ids=False).where("doc_id = 7")
    text = plan._jdf.queryExecution().toString()
    schema = text[text.rindex("ReadSchema") :].split("\n")[0]
    assert "ids" not in schema and "EqualTo(doc_id,7)" in text
    assert plan.count() == 1


def test_token_files_with_null_and_repeated_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 20_000)
    rows = sample_documents()[:50] + odd_documents()
    folder = str(tmp_path / "files")
    token_files.write_token_files(documents(spark, rows), folder, default_path(NAMES[1]), end_id=1)
    found = token_files.read_token_files(spark, folder).orderBy("start").collect()
    assert len(found) == len(rows)
    assert [r["doc_id"] for r in found] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(found, found[1:]))
    assert spark.read.parquet(f"{folder}/parts").count() > 5


def test_empty_tables(spark, tmp_path):
    none = stored(documents(spark, []), tmp_path)
    path = default_path(NAMES[0])
    assert bpe.decode(bpe.encode(none, path), path).collect() == []
    assert token_counts.count_tokens(none, path).collect() == []
    token_files.write_token_files(none, str(tmp_path / "files"), path)
    assert token_files.with_crc32(token_files.read_token_files(spark, str(tmp_path / "files"))).collect() == []


def test_text_column_of_another_name(spark):
    df = documents(spark, odd_documents()).select(F.col("text").alias("body"), F.col("doc_id").cast("string").alias("name"))
    found = token_counts.count_tokens(df, default_path(NAMES[0]), id_col="name", text_col="body")
    assert found.columns == ["name", "n_bytes", "n_tokens", "over_limit"] and found.count() == df.count()
