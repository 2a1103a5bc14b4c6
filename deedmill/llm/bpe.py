"""BPE encoding by a distinct-word table, and decoding by an id-to-piece join.

Encoding splits each text once and shuffles no text:

1. a task cuts its rows into *blocks* of about ``BLOCK_CHARS`` characters. A block
   yields its documents as word numbers (frequent words first, compressed) and,
   for each *bucket* that the hash of a word names, the sorted distinct words;
2. a bucket encodes each of its distinct words once and answers every block that
   asked, in the order of the question, with ids alone;
3. a block joins the ids back to the positions of its words.

Questions and documents travel in one exchange, which Spark writes once and reads
for both steps. No word table is broadcast or collected; blocks and buckets keep
their size when the corpus grows, there are only more of them. A block's name
holds a digest of its words, so that an answer never meets another block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from deedmill.llm.token_counts import chunks
from deedmill.llm.tokenizers import load_units

#: Characters of text in a block.
BLOCK_CHARS = 8 << 20
#: Words whose ids are put in place at once.
PLACED = 1 << 18


def bucket_count(docs: DataFrame, text_col: str) -> int:
    """Buckets for the whole table: one pass over the text column's lengths."""
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0]
    return max(8, -(-(total or 0) // BLOCK_CHARS))


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2**32, as compressed planes of their bytes."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return len(numbers).to_bytes(8, "little") + pa.compress(
        np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True
    )


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(packed[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _pack_words(words: list[str]) -> bytes:
    raw = "".join(words).encode()
    sizes = _pack(np.fromiter(map(len, words), np.int64, len(words)))
    head = len(raw).to_bytes(8, "little") + len(sizes).to_bytes(8, "little")
    return head + sizes + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpack_words(packed: bytes) -> list[str]:
    n_raw, n_sizes = int.from_bytes(packed[:8], "little"), int.from_bytes(packed[8:16], "little")
    ends = np.cumsum(_unpack(packed[16 : 16 + n_sizes])).tolist()
    raw = pa.decompress(packed[16 + n_sizes :], n_raw, codec="zstd", asbytes=True).decode() if n_raw else ""
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, … of every stretch, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class _Block:
    """Documents of a block as numbers of its distinct words."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.codes: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.chars = 0

    def add(self, split: list[list[str]], chars: int) -> None:
        new = set().union(*split).difference(self.number)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        for words in split:
            self.codes.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
            self.sizes.append(len(words))
        self.chars += chars

    def rows(self, n_buckets: int, seat: str) -> list[dict]:
        """The row of the documents, then one question per bucket."""
        words = sorted(self.number)
        bucket = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)) % np.uint64(n_buckets)
        order = np.argsort(bucket, kind="stable")
        words, bucket = [words[k] for k in order], bucket[order].astype(np.int64)
        place = np.empty(len(words), np.int64)  # of each number, in the order of the questions
        place[np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int32)
        common = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[common] = np.arange(len(words))
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(words) else np.zeros(0, np.int64)
        packed = [_pack_words(words[a:b]) for a, b in zip(cuts, [*cuts[1:], len(words)])]
        digest = xxhash.xxh64_intdigest(b"".join(packed))
        name = f"{seat}-{digest:016x}-{len(words)}"
        rows = [
            {
                "key": name,
                "number": len(words),
                "sizes": _pack(np.array(self.sizes, np.int64)),
                "words": _pack(rank[codes]),
                "places": _pack(place[common]),
            }
        ]
        rows += [
            {"key": str(bucket[a]), "block": name, "number": int(bucket[a]), "words": w} for a, w in zip(cuts, packed)
        ]
        return rows


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``ids``, an array of the text's token ids.

    Equal to the library's encoding without special tokens added, truncation and
    padding; strings of special tokens inside a text are encoded as the library
    does by default. Null and empty texts give an empty array. Null and repeated
    ids keep a row each, equal rows are spread like others; other columns are not
    read. ``docs`` is to be a stored table: its rows must come in the same order
    whenever a lost task runs again.
    """
    n_buckets = bucket_count(docs, text_col)
    id_field = T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType))
    asked = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("block", T.StringType()),
            T.StructField("number", T.LongType()),
            id_field,
            T.StructField("sizes", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("places", T.BinaryType()),
        ]
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = load_units(path)
        seat = str(TaskContext.get().partitionId())
        block, ids, nth = _Block(), [], 0

        def flush() -> pa.RecordBatch:
            nonlocal block, ids, nth
            rows, own = block.rows(n_buckets, f"{seat}.{nth}"), pa.concat_arrays(ids)
            block, ids, nth = _Block(), [], nth + 1
            lists = pa.ListArray.from_arrays(
                pa.array([0] + [len(own)] * len(rows), pa.int32()), own
            )
            columns = [
                pa.array([r["key"] for r in rows], pa.string()),
                pa.array([r.get("block") for r in rows], pa.string()),
                pa.array([r["number"] for r in rows], pa.int64()),
                lists,
                *[pa.array([r.get(c) for r in rows], pa.binary()) for c in ("sizes", "words", "places")],
            ]
            return pa.RecordBatch.from_arrays(columns, asked.names)

        for batch in batches:
            at = 0
            for texts in chunks([t or "" for t in batch.column("text").to_pylist()]):
                block.add([units.split(t) for t in texts], sum(map(len, texts)))
                ids.append(batch.column("id").slice(at, len(texts)))
                at += len(texts)
                if block.chars >= BLOCK_CHARS:
                    yield flush()
        if ids:
            yield flush()

    def answer(table: pa.Table) -> pa.Table:
        asked_words = [_unpack_words(w) for b, w in zip(table["block"].to_pylist(), table["words"].to_pylist()) if b]
        blocks = [b for b in table["block"].to_pylist() if b]
        words = list(set().union(*asked_words))
        ids, sizes = load_units(path).merge(words) if words else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        starts = np.cumsum(sizes) - sizes
        code = {w: k for k, w in enumerate(words)}
        out_sizes, out_ids = [], []
        for part in asked_words:
            at = np.fromiter(map(code.__getitem__, part), np.int64, len(part))
            out_sizes.append(_pack(sizes[at]))
            out_ids.append(_pack(ids[_gather(starts[at], sizes[at])]))
        numbers = [n for n, b in zip(table["number"].to_pylist(), table["block"].to_pylist()) if b]
        return pa.table(
            {
                "key": pa.array(blocks, pa.string()),
                "bucket": pa.array(numbers, pa.int64()),
                "unit_sizes": pa.array(out_sizes, pa.binary()),
                "unit_ids": pa.array(out_ids, pa.binary()),
            }
        )

    def join_back(own: pa.Table, answers: pa.Table) -> pa.Table:
        documents = own.filter(pa.compute.is_null(own["block"]))
        if not len(documents):
            return pa.table({id_col: own["ids"].combine_chunks().values.slice(0, 0), "ids": pa.array([], pa.list_(pa.int32()))})
        row = documents.slice(0, 1)
        answers = answers.sort_by("bucket")
        sizes = np.concatenate([np.zeros(0, np.int64), *map(_unpack, answers["unit_sizes"].to_pylist())])
        ids = np.concatenate(
            [np.zeros(0, np.int32), *(_unpack(u.as_py()).astype(np.int32) for u in answers["unit_ids"])]
        )
        if len(sizes) != row["number"][0].as_py():
            raise RuntimeError("the words of a block and the answers to it differ: the input changed its row order")
        starts = np.cumsum(sizes) - sizes
        words = _unpack(row["places"][0].as_py()).astype(np.int32)[_unpack(row["words"][0].as_py()).astype(np.int32)]
        per_text = _unpack(row["sizes"][0].as_py())
        ends = np.r_[0, np.cumsum(sizes[words])]
        out = np.empty(ends[-1], np.int32)
        for at in range(0, len(words), PLACED):
            part = words[at : at + PLACED]
            out[ends[at] : ends[at + len(part)]] = ids[_gather(starts[part], sizes[part])]
        ends = ends[np.r_[0, np.cumsum(per_text)]]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out))
        return pa.table({id_col: row["ids"].combine_chunks().flatten(), "ids": lists})

    questions = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(ask, asked)
    answers = questions.groupBy("key").applyInArrow(answer, "key string, bucket long, unit_sizes binary, unit_ids binary")
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )
    return questions.groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(join_back, schema)


def decode(encoded: DataFrame, path: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with a text column: the pieces of the ids, joined by id and put together.

    The other side of the join is the vocabulary, a table of as many rows as the
    tokenizer has ids, whatever the corpus; every worker holds it and takes the
    pieces of a batch by id. Bytes that are no UTF-8 become U+FFFD, as in the
    library. A null array gives null, an empty one an empty text; ids outside the
    vocabulary give nothing.
    """
    names = [c for c in encoded.columns if c != out_col]
    schema = T.StructType([*encoded.select(*names).schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = load_units(path).pieces()
        pieces = np.array([p or b"" for p in listed] + [b""], dtype=object)
        for batch in batches:
            column = batch.column(ids_col)
            texts = []
            for ids in column:
                if not ids.is_valid:
                    texts.append(None)
                    continue
                at = np.nan_to_num(ids.values.to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
                at[(at < 0) | (at >= len(listed))] = len(listed)
                texts.append(b"".join(pieces[at]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col]
            )

    return encoded.select(*names).mapInArrow(run, schema)
