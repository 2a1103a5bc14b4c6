"""Token ids as Parquet: list columns with dictionary or delta encoding, bounded row groups, page indexes.

A data set is a folder with two tables:

- ``tokens``: ``doc_id``, ``n_tokens``, ``part`` (the file's number), ``part_start`` (ids before the
  row in its file) and ``ids``; rows ascend by id within a file and from file to file;
- ``parts``: ``part``, ``first`` (ids in all files before) and ``part_tokens``; one row per file.

Parquet writes a column index for every page, so readers of some documents or of
the metadata columns alone skip the pages of all other ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from deedmill.llm.bpe import _gather
from deedmill.llm.token_counts import REMEMBERED, chunks
from deedmill.llm.tokenizers import Units, load_units

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 1 << 20
PAGE_ROWS = 2_000
#: Text bytes for one file.
FILE_BYTES = 64 << 20


class TextEncoder:
    """Ids of whole texts; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str, units: Units | None = None):
        self.units = units or load_units(path)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        ids, sizes = self.units.merge(new)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, texts: list[str], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, each text followed by ``end_id``, and the ids per text."""
        split = [self.units.split(t) for t in texts]
        new = list(set().union(*split).difference(self.number))
        if len(self.number) + len(new) > REMEMBERED:
            self._forget()
            new = list(set().union(*split))
        if new:
            self._learn(new)
        out, counts = [], []
        tail = np.zeros(0, np.int32) if end_id is None else np.array([end_id], np.int32)
        for words in split:
            at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
            own = self.ids[_gather(self.starts[at], self.sizes[at])] if len(at) else np.zeros(0, np.int32)
            out += [own, tail]
            counts.append(len(own) + len(tail))
        return np.concatenate(out) if out else np.zeros(0, np.int32), np.array(counts, np.int64)


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = None,
    dictionary: bool = True,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Encode whole texts and write them in ascending order of their ids.

    Null and empty texts have no ids but ``end_id``. Null ids come first; rows
    with equal ids come in the order of a hash of their texts, and many of them
    are spread over several files. Other columns are not read. Texts, not ids,
    are moved into order, since ranges are sampled from what is moved.
    ``dictionary=False`` writes delta-encoded ids.
    """
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("part_start", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = TextEncoder(path), 0
        for batch in batches:
            at = 0
            for texts in chunks([t or "" for t in batch.column("text").to_pylist()]):
                ids, counts = encoder(texts, end_id)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(at, len(texts)),
                        pa.array(counts),
                        batch.column("part").slice(at, len(texts)),
                        pa.array(before + ends - counts),
                        pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids)),
                    ],
                    schema.names,
                )
                at += len(texts)
                before += int(ends[-1])

    total = docs.agg(F.sum(F.octet_length(text_col).cast("long") + 32)).first()[0] or 0
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = (
        rows.repartitionByRange(max(1, -(-total // FILE_BYTES)), *order)
        .sortWithinPartitions(*order)
        .select("id", "text", F.spark_partition_id().alias("part"))
    )
    (
        ordered.mapInArrow(run, schema)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", str(dictionary).lower())
        .parquet(f"{folder}/tokens")
    )
    # sizes of the files, from the metadata columns alone; one row per file from here on
    sizes = spark.read.parquet(f"{folder}/tokens").groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select(
        "part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("first"), "part_tokens"
    ).write.mode("overwrite").parquet(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str, *, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start`` (ids of all rows before), ``n_tokens`` and, if asked for, ``ids``.

    Filters on ``doc_id`` reach the page index; without ``ids`` their pages stay unread.
    """
    tokens = spark.read.parquet(f"{folder}/tokens")
    parts = spark.read.parquet(f"{folder}/parts").select("part", "first")
    # one row per file, some dozens of bytes for what is FILE_BYTES of text
    return tokens.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("first") + F.col("part_start")).alias("start"), "n_tokens", *(["ids"] if with_ids else [])
    )


def with_crc32(tokens: DataFrame, ids_col: str = "ids", out_col: str = "ids_crc32") -> DataFrame:
    """Replaces the ids by the CRC-32 of their little-endian unsigned 32-bit integers."""
    names = [c for c in tokens.columns if c not in (ids_col, out_col)]
    schema = T.StructType([*tokens.select(*names).schema.fields, T.StructField(out_col, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                zlib.crc32(ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()) if ids.is_valid else None
                for ids in batch.column(ids_col)
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sums, pa.int64())], schema.names)

    return tokens.mapInArrow(run, schema)
