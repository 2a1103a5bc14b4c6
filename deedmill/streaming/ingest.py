"""Incremental ingest: landed files, each processed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from deedmill.operators.dedupe import latest_per_key
from deedmill.session import job_folder
from deedmill.sources.buckets import merge_buckets
from deedmill.sources.raw import replace_batches, wrap_raw


def incremental_ingest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    id_field: str,
    ts: str,
    raw_path: str,
    table_base: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    file_format: str = "parquet",
    options: dict[str, str] | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Take in the files that came since the last run, then stop.

    Every micro-batch lands in the raw table and its newest row per id is
    taken into the table, of which only the buckets of its ids are rewritten. A batch replayed after a failure replaces
    its own raw partition and upserts the same rows, so replays change nothing.
    Late rows need no watermark: rows of a batch and the table's own compete by
    the same order (newest, then ``tiebreak``), so the result does not depend on
    how files fall into batches. Without a total order the table's row stays.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        landed = wrap_raw(batch, id_field, F.col(ts).cast("timestamp"))
        replace_batches(landed.withColumn("batch", F.lit(f"stream-{batch_id:010d}")), raw_path, many=False)
        newest = latest_per_key(batch, [id_field], ts, tiebreak)
        with job_folder(spark):
            merge_newest(newest, table_base, id_field, ts, tiebreak)

    (
        reader.load(landing)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def merge_newest(rows: DataFrame, table_base: str, key: str, ts: str, tiebreak: Sequence[str] = ()) -> int:
    """Take in ``rows`` (one per key) where they come before the table's row of the same key.

    Only the buckets of the batch's keys are read and written; returns their number.
    """

    def newest(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        if current is None:
            return batch
        # where no order decides, the table's row stays
        both = current.withColumn("_new", F.lit(1)).unionByName(batch.withColumn("_new", F.lit(2)), allowMissingColumns=True)
        return latest_per_key(both, [key], ts, [*tiebreak, "_new"]).drop("_new")

    return merge_buckets(rows, table_base, [key], newest)
