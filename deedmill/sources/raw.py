"""Raw layer: append-only documents (id, data, extracted_at)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from deedmill.functions.truth import filled


def wrap_raw(
    df: DataFrame, id_field: str, extracted_at: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Each record as one JSON document beside its id; NULL fields are kept.

    Columns in ``keep`` stand beside the document and not in it.
    """
    fields = [F.col(f"`{c}`") for c in df.columns if c not in keep]
    document = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    stamp = F.current_timestamp() if extracted_at is None else extracted_at
    ident = F.col(id_field) if id_field in df.columns else F.lit(None)
    return df.select(
        ident.cast("string").alias(id_field),
        document.alias("data"),
        stamp.alias("extracted_at"),
        *keep,
    )


def resolved_id(id_field: str) -> Column:
    """The row's id, else the one inside the document."""
    inside = F.get_json_object("data", f"$.{id_field}")
    return F.coalesce(filled(F.col(id_field)), filled(inside))


def with_resolved_id(raw: DataFrame, id_field: str) -> DataFrame:
    """Rows that have an id in either place, with that id."""
    return raw.withColumn(id_field, resolved_id(id_field)).where(F.col(id_field).isNotNull())


def resolved_ids(raw: DataFrame, id_field: str) -> DataFrame:
    """The ids of ``with_resolved_id``, repeats included, without reading documents.

    Rows with an id of their own need only that column; the others are told
    apart by a filter that reaches the scan, which skips all row groups where
    every row has its id.
    """
    own = F.col(id_field)
    outside = raw.where(own != "").select(id_field)
    inside = raw.where(own.isNull() | (own == "")).select(resolved_id(id_field).alias(id_field))
    return outside.union(inside.where(own.isNotNull()))


def open_envelope(
    raw: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ("extracted_at",), once: bool = False
) -> DataFrame:
    """The document's fields as columns; a missing document gives NULLs.

    Columns in ``keep`` stand beside them under a leading underscore. ``once`` is
    for frames that are filtered by the fields: the filter would move below
    and parse every document a second time, but stays above a generator.
    """
    doc = F.from_json(F.coalesce(F.col("data"), F.lit("{}")), schema)
    kept = [F.col(c).alias(f"_{c}") for c in keep]
    if once:
        return raw.select(F.inline(F.array(doc)), *kept)
    return raw.select(doc.alias("_doc"), *kept).select(
        "_doc.*", *[f"_{c}" for c in keep]
    )


def append_raw(
    raw: DataFrame, path: str, batch: str | Column, name: str = "rows", replace: bool = False
) -> int:
    """Append one load to the raw table; returns the rows written.

    ``batch`` names the load (a day, say) and becomes the partition. With
    ``replace`` an earlier try of the same load makes way, so that a job may be
    run again after a failure halfway. The count is observed while writing. No
    rows, no data files.
    """
    seen = Observation(name)
    rows = raw.withColumn("batch", batch if isinstance(batch, Column) else F.lit(batch))
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy("batch")
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)
    return int(seen.get["rows"])


def replace_batches(raw: DataFrame, path: str, many: bool = True) -> None:
    """Write whole batches (column ``batch``), replacing earlier tries of the same ones.

    With ``many`` batches at once their rows are brought together first, as
    every task would otherwise write a small file for each; AQE splits a batch
    that is much larger than the others.
    """
    rows = raw.hint("rebalance", "batch") if many else raw
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str, id_field: str) -> DataFrame:
    """A raw table with its ``batch`` column, on which filters skip whole folders."""
    schema = T.StructType(
        [
            T.StructField(id_field, T.StringType()),
            T.StructField("data", T.StringType()),
            T.StructField("extracted_at", T.TimestampType()),
            T.StructField("batch", T.StringType()),
        ]
    )
    return spark.read.schema(schema).parquet(path)
